"""Token counts by finite-state machines compiled from a byte-level BPE file.

Two deterministic transducers, one after the other:

* The splitter reads characters (as classes, with the next two characters folded into the class) and says where a new
  piece begins. Texts are cut into chunks of equal length. Each chunk is a map from every state at its begin to the state
  at its end; the maps are composed by a parallel prefix scan, which gives each chunk the state it really begins in, and
  all chunks then emit at once.
* The merger reads the bytes of a piece. A transition carries the change of the token count: reading a byte may end a
  token or join the last ones. A state is what can still matter: the longest suffix that begins some token of the
  vocabulary, and for each place in it the last token of the encoding up to there and its count, relative to now. States
  are compiled when first reached. All pieces of a batch step together, a byte at a time.

That a prefix's encoding is one token after the encoding of what stands before it, and which token that is, follows from
pairs: token t may follow token p if merging the bytes of both again gives p, t.

Counts equal those of the library that reads the file: no tokens are added, and a special string inside a text is one
token. The classes of characters outside ASCII are asked of that library, once for each character.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Rows are counted one by one, so repeated rows and null keys
need no care. Long texts are cut into windows, at the begin of a piece, so memory is bounded by the window and the longest
piece.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from facetide.llm.common import without
from facetide.llm.words import buffers, pieces
from facetide.session import ship

LIMIT = 512
RESULTS = ("n_bytes", "n_tokens", "over_limit")

# Classes of characters, as the splitter reads them.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACES, LAST_SPACE, LAST_WHITE, END = range(9)
WHITE = SPACES
# States of the splitter: a piece has just ended; in a run of one kind; after a space that begins a piece; inside a
# contraction of which one or two more characters come.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)
STATES = 8
CHUNK = 128
WINDOW_BYTES = 4 << 20
#: Pieces longer than this are read one by one.
LONG_PIECE = 256
#: Compiled states that a task holds; beyond that it begins anew.
MAX_STATES = 3 << 17


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and begins[class, state]."""
    to, begins = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for kind, inside in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        to[kind] = inside
        begins[kind, [inside, AFTER_SPACE]] = False
    for kind, inside in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        to[kind] = inside
        to[kind, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        begins[kind, [IN_OTHERS, AFTER_SPACE]] = False
    to[SPACES] = IN_SPACES
    begins[SPACES, IN_SPACES] = False
    to[LAST_SPACE] = AFTER_SPACE
    to[LAST_WHITE] = DONE
    to[:, ONE_MORE], begins[:, ONE_MORE] = DONE, False
    to[:, TWO_MORE], begins[:, TWO_MORE] = ONE_MORE, False
    to[END], begins[END] = DONE, True
    return to, begins


_NEXT, _BEGINS = _splitter()


class Classes:
    """The class of each code point. ASCII is known; others are found by asking the library how it splits."""

    UNKNOWN = 255

    def __init__(self, split):
        self._split = split
        self.of = np.full(0x110000, self.UNKNOWN, np.uint8)
        self._ask(range(128))

    def _ask(self, points) -> None:
        # Joined to a letter, a number or another sign, a character of that kind makes one piece with it.
        for p in points:
            c = chr(p)
            kind = WHITE
            for known, k in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
                if len(self._split(known + c)) == 1:
                    kind = k
                    break
            self.of[p] = kind

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.of[points]
        if (out == self.UNKNOWN).any():
            new = np.unique(points[out == self.UNKNOWN])
            # Surrogates do not occur in UTF-8.
            self._ask(p for p in new.tolist() if not 0xD800 <= p < 0xE000)
            out = self.of[points]
        return out


def splits(kinds: np.ndarray, points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where pieces begin. ``last`` marks the last character of each text; nothing reads across it."""
    n = len(kinds)
    if not n:
        return np.zeros(0, bool)
    symbols = kinds.copy()
    after = np.full(n + 2, -1, np.int64)
    after[:n] = points
    one = np.where(last, -1, after[1:n + 1])
    two = np.where(last | np.append(last[1:], True), -1, after[2:n + 2])
    quote = points == ord("'")
    symbols[quote & np.isin(one, [ord(c) for c in "stmd"])] = SHORT
    for x, y in ("re", "ve", "ll"):
        symbols[quote & (one == ord(x)) & (two == ord(y))] = LONG
    white = kinds == WHITE
    before_text = white & ~last & ~np.append(white[1:], True)
    symbols[before_text & (points == 0x20)] = LAST_SPACE
    symbols[before_text & (points != 0x20)] = LAST_WHITE

    # A text's first character has a class of its own, in which every state acts like DONE.
    to = np.concatenate([_NEXT, np.repeat(_NEXT[:, [DONE]], STATES, axis=1)])
    begins = np.concatenate([_BEGINS, np.ones_like(_BEGINS)])
    first = np.ones(n, bool)
    first[1:] = last[:-1]
    symbols = symbols.astype(np.int64) + 9 * first

    rows = -(-n // CHUNK)
    padded = np.full(rows * CHUNK, END, np.int64)
    padded[:n] = symbols
    grid = np.ascontiguousarray(padded.reshape(rows, CHUNK).T) * STATES
    flat_to, flat_begins = to.ravel(), begins.ravel()
    # The map of each chunk: from every state to the state at its end.
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for step in grid:
        maps = flat_to[step[:, None] + maps]
    # Prefix scan: after each round a chunk's map covers twice as many chunks before it.
    gap = 1
    while gap < rows:
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.int64), axis=1)
        gap *= 2
    state = np.full(rows, DONE, np.int64)
    state[1:] = maps[:-1, DONE]
    out = np.empty((CHUNK, rows), bool)
    for k, step in enumerate(grid):
        at = step + state
        out[k] = flat_begins[at]
        state = flat_to[at]
    return out.T.ravel()[:n]


class Merger:
    """The transducer of the merges, compiled as it is used."""

    ROOT = 0

    def __init__(self, vocabulary: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        self._tokens = sorted(vocabulary)
        self._ident = {t: i for i, t in enumerate(self._tokens)}
        self._ranks = ranks
        self._prefixes = {t[:k] for t in vocabulary for k in range(len(t) + 1)}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._number: dict[bytes, int] = {}
        self._states: list[bytes] = []
        self._step = Transitions()
        # Suffix that begins a token; for each place in it, the token that ends there (none at the piece's begin) and count.
        self._add(b"", [(-1, 0)])

    def _add(self, suffix: bytes, places: list[tuple[int, int]]) -> int:
        # A place matters only if what stands behind it begins a token.
        held = [p if suffix[i:] in self._prefixes else (-2, 0) for i, p in enumerate(places)]
        state = array("i", [x for p in held for x in p]).tobytes() + suffix
        n = self._number.setdefault(state, len(self._states))
        if n == len(self._states):
            self._states.append(state)
        return n

    def _read(self, number: int) -> tuple[bytes, list[tuple[int, int]]]:
        state = self._states[number]
        size = (len(state) - 8) // 9  # 8 bytes for each place, of which there is one more than letters
        numbers = array("i", state[:8 * (size + 1)]).tolist()
        return state[8 * (size + 1):], list(zip(numbers[::2], numbers[1::2]))

    def full(self) -> bool:
        return len(self._states) > MAX_STATES

    def _may_follow(self, left: bytes, right: bytes) -> bool:
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) > 1 << 18:
                self._pairs.clear()
            found = self._pairs[left, right] = self.encode(left + right) == [left, right]
        return found

    def encode(self, piece: bytes) -> list[bytes]:
        """By the merges themselves; for the short strings that decide pairs."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self._ranks.get((parts[i], parts[i + 1]), 1 << 60))
            pair = parts[best], parts[best + 1]
            if pair not in self._ranks:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def compile(self, number: int, byte: int) -> tuple[int, int]:
        """The next state and the change of the count."""
        suffix, places = self._read(number)
        text = suffix + bytes([byte])
        for size in range(len(text), 0, -1):
            token = text[len(text) - size:]
            ident = self._ident.get(token)
            if ident is not None:
                left, count = places[len(text) - size]
                if left == -1 or left >= 0 and self._may_follow(self._tokens[left], token):
                    break
        else:
            raise ValueError(f"byte {byte} is in no token")
        keep = text
        while keep not in self._prefixes:
            keep = keep[1:]
        change = count + 1
        held = [(t, c - change) for t, c in (*places, (ident, change))[len(text) - len(keep):]]
        to = self._add(keep, held)
        self._step.add(number << 8 | byte, to, change)
        return to, change

    def counts(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        out = np.zeros(len(start), np.int64)
        order = np.argsort(-size, kind="stable")
        long = int(np.searchsorted(-size[order], -LONG_PIECE, "left"))
        for i in order[:long].tolist():
            out[i] = self._count(data[start[i]:start[i] + size[i]].tolist())
        order = order[long:]
        begin, left = start[order], -size[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for step in range(LONG_PIECE):
            active = int(np.searchsorted(left, -step, "left"))
            if not active:
                break
            key = state[:active] << 8 | data[begin[:active] + step]
            slot = self._step.find(key)
            missing = np.flatnonzero(slot < 0)
            if len(missing):
                for k in np.unique(key[missing]).tolist():
                    self.compile(k >> 8, k & 255)
                # Adding may have moved what was found before.
                slot = self._step.find(key)
            total[:active] += self._step.change[slot]
            state[:active] = self._step.to[slot]
        out[order] = total
        if self.full():
            self._reset()
        return out

    def _count(self, piece: list[int]) -> int:
        state, total = self.ROOT, 0
        for byte in piece:
            found = self._step.get(state << 8 | byte)
            if found is None:
                if self.full():
                    # Go on with the same state in an empty machine.
                    kept = self._read(state)
                    self._reset()
                    state = self._add(*kept)
                found = self.compile(state, byte)
            state, change = found
            total += change
        return total


class Transitions:
    """(state, byte) to (state, change), as a hash table that numpy can search for many keys at once."""

    def __init__(self, bits: int = 16):
        self._bits, self._used = bits, 0
        self.key = np.full(1 << bits, -1, np.int64)
        self.to = np.zeros(1 << bits, np.int32)
        self.change = np.zeros(1 << bits, np.int16)

    def _home(self, key: int) -> int:
        return (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self._bits)

    def add(self, key: int, to: int, change: int) -> None:
        if 2 * self._used >= len(self.key):
            old = self.key, self.to, self.change
            self.__init__(self._bits + 1)
            for i in np.flatnonzero(old[0] >= 0).tolist():
                self._put(int(old[0][i]), int(old[1][i]), int(old[2][i]))
        self._put(key, to, change)

    def _put(self, key: int, to: int, change: int) -> None:
        at, last = self._home(key), len(self.key) - 1
        while self.key[at] >= 0:
            at = at + 1 & last
        self.key[at], self.to[at], self.change[at] = key, to, change
        self._used += 1

    def get(self, key: int) -> tuple[int, int] | None:
        at, last = self._home(key), len(self.key) - 1
        while (held := self.key[at]) != key:
            if held < 0:
                return None
            at = at + 1 & last
        return int(self.to[at]), int(self.change[at])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)
        held = self.key[at]
        open_at = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_at):
            at[open_at] = at[open_at] + 1 & len(self.key) - 1
            held[open_at] = self.key[at[open_at]]
            open_at = open_at[(held[open_at] != keys[open_at]) & (held[open_at] >= 0)]
        at[held < 0] = -1
        return at


class Counter:
    """Token counts of whole batches, by one vocabulary file."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        parsed = json.loads(spec)
        model, split = parsed["model"], parsed["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or parsed["normalizer"]:
            raise ValueError("only byte-level BPE files without a normalizer are known")
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"].encode() for t in parsed["added_tokens"]]
        odd = [t for t in parsed["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if odd or len(self.special) > 1:
            raise ValueError("only one plain special token is known")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if t.encode() not in self.special}
        self.merger = Merger(vocabulary, ranks)
        reader = Tokenizer.from_str(spec).pre_tokenizer
        self.classes = Classes(reader.pre_tokenize_str)

    def count(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer."""
        total = np.zeros(len(starts) - 1, np.int64)
        cuts = []
        if self.special:
            # A special string is one token and ends the text before it.
            held, size = data.tobytes(), len(self.special[0])
            for i in range(len(starts) - 1):
                at = held.find(self.special[0], starts[i], starts[i + 1])
                while at >= 0:
                    total[i] += 1
                    cuts.append((at, at + size))
                    at = held.find(self.special[0], at + size, starts[i + 1])
            del held
        edges = np.unique(np.concatenate([starts, np.array(cuts, np.int64).ravel()]))
        skipped = {a for a, _ in cuts}
        parts = [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if a < b and a not in skipped]
        group, size = [], 0
        for a, b in parts:
            if group and size + b - a > WINDOW_BYTES:
                self._add(data, group, starts, total)
                group, size = [], 0
            if b - a > WINDOW_BYTES:
                self._long(data, a, b, starts, total)
                continue
            group.append((a, b))
            size += b - a
        if group:
            self._add(data, group, starts, total)
        return total

    def _pieces(self, data: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
        """Byte offsets, in ``data``, at which pieces begin."""
        whole = np.concatenate([data[a:b] for a, b in parts])
        place = np.concatenate([np.arange(a, b) for a, b in parts])
        lead = np.flatnonzero((whole & 0xC0) != 0x80)
        points = code_points(whole, lead)
        ends = np.cumsum([b - a for a, b in parts])
        last = np.zeros(len(lead), bool)
        last[np.searchsorted(lead, ends, "left") - 1] = True
        return place[lead[splits(self.classes(points), points, last)]]

    def _add(self, data: np.ndarray, parts: list[tuple[int, int]], starts: np.ndarray, total: np.ndarray) -> None:
        begin = self._pieces(data, parts)
        ends = np.array([b for _, b in parts])
        size = np.minimum(np.append(begin[1:], ends[-1]), ends[np.searchsorted(ends, begin, "right")]) - begin
        np.add.at(total, np.searchsorted(starts, begin, "right") - 1, self.merger.counts(data, begin, size))

    def _long(self, data: np.ndarray, a: int, b: int, starts: np.ndarray, total: np.ndarray) -> None:
        """A text above the window: the last sure begin of a piece in a window is where the next window begins."""
        text, window = int(np.searchsorted(starts, a, "right")) - 1, WINDOW_BYTES
        while a < b:
            end = min(b, a + window)
            while end < b and data[end] & 0xC0 == 0x80:
                end += 1
            begin = self._pieces(data, [(a, end)])
            if end < b:
                # The last characters are read without what follows; begins before them are sure.
                sure = begin[begin < end - 16]
                if len(sure) < 2:
                    window *= 2
                    continue
                begin, end = sure[:-1], int(sure[-1])
            total[text] += self.merger.counts(data, begin, np.diff(np.append(begin, end))).sum()
            a, window = end, WINDOW_BYTES


def code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Decode UTF-8."""
    first = data[lead].astype(np.int64)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    one, two, three = ((padded[lead + k] & 0x3F).astype(np.int64) for k in (1, 2, 3))
    return np.select(
        [first < 0x80, first < 0xE0, first < 0xF0],
        [first, (first & 0x1F) << 6 | one, (first & 0x0F) << 12 | one << 6 | two],
        (first & 0x07) << 18 | one << 12 | two << 6 | three)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


_counters: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Replace ``text`` by ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens); other columns stay."""
    ship(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # one file of a fixed vocabulary
    rows = without(docs, set(RESULTS) - {text})
    schema = StructType([f for f in rows.schema if f.name != text] + [
        StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        counter = _counters.get(hash(spec.value))
        if counter is None:
            _counters.clear()
            counter = _counters[hash(spec.value)] = Counter(spec.value)
        for batch in batches:
            for piece in pieces(batch, text):
                data, starts = buffers(piece.column(text))
                made = {"n_bytes": pa.array(np.diff(starts), pa.int64()), "n_tokens": pa.array(counter.count(data, starts))}
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if f.name in made else piece.column(f.name).cast(f.type) for f in out], schema=out)

    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
