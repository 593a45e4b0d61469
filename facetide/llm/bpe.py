"""BPE encoding and decoding of whole texts as streams with a memory that does not grow with the text.

Encoding is a transducer with bounded lookahead. A text is read in windows. Pieces (words with the space before them,
numbers, runs of signs or of white space) are cut off as soon as nothing that follows can change them, which takes two
pieces of lookahead; within a piece the merges decide. A run longer than a window is never held as a whole: its tokens are
put out once they are stable, and only what follows the last stable token is kept.

When is a token stable? Let more text follow a prefix that has been read. Compared with the prefix alone, the first
boundary at which the two sequences of merges differ is the prefix's end; a difference moves left only through a rule
(x, y) of a higher rank whose right side y begins with the left side of the rule that made the difference before, and then
it moves by the length of that left side. So a difference reaches no further back than the longest such chain of rules,
and that sum of lengths, the lookahead, is computed once from the merge list. Boundaries further back than it are
final, and what follows a final boundary is encoded without what stands before it.

Decoding reads ids in blocks. The bytes of a token may end within a character, so a state machine (the incremental UTF-8
decoder, of three bytes at most) carries over what is incomplete and puts out text as soon as characters are whole.

Ids and texts equal those of the library that reads the file, without added special tokens: a special string inside a
text is one token, bytes that are no UTF-8 decode to U+FFFD, ids outside the vocabulary decode to nothing. The
characters' classes are asked of that library, once for each character that occurs.

Defined cases: a null or empty text has no ids; null ids decode to a null text, a null among ids to nothing. Rows are worked
on one by one, so repeated rows, ties and null keys need no care; an empty table stays empty. Columns with the name of a
result are replaced, all others are passed on. Many pieces of a batch are merged at once, in numpy; known pieces are held in a
table of bounded size.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from facetide.llm.common import without
from facetide.llm.tokens import _byte_letters
from facetide.llm.words import pieces
from facetide.session import ship

#: Fixed value: how byte-level BPE cuts a text into pieces.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_RUNS = [regex.compile(f"{c}*") for c in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s")]
_WHITE = 3
#: Texts of characters below this are cut by a pattern that names their classes, which is twice as fast.
_LATIN = 0x250
_BEYOND = re.compile(f"[^\\x00-{chr(_LATIN - 1)}]")
#: A character of each class, which stands for those that the two sets of tables class differently.
_STAND_IN = ("a", "1", "!", "\n")
#: Characters that are read at once of a long text, and of which a longer piece is an open run.
WINDOW = 1 << 16
LONG = 1 << 10
#: Bytes of an open run beyond the lookahead that are merged at once.
STEP = 1 << 12
#: Pieces that a task knows by heart, and their tokens in all.
KNOWN = 1 << 19
KNOWN_IDS = 1 << 22
#: Ids that are decoded at once.
BLOCK_IDS = 1 << 16
_NEVER = np.int64(1) << 40


class Vocabulary:
    """Tokens as bytes, and merges as triples of ids, of a byte-level BPE file."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model, split = parsed["model"], parsed["pre_tokenizer"]
        if (model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True)
                or parsed["normalizer"] or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError("only byte-level BPE files without a normalizer are known")
        odd = [t for t in parsed["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if odd:
            raise ValueError("only plain special tokens are known")
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        letters = _byte_letters()
        self.bytes: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()
                                        if t not in self.special}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = model["vocab"]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]


class Merges:
    """The merge list: applied to many byte strings at once, and how far back later bytes can act."""

    def __init__(self, vocabulary: Vocabulary):
        self.of_byte = np.full(256, -1, np.int64)
        for i, b in vocabulary.bytes.items():
            if len(b) == 1:
                self.of_byte[b[0]] = i
        if (self.of_byte < 0).any():
            raise ValueError("a byte has no token")
        self.size = np.zeros(max(vocabulary.bytes) + 1, np.int64)
        for i, b in vocabulary.bytes.items():
            self.size[i] = len(b)
        self._check(vocabulary.merges)
        left, right, made = (np.array(x, np.int64) for x in zip(*vocabulary.merges))
        self.made = made
        key = left << 20 | right
        order = np.argsort(key, kind="stable")
        self._key, self._rank = key[order], order
        # A byte for each of many key hashes says whether a search is worth it: most pairs have no rule.
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[self._slot(key)] = True
        self.lookahead = self._lookahead(vocabulary.merges)

    def _check(self, merges: list[tuple[int, int, int]]) -> None:
        known = set(self.of_byte.tolist())
        for a, b, c in merges:
            if a not in known or b not in known:
                raise ValueError("a merge uses a token that a later one makes")
            known.add(c)

    def _lookahead(self, merges: list[tuple[int, int, int]]) -> int:
        """The greatest distance in bytes at which what follows a prefix can change a boundary within it."""
        lefts: dict[int, list[int]] = {}
        for a, _, c in merges:
            lefts.setdefault(c, []).append(a)
        spines: dict[int, frozenset[int]] = {}

        def spine(token: int) -> frozenset[int]:
            """The token and all that it begins with while it is made."""
            if token not in spines:
                spines[token] = frozenset({token}).union(*(spine(a) for a in lefts.get(token, ())))
            return spines[token]

        # The distance to the boundary that a difference has reached, by the left side of the last rule of its chain.
        reach: dict[int, int] = {}
        for a, b, _ in merges:
            before = max((reach[t] for t in spine(b) if t in reach), default=0)
            reach[a] = max(reach.get(a, 0), before + int(self.size[a]))
        return max(reach.values(), default=0)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        out = np.full(len(key), _NEVER)
        at = np.flatnonzero(self._maybe[self._slot(key)])
        if len(at):
            place = np.minimum(np.searchsorted(self._key, key[at]), len(self._key) - 1)
            out[at] = np.where(self._key[place] == key[at], self._rank[place], _NEVER)
        return out

    def encode(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many byte strings, which stand one after the other in ``data``, and how many ids each has."""
        tokens, own = self.of_byte[data], np.repeat(np.arange(len(size)), size)
        rank = np.full(len(tokens), _NEVER)
        if len(tokens):
            inner = own[1:] == own[:-1]
            rank[:-1][inner] = self._ranks(tokens[:-1][inner], tokens[1:][inner])
        done = []
        while len(tokens):
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            many = np.diff(np.append(first, len(own)))
            least = np.minimum.reduceat(rank, first)
            over = np.repeat(least == _NEVER, many)
            if over.any():
                done.append((own[over], tokens[over]))
                tokens, own, rank = tokens[~over], own[~over], rank[~over]
                many, least = many[least != _NEVER], least[least != _NEVER]
                if not len(tokens):
                    break
            # Each string applies its best rule, everywhere from the left; of a run of equal tokens every other pair.
            at = np.flatnonzero(rank == np.repeat(least, many))
            start = np.append(True, at[1:] != at[:-1] + 1)
            count = np.arange(len(at))
            at = at[(count - np.maximum.accumulate(np.where(start, count, 0))) % 2 == 0]
            tokens[at] = self.made[rank[at]]
            live = np.ones(len(tokens), bool)
            live[at + 1] = False
            at = at - np.arange(len(at))
            tokens, own, rank = tokens[live], own[live], rank[live]
            # Ranks change at each new token and before it.
            changed = np.zeros(len(tokens), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            new = np.flatnonzero(changed)
            after = np.minimum(new + 1, len(tokens) - 1)
            inner = (after > new) & (own[new] == own[after])
            rank[new] = _NEVER
            new, after = new[inner], after[inner]
            rank[new] = self._ranks(tokens[new], tokens[after])
        own = np.concatenate([np.zeros(0, np.int64), *(d[0] for d in done)])
        tokens = np.concatenate([np.zeros(0, np.int64), *(d[1] for d in done)])
        return tokens[np.argsort(own, kind="stable")], np.bincount(own, minlength=len(size))


class Numbers(dict):
    """Numbers of pieces, from ``first`` on; what is new gets the next one."""

    def __init__(self):
        self.new: list[str] = []
        self.first = 0

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.first + len(self.new)
        self.new.append(piece)
        return n


class OpenRun:
    """The ids of one piece that arrives in parts. It holds no more than the lookahead, one step and one token."""

    def __init__(self, merges: Merges):
        self._merges, self._held, self.ids = merges, bytearray(), []

    def feed(self, data: bytes) -> None:
        for at in range(0, len(data), STEP):
            self._held += data[at:at + STEP]
            if len(self._held) >= STEP + self._merges.lookahead:
                self._put(len(self._held) - self._merges.lookahead)

    def _put(self, upto: int) -> None:
        """Put out the tokens that end at ``upto`` or before."""
        ids, _ = self._merges.encode(np.frombuffer(bytes(self._held), np.uint8), np.array([len(self._held)]))
        ends = np.cumsum(self._merges.size[ids])
        stable = int(np.searchsorted(ends, upto, "right"))
        if stable:
            self.ids.append(ids[:stable])
            del self._held[:int(ends[stable - 1])]

    def finish(self) -> np.ndarray:
        if self._held:
            self._put(len(self._held))
        return np.concatenate([np.zeros(0, np.int64), *self.ids])


class Encoder:
    """Texts to ids. A text is a list of pieces, of special tokens and of runs; each is a number in a table of their ids."""

    def __init__(self, spec: str, special: bool = True):
        from tokenizers import Tokenizer

        vocabulary = Vocabulary(spec)
        self.merges = Merges(vocabulary)
        self._special = dict(sorted(vocabulary.special.items(), key=lambda s: -len(s[0]))) if special else {}
        self._specials = regex.compile("|".join(map(regex.escape, self._special))) if self._special else None
        self._split = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        classes: list[list[str]] = [[], [], [], []]
        for c in map(chr, range(_LATIN)):
            classes[self._kind(self._split, c)].append(c)
        letter, number, _, white = ("".join(map(re.escape, c)) for c in classes)
        self._latin = re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{white}{letter}{number}]+|"
                                 f"[{white}]+(?![^{white}])|[{white}]+")
        self._asked, self._odd = set(map(chr, range(128))), {}
        self._forget()

    def _forget(self) -> None:
        self._number = Numbers()
        self._ids, self._end = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _add(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Put entries into the table, after those that are there."""
        self._ids = np.concatenate([self._ids, *ids])
        self._end = np.concatenate([self._end, self._end[-1] + np.cumsum(np.concatenate(sizes))])

    def _kind(self, cut, c: str) -> int:
        return next((k for k, known in enumerate("a1!") if len(cut(known + c)) == 1), _WHITE)

    def _shadow(self, text: str) -> str:
        """The text with characters that this module's tables would class wrongly replaced by others of their class."""
        if text.isascii():
            return text
        held = set(text)
        for c in held - self._asked:
            kind = self._kind(self._split, c)
            if kind != self._kind(PIECE.findall, c):
                self._odd[ord(c)] = _STAND_IN[kind]
            self._asked.add(c)
        return text.translate(self._odd) if self._odd and any(ord(c) in self._odd for c in held) else text

    def _cut(self, text: str, out: list) -> None:
        """Append the text's pieces, and the ids of its open runs."""
        n = len(text)
        if n <= WINDOW and not _BEYOND.search(text):
            out += self._latin.findall(text)
            return
        shadow = self._shadow(text)
        at = begin = 0
        while begin < n:
            at = min(n, max(at, begin) + WINDOW)
            spans = [m.span() for m in PIECE.finditer(shadow, begin, at)]
            if at == n:
                sure, begin = len(spans), n
            elif spans[-1][1] - spans[-1][0] > LONG:
                sure = len(spans) - 1
                begin = spans[-1][0]
            else:
                # A contraction may still grow out of the last two pieces.
                sure = max(0, len(spans) - 2)
                begin = spans[sure][0]
            out += [text[a:b] for a, b in spans[:sure]]
            if at < n and spans[-1][1] - spans[-1][0] > LONG:
                begin = self._run(text, shadow, begin, at, out)

    def _run(self, text: str, shadow: str, begin: int, at: int, out: list) -> int:
        """Read a run that began at ``begin`` and goes on at ``at``; returns where it ends."""
        kind = next(k for k, r in enumerate(_RUNS) if r.match(shadow, at - 1, at).end() == at)
        run, n, end = OpenRun(self.merges), len(text), at
        while True:
            at, end = end, _RUNS[kind].match(shadow, end, min(n, end + WINDOW)).end()
            closed = end == n or end < at + WINDOW
            # White space leaves its last character to what follows.
            upto = end - 1 if kind == _WHITE and end < n else end
            run.feed(text[begin:upto].encode())
            begin = upto
            if closed:
                out.append(run.finish())
                return begin

    def _plain(self, texts: list[str | None]) -> bool:
        if None in texts or not texts or max(map(len, texts)) > WINDOW:
            return False
        joined = "".join(texts)
        return not _BEYOND.search(joined) and not (self._specials and self._specials.search(joined))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin, with the end at last."""
        if len(self._number) > KNOWN or len(self._ids) > KNOWN_IDS:
            self._forget()
        parts: list = []
        own: list[int] = []  # which parts are ids already
        last = np.zeros(len(texts) + 1, np.int64)
        if self._plain(texts):
            # Nothing but short texts of Latin letters, as most batches are.
            lists = list(map(self._latin.findall, texts))
            np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=last[1:])
            parts = list(chain.from_iterable(lists))
            texts = []
        for i, text in enumerate(texts):
            if text:
                begin = 0
                for found in self._specials.finditer(text) if self._specials else ():
                    self._cut(text[begin:found.start()], parts)
                    parts.append(np.array([self._special[found.group()]]))
                    begin = found.end()
                if len(text) > WINDOW or begin:
                    before = last[i]
                    self._cut(text[begin:], parts)
                    own += [k for k in range(before, len(parts)) if type(parts[k]) is not str]
                else:
                    self._cut(text, parts)
            last[i + 1] = len(parts)
        given = [parts[k] for k in own]
        for k in own:
            parts[k] = ""  # no piece is empty
        known = self._number
        known.first, known.new = len(self._end) - 1, []
        number = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        new = [p.encode() for p in known.new]
        known.pop("", None)
        ids, sizes = self.merges.encode(np.frombuffer(b"".join(new), np.uint8), np.array(list(map(len, new)), np.int64))
        number[own] = len(self._end) - 1 + len(new) + np.arange(len(own))
        self._add([ids, *given], [sizes, np.array(list(map(len, given)), np.int64)])
        begin, size = self._end[number], self._end[number + 1] - self._end[number]
        ends = np.cumsum(size)
        place = np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return self._ids[place], np.append(0, ends)[last]


class Decoder:
    """Ids to texts."""

    def __init__(self, spec: str):
        vocabulary = Vocabulary(spec)
        n = max(vocabulary.bytes) + 1
        held = [vocabulary.bytes.get(i, b"") for i in range(n)] + [b""]  # the last stands for unknown ids
        self._bytes = np.frombuffer(b"".join(held), np.uint8)
        self._size = np.array([len(b) for b in held], np.int64)
        self._begin = np.cumsum(self._size) - self._size

    def raw(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes."""
        ids = np.where((ids < 0) | (ids >= len(self._size)), len(self._size) - 1, ids)
        size = self._size[ids]
        ends = np.cumsum(size)
        place = np.repeat(self._begin[ids] - ends + size, size)
        place += np.arange(len(place))
        return self._bytes[place].tobytes()

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The text of each list of ids; a block at a time, which may end within a character or hold many texts."""
        out, machine = [], codecs.getincrementaldecoder("utf-8")("replace")
        at = 0
        while at < len(starts) - 1:
            upto = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_IDS, "right")) - 1)
            if starts[upto] - starts[at] <= BLOCK_IDS:
                here = ids[starts[at]:starts[upto]]
                data, known = self.raw(here), np.where((here < 0) | (here >= len(self._size)), len(self._size) - 1, here)
                ends = np.append(0, np.cumsum(self._size[known]))[starts[at:upto + 1] - starts[at]].tolist()
                for a, b in zip(ends, ends[1:]):
                    out.append(machine.decode(data[a:b], final=True))
            else:
                text = [machine.decode(self.raw(ids[k:min(k + BLOCK_IDS, starts[upto])]))
                        for k in range(int(starts[at]), int(starts[upto]), BLOCK_IDS)]
                out.append("".join(text) + machine.decode(b"", final=True))
            at = upto
        return out


_made: dict[tuple, object] = {}


def _of(kind, spec: str, *more):
    """One for each worker process and file."""
    key = (kind, hash(spec), *more)
    if key not in _made:
        _made.clear()
        _made[key] = kind(spec, *more)
    return _made[key]


def _file(docs: DataFrame, path: str):
    """One file of a fixed vocabulary."""
    ship(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", special: bool = True) -> DataFrame:
    """Replace ``text`` by its token ``ids``; other columns stay. Without ``special``, special strings are plain text."""
    spec = _file(docs, vocabulary_path)
    rows = without(docs, {ids} - {text})
    schema = StructType([f for f in rows.schema if f.name != text] + [StructField(ids, ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, encoder = to_arrow_schema(schema), _of(Encoder, spec.value, special)
        for batch in batches:
            for piece in pieces(batch, text):
                found, starts = encoder.encode(piece.column(text).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [lists.cast(f.type) if f.name == ids else piece.column(f.name).cast(f.type) for f in out], schema=out)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replace ``ids`` by the ``text`` that they stand for; other columns stay."""
    spec = _file(rows, vocabulary_path)
    rows = without(rows, {text} - {ids})
    schema = StructType([f for f in rows.schema if f.name != ids] + [StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, decoder = to_arrow_schema(schema), _of(Decoder, spec.value)
        for batch in batches:
            lists = batch.column(ids)
            starts = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            held = lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(starts, starts[at] + 8 * BLOCK_IDS, "right")) - 1)
                texts = decoder.decode(held[starts[at]:starts[upto]], starts[at:upto + 1] - starts[at])
                part = batch.slice(at, upto - at)
                valid = part.column(ids).is_valid().to_pylist()
                made = pa.array([t if v else None for t, v in zip(texts, valid)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [made.cast(f.type) if f.name == text else part.column(f.name).cast(f.type) for f in out], schema=out)
                at = upto

    return rows.mapInArrow(run, schema)
