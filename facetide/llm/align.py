"""Alignment of two tokenizers over the same bytes: groups, links, and in how many documents each pair of ids is linked.

A is a byte-level BPE file, B a sentencepiece model. Both cut the same bytes, a space and the text. By interval coalescing
all tokens of both are sorted by their start, the running maximum of their ends is taken, and a group begins where a start
reaches that maximum; within it every A token is linked with every B token that it overlaps.

Texts repeat words, so each task holds a table of stretches: a word with the space before it, or white space that neither
tokenizer joins with what stands before. Both tokenizers end a token where a stretch ends, whatever is around it, so no group
or link crosses. New stretches of a batch are encoded and coalesced together, all at once; a text is the sequence of its
stretches. Texts with rare white space, or a model whose pieces could cross such a place, are one stretch each.

Two maps over the documents. The first adds up in how many documents a pair of ids is linked, per task before the shuffle;
the second looks the counts up. The table of counts grows with the vocabularies and not with the documents, but is not
taken to be small: it goes out in blocks of at most ``BLOCK_PAIRS`` pairs, cut by the A id so that the highest count of an id is
known, with one map for each block. No text is shuffled.

Defined cases: a text that is null or empty, or that one of the tokenizers does not give back byte for byte, has no tokens: counts
of 0 and empty ``groups``. Every row is a document of its own, repeated ones and those without a key too. Columns with
the name of a result are replaced, others passed on; an empty table stays empty. Long texts are held one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from facetide.llm.bpe import Encoder, Numbers, Vocabulary
from facetide.llm.common import stored, without
from facetide.llm.words import pieces
from facetide.session import ship

RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
#: Pairs of ids that go out at once.
BLOCK_PAIRS = 1 << 20
#: Stretches, links and letters that a task knows by heart, and pairs that it adds up before it puts them out.
KNOWN = 3 << 17
KNOWN_LINKS = 1 << 22
KNOWN_LETTERS = 1 << 26
HELD_PAIRS = 1 << 21
#: White space after and before which both tokenizers cut as described; texts with other white space are whole stretches.
_STRETCH = re.compile(r" ?[^ \t\n]+|[ \t\n][ \t\n]+[^ \t\n]*|[ \t\n]")
_RARE = re.compile(r"[\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")
_PAIR = 21  # bits of a B id within a pair


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of both sides: the order of all by start, the group of each in that order, and the links (A, B) as places.

    Each side's intervals follow one another; texts follow one another too, so no group holds two of them.
    """
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(len(start)), start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reached[:-1]
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    many = high - low
    ends = np.cumsum(many)
    a = np.repeat(np.arange(len(a_start)), many)
    b = np.repeat(low - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)
    return order, np.cumsum(breaks) - 1, a, b


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


class Pieces:
    """Encoder of a sentencepiece model for stretches."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        # The guard is cut off by both tokens that it gives; where that does not hold, texts are encoded whole.
        self._guard = self._model.encode("\n")
        self.cuts = (
            not any(re.search(r"[^▁]▁|[\t\n]", p) and len(p) > 1 for p in names)
            and self._model.normalize("  a  ﬁ  b ") == "▁▁▁a▁▁ﬁ▁▁b▁" and len(self._guard) == 2)

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches one after the other, and how many each has."""
        # The model puts a space before what it reads; a stretch that does not begin with one is read behind a guard.
        plain = [s[0] == " " and (len(s) > 1 or not self.cuts) for s in stretches]
        found = self._model.encode([s[1:] if p else "\n" + s for s, p in zip(stretches, plain)], num_threads=1)
        found = [f if p else f[len(self._guard):] for f, p in zip(found, plain)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes


class Stretches:
    """The table of stretches: counts, links as pairs of ids, and the groups' text, by number."""

    def __init__(self, a_spec: str, b_model: bytes):
        self._a, self._b = Encoder(a_spec, special=False), Pieces(b_model)
        vocabulary = Vocabulary(a_spec)
        self._a_bytes = [vocabulary.bytes.get(i, b"") for i in range(len(self._a.merges.size))]
        if max(len(self._a_bytes), len(self._b.bytes)) > 1 << _PAIR:
            raise ValueError("the vocabulary is too large")
        #: Each id with what may stand behind it: the same side, the other side, another group, another stretch.
        self._marked = [f"{i}{mark}" for i in range(max(len(self._a_bytes), len(self._b.bytes))) for mark in ",|;\n"]
        self.forget()

    def forget(self) -> None:
        self._number = Numbers()
        self._letters = 0
        self.groups: list[str] = []
        #: A, B, groups, links, and 1 if a tokenizer does not give the bytes back.
        self.counts = np.zeros((0, 5), np.int64)
        self.pairs, self.end = np.zeros(0, np.int64), np.zeros(1, np.int64)
        #: Pairs that occur, and for each link the place of its pair among them.
        self._place = Numbers()
        self.places = np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self._number) > KNOWN or len(self.pairs) > KNOWN_LINKS or self._letters > KNOWN_LETTERS

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The stretches of all texts by number, one text after the other, and where each text begins, with the end at last."""
        parts: list[str] = []
        last = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                if self._b.cuts and not _RARE.search(text):
                    parts += _STRETCH.findall(" " + text)
                else:
                    parts.append(" " + text)
            last[i + 1] = len(parts)
        known = self._number
        known.first, known.new = len(self.groups), []
        number = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        if known.new:
            self._add(known.new)
        return number, last

    def kinds(self) -> np.ndarray:
        """The pairs that occur, in the order of ``places``."""
        return np.fromiter(self._place, np.int64, len(self._place))

    def _add(self, new: list[str]) -> None:
        raw = [s.encode() for s in new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self._letters += int(size.sum())
        a, starts = self._a.encode(new)
        a_many = np.diff(starts)
        b, b_many = self._b.encode(new)
        bad = self._differ(raw, size, a, a_many, self._a.merges.size, self._a_bytes)
        bad |= self._differ(raw, size, b, b_many, self._b.size, self._b.bytes)
        a_of, b_of = (np.repeat(np.arange(len(new)), m) for m in (a_many, b_many))
        if bad.any():
            a, a_of, b, b_of = a[~bad[a_of]], a_of[~bad[a_of]], b[~bad[b_of]], b_of[~bad[b_of]]
            size = np.where(bad, 0, size)
        a_end, b_end = np.cumsum(self._a.merges.size[a]), np.cumsum(self._b.size[b])
        a_start, b_start = a_end - self._a.merges.size[a], b_end - self._b.size[b]
        order, group, x, y = coalesce(a_start, a_end, b_start, b_end)

        # Groups in words: tokens by group, A before B, with what stands between them.
        side, of, token = (order >= len(a)).astype(np.int64), np.concatenate([a_of, b_of])[order], np.concatenate([a, b])[order]
        by = np.lexsort((np.arange(len(order)), side, group))
        side, of, group, token = side[by], of[by], group[by], token[by]
        between = np.select([of[1:] != of[:-1], group[1:] != group[:-1], side[1:] != side[:-1]], [3, 2, 1], 0)
        held = "".join(map(self._marked.__getitem__, (token << 2 | np.append(between, 3)[:len(token)]).tolist()))
        names = iter(held.split("\n"))
        self.groups += ["" if w else next(names) for w in bad.tolist()]

        firsts = np.append(True, group[1:] != group[:-1])[:len(group)]
        n = len(new)
        links = np.bincount(a_of[x], minlength=n)
        self.counts = np.concatenate([self.counts, np.stack([
            np.bincount(a_of, minlength=n), np.bincount(b_of, minlength=n), np.bincount(of[firsts], minlength=n), links, bad], axis=1)])
        pairs = a[x] << _PAIR | b[y]
        kinds = distinct(pairs)
        self._place.first, self._place.new = len(self._place), []
        places = np.fromiter(map(self._place.__getitem__, kinds.tolist()), np.int64, len(kinds))
        self.places = np.concatenate([self.places, places[np.searchsorted(kinds, pairs)]])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.end = np.concatenate([self.end, self.end[-1] + np.cumsum(links)])


    @staticmethod
    def _differ(raw: list[bytes], size: np.ndarray, ids: np.ndarray, many: np.ndarray, sizes: np.ndarray, of: list[bytes]) -> np.ndarray:
        """Which strings their tokens do not give back."""
        held = ids.tolist()
        ends = np.append(0, np.cumsum(sizes[ids]))
        last = np.append(0, np.cumsum(many))
        bad = ends[last[1:]] - ends[last[:-1]] != size
        if bad.any() or b"".join(map(of.__getitem__, held)) != b"".join(raw):
            last = last.tolist()
            bad = np.array([b"".join(map(of.__getitem__, held[a:b])) != r for a, b, r in zip(last, last[1:], raw)])
        return bad


class Read:
    """A batch of texts: whose texts have tokens, and the stretches of those."""

    def __init__(self, table: Stretches, texts: list[str | None]):
        number, last = table.read(texts)
        self.n = len(texts)
        self.many = np.diff(last)
        of = np.repeat(np.arange(self.n), self.many)
        bad = np.bincount(of, weights=table.counts[number, 4], minlength=self.n) > 0
        self.number, self.of = number[~bad[of]], of[~bad[of]]
        self.last = np.append(0, np.cumsum(np.where(bad, 0, self.many)))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of a value for each stretch, the sum in each text."""
        total = np.append(0, np.cumsum(values[self.number]))
        return total[self.last[1:]] - total[self.last[:-1]]


_tables: dict[int, Stretches] = {}


def _table(a_spec: str, b_model: bytes) -> Stretches:
    key = hash((a_spec, b_model))
    if key not in _tables:
        _tables.clear()
        _tables[key] = Stretches(a_spec, b_model)
    return _tables[key]


def _linked(table: Stretches, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(pair, how many of the texts hold it linked)."""
    read = Read(table, texts)
    # A stretch counts once for each text, then a pair once for each text.
    seen = distinct(read.of << 40 | read.number)
    of, number = seen >> 40, seen & (1 << 40) - 1
    begin, many = table.end[number], table.end[number + 1] - table.end[number]
    ends = np.cumsum(many)
    places = table.places[np.repeat(begin - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]
    once = distinct(np.repeat(of, many) << 40 | places) & (1 << 40) - 1
    n = np.bincount(once)
    held = np.flatnonzero(n)
    return table.kinds()[held], n[held]


def _pairs(docs: DataFrame, files) -> DataFrame:
    """(pair, a, n, best): documents that hold a pair linked, and whether that is the highest count of its A id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = _table(*files.value), []

        def added() -> list[tuple[np.ndarray, np.ndarray]]:
            pairs, n = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            if not len(pairs):
                return []
            order = np.argsort(pairs, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(pairs[order]) != 0))
            return [(pairs[order][first], np.add.reduceat(n[order], first))]

        for batch in batches:
            for piece in pieces(batch, "text"):
                if table.full():
                    table.forget()
                held.append(_linked(table, piece.column("text").to_pylist()))
                if sum(len(h[0]) for h in held) > HELD_PAIRS:
                    held = added()
                    if held and len(held[0][0]) > HELD_PAIRS // 2:
                        yield _counted(*held.pop())
        for h in added() if held else ():
            yield _counted(*h)

    rows = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(rows.withColumn("a", F.shiftright("pair", _PAIR)), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stored(counts.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _counted(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"pair": pa.array(pairs), "n": pa.array(n)})


def _blocks(pairs: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The counts in sorted arrays, a block of A ids at a time; one block if there are none."""
    n = max(1, -(-pairs.count() // BLOCK_PAIRS))
    for b in range(n):
        part = pairs.where(F.pmod(F.xxhash64("a"), F.lit(n)) == b) if n > 1 else pairs
        held = part.select("pair", "n", "best").toArrow()  # of bounded size
        pair, count, best = (held.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        yield pair[order], count[order], best[order].astype(np.int64)


def _found(docs: DataFrame, text: str, files, block, first: bool) -> DataFrame:
    """Add what this block of counts gives; the first one adds all else too."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    schema = StructType([f for f in docs.schema if f.name not in RESULTS] + [
        StructField(r, StringType() if r == "groups" else LongType()) for r in RESULTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, table = to_arrow_schema(schema), _table(*files.value)
        pair, count, best = sent.value
        found = bests = np.zeros(0, np.int64)
        for batch in batches:
            for piece in pieces(batch, text):
                if table.full():
                    table.forget()
                    found = bests = found[:0]
                read = Read(table, piece.column(text).to_pylist())
                # What each new stretch gives.
                begin = table.end[len(found)]
                new = table.pairs[begin:]
                place = np.minimum(np.searchsorted(pair, new), max(0, len(pair) - 1))
                same = pair[place] == new if len(pair) else np.zeros(len(new), bool)
                sums = [np.append(0, np.cumsum(np.where(same, v[place], 0))) if len(pair) else np.zeros(len(new) + 1, np.int64)
                        for v in (count, best)]
                ends = table.end[len(found):] - begin
                found = np.append(found, sums[0][ends[1:]] - sums[0][ends[:-1]])
                bests = np.append(bests, sums[1][ends[1:]] - sums[1][ends[:-1]])
                made = {"count_sum": read.sums(found), "n_best": read.sums(bests)}
                if first:
                    made |= {name: read.sums(table.counts[:, k]) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
                    words = [table.groups[k] for k in read.number.tolist()]
                    last = read.last.tolist()
                    made["groups"] = [";".join(words[a:b]) for a, b in zip(last, last[1:])]
                else:
                    made = {k: v + piece.column(k).to_numpy(zero_copy_only=False) for k, v in made.items()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) if f.name in made else piece.column(f.name).cast(f.type) for f in out],
                    schema=out)

    return docs.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Replace ``text`` by ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest of their A id),
    ``count_sum`` (of all links) and ``groups`` (``a1,a2|b1;a3|b2``); and the pairs: (``a``, ``b``, ``n`` documents, ``best``)."""
    if text in RESULTS:
        raise ValueError(f"{text} is the name of a result")
    ship(docs.sparkSession)
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # files of fixed vocabularies
    rows = without(docs, RESULTS)
    pairs = _pairs(docs.select(F.col(text).alias("text")), files)
    for number, block in enumerate(_blocks(pairs)):
        rows = _found(rows, text, files, block, number == 0)
    return rows.drop(text), pairs.select("a", F.col("pair").bitwiseAND((1 << _PAIR) - 1).alias("b"), "n", "best")
