"""Benchmark decontamination: words of documents that lie inside a window of a benchmark item.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter one). Containment is a set join with overlap
of the whole window, so by the prefix principle one shingle of a window is enough to find it: the one that is rarest in
the documents. Its shingles are counted over all documents first; then documents look up their shingles among those
rarest ones, and a find gives a candidate place for the window. Candidates must lie wholly inside the text (length and
position bound), and are verified word by word.

The items are the query set: they go to the tasks in blocks of ``BLOCK_BYTES`` at most (a single item may be longer), one
map over the documents for each block, so no text is shuffled and nothing sent out grows with the documents.

Defined cases: a null or empty text has no words and no hits; an item without words has no window; items with the same id
count as one item, and a null id is left out of ``items`` although its windows hit. Documents are judged row by row, so
repeated rows get the same result. Columns of the input with the name of a result are replaced. Long texts are held one
at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from facetide.llm.common import without
from facetide.llm.words import NOT_ALNUM, Words, joined, pieces
from facetide.session import ship

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 16 << 20
RESULTS = ("n_words", "spans", "items", "n_hit", "n_items", "items_sha256", "contaminated")

_SPANS = ArrayType(StructType([StructField("start", IntegerType(), False), StructField("end", IntegerType(), False)]))


class Windows:
    """The distinct windows of a block of items, their shingles, and the items that hold each."""

    def __init__(self, ids: list[str | None], texts: list[str | None]):
        words = Words(pa.array(texts, pa.large_string()), NOT_ALNUM)
        lengths = words.end - words.start
        held: dict[bytes, int] = {}
        self.hashes, self.lengths, self.items = [], [], []
        for row, item in enumerate(ids):
            first, last = int(words.first[row]), int(words.first[row + 1])
            size = min(WINDOW, last - first)
            for at in range(first, last - size + 1) if size else ():
                hashes, sizes = words.hash[at:at + size], lengths[at:at + size]
                key = hashes.tobytes() + sizes.tobytes()
                n = held.setdefault(key, len(held))
                if n == len(self.items):
                    self.hashes.append(hashes)
                    self.lengths.append(sizes)
                    self.items.append(set())
                if item is not None:
                    self.items[n].add(item)
        self.shingles = [joined(h, min(SHINGLE, len(h))) for h in self.hashes]
        self.sizes = sorted({min(SHINGLE, len(h)) for h in self.hashes})

    def distinct(self, size: int) -> np.ndarray:
        found = [s for s, h in zip(self.shingles, self.hashes) if min(SHINGLE, len(h)) == size]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def index(self, counts: dict[int, np.ndarray]) -> Index:
        """Choose each window's rarest shingle; ties go to the lower hash."""
        keys = {s: self.distinct(s) for s in self.sizes}
        entries: dict[int, list[tuple[int, int, int]]] = {s: [] for s in self.sizes}
        for n, (shingles, hashes) in enumerate(zip(self.shingles, self.hashes)):
            size = min(SHINGLE, len(hashes))
            seen = counts[size][np.searchsorted(keys[size], shingles)]
            offset = int(np.lexsort((shingles, seen))[0])
            entries[size].append((int(shingles[offset]), n, offset))
        return Index(self, entries)


class Index:
    """Rarest shingle to windows, as sorted arrays."""

    def __init__(self, windows: Windows, entries: dict[int, list[tuple[int, int, int]]]):
        self.items = [sorted(i) for i in windows.items]
        self.size = np.array([len(h) for h in windows.hashes], np.int64)
        self.hashes = np.zeros((len(self.size), WINDOW), np.uint64)
        self.lengths = np.zeros((len(self.size), WINDOW), np.int64)
        for n, (h, s) in enumerate(zip(windows.hashes, windows.lengths)):
            self.hashes[n, :len(h)], self.lengths[n, :len(h)] = h, s
        self.tables = {}
        for size, rows in entries.items():
            rows.sort()
            key = np.array([r[0] for r in rows], np.uint64)
            self.tables[size] = (key, Members(key), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        text_of = np.repeat(np.arange(len(words)), words.counts())
        sizes = words.end - words.start
        for size, (key, members, window, offset) in self.tables.items():
            hashes = joined(words.hash, size)
            at = members.where(hashes)
            low, high = np.searchsorted(key, hashes[at], "left"), np.searchsorted(key, hashes[at], "right")
            many = high - low
            entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place, w = np.repeat(at, many), window[entry]
            start, end = place - offset[entry], place - offset[entry] + self.size[w]
            # Wholly inside the text that holds the shingle.
            text = text_of[place]
            ok = (start >= words.first[text]) & (end <= words.first[text + 1])
            start, w = start[ok], w[ok]
            for k in range(WINDOW):
                inside = k < self.size[w]
                word = np.minimum(start + k, max(0, len(words.hash) - 1))
                same = ~inside | ((words.hash[word] == self.hashes[w, k]) & (sizes[word] == self.lengths[w, k]))
                start, w = start[same], w[same]
            out.append((start, w))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


class Members:
    """Which of many hashes are among a sorted few."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[keys >> np.uint64(64 - self.BITS)] = True

    def where(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - self.BITS)])
        if len(at) and len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            return at[self.keys[place] == hashes[at]]
        return at[:0]


def _counts(docs: DataFrame, text: str, keys: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each shingle of the items occurs in the documents; pre-added in each task."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = {s: Members(k) for s, k in sent.value.items()}
        total = {s: np.zeros(len(k), np.int64) for s, k in sent.value.items()}
        for batch in batches:
            for piece in pieces(batch, text):
                words = Words(piece.column(text), NOT_ALNUM)
                text_of = np.repeat(np.arange(len(words)), words.counts())
                for size, found in members.items():
                    hashes = joined(words.hash, size)
                    at = found.where(hashes)
                    at = at[text_of[at] == text_of[at + size - 1]]
                    total[size] += np.bincount(np.searchsorted(found.keys, hashes[at]), minlength=len(found.keys))
        for size, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(np.full(len(at), size), pa.int32()), "at": pa.array(at, pa.int64()),
                "n": pa.array(n[at], pa.int64())})

    rows = docs.select(text).mapInArrow(count, "size int, at long, n long").groupBy("size", "at").agg(F.sum("n").alias("n"))
    out = {s: np.zeros(len(k), np.int64) for s, k in keys.items()}
    for r in rows.collect():  # no more than the block of items has shingles
        out[r["size"]][r["at"]] = r["n"]
    sent.unpersist()
    return out


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[list, list]]:
    items = benchmark.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = -(-size // BLOCK_BYTES)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) if n > 1 else items
        rows = part.collect()
        yield [r["id"] for r in rows], [r["text"] for r in rows]


def _marked(docs: DataFrame, text: str, index: Index | None) -> DataFrame:
    """Add word counts, merged spans of hit words and item ids; spans and items of an earlier block are taken along."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = StructType([f for f in docs.schema if f.name not in ("n_words", "spans", "items")] + [
        StructField("n_words", LongType()), StructField("spans", _SPANS), StructField("items", ArrayType(StringType()))])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema, found = to_arrow_schema(schema), sent.value
        for batch in batches:
            for piece in pieces(batch, text):
                words = Words(piece.column(text), NOT_ALNUM)
                spans, items = [[] for _ in range(len(words))], [set() for _ in range(len(words))]
                if "spans" in piece.schema.names:
                    spans = [[(s["start"], s["end"]) for s in x] for x in piece.column("spans").to_pylist()]
                    items = [set(x) for x in piece.column("items").to_pylist()]
                if found is not None and len(found.size):
                    start, window = found.find(words)
                    texts = np.searchsorted(words.first, start, "right") - 1
                    for t, s, w in zip(texts.tolist(), (start - words.first[texts]).tolist(), window.tolist()):
                        spans[t].append((s, s + int(found.size[w])))
                        items[t].update(found.items[w])
                made = {
                    "n_words": pa.array(words.counts(), pa.int64()),
                    "spans": pa.array([[{"start": s, "end": e} for s, e in _merged(x)] for x in spans],
                                      out_schema.field("spans").type),
                    "items": pa.array([sorted(x) for x in items], out_schema.field("items").type),
                }
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if f.name in made else piece.column(f.name).cast(f.type) for f in out_schema],
                    schema=out_schema)

    return docs.mapInArrow(mark, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``n_words``, the ``spans`` of hit words (word numbers), ``n_hit``, the ``items`` that hit, ``n_items``,
    ``items_sha256`` and ``contaminated``. Without ``keep_text`` the text does not come back from the Python workers."""
    ship(docs.sparkSession)
    rows = without(docs, set(RESULTS) - {text})
    marked = None
    for ids, texts in _blocks(benchmark, item_key, item_text):
        windows = Windows(ids, texts)
        index = windows.index(_counts(docs, text, {s: windows.distinct(s) for s in windows.sizes}))
        marked = _marked(rows if marked is None else marked, text, index)
    if marked is None:
        marked = _marked(rows, text, None)
    if not keep_text:
        marked = marked.drop(text)
    return marked.withColumns({
        "n_hit": F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]),
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", "items"), 256),
        "contaminated": F.size("spans") > 0,
    })
