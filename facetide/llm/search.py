"""Ranked lexical search, reversed: the items are indexed and sent out, and every document streams through the index.

Items are few and documents many, so the inverted index (term to the items that hold it) is over the items' terms. Two
maps over the documents: the first counts the documents with a term N, all their terms L, and for each indexed term
the documents that hold it; the second looks the terms of each document up, adds what each term gives to its items, and
keeps the best ``top`` documents of each item in a heap. A task puts its heaps out at its end; they are merged by item, first
those of some tasks, then those of all. No text is shuffled, and what is depends on tasks and items only.

The index goes out in blocks of at most ``BLOCK_POSTINGS`` (item, term) pairs, or one item if it has more, two maps for
each block, so that neither the driver nor a task holds more however many items there are.

Score of a document for an item, in 64-bit integers with division rounding down: with n terms in the document and
m = 10 + 90 n N / L, the sum over the item's terms, once each, of w * (10^9 tf / (1000 tf + 8 m)), where
w = floor(1000 ln((2 N + 2) / (2 df + 1))).

Terms are runs of letters and digits (and of all characters beyond ASCII), A-Z lower-cased, told apart by 64-bit hashes.
Defined cases: a null or empty text has no terms, is not counted in N and never ranked, nor is a score of 0; items without terms have
no rows; items with the same id (null too) are one item with the terms of all. Equal scores go by the key, null keys
last; rows that repeat are ranked one by one, and which of them has which rank cannot be told. An empty table on either
side gives no rows. Only the keys and texts are read, so other columns cannot clash. Long texts are held one at a time.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from facetide.llm.common import stored
from facetide.llm.decontaminate import Members
from facetide.llm.words import NOT_ALNUM, Words, pieces
from facetide.session import ship

TOP = 10
BLOCK_POSTINGS = 1 << 18
#: Cells (document, item) and additions to them that are worked on at once.
CELLS = 1 << 22
#: Heaps of so many groups of tasks are merged first.
GROUPS = 64
#: Rows of the counts that stand for N and L.
_DOCUMENTS, _TERMS = -1, -2


class Index:
    """Terms of a block of items as sorted hashes, and the items that hold each."""

    def __init__(self, ids: list, item: np.ndarray, term: np.ndarray):
        self.ids = ids
        self.terms, of = np.unique(term, return_inverse=True)
        order = np.argsort(of, kind="stable")
        self.items = item[order]
        self.many = np.bincount(of, minlength=len(self.terms))
        self.begin = np.cumsum(self.many) - self.many


class Found:
    """The indexed terms of a batch of texts: text, term and count of each pair, and all terms of each text."""

    def __init__(self, texts: pa.Array, members: Members):
        words = Words(texts, NOT_ALNUM)
        self.n = words.counts()
        at = members.where(words.hash)
        text = np.searchsorted(words.first, at, "right") - 1
        width = max(1, len(members.keys))
        pairs, self.tf = np.unique(text * width + np.searchsorted(members.keys, words.hash[at]), return_counts=True)
        self.text, self.term = pairs // width, pairs % width


def _postings(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term) for all terms of all items."""
    schema = StructType([StructField("item", items.schema[key].dataType), StructField("term", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(piece.column("text"), NOT_ALNUM)
                item = pa.array(np.repeat(np.arange(len(words)), words.counts()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("item").take(item).cast(out.field("item").type), pa.array(words.hash.view(np.int64))], schema=out)

    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(run, schema).distinct(), "postings")


def _blocks(postings: DataFrame) -> Iterator[Index]:
    n = -(-postings.count() // BLOCK_POSTINGS)
    for b in range(n):
        part = postings.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b) if n > 1 else postings
        held = part.toArrow()  # of bounded size
        if held.num_rows:
            coded = held.column("item").combine_chunks().dictionary_encode("encode")
            yield Index(coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64),
                        held.column("term").to_numpy().view(np.uint64))


def _counts(docs: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Documents that hold each term (by its place in ``terms``), N and L; added up in each task."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, documents, words = Members(sent.value), 0, 0
        held = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = Found(piece.column("text"), members)
                held += np.bincount(found.term, minlength=len(held))
                documents += int((found.n > 0).sum())
                words += int(found.n.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(np.append(at, [_DOCUMENTS, _TERMS]), pa.int32()),
            "n": pa.array(np.append(held[at], [documents, words]), pa.int64())})

    rows = docs.select("text").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    sent.unpersist()
    return {r["at"]: r["n"] for r in rows}


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class _Held:
    """A document in a heap; the least is the worst: the lowest score, then the last key."""

    __slots__ = ("score", "key")

    def __init__(self, score: int, key):
        self.score, self.key = score, key

    def __lt__(self, other: _Held) -> bool:
        if self.score != other.score:
            return self.score < other.score
        if self.key is None or other.key is None:
            return self.key is None and other.key is not None
        return self.key > other.key


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, index: Index, weights: np.ndarray, documents: int, terms: int, top: int):
        self.index, self.weights, self.top = index, weights, top
        self.documents, self.terms = documents, terms
        self.held: list[list[_Held]] = [[] for _ in index.ids]
        #: A score below this does not enter the item's heap.
        self.least = np.ones(len(index.ids), np.int64)

    def length(self, n: np.ndarray) -> np.ndarray:
        if len(n) and 90 * int(n.max()) * self.documents >= 1 << 63:
            return np.array([10 + 90 * k * self.documents // self.terms for k in n.tolist()], np.int64)
        return 10 + 90 * n * self.documents // max(1, self.terms)

    def add(self, found: Found, keys: list) -> None:
        gives = self.weights[found.term] * (10**9 * found.tf // (1000 * found.tf + 8 * self.length(found.n)[found.text]))
        many = self.index.many[found.term]
        # Cut between documents, so that cells and additions are bounded; a single document may have more additions.
        added = np.cumsum(np.bincount(found.text, weights=many, minlength=len(found.n)))
        step = max(1, CELLS // max(1, len(self.index.ids)))
        first = 0
        while first < len(found.n):
            done = added[first - 1] if first else 0
            last = min(first + step, max(first + 1, int(np.searchsorted(added, done + CELLS, "right"))))
            a, b = np.searchsorted(found.text, [first, last])
            self._add(found.text[a:b] - first, found.term[a:b], gives[a:b], many[a:b], keys[first:last])
            first = last

    def _add(self, text: np.ndarray, term: np.ndarray, gives: np.ndarray, many: np.ndarray, keys: list) -> None:
        width = len(self.index.ids)
        ends = np.cumsum(many)
        place = np.repeat(self.index.begin[term] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)
        scores = np.zeros(len(keys) * width, np.int64)
        np.add.at(scores, np.repeat(text, many) * width + self.index.items[place], np.repeat(gives, many))
        scores = scores.reshape(len(keys), width)
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        order = np.empty(len(keys), np.int64)
        order[sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i]))] = np.arange(len(keys))
        score = scores[row, item]
        best = np.lexsort((order[row], -score, item))
        row, item, score = row[best], item[best], score[best]
        # Of these documents no more than the best of each item can enter.
        begin = np.searchsorted(item, item)
        few = np.arange(len(item)) - begin < self.top
        for i, s, r in zip(item[few].tolist(), score[few].tolist(), row[few].tolist()):
            heap, new = self.held[i], _Held(s, keys[r])
            if len(heap) < self.top:
                heapq.heappush(heap, new)
            elif heap[0] < new:
                heapq.heapreplace(heap, new)
            if len(heap) == self.top:
                self.least[i] = heap[0].score


def _ranked(docs: DataFrame, index: Index, top: int, schema: StructType) -> DataFrame:
    """The best documents of each item in each task."""
    counts = _counts(docs, index.terms)
    documents, terms = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
    weights = np.array([weight(documents, counts.get(i, 0)) for i in range(len(index.terms))], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((index, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        index, weights = sent.value
        members, heaps = Members(index.terms), Heaps(index, weights, documents, terms, top)
        for batch in batches:
            for piece in pieces(batch, "text"):
                heaps.add(Found(piece.column("text"), members), piece.column("doc").to_pylist())
        rows = [(index.ids[i], h.key, h.score) for i, heap in enumerate(heaps.held) for h in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

    return docs.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item key, ``rank`` from 1, key, ``score``) of the ``top`` documents of each item with a score above 0."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    schema = StructType([
        StructField("item", items.schema[item_key].dataType), StructField("doc", docs.schema[key].dataType),
        StructField("score", LongType())])
    ranked = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(_postings(items, item_key, item_text)):
        ranked = ranked.unionByName(_ranked(rows, index, top, schema))
    best = [F.desc("score"), F.asc_nulls_last("doc")]
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
    some = ranked.select("*", group).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*best))).where(F.col("rank") <= top)
    every = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= top)
    return every.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
