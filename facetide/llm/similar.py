"""N-gram Jaccard join: documents whose sets of five-word shingles overlap by three quarters, exactly, and their groups.

1. Each text becomes a set of 64-bit shingle hashes. Equal sets are one class, so copies are compared once.
2. Prefixes: classes that are linked share a token among the first quarter of the larger one's tokens and the first seventh
   of the smaller one's, in any common order. The order
   puts the frequent shingles last (a table of bounded size, counted over all texts) and the others by hash. Tokens that
   two or more classes share are kept; those below are found per task, the frequent ones go through an aggregate.
3. Blocks: the tokens whose least class is the same are one block, which holds all classes of these tokens. So a class goes
   to few blocks however many tokens it shares, and to none in which no other class has about its size. A block above ``PART_BYTES`` or ``PART_CLASSES`` is cut by bands of size,
   of which only neighbours can hold linked sets, and each band by hash. A part, or a pair of parts, is a cell.
4. Signature trees: the bitmaps and sizes of a cell's sets are a tree, or one for each side, searched against itself or the
   other; pairs of nodes are ruled out by their greatest possible overlap, or because all below is one group already. First
   only bitmaps go to the cells, and the classes that may be linked at all come out. Then the sets of these go there, are
   searched again, and what is left is verified on the whole sets. A cell gives only links that join two of its groups, so
   fewer than it has classes. First each part is searched by itself. What was cut is then searched in a ring of parts, which
   joins a large group, and at last in all pairs of parts, where a large group has parts of its own: two parts of one group
   are no cell.
5. Links become groups by contracting stars.

Nothing is approximate: two sets count as equal, or a shingle as shared, by 64-bit hashes.

Defined cases: words are runs without white space, A-Z lower-cased; a text of fewer than five words is one shingle; a null
or empty text has no set and is linked with nothing. Repeated rows, also with null keys, belong to one group. A null key
never names a group unless all its keys are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from facetide.llm import signature
from facetide.llm.common import apart, bounded, stored
from facetide.llm.words import SPACE, Words, joined, mix, pieces
from facetide.session import ship

SHINGLE = 5
#: Frequent shingles, which come last in the order. More or fewer change the work, never the result.
FREQUENT = 1 << 17
FREQUENT_IN_PIECE = 3
COUNTED_BYTES = 8 << 20
#: Bytes of the sets, and classes, of a part of a block; two parts are searched together.
PART_BYTES, PART_CLASSES = 16 << 20, 4096
#: Steps of size within the greatest ratio of linked sizes.
SIZE_STEPS = 4
#: Bytes of a token in a set.
TOKEN_BYTES = 8
CLASS_ROW_BYTES = 96


def _shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, SPACE)
    runs = joined(words.hash, SHINGLE)
    for i in range(len(words)):
        first, last = words.first[i], words.first[i + 1]
        n = last - first
        if n >= SHINGLE:
            yield np.unique(runs[first:last - SHINGLE + 1])
        else:
            yield joined(words.hash[first:last], n) if n else np.zeros(0, np.uint64)


def _class_of(tokens: np.ndarray) -> int:
    """One 64-bit name for a set."""
    if not len(tokens):
        return 0
    names = mix(tokens + np.uint64(0x2545F4914F6CDD1D))
    return int(mix(np.array([np.add.reduce(names) ^ np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _frequent(docs: DataFrame, text: str) -> np.ndarray:
    """The most frequent shingles, most frequent last. What repeats within a piece of a batch is counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, COUNTED_BYTES):
                distinct = {_class_of(s): s for s in _shingles(piece.column(text))}
                tokens, n = np.unique(np.concatenate([*distinct.values(), np.zeros(0, np.uint64)]), return_counts=True)
                many = n >= FREQUENT_IN_PIECE
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(tokens[many].view(np.int64)), "n": pa.array(n[many], pa.int64())})

    rows = (
        docs.select(text).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").collect())  # of bounded size
    return np.array([r["token"] for r in rows], np.int64).view(np.uint64)[::-1]


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """A row per document: key, class, set size; for the first of its class in a piece also the bitmap and the prefix's frequent
    tokens. The others go from the texts straight into their exchange, as they would fill the disk twice: they are not stored
    but a table of their own, which is made again from the texts."""
    frequent = _frequent(docs, text)
    order = np.argsort(frequent, kind="stable")
    sent = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = sent.value
        for batch in batches:
            for piece in pieces(batch, "_text"):
                seen, names, sizes, fine, least, rare, before, often = set(), [], [], [], [], [], [], []
                for tokens in _shingles(piece.column("_text")):
                    name, n = _class_of(tokens), len(tokens)
                    names.append(name)
                    sizes.append(n)
                    if not n or name in seen:
                        for held in (fine, least, rare, before, often):
                            held.append(None)
                        continue
                    seen.add(name)
                    need = signature.prefix_length(n)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                        is_known = known[at] == tokens
                        first = tokens[~is_known][:need]
                        late = tokens[is_known]
                        late = late[np.argsort(rank[at[is_known]])][:need - len(first)]
                    else:
                        first, late = tokens[:need], tokens[:0]
                    fine.append(signature.bitmap(tokens, signature.FINE).tobytes())
                    least.append(int(tokens[:1].view(np.int64)[0]))
                    rare.append(first.view(np.int64))
                    before.append(len(first))
                    often.append(late.view(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "short": pa.array([signature.short_length(n) for n in sizes], pa.int32()), "key": piece.column("key"),
                    "place": piece.column("place"), "class": pa.array(names, pa.int64()), "n": pa.array(sizes, pa.int64()),
                    "fine": pa.array(fine, pa.binary()), "least": pa.array(least, pa.int64()),
                    "rare": pa.array(rare, pa.list_(pa.int64())),
                    "before": pa.array(before, pa.int32()), "often": pa.array(often, pa.list_(pa.int64()))})

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("place"), F.col(text).alias("_text"))
    made = rows.mapInArrow(make, f"short int, key {kind}, place long, class long, n long, fine binary, least long, "
                           "rare array<long>, before int, often array<long>")
    return stored(made.drop("rare"), "classes"), made.where("rare is not null").select("class", "n", "short", "rare")


def _shared(classes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(token, class) of prefix tokens that several classes have.

    Of linked sets the smaller one has a shared token among its first seventh, so a token counts for a class only if that
    holds for the class, or for one that is no larger.
    """
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(b.column(i).to_numpy() for i in range(3)) for b in batches]
        if not held:
            return
        token, name, size = (np.concatenate([h[i] for h in held]) for i in range(3))
        del held
        order = np.argsort(token, kind="stable")
        token = token[order]
        # Most tokens have one row.
        same = np.zeros(len(token), bool)
        same[1:] = token[1:] == token[:-1]
        same[:-1] |= same[1:]
        token, name, size = token[same], name[order[same]], size[order[same]]
        if not len(token):
            return
        order = np.lexsort((name, token))
        token, name, size = token[order], name[order], size[order]
        begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        least = np.minimum.reduceat(np.where(size & 1, size >> 1, 1 << 30), begin)
        held = (size >> 1) >= np.repeat(least, np.diff(np.append(begin, len(token))))
        token, name = token[held], name[held]
        if not len(token):
            return
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        token, name = token[fresh], name[fresh]
        same = np.zeros(len(token), bool)
        same[1:] = token[1:] == token[:-1]
        same[:-1] |= same[1:]
        if same.any():
            yield pa.RecordBatch.from_pydict({"token": pa.array(token[same]), "class": pa.array(name[same])})

    sets = classes.where("often is not null")
    # The size, and whether the token is among the first seventh, as one number.
    size = lambda place: (2 * F.col("n") + (place < F.col("short")).cast("int")).cast("int").alias("size")
    rare = prefixes.select("class", "n", "short", F.posexplode("rare").alias("at", "token")).select("token", "class", size(F.col("at")))
    rare = rare.repartition(F.col("token")).mapInArrow(groups, "token long, class long")
    often = sets.select("class", "n", "short", "before", F.posexplode("often").alias("at", "token")).select(
        "token", "class", size(F.col("at") + F.col("before"))).distinct()
    least = often.where("size % 2 = 1").groupBy("token").agg(F.min(F.shiftright("size", 1)).alias("least"))
    often = often.join(least, "token").where(F.shiftright("size", 1) >= F.col("least")).select("token", "class")
    return stored(rare.unionByName(often), "shared")


def groups(links: DataFrame) -> DataFrame:
    """(class, root): the least class reachable by links (a, b), by contracting stars until nothing changes."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    while True:
        # Large stars: every higher neighbour goes to the least neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u != v").distinct(), "edges")
        # Small stars: every lower neighbour goes to the least one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("class"), F.col("v").alias("root"))
        before = now


def _blocks(shared: DataFrame, facts: DataFrame) -> DataFrame:
    """The blocks and bands of each class that shares a token; the band is -1 in blocks that need no cut."""
    least = shared.groupBy("token").agg(F.min("class").alias("block"))
    of_class = shared.join(least, "token").select("class", "block").distinct()
    # Linked sizes differ by a third at most: a class without another of about its size in the block is left out.
    fine = F.floor(SIZE_STEPS * F.log("n") / F.log(F.lit(100 / signature.PERCENT))).cast("int")
    sized = stored(of_class.join(facts.select("class", "n", "place"), "class").withColumn("step", fine), "sized")
    near = F.explode(F.sequence(F.col("step") - SIZE_STEPS - 1, F.col("step") + SIZE_STEPS + 1)).alias("step")
    about = sized.groupBy("block", "step").agg(F.count(F.lit(1)).alias("many")).select("block", near, "many").groupBy(
        "block", "step").agg(F.sum("many").alias("many")).where("many > 1").select("block", "step")
    rows = stored(sized.join(about, ["block", "step"]).drop("step"), "blocks")
    large = stored(rows.groupBy("block").agg(*_extent()).where("cuts > 1").select("block", F.lit(True).alias("large")), "large")
    if not large.limit(1).count():
        return rows.select("class", "n", "place", "block", F.lit(-1).alias("band"))
    # Linked sizes differ by a third at most, so they are in one band or in neighbours.
    band = F.floor(F.log("n") / F.log(F.lit(100 / signature.PERCENT))).cast("int")
    return stored(rows.join(large, "block", "left").select(
        "class", "n", "place", "block", F.when(F.col("large"), band).otherwise(-1).alias("band")), "bands")


def _extent() -> list:
    """Of a group of classes, how many parts it needs."""
    by_bytes, by_count = F.sum("n") * TOKEN_BYTES / PART_BYTES, F.count(F.lit(1)) / PART_CLASSES
    return [F.greatest(F.ceil(by_bytes), F.ceil(by_count)).alias("cuts")]


def _parts(blocks: DataFrame, labels: DataFrame, by_label: bool) -> DataFrame:
    """Add label, ``of`` and ``part``. ``by_label``: a label that would fill a part has parts of its own, named by ``of``."""
    rows = blocks.join(labels, "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")
    if by_label:
        own = rows.where("band >= 0").groupBy("block", "band", "label").agg(*_extent(), F.count(F.lit(1)).alias("many")).where(
            F.col("many") > 1).where((F.col("cuts") > 1) | (F.col("many") > PART_CLASSES // 2)).select(
            "block", "band", "label", F.col("label").alias("of"))
        rows = rows.join(own, ["block", "band", "label"], "left")
    else:
        rows = rows.withColumn("of", F.lit(None).cast("long"))
    rows = rows.withColumn("of", F.coalesce("of", F.lit(0).cast("long")))
    counted = rows.where("band >= 0").groupBy("block", "band", "of").agg(*_extent()).where("cuts > 1")
    part = F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("class", F.lit(1)), F.col("cuts"))).otherwise(0).cast("int")
    named = ["block", "band", "of"]
    return stored(rows.join(counted, named, "left").select(
        "class", "place", "label", *named, part.alias("part"), F.coalesce("cuts", F.lit(1)).cast("int").alias("cuts")), "parts")


_PART = ["block", "band", "of", "part"]


def _whole(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_PART, "cuts").agg(F.min("label").alias("first"), F.max("label").alias("last"))


def _own(parts: DataFrame) -> DataFrame:
    """Cells of single parts that hold different labels: class, place, label, cell, side."""
    cells = _whole(parts).where("first != last").select(*_PART)
    return parts.join(cells, _PART).select("class", "place", "label", F.xxhash64(*_PART).alias("cell"), F.lit(0).alias("side"))


def _across(parts: DataFrame, ring: bool) -> DataFrame:
    """Cells of two parts that may hold linked sets of different labels: all, or each part with the next one only. What
    cannot differ is left out before any row of a cell is made; the parts themselves are few."""
    whole = stored(_whole(parts).where("band >= 0"), "whole")
    low, high = (whole.select(*(F.col(c).alias(f"{x}_{c}") for c in whole.columns)) for x in ("low", "high"))
    step = F.col("high_band") - F.col("low_band")
    if ring:
        meet = (step == 0) & (F.col("low_of") == F.col("high_of")) & (
            F.col("high_part") == (F.col("low_part") + 1) % F.col("low_cuts")) & (
            (F.col("low_cuts") > 2) | (F.col("low_part") < F.col("high_part")))
    else:
        meet = (step == 1) | (step == 0) & (F.struct("low_of", "low_part") < F.struct("high_of", "high_part"))
    apart = F.least("low_first", "high_first") != F.greatest("low_last", "high_last")
    cell = F.xxhash64(*(f"{x}_{c}" for x in ("low", "high") for c in _PART)).alias("cell")
    sides = F.explode(F.array(*(F.struct(F.lit(i).alias("side"), *(F.col(f"{x}_{c}").alias(c) for c in _PART))
                                for i, x in enumerate(("low", "high"))))).alias("s")
    pairs = low.join(high, F.col("low_block") == F.col("high_block")).where(meet & apart).select(cell, sides)
    return parts.join(pairs.select("cell", "s.*"), _PART).select("class", "place", "label", "cell", "side")


def _open(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """Of the rows of cells those whose class may be linked with one of another label, by the trees of their bitmaps."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, name, label, side, held, more in _in_cells(batches, ("place", "n", "least")):
            found = signature.may_link(more["n"], more["least"].view(np.uint64), held, label, side if side.any() else None)
            if found.any():
                yield pa.RecordBatch.from_pydict({
                    "class": pa.array(name[found]), "place": pa.array(more["place"][found]), "label": pa.array(label[found]),
                    "cell": pa.array(np.full(int(found.sum()), cell)), "side": pa.array(side[found].astype(np.int32))})

    rows = cells.join(facts.select("class", "n", "least", F.col("fine").alias("set")), "class")
    return rows.repartition("cell").sortWithinPartitions("cell").select(
        "cell", "class", "label", "side", "set", "place", "n", "least").mapInArrow(
        search, "class long, place long, label long, cell long, side int")


def _searched(cells: DataFrame, facts: DataFrame, docs: DataFrame, text: str, every: bool) -> DataFrame:
    """Linked pairs of classes of one cell: all, or those that join the cell's groups. Sets are made again from one text of each
    class and sent to their cells."""
    cells = _open(cells, facts)
    def remake(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch, "_text"):
                # Of texts that are alike a task sends the first.
                names, fresh = piece.column("class").to_pylist(), []
                for i, name in enumerate(names):
                    if name not in seen:
                        seen.add(name)
                        fresh.append(i)
                piece = piece.take(pa.array(fresh, pa.int64()))
                cells = piece.column("cells")
                at = np.repeat(np.arange(piece.num_rows), cells.value_lengths().to_numpy())
                flat, held = cells.flatten(), [s.tobytes() for s in _shingles(piece.column("_text"))]
                for first in range(0, len(at), 4096):  # a set that goes to many cells is not held for all at once
                    now = at[first:first + 4096]
                    part = flat.slice(first, len(now))
                    yield pa.RecordBatch.from_pydict({
                        "cell": part.field("cell"), "side": part.field("side"), "class": piece.column("class").take(pa.array(now)),
                        "label": piece.column("label").take(pa.array(now)), "set": pa.array([held[k] for k in now.tolist()], pa.binary())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, name, label, side, held, _ in _in_cells(batches):
            if len(np.unique(label)) < 2:
                continue
            found = signature.links(label, held, side if side.any() else None, abs(cell) % (1 << 62), every)
            found = np.array(list(found), np.int64).reshape(-1, 2)
            a, b = name[found[:, 0]], name[found[:, 1]]
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    wanted = stored(cells.groupBy("place", "class", "label").agg(F.collect_list(F.struct("cell", "side")).alias("cells")), "wanted")
    texts = docs.select(F.xxhash64(F.col(text)).alias("place"), F.col(text).alias("_text"))
    rows = texts.join(bounded(wanted, CLASS_ROW_BYTES), "place").select("class", "label", "cells", "_text").mapInArrow(
        remake, "cell long, side int, class long, label long, set binary")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(search, "a long, b long")


def _in_cells(batches: Iterator[pa.RecordBatch], more: tuple[str, ...] = ()) -> Iterator[tuple]:
    """Cell, and class, label, side, set (or bitmap) and more of its rows, each class once; a cell holds two parts at most."""
    held, cell = [], None

    def rows():
        t = pa.Table.from_batches(held)
        name, at = np.unique(t.column("class").to_numpy(), return_index=True)
        label, side = (t.column(c).to_numpy()[at] for c in ("label", "side"))
        sets = t.column("set").take(pa.array(at))
        return int(cell), name, label, side, [np.frombuffer(s.as_buffer(), np.uint64) for s in sets], {
            c: t.column(c).to_numpy()[at] for c in more}

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if keys[low] != cell and held:
                yield rows()
                held = []
            cell = keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield rows()


def _prepared(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A row per document, a row of facts per class, and the blocks of those that share a token."""
    ship(docs.sparkSession)
    classes, prefixes = _classes(docs, key, text)
    shared = _shared(classes, prefixes)
    facts = stored(classes.where("n > 0").groupBy("class").agg(F.max("n").alias("n"), F.min("place").alias("place"), F.max("fine").alias("fine"), F.max("least").alias("least")), "facts")
    return classes, facts, _blocks(shared, facts)


def all_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every linked pair of classes: a row per document (key, ``class``, ``n_links``: the other documents it is linked
    with, equal sets among them), and all links (a, b, ``a_rows``, ``b_rows``) with the documents of either class.

    No group is skipped, so a group of many different texts costs its square, which is also the size of its result.
    """
    classes, facts, blocks = _prepared(docs, key, text)
    parts = _parts(blocks, facts.select("class", F.col("class").alias("root")), False)
    pairs = stored(_searched(
        _own(parts).unionByName(_across(parts, False)), facts, docs, text, True).distinct(), "searched")
    rows = stored(classes.where("n > 0").groupBy("class").agg(F.count(F.lit(1)).alias("rows")), "rows")
    side = lambda x: rows.select(F.col("class").alias(x), F.col("rows").alias(f"{x}_rows"))
    links = stored(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_rows", "b_rows"), "all_links")
    ends = links.select(F.col("a").alias("class"), F.col("b_rows").alias("n")).unionByName(
        links.select(F.col("b").alias("class"), F.col("a_rows").alias("n")))
    others = ends.groupBy("class").agg(F.sum("n").alias("others"))
    counts = rows.join(others, "class", "left").select(
        "class", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = classes.select("key", "n", "class").join(counts, "class", "left").select(
        F.col("key").alias(key), F.when(F.col("n") > 0, F.col("class")).alias("class"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out, links


def _components(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A row per document (key, place, class, n); (class, root); and links that connect each group."""
    classes, facts, blocks = _prepared(docs, key, text)
    parts = _parts(blocks, facts.select("class", F.col("class").alias("root")), False)
    links = stored(_searched(_own(parts), facts, docs, text, False), "links")
    of_class = groups(links)
    if blocks.where("band >= 0").limit(1).count():
        for ring in (True, False):
            parts = _parts(blocks, of_class, not ring)
            cells = _across(parts, ring) if ring else _across(parts, ring).unionByName(_own(parts.where("band >= 0")))
            links = stored(links.unionByName(_searched(cells, facts, docs, text, False)), "links")
            of_class = groups(links)
    roots = facts.select("class").join(of_class, "class", "left").select("class", F.coalesce("root", "class").alias("root"))
    return classes.select("key", "place", "class", "n"), stored(roots, "roots"), links


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """A row per document (key, ``class``, ``n_shingles``, ``component_id``: the least key of its group), and links (a, b)
    between classes that connect each group; ``all_links`` gives all of them."""
    rows, roots, links = _components(docs, key, text)
    # The least key of each class, then of each group.
    names = stored(rows.where("n > 0").groupBy("class").agg(F.min("key").alias("least")).join(roots, "class"), "names")
    of_root = names.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stored(names.join(of_root, "root").select("class", "component_id"), "components")
    out = rows.join(of_class, "class", "left").select(
        F.col("key").alias(key), F.when(F.col("n") > 0, F.col("class")).alias("class"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
    return out, links


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least key of each group, null keys last, and all documents without words."""
    return apart(docs, (), (key, text), _kept)


def _kept(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows, roots, _ = _components(docs, key, text)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "place")).alias("f")
    held = rows.where("n > 0").groupBy("class").agg(first).join(roots, "class").groupBy("root").agg(
        F.min("f").alias("f")).select(F.col("f.key").alias("_key"), F.col("f.place").alias("_place"))
    held = stored(held.unionByName(rows.where("n = 0").select(F.col("key").alias("_key"), F.col("place").alias("_place"))
                                   .distinct()), "kept")
    placed = docs.withColumn("_at", F.xxhash64(F.col(text)))
    same = placed[key].eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_place"))
    kept = placed.join(bounded(held, CLASS_ROW_BYTES), same, "left_semi")
    # Rows repeated with key and text: one stays of those with words. Their texts alone are shuffled.
    again = stored(rows.where("n > 0").groupBy(F.col("key").alias("_key"), F.col("place").alias("_place")).count()
                   .where("count > 1").drop("count"), "again")
    if not again.limit(1).count():
        return kept.drop("_at")
    again = bounded(again, CLASS_ROW_BYTES)
    once = kept.join(again, same, "left_anti")
    return once.unionByName(kept.join(again, same, "left_semi").dropDuplicates([key, "_at"])).drop("_at")
