import re
from collections import defaultdict

import numpy as np
import pytest

from facetide.llm import signature, similar


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Least key of each row's group, by comparing everything."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in by[g] if j < i}:
            o = len(s & sets[j])
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            r = find(i)
            least[r] = min(least.get(r, k), k)
    return [(k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))], [find(i) for i in range(len(rows))]


def texts(seed=0, clusters=12, size=18):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(4000)}"
    passage = [word() for _ in range(55)]
    out = []
    for c in range(clusters):
        base = [word() for _ in range(rng.integers(6, 160))] + (passage if c % 3 == 0 else [])
        for _ in range(rng.integers(1, size)):
            held = list(base)
            for _ in range(rng.integers(0, max(2, len(base) // 22))):
                held[rng.integers(len(held))] = word()
            out.append(" ".join(held))
            if rng.random() < 0.2:
                out.append("  ".join(held).upper())
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_equal_brute_force(spark, seed, monkeypatch):
    if seed:  # frequent shingles change the order of tokens, small blocks split every token
        monkeypatch.setattr(similar, "FREQUENT", 50)
        monkeypatch.setattr(similar, "PART_CLASSES", 3)
    rows = list(enumerate(texts(seed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out, links = similar.similar(docs)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()]
    assert sorted(got) == sorted(brute(rows)[0])
    classes = {r["doc_id"]: r["class"] for r in out.collect()}
    held = defaultdict(set)
    for i, t in rows:
        held[classes[i]].add(frozenset(shingles(t)))
    assert all(len(s) == 1 for s in held.values())
    for r in links.collect():
        (a,), (b,) = held[r["a"]], held[r["b"]]
        assert 100 * len(a & b) >= 75 * len(a | b)


@pytest.mark.parametrize("block", [3, 4096])
def test_all_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(similar, "PART_CLASSES", block)
    rows = list(enumerate(texts(2, clusters=6)))
    rows += [(900, ""), (901, None), (902, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out, links = similar.all_links(docs)
    sets = {k: frozenset(shingles(t)) for k, t in rows}
    linked = [(i, j) for i, _ in rows for j, _ in rows if i != j and sets[i] and sets[j]
              and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    got = {r["doc_id"]: r for r in out.collect()}
    assert {k: r["n_links"] for k, r in got.items()} == {k: sum(i == k for i, _ in linked) for k, _ in rows}
    want = {tuple(sorted((got[i]["class"], got[j]["class"]))) for i, j in linked if sets[i] != sets[j]}
    held = [(r["a"], r["b"]) for r in links.collect()]
    assert len(held) == len(set(held)) and set(held) == want
    assert similar.similar(docs)[1].distinct().count() < len(want)  # those connect groups only


def test_keep_one(spark):
    rows = list(enumerate(texts(3)))
    rows += [(None, rows[0][1]), (5, rows[5][1]), (900, ""), (900, ""), (None, None)]
    docs = spark.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, text string, _n long")
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    _, roots = brute(rows)
    groups = defaultdict(list)
    for (k, t), r in zip(rows, roots):
        if shingles(t):
            groups[r].append(k)
    want = [min(k for k in g if k is not None) for g in groups.values()]
    assert sorted(k for k, t in got if shingles(t)) == sorted(want)
    assert sum(not shingles(t) for _, t in got) == 3


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar.similar(odd)[0].collect()]
    assert sorted(got, key=key) == sorted(brute(rows)[0], key=key)
    assert similar.similar(none)[0].count() == 0


def test_trees_lose_no_pair_and_forests_connect():
    rng = np.random.default_rng(0)
    for trial in range(12):
        base = [rng.integers(0, 2**63, rng.integers(5, 300)).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(rng.integers(2, 150)):
            b = base[rng.integers(4)]
            s = np.unique(np.concatenate([b[rng.random(len(b)) > rng.random() * 0.3],
                                          rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64)]))
            sets.append(s if len(s) else b)
        labels = np.arange(len(sets)) if trial % 2 else rng.integers(0, 5, len(sets))
        side = None if trial % 3 else rng.integers(0, 2, len(sets))
        facts = np.array([len(s) for s in sets]), np.array([s[0] for s in sets]), [signature.bitmap(s, signature.FINE) for s in sets]
        got = [tuple(sorted(p)) for x, y in signature.candidates(*facts, labels, side, trial) for p in zip(x.tolist(), y.tolist())]
        assert signature.may_link(*facts, labels, side).nonzero()[0].tolist() == sorted({k for p in got for k in p})
        assert len(got) == len(set(got))
        plain = [set(s.tolist()) for s in sets]
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                o = len(plain[i] & plain[j])
                if labels[i] != labels[j] and (side is None or side[i] != side[j]) and 100 * o >= 75 * len(plain[i] | plain[j]):
                    assert (i, j) in set(got)
                    assert signature.linked(sets[i], sets[j])
        true = [(i, j) for i, j in got if signature.linked(sets[i], sets[j])]
        assert sorted(tuple(sorted(p)) for p in signature.links(labels, sets, side, trial, True)) == sorted(true)
        few = list(signature.links(labels, sets, side, trial))
        assert len(few) < len(set(labels.tolist())) and {tuple(sorted(p)) for p in few} <= set(true)
        for pairs in (true, few):
            top = {x: x for x in labels.tolist()}
            for i, j in pairs:
                a, b = top[int(labels[i])], top[int(labels[j])]
                top = {k: a if v == b else v for k, v in top.items()}
            parts = len(set(top.values()))
            assert pairs is true or parts == whole
            whole = parts


def test_prefixes_of_linked_sets_meet():
    for n in range(1, 60):
        for m in range(n, 80):
            o = int(signature.needed(n, m))
            if o <= n:
                # With o shared tokens, the first shared one is within both prefixes.
                assert n - o + 1 <= signature.prefix_length(n) and m - o + 1 <= signature.prefix_length(m)


def test_the_smaller_set_needs_a_short_prefix_only():
    for n in range(1, 60):
        for m in range(n, 80):
            o = int(signature.needed(n, m))
            if o <= n:
                assert n - o + 1 <= signature.short_length(n) <= signature.prefix_length(n)


def test_rare_tokens_of_prefixes_are_not_stored(spark):
    """They fill the exchange; in a table beside it they would fill the disk twice."""
    docs = spark.range(200).selectExpr("id", "concat_ws(' ', transform(sequence(1, 60), x -> concat('w', id div 2, '_', x))) as text")
    classes, prefixes = similar._classes(docs, "id", "text")
    assert "rare" not in classes.columns and "MapInArrow" in prefixes._jdf.queryExecution().executedPlan().toString()
    held = {r["class"]: r["before"] for r in classes.where("before is not null").collect()}
    assert len(held) == 100 and held == {r["class"]: len(r["rare"]) for r in prefixes.collect()}
    out, _ = similar.similar(docs, "id", "text")
    assert {(r["id"], r["component_id"]) for r in out.collect()} == {(i, i // 2 * 2) for i in range(200)}
