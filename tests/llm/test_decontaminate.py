import hashlib
import re

from facetide.llm import decontaminate


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        size = min(10, len(v))
        for j in range(len(v) - size + 1) if size else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == v[j:j + size]:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
    ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), ids, bool(hit)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog while seven calm otters"), (2, "One"), (10, "c D"), (11, "..."), (12, None),
         (None, "from the quiet"), (1, "watch from the quiet river bank"), (3, "quick brown fox jumps over the lazy dog while seven"),
         (4, "brown fox jumps over the lazy dog while seven calm"), (5, "日本 😀"), (6, "a a a a a a a a a a a a")]


def compare(spark, docs, monkeypatch=None):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.decontaminate(docs, bench)
    got = out.collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == brute(r["text"], ITEMS), r["doc_id"]
        assert r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"])
    return out


def test_odd_rows(spark, odd, none):
    more = spark.createDataFrame(
        [(20, "x a A a-a.a a a a a a a a y", None, None, None, None, None), (21, "ONE fish; the quick, brown fox jumps over the lazy dog while "
          "seven calm otters c d", None, None, None, None, None), (22, "fox jumps over the lazy dog while", None, None, None, None, None)], odd.schema)
    out = compare(spark, odd.unionByName(more))
    assert out.columns[:7] == odd.columns
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert not decontaminate.decontaminate(odd, bench.limit(0)).where("contaminated").count()


def test_blocks_of_items_give_the_same(spark, odd, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    compare(spark, odd.where("doc_id <> 6"))


def test_columns_with_the_names_of_results(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = odd.withColumnsRenamed({"score": "spans", "Shard": "Items"})
    assert decontaminate.decontaminate(docs, bench).where("contaminated").count() > 0
