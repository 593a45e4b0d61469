from pyspark.sql import functions as F

from facetide.llm import language, queries


def test_held_out_accuracy(spark):
    # The smallest tables hold too few texts to learn from.
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("lang").alias("want"))
    out = queries.op4(spark, sf_dir).join(docs, "doc_id")
    rows = out.where("held_out").collect()
    assert len(rows) > 100 and sum(r["lang_pred"] == r["want"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    again = queries.op4(spark, sf_dir).where("held_out").collect()
    assert {r["doc_id"]: r["lang_pred"] for r in again} == {r["doc_id"]: r["lang_pred"] for r in rows}


def test_odd_rows(spark, odd, none):
    net = language.fit(odd)
    out = language.predict(odd, net)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "Shard", "lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (3, 4, 5)} == {("und", 0.0)}
    assert all(r["lang_pred"] in ("en", "es", "fr") for r in rows if r["doc_id"] in (1, 2, 6, 7))
    assert language.predict(none, net).count() == 0
    assert language.fit(none) is None
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}


def test_compiled_tables_give_what_the_filters_give():
    import numpy as np

    net = language.Network(["a", "b", "c"])
    x = np.random.default_rng(0).integers(0, 256, (5, language.WINDOW + language.PAD + 1)).astype(np.uint8)
    kept = [sum(t[k][x[:, k:k + language.WINDOW]] for k in range(w)).max(axis=1) for w, t in zip(language.WIDTHS, net.tables)]
    full = np.hstack([np.maximum(np.hstack(kept), 0), np.ones((5, 1))])
    assert np.allclose(net.compiled().windows(x), language._softmax(full @ net.out), atol=1e-5)


def test_whole_texts_count():
    import numpy as np

    net = language.Network(["a", "b"]).compiled()
    data = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    whole = net.texts(data, np.array([0, 3000]))[0]
    parts = net.texts(data, np.array([0, *range(256, 3000, 256), 3000]))
    sizes = np.diff([0, *range(256, 3000, 256), 3000])
    assert np.allclose(whole, (parts * sizes[:, None]).sum(axis=0) / 3000)
