"""Scalar functions against Python and numpy."""

import math
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from facetide import functions as fn

few = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
finite = st.floats(-50, 50, allow_nan=False, width=32)


def column(spark, rows, schema, **columns):
    return [r.asDict() for r in spark.createDataFrame(rows, schema).select(
        *(c.alias(n) for n, c in columns.items())).collect()]


@few
@given(st.lists(st.tuples(st.floats(-1000, 3652425), st.integers(1900, 2030)), min_size=50, max_size=200))
def test_serial_dates_and_ages(spark, rows):
    got = column(spark, rows, "dob double, taken int", d=fn.serial_to_date("dob"), a=fn.age_at("taken", "dob"))
    for (dob, taken), out in zip(rows, got):
        birth = date.fromordinal(max(int(dob) - 366, 1))
        assert out["d"] == birth
        assert out["a"] == taken - birth.year - (0 if birth.month < 7 else 1)


def test_unusable_birth_dates_give_null(spark):
    rows = [(float("nan"),), (None,), (float("inf"),), (1e30,), (-1e30,), (3652426.0,), (367.9,), (-5.0,)]
    got = column(spark, rows, "dob double", d=fn.serial_to_date("dob").cast("string"))
    assert [r["d"] for r in got] == [None] * 6 + ["0001-01-01"] * 2


def ragged(size):
    return st.lists(st.lists(finite, min_size=1, max_size=size), min_size=10, max_size=40)


@few
@given(ragged(20))
def test_array_maths(spark, rows):
    labelled = [(r, len(r) // 2) for r in rows]
    got = column(
        spark, labelled, "x array<double>, y int", p=fn.softmax("x"), e=fn.expected_index(fn.softmax("x")),
        m=fn.argmax("x"), l=fn.sparse_xent("x", "y"), k=fn.in_top_k("x", "y", 2), z=fn.standardize("x"),
        w=fn.l2_penalty("x", 0.5),
    )
    for (x, y), out in zip(labelled, got):
        a = np.array(x)
        p = np.exp(a - a.max()) / np.exp(a - a.max()).sum()
        np.testing.assert_allclose(out["p"], p, atol=1e-12)
        np.testing.assert_allclose(out["e"], (p * np.arange(len(a))).sum(), atol=1e-9)
        assert out["m"] == int(a.argmax())
        np.testing.assert_allclose(out["l"], np.log(np.exp(a - a.max()).sum()) + a.max() - a[y], atol=1e-9)
        assert out["k"] == bool((a > a[y]).sum() < 2)
        np.testing.assert_allclose(
            out["z"], (a - a.mean()) / max(a.std(), 1 / math.sqrt(len(a))), atol=1e-6, rtol=1e-6
        )
        np.testing.assert_allclose(out["w"], 0.25 * (a * a).sum(), rtol=1e-9)


def test_ties_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([1.0, 1.0], 1), ([1.0, 2.0], 0), ([nan, 1.0], 0), ([inf, 1.0], 0), ([1.0, 1.0, 0.0], 0)]
    got = column(spark, rows, "x array<double>, y int", m=fn.argmax("x"), k=fn.in_top_k("x", "y"))
    assert [r["m"] for r in got] == [0, 1, 0, 0, 0]
    assert [r["k"] for r in got] == [True, False, False, False, True]


@pytest.mark.parametrize("f", [fn.sparse_xent, fn.in_top_k])
def test_label_outside_the_array_is_an_error(spark, f):
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        column(spark, [([1.0, 2.0], 2)], "x array<double>, y int", v=f("x", "y"))


def test_large_logits_do_not_overflow(spark):
    got = column(spark, [([1000.0, 1000.0], 0)], "x array<double>, y int", l=fn.sparse_xent("x", "y"),
                 p=fn.softmax("x"))
    assert got[0]["p"] == [0.5, 0.5] and abs(got[0]["l"] - math.log(2)) < 1e-12


def test_constant_and_empty_rows_standardize(spark):
    got = column(spark, [([3.0, 3.0],), ([],)], "x array<double>", z=fn.standardize("x"))
    assert [r["z"] for r in got] == [[0.0, 0.0], []]


def test_reverse_channels(spark):
    got = column(spark, [([1, 2, 3, 4, 5, 6],), ([],)], "x array<int>", r=fn.reverse_channels("x", 3))
    assert [r["r"] for r in got] == [[3, 2, 1, 6, 5, 4], []]
    with pytest.raises(Exception, match="multiple of 3"):
        column(spark, [([1, 2],)], "x array<int>", r=fn.reverse_channels("x", 3))


def test_images_decode_reverse_and_standardize(spark):
    rng = np.random.default_rng(0)
    shape = (4, 5, 3)
    pictures = [rng.integers(0, 256, 60, dtype=np.uint8) for _ in range(7)] + [np.full(60, 9, np.uint8)]
    rows = [(i, bytearray(p.tobytes())) for i, p in enumerate(pictures)] + [(8, None)]
    df = spark.createDataFrame(rows, "i int, b binary").coalesce(1)
    got = df.select("i", fn.decode_raw("b", shape).alias("d"), fn.image_tensor("b", shape).alias("t")).collect()
    for r in got[:8]:
        p = pictures[r["i"]]
        assert r["d"] == p.tolist()
        x = p.reshape(shape)[:, :, ::-1].ravel().astype(float)
        np.testing.assert_allclose(r["t"], (x - x.mean()) / max(x.std(), 1 / math.sqrt(60)), atol=1e-5)
    assert got[8]["d"] is None and got[8]["t"] is None

    def make():
        return lambda x: np.stack([x[:, 0, 0, 0], x.sum(axis=(1, 2, 3)), x[:, -1, -1, 2]], axis=1)

    vectors = {r["i"]: r["v"] for r in df.select("i", fn.image_features("b", make, shape, 3).alias("v")).collect()}
    for r in got[:8]:
        np.testing.assert_allclose(vectors[r["i"]], [r["t"][0], sum(r["t"]), r["t"][-1]], atol=1e-4)
    assert vectors[8] is None
    with pytest.raises(Exception, match="image has 3 bytes, not 60"):
        spark.createDataFrame([(bytearray(b"abc"),)], "b binary").select(fn.decode_raw("b", shape)).collect()


def test_learning_rate_steps_down(spark):
    rows = [(s,) for s in (0, 2999, 3000, 6001)]
    got = column(spark, rows, "s long", lr=fn.decayed_lr("s", 0.01))
    np.testing.assert_allclose([r["lr"] for r in got], [0.01, 0.01, 0.009, 0.0081])


def test_paths_and_lines(spark):
    rows = [("imdb", "a/1.jpg", 3), ("wiki", "b.jpg", 1234)]
    got = column(spark, rows, "s string, f string, n int", p=fn.image_path(fn.corpus_dir("/d/", "s"), "f"),
                 n=fn.shard_name("test", "n"))
    assert [(r["p"], r["n"]) for r in got] == [
        ("/d/imdb_crop/a/1.jpg", "test-003.tfrecords"), ("/d/wiki_crop/b.jpg", "test-1234.tfrecords")
    ]
    with pytest.raises(Exception, match="unknown corpus: other"):
        column(spark, [("other",)], "s string", p=fn.corpus_dir("/d", "s"))
    for ts in (datetime(2020, 1, 2, 3, 4, 5), datetime(2020, 1, 2, 3, 4, 5, 60)):
        line = column(spark, [(ts, 1, 30, 0, 31.5)], "ts timestamp_ntz, g int, a int, pg int, pa double",
                      v=fn.format_result("ts", "g", "a", "pg", "pa"))[0]["v"]
        assert line == f"{ts.isoformat()} Real Gender/Age: 1/30, Predicted Gender/Age: 0/31.5"


def test_functions_stay_in_the_jvm(spark):
    df = spark.range(1).select(F.array(F.lit(1.0), F.lit(2.0)).alias("x"), F.lit(1).alias("y"))
    plan = df.select(fn.softmax("x"), fn.sparse_xent("x", "y"), fn.in_top_k("x", "y"), fn.standardize("x"),
                     fn.argmax("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
