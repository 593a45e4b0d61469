"""Preparation: parallel arrays, gates, files, counters."""

import os
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from facetide.operators import images, prep
from facetide.plans.prepare import prepare, sharded
from facetide.sources import files
from facetide.sources.files import list_files
from facetide.sources.tables import read_meta, read_prepared, write_prepared
from facetide.sources.tfrecord import read_records

NAN, INF = float("nan"), float("inf")
COLUMNS = "name string, score double, age int, gender double, second_score double, n_det int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


GATED = [
    (("kept", 0.75, 0, 1.0, NAN, 1), None),
    (("kept at 100", 3.0, 100, 0.0, 0.0, 1), None),
    (("nan score stays", NAN, 5, 0.0, None, 1), None),
    (("low", 0.7499, 5, 1.0, NAN, 1), "score"),
    (("minus infinity", -INF, 500, NAN, NAN, 0), "score"),
    (("no score", None, 5, 1.0, NAN, 1), "score"),
    (("negative age", 1.0, -1, NAN, NAN, 1), "age"),
    (("old", 1.0, 101, 1.0, NAN, 1), "age"),
    (("no age", 1.0, None, 1.0, NAN, 1), "age"),
    (("nan gender", 1.0, 5, NAN, NAN, 1), "gender"),
    (("null gender", 1.0, 5, None, NAN, 1), "gender"),
    (("no face", 1.0, 5, 1.0, NAN, 0), "detection"),
    (("two faces", 1.0, 5, 1.0, NAN, 2), "detection"),
]


def test_gates_and_reasons_agree(spark):
    df = frame(spark, *(row for row, _ in GATED))
    got = {r["name"]: r["why"] for r in
           df.select("name", prep.reject_reason(n_detections="n_det").alias("why")).collect()}
    assert got == {row[0]: why for row, why in GATED}
    kept = {r["name"] for r in prep.clean(df, n_detections="n_det").collect()}
    assert kept == {row[0] for row, why in GATED if why is None}


def test_second_face_gate(spark):
    df = frame(spark, ("nan", 1.0, 5, 1.0, NAN, 1), ("null", 1.0, 5, 1.0, None, 1), ("zero", 1.0, 5, 1.0, 0.0, 1),
               ("one", 1.0, 5, 1.0, 1.0, 1))
    assert {r["name"] for r in prep.clean(df, second_face=True).collect()} == {"nan", "null", "zero"}
    assert prep.clean(df).count() == 4


def test_gates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, *(row for row, _ in GATED)).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = prep.clean(spark.read.parquet(path)).select("name")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(age,100)" in plan and "IsNotNull(gender)" in plan
    assert "second_score" not in plan


def test_nan_score_survives_row_group_skipping(spark, tmp_path):
    """A file whose statistics do not tell of its NaN."""
    columns = {"name": ["nan", "low"], "score": [NAN, 0.1], "age": [5, 5], "gender": [1.0, 1.0]}
    pq.write_table(pa.table(columns), str(tmp_path / "f.parquet"))
    kept = prep.clean(spark.read.parquet(str(tmp_path))).collect()
    assert [r["name"] for r in kept] == ["nan"]


def test_parallel_arrays(spark):
    df = spark.createDataFrame([("s", [1, 2, 3], ["a", "b", "c"]), ("t", [], [])], "k string, x array<int>, y array<string>")
    rows = sorted(tuple(r) for r in prep.explode_parallel(df, ["x", "y"]).collect())
    assert rows == [("s", 1, "a"), ("s", 2, "b"), ("s", 3, "c")]
    bad = spark.createDataFrame([([1], ["a", "b"])], "x array<int>, y array<string>")
    with pytest.raises(Exception, match="differ in length"):
        prep.explode_parallel(bad, ["x", "y"]).collect()


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert prep.require(df.filter("k = 1"), "k", "v").collect() == df.filter("k = 1").collect()
    with pytest.raises(Exception, match="missing v"):
        prep.require(df, "v").collect()


def test_exactly_one(spark):
    faces = spark.createDataFrame([("a",), ("b",), ("b",), ("x",)], "k string")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, v int")
    assert sorted(r["v"] for r in prep.exactly_one(df, faces, "k").collect()) == [1, 2]


def test_hot_key_of_exactly_one_is_split(spark):
    """A third of all rows under one key must not end up in one task of the join."""
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40"}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        rows = spark.range(0, 120000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v")
        )
        out = prep.exactly_one(rows, spark.range(0, 60000).withColumnRenamed("id", "k"), "k")
        tasks = [r["p"] for r in out.select("v", F.spark_partition_id().alias("p")).collect()]
        assert len(tasks) == 40000 + sum(1 for i in range(60000) if i % 3)
        assert max(Counter(tasks).values()) < 10000
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.fixture
def pictures(tmp_path):
    folder = tmp_path / "imdb_crop" / "p"
    folder.mkdir(parents=True)
    for i in range(40):
        if i % 5:
            (folder / f"{i}.jpg").write_bytes(bytes([i]) * (i + 1))
    return str(tmp_path)


def metadata(spark, n=40):
    # Born on the last day of 1970, photographed in 2000: 29 years old.
    rows = [(f"p/{i}.jpg", 719893.0 + 0.5, 2000, float(i % 2), 0.5 if i % 7 == 3 else 2.0, NAN) for i in range(n)]
    return spark.createDataFrame(
        rows, "file_name string, dob double, photo_taken int, gender double, face_score double, second_face_score double"
    )


def test_attach_bytes_and_listing(spark, pictures, tmp_path):
    df = metadata(spark).select(F.concat(F.lit(f"{pictures}/imdb_crop/"), "file_name").alias("path"))
    rows = images.with_missing_flag(images.attach_bytes(df, num_partitions=3)).collect()
    for r in rows:
        i = int(r["path"].rsplit("/", 1)[1][:-4])
        assert r["missing"] == (i % 5 == 0)
        assert r["image_raw"] == (None if i % 5 == 0 else bytes([i]) * (i + 1))
    assert len(rows) == 40
    nested = tmp_path / "imdb_crop" / "p" / "deeper"
    nested.mkdir()
    (nested / "no.jpg").write_bytes(b"x")
    listing = list_files(spark, f"{pictures}/imdb_crop/p")
    assert listing.count() == 32
    assert listing.agg(F.sum("length")).first()[0] == sum(i + 1 for i in range(40) if i % 5)
    on = df.withColumn("path", F.concat(F.lit("file:"), "path"))
    assert images.missing_files(on, listing).count() == 8
    assert images.attach_files(on, listing).count() == 32


def listed(listing):
    return sorted(tuple(r) for r in listing.select("path", "length", F.unix_millis("modificationTime")).collect())


def test_listing_has_the_rows_of_sparks_listing(spark, tmp_path):
    top = tmp_path / "top" / "dir"
    (top / "sub" / "dir").mkdir(parents=True)
    (top / "empty").mkdir()
    seen = ["a.jpg", "b:c.jpg", "d e.jpg", "f%20g.jpg", "h\ni.jpg", "é.jpg", "j#k?.jpg", "k=v", "q[1]{z}*.jpg", "_l=m.jpg"]
    for name in [*seen, ".h.jpg", "_x.jpg", "_metadata", ".a.jpg.crc", "n._COPYING_", "sub/no.jpg", "sub/dir/no.jpg"]:
        (top / name).write_bytes(b"x" * len(name))
    (top / "zero.jpg").touch()
    (top / "link.jpg").symlink_to("a.jpg")
    for name, to in (("nowhere.jpg", "none"), ("loop.jpg", "loop.jpg"), ("below.jpg", "a.jpg/b"), ("folder.jpg", "sub")):
        (top / name).symlink_to(to)
    os.mkfifo(top / "pipe.jpg")
    with open(os.path.join(os.fsencode(top), b"\xff.jpg"), "wb") as odd:
        odd.write(b"x")
    os.utime(top / "a.jpg", ns=(0, 1_700_000_000_123_999_999))
    sizes = {n: len(n) for n in seen} | {"link.jpg": len("a.jpg")}
    expected = sorted((f"file:{top}/{n}", k, (top / n).stat().st_mtime_ns // 1_000_000) for n, k in sizes.items())
    assert (f"file:{top}/a.jpg", 5, 1_700_000_000_123) in expected
    # The same folder, however it is written. With // in it none of its files were found.
    for directory in (f"{top}", f"{top}/", f"file:{top}", f"file://{top}", f"{tmp_path}//top/./dir", os.path.relpath(top)):
        assert listed(list_files(spark, directory)) == expected, directory
    by_spark = files._listed_by_spark(spark, str(top), files.qualified(spark, str(top)))
    assert listed(by_spark) == expected and by_spark.schema == list_files(spark, str(top)).schema
    for nothing in ("empty", "a.jpg"):
        assert list_files(spark, f"{top}/{nothing}").count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        list_files(spark, f"{top}/none")


def test_listing_of_a_store_that_only_spark_opens(spark, tmp_path):
    (tmp_path / "p" / "p").mkdir(parents=True)
    for name in ("a.jpg", "b.jpg", "p/no.jpg"):
        (tmp_path / "p" / name).write_bytes(b"x")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.listed.link./in", f"file://{tmp_path}")
    found = listed(list_files(spark, "viewfs://listed/in/p"))
    assert [r[:2] for r in found] == [(f"viewfs://listed/in/p/{n}.jpg", 1) for n in "ab"]


def test_listing_is_not_held_by_the_driver(spark, tmp_path):
    """A frame over the files themselves has each of them in its plan, and a task for every few of them."""
    for i in range(300):
        (tmp_path / f"{i}.jpg").write_bytes(b"x" * (i + 1))
    listing = list_files(spark, str(tmp_path))
    assert not [f for f in listing.inputFiles() if f.endswith(".jpg")]
    (tmp_path / "later.jpg").write_bytes(b"x")
    (tmp_path / "0.jpg").unlink()
    assert [(p.rsplit("/", 1)[1], k) for p, k, _ in listed(listing)] == sorted((f"{i}.jpg", i + 1) for i in range(300))


def test_names_come_in_runs(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RUN_NAMES", 4)
    for i in range(10):
        (tmp_path / f"{i}.jpg").write_bytes(b"x")
    runs = list(files.name_runs(str(tmp_path)))
    assert [len(r) for r in runs] == [4, 4, 2] and len({n for r in runs for n in r}) == 10
    assert files.status(str(tmp_path), "gone.jpg") is None
    with pytest.raises(OSError):
        files.status(str(tmp_path), "x" * 300)


def test_prepare_end_to_end(spark, pictures, tmp_path):
    out = str(tmp_path / "out")
    meta = metadata(spark).withColumn("source", F.lit("imdb"))
    counts = prepare(meta, pictures, out, test_size=0.25, n_shards=3,
                     detect=lambda data: [] if data[0] == 1 else [data[:1] + b"!"])
    names = {s: sorted(n for n in os.listdir(f"{out}/{s}") if not n.startswith(("_", "."))) for s in ("train", "test")}
    assert names == {"train": [f"train-00{i}.tfrecords" for i in range(3)], "test": ["test-000.tfrecords"]}
    rows = {s: read_records(spark, f"{out}/{s}").collect() for s in names}
    kept = {i for i in range(40) if i % 7 != 3}
    found = {int(r["file_name"][2:-4]): r for s in rows for r in rows[s]}
    assert set(found) == {i for i in kept if i % 5 and i != 1}
    assert all(r["age"] == 29 and r["gender"] == i % 2 and r["image_raw"] == bytes([i]) + b"!" for i, r in found.items())
    told = {r["split"]: r for r in counts.collect()}
    assert sum(r["missing"] for r in told.values()) == len([i for i in kept if i % 5 == 0])
    assert {s: told[s]["valid"] for s in rows} == {s: len(rows[s]) for s in rows}


def test_split_is_exact_before_the_gates(spark):
    plans = sharded(metadata(spark).withColumn("source", F.lit("imdb")), test_size=0.25, n_shards=5)
    assert {s: k for s, (_, k) in plans.items()} == {"train": 5, "test": 2}
    train, test = (plans[s][0].collect() for s in ("train", "test"))
    assert len(train) + len(test) == 34 and len(test) <= 10
    sizes = [sum(r["shard"] == s for r in train) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_images_listed_many_times(spark):
    """A third of all rows is one image: copies are rows like others and spread over the shards."""
    meta = metadata(spark, 40).withColumn("source", F.lit("imdb"))
    copies = meta.filter("file_name = 'p/1.jpg'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("n")
    plans = sharded(meta.unionByName(copies), test_size=0.5, n_shards=4)
    train, test = (plans[s][0].collect() for s in ("train", "test"))
    assert len(train) + len(test) == 34 + 20 and len(test) <= 30
    assert sum(r["file_name"] == "p/1.jpg" for r in train + test) == 21
    assert len({r["shard"] for r in train if r["file_name"] == "p/1.jpg"}) > 1


def test_prepared_parquet_prunes_by_split(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(20).select("id", (F.col("id") % 2).cast("int").alias("shard"),
                                F.when(F.col("id") < 5, "test").otherwise("train").alias("split"))
    write_prepared(df, path, 2)
    assert len(os.listdir(f"{path}/split=train/shard=0")) <= 4  # one data file, its checksum
    test = read_prepared(spark, path, "test")
    assert sorted(r["id"] for r in test.collect()) == [0, 1, 2, 3, 4]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_read_meta_formats(spark, tmp_path):
    meta = metadata(spark, 5)
    meta.write.parquet(str(tmp_path / "a"))
    meta.write.csv(str(tmp_path / "b"), header=True)
    both = prep.union_corpora(read_meta(spark, str(tmp_path / "a"), "imdb"),
                              read_meta(spark, str(tmp_path / "b"), "wiki", "csv", header=True))
    counts = {r["source"]: r["n"] for r in both.groupBy("source").agg(
        F.count_if(F.isnan("second_face_score") & (F.col("dob") == 719893.5)).alias("n")).collect()}
    assert counts == {"imdb": 5, "wiki": 5}
    report = prep.prep_report(both.withColumn("missing", F.col("gender") == 1), ["source"]).collect()
    assert {(r["source"], r["missing"], r["valid"]) for r in report} == {("imdb", 2, 3), ("wiki", 2, 3)}


def hooks(name):
    """Functions made here travel to the tasks by value; a user's module would be sent along with ``--py-files``."""
    def quarters():
        return lambda x: x.reshape(len(x), 4, -1).mean(axis=2)

    return {"quarters": quarters, "face": lambda data: [(data * 76800)[:76800]], None: None}[name]


def test_command_line(spark, pictures, tmp_path, monkeypatch, capsys):
    """All four modes, one after another, on images that a hook turns into records and features."""
    from facetide.__main__ import main

    monkeypatch.setattr("facetide.__main__.hook", hooks)
    out, model = str(tmp_path / "out"), str(tmp_path / "model")
    metadata(spark).write.parquet(str(tmp_path / "meta"))
    main(["prepare", "--imdb", str(tmp_path / "meta"), "--base_path", pictures, "--out", out, "--test_size", "0.25",
          "--nworks", "2", "--detect", "face"])
    n_test = read_records(spark, f"{out}/test").count()
    main(["train", "--path", f"{out}/train", "--model", model, "--featurize", "quarters", "--batch_size", "8", "--epochs",
          "1", "--log_path", str(tmp_path / "log")])
    main(["infer", "--path", f"{out}/test", "--model", model, "--featurize", "quarters", "--output", str(tmp_path / "text"),
          "--num-partitions", "2"])
    assert spark.read.text(str(tmp_path / "text")).count() == n_test
    main(["evaluate", "--path", f"{out}/test", "--model", model, "--featurize", "quarters"])
    main(["evaluate", "--path", f"{out}/test", "--model", model, "--featurize", "quarters", "--choose_best"])
    shown = capsys.readouterr().out
    assert "mean_error_age" in shown and "best_gender_acc" in shown
    with pytest.raises(SystemExit, match="at least one"):
        main(["prepare"])
    with pytest.raises(FileNotFoundError):
        main(["evaluate", "--path", f"{out}/test", "--model", str(tmp_path / "none"), "--featurize", "quarters"])


def test_wide_types_are_cast(spark, tmp_path):
    """Years and flags as other writers store them."""
    rows = spark.createDataFrame(
        [("a", 711000.5, 2000, 1, 2.5, None), ("b", None, 2**40, None, NAN, 1.0)],
        "file_name string, dob double, photo_taken long, gender int, face_score double, second_face_score float")
    rows.write.parquet(str(tmp_path / "meta"))
    got = {r["file_name"]: r for r in read_meta(spark, str(tmp_path / "meta"), "x").collect()}
    assert (got["a"]["photo_taken"], got["a"]["gender"], got["a"]["source"]) == (2000, 1.0, "x")
    assert got["b"]["photo_taken"] is None and got["b"]["second_face_score"] == 1.0


def test_small_files_are_read_in_runs_and_large_ones_one_by_one(tmp_path, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    monkeypatch.setattr(images, "RUN_BYTES", 1000)
    sizes = [3] * 400 + [600] * 40 + [5000] * 5 + [0, 3] * 60
    paths = []
    for i, n in enumerate(sizes):
        (tmp_path / f"{i}").write_bytes(bytes([i % 251]) * n)
        paths += [str(tmp_path / f"{i}"), None, str(tmp_path / f"no{i}")][:1 + 2 * (i % 50 == 0)]
    calls, read = [], images._read_run
    monkeypatch.setattr(images, "_read_run", lambda p: calls.append(read(p)) or calls[-1])
    with ThreadPoolExecutor(4) as pool:
        found = dict(images._read_all(paths, pool))
    assert sorted(found) == list(range(len(paths)))
    for i, p in enumerate(paths):
        at = int(p.rsplit("/", 1)[1]) if p and "no" not in p.rsplit("/", 1)[1] else None
        assert found[i] == (None if at is None else bytes([at % 251]) * sizes[at])
    assert len(calls) < len(paths) / 3  # before, a call for each file
    assert all(sum(len(d or b"") for d in c[:-1]) < 1000 for c in calls)


def test_exported_images_are_spread_over_folders(spark, tmp_path):
    from facetide.plans import queries_prepare

    spark.range(1000).selectExpr("id as doc_id", "concat('t', id) as text").write.parquet(str(tmp_path / "documents.parquet"))
    base = queries_prepare.export_images(spark, str(tmp_path), 16).removeprefix("file:")
    held = {f: len(os.listdir(f"{base}/{f}/src")) for f in os.listdir(base)}
    assert len(held) == 16 and sum(held.values()) == 900 and max(held.values()) < 70
    rows = queries_prepare.attach_bytes(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows if r["missing"]} == set(range(0, 1000, 10)) and len(rows) == 1000
