"""Records as a stream: the list of arrivals, bounded steps, restarts, state over micro-batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from facetide.sources import arrivals, tfrecord
from facetide.streaming import running
from facetide.streaming.running import read_running, running_metrics
from facetide.streaming.score import await_scored


def put(spark, folder, split, low, high, parts=1):
    tfrecord.register(spark)
    spark.range(low, high, 1, parts).select(F.col("id").alias("k")).write.format("tfrecord").mode("append").option(
        "split", split).save(str(folder))


def test_arrivals_are_listed_once_and_cut_alike_after_a_restart(tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "WHOLE_EVERY", 3)
    state = str(tmp_path / "state")
    held = arrivals.Arrivals(state)
    for n in range(8):  # later names may sort before earlier ones
        listed = [(f"f{k}", 10 + k) for k in range(7 - n, 8)] + [("empty", 0)]
        held.add(listed)
        held.add(listed)
        again = arrivals.Arrivals(state)
        assert again.files == held.files == [(f"f{k}", 10 + k) for k in range(7, 6 - n, -1)]
        assert (again.ends, again.parts) == (held.ends, held.parts) == (held.ends, n + 1)
    assert held.total == sum(10 + k for k in range(8))
    assert held.between(0, 17) == [("f7", 17, 0, 17)] and held.between(16, 18) == [("f7", 17, 16, 17), ("f6", 16, 0, 1)]
    assert held.between(5, 5) == [] and held.between(17, 33) == [("f6", 16, 0, 16)]
    assert [held.step(0, None, None), held.step(0, 5, None), held.step(0, None, 2), held.step(17, 40, 2), held.step(20, 0, None)] == [
        held.total, 5, 33, 48, 21]
    assert held.step(held.total, 5, 1) == held.total
    assert held.given() == 0
    held.give(33)
    assert arrivals.Arrivals(state).given() == 33
    other = arrivals.Arrivals(state)
    held.add([("x", 1)])
    with pytest.raises(RuntimeError, match="another query"):
        other.add([("y", 1)])


def test_steps_are_bounded_and_a_restart_loses_nothing(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    put(spark, folder, "b", 0, 300, 3)
    seen = []

    def run(stop_after):
        done = []

        def write(batch, number):
            if stop_after is not None and len(done) >= stop_after:
                raise RuntimeError("the cap on micro-batches is reached")
            rows = [r["k"] for r in batch.collect()]
            done.append(rows)
            seen.append((number, rows))

        stream = tfrecord.read_record_stream(spark, str(folder), str(tmp_path / "arrivals"), "k long", max_bytes=1000)
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).start()

    size = sum(os.path.getsize(folder / n) for n in os.listdir(folder) if n.endswith(".tfrecords"))
    await_scored(run(2))
    put(spark, folder, "a", 300, 340, 2)  # sorts before what was read
    query = run(None)
    query.processAllAvailable()
    put(spark, folder, "c", 340, 350)
    query.processAllAvailable()
    query.stop()
    query = run(None)  # nothing new
    query.processAllAvailable()
    query.stop()
    numbers = [n for n, _ in seen]
    assert numbers == sorted(set(numbers)) and len(numbers) >= size // 1000
    assert sorted(k for _, rows in seen for k in rows) == list(range(350))
    assert max(len(rows) for _, rows in seen) <= 2 * 1000 / (size / 300)
    held = json.loads((tmp_path / "arrivals" / "part-0").read_text())
    assert [os.path.basename(p) for p, _ in held] == [f"b-{i:03d}.tfrecords" for i in range(3)]
    assert out is not None


def test_a_stream_needs_a_state(spark, tmp_path):
    put(spark, tmp_path / "in", "a", 0, 3)
    rows = spark.readStream.format("tfrecord").schema("k long").load(str(tmp_path / "in"))
    with pytest.raises(Exception, match="needs the option state"):
        rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "s")).start().processAllAvailable()


def test_batches_stay_open_over_micro_batches(spark, tmp_path, monkeypatch):
    """Rows of a batch come in different micro-batches and out of order; models and stretches are kept apart."""
    monkeypatch.setattr(running, "STRETCH", 2)
    order = [(k * 37) % 101 for k in range(101)]
    rows = [(m, p, float(p % 7), float(m), (p * 3 % 5) / 2, float(p % 2)) for m in (0, 1) for p in order]
    names = "model int, position long, age_xent double, gender_xent double, age_error double, gender_hit double"
    source = tmp_path / "in"
    for part in range(4):
        spark.createDataFrame(rows[part::4], names).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).parquet(str(source))
        running_metrics(stream, str(tmp_path / "sums"), str(tmp_path / "state"), ["model"], batch_rows=8).awaitTermination()
        seen = {(m, p): v for m, p, *v in (r for k in range(part + 1) for r in rows[k::4])}
        for r in read_running(spark, str(tmp_path / "sums"), ["model"]).collect():
            batches = {}
            for (m, p), v in seen.items():
                if m == r["model"]:
                    batches.setdefault(p // 8, []).append(v)
            mean = lambda i: sum(sum(v[i] for v in b) / len(b) for b in batches.values()) / len(batches)
            assert (r["n_batches"], r["n_rows"]) == (len(batches), sum(map(len, batches.values())))
            assert [r["mean_age_xent"], r["mean_gender_xent"], r["mean_error_age"], r["mean_gender_acc"]] == pytest.approx(
                [mean(i) for i in range(4)])
    # Full batches are no longer held.
    kept = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "open").load()
    assert kept.count() == 2


def test_files_grow_with_the_table_and_their_number_does_not(spark, tmp_path):
    from facetide.plans import queries_stream

    for name, low, rows in (("small", 0, 460), ("large", 0, 6000), ("far", 10**9, 3000)):
        vectors = spark.range(low, low + rows).select(
            F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.5).cast("float"), 64).alias("embedding"), (F.col("id") % 7).cast("int").alias("label"))
        vectors.write.parquet(str(tmp_path / name / "embeddings.parquet"))
        folder, sizes = str(tmp_path / f"{name}-files"), []
        for lot in (0, 1):
            queries_stream._arrive(spark, str(tmp_path / name), folder, lot)
            sizes.append(len([n for n in os.listdir(folder) if n.endswith(".tfrecords")]))
        assert sizes == ([2, 4] if rows < 1000 else [8, 16])
        found = tfrecord.read_records(spark, folder, schema="vec_id long", file_columns=True)
        assert sorted(r["vec_id"] for r in found.collect()) == list(range(low, low + rows))
        batches = found.groupBy(F.floor(F.col("vec_id") / 32)).agg(F.countDistinct("shard").alias("n"))
        assert batches.where("n = 2").count() >= rows // 160  # batches still lie in two files


def test_ids_with_wide_gaps_are_dealt_to_all_files(spark, tmp_path):
    from facetide.plans import queries_stream

    for name, gap in (("rounds", 2400), ("shifted", 16 * 2400), ("far", 10**12)):
        spark.range(600).select(
            (F.col("id") * gap + 150).alias("vec_id"), F.array_repeat(F.lit(0.5).cast("float"), 64).alias("embedding"),
            (F.col("id") % 7).cast("int").alias("label")).write.parquet(str(tmp_path / name / "embeddings.parquet"))
        folder = str(tmp_path / f"{name}-files")
        for lot in (0, 1):
            queries_stream._arrive(spark, str(tmp_path / name), folder, lot)
        found = tfrecord.read_records(spark, folder, schema="vec_id long", file_columns=True)
        sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
        assert len(sizes) == 16 and sum(sizes) == 600 and max(sizes) < 120
        assert sorted(r["vec_id"] for r in found.collect()) == [k * gap + 150 for k in range(600)]


@pytest.mark.parametrize("rows, low", [(100, 0), (100, 150), (310, 0)])
def test_the_first_run_ends_when_fewer_files_come_than_its_cap(spark, tmp_path, rows, low):
    import threading

    from facetide.plans import queries_stream

    spark.range(low, low + rows).select(
        F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.5).cast("float"), 64).alias("embedding"),
        (F.col("id") % 7).cast("int").alias("label")).write.parquet(str(tmp_path / "embeddings.parquet"))
    late = []

    def end():
        late.append(True)
        for query in spark.streams.active:
            query.stop()

    timer = threading.Timer(60, end)
    timer.start()
    try:
        found = queries_stream.stream_records(spark, str(tmp_path)).collect()
    finally:
        timer.cancel()
    assert not late and sorted(r["vec_id"] for r in found) == list(range(low, low + rows))


def test_the_state_has_no_more_parts_than_tasks_at_once(spark, tmp_path):
    names = "position long, age_xent double, gender_xent double, age_error double, gender_hit double"
    spark.range(100).selectExpr("id as position", *(f"cast(id as double) as {m}" for m in running.MEASURES)).coalesce(1).write.parquet(
        str(tmp_path / "in"))
    setting = spark.conf.get(running.PARTS)
    spark.conf.set(running.PARTS, "40")
    try:
        stream = spark.readStream.schema(names).parquet(str(tmp_path / "in"))
        running_metrics(stream, str(tmp_path / "sums"), str(tmp_path / "state")).awaitTermination()
        assert spark.conf.get(running.PARTS) == "40"
    finally:
        spark.conf.set(running.PARTS, setting)
    parts = [n for n in os.listdir(tmp_path / "state" / "state" / "0") if n.isdigit()]
    assert len(parts) == min(40, spark.sparkContext.defaultParallelism)
    assert read_running(spark, str(tmp_path / "sums")).first()["n_rows"] == 100
