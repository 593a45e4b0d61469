"""TFRecord files: checksums, messages, reading, splitting, writing."""

import os
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, LongType, StringType

from facetide.operators import images
from facetide.sources import crc32c, example, tfrecord
from facetide.sources.files import resolve


def slow_crc(data: bytes) -> int:
    reg = 0xFFFFFFFF
    for byte in data:
        reg ^= byte
        for _ in range(8):
            reg = (reg >> 1) ^ (0x82F63B78 if reg & 1 else 0)
    return reg ^ 0xFFFFFFFF


def test_known_checksums():
    assert crc32c.crc32c([b"123456789", b"", b"a", b"\x00" * 32, b"\xff" * 32]).tolist() == [
        0xE3069283, 0, 0xC1D04330, 0x8A9136AA, 0x62A8AB43
    ]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.binary(max_size=1500), min_size=1, max_size=10))
def test_checksums_of_mixed_lengths(rows):
    assert crc32c.crc32c(rows).tolist() == [slow_crc(r) for r in rows]
    lengths = np.array([len(r) for r in rows], dtype=np.uint64)
    assert crc32c.masked_of_words(lengths).tolist() == crc32c.mask(
        np.array([slow_crc(struct.pack("<Q", len(r))) for r in rows], np.uint32)).tolist()


values = st.one_of(
    st.tuples(st.just("int"), st.lists(st.integers(-(2**63), 2**63 - 1), max_size=5)),
    st.tuples(st.just("bytes"), st.lists(st.binary(max_size=300), max_size=3)),
    st.tuples(st.just("float"), st.lists(st.floats(width=32, allow_nan=False), max_size=5)),
)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text(max_size=8), values, max_size=5))
def test_messages_round_trip(features):
    data = example.encode([(name, kind, v) for name, (kind, v) in features.items()])
    assert example.decode(memoryview(data)) == {n: (k, list(v)) for n, (k, v) in features.items()}
    assert set(example.decode(data, {"a"})) == set(features) & {"a"}


def test_messages_match_the_protobuf_runtime():
    pb = pytest.importorskip("google.protobuf")
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    assert pb
    file = descriptor_pb2.FileDescriptorProto(name="example.proto", package="t", syntax="proto3")

    def message(name, *fields):
        added = file.message_type.add(name=name)
        for field, number, kind, label, of in fields:
            f = added.field.add(name=field, number=number, type=kind, label=label)
            if of:
                f.type_name = f".t.{of}"

    message("B", ("value", 1, 12, 3, None))
    message("F", ("value", 1, 2, 3, None))
    message("I", ("value", 1, 3, 3, None))
    message("Feature", ("b", 1, 11, 1, "B"), ("f", 2, 11, 1, "F"), ("i", 3, 11, 1, "I"))
    message("Entry", ("key", 1, 9, 1, None), ("value", 2, 11, 1, "Feature"))
    message("Features", ("feature", 1, 11, 3, "Entry"))
    message("Example", ("features", 1, 11, 1, "Features"))
    pool = descriptor_pool.DescriptorPool()
    pool.AddSerializedFile(file.SerializeToString())
    cls = message_factory.GetMessageClass(pool.FindMessageTypeByName("t.Example"))
    ours = [("age", "int", [5, -1, 2**62]), ("image", "bytes", [b"x" * 70000, b""]), ("score", "float", [1.5, -2.5])]
    theirs = cls.FromString(example.encode(ours))
    found = {e.key: (list(e.value.i.value), list(e.value.b.value), list(e.value.f.value))
             for e in theirs.features.feature}
    assert found == {"age": ([5, -1, 2**62], [], []), "image": ([], [b"x" * 70000, b""], []),
                     "score": ([], [], [1.5, -2.5])}
    assert example.decode(theirs.SerializeToString()) == {n: (k, v) for n, k, v in ours}


def test_unpacked_integers_are_read():
    # 08 01 08 02: two integers, each under its own key.
    entry = b"\x0a\x01a\x12\x06\x1a\x04\x08\x01\x08\x02"
    data = b"\x0a" + bytes([len(entry) + 2]) + b"\x0a" + bytes([len(entry)]) + entry
    assert example.decode(data) == {"a": ("int", [1, 2])}


def records(spark, n=60, parts=3):
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("age"), (F.col("id") % 2).alias("gender"),
        F.encode(F.repeat(F.lit("ab"), F.col("id").cast("int")), "UTF-8").alias("image_raw"),
        F.concat(F.lit("ä/"), F.col("id").cast("string")).alias("file_name"), (F.col("id") % 4).cast("int").alias("shard"),
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select("age", "gender", "image_raw", "file_name").collect())


@pytest.fixture
def written(spark, tmp_path):
    tfrecord.write_shards(records(spark), str(tmp_path), "train", 4)
    return str(tmp_path / "train")


def test_shards_hold_their_rows(spark, written):
    assert sorted(n for n in os.listdir(written)) == [f"train-{i:03d}.tfrecords" for i in range(4)]
    for i in range(4):
        ages = tfrecord.read_records(spark, f"{written}/train-{i:03d}.tfrecords").select("age").collect()
        assert sorted(r[0] for r in ages) == list(range(i, 60, 4))
    back = tfrecord.read_records(spark, written)
    assert back.rdd.getNumPartitions() == 4
    assert rows_of(back) == rows_of(records(spark))


def test_schema_from_the_first_record(spark, written):
    schema = tfrecord.infer_record_schema(spark, written)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "age": "bigint", "gender": "bigint", "image_raw": "binary", "file_name": "string"
    }
    text = tfrecord.infer_record_schema(spark, written, binary_features="file_name")
    assert {f.name: f.dataType.simpleString() for f in text}["image_raw"] == "string"


def test_raw_records_are_the_framed_bytes(spark, written):
    raw = tfrecord.read_raw_records(spark, written)
    ages = sorted(example.decode(r["value"])["age"][1][0] for r in raw.collect())
    assert ages == list(range(60))


def test_lists_floats_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.5, 2.5], ["a", "b"], None), (2, [0.5, 1.0], ["c", "d"], "x")],
                               "k int, f array<float>, s array<string>, maybe string")
    df.coalesce(1).write.format("tfrecord").mode("append").save(str(tmp_path / "r"))
    back = tfrecord.read_records(spark, str(tmp_path / "r"), schema=df.schema, mode="PERMISSIVE")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert tfrecord.infer_record_schema(spark, str(tmp_path / "r")).simpleString() == (
        "struct<f:array<float>,k:bigint,s:array<string>>"
    )
    with pytest.raises(Exception, match="record lacks the feature maybe"):
        tfrecord.read_records(spark, str(tmp_path / "r"), schema=df.schema).collect()
    back = tfrecord.read_records(spark, str(tmp_path / "r"), schema="k long, maybe string", optional="maybe")
    assert sorted((r["k"], r["maybe"]) for r in back.collect()) == [(1, None), (2, "x")]
    with pytest.raises(Exception, match="holds float values"):
        tfrecord.read_records(spark, str(tmp_path / "r"), schema="f string").collect()
    with pytest.raises(Exception, match="holds 2 values, not one"):
        tfrecord.read_records(spark, str(tmp_path / "r"), schema="f float").collect()


@pytest.mark.parametrize("split_bytes", [1, 100, 1000, 5000, 0])
def test_one_file_in_parts(spark, tmp_path, split_bytes):
    tfrecord.write_single(records(spark).drop("shard"), str(tmp_path), "all")
    assert os.listdir(tmp_path) == ["all.tfrecords"]
    size = os.path.getsize(tmp_path / "all.tfrecords")
    back = tfrecord.read_records(spark, str(tmp_path / "all.tfrecords"), splitBytes=max(split_bytes, size // 50) if split_bytes else 0)
    assert (back.rdd.getNumPartitions() > 1) == (0 < split_bytes)
    assert rows_of(back) == rows_of(records(spark))


def test_records_longer_than_a_block(tmp_path, monkeypatch):
    monkeypatch.setattr(tfrecord, "BLOCK_BYTES", 64)
    rng = np.random.default_rng(0)
    data = [rng.bytes(int(n)) for n in rng.integers(0, 900, 40)]
    path = tmp_path / "f"
    path.write_bytes(frames(data))
    whole = tfrecord._Frames(str(path), path.stat().st_size)
    assert [bytes(d) for block in whole.records(0, whole.size, True) for d in block] == data
    for pieces in (2, 7, 100):
        cuts = [whole.size * i // pieces for i in range(pieces + 1)]
        got = [bytes(d) for a, b in zip(cuts, cuts[1:]) for block in whole.records(a, b, True) for d in block]
        assert got == data


def frames(rows) -> bytes:
    def mask(crc):
        return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF

    out = b""
    for r in rows:
        head = struct.pack("<Q", len(r))
        out += head + struct.pack("<I", mask(slow_crc(head))) + r + struct.pack("<I", mask(slow_crc(r)))
    return out


def cuts(size, n):
    return [size * i // n for i in range(n + 1)]


@pytest.mark.parametrize("indexed", [False, True])
def test_records_within_records_are_read_alike_however_they_are_cut(tmp_path, indexed, monkeypatch):
    monkeypatch.setattr(tfrecord, "INDEX_BYTES", 100)
    inner = frames([b"inner record"] * 50)
    held = [b"first", inner, b"", frames([inner, b"x"]), b"last"]
    path = tmp_path / "f"
    path.write_bytes(frames(held))
    if indexed:
        marks = tfrecord.Marks()
        for h in held:
            marks.add([len(h)])
        assert marks.size == path.stat().st_size and marks.records == 5
        (tmp_path / "_f.index").write_bytes(marks.text())
        assert tfrecord.frame_starts(str(path), marks.size) == marks.starts and 1 < len(marks.starts) < 5
    whole = tfrecord._Frames(str(path), path.stat().st_size)
    for n in (1, 2, 3, 10, 700):
        got = [bytes(d) for a, b in zip(cuts(whole.size, n), cuts(whole.size, n)[1:])
               for block in whole.records(a, b, True) for d in block]
        assert got == held


def test_an_index_of_another_file_is_not_used(tmp_path):
    path = tmp_path / "f"
    path.write_bytes(frames([b"a" * 50, b"b" * 70]))
    (tmp_path / "_f.index").write_bytes(b'{"size": 3, "records": 1, "starts": [0, 99]}')
    whole = tfrecord._Frames(str(path), path.stat().st_size)
    assert whole.first(1) == 66 and [bytes(d) for x in whole.records(1, whole.size, True) for d in x] == [b"b" * 70]


def test_the_sink_writes_indexes_and_removes_old_ones(spark, tmp_path, monkeypatch):
    from facetide.sources.files import read_bytes

    base = str(tmp_path / "train")
    wide = records(spark, 9, 1).withColumn("image_raw", F.encode(F.repeat(F.lit("x"), 700_000), "UTF-8"))
    tfrecord.write_shards(wide.withColumn("shard", F.lit(0)), str(tmp_path), "train", 1)
    assert sorted(os.listdir(base)) == ["_train-000.tfrecords.index", "train-000.tfrecords"]
    held = tfrecord.json.loads(read_bytes(f"{base}/_train-000.tfrecords.index"))
    assert held["size"] == os.path.getsize(f"{base}/train-000.tfrecords") and held["records"] == 9
    assert len(held["starts"]) == 2
    back = tfrecord.read_records(spark, base, columns=["age"], splitBytes=1 << 20)
    assert back.rdd.getNumPartitions() == 7 and sorted(r["age"] for r in back.collect()) == list(range(9))
    tfrecord.write_shards(records(spark, 10).withColumn("shard", F.lit(0)), str(tmp_path), "train", 1)
    assert os.listdir(base) == ["train-000.tfrecords"]


def test_index_records_of_files_from_elsewhere(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    sizes = {"a": 40, "b": 3, "c": 0}
    for name, n in sizes.items():
        (tmp_path / f"{name}.tfrecords").write_bytes(frames([rng.bytes(int(k)) for k in rng.integers(0, 3000, n)]))
    small = (tmp_path / "a.tfrecords").read_bytes()
    big = small * 150
    (tmp_path / "big.tfrecords").write_bytes(big)
    for _ in range(2):  # the second time by the indexes
        got = {r["file"]: (r["bytes"], r["records"]) for r in tfrecord.index_records(spark, str(tmp_path)).collect()}
        assert got == {f"{n}.tfrecords": (os.path.getsize(tmp_path / f"{n}.tfrecords"), k) for n, k in sizes.items()} | {
            "big.tfrecords": (len(big), 40 * 150)}
    assert len(big) > tfrecord.INDEX_BYTES and "_big.tfrecords.index" in os.listdir(tmp_path)
    raw = tfrecord.read_raw_records(spark, str(tmp_path / "big.tfrecords"), splitBytes=1 << 20)
    assert raw.rdd.getNumPartitions() > 5 and raw.count() == 6000


def test_walks_read_heads_only(tmp_path):
    path = tmp_path / "f"
    path.write_bytes(frames([b"x" * 50_000] * 20))

    class Counting:
        def __init__(self, file):
            self.file, self.read = file, 0

        def read_at(self, n, at):
            self.read += n
            return self.file.read_at(n, at)

    whole = tfrecord._Frames(str(path), path.stat().st_size)
    whole.file = Counting(whole.file)
    assert whole.first(whole.size - 5) == whole.size and whole.file.read <= 21 * 4096


@pytest.mark.parametrize("damage, message", [
    (lambda b: b[:-3], "truncated"), (lambda b: b[:5], "truncated"),
    (lambda b: b[:3] + b"\x01" + b[4:], "length|truncated"), (lambda b: b[:14] + bytes([b[14] ^ 1]) + b[15:], "corrupted record data"),
])
def test_damaged_files_are_errors(spark, tmp_path, damage, message):
    good = frames([example.encode([("age", "int", [i])]) for i in range(3)])
    (tmp_path / "bad.tfrecords").write_bytes(damage(good))
    with pytest.raises(Exception, match=message):
        tfrecord.read_records(spark, str(tmp_path), schema="age long").collect()


def test_unchecked_data_can_be_asked_for(spark, tmp_path):
    good = bytearray(frames([example.encode([("age", "int", [7])])]))
    good[-1] ^= 1
    (tmp_path / "odd.tfrecords").write_bytes(bytes(good))
    assert tfrecord.read_records(spark, str(tmp_path), schema="age long", verifyData="false").first()["age"] == 7


kinds_of = {"i": LongType(), "f": FloatType(), "b": BinaryType(), "s": StringType(), "li": ArrayType(LongType()),
            "lf": ArrayType(FloatType())}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.permutations(["i", "f", "b", "s", "li", "lf", "other"]), st.integers(-(2**63), 2**63 - 1),
                          st.floats(width=32, allow_nan=False), st.binary(max_size=300), st.text(max_size=5),
                          st.lists(st.integers(-(2**63), 2**63 - 1), max_size=4),
                          st.lists(st.floats(width=32, allow_nan=False), max_size=4), st.integers(0, 6)), min_size=1, max_size=12))
def test_blocks_decode_as_single_messages_do(rows):
    """Features in any order, some missing, some of another kind or number: the same values, or the same error."""
    import pyarrow as pa

    messages = []
    for order, i, f, b, s, li, lf, odd in rows:
        values = {"i": ("int", [i]), "f": ("float", [f]), "b": ("bytes", [b]), "s": ("bytes", [s.encode()]), "li": ("int", li),
                  "lf": ("float", lf), "other": ("bytes", [b"x", b""])}
        if odd == 1:
            del values["b"]
        messages.append(example.encode([(n, *values[n]) for n in order if n in values]))
    fields = [(name, kind, False) for name, kind in kinds_of.items()]
    kinds = [pa.int64(), pa.float32(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.float32())]
    ends = np.cumsum([len(m) for m in messages]).tolist()
    got = tfrecord.decoded(memoryview(b"".join(messages)), [0, *ends[:-1]], ends, fields, kinds)
    for (name, kind, required), column in zip(fields, got):
        one = [tfrecord._cell(example.decode(m).get(name), name, kind, required) for m in messages]
        assert column.to_pylist() == tfrecord._column(pa, one, column.type).to_pylist()


def test_odd_messages_are_left_to_the_parser_of_single_ones():
    import pyarrow as pa

    entry = b"\x0a\x01a\x12\x06\x1a\x04\x08\x01\x08\x02"  # unpacked integers
    unpacked = b"\x0a" + bytes([len(entry) + 2]) + b"\x0a" + bytes([len(entry)]) + entry
    plain = example.encode([("a", "int", [7])])
    twice = example.encode([("a", "int", [1]), ("a", "int", [2])])
    held = [plain, unpacked[:0], twice, plain]
    ends = np.cumsum([len(h) for h in held]).tolist()
    field = [("a", LongType(), False)]
    got = tfrecord.decoded(memoryview(b"".join(held)), [0, *ends[:-1]], ends, field, [pa.int64()])
    assert got[0].to_pylist() == [7, None, 2, 7]
    with pytest.raises(ValueError, match="holds 2 values, not one"):
        tfrecord.decoded(memoryview(unpacked), [0], [len(unpacked)], field, [pa.int64()])
    with pytest.raises(ValueError, match="truncated|index"):
        tfrecord.decoded(memoryview(plain[:-2]), [0], [len(plain) - 2], field, [pa.int64()])


def test_filters_on_file_columns_choose_the_files(spark, written, tmp_path):
    back = tfrecord.read_records(spark, written, file_columns=True)
    assert back.columns[-3:] == ["file", "split", "shard"]
    assert {(r["file"], r["split"], r["shard"], r["age"] % 4) for r in back.collect()} == {
        (f"train-{i:03d}.tfrecords", "train", i, i) for i in range(4)}
    cases = [(F.col("shard") == 2, [2]), (F.col("shard").isin(0, 3), [0, 3]), (~(F.col("shard") >= 1), [0]),
             (F.col("file") == "train-001.tfrecords", [1]), ((F.col("shard") > 0) & (F.col("split") == "train"), [1, 2, 3]),
             (F.col("file").endswith("2.tfrecords"), [2]), (F.col("shard").isNull(), []), (F.col("split") == "test", [])]
    for given, shards in cases:
        chosen = back.where(given)
        assert chosen.rdd.getNumPartitions() == max(1, len(shards))
        assert sorted(r["age"] for r in chosen.collect()) == sorted(a for a in range(60) if a % 4 in shards)
    mixed = back.where((F.col("shard") == 2) & (F.col("age") < 20))
    assert mixed.rdd.getNumPartitions() == 1 and sorted(r["age"] for r in mixed.collect()) == [2, 6, 10, 14, 18]
    (tmp_path / "train" / "train-001.tfrecords").write_bytes(b"broken")
    assert back.where("shard = 2").count() == 15


def test_raw_records_decode_in_place(spark):
    rows = [(1, example.encode([("a", "int", [5])])), (2, None), (3, example.encode([("b", "int", [1])]))]
    df = spark.createDataFrame(rows, "k int, value binary")
    got = tfrecord.decode_records(df, "a long", permissive=True)
    assert sorted(map(tuple, got.collect())) == [(1, 5), (2, None), (3, None)]
    with pytest.raises(Exception, match="record lacks the feature a"):
        tfrecord.decode_records(df, "a long").collect()


def test_empty_files_and_directories(spark, tmp_path):
    (tmp_path / "empty.tfrecords").write_bytes(b"")
    (tmp_path / "_SUCCESS").write_bytes(b"x")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "x.tfrecords").write_bytes(b"not read")
    assert tfrecord.read_records(spark, str(tmp_path), schema="age long").count() == 0
    with pytest.raises(Exception, match="give a schema"):
        tfrecord.read_records(spark, str(tmp_path)).count()


def test_overwrite_and_append(spark, tmp_path):
    base = str(tmp_path)
    tfrecord.write_shards(records(spark), base, "train", 4)
    tfrecord.write_shards(records(spark, 10).withColumn("shard", F.lit(0)), base, "train", 1)
    assert os.listdir(f"{base}/train") == ["train-000.tfrecords"]
    again = records(spark, 10).drop("shard").coalesce(1).write.format("tfrecord").mode("append").option("split", "train")
    with pytest.raises(Exception, match="already has train-000"):
        again.save(f"{base}/train")
    assert os.listdir(f"{base}/train") == ["train-000.tfrecords"]
    again.option("split", "more").save(f"{base}/train")
    assert tfrecord.read_records(spark, f"{base}/train").count() == 20


def test_failed_writes_leave_nothing(spark, tmp_path):
    tfrecord.register(spark)
    bad = records(spark).withColumn("age", F.when(F.col("age") == 50, F.raise_error(F.lit("stop"))).otherwise(F.col("age")))
    with pytest.raises(Exception, match="stop"):
        bad.drop("shard").write.format("tfrecord").mode("append").save(str(tmp_path / "out"))
    assert not [n for _, _, names in os.walk(tmp_path / "out") for n in names]
    with pytest.raises(Exception, match="two tasks wrote"):
        tfrecord.write_shards(records(spark).withColumn("shard", F.lit(0)), str(tmp_path), "train", 1, partitioned=True)
    assert not [n for _, _, names in os.walk(tmp_path / "train") for n in names]


def test_named_columns_only(spark, tmp_path):
    tfrecord.write_single(records(spark).drop("shard"), str(tmp_path), "all")
    back = tfrecord.read_records(spark, str(tmp_path), columns=["age"])
    assert back.columns == ["age"] and "image_raw" not in back._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["age"] for r in back.collect()) == sorted(r["age"] for r in records(spark).collect())


def test_paths_without_a_scheme_are_on_the_default_file_system(spark, tmp_path):
    from facetide.sources.files import default_root, qualified, qualified_in

    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and default_root(spark) == "file:"
    assert qualified_in("/a/b", "hdfs://host:1") == "hdfs://host:1/a/b" and qualified_in("s3://x/y", "file:") == "s3://x/y"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.named.link./here", f"file:{tmp_path}")
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "viewfs://named/")
        assert qualified(spark, "/here/x") == "viewfs://named/here/x" and default_root(spark) == "viewfs://named"
    finally:
        conf.set("fs.defaultFS", before)


def test_a_large_single_set_is_cut(spark, tmp_path):
    tfrecord.write_single(records(spark).drop("shard"), str(tmp_path / "one"), "x", file_bytes=500)
    assert len([n for n in os.listdir(tmp_path / "one") if n.startswith("x-")]) > 1
    assert rows_of(tfrecord.read_records(spark, str(tmp_path / "one"))) == rows_of(records(spark))


def test_the_single_file_query_reads_a_set_that_was_cut(spark, sf_dir, monkeypatch):
    from facetide.plans import queries_records

    whole = sorted(queries_records.single_file(spark, sf_dir).collect())
    monkeypatch.setattr(tfrecord.write_single, "__defaults__", (500,))
    assert sorted(queries_records.single_file(spark, sf_dir).collect()) == whole


def test_paths_of_all_kinds(tmp_path):
    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        system, path = resolve(uri)
        assert path == str(tmp_path) and system.type_name == "local"


def test_map_images_keeps_single_faces(spark):
    df = records(spark, 8)
    out = images.map_images(df, lambda data: [data[:1]] * (len(data) // 2 % 3))
    assert sorted((r["age"], bytes(r["image_raw"])) for r in out.collect()) == [(1, b"a"), (4, b"a"), (7, b"a")]
