"""Queries over records: writing and reading TFRecord and Parquet, bytes to numbers, mapped images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.functions import decode_raw, image_tensor
from facetide.operators import images, prep, sampling
from facetide.plans.prepare import prepare, sharded
from facetide.plans.queries_prepare import export_images
from facetide.plans.views import CLEAN, EXAMPLE
from facetide.session import scratch_path
from facetide.sources import tables, tfrecord

SHAPE = (2, 2, 3)
SHARDS = 4


def _written(spark: SparkSession, sf_dir: str) -> str:
    """The example records in four shards; returns their directory."""
    base = scratch_path(spark, "records")
    numbered = sampling.number_shuffled(fixtures.example(spark, sf_dir), "file_name")
    tfrecord.write_shards(
        sampling.assign_shards(numbered, SHARDS).drop("pos", "total"), base, "train", SHARDS
    )
    return f"{base}/train"


@query("tfrecord_roundtrip", f"with {EXAMPLE} select age, gender, md5(image_raw) as digest, file_name from example")
def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tfrecord.read_records(spark, _written(spark, sf_dir))
    return back.select("age", "gender", F.md5("image_raw").alias("digest"), "file_name")


@query("tfrecord_single", f"with {EXAMPLE} select age, gender, md5(image_raw) as digest from example")
def single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-feature records in one file (several, if they are many), read in parts: a file is cut wherever a task's share
    ends."""
    base = scratch_path(spark, "records")
    tfrecord.write_single(prep.to_example(fixtures.example(spark, sf_dir).drop("file_name")), base, "train")
    back = tfrecord.read_records(spark, base, splitBytes=16384)
    return back.select("age", "gender", F.md5("image_raw").alias("digest"))


@query("tfrecord_pruned", "select doc_id % 101 as age from documents")
def pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfrecord.read_records(spark, _written(spark, sf_dir), schema="age long")


@query("tfrecord_schema", """
select 'bigint' as age, 'bigint' as gender, 'binary' as image_raw, 'string' as file_name, count(*) as n from documents
""")
def inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred from the first record, with the number of records that agree with them."""
    back = tfrecord.read_records(spark, _written(spark, sf_dir))
    types = [F.typeof(c).alias(c) for c in ("age", "gender", "image_raw", "file_name")]
    return back.groupBy(*types).agg(F.count(F.lit(1)).alias("n"))


@query("tfrecord_optional", f"with {EXAMPLE} select age, cast(null as varchar) as caption from example")
def optional_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature no record has: null in permissive mode, where strict mode fails."""
    return tfrecord.read_records(
        spark, _written(spark, sf_dir), schema="age long, caption string", mode="PERMISSIVE"
    )


@query("raw_records", "select count(*) as n, count(distinct doc_id) as n_distinct from documents")
def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tfrecord.read_raw_records(spark, _written(spark, sf_dir))
    return raw.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.md5("value")).alias("n_distinct"))


@query("record_files", f"""
with r as (
  select row_number() over (order by md5(concat('2017|src/', cast(doc_id as varchar), '.jpg'))) - 1 as pos,
    count(*) over () as n, doc_id % 101 as age
  from documents)
select printf('train-%03d.tfrecords', ((pos + 1) * {SHARDS} - 1) // n) as file, count(*) as n, cast(sum(age) as bigint) as ages
from r group by 1
""")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each shard file holds, read file by file."""
    from functools import reduce

    from facetide.functions import shard_name

    folder = _written(spark, sf_dir)
    per_file = [
        tfrecord.read_records(spark, f"{folder}/train-{i:03d}.tfrecords", schema="age long").withColumn(
            "file", shard_name("train", F.lit(i))
        )
        for i in range(SHARDS)
    ]
    every = reduce(lambda a, b: a.unionByName(b), per_file)
    return every.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("age").alias("ages"))


@query("tfrecord_one_shard", f"""
with r as (
  select row_number() over (order by md5(concat('2017|src/', cast(doc_id as varchar), '.jpg'))) - 1 as pos,
    count(*) over () as n, doc_id
  from documents),
s as (select cast(((pos + 1) * {SHARDS} - 1) // n as int) as shard, doc_id from r)
select printf('train-%03d.tfrecords', shard) as file, 'train' as split, shard, doc_id % 101 as age,
  concat('src/', cast(doc_id as varchar), '.jpg') as file_name
from s where shard in (1, 3) and shard >= 2
""")
def one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters on shard and split reach the source: of the files, only those that pass are opened."""
    back = tfrecord.read_records(spark, _written(spark, sf_dir), file_columns=True)
    chosen = back.where((F.col("split") == "train") & F.col("shard").isin(1, 3) & (F.col("shard") >= 2))
    return chosen.select("file", "split", "shard", "age", "file_name")


@query("record_index", f"""
with r as (
  select row_number() over (order by md5(concat('2017|src/', cast(doc_id as varchar), '.jpg'))) - 1 as pos,
    count(*) over () as n
  from documents)
select printf('train-%03d.tfrecords', ((pos + 1) * {SHARDS} - 1) // n) as file, count(*) as records from r group by 1
""")
def record_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each file, counted by walking over the frames' lengths."""
    return tfrecord.index_records(spark, _written(spark, sf_dir)).select("file", "records")


@query("tfrecord_nested", f"with {EXAMPLE} select age, gender, md5(image_raw) as digest, file_name from example")
def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that hold whole record files, in a file cut into many parts, most of which begin within such a record."""
    base = scratch_path(spark, "records")
    files = spark.read.format("binaryFile").load(f"{_written(spark, sf_dir)}/train-*.tfrecords")
    outer = files.select(F.length("content").alias("age"), F.lit(0).alias("gender"), F.col("content").alias("image_raw"))
    tfrecord.write_single(outer, base, "outer")
    back = tfrecord.read_records(spark, base, columns=["image_raw"], splitBytes=16384)
    inner = tfrecord.unnest_records(back, "image_raw")
    return tfrecord.decode_records(inner, "age long, gender long, image_raw binary, file_name string").select(
        "age", "gender", F.md5("image_raw").alias("digest"), "file_name")


@query("prepared_parquet", f"""
with {CLEAN},
r as (select *, row_number() over (order by md5(concat('2017|', source, '|', file_name))) - 1 as all_pos,
        count(*) over () as n from aged),
s as (select *, case when all_pos < ceil(n * 0.2) then 'test' else 'train' end as split from r),
k as (select *, row_number() over (partition by split order by all_pos) - 1 as pos, count(*) over (partition by split) as total
      from s where not (face_score < 0.75) and age between 0 and 100 and gender is not null and not isnan(gender))
select file_name, cast(age as bigint) as age, cast(gender as bigint) as gender, split,
  cast(((pos + 1) * case when split = 'test' then 2 else 6 end - 1) // total as int) as shard
from k
""")
def prepared_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, gated and sharded metadata, written by split and shard and read back."""
    path = scratch_path(spark, "prepared")
    plans = sharded(fixtures.face_meta(spark, sf_dir), test_size=0.2, n_shards=6)
    rows = plans["train"][0].unionByName(plans["test"][0])
    tables.write_prepared(prep.to_example(rows, "split", "shard"), path, 6)
    return tables.read_prepared(spark, path).select("file_name", "age", "gender", "split", "shard")


@query("prepare_records", f"""
with {CLEAN},
r as (select *, row_number() over (order by md5(concat('2017|', source, '|', file_name))) - 1 as all_pos,
        count(*) over () as n from aged)
select case when all_pos < ceil(n * 0.2) then 'test' else 'train' end as split, r.file_name,
  cast(r.age as bigint) as age, cast(r.gender as bigint) as gender, md5(d.text) as digest
from r join documents d on r.doc_id = d.doc_id
where not (face_score < 0.75) and age between 0 and 100 and gender is not null and not isnan(gender)
  and r.doc_id % 10 <> 0 and d.text not like 'A%'
""")
def prepare_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and image files to training and test records, with a detector that finds no face in some."""
    base, out = export_images(spark, sf_dir), scratch_path(spark, "records")
    meta = fixtures.face_meta(spark, sf_dir)
    folders = {f"src{i}": "" for i in range(20)}
    prepare(meta, base, out, test_size=0.2, n_shards=6, folders=folders,
            detect=lambda data: [] if data.startswith(b"A") else [data])
    parts = [
        tfrecord.read_records(spark, f"{out}/{split}").withColumn("split", F.lit(split))
        for split in ("train", "test")
    ]
    return parts[0].unionByName(parts[1]).select(
        "split", "file_name", "age", "gender", F.md5("image_raw").alias("digest")
    )


@query("decode_raw", f"""
with {EXAMPLE}, bytes as (select file_name, substr(md5(text), 1, 12) as s from example)
select file_name, cast(i as int) as i, cast(ascii(substr(s, cast(i as int) + 1, 1)) as smallint) as v
from bytes, range(12) t(i)
""")
def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.example(spark, sf_dir).select(
        "file_name", F.posexplode(decode_raw("image_raw", SHAPE)).alias("i", "v")
    )


@query("image_tensor", f"""
with {EXAMPLE}, bytes as (select file_name, substr(md5(text), 1, 12) as s from example),
px as (select file_name, i, cast(ascii(substr(s, cast(i // 3 * 3 + 2 - i % 3 as int) + 1, 1)) as double) as x
       from bytes, range(12) t(i)),
st as (select file_name, avg(x) as mu, greatest(stddev_pop(x), 1 / sqrt(12)) as sd from px group by 1)
select file_name, cast(i as int) as i, round((x - mu) / sd, 2) as v from px join st using (file_name)
""")
def tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.example(spark, sf_dir).select(
        "file_name", F.posexplode(image_tensor("image_raw", SHAPE)).alias("i", "v")
    ).withColumn("v", F.round(F.col("v").cast("double"), 2))


@query("map_images", f"""
with {EXAMPLE}
select file_name, substr(md5(text), 2, 3) as crop from example
where substr(md5(text), 1, 1) = '1'
""")
def mapped_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector that reads the number of faces from the first byte and crops the bytes after it."""
    def detect(data: bytes) -> list[bytes]:
        faces = int(chr(data[0]), 16)
        return [data[1 + 3 * k:4 + 3 * k] for k in range(faces)]

    found = images.map_images(fixtures.example(spark, sf_dir), detect)
    return found.select("file_name", F.decode("image_raw", "UTF-8").alias("crop"))


@query("map_records", f"with {EXAMPLE} select file_name, octet_length(image_raw) as n_bytes, age + 1 as next_age from example")
def mapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fn(frames):
        for frame in frames:
            yield frame.assign(n_bytes=frame.image_raw.str.len(), next_age=frame.age + 1)[
                ["file_name", "n_bytes", "next_age"]
            ]

    return images.map_records(fixtures.example(spark, sf_dir), fn, "file_name string, n_bytes long, next_age long")
