"""Queries over metadata: ages, gates, corpora, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.functions import age_at, corpus_dir, image_path, serial_to_date
from facetide.operators import images, prep
from facetide.plans.views import AGED, CLEAN, DETECTIONS, FACE_META, IMAGE_FILES, SCORES
from facetide.session import scratch_path, ship
from facetide.sources.files import list_files
from facetide.sources.tables import read_meta


SCORE_FIELDS = ("gender", "face_score", "second_face_score")


def plain_scores(df: DataFrame) -> DataFrame:
    """NaN and infinity, as engines write them alike."""
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).when(F.abs(c) == float("inf"), F.lit(-999.0)).otherwise(F.col(c))
                           for c in SCORE_FIELDS})


@query("age_from_serial", f"with {AGED} select doc_id, cast(birth as varchar) as birth, age from aged")
def age_from_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.face_meta(spark, sf_dir).select(
        "doc_id",
        serial_to_date("dob").cast("string").alias("birth"),
        age_at("photo_taken", "dob").alias("age"),
    )


@query("clean_faces", f"""
with {CLEAN}
select file_name, source, cast(age as bigint) as age, cast(gender as bigint) as gender from kept
""")
def clean_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixtures.face_meta(spark, sf_dir)
    return prep.to_example(prep.clean(prep.with_age(meta)), "source")


@query("second_face_gate", f"""
with {CLEAN}
select file_name, cast(age as bigint) as age, cast(gender as bigint) as gender from kept
where isnan(second_face_score) or not (second_face_score > 0)
""")
def second_face_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.to_example(prep.clean(prep.with_age(fixtures.face_meta(spark, sf_dir)), second_face=True))


@query("reject_reasons", f"""
with {AGED}, {DETECTIONS},
n as (select doc_id, count(*) as n_det from detections group by doc_id)
select a.source,
  case when face_score < 0.75 then 'score' when age not between 0 and 100 then 'age'
       when gender is null or isnan(gender) then 'gender'
       when coalesce(n_det, 0) <> 1 then 'detection' else 'kept' end as reason,
  count(*) as n
from aged a left join n on a.doc_id = n.doc_id group by 1, 2
""")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fixtures.detections(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_det"))
    meta = prep.with_age(fixtures.face_meta(spark, sf_dir)).join(counts, "doc_id", "left")
    reason = F.coalesce(prep.reject_reason(n_detections="n_det"), F.lit("kept"))
    return meta.groupBy("source", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("explode_parallel", f"""
with {FACE_META} select source, file_name, dob, photo_taken, doc_id, {SCORES} from face_meta
""")
def explode_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of up to a hundred rows per source and key range, and back to rows."""
    fields = ["file_name", "dob", "photo_taken", "doc_id", *SCORE_FIELDS]
    packed = (
        fixtures.face_meta(spark, sf_dir)
        .groupBy("source", F.expr("doc_id div 100").alias("part"))
        .agg(F.collect_list(F.struct(*fields)).alias("rows"))
        .select("source", *(F.col(f"rows.{f}").alias(f) for f in fields))
    )
    return plain_scores(prep.explode_parallel(packed, fields))


@query("union_corpora", f"""
with {FACE_META}
select doc_id, case when doc_id % 3 = 0 then 'wiki' else 'imdb' end as source,
  concat('/data/', case when doc_id % 3 = 0 then 'wiki' else 'imdb' end, '_crop/', file_name) as path
from face_meta
""")
def union_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixtures.face_meta(spark, sf_dir).drop("source")
    wiki = meta.filter("doc_id % 3 = 0").withColumn("source", F.lit("wiki"))
    imdb = meta.filter("doc_id % 3 <> 0").withColumn("source", F.lit("imdb"))
    both = prep.union_corpora(imdb, wiki)
    return both.select(
        "doc_id", "source", image_path(corpus_dir("/data", "source"), "file_name").alias("path")
    )


@query("missing_files", f"""
with {FACE_META}, {IMAGE_FILES}
select doc_id, file_name as path from face_meta where file_name not in (select path from image_files)
""")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixtures.face_meta(spark, sf_dir).withColumnRenamed("file_name", "path")
    return images.missing_files(meta, fixtures.image_files(spark, sf_dir)).select("doc_id", "path")


@query("attach_files", f"""
with {FACE_META}, {IMAGE_FILES}
select m.doc_id, m.file_name as path, f.length from face_meta m join image_files f on m.file_name = f.path
""")
def attach_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixtures.face_meta(spark, sf_dir).withColumnRenamed("file_name", "path")
    return images.attach_files(meta, fixtures.image_files(spark, sf_dir)).select("doc_id", "path", "length")


#: Tasks that make files in one folder wait for each other.
FOLDERS = 256


def _image_at(base: str, folders: int) -> F.Column:
    doc = F.col("doc_id")
    name = fixtures.file_name(doc)
    return image_path(base, F.concat_ws("/", F.pmod(doc, F.lit(folders)).cast("string"), name) if folders > 1 else name)


def export_images(spark: SparkSession, sf_dir: str, folders: int = 1) -> str:
    """Write each document's text as a file, leaving out one of ten; returns the base directory. With ``folders`` the files are
    spread over so many."""
    ship(spark)
    base = scratch_path(spark, "images")
    rows = fixtures.table(spark, sf_dir, "documents").filter("doc_id % 10 <> 0").select(
        _image_at(base, folders).alias("path"), "text"
    )

    def write(batches):
        from facetide.sources.files import resolve

        made = set()
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                system, inner = resolve(path)
                folder = inner.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(inner) as stream:
                    stream.write(text.encode())
        yield from ()

    rows.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    return base


@query("attach_bytes", """
select doc_id, doc_id % 10 = 0 as missing,
  case when doc_id % 10 <> 0 then md5(text) end as digest
from documents
""")
def attach_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = export_images(spark, sf_dir, FOLDERS)
    meta = fixtures.table(spark, sf_dir, "documents").select("doc_id", _image_at(base, FOLDERS).alias("path"))
    tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
    attached = images.with_missing_flag(images.attach_bytes(meta, num_partitions=tasks))
    return attached.select("doc_id", "missing", F.md5("image_raw").alias("digest"))


@query("list_files", """
select concat('src/', cast(doc_id as varchar), '.jpg') as path, cast(octet_length(encode(text)) as bigint) as length
from documents where doc_id % 10 <> 0
""")
def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = export_images(spark, sf_dir)
    return list_files(spark, f"{base}/src").select(
        F.regexp_extract("path", "(src/[^/]*)$", 1).alias("path"), "length"
    )


@query("required_features", "select doc_id, lang, source from documents")
def required_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that must be there: a null would stop the job."""
    return prep.require(
        fixtures.table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "lang", "source"
    )


@query("exactly_one", f"""
with {FACE_META}, {DETECTIONS}
select doc_id, file_name from face_meta
where doc_id in (select doc_id from detections group by doc_id having count(*) = 1)
""")
def exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixtures.face_meta(spark, sf_dir)
    return prep.exactly_one(meta, fixtures.detections(spark, sf_dir), "doc_id").select("doc_id", "file_name")


@query("prep_report", f"""
with {CLEAN}
select source, count(*) filter (doc_id % 10 = 0) as missing, count(*) filter (doc_id % 10 <> 0) as valid
from kept group by source
""")
def prep_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = prep.clean(prep.with_age(fixtures.face_meta(spark, sf_dir)))
    files = fixtures.image_files(spark, sf_dir).withColumnRenamed("path", "file_name")
    return prep.prep_report(meta.join(files, "file_name", "left"), ["source"], F.col("length").isNull())


@query("read_meta", f"""
with {FACE_META}
select file_name, dob, photo_taken, {SCORES},
  case when doc_id % 2 = 0 then 'even' else 'odd' end as source
from face_meta
""")
def read_meta_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the metadata written and read as Parquet, half as CSV."""
    meta = fixtures.face_meta(spark, sf_dir)
    fields = ["file_name", "dob", "photo_taken", "gender", "face_score", "second_face_score"]
    even, odd = scratch_path(spark, "meta"), scratch_path(spark, "meta")
    meta.filter("doc_id % 2 = 0").select(*fields).write.parquet(even)
    meta.filter("doc_id % 2 = 1").select(*fields).write.csv(odd, header=True)
    both = prep.union_corpora(
        read_meta(spark, even, "even"), read_meta(spark, odd, "odd", "csv", header=True)
    )
    return plain_scores(both.select("file_name", "dob", "photo_taken", *SCORE_FIELDS, "source"))


@query("row_counts", """
select 'documents' as name, count(*) as n from documents union all select 'labels', count(*) from labels
""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def counted(name: str) -> DataFrame:
        return fixtures.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("name"), "n"
        )

    return counted("documents").unionByName(counted("labels"))
