import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from facetide.llm import decontaminate, mixing, quality, similar
from facetide.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = [docs]
    for name, stage in pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, held[-1], sf_dir).write.parquet(path)
        held.append(spark.read.parquet(path))
    return held


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_acts_on_what_the_last_one_kept(spark, sf_dir, stages):
    docs, ruled, single, clean, mixed, sharded = stages
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    assert ids(ruled) == ids(quality.quality(docs, good).where("kept")) and ruled.count() < docs.count()
    groups = similar.similar(ruled)[0]
    assert ids(single) == ids(groups.where("doc_id = component_id"))
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert ids(clean) == ids(decontaminate.decontaminate(single, bench).where("not contaminated")) and clean.count() < single.count()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect()}
    assert ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(sharded) == ids(mixed) and sharded.where("shard is null").count() == 0
    for df in stages[:-1]:
        assert df.columns == docs.columns
    assert sharded.columns == [*docs.columns, "n_bytes", "shard", "shard_bytes", "shard_docs"]


def test_run_is_the_stages(spark, sf_dir, stages):
    assert ids(pipeline.run(spark, sf_dir)) == ids(stages[-1])


def test_odd_rows(spark, sf_dir, odd, none):
    for docs in (odd.select(*pipeline.DOCUMENTS, F.lit(1).alias("extra")), none.select(*pipeline.DOCUMENTS)):
        for name, stage in pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() >= 0, name
