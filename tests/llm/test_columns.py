"""Columns of the input that have the names of working columns pass through every operator unchanged."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from facetide.llm import (
    align, bpe, decontaminate, language, mixing, quality, sharding, similar, tokens, toxicity, urls)

WORKING = ["_s", "_u", "_size", "_cut", "_by", "_at", "_hash", "_shard", "_cell", "_depth", "_words", "_hashed", "_windows", "_tokens",
           "_buckets", "_made", "_distinct", "_lines", "_key", "_place", "_letters", "_one", "_good", "_row", "_host", "_text", "in0",
           "in1", "class", "cell", "label", "place", "bucket", "n", "cells"]
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def clean(rows):
    return toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", F.lit(0).alias("toxic")).limit(0))


OPERATORS = {
    "tokens": lambda d: tokens.count_tokens(d, JSON),
    "mixing": mixing.mix,
    "urls": lambda d: urls.judge(d.withColumnRenamed("source", "url"), urls.host_rules(d.sparkSession, [("block", "com/")])),
    "language": lambda d: language.predict(d, None),
    "keep_one": similar.keep_one,
    "sharding": lambda d: sharding.shard(d, limit=300),
    "decontaminate": lambda d: decontaminate.decontaminate(
        d, d.sparkSession.createDataFrame([(1, "quick brown fox jumps")], "item_id long, text string")),
    "quality": lambda d: quality.judge(d, [0.0] * quality.BUCKETS),
    "toxicity": lambda d: toxicity.score(d, clean(d)),
    "align": lambda d: align.align(d, JSON, MODEL)[0],
    "bpe": lambda d: bpe.encode(d, JSON),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_working_names_do_not_clash(spark, odd, name):
    values = {c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in WORKING}
    rows = odd.where("doc_id is not null and doc_id != 6").drop("score").withColumns(values)
    out = OPERATORS[name](rows)
    found = [c for c in out.columns if c in WORKING]
    assert found == WORKING
    for r in out.collect():
        assert [r[c] for c in WORKING] == [f"{c}{r['doc_id']}" for c in WORKING]
    if name != "keep_one":
        assert out.count() == rows.count()
