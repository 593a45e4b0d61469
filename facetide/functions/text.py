"""Paths, file names and result lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from facetide.functions._util import as_column

# Image folder of each public corpus, below the base directory.
CORPUS_FOLDERS = {"imdb": "imdb_crop", "wiki": "wiki_crop"}


def image_path(base: Column | str, file_name: Column | str) -> Column:
    """``base/file_name``; a plain string ``base`` is a literal directory."""
    root = F.lit(base.rstrip("/")) if isinstance(base, str) else base
    return F.concat_ws("/", root, as_column(file_name))


def corpus_dir(base: str, source: Column | str, folders: Mapping[str, str] = CORPUS_FOLDERS) -> Column:
    """Image directory of a row's corpus; an unknown corpus is an error."""
    name = as_column(source)
    root = base.rstrip("/")
    chosen = F.when(F.lit(False), F.lit(""))
    for corpus, folder in folders.items():
        chosen = chosen.when(name == corpus, F.lit(f"{root}/{folder}"))
    return chosen.otherwise(
        F.raise_error(F.concat(F.lit("unknown corpus: "), F.coalesce(name, F.lit("null"))))
    )


def shard_name(split: Column | str, shard: Column | str) -> Column:
    """``train-007.tfrecords`` and the like; a plain string ``split`` is a literal name."""
    prefix = F.lit(split) if isinstance(split, str) else split
    return F.format_string("%s-%03d.tfrecords", prefix, as_column(shard))


def _iso(ts: Column) -> Column:
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))


def format_result(
    ts: Column | str,
    real_gender: Column | str,
    real_age: Column | str,
    pred_gender: Column | str,
    pred_age: Column | str,
) -> Column:
    """One prediction as a line of text with an ISO time."""
    return F.format_string(
        "%s Real Gender/Age: %s/%s, Predicted Gender/Age: %s/%s",
        _iso(as_column(ts)),
        *(as_column(c).cast("string") for c in (real_gender, real_age, pred_gender, pred_age)),
    )
