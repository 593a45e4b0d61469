"""URL filters: pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens that every URL it matches must have: labels of
the host and whole folders of the path. Tokens are counted over all URLs, and each rule is filed under its rarest one. A
URL fetches the rules of its own tokens, and only those run their expressions. Of the rules that match, the longest decides.

All of it is DataFrame functions. The index is broadcast if its counted size is within the bound, else joined; a row goes
through one shuffle, pre-aggregated in its task, so that a token that is in every URL gathers nowhere.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets ``default``. Of equally
long rules, block goes before allow, then the text decides. Repeated rows are judged one by one. Columns of the input with
the name of a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from facetide.llm.common import bounded, lower_ascii, stored, without

DEFAULT = "allow"
RULE_ROW_BYTES = 512
#: The token of rules that have no literal token, and of every URL.
ANY = "*"
RESULTS = ("host", "path", "rule", "verdict")


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    folders = F.split(path, "/")
    whole = F.transform(F.slice(folders, 1, F.size(folders) - 1), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, whole), lambda x: F.length(x) > 2))


def host_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules from (verdict, host/path): the host itself and all subdomains, and paths that begin with the path."""
    rows = F.explode(F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules)))
    split = spark.range(1).select(rows.alias("r")).select("r.*").withColumns({
        "_host": F.substring_index("rule", "/", 1), "_path": F.expr("substring(rule, instr(rule, '/'))")})
    return split.select(
        "rule", "verdict",
        F.concat(F.lit(r"(?s)^(?:.*\.)?"), _quoted(F.col("_host")), F.lit("\n"), _quoted(F.col("_path"))).alias("pattern"),
        _tokens(F.col("_host"), F.col("_path")).alias("tokens"))


def _parts(url: Column) -> tuple[Column, Column]:
    """Host and the rest behind it."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit("")), F.coalesce(rest, F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``. ``rules`` has rule, verdict, pattern (over host, line end, path)
    and tokens."""
    held = without(pages, set(RESULTS) - {url})
    kept = [F.col(f"`{c}`") for c in held.columns]
    host, rest = _parts(F.col(url))
    split = held.select(F.struct(*kept).alias("_row"), host.alias("_host"), rest.alias("_rest"))
    split = split.select("_row", lower_ascii(F.col("_host")).alias("_host"), F.regexp_extract(
        F.substr("_rest", F.length("_host") + 1), r"^[^?#]*", 0).alias("_path"))

    every = stored(rules.select("rule", "verdict", "pattern", F.when(
        F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit(ANY))).alias("tokens")), "rules")
    wanted = stored(every.select(F.explode("tokens").alias("token")).distinct(), "tokens")
    seen = (
        split.select(F.explode(_tokens(F.col("_host"), F.col("_path"))).alias("token"))
        .join(bounded(wanted, RULE_ROW_BYTES), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = every.select("rule", "verdict", "pattern", F.explode("tokens").alias("token")).join(seen, "token", "left")
    index = stored(ranked.groupBy("rule", "verdict", "pattern").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("t")).select(
        F.col("t.token").alias("token"), "rule", "verdict", "pattern"), "index")

    fetched = (
        split.withColumn("_id", F.monotonically_increasing_id())
        .withColumn("token", F.explode(F.concat(F.array(F.lit(ANY)), _tokens(F.col("_host"), F.col("_path")))))
        .join(bounded(index, RULE_ROW_BYTES), "token", "left"))
    target = F.concat("_host", F.lit("\n"), "_path")
    fits = F.col("pattern").isNotNull() & F.regexp_like(target, F.col("pattern"))
    best = F.max(F.when(fits, F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"),
                                       F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))))
    judged = fetched.groupBy("_id").agg(F.first("_row").alias("_row"), F.first("_host").alias("host"),
                                        F.first("_path").alias("path"), best.alias("_best"))
    return judged.select(
        *(F.col(f"_row.`{c}`").alias(c) for c in held.columns), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
