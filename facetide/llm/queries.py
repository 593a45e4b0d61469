"""One query per operator over the whole of its table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.llm import (
    align, bpe, decontaminate, language, mixing, quality, search, sharding, similar, tokens, toxicity, urls, warc)
from facetide.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the documents that are labelled good."""
    return table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1").select("doc_id")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    judged = quality.quality(docs, trusted(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "score")


@query("op6_ngram_jaccard_join", r"""
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    shingles as (
        select distinct doc_id, unnest(case when len(w) >= 5
            then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
    sizes as (select words.doc_id, count(s) as n from words left join shingles using (doc_id) group by 1),
    shared as (
        select a.doc_id as x, b.doc_id as y, count(*) as k from shingles a join shingles b using (s)
        where a.doc_id <> b.doc_id group by 1, 2),
    links as (
        select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
        where 100 * k >= 75 * (p.n + q.n - k)),
    reached as (
        select doc_id as x, doc_id as y from sizes
        union select r.x, l.y from reached r join links l on r.y = l.x)
    select doc_id, n::bigint as n_shingles, min(y) as component_id from sizes join reached on x = doc_id group by 1, 2
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return similar.similar(docs)[0].select("doc_id", "n_shingles", "component_id")


@query("op8_benchmark_decontamination", r"""
    with doc as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    item as (
        select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
    windows as (
        select distinct item_id, least(10, len(w)) as size, unnest(list_transform(range(1, greatest(2, len(w) - 8)),
            lambda i: array_to_string(w[i:i + 9], ' '))) as s from item where len(w) > 0),
    sizes as (select distinct size from windows),
    places as (
        select doc_id, size, unnest(range(1, len(w) - size + 2)) as i, w from doc, sizes where len(w) >= size),
    hits as (
        select doc_id, i, p.size, item_id from (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as s
            from places) p join windows on windows.size = p.size and windows.s = p.s),
    hit_words as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + size)) as k from hits) group by 1),
    hit_items as (
        select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids
        from (select distinct doc_id, item_id::varchar as id from hits) group by 1)
    select doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(t.n, 0)::bigint as n_items,
        sha256(coalesce(ids, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
    from doc left join hit_words h using (doc_id) left join hit_items t using (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op2_mixing_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shard(docs).select("doc_id", "n_bytes", "shard", "shard_bytes", "shard_docs")


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/")]


@query("op3_url_filters", r"""
    with parts as (
        select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
        from pages),
    hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from parts),
    split as (
        select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from hosts),
    rules(verdict, rule_host, rule_path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    fits as (
        select page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
            max_by(verdict, length(rule_host || rule_path)) as verdict
        from split join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        group by 1)
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from split left join fits using (page_id)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages", "page_id", "url"), urls.host_rules(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = held_out(F.col("doc_id"))
    net = language.fit(docs.where(F.col("doc_id").isNotNull() & ~out))
    return language.predict(docs.select("doc_id", "text"), net).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op5_warc_records", r"""
    with payloads as (select page_id, encode(coalesce(html, '')) as p from pages),
    sized as (select page_id, octet_length(p)::bigint as n, sha1(p) as d from payloads),
    kept as (select d, n, max(page_id) as k from sized where n >= 1000 group by 1, 2)
    select page_id, n as payload_bytes, d as payload_digest,
        case when k is null or k = page_id then 'response' else 'revisit' end as record_type,
        case when k <> page_id then k end as refers_to
    from sized left join kept using (d, n)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.pages_to_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return warc.read_warc(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    out = held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.where(F.col("doc_id").isNotNull() & ~out))
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


@query("op13_bpe_roundtrip")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"))
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text"), 256).alias("decoded_sha256"))


@query("op11_lexical_search", r"""
    with doc as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    item as (
        select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as t from benchmark),
    totals as (select count(*) as n_docs, sum(len(w))::bigint as n_terms from doc where len(w) > 0),
    lengths as (
        select doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms as m from doc, totals where len(w) > 0),
    counts as (
        select doc_id, t, count(*) as tf from (select doc_id, unnest(w) as t from doc)
        where t in (select t from item) group by 1, 2),
    weights as (
        select t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as wt
        from counts, totals group by 1),
    scores as (
        select item_id, doc_id, sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
        from item join counts using (t) join weights using (t) join lengths using (doc_id) group by 1, 2),
    ranked as (
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
        from scores where score > 0)
    select * from ranked where rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return search.search(docs, table(spark, sf_dir, "benchmark"))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows, _ = align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))
