"""The operators' queries over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import chat, decontaminate, exact_dedup, html_extract, jaccard_join, lm_score, packing, quality, url_filter, warc
from weft.llm.common import fold, table

#: Fixed values of the contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score(table(spark, sf_dir, "documents"), fold(F.col("id"), 7) != 2)
    return scored.withColumn("held_out", fold(F.col("doc_id"), 7) == 2)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard_join.near_groups(table(spark, sf_dir, "documents"), k=3, num=90, den=100)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_quotes(table(spark, sf_dir, "conversations"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda k: fold(k, 4) != 2)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_ngram_jaccard_join, op3_quotation_linking, op4_html_extraction, op5_warc, op6_url_filter, op7_quality_classifier, op8_exact_dedup, op9_packing, op10_benchmark_decontamination)}

#: DuckDB SQL of the queries that it expresses; the others are tested against brute force.
ORACLE_SQL = {
    "op3_quotation_linking": chat.SQL,
    "op6_url_filter": r"""
with u as (
  select page_id, case when url like '%://%' then split_part(split_part(substr(url, strpos(url, '://') + 3), '#', 1), '?', 1) else '' end as rest from pages),
h as (
  select page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         case when strpos(rest, '/') > 0 then substr(rest, strpos(rest, '/')) else '' end as path from u),
r(rule, rhost, rpath, verdict) as (values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
f as (
  select h.page_id, h.host, h.path, max(struct_pack(n := length(r.rule), rule := r.rule, verdict := r.verdict)) as best
  from h left join r on (h.host = r.rhost or suffix(h.host, '.' || r.rhost)) and starts_with(h.path, r.rpath) group by all)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from f
""",
    "op8_exact_dedup": r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
from d window w as (partition by norm order by n desc, doc_id)
""",
    "op2_ngram_jaccard_join": r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as set from w),
e as materialized (select doc_id, len(set) as n, unnest(set) as sh from s),
p as materialized (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.sh = b.sh and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
r(node, seen) as (select distinct a, a from p union select r.node, p.b from r join p on r.seen = p.a),
c as (select node, min(seen) as root from r group by node),
l as (select a, count(*) as n_links from p group by a)
select s.doc_id, cast(len(s.set) as bigint) as n_shingles, coalesce(c.root, s.doc_id) as component_id, cast(coalesce(l.n_links, 0) as bigint) as n_links
from s left join c on s.doc_id = c.node left join l on s.doc_id = l.a
""",
    "op5_warc": r"""
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h, min(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, cast(strlen(body) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as integer) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
from p
""",
}
