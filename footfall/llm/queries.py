"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import (fill_middle, line_chunks, mtree, packing, phrase_index, pseudo_lm, quality_rules, setsketch,
                          token_alignment, token_blocks, toxicity, url_rules, word_bpe)
from footfall.llm.tables import run_folder, table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), run_folder(spark, "op1"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"), run_folder(spark, "op2"))
    return quality_rules.assess(docs, rules)


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    blocks = token_blocks.write(table(spark, sf_dir, "documents"), path, run_folder(spark, "op3"), end_id=0)
    return token_blocks.read(blocks, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op4_pseudo_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known, net = pseudo_lm.fit(docs, run_folder(spark, "op4"))
    return pseudo_lm.score(docs, known, net)


def op5_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "op5")
    vectors = mtree.integers(table(spark, sf_dir, "embeddings"))
    return mtree.search(mtree.index(vectors, folder), vectors.where("id % 50 = 0"), vectors, folder, k=5)


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = word_bpe.encode(table(spark, sf_dir, "documents"), path, run_folder(spark, "op6"), decoded=True)
    return encoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op8_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), run_folder(spark, "op8"))


def op9_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: what stays of its text, how many runs of chunks went, of how many lines."""
    out = line_chunks.without_repeats(table(spark, sf_dir, "documents"), run_folder(spark, "op9"))
    return out.select("row.doc_id", F.col("runs").alias("n_removed_chunks"),
                      F.col("removed").alias("n_removed_lines"), "text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), run_folder(spark, "op10"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return scored.select("doc_id", (crc % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "op11")
    segments = phrase_index.index(table(spark, sf_dir, "documents"), folder)
    windows = phrase_index.phrases(table(spark, sf_dir, "benchmark"), folder)
    out = phrase_index.contamination(segments, phrase_index.matches(segments, windows, folder))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "op12")
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"), folder)
    return token_alignment.digests(aligned, token_alignment.link_counts(aligned, folder), folder)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


OP7_SQL = """
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from cut),
rules(rule_host, rule_path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
urls as (select distinct host, path from parts),
best as (
  select host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(verdict, length(rule_host || rule_path)) as verdict
  from urls join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by host, path)
select p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict
from parts p left join best b on p.host = b.host and p.path = b.path
"""


OP5_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x))
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 5
"""


OP11_SQL = """
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
items as (
  select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
phrases as (
  select distinct item, least(len(w), 10) as width, array_to_string(list_slice(w, i, i + 9), ' ') as phrase
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
widths as (select distinct width from phrases),
grams as (
  select r, i, width, array_to_string(list_slice(w, i, i + width - 1), ' ') as phrase
  from (select r, w, width, unnest(range(1, len(w) - width + 2)) as i from docs, widths where len(w) >= width)),
found as (select distinct g.r, g.i, g.width, p.item from grams g join phrases p using (width, phrase)),
hits as (
  select r, count(distinct place) as n_hit
  from (select r, unnest(range(i, i + width)) as place from (select distinct r, i, width from found)) group by r),
names as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names
          from (select distinct r, item from found) group by r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(n.n_items, 0)::bigint as n_items, sha256(coalesce(n.names, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hits h on d.r = h.r left join names n on d.r = n.r
"""


OP13_SQL = """
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u
  from documents),
numbers as (
  select *, len(u)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
         ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from drawn),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from numbers),
parts as (
  select *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') as p,
         coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') as m,
         coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') as s
  from cuts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else text end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_packing, op2_quality_rules, op3_token_blocks, op4_pseudo_lm, op5_mtree, op6_word_bpe,
             op7_url_rules, op8_setsketch, op9_line_chunks, op10_toxicity, op11_phrase_index,
             op12_token_alignment, op13_fill_middle]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    out = {"op5_mtree": OP5_SQL, "op7_url_rules": OP7_SQL, "op11_phrase_index": OP11_SQL, "op13_fill_middle": OP13_SQL}
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
