"""The numbered operators as queries over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import fingerprints, jaccard, language, leaks, lines, mixing, quality, repeats, search, shards, tokens, tries, url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 8
END_ID = 2


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that all executors share."""
    return os.path.join(shared_dir(spark), "bazaarline", f"{label}-{uuid.uuid4().hex}")


def byte_bpe() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op1_token_output")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokens.write_tokens(table(spark, sf_dir, "documents"), byte_bpe(), scratch(spark, "tokens"), END_ID)
    return tokens.read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op6_line_dedup", r"""
with lines as (
  select d.doc_id, u.pos, u.line,
         lower_ascii as key
  from documents d,
       lateral (select unnest(string_split(coalesce(d.text, ''), chr(10))) as line,
                       generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) as pos) u,
       lateral (select translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii) k
), firsts as (select key, min(doc_id) as first_doc from lines where length(key) >= 10 group by key)
select l.doc_id, count(*) as n_lines,
       count(*) filter (where f.first_doc < l.doc_id) as n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) order by l.pos)
                       filter (where f.first_doc is null or f.first_doc >= l.doc_id), '')) as kept_sha256
from lines l left join firsts f on l.key = f.key
group by l.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                          F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_rows(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed, _ = mixing.mix_sources(docs, min_entropy=0.95)
    return mixed.select("doc_id", "source", "n_tokens", "block", "place", "passes")


@query("op3_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_ngram_jaccard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and every document; a page has no doc_id, a document no page_id."""
    docs = table(spark, sf_dir, "documents")
    pages = language.page_evidence(table(spark, sf_dir, "pages")).withColumn("kind", F.lit("page"))
    plain = language.plain_evidence(docs).withColumn("kind", F.lit("document"))
    return language.identify(docs, pages.unionByName(plain)).select(
        F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
        F.when(F.col("kind") == "page", F.col("id")).alias("page_id"), "host", "declared", "lang", "probability", "text_lang")


# the verdicts of this list come before what is mined, and are what is learned from
URL_RULES = [url_rules.Rule("com", "/", "allow"), url_rules.Rule("example.com", "/en/", "block"),
             url_rules.Rule("www.example.com", "/en/", "allow"), url_rules.Rule("net", "/es/", "block"),
             url_rules.Rule("net", "/fr/", "block")]


@query("op11_url_rules")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"))


@query("op12_conversation_trie", r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
           md5(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null
), sizes as (
  -- crc32 of the decimal id, bit by bit: a byte (0 or more) is mixed in, then eight steps (-1) follow
  select conv_id, count(*) as n, conv_id - conv_id % 5 as base,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
               lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda crc, b: case when b >= 0 then xor(crc, b)
                              when crc % 2 = 1 then xor(crc // 2, 3988292384::bigint) else crc // 2 end),
           4294967295::bigint) % 9 as h
  from turns group by conv_id
), taken as (select s.*, least(s.h, coalesce(b.n, 0)) as t from sizes s left join sizes b on b.conv_id = s.base),
rebuilt as (
  select k.conv_id, t.pos, t.role, t.text from taken k join turns t on t.conv_id = k.base and t.pos < k.t
  union all
  select k.conv_id, t.pos - k.h + k.t, t.role, t.text from taken k join turns t on t.conv_id = k.conv_id and t.pos >= k.h
), paths as (
  select s.conv_id, coalesce(list([r.role, r.text] order by r.pos) filter (where r.pos is not null), []) as path
  from sizes s left join rebuilt r on r.conv_id = s.conv_id group by s.conv_id
), nodes as (
  select p.path[1:d.d] as prefix, d.d as depth, min(p.conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (where len(p.path) = d.d), '')) as ends_sha256,
         case when d.d = 0 then 0 else (count(*) - 1) * octet_length(encode(any_value(p.path[d.d][2]))) end as saved
  from paths p, lateral (select unnest(range(0, len(p.path) + 1)) as d) d group by 1, 2
), kids as (
  select n.conv_id, n.depth, count(k.depth) as n_children, any_value(p.conv_id) as parent_conv_id,
         any_value(n.prefix) as prefix, any_value(n.n_convs) as n_convs, any_value(n.ends_sha256) as ends_sha256, any_value(n.saved) as saved
  from nodes n left join nodes k on k.depth = n.depth + 1 and k.prefix[1:n.depth] = n.prefix
               left join nodes p on p.depth = n.depth - 1 and n.prefix[1:p.depth] = p.prefix
  group by n.conv_id, n.depth
)
select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, count(*) filter (where b.n_children = 0) as n_leaves,
       sum(b.saved)::bigint as saved_tokens, n.ends_sha256
from kids n join kids b on b.depth >= n.depth and b.prefix[1:n.depth] = n.prefix
group by all""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_ranked_search", r"""
with words as (
  select d.doc_id, d.rowid as row, unnest(regexp_extract_all(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select doc_id, text, row_number() over () as rowid from documents) d
), sizes as (select row, any_value(doc_id) as doc_id, count(*) as n from words group by row),
totals as (select count(*) as nn, sum(n)::bigint as l from sizes),
asked as (
  select distinct i.item_id, unnest(regexp_extract_all(translate(i.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark i
), tfs as (select row, term, count(*) as tf from words where term in (select term from asked) group by row, term),
weights as (select term, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tfs, totals group by term, nn),
scores as (
  select a.item_id, t.row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::bigint as score
  from asked a join tfs t using (term) join weights using (term) join sizes s on s.row = t.row cross join totals
  group by a.item_id, t.row
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores join sizes using (row) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
