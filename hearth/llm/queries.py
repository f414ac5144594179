"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import bpe, fim, html, jaccard, licenses, lines, neighbours, packing, quality, resample, sharding, simhash, suffixes
from hearth.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def hex64(col: str) -> Column:
    """A signed 64-bit number as 16 lowercase hex digits of its unsigned value."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.tokens(VOCABULARY, end=2))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).drop("text")
    both = bpe.decode(ids, VOCABULARY)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.encode("text", "UTF-8")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shard(rows, 8, key="doc_id", size="size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash.classes(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), hex64("fp").alias("fingerprint"), "component_id")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return suffixes.remove(docs, with_text=False).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 50 == 0, k=5, id_col="vec_id", vector_col="embedding")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "license", "word", "containment")


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines in classes of near-equal lines, each with the first occurrence of its class, and the text that stays."""
    done = lines.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.filter("dups", lambda d: ~d["is_first"])
    return done.select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_removed").cast("bigint").alias("n_removed"),
        F.transform(removed, lambda d: d["line"]).alias("removed_lines"), F.transform(removed, lambda d: d["first_id"]).alias("first_doc_ids"),
        F.transform(removed, lambda d: d["first_line"]).alias("first_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.assess(table(spark, sf_dir, "documents")).select(*cols)


SQL["op8_quality_rules"] = r"""
WITH t AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(text, '') AS s FROM documents),
w AS (SELECT r, doc_id, s, list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT r, i, COUNT(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n
      FROM (SELECT r, ws, UNNEST(generate_series(1, len(ws) - 2)) AS i FROM w)),
c AS (SELECT r, COUNT(DISTINCT j) AS n FROM (SELECT r, UNNEST([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(s, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
             length(regexp_replace(s, '[^\p{Lu}]', '', 'g')) AS upper_n, length(regexp_replace(s, '[^\p{Ll}]', '', 'g')) AS lower_n,
             length(regexp_replace(s, '[^!]', '', 'g')) AS bangs
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > n_words * CAST(0.3 AS DOUBLE) OR n_dup_lines > n_lines * CAST(0.5 AS DOUBLE)
            OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words OR upper_n > (upper_n + lower_n) * CAST(0.6 AS DOUBLE)
            OR bangs > n_words * CAST(0.2 AS DOUBLE)) AS kept
FROM b"""


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = jaccard.classes(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(), 256).alias("restored_sha256"),
    )


SQL["op12_fill_in_middle"] = r"""
WITH t AS (SELECT doc_id, COALESCE(text, '') AS s, sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT *, regexp_extract_all(s, '[A-Za-z]+|[^A-Za-z]') AS units FROM t),
h AS (SELECT doc_id, s, units, CAST(len(units) AS BIGINT) AS n, CAST('0x' || d[1:8] AS UBIGINT) AS h1, CAST('0x' || d[9:16] AS UBIGINT) AS h2,
             CAST('0x' || d[17:24] AS UBIGINT) AS h3, CAST('0x' || d[25:32] AS UBIGINT) AS h4 FROM u),
c AS (SELECT doc_id, s, n, units, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b,
             CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, s, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(s) AS restored_sha256
FROM p"""


@query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return scored.withColumnRenamed("id", "doc_id")
