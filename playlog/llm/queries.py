"""Registered queries of the subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.llm import bpe
from playlog.llm import common as C
from playlog.llm import decontaminate
from playlog.llm import langid
from playlog.llm import lexical
from playlog.llm import masked_lm
from playlog.llm import mih
from playlog.llm import periodic
from playlog.llm import pii
from playlog.llm import simhash
from playlog.llm import suffix_dedup
from playlog.llm import token_files
from playlog.llm import toxicity
from playlog.llm import warc
from playlog.session import scratch_path

# a deployment passes its own secret
PII_KEY = "registered-query-key"


def op1_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = masked_lm.score(docs, masked_lm.fit(docs))
    return found.select("doc_id", F.col("lm_tokens").alias("n_tokens"), F.col("lm_log_prob").alias("log_prob"),
                        F.col("lm_mean").alias("mean_log_prob"), F.col("lm_perplexity").alias("perplexity"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(C.read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex().alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(C.read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, ranks)
    return decoded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(C.read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return found.select("doc_id", "text", F.size("pii").alias("n_pii"), "pii")


def op5_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mih.neighbours(C.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, C.read(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", C.held_out("doc_id").alias("held_out"), F.col("toxic_score").alias("score"),
                        F.col("toxic_pred").alias("predicted"), F.size("offending_index").alias("n_offending"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(C.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.PATTERN, end_id=2, folder=folder)
    found = token_files.read(spark, manifest, folder, with_ids=False)
    return token_files.located(found, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents")
    model = langid.fit(docs)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", C.held_out("doc_id").alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"), F.col("lang_margin").alias("margin"),
                        F.col("lang_rejected").alias("rejected"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated(C.read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes",
                        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write(C.read(spark, sf_dir, "pages"), folder)
    found = warc.read(spark, folder, with_payload=False)
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _planted(doc_id: str, text: str) -> F.Column:
    """The text, of one id in ten with the words from some place on made periodic."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic_words(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(w, i.cast("int"))), " ")).otherwise(F.col(text))

    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.when((h % 10 == 0) & F.col(text).isNotNull(),
                  F.get(F.transform(F.array(words), periodic_words), F.lit(0))).otherwise(F.col(text))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", _planted("doc_id", "text").alias("text"))
    found = periodic.find_runs(docs)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        (-best["l"]).alias("length"), best["period"].alias("period"),
        F.floor(1000 * -best["l"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_masked_lm": op1_masked_lm,
    "op2_simhash": op2_simhash,
    "op3_bpe": op3_bpe,
    "op4_pii": op4_pii,
    "op5_mih": op5_mih,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_warc": op11_warc,
    "op12_periodic": op12_periodic,
    "op13_lexical": op13_lexical,
}

# Windows of 10 words (fewer where the item has fewer) as strings, matched at every position.
_OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS body
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
pos AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS body
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT pos.r, pos.i, pos.n, win.item FROM pos JOIN win USING (n, body)),
cov AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""

# Base 32 of a SHA-1: each 5 hex digits are 20 bits, so four characters.
_OP11_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
g AS (SELECT body, max(page_id) AS keep FROM p GROUP BY body)
SELECT page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           (CAST('0x' || substr(sha, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST((3 - i % 4) * 5 AS INTEGER))
           & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keep THEN keep END AS refers_to
FROM p JOIN g ON p.body = g.body
"""

# Every document that shares a term with an item is scored.
_OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS q, item_id, w FROM (
    SELECT DISTINCT item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL)),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf
       FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY r, doc_id, n, t),
qt AS (SELECT q, item_id, t, count(*) AS times FROM (SELECT q, item_id, unnest(w) AS t FROM i) GROUP BY q, item_id, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
           FROM tf, totals GROUP BY t, n_docs),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (
           100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM qt JOIN tf USING (t) JOIN weight USING (t), totals GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op8_decontamination": _OP8_SQL,
    "op11_warc": _OP11_SQL,
    "op13_lexical": _OP13_SQL,
}
