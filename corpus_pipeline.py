"""Clean-up pipeline over ``documents``: each stage calls one operator.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and the next stage reads it back. All stages but the last return the
columns of ``documents``.

Rows are told apart by id and text together (``common.row_keys``): rows alike
in both share every decision, and the near-duplicate stage keeps one of them.
Null and empty texts have no letter, so the first stage drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog.llm import bpe
from playlog.llm import common as C
from playlog.llm import decontaminate
from playlog.llm import langid
from playlog.llm import pii
from playlog.llm import simhash
from playlog.llm.queries import PII_KEY
from playlog.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts no language's dictionary tells apart."""
    found = langid.predict(docs, langid.fit(docs))
    return found.filter(~F.col("lang_rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the smallest doc_id."""
    stay = simhash.representatives(simhash.near_duplicates(docs))
    return C.keep_rows(docs, stay, "left_semi", "doc_id", "text", once=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    found = decontaminate.contamination(docs, C.read(spark, sf_dir, "benchmark"))
    hit = found.filter("n_hit > 0").select("k1", "k2")
    return C.keep_rows(docs, hit, "left_anti", "doc_id", "text")


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal numbers, dates and addresses within their format."""
    return pii.pseudonymise(docs, PII_KEY).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("bpe", encoding),
]

# identification by compression, fingerprints, pseudonyms and BPE merges are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole of ``documents``."""
    docs = C.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
