"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are applied in order; each takes what its predecessor kept, written as
Parquet and read again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import minhash, packing, quality, secrets, substrings
from ledgerline.llm.common import cut, few_or_shuffled, fresh, shared_folder

#: word-shingle similarity, in percent, from which two documents are near copies here;
#: the 85 of op2 is that query's own contract
NEAR_PERCENT = 80

#: SQL can express neither the similarity join nor the packing
ORACLE_SQL = None


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    verdict = fresh(docs.columns, "quality_kept")
    # measured columns may clash with the table's own, so measure beside it
    kept = quality.apply_policy(quality.ledger(docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))), out=verdict)
    return kept.where(verdict).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id.  Where
    rows repeat an id, each text under it is a document of its own, and of rows with one id
    and text the smallest stays; rows without an id stay."""
    names, key = docs.columns, fresh(docs.columns, "row_key")
    keyed = docs.where("doc_id is not null")
    if keyed.groupBy("doc_id").count().where("count > 1").isEmpty():
        keyed = keyed.withColumn(key, F.col("doc_id"))
    else:
        rest = F.struct(F.lit(0), *(c for c in names if c not in ("doc_id", "text")))
        one = F.min(rest).alias(key)
        again = cut(keyed.groupBy("doc_id", F.xxhash64("text").alias(key)).count().where("count > 1").select("doc_id").distinct())
        again = few_or_shuffled(again)
        once = keyed.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(one).select("doc_id", "text", f"{key}.*").select(*names)
        keyed = keyed.join(again, "doc_id", "left_anti").unionByName(once).withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("text")))
    found = cut(minhash.near_duplicates(keyed.select(key, "text"), key=key, percent=NEAR_PERCENT).select("doc_id", "kept"))
    gone = few_or_shuffled(found.where("not kept").select(F.col("doc_id").alias(key)).distinct())
    out = keyed.join(gone, key, "left_anti").select(*names)
    return out.unionByName(docs.where("doc_id is null"))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go; a character that loses a byte goes whole."""
    rest = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    out = substrings.repeated_spans(docs.select("doc_id", "text", rest))
    raw = F.col("kept").cast("string")
    text = F.when(F.expr("is_valid_utf8(cast(kept AS string))"), raw).otherwise(F.regexp_replace(F.expr("make_valid_utf8(cast(kept AS string))"), "�", ""))
    text = F.when(F.size("spans") > 0, text).otherwise(F.col("text"))
    flat = out.select("row.*", text.alias("text"))
    return _recount(flat).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay."""
    path = "source" if "source" in docs.columns else None
    forest = secrets.fit_forest(secrets.weak_labels(secrets.plausible(docs, path=path)))
    return _recount(secrets.redact(docs, forest, path=path)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document and their places in sequences."""
    return packing.pack(packing.encode(docs.select("doc_id", "text")))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_substrings),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
