"""A training corpus from raw documents: quality, exact and near copies, benchmark leaks, packing.

``STAGES`` are applied in order by ``run``; each one's result is written to the
shared folder and read again as the documents of the next. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.llm import exact_dedup, latent_decontamination, minhash, quality_ranker, retrieval_packing
from ride_analytics.llm.common import table
from ride_analytics.sources.storage import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score, learnt from the labels that are not held out, is at least 0.3.

    Each row is judged by its text alone (null: empty), so repeated rows and ids go together; no rows give no rows.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~quality_ranker.held_out())
    return quality_ranker.keep_good(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space: the longest, then that of the smallest id.

    Null, empty and blank texts are one group. Of rows that repeat id and text, white space aside, one stays.
    """
    found = written(exact_dedup.exact_duplicates(docs).where("kept").groupBy(F.col("doc_id").alias("keep"), "text_sha256", "keep_cp").agg(F.count("*").alias("rows")),
                    "kept-texts").alias("k")
    norm = exact_dedup.normalised(F.col("d.text"))
    kept = docs.alias("d").withColumn("__digest", F.sha2(norm.cast("binary"), 256)).join(
        found, (F.col("__digest") == F.col("k.text_sha256")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.keep"))
        & (F.length(F.coalesce("d.text", F.lit(""))) == F.col("k.keep_cp")))
    one = kept.where("k.rows = 1").select("d.*")
    if found.where("rows > 1").isEmpty():
        return one
    # rows that repeat id and text: the longest text, then the first in order
    again = kept.where("k.rows > 1").withColumn("__length", F.length(F.coalesce("d.text", F.lit(""))))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    best = again.groupBy("__digest", "k.keep").agg(F.max(F.struct("__length", *columns)).alias("best"))
    return one.union(best.select(*[F.col(f"best.`{c}`") for c in docs.columns]))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of at least 0.8 of five-word shingles: that of the smallest id.

    Documents without words stay, and those of a null id. Rows that share an id go only if all would go.
    """
    kept = minhash.near_duplicates(docs, threshold=0.8).where("kept").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as a copy or a paraphrase with its answer; each row is judged by its text alone."""
    return latent_decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    import public_tokenizers
    return retrieval_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("minhash near-dedup", near), ("benchmark decontamination", decontaminate),
          ("packing", pack)]
ORACLE_SQL = None  # learnt scores and latent search have no SQL; tests/llm/test_pipeline.py compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
