"""Exact duplicates by an extendible-hash index kept as files of the shared folder; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.sources.storage import written

LEAF_BITS = 12


def normalised(text: Column) -> Column:
    """The text without space, tab, line feed, vertical tab, form feed and carriage return; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")


def directory(keys: DataFrame, bucket_keys: int) -> DataFrame:
    """Extendible-hash directory over ``keys`` (key): one row per leaf of ``LEAF_BITS`` more bits, with its bucket.

    A directory entry of depth d stands for all keys with the same first d bits.
    Doubling splits a bucket of more than ``bucket_keys`` keys until its parts
    fit, which is the smallest such d. One count of the leaves gives the keys of
    every prefix; leaves that are still overfull are split on in another round.
    Rows: level (rounds before), leaf, bucket_start (the first key), depth.
    """
    out, level, rest = None, 0, keys
    while True:
        bits = LEAF_BITS * (level + 1)
        leaves = rest.groupBy(F.shiftrightunsigned("key", 64 - bits).alias("leaf")).agg(F.count("*").alias("n"))
        prefixes = leaves.withColumn("up", F.explode(F.sequence(F.lit(0), F.lit(LEAF_BITS))))
        prefixes = prefixes.groupBy("up", F.expr("shiftright(leaf, up)").alias("prefix")).agg(F.sum("n").alias("n"))
        fits = prefixes.where(F.col("n") <= bucket_keys).select("up", "prefix")
        held = (leaves.withColumn("up", F.explode(F.sequence(F.lit(0), F.lit(LEAF_BITS))))
                .withColumn("prefix", F.expr("shiftright(leaf, up)"))
                .join(fits, ["up", "prefix"], "left_semi").groupBy("leaf").agg(F.max("up").alias("up")))
        done = leaves.join(held, "leaf", "left").select(
            F.lit(level).alias("level"), "leaf", F.col("up").isNull().alias("overfull"),
            F.expr(f"shiftleft(shiftright(leaf, coalesce(up, 0)), {64 - bits} + coalesce(up, 0))").alias("bucket_start"),
            (F.lit(bits) - F.coalesce("up", F.lit(0))).alias("depth"))
        done = written(done, "hash-directory")
        full = done.where("overfull").select("leaf")
        last = bits + LEAF_BITS > 60 or full.isEmpty()
        kept = (done if last else done.where("NOT overfull")).drop("overfull")
        out = kept if out is None else out.union(kept)
        if last:
            return out
        rest = rest.join(full, F.shiftrightunsigned("key", 64 - bits) == full.leaf, "left_semi")
        level += 1


def hash_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Index of the distinct normalised texts, and the rows with their entry's key.

    Index rows: bucket_start, depth, key (64-bit hash), chain (place among texts
    of one key), text_sha256, copies. Texts are told apart by their bytes: the
    aggregate below compares whole texts of one hash, so texts that collide
    become entries of one chain. Copies are merged before they are shuffled,
    so a text that fills a third of the rows weighs no more than any other.
    The owner of a range of keys numbers its chains and writes its bucket files.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), F.length(F.coalesce(text_col, F.lit(""))).alias("n_cp"),
                       normalised(F.col(text_col)).alias("norm")).withColumn("key", F.xxhash64("norm"))
    rows = written(norm.select("doc_id", "n_cp", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "hash-rows")
    texts = norm.groupBy("key", "norm").agg(F.count("*").alias("copies"))
    entries = written(texts.select("key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                                   F.octet_length("norm").alias("n_bytes"), "copies"), "hash-entries")
    tree = directory(entries.select("key").distinct(), bucket_keys)
    placed = None
    for level in range(60 // LEAF_BITS):
        bits = LEAF_BITS * (level + 1)
        part = entries.withColumn("leaf", F.shiftrightunsigned("key", 64 - bits)).join(
            tree.where(F.col("level") == level).drop("level"), "leaf").drop("leaf")
        placed = part if placed is None else placed.union(part)
    # the owner of a bucket sees its keys together and in order
    chained = placed.withColumn("chain", F.row_number().over(
        Window.partitionBy("bucket_start", "key").orderBy("text_sha256", "n_bytes")) - 1)
    # two texts of one chain with the same SHA-256 could not be told apart by the rows' digests
    alike = F.count("*").over(Window.partitionBy("bucket_start", "key", "text_sha256")) > 1
    chained = chained.withColumn("chain", F.when(alike, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("chain")))
    return written(chained, "hash-index"), rows


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = 4096) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, keep_cp (code points of the kept row), and the index entry
    (bucket_start, depth, chain).

    Texts are equal when the same after deleting white space ``[\\x20\\x09-\\x0D]``; null counts as empty, so null,
    empty and blank texts form one group. Of a group the row with the most code points stays, then the smallest id.
    Rows that repeat an id are told apart by nothing: all that carry the keeper's id and length are kept. A null id
    sorts after all others. An empty table gives no rows. Columns besides id and text are not read.
    """
    index, rows = hash_index(docs, id_col, text_col, bucket_keys)
    longest = rows.groupBy("key", "text_sha256").agg(F.max("n_cp").alias("keep_cp"), F.count("*").alias("group_size"))
    keepers = (rows.join(longest, ["key", "text_sha256"]).where("n_cp = keep_cp")
               .groupBy("key", "text_sha256").agg(F.min("doc_id").alias("keep_id"), F.max("keep_cp").alias("keep_cp"), F.max("group_size").alias("group_size")))
    heads = index.join(keepers, ["key", "text_sha256"])
    return rows.join(heads, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_cp") == F.col("keep_cp"))).alias("kept"),
        "text_sha256", "keep_cp", "bucket_start", "depth", "chain")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
