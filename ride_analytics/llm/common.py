"""Helpers shared by the operators: tables, and words and hashes of Arrow text batches as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, U64), np.ones(1, U64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(size, U64(base))
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and where each row begins (one more than rows); null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(ends, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay under ``limit``; a longer row comes alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def batches(reader: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of Arrow batches of at most ``limit`` text bytes, with bytes and offsets of their texts."""
    for batch in reader:
        _, offsets = text_bytes(batch.column(text))
        for a, b in row_chunks(offsets, limit):
            part = batch.slice(a, b - a)
            yield (part, *text_bytes(part.column(text)))


def filter_rows(docs: DataFrame, keeps, text_col: str = "text", limit: int = 1 << 20) -> DataFrame:
    """Rows of ``docs``, with all their columns, for whose texts ``keeps`` (bytes, offsets -> booleans) holds."""

    def run(reader):
        for part, raw, offsets in batches(reader, text_col, limit):
            yield part.filter(pa.array(keeps(raw, offsets)))

    return docs.mapInArrow(run, docs.schema)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the rows after lower-casing A-Z: the lower-cased bytes, starts, ends, and
    where each row's words begin (one more than rows)."""
    low = LOWER[raw]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = ~WHITE[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return low, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: the same bytes give the same hash anywhere."""
    if not len(starts):
        return np.zeros(0, U64)
    p, q = powers(len(low) + 1)
    total = np.zeros(len(low) + 1, U64)
    np.cumsum(_TABLE[low] * p[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * q[starts] + (ends - starts).astype(U64))


_STEPS = np.random.default_rng(20240502).integers(1, 2**63, 8, dtype=np.uint64) * U64(2) + U64(1)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each row, and where each row's begin. A row of fewer words has one
    run, the whole row; a row without words none."""
    counts = np.diff(first)
    number = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    begin = np.concatenate(([0], np.cumsum(number)))
    row = np.repeat(np.arange(len(counts)), number)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    padded = np.concatenate((hashes, np.zeros(size, U64)))
    length = np.minimum(counts, size)[row]
    out = length.astype(U64)
    for k in range(size):
        out += np.where(length > k, padded[at + k], U64(0)) * _STEPS[k]
    return mix(out), begin


def connected(links: DataFrame, cut) -> DataFrame:
    """Smallest id reachable from each end of ``links`` (a, b): rows (id, component).

    Each round hands every id the smallest label among its neighbours and then
    the label of its label, so paths shorten to a fraction; ``cut`` writes each
    round's labels to the shared folder. Hot ids are aggregates with map-side
    partial results.
    """
    edges = cut(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct())
    labels = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = (edges.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        step = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("next"))
        top = labels.select(F.col("id").alias("next"), F.col("component").alias("root"))
        step = step.join(top, "next", "left").select("id", "component", F.least("next", F.coalesce("root", "next")).alias("next"))
        step = cut(step)
        if step.where("next != component").isEmpty():
            return step.select("id", "component")
        labels = step.select("id", F.col("next").alias("component"))
