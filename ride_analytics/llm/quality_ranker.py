"""Document quality by Bradley-Terry ranking: scores learnt from preference pairs of labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import batches, filter_rows, word_hashes, words
from ride_analytics.sources.storage import written

FIT_ROWS = 20_000     # labelled documents that a fit reads at most, half of each label
PAIRS_PER_ROW = 8     # preferred documents are paired with so many others each
CHUNK_BYTES = 2 << 20

_CLASSES = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "stop": ".,;:?", "shout": "!", "symbol": "#$%&*+=@\\^_`~<>",
            "bar": "|{}[]()/", "quote": "\"'-", "line": "\n", "space": " \t\r"}
_LOOKUP = {name: np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8)) for name, chars in _CLASSES.items()}
FEATURES = (*_CLASSES, "high", "log_bytes", "log_words", "word_length", "word_spread", "short_words", "new_words", "new_pairs", "new_runs",
            "new_lines", "same_next", "top_word", "none")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of whole texts, one row each: shares of kinds of characters, lengths, and how much repeats."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, len(FEATURES)))
    low, starts, ends, first = words(raw, offsets)
    hashes = word_hashes(low, starts, ends)
    number = np.diff(first)
    at = {name: k for k, name in enumerate(FEATURES)}
    some, wordy = np.maximum(size, 1), np.maximum(number, 1)
    for name, table in _LOOKUP.items():
        out[:, at[name]] = _sums(table[raw], offsets) / some
    out[:, at["high"]] = _sums(raw >= 128, offsets) / some
    length = (ends - starts).astype(np.float64)
    mean = _sums(length, first) / wordy
    out[:, at["log_bytes"]] = np.log1p(size)
    out[:, at["log_words"]] = np.log1p(number)
    out[:, at["word_length"]] = np.log1p(mean)
    out[:, at["word_spread"]] = np.log1p(np.sqrt(np.maximum(0, _sums(length**2, first) / wordy - mean**2)))
    out[:, at["short_words"]] = _sums(length <= 3, first) / wordy
    out[:, at["none"]] = number == 0
    breaks = np.flatnonzero(raw == 10)
    for k in range(n):
        own = hashes[first[k]:first[k + 1]]
        m = len(own)
        if not m:
            continue
        _, count = np.unique(own, return_counts=True)
        out[k, at["new_words"]] = len(count) / m**0.8
        out[k, at["top_word"]] = count.max() / m
        if m > 1:
            out[k, at["same_next"]] = (own[1:] == own[:-1]).mean()
            out[k, at["new_pairs"]] = len(np.unique(own[:-1] * np.uint64(3) + own[1:])) / (m - 1)
        if m > 4:
            out[k, at["new_runs"]] = len(np.unique(own[:-4] + own[1:-3] * np.uint64(3) + own[2:-2] * np.uint64(5) + own[3:-1] * np.uint64(7) + own[4:] * np.uint64(9))) / (m - 4)
        inner = breaks[np.searchsorted(breaks, offsets[k]):np.searchsorted(breaks, offsets[k + 1])]
        if len(inner):
            lines = np.split(own, np.unique(np.searchsorted(starts[first[k]:first[k + 1]], inner)))
            lines = [x.tobytes() for x in lines if len(x)]
            out[k, at["new_lines"]] = 1 - len(set(lines)) / max(1, len(lines))
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one column ``f_<name>`` for each of ``FEATURES``; null texts count as empty."""

    def compute(reader):
        for part, raw, offsets in batches(reader, "text", CHUNK_BYTES):
            rows = text_features(raw, offsets)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(rows[:, k]) for k in range(rows.shape[1]))],
                                             ["doc_id", *(f"f_{x}" for x in FEATURES)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(compute, ", ".join(["doc_id long", *(f"f_{x} double" for x in FEATURES)]))


@dataclass(frozen=True)
class Ranker:
    """Weights of standardised features, and the line that turns a score into a probability of label 1."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    slope: float
    shift: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Scores of rows of features."""
        z = np.clip((rows - np.array(self.mean)) / np.array(self.scale), -8, 8)
        return 1 / (1 + np.exp(-np.clip(z @ np.array(self.weights) * self.slope + self.shift, -40, 40)))

    def column(self) -> F.Column:
        """The same as a column over a table of features."""
        total = F.lit(self.shift)
        for name, mean, scale, weight in zip(FEATURES, self.mean, self.scale, self.weights):
            z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(f"f_{name}") - mean) / scale))
            total = total + z * (weight * self.slope)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), total))))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton's method for the logistic loss with an L2 penalty per weight."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_pairs(better: np.ndarray, worse: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, seed: int = 2) -> Ranker:
    """Bradley-Terry scores from rows of features with label 1 and label 0.

    Each pair (a, b) says that a is preferred; its probability is the logistic
    function of w . (a - b), so the loss is that of a logistic regression on
    feature differences without intercept. A second fit of one line maps scores
    to probabilities of label 1 at the labels' own rate.
    """
    both = np.vstack([better, worse])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    standard = lambda x: np.clip((x - mean) / scale, -8, 8)
    a, b = standard(better), standard(worse)
    draw = np.random.default_rng(seed)
    i = np.concatenate([np.repeat(np.arange(len(a)), pairs_per_row), draw.integers(0, len(a), pairs_per_row * len(b))])
    j = np.concatenate([draw.integers(0, len(b), pairs_per_row * len(a)), np.repeat(np.arange(len(b)), pairs_per_row)])
    difference = a[i] - b[j]
    w = _logistic(difference, np.ones(len(difference)), np.full(len(mean), 0.002 * len(difference)))
    s = np.concatenate([a @ w, b @ w])
    y = np.concatenate([np.ones(len(a)), np.zeros(len(b))])
    slope, shift = _logistic(np.column_stack([s, np.ones(len(s))]), y, np.array([1.0, 1e-3]))
    return Ranker(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w)), float(slope), float(shift))


def fit_ranker(table: DataFrame, labels: DataFrame, label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Ranker:
    """Fit on at most ``fit_rows`` of the labelled rows of a feature table, half of each label, chosen by a hash of the id.

    Rows with a null label or id are no examples. Several labels of one
    document count as 1 only if all are. Without rows of both labels every
    document gets the labels' share of ones.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label_col).alias("label"))
    rows = table.join(known, "doc_id")
    rate = rows.agg(F.avg("label")).first()[0]
    side = lambda value: np.array([r[:-1] for r in rows.where(F.col("label") == value).select(
        *(f"f_{x}" for x in FEATURES), F.xxhash64("doc_id", F.lit(17)).alias("h")).orderBy("h").limit(fit_rows // 2).collect()], np.float64)
    better, worse = side(1), side(0)
    if not len(better) or not len(worse):
        n = len(FEATURES)
        rate = min(max(0.5 if rate is None else float(rate), 1e-6), 1 - 1e-6)
        return Ranker((0.0,) * n, (1.0,) * n, (0.0,) * n, 1.0, float(np.log(rate / (1 - rate))))
    return fit_pairs(better, worse)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id and score, its probability of label 1 by the ranking.

    ``labels``: doc_id, quality; only these rows teach. Null texts count as
    empty; null and repeated ids give rows of their own; an empty table gives
    none. Only id and text of ``docs`` are read.
    """
    table, ranker = learn(docs, labels, id_col, text_col, fit_rows)
    return table.select("doc_id", ranker.column().alias("score"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> tuple[DataFrame, Ranker]:
    """The features of all documents, and the ranking that the labelled ones teach."""
    table = written(features(docs, id_col, text_col), "quality-features")
    return table, fit_ranker(table, labels, fit_rows=fit_rows)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, whose score is at least ``least``."""
    _, ranker = learn(docs, labels, text_col=text_col)
    return filter_rows(docs, lambda raw, offsets: ranker.scores(text_features(raw, offsets)) >= least, text_col)


def keep_best(scores: DataFrame, share: float, accuracy: int = 10_000) -> DataFrame:
    """Rows whose score reaches the (1 - share) quantile of all scores; ties with the quantile stay."""
    bound = scores.agg(F.percentile_approx("score", 1 - share, accuracy)).first()[0]
    return scores.where(F.col("score") >= F.lit(bound)) if bound is not None else scores


def held_out(id_col: str = "doc_id") -> F.Column:
    """Documents that no label teaches: CRC-32 of the id's digits divisible by 5; a null id too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~held_out())
    scores = score_documents(docs, labels)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
