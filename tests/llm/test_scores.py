"""Quality ranking by held-out accuracy, language-model scores by brute force."""
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ride_analytics.llm import ppm, quality_ranker

DOCS = "doc_id long, text string, score double, label int, f_upper double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 1, 1.0) for i, t in rows], DOCS)


def quality_rows(n):
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(1, 9))) for _ in range(900)]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(20, 200))]
        bad = i % 4 == 0
        rows.append((i, "\n".join(" ".join(w.upper() + "!!" if bad else w for w in words[k:k + 12]) for k in range(0, len(words), 12)), int(not bad)))
    return rows


def test_ranking_holds_on_documents_that_taught_nothing(spark):
    rows = quality_rows(400)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2], "doc_id long, quality int").union(
        spark.createDataFrame([(i, y) for i, _, y in rows if i % 8 == 0], "doc_id long, quality int"))
    scores = {r.doc_id: r.score for r in quality_ranker.score_documents(frame(spark, [r[:2] for r in rows]), labels).collect()}
    tested = [(scores[i], y) for i, _, y in rows if i % 2 == 0 and i % 8]
    assert np.mean([(s >= 0.5) == y for s, y in tested]) > 0.98
    assert all(0 <= s <= 1 for s in scores.values())


def test_scores_of_odd_rows_and_labels(spark):
    rows = [(i, t) for i, t, _ in quality_rows(60)] + [(100, None), (101, ""), (102, "x" * 300_000), (None, "a"), (5, "again")]
    labels = spark.createDataFrame([(i, y) for i, _, y in quality_rows(60)] + [(None, 1), (3, None), (3, 1), (100, 0)], "doc_id long, quality int")
    got = quality_ranker.score_documents(frame(spark, rows), labels)
    assert got.count() == len(rows) and got.where("score IS NULL OR isnan(score) OR score < 0 OR score > 1").isEmpty()
    assert quality_ranker.score_documents(frame(spark, []), labels).count() == 0
    none = quality_ranker.score_documents(frame(spark, rows), labels.where("false"))
    assert {r.score for r in none.collect()} == {0.5}
    kept = quality_ranker.keep_good(frame(spark, rows), labels)
    assert kept.columns == ["doc_id", "text", "score", "label", "f_upper"]
    by_column = {r.doc_id for r in got.where("score >= 0.3").collect()}
    assert {r.doc_id for r in kept.collect()} == by_column


def test_quantile_keeps_the_best_share(spark):
    scores = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") / 1000.0).alias("score"))
    assert abs(quality_ranker.keep_best(scores, 0.25).count() - 250) <= 2
    assert quality_ranker.keep_best(scores.where("false"), 0.25).count() == 0


def brute_ppm(train, text, order):
    children = {}
    for t in train:
        s = [257] * order + list(t) + [256]
        for k in range(order, len(s)):
            for n in range(order + 1):
                children.setdefault(tuple(s[k - n:k]), Counter())[s[k]] += 1
    total, s = 0.0, [257] * order + list(text) + [256]
    for k in range(order, len(s)):
        excluded = set()
        for n in range(order, -1, -1):
            seen = {a: c for a, c in children.get(tuple(s[k - n:k]), {}).items() if a not in excluded}
            if not seen:
                continue
            if s[k] in seen:
                total += math.log10((seen[s[k]] - 0.5) / sum(seen.values()))
                break
            total += math.log10(len(seen) / 2 / sum(seen.values()))
            excluded |= set(seen)
        else:
            total -= math.log10(257 - len(excluded))
    return total


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_scores_equal_brute_force(spark, block):
    rows = [(i, t) for i, t, _ in quality_rows(25)] + [(90, None), (91, ""), (92, "  \n"), (93, "é\x00ü ABC abc"), (94, "ab" * 3000), (95, "only here 日本"), (None, "z")]
    trains = F.col("doc_id") % 3 != 0
    got = ppm.score_documents(frame(spark, rows), trains, block_bytes=block).collect()
    assert len(got) == len(rows)
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    texts = {i: (t or "").encode().translate(lower) for i, t in rows}
    train = [t for i, t in texts.items() if i is not None and i % 3]
    counts = Counter(w for t in train for w in t.split())
    n = sum(counts.values()) + len(train)
    v = len(counts) + 1
    for r in got:
        words = texts[r.doc_id].split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id is None or r.doc_id % 3 == 0, len(words) + 1, sum(w in counts for w in words) + 1, n)
        assert abs(r.base_score - base) < 1e-6
        assert abs(r.score - brute_ppm(train, texts[r.doc_id], ppm.ORDER)) < 1e-3 * (1 + abs(r.score))


def test_no_training_text_and_no_rows(spark):
    got = ppm.score_documents(frame(spark, [(1, "ab"), (2, None)]), F.lit(False)).collect()
    assert {r.doc_id: round(r.score, 6) for r in got} == {1: round(-3 * math.log10(257), 6), 2: round(-math.log10(257), 6)}
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)}
    assert ppm.score_documents(frame(spark, []), F.lit(True)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    draw = np.random.default_rng(4)
    texts = [draw.integers(97, 103, 400).astype(np.uint8) for _ in range(5)]
    raw, offsets = np.concatenate(texts), np.arange(6) * 400
    keys, counts = np.unique(ppm.grams(raw, offsets, 3)[0], return_counts=True)
    levels = ppm.levels_of(keys, counts.astype(np.int64), 3, ppm.lowest_levels(keys & np.uint64((1 << 18) - 1), counts.astype(np.int64)))
    for context in (0, 97, (97 << 9) | 98, (97 << 18) | (98 << 9) | 102, (5 << 18) | (257 << 9) | 257):
        after = (np.uint64(context) << np.uint64(9)) | np.arange(257, dtype=np.uint64)
        assert abs((10.0 ** ppm.code_log10(after, levels)).sum() - 1) < 1e-9
