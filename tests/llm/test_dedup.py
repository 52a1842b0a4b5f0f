"""Exact and near duplicates against brute force on small tables."""
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ride_analytics.llm import exact_dedup, minhash

DOCS = "doc_id long, text string, key string, head string, n_cp long"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


def test_exact_groups_nulls_blanks_ties_and_repeats(spark):
    rows = [(5, None), (3, ""), (4, " \n\t"), (1, "a b"), (2, "ab"), (9, "a  b"), (8, "a \nb"), (7, "c" * 50_000), (6, "c" * 50_000 + " "),
            (10, "A b"), (11, "a b"), (12, "z"), (12, "z"), (None, "q")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(frame(spark, rows), bucket_keys=2).collect()}
    assert got == {(5, 4, 3, False), (3, 4, 3, False), (4, 4, 3, True), (1, 8, 4, False), (2, 8, 4, False), (9, 8, 4, False), (8, 8, 4, True),
                   (7, 6, 2, False), (6, 6, 2, True), (10, 10, 1, True), (11, 11, 1, True), (12, 12, 2, True), (None, None, 1, True)}


def test_exact_empty_table_and_digest(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    row = exact_dedup.exact_duplicates(frame(spark, [(1, "é f\n")])).first()
    assert row.text_sha256 == hashlib.sha256("éf".encode()).hexdigest()


@pytest.mark.parametrize("cap", [1, 7, 1000])
def test_directory_splits_until_buckets_fit(spark, cap):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    index, _ = exact_dedup.hash_index(docs, bucket_keys=cap)
    buckets = index.groupBy("bucket_start", "depth").agg(F.countDistinct("key").alias("n"), F.min(F.col("key")).alias("lo")).collect()
    assert sum(b.n for b in buckets) == 500
    for b in buckets:
        assert b.n <= cap
        parent = [x for x in buckets if x.depth >= b.depth - 1 and b.depth and (x.bucket_start % 2**64) >> (65 - b.depth) == (b.bucket_start % 2**64) >> (65 - b.depth)]
        assert not b.depth or sum(x.n for x in parent) > cap  # no bucket is split without need


def test_directory_goes_on_below_its_first_leaves(spark):
    # 40 keys that share their first 14 bits and differ at once behind
    keys = spark.range(40).select((F.lit(5 << 50) + F.col("id") * (1 << 44)).alias("key"))
    tree = exact_dedup.directory(keys, 1).collect()
    assert {r.level for r in tree} == {1}
    assert len({r.bucket_start for r in tree}) == 40


def brute(rows, threshold):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(lower)) if x]
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= round(100 * threshold) * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("threshold,block", [(0.85, 8), (0.8, 256)])
def test_near_duplicates_equal_brute_force(spark, threshold, block):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(400)]
    rows, base = [], []
    for k in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice((60, 120, 300)))]
        for j in range(15):
            own = list(base)
            for _ in range(draw.randrange(0, 5)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            if j % 4 == 3:
                base = own  # chains
            rows.append((k * 100 + j, " ".join(own).upper() if j % 5 == 0 else "\n".join(own)))
    rows += [(2000, None), (2001, ""), (2002, " \t"), (2003, "one two"), (2004, "One  TWO"), (2005, "x"), (2006, "w " * 40_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows), threshold=threshold, block=block).collect()}
    assert got == brute(rows, threshold)


def test_near_duplicates_null_ids_and_empty_tables(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    got = minhash.near_duplicates(frame(spark, [(None, "a b c"), (None, None), (1, "a b c"), (2, "A b c"), (2, "A b c")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, -1, True), (1, 1, True), (2, 1, False), (2, 1, False)]


def test_pruning_bound_keeps_similar_pairs():
    least = minhash.least_matches(0.8, 1e-6, 140, 20)
    draw = np.random.default_rng(1)
    matches = np.cumsum(draw.random((20_000, 140)) < 0.8, axis=1)[:, 19::20]
    assert (matches >= np.array(least)).all(axis=1).mean() > 0.9995
    unlike = np.cumsum(draw.random((20_000, 140)) < 0.3, axis=1)[:, 19::20]
    assert (unlike[:, 1] >= least[1]).mean() < 0.1
