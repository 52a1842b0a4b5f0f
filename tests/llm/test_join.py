"""Adaptive-prefix join against all pairs on small tables."""
import itertools
import random
import re

import numpy as np
import pytest

from ride_analytics.llm import adaptive_join

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, percent):
    sets = []
    for _, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        sets.append(frozenset(tuple(w[k:k + 4]) for k in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            up[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, 9) for i, t in rows], "doc_id long, text string, token string, n long, block long").repartition(3)


def documents(seed, groups=10, copies=14):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    passage = [draw.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [draw.choice(vocabulary) for _ in range(draw.choice((5, 20, 60, 150)))]
        for j in range(copies):
            own = list(base)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            if j % 4 == 3:
                base = own  # chains
            if j % 5 == 4:
                own = own + passage
            rows.append((len(rows) * 7 % 1009, " ".join(own)))
    return rows


@pytest.mark.parametrize("percent,group,bucket,rounds,block", [(85, 256, 1_000_000, 2, 4 << 20), (80, 4, 50, 0, 700), (85, 3, 7, 1, 1)])
def test_components_equal_all_pairs(spark, percent, group, bucket, rounds, block):
    rows = documents(percent + group)
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE "), (2005, "one two three"), (2006, "one two\tthree"), (2007, "a b c d"), (2007, "a b c d"),
             (2007, "other text with this id"), (None, "a b c d"), (None, "no id at all here"), (2008, "w " * 30_000), (2009, "É é É é x")]
    got = adaptive_join.jaccard_components(frame(spark, rows), percent=percent, group=group, bucket_tokens=bucket, rounds=rounds, block_bytes=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, percent)


@pytest.mark.parametrize("bits", [3, 12, 40, 64])
def test_counts_by_upper_bits_lose_no_link(spark, bits):
    """op12's disk: only the upper bits of a token travel to be counted; tokens that agree in them pass for more frequent ones."""
    rows = documents(5)
    got = adaptive_join.jaccard_components(frame(spark, rows), count_bits=bits, bucket_tokens=500, block_bytes=5000)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 85)


def test_counted_tokens_travel_short(spark):
    draw = random.Random(3)
    rows = [(k, " ".join(str(draw.randrange(10**6)) for _ in range(4000))) for k in range(5)]
    blocks = adaptive_join.pack_texts(frame(spark, rows + rows).select("doc_id", "text"), 4 << 20)
    r = adaptive_join.shared_tokens(blocks, 40_000, 1_000_000).selectExpr("sum(n) AS n", "sum(length(tokens)) AS bytes").first()
    assert r.n > 15_000 and r.bytes < 5 * r.n      # 7 bytes each as whole hashes


def test_near_copies_are_one_component_without_their_pairs(spark, monkeypatch):
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(base[:k % 197] + [f"own{k}"] + base[k % 197 + 1:])) for k in range(600)]
    seen = []
    real = adaptive_join.similar
    monkeypatch.setattr(adaptive_join, "similar", lambda pairs, *rest: (seen.append(pairs.count()), real(pairs, *rest))[1])
    got = adaptive_join.jaccard_components(frame(spark, rows))
    assert {r.component_id for r in got.collect()} == {0}
    assert sum(seen) < 40 * len(rows)  # of 179,700 pairs


def test_long_rows_are_hashed_in_chunks_alike():
    draw = np.random.default_rng(2)
    texts = [" ".join(map(str, draw.integers(0, 40, n))) for n in (0, 3, 500, 2, 900)] + ["x" * 300, " " * 200, "a  b"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    want = [s.tolist() for s in adaptive_join.shingle_sets(raw, offsets)]
    for chunk in (1, 17, 100, 1000):
        assert [s.tolist() for s in adaptive_join.shingle_sets(raw, offsets, chunk)] == want


def test_empty_table(spark):
    assert adaptive_join.jaccard_components(frame(spark, [])).count() == 0
