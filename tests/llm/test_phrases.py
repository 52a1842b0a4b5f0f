"""Phrases against plain counting."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from ride_analytics.llm import phrase_mining

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, support, top, covered=80):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    found = {p: a for p, a in counts.items() if a >= support and len(p[1]) > 1}
    out = {}
    for (lang, p), a in found.items():
        if any(y == lang and len(q) > len(p) and 100 * f >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q))) for (y, q), f in found.items()):
            continue
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, k + 1, p.decode(), -a, left, right, words[lang], -score) for lang, rows in out.items()
                  for k, (score, a, p, left, right) in enumerate(sorted(rows)[:top]))


def frame(spark, rows):
    return spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, f long, word string").repartition(3)


@pytest.mark.parametrize("support,top,block,parts", [(3, 40, 300, 2), (5, 2000, 4 << 20, 64), (2, 7, 1, 3)])
def test_phrases_equal_plain_counts(spark, support, top, block, parts):
    draw = random.Random(support)
    vocabulary = ["The", "of", "é", "Straße", "a", "b", "x-y", "naïve", "日本", " ", "''"]
    rows = [(draw.choice(["en", "fr", None, "und", ""]), "".join(draw.choice(vocabulary) + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(draw.randrange(0, 40))))
            for _ in range(80)]
    rows += [("en", None), (None, None), ("fr", ""), ("en", "a a a a a a a a a"), ("en", "a a a a a a a a a"), ("en", ".;,"), ("de", "only once"), ("en", "w " * 30_000)]
    got = phrase_mining.mine_phrases(frame(spark, rows), support=support, top=top, block_bytes=block, rank_parts=parts)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, support, top)


def test_frequent_groups_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(phrase_mining, "MERGED_PAIRS", 3)
    monkeypatch.setattr(phrase_mining.frequent_pairs, "__defaults__", (2,))
    rows = [("en", "one two three four five"), ("en", "one two three four six")] * 4
    got = phrase_mining.mine_phrases(frame(spark, rows), support=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 2000)


def test_empty_table(spark):
    assert phrase_mining.mine_phrases(frame(spark, [])).count() == 0


def test_first_ids_ascend_in_their_blocks(spark):
    """op11, disk: the first ids of a block's groups are kept as differences that are never negative, and read back whole."""
    draw = random.Random(4)
    rows = [("en", " ".join(draw.choice("abcdefgh") for _ in range(50))) for _ in range(40)]
    relation = phrase_mining.word_relation(frame(spark, rows), 500).cache()
    ids = spark.createDataFrame([(w, 90 - 7 * i) for i, w in enumerate("abcdefgh")], "word string, id long")
    kept = phrase_mining.word_groups(relation).join(ids, "word").select("block", "number", "id")
    out = phrase_mining.extended(relation, kept, False).cache()
    steps = [phrase_mining.unpacked_longs(r["first"], r["n_groups"]) for r in out.collect()]
    assert len(steps) > 1 and all((s >= 0).all() and len(s) > 8 for s in steps)
    known = dict(map(tuple, ids.collect()))
    want = Counter((known[a], known[b]) for _, t in rows for a, b in zip(t.split(), t.split()[1:]))
    assert {(r["first"], r["second"]) for r in phrase_mining.pair_groups(out).collect()} == set(want)
    got = {(r["first"], r["second"]): r["f"] for r in phrase_mining.frequent_pairs(out, 1).collect()}
    assert got == want


def test_ids_of_groups_travel_byte_by_byte():
    """op11: numbers come back as they were, and ids of many partitions take less room than eight bytes in a row each."""
    import pyarrow as pa
    from ride_analytics.llm.phrase_mining import packed_longs, unpacked_longs
    draw = np.random.default_rng(1)
    ids = np.concatenate([(np.int64(k) << 33) + np.arange(3000) for k in range(20)])[np.minimum(draw.zipf(1.2, 50_000), 59_999)]
    for numbers in (ids, np.array([-1, 0, 2**62, -2**63, 5]), np.zeros(0, np.int64)):
        blob = packed_longs(numbers)
        assert unpacked_longs(blob, len(numbers)).tolist() == numbers.tolist()
    assert len(packed_longs(ids)) < 0.85 * len(pa.compress(ids.tobytes(), codec="zstd", asbytes=True))
