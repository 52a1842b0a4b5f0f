"""Phrases by SETM: sorted occurrence relations that are merge-joined with themselves, counted by group and cut to the frequent groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.llm.common import LOWER, batches, mix
from ride_analytics.sources.storage import written

BLOCK_BYTES = 2 << 20     # text whose occurrences are one row of the relation
MOST_WORDS = 4
SUPPORT = 30
TOP = 2000
MERGED_PAIRS = 1_000_000  # groups that a task merges before they are cut into buckets
BUCKET_PAIRS = 500_000    # groups of a bucket, before its owner merges them
BROADCAST_ROWS = 400_000  # frequent groups that are handed to all tasks; beyond, both sides are shuffled
RANK_PARTS = 64           # hash classes of a language's phrases that are ranked apart first

STOP = np.zeros(256, bool)
STOP[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True


def pieces_and_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the rows after lower-casing A-Z, their positions, and where each row's begin (one more than rows).

    Positions of neighbours differ by one inside a piece and by more across its border.
    """
    low = LOWER[raw]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = ~(STOP[low] | BLANK[low])
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(starts, offsets)
    piece = np.searchsorted(np.flatnonzero(STOP[low]), starts) + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(low[inside[:-1]].tobytes()))
    return found, np.arange(len(starts)) + piece, first


def packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 4 * n, codec="zstd", asbytes=True), np.int32) if n else np.zeros(0, np.int32)


def packed_longs(x: np.ndarray) -> bytes:
    """Byte by byte, all lowest bytes first: the upper ones repeat and take little room."""
    return packed(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).ravel())


def unpacked_longs(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def word_relation(docs: DataFrame, block_bytes: int) -> DataFrame:
    """R1, a row per block of texts: ``steps`` (differences of the positions) and ``groups`` (numbers of the words) of its occurrences in
    order; ``words``, ``langs`` and ``times`` of each number, packed; ``lang_names`` and ``lang_words``, the block's words per language."""

    def run(reader):
        for part, raw, offsets in batches(reader, "text", block_bytes):
            found, position, first = pieces_and_words(raw, offsets)
            coded = found.dictionary_encode()
            langs = part.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            lang = np.repeat(langs.indices.to_numpy(), np.diff(first))
            key = coded.indices.to_numpy().astype(np.int64) * max(1, len(names)) + lang
            own, number, times = np.unique(key, return_inverse=True, return_counts=True)
            text = "\n".join(coded.dictionary.take(pa.array(own // max(1, len(names)))).to_pylist()).encode()  # a word has no line break
            blobs = [packed(np.diff(position, prepend=0).astype(np.int32)), packed(number.astype(np.int32)), pa.compress(text, codec="zstd", asbytes=True),
                     packed((own % max(1, len(names))).astype(np.int32)), packed(times.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (len(number), len(own), len(text))] + [pa.array([x], pa.binary()) for x in blobs]
                + [pa.array([names], pa.list_(pa.string())), pa.array([np.bincount(lang, minlength=len(names))], pa.list_(pa.int64()))],
                ["n", "n_groups", "n_text", "steps", "groups", "words", "langs", "times", "lang_names", "lang_words"])

    schema = ("n long, n_groups long, n_text long, steps binary, groups binary, words binary, langs binary, times binary, lang_names array<string>, "
              "lang_words array<long>")
    return docs.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def word_groups(relation: DataFrame) -> DataFrame:
    """One row per block and word: block, number, lang, word, times."""

    def run(reader):
        for batch in reader:
            for r in batch.to_pylist():
                n = r["n_groups"]
                if n:
                    text = pa.decompress(r["words"], r["n_text"], codec="zstd", asbytes=True).decode()
                    langs = pa.DictionaryArray.from_arrays(pa.array(unpacked(r["langs"], n)), pa.array(r["lang_names"], pa.string())).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, r["block"])), pa.array(np.arange(n)), langs, pa.array(text.split("\n"), pa.string()),
                                                      pa.array(unpacked(r["times"], n).astype(np.int64))], ["block", "number", "lang", "word", "times"])

    return relation.select("block", "n_groups", "n_text", "words", "langs", "times", "lang_names").mapInArrow(
        run, "block long, number long, lang string, word string, times long")


def extended(relation: DataFrame, kept: DataFrame, keep_occurrences: bool) -> DataFrame:
    """R(k) from R(k-1) and ``kept`` (block, number, id of its frequent groups).

    The occurrences of frequent groups are merge-joined with themselves: those
    at neighbouring positions of a piece, each a run of k-1 words, overlap in
    all but their ends and make one of k. A group is the pair of their ids.
    """

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        if not len(blocks) or not len(told):
            return pa.Table.from_pylist([], names)
        r = blocks.to_pylist()[0]
        position = np.cumsum(unpacked(r["steps"], r["n"]), dtype=np.int64)
        groups = unpacked(r["groups"], r["n"])
        told = told.sort_by("id")      # so that first ids ascend, and their differences take little room
        number, ids = told.column("number").to_numpy(), told.column("id").to_numpy()
        place = np.full(int(max(groups.max(initial=0), number.max())) + 1, -1, np.int64)
        place[number] = np.arange(len(number))
        own = place[groups]
        position, own = position[own >= 0], own[own >= 0]
        at = np.flatnonzero(position[1:] == position[:-1] + 1)
        pairs, group, times = np.unique(own[at] * len(ids) + own[at + 1], return_inverse=True, return_counts=True)
        row = {"block": r["block"], "n": len(at), "n_groups": len(pairs), "steps": b"", "groups": b"", "first": packed_longs(np.diff(ids[pairs // len(ids)], prepend=0)),
               "second": packed_longs(ids[pairs % len(ids)]), "times": packed(times.astype(np.int32))}
        if keep_occurrences:
            row |= {"steps": packed(np.diff(position[at], prepend=0).astype(np.int32)), "groups": packed(group.astype(np.int32))}
        return pa.Table.from_pylist([row], names)

    names = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("n_groups", pa.int64()), ("steps", pa.binary()), ("groups", pa.binary()), ("first", pa.binary()),
                       ("second", pa.binary()), ("times", pa.binary())])
    blocks = relation.select("block", "n", "steps", "groups").groupBy("block")
    return blocks.cogroup(kept.groupBy("block")).applyInArrow(run, "block long, n long, n_groups long, steps binary, groups binary, first binary, second binary, times binary")


def pair_groups(relation: DataFrame) -> DataFrame:
    """One row per block and group: block, number, first, second."""

    def run(reader):
        for batch in reader:
            for r in batch.to_pylist():
                n = r["n_groups"]
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, r["block"])), pa.array(np.arange(n)), pa.array(np.cumsum(unpacked_longs(r["first"], n))),
                                                      pa.array(unpacked_longs(r["second"], n))], ["block", "number", "first", "second"])

    return relation.select("block", "n_groups", "first", "second").mapInArrow(run, "block long, number long, first long, second long")


def sums_of_sorted(first: np.ndarray, second: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, each once, with its summed times."""
    order = np.lexsort((second, first))
    first, second, times = first[order], second[order], times[order]
    new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))) if len(first) else np.zeros(0, np.int64)
    return first[new], second[new], np.add.reduceat(times, new) if len(new) else times


def frequent_pairs(relation: DataFrame, support: int, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """first, second, f of the groups of all blocks that reach ``support``.

    A task merges the sorted groups of its blocks and cuts them by hash into
    buckets, which travel as compressed sorted arrays; the owner of a bucket
    merges and counts them. The number of buckets follows the groups, so a bucket's size does not grow.
    """
    total = relation.agg(F.sum("n_groups")).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_pairs))

    def slices(parts):
        first, second, times = sums_of_sorted(*(np.concatenate(x) for x in zip(*parts)))
        bucket = (mix(first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= len(bucket) else np.append(np.unique(bucket[order], return_index=True)[1], len(bucket))
        rows = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b > a:
                own = order[a:b]
                rows.append((int(bucket[own[0]]), b - a, packed_longs(np.diff(first[own], prepend=0)), packed_longs(second[own]), packed_longs(times[own])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64()] + [pa.binary()] * 3)],
                                          ["bucket", "n", "first", "second", "times"])

    def cut(reader):
        parts, size = [], 0
        for batch in reader:
            for r in batch.to_pylist():
                n = r["n_groups"]
                if n:
                    parts.append((np.cumsum(unpacked_longs(r["first"], n)), unpacked_longs(r["second"], n), unpacked(r["times"], n).astype(np.int64)))
                    size += n
                if size >= MERGED_PAIRS:
                    yield slices(parts)
                    parts, size = [], 0
        if parts:
            yield slices(parts)

    def count(parts):
        first, second, times = sums_of_sorted(*(np.concatenate(x) for x in zip(*parts)))
        own = times >= support
        return pa.RecordBatch.from_arrays([pa.array(x[own]) for x in (first, second, times)], ["first", "second", "f"])

    def merge(reader):
        parts, bucket = [], None
        for batch in reader:
            for r in batch.to_pylist():
                if parts and r["bucket"] != bucket:
                    yield count(parts)
                    parts = []
                bucket, n = r["bucket"], r["n"]
                parts.append((np.cumsum(unpacked_longs(r["first"], n)), unpacked_longs(r["second"], n), unpacked_longs(r["times"], n)))
        if parts:
            yield count(parts)

    cuts = relation.select("n_groups", "first", "second", "times").mapInArrow(cut, "bucket long, n long, first binary, second binary, times binary")
    return cuts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "first long, second long, f long")


def semi_joined(groups: DataFrame, frequent: DataFrame, keys: list[str]) -> DataFrame:
    """block, number, id of the groups that are frequent. Few frequent groups, by their count, are broadcast."""
    small = frequent.select(*keys, "id")
    if frequent.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return groups.join(small, keys).select("block", "number", "id")


def frequent_phrases(docs: DataFrame, most_words: int, support: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``most_words`` words that occur at least ``support`` times (lang, phrase, words, f), and lang, n."""
    relation = written(word_relation(docs, block_bytes), "phrase-relation-1")
    per_lang = relation.select(F.explode(F.arrays_zip("lang_names", "lang_words")).alias("x")).select(F.col("x.lang_names").alias("lang"), F.col("x.lang_words").alias("n"))
    totals = per_lang.groupBy("lang").agg(F.sum("n").alias("n"))
    groups = word_groups(relation)
    counts = groups.groupBy("lang", "word").agg(F.sum("times").alias("f")).where(F.col("f") >= support)
    frequent = written(counts.withColumn("id", F.monotonically_increasing_id()), "phrase-frequent-1")
    kept = semi_joined(groups, frequent, ["lang", "word"])
    level = frequent.select("lang", F.col("word").alias("phrase"), F.array("word").alias("words"), "f", "id")
    levels = [level]
    for k in range(2, most_words + 1):
        relation = written(extended(relation, kept, k < most_words), f"phrase-relation-{k}")
        frequent = written(frequent_pairs(relation, support).withColumn("id", F.monotonically_increasing_id()), f"phrase-frequent-{k}")
        if k < most_words:
            kept = semi_joined(pair_groups(relation), frequent, ["first", "second"])
        heads = level.select(F.col("id").alias("first"), "lang", F.col("words").alias("head"))
        tails = level.select(F.col("id").alias("second"), F.element_at("words", -1).alias("tail"))
        named = frequent.join(heads, "first").join(tails, "second").select("lang", F.concat("head", F.array("tail")).alias("words"), "f", "id")
        level = written(named.select("lang", F.array_join("words", " ").alias("phrase"), "words", "f", "id"), f"phrase-level-{k}")
        levels.append(level)
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out.drop("id"), totals


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS, support: int = SUPPORT, top: int = TOP,
                 covered: int = 80, block_bytes: int = BLOCK_BYTES, rank_parts: int = RANK_PARTS) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, with A-Z lower-cased, are cut into pieces at ``.,;:!?`` and line
    breaks, and pieces into words at spaces and tabs. f(phrase) counts all its
    occurrences inside pieces, overlaps included; n all words. Candidates have 2
    to ``most_words`` words and a = f >= ``support``. Cut after k words, with l
    and r the counts of both parts, a phrase scores floor(2000000 * a / (l + r));
    its lowest cut counts, of equals the first. Candidates inside a longer
    candidate with 100 * f(longer) >= ``covered`` * a are dropped, those that are
    dropped themselves included. The order is by score and a, descending, and phrase.

    SETM: the occurrence relation is written sorted by piece and position, a row
    per block of texts; each round merge-joins it with itself at the next
    position, counts the groups over all blocks, and the semi-join with the
    frequent ones goes back to the blocks. Groups are named by ids of written
    frequent phrases, never by hashes, so counts are exact. Blocks emit each
    group once, so a hot phrase is a row per block.

    Null texts count as empty, a null language as ``und``; equal rows count again;
    long texts are blocks of their own; no rows give no rows; other columns are
    not read. Products are decimals of 38 digits.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    phrases, totals = frequent_phrases(rows, most_words, support, block_bytes)
    phrases = written(phrases, "phrase-all")
    known = phrases.select("lang", "phrase", "f")
    longer = phrases.where(F.size("words") > 1)
    # every way to cut a candidate in two
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # the largest count of a longer candidate around each phrase
    inner = longer.where(F.size("words") > 2).select("lang", "f", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    inner = inner.select("lang", "f", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    around = inner.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("f").alias("around"))
    free = scored.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(F.expr(f"cast(around as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {int(covered)}"), F.lit(True)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    free = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(rank_parts)).alias("part"))
    best = free.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir):
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
g AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k),
f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cut AS (
    SELECT c.lang, c.phrase, c.k AS size, c.f AS a, j.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
    FROM (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1) c
    JOIN (VALUES (1), (2), (3)) AS j(k) ON j.k < c.k
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:j.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[j.k + 1:], ' ')),
scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, max(f) AS around FROM (
        SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 2), (VALUES (2), (3)) AS s(s) WHERE s < k)
    GROUP BY ALL),
free AS (
    SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.around IS NULL OR 100 * i.around < 80 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(n.n AS BIGINT) AS n, r.score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""
