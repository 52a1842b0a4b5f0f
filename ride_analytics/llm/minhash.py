"""Near-duplicates by MinHash bands with sequential Bayesian verification, and exact confirmation of the survivors."""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import U64, batches, connected, shingles, word_hashes, words
from ride_analytics.sources.storage import cut, written

ROWS = 5          # hashes per band
BANDS = 28        # at a similarity of 0.85 all bands miss a pair with a probability of 1e-7
BATCH = 20        # hashes compared at a time
BLOCK = 256       # documents per block of a large group
CHUNK_BYTES = 1 << 20


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(9_000_001)
    return draw.integers(1, 2**63, n, dtype=np.uint64) * U64(2) + U64(1), draw.integers(0, 2**63, n, dtype=np.uint64)


def signatures(hashes: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """MinHash signatures of rows that all have shingles: (rows, size) of 16 bits of each least hash."""
    out = np.empty((len(begin) - 1, size), np.uint16)
    for k, (a, b) in enumerate(zip(*_seeds(size))):
        out[:, k] = np.minimum.reduceat(((hashes * a + b) >> U64(32)).astype(np.uint32), begin[:-1]) & np.uint32(0xFFFF)
    return out


@functools.lru_cache(maxsize=64)
def least_matches(threshold: float, miss: float, size: int, batch: int) -> tuple[int, ...]:
    """For each number of compared hashes, the fewest matches that keep a pair.

    With a uniform prior the similarity after m matches of n has a
    Beta(m + 1, n - m + 1) posterior. A pair goes when the posterior probability
    of a similarity of at least ``threshold`` is below ``miss``.
    """
    grid = (np.arange(20000) + 0.5) / 20000
    out = []
    for n in range(batch, size + 1, batch):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(log - log.max())
            if mass[grid >= threshold].sum() / mass.sum() >= miss:
                break
        out.append(m)
    return tuple(out)


def spanning_links(n: np.ndarray, side: np.ndarray, signature: np.ndarray, threshold: float, miss: float, confirm=None) -> list[tuple[int, int]]:
    """Links of a spanning forest of the similar pairs of one part: pairs across its two sides, or any if it has one.

    A search from each member reaches its similar ones among those not reached
    yet, so a part of copies takes a step per member and no pair is kept. Sizes
    rule out members first (a similarity needs sizes in that ratio), then the
    batches of the signatures; ``confirm(i, j)`` decides on a survivor.
    """
    least = least_matches(threshold, miss, signature.shape[1], BATCH)
    two = side[0] != side[-1]
    rest, out = np.ones(len(n), bool), []
    for start in range(len(n)):
        if not rest[start]:
            continue
        rest[start] = False
        queue = [start]
        while queue:
            x = queue.pop()
            at = np.flatnonzero(rest & (side != side[x])) if two else np.flatnonzero(rest)
            at = at[np.minimum(n[at], n[x]) >= threshold * np.maximum(n[at], n[x]) - 1e-9]
            matches = np.zeros(len(at), np.int64)
            for k, need in enumerate(least):
                if not len(at):
                    break
                own = slice(k * BATCH, (k + 1) * BATCH)
                matches += (signature[at, own] == signature[x, own]).sum(axis=1)
                at, matches = at[matches >= need], matches[matches >= need]
            for y in at.tolist():
                if confirm is None or confirm(x, y):
                    rest[y] = False
                    queue.append(y)
                    out.append((x, y))
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the shingle set), signature (binary) of every document."""

    def sketch(reader):
        for part, raw, offsets in batches(reader, "text", CHUNK_BYTES):
            low, starts, ends, first = words(raw, offsets)
            found, begin = shingles(word_hashes(low, starts, ends), first)
            number = np.zeros(len(part), np.int64)
            ids, blobs = [None] * len(part), [None] * len(part)
            full = np.flatnonzero(np.diff(begin))
            if len(full):
                each = signatures(found, np.append(begin[:-1][full], begin[-1]), size)
                for k, row in enumerate(full.tolist()):
                    own = np.unique(found[begin[row]:begin[row + 1]])
                    number[row], ids[row], blobs[row] = len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), each[k].tobytes()
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(number), pa.array(ids, pa.binary()), pa.array(blobs, pa.binary())],
                                             ["doc_id", "n_shingles", "set_id", "signature"])

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, set_id binary, signature binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``docs`` with the sorted shingle hashes of each text as one binary value in place of the text."""

    def sets(reader):
        for part, raw, offsets in batches(reader, "text", CHUNK_BYTES):
            low, starts, ends, first = words(raw, offsets)
            found, begin = shingles(word_hashes(low, starts, ends), first)
            blobs = [np.unique(found[a:b]).tobytes() for a, b in zip(begin[:-1], begin[1:])]
            columns = [part.column(c) if c != "text" else pa.array(blobs, pa.binary()) for c in part.schema.names]
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    schema = ", ".join(f"{f.name} {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(sets, schema).withColumnRenamed("text", "shingle_set")


def block_pairs(members: DataFrame, group: str, order: list[str], block: int) -> DataFrame:
    """Members dealt to pairs of blocks of their group: every two members of a group meet in one pair of blocks.

    A group of at most ``block`` members is one task; a larger one is cut into
    blocks, and each member goes to as many pairs as there are blocks. Rows gain
    part (the pair's name) and side (which block it stands in).
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("members")).where("members > 1")
    rows = members.join(sizes, group)
    # a block of a large group is a hash class of its members, so no task has to sort or number a group
    rows = rows.withColumn("blocks", F.ceil(F.col("members") / block)).withColumn("own", F.pmod(F.xxhash64(*order), F.col("blocks")))
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.withColumn("other", other)
    # parts that share a hash are compared as one, which only compares more
    return (rows.withColumn("part", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")))
            .withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("members", "blocks", "own", "other", group))


def links_of_parts(parts: DataFrame, threshold: float, miss: float, exact: bool) -> DataFrame:
    """Spanning links (a, b) of each part: by signatures, or ``exact`` by whole shingle sets too.

    Partitions are sorted by part and read as a stream, so a task holds one part at a time and small parts cost little.
    """

    def links(rows):
        part, ids = rows.column("part").to_numpy(), rows.column("doc_id").to_numpy()
        n, side = rows.column("n_shingles").to_numpy(), rows.column("side").to_numpy()
        signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(len(ids), -1)
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingle_set").to_pylist()] if exact else None
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        found = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            confirm = None
            if exact:
                def confirm(x, y, base=a):
                    x, y = sets[base + x], sets[base + y]
                    both = np.concatenate((x, y))
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    return 100 * shared >= round(100 * threshold) * (len(x) + len(y) - shared)
            found += [(a + x, a + y) for x, y in spanning_links(n[a:b], side[a:b], signature[a:b], threshold, miss, confirm)]
        x, y = np.array(found, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], ["a", "b"])

    def stream(reader):
        held = None
        for batch in reader:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            part = rows.column("part").to_numpy()
            if not len(part):
                continue
            last = int(np.searchsorted(part, part[-1], "left"))  # the last part may go on in the next batch
            if last:
                yield links(rows.slice(0, last).combine_chunks())
            held = rows.slice(last)
        if held is not None and len(held):
            yield links(held.combine_chunks())

    columns = ["part", "side", "doc_id", "n_shingles", "signature", *(["shingle_set"] if exact else [])]
    return parts.select(*columns).repartition("part").sortWithinPartitions("part", "side", "doc_id").mapInArrow(stream, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, miss: float = 1e-6,
                    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are sets of distinct five-word shingles of the text with A-Z
    lower-cased (a shorter text is one shingle; one without words, or null, has
    none and is linked with nothing). Two are linked at a Jaccard similarity of at
    least ``threshold``; a component is what links reach, named by its smallest id.

    1. Documents of one shingle set are one class; only its smallest id goes on.
    2. Classes that share a band of their signatures are candidates. Batches of
       the signatures are compared one by one, and a pair goes as soon as its
       posterior probability of being similar is below ``miss``. Each group of
       candidates gives the links of a spanning forest, never its pairs.
    3. Components of these links are compared again, now with whole sets: a
       link is a link only by the exact similarity. Large groups are cut into
       pairs of blocks of ``block`` members, in both steps.

    A pair is missed when all bands miss it, with probability (1 - J**rows)**bands,
    or when pruned. Ids should not repeat; rows that repeat an id get the same
    component. Null ids are kept with a null component. Empty tables give no
    rows; other columns are not read.
    """
    size = math.ceil(bands * rows / BATCH) * BATCH
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = texts.where("doc_id IS NOT NULL")
    sketch = written(sketches(texts, size), "minhash-sketches")
    # classes of equal sets: the digest stands for the set, copies merge before the shuffle
    classes = sketch.where("doc_id IS NOT NULL AND set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("head"))
    members = sketch.where("set_id IS NOT NULL AND doc_id IS NOT NULL").join(classes, "set_id")
    heads = members.where("doc_id = head").dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "signature")
    heads = written(heads, "minhash-heads")
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("signature", 2 * rows * k + 1, 2 * rows)) for k in range(bands)])
    banded = heads.select("doc_id", F.explode(keys).alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    banded = cut(banded.join(shared, "band"))
    rough = links_of_parts(block_pairs(banded.join(heads, "doc_id"), "band", ["doc_id"], 4 * block), threshold, miss, False)
    groups = connected(rough, cut).select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    sets = shingle_sets(known.join(groups, "doc_id")).dropDuplicates(["doc_id"])
    full = sets.join(heads, "doc_id")
    links = links_of_parts(block_pairs(full, "cluster", ["doc_id"], block), threshold, miss, True)
    found = connected(links, cut)
    named = classes.join(found, classes["head"] == found["id"], "left").select("set_id", F.coalesce("component", "head").alias("root"))
    return sketch.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, threshold=0.85)
