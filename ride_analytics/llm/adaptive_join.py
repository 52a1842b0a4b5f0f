"""Jaccard join of shingle sets by adaptive prefixes: how many prefix tokens a pair must share follows each document's candidate cost."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import U64, WHITE, connected, mix, shingles, words
from ride_analytics.llm.run_index import pack_texts, unpack
from ride_analytics.sources.storage import cut, written

SIZE = 4                   # words of a shingle
PERCENT = 85
MOST_SHARED = 8            # the longest prefix asks for so many shared tokens
BLOCK_BYTES = 4 << 20      # text of a block
CHUNK_BYTES = 1 << 20      # text whose words are hashed at a time
BUCKET_TOKENS = 1_000_000  # tokens counted at a time
GROUP = 256                # documents of a token that one task compares at a time
PIVOT_ROUNDS = 3
MOST_MARKS = 96            # prefix tokens that travel with each posting; a longer prefix would cost their square
COUNT_BITS = 40            # of a token's hash by which documents are counted: what travels is short, and a count is never too small
CHECK_COST = 1 / 16        # of comparing one shingle of a candidate, against reading one posting


def hashed_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word and where each row's begin; each different word is hashed once."""
    low, starts, ends, first = words(raw, offsets)
    if not len(starts):
        return np.zeros(0, U64), first
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(low[~WHITE[low]].tobytes())])
    coded = found.dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], U64)
    return own[coded.indices.to_numpy()], first


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK_BYTES) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row. Words of long rows are hashed in chunks cut at white space."""
    cuts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + chunk)
        row = int(np.searchsorted(offsets, end, "right")) - 1
        if end < len(raw) and offsets[row] > at:
            end = int(offsets[row])  # whole rows
        elif end < len(raw):
            blank = np.flatnonzero(WHITE[raw[end:offsets[row + 1]]])
            end += int(blank[0]) if len(blank) else int(offsets[row + 1]) - end
        cuts.append((at, end))
        at = end
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for a, b in cuts:
        own, first = hashed_words(raw[a:b], np.clip(offsets, a, b) - a)
        hashes.append(own)
        counts += np.diff(first)
    found, begin = shingles(np.concatenate(hashes) if hashes else np.zeros(0, U64), np.concatenate(([0], np.cumsum(counts))), SIZE)
    return [np.unique(found[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def rows_of(batch: pa.RecordBatch):
    """Each block of a batch with its sets."""
    for r in batch.to_pylist():
        yield r, shingle_sets(*unpack(r["offsets"], r["texts"]))


def sketches(blocks: DataFrame) -> DataFrame:
    """block, row, doc_id, n_shingles, set_id (digest of the set; null without words) of every document."""

    def run(reader):
        for batch in reader:
            for r, sets in rows_of(batch):
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sets), r["block"])), pa.array(np.arange(len(sets))), pa.array(r["ids"], pa.int64()),
                                                  pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())],
                                                 ["block", "row", "doc_id", "n_shingles", "set_id"])

    return blocks.mapInArrow(run, "block long, row long, doc_id long, n_shingles long, set_id binary")


def packed_tokens(tokens: np.ndarray) -> bytes:
    """Sorted tokens as differences, byte by byte, so the upper bytes, mostly 0, cost nothing."""
    steps = np.diff(tokens, prepend=U64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpacked_tokens(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(raw.T).view(U64).ravel(), dtype=U64)


def shared_tokens(blocks: DataFrame, total: int, bucket_tokens: int, bits: int = COUNT_BITS) -> DataFrame:
    """block, n, tokens, counts (packed): the tokens of each block that several documents of the corpus hold, with how many.

    Tokens stand for their upper ``bits`` here. Two that agree in these are counted together: a token of one document
    may pass for a shared one, never the reverse, and each document sees the same count.

    Blocks cut their sorted tokens into buckets by range; the owner of a bucket counts them and answers each block.
    """
    buckets = max(1, -(-int(total) // bucket_tokens))
    edges = (np.arange(1, buckets, dtype=object) * 2**bits // buckets).astype(np.uint64)

    def slices(reader):
        for batch in reader:
            for r, sets in rows_of(batch):
                tokens, counts = np.unique(np.concatenate(sets) >> U64(64 - bits), return_counts=True) if sets else (np.zeros(0, U64), np.zeros(0, np.int64))
                bounds = np.concatenate(([0], np.searchsorted(tokens, edges), [len(tokens)]))
                own = np.flatnonzero(np.diff(bounds))
                blobs = [(packed_tokens(tokens[bounds[k]:bounds[k + 1]]), pa.compress(counts[bounds[k]:bounds[k + 1]].astype(np.uint32).tobytes(), codec="zstd", asbytes=True)) for k in own.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), r["block"])), pa.array(np.diff(bounds)[own]), pa.array([b[0] for b in blobs], pa.binary()),
                                                  pa.array([b[1] for b in blobs], pa.binary())], ["bucket", "block", "n", "tokens", "counts"])

    def count(rows):
        tokens = [unpacked_tokens(r["tokens"], r["n"]) for r in rows]
        counts = [np.frombuffer(pa.decompress(r["counts"], 4 * len(t), codec="zstd", asbytes=True), np.uint32) for r, t in zip(rows, tokens)]
        all_, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
        df = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)[inverse]
        out, at = [], 0
        for r, t in zip(rows, tokens):
            own = df[at:at + len(t)]
            at += len(t)
            if (own > 1).any():
                out.append((r["block"], int((own > 1).sum()), packed_tokens(t[own > 1]), pa.compress(own[own > 1].tobytes(), codec="zstd", asbytes=True)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                          ["block", "n", "tokens", "counts"])

    def merge(reader):
        rows, bucket = [], None
        for batch in reader:
            for r in batch.to_pylist():
                if rows and r["bucket"] != bucket:
                    yield count(rows)
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
        if rows:
            yield count(rows)

    cuts = blocks.mapInArrow(slices, "bucket long, block long, n long, tokens binary, counts binary")
    return cuts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "block long, n long, tokens binary, counts binary")


def least_overlap(n: int, percent: int) -> int:
    """Fewest tokens that a set of ``n`` shares with any similar one."""
    return -(-percent * n // 100)


def shared_wanted(counts: np.ndarray, alone: int, prefix: int, n: int, most: int) -> int:
    """How many shared prefix tokens a document asks for: the number of least estimated cost.

    ``counts``: documents of each token in the global order, of which ``alone``
    have one; ``prefix``: tokens of the prefix that asks for one. A longer prefix
    reads more postings, but a candidate must fill more of them.
    """
    end = np.minimum(prefix + np.arange(most), len(counts))
    scanned = np.concatenate(([0], np.cumsum(counts[alone:])))[end - alone]
    need = np.arange(1, most + 1)
    return int(np.argmin(scanned + scanned / need * (n * CHECK_COST))) + 1


def marks(tokens: np.ndarray) -> bytes:
    """Prefix tokens as 32-bit numbers, all different: two sets of them share at least as many as the tokens do."""
    short = np.sort((mix(tokens) & U64(0xFFFFFF)).astype(np.uint32))
    new = np.concatenate(([True], short[1:] != short[:-1]))
    again = np.arange(len(short)) - np.maximum.accumulate(np.where(new, np.arange(len(short)), 0))
    return (short << np.uint32(8) | np.minimum(again, 255).astype(np.uint32)).tobytes()


def postings(blocks: DataFrame, heads: DataFrame, shared: DataFrame, percent: int, most: int, bits: int = COUNT_BITS) -> DataFrame:
    """Postings (token, uid, n, wanted, marks) of the heads' prefixes, and their sets (uid, n, whole; token null).

    Tokens are ordered by their documents, counted by their upper ``bits``, then by value. Tokens of one document
    lead nowhere; a head whose shortest prefix holds no others has no partner and no row.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            told = right.to_pylist()
            tokens = np.concatenate([np.zeros(0, U64), *(unpacked_tokens(x["tokens"], x["n"]) for x in told)])
            counts = np.frombuffer(b"".join(pa.decompress(x["counts"], 8 * x["n"], codec="zstd", asbytes=True) for x in told), np.int64)
            order = np.argsort(tokens)
            tokens, counts = np.append(tokens[order], U64(2**64 - 1)), np.append(counts[order], 1)
            sets = shingle_sets(*unpack(r["offsets"], r["texts"]))
            for head in r["heads"]:
                own = sets[head["row"]]
                n = len(own)
                upper = own >> U64(64 - bits)
                place = np.searchsorted(tokens[:-1], upper)
                df = np.where(tokens[place] == upper, counts[place], 1)
                alone, prefix = int((df == 1).sum()), n - least_overlap(n, percent) + 1
                if alone >= prefix:
                    continue
                order = np.lexsort((own, df))
                wanted = shared_wanted(df[order], alone, prefix, n, min(most, least_overlap(n, percent))) if prefix + most - alone <= MOST_MARKS else 1
                sketch = marks(own[order[alone:prefix + wanted - 1]]) if wanted > 1 else b""
                out += [(t, head["uid"], n, wanted, sketch, None) for t in own[order[alone:prefix]].view(np.int64).tolist()]
                out.append((None, head["uid"], n, wanted, None, own.tobytes()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], ["token", "uid", "n", "wanted", "marks", "whole"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    asked = heads.groupBy("block").agg(F.collect_list(F.struct("row", "uid")).alias("heads"))
    left = blocks.join(asked, "block").select("block", "offsets", "texts", "heads")
    return left.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(run, "token long, uid long, n long, wanted long, marks binary, whole binary")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar."""

    def run(reader):
        for batch in reader:
            both = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            keep = [overlaps(np.frombuffer(x, U64), np.frombuffer(y, U64), percent) for x, y in both]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    left = pairs.join(sets.select(F.col("uid").alias("a"), F.col("whole").alias("x")), "a")
    return left.join(sets.select(F.col("uid").alias("b"), F.col("whole").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def part_links(part: dict, percent: int, whole: bool) -> list[tuple[int, int]]:
    """Links of a forest over the pairs of a part's two sides, or of its one side, that are in different components and
    share as many marks as either asks for; with ``whole`` only pairs whose whole sets are similar.

    What a link joins is one component from then on, so a part gives fewer links than it has members.
    """
    uid, n, wanted, side = (np.array(part[c]) for c in ("uid", "n", "wanted", "side"))
    label = np.unique(np.array(part["component"]), return_inverse=True)[1]
    if label.min() == label.max():
        return []
    own = [np.frombuffer(m, np.uint32) for m in part["marks"]]
    sets = [np.frombuffer(x, U64) for x in part["whole"]] if whole else None
    two = side[0] != side[-1]
    values, place = np.unique(np.concatenate(own), return_inverse=True)
    has = np.zeros((len(uid), len(values)), np.float32)
    has[np.repeat(np.arange(len(uid)), [len(m) for m in own]), place] = 1
    found = []
    for i in range(len(uid) - 1):
        j = np.arange(i + 1, len(uid))
        j = j[(label[j] != label[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        j = j[side[j] != side[i]] if two else j
        if len(j):
            need = np.minimum(wanted[j], wanted[i])
            j = j[(need == 1) | (has[j] @ has[i] >= need)]
        for k in j.tolist():
            if label[k] != label[i] and (not whole or overlaps(sets[i], sets[k], percent)):
                label[label == label[k]] = label[i]
                found.append((int(uid[i]), int(uid[k])))
    return found


def overlaps(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def links_of(parts: DataFrame, percent: int, whole: bool) -> DataFrame:
    """``part_links`` (a, b) of all parts. Partitions are sorted by part, so a task holds one part at a time."""

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    def stream(reader):
        held, found = None, []
        for batch in reader:
            columns = batch.to_pydict()
            part = np.array(columns["part"])
            edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))).tolist() if len(part) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                rows = {c: v[a:b] for c, v in columns.items()}
                if held is not None and held["part"][0] == rows["part"][0]:
                    held = {c: held[c] + rows[c] for c in held}
                    continue
                if held is not None and len(held["uid"]) > 1:
                    found += part_links(held, percent, whole)
                held = rows
            if len(found) > 10_000:
                yield batch_of(found)
                found = []
        if held is not None and len(held["uid"]) > 1:
            found += part_links(held, percent, whole)
        yield batch_of(found)

    rows = parts.select("part", "side", "uid", "n", "wanted", "component", "marks", *(["whole"] if whole else []))
    return rows.repartition("part").sortWithinPartitions("part", "side").mapInArrow(stream, "a long, b long")


def cross_parts(members: DataFrame, key: str, group: int) -> DataFrame:
    """Members dealt so that every two of one ``key`` in different components meet in a part: part, side.

    The largest component of a key needs no pairs of its own, so its hash
    classes of ``group`` members meet only those of the rest: rows grow with
    its size times the classes of the rest.
    """
    sizes = members.groupBy(key, "component").agg(F.count("*").alias("size"))
    of_key = sizes.groupBy(key).agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all"), F.count("*").alias("components")).where("components > 1")
    rows = members.join(of_key, key).withColumn("main", F.col("component") == F.col("top.component"))
    rows = rows.withColumn("mains", F.ceil(F.col("top.size") / group)).withColumn("rests", F.ceil((F.col("all") - F.col("top.size")) / group))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("uid"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))))
    one = F.lit(1).cast("bigint")
    across = F.when(F.col("main"), F.transform(F.sequence(one * 0, F.col("rests") - 1), lambda r: F.struct(F.xxhash64(key, F.lit("x"), F.col("own"), r).alias("part"), F.lit(0).alias("side"))))
    across = across.otherwise(F.concat(
        F.transform(F.sequence(one * 0, F.col("mains") - 1), lambda m: F.struct(F.xxhash64(key, F.lit("x"), m, F.col("own")).alias("part"), F.lit(1).alias("side"))),
        F.transform(F.sequence(one * 0, F.col("rests") - 1), lambda r: F.struct(F.xxhash64(key, F.lit("r"), F.least("own", r), F.greatest("own", r)).alias("part"),
                                                                                (F.col("own") > r).cast("int").alias("side")))))
    return rows.withColumn("at", F.explode(across)).select(*members.columns, "at.part", "at.side")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, most_shared: int = MOST_SHARED,
                       block_bytes: int = BLOCK_BYTES, bucket_tokens: int = BUCKET_TOKENS, group: int = GROUP, rounds: int = PIVOT_ROUNDS,
                       count_bits: int = COUNT_BITS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents are sets of distinct four-word shingles of the text with A-Z
    lower-cased (fewer words: the whole sequence). Two link when
    100 * intersection >= ``percent`` * union; a component is what links reach,
    named by its smallest id.

    1. Documents of one set are a class, and only one of it goes on.
    2. Tokens are counted over all documents. Of similar sets ordered by count, the prefixes of n - ceil(J n) + l
       tokens share at least l. Each document takes the l of the least estimated cost (``shared_wanted``); a pair must
       share the smaller of its two, and its first shared token lies in both prefixes of l = 1, which are posted. The
       prefix travels with each posting; very long ones, for which that costs most, take l = 1.
    3. ``rounds`` times, each posting list compares its members with one of them, drawn anew, whole sets at once. What
       this links is one component, so lists of near copies are done without pairs.
    4. Lists that still hold several components give a forest of the pairs across them that share enough prefix tokens;
       what it reaches is a cluster, whose members are compared across components, first on prefixes, then on whole sets.
       Both steps take lists and clusters in pairs of hash classes of ``group`` members and never emit pairs.

    No link is lost: the two filters are necessary conditions, and pairs of one component need none. Shingles are
    64-bit hashes (each different word hashed by its bytes). Null and blank texts have no shingles and link with nothing;
    rows that repeat an id are judged by their own texts; null ids stay, and name a component only if no other row of
    it has an id; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(pack_texts(rows, block_bytes), "join-blocks")
    sketch = written(sketches(blocks), "join-sketches")
    members = sketch.where("set_id IS NOT NULL")
    # the least id of a class names it; a null id only if there is no other
    heads = members.groupBy("set_id").agg(F.min("doc_id").alias("head"), F.min(F.struct("block", "row")).alias("at"))
    heads = written(heads.select("set_id", "head", "at.block", "at.row").withColumn("uid", F.monotonically_increasing_id()), "join-heads")
    total = sketch.agg(F.sum("n_shingles")).first()[0] or 0
    shared = shared_tokens(blocks, total, bucket_tokens, count_bits)
    found = written(postings(blocks, heads.select("block", "row", "uid"), shared, percent, most_shared, count_bits), "join-postings")
    sets = found.where("whole IS NOT NULL").select("uid", "n", "whole")
    lists = found.where("token IS NOT NULL").select("token", "uid", "n", "wanted", "marks")
    links, labels = None, None
    for k in range(rounds):
        narrow = lists.select("token", "uid", "n")
        if labels is not None:
            narrow = narrow.join(labels, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
        else:
            narrow = narrow.withColumn("component", F.col("uid"))
        pivot = narrow.groupBy("token").agg(F.min(F.struct(F.xxhash64("uid", F.lit(k)).alias("h"), "uid", "n", "component")).alias("p"), F.count("*").alias("c")).where("c > 1").select("token", "p")
        pairs = narrow.join(pivot, "token").where(f"component != p.component AND 100 * least(n, p.n) >= {int(percent)} * greatest(n, p.n)")
        pairs = pairs.select(F.least("uid", "p.uid").alias("a"), F.greatest("uid", "p.uid").alias("b")).distinct()
        own = cut(similar(pairs, sets, percent))
        links = own if links is None else links.union(own)
        labels = cut(connected(links, cut).withColumnRenamed("id", "uid"))
    labels = labels if labels is not None else lists.select("uid", F.col("uid").alias("component")).limit(0)
    rest = lists.join(labels, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    mixed = rest.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("token")
    rest = written(rest.join(mixed, "token"), "join-lists")
    near = links_of(cross_parts(rest, "token", group), percent, False)
    ties = rest.select(F.col("uid").alias("a"), F.col("component").alias("b")).distinct()
    clusters = connected(near.union(ties), cut).withColumnRenamed("id", "uid").withColumnRenamed("component", "cluster")
    known = rest.dropDuplicates(["uid"]).select("uid", "n", "wanted", "marks", "component").join(clusters, "uid")
    own = cut(links_of(cross_parts(known.join(sets.select("uid", "whole"), "uid"), "cluster", group), percent, True))
    links = own if links is None else links.union(own)
    reached = connected(links, cut).withColumnRenamed("id", "uid")
    named = heads.join(reached, "uid", "left").withColumn("component", F.coalesce("component", "uid")).select("set_id", "head", "component")
    names = named.groupBy("component").agg(F.min("head").alias("component_id"))
    named = named.join(names, "component").select("set_id", "component_id")
    return sketch.join(named, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
