"""Language-model scores of documents: prediction by partial matching over bytes, and a smoothed word model beside it.

The corpus is dealt to blocks of documents. A block's distinct byte strings (and
words) with their counts go, as sorted arrays, to slices of the key space; a
slice adds them up, which is its part of the trie, and answers every block with
the code lengths of that block's own strings. So neither a task nor the driver
ever holds the trie, only the part that one block or one slice needs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import LOWER, U64, mix, text_bytes, word_hashes, words
from ride_analytics.sources.storage import written

ORDER = 5                 # bytes of context
BITS = U64(9)             # per symbol: 256 bytes, the end of a text, and what stands before a text
END, START = 256, 257
ALPHABET = 257            # symbols that can follow a context
BLOCK_BYTES = 8 << 20     # text of one block
MERGE_ROWS = 1 << 22      # entries a slice gathers before it adds them up


def grams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text and its end, the symbol with the ``order`` symbols before it as one number, and
    where each text's begin. What stands before a text is a symbol of its own."""
    n = len(offsets) - 1
    begin = offsets + np.arange(n + 1) * (order + 1)  # room for ``order`` start symbols and an end
    symbols = np.full(begin[-1], START, np.uint64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    symbols[np.arange(len(raw)) + (row + 1) * order + row] = raw
    symbols[begin[1:] - 1] = END
    out = symbols.copy()
    for k in range(1, order + 1):
        out[order:] |= symbols[order - k:len(symbols) - k] << (BITS * U64(k))
    keep = np.ones(len(symbols), bool)
    keep[(begin[:-1, None] + np.arange(order)).ravel()] = False
    return out[keep], offsets + np.arange(n + 1)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slice of each gram: by the symbol before the last and the one before that, so a context of two or more symbols
    has all its children, and all longer contexts that end with it, in one slice."""
    return (mix((keys >> BITS) & U64((1 << 18) - 1)) % U64(slices)).astype(np.int64)


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Level:
    """Children of the contexts of one length: sorted grams with counts, and per context total, distinct children, and
    how often these children follow the context that is one symbol shorter (what exclusion takes from it)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        contexts = keys >> BITS
        first = np.flatnonzero(np.concatenate((contexts[:1] == contexts[:1], contexts[1:] != contexts[:-1])))
        self.contexts = contexts[first]
        self.total = np.add.reduceat(counts, first).astype(np.float64) if len(first) else np.zeros(0)
        self.distinct = np.diff(np.append(first, len(keys))).astype(np.float64)
        self.first = first
        self.excluded = np.zeros(len(first))

    def exclude(self, shorter: "Level | None", length: int) -> None:
        if length == 0:
            return
        cut = self.keys & U64((1 << (9 * length)) - 1)
        at = np.searchsorted(shorter.keys, cut)
        same = shorter.counts[np.minimum(at, len(shorter.keys) - 1)] if len(shorter.keys) else np.zeros(len(cut))
        self.excluded = np.add.reduceat(same, self.first).astype(np.float64) if len(self.first) else np.zeros(0)


def levels_of(keys: np.ndarray, counts: np.ndarray, order: int, lowest: list[Level]) -> list[Level]:
    """Levels of contexts of 0 to ``order`` symbols: ``lowest``, then those of sorted, distinct grams of ``order`` + 1."""
    out = []
    for length in range(order, len(lowest) - 1, -1):
        if length < order:
            keys, counts = add_up(keys & U64((1 << (9 * (length + 1))) - 1), counts)
        out.append(Level(keys, counts))
    out = lowest + out[::-1]
    for length in range(len(lowest), order + 1):
        out[length].exclude(out[length - 1], length)
    return out


def lowest_levels(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels of contexts of no and one symbol from grams of two symbols."""
    return levels_of(*add_up(keys, counts), 1, [])


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return at, (sorted_keys[at] == wanted) if len(sorted_keys) else np.zeros(len(wanted), bool)


def code_log10(wanted: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of the last symbol of each gram after the symbols before it, by escape method D with exclusion.

    Scoring begins at the longest context that the trie has. A symbol that
    followed it has the probability (2 c - 1) / 2 T; else the escape D / 2 T is
    paid and the next shorter context is asked, without the symbols that
    followed the longer one: their counts leave T, their number leaves D. Below
    the empty context all symbols that are not excluded are equal.
    """
    result, excluded_total, excluded_distinct = np.zeros(len(wanted)), np.zeros(len(wanted)), np.zeros(len(wanted))
    left = np.arange(len(wanted))  # grams without a code length yet
    for length in range(len(levels) - 1, -1, -1):
        level, gram = levels[length], wanted[left] & U64((1 << (9 * (length + 1))) - 1)
        c, has = find(level.contexts, gram >> BITS)
        left_out, left, gram, c = left[~has], left[has], gram[has], c[has]
        g, child = find(level.keys, gram)
        total, distinct = level.total[c] - excluded_total[left], level.distinct[c] - excluded_distinct[left]
        hit, miss = left[child], left[~child]
        result[hit] += np.log10((level.counts[g[child]] - 0.5) / total[child])
        # a context all of whose children are excluded tells nothing new: its escape is certain
        part, whole = distinct[~child], total[~child]
        result[miss] += np.log10(np.where(part > 0, part / np.maximum(2 * whole, 1.0), 1.0))
        excluded_distinct[miss] = level.distinct[c[~child]]
        excluded_total[miss] = level.excluded[c[~child]]
        left = np.sort(np.concatenate((left_out, miss)))
    result[left] -= np.log10(np.maximum(ALPHABET - excluded_distinct[left], 1.0))
    return result


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as bytes for a shuffle: equal places of all numbers together, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(kind)
    planes = pa.decompress(data[8:], n * kind.itemsize, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=U64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def pack_blocks(docs: DataFrame, trains: F.Column, block_bytes: int) -> DataFrame:
    """Documents in blocks of about ``block_bytes``: one row with ids, training flags, offsets and the compressed lower-cased
    texts, and the counts of two-symbol grams of its training texts. A longer text is a block of its own."""

    def flush(ids, flags, texts):
        data = b"".join(texts)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        teach = [t for t, f in zip(texts, flags) if f]
        begin = np.concatenate(([0], np.cumsum([len(t) for t in teach]))).astype(np.int64)
        pairs, _ = grams(np.frombuffer(b"".join(teach), np.uint8), begin, 1)
        count = np.bincount(pairs.astype(np.int64), minlength=1 << 18)
        keys = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(flags, bool).tobytes()], pa.binary()), pa.array([offsets.tobytes()], pa.binary()),
             pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary()), pa.array([keys], pa.list_(pa.int64())), pa.array([count[keys]], pa.list_(pa.int64()))],
            ["ids", "flags", "offsets", "texts", "pairs", "pair_counts"])

    def pack(reader):
        ids, flags, texts, size = [], [], [], 0
        for batch in reader:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                raw, offsets = text_bytes(part.column("text"))
                low = LOWER[raw].tobytes()
                for k, (i, f) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("trains").to_pylist())):
                    own = low[offsets[k]:offsets[k + 1]]
                    if size and size + len(own) > block_bytes:
                        yield flush(ids, flags, texts)
                        ids, flags, texts, size = [], [], [], 0
                    ids.append(i)
                    flags.append(f)
                    texts.append(own)
                    size += len(own) + 1
        if ids:
            yield flush(ids, flags, texts)

    rows = docs.select("doc_id", "text", trains.alias("trains"))
    packed = rows.mapInArrow(pack, "ids array<long>, flags binary, offsets binary, texts binary, pairs array<long>, pair_counts array<long>")
    return packed.withColumn("block", F.monotonically_increasing_id())


def block_keys(flags: bytes, offsets: bytes, texts: bytes, order: int):
    """Grams and word hashes of a block with their training flags and where each text's begin."""
    offsets = np.frombuffer(offsets, np.int64)
    raw = np.frombuffer(pa.decompress(texts, int(offsets[-1]), codec="zstd", asbytes=True), np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
    flags = np.frombuffer(flags, bool)
    found, begin = grams(raw, offsets, order)
    low, starts, ends, first = words(raw, offsets)
    hashes = word_hashes(low, starts, ends) & ~U64(1)
    return flags, found, begin, hashes, first


def distinct_counts(keys: np.ndarray, teaches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of at most 63 bits, and how often each occurs where ``teaches`` holds."""
    both, counts = np.unique((keys << U64(1)) | teaches.astype(np.uint64), return_counts=True)
    if not len(both):
        return both, counts
    own = both >> U64(1)
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    return own[first], np.add.reduceat(np.where(both & U64(1), counts, 0), first)


GRAM, WORD = 0, 1
PAYLOAD = "block long, slice int, kind int, keys binary, counts binary"


def string_counts(blocks: DataFrame, order: int, slices: int) -> DataFrame:
    """Each block's distinct grams and words with their training counts, one row per block, kind and slice."""

    def count(reader):
        for batch in reader:
            for row in range(len(batch)):
                r = {c: batch.column(c)[row].as_py() for c in ("block", "flags", "offsets", "texts")}
                flags, found, begin, hashes, first = block_keys(r["flags"], r["offsets"], r["texts"], order)
                out = []
                for kind, keys, bounds in ((GRAM, found, begin), (WORD, hashes >> U64(1), first)):
                    keys, counts = distinct_counts(keys, np.repeat(flags, np.diff(bounds)))
                    own = slice_of(keys, slices) if kind == GRAM else (keys % U64(slices)).astype(np.int64)
                    for s in range(slices):
                        at = own == s
                        if at.any():
                            out.append((r["block"], s, kind, squeeze_sorted(keys[at]), squeeze(counts[at].astype(np.uint32))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                                     ["block", "slice", "kind", "keys", "counts"])

    return blocks.select("block", "flags", "offsets", "texts").mapInArrow(count, PAYLOAD)


def trained_slices(counts: DataFrame, slices: int) -> DataFrame:
    """The sum of all blocks' training counts: one row per slice and kind, with the number of its keys and of their occurrences."""

    def merge(reader):
        own, keys, sums, gathered = None, [], [], 0

        def settle():
            k, c = add_up(np.concatenate(keys), np.concatenate(sums))
            return [k], [c]

        def result():
            k, c = settle()
            return pa.RecordBatch.from_arrays(
                [pa.array([own[0]], pa.int32()), pa.array([own[1]], pa.int32()), pa.array([squeeze_sorted(k[0])], pa.binary()),
                 pa.array([squeeze(c[0].astype(np.int64))], pa.binary()), pa.array([len(k[0])]), pa.array([int(c[0].sum())])],
                ["slice", "kind", "keys", "counts", "n_keys", "total"])

        for batch in reader:
            for row in range(len(batch)):
                name = (batch.column("slice")[row].as_py(), batch.column("kind")[row].as_py())
                if own is not None and name != own:
                    yield result()
                    keys, sums, gathered = [], [], 0
                own = name
                k, c = unsqueeze_sorted(batch.column("keys")[row].as_py()), unsqueeze(batch.column("counts")[row].as_py(), np.uint32)
                keys.append(k[c > 0])
                sums.append(c[c > 0].astype(np.int64))
                gathered += len(keys[-1])
                if gathered > MERGE_ROWS + 2 * len(keys[0]):
                    keys, sums = settle()
                    gathered = 0
        if own is not None:
            yield result()

    return (counts.select("slice", "kind", "keys", "counts").repartition(slices, "slice", "kind").sortWithinPartitions("slice", "kind")
            .mapInArrow(merge, "slice int, kind int, keys binary, counts binary, n_keys long, total long"))


def answers(counts: DataFrame, model: DataFrame, pairs: tuple[np.ndarray, np.ndarray], order: int, slices: int) -> DataFrame:
    """For every block its grams' code lengths and its words' training counts, in the order of its keys.

    The trained slice comes first in its partition, then one block after the other, so a task holds one slice and one block's part.
    """
    lowest = lowest_levels(*pairs)

    def answer(reader):
        own, table = None, None
        for batch in reader:
            for row in range(len(batch)):
                r = {c: batch.column(c)[row].as_py() for c in ("block", "slice", "kind", "keys", "counts")}
                keys = unsqueeze_sorted(r["keys"])
                if r["block"] is None:
                    counts = unsqueeze(r["counts"], np.int64)
                    own = (r["slice"], r["kind"])
                    table = levels_of(keys, counts, order, lowest[:]) if r["kind"] == GRAM else (keys, counts)
                    continue
                assert own == (r["slice"], r["kind"])
                if r["kind"] == GRAM:
                    value = code_log10(keys, table).astype(np.float32)
                else:
                    at, has = find(table[0], keys)
                    value = np.where(has, table[1][at], 0) if len(table[0]) else np.zeros(len(keys), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([r["slice"]], pa.int32()), pa.array([r["kind"]], pa.int32()), pa.array([squeeze(value)], pa.binary())],
                                                 ["block", "slice", "kind", "value"])

    asked = counts.select("block", "slice", "kind", "keys", F.lit(None).cast("binary").alias("counts"))
    trained = model.select(F.lit(None).cast("long").alias("block"), "slice", "kind", "keys", "counts")
    return (trained.union(asked).repartition(slices, "slice", "kind").sortWithinPartitions(F.col("slice"), F.col("kind"), F.col("block").asc_nulls_first())
            .mapInArrow(answer, "block long, slice int, kind int, value binary"))


def block_scores(blocks: DataFrame, answered: DataFrame, order: int, slices: int, tokens: int, distinct: int, ends: int) -> DataFrame:
    """Scores of every document from the answers to its block. The answers come before the block's texts in its partition."""
    base = lambda c: np.log10((c + 1) / (tokens + distinct + 1))

    def score(reader):
        held = {}
        for batch in reader:
            for row in range(len(batch)):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if r["texts"] is None:
                    held[r["kind"], r["slice"]] = r["value"]
                    continue
                flags, found, begin, hashes, first = block_keys(r["flags"], r["offsets"], r["texts"], order)
                values = []
                for kind, each in ((GRAM, found), (WORD, hashes >> U64(1))):
                    keys = np.sort(each)
                    keys = keys[np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1]))]
                    own = slice_of(keys, slices) if kind == GRAM else (keys % U64(slices)).astype(np.int64)
                    value = np.zeros(len(keys), np.float32 if kind == GRAM else np.int64)
                    for s in range(slices):
                        if (kind, s) in held:
                            value[own == s] = unsqueeze(held[kind, s], value.dtype)
                    out = np.empty(len(each), value.dtype)
                    for a in range(0, len(each), 1 << 19):
                        out[a:a + (1 << 19)] = value[np.searchsorted(keys, each[a:a + (1 << 19)])]
                    values.append(out)
                held, found, keys, each = {}, None, None, None
                log, count = values
                sums = np.add.reduceat(log, begin[:-1], dtype=np.float64)
                total = np.concatenate(([0.0], np.cumsum(base(count))))
                known = np.concatenate(([0], np.cumsum(count > 0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), pa.array(~flags), pa.array(np.diff(first) + 1), pa.array(np.diff(known[first]) + int(ends > 0)),
                     pa.array(np.full(len(flags), tokens)), pa.array(np.diff(total[first]) + base(ends)), pa.array(sums)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    none = lambda *kinds: [F.lit(None).cast(t).alias(n) for n, t in kinds]
    texts = blocks.select("block", *none(("slice", "int"), ("kind", "int"), ("value", "binary")), "ids", "flags", "offsets", "texts")
    asked = answered.select("block", "slice", "kind", "value", *none(("ids", "array<long>"), ("flags", "binary"), ("offsets", "binary"), ("texts", "binary")))
    return (asked.union(texts).repartition("block").sortWithinPartitions(F.col("block"), F.col("slice").asc_nulls_last())
            .mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def score_documents(docs: DataFrame, trains: F.Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out (not ``trains``), n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text's bytes (A-Z lower-cased) and
    its end under a trie of contexts of up to ``order`` bytes, trained on the
    texts for which ``trains`` holds; the probabilities of all symbols after a
    context sum to 1. ``base_score`` is that of its words and end under the
    words' training frequencies with one added. All training texts count, and
    all texts are scored whole. Null and empty texts have an end only; ids may
    be null or repeat, each row gives a row; with no training text all symbols
    are equally likely; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    blocks = written(pack_blocks(rows, F.col("trains"), block_bytes), "ppm-blocks")
    slices = max(12, math.ceil(math.sqrt(blocks.count())))
    # two symbols are at most 258 * 257 different grams, whatever the corpus
    pairs = (blocks.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p")).groupBy("p.pairs").agg(F.sum("p.pair_counts").alias("n")).collect())
    keys, sums = np.array([r[0] for r in pairs], np.uint64), np.array([r[1] for r in pairs], np.int64)
    ends = int(sums[(keys & U64(511)) == END].sum())
    counts = written(string_counts(blocks, order, slices), "ppm-counts")
    model = written(trained_slices(counts, slices), "ppm-model")
    distinct, tokens = model.where(F.col("kind") == WORD).agg(F.coalesce(F.sum("n_keys"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    answered = answers(counts, model, (keys, sums), order, slices)
    return block_scores(blocks, answered, order, slices, tokens + ends, distinct + int(ends > 0), ends)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
