"""Long repeats of a corpus by run-length indexes: which bytes lie in a string of a given length that also starts elsewhere.

Strings that are equal choose the same anchor inside them, so the corpus falls
apart into small sets of contexts, one per anchor, that never match across.
Each set gets an index of its own: the Burrows-Wheeler transform of its window
starts, compressed to runs, with samples at the ends of runs. Between samples
the length of the longest match elsewhere falls by one from each start to the
next, so the matching statistics stream from the samples alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import _TABLE, U64, mix, powers, text_bytes
from ride_analytics.sources.storage import written

SPAN = 400                # bytes of a repeat
ANCHOR = 100              # bytes of an anchor
BLOCK_BYTES = 2 << 20     # text that is anchored at a time
HOT_CONTEXTS = 20_000     # contexts of an anchor beyond which they are cut into single windows
SORT_STARTS = 1 << 16     # window starts sorted at a time
NONE = U64(2**64 - 1)


def pack_texts(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Documents in blocks of about ``block_bytes``: ids, offsets and compressed texts. A longer text is a block of its own."""

    def flush(ids, texts):
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([offsets.tobytes()], pa.binary()),
                                           pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary())], ["ids", "offsets", "texts"])

    def pack(reader):
        ids, texts, size = [], [], 0
        for batch in reader:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                raw, offsets = text_bytes(part.column("text"))
                data = raw.tobytes()
                for k, i in enumerate(part.column("doc_id").to_pylist()):
                    own = data[offsets[k]:offsets[k + 1]]
                    if size and size + len(own) > block_bytes:
                        yield flush(ids, texts)
                        ids, texts, size = [], [], 0
                    ids.append(i)
                    texts.append(own)
                    size += len(own) + 8
        if ids:
            yield flush(ids, texts)

    return docs.select("doc_id", "text").mapInArrow(pack, "ids array<long>, offsets binary, texts binary").withColumn("block", F.monotonically_increasing_id())


def unpack(offsets: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(offsets, np.int64)
    data = pa.decompress(texts, int(offsets[-1]), codec="zstd", asbytes=True) if offsets[-1] else b""
    return np.frombuffer(data, np.uint8), offsets


class Anchors:
    """Contexts of a block: maximal runs of window starts that choose the same anchor.

    Of the anchors in a window the one with the least hash is chosen, the first
    of equals, so equal windows choose equal anchors at equal places.
    ``anchor``: hash of the anchor; ``context``: hash of the run's bytes and its
    anchor; ``start``, ``number``: its window starts.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, span: int, size: int):
        self.span = span
        n, width = len(raw), span - size + 1
        if n < span:
            self.anchor = self.context = np.zeros(0, np.uint64)
            self.start = self.number = np.zeros(0, np.int64)
            return
        p, self.inverse = powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[raw] * p[:-1], out=self.total[1:])
        hashes = mix((self.total[size:] - self.total[:-size]) * self.inverse[:n - size + 1])
        keys = np.full(-(-len(hashes) // width) * width, NONE)
        keys[:len(hashes)] = (hashes & U64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        keys = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].ravel()
        keys = np.minimum.accumulate(keys, axis=1).ravel()
        starts = n - span + 1
        chosen = (np.minimum(ahead[:starts], keys[width - 1:width - 1 + starts]) & U64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(n + 1, np.int8)  # starts whose window ends in the same text
        long = np.diff(offsets) >= span
        inside[offsets[:-1][long]] += 1
        inside[(offsets[1:] - span + 1)[long]] -= 1
        inside = np.cumsum(inside)[:starts] > 0
        edge = np.zeros(starts, bool)
        edge[offsets[:-1][long]] = True
        first = inside.copy()
        first[1:] &= (chosen[1:] != chosen[:-1]) | edge[1:] | ~inside[:-1]
        self.start = np.flatnonzero(first)
        self.number = np.add.reduceat(inside.astype(np.int64), self.start) if len(self.start) else np.zeros(0, np.int64)
        self.anchor = hashes[chosen[self.start]]
        self.context = mix(self.hash_of(self.start, self.number + span - 1) + self.anchor * U64(3) + self.number.astype(np.uint64))

    def hash_of(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.total[start + length] - self.total[start]) * self.inverse[start])

    def windows(self, k: int) -> np.ndarray:
        """Hashes of the single windows of one context."""
        at = np.arange(self.start[k], self.start[k] + self.number[k])
        return self.hash_of(at, self.span)


def contexts(blocks: DataFrame, span: int, size: int) -> DataFrame:
    """Each block's distinct contexts: block, anchor, context, start (of one), number, times."""

    def find(reader):
        for batch in reader:
            for row in range(len(batch)):
                raw, offsets = unpack(batch.column("offsets")[row].as_py(), batch.column("texts")[row].as_py())
                a = Anchors(raw, offsets, span, size)
                own, first, times = np.unique(a.context, return_index=True, return_counts=True)
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), batch.column("block")[row].as_py())), pa.array(a.anchor[first].view(np.int64)), pa.array(own.view(np.int64)),
                         pa.array(a.start[first]), pa.array(a.number[first].astype(np.int32)), pa.array(times.astype(np.int32))],
                        ["block", "anchor", "context", "start", "number", "times"])

    return blocks.select("block", "offsets", "texts").mapInArrow(find, "block long, anchor long, context long, start long, number int, times int")


def window_order(text: np.ndarray, starts: np.ndarray, span: int, limit: int = SORT_STARTS) -> np.ndarray:
    """Order of the windows at ``starts`` by their bytes. Larger sets are cut by eight bytes at a time before they are sorted."""

    def by_bytes(at: np.ndarray, depth: int) -> np.ndarray:
        rows = np.lib.stride_tricks.sliding_window_view(text, span - depth)[starts[at] + depth]
        return at[np.argsort(np.ascontiguousarray(rows).view(f"S{span - depth}").ravel(), kind="stable")]

    out, todo = [], [(np.arange(len(starts)), 0)]
    while todo:
        at, depth = todo.pop()
        if len(at) <= limit or depth + 8 >= span:
            out.append(by_bytes(at, depth))
            continue
        word = np.zeros(len(at), np.uint64)
        for k in range(8):
            word = (word << U64(8)) | text[starts[at] + depth + k]
        order = np.argsort(word, kind="stable")
        at, word = at[order], word[order]
        edges = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True])))
        parts, a = [], 0
        while a < len(edges) - 1:
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + limit, "right")) - 1)
            alone = edges[a + 1] - edges[a] > limit
            parts.append((at[edges[a]:edges[a + 1]], depth + 8) if alone else (at[edges[a]:edges[b]], depth))
            a = a + 1 if alone else b
        todo += parts[::-1]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_lengths(text: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of the longest common prefixes of the texts at x and at y, at most ``most``."""
    out, left, step = np.zeros(len(x), np.int64), np.arange(len(x)), 64
    reach = np.arange(step)
    for a in range(0, int(most.max(initial=0)), step):
        keep = []
        for part in np.array_split(left, max(1, len(left) // 16384)):
            i, j = np.minimum(x[part, None] + a + reach, len(text) - 1), np.minimum(y[part, None] + a + reach, len(text) - 1)
            differ = text[i] != text[j]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), step)
            out[part] = np.minimum(most[part], a + same)
            keep.append(part[(same == step) & (most[part] > a + step)])
        left = np.concatenate(keep)
        if not len(left):
            break
    return out


class RunIndex:
    """Run-length index over the window starts of some contexts.

    ``order`` are the starts sorted by their windows, ``bwt`` the byte before
    each (256 before a context's first start), ``runs`` where a run of equal
    bytes begins. ``matches`` streams the statistics.
    """

    def __init__(self, contents: list[bytes], span: int):
        length = np.array([len(c) for c in contents], np.int64)
        number = length - span + 1
        self.span, self.number = span, number
        self.text = np.frombuffer(b"".join(contents), np.uint8)
        begin = np.concatenate(([0], np.cumsum(length)))
        self.first = np.concatenate(([0], np.cumsum(number)))
        owner = np.repeat(np.arange(len(contents)), number)
        self.starts = np.arange(self.first[-1]) - self.first[:-1][owner] + begin[:-1][owner]
        self.rest = begin[1:][owner] - self.starts
        self.head = np.zeros(self.first[-1], bool)
        self.head[self.first[:-1]] = True
        self.order = window_order(self.text, self.starts, span)
        before = self.text[np.maximum(self.starts - 1, 0)].astype(np.int16)
        before[self.head] = 256
        self.bwt = before[self.order]
        self.runs = np.flatnonzero(np.concatenate(([True], (self.bwt[1:] != self.bwt[:-1]) | (self.bwt[1:] == 256)))) if len(self.order) else np.zeros(0, np.int64)

    def _stream(self, near: np.ndarray, sampled: np.ndarray) -> np.ndarray:
        """Match length of each start with its neighbour in the order: at samples by comparing bytes, else one less than the start before."""
        at = np.flatnonzero(sampled)
        known = np.zeros(len(near), np.int64)
        some = at[near[at] >= 0]
        other = near[some]
        known[some] = common_lengths(self.text, self.starts[some], self.starts[other], np.minimum(self.rest[some], self.rest[other]))
        place = np.arange(len(near))
        last = np.maximum.accumulate(np.where(sampled, place, 0))
        return known[last] - (place - last)

    def matches(self) -> np.ndarray:
        """For each start the length of the longest string from it that another start has too, exact from ``span`` on."""
        n = len(self.order)
        begins, ends = np.zeros(n, bool), np.zeros(n, bool)  # run ends, by place in the order
        begins[self.runs] = True
        ends[:-1], ends[-1:] = begins[1:], True
        out = np.zeros(n, np.int64)
        for shift, edge in ((1, begins), (-1, ends)):
            near = np.full(n, -1, np.int64)
            if shift == 1:
                near[self.order[1:]] = self.order[:-1]
            else:
                near[self.order[:-1]] = self.order[1:]
            sampled = np.zeros(n, bool)
            sampled[self.order] = edge
            sampled |= self.head
            # inside a run the neighbour's start before is the neighbour of the start before, unless a start lies between
            # that no context goes on from, or equal windows stand in another order
            inner = np.flatnonzero(~sampled)
            sampled[inner] = (near[inner] < 0) | (near[inner - 1] != near[inner] - 1) | self.head[near[inner]]
            out = np.maximum(out, self._stream(near, sampled))
        return out


def ranges_of(flags: np.ndarray) -> np.ndarray:
    """Begin and end of each run of true values, flat."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).astype(np.int32)


def repeated_starts(contents: DataFrame, span: int) -> DataFrame:
    """context and ranges (begin, end, ... as 32-bit numbers) of its starts whose window another context of its anchor has.

    A task streams its anchors and indexes a bundle of them at a time.
    """

    def index(names, texts):
        own = RunIndex(texts, span)
        hit = own.matches() >= span
        found = [(name, ranges_of(hit[a:b]).tobytes()) for name, a, b in zip(names, own.first[:-1], own.first[1:]) if hit[a:b].any()]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], ["context", "ranges"])

    def stream(reader):
        names, texts, size, last = [], [], 0, None
        for batch in reader:
            for anchor, name, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "content"))):
                if anchor != last and size >= SORT_STARTS:
                    yield index(names, texts)
                    names, texts, size = [], [], 0
                last = anchor
                names.append(name)
                texts.append(text)
                size += len(text) - span + 1
        if names:
            yield index(names, texts)

    return contents.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(stream, "context long, ranges binary")


def long_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, anchor: int = ANCHOR,
                 hot_contexts: int = HOT_CONTEXTS, kept: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin and end of each maximal
    run of bytes covered by a ``span``-byte string that also starts anywhere else), and with ``kept`` the bytes that stay.

    1. Contexts: runs of window starts with the same anchor (``Anchors``). Equal contexts, as in copies, merge at once;
       a context that occurs twice is repeated as a whole, and an anchor that occurs once is dropped.
    2. The different contexts of one anchor are indexed and matched (``RunIndex``).
    3. An anchor with more than ``hot_contexts`` of them is cut into single windows, which merge the same way, so no
       task holds an unbounded set.
    4. Each block of documents gets the ranges of its own contexts and marks its bytes.

    Strings are compared by 64-bit hashes where equal contexts merge, by bytes in the indexes. Null texts count as
    empty; texts shorter than ``span`` are never touched; equal rows repeat each other; null and repeated ids give a row
    each; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(pack_texts(rows, BLOCK_BYTES), "repeat-blocks")
    own = written(contexts(blocks, span, anchor), "repeat-contexts")
    totals = own.groupBy("anchor").agg(F.sum("times").alias("n"), F.count("*").alias("rows"), F.min("context").alias("a"), F.max("context").alias("b")).where("n > 1")
    shared = written(own.join(totals, "anchor").select("block", "anchor", "context", "start", "number", "times", (F.col("rows") > hot_contexts).alias("hot"),
                                                       (F.col("a") != F.col("b")).alias("mixed")), "repeat-shared")
    cold = shared.where("NOT hot")
    merged = cold.groupBy("anchor", "context").agg(F.sum("times").alias("n"), F.min(F.struct("block", "start", "number")).alias("one"), F.first("mixed").alias("mixed"))
    merged = written(merged, "repeat-merged")
    asked = merged.where("mixed").groupBy("one.block").agg(F.collect_list(F.struct("anchor", "context", "one.start", "one.number")).alias("asked"))

    def fetch(reader):
        for batch in reader:
            for row in range(len(batch)):
                raw, _ = unpack(batch.column("offsets")[row].as_py(), batch.column("texts")[row].as_py())
                data = raw.tobytes()
                items = batch.column("asked")[row].as_py()
                for a in range(0, len(items), 4096):
                    part = items[a:a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x["anchor"] for x in part], pa.int64()), pa.array([x["context"] for x in part], pa.int64()),
                         pa.array([data[x["start"]:x["start"] + x["number"] + span - 1] for x in part], pa.binary())], ["anchor", "context", "content"])

    contents = blocks.join(asked, "block").select("offsets", "texts", "asked").mapInArrow(fetch, "anchor long, context long, content binary")
    found = repeated_starts(contents, span)
    whole = merged.where("n > 1").select("context", F.lit(None).cast("binary").alias("ranges"))
    marks = written(found.union(whole), "repeat-marks")
    per_block = (cold.select("block", "context").join(marks, "context").groupBy("block")
                 .agg(F.collect_list("context").alias("marked"), F.collect_list(F.coalesce("ranges", F.lit(b""))).alias("ranges")))

    hot = shared.where("hot").select("block", "anchor").distinct().groupBy("block").agg(F.collect_list("anchor").alias("hot"))
    hot = written(hot, "repeat-hot")

    def single(reader):
        for batch in reader:
            for row in range(len(batch)):
                a = Anchors(*unpack(batch.column("offsets")[row].as_py(), batch.column("texts")[row].as_py()), span, anchor)
                anchors = np.array(batch.column("hot")[row].as_py(), np.int64)
                at = np.flatnonzero(np.isin(a.anchor.view(np.int64), anchors))
                if len(at):
                    names, times = np.unique(np.concatenate([a.windows(k) for k in at.tolist()]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), batch.column("block")[row].as_py())), pa.array(names.view(np.int64)), pa.array(times)],
                                                     ["block", "window", "times"])

    windows = written(blocks.join(hot, "block").select("block", "offsets", "texts", "hot").mapInArrow(single, "block long, window long, times long"), "repeat-windows")
    twice = windows.groupBy("window").agg(F.sum("times").alias("n")).where("n > 1").select("window")
    per_window = windows.join(twice, "window").groupBy("block").agg(F.collect_list("window").alias("windows"))

    def mark(reader):
        for batch in reader:
            for row in range(len(batch)):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                raw, offsets = unpack(r["offsets"], r["texts"])
                a = Anchors(raw, offsets, span, anchor)
                cover = np.zeros(len(raw) + span + 1, np.int32)
                if r["marked"]:
                    names = np.array(r["marked"], np.int64)
                    order = np.argsort(names, kind="stable")
                    names, ctx = names[order], a.context.view(np.int64)
                    low, high = np.searchsorted(names, ctx, "left"), np.searchsorted(names, ctx, "right")
                    for k in np.flatnonzero(high > low).tolist():
                        for j in order[low[k]:high[k]].tolist():
                            ranges = np.frombuffer(r["ranges"][j], np.int32) if r["ranges"][j] else (0, int(a.number[k]))
                            for x, y in zip(ranges[::2], ranges[1::2]):
                                cover[a.start[k] + x] += 1
                                cover[a.start[k] + y - 1 + span] -= 1
                if r["windows"]:
                    wanted, anchors = np.array(r["windows"], np.int64), np.array(r["hot"], np.int64)
                    for k in np.flatnonzero(np.isin(a.anchor.view(np.int64), anchors)).tolist():
                        at = a.start[k] + np.flatnonzero(np.isin(a.windows(k).view(np.int64), wanted))
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + span, -1)
                gone = np.cumsum(cover)[:len(raw)] > 0
                stays = raw[~gone].tobytes()
                left = offsets - np.concatenate(([0], np.cumsum(gone)))[offsets]
                spans, blobs = [], []
                for p, q in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    edges = ranges_of(gone[p:q])
                    spans.append([{"begin": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])])
                blobs = [stays[p:q] for p, q in zip(left[:-1].tolist(), left[1:].tolist())]
                columns = [pa.array(r["ids"], pa.int64()), pa.array(np.diff(offsets)), pa.array(np.diff(offsets) - np.diff(left)), pa.array([len(s) for s in spans], pa.int64()),
                           pa.array([hashlib.sha256(b).hexdigest() for b in blobs]), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(blobs, pa.binary())] if kept else []), names_out)

    names_out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept"] if kept else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>" + (", kept binary" if kept else "")
    lists = per_block.join(per_window, "block", "full").join(hot, "block", "left")
    return (blocks.join(lists, "block", "left").select("ids", "offsets", "texts", "marked", "ranges", "windows", "hot")).mapInArrow(mark, schema)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return long_repeats(docs).drop("spans")
