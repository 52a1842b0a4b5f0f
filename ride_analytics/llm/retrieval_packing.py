"""Packing of documents into fixed windows, each filled with the lexical neighbours of the document that opens it."""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import batches, mix, row_chunks, word_hashes, words
from ride_analytics.sources.storage import written

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20   # about so many ids share one inverted index
QUERY_TERMS = 12
K1, B = 1.2, 0.75
CHUNK_BYTES = 4 << 20
SLICE_BYTES = 1 << 18     # of a chunk, whose words are cut and hashed at a time
CACHE_BYTES = 64 << 20   # of ids that a worker keeps, by the hashes of their runs
ENTRY_BYTES = 160        # of an entry, without its ids

# letters of Latin words, which the tokenizer keeps together, and punctuation behind them, which it keeps apart
KIND = np.zeros(256, np.int64)     # a letter counts 1, a punctuation mark 2**32
KIND[ord("a"):ord("z") + 1] = 1
KIND[list(b".,;:!?#$%&*|()\"+=/")] = 1 << 32
LATIN = np.zeros(256, bool)        # second bytes of À-Ö, Ø-ö and ø-ÿ, after 0xC3
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False


def letters_end(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the letters of each word end, and whether the word is Latin letters with nothing but punctuation behind them."""
    kind = KIND[low]
    head = np.flatnonzero(low[:-1] == 0xC3)
    head = head[LATIN[low[head + 1]]]
    kind[head] = kind[head + 1] = 1
    count = np.zeros(len(low) + 1, np.int64)
    np.cumsum(kind, out=count[1:])
    before, own = count[starts], count[ends] - count[starts]
    letters = own & 0xFFFFFFFF
    plain = (letters > 0) & (letters + (own >> 32) == ends - starts) & (count[starts + letters] - before == letters)
    return np.where(plain, starts + letters, ends), plain


def word_runs(raw: np.ndarray, offsets: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes and hashes of the words; of the runs they are cut into, hashes, where they begin and end (counted from ``at``
    places before the bytes), and which are words kept whole; words and runs of each row."""
    low, starts, ends, first = words(raw, offsets)
    middle, plain = letters_end(low, starts, ends)
    two = middle < ends
    place = np.concatenate(([0], np.cumsum(1 + two)))      # of each word's first run among the runs
    begins, stops, apart = np.empty(place[-1], np.int64), np.empty(place[-1], np.int64), np.zeros(place[-1], bool)
    begins[place[:-1]], stops[place[:-1]], apart[place[:-1]] = starts, middle, ~plain
    begins[place[:-1][two] + 1], stops[place[:-1][two] + 1] = middle[two], ends[two]
    hashes = word_hashes(low, np.concatenate((starts, begins)), np.concatenate((ends, stops)))
    return low, hashes[:len(starts)], hashes[len(starts):], begins + at, stops + at, apart, np.diff(first), np.diff(place[first])


class WordTokenizer:
    """Ids of whole texts from ids of their runs, for a tokenizer that never joins text across white space.

    A word of Latin letters and punctuation behind them is two runs, any other
    is one. Each distinct run is encoded once per worker while it is in the
    cache. Letters and punctuation go many in one call; the last id of such a
    run carries the end-of-word mark, which tells the runs of a call apart.
    Texts that hold the opening of a special token are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.model.id_to_token(k) or "").endswith("</w>") for k in range(size)])
        self.runs: dict[int, bytes] = {}
        self.held = 0

    def _learn(self, keys: list[int], runs: list[str]) -> None:
        for a in range(0, len(runs), 2000):
            part = runs[a:a + 2000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                self.runs.update((k, self._whole(r)) for k, r in zip(keys[a:a + 2000], part))
                continue
            data, first = ids.tobytes(), 0
            for key, stop in zip(keys[a:a + 2000], (4 * stops).tolist()):
                self.runs[key] = data[first:stop]
                first = stop

    def _whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows end to end, where each row's begin, and hashes of the words with where each row's begin."""
        parts = [word_runs(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], int(offsets[a])) for a, b in row_chunks(offsets, SLICE_BYTES)]
        low, hashes, keys, begins, stops, apart, n_words, n_runs = (np.concatenate(x) for x in zip(*parts))
        first = np.concatenate(([0], np.cumsum(n_words)))
        coded = pa.array(keys.view(np.int64)).dictionary_encode()
        names, inverse = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        known = self.runs
        pieces = list(map(known.get, names))
        unknown = np.array([k for k, p in enumerate(pieces) if p is None], np.int64)
        where = np.empty(len(names), np.int64)
        where[inverse] = np.arange(len(inverse))               # any place of a run will do
        where = where[unknown]
        data = low.tobytes()
        found = [data[a:b].decode("utf-8", "replace") for a, b in zip(begins[where].tolist(), stops[where].tolist())]
        own = [names[k] for k in unknown.tolist()]
        whole = apart[where].tolist()
        self._learn([k for k, w in zip(own, whole) if not w], [r for r, w in zip(found, whole) if not w])
        known.update((k, self._whole(r)) for k, r, w in zip(own, found, whole) if w)
        for k, name in zip(unknown.tolist(), own):
            pieces[k] = known[name]
        self.held += ENTRY_BYTES * len(own) + sum(len(known[k]) for k in own)
        if self.held > CACHE_BYTES:
            self.runs, self.held = {}, 0
        size = np.fromiter(map(len, pieces), np.int32, len(pieces)) >> 2
        flat = np.frombuffer(b"".join(pieces), np.uint32)
        begin = np.concatenate(([0], np.cumsum(size)))
        number = size[inverse]
        total = np.concatenate(([0], np.cumsum(number, dtype=np.int64)))
        ids = flat[np.repeat((begin[:-1][inverse] - total[:-1]).astype(np.int32), number) + np.arange(total[-1], dtype=np.int32)]
        bounds = total[np.concatenate(([0], np.cumsum(n_runs)))]
        if b"<|" in data:
            rows = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for k in range(len(rows)):
                own = raw[offsets[k]:offsets[k + 1]].tobytes()
                if b"<|" in own:
                    rows[k] = np.frombuffer(self._whole(own.decode("utf-8", "replace")), np.uint32)
            ids = np.concatenate(rows) if rows else ids
            bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        return ids, bounds, hashes, first


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded_pieces(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """Each document's ids cut at multiples of the window: doc_id, start, length, ids_crc32, doc_tokens, ids, route.

    ``ids`` (little-endian unsigned 32 bits) only of the last piece, if it is
    shorter than a window; a whole window needs no more packing. ``route`` is
    the smallest hash of the document's longer words: documents that share words
    tend to share it.
    """

    def encode(reader):
        model = tokenizer(path)
        for part, raw, offsets in batches(reader, "text", CHUNK_BYTES):
            ids, bounds, hashes, first = model.encode(raw, offsets)
            data, stop, bounds = ids.astype("<u4").tobytes(), int(end_id).to_bytes(4, "little"), (4 * bounds).tolist()
            least = np.zeros(len(first) - 1, np.uint64)
            filled = np.flatnonzero(np.diff(first))
            if len(filled):
                least[filled] = np.minimum.reduceat(mix(hashes), first[filled]) >> np.uint64(1)
            out = []
            for doc, a, b, route in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], least.tolist()):
                own = data[a:b] + stop
                n = len(own) >> 2
                for at in range(0, n, window):
                    piece = own[4 * at:4 * (at + window)]
                    size = len(piece) >> 2
                    out.append((doc, at, size, zlib.crc32(piece), n, None if size == window else piece, route))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "route"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return docs.mapInArrow(encode, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, route long")


class InvertedIndex:
    """BM25 postings of one shard's documents over token ids."""

    def __init__(self, documents: list[np.ndarray]):
        n = len(documents)
        length = np.array([len(d) for d in documents], np.int64)
        keys = np.concatenate([d.astype(np.int64) for d in documents]) * n + np.repeat(np.arange(n), length)
        keys, tf = np.unique(keys, return_counts=True)
        self.doc = (keys % n).astype(np.int64)
        terms, self.begin, df = np.unique(keys // n, return_index=True, return_counts=True)
        self.begin = np.append(self.begin, len(keys))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length[self.doc] / max(1.0, length.mean()))
        self.weight = (np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        # the terms of each document that weigh most and that another document has
        term = np.repeat(np.arange(len(terms)), df)
        shared = np.repeat(df > 1, df)
        order = np.lexsort((-self.weight, self.doc))
        order = order[shared[order]]
        self.top_begin = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.top = term[order]
        self.n = n

    def scores(self, doc: int, terms: int | None = None) -> np.ndarray:
        """Of all documents, by the document's ``terms`` heaviest terms, or by every one it shares."""
        out = np.zeros(self.n, np.float32)
        a, b = self.top_begin[doc], self.top_begin[doc + 1]
        for t in self.top[a:b if terms is None else min(a + terms, b)].tolist():
            at = slice(self.begin[t], self.begin[t + 1])
            out[self.doc[at]] += self.weight[at]
        return out


def fill_windows(documents: list[np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, first id, length, sequence, offset) of windows that leave no gap but at the end of the last.

    The document that opens a window retrieves its unused neighbours, best
    first, and they fill it; the one that no longer fits is cut and its rest
    opens the next window. Neighbours by the ``QUERY_TERMS`` heaviest terms come
    first; when they are used up, those by all terms, so no document that shares
    a term is passed over. Without a neighbour the next unused document follows.
    """
    index = InvertedIndex(documents)
    unused = np.ones(len(documents), bool)
    out, sequence, offset, following = [], 0, 0, 0
    seed = rest = None
    while True:
        if rest is None:
            while following < len(documents) and not unused[following]:
                following += 1
            if following == len(documents):
                return out
            seed, at = following, 0
        else:
            seed, at = rest
        unused[seed] = False
        ranked, rounds = iter(()), [None, QUERY_TERMS]
        rest, current = None, (seed, at)
        while True:
            doc, at = current
            take = min(len(documents[doc]) - at, window - offset)
            out.append((doc, at, take, sequence, offset))
            offset += take
            if offset == window:
                sequence, offset = sequence + 1, 0
                rest = (doc, at + take) if at + take < len(documents[doc]) else None
                break
            near = next((d for d in ranked if unused[d]), None)
            while near is None and rounds:
                scores = index.scores(seed, rounds.pop())
                left = np.flatnonzero(unused & (scores > 0))
                ranked = iter(left[np.argsort(-scores[left], kind="stable")].tolist())
                near = next(ranked, None)
            if near is None:
                break
            unused[near] = False
            current = (near, 0)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (null for whole windows).

    A document is its ids and ``end_id``. Whole windows of long documents are
    sequences of their own; the rest of each document goes to a shard by its
    words, and each shard packs its documents by its own inverted index. Shards
    are cut to about ``shard_tokens`` ids by the measured size of each route, so
    copies that share one are dealt to several. Only the last sequence of a
    shard is short. Null and empty texts are one ``end_id``; null and repeated
    ids give pieces of their own; an empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = written(encoded_pieces(rows, tokenizer_path, window, end_id).withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    weight = F.when(F.col("ids").isNull(), F.lit(16)).otherwise(F.col("length"))
    total = pieces.agg(F.sum(weight)).first()[0] or 0
    lanes = max(1, -(-int(total) // shard_tokens))
    # routes are many; the sizes of the lanes they fall into are few, one row per shard at most
    lane = F.pmod(F.xxhash64("route"), F.lit(lanes))
    sizes = pieces.groupBy(lane.alias("lane")).agg(F.greatest(F.lit(1), F.ceil(F.sum(weight) / shard_tokens)).alias("parts"))
    most = sizes.agg(F.max("parts")).first()[0] or 1
    dealt = (pieces.withColumn("lane", lane).join(sizes, "lane")
             .withColumn("shard", F.col("lane") * most + F.pmod(F.xxhash64("uid"), F.col("parts"))).drop("lane", "parts", "route"))

    def fill(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("uid")
        number = shard.column("shard")[0].as_py()
        rows = shard.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]).to_pylist()
        out, sequence = [], 0
        for r in rows:
            if r["ids"] is None:
                out.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], sequence, 0, None))
                sequence += 1
        rest = [r for r in rows if r["ids"] is not None]
        documents = [np.frombuffer(r["ids"], "<u4") for r in rest]
        for doc, at, take, k, offset in fill_windows(documents, window) if rest else ():
            r, ids = rest[doc], documents[doc][at:at + take]
            out.append((r["doc_id"], r["start"] + at, take, r["ids_crc32"] if take == r["length"] else crc(ids), r["doc_tokens"], sequence + k, offset,
                        ids.tobytes()))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 7 + [pa.binary()])]
        columns[5] = pa.array([(number << 32) + k for k in columns[5].to_pylist()], pa.int64())
        return pa.Table.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return dealt.groupBy("shard").applyInArrow(fill, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                                                     "offset long, ids binary")


def query(spark, sf_dir):
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")
