"""Alignment of two tokenizers over the same texts by diagonal run skipping, with corpus-wide link counts."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import batches
from ride_analytics.sources.storage import written

BLOCK_BYTES = 2 << 20   # text aligned at a time
CHUNK_CHARS = 1 << 16   # characters given to an encoder at a time, where the text has a safe cut
LANE = 512              # tokens between two checks for a place to start a lane of its own

# a space that neither tokenizer joins to what stands before it: no token of the second holds a space behind another
# character, and the first splits texts there before it merges
SAFE_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
# how text is split before the merges of the rank file (the public pattern of that vocabulary; a fixed value)
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """Byte-level tokenizer: ids by the tokenizers library, or by ranks of the same vocabulary for plain Latin text.

    Letters below U+0250 and general punctuation fall into the same classes in
    both libraries, so their ids agree there; other texts go to the first.
    """

    def __init__(self, path: str, ranks_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.ranks = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        # the bytes that are printed as themselves; the others are shifted behind U+0100, in their order
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain}
        shown |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        size = self.model.get_vocab_size(with_added_tokens=True)
        tokens = [self.model.id_to_token(k) or "" for k in range(size)]
        self.bytes = [bytes(shown[c] for c in t) if all(c in shown for c in t) else t.encode() for t in tokens]

    def encode(self, chunks: list[str]) -> list:
        if self.ranks is None:
            return [e.ids for e in self.model.encode_batch_fast(chunks, add_special_tokens=False)]
        out = [None] * len(chunks)
        rest = []
        for k, chunk in enumerate(chunks):
            if chunk.isascii() or not NOT_LATIN.search(chunk):
                try:
                    out[k] = self.ranks.encode_ordinary(chunk)
                    continue
                except Exception:  # runs too long for the pattern's matcher
                    pass
            rest.append(k)
        for k, e in zip(rest, self.model.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False) if rest else ()):
            out[k] = e.ids
        return out


NOT_LATIN = re.compile("[^\x00-ɏ -⁯]")


class PieceTokens:
    """Piece tokenizer, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]

    def encode(self, chunks: list[str]) -> list:
        return self.model.encode([c[1:] for c in chunks], num_threads=1)


class Table:
    """Bytes of each id's token, end to end, and the digits of the id."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int32)
        self.begin = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        width = len(str(len(tokens)))
        self.digits = np.frombuffer(b"".join(str(k).encode().ljust(width, b"\0") for k in range(len(tokens))), np.uint8).reshape(-1, width)
        self.n_digits = (self.digits != 0).sum(axis=1)

    def text(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        total = np.cumsum(length, dtype=np.int64)
        return self.flat[np.repeat(self.begin[ids] - (total - length), length) + np.arange(total[-1] if len(total) else 0)]


@functools.lru_cache(maxsize=2)
def tokenizers_of(byte_path: str, ranks_path: str | None, piece_path: str) -> tuple:
    a, b = ByteTokens(byte_path, ranks_path), PieceTokens(piece_path)
    return a, Table(a.bytes), b, Table(b.bytes)


def chunks_of(text: str, size: int) -> list[str]:
    """``text`` behind a space, cut at safe places about ``size`` characters apart; each chunk begins with a space."""
    text = " " + text
    out, start = [], 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if not cut:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray, apart: int) -> tuple[np.ndarray, ...]:
    """Where lanes begin and end: at rows, and at checkpoints of long rows where both tokenizers end a token."""
    at = np.arange(apart, len(ends_a), apart)
    place = np.searchsorted(ends_b, ends_a[at - 1])
    both = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at - 1]
    begin_a = np.concatenate((rows_a[:-1], at[both]))
    begin_b = np.concatenate((rows_b[:-1], place[both] + 1))
    begin_a, first = np.unique(begin_a, return_index=True)
    begin_b = begin_b[first]
    return begin_a, begin_b, np.append(begin_a[1:], len(ends_a)), np.append(begin_b[1:], len(ends_b))


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray, apart: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of both sides that end together, in order.

    ``ends``: byte ends over all rows, ascending; ``rows``: where each row's
    tokens begin (one more than rows; no row without tokens). All lanes step at
    once: each compares the two end arrays at its current index shift over a
    span that doubles while all ends agree, so one-to-one stretches are jumped;
    at the first difference the side behind steps on until both ends meet, which
    closes the irregular group and sets the new shift.
    """
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, stop_i, stop_j = lanes(ends_a, ends_b, rows_a, rows_b, apart)
    span = np.ones(len(i), np.int64)
    found_a, found_b = [], []
    while len(i):
        m = np.minimum(span, np.minimum(stop_i - i, stop_j - j))
        total = np.cumsum(m)
        lane = np.repeat(np.arange(len(m)), m)
        step = np.arange(total[-1]) - np.repeat(total - m, m)
        at_a, at_b = i[lane] + step, j[lane] + step
        differ = np.flatnonzero(ends_a[at_a] != ends_b[at_b])
        run = m.copy()
        if len(differ):
            owner = lane[differ]
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            run[owner[first]] = step[differ[first]]
        same = step < run[lane]
        found_a.append(at_a[same])
        found_b.append(at_b[same])
        whole = run == m
        i, j, span = i + run, j + run, np.where(whole, span * 2, 1)
        open_, x, y = np.flatnonzero(~whole), i[~whole], j[~whole]
        while len(open_):
            a, b = ends_a[x], ends_b[y]
            met = a == b
            i[open_[met]], j[open_[met]] = x[met], y[met]
            x, y = (x + (a < b))[~met], (y + (a > b))[~met]
            open_ = open_[~met]
        left = i < stop_i
        i, j, span, stop_i, stop_j = i[left], j[left], span[left], stop_i[left], stop_j[left]
    found_a, found_b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(found_a, kind="stable")
    return found_a[order], found_b[order]


def group_texts(ids_a, ids_b, last_a, last_b, row_ends, table_a: Table, table_b: Table) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all rows end to end, and where each row's begins. ``last``: the last tokens of each
    group, ``row_ends``: the last group of each row."""
    n_a, n_b = len(ids_a), len(ids_b)
    width = max(table_a.digits.shape[1], table_b.digits.shape[1])
    out = np.zeros((n_a + n_b, width + 1), np.uint8)
    size = np.zeros(n_a + n_b + 1, np.int64)
    mark_a, mark_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
    mark_a[last_a], mark_b[last_b] = True, True
    before_b = np.concatenate(([0], last_b + 1))
    place = np.arange(n_a) + before_b[np.cumsum(mark_a) - mark_a]
    out[place, :table_a.digits.shape[1]] = table_a.digits[ids_a]
    out[place, width] = np.where(mark_a, ord("|"), ord(","))
    size[place + 1] = table_a.n_digits[ids_a] + 1
    place = np.arange(n_b) + (last_a + 1)[np.cumsum(mark_b) - mark_b]
    out[place, :table_b.digits.shape[1]] = table_b.digits[ids_b]
    out[place, width] = np.where(mark_b, ord(";"), ord(","))
    size[place + 1] = table_b.n_digits[ids_b] + 1
    ends = last_a[row_ends] + last_b[row_ends] + 1  # the last token of each row in the merged order
    out[ends, width] = 0
    size[ends + 1] -= 1
    bounds = np.cumsum(size)
    return out[out != 0].tobytes(), np.concatenate(([0], bounds[ends + 1]))


def flat_ids(found: list, owner: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks end to end and how many each of ``n`` rows has."""
    number = np.array([len(x) for x in found], np.int64)
    ids = np.concatenate([np.asarray(x, np.int32) for x in found]) if len(found) else np.zeros(0, np.int32)
    return ids, np.bincount(np.array(owner, np.int64), number, n).astype(np.int64) if len(found) else np.zeros(n, np.int64)


def row_check(ids, number, table: Table, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows' tokens, joined, are a space and the row's text."""
    joined = table.text(ids)
    length = np.add.reduceat(np.append(table.length[ids].astype(np.int64), 0), np.minimum(np.cumsum(number) - number, len(ids))) * (number > 0) if len(number) else number
    bounds = np.concatenate(([0], np.cumsum(length)))
    fits = (length == np.diff(offsets) + 1) & (number > 0)
    if fits.all() and len(fits):  # texts with their spaces, in one comparison
        spaced = np.insert(raw, offsets[:-1], 32)
        differ = np.flatnonzero(joined != spaced)
        fits[np.searchsorted(bounds, differ, "right") - 1] = False
        return fits
    for k in np.flatnonzero(fits).tolist():
        own = joined[bounds[k]:bounds[k + 1]]
        fits[k] = own[0] == 32 and np.array_equal(own[1:], raw[offsets[k]:offsets[k + 1]])
    return fits


def align_rows(texts: list[str], raw: np.ndarray, offsets: np.ndarray, models: tuple, chunk: int = CHUNK_CHARS, apart: int = LANE) -> dict:
    """Alignment of a batch: per row n_a, n_b, n_groups, sha; ``links`` of each row as (a, b) ids, flat."""
    a, table_a, b, table_b = models
    n = len(texts)
    parts = [(k, c) for k, t in enumerate(texts) if t for c in (chunks_of(t, chunk) if len(t) > chunk else (" " + t,))]
    owner, chunks = [k for k, _ in parts], [c for _, c in parts]
    ids_a, number_a = flat_ids(a.encode(chunks), owner, n)
    ids_b, number_b = flat_ids(b.encode(chunks), owner, n)
    some = np.flatnonzero(np.diff(offsets) > 0)
    fits = np.zeros(n, bool)
    if len(some):
        own = np.concatenate((offsets[some], offsets[-1:]))
        fits[some] = row_check(ids_a, number_a[some], table_a, raw, own) & row_check(ids_b, number_b[some], table_b, raw, own)
    if not fits.all():
        ids_a, ids_b = ids_a[np.repeat(fits, number_a)], ids_b[np.repeat(fits, number_b)]
    number_a, number_b = number_a * fits, number_b * fits
    rows = np.flatnonzero(fits)
    rows_a, rows_b = (np.concatenate(([0], np.cumsum(x[rows]))) for x in (number_a, number_b))
    ends_a, ends_b = (np.cumsum(t.length[x], dtype=np.int64) for t, x in ((table_a, ids_a), (table_b, ids_b)))
    last_a, last_b = common_ends(ends_a, ends_b, rows_a, rows_b, apart)
    groups = np.zeros(n, np.int64)
    sha = [""] * n
    if len(rows):
        row_ends = np.searchsorted(last_a, rows_a[1:] - 1)
        groups[rows] = np.diff(np.concatenate(([-1], row_ends)))
        text, bounds = group_texts(ids_a, ids_b, last_a, last_b, row_ends, table_a, table_b)
        text = memoryview(text)
        for k, x, y in zip(rows.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            sha[k] = hashlib.sha256(text[x:y]).hexdigest()
    return {"n_a": number_a, "n_b": number_b, "n_groups": groups, "sha": sha, "link_a": ids_a[last_a], "link_b": ids_b[last_b],
            "last_a": last_a, "last_b": last_b, "ids_a": ids_a, "ids_b": ids_b}


def aligned_blocks(rows: DataFrame, byte_path: str, piece_path: str, ranks_path: str | None, block_bytes: int, chunk: int, apart: int) -> DataFrame:
    """One row per block of texts: the rows' results, their links as numbers of the block's id pairs, and these pairs with their counts."""

    def run(reader):
        models = tokenizers_of(byte_path, ranks_path, piece_path)
        for part, raw, offsets in batches(reader, "text", block_bytes):
            r = align_rows(part.column("text").fill_null("").to_pylist(), raw, offsets, models, chunk, apart)
            pairs, number, times = np.unique(r["link_a"].astype(np.int64) << 32 | r["link_b"], return_inverse=True, return_counts=True)
            blob = pa.compress(number.astype(np.uint32 if len(pairs) > 65536 else np.uint16).tobytes(), codec="zstd", asbytes=True) if len(number) else b""
            lists = [part.column("doc_id").to_pylist(), r["n_a"], r["n_b"], r["n_groups"], r["sha"], (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), times]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.list_(t)) for x, t in zip(lists, types)] + [pa.array([blob], pa.binary())], names)

    names = ["ids", "n_a", "n_b", "n_groups", "sha", "pair_a", "pair_b", "times", "links"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
    schema = ("ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>, pair_a array<int>, pair_b array<int>, "
              "times array<long>, links binary")
    return rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, count of all links, best: whether no other a has more links with this b."""
    totals = pairs.groupBy("a", "b").agg(F.sum("times").alias("count"))
    most = totals.groupBy("b").agg(F.max("count").alias("most"))
    return totals.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, chunk_chars: int = CHUNK_CHARS, apart: int = LANE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level tokenizer over a space and the text, B a piece tokenizer
    over the text, both without special tokens. Places where tokens of both end
    cut them into groups and link the two tokens that end there (no token is
    empty, so each place is one link). ``count``: the links of an id pair in all
    documents; n_best: links whose count no other A id reaches with the same B id;
    count_sum: the counts of the document's links. ``ranks_path``: ranks of A's
    vocabulary for the faster encoder of plain Latin text, which gives the same ids.

    Blocks of texts are aligned in one pass and written; only their distinct id
    pairs travel to be counted, and come back to their blocks. Texts longer than
    ``chunk_chars`` are encoded in chunks cut where neither tokenizer joins
    anything; the tokens are those of the whole text. Null and empty texts, and
    those that tokens don't give back byte for byte, count zero and have an empty
    digest. Null and repeated ids and rows give a row each, an empty table none;
    other columns are not read; there are no ties to break, equal counts are all best.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(aligned_blocks(rows, byte_path, piece_path, ranks_path, block_bytes, chunk_chars, apart), "aligned-blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b", "times")).alias("number", "pair")).select(
        "block", "number", F.col("pair.pair_a").alias("a"), F.col("pair.pair_b").alias("b"), F.col("pair.times").alias("times"))
    counts = written(pair_counts(pairs), "aligned-pairs")
    told = pairs.join(counts, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("number", "count", "best")).alias("told"))

    def finish(reader):
        for batch in reader:
            for k in range(len(batch)):
                told = batch.column("told")[k].values
                ids, n_a, n_b, n_groups, sha = (batch.column(c)[k].values for c in ("ids", "n_a", "n_b", "n_groups", "sha"))
                bounds = np.concatenate(([0], np.cumsum(n_groups.to_numpy())))
                of_row = np.zeros((2, bounds[-1] + 1), np.int64)
                if bounds[-1]:
                    number = told.field("number").to_numpy()
                    count, best = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                    count[number], best[number] = told.field("count").to_numpy(), told.field("best").to_numpy(zero_copy_only=False)
                    kind = np.dtype(np.uint32 if len(number) > 65536 else np.uint16)
                    links = np.frombuffer(pa.decompress(batch.column("links")[k].as_py(), int(bounds[-1]) * kind.itemsize, codec="zstd", asbytes=True), kind)
                    np.cumsum(best[links], out=of_row[0, 1:])
                    np.cumsum(count[links], out=of_row[1, 1:])
                n_best, total = np.diff(of_row[:, bounds], axis=1)
                yield pa.RecordBatch.from_arrays([ids, n_a, n_b, n_groups, n_groups, pa.array(n_best), pa.array(total), sha],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    lists = blocks.join(told, "block", "left").select("ids", "n_a", "n_b", "n_groups", "sha", "links", "told")
    return lists.mapInArrow(finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def query(spark, sf_dir):
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokens(docs, *(public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")))
