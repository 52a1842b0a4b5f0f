"""Token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced at stable boundaries."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import batches

SPACES = " ▁"  # the model writes a space as the second; both begin a piece


@functools.lru_cache(maxsize=4)
def piece_model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def crossing_pieces(model) -> bool:
    """Whether a piece holds a space after another character: then no boundary is stable."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return any("▁" in p.lstrip("▁") for p in pieces)


def stable(text: str, at: int) -> bool:
    """Whether a token ends before ``at`` in the whole text's encoding, whatever stands around.

    No piece holds a space after another character, and pieces only arise by
    merging neighbours into pieces, so nothing ever joins a character to the
    space behind it.
    """
    return 0 < at < len(text) and text[at] in SPACES and text[at - 1] not in SPACES


def token_offsets(model, text: str) -> np.ndarray:
    """Where each token of ``text`` begins, in code points. The library tells bytes."""
    begins = np.array([p.begin for p in model.encode(text, return_type="proto").pieces], np.int64)
    first = (np.frombuffer(text.encode("utf-8") + b" ", np.uint8) & 0xC0) != 0x80
    return np.cumsum(first)[begins] - 1


def count_spliced(model, text: str, chunk: int, overlap: int) -> int:
    """Tokens of ``text`` from overlapping chunks.

    Tokens before ``start`` are counted. The next chunk reaches back by the
    overlap; both chunks must show a boundary at ``start``, else the overlap is
    widened. The chunk gives its tokens up to its last stable boundary; a chunk
    without one is widened to the right.
    """
    total, start, back, size = 0, 0, overlap, chunk
    while True:
        left, right = max(0, start - back), min(len(text), start + size)
        begins = token_offsets(model, text[left:right]) + left
        if left and not (begins == start).any():
            back *= 2
            continue
        if right == len(text):
            return total + int((begins >= start).sum())
        end = next((p for p in range(right - 1, start, -1) if stable(text, p)), None)
        if end is None or not (begins == end).any():
            size *= 2
            continue
        total += int(((begins >= start) & (begins < end)).sum())
        start, back, size = end, overlap, chunk


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
                 chunk_chars: int = 65536, overlap_chars: int = 256) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Tokens are those of the model's library for the whole text, with its
    defaults. Texts of more than ``chunk_chars`` are encoded in chunks, so the
    encoder's memory is bounded; the count is the same. Null texts count as
    empty (0 tokens); ids may be null or repeat, each row gives a row; an empty
    table gives none; other columns are not read.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def count(reader):
        model = piece_model(model_path)
        whole = None
        for part, _, offsets in batches(reader, "text", 4 << 20):
            texts = part.column("text").fill_null("").to_pylist()
            huge = [i for i, t in enumerate(texts) if len(t) > chunk_chars]
            short = texts
            if huge:
                if whole is None:
                    whole = crossing_pieces(model)
                if not whole:
                    short = [t if len(t) <= chunk_chars else "" for t in texts]
            n = np.array([len(x) for x in model.encode(short, num_threads=1)], np.int64)
            if huge and not whole:
                n[huge] = [count_spliced(model, texts[i], chunk_chars, overlap_chars) for i in huge]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, schema)


def query(spark, sf_dir):
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
