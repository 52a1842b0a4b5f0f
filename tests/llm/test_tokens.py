"""Token counts and packing against the tokenizers themselves."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ride_analytics.llm import retrieval_packing, token_counts

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, length long, ids string, uid long"
ODD = [None, "", " ", "a", "</s><s> <unk>", "x" * 3000, "é\x00▁ ▁a b c", "日本語 text 123 don't it'S", "é Éé", "A\r\n\t b  c   d"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)


def long_texts():
    draw = random.Random(8)
    return [" ".join("".join(draw.choice("abcdé,.") for _ in range(draw.randrange(1, 9))) for _ in range(n)) for n in (3000, 700)] + ["ab " * 4000, "z" * 9000]


@pytest.mark.parametrize("chunk,overlap", [(65536, 256), (100, 1)])
def test_counts_equal_the_library(spark, chunk, overlap):
    texts = ODD + long_texts()
    rows = [*enumerate(texts), (None, "a b"), (0, "a b")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in token_counts.count_tokens(frame(spark, rows), PIECES, limit=10, chunk_chars=chunk, overlap_chars=overlap).collect())
    model = token_counts.piece_model(PIECES)
    want = [(i if i is not None else -1, len((t or "").encode()), n := len(model.encode(t or "")), n > 10) for i, t in rows]
    assert got == sorted(want)
    assert token_counts.count_tokens(frame(spark, []), PIECES).count() == 0


def test_splices_only_at_stable_boundaries():
    model = token_counts.piece_model(PIECES)
    assert not token_counts.crossing_pieces(model)
    for text in long_texts() + ["▁a▁▁b " * 300, "😀 😀" * 200, " " * 500 + "end"]:
        for chunk, overlap in ((50, 1), (333, 40)):
            assert token_counts.count_spliced(model, text, chunk, overlap) == len(model.encode(text))


def check_packing(spark, rows, **options):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(WORDS)
    want = {i: model.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    got = retrieval_packing.pack(frame(spark, rows), WORDS, **options).collect()
    window, at, places = options.get("window", 2048), {}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.start == at.get(r.doc_id, 0) and r.length == len(ids) > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.ids is None or np.frombuffer(r.ids, "<u4").tolist() == ids
        at[r.doc_id] = r.start + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {i: len(ids) for i, ids in want.items()}
    total = 0
    for pieces in places.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place <= window
        total += place
    return places, total


@pytest.mark.parametrize("options", [{}, {"window": 64, "shard_tokens": 500}])
def test_every_id_is_packed_once(spark, options):
    texts = ODD + long_texts() + ["<|endoftext|> a <|ENDOFTEXT|>", "U" * 300 + "! hello, (world)..."] + ["same copy of a text"] * 40
    places, total = check_packing(spark, list(enumerate(texts)), **options)
    if not options:
        assert len(places) == -(-total // 2048)  # only the last sequence is short


def test_repeated_and_null_ids_and_no_rows(spark):
    got = retrieval_packing.pack(frame(spark, [(None, "a b"), (3, "c"), (3, "c"), (None, None)]), WORDS).collect()
    assert sum(r.length for r in got) == 3 + 2 + 2 + 1
    assert retrieval_packing.pack(frame(spark, []), WORDS).count() == 0


def test_a_window_is_filled_with_neighbours():
    draw = np.random.default_rng(3)
    topics = [draw.integers(k * 1000, k * 1000 + 40, (10, 60)).astype(np.uint32) for k in range(5)]
    documents = [topics[k % 5][k // 5] for k in range(50)]  # the topics take turns
    pieces = retrieval_packing.fill_windows(documents, 300)
    windows = {}
    for doc, *_, sequence, _ in pieces:
        windows.setdefault(sequence, set()).add(doc % 5)
    assert np.mean([len(t) for t in windows.values()]) < 1.5
    assert sorted({p[0] for p in pieces}) == list(range(50))


def test_neighbours_by_any_shared_term_follow():
    """a document that shares only a lighter term of the opening one comes before one that shares none."""
    common = list(range(100, 100 + retrieval_packing.QUERY_TERMS))
    opening = np.array([t for t in common for _ in range(3)] + [7], np.uint32)   # 7 weighs least
    documents = [opening, np.full(5, 900, np.uint32), np.array([901] * 5 + [7], np.uint32), *[np.array([t], np.uint32) for t in common]]
    pieces = retrieval_packing.fill_windows(documents, len(opening) + len(common) + 6)
    assert [p[0] for p in pieces if p[3] == 0][-1] == 2
    assert sorted(p[0] for p in pieces) == list(range(len(documents)))


def test_runs_are_learned_once_and_equal_the_library():
    """op3: a run of letters is encoded once whatever punctuation follows it, and the ids are those of the library."""
    from tokenizers import Tokenizer
    from ride_analytics.llm.common import batches
    import pyarrow as pa
    model, library = retrieval_packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    texts = ["wordy wordy, wordy. wordy!? (wordy) wordy.wordy Wordy; wordy", None, "", "× a× ×a a÷, Ã ã, Éa. éÀ?! ÿ... Ć ć,", "a,,b a,. ... .a", "x" * 5000, " \t"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for _, raw, offsets in batches([batch], "text", 1 << 20):
        ids, bounds, _, _ = model.encode(raw, offsets)
    own = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert own == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    learned = []
    known = retrieval_packing.WordTokenizer(WORDS)
    learn = known._learn
    known._learn = lambda keys, runs: (learned.extend(runs), learn(keys, runs))
    for text in ("wordy, wordy wordy.", "wordy!? wordy;"):
        for _, raw, offsets in batches([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])], "text", 1 << 20):
            known.encode(raw, offsets)
    assert sorted(learned) == sorted(["wordy", ",", ".", "!?", ";"]) and len(known.runs) == 5
