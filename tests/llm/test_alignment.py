"""Token alignment against two plain loops over the libraries' own encodings."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ride_analytics.llm import token_alignment as ta

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, PIECE, RANKS = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


def plain_groups(a, b, len_a, len_b):
    """Groups by stepping both sides token by token."""
    out, i, j = [], 0, 0
    while i < len(a):
        x, y, p, q = [a[i]], [b[j]], len_a[a[i]], len_b[b[j]]
        i, j = i + 1, j + 1
        while p != q:
            if p < q:
                x.append(a[i])
                p += len_a[a[i]]
                i += 1
            else:
                y.append(b[j])
                q += len_b[b[j]]
                j += 1
        out.append((x, y))
    return out


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(BYTE)
    model.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    bytes_a = ta.ByteTokens(BYTE, None).bytes
    bytes_b = [bytes([int(m[1], 16)]) if (m := re.fullmatch(r"<0x(..)>", p)) else p.replace("▁", " ").encode()
               for p in (piece.id_to_piece(k) for k in range(piece.get_piece_size()))]
    found = []
    for i, text in rows:
        a = model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(bytes_a[x] for x in a) != whole or b"".join(bytes_b[x] for x in b) != whole:
            a = b = []
        found.append((i, a, b, plain_groups(a, b, [len(x) for x in bytes_a], [len(x) for x in bytes_b])))
    counts = Counter((x[-1], y[-1]) for *_, groups in found for x, y in groups)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for i, a, b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def texts(n=60, seed=3):
    draw = random.Random(seed)
    alphabet = ["the", "of", "naïve", "Ünïcödé", "12345", "don't", "<|endoftext|>", "<s>", "</s>", "<0x41>", "日本語", "🙂", "a b", "x▁y", "“q”", "\n\n", "\t", "  ", "é", "ﬁ"]
    return [" ".join(draw.choice(alphabet) if draw.random() < 0.3 else "".join(draw.choice("abcdefgh.,") for _ in range(draw.randrange(1, 9)))
                     for _ in range(draw.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("ranks,block,chunk,apart", [(RANKS, 4 << 20, 1 << 16, 512), (None, 900, 64, 4), (RANKS, 1, 16, 1)])
def test_alignment_equals_plain_loops(spark, ranks, block, chunk, apart):
    rows = [(k, t) for k, t in enumerate(texts())]
    rows += [(100, None), (101, ""), (102, " "), (103, "  a  "), (104, "same"), (104, "same"), (105, "same"), (None, "no id"), (106, "▁"), (107, "▁ x"),
             (108, "word " * 40_000), (109, "a" * 5000), (110, " " * 300 + "x"), (111, "\x00\x01 z"), (112, "É" * 700 + " end "), (113, "\n"), (114, "new\r\nline\x85x")]
    docs = spark.createDataFrame([(i, t, "t", 7) for i, t in rows], "doc_id long, text string, block string, n_a int").repartition(3)
    got = ta.align_tokens(docs, BYTE, PIECE, ranks, block_bytes=block, chunk_chars=chunk, apart=apart)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute(rows))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align_tokens(docs, BYTE, PIECE, RANKS).count() == 0


def test_common_ends_of_random_cuts():
    draw = np.random.default_rng(1)
    for _ in range(200):
        sizes = draw.integers(1, 60, draw.integers(1, 6))
        ends = [], []
        rows = [0], [0]
        base = 0
        for n in sizes.tolist():
            for side in (0, 1):
                cuts = np.unique(np.append(draw.integers(1, n + 1, draw.integers(1, n + 2)), n)) + base
                ends[side].extend(cuts.tolist())
                rows[side].append(len(ends[side]))
            base += n
        a, b = (np.array(x) for x in ends)
        got = ta.common_ends(a, b, *(np.array(x) for x in rows), apart=int(draw.integers(1, 9)))
        want = np.intersect1d(a, b)
        assert (a[got[0]] == want).all() and (b[got[1]] == want).all() and len(got[0]) == len(want)
