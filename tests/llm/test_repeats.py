"""Long repeats by brute force, and benchmark leaks that were put in on purpose."""
import hashlib
import random

import numpy as np
import pytest

from ride_analytics.llm import latent_decontamination, run_index

DOCS = "doc_id long, text string, start long, block string, marked int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)


def corpus():
    draw = random.Random(11)
    word = lambda n: "".join(draw.choice("abcdefgh é") for _ in range(n))
    shared, line = word(700), "One line that stands in many texts and is not short.\n"
    texts = [word(draw.randrange(0, 2500)) for _ in range(12)]
    texts += [word(draw.randrange(0, 300)) + shared[a:b] + word(draw.randrange(0, 300)) for a, b in ((0, 700), (0, 399), (100, 600), (250, 655), (0, 700), (3, 404))]
    texts += [line * n for n in (5, 9, 40)] + ["ab" * 600, "b" * 399, "b" * 400, "b" * 401, "c" * 400]
    texts += [texts[3], texts[3], texts[12], word(400), None, "", "\x00" * 500, "x\x00" + "\x00" * 450]
    copy = list(word(3000))
    for k in range(6):
        own = list(copy)
        own[draw.randrange(3000)] = "#"
        texts.append("".join(own))
    return [(i * 3, t) for i, t in enumerate(texts)]


def brute(rows, span):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for d, text in enumerate(data):
        for a in range(len(text) - span + 1):
            seen[text[a:a + span]] = seen.get(text[a:a + span], 0) + 1
    out = []
    for (i, _), text in zip(rows, data):
        gone = np.zeros(len(text), bool)
        for a in range(len(text) - span + 1):
            if seen[text[a:a + span]] > 1:
                gone[a:a + span] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((i, len(text), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), [(int(x), int(y)) for x, y in zip(edges[::2], edges[1::2])]))
    return out


@pytest.mark.parametrize("hot,block", [(20_000, 1 << 21), (1, 4000), (3, 1 << 21)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(run_index, "BLOCK_BYTES", block)
    rows = corpus()
    got = run_index.long_repeats(frame(spark, rows), hot_contexts=hot, kept=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, [tuple(s) for s in r.spans]) for r in got) == brute(rows, run_index.SPAN)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "".join(random.Random(1).choice("abc") for _ in range(450))
    got = run_index.long_repeats(frame(spark, [(None, text), (7, text), (7, "short"), (8, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 450), (7, 0), (7, 450), (8, 0)]
    assert run_index.long_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [3, 50, 10_000])
def test_index_orders_samples_and_streams(monkeypatch, limit):
    monkeypatch.setattr(run_index, "SORT_STARTS", limit)
    draw = random.Random(limit)
    base = bytes(draw.choice(b"abc") for _ in range(300))
    contents = [base[a:a + draw.randrange(40, 200)] for a in (0, 10, 20, 50, 90)] + [bytes(draw.choice(b"ab") for _ in range(60)) for _ in range(4)]
    span = 24
    index = run_index.RunIndex(contents, span)
    order = run_index.window_order(index.text, index.starts, span, limit)
    windows = [bytes(index.text[s:s + span]) for s in index.starts]
    assert [windows[k] for k in order] == sorted(windows)
    hit = index.matches() >= span
    assert hit.tolist() == [windows.count(w) > 1 for w in windows]
    assert len(index.runs) < len(index.order)


def sentences(draw, vocabulary, n):
    out = []
    for k in range(n):
        out.append(draw.choice(vocabulary) + ("." if k % 9 == 8 else ""))
    return " ".join(out)


def test_leaks_are_found_and_clean_documents_stay(spark):
    draw = random.Random(21)
    vocabulary = ["".join(draw.choice("abcdefghijklmnoprstuvé") for _ in range(draw.randrange(2, 8))) for _ in range(3000)]
    items = [(k, sentences(draw, vocabulary, draw.randrange(12, 70)).capitalize() + ".") for k in range(40)]
    rows, want = [], set()
    for i in range(400):
        text = sentences(draw, vocabulary, draw.randrange(5, 400))
        if i % 5 == 0:
            k = draw.randrange(40)
            item = items[k][1]
            if i % 3 == 0:  # a paraphrase: a few words of the first part changed, the answer left
                words = item.split()
                for j in range(0, len(words) * 2 // 3, 5):
                    words[j] = draw.choice(vocabulary)
                item = " ".join(words)
            at = draw.randrange(len(text.split()) + 1)
            words = text.split()
            text = " ".join(words[:at] + [item.upper() if i % 2 else item.replace(" ", "\n")] + words[at:])
            want.add((i, k))
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, "..."), (None, items[0][1]), (903, items[1][1]), (903, items[1][1]), (904, "word " * 20_000 + items[2][1])]
    want |= {(None, 0), (903, 1), (904, 2)}
    benchmark = spark.createDataFrame([*items, (None, "null id"), (50, None), (51, ""), (52, "...")], "item_id long, text string")
    found = latent_decontamination.contaminated(frame(spark, rows), benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    left = latent_decontamination.drop_contaminated(frame(spark, rows), benchmark)
    assert left.columns == ["doc_id", "text", "start", "block", "marked"]
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _ in rows if i is not None} - {i for i, _ in want})
    assert latent_decontamination.contaminated(frame(spark, []), benchmark).count() == 0
    assert latent_decontamination.contaminated(frame(spark, rows), benchmark.where("false")).count() == 0


def test_copies_and_paraphrases_of_a_full_batch_are_found(spark):
    draw = random.Random(22)
    names = ["".join(draw.choice("abcdefghijklmnoprstuv") for _ in range(draw.randrange(2, 8))) for _ in range(4000)]
    word = lambda: names[int(4000 ** draw.random()) - 1]
    # every passage of the benchmark is about as long as those of the tables, and all fit one pass
    items = [(k, [word() for _ in range(draw.randrange(15, 60))]) for k in range(530)]
    assert 19_000 < sum(len(w) for _, w in items) <= latent_decontamination.ITEM_WORDS
    rows, want = [], set()
    for k, own in items:
        kept = [*own]
        for j in draw.sample(range(len(own) - 4), int(0.4 * len(own))):
            kept[j] = f"new{draw.randrange(10**6)}"
        for i, passage in ((2 * k, own), (2 * k + 1, kept)):
            rows.append((i, " ".join([word() for _ in range(draw.randrange(5, 60))] + passage + [word() for _ in range(draw.randrange(5, 60))])))
            want.add((i, k))
    benchmark = spark.createDataFrame([(k, " ".join(w[:-4]) + ". " + " ".join(w[-4:])) for k, w in items], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in latent_decontamination.contaminated(frame(spark, rows), benchmark).collect()}
    copies = {(i, k) for i, k in want if i % 2 == 0}
    assert (len(copies & found), len((want - copies) & found), len(found - want)) == (530, 530, 0)


def test_items_of_frequent_words_are_found(spark):
    draw = random.Random(24)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(2, 8))) for _ in range(2000)]
    frequent = [f"of{k}" for k in range(25)]
    items = [(0, sentences(draw, vocabulary, 40)), (1, sentences(draw, frequent, 40)), (2, sentences(draw, vocabulary, 20))]
    # item 0 stands in a third of the documents; the words of item 1 stand in most, the item itself in one of eleven
    rows = []
    for i in range(330):
        text = [sentences(draw, vocabulary, 60), sentences(draw, frequent, 60), sentences(draw, vocabulary, 30)]
        rows.append((i, " ".join([*text[:2], *([items[0][1]] if i % 3 == 0 else []), *([items[1][1]] if i % 11 == 0 else []), text[2]])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = latent_decontamination.contaminated(frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.common_share == 1} == {(i, k) for k, n in ((0, 3), (1, 11)) for i in range(0, 330, n)}
    small = [(0, items[0][1]), (1, "other words " + items[2][1].upper()), (2, rows[1][1])]
    found = latent_decontamination.contaminated(frame(spark, small), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 0), (1, 2)} and all(r.cosine > 0.5 for r in found)


def brute_hits(search, hashes, first):
    """(text, item) of the windows that pass the checks, without any search."""
    out = set()
    for length, own in search.lengths.items():
        stride = max(1, length // 3)
        for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            for x in range(a, max(a, b - length - stride) + stride, stride) if b > a else ():
                out |= {(k, i) for i in own if search.check(i, hashes[x:min(x + length + stride, b)])}
    return out


@pytest.mark.parametrize("cosine", [0.15, 2.0])
def test_hits_are_those_of_all_windows(spark, cosine):
    draw = random.Random(23)
    few = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(draw.choice(few) for _ in range(draw.randrange(1, 25)))) for k in range(40)]
    texts = ["", *(" ".join(draw.choice(few) for _ in range(draw.randrange(0, 120))) for _ in range(60)), "", items[3][1]]
    rows = frame(spark, list(enumerate(texts))).select("doc_id", "text")
    search, = latent_decontamination.fit_searches(rows, spark.createDataFrame(items, "item_id long, text string"), cosine=cosine)
    raw = [t.encode() for t in texts]
    hashes, first = latent_decontamination.plain_words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    want = brute_hits(search, hashes, first)
    assert len(want) > 20 and {h[:2] for h in search.hits(hashes, first)} == want


def test_space_is_fitted_on_all_documents(spark):
    # each word of the documents is in two of them, far apart; a part of the documents misses most such pairs
    rows = frame(spark, [(i, f"both{i % 5000} and some more") for i in range(10_000)]).select("doc_id", "text")
    benchmark = spark.createDataFrame([(0, "an item of a few words")], "item_id long, text string")
    search, = latent_decontamination.fit_searches(rows, benchmark)
    words = np.concatenate([latent_decontamination.text_words(f"both{k}") for k in range(5000)])
    number = search.vocabulary.numbers(words)
    assert (number >= 0).all()
    assert (search.squares[number] == search.squares[number[0]]).all()


def test_latent_space_is_that_of_all_passages(spark):
    draw = random.Random(25)
    names = [f"w{k}" for k in range(400)]
    word = lambda: names[int(400 ** draw.random()) - 1]
    texts = ["", *(" ".join(word() for _ in range(draw.randrange(1, 200))) for _ in range(150)), "...", "only unknown words"]
    items = [latent_decontamination.Item(k, latent_decontamination.text_words(" ".join(word() for _ in range(20))), None) for k in range(6)]
    known = latent_decontamination.Vocabulary(np.concatenate([latent_decontamination.text_words(w) for w in names]))
    vocabulary = latent_decontamination.Vocabulary(known.hashes[::2])
    items = [latent_decontamination.Item(i.item_id, i.words[vocabulary.numbers(i.words) >= 0], None) for i in items]
    size = len(vocabulary.hashes)
    idf, counts = np.linspace(0.5, 3, size), np.arange(size)
    # the rows one by one
    matrix = []
    for own, length, weight in [*((latent_decontamination.text_words(t), 64, 1.0) for t in texts), *((i.words, 1000, latent_decontamination.ITEM_WEIGHT) for i in items)]:
        for k in range(0, len(own), length):
            number = vocabulary.numbers(own[k:k + length])
            row = np.bincount(number[number >= 0], minlength=size) * idf
            if row.any():
                matrix.append(weight * row / np.linalg.norm(row))
    matrix = np.array(matrix)
    rows = frame(spark, list(enumerate(texts))).select("doc_id", "text").repartition(5)
    passages = latent_decontamination.stored_passages(rows, known)
    local = vocabulary.numbers(known.hashes)
    space = latent_decontamination.latent_space(passages, local, items, vocabulary, counts, idf, 12)
    assert np.allclose(space.T @ space, np.eye(12), atol=1e-4)
    best = (np.linalg.svd(matrix, compute_uv=False)[:12] ** 2).sum()
    assert 0.995 * best < (np.linalg.norm(matrix @ space) ** 2) < 1.0001 * best
    basis = np.vstack([space, np.zeros((1, 12), np.float32)])
    blocks = [latent_decontamination.passage_blocks(local[np.frombuffer(r[0], np.int32)], np.frombuffer(r[1], np.uint8), np.frombuffer(r[2], np.int32), np.append(idf, 0.0))
              for r in passages.collect()]
    rest = matrix[:-len(items)]
    total, gram = latent_decontamination.multiplied((b for bs in blocks for b in bs), basis, np.arange(0, size, 3))
    assert np.allclose(total[:-1], rest.T @ rest @ space, atol=1e-4) and np.allclose(gram, space.T @ rest.T @ rest @ space, atol=1e-4)


def test_common_subsequence():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
        return row[-1]

    draw = random.Random(2)
    for _ in range(50):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 30))] for _ in range(2))
        masks = {}
        for k, x in enumerate(b):
            masks[x] = masks.get(x, 0) | 1 << k
        assert latent_decontamination.lcs_length(a, masks, len(b)) == table(a, b)
