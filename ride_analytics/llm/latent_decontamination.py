"""Benchmark passages in documents: latent semantic search and shared rare words for candidates, then longest common subsequences and answers."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import U64, batches, filter_rows, mix, text_bytes, word_hashes, words
from ride_analytics.sources.storage import written

RANK = 48               # latent dimensions
OVERSAMPLE = 8          # more dimensions while they are searched
POWER_ROUNDS = 2
FIT_PARTS = 32          # sums that the driver adds up in each round, at most
FREQUENT_WORDS = 16384  # words of the documents in the space, those in most of them, besides all of the items
PASSAGE_WORDS = 64
BLOCK_PASSAGES = 4096   # multiplied at once
DENSE_WORDS = 256       # words that are columns of a dense block there; the others are added up word by word
HELD_WORDS = 1 << 20    # entries of chunks that are merged before they leave a task
ITEM_WEIGHT = 30.0      # of an item's row in the fit, where a passage has 1: the space serves to tell the items apart
ITEM_WORDS = 20_000     # words of the items that are searched in one pass
STEP = 1.5              # ratio of the window lengths
COMMONEST = 0.2         # words in more than this share of the documents have the least weight
LEAST_WEIGHT = 0.05     # never none, so that an item of such words alone has a direction too
COSINE = 0.15
COMMON = 0.8            # share of an item's words, in order, that is a copy
PARAPHRASE = 0.6        # share that is a paraphrase, if the answer is there
RARE_WORDS = 4          # of an item's rarest words that a window must hold to be checked whatever its cosine
CHUNK_BYTES = 1 << 20

# white space and punctuation end words, so that neither tells a copy from its source
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[k for k in range(128) if not chr(k).isalnum()]] = 0x20


def plain_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, without case and ASCII punctuation, and where each text's begin."""
    if (raw >= 128).any():
        whole = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))
        raw, offsets = text_bytes(pc.utf8_lower(whole))
    low, starts, ends, first = words(_PLAIN[raw], offsets)
    return word_hashes(low, starts, ends), first


def text_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return plain_words(raw, np.array([0, len(raw)]))[0]


class Vocabulary:
    """Numbers of some words by their hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.bits = U64(64 - max(12, int(len(self.hashes) * 8).bit_length()))
        # words by a part of the hash; the few that share it are looked up by search
        slot = (mix(self.hashes) >> self.bits).astype(np.int64)
        self.table = np.full(1 << (64 - int(self.bits)), -1, np.int32)
        self.table[slot] = np.arange(len(slot))
        self.lost = np.flatnonzero(self.table[slot] != np.arange(len(slot)))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for words that have none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int32)
        at = self.table[(mix(hashes) >> self.bits).astype(np.int64)]
        at = np.where((at >= 0) & (self.hashes[at] == hashes), at, -1)
        if len(self.lost):
            lost = self.hashes[self.lost]
            k = np.searchsorted(lost, hashes)
            k[k == len(lost)] = 0
            at = np.where(lost[k] == hashes, self.lost[k], at)
        return at.astype(np.int32)


@dataclass(frozen=True)
class Item:
    """One benchmark item: its words, and the words of its answer, which is its last sentence."""

    item_id: int
    words: np.ndarray
    answer: np.ndarray


def read_items(benchmark: DataFrame) -> list[Item]:
    """Items with words, by id. Null texts and ids are left out."""
    out = []
    for i, text in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").orderBy("item_id").toLocalIterator():
        own = text_words(text)
        if len(own):
            sentences = [s for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if len(text_words(s))]
            out.append(Item(i, own, text_words(sentences[-1]) if sentences else own))
    return out


def item_batches(items: list[Item]) -> list[list[Item]]:
    out, size = [], 0
    for item in items:
        if not out or size + len(item.words) > ITEM_WORDS:
            out.append([])
            size = 0
        out[-1].append(item)
        size += len(item.words)
    return out


def word_counts(rows: DataFrame) -> DataFrame:
    """In how many of all documents each word is: word, n."""

    def distinct(reader):
        held, size = [], 0
        for _, raw, offsets in batches(reader, "text", CHUNK_BYTES // 4):
            hashes, first = plain_words(raw, offsets)
            order = np.argsort(hashes, kind="stable")
            hashes, text = hashes[order], np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
            again = np.zeros(len(hashes), bool)  # in the same text
            again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
            held.append(np.unique(hashes[~again], return_counts=True))
            size += len(held[-1][0])
            if size > HELD_WORDS:
                yield merged(held)
                held, size = [], 0
        if size:
            yield merged(held)

    def merged(held):
        word, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(word, kind="stable")
        word, n = word[order], n[order]
        begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        return pa.RecordBatch.from_arrays([pa.array(word[begin].view(np.int64)), pa.array(np.add.reduceat(n, begin))], ["word", "n"])

    return written(rows.select("text").mapInArrow(distinct, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def document_counts(counted: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """In how many documents each word of the vocabulary is, from ``word_counts``."""
    out = np.zeros(len(vocabulary.hashes), np.int64)
    wanted = counted.sparkSession.createDataFrame(pa.table({"word": vocabulary.hashes.view(np.int64)}))
    found = counted.join(wanted, "word").collect()  # a row per word of the vocabulary
    out[vocabulary.numbers(np.array([r["word"] for r in found], np.int64).view(np.uint64))] = [r["n"] for r in found]
    return out


def passage_words(numbers: np.ndarray, first: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages of ``length`` words of each text: their distinct words, how often each is there, and where each passage's
    begin. ``numbers``: below ``size``, or -1 for words that do not count; passages of such words alone are left out."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    passage = np.cumsum((np.arange(len(numbers)) - first[:-1][text]) % length == 0)
    known = numbers >= 0
    key, often = np.unique(passage[known] * size + numbers[known], return_counts=True)
    passage, number = np.divmod(key, max(1, size))
    return number.astype(np.int32), often, np.flatnonzero(np.diff(passage, prepend=-1)).astype(np.int32)


def stored_passages(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``passage_words`` of all texts, written a row per chunk of text: words, often, begin."""

    def number(reader):
        for _, raw, offsets in batches(reader, "text", CHUNK_BYTES):
            hashes, first = plain_words(raw, offsets)
            word, often, begin = passage_words(vocabulary.numbers(hashes), first, len(vocabulary.hashes), PASSAGE_WORDS)
            if len(begin):
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (word, often.astype(np.uint8), begin)], ["words", "often", "begin"])

    return written(rows.select("text").mapInArrow(number, "words binary, often binary, begin binary"), "latent-passages")


def passage_blocks(word: np.ndarray, often: np.ndarray, begin: np.ndarray, idf: np.ndarray, length: float = 1.0):
    """Word, passage and weight of the entries, and number of the passages, of blocks of TF-IDF rows of that length.
    The last of ``idf`` is that of the word -1, which has no weight."""
    end = np.append(begin[1:], len(word))
    for k in range(0, len(begin), BLOCK_PASSAGES):
        a, b = begin[k:k + BLOCK_PASSAGES], end[k:k + BLOCK_PASSAGES]
        own = word[a[0]:b[-1]]
        weight = often[a[0]:b[-1]] * idf[own]
        row = np.repeat(np.arange(len(a)), b - a)
        norm = np.sqrt(np.bincount(row, weight**2))
        yield own, row, (length * weight / np.maximum(norm, 1e-30)[row]).astype(np.float32), len(a)


def segment_sums(matrix: np.ndarray, index: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of weight x matrix[index] over each segment of the entries. Segments of about one length are filled up with
    weights of 0 and multiplied at once."""
    count = np.diff(np.append(begin, len(index)))
    out = np.empty((len(begin), matrix.shape[1]), np.float32)
    top = np.log2(np.maximum(count, 1)).astype(int)
    width = np.where(count <= 1 << top, 1 << top, np.where(count <= 3 << top >> 1, 3 << top >> 1, 2 << top))
    for n in np.unique(width):
        own = np.flatnonzero(width == n)
        inside = np.arange(n) < count[own, None]
        place = np.where(inside, begin[own, None] + np.arange(n), 0)
        out[own] = np.matmul(np.where(inside, weight[place], np.float32(0))[:, None, :], matrix[index[place]])[:, 0]
    return out


def multiplied(blocks, basis: np.ndarray, dense: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A'AB (zeros without ``fold``) and B'A'AB of the rows A of ``blocks`` and the ``basis`` B. ``dense``: words whose
    entries are multiplied as a dense matrix, since most entries are of few words."""
    column = np.full(len(basis), -1)
    column[dense] = np.arange(len(dense))
    total, gram = np.zeros(basis.shape), np.zeros((basis.shape[1],) * 2)
    for word, row, weight, n in blocks:
        at = column[word]
        common, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        matrix = np.zeros((n, len(dense)), np.float32)
        matrix[row[common], at[common]] = weight[common]
        y = matrix @ basis[dense]
        word, row, weight = word[rare], row[rare], weight[rare]
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        y[row[begin]] += segment_sums(basis, word, weight, begin)
        gram += y.T @ y
        if fold:
            total[dense] += matrix.T @ y
            order = np.argsort(word, kind="stable")
            begin = np.flatnonzero(np.diff(word[order], prepend=-2))
            total[word[order[begin]]] += segment_sums(y, row[order], weight[order], begin)
    return total, gram


def latent_space(passages: DataFrame, local: np.ndarray, items: list[Item], vocabulary: Vocabulary, counts: np.ndarray, idf: np.ndarray,
                 rank: int) -> np.ndarray:
    """Right singular vectors (words x rank) of the TF-IDF rows of all ``passages`` and the items, by randomised SVD.

    ``local``: numbers in ``vocabulary`` of the words of ``passages``, -1 for
    words of other items. Each round multiplies every passage with the basis and
    back, in Spark's tasks; the driver adds up at most ``FIT_PARTS`` matrices of
    words x (rank + oversampling), one at a time, and makes the sum orthogonal.
    """
    size, wide = len(vocabulary.hashes), min(rank + OVERSAMPLE, max(1, len(vocabulary.hashes)))
    idf = np.append(idf, 0.0)
    dense = np.sort(np.argsort(-counts, kind="stable")[:DENSE_WORDS])
    own = passage_words(vocabulary.numbers(np.concatenate([i.words for i in items])), np.cumsum([0, *(len(i.words) for i in items)]), size, 1 << 40)

    def multiply(basis, fold=True):
        basis = np.vstack([basis, np.zeros((1, wide))]).astype(np.float32)

        def blocks(reader):
            for batch in reader:
                for word, often, begin in zip(*(batch.column(c) for c in ("words", "often", "begin"))):
                    word, begin = (np.frombuffer(x.as_buffer(), np.int32) for x in (word, begin))
                    yield from passage_blocks(local[word], np.frombuffer(often.as_buffer(), np.uint8), begin, idf)

        def task(reader):
            total, gram = multiplied(blocks(reader), basis, dense, fold)
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes() if fold else b""]), pa.array([gram.tobytes()])], ["total", "gram"])

        total, gram = multiplied(passage_blocks(*own, idf, ITEM_WEIGHT), basis, dense, fold)
        for r in written(passages.coalesce(FIT_PARTS).mapInArrow(task, "total binary, gram binary"), "latent-sums").toLocalIterator():
            if fold:
                total += np.frombuffer(r[0], np.float32).reshape(total.shape)
            gram += np.frombuffer(r[1]).reshape(gram.shape)
        return total[:-1], gram

    basis = np.linalg.qr(np.random.default_rng(8).standard_normal((size, wide)))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(multiply(basis)[0])[0]
    _, turn = np.linalg.eigh(multiply(basis, fold=False)[1])
    return (basis @ turn[:, ::-1][:, :rank]).astype(np.float32)


def lcs_length(a: list[int], masks: dict[int, int], n: int) -> int:
    """Longest common subsequence of ``a`` with a sequence of ``n`` words, given as the bits where each word stands."""
    row, full = 0, (1 << n) - 1
    for word in a:
        m = masks.get(word)
        if m:
            u = row | m
            row = u & ~(u - ((row << 1) | 1)) & full
    return row.bit_count()


class Search:
    """Items in the latent space, by window length, and by their rarest words, and the checks of their candidates.

    A window that holds ``need`` of an item's n words holds at least r of any
    n - need + r of them. The postings are the rarest so many words of each item
    (r is ``RARE_WORDS``), so every window that can pass the checks is a
    candidate by them, also where the latent space keeps too little of an item
    or its words are so frequent that they have no weight.
    """

    def __init__(self, items: list[Item], vocabulary: Vocabulary, counts: np.ndarray, idf: np.ndarray, unknown: float, space: np.ndarray, cosine: float,
                 common: float, paraphrase: float):
        self.items, self.vocabulary, self.cosine, self.common, self.paraphrase = items, vocabulary, cosine, common, paraphrase
        # the last row is that of words outside the vocabulary: no direction in the space, but the length of a rare word
        self.vectors = np.vstack([space * idf[:, None], np.zeros((1, space.shape[1]))]).astype(np.float32)
        self.squares = np.append(idf, unknown) ** 2
        self.lengths: dict[int, list[int]] = {}
        for k, item in enumerate(items):
            length = 8
            while length < 1.1 * len(item.words):
                length = math.ceil(length * STEP)
            self.lengths.setdefault(length, []).append(k)
        self.units, self.unit = {}, np.zeros((len(items), space.shape[1]), np.float32)
        self.length_of = np.zeros(len(items), np.int64)
        for length, own in self.lengths.items():
            m = np.array([self.vectors[vocabulary.numbers(items[k].words)].sum(axis=0) for k in own])
            self.unit[own] = self.units[length] = m / np.maximum(1e-9, np.linalg.norm(m, axis=1, keepdims=True))
            self.length_of[own] = length
        self.least, rare = np.ones(len(items), np.int64), []
        for k, item in enumerate(items):
            number, n = vocabulary.numbers(item.words), len(item.words)
            need = next((m for m in range(1, n + 1) if m / n >= paraphrase), n)
            self.least[k] = min(need, RARE_WORDS)
            rare.append(np.unique(number[np.argsort(counts[number], kind="stable")[:n - need + self.least[k]]]))
        word = np.concatenate(rare)
        order = np.argsort(word, kind="stable")
        self.post_items = np.repeat(np.arange(len(items)), [len(x) for x in rare])[order]
        self.posts = np.bincount(word, minlength=len(vocabulary.hashes) + 1)  # none of words outside the vocabulary
        self.post_begin = np.cumsum(self.posts) - self.posts
        self.masks: dict[int, tuple] = {}

    def rare_windows(self, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, item, first and last word of all windows that hold the least number of an item's rarest words."""
        posts = self.posts[numbers]
        place = np.repeat(np.arange(len(numbers)), posts)
        item = self.post_items[np.repeat(self.post_begin[numbers] - (np.cumsum(posts) - posts), posts) + np.arange(len(place))]
        order = np.argsort(item, kind="stable")
        place, item = place[order], item[order]
        row = np.searchsorted(first, place, "right") - 1
        last = np.arange(len(place)) + self.least[item] - 1
        stride = np.maximum(1, self.length_of[item] // 3)
        span = self.length_of[item] + stride
        inside = np.minimum(last, max(0, len(place) - 1))
        near = np.flatnonzero((last == inside) & (item[inside] == item) & (row[inside] == row) & (place[inside] - place < span))
        row, item, stride, span, x, y = row[near], item[near], stride[near], span[near], place[near], place[inside[near]]
        begin, count = first[row], first[row + 1] - first[row]
        # the windows begin at multiples of the stride; these hold x and y
        low = np.maximum(0, -((span - (y + 1 - begin)) // stride))
        high = np.minimum((x - begin) // stride, np.maximum(0, -((span - count) // stride)))
        n = np.maximum(0, high - low + 1)
        window = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row, item, window = np.unique(np.stack([np.repeat(row, n), np.repeat(item, n), window]), axis=1)
        stride = np.maximum(1, self.length_of[item] // 3)
        begin = first[row] + window * stride
        return row, item, begin, np.minimum(begin + self.length_of[item] + stride, first[row + 1])

    def candidates(self, hashes: np.ndarray, first: np.ndarray):
        """(text, item, first word, last word, cosine) of the windows near an item in the latent space, then of those that
        are not but hold its rarest words. Each item that a text holds lies whole in a window."""
        numbers = self.vocabulary.numbers(hashes)
        total = np.zeros((len(hashes) + 1, self.vectors.shape[1]), np.float32)
        np.cumsum(self.vectors[numbers], axis=0, out=total[1:])
        squares = np.concatenate(([0.0], np.cumsum(self.squares[numbers])))
        count = np.diff(first)
        for length, own in self.lengths.items():
            stride = max(1, length // 3)
            span = length + stride
            n = np.maximum(1, -(-(count - span) // stride) + 1) * (count > 0)
            row = np.repeat(np.arange(len(count)), n)
            begin = first[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * stride
            end = np.minimum(begin + span, first[1:][row])
            units = self.units[length].T.copy()
            for a in range(0, len(row), 8192):
                x, y = begin[a:a + 8192], end[a:a + 8192]
                near = (total[y] - total[x]) @ units
                norm = np.sqrt(np.maximum(squares[y] - squares[x], 1e-9))
                w, k = np.nonzero(near >= (self.cosine * norm)[:, None])
                for x, y in zip(w.tolist(), k.tolist()):
                    yield int(row[a + x]), own[y], int(begin[a + x]), int(end[a + x]), float(near[x, y] / norm[x])
        row, item, begin, end = self.rare_windows(numbers, first)
        for a in range(0, len(row), 8192):
            x, y, k = begin[a:a + 8192], end[a:a + 8192], item[a:a + 8192]
            near = ((total[y] - total[x]) * self.unit[k]).sum(axis=1)
            norm = np.sqrt(np.maximum(squares[y] - squares[x], 1e-9))
            for w in np.flatnonzero(near < self.cosine * norm).tolist():
                yield int(row[a + w]), int(k[w]), int(x[w]), int(y[w]), float(near[w] / norm[w])

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple]:
        """(text, item, cosine, share, answer, first word of the text, words) of the best window of each text and item that passes the checks."""
        best = {}
        for row, item, a, b, near in self.candidates(hashes, first):
            got = self.check(item, hashes[a:b])
            if got and ((row, item) not in best or got > best[row, item][:2]):
                best[row, item] = (*got, near, a - int(first[row]), b - a)
        return [(*key, near, share, answer, a, n) for key, (share, answer, near, a, n) in sorted(best.items())]

    def check(self, item: int, window: np.ndarray) -> tuple[float, bool] | None:
        """Share of the item's words that stand in the window in order, and whether its answer does, if they are contamination."""
        if item not in self.masks:
            masks: dict[int, int] = {}
            for k, word in enumerate(self.items[item].words.tolist()):
                masks[word] = masks.get(word, 0) | 1 << k
            self.masks[item] = masks, len(self.items[item].words), self.items[item].answer.tobytes()
        masks, n, answer = self.masks[item]
        own = window.tolist()
        if sum(masks[w].bit_count() for w in set(own) if w in masks) < self.paraphrase * n:
            return None
        share = lcs_length(own, masks, n) / n
        if share < self.paraphrase:
            return None
        place = window.tobytes().find(answer)
        while place > 0 and place % 8:
            place = window.tobytes().find(answer, place + 1)
        if share >= self.common or place >= 0:
            return share, place >= 0
        return None


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: int = RANK, cosine: float = COSINE,
                 common: float = COMMON, paraphrase: float = PARAPHRASE) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, cosine, common_share, answer, first_word, n_words.

    Words have no case and no ASCII punctuation. Windows of each document are
    compared with the items of their length in the latent space; those of a
    cosine of at least ``cosine`` are candidates, and so is every window with as
    many of an item's rarest words as a hit cannot lack (``Search``). So the hits
    are those of all windows, whatever the rank and the cosine. A candidate is a hit when the
    longest common subsequence has ``common`` of the item's words, or
    ``paraphrase`` of them and the window holds the item's answer (its last
    sentence). The space is fitted on the items and the passages of all texts; its
    words are those of the items and the ``FREQUENT_WORDS`` that most documents
    hold. Items are searched in groups of ``ITEM_WORDS`` words, so neither the driver
    nor a task holds more. Null and empty texts and items hold nothing; a
    document of a null id, or of rows that repeat it, is reported by its id;
    empty tables give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, cosine double, common_share double, answer boolean, first_word long, n_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    for search in fit_searches(rows, benchmark, rank, cosine, common, paraphrase):
        out = out.union(_search(rows, search, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no benchmark item; as ``contaminated`` decides."""
    rows = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    for search in fit_searches(rows, benchmark):
        def clean(raw, offsets, search=search):
            out = np.ones(len(offsets) - 1, bool)
            for row, *_ in search.hits(*plain_words(raw, offsets)):
                out[row] = False
            return out

        docs = filter_rows(docs, clean, text_col, CHUNK_BYTES // 4)
    return docs


def fit_searches(rows: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE, common: float = COMMON,
                 paraphrase: float = PARAPHRASE) -> list[Search]:
    """A search for each group of items, none without items or documents."""
    items = read_items(benchmark)
    n_docs = rows.count()
    if not items or not n_docs:
        return []
    counted = word_counts(rows)
    frequent = counted.where("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).collect()
    frequent = np.array([r[0] for r in frequent], np.int64).view(np.uint64)
    known = Vocabulary(np.concatenate([frequent, *(i.words for i in items)]))
    known_counts, passages = document_counts(counted, known), stored_passages(rows, known)
    rarity = lambda n: np.maximum(LEAST_WEIGHT, np.log((n_docs + 1) * COMMONEST / (n + 1)))
    out = []
    for own in item_batches(items):
        vocabulary = Vocabulary(np.concatenate([frequent, *(i.words for i in own)]))
        counts = known_counts[known.numbers(vocabulary.hashes)]
        idf = rarity(counts)
        space = latent_space(passages, vocabulary.numbers(known.hashes), own, vocabulary, counts, idf, rank)
        out.append(Search(own, vocabulary, counts, idf, float(rarity(1)), space, cosine, common, paraphrase))
    return out


def _search(rows: DataFrame, search: Search, schema: str) -> DataFrame:
    def find(reader):
        for part, raw, offsets in batches(reader, "text", CHUNK_BYTES // 4):
            ids = part.column("doc_id").to_pylist()
            found = [(ids[row], search.items[item].item_id, *rest) for row, item, *rest in search.hits(*plain_words(raw, offsets))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], [x.split()[0] for x in schema.split(", ")])

    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
    return rows.mapInArrow(find, schema)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark)
