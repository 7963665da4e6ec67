"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words are counted over the whole
   corpus.
2. The benchmark's TF-IDF passages are factorised by a randomised SVD: the
   products with the passage matrix are summed over the cluster, the small
   orthogonalisations run on the driver.
3. Every window of every document is folded into the latent space; windows
   whose cosine with an item reaches ``min_cosine`` are candidates.
4. A candidate counts if, in a stretch of one and a half times the item's
   length, the longest common subsequence of words covers most of the item, or
   about half of it and the item's answer as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, text_batches

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Item:
    item_id: int
    words: list[str]
    answer: list[str]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_of(text: str | None, answer: str | None) -> list[str]:
    """The words of the answer; without one, of the item's last sentence
    (its last five words if that is shorter than three)."""
    if answer and words_of(answer):
        return words_of(answer)
    whole = words_of(text)
    last = words_of(_SENTENCE.split((text or "").strip())[-1])
    return last if len(last) >= 3 else whole[-5:]


def common_subsequence(item: list[str], text: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    n = len(item)
    at: dict[str, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << n) - 1
    row = full
    for w in text:
        m = at.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def _answer_share(answer: list[str], text: list[str]) -> float:
    """Share of the answer found in order within twice its length."""
    m = len(answer)
    if not m or common_subsequence(answer, text) == 0:
        return 0.0
    step = max(1, m // 2)
    return max(common_subsequence(answer, text[a:a + 2 * m])
               for a in range(0, max(1, len(text) - 2 * m + step), step)) / m


def closest(item: Item, text: list[str], lo: int, hi: int, near_verbatim: float, paraphrase: float,
            answer_share: float) -> tuple[float, float] | None:
    """(share of the item, share of its answer) of the best stretch of
    ``text[lo:hi]`` that holds the item, or None.

    A stretch is one and a half item lengths, moved by a quarter of one, so
    the text's length has no say in what is found by chance; the answer may
    stand up to twice its length outside.
    """
    n, around, region = len(item.words), 2 * len(item.answer), text[lo:hi]
    # No common subsequence is longer than the item's words that occur at all, or than that of the whole region.
    least = min(paraphrase, near_verbatim) * n
    own, there = set(item.words), set(region)
    if sum(map(there.__contains__, item.words)) < least:
        return None
    if n < 8:
        at = [a for a in range(len(region) - n + 1) if region[a:a + n] == item.words]
        stretches = [(a, a + n) for a in at]
    else:
        if common_subsequence(item.words, region) < least:
            return None
        size, step = n + (n + 1) // 2, max(1, n // 4)
        stretches = [(a, min(a + size, len(region))) for a in range(0, max(1, len(region) - size + step), step)]
    hits = np.cumsum([0, *map(own.__contains__, region)])
    best = None
    for a, b in stretches:
        if hits[b] - hits[a] < least:
            continue
        share = common_subsequence(item.words, region[a:b]) / n
        if share < min(paraphrase, near_verbatim) or (best and share < best[0]):
            continue
        known = _answer_share(item.answer, text[max(0, lo + a - around):lo + b + around])
        if share >= near_verbatim or (share >= paraphrase and known >= answer_share):
            best = max(best or (0.0, 0.0), (share, known))
    return best


def _document_counts(vocab: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows, keys = np.zeros(len(vocab) + 1, np.int64), 0, vocab.keys()
        for (texts,) in text_batches(batches, (0,), 0):
            for text in texts:
                if text:
                    for w in keys & set(words_of(text)):
                        counts[vocab[w]] += 1
            rows += len(texts)
        counts[-1] = rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["term", "n"])
    return run


def _gram_times(vocab: dict[str, int], idf: np.ndarray, basis: np.ndarray):
    """Per task, the rows of A'(A basis) that its passages (rows of A) touch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros_like(basis)
        for (texts,) in text_batches(batches, (0,), 0):
            for text in texts:
                ids = np.array([vocab[w] for w in words_of(text)], np.int64)
                if len(ids):
                    at, tf = np.unique(ids, return_counts=True)
                    row = tf * idf[at]
                    row = row / max(np.linalg.norm(row), 1e-12)
                    out[at] += row[:, None] * (row @ basis[at])
        at = np.flatnonzero(np.abs(out).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(list(out[at]), pa.list_(pa.float64()))], names=["term", "v"])
    return run


def latent_basis(bench: DataFrame, vocab: dict[str, int], idf: np.ndarray, rank: int, rounds: int = 3) -> np.ndarray:
    """Leading right singular vectors (words x rank) of the TF-IDF passages."""
    n = len(vocab)
    rank = min(rank, n)
    basis, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((n, rank)))

    def times(q: np.ndarray) -> np.ndarray:
        sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(q.shape[1])]
        out = np.zeros_like(q)
        for r in (bench.select("text").mapInArrow(_gram_times(vocab, idf, q), "term long, v array<double>")
                  .groupBy("term").agg(F.array(*[s for s in sums]).alias("v")).collect()):
            out[r["term"]] = r["v"]
        return out

    for _ in range(rounds):
        basis, _ = np.linalg.qr(times(basis))
    values, turn = np.linalg.eigh(basis.T @ times(basis))
    return basis @ turn[:, np.argsort(-values)]


@dataclass(frozen=True)
class Index:
    """What a search task needs; its size follows the benchmark's, not the corpus'."""

    vocab: dict[str, int]
    table: np.ndarray  # (words + 1) x rank: latent rows times idf, zero row for other words
    items: list[Item]
    vectors: np.ndarray  # items x rank, of length one


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def build_index(docs: DataFrame, bench: DataFrame, rank: int = 64) -> Index:
    """Index of ``bench(item_id, text, answer)`` with statistics of ``docs(text)``."""
    rows = bench.collect()  # the stated query set
    items = [Item(r["item_id"], words_of(r["text"]), answer_of(r["text"], r["answer"])) for r in rows]
    items = sorted((i for i in items if i.words), key=lambda i: (i.item_id is None, i.item_id, i.words))
    vocab = {w: n for n, w in enumerate(sorted({w for i in items for w in i.words}))}
    if not vocab:
        return Index({}, np.zeros((1, 1), np.float32), [], np.zeros((0, 1), np.float32))
    counts = np.zeros(len(vocab) + 1)
    for r in (docs.select("text").mapInArrow(_document_counts(vocab), "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect()):
        counts[r["term"]] = r["n"]
    idf = np.log((counts[-1] + 2) / (counts[:-1] + 1))
    table = np.zeros((len(vocab) + 1, min(rank, len(vocab))), np.float32)
    table[:-1] = latent_basis(bench, vocab, idf, rank) * idf[:, None]
    vectors = np.array([table[[vocab[w] for w in i.words]].sum(axis=0) for i in items], np.float32)
    return Index(vocab, table, items, _unit(vectors))


def candidates(index: Index, texts: list[list[str]], min_cosine: float, block: int, span: int):
    """(text, item, first word, end, cosine) of windows of ``span`` blocks of
    ``block`` words near an item; a text's last windows are shorter."""
    sizes = np.array([len(t) for t in texts])
    n_blocks = -(-sizes // block)
    if not len(index.items) or not n_blocks.sum():
        return
    other = len(index.vocab)
    total = np.zeros((int(n_blocks.sum()) + 1, index.table.shape[1]))
    at = 0
    for words, n in zip(texts, n_blocks.tolist()):
        if n:
            ids = np.fromiter(map(index.vocab.get, words, repeat(other)), np.int64, len(words))
            for part in range(0, n, 4096):
                piece = ids[part * block:(part + 4096) * block]
                sums = np.add.reduceat(index.table[piece], np.arange(0, len(piece), block), axis=0)
                total[at + 1 + part:at + 1 + part + len(sums)] = sums
        at += n
    np.cumsum(total, axis=0, out=total)
    text_of = np.repeat(np.arange(len(texts)), n_blocks)
    last = np.cumsum(n_blocks)
    first = np.arange(len(text_of))
    stop = np.minimum(first + span, last[text_of])
    # A window that only repeats the end of the one before it adds nothing.
    own = (first + span <= last[text_of]) | (first == (last - n_blocks)[text_of])
    first, stop, text_of = first[own], stop[own], text_of[own]
    for lo in range(0, len(first), 8192):
        f, s = first[lo:lo + 8192], stop[lo:lo + 8192]
        near = _unit((total[s] - total[f]).astype(np.float32)) @ index.vectors.T
        for w, i in np.argwhere(near >= min_cosine).tolist():
            t = int(text_of[lo + w])
            begin = int(f[w]) - int(last[t] - n_blocks[t])
            yield t, i, begin * block, min((int(s[w]) - int(f[w]) + begin) * block, int(sizes[t])), float(near[w, i])


_MATCH = "matches array<struct<item_id:long,cosine:double,lcs:double,answer:double>>"


def search(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
           item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None, rank: int = 64,
           min_cosine: float = 0.6, block: int = 12, span: int = 3, near_verbatim: float = 0.7,
           paraphrase: float = 0.5, answer_share: float = 0.8) -> DataFrame:
    """Find the benchmark's items in documents, word for word or paraphrased.

    Returns one row per document row: ``matches`` with one entry per item
    found, and ``row``, a struct of the ``carry`` columns.  An entry has
    ``item_id, cosine`` (of the closest window), ``lcs`` (share of the item's
    words in the longest common subsequence with the best stretch, of one and
    a half item lengths, around the candidate windows) and ``answer`` (the same
    of the answer's words, within twice the answer's length in or next to that
    stretch).  An item counts
    if ``lcs >= near_verbatim``, or if ``lcs >= paraphrase`` and ``answer >=
    answer_share``; items of under eight words must be found whole.

    The benchmark is the stated query set: it, its vocabulary and its vectors
    are sent to every task.  Every window of every document is scored; there
    is no limit on candidates.  Empty or null texts hold nothing; items
    without words are never found; repeated rows repeat, repeated items don't.
    """
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    bench = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text).cast("string").alias("text"), answer.alias("answer")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(
        build_index(docs.select(F.col(text_col).cast("string").alias("text")), bench, rank))

    def judged(index: Index, words: list[list[str]]) -> list[list[dict]]:
        spans: dict[tuple[int, int], list] = {}
        for t, i, lo, hi, cosine in candidates(index, words, min_cosine, block, span):
            n = len(index.items[i].words)
            lo, hi = max(0, lo - n), min(len(words[t]), hi + n)
            have = spans.setdefault((t, i), [])
            if have and lo <= have[-1][1]:
                have[-1][1], have[-1][2] = max(hi, have[-1][1]), max(cosine, have[-1][2])
            else:
                have.append([lo, hi, cosine])
        found: list[list[dict]] = [[] for _ in words]
        for (t, i), parts in spans.items():
            item, best = index.items[i], None
            for lo, hi, cosine in parts:
                held = closest(item, words[t], lo, hi, near_verbatim, paraphrase, answer_share)
                if held:
                    best = max(best or (0.0, 0.0, 0.0), (*held, cosine))
            if best:
                found[t].append({"item_id": item.item_id, "cosine": best[2], "lcs": best[0], "answer": best[1]})
        return found

    def make():
        index = shared.value
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()),
                                   ("answer", pa.float64())]))
        return lambda texts: [pa.array(judged(index, [words_of(t) for t in texts]), kind)]

    return map_texts(docs, text_col, list(carry), _MATCH, make, limit=2 << 20)
