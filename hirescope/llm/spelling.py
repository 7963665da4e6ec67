"""Spelling variant grouping by blocked Gram matrices.

Every word is a vector of letter counts.  One inserted or deleted letter moves
it by a squared distance of 1, one replaced letter by at most 2, so words that
are one edit apart are at most 2 apart.  ``|a|^2 + |b|^2 - 2 a.b`` comes from
NumPy products of whole blocks, pairs beyond 2 go, and the rest is verified
letter by letter.

A block holds words of two adjacent lengths, ``short`` and ``short + 1``, that
share a half: of the words on both sides of one edit, either the first
``short // 2`` code points agree or the last do.  So each word stands in at
most four blocks and no near pair is lost, while a block stays a small part
of a length.  Blocks above ``block_size`` words are dealt into sub-blocks and
every two sub-blocks meet in a cell of their own.  A cell gives one row per
word (how many near words, and the best of them), never its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialise, release, ship_package, text_batches

RUNS = re.compile("[a-zÀ-ÿ]+")
#: a-z and U+00C0..U+00FF; any other code point shares one of these places, which only lowers distances.
_LETTERS = 26 + 64
_FLUSH = 200_000
_ENTRIES = 1 << 22


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                min_count: int = 2, damage: int | None = None) -> DataFrame:
    """``word, n``: the runs of Latin letters of all texts, A-Z lower-cased, of
    at least ``min_length`` code points and ``min_count`` occurrences.

    With ``damage`` the letter ``h % length`` of a run is left out where
    ``h = crc32("<id>:<run>")`` is a multiple of it: misspellings that are
    known.  A null id counts as an empty one; null and empty texts hold no
    run; repeated rows count repeatedly.
    """
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))

    def send(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for ids, texts in text_batches(batches, (0, 1), 1):
            for i, text in zip(ids, texts):
                start = crc32(f"{'' if i is None else i}:".encode())
                for word in RUNS.findall((text or "").encode().lower().decode()):
                    size = len(word)
                    if size < min_length:
                        continue
                    if damage:
                        h = crc32(word.encode(), start)
                        if h % damage == 0:
                            if size == min_length:
                                continue
                            word = word[:h % size] + word[h % size + 1:]
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) > _FLUSH:
                    yield send(counts)
                    counts = {}
        yield send(counts)

    return (source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _blocks(words: DataFrame) -> DataFrame:
    """``block, side, short, word, n``: up to four blocks a word."""
    size = F.char_length("word")

    def block(short: Column, side: str) -> Column:
        half = F.floor(short / 2).cast("int")
        part = F.left(F.col("word"), half) if side == "p" else F.right(F.col("word"), half)
        return F.struct(F.xxhash64(short, F.lit(side), part).alias("block"), F.lit(side).alias("side"),
                        short.alias("short"))

    rows = F.array(*[block(short, side) for short in (size, size - 1) for side in "ps"])
    return (words.where(size > 0).select("word", "n", F.explode(rows).alias("b"))
            .select("b.*", "word", "n"))


def _codes(words: list[str], size: int) -> np.ndarray:
    """One row of code points per word of ``size`` code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), size)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    place = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % 64).astype(np.int64)
    rows = np.arange(len(codes), dtype=np.int64)[:, None] * _LETTERS
    counts = np.bincount((rows + place).ravel(), minlength=len(codes) * _LETTERS).reshape(len(codes), _LETTERS)
    return counts.astype(np.float32 if codes.shape[1] < 2000 else np.float64)  # exact in either


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` are one edit from the same rows of ``b``; ``b`` is as
    wide as ``a`` or one code point wider."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    lead = np.cumprod(a == b[:, :-1], 1).sum(1)
    trail = np.cumprod((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return lead + trail >= a.shape[1]


def near_pairs(a: list[str], b: list[str], side: str, short: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart, of ``a`` (length ``short``) and
    ``b`` (``short`` or one more), that this side of the block answers for:
    equal first halves on side "p"; equal last and unequal first ones on "s".
    ``same``: both are one list, and a pair is given once."""
    none = np.empty(0, np.int64)
    if not a or not b:
        return none, none
    ca, cb = _codes(a, short), _codes(b, len(b[0]))
    va, vb = _letter_counts(ca), _letter_counts(cb)
    na, nb = (va * va).sum(1), (vb * vb).sum(1)
    half = short // 2
    out: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, _ENTRIES // len(b))
    for at in range(0, len(a), step):
        gram = va[at:at + step] @ vb.T
        i, j = np.nonzero(na[at:at + step, None] + nb[None, :] - 2 * gram <= 2)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        few = max(1, _ENTRIES // (short + 1))
        for lo in range(0, len(i), few):
            p, q = i[lo:lo + few], j[lo:lo + few]
            x, y = ca[p], cb[q]
            ok = _one_edit(x, y)
            first = (x[:, :half] == y[:, :half]).all(1)
            if side == "p":
                ok &= first
            else:
                ok &= ~first & (x[:, short - half:] == y[:, y.shape[1] - half:]).all(1)
            out.append((p[ok], q[ok]))
    if not out:
        return none, none
    return np.concatenate([p for p, _ in out]), np.concatenate([q for _, q in out])


def _cell(side: str, short: int, i: int, j: int, words: list[str], ns: list[int], subs: list[int],
          factor: int) -> Iterator[tuple[str, int, int | None, str | None]]:
    """Per word of a cell that has near words in it: their number, and the one
    of largest count (then least) where that is ``factor`` times the word's own."""
    lists = [[k for k, w in enumerate(words) if subs[k] == s and len(w) == size]
             for s in (i, j) for size in (short, short + 1)]
    a, a1, b, b1 = lists
    found = [(a, a, True), (a, a1, False)] if i == j else [(a, b, False), (a, b1, False), (b, a1, False)]
    us, vs = [], []
    for left, right, same in found:
        p, q = near_pairs([words[k] for k in left], [words[k] for k in right], side, short, same)
        us.append(np.array(left, np.int64)[p])
        vs.append(np.array(right, np.int64)[q])
    u, v = np.concatenate(us), np.concatenate(vs)
    if not len(u):
        return
    own, near = np.concatenate([u, v]), np.concatenate([v, u])
    n = np.array(ns, np.int64)
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    by = np.lexsort((order[near], -n[near], own))
    own, near = own[by], near[by]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    for k, best, count in zip(own[first].tolist(), near[first].tolist(), np.diff(np.r_[first, len(own)]).tolist()):
        far = ns[best] >= factor * ns[k]
        yield words[k], count, ns[best] if far else None, words[best] if far else None


def near_words(words: DataFrame, factor: int = 10, block_size: int = 2000) -> DataFrame:
    """``word, n_near, form_n, form`` of the words (``word, n``, each once) that
    are one edit from another: how many such there are, and the most frequent
    of them (ties: the least) where it has ``factor`` times the word's count."""
    rows = _blocks(words)
    sizes = rows.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    subs = F.ceil(F.col("size") / block_size).cast("int")
    sub = F.pmod(F.xxhash64("word"), F.col("subs")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("other")
    cells = (rows.join(sizes, "block").select("block", "side", "short", "word", "n", subs.alias("subs"))
             .select("*", sub.alias("sub")).select("*", other)
             .select("block", F.least("sub", "other").alias("i"), F.greatest("sub", "other").alias("j"),
                     "side", "short", "word", "n", "sub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, have = None, ([], [], [])
        out: list[tuple] = []

        def send() -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              names=["word", "n_near", "form_n", "form"])
            out.clear()
            return made

        def close() -> None:
            if len(have[0]) > 1:
                block, i, j, side, short = key
                out.extend(_cell(side, short, i, j, *have, factor))

        for batch in batches:
            *keys, words_, ns, subs_ = (c.to_pylist() for c in batch.columns)
            for k, w, n, s in zip(zip(*keys), words_, ns, subs_):
                if k != key:
                    close()
                    key, have = k, ([], [], [])
                    if len(out) >= 5000:
                        yield send()
                have[0].append(w)
                have[1].append(n)
                have[2].append(s)
        close()
        yield send()

    found = (cells.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "side", "short")
             .mapInArrow(run, "word string, n_near long, form_n long, form string"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the links ``word -> form`` end.  A form has a
    larger count than its word, so there are no cycles; every round doubles
    the steps taken, and few rounds do."""
    at = materialise(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        later = materialise(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")))
        release(at)
        at = later
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def variants(words: DataFrame, factor: int = 10, block_size: int = 2000) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``,
    each word once).  Words without near words have ``n_near`` 0; without a
    form, ``form`` and ``form_n`` are null and ``root`` is the word itself.
    Letters are compared as they are, whatever their script; an empty word is
    near none; an empty table gives an empty result."""
    ship_package(words.sparkSession)
    near = materialise(near_words(words, factor, block_size))
    return (words.join(near, "word", "left").join(roots(near), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
