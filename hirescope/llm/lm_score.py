"""Cross-entropy difference scoring with matched n-gram models.

A target and a background model share one vocabulary: every word of the
corpus.  Both are interpolated bigram models whose counts cover every document
and are keyed by 62 bits of a hash.  The keys fall into ranges, whose number
follows the corpus; a chunk of texts sends one packed row of counts to each
range, not a row per key, and the merged counts are a Spark table of a row per
range.  Documents are scored in chunks: a chunk asks each range for the counts
of its different words and pairs and gets them back in its own order, so
neither the driver nor a task holds the models.  A document's score is the
mean, over its tokens, of the background loss less the target loss: above zero
it resembles the target.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from hirescope.llm.common import free_shuffles, materialise, text_batches

_TOKEN = re.compile(r"\w+|[^\w\s]")
_WORD, _CONTEXT, _PAIR = range(3)
#: Characters of a chunk; the corpus has a range of keys for each as many.
_CHUNK = 8 << 20
#: Chunks ask in so many turns, so that only a part of the requests is on disk at once.
_TURNS = 3


@dataclass(frozen=True)
class Shape:
    """``weight`` is the bigram's share in the mixture.  A caller may bound the
    models: to the most frequent words (``vocabulary``, all others are one
    unknown word), and to pair counts hashed into ``cells``."""

    vocabulary: int | None = None
    cells: int | None = None
    weight: float = 0.6


@dataclass(frozen=True)
class Coded:
    """Some texts as numbers of their different words; number 0 stands before a text's first token."""

    sizes: np.ndarray  # tokens per text
    ids: np.ndarray  # each token's number
    hashes: np.ndarray  # per number


@dataclass(frozen=True)
class Pairs:
    """The different pairs of some texts, and the keys that they need."""

    before: np.ndarray  # per token, the number before it
    pair: np.ndarray  # per token, its pair
    first: np.ndarray  # numbers, per pair
    second: np.ndarray
    keys: np.ndarray  # different keys, ascending
    word_at: np.ndarray  # places in keys, per number
    context_at: np.ndarray
    pair_at: np.ndarray  # and per pair


def _key(h: np.ndarray, kind: int) -> np.ndarray:
    return (h << np.uint64(2)) | np.uint64(kind)


def _coded(texts: list[str | None], vocab: frozenset[str] | None) -> Coded:
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    number[" "] = 0  # no token is a blank
    parts = []
    for text in texts:
        found = _TOKEN.findall((text or "").lower())
        if vocab is not None:
            found = [w if w in vocab else "" for w in found]
        parts.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    digests = b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in number)
    return Coded(np.array([len(p) for p in parts], np.int64), np.concatenate([*parts, np.zeros(0, np.int64)]),
                 np.frombuffer(digests, "<u8").astype(np.uint64))


def _pairs(coded: Coded, shape: Shape) -> Pairs:
    sizes, ids, h = coded.sizes, coded.ids, coded.hashes
    before = np.concatenate([np.zeros(1, np.int64), ids])[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    codes, pair = np.unique(before * len(h) + ids, return_inverse=True)
    first, second = codes // len(h), codes % len(h)
    both = (h[first] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[second] * np.uint64(0xC2B2AE3D27D4EB4F))
    both = (both ^ (both >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    both = both ^ (both >> np.uint64(32))
    if shape.cells:  # an odd factor keeps cells apart and spreads them over the ranges
        both = both % np.uint64(shape.cells) * np.uint64(0x9E3779B97F4A7C15)
    keys, at = np.unique(np.concatenate([_key(h, _WORD), _key(h, _CONTEXT), _key(both, _PAIR)]), return_inverse=True)
    return Pairs(before, pair, first, second, keys, *np.split(at, [len(h), 2 * len(h)]))


def _packed(*columns: np.ndarray) -> bytes:
    """Whole numbers from 0, byte planes apart (the high ones are mostly zero), compressed."""
    head, planes = [], []
    for c in columns:
        width = (int(c.max(initial=0)).bit_length() + 7) // 8
        head += [len(c), width]
        planes.append(np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    raw = np.array([len(columns), *head], "<u4").tobytes() + b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    count = int.from_bytes(raw[:4], "little")
    head, at, out = np.frombuffer(raw, "<u4", 2 * count, 4).tolist(), 4 + 8 * count, []
    for n, width in zip(head[::2], head[1::2]):
        column = np.zeros((n, 8), np.uint8)
        column[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(column.view("<u8").reshape(-1))
        at += n * width
    return out


def _decoded(code: bytes) -> list[np.ndarray]:
    sizes, ids, hashes = _unpacked(code)
    return [sizes.astype(np.int64), ids.astype(np.int64), hashes]


def _lowest(ranges: int) -> np.ndarray:
    return np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)


def _gaps(keys: np.ndarray, low: np.uint64) -> np.ndarray:
    """Ascending keys from ``low`` as differences; ``_from_gaps`` turns them back."""
    return np.diff(keys, prepend=low)


def _from_gaps(gaps: np.ndarray, low: np.uint64) -> np.ndarray:
    return np.cumsum(gaps, dtype=np.uint64) + low


def _by_range(low: np.ndarray, keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(range, packed keys and columns) of the ranges that hold some of the keys."""
    cut = [*np.searchsorted(keys, low).tolist(), len(keys)]
    for r, (a, b) in enumerate(zip(cut, cut[1:])):
        if a < b:
            yield r, _packed(_gaps(keys[a:b], low[r]), *(c[a:b] for c in columns))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (texts,) in text_batches(batches, (0,), 0):
        counts: defaultdict[str, int] = defaultdict(int)
        for text in texts:
            for w in _TOKEN.findall((text or "").lower()):
                counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _counts(vocab: frozenset[str] | None, shape: Shape, ranges: int, size: int):
    """Rows (range, counts), added up per chunk; counts are packed keys, target and background."""
    low = _lowest(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, target in text_batches(batches, (0, 1), 0, size):
            coded = _coded(texts, vocab)
            p, n = _pairs(coded, shape), len(coded.hashes)
            own = np.repeat(np.array(target, bool), coded.sizes)
            at = np.concatenate([p.word_at, p.context_at, p.pair_at])

            def added(some) -> np.ndarray:
                each = np.concatenate([np.bincount(coded.ids[some], minlength=n), np.bincount(p.before[some], minlength=n),
                                       np.bincount(p.pair[some], minlength=len(p.first))])
                return np.bincount(at, each, minlength=len(p.keys)).astype(np.uint64)
            t, b = added(own), added(slice(None))
            seen = b > 0
            rows = list(_by_range(low, p.keys[seen], t[seen], b[seen]))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()),
                                              pa.array([x for _, x in rows], pa.binary())], names=["range", "counts"])
    return run


def _merged(ranges: int):
    """Adds up the counts of a range; ``words``, ``t`` and ``b``: its words and their tokens."""
    low = _lowest(ranges)

    def run(table: pa.Table) -> pa.Table:
        r = table.column("range")[0].as_py()
        parts = [_unpacked(x) for x in table.column("counts").to_pylist()]
        keys, at = np.unique(np.concatenate([_from_gaps(x[0], low[r]) for x in parts]), return_inverse=True)
        t, b = (np.bincount(at, np.concatenate([x[i] for x in parts]), minlength=len(keys)).astype(np.uint64) for i in (1, 2))
        word = keys & np.uint64(3) == _WORD
        return pa.table({"range": [r], "counts": pa.array([_packed(_gaps(keys, low[r]), t, b)], pa.binary()),
                         "words": [int(word.sum())], "t": [int(t[word].sum())], "b": [int(b[word].sum())]})
    return run


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written; what Python still held of its plan while it ran is let go as well."""
    out = materialise(df)
    free_shuffles(out.sparkSession)
    return out


@dataclass(frozen=True)
class Models:
    vocab: frozenset[str] | None  # None: every word
    shape: Shape
    counts: DataFrame  # per range of keys: range, counts (packed), words, t, b
    tokens: tuple[int, int]  # of target and background
    size: int  # words, and one for all that were never seen
    ranges: int


def learn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shape: Shape = Shape()) -> Models:
    """Models from all documents; ``target(id)`` names those of the target.

    Counts are taken over every document, word and pair, and written as a
    table; the driver gets four totals (and the words, where the caller bounds
    the vocabulary).  Without target documents the target model is uniform
    over its words.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    vocab = None
    if shape.vocabulary is not None:
        top = (texts.select("text").mapInArrow(_word_counts, "word string, n long").groupBy("word")
               .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(shape.vocabulary).collect())
        vocab = frozenset(r["word"] for r in top)
    ranges = (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // _CHUNK + 1
    chosen = target.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct().withColumn(
        "flag", F.lit(1))
    # Always a merge join: the list of target ids grows with the corpus.
    marked = texts.join(chosen.hint("merge"), "id", "left").select("text", F.coalesce("flag", F.lit(0)).alias("flag"))
    counts = _stored(marked.mapInArrow(_counts(vocab, shape, ranges, _CHUNK), "range long, counts binary")
                     .groupBy("range").applyInArrow(_merged(ranges), "range long, counts binary, words long, t long, b long"))
    n = counts.agg(F.sum("t").alias("t"), F.sum("b").alias("b"), F.sum("words").alias("words")).first()
    words = (n["words"] or 0) if vocab is None else len(vocab)
    return Models(vocab, shape, counts, (n["t"] or 0, n["b"] or 0), words + 1, ranges)


def _looked_up(keys: np.ndarray, table: tuple[np.ndarray, ...]) -> np.ndarray:
    """2 x keys: counts in target and background, zero where there is none."""
    known, *counts = table
    if not len(known):
        return np.zeros((2, len(keys)), np.uint64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, np.stack(counts)[:, at], np.uint64(0))


def _chunks(vocab: frozenset[str] | None, size: int):
    """Rows (chunk, chars, code, rows): about ``size`` characters of texts, and what is carried with each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, rows, chars, chunk = [], [], 0, TaskContext.get().partitionId() << 32

        def chunked() -> pa.RecordBatch:
            coded, carried = _coded(texts, vocab), pa.concat_arrays(rows)
            code = _packed(coded.sizes, coded.ids, coded.hashes)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([chars]), pa.array([code], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(carried)], pa.int32()), carried)],
                names=["chunk", "chars", "code", "rows"])
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                new = part.column(0).to_pylist()
                texts, rows, chars = texts + new, [*rows, part.column(1)], chars + sum(len(x) for x in new if x)
                if chars >= size:
                    yield chunked()
                    texts, rows, chars, chunk = [], [], 0, chunk + 1
        if texts:
            yield chunked()
    return run


def score(docs: DataFrame, models: Models, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_tokens, target_loss, background_loss, score, row`` per row; whole
    texts are read.  ``score`` is the background loss less the target loss per
    token; texts without a token get zeros.  Repeated rows repeat.

    Each task cuts its rows into chunks of about eight million characters and
    writes them as numbers; from there on no text is read or moved.
    """
    shape, tokens, size, low = models.shape, models.tokens, models.size, _lowest(models.ranges)
    source = docs.select(F.col(text_col).cast("string").alias("text"),
                         F.struct(*[F.col(c) for c in carry]).alias("row"))
    row = source.schema["row"].dataType
    coded = _stored(source.mapInArrow(
        _chunks(models.vocab, _CHUNK), StructType.fromDDL("chunk long, chars long, code binary").add("rows", ArrayType(row))))
    chars = coded.agg(F.sum("chars")).first()[0] or 0
    # Where far more is scored than was learned, a range's requests are dealt to several copies of it.
    copies = chars // (models.ranges * _CHUNK) + 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, code = (batch.column(c)[i].as_py() for c in (0, 1))
                rows = list(_by_range(low, _pairs(Coded(*_decoded(code)), shape).keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()),
                     pa.array([x for _, x in rows], pa.binary())], names=["range", "chunk", "asked"])

    def tell(asked: pa.Table, counts: pa.Table) -> pa.Table:
        out, known = [], ()
        for r, chunk, keys in zip(*(asked.column(c).to_pylist() for c in ("range", "chunk", "asked"))):
            if not known:  # one range a group
                gaps, *n = _unpacked(counts.column("counts")[0].as_py()) if counts.num_rows else [np.zeros(0, np.uint64)] * 3
                known = (_from_gaps(gaps, low[r]), *n)
            out.append((chunk, r, _packed(*_looked_up(_from_gaps(_unpacked(keys)[0], low[r]), known))))
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "range": pa.array(columns[1], pa.int64()),
                         "told": pa.array(columns[2], pa.binary())})

    def judge(table: pa.Table, told: pa.Table) -> pa.Table:
        coded = Coded(*_decoded(table.column("code")[0].as_py()))
        p = _pairs(coded, shape)
        parts = [_unpacked(x) for x in told.sort_by("range").column("told").to_pylist()]
        counts = [np.concatenate([*(x[m] for x in parts), np.zeros(0, np.uint64)]).astype(float) for m in (0, 1)]
        text_of, n = np.repeat(np.arange(len(coded.sizes)), coded.sizes), len(coded.sizes)
        losses = []
        for m in (0, 1):
            words, contexts, pairs = counts[m][p.word_at[p.second]], counts[m][p.context_at[p.first]], counts[m][p.pair_at]
            # A cell may hold several pairs: no pair is more frequent than its context.
            pair = np.minimum(pairs, contexts) / np.maximum(contexts, 1)
            share = np.where(contexts > 0, shape.weight, 0.0)
            loss = -np.log(share * pair + (1 - share) * (words + 1) / (tokens[m] + size))
            losses.append(np.bincount(text_of, loss[p.pair], minlength=n) / np.maximum(coded.sizes, 1))
        return pa.table({"n_tokens": coded.sizes, "target_loss": losses[0], "background_loss": losses[1],
                         "score": losses[1] - losses[0], "row": table.column("rows").combine_chunks().flatten()})

    schema = StructType.fromDDL("n_tokens long, target_loss double, background_loss double, score double").add("row", row)
    counts = models.counts.select("range", "counts", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    answers = []
    for turn in range(_TURNS):
        mine = coded.where(F.pmod(F.xxhash64("chunk"), F.lit(_TURNS)) == turn).select("chunk", "code")
        asked = mine.mapInArrow(ask, "range long, chunk long, asked binary").withColumn(
            "copy", F.pmod(F.hash("chunk"), F.lit(copies)).cast("int"))
        answers.append(_stored(asked.groupBy("range", "copy").cogroup(counts.groupBy("range", "copy"))
                                 .applyInArrow(tell, "chunk long, range long, told binary")))
    told = reduce(DataFrame.unionByName, answers)
    return coded.select("chunk", "code", "rows").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(judge, schema)
