"""Target-distribution importance resampling.

A document's features are its word n-grams, counted in hashed buckets.  For
every bucket the log ratio of its smoothed share of the target texts to its
share of the corpus is one entry of an array; a document's weight is the mean
of the entries of its features.  Gumbel noise from a hash of the id is added,
so the highest scores are a draw without replacement in proportion to the
exponentials of the weights, the same on every run.  Ranks come from a
distributed LSD radix sort (``radix``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, materialise, ship_package, text_batches
from hirescope.llm.radix import Key, ranks

# UTF-8 bytes of words stay (A-Z lower-cased), all other ASCII bytes part words.
_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
#: Words whose bucket a task remembers.
_REMEMBER = 1 << 18


@dataclass(frozen=True)
class Model:
    """``gains[b]``: 1000 times the log ratio of bucket ``b``, floored."""

    gains: np.ndarray
    ngrams: int


def _reader(buckets: int, ngrams: int) -> Callable[[str | None], tuple[int, np.ndarray]]:
    """Function from a text to its number of words and its features' buckets."""
    known: dict[bytes, int] = {}

    def read(text: str | None) -> tuple[int, np.ndarray]:
        words = (text or "").encode().translate(_WORD_BYTES).split(b" ")
        words = [w for w in words if w]
        grams = list(words)
        for size in range(2, ngrams + 1):
            grams += [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
        if len(known) > _REMEMBER:
            known.clear()
        for gram in grams:
            if gram not in known:
                known[gram] = crc32(gram) % buckets
        return len(words), np.fromiter(map(known.__getitem__, grams), np.int64, len(grams))

    return read


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, ngrams: int) -> np.ndarray:
    """How often each bucket occurs in all texts; one row per task and bucket is shuffled."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, counts = _reader(buckets, ngrams), np.zeros(buckets, np.int64)
        for (rows,) in text_batches(batches, (0,), 0):
            counts += np.bincount(np.concatenate([read(text)[1] for text in rows]), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    rows = (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def learn(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text",
          buckets: int = 10000, ngrams: int = 1) -> Model:
    """Gains of the target texts over all of ``docs``.  Either table may be
    empty; null texts hold no features; repeated rows count repeatedly."""
    s, t = bucket_counts(docs, text_col, buckets, ngrams), bucket_counts(target, target_col, buckets, ngrams)
    over, under = float(s.sum()) + buckets, float(t.sum()) + buckets
    gains = [math.floor(1000 * math.log((b + 1.0) * over / ((a + 1.0) * under))) for a, b in zip(s.tolist(), t.tolist())]
    return Model(np.array(gains, np.int64), ngrams)


def noise(key: str, seed: int) -> int:
    """1000 times a standard Gumbel value fixed by ``seed`` and ``key``, floored."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", seed: int = 2024,
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_words, n_features, weight, score`` (longs) and a struct ``row`` of the
    ``carry`` columns, one row per row of ``docs``.  The weight is the floored
    mean gain (0 without features); a null id hashes as an empty one."""
    ship_package(docs.sparkSession)
    gains, ngrams = model.gains, model.ngrams

    def make() -> Callable[..., list[pa.Array]]:
        read = _reader(len(gains), ngrams)

        def work(texts: list[str | None], ids: list[str | None]) -> list[pa.Array]:
            out = []
            for text, key in zip(texts, ids):
                n_words, at = read(text)
                weight = int(gains[at].sum()) // len(at) if len(at) else 0
                out.append((n_words, len(at), weight, weight + noise(key or "", seed)))
            return [pa.array(c, pa.int64()) for c in zip(*out)]

        return work

    keyed = docs.withColumn("_resample_key", F.col(id_col).cast("string"))
    return map_texts(keyed, text_col, list(carry), "n_words long, n_features long, weight long, score long", make,
                     extra=("_resample_key",))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text", buckets: int = 10000, ngrams: int = 1,
             seed: int = 2024) -> DataFrame:
    """Draw ``percent`` per cent of the documents with at least ``min_words``
    words to follow the target's distribution.

    Returns ``doc_id, n_features, weight, score, rank`` for every row: ``rank``
    1, 2, 3, ... by falling score, then smaller id (rows without id last), then
    fewer features; null for documents not drawn.  Repeated rows take ranks of
    their own.
    """
    model = learn(docs, target, text_col, target_col, buckets, ngrams)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = materialise(score(plain, model, seed=seed)
                         .select("row.doc_id", "n_words", "n_features", "weight", "score"))
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = ranks(able, [Key("score", descending=True), Key("doc_id"), Key("n_features")])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return (ranked.withColumn("rank", rank).unionByName(rest)
            .select("doc_id", "n_features", "weight", "score", "rank"))
