"""Language identification with string kernels.

The kernel of two texts is the cosine of their n-gram presence vectors over a
blended spectrum (all n-grams of one to ``n_max`` characters, present or not,
how often does not matter).  N-grams are hashed to a fixed number of features.
Landmark texts give the Nystroem features of a text - its kernel values with
the landmarks, whitened - on which one-versus-rest kernel ridge regression is
solved.  Texts are scored in batches by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts

#: What is given for texts without a letter.
UNDETERMINED = "und"
FEATURES = 1 << 14
N_MAX = 3
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def presence(text: str, n_max: int = N_MAX, features: int = FEATURES, piece: int = 1 << 16) -> np.ndarray:
    """Sorted features of the text's n-grams; digits and white space are one
    character each, letters count in lower case."""
    seen = np.zeros(features, bool)
    shift = np.uint32(32 - (features.bit_length() - 1))
    lower = text.lower()
    for at in range(0, len(lower), piece):
        cp = np.frombuffer(lower[at:at + piece + n_max - 1].encode("utf-32-le", "replace"), np.uint32).copy()
        cp[(cp >= 48) & (cp <= 57)] = 48
        cp[(cp >= 9) & (cp <= 13)] = 32
        run = cp * _MULTIPLIERS[0] + np.uint32(1)
        seen[(run * _MULTIPLIERS[4]) >> shift] = True
        for n in range(1, n_max):
            run = (run[:-1] ^ (run[:-1] >> np.uint32(15))) * _MULTIPLIERS[n % 4] + cp[n:]
            seen[(run * _MULTIPLIERS[4]) >> shift] = True
    return np.flatnonzero(seen)


def _matrix(texts: list[str]) -> np.ndarray:
    """Presence vectors of length one, dense."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, t in enumerate(texts):
        at = presence(t)
        if len(at):
            out[i, at] = 1 / np.sqrt(len(at))
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # landmarks x FEATURES
    weights: np.ndarray  # landmarks x languages: whitening and ridge weights in one
    bias: np.ndarray

    def decide(self, texts: list[str], batch: int = 256) -> tuple[list[int], list[float]]:
        best, sure = [], []
        for at in range(0, len(texts), batch):
            kernel = _matrix(texts[at:at + batch]) @ self.landmarks.T
            values = kernel @ self.weights + self.bias
            odds = np.exp(8 * (values - values.max(axis=1, keepdims=True)))
            odds /= odds.sum(axis=1, keepdims=True)
            best += values.argmax(axis=1).tolist()
            sure += odds.max(axis=1).tolist()
        return best, sure


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = 1500, landmarks: int = 64, max_languages: int = 256, ridge: float = 1e-2) -> Model | None:
    """Model from labelled documents.

    Every language that occurs is learned; more than ``max_languages`` are an
    error, since the driver solves for all of them at once.  Bounds: for each
    language the ``per_language`` labelled texts with a letter of least
    ``xxhash64(id, text)`` are used, and the first ``landmarks`` of these as
    landmarks; their kernel values come to the driver.  Null labels are
    ignored; without any label there is no model.
    """
    given = (docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                         F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
             .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")))
    counts = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than max_languages={max_languages} languages are labelled")
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return None
    # The share of each language whose hash lies below a bound holds a little
    # more than the texts wanted: no language is sorted or gathered whole.
    bound = {r["lang"]: min(1.0, 1.3 * (per_language + 50) / r["count"]) for r in counts}
    share = F.coalesce(*[F.when(F.col("lang") == n, F.lit(s)) for n, s in bound.items()])
    spread = (F.pmod("h", F.lit(1 << 30)) / float(1 << 30))
    picked = given.where(F.col("lang").isin(languages)).where(spread < share)
    chosen = (picked.groupBy("lang", F.pmod("h", F.lit(1 << 30)).alias("o")).agg(F.min("text").alias("text"))
              .collect())
    by: dict[str, list] = {n: [] for n in languages}
    for r in sorted(chosen, key=lambda r: (r["o"], r["lang"])):
        if len(by[r["lang"]]) < per_language:
            by[r["lang"]].append(r["text"])
    return fit(by, landmarks, ridge)


def fit(by: dict[str, list[str]], landmarks: int, ridge: float) -> Model:
    """Nystroem landmarks and ridge weights from texts by language."""
    languages = sorted(by)
    marks = _matrix([t for n in languages for t in by[n][:landmarks]])
    among = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    rows, labels = [], []
    for number, n in enumerate(languages):
        for at in range(0, len(by[n]), 256):
            part = by[n][at:at + 256]
            rows.append((_matrix(part) @ marks.T).astype(np.float64) @ whiten)
            labels += [number] * len(part)
    x, y = np.concatenate(rows), np.array(labels)
    # Every language weighs the same, however many texts it has.
    weight = 1 / np.bincount(y, minlength=len(languages))[y]
    target = np.where(np.arange(len(languages))[None, :] == y[:, None], 1.0, -1.0)
    mean = (x * weight[:, None]).sum(axis=0) / weight.sum()
    centre = (target * weight[:, None]).sum(axis=0) / weight.sum()
    xc, tc = x - mean, target - centre
    scale = len(x) / weight.sum()
    gram = (xc * weight[:, None]).T @ xc * scale + ridge * np.eye(x.shape[1]) * np.sqrt(len(x))
    w = np.linalg.solve(gram, (xc * weight[:, None]).T @ tc * scale)
    return Model(languages, marks, (whiten @ w).astype(np.float32), (centre - mean @ w).astype(np.float32))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text",
            carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``lang, score, row`` per row: the language (``und`` for null texts and
    texts without a letter, score 0, and for every text if there is no model),
    a score from 0 to 1 and a struct of the ``carry`` columns.  Whole texts
    are read; repeated rows repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x landmarks vectors at most

    def make():
        model = shared.value

        def work(texts):
            lang, sure = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            mine = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
            if mine:
                best, odds = model.decide([texts[i] for i in mine])
                for i, b, o in zip(mine, best, odds):
                    lang[i], sure[i] = model.languages[b], o
            return [pa.array(lang, pa.string()), pa.array(sure, pa.float64())]
        return work

    return map_texts(docs, text_col, list(carry), "lang string, score double", make)
