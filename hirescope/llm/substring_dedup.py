"""Line-level substring deduplication.

Lines are normalised (lower case, white space runs as one space, trimmed) and
digested; over the whole corpus the earliest occurrence of a digest, by
document id and line number, stays and all others are removed.  Lines of fewer
than ``min_words`` words are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, materialise, text_batches

MIN_WORDS = 5
_SPACE = re.compile(r"[ \t\r\f\v]+")
_NO_ID = 2**63 - 1


def normalise(line: str) -> str:
    return _SPACE.sub(" ", line.lower()).strip(" ")


def _units(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in text_batches(batches, (0, 1, 2), 2, 4 << 20):
            did, th, number, start, end, digest = [], [], [], [], [], []
            for i, h, text in zip(ids, hashes, texts):
                at = 0
                for n, line in enumerate(text.split("\n")):
                    norm = normalise(line)
                    if norm.count(" ") >= min_words - 1 and norm:
                        did.append(i)
                        th.append(h)
                        number.append(n)
                        start.append(at)
                        end.append(at + len(line))
                        digest.append(hashlib.md5(norm.encode(), usedforsecurity=False).digest())
                    at += len(line) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(did, pa.int64()), pa.array(th, pa.int32()), pa.array(number, pa.int32()),
                 pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(digest, pa.binary())],
                names=["did", "th", "line", "start", "end", "digest"])
    return run


def _cut(texts, given):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    lines, spans, kept = [], [], []
    for text, want in zip(texts, given):
        text = text or ""
        cuts = sorted({(w["start"], w["end"]) for w in want or ()})
        gone = {s for s, _ in cuts}
        at, rest, all_lines = 0, [], text.split("\n")
        for line in all_lines:
            if at not in gone or not line:
                rest.append(line)
            at += len(line) + 1
        lines.append(len(all_lines))
        spans.append([{"start": s, "end": e} for s, e in cuts])
        kept.append("\n".join(rest))
    return [pa.array(lines, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.string())]


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_words: int = MIN_WORDS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Remove every line whose normal form occurs earlier in the corpus.

    Returns one row per input row: ``n_lines, spans`` (code point offsets of
    the removed lines in the original text), ``kept`` (the other lines, joined
    by line feeds) and ``row``, a struct of the ``carry`` columns.

    Null texts count as empty (one empty line).  Rows without an id come last,
    as one document; rows that repeat an id are one document given more than
    once and don't remove each other's lines at the same line number.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("did"), F.hash(text).alias("th"),
                      text.alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    units = src.select("did", "th", "text").mapInArrow(
        _units(min_words), "did long, th int, line int, start int, end int, digest binary")
    # Reduced to one row per digest and task before the shuffle, however frequent a line is.  Written, so that
    # the join reads nothing but its two exchanges: Spark then splits the partition of a very frequent line.
    earliest = materialise(units.groupBy("digest").agg(F.min(F.struct("did", "line")).alias("e"), F.count(F.lit(1)).alias("n"))
                           .where("n > 1").select("digest", "e"))
    later = units.join(earliest, "digest").where("not (did = e.did and line = e.line)")
    by_doc = later.groupBy("did", "th").agg(F.collect_list(F.struct("start", "end")).alias("cut"))
    names = [f"c{i}" for i in range(len(carry))]
    whole = src.join(by_doc, ["did", "th"], "left").select("text", "cut", *names)
    out = map_texts(whole, "text", names, "n_lines long, spans array<struct<start:long,end:long>>, kept string",
                    lambda: _cut, extra=("cut",))
    return out.select("n_lines", "spans", "kept",
                      F.struct(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)]).alias("row"))
