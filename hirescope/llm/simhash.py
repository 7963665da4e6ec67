"""SimHash near-duplicate detection by anchor-point covering.

Two documents are linked when their 64-bit fingerprints differ in at most
``max_bits`` bits.  All such pairs are found, not a sample of them:

* The 64 bits are cut into segments with a tolerance each.  If every segment
  differed by more than its tolerance the total would exceed ``max_bits``, so
  a linked pair is within tolerance in one segment at least.
* In a segment the anchors are the words of a covering code of radius 1:
  a [31, 26] Hamming code on 31 bits, beside any further bits taken as they
  are.  Every word has one home anchor (itself, or the one code word a bit
  away).
* A fingerprint is sent to every anchor within ``1 + tolerance`` of it.  By
  the triangle inequality it then meets, at their home anchors, all
  fingerprints within tolerance of it.
* At an anchor only its home fingerprints are compared with those sent there.

Equal fingerprints are grouped first, so a group of copies of any size is one
fingerprint.  Anchors that are home to very many different fingerprints are
split into blocks of home fingerprints; visitors go to every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialise, text_batches
from hirescope.llm.components import connected_components

SEED = 42
_HAMMING_BITS, _CHECKS = 31, 5


@dataclass(frozen=True)
class Segment:
    """``raw`` bits from ``start`` on, then 31 bits under the Hamming code."""

    start: int
    raw: int
    tolerance: int


#: 31 bits with one difference, 33 bits with two: (1+1) + (2+1) > 4.
SEGMENTS = (Segment(0, 0, 1), Segment(31, 2, 2))

# Bytes (0..255) to their eight bits, least significant first.
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of a text: majority of the XXH64 bits of its word shingles."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and \x20\x09-\x0D only
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.empty(n, np.int64)
        starts[0] = 0
        starts[1:] = ends[:-1]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[:n - shingle + 1].tolist(),
                                                       (ends[shingle - 1:] - 1).tolist())),
            np.uint64, n - shingle + 1)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) per row of ``docs``."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches, (0, 1), 1):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps)], names=["doc_id", "fp"])

    return source.mapInArrow(run, "doc_id long, fp long")


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Which bit (1..31) of a 31-bit word is off the nearest code word; 0: none."""
    out = np.zeros(len(word), np.int64)
    index = np.arange(1, _HAMMING_BITS + 1)
    for j in range(_CHECKS):
        mask = np.uint64(sum(1 << int(i - 1) for i in index if i >> j & 1))
        out |= (np.bitwise_count(word & mask).astype(np.int64) & 1) << j
    return out


def _flips(radius: int) -> list[np.ndarray]:
    """For each syndrome: the patterns of at most ``radius`` bits that lead to a code word."""
    by: list[list[int]] = [[] for _ in range(_HAMMING_BITS + 1)]

    def grow(first: int, left: int, pattern: int, syndrome: int) -> None:
        by[syndrome].append(pattern)
        if left:
            for i in range(first, _HAMMING_BITS + 1):
                grow(i + 1, left - 1, pattern | 1 << (i - 1), syndrome ^ i)

    grow(1, radius, 0, 0)
    return [np.array(x, np.uint64) for x in by]


def _fields(fps: np.ndarray, seg: Segment) -> tuple[np.ndarray, np.ndarray]:
    raw = (fps >> np.uint64(seg.start)) & np.uint64((1 << seg.raw) - 1)
    return raw, (fps >> np.uint64(seg.start + seg.raw)) & np.uint64((1 << _HAMMING_BITS) - 1)


def _key(number: int, raw: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (np.uint64(number) << np.uint64(60)) | (raw << np.uint64(_HAMMING_BITS)) | code


def home_anchors(fps: np.ndarray, segments: tuple[Segment, ...] = SEGMENTS) -> list[np.ndarray]:
    """Per segment, the home anchor of each fingerprint."""
    out = []
    for number, seg in enumerate(segments):
        raw, word = _fields(fps, seg)
        s = _syndrome(word)
        flip = np.where(s > 0, np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64), np.uint64(0))
        out.append(_key(number, raw, word ^ flip))
    return out


def reached_anchors(fps: np.ndarray, segments: tuple[Segment, ...] = SEGMENTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (anchor, fingerprint): all anchors within radius plus tolerance."""
    for number, seg in enumerate(segments):
        raw, word = _fields(fps, seg)
        s = _syndrome(word)
        for mask in range(1 << seg.raw):
            off = int(mask).bit_count()
            if off > seg.tolerance:
                continue
            flips = _flips(seg.tolerance + 1 - off)
            for syndrome in range(_HAMMING_BITS + 1):
                at = np.flatnonzero(s == syndrome)
                f = flips[syndrome]
                if len(at) and len(f):
                    codes = word[at][:, None] ^ f[None, :]
                    raws = np.broadcast_to((raw[at] ^ np.uint64(mask))[:, None], codes.shape)
                    yield _key(number, raws, codes).ravel(), np.repeat(fps[at], len(f))


def _forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Least reachable index for each of ``n`` items under links ``u - v``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links(anchors: np.ndarray, blocks: np.ndarray, n_blocks: np.ndarray, fps: np.ndarray, max_bits: int,
           segments: tuple[Segment, ...], pairs_at_once: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between home fingerprints and those sent to the same anchor, as a
    forest per piece (never all pairs of a group)."""
    order = np.lexsort((blocks, anchors))
    anchors, blocks, n_blocks, fps = anchors[order], blocks[order], n_blocks[order], fps[order]
    edge = np.r_[True, (anchors[1:] != anchors[:-1]) | (blocks[1:] != blocks[:-1])]
    first = np.flatnonzero(edge)
    size = np.diff(np.r_[first, len(anchors)])
    cell = np.cumsum(edge) - 1
    is_home = np.zeros(len(fps), bool)
    for home in home_anchors(fps, segments):
        is_home |= home == anchors
    is_home &= _block(fps, n_blocks) == blocks
    home_at = np.flatnonzero(is_home & (size[cell] > 1))
    work = np.cumsum(size[cell[home_at]])
    lo = 0
    while lo < len(home_at):
        done = work[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(work, done + pairs_at_once, side="right")))
        at = home_at[lo:hi]
        count = size[cell[at]]
        a = np.repeat(at, count)
        b = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[cell[at]], count)
        near = (np.bitwise_count(fps[a] ^ fps[b]) <= max_bits) & (fps[a] != fps[b])
        if near.any():
            ends, which = np.unique(np.concatenate([fps[a[near]], fps[b[near]]]), return_inverse=True)
            half = len(which) // 2
            label = _forest(which[:half], which[half:], len(ends))
            moved = np.flatnonzero(label != np.arange(len(ends)))
            yield ends[moved], ends[label[moved]]
        lo = hi


def _block(fps: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Block of a home fingerprint among its anchor's blocks."""
    mixed = (fps ^ (fps >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % n_blocks.astype(np.uint64)).astype(np.int64)


def links(distinct: DataFrame, max_bits: int = 4, segments: tuple[Segment, ...] = SEGMENTS,
          block: int = 4096) -> DataFrame:
    """Links ``u, v`` between the distinct fingerprints ``fp`` whose closure is
    that of all pairs within ``max_bits`` bits."""
    if sum(s.tolerance + 1 for s in segments) <= max_bits:
        raise ValueError("the segments' tolerances do not cover max_bits")

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            keys, counts = np.unique(np.concatenate(home_anchors(fps, segments)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["anchor", "n"])

    # Anchors that are home to more than a block; few, whatever the input.
    hot = materialise(distinct.select("fp").mapInArrow(homes, "anchor long, n long")
                      .groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > block)
                      .select("anchor", F.ceil(F.col("n") / block).cast("long").alias("n_blocks")))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                for anchor, fp in reached_anchors(fps[at:at + 4096], segments):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp.view(np.int64))],
                                                     names=["anchor", "fp"])

    # Each fingerprint becomes some two hundred rows: don't let the planner join small partitions here.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = (distinct.select("fp").repartition(tasks, "fp").mapInArrow(reach, "anchor long, fp long").join(hot, "anchor", "left")
            .select("anchor", "fp", F.coalesce("n_blocks", F.lit(1)).cast("long").alias("n_blocks"))
            .select("anchor", "fp", "n_blocks",
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for have, c in zip(cols, batch.columns):
                have.append(c.to_numpy())
        if not cols[0]:
            return
        anchor, fp, n_blocks, blk = (np.concatenate(x) for x in cols)
        for u, v in _links(anchor.view(np.uint64), blk, n_blocks, fp.view(np.uint64), max_bits, segments):
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return sent.repartition("anchor", "block").mapInArrow(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, segments: tuple[Segment, ...] = SEGMENTS) -> DataFrame:
    """Near-duplicate groups of ``docs``.

    Returns one row per input row: ``doc_id, fp, component_id``, where
    ``component_id`` is the least id reachable over links of at most
    ``max_bits`` differing fingerprint bits.

    Null or empty texts have fingerprint zero and are linked like any other;
    a null id keeps its row and never names a component; repeated rows give
    repeated results; other columns of ``docs`` are not read.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, shingle))
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = connected_components(links(reps.select("fp"), max_bits, segments))
    grouped = (reps.join(labels.select(F.col("vertex").alias("fp"), "component"), "fp", "left")
               .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(grouped.join(names, "component").select("fp", "component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")
