"""Exact substring deduplication: sampled suffixes, sorted by hash comparison.

A byte is removed when some string of ``length`` bytes that covers it also
starts earlier: in a document of smaller id, or further left in its own.

Only suffixes at content-defined positions are sorted.  Each window of
``length`` bytes is represented by its least k-gram (leftmost on ties), its
*anchor*.  Equal windows have equal anchors at equal offsets, so comparing the
occurrences of one k-gram finds every repeat.  Consecutive windows with the
same anchor form one *unit*, about one per 30 bytes.

1. Units are keyed by their anchor's k-gram.  Equal units (128 bits of hash)
   settle all their windows at once; repeats within a piece of a map task are
   settled before the shuffle.  A k-gram seen in one unit only cannot repeat.
2. For k-grams with different units, the units' bytes are fetched and their
   suffixes sorted: mergesort, two suffixes compared by binary search over
   prefix polynomial hashes for their common extension.  The extensions are
   verified byte by byte.  Sorting the bytes to the right and (reversed) to
   the left of the anchors yields, for each offset, classes of equal windows.
3. k-grams with very many different units (the border of a passage that a
   large part of the corpus shares) are never gathered: map tasks and reducers
   divert their windows to an aggregation by 128-bit window digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, materialise, text_batches
from hirescope.llm.polyhash import PrefixHash, mix

LENGTH = 100
KGRAM = 32


@dataclass(frozen=True)
class Limits:
    """Working-memory bounds; results don't depend on them."""

    #: Bytes hashed at a time.  Positions are packed into the low 24 bits of a key.
    piece: int = 1 << 20
    #: Different units of one k-gram that a map piece, and a reducer, brings together.
    piece_group: int = 256
    task_group: int = 4096


UNIT, HOT, WINDOWS, REMOVED, CONTEXT = range(5)
_ROW = "pkey long, uh long, did long, th int, kind int, a int, b int"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_NO_ID = 2**63 - 1


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` consecutive ones, by doubling."""
    size = 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = width - size
    return np.minimum(key[:-rest], key[rest:]) if rest else key


def find_units(buf: np.ndarray, ends: np.ndarray, length: int, k: int):
    """Units of a buffer of concatenated documents (``ends``: their ends).

    Returns anchor, first and last window start, k-gram hash and unit hash.
    """
    if len(buf) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = PrefixHash(buf)
    grams = prefix.windows(k)
    keys = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(keys, length - k + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    valid = np.ones(len(anchor), bool)
    for end in ends[:-1]:
        valid[max(0, end - length + 1):end] = False
    change = np.r_[True, (anchor[1:] != anchor[:-1]) | ~valid[:-1]] & valid
    first = np.flatnonzero(change)
    stop = np.flatnonzero(np.r_[change[1:] | ~valid[1:], True] & valid)
    at = anchor[first]
    return at, first, stop, grams[at], prefix.spans(first, stop + length)


def _runs(did, th, start, end):
    """Merge overlapping or touching [start, end) of the same document."""
    order = np.lexsort((start, th, did))
    did, th, start, end = did[order], th[order], start[order], end[order]
    same = np.r_[False, (did[1:] == did[:-1]) & (th[1:] == th[:-1])]
    # Ends made cumulative within a document: shift every document past the last.
    shift = np.cumsum(~same).astype(np.int64) << 32
    reach = np.maximum.accumulate(end + shift) if len(end) else end
    new = np.r_[True, start[1:] + shift[1:] > reach[:-1]] if len(end) else np.empty(0, bool)
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(start)] - 1 if len(at) else at
    return did[at], th[at], start[at], (reach[last] - shift[last])


def _later(order_keys, did, pos):
    """Rows sorted by (keys, did, pos): which are not the earliest of their
    key; rows that tie with the earliest (a repeated row) are not later."""
    same = np.ones(len(did), bool)
    same[:1] = False
    for key in order_keys:
        same[1:] &= key[1:] == key[:-1]
    head = np.maximum.accumulate(np.where(~same, np.arange(len(did)), 0)) if len(did) else np.empty(0, np.int64)
    return (did != did[head]) | (pos != pos[head]), ~same


def _batch(pkey, uh, did, th, kind, a, b) -> pa.RecordBatch:
    n = len(did)
    kinds = np.full(n, kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(pkey).view(np.int64)), pa.array(np.asarray(uh).view(np.int64)), pa.array(did),
         pa.array(th.astype(np.int32)), pa.array(kinds), pa.array(np.asarray(a).astype(np.int32)),
         pa.array(np.asarray(b).astype(np.int32))], names=_NAMES)


def _spread(did, a):
    """Partition keys for rows that any task may handle."""
    return mix(did.view(np.uint64) * np.uint64(31) + np.asarray(a).astype(np.uint64))


def _pieces(ids, hashes, texts, length, limits):
    """Concatenated buffers of at most about twice ``limits.piece`` bytes; longer documents are
    cut with an overlap so that each window lies in one piece."""
    part, size = [], 0
    for did, th, text in zip(ids, hashes, texts):
        raw = (text or "").encode()
        if len(raw) < length:
            continue
        for at in range(0, len(raw) - length + 1, limits.piece):
            cut = raw[at:at + limits.piece + length - 1]
            if size and size + len(cut) > 2 * limits.piece:
                yield part
                part, size = [], 0
            part.append((_NO_ID if did is None else did, th, at, cut))
            size += len(cut)
    if part:
        yield part


def _map_units(length: int, k: int, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in text_batches(batches, (0, 1, 2), 2, 4 << 20):
            for part in _pieces(ids, hashes, texts, length, limits):
                buf = np.frombuffer(b"".join(x[3] for x in part), np.uint8)
                ends = np.cumsum([len(x[3]) for x in part])
                at, first, last, kh, uh = find_units(buf, ends, length, k)
                doc = np.searchsorted(ends, at, side="right")
                base = np.array([e - len(x[3]) - x[2] for e, x in zip(ends.tolist(), part)], np.int64)
                did = np.array([x[0] for x in part], np.int64)[doc]
                th = np.array([x[1] for x in part], np.int64)[doc]
                pos, lo, hi = at - base[doc], at - first, at - last
                order = np.lexsort((pos, did, uh, kh))
                kh, uh, did, th, pos, lo, hi = (x[order] for x in (kh, uh, did, th, pos, lo, hi))
                later, head = _later((kh, uh), did, pos)
                if later.any():
                    rd, rt, rs, re = _runs(did[later], th[later], (pos - lo)[later], (pos - hi)[later] + length)
                    yield _batch(_spread(rd, rs), np.zeros(len(rd), np.int64), rd, rt, REMOVED, rs, re)
                keep = ~later
                # k-grams with very many different units in this piece
                edge = np.r_[True, kh[1:] != kh[:-1]] if len(kh) else np.empty(0, bool)
                group = np.cumsum(edge) - 1
                hot = np.bincount(group, weights=head, minlength=1)[group] > limits.piece_group if len(kh) else edge
                sel = keep & ~hot
                yield _batch(kh[sel], uh[sel], did[sel], th[sel], UNIT, pos[sel], (lo * 128 + hi)[sel])
                sel = keep & hot
                if sel.any():
                    yield _batch(_spread(did[sel], pos[sel]), uh[sel], did[sel], th[sel], WINDOWS, pos[sel],
                                 (lo * 128 + hi)[sel])
                    sel = hot & edge
                    zero = np.zeros(int(sel.sum()), np.int64)
                    yield _batch(kh[sel], zero, zero, zero, HOT, zero, zero)
    return run


def _reduce_units(length: int, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in _NAMES]
        for batch in batches:
            kind = batch.column(4).to_numpy()
            through = np.flatnonzero((kind == REMOVED) | (kind == WINDOWS))
            if len(through):
                yield batch.take(pa.array(through))
            mine = np.flatnonzero((kind == UNIT) | (kind == HOT))
            for have, c in zip(cols, batch.columns):
                have.append(c.to_numpy()[mine])
        if not cols[0]:
            return
        kh, uh, did, th, kind, pos, b = (np.concatenate(x) for x in cols)
        marked = np.unique(kh[kind == HOT])
        order = np.lexsort((pos, did, uh, kh))
        order = order[kind[order] == UNIT]
        kh, uh, did, th, pos, b = (x[order] for x in (kh, uh, did, th, pos, b))
        if not len(kh):
            return
        lo, hi = b >> 7, b & 127
        later, head = _later((kh, uh), did, pos)
        if later.any():
            rd, rt, rs, re = _runs(did[later], th[later], (pos - lo)[later].astype(np.int64),
                                   (pos - hi)[later].astype(np.int64) + length)
            yield _batch(np.zeros(len(rd), np.int64), np.zeros(len(rd), np.int64), rd, rt, REMOVED, rs, re)
        group = np.cumsum(np.r_[True, kh[1:] != kh[:-1]]) - 1
        different = np.bincount(group, weights=head)[group]
        many = (different > limits.task_group) | np.isin(kh, marked)
        go = ~later & (many | (different > 1))
        yield _batch(kh[go], uh[go], did[go], th[go], np.where(many[go], WINDOWS, CONTEXT), pos[go], b[go])
    return run


_FETCHED = "kind int, kh long, did long, th int, a int, b int, ctx binary"


def _fetch(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _FETCHED.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for ids, hashes, texts, wants in text_batches(batches, (0, 1, 2, 3), 2, 4 << 20):
            rows: list[tuple] = []
            for did, th, text, want in zip(ids, hashes, texts, wants):
                raw = text.encode()
                for w in want:
                    a, lo, hi = w["a"], w["b"] >> 7, w["b"] & 127
                    if w["kind"] == CONTEXT:
                        rows.append((CONTEXT, w["pkey"], did, th, a, w["b"], raw[a - lo:a - hi + length]))
                    else:
                        rows.extend((WINDOWS, 0, did, th, s, 0,
                                     hashlib.blake2b(raw[s:s + length], digest_size=16).digest())
                                    for s in range(a - lo, a - hi + 1))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


class _Suffixes:
    """Suffixes of contexts in one buffer, compared by their hashes."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.buf, self.start, self.size = buf, start, size
        self.prefix = PrefixHash(buf)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of suffixes i and j: binary search over hashes."""
        lo = np.zeros(len(i), np.int64)
        hi = np.minimum(self.size[i], self.size[j])
        s, t = self.start[i], self.start[j]
        for _ in range(int(hi.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            eq = self.prefix.raw(s, s + mid) == self.prefix.raw(t, t + mid)
            lo, hi = np.where(eq, mid, lo), np.where(eq, hi, np.maximum(mid - 1, lo))
        return lo

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: bool) -> np.ndarray:
        ext = self.extension(i, j)
        end_i, end_j = ext >= self.size[i], ext >= self.size[j]
        last = len(self.buf) - 1
        bi = self.buf[np.minimum(self.start[i] + ext, last)]
        bj = self.buf[np.minimum(self.start[j] + ext, last)]
        out = np.where(end_i | end_j, end_i & ~end_j, bi < bj)
        return out | (end_i & end_j) if or_equal else out

    def sort(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Mergesort of every group ``[first, first + size)`` of suffixes; all
        groups advance together, one run width at a time."""
        n = int(size.sum())
        group = np.repeat(np.arange(len(size)), size)
        base, count = first[group], size[group]
        order, place = np.arange(n), np.arange(n) - base
        width = 1
        while width < int(size.max(initial=0)):
            todo = np.flatnonzero(count > width)
            p, g0, c = place[todo], base[todo], count[todo]
            run = p // width
            left = run % 2 == 0
            other = np.where(left, run + 1, run - 1) * width
            other_end = np.minimum(other + width, c)
            paired = other < c
            lo, hi = other.copy(), np.where(paired, other_end, other)
            me = order[todo]
            live = np.flatnonzero(lo < hi)
            while len(live):
                mid = (lo[live] + hi[live]) >> 1
                them = order[g0[live] + mid]
                # Elements of the other run that go before me; ties keep their order.
                before = np.where(left[live], self.less(them, me[live], False), self.less(them, me[live], True))
                lo[live] = np.where(before, mid + 1, lo[live])
                hi[live] = np.where(before, hi[live], mid)
                live = live[lo[live] < hi[live]]
            pair0 = (run - (run % 2)) * width
            target = g0 + pair0 + (p - run * width) + (lo - other)
            new = order.copy()
            new[target] = me
            order = new
            width *= 2
        return order

    def ranks(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted order, and the verified common extension of each suffix with
        the one before it (-1 at the head of a group)."""
        order = self.sort(first, size)
        ext = self._verified(order, first)
        if ext is None:  # hashes collided: order these few groups by their bytes
            raw = self.buf.tobytes()
            key = [raw[s:s + c] for s, c in zip(self.start.tolist(), self.size.tolist())]
            order = np.concatenate([np.array(sorted(range(f, f + c), key=key.__getitem__), np.int64)
                                    for f, c in zip(first.tolist(), size.tolist())])
            ext = self._bytes(order[:-1], order[1:])
            ext = np.r_[-1, ext]
            ext[first] = -1
        return order, ext

    def _bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        last = len(self.buf) - 1
        for at in range(0, len(i), 1 << 15):
            a, b = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            most = np.minimum(self.size[a], self.size[b])
            cols = np.arange(int(most.max(initial=0)) + 1)
            diff = (self.buf[np.minimum(self.start[a][:, None] + cols, last)]
                    != self.buf[np.minimum(self.start[b][:, None] + cols, last)]) | (cols >= most[:, None])
            out[at:at + len(a)] = diff.argmax(axis=1)
        return out

    def _verified(self, order: np.ndarray, first: np.ndarray) -> np.ndarray | None:
        out = np.full(len(order), -1, np.int64)
        ok = np.ones(len(order), bool)
        ok[first] = False
        at = np.flatnonzero(ok)
        by_hash, by_bytes = self.extension(order[at - 1], order[at]), self._bytes(order[at - 1], order[at])
        if not np.array_equal(by_hash, by_bytes):
            return None
        out[at] = by_bytes
        return out


def repeated_windows(kh, did, th, pos, b, ctx: list[bytes], length: int):
    """Windows of units of shared k-grams that also start earlier, as runs
    (did, th, start, end)."""
    order = np.lexsort((pos, did, kh))
    kh, did, th, pos, b = (x[order] for x in (kh, did, th, pos, b))
    ctx = [ctx[i] for i in order.tolist()]
    lo, hi = (b >> 7).astype(np.int64), (b & 127).astype(np.int64)
    edge = np.r_[True, kh[1:] != kh[:-1]]
    first = np.flatnonzero(edge)
    size = np.diff(np.r_[first, len(kh)])
    group = np.cumsum(edge) - 1
    lens = np.fromiter(map(len, ctx), np.int64, len(ctx))
    raw = b"".join(ctx)
    begin = np.cumsum(lens) - lens
    buf = np.frombuffer(raw, np.uint8)
    right = _Suffixes(buf, begin + lo, lens - lo)
    left = _Suffixes(buf[::-1].copy(), len(buf) - (begin + lo), lo)
    ro, re = right.ranks(first, size)
    lo_, le = left.ranks(first, size)
    n = len(kh)
    out = []
    cls_r, cls_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for off in range(int(lo.max()) + 1):
        mine = np.flatnonzero((lo >= off) & (hi <= off))
        if len(mine) < 2:
            continue
        cls_r[ro] = np.cumsum(re < length - off)
        cls_l[lo_] = np.cumsum(le < off)
        key = cls_r[mine] * np.int64(n + 1) + cls_l[mine]
        by = np.argsort(key, kind="stable")  # rows are in (did, pos) order within a group
        later, _ = _later((key[by],), did[mine][by], pos[mine][by])
        hit = mine[by[later]]
        if len(hit):
            out.append((did[hit], th[hit], pos[hit] - off, pos[hit] - off + length))
    del group
    if not out:
        return None
    return _runs(*(np.concatenate(x).astype(np.int64) for x in zip(*out)))


def _compare(length: int, at_once: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], [], []]
        for batch in batches:
            for have, i in zip(rows, (1, 2, 3, 4, 5)):
                have.append(batch.column(i).to_numpy())
            rows[5].extend(batch.column(6).to_pylist())
        if not rows[0]:
            return
        kh, did, th, pos, b = (np.concatenate(x) for x in rows[:5])
        order = np.argsort(kh, kind="stable")
        kh, did, th, pos, b = (x[order] for x in (kh, did, th, pos, b))
        ctx = [rows[5][i] for i in order.tolist()]
        size = np.cumsum([len(x) for x in ctx])
        cut = 0
        while cut < len(kh):  # whole groups, about at_once bytes at a time
            end = int(np.searchsorted(size, (size[cut - 1] if cut else 0) + at_once, side="left")) + 1
            end = int(np.searchsorted(kh, kh[min(end, len(kh)) - 1], side="right"))
            runs = repeated_windows(kh[cut:end], did[cut:end], th[cut:end], pos[cut:end].astype(np.int64),
                                    b[cut:end], ctx[cut:end], length)
            if runs is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs[0]), pa.array(runs[1].astype(np.int32)), pa.array(runs[2].astype(np.int32)),
                     pa.array(runs[3].astype(np.int32))], names=["did", "th", "a", "b"])
            cut = end
    return run


def _cut(as_text: bool):
    """Apply each text's spans to it."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(texts, given):
        sizes, spans, kept = [], [], []
        for text, want in zip(texts, given):
            raw = (text or "").encode()
            runs: list[list[int]] = []
            for s, e in sorted((w["a"], w["b"]) for w in want or ()):
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], e)
                else:
                    runs.append([s, e])
            at, parts = 0, []
            for s, e in runs:
                parts.append(raw[at:s])
                at = e
            sizes.append(len(raw))
            spans.append([{"start": s, "end": e} for s, e in runs])
            kept.append(b"".join(parts) + raw[at:] if runs else raw)
        return [pa.array(sizes, pa.int64()), pa.array(spans, spans_type),
                pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text
                else pa.array(kept, pa.binary())]
    return work


def _source(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("did"), F.hash(text).alias("th"),
                       text.alias("text"), *([F.struct(*carry).alias("row")] if carry else []))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   k: int = KGRAM, limits: Limits = Limits()) -> DataFrame:
    """Byte ranges ``a <= . < b`` to remove, by document key ``did, th``; a
    document's ranges may overlap."""
    if not 0 < k <= length <= 127 + k:
        raise ValueError("length must lie between k and k + 127")
    src = _source(docs, id_col, text_col)
    units = src.select("did", "th", "text").mapInArrow(_map_units(length, k, limits), _ROW)
    settled = materialise(units.repartition("pkey").mapInArrow(_reduce_units(length, limits), _ROW))
    wanted = (settled.where(F.col("kind").isin(WINDOWS, CONTEXT)).groupBy("did", "th")
              .agg(F.collect_list(F.struct("kind", "pkey", "a", "b")).alias("want")))
    fetched = materialise(src.select("did", "th", "text").join(wanted, ["did", "th"])
                          .mapInArrow(_fetch(length), _FETCHED))
    compared = fetched.where(F.col("kind") == CONTEXT).repartition("kh").mapInArrow(
        _compare(length), "did long, th int, a int, b int")
    windows = fetched.where(F.col("kind") == WINDOWS).select("ctx", "did", "th", "a")
    earliest = windows.groupBy("ctx").agg(F.min(F.struct("did", "a")).alias("e"))
    diverted = (windows.join(earliest, "ctx").where("not (did = e.did and a = e.a)")
                .select("did", "th", "a", (F.col("a") + length).cast("int").alias("b")))
    return (settled.where(F.col("kind") == REMOVED).select("did", "th", "a", "b")
            .union(compared).union(diverted))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   k: int = KGRAM, limits: Limits = Limits(), carry: tuple[str, ...] = ("doc_id",),
                   as_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts
    earlier; strings are judged on the input.

    Returns one row per input row: ``n_bytes, spans`` (maximal removed byte
    ranges, ascending), ``kept`` (the remaining bytes, concatenated; a cut may
    fall inside a UTF-8 sequence; ``as_text``: as a string without the rest of
    a character so cut) and ``row``, a struct of the ``carry`` columns.

    Null texts count as empty.  Rows without an id come after all others, as
    one document.  Rows that repeat an id are the same document given more
    than once: they don't remove each other's bytes at the same offset.
    Texts shorter than ``length`` bytes stay whole.  Other columns of
    ``docs`` are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, length, k, limits)
    by_doc = spans.groupBy("did", "th").agg(F.collect_list(F.struct("a", "b")).alias("cut"))
    whole = _source(docs, id_col, text_col, carry).join(by_doc, ["did", "th"], "left").select("text", "cut", "row")
    names = [f"row.{c}" for c in carry]
    flat = whole.select("text", "cut", *[F.col(n).alias(f"c{i}") for i, n in enumerate(names)])
    out = map_texts(flat, "text", [f"c{i}" for i in range(len(carry))],
                    "n_bytes long, spans array<struct<start:long,end:long>>, kept " + ("string" if as_text else "binary"),
                    lambda: _cut(as_text), extra=("cut",))
    return out.select("n_bytes", "spans", "kept",
                      F.struct(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)]).alias("row"))
