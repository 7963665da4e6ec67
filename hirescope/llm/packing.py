"""Packing documents into fixed-length token sequences.

Whole windows of a document become sequences of their own.  What is left of
the documents is cut into pieces and dealt over windows by Karmarkar-Karp
multiway differencing: of the partial partitions, the two with the largest
imbalance are merged, the fullest windows of one with the emptiest of the
other, until one partition is left whose windows are nearly equal.  Should a
window exceed the capacity the window count rises and the block is dealt anew.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import text_batches

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
#: A space beside other white space: there, words can't be encoded one by one.
_ODD_SPACE = re.compile(r"\s | \s")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: printable Latin-1 characters stand
    for themselves, the other bytes in order for the code points from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of a ``tokenizers`` byte-level BPE file.

    White space starts a token of this kind, so where spaces stand alone the
    ids of a text are those of its space-separated words, one after another;
    the words' ids are remembered (a bounded number of them).
    """

    def __init__(self, path: str, most: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        self.bpe = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens=special)
        self.most, self.known = most, {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.bpe.encode(text, allowed_special="all"), "<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if _ODD_SPACE.search(text):
            return np.frombuffer(self._encode(text), "<u4")
        words = text.split(" ")
        if len(self.known) > self.most:
            self.known.clear()
        known, encode = self.known, self._encode
        parts = [encode(words[0])]
        for got, word in zip(map(known.get, words[1:]), words[1:]):
            if got is None:
                got = known.get(word)
                if got is None:
                    known[word] = got = encode(" " + word)
            parts.append(got)
        return np.frombuffer(b"".join(parts), "<u4")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp: the window (0..k-1) of each item."""
    n = len(sizes)
    left, right = np.full(2 * n, -1), np.full(2 * n, -1)
    fresh = n  # handles below n are items, above: unions of two handles
    heap = []
    for i, size in enumerate(sizes.tolist()):
        load, hold = np.zeros(k, np.int64), np.full(k, -1)
        load[0], hold[0] = size, i
        heap.append((-size, i, load, hold))
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, load, hold = heapq.heappop(heap)
        _, _, load2, hold2 = heapq.heappop(heap)
        load, a, b = load + load2[::-1], hold, hold2[::-1]
        both = np.flatnonzero((a >= 0) & (b >= 0))
        hold = np.maximum(a, b)
        new = np.arange(fresh, fresh + len(both))
        left[new], right[new] = a[both], b[both]
        hold[both] = new
        fresh += len(both)
        order = np.argsort(-load, kind="stable")
        load, hold = load[order], hold[order]
        load -= load[-1]
        heapq.heappush(heap, (-int(load[0]), tie, load, hold))
        tie += 1
    window = np.full(2 * n, -1)
    if heap:
        hold = heap[0][3]
        window[hold[hold >= 0]] = np.flatnonzero(hold >= 0)
    for h in range(fresh - 1, n - 1, -1):
        window[left[h]] = window[right[h]] = window[h]
    return window[:n]


def deal(sizes: np.ndarray, capacity: int, k: int) -> tuple[np.ndarray, int]:
    """Windows of the items and their number: ``k``, or more if one overflows."""
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max(initial=0) <= capacity:
            return window, k
        k += 1


_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids array<int>")


class _Packer:
    """Packs the documents of one task."""

    def __init__(self, task: int, capacity: int, cut: int, block: int, spare: int):
        self.next_id = task << 40
        self.capacity, self.cut, self.block, self.spare = capacity, cut, block, spare
        self.queue: list[tuple] = []  # (doc, start, ids, doc_tokens) of at most `cut` ids
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            self._emit((doc, at, ids[at:at + self.capacity], n), self.next_id, 0)
            self.next_id += 1
        self.queue.extend((doc, at, ids[at:at + self.cut], n) for at in range(whole, n, self.cut))
        if len(self.queue) >= self.block:
            self._flush(False)

    def _emit(self, piece, sequence: int, offset: int) -> None:
        doc, start, ids, n = piece
        self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, sequence, offset, ids))

    def _flush(self, last: bool) -> None:
        total = sum(len(p[2]) for p in self.queue)
        block, k = self.queue, -(-total // self.capacity)
        self.queue = []
        if not last:
            # As many ids as fill k windows but for a few; the rest waits for the next block.
            k = total // (self.capacity - self.spare)
            room = k * (self.capacity - self.spare)
            take = 0
            while take < len(block) and room >= len(block[take][2]):
                room -= len(block[take][2])
                take += 1
            rest, block = block[take:], block[:take]
            if rest and room:
                doc, start, ids, n = rest[0]
                block.append((doc, start, ids[:room], n))
                rest[0] = (doc, start + room, ids[room:], n)
            self.queue = rest
        if not block:
            return
        window, k = deal(np.array([len(p[2]) for p in block]), self.capacity, max(1, k))
        fill = [0] * k
        for piece, w in zip(block, window.tolist()):
            self._emit(piece, self.next_id + w, fill[w])
            fill[w] += len(piece[2])
        self.next_id += k

    def finish(self) -> None:
        if self.queue:
            self._flush(True)

    def batch(self, with_ids: bool) -> pa.RecordBatch:
        cols = list(zip(*self.out)) if self.out else [()] * 8
        self.out = []
        arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            arrays.append(pa.array([x.astype(np.int32) for x in cols[7]], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY, cut: int = 256, block: int = 512, spare: int = 2,
         with_ids: bool = True) -> DataFrame:
    """Pieces of all documents, each document's ids followed by id 0.

    Returns one row per piece: ``doc_id, start`` (the document's ids before
    it), ``length, ids_crc32`` (of the ids as little-endian unsigned 32-bit
    numbers), ``doc_tokens, sequence_id, offset`` and, ``with_ids``, ``ids``.
    ``cut`` is the most ids of a piece that shares its sequence, ``block`` the
    pieces dealt at once, ``spare`` the ids that a window is planned short.

    Each task packs the documents it reads, so nothing is shuffled and each
    task leaves one window partly filled at most.  Null texts count as empty
    (one piece with id 0); null ids and repeated rows are packed like others;
    other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(public_tokenizers.path(tokenizer))
        packer = _Packer(TaskContext.get().partitionId(), capacity, cut, block, spare)
        end = np.zeros(1, "<u4")
        for ids, texts in text_batches(batches, (0, 1), 1, 2 << 20):
            for doc, text in zip(ids, texts):
                packer.add(doc, np.concatenate([encode(text or ""), end]))
            yield packer.batch(with_ids)
        packer.finish()
        yield packer.batch(with_ids)

    schema = _PIECE if with_ids else _PIECE.rsplit(", ", 1)[0]
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema))
