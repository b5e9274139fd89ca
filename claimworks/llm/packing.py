"""Packing of documents into sequences of fixed length, online and in bounded space.

Each partition is one stream. A fixed number of windows is open; a piece goes to the window it
fits best (the smallest gap that holds it). When no window holds it, the fullest one is topped up
with the head of the piece, if its gap is at least ``cut_from`` ids, and emitted. Documents longer
than a sequence fill whole sequences first. At the end of the stream the open windows are merged,
so that at most one part-filled window per partition is left; these are merged in groups of
``fan`` partitions, and groups of groups, until one is left for the whole table.

Memory is that of the open windows and one input batch. A sequence's number is made of the round,
the partition and a counter. Defined results: a null or empty text is the end id alone; null and
repeated keys are packed like others; an empty table gives no pieces. Only key and text are read.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import written
from claimworks.llm.tokens import WordIds

_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, part long, is_open boolean, ids binary")
_NAMES = [c.split()[0] for c in _PIECE.split(", ")]
_TYPES = pa.schema([(n, pa.bool_() if n == "is_open" else pa.binary() if n == "ids" else pa.int64())
                    for n in _NAMES])
_caches: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's cache for a vocabulary file; workers are used again for many tasks."""
    if path not in _caches:
        _caches[path] = WordIds(path)
    return _caches[path]


class _Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        return (_Piece(self.doc, self.start, self.ids[:4 * n], self.total),
                _Piece(self.doc, self.start + n, self.ids[4 * n:], self.total))


class Packer:
    """The stream of one partition. Finished rows gather in ``rows`` until they are taken."""

    def __init__(self, capacity: int, windows: int, cut_from: int, round_no: int, part: int, keep_ids: bool):
        self.capacity, self.windows, self.cut_from = capacity, windows, max(1, cut_from)
        self.part, self.next, self.keep_ids = part, (round_no << 56) + (part << 32), keep_ids
        self.open: list[list] = []  # [ids so far, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[_Piece], is_open: bool = False) -> None:
        at = 0
        for p in pieces:
            self.rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, self.next, at,
                              self.part, is_open, p.ids if is_open or self.keep_ids else None))
            at += len(p)
        self.next += 1

    def add(self, piece: _Piece) -> None:
        while len(piece) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            self.emit([head])
        while len(piece):
            fits = [w for w in self.open if w[0] + len(piece) <= self.capacity]
            if fits:
                best = max(fits, key=lambda w: w[0])
                best[0] += len(piece)
                best[1].append(piece)
                if best[0] == self.capacity:
                    self.open.remove(best)
                    self.emit(best[1])
                return
            if len(self.open) < self.windows:
                self.open.append([len(piece), [piece]])
                return
            fullest = max(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            gap = self.capacity - fullest[0]
            if gap >= self.cut_from:
                head, piece = piece.cut(gap)
                fullest[1].append(head)
            self.emit(fullest[1])

    def merge(self, pieces, last: bool) -> None:
        """Lay pieces end to end; what does not fill a sequence stays open unless it is the last."""
        now, filled = [], 0
        for piece in pieces:
            while len(piece):
                head, piece = piece.cut(min(len(piece), self.capacity - filled))
                now.append(head)
                filled += len(head)
                if filled == self.capacity:
                    self.emit(now)
                    now, filled = [], 0
        if now:
            self.emit(now, is_open=not last)

    def close(self) -> None:
        left, self.open = sorted(self.open, key=lambda w: -w[0]), []
        self.merge((p for w in left for p in w[1]), last=False)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _TYPES)], schema=_TYPES)


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", *, capacity: int = 2048,
         windows: int = 32, cut_from: int = 8, end_id: int = 1, fan: int = 64, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents: where each lies in its document and in which sequence.

    ``keep_ids`` adds the ids themselves as little-endian unsigned 32-bit words, for writing the
    sequences; their checksum is always there.
    """
    end = end_id.to_bytes(4, "little")

    def stream(batches):
        packer = Packer(capacity, windows, cut_from, 0, TaskContext.get().partitionId(), keep_ids)
        cache = word_ids(vocabulary)
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = cache.encode(body.as_py() or "") + end
                packer.add(_Piece(doc, 0, ids, len(ids) // 4))
                if len(packer.rows) >= 4096:
                    yield packer.take()
        packer.close()
        yield packer.take()

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    done = written(plain.mapInArrow(stream, _PIECE), "packed")
    parts, round_no = done, 0
    while True:
        left = parts.filter("is_open")
        most = left.agg(F.max("part")).first()[0]
        if most is None:
            break
        round_no += 1
        last = most < fan
        parts = written(_merged(left, capacity, fan, round_no, last, keep_ids), "merged")
        done = done.filter("NOT is_open").unionByName(parts.filter("NOT is_open")) if round_no == 1 else \
            done.unionByName(parts.filter("NOT is_open"))
        if last:
            break
    return done.filter("NOT is_open").drop("part", "is_open", *([] if keep_ids else ["ids"]))


def _merged(left: DataFrame, capacity: int, fan: int, round_no: int, last: bool, keep_ids: bool) -> DataFrame:
    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        rows = group.to_pylist()
        packer = Packer(capacity, 0, 1, round_no, rows[0]["part"] // fan, keep_ids)
        packer.merge((_Piece(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in rows), last)
        return pa.Table.from_batches([packer.take()])

    group = F.floor(F.col("part") / F.lit(fan))
    return left.groupBy(group.alias("of")).applyInArrow(merge, _PIECE)
