"""Bounded-space online packing of documents into training sequences."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save
from .tokens import byte_encoder, slices

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary"
FIELDS = [x.split(" ")[0] for x in SCHEMA.split(", ")]
TYPES = [pa.binary() if x.endswith("binary") else pa.int64() for x in SCHEMA.split(", ")]
FAN_IN = 32


class Packer:
    """A fixed number of open windows; a document's rest goes where it leaves the least room.

    Where none has room for it, the fullest window is topped up with a piece of
    it and emitted, so emitted windows are full.
    """

    def __init__(self, window: int, open_windows: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.open: list[list] = [[] for _ in range(open_windows)]
        self.fill = [0] * open_windows
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, offset, None, None))
            offset += n
        self.next += 1

    def add(self, doc: int, start: int, ids: bytes, total: int) -> None:
        while ids:
            n = len(ids) // 4
            if n >= self.window:
                cut = 4 * self.window
                self.emit([(doc, start, ids[:cut], total)])
                ids, start = ids[cut:], start + self.window
                continue
            fits = [k for k, f in enumerate(self.fill) if f + n <= self.window]
            k = max(fits or range(len(self.fill)), key=self.fill.__getitem__)
            n = min(n, self.window - self.fill[k])
            self.open[k].append((doc, start, ids[: 4 * n], total))
            self.fill[k] += n
            ids, start = ids[4 * n :], start + n
            if self.fill[k] == self.window:
                self.emit(self.open[k])
                self.open[k], self.fill[k] = [], 0

    def left(self) -> list[tuple]:
        """The pieces of the windows still open, fullest first."""
        order = sorted(range(len(self.fill)), key=lambda k: -self.fill[k])
        return [x for k in order for x in self.open[k]]

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], FIELDS)


def _over(pieces: list[tuple], part: int) -> list[tuple]:
    return [(doc, start, len(ids) // 4, None, total, None, k, part, ids) for k, (doc, start, ids, total) in enumerate(pieces)]


def _merge(level: int, last: bool, window: int):
    """Fill windows from the leftovers of a few parts in turn; hand on what is less than a window."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        group = key[0].as_py()
        t = t.sort_by([("part", "ascending"), ("offset", "ascending")])
        packer = Packer(window, 1, (level << 56) + (group << 32))
        for doc, start, ids, total in zip(*(t[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True):
            packer.add(doc, start, ids, total)
        left = packer.left()
        if not last:
            return pa.Table.from_batches([_batch(packer.taken() + _over(left, group))])
        size = packer.fill[0]
        while size:  # the very last ids: sequences of a power of two need no padding
            room = 1 << (size.bit_length() - 1)
            size -= room
            tail = Packer(room, 1, packer.next)
            while room:
                doc, start, ids, total = left.pop(0)
                n = min(room, len(ids) // 4)
                tail.open[0].append((doc, start, ids[: 4 * n], total))
                room -= n
                if len(ids) > 4 * n:
                    left.insert(0, (doc, start + n, ids[4 * n :], total))
            tail.emit(tail.open[0])
            packer.rows += tail.taken()
            packer.next = tail.next
        return pa.Table.from_batches([_batch(packer.taken())])

    return run


def pack(df: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, open_windows: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole texts into sequences of at most ``window`` ids.

    One row per piece: ``doc_id``, ``start`` (the document's ids before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (in its
    sequence, gapless from 0).  Every id, ``end_id`` after each text included,
    lies in exactly one piece.

    Each partition of the input packs its own rows as they come, with
    ``open_windows`` open windows and nothing else in memory.  What is left open
    at the end (less than that many windows) is merged over groups of 32
    partitions at a time, until one group is left; its last ids make sequences
    of a power of two.  So every sequence has ``window`` ids, or a power of two.

    A null or empty text is the end id alone.  Rows that repeat an id are
    documents of their own.  Rows with a null id are left out.  An empty table
    gives an empty result.  Extra columns are ignored.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        packer = Packer(window, open_windows, part << 32)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                for doc, coded in zip(ids[a:b], byte_encoder(tokenizer_path).encode(texts[a:b]), strict=True):
                    packer.add(doc, 0, coded + end, len(coded) // 4 + 1)
                yield _batch(packer.taken())
        yield _batch(_over(packer.left(), part))

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    step = save(rows.mapInArrow(run, SCHEMA), "pack-0")
    pieces, level = step.where("sequence_id is not null"), 1
    left = step.where("sequence_id is null")
    parts = left.agg(F.max("part")).first()[0]
    while parts is not None:
        groups = parts // FAN_IN
        step = save(left.groupBy(F.expr(f"part div {FAN_IN}").alias("group")).applyInArrow(_merge(level, groups == 0, window), SCHEMA), f"pack-{level}")
        pieces = pieces.unionByName(step.where("sequence_id is not null"))
        left, level, parts = step.where("sequence_id is null"), level + 1, groups or None
    return pieces.drop("part", "ids")
