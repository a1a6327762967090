"""Bounded-space online packing of documents into token sequences of one length.

Each partition keeps a fixed number of open windows. A document's ids (its text's, then an end
id) fill whole windows first; the rest is placed best-fit: into the open window that it leaves
the least room in. When none fits, the fullest is emitted: room for at most ``pad`` ids is padded,
more is filled with the beginning of the piece, whose end is placed anew. At last the leftovers
are merged: the windows still open are poured together, first in each partition, then those
of ``FAN_IN`` partitions at a time, round by round, until one window is left. It is cut into
sequences whose lengths are powers of two, which need no padding.

Open windows hold their ids, so that a merge can cut them; every other piece is only a row of
numbers. Memory of a task: ``open_windows`` windows, and the encoder's own (``bpe_index``).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.bpe_index import Encoder, text_groups, vocabulary
from tallyspark.llm.common import pick, stored

WINDOW, OPEN_WINDOWS, PAD = 2048, 64, 8
END_ID = 1
#: Partitions whose last windows are merged by one task.
FAN_IN = 8
#: A sequence's number: the round that emitted it (0: while reading), the task, a counter.
_ROUND_BITS, _TASK_BITS = 58, 30


class Packer:
    """Open windows and the pieces emitted from them. A piece is ``(doc, start, ids, doc_tokens)``
    with ``doc`` anything that names the document."""

    def __init__(self, first_id: int, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
                 pad: int = PAD):
        self.window, self.pad, self.next_id = window, pad, first_id
        self.pieces: dict[int, list] = {i: [] for i in range(open_windows)}
        self.room = [(window, i) for i in range(open_windows)]      # in order
        self.out: list[tuple] = []

    def _emit(self, pieces: list):
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, ids, total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray):
        """One document: whole windows at once, the rest by best fit."""
        total = len(ids)
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self._emit([(doc, start, ids[start:start + self.window], total)])
        if whole < total:
            self.place((doc, whole, ids[whole:].copy(), total))

    def place(self, piece: tuple):
        """A piece of at most a window."""
        while True:
            doc, start, ids, total = piece
            i = bisect_left(self.room, (len(ids), -1))
            if i < len(self.room):
                room, w = self.room.pop(i)
                self.pieces[w].append(piece)
                self._reopen(w, room - len(ids))
                return
            room, w = self.room.pop(0)                # none fits: the fullest goes
            if room > self.pad:
                self.pieces[w].append((doc, start, ids[:room], total))
                piece = (doc, start + room, ids[room:], total)
            self._reopen(w, 0)

    def _reopen(self, w: int, room: int):
        if not room:
            self._emit(self.pieces[w])
            self.pieces[w], room = [], self.window
        insort(self.room, (room, w))

    def pour(self) -> list:
        """Merges all open windows, fullest first, cutting pieces where a window is full: whole
        windows are emitted, the pieces of the last one are returned."""
        held, room = [], self.window
        for _, w in self.room:
            for doc, start, ids, total in self.pieces[w]:
                while len(ids) >= room:
                    self._emit([*held, (doc, start, ids[:room], total)])
                    start, ids, held, room = start + room, ids[room:], [], self.window
                if len(ids):
                    held.append((doc, start, ids, total))
                    room -= len(ids)
        self.pieces, self.room = {}, []
        return held

    def finish(self, held: list):
        """The last window of all, as sequences whose lengths are powers of two."""
        todo, left = list(reversed(held)), sum(len(p[2]) for p in held)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            mine = []
            while size:
                doc, start, ids, total = todo.pop()
                if len(ids) > size:
                    todo.append((doc, start + size, ids[size:], total))
                    ids = ids[:size]
                mine.append((doc, start, ids, total))
                size -= len(ids)
            self._emit(mine)


_COLUMNS = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
            ("task", pa.int64()), ("ids", pa.binary())]


def _batch(doc_type, done: list, held: list, task: int, with_ids: bool):
    """Emitted pieces, and those of the last window (no sequence, but their ids)."""
    rows = [(doc, start, len(ids), zlib.crc32(raw := ids.astype("<u4").tobytes()), total, seq,
             at, task, raw if with_ids else None) for doc, start, ids, total, seq, at in done]
    rows += [(doc, start, len(ids), None, total, None, at, task, ids.astype("<u4").tobytes())
             for at, (doc, start, ids, total) in enumerate(held)]
    schema = pa.schema([("doc_id", doc_type), *_COLUMNS])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema) if rows else pa.RecordBatch.from_arrays(
        [pa.array([], f.type) for f in schema], schema=schema)


def _pack_batches(path, window, open_windows, pad, end_id, with_ids):
    def run(batches):
        task = TaskContext.get().partitionId()
        packer = Packer(task << _TASK_BITS, window, open_windows, pad)
        enc, end, doc_type = Encoder(vocabulary(path)), np.array([end_id], np.uint32), pa.int64()
        for b in batches:
            doc_type = b.schema.field("doc_id").type
            ids = b.column("doc_id").to_pylist()
            for off, texts in text_groups(b.column("text")):
                for doc, packed in zip(ids[off:off + len(texts)], enc.encode(texts),
                                       strict=True):
                    packer.add(doc, np.concatenate([np.frombuffer(packed, np.uint32), end]))
                yield _batch(doc_type, packer.out, [], task, with_ids)
                packer.out = []
        held = packer.pour()
        yield _batch(doc_type, packer.out, held, task, with_ids)
    return run


def _merge_group(level, last, window, with_ids):
    def run(table):
        rows = sorted(table.to_pylist(), key=lambda r: (r["task"], r["offset"]))
        task = rows[0]["task"] // FAN_IN
        packer = Packer((level << _ROUND_BITS) + (task << _TASK_BITS), window, 1)
        packer.pieces[0] = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"),
                             r["doc_tokens"]) for r in rows]
        held = packer.pour()
        if last:
            packer.finish(held)
            held = []
        return pa.Table.from_batches([_batch(table.schema.field("doc_id").type, packer.out,
                                             held, task, with_ids)])
    return run


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW,
                   open_windows: int = OPEN_WINDOWS, pad: int = PAD, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)``, one row per
    piece: ``start`` counts the document's ids before it, ``offset`` those before it in its
    sequence. ``docs`` has doc_id and text; other columns are ignored. ``path`` names the
    vocabulary on every node. ``ids`` holds the piece's ids as little-endian 32-bit integers, if
    asked for (else null).

    A null or empty text is one end id. Repeated rows and repeated doc_ids are packed each. A
    text of any length is packed whole. An empty table has no pieces.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, task long, ids binary")
    table = stored(pick(docs, "doc_id", "text").mapInArrow(
        _pack_batches(path, window, open_windows, pad, end_id, with_ids), schema), "pieces")
    done, level = [table.where("sequence_id is not null")], 0
    tasks = table.where("sequence_id is null").agg(F.max("task")).first()[0]
    while tasks is not None:
        level, tasks = level + 1, tasks // FAN_IN
        table = table.where("sequence_id is null").withColumn(
            "to", F.floor(F.col("task") / FAN_IN)).groupBy("to")
        table = stored(_without_key(table, _merge_group(level, tasks == 0, window, with_ids),
                                    schema), f"merged{level}")
        done.append(table.where("sequence_id is not null"))
        if tasks == 0:
            break
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.drop("task")


def _without_key(grouped, fn, schema):
    return grouped.applyInArrow(lambda t: fn(t.drop_columns(["to"])), schema)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the sequences of pieces packed ``with_ids``, each one
    array of ids, padded to ``window`` unless its length is a power of two. A sequence has at
    most ``window`` pieces, so a group is small."""
    def join(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["offset"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]).astype(np.int32)
        n = len(ids)
        if n & (n - 1):
            ids = np.concatenate([ids, np.full(window - n, pad_id, np.int32)])
        return pa.table({"sequence_id": pa.array([rows[0]["sequence_id"]], pa.int64()),
                         "n_tokens": pa.array([n], pa.int64()),
                         "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})
    return pick(pieces, "sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        join, "sequence_id long, n_tokens long, ids array<int>")


def packed_pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of all documents without their ids."""
    return pack_documents(docs, path).drop("ids")
