"""Document fingerprints by Order MinHash: sensitive to edits, and to the order of the text."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pick

K = 6                  # code points of a k-mer
PICKED = 2             # k-mers that one component selects
COMPONENTS = 64        # components of a signature
SEED = 1_729
CHUNK = 1 << 12        # k-mers ranked at once (bounded memory for long texts)
BUCKET_BYTES = 8 << 20   # text that one ordered range of documents should hold, at least
RANGES = 200_000         # ranges that a table is cut into, at most (of 500 MB each at 100 TB)
SAMPLED = 32             # sampled rows for each range, about, that place the bounds

_DRAW = np.random.default_rng(SEED)
_XOR = _DRAW.integers(0, 1 << 32, COMPONENTS, dtype=np.uint32)
_MUL = _DRAW.integers(0, 1 << 32, COMPONENTS, dtype=np.uint32) | np.uint32(1)
_ROWS = np.arange(COMPONENTS)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 32-bit values."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """A 32-bit hash for each k-mer together with its occurrence number (how many equal
    k-mers come before it), in text order. A text shorter than ``k`` is one k-mer."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32)
    k = min(k, n)
    h = np.full(n - k + 1, n if n < K else 0, np.uint32)
    for i in range(k):
        h = (h ^ points[i:i + len(h)]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    # equal k-mers next to each other, in text order
    order = np.sort((h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64))
    value, at = (order >> np.uint64(32)), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    nth = np.arange(len(h))
    first = np.concatenate([[True], value[1:] != value[:-1]])
    occurrence = np.zeros(len(h), np.uint32)
    occurrence[at] = nth - np.maximum.accumulate(np.where(first, nth, 0))
    return _mix(h + occurrence * np.uint32(0x85EBCA6B))


_RANKS = np.empty(COMPONENTS * CHUNK, np.uint32)  # reused: fresh pages cost more than the work


def _least(kmers: np.ndarray):
    """Of each component the positions of its ``PICKED`` least k-mers; ties go to the earlier."""
    values, places = [], []
    for s in range(0, len(kmers), CHUNK):
        part = kmers[s:s + CHUNK]
        ranks = _RANKS[:COMPONENTS * len(part)].reshape(COMPONENTS, len(part))
        np.bitwise_xor(part[None, :], _XOR[:, None], out=ranks)
        np.multiply(ranks, _MUL[:, None], out=ranks)
        for _ in range(min(PICKED, len(part))):
            at = ranks.argmin(axis=1)
            values.append(ranks[_ROWS, at])
            places.append(at + s)
            ranks[_ROWS, at] = np.uint32(0xFFFFFFFF)
    order = np.argsort(np.stack(values, axis=1), axis=1, kind="stable")[:, :PICKED]
    return np.stack(places, axis=1)[_ROWS[:, None], order]


def signature(points: np.ndarray, k: int = K) -> np.ndarray:
    """One 32-bit value for each component: the hash of the tuple of its least k-mers, which
    stand in the order in which the text has them. An empty text has the value zero."""
    kmers = numbered_kmers(points, k)
    if not len(kmers):
        return np.zeros(COMPONENTS, np.uint32)
    at = np.sort(_least(kmers), axis=1)
    out = np.full(COMPONENTS, at.shape[1], np.uint32)
    for j in range(at.shape[1]):
        out = _mix((out ^ kmers[at[:, j]]) * np.uint32(0x9E3779B1) + np.uint32(j))
    return out


def to_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components: estimates the edit similarity, 1 for equal texts."""
    return float((a == b).mean())


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half (rounded down) replaced by as much of the start of ``following``."""
    half = len(points) // 2
    return np.concatenate([points[:len(points) - half], following[:half]])


def signatures(docs: DataFrame, k: int = K) -> DataFrame:
    """``(doc_id, fingerprint)``, one row per document row; a null text counts as empty."""
    def run(batches):
        for b in batches:
            sigs = [to_hex(signature(code_points(t), k)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.string())],
                                             ["doc_id", "fingerprint"])
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, fingerprint string")


# -------------------------------------------------------------- next document
def _rows_in_order(batches):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)


def _compare_batches(k, most=512):
    """Rows (bucket, guest, doc_id, text) sorted by bucket, guest and order in it: each own
    row with the one after it; a bucket's guest (the first row after it) is not judged."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def out(rows):
        cols = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                 pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    def judged(doc, following):
        (doc_id, points, sig), (_, next_points, next_sig) = doc, following
        new = edited(points, next_points)
        new_sig = sig if np.array_equal(new, points) else signature(new, k)
        return (doc_id, len(points), hashlib.sha256(
            new.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        ).hexdigest(), to_hex(sig), to_hex(new_sig), likeness(sig, new_sig),
            likeness(sig, next_sig))

    def run(batches):
        rows, before, bucket, last = [], None, None, None
        for at, guest, doc_id, text in _rows_in_order(batches):
            if last is None or text != last[0]:
                points = code_points(text)
                last = (text, points, signature(points, k))
            here = (doc_id, *last[1:])
            if before is not None and at == bucket:
                rows.append(judged(before, here))
            before, bucket = (None if guest else here), at
            if len(rows) >= most:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)
    return run


def _bounds(rows: DataFrame, total: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``n - 1`` places ``(key, turn)`` that cut ``rows(key, turn, size)`` into ranges of
    about equal size. They hang on a sample that takes a row with a chance that grows with its
    size, so it holds at most about twice ``SAMPLED * n`` rows; where the bounds lie decides
    how even the tasks are, not what they return."""
    unit = max(1, total // (SAMPLED * n))          # each sampled row stands for so much, at least
    share = F.floor(F.least(F.col("size") / unit, F.lit(1.0)) * float(1 << 31))
    got = rows.where(F.pmod(F.xxhash64("key", "turn", "size"), F.lit(1 << 31)) < share).toArrow()
    key, turn, size = (got.column(c).to_numpy() for c in ("key", "turn", "size"))
    order = np.lexsort((turn, key))
    key, turn = key[order], turn[order]
    ends = np.cumsum(np.maximum(size[order], unit))
    at = np.searchsorted(ends, (ends[-1] / n) * np.arange(1, n)) if len(ends) else []
    at = np.unique(np.asarray(at, np.int64))
    return key[at], turn[at]


def _range_of(keys: np.ndarray, turns: np.ndarray):
    """Range i holds the rows from bound i - 1 up to below bound i, in the order of key, turn."""
    @F.pandas_udf("int")
    def at(key: pd.Series, turn: pd.Series) -> pd.Series:
        k, t = key.to_numpy(), turn.to_numpy()
        start, stop = np.searchsorted(keys, k, side="left"), np.searchsorted(keys, k, side="right")
        out, inside = start.copy(), np.flatnonzero(stop > start)     # of ids that bounds cut
        for first in np.unique(start[inside]).tolist():
            rows = inside[start[inside] == first]
            last = int(stop[rows[0]])
            out[rows] = first + np.searchsorted(turns[first:last], t[rows], side="right")
        return pd.Series(out.astype(np.int32))
    return at


def edit_neighbours(docs: DataFrame, k: int = K, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``, one row per document row.

    The next document is that of the next higher doc_id (after the last: the first). The
    table is cut into ranges of doc_id that hold about ``bucket_bytes`` of text each (more in
    tables that would need over ``RANGES`` ranges); whole texts move once, to the task of their
    range. The first row of a range is also sent, as a guest, to the range before it, so that
    every row finds its successor in its own range. Null ids come first; rows of one id follow
    each other by a hash of the text, and ranges may end among them, so that an id of very many
    rows spreads; rows equal in both lie in one range, are read as a stream and signed
    once. A table of one row is followed by itself. Null texts
    count as empty; a text of any length is signed whole; an empty table gives no rows; other
    columns are ignored.
    """
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"),
                                            F.coalesce(F.col("text").cast("string"), F.lit(""))
                                            .alias("text"))
    # ids in order, null before all
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    placed = d.select("doc_id", "text", key.alias("key"), F.xxhash64("text").alias("turn"))
    slim = placed.select("key", "turn", (F.length("text") + 1).cast("long").alias("size"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    n = max(1, min(RANGES, -(-total // bucket_bytes)))
    if n > 1:
        keys, turns = _bounds(slim, total, n)
        placed = placed.withColumn("bucket", _range_of(keys, turns)(F.col("key"), F.col("turn")))
        n = len(keys) + 1
    else:
        placed = placed.withColumn("bucket", F.lit(0))
    # the first row of each range, and the range that it follows (one row a range)
    firsts = [(r["bucket"], *r["first"]) for r in placed.groupBy("bucket").agg(
        F.min(F.struct("key", "turn")).alias("first")).orderBy("bucket").collect()]
    rows = placed.select("bucket", F.lit(False).alias("guest"), "doc_id", "text", "key", "turn")
    if firsts:
        # a range's first row visits the range before it (the very first one the last range)
        guests = [(at, k, t, firsts[i - 1][0]) for i, (at, k, t) in enumerate(firsts)]
        to = F.broadcast(docs.sparkSession.createDataFrame(
            guests, "_at int, _key long, _turn long, to int"))
        first = placed.join(to, (F.col("bucket") == F.col("_at")) & (F.col("key") == F.col("_key"))
                            & (F.col("turn") == F.col("_turn"))).groupBy(
            "to", "key", "turn").agg(F.min("text").alias("text"), F.min("doc_id").alias("doc_id"))
        rows = rows.unionByName(first.select(F.col("to").alias("bucket"),
                                             F.lit(True).alias("guest"), "doc_id", "text", "key",
                                             "turn"))
    return (rows.repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", "key", "turn", "text")
            .select("bucket", "guest", "doc_id", "text")
            .mapInArrow(_compare_batches(k), "doc_id long, n_chars long, edited_sha256 string, "
                        "fingerprint string, edited_fingerprint string, near_edited double, "
                        "near_next double"))
