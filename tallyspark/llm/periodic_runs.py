"""Periodic runs of words, found by recursive frequency splitting.

A run is a stretch of consecutive words that repeats with a smallest period ``q``, is at least
``max(LEAST, 3 * q)`` words long, and cannot be made longer by a neighbouring word. A word of a
run occurs three times in it at least. So a word that occurs less often within its segment is in
no run, and splits the segment; the parts are counted anew, until no word of any part is rare.
What is left is scanned lag by lag: words that equal the word ``q`` further on, for a stretch of
at least ``max(LEAST, 3 * q) - q``, are a run of period ``q`` unless a smaller one fits.

Texts are handled where they are read, one at a time; nothing is shuffled. Memory grows with the
longest single text: about 60 bytes for each of its words beside the text.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pick

WORD = re.compile("[^ \t-\r]+")
LEAST, TIMES = 24, 3
#: Words compared around a match before it is followed further (at most half of the shortest
#: stretch of equal words that any run has).
NEAR = 8


def segments(words: np.ndarray) -> list[tuple[int, int]]:
    """The parts ``[start, end)`` that can hold runs: in each, every word occurs often enough."""
    stable, todo = [], [(0, len(words))]
    while todo:
        start, end = todo.pop()
        if end - start < LEAST:
            continue
        _, which, counts = np.unique(words[start:end], return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[which] < TIMES) + start
        if not len(cuts):
            stable.append((start, end))
            continue
        edges = np.concatenate([[start - 1], cuts, [end]])
        long = np.flatnonzero(np.diff(edges) > LEAST)
        todo += [(int(edges[i]) + 1, int(edges[i + 1])) for i in long]
    return sorted(stable)


def _stretch(period):
    """The fewest consecutive words that equal the word a period further on, in any run."""
    return np.maximum(LEAST, TIMES * period) - period


def _probes(w: np.ndarray, most: int):
    """``(period, place)`` of equal words ``period`` apart, at every place that is a multiple of
    the shortest stretch of that period: each run has at least one. Ascending by period."""
    n, found = len(w), []
    few = min(most, max(LEAST // TIMES, int(n ** 0.5)))
    for q in range(1, few + 1):                      # short periods: many places each
        at = np.arange(0, n - q, int(_stretch(q)))
        at = at[w[at] == w[at + q]]
        found.append((np.full(len(at), q), at))
    periods = np.arange(few + 1, most + 1)
    step = _stretch(periods)
    for k in range(n // int(_stretch(few + 1)) + 1):  # long periods: few places, all periods
        at = k * step
        periods = periods[:int(np.searchsorted(at + periods, n))]
        step, at = step[:len(periods)], at[:len(periods)]
        if not len(periods):
            break
        same = w[at] == w[at + periods]
        found.append((periods[same], at[same]))
    q, at = (np.concatenate(x) for x in zip(*found, strict=True))
    # at least NEAR equal words lie on one side of the place
    side = np.zeros(len(q), bool)
    for sign in (-1, 1):
        all_same = np.ones(len(q), bool)
        for d in range(1, NEAR):
            i = at + sign * d
            ok = (i >= 0) & (i + q < n)
            i = np.where(ok, i, 0)
            all_same &= ok & (w[i] == w[np.where(ok, i + q, 0)])
        side |= all_same
    q, at = q[side], at[side]
    order = np.lexsort((at, q))
    return zip(q[order].tolist(), at[order].tolist(), strict=True)


def _same_for(w: np.ndarray, at: int, q: int, sign: int) -> int:
    """How many words from ``at`` on (or back, ``sign`` -1) equal the word ``q`` further on."""
    n, size, done = len(w), 64, 0
    while True:
        if sign > 0:
            a, b = at + done, min(at + done + size, n - q)
            diff = w[a:b] != w[a + q:b + q]
        else:
            b, a = at - done + 1, max(at - done - size + 1, 0)
            diff = (w[a:b] != w[a + q:b + q])[::-1]
        if len(diff) <= 0:
            return done
        first = int(diff.argmax())
        if diff[first]:
            return done + first
        done += len(diff)
        size *= 4


def _scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of one segment, every word given as a number."""
    runs: dict[tuple[int, int], int] = {}      # (start, end): smallest period
    by_start: list[tuple[int, int, int]] = []  # (start, end, period) in order
    reached = (0, -1)                          # the last stretch that was followed: period, end
    for q, at in _probes(w, len(w) // TIMES):
        if reached[0] == q and at < reached[1]:
            continue
        # inside a known run of a period that divides q, the stretch is that run again
        i = bisect_right(by_start, (at, len(w), 0)) - 1
        if i >= 0 and (known := by_start[i])[1] >= at + q and q % known[2] == 0:
            continue
        start = at - _same_for(w, at, q, -1) + 1
        stop = at + _same_for(w, at, q, 1)
        reached = (q, stop)
        if stop - start < _stretch(q):
            continue
        end = stop + q
        if (start, end) not in runs:
            runs[start, end] = q
            i = bisect_right(by_start, (start, end, q))
            by_start.insert(i, (start, end, q))
    return [(s, e - s, q) for (s, e), q in runs.items()]


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a list of words, by start, then period."""
    if len(words) < LEAST:
        return []
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    found = []
    for start, end in segments(ids):
        found += [(start + s, length, q) for s, length, q in _scan(ids[start:end])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that any run holds after its first period."""
    if not runs:
        return " ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return " ".join(words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist())


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                            ("period", pa.int64())]))
_BATCH_CHARS = 4 << 20


def _batches(batches):
    schema = None
    for b in batches:
        schema = schema or pa.schema([("doc_id", b.schema.field("doc_id").type),
                                      ("runs", _RUNS), ("collapsed_text", pa.string())])
        ids, texts = b.column("doc_id"), b.column("text")
        runs, kept, load, first = [], [], 0, 0
        for i in range(len(b)):
            words = WORD.findall(texts[i].as_py() or "")
            found = runs_of(words)
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            kept.append(collapsed(words, found))
            load += len(kept[-1])
            if load > _BATCH_CHARS or i + 1 == len(b):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, i + 1 - first), pa.array(runs, _RUNS),
                     pa.array(kept, pa.string())], schema=schema)
                runs, kept, load, first = [], [], 0, i + 1


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, runs, collapsed_text)`` for every row of ``docs`` (doc_id, text; other columns
    are ignored): all runs of the whole text by start, then period, as an array of ``(start,
    length, period)`` in words, and the words that no run drops, joined by single spaces.

    A null, empty or blank text has no runs and an empty collapsed text. A text of any length is
    read whole. Repeated rows each give a row; an empty table gives none. Runs may overlap; two
    runs of one stretch cannot differ, as only the smallest period counts.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return pick(docs, "doc_id", "text").mapInArrow(
        _batches, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, "
        "collapsed_text string")


def planted(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with a period planted in some texts, as a test does: with ``h =
    crc32(doc_id)``, ``g = h div 10``, where ``h % 10 = 0`` and there are ``n > 0`` words, each
    word ``i >= a = g % n`` becomes the original word ``a + (i - a) % p``, ``p = 1 + (n - a) div
    (3 + g % 8)``. Other texts, also those without a doc_id, stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n, a, p = F.col("_words"), F.size("_words"), F.col("_a"), F.col("_p")
    d = pick(docs, "doc_id", "text").withColumn("_g", F.floor(h / 10)).withColumn(
        "_words", F.when(h % 10 == 0, F.regexp_extract_all(
            "text", F.lit(r"[^\x20\x09-\x0D]+"), 0)))
    d = d.withColumn("_a", (F.col("_g") % F.greatest(n, F.lit(1))).cast("int")).withColumn(
        "_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p),
                                    F.ceil((n - a) / p).cast("int")))
    new = F.array_join(F.concat(F.slice(words, 1, a), F.slice(tail, 1, n - a)), " ")
    return d.select("doc_id", F.when(n > 0, new).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """One row per document: the number of its runs, the run of greatest exact length/period
    (ties: smallest start, then period), and SHA-256 hashes of all runs and of the collapsed
    text, after periods have been planted by :func:`planted`."""
    found = periodic_runs(planted(docs))
    # length/period of two runs compared exactly: as whole numbers, by cross-multiplication
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r)
        .otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))
