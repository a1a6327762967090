"""Substring dedup: text that a repeated run of consecutive sentences covers is removed.

Sentences are cut further, by their words alone, so that an equal passage is cut alike wherever it
stands, inside a longer sentence too: what is hashed and removed are these units, not always whole
sentences.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import pick, positional, stored

RUN_SENTENCES = 3        # units of a run, at least
RUN_WORDS = 28           # words of a run, at least (it takes in more units until then)
WINDOW = 8               # of every so many words in a row, a unit ends after one at least

#: A sentence ends after . ! or ? before a blank, and at line ends.
_END = re.compile(r"[.!?]+[\"')\]]*\s+|\n\s*")
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])
#: Runs are hashed by a polynomial over their words' hashes, modulo 2^64; the inverse of its odd
#: base lets every run be read off from one sum along the text.
_BASE = 0x9E3779B97F4A7C17
_INVERSE = pow(_BASE, -1, 1 << 64)
_FORGET = 500_000        # words whose hashes a task remembers; beyond this it starts anew


class _WordHashes(dict):
    """Word: 64-bit hash."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = h
        return h


_HASHES = _WordHashes()
_POWERS = {b: np.ones(1, np.uint64) for b in (_BASE, _INVERSE)}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64 (remembered, doubled when too few)."""
    while len(_POWERS[base]) < n:
        have = _POWERS[base]
        step = np.uint64(pow(base, len(have), 1 << 64))
        _POWERS[base] = np.concatenate([have, have * step])
    return _POWERS[base][:n]


def _chosen(h: np.ndarray) -> np.ndarray:
    """The word of least hash (ties: the last) in each window of ``WINDOW`` words."""
    n = len(h) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    least, at = h[:n].copy(), np.arange(n)
    for s in range(1, WINDOW):
        lower = np.flatnonzero(h[s:s + n] <= least)
        least[lower] = h[lower + s]
        at[lower] = lower + s
    return np.unique(at)


def cut(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (lower-cased), and for each unit its end in the text and the number of
    words up to there. A unit ends where a sentence ends, and after each word that has the
    least hash of any ``WINDOW`` words in a row, whatever the sentence's length. Whether a word
    does hangs on the ``WINDOW`` - 1 words before and after it only, and no unit is longer than
    ``WINDOW`` words (but at the text's ends)."""
    if len(_HASHES) > _FORGET:
        _HASHES.clear()
    words = text.lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.ones(len(codes) + 1, bool)
    inside[0] = False
    low = codes < len(_SPACE)
    inside[1:][low] = ~_SPACE[codes[low]]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.append(starts[1:], len(text)) if len(starts) else starts
    bounds = np.unique(np.concatenate([
        np.array([m.end() for m in _END.finditer(text)], np.int64), ends[_chosen(h)],
        [len(text)]]))
    bounds = bounds[bounds > 0]
    return h, bounds, np.searchsorted(ends, bounds, side="right")


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """``(start, end, key, words)`` of each unit of :func:`cut`; the spans cover the text. The
    key is the unit in lower case with single blanks."""
    _, bounds, upto = cut(text)
    words, out, at, first = text.lower().split(), [], 0, 0
    for end, last in zip(bounds.tolist(), upto.tolist(), strict=True):
        out.append((at, end, " ".join(words[first:last]), last - first))
        at, first = end, last
    return out


def runs(text: str, least: int = RUN_SENTENCES, words: int = RUN_WORDS):
    """``(ends, hashes, first, last)``: the units' ends, and for every unit that a run can start
    with the shortest run of ``least`` or more units with ``words`` or more words: the hash of
    its words, and the numbers of its first and last unit. Units without a word (blank lines)
    belong to no run."""
    none = np.zeros(0, np.int64)
    h, bounds, upto = cut(text)
    if len(h) < words:
        return bounds, none, none, none
    before = np.concatenate([[0], upto[:-1]])
    own = np.flatnonzero(upto > before)
    start, end = before[own], upto[own]
    last = np.maximum(np.arange(len(own)) + least - 1, np.searchsorted(end, start + words))
    whole = last < len(own)
    start, last = start[whole], last[whole]
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum(h * _powers(_INVERSE, len(h)), dtype=np.uint64)])
    found = (sums[end[last]] - sums[start]) * _powers(_BASE, len(h) + 1)[start]
    return bounds, found.view(np.int64), own[:len(start)], own[last]


_RUN = pa.struct([("h", pa.int64()), ("i", pa.int32()), ("j", pa.int32())])


def _unit_batches(least, words, most=1 << 20):
    """``(doc_id, tag, ends, runs)`` of each text that has runs."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()),
                        ("ends", pa.list_(pa.int32())), ("runs", pa.list_(_RUN))])

    def lists(parts, values):
        sizes = np.cumsum([0, *map(len, parts)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(sizes), values)

    def batch(rows):
        ids, tags, ends, h, i, j = zip(*rows, strict=True)
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(h)), pa.array(np.concatenate(i).astype(np.int32)),
             pa.array(np.concatenate(j).astype(np.int32))], fields=list(_RUN))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(tags, pa.int64()),
             lists(ends, pa.array(np.concatenate(ends).astype(np.int32))), lists(h, flat)],
            schema=schema)

    def run(batches):
        rows, load = [], 0
        for b in batches:
            ids, tags, texts = (b.column(i) for i in range(3))
            for k in range(len(b)):
                text = texts[k].as_py()
                found = runs(text, least, words) if text else ((), ())
                if not len(found[1]):
                    continue
                rows.append((ids[k].as_py(), tags[k].as_py(), *found))
                load += len(found[0]) + len(found[1])
                if load >= most:
                    yield batch(rows)
                    rows, load = [], 0
        if rows:
            yield batch(rows)
    return run


def _cut_batches(at):
    """The columns up to the text and beyond, the texts cut; behind them come spans and ends."""
    def run(batches):
        for b in batches:
            texts, gone = [], []
            old = b.column(at)
            for k, (spans, ends) in enumerate(zip(b.column(len(b.columns) - 2).to_pylist(),
                                                  b.column(len(b.columns) - 1).to_pylist(),
                                                  strict=True)):
                text = old[k].as_py()
                drop = {u for s in spans or () for u in range(s["i"], s["j"] + 1)}
                if drop:
                    text = "".join(text[s:e] for u, (s, e) in enumerate(zip([0, *ends], ends))
                                   if u not in drop)
                texts.append(text)
                gone.append(len(drop))
            cols = list(b.columns[:-2])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(gone, pa.int64())],
                                             [*[f"_c{i}" for i in range(len(cols))],
                                              "n_removed"])
    return run


def remove_repeated_spans(docs: DataFrame, least: int = RUN_SENTENCES,
                          words: int = RUN_WORDS) -> DataFrame:
    """``docs`` (all columns), with ``text`` less every unit that a repeated run covers, and one
    more column ``n_removed``: how many units those were.

    A unit is a sentence, or the part of one between two words that :func:`cut` chooses (a
    sentence of 21 words has about five). Every run of consecutive units is hashed (64 bits)
    and met with all others. Its first occurrence, by doc_id, text and place, stays; units that
    any other occurrence covers go. A run that repeats inside one text counts too. Rows
    without an id come last. Documents are told apart by id and text, so rows that share
    both count as one document, and rows that share an id only are cut each by its own spans. Null
    texts stay null; texts shorter than a run are unchanged; a text of any length is cut
    once, whole; an empty table stays empty.

    Each text is cut once: its units' ends and its runs are stored as arrays, from which both
    sides of the join are read. A run shared by very many documents is one row after the partial
    aggregate; the join back is a plain sort-merge join, whose hot side adaptive execution
    splits.
    """
    extra = "n_removed"
    while extra in docs.columns:
        extra += "_"
    flat, name = positional(docs)
    text, doc_id = name["text"], F.col(name["doc_id"]).cast("long")
    tag = F.xxhash64(text)
    units = stored(flat.select(doc_id.alias("doc_id"), tag.alias("tag"),
                               F.col(text).alias("text")).mapInArrow(
        _unit_batches(least, words), "doc_id long, tag long, ends array<int>, "
        "runs array<struct<h:long,i:int,j:int>>"), "units")
    found = units.select("doc_id", "tag", F.inline("runs"))
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "tag", "i")
    first = (found.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("h").alias("_h"), "first"))
    # a table of its own: else the join would share the aggregate's stage, and a hot run
    # could not be split
    first = stored(first, "repeated")
    spans = (found.join(first, F.col("h") == F.col("_h")).where(place != F.col("first"))
             .groupBy("doc_id", "tag").agg(F.collect_set(F.struct("i", "j")).alias("spans")))
    spans = stored(spans, "spans")
    ends = units.groupBy(F.col("doc_id").alias("_d"), F.col("tag").alias("_t")).agg(
        F.any_value("ends").alias("ends"))
    later = spans.join(ends, F.col("doc_id").eqNullSafe(F.col("_d"))
                       & (F.col("tag") == F.col("_t"))).select("_d", "_t", "spans", "ends")
    joined = flat.withColumn("_tag", tag).join(
        later, doc_id.eqNullSafe(F.col("_d")) & (F.col("_tag") == F.col("_t")), "left")
    schema = T.StructType([*flat.schema, T.StructField("n_removed", T.LongType())])
    done = joined.select(*flat.columns, "spans", "ends").mapInArrow(
        _cut_batches(flat.columns.index(text)), schema)
    return done.toDF(*docs.columns, extra)


def dedup_documents(docs: DataFrame, **rules) -> DataFrame:
    """``(doc_id, text, n_removed)`` of ``remove_repeated_spans``."""
    return remove_repeated_spans(pick(docs, "doc_id", "text"), **rules)
