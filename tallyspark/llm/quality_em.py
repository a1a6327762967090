"""Quality classifier from weak labels: EM over heuristic labellers, then a hashed linear scorer."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import linear
from tallyspark.llm.common import pick, stored

DIMENSIONS = 1 << 14      # buckets of the hashed features
SAMPLE = 5_000            # rows of each side (likely good, likely bad) that fit the scorer (bound)
KEEP_AT = 0.5             # score from which a document is kept
ITERATIONS = 25
SYMBOLS = "#*$%&|<>"
_TOKEN = re.compile(r"\w+|[^\w\s]+")


# --------------------------------------------------------------------- labellers
_RUN = re.compile("[#*$%&|<>]+")


def measures(text: str | None) -> dict[str, float]:
    """What the labellers look at."""
    text = text or ""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    return {
        "n": len(words), "letters": sum(map(len, words)), "distinct": len(set(words)),
        "symbols": sum(map(text.count, SYMBOLS)), "runs": len(_RUN.findall(text)),
        "upper": sum(map(str.isupper, words)), "again": sum(map(eq, words, words[1:])),
        "short": sum(len(w) <= 3 for w in words), "ends": sum(map(text.count, ".!?")),
        "shouts": text.count("!"), "lines": len(lines), "dup_lines": len(lines) - len(set(lines)),
    }


def _share(part, whole, good_to, bad_from, least=5):
    """Good up to one share, bad from another on; no opinion between, or on few."""
    if whole < least:
        return None
    return 1 if part <= good_to * whole else 0 if part >= bad_from * whole else None


#: Overlapping heuristics. Each votes 1 (good), 0 (bad) or None (no opinion).
LABELLERS = {
    "symbols": lambda m: _share(m["symbols"], m["n"], 0.08, 0.3),
    "symbol_runs": lambda m: _share(m["runs"], m["n"], 0.08, 0.25),
    "symbol_letters": lambda m: _share(m["symbols"], m["letters"], 0.02, 0.06, 20),
    "upper_words": lambda m: _share(m["upper"], m["n"], 0.25, 0.5),
    "exclaims": lambda m: _share(m["shouts"], m["n"], 0.1, 0.3),
    "distinct": lambda m: _share(m["n"] - m["distinct"], m["n"], 0.6, 0.8, 20),
    "again": lambda m: _share(m["again"], m["n"], 0.1, 0.4),
    "dup_lines": lambda m: _share(m["dup_lines"], m["lines"], 0.2, 0.45, 4),
    "sentences": lambda m: _share(m["n"], max(m["ends"], 1), 40, 150, 1) if m["n"] >= 30 else None,
    "word_length": lambda m: _share(m["letters"], m["n"], 10, 14),
}


def votes(text: str | None) -> int:
    """All votes in one number: base-3 digits, 0 for bad, 1 for good, 2 for no opinion."""
    m, code = measures(text), 0
    for f in LABELLERS.values():
        v = f(m)
        code = code * 3 + (2 if v is None else v)
    return code


def digits(codes: np.ndarray, n: int) -> np.ndarray:
    return np.stack([codes // 3 ** (n - 1 - i) % 3 for i in range(n)], axis=1)


@dataclass
class LabelModel:
    """Chance of each opinion given the true class: ``table[labeller, class, vote]``. Having
    no opinion says nothing about the class."""

    share: float
    table: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        d = digits(codes, len(self.table))
        logs = np.log(np.array([1 - self.share, self.share]))[None, :].repeat(len(d), 0)
        for i, t in enumerate(self.table):
            known = np.log(np.hstack([t, np.ones((2, 1))]))
            logs = logs + known[:, d[:, i]].T
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)

    def accuracies(self) -> dict[str, float]:
        """Chance that a labeller is right when it has an opinion."""
        prior = np.array([1 - self.share, self.share])
        return {name: float(prior @ np.diag(t)) for name, t in zip(LABELLERS, self.table,
                                                                   strict=False)}


def expectation_maximisation(codes: np.ndarray, counts: np.ndarray, labellers: int,
                             rounds: int = 200, smooth: float = 1.0) -> LabelModel:
    """Dawid-Skene over distinct vote patterns and their counts. It starts from the belief
    that bad votes are rarely wrong (no bad vote: 0.95 good; else 1 / (1 + 2 x bad votes)),
    which also fixes which class is the good one."""
    d = digits(codes, labellers)
    bad = (d == 0).sum(axis=1)
    p = np.where(bad == 0, 0.95, 1 / (1.0 + 2 * bad))
    model, before = None, None
    for _ in range(rounds):
        mass = np.stack([(1 - p) * counts, p * counts])
        table = np.empty((labellers, 2, 2))
        for i in range(labellers):
            for c in range(2):
                table[i, c] = np.bincount(d[:, i], mass[c], 3)[:2] + smooth
                table[i, c] /= table[i, c].sum()
        share = float(np.clip((mass[1].sum() + smooth) / (counts.sum() + 2 * smooth), 1e-6,
                              1 - 1e-6))
        model = LabelModel(share, table)
        p = model.posterior(codes)
        if before is not None and np.abs(p - before).max() < 1e-7:
            break
        before = p
    return model


# ------------------------------------------------------------------------ scorer
class Hasher:
    """Hashed features of a text: words and punctuation runs, and a few whole-text signs.
    Values are damped counts, scaled to norm 1."""

    def __init__(self, dim: int = DIMENSIONS):
        self.dim, self.known = dim, {}

    def _bucket(self, token: str) -> int:
        at = self.known.get(token)
        if at is None:
            if len(self.known) > 200_000:
                self.known.clear()
            at = self.known[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.dim
        return at

    def __call__(self, text: str | None):
        tokens = _TOKEN.findall(text or "")
        found = Counter(tokens)
        n = len(tokens)
        found["\0upper"] = sum(map(str.isupper, tokens))
        found["\0again"] = n - len(found) + 1
        found["\0short"] = int(n < 50) * 20
        found["\0any"] = 20
        at = np.fromiter(map(self._bucket, found), np.int32, len(found))
        val = np.log1p(np.fromiter(found.values(), np.float64, len(found)))
        return at, val / np.linalg.norm(val)


def _vote_batches(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(list(map(votes, b.column(1).to_pylist())), pa.int64())],
            ["doc_id", "votes"])


def _feature_batches(dim):
    def run(batches):
        hasher = Hasher(dim)
        for b in batches:
            rows = [hasher(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at for at, _ in rows], pa.list_(pa.int32())),
                 pa.array([v for _, v in rows], pa.list_(pa.float64())), b.column(1)],
                ["idx", "val", "want"])
    return run


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray

    def score(self, at, val) -> float:
        z = val @ (self.weights[at, 1] - self.weights[at, 0])
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def learn(docs: DataFrame, sample: int = SAMPLE, dim: int = DIMENSIONS) -> QualityModel:
    """Votes of all documents are counted by pattern (at most 3 ** labellers rows reach the
    driver, however many documents there are); EM runs over the counts. The posterior of
    its pattern is a document's soft label. The scorer is fitted to a bounded sample: the
    ``sample`` ids of least hash among the likely good and among the likely bad, weighted
    back to the shares of the corpus."""
    spark = docs.sparkSession
    held = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    voted = stored(held.mapInArrow(_vote_batches, "doc_id long, votes long"), "votes")
    seen = voted.groupBy("votes").count().orderBy("votes").collect()
    codes = np.array([r["votes"] for r in seen], np.int64)
    counts = np.array([r["count"] for r in seen], float)
    n = len(LABELLERS)
    if not len(codes):
        return QualityModel(LabelModel(0.5, np.full((n, 2, 2), 0.5)), np.zeros((dim, 2)))
    labels = expectation_maximisation(codes, counts, n)
    soft = labels.posterior(codes)
    likely = F.broadcast(spark.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, soft, strict=True)], "votes long, p double"))
    known = voted.where("doc_id is not null").join(likely, "votes")
    share = {True: float(counts[soft >= 0.5].sum()), False: float(counts[soft < 0.5].sum())}
    ids = None
    for side in (True, False):
        part = known.where((F.col("p") >= 0.5) == side).groupBy("doc_id").agg(
            F.min("p").alias("p")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        weight = F.lit(share[side] / max(1.0, min(sample, share[side])))
        part = part.select(F.col("doc_id").alias("_id"),
                           F.array((1 - F.col("p")) * weight, F.col("p") * weight).alias("want"))
        ids = part if ids is None else ids.unionByName(part)
    rows = held.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("text", "want")
    rows = stored(rows.mapInArrow(_feature_batches(dim),
                                  "idx array<int>, val array<double>, want array<double>"), "rows")
    return QualityModel(labels, linear.fit(rows, dim, 2, ITERATIONS))


def classify(docs: DataFrame, keep_at: float = KEEP_AT, **learning) -> DataFrame:
    """``(doc_id, score, kept)``, one row per document row: the chance that it is good.

    Learned without any given label. Null texts count as empty, and are scored like any
    other; a text of any length is voted on and scored whole; repeated rows score alike; an
    empty table gives no rows. Other columns are ignored.
    """
    model = learn(docs, **learning)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    dim = len(model.weights)

    def run(batches):
        m, hasher = sent.value, Hasher(dim)
        for b in batches:
            s = [m.score(*hasher(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())],
                                             ["doc_id", "score"])

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double").withColumn("kept", F.col("score") >= keep_at)
