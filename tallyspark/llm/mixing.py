"""Mixing sources to target weights: soft domain membership and nonnegative document rates."""

from __future__ import annotations

import warnings
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import linear
from tallyspark.llm.common import pick, positional, stored

PER_DOMAIN = 3_000       # labelled rows of each domain that fit the classifier (bound)
DIMENSIONS = 1 << 15     # buckets that the words of all texts are hashed to
LEAST_EVIDENCE = 0.05    # of a word that all domains have alike
ITERATIONS = 40
STEPS = 60               # scaled gradient steps, at most
RIDGE = 1e-6             # weight of changing the rates, beside missing the targets
TOLERANCE = 1e-4         # relative miss of a domain's target at which the steps end
DECIMALS = 3             # of a posterior: equal ones share a row while rates are fitted

#: Target share of the token total for each domain.
TARGETS = {"clean": 0.90, "junk": 0.04, "toxic": 0.06}
SYMBOLS = "#*$%&|<>"


def domains_of(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from the label table: toxic, else clean or junk by quality. Rows
    without an id or with a null label are left out; of several the least name counts."""
    return (pick(labels, "doc_id", "quality", "toxic")
            .where("doc_id is not null and quality is not null and toxic is not null")
            .select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(
                F.col("quality") == 1, "clean").otherwise("junk").alias("domain"))
            .groupBy("doc_id").agg(F.min("domain").alias("domain")))


# -------------------------------------------------------------------- classifier
def features(text: str | None) -> tuple[Counter, int]:
    """Lower-case words with their counts, a few signs of the whole text, and its length in
    words (the tokens that the targets count)."""
    text = text or ""
    words = text.split()
    n = len(words)
    found = Counter(text.lower().split())
    distinct = len(found)
    upper = sum(map(str.isupper, words))
    symbols = sum(map(text.count, SYMBOLS))
    for name, hit in (("\0shouting", upper > n / 2), ("\0symbols", symbols > n / 4),
                      ("\0repeats", distinct < n / 3), ("\0short", n < 20), ("\0any", True)):
        if hit:
            found[name] = 1
    return found, n


class DomainModel:
    """Posteriors of the domains, from all words of a text, hashed to buckets. A bucket counts by
    its ``value`` (so that a few telling words outweigh common ones); rows have norm one."""

    def __init__(self, domains: list[str], value: np.ndarray, weights: np.ndarray):
        self.domains, self.value, self.weights = domains, value, weights
        self.known: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        at = self.known.get(word)
        if at is None:
            if len(self.known) > 200_000:
                self.known.clear()
            at = self.known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % len(
                self.value)
        return at

    def values(self, idx: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Values of the words of many rows that lie one after another."""
        val = self.value[idx]
        ends = np.cumsum(sizes)
        squares = np.concatenate([[0.0], np.cumsum(val * val)])
        norms = np.sqrt(np.maximum(squares[ends] - squares[ends - sizes], 1e-12))
        return val / np.repeat(norms, sizes)

    def row(self, found) -> np.ndarray:
        return np.unique(np.fromiter(map(self.bucket, found), np.int32, len(found)))

    def posteriors(self, texts) -> tuple[np.ndarray, list[int]]:
        rows, tokens = [], []
        for t in texts:
            found, n = features(t)
            rows.append(self.row(found))
            tokens.append(n)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        idx = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
        p = linear.softmax(linear.scores(sizes, idx, self.values(idx, sizes), self.weights))
        return _rounded(p), tokens


def _rounded(p: np.ndarray) -> np.ndarray:
    """Posteriors in steps of 10 ** -DECIMALS that still add up to one."""
    unit = 10 ** DECIMALS
    q = np.floor(p * unit).astype(np.int64)
    q[np.arange(len(q)), p.argmax(axis=1)] += unit - q.sum(axis=1)
    return q / unit


def learn_domains(docs: DataFrame, domains: DataFrame, names: list[str],
                  per_domain: int = PER_DOMAIN, dimensions: int = DIMENSIONS) -> DomainModel:
    """Softmax regression on a bounded labelled sample (the ids of least hash of each domain;
    they are sent to the readers). All words of a text count, each bucket by its rarity in the
    sample and by how differently the domains have it: ``idf * (LEAST_EVIDENCE + ln(1 +
    chi2)^2)``. Classes weigh as often as they occur among the labels, so posteriors keep
    the labels' shares."""
    shares = {r["domain"]: r["count"] for r in domains.groupBy("domain").count().collect()}
    sample = None
    for d in names:
        part = domains.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
            per_domain)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.withColumnRenamed("doc_id", "_id")
    held = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    model = DomainModel(names, np.ones(dimensions), np.zeros((dimensions, len(names))))

    def bags_of(batches):
        for b in batches:
            bags = [model.row(features(t)[0]) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array(bags, pa.list_(pa.int32()))], ["domain", "idx"])

    bags = stored(held.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
                  .select("text", "domain").mapInArrow(bags_of, "domain string, idx array<int>"),
                  "bags")
    sizes = {r["domain"]: r["count"] for r in bags.groupBy("domain").count().collect()}
    n = sum(sizes.values())
    if not n:
        return model
    # at most one row per bucket
    seen = bags.select("domain", F.explode("idx").alias("i")).groupBy("i").agg(*[
        F.count_if(F.col("domain") == d).alias(f"n_{k}") for k, d in enumerate(names)]).toArrow()
    with_it = np.zeros((dimensions, len(names)))
    with_it[seen.column("i").to_numpy()] = np.stack(
        [seen.column(f"n_{k}").to_numpy() for k in range(len(names))], axis=1)
    all_with = with_it.sum(axis=1)
    want = all_with[:, None] * np.array([sizes.get(d, 0) for d in names]) / n
    chi2 = (np.square(with_it - want) / np.where(want > 0, want, 1.0)).sum(axis=1)
    model.value = np.log((n + 1) / np.maximum(all_with, 1)) * (
        LEAST_EVIDENCE + np.square(np.log1p(chi2)))
    model.value[model.bucket("\0any")] = 1.0
    total = sum(shares.get(d, 0) for d in names) or 1
    weight = {d: (shares.get(d, 0) / total) / (sizes[d] / n) for d in sizes}

    def rows(batches):
        for b in batches:
            sizes, flat = linear.pack(b.column("idx"))
            val = pa.array(model.values(flat.astype(np.int64), sizes))
            want = [[weight[d] if d == x else 0.0 for x in names]
                    for d in b.column("domain").to_pylist()]
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())),
                 pa.ListArray.from_arrays(ends, val),
                 pa.array(want, pa.list_(pa.float64()))], ["idx", "val", "want"])

    fitted = stored(bags.mapInArrow(rows, "idx array<int>, val array<double>, want array<double>"),
                    "rows")
    model.weights = linear.fit(fitted, dimensions, len(names), ITERATIONS)
    return model


# -------------------------------------------------------------------------- rates
def rates(p: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """A row's rate: one, moved against the gradients gathered so far (``pull`` per unit of
    posterior), projected to zero or more. It depends on the posteriors only, so no rate
    has to be stored between the steps."""
    return np.maximum(0.0, 1.0 - p @ pull)


def _total_batches(pull, domains):
    def run(batches):
        out = np.zeros(1 + domains + domains * domains)
        for b in batches:
            p = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(domains)], 1)
            n = b.column(domains).to_numpy(zero_copy_only=False)
            r = rates(p, pull)
            overlap = (p * (n * (r > 0))[:, None]).T @ p
            out += np.concatenate([[(n * r * r).sum() / 2], (r * n) @ p, overlap.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))],
                                         ["sums"])
    return run


def fit_rates(members: DataFrame, targets: dict[str, float], budget: float = 1.0,
              max_steps: int = STEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Least squares over the domains by lazily projected gradient steps: minimise the
    squared misses of the expected token totals (and, with weight ``RIDGE``, the squared
    change of the rates) over nonnegative rates, from rates of one. Returns ``pull``.

    ``members(p_0.., n_tokens)``: posteriors and tokens. Rows of equal posteriors are added
    up first. Each step is one distributed sum: a total for each domain, and the overlap of
    the domains over the rows whose rate is above zero, which scales the gradient so that
    domains that are hard to tell apart do not slow it down. A step that overshoots is
    halved. The steps end when every domain is within ``tolerance`` of the whole of its
    target, or stand still at the least squares of a target that no rates meet. If they do
    neither within ``max_steps``, a ``RuntimeWarning`` names every domain's miss.
    """
    d = len(targets)
    cols = [f"p_{i}" for i in range(d)]
    cells = stored(members.groupBy(*cols).agg(F.sum("n_tokens").cast("double").alias("n")), "cells")
    whole = cells.agg(F.sum("n")).first()[0] or 0.0
    pull = np.zeros(d)
    if whole <= 0:
        return pull
    want = np.array(list(targets.values()))
    want = want / want.sum() * budget
    parts = cells.select(*cols, "n")

    def sums(at):
        got = parts.mapInArrow(_total_batches(at, d), "sums array<double>").select(
            *[F.col("sums")[i].alias(f"s_{i}") for i in range(1 + d + d * d)]).agg(
            *[F.sum(f"s_{i}") for i in range(1 + d + d * d)]).first()
        x = np.array([v or 0.0 for v in got]) / whole
        return x[0] + at @ want + RIDGE / 2 * at @ at, x[1:d + 1] - want, x[d + 1:].reshape(d, d)

    height, miss, overlap = sums(pull)
    step = None
    for _ in range(max_steps):
        if np.abs(miss).max() <= tolerance:
            break
        slope = miss - RIDGE * pull
        if step is None:
            step = np.linalg.solve(overlap + RIDGE * np.eye(d), slope)
        if np.abs(step).max() <= 1e-9 * (1 + np.abs(pull).max()):
            break
        new = sums(pull + step)
        if new[0] <= height - 1e-4 * slope @ step or slope @ step < 1e-14:
            settled = slope @ step < 1e-14
            pull, (height, miss, overlap), step = pull + step, new, None
            if settled:
                break
        else:
            step = step / 2
    else:
        if np.abs(miss).max() > tolerance:
            left = ", ".join(f"{n} {m:+.6f}" for n, m in zip(targets, miss, strict=True))
            warnings.warn(f"rates did not settle in {max_steps} steps; shares of the token total "
                          f"off their targets: {left}", RuntimeWarning, stacklevel=2)
    return pull


def _member_batches(sent, domains):
    names = ["doc_id", *[f"p_{i}" for i in range(domains)], "n_tokens", "u"]

    def run(batches):
        m = sent.value
        for b in batches:
            p, n = m.posteriors(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(p[:, i]) for i in range(domains)],
                 pa.array(n, pa.int64()), b.column(2)], names)
    return run


def _draw(doc_id, text):
    """A number in [0, 1) for a row, from its id (or its text if it has none)."""
    h = F.when(doc_id.isNotNull(), F.xxhash64(doc_id, F.lit("mix"))).otherwise(
        F.xxhash64(text, F.lit("mix")))
    return F.pmod(h, F.lit(1 << 53)) / float(1 << 53)


def _rate_batches(pull, domains):
    def run(batches):
        for b in batches:
            p = np.stack([b.column(1 + i).to_numpy(zero_copy_only=False) for i in range(domains)],
                         1)
            r = rates(p, pull)
            u = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            copies = np.floor(r).astype(np.int64) + (u < r - np.floor(r))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1 + domains), *[b.column(1 + i) for i in range(domains)],
                 pa.array(r), pa.array(copies)],
                ["doc_id", "n_tokens", *[f"p_{i}" for i in range(domains)], "rate", "copies"])
    return run


def _members(docs, labels, targets, **learning):
    names = list(targets)
    model = learn_domains(docs, domains_of(labels), names, **learning)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    cols = ", ".join(f"p_{i} double" for i in range(len(names)))
    return stored(d.select("doc_id", "text", _draw(F.col("doc_id"), F.col("text")).alias("u"))
                  .mapInArrow(_member_batches(sent, len(names)),
                              f"doc_id long, {cols}, n_tokens long, u double"), "members"), sent


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
        budget: float = 1.0, **learning) -> DataFrame:
    """``(doc_id, n_tokens, p_<domain>..., rate, copies)``, one row per document row.

    ``rate`` is how often the document should occur, so that the expected tokens of each
    domain match ``targets`` of ``budget`` times the present total; ``copies`` is the rate
    rounded down or up at random (by a hash of the id), right on average. Null and empty
    texts have no tokens and the posteriors of an empty text; a text of any length counts whole,
    one at a time. Repeated rows get equal values.
    Without labels all posteriors are equal. An empty table gives no rows.
    """
    members, _ = _members(docs, labels, targets, **learning)
    pull = fit_rates(members, targets, budget)
    names = list(targets)
    cols = ", ".join(f"p_{i} double" for i in range(len(names)))
    out = members.mapInArrow(_rate_batches(pull, len(names)),
                             f"doc_id long, n_tokens long, {cols}, rate double, copies long")
    return out.toDF("doc_id", "n_tokens", *[f"p_{d}" for d in names], "rate", "copies")


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
                    budget: float = 1.0, **learning) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as ``mix`` says. Rates are applied
    where the rows are read, without a join."""
    members, sent = _members(docs, labels, targets, **learning)
    pull = fit_rates(members, targets, budget)
    flat, name = positional(docs)
    columns = flat.columns
    at = columns.index(name["text"])

    def run(batches):
        m = sent.value
        for b in batches:
            p, _ = m.posteriors(b.column(at).to_pylist())
            r = rates(p, pull)
            u = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            copies = np.floor(r).astype(np.int64) + (u < r - np.floor(r))
            take = pa.array(np.repeat(np.arange(b.num_rows), copies))
            yield pa.RecordBatch.from_arrays(
                [c.take(take) for c in b.columns[:-1]], columns)

    drawn = flat.withColumn("_u", _draw(F.col(name["doc_id"]).cast("long"), F.col(name["text"])))
    return drawn.mapInArrow(run, T.StructType(flat.schema.fields)).toDF(*docs.columns)
