"""Toxicity by nearest labelled examples: exact cosine of plain TF-IDF over all terms of the
examples, by posting lists and block maxima. What the classes tell about a term counts in the
neighbours' votes only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import crc_fold, pick, stored

PER_CLASS = 4_000        # labelled rows of each class that shape and fill the index (bound)
BLOCK = 64               # examples of a block of the index
LONG_LIST = 8            # a term of more than 1/8 of the examples has its postings in full rows
TOGETHER = 256           # texts that are searched together
NEIGHBOURS = 50
LEAST_EVIDENCE = 0.05    # of a shared term that both classes have alike
PRIOR_WEIGHT = 0.5       # weight of the class share beside the neighbours' votes
TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").lower())


# ------------------------------------------------------------------------- index
@dataclass
class Sparse:
    """Rows of (column, value), one after another; row i is ``start[i]:start[i + 1]``."""

    start: np.ndarray
    at: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> "Sparse":
        start = np.cumsum([0, *[len(at) for at, _ in rows]])
        return cls(start, np.concatenate([np.zeros(0, np.int32), *[at for at, _ in rows]]),
                   np.concatenate([np.zeros(0, np.float32), *[v for _, v in rows]]))

    def spans(self, rows: np.ndarray):
        """Places of all entries of the rows, and how many each row has."""
        n = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(n)
        return np.arange(ends[-1] if len(n) else 0) + np.repeat(self.start[rows] - (ends - n), n), n

    def turned(self, columns: int) -> "Sparse":
        """The same entries by column, the rows of each column in order."""
        order = np.argsort(self.at, kind="stable")
        row = np.repeat(np.arange(len(self.start) - 1, dtype=np.int32), np.diff(self.start))
        return Sparse(np.concatenate([[0], np.cumsum(np.bincount(self.at, minlength=columns))]),
                      row[order], self.value[order])


class BlockMaxIndex:
    """Examples as unit vectors in posting lists by term, and in blocks.

    A list of up to 1/8 of the examples is scored posting by posting. The longer lists (most
    of the work) are kept in full rows, block by block, with the largest weight that any
    example of the block gives to the term: what a block's examples have from the short lists,
    and the query's sum over these maxima, bound their cosines. Blocks are opened in falling
    order of the bounds until the next bound is below the k-th best cosine: the result is
    exact. ``unseen`` is the idf of a term that no example has (it lengthens the query)."""

    def __init__(self, vocab: dict[str, int], idf: np.ndarray, examples: np.ndarray | Sparse,
                 toxic: np.ndarray, weight: np.ndarray, ids: list, block: int = BLOCK,
                 unseen: float = 0.0, evidence: np.ndarray | None = None):
        self.vocab, self.idf, self.block, self.unseen = vocab, idf, block, unseen
        self.evidence = np.ones(len(idf)) if evidence is None else evidence
        if isinstance(examples, np.ndarray):
            examples = Sparse.of([(np.flatnonzero(x).astype(np.int32), x[x != 0])
                                  for x in examples])
        rows = [(examples.at[s:e], examples.value[s:e])
                for s, e in zip(examples.start[:-1], examples.start[1:], strict=True)]
        # like examples share blocks: ordered by their heaviest term, then by id
        order = np.argsort([at[v.argmax()] if len(at) else -1 for at, v in rows], kind="stable")
        order = order.astype(int)
        self.rows = Sparse.of([rows[i] for i in order])
        self.toxic, self.weight = toxic[order], weight[order]
        self.ids = [ids[i] for i in order]
        self.size = len(order)
        self.postings = self.rows.turned(len(idf))
        n_blocks = -(-self.size // block)
        long = np.flatnonzero(np.diff(self.postings.start) * LONG_LIST > self.size)
        self.column = np.full(len(idf), -1)
        self.column[long] = np.arange(len(long))
        self.full = np.zeros((n_blocks * block, len(long)), np.float32)
        at, n = self.postings.spans(long)
        self.full[self.postings.at[at], np.repeat(np.arange(len(long)), n)] = (
            self.postings.value[at])
        # for the votes: the same rows, each term's weight times its evidence
        self.telling = self.full * self.evidence[long].astype(np.float32)
        self.maxima = np.zeros((len(long), n_blocks), np.float32)
        for b in range(n_blocks):
            self.maxima[:, b] = self.full[b * block:(b + 1) * block].max(axis=0)

    @property
    def examples(self) -> np.ndarray:
        """The examples in one matrix (for tests)."""
        out = np.zeros((self.size, len(self.idf)), np.float32)
        out[np.repeat(np.arange(self.size), np.diff(self.rows.start)), self.rows.at] = (
            self.rows.value)
        return out

    def vector(self, words: list[str]):
        """Numbers, in order, and weights of a text's terms that examples have. The weights are
        those of the unit vector of all its terms."""
        found = Counter(words)
        at = np.fromiter(map(self.vocab.get, found, repeat(-1)), np.int64, len(found))
        tf = 1 + np.log(np.fromiter(found.values(), np.float64, len(found)))
        known = at >= 0
        beyond = np.square(tf[~known] * self.unseen).sum()
        at, tf = at[known], tf[known]
        order = np.argsort(at)
        at = at[order]
        w = tf[order] * self.idf[at]
        norm = np.sqrt(w @ w + beyond)
        return at, (w / (norm or 1.0)).astype(np.float32)

    def search_together(self, queries: list, k: int = NEIGHBOURS) -> list[tuple]:
        """For each ``(at, w)`` the ``k`` examples of highest cosine above zero (ties: the
        earlier), their cosines, and the number of blocks whose long lists were opened."""
        return [x[:3] for x in self.evident_search(queries, k)]

    def evident_search(self, queries: list, k: int = NEIGHBOURS) -> list[tuple]:
        """:meth:`search_together`, and behind it each neighbour's cosine with every shared
        term's part times the term's evidence."""
        if not self.size:
            none = np.zeros(0, np.float32)
            return [(np.zeros(0, np.int64), none, 0, none) for _ in queries]
        n_blocks, block = self.maxima.shape[1], self.block
        short = np.zeros((len(queries), n_blocks * block), np.float32)  # of the short lists
        told_short = np.zeros_like(short)
        asked = np.zeros((len(queries), len(self.maxima)), np.float32)
        for q, (at, w) in enumerate(queries):
            column = self.column[at]
            is_long = column >= 0
            asked[q, column[is_long]] = w[is_long]
            places, n = self.postings.spans(at[~is_long])
            if len(places):
                row = self.postings.at.take(places, mode="clip").astype(np.intp)
                part = self.postings.value.take(places, mode="clip")
                part *= np.repeat(w[~is_long], n)
                short[q] = np.bincount(row, part, short.shape[1])
                part *= np.repeat(self.evidence[at[~is_long]].astype(np.float32), n)
                told_short[q] = np.bincount(row, part, short.shape[1])
        sums = short.copy()
        bounds = sums.reshape(len(queries), n_blocks, block).max(axis=2) + asked @ self.maxima

        def open_blocks(mask):
            for b in np.flatnonzero(mask.any(axis=0)):
                own, part = np.flatnonzero(mask[:, b]), slice(b * block, (b + 1) * block)
                sums[own, part] += asked[own] @ self.full[part].T

        lead = min(-(-k // block) + 1, n_blocks)
        first = np.argsort(-bounds, axis=1, kind="stable")[:, :lead]
        opened = np.zeros(bounds.shape, bool)
        np.put_along_axis(opened, first, True, axis=1)
        opened &= bounds > 0
        open_blocks(opened)
        # the k-th best so far; float sums of one bound and one cosine can differ in their
        # last digits
        led = np.take_along_axis(sums.reshape(len(queries), n_blocks, block),
                                 first[:, :, None], axis=1).reshape(len(queries), -1)
        least = np.zeros(len(queries), np.float32)
        if led.shape[1] >= k:
            least = np.partition(led, led.shape[1] - k, axis=1)[:, -k] - 1e-5
        rest = ~opened & (bounds >= least[:, None]) & (bounds > 0)
        open_blocks(rest)
        out = []
        for q in range(len(queries)):
            where = np.flatnonzero((sums[q] >= least[q]) & (sums[q] > 0))
            if len(where) > k:
                near = sums[q, where]
                where = where[near >= np.partition(near, len(near) - k)[-k] - 1e-5]
            # the long lists of those few once more, in an order that no other query has a part
            # in; the short lists' sums are the query's own
            column = np.flatnonzero(asked[q])
            at = where[:, None] * asked.shape[1] + column
            w = asked[q, column]
            cos = short[q, where] + (self.full.take(at) * w).sum(axis=1)
            told = told_short[q, where] + (self.telling.take(at) * w).sum(axis=1)
            best = np.lexsort((where, -cos))[:k]
            best = best[cos[best] > 0]
            out.append((where[best], cos[best], int(opened[q].sum() + rest[q].sum()),
                        told[best]))
        return out

    def search(self, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS):
        return self.search_together([(at, w)], k)[0]

    def vote(self, where, told, prior: float, prior_weight: float = PRIOR_WEIGHT) -> float:
        """Share of toxic among the neighbours, weighted by their closeness in terms that tell the
        classes apart (``told``); the prior weighs in."""
        near = np.square(told) * self.weight[where]
        return float((near @ self.toxic[where] + prior_weight * prior)
                     / (near.sum() + prior_weight))


@dataclass
class Model:
    index: BlockMaxIndex
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self, vote: float) -> float:
        z = np.log((vote + 1e-3) / (1 - vote + 1e-3))
        return float(1 / (1 + np.exp(-(self.slope * z + self.shift))))


def calibrate(votes: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Slope and shift of a logistic curve over the votes' log-odds (Newton steps, softened
    targets, so that separable votes stay finite)."""
    z = np.log((votes + 1e-3) / (1 - votes + 1e-3))
    up, down = weight[y == 1].sum(), weight[y == 0].sum()
    want = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(h, x.T @ (weight * (p - want)) + 1e-3 * (beta - [1.0, 0.0]))
        beta = beta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


# ---------------------------------------------------------------------- learning
def _bag_batches(batches):
    for b in batches:
        bags = [Counter(terms(t)) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array([list(x) for x in bags], pa.list_(pa.string())),
             pa.array([list(x.values()) for x in bags], pa.list_(pa.int32()))],
            ["doc_id", "toxic", "terms", "counts"])


def labelled_bags(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``(doc_id, toxic, terms, counts)`` of a bounded sample of the rows to learn from.

    Only ids whose fold is not 0 are eligible; of each class the ``per_class`` ids with the
    least hash are taken. The sample's ids are sent to the readers (at most twice
    ``per_class`` of them), so documents do not move to be matched. An id with several
    labels counts by the highest; nulls are left out.
    """
    eligible = (pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
                .where(crc_fold("doc_id") != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = None
    for c in (0, 1):
        part = eligible.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
            per_class)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.withColumnRenamed("doc_id", "_id")
    held = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return held.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select(
        "doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        _bag_batches, "doc_id long, toxic int, terms array<string>, counts array<int>")


def _count_batches(sent):
    def run(batches):
        vocab = sent.value
        counts, rows = np.zeros(len(vocab), np.int64), 0
        for b in batches:
            texts = b.column(0).to_pylist()
            rows += len(texts)
            for i in range(0, len(texts), TOGETHER):
                # behind the last place: terms that the vocabulary lacks
                at = np.fromiter(chain.from_iterable(
                    map(vocab.get, set(terms(t)), repeat(len(vocab)))
                    for t in texts[i:i + TOGETHER]), np.int64)
                counts += np.bincount(at, minlength=len(vocab) + 1)[:-1]
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(counts[at], rows))],
            ["i", "n"])
    return run


def document_frequencies(docs: DataFrame, vocab: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many rows of the whole table each term occurs, and the number of rows."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    got = (pick(docs, "text").mapInArrow(_count_batches(sent), "i int, n long")
           .groupBy("i").agg(F.sum("n").alias("n")).toArrow())
    at, n = got.column("i").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(len(vocab), np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Term weights, index and calibration from a bounded labelled sample.

    Every term of every sampled row is in the index. Its weight is its idf, from the document
    frequencies that Spark counts over the whole table. Its evidence, for the votes, is
    ``LEAST_EVIDENCE + ln(1 + chi2) ^ 2``, where chi2 says how well its presence tells the
    sample's classes apart. Every sampled row is an example; equal vectors become one example with a share of
    toxic rows. Half of the sample's rows (by a hash of the id) are examples while the curve is
    fitted on the votes for the other half; then all rows become examples.
    """
    bags = stored(labelled_bags(docs, labels, per_class), "bags").dropDuplicates(["doc_id"])
    totals = {r["toxic"]: r["n"] for r in bags.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    known = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(
        crc_fold("doc_id") != 0).agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    prior = float(known or 0.0)
    if not n0 or not n1:
        return Model(BlockMaxIndex({}, np.zeros(0), np.zeros((0, 0), np.float32), np.zeros(0),
                                   np.zeros(0), []), prior)
    n = n0 + n1
    found = (bags.select("toxic", F.explode("terms").alias("t")).groupBy("t").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        .toArrow().sort_by("t"))  # at most the terms of the sample's rows
    vocab = {t: i for i, t in enumerate(found.column("t").to_pylist())}
    a, b = (found.column(c).to_numpy().astype(float) for c in ("a", "b"))
    chi2 = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / (
        float(n0) * n1 * (a + b) * (n - a - b + 1e-9))
    frequency, whole = document_frequencies(docs, vocab)
    idf = np.log((2 + whole) / (1 + frequency))
    evidence = LEAST_EVIDENCE + np.square(np.log1p(chi2))
    unseen = float(np.log((2 + whole) / (1 + whole / n)))  # as rare as one row of the sample
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def project(batches):
        own = sent.value
        for x in batches:
            rows = [sorted((own[t], c) for t, c in zip(ts, cs, strict=True))
                    for ts, cs in zip(x.column("terms").to_pylist(),
                                      x.column("counts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [x.column("doc_id"), x.column("toxic"),
                 *[pa.array([np.array([e[i] for e in r], np.int32).tobytes() for r in rows],
                            pa.binary()) for i in (0, 1)]],
                ["doc_id", "toxic", "at", "tf"])

    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    rows = (bags.mapInArrow(project, "doc_id long, toxic int, at binary, tf binary")
            .groupBy("at", "tf", half).agg(
                F.min("doc_id").alias("id"), F.count_if(F.col("toxic") == 1).alias("a"),
                F.count_if(F.col("toxic") == 0).alias("b"))
            .orderBy("id").collect())  # at most the sample's rows
    # sampled rows of a class stand for all of its class
    w1 = prior / n1 if n1 else 0.0
    w0 = (1 - prior) / n0 if n0 else 0.0

    def unit(at: bytes, tf: bytes):
        at = np.frombuffer(at, np.int32)
        v = (1 + np.log(np.frombuffer(tf, np.int32).astype(float))) * idf[at]
        return at, (v / (np.linalg.norm(v) or 1.0)).astype(np.float32)

    def build(part) -> BlockMaxIndex:
        merged: dict = {}
        for r in part:
            m = merged.setdefault((bytes(r["at"]), bytes(r["tf"])), [r["id"], 0, 0])
            m[0], m[1], m[2] = min(m[0], r["id"]), m[1] + r["a"], m[2] + r["b"]
        toxic = [x * w1 / (x * w1 + y * w0) for _, x, y in merged.values()]
        weight = [1 + np.log(x + y) for _, x, y in merged.values()]
        return BlockMaxIndex(vocab, idf, Sparse.of([unit(*key) for key in merged]),
                             np.array(toxic), np.array(weight), [m[0] for m in merged.values()],
                             unseen=unseen, evidence=evidence)

    trial = build([r for r in rows if r["half"] == 0])
    votes, y, weight = [], [], []
    asked = [r for r in rows if r["half"] == 1]
    for i in range(0, len(asked), TOGETHER):
        part = asked[i:i + TOGETHER]
        for r, (where, _, _, told) in zip(part, trial.evident_search(
                [unit(r["at"], r["tf"]) for r in part]), strict=True):
            vote = trial.vote(where, told, prior)
            for label, count, w in ((1, r["a"], w1), (0, r["b"], w0)):
                if count:
                    votes.append(vote)
                    y.append(label)
                    weight.append(count * w * n)
    model = Model(build(rows), prior)
    if {0, 1} <= set(y):
        model.slope, model.shift = calibrate(np.array(votes), np.array(y), np.array(weight))
    return model


# ----------------------------------------------------------------------- scoring
def score_documents(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """``(doc_id, held_out, score, predicted, neighbours, cosines)``, one row per document row.

    ``held_out``: the id's fold is 0, so its label was not learned from (null for a null id).
    ``neighbours`` and ``cosines`` are the evidence: ids of the nearest examples. A text
    that shares no term with any example, an empty or a null one has none and gets the score of
    no evidence (``share_without_neighbours`` says how many); a text of any length is scored
    whole. Repeated rows score alike; without labels of both classes every score is the class
    share. An empty table gives no rows; other columns are ignored.
    """
    model = learn(docs, labels, **learning)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        cache: dict = {}
        for b in batches:
            found = []
            texts = b.column(1).to_pylist()
            for i in range(0, len(texts), TOGETHER):
                if len(cache) > 20_000:
                    cache = {}
                vectors = [m.index.vector(terms(t)) for t in texts[i:i + TOGETHER]]
                keys = [hashlib.blake2b(at.tobytes() + w.tobytes(), digest_size=16).digest()
                        for at, w in vectors]
                fresh = {k: v for k, v in zip(keys, vectors, strict=True) if k not in cache}
                for k, (where, cos, _, told) in zip(fresh, m.index.evident_search(
                        list(fresh.values())) if fresh else [], strict=True):
                    cache[k] = (m.score(m.index.vote(where, told, m.prior)),
                                [m.index.ids[j] for j in where], cos.tolist())
                found += [cache[k] for k in keys]
            out, near, cosines = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.float64()), pa.array(near, pa.list_(pa.int64())),
                 pa.array(cosines, pa.list_(pa.float32()))],
                ["doc_id", "score", "neighbours", "cosines"])

    scored = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, neighbours array<long>, cosines array<float>")
    return scored.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours",
                         "cosines")


def share_without_neighbours(scored: DataFrame) -> float:
    """Share of the rows of ``score_documents`` that no example came near to (0 of no rows)."""
    return float(scored.agg(F.avg((F.size("neighbours") == 0).cast("double"))).first()[0] or 0.0)
