"""SimHash near-duplicates: exact pairs within a Hamming radius by vantage-point trees."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import pick, positional, stored
from tallyspark.llm.components import connected_components, with_least

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
SAMPLE = 16_384          # sampled fingerprints that shape the splits of one shard, at most
ALL_SAMPLES = 1 << 20    # and of all shards that one round splits, about
LEAST_SAMPLE = 64        # of one shard, about, however many shards a round splits
LEAF_TARGET = 16_384     # aimed fingerprints of a shard; each is searched by a tree of its own
MIN_SAMPLE = 16          # sampled fingerprints below which a node is not split
MAX_SHARD = 200_000      # more own fingerprints than this: split again
MAX_ROUNDS = 40          # of splits; each splits up to ALL_SAMPLES / LEAST_SAMPLE shards
BLOCK = 200_000          # rows of one side of a block of a shard that does not split


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the whole text (A-Z lower-cased, words between ASCII blanks,
    ``k``-word shingles with repeats, XXH64). No words, or null: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < k:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
        n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    while True:  # bounded memory for very long texts
        h = np.fromiter((digest(g, HASH_SEED) for g in islice(grams, 1 << 16)), np.uint64)
        if not len(h):
            break
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(k):
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, k) for t in b.column(1).to_pylist()), np.uint64,
                              b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))],
                                             ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``, one row per document row; fp is the fingerprint as a signed long."""
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _fingerprint_batches(k), "doc_id long, fp long")


# ------------------------------------------------------------ vantage-point tree
def _dist(a, v):
    return np.bitwise_count(a ^ v)


def _split(points: np.ndarray, seed: int):
    """A vantage point and radius that split ``points`` most evenly and with the fewest
    near the border, out of a few candidates; None if no candidate splits them."""
    best = None
    for c in range(4):
        v = points[(seed * 7919 + c * 104_729) % len(points)]
        d = _dist(points, v)
        mu = int(np.median(d))
        if (inside := int((d <= mu).sum())) == len(points):
            mu = int(d.max()) - 1
            inside = int((d <= mu).sum())
        if 0 < inside < len(points):
            cost = abs(2 * inside - len(points)) + int((np.abs(d.astype(int) - mu) <= 3).sum())
            if best is None or cost < best[0]:
                best = (cost, v, mu)
    return best and best[1:]


def build_tree(sample: np.ndarray, population: int, leaf_target: int = LEAF_TARGET,
               min_sample: int = MIN_SAMPLE):
    """Nested tuples ``(vantage, radius, inside, outside)``; a leaf is None. Splits until a
    leaf is expected to hold ``leaf_target`` of the ``population`` fingerprints."""
    if len(sample) < 2 * min_sample or population <= leaf_target:
        return None
    cut = _split(sample, len(sample))
    if cut is None:
        return None
    v, mu = cut
    near = _dist(sample, v) <= mu
    share = near.sum() / len(sample)
    return (int(v), mu, build_tree(sample[near], int(population * share), leaf_target, min_sample),
            build_tree(sample[~near], int(population * (1 - share)), leaf_target, min_sample))


def route(tree, fps: np.ndarray, own: np.ndarray, r: int):
    """Yields ``(leaf path, indices, own flags)``.

    Every fingerprint goes to its own leaf. It is also a guest of each leaf that can own
    another fingerprint within ``r`` bits: from outside a ball it visits the inside if it
    is within ``r`` of the border (triangle inequality); the inside need not visit back,
    as one of the two suffices. A guest looks both ways at every later node.
    """
    stack = [(tree, "", np.arange(len(fps)), own)]
    while stack:
        node, path, idx, mine = stack.pop()
        if not len(idx):
            continue
        if node is None:
            yield path, idx, mine
            continue
        v, mu, inner, outer = node
        d = _dist(fps[idx], np.uint64(v)).astype(int)
        near = d <= mu
        into = near | (d <= mu + r)
        stack.append((inner, path + "i", idx[into], (mine & near)[into]))
        out = (~near & mine) | (~mine & (d > mu - r))
        stack.append((outer, path + "o", idx[out], (mine & ~near)[out]))


def _route_batches(trees: dict, r: int):
    def run(batches):
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            own = b.column("own").to_numpy(zero_copy_only=False)
            shards = np.array(b.column("shard").to_pylist(), dtype=object)
            for shard in dict.fromkeys(shards.tolist()):
                at = np.flatnonzero(shards == shard)
                for path, idx, mine in route(trees.get(shard), fps[at], own[at], r):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard + path] * len(idx), pa.string()),
                         pa.array(fps[at][idx].view(np.int64)), pa.array(mine)],
                        ["shard", "fp", "own"])
    return run


# ------------------------------------------------------------------- pairs
class _Forest:
    """Union of index pairs, vectorised."""

    def __init__(self, n):
        self.label = np.arange(n)

    def add(self, i, j):
        while len(i):
            a, b = self.label[i], self.label[j]
            live = a != b
            i, j, a, b = i[live], j[live], a[live], b[live]
            if not len(i):
                return
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _near_pairs(fps, home, guest, r, forest, same, leaf=256):
    """Adds to ``forest`` the links between ``home`` points, and from ``home`` to ``guest``
    points, by a local vantage-point tree. ``same``: compare home with home too."""
    stack = [(home, guest)]
    while stack:
        home, guest = stack.pop()
        if not len(home) or not (same or len(guest)):
            continue
        cut = _split(fps[home], len(home)) if len(home) > leaf else None
        if cut is None:
            others = np.concatenate([home, guest]) if same else guest
            step = max(1, (1 << 20) // max(1, len(others)))
            for s in range(0, len(home), step):
                rows = home[s:s + step]
                i, j = np.nonzero(_dist(fps[rows][:, None], fps[others][None, :]) <= r)
                forest.add(rows[i], others[j])
            continue
        v, mu = cut
        dh, dg = _dist(fps[home], v).astype(int), _dist(fps[guest], v).astype(int)
        near = dh <= mu
        visit = home[~near & (dh <= mu + r)] if same else home[:0]
        stack.append((home[near], np.concatenate([guest[dg <= mu + r], visit])))
        stack.append((home[~near], guest[dg > mu - r]))


def _shard_links(r):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy(zero_copy_only=False)
        whole = bool(table.column("whole")[0].as_py())
        forest = _Forest(len(fps))
        _near_pairs(fps, np.flatnonzero(own), np.flatnonzero(~own), r, forest, whole)
        moved = np.flatnonzero(forest.label != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[forest.label[moved]]})
    return run


def _samples(rows: DataFrame, big: dict[str, int], each: int, seed: int) -> dict[str, np.ndarray]:
    """About ``each`` own fingerprints of every shard in ``big``, in an order that does not depend
    on partitions: those whose hash falls into the shard's share of all hashes."""
    share = {s: min(1 << 31, -(-(each << 31) // n)) for s, n in big.items()}
    own = rows.where("own")
    if len(share) == 1:             # the whole table, at first
        (shard, only), = share.items()
        own = own.where(F.col("shard") == shard).withColumn("share", F.lit(only))
    else:
        own = own.join(F.broadcast(rows.sparkSession.createDataFrame(
            list(share.items()), "shard string, share long")), "shard")
    picked = own.where(F.pmod(F.xxhash64("fp", F.lit(seed)), F.lit(1 << 31)) < F.col("share")
                       ).select("shard", "fp").orderBy("shard", "fp").toArrow()
    by_shard: dict[str, list[int]] = {}
    for s, fp in zip(picked["shard"].to_pylist(), picked["fp"].to_pylist(), strict=True):
        by_shard.setdefault(s, []).append(fp)
    return {s: np.array(v, np.int64).view(np.uint64) for s, v in by_shard.items()}


def _trees(samples: dict, big: dict[str, int], leaf_target: int, min_sample: int) -> dict:
    """A tree for each shard that its sample can split."""
    trees = {s: build_tree(v, big[s], leaf_target, min_sample) for s, v in samples.items()}
    return {s: t for s, t in trees.items() if t is not None}


def near_links(fps: DataFrame, r: int = MAX_BITS, *, sample: int = SAMPLE,
               leaf_target: int = LEAF_TARGET, min_sample: int = MIN_SAMPLE,
               max_shard: int = MAX_SHARD, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct fingerprints ``fps(fp)`` which lie
    within ``r`` bits, directly or through others (a spanning forest of every shard, so
    never more links than rows). Exact at every size.

    Shards with more than ``max_shard`` fingerprints of their own are split, again and again,
    each by a bounded sample of its own fingerprints, until none is left that splits. What does
    not split (a dense cloud) is compared in blocks of ``block`` rows, each its own task.
    """
    spark = fps.sparkSession
    rows = fps.select(F.lit("").alias("shard"), "fp", F.lit(True).alias("own"))
    stuck: list[str] = []
    for round_no in range(MAX_ROUNDS):
        sizes = rows.where("own").groupBy("shard").count().where(
            F.col("count") > (max_shard if round_no else leaf_target))
        if stuck:
            known = spark.createDataFrame([(s,) for s in stuck], "shard string")
            sizes = sizes.join(F.broadcast(known), "shard", "left_anti")
        big = {s["shard"]: s["count"] for s in sizes.orderBy(F.desc("count"), "shard").limit(
            ALL_SAMPLES // LEAST_SAMPLE).collect()}
        if not big:
            break
        each = max(LEAST_SAMPLE, min(sample, ALL_SAMPLES // len(big)))
        trees = _trees(_samples(rows, big, each, round_no), big, leaf_target, min_sample)
        stuck += [s for s in big if s not in trees]
        if not trees:
            continue
        rows = stored(rows.mapInArrow(_route_batches(trees, r),
                                      "shard string, fp long, own boolean"), "shards")
    # blocks: one for nearly every shard; h x g tasks for shards beyond the block size
    dims = rows.groupBy("shard").agg(
        F.ceil(F.sum(F.col("own").cast("long")) / block).alias("h"),
        F.ceil(F.count(F.lit(1)) / block).alias("g")).where("h > 0")
    wide = dims.where("h > 1 or g > 2")
    plain = rows.join(wide, "shard", "left_anti").select(
        "shard", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "fp", "own",
        F.lit(True).alias("whole"))
    cut = rows.join(wide, "shard")
    mark = F.pmod(F.xxhash64("fp"), F.col("h"))
    homes = cut.where("own").select(
        "shard", mark.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1))
        .alias("j"), "fp", F.lit(True).alias("own"), F.lit(False).alias("whole"))
    visits = cut.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1)).alias("i"),
        F.pmod(F.xxhash64("fp", F.lit(7)), F.col("g")).alias("j"), "fp",
        F.lit(False).alias("own"), F.lit(False).alias("whole"))
    return (plain.unionByName(homes).unionByName(visits).groupBy("shard", "i", "j")
            .applyInArrow(_shard_links(r), "a long, b long"))


# --------------------------------------------------------------- operator
def simhash_components(docs: DataFrame, k: int = SHINGLE_WORDS, r: int = MAX_BITS,
                       **tree) -> DataFrame:
    """``(doc_id, fingerprint, component_id, component_root)``, one row per document row;
    component_root is the least fingerprint of the component.

    Exact copies share a fingerprint, so only distinct fingerprints are searched. Texts
    that are null, empty or without words have fingerprint zero and link like any other.
    Repeated rows stay repeated. A null doc_id never is a component id unless no member of
    the component has an id. An empty table gives no rows. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, k), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    comp = stored(connected_components(near_links(distinct.select("fp"), r, **tree)), "roots")
    linked = distinct.join(comp.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    merged = with_least(linked, least, "root").select("fp", "component_id", "root")
    lone = distinct.join(comp.select(F.col("node").alias("fp")), "fp", "left_anti").select(
        "fp", F.col("least").alias("component_id"), F.col("fp").alias("root"))
    return rows.join(merged.unionByName(lone), "fp").select(
        "doc_id", hex16("fp").alias("fingerprint"), "component_id",
        hex16("root").alias("component_root"))


def hex16(col):
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def keep_one_per_component(docs: DataFrame, k: int = SHINGLE_WORDS, r: int = MAX_BITS,
                           **tree) -> DataFrame:
    """The rows of ``docs`` (all columns) without near-duplicates: of each component the row
    with the least doc_id stays, and one row where that id is repeated. Rows without an id
    stay only if no member has one (then one of them)."""
    flat, name = positional(docs)
    ids, text = F.col(name["doc_id"]).cast("long"), name["text"]
    comp = stored(simhash_components(docs, k, r, **tree), "components")
    # ids whose one row is its component's only choice; others need one row chosen
    per_id = comp.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    drop = per_id.where("n = 1 and doc_id is not null and not stays").select("doc_id")
    odd = stored(per_id.where("n > 1 or doc_id is null").select("doc_id"), "odd")
    # the ids that go grow with the table: at every size a merge join, never a broadcast
    plain = (flat.join(drop.hint("merge"), ids == drop["doc_id"], "left_anti")
             .join(odd, ids.eqNullSafe(odd["doc_id"]), "left_anti"))
    if odd.isEmpty():
        return plain.toDF(*docs.columns)
    # repeated or missing ids: one fingerprint, then one row, stands for each component
    rest = flat.join(odd, ids.eqNullSafe(odd["doc_id"]), "left_semi")
    marks = stored(comp.join(odd.withColumnRenamed("doc_id", "_o"),
                             F.col("doc_id").eqNullSafe(F.col("_o")), "left_semi")
                   .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .groupBy("component_root")
                   .agg(F.min(F.struct("doc_id", "fingerprint")).alias("m"))
                   .select("component_root", "m.doc_id", "m.fingerprint"), "marks")
    tagged = rest.mapInArrow(_tag_batches(rest.columns, text, k),
                             T.StructType([*rest.schema, T.StructField("_fp", T.StringType())]))
    one = (tagged.join(marks, F.col(name["doc_id"]).cast("long").eqNullSafe(marks["doc_id"])
                       & (F.col("_fp") == marks["fingerprint"]))
           .dropDuplicates(["component_root"]).select(*flat.columns))
    return plain.unionByName(one).toDF(*docs.columns)


def _tag_batches(columns, text, k):
    at = columns.index(text)

    def run(batches):
        for b in batches:
            fp = [format(fingerprint(t, k), "016x") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp, pa.string())],
                                             [*columns, "_fp"])
    return run
