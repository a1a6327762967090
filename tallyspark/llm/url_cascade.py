"""URL filters: exact membership in a list of keys by a cascade of Bloom filters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pick, stored

FIRST_BITS = 10           # bits for each key of the first level
LATER_BITS = 4            # and of the later ones, whose universe is small already
SHARD_KEYS = 200_000      # aimed keys of the universe of a shard (its cascade: 1 MB at most)
BROADCAST_BYTES = 32 << 20  # all cascades together; beyond this, rows are sent to the cascades
ROWS_PER_TASK = 500_000   # rows of one shard that one task probes, beyond that size


# --------------------------------------------------------------- one shard's cascade
def _positions(h: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions of 64-bit key hashes at a level (double hashing of a remixed hash)."""
    with np.errstate(over="ignore"):
        x = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        steps = np.arange(hashes, dtype=np.uint64)[:, None]
        return ((a + steps * b) & np.uint64(0xFFFFFFFF)) % np.uint64(bits)


class Cascade:
    """Level 0 holds the listed keys; each later level holds the keys of the other side that
    the level before it passes wrongly. The first level that misses a key decides: a miss at
    an even level means not listed, at an odd one listed; a key that no level misses is
    listed if the last level holds listed keys. Exact for every key of the universe it was
    built over."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels

    @staticmethod
    def build(h: np.ndarray, listed: np.ndarray, first_bits: int = FIRST_BITS,
              later_bits: int = LATER_BITS) -> "Cascade":
        """``h``: distinct 64-bit hashes of the universe; ``listed``: which are listed."""
        into, others, levels = h[listed], h[~listed], []
        while len(into):
            per_key = first_bits if not levels else later_bits
            bits = max(64, per_key * len(into))
            hashes = max(1, round(per_key * math.log(2)))
            field = np.zeros(bits, bool)
            field[_positions(into, len(levels), bits, hashes).astype(np.int64)] = True
            levels.append((bits, hashes, np.packbits(field)))
            wrong = others[_passes(levels[-1], len(levels) - 1, others)]
            into, others = wrong, into
        return Cascade(levels)

    def listed(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        open_ = np.arange(len(h))
        for i, level in enumerate(self.levels):
            hit = _passes(level, i, h[open_])
            out[open_[~hit]] = i % 2 == 1
            open_ = open_[hit]
        out[open_] = len(self.levels) % 2 == 1
        return out

    def packed(self) -> bytes:
        head = np.array([len(self.levels)] + [x for b, k, _ in self.levels for x in (b, k)],
                        "<i8")
        return head.tobytes() + b"".join(f.tobytes() for _, _, f in self.levels)

    @staticmethod
    def unpacked(blob: bytes) -> "Cascade":
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        head = np.frombuffer(blob, "<i8", 2 * n, 8).tolist()
        levels, at = [], 8 + 16 * n
        for bits, hashes in zip(head[::2], head[1::2], strict=True):
            size = (bits + 7) // 8
            levels.append((bits, hashes, np.frombuffer(blob, np.uint8, size, at)))
            at += size
        return Cascade(levels)


def _passes(level, i, h) -> np.ndarray:
    bits, hashes, field = level
    if not len(h):
        return np.zeros(0, bool)
    at = _positions(h, i, bits, hashes).astype(np.int64)
    return ((field[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


# ------------------------------------------------------------------- distributed
def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def _build(table: pa.Table) -> pa.Table:
    h = table.column("h").to_numpy().view(np.uint64)
    cascade = Cascade.build(h, table.column("listed").to_numpy(zero_copy_only=False))
    return pa.table({"shard": table.column("shard")[:1], "cascade": pa.array([cascade.packed()])})


class CascadeFilter:
    """Cascades over all keys of a corpus, one for each shard of the key hashes.

    ``universe(key)`` are all keys that will ever be asked, repeats allowed; ``listed(key)``
    the listed ones. Both sides are made distinct by a partial aggregate, so a key that a
    third of all rows share counts once. The 64-bit hashes of the universe must tell listed
    from other keys; ``build`` checks that and takes the next hash seed if they do not.
    """

    def __init__(self, cascades: DataFrame, shards: int, seed: int):
        self.cascades, self.shards, self.seed = cascades, shards, seed

    @staticmethod
    def build(universe: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS):
        marked = (pick(universe, "key").select("key", F.lit(False).alias("listed"))
                  .unionByName(pick(listed, "key").select("key", F.lit(True).alias("listed")))
                  .where("key is not null").groupBy("key").agg(F.max("listed").alias("listed")))
        marked = stored(marked, "keys")
        for seed in range(16):
            by_hash = marked.groupBy(F.xxhash64("key", F.lit(seed)).alias("h")).agg(
                F.max("listed").alias("listed"), F.min("listed").alias("all"))
            check = by_hash.agg(F.count(F.lit(1)).alias("n"),
                                F.count_if(F.col("listed") != F.col("all")).alias("mixed")).first()
            if not check["mixed"]:
                break
        else:
            raise RuntimeError("no hash seed tells the listed keys from the others")
        shards = max(1, -(-check["n"] // shard_keys))
        shard = F.pmod(F.shiftrightunsigned(F.col("h"), 40), F.lit(shards))
        built = (by_hash.select(shard.alias("shard"), "h", "listed").groupBy("shard")
                 .applyInArrow(_build, "shard long, cascade binary"))
        return CascadeFilter(stored(built, "cascades"), shards, seed)

    def ask(self, rows: DataFrame, key: str, out: str = "listed",
            broadcast_bytes: int = BROADCAST_BYTES, rows_per_task: int = ROWS_PER_TASK):
        """``rows`` with a boolean column ``out``: whether ``key`` is listed (false for null).

        If all cascades together are no larger than ``broadcast_bytes``, each task gets them
        and probes its rows where they are. Beyond that, rows go to their shard's cascade;
        a shard that many rows ask (a hot key) is dealt to as many tasks as it needs, each
        with a copy of the cascade.
        """
        names, seed, shards = rows.columns, self.seed, self.shards
        asked = rows.withColumn("_h", F.when(F.col(key).isNotNull(),
                                             F.xxhash64(key, F.lit(seed))))
        size = self.cascades.agg(F.coalesce(F.sum(F.length("cascade")), F.lit(0))).first()[0]
        if size <= broadcast_bytes:
            spark = rows.sparkSession
            sent = spark.sparkContext.broadcast(
                {r["shard"]: bytes(r["cascade"]) for r in self.cascades.collect()})
            return asked.mapInArrow(_probe_batches(sent, shards, names, out),
                                    _with_flag(rows.schema, out))
        asked = asked.withColumn("_shard", F.pmod(F.shiftrightunsigned(F.col("_h"), 40),
                                                  F.lit(shards)))
        tasks = asked.groupBy("_shard").agg(
            F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_tasks"))
        tasks = F.broadcast(stored(tasks.withColumnRenamed("_shard", "_s"), "tasks"))  # a row a shard
        dealt = asked.join(tasks, F.col("_shard").eqNullSafe(F.col("_s"))).withColumn(
            "_task", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.col("_tasks"))
        ).drop("_tasks", "_s")
        copies = self.cascades.join(tasks, F.col("shard") == F.col("_s")).select(
            F.col("shard").alias("_shard"), F.explode(F.sequence(
                F.lit(0).cast("long"), F.col("_tasks") - 1)).alias("_task"), "cascade")
        fields = _with_flag(rows.schema, out)
        return dealt.groupBy("_shard", "_task").cogroup(
            copies.groupBy("_shard", "_task")).applyInArrow(_probe_group(names, out), fields)


def _with_flag(schema, out):
    from pyspark.sql import types as T
    return T.StructType([*schema, T.StructField(out, T.BooleanType())])


def _answers(cascade_of, column, shards):
    valid = np.asarray(column.is_valid())
    h = column.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    out, shard = np.zeros(len(h), bool), _shard_of(h, shards)
    for s in np.unique(shard[valid]).tolist():
        cascade = cascade_of(s)
        if cascade is not None:
            at = np.flatnonzero(valid & (shard == s))
            out[at] = cascade.listed(h[at])
    return out


def _probe_batches(sent, shards, names, out):
    def run(batches):
        held = {s: Cascade.unpacked(b) for s, b in sent.value.items()}
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(_answers(held.get, b.column(b.num_columns - 1),
                                                    shards))], [*names, out])
    return run


def _probe_group(names, out):
    def run(rows: pa.Table, cascades: pa.Table) -> pa.Table:
        cascade = (Cascade.unpacked(cascades.column("cascade")[0].as_py())
                   if cascades.num_rows else None)
        flags = _answers(lambda _: cascade, rows.column("_h").combine_chunks(), 1)
        return rows.select(names).append_column(out, pa.array(flags))
    return run


# ------------------------------------------------------------------------- pages
#: (host, path, verdict): a rule fits the host and all its subdomains, for urls whose path
#: starts with the rule's; of the rules that fit the longest decides.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A host with one of these words in a label is listed (fixed values).
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")
LISTED_HOST = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def host_and_path(url: str = "url"):
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: then up
    to ``?``, ``#`` or the end. Null, or no ``://``: both empty."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.substr(u, F.locate("://", u) + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host, path, rules=RULES):
    """The string of the longest rule that fits, and its verdict (columns; null if none)."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest ends outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge_pages(pages: DataFrame, listed: DataFrame | None = None, rules=RULES,
                **asking) -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)``, one row per page row.

    Keys are host + path; the universe is every key of ``pages``. ``listed(key)`` defaults
    to the keys whose host has one of ``LISTED_WORDS`` in a label. Where no rule fits, a
    listed key is blocked and any other allowed; an empty host is never listed by default.
    Null urls, urls of any length, repeated rows and other columns are allowed; no pages give no
    rows.
    """
    host, path = host_and_path()
    p = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    p = p.withColumn("key", F.concat("host", "path"))
    if listed is None:
        listed = p.where(F.col("host").rlike(LISTED_HOST)).select("key")
    answered = CascadeFilter.build(p.select("key"), listed).ask(p, "key", **asking)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return answered.select("page_id", "host", "path", name.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def _rules_sql(rules) -> str:
    return ", ".join(f"('{h}', '{p}', '{h + p}', '{v}')" for h, p, v in rules)


ORACLE_SQL = f"""
with rules(rhost, rpath, rule, verdict) as (values {_rules_sql(RULES)}),
cut as (
  select page_id, case when position('://' in coalesce(url, '')) > 0
    then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut),
best as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from parts join rules on (host = rhost or ends_with(host, '.' || rhost))
    and starts_with(path, rpath)
  group by page_id),
marked as (
  select *, regexp_matches(host, '{LISTED_HOST}') as listed from parts)
select m.page_id, m.host, m.path, b.rule,
  coalesce(b.verdict, case when m.listed then 'block' else 'allow' end) as verdict, m.listed
from marked m left join best b using (page_id)
"""
