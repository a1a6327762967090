"""Secret scans with an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import pick, positional, stored
from tallyspark.plans.versions import VersionLog


# ------------------------------------------------------------------------- rules
@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``least`` characters or more;
    ``version`` changes whenever the pattern does, so that old blobs are scanned again.
    Every match contains ``hint``: texts without it are not searched. A text with a match that is
    long enough matches ``maybe``, a Java pattern: others need not be sent to where they would
    be searched (empty: any text may)."""

    kind: str
    pattern: re.Pattern
    least: int = 0
    group: int = 0
    version: int = 1
    base: bool = False
    hint: str = ""
    maybe: str = ""


#: Fixed patterns and lengths of the base kinds, in their order.
BASE_RULES = (
    Rule("assign", re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII), 8, 2, base=True,
        maybe=r"""(?i)(?:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Z0-9+/_.=-]{8}"""),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), 16, base=True, maybe="AKIA[A-Z0-9]{12}"),
    Rule("hex", re.compile(r"[0-9a-f]+"), 32, base=True, maybe="[0-9a-f]{32}"),
)
MORE_RULES = (
    Rule("pem", re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:[^-]|-(?!----))+"
                           r"-----END [A-Z0-9 ]*PRIVATE KEY-----"), version=2,
         hint="PRIVATE KEY", maybe="PRIVATE KEY-----"),
    Rule("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
         hint="eyJ", maybe="eyJ[A-Za-z0-9_-]{8}"),
    Rule("forge", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), hint="_",
         maybe="gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("login", re.compile(r"://[^\s/:@]+:[^\s/:@]{3,}@"), version=2, hint="://",
         maybe=r"://[^\s/:@]+:[^\s/:@]"),
)
RULES = BASE_RULES + MORE_RULES

#: A run of 32 or more of [0-9a-f] can only begin where this matches.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")


def scan(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Spans (code points, end exclusive) of the rule's leftmost non-overlapping matches
    that are long enough."""
    if rule.hint not in text:
        return []
    pattern = rule.pattern
    if rule.kind == "hex" and rule.base:
        pattern = _HEX  # same matches: the runs are maximal, shorter ones are dropped anyway
    g, least = rule.group, rule.least
    return [m.span() for m in pattern.finditer(text) if m.end(g) - m.start(g) >= least]


# ------------------------------------------------------------------------ ledger
LEDGER_SCHEMA = T.StructType([
    T.StructField("blob", T.BinaryType(), False), T.StructField("kind", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())), True)])


def may_match(text, rules):
    """Whether a text column can hold a finding of any of the rules."""
    tests = [text.rlike(r.maybe) if r.maybe else F.lit(True) for r in rules]
    return F.coalesce(functools.reduce(lambda a, b: a | b, tests), F.lit(False))


def _scan_batches(rules):
    """Texts that cannot match are not sent along: null."""
    def run(batches):
        for b in batches:
            blobs, kinds, versions, spans = [], [], [], []
            for text, blob, todo in zip(*(b.column(i).to_pylist() for i in range(3)),
                                        strict=True):
                for i in todo:
                    r = rules[i]
                    blobs.append(blob)
                    kinds.append(r.kind)
                    versions.append(r.version)
                    spans.append([] if text is None else scan(text, r))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), pa.array(kinds, pa.string()),
                 pa.array(versions, pa.int32()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["blob", "kind", "version", "spans"])
    return run


def address(text: str):
    """SHA-256 of a text column's UTF-8 bytes (a null is the empty text), as binary."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return F.unhex(F.sha2(plain, 256))


class Ledger:
    """What has been scanned: one row for each blob, rule kind and rule version, with the
    spans found (maybe none).

    Kept below ``path`` (a shared folder). Every run writes the pairs it scanned to a folder of
    its own and then enters that in a log of versions: a run that fails adds nothing, and runs at
    the same time each add theirs. Where two have scanned the same pair, one of the equal rows
    counts. A run that finds nothing new writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path and path.rstrip("/")
        self.last_scanned: DataFrame | None = None

    def folders(self) -> dict[str, int]:
        """The folders that hold the ledger, with the numbers of their entries."""
        log = VersionLog(self.spark, self.path)
        entries = [log.read(n) for n, _ in log.numbers()]
        gone = {n for e in entries for n in e["replaces"]}
        return {e["folder"]: e["number"] for e in entries if e["number"] not in gone}

    def rows(self) -> DataFrame:
        """One row for each pair."""
        folders = self.folders() if self.path is not None else {}
        if not folders:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        found = self.spark.read.schema(LEDGER_SCHEMA).parquet(
            *[f"{self.path}/{f}" for f in sorted(folders)])
        # each folder holds a pair once
        return found if len(folders) == 1 else found.dropDuplicates(["blob", "kind", "version"])

    def append(self, found: DataFrame, replaces: tuple[int, ...] = ()) -> None:
        """Add rows that hold each pair once, in place of the entries ``replaces``."""
        folder = f"v-{uuid.uuid4().hex}"
        found.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        VersionLog(self.spark, self.path).enter({"folder": folder, "replaces": [*replaces]})

    def compact(self) -> None:
        """Many runs' folders become one. What others enter meanwhile stays beside it; the old
        folders stay too, for those who read them (``plans.sinks.vacuum`` is not for ledgers)."""
        folders = self.folders()
        if len(folders) > 1:
            self.append(self.rows(), tuple(folders.values()))

    def scan(self, versions: DataFrame, rules=RULES) -> DataFrame:
        """Scans what is new in ``versions(path, text)`` and returns the ledger's rows with
        findings, for these rules, of any blob ever seen.

        A blob's address is the SHA-256 of its bytes. Only blobs that lack a (kind, version)
        pair are read again, each through one of its rows and for the lacking rules only.
        """
        held = pick(versions, "path", "text").select(
            "path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        held = held.withColumn("blob", address("text"))
        wanted = [(r.kind, r.version) for r in rules]
        now = F.broadcast(self.spark.createDataFrame(wanted, "kind string, version int"))
        seen = (self.rows().join(now, ["kind", "version"], "left_semi").groupBy("blob")
                .agg(F.collect_set(F.struct("kind", "version")).alias("done")))
        blobs = held.groupBy("blob").agg(F.min("path").alias("path"))
        lacking = F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: ~F.coalesce(
            F.array_contains(F.col("done"), F.array(*[
                F.struct(F.lit(k).alias("kind"), F.lit(v).alias("version"))
                for k, v in wanted])[i]), F.lit(False)))
        todo = stored(blobs.join(seen, "blob", "left").select("blob", "path",
                                                              lacking.alias("todo"))
                      .where(F.size("todo") > 0), "unseen")
        if todo.isEmpty():
            self.last_scanned = self.spark.createDataFrame([], LEDGER_SCHEMA)
        else:
            # only texts that may match move to the task where their blob is scanned
            sent = held.withColumn("text", F.when(may_match(F.col("text"), rules),
                                                  F.col("text")))
            one = sent.join(todo.withColumnRenamed("path", "_path")
                            .withColumnRenamed("blob", "_b"),
                            (F.col("blob") == F.col("_b"))
                            & F.col("path").eqNullSafe(F.col("_path")))
            found = one.select("text", "blob", "todo").mapInArrow(
                _scan_batches(tuple(rules)), LEDGER_SCHEMA)
            self.last_scanned = stored(found, "scanned").dropDuplicates(
                ["blob", "kind", "version"])
            if self.path is not None:
                self.append(self.last_scanned)
        all_rows = self.last_scanned if self.path is None else self.rows()
        return all_rows.where(F.size("spans") > 0).join(now, ["kind", "version"], "left_semi")


def _digest_batches(kinds, n_base):
    """Spans of a blob to the digest columns."""
    at = {k: i for i, k in enumerate(kinds)}

    def joined(spans):
        return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        for b in batches:
            cols = [[], [], [], [], []]
            for found in b.column(1).to_pylist():
                spans = sorted((s, at[f["kind"]], e) for f in found or [] for s, e in f["spans"])
                base = [x for x in spans if x[1] < n_base]
                for i in range(3):
                    cols[i].append(sum(x[1] == i for x in base))
                cols[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[4].append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 *[pa.array(c, pa.string()) for c in cols[3:]]],
                ["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


DIGESTS = "blob binary, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
_NOTHING = hashlib.sha256(b"").hexdigest()


def scan_documents(docs: DataFrame, ledger: Ledger | None = None, rules=RULES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row per document row:
    the findings of its blob, joined back to every row that holds it.

    A null text is the empty blob. Repeated rows and ids stay repeated. A text of any length
    is searched whole. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark)
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    found = ledger.scan(d.withColumnRenamed("doc_id", "path"), rules)
    per_blob = found.groupBy("blob").agg(F.collect_list(F.struct("kind", "spans")).alias("found"))
    digests = per_blob.mapInArrow(_digest_batches([r.kind for r in rules],
                                                  sum(r.base for r in rules)), DIGESTS)
    return (d.select("doc_id", address("text").alias("blob")).join(digests, "blob", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                    for c in ("n_assign", "n_access", "n_hex")],
        F.coalesce("base_sha256", F.lit(_NOTHING)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans")))


# --------------------------------------------------------------------- redaction
MASK = "[SECRET]"


def _merge(spans):
    out = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def redact(text: str, spans) -> str:
    """The text with each span (overlapping ones as one) replaced by the mask."""
    parts, at = [], 0
    for s, e in _merge(spans):
        parts += [text[at:s], MASK]
        at = e
    return "".join(parts) + text[at:]


def _redact_batches(at, at_found):
    def run(batches):
        for b in batches:
            texts = [t if f is None else redact(t or "", [tuple(x) for x in f])
                     for t, f in zip(b.column(at).to_pylist(), b.column(at_found).to_pylist(),
                                     strict=True)]
            cols = [c for i, c in enumerate(b.columns) if i != at_found]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, b.column(at_found).is_valid()],
                                             [*[f"_c{i}" for i in range(len(cols))], "_hit"])
    return run


def redact_documents(docs: DataFrame, ledger: Ledger | None = None, rules=RULES) -> DataFrame:
    """``docs`` with every secret masked in ``text`` (and ``n_chars``, if there, counted
    anew for those rows). All rows and columns stay; rows without findings are unchanged."""
    flat, name = positional(docs)
    ledger = ledger or Ledger(docs.sparkSession)
    versions = pick(docs, "doc_id", "text").withColumnRenamed("doc_id", "path")
    found = ledger.scan(versions, rules).groupBy("blob").agg(
        F.flatten(F.collect_list("spans")).alias("_found"))
    # texts that cannot match any rule stay where they are
    may = may_match(F.col(name["text"]).cast("string"), rules)
    joined = flat.where(may).withColumn("blob", address(name["text"])).join(
        found, "blob", "left").select(*flat.columns, "_found")
    schema = T.StructType([*flat.schema, T.StructField("_hit", T.BooleanType())])
    out = joined.mapInArrow(_redact_batches(flat.columns.index(name["text"]),
                                            len(flat.columns)), schema)
    if "n_chars" in name:
        n = name["n_chars"]
        out = out.withColumn(n, F.when(F.col("_hit"), F.length(name["text"]).cast(
            flat.schema[n].dataType)).otherwise(F.col(n)))
    return out.drop("_hit").unionByName(flat.where(~may)).toDF(*docs.columns)
