"""Sinks: versioned model tables, caching and CSV export."""

from __future__ import annotations

import json
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.plans.versions import VersionLog, file_system, hadoop_path, java_error

#: Seconds for which a version stays readable after a newer one has replaced it.
RETAIN_SECONDS = 24 * 3600


# ------------------------------------------------------------------ model tables
def _finished(spark: SparkSession, path: str) -> list[dict]:
    """The finished versions of a table that are still kept, the newest last."""
    log = VersionLog(spark, path)
    return [log.read(n) for n, _ in log.numbers()]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can reach (no error if it is gone)."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def stamp_of(**facts) -> str:
    """What a stored table depends on, as text that can be compared."""
    return json.dumps({k: str(v) for k, v in facts.items()}, sort_keys=True)


def write_model_table(df: DataFrame, path: str, force: bool = False, fmt: str = "parquet",
                      stamp: str = "", retain: float = RETAIN_SECONDS) -> DataFrame:
    """Save a model so later models reuse it, and return it read back.

    Every write goes to a new version folder below ``path``, which is entered in a log after
    it is complete; readers take the last entered version, so a failed or half-written
    table is never read, and writers at the same time each get a version of their own. A
    stored table is kept only if, without ``force``, its last version has this model's schema
    and this ``stamp`` (as-of date, configuration, inputs); anything else, an empty or a foreign
    folder too, is built anew. Versions replaced for more than ``retain`` seconds are deleted.
    Beside the write itself this runs no Spark job.
    """
    return store_model_table(df, path, force, fmt, stamp, retain)[0]


def store_model_table(df: DataFrame, path: str, force: bool = False, fmt: str = "parquet",
                      stamp: str = "", retain: float = RETAIN_SECONDS
                      ) -> tuple[DataFrame, int, bool]:
    """:func:`write_model_table` with the version's number and whether it is a new one."""
    spark, log = df.sparkSession, VersionLog(df.sparkSession, path)
    schema = df.schema.json()
    last = None if force else log.latest()
    new = not (last and last["stamp"] == stamp and last["schema"] == schema)
    if new:
        folder = f"v-{uuid.uuid4().hex}"
        df.write.format(fmt).save(f"{path}/{folder}")
        number = log.enter({"folder": folder, "stamp": stamp, "schema": schema})
        _expire(log, path, retain)
    else:
        folder, number = last["folder"], last["number"]
    table = spark.read.schema(df.schema).format(fmt).load(f"{path}/{folder}")
    return table, number, new


def _expire(log: VersionLog, path: str, retain: float) -> None:
    """Delete the versions that a newer one has replaced long ago. A reader that has taken a
    version keeps it for ``retain`` seconds after that, however many versions came since."""
    found, now = log.numbers(), time.time() * 1000
    for (number, _), (_, replaced) in zip(found, found[1:], strict=False):
        if now - replaced >= retain * 1000:
            try:
                folder = log.read(number)["folder"]
            except Py4JJavaError as e:      # another writer was faster
                if java_error(e) != "FileNotFoundException":
                    raise
                continue
            delete_folder(log.spark, f"{path}/{folder}")
            log.remove(number)


def vacuum(spark: SparkSession, path: str, retain: float = RETAIN_SECONDS) -> None:
    """Delete replaced versions, and folders of writes that never finished, once they are older
    than ``retain`` seconds."""
    log = VersionLog(spark, path)
    _expire(log, path, retain)
    known = {e["folder"] for e in _finished(spark, path)}
    fs, now = file_system(spark, path), time.time() * 1000
    for s in fs.listStatus(hadoop_path(spark, path)):
        name = s.getPath().getName()
        if name.startswith("v-") and name not in known \
                and now - s.getModificationTime() >= retain * 1000:
            fs.delete(s.getPath(), True)


def read_model_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The last finished version of a stored model; an error if there is none. What it returns
    stays readable for the retention time of the writers, however often the model is rebuilt."""
    last = VersionLog(spark, path).latest()
    if last is None:
        raise FileNotFoundError(f"no finished model table at {path}")
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    return spark.read.schema(schema).format(fmt).load(f"{path}/{last['folder']}")


# ------------------------------------------------------------------ cache
#: The persisted versions of each model table, by application and path.
_CACHED: dict[tuple[str, str], list[DataFrame]] = {}
_CACHE_LOCK = threading.Lock()


def _cache_key(df: DataFrame, path: str) -> tuple[str, str]:
    return df.sparkSession.sparkContext.applicationId, path.rstrip("/")


def cache_model(df: DataFrame, no_cache: bool = False, path: str | None = None) -> DataFrame:
    """Keep a model in executor memory/disk for reuse, or drop it (``no_cache``).

    ``path``: where the model is stored. All model sets of the application share one registry of
    what is persisted for a path: a newer version frees the older ones, and ``no_cache`` frees
    every version. Persisted blocks are recomputed from lineage if an executor is lost; for a
    hard lineage cut use :func:`write_model_table`.
    """
    if path is not None:
        with _CACHE_LOCK:
            key = _cache_key(df, path)
            for k in [k for k in _CACHED if k[0] != key[0]]:    # applications that have ended
                del _CACHED[k]
            for old in _CACHED.pop(key, []):
                old.unpersist()
            if not no_cache:
                _CACHED[key] = [df]
    return df.unpersist() if no_cache else df.persist(StorageLevel.MEMORY_AND_DISK)


def release_model(df: DataFrame, path: str) -> None:
    """Free one persisted version; newer ones of the same path stay."""
    with _CACHE_LOCK:
        key = _cache_key(df, path)
        if any(x is df for x in _CACHED.get(key, [])):
            del _CACHED[key]
    df.unpersist()


# ------------------------------------------------------------------ export
_CSV = {"header": True,      # and labels verbatim: one of them ends in a space
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> DataFrame:
    """Publish an export as CSV with a header; returns it read back.

    The files are written to a folder of their own beside ``path`` and take its place only when
    they are complete: an export that fails leaves the published one as it was.

    ``single_file`` gathers it into one file, for a table known to be small (the metric
    exports: at most 19 rows a quarter); otherwise each partition writes its own.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    stage = f"{path}.new-{uuid.uuid4().hex}"
    try:
        (df.coalesce(1) if single_file else df).write.options(**_CSV).csv(stage)
        _publish(spark, stage, path)
    except BaseException:
        delete_folder(spark, stage)
        raise
    return spark.read.schema(df.schema).options(**_CSV).csv(path)


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False if the target is there already or the source is not."""
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        hadoop_path(spark, source).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(hadoop_path(spark, source), hadoop_path(spark, target), none)
        return True
    except Py4JJavaError as e:
        if java_error(e) in ("FileAlreadyExistsException", "FileNotFoundException"):
            return False
        raise


def _publish(spark: SparkSession, stage: str, path: str, tries: int = 100) -> None:
    """Put a complete folder in the place of ``path``: what is there moves aside, comes back if
    the new one cannot follow, and is deleted once it has. Of several exporters the last one's
    folder stays."""
    for _ in range(tries):
        old = f"{path}.old-{uuid.uuid4().hex}"
        had = _move(spark, path, old)
        try:
            done = _move(spark, stage, path)
        except BaseException:
            if had:
                _move(spark, old, path)
            raise
        if had:
            delete_folder(spark, old)
        if done:
            return
    raise RuntimeError(f"{path} was replaced by others {tries} times meanwhile")


def checksum(df: DataFrame) -> str:
    """Row count and an order-free sum of row hashes (computed by the executors)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return f"{row['n']}:{row['s']}"
