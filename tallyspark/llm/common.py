"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.plans.sinks import delete_folder
from tallyspark.session import checkpoint_dir, ensure_session_conf


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the application, wherever the
    driver was started from (once; the same as ``--py-files`` with the package's zip)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tallyspark-"), "tallyspark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session_conf(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns only, found by exact name and position: extra columns,
    also ones that differ in case only or appear twice, cannot clash."""
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select([F.col(f"_c{df.columns.index(c)}").alias(c) for c in cols])


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """All columns under neutral names, and the neutral name of each original one
    (the first, if a name repeats). ``df.toDF(*old.columns)`` restores the names."""
    names = {}
    for i, c in enumerate(df.columns):
        names.setdefault(c, f"_c{i}")
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), names


_MADE: dict[str, list[str]] = {}
_STEP = threading.local()      # the folders that the present step of this thread has made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(folder)
    if getattr(_STEP, "made", None) is not None:
        _STEP.made.append(folder)
    return f"{folder}/{name}"


def kept_step(spark: SparkSession, step, name: str) -> tuple[DataFrame, list[str]]:
    """The rows of ``step()``, a function that gives a DataFrame, stored in a table of their own,
    and that table's folder (to be discarded when its readers are done); every other folder
    that the step (in this thread) has written is deleted then."""
    outer, _STEP.made = getattr(_STEP, "made", None), []
    try:
        rows = step()
        made, _STEP.made = _STEP.made, []
        out = stored(rows, name)
        kept = _STEP.made
    finally:
        _STEP.made = outer
    if outer is not None:
        outer += kept
    discard(spark, made)
    return out, kept


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete intermediate tables that nobody reads any more."""
    mine = _MADE.get(spark.sparkContext.applicationId, [])
    for folder in folders:
        delete_folder(spark, folder)
        if folder in mine:
            mine.remove(folder)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables that this application's operators have written. To be
    called once their results have been consumed (results read these tables)."""
    for folder in _MADE.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, folder)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once,
    lineage cut, and safe against lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(col, folds: int = 5):
    """crc32 of the id's decimal text, modulo ``folds`` (a column)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % folds


def crc_fold_py(doc_id, folds: int = 5):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds
