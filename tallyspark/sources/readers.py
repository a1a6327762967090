"""Readers for the raw billing tables and the product configuration."""

from __future__ import annotations

import functools
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.schemas import BILLING_SCHEMAS, PRODUCT_CONFIG


@dataclass(frozen=True)
class BillingTables:
    """The raw inputs of every model, one DataFrame per billing table."""

    customer: DataFrame
    card: DataFrame
    product: DataFrame
    product_config: DataFrame
    price: DataFrame
    tier: DataFrame
    subscription_item: DataFrame
    subscription_history: DataFrame
    invoice: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def register_views(self, prefix: str = "") -> None:
        """Expose every table to ``spark.sql`` as a temp view."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)


def input_states(tables: dict[str, DataFrame]) -> dict[str, str]:
    """For each table what its rows are read from: changes when the data are replaced, under the
    same names too. One Spark job over all tables adds up, row by row, a hash of the row's file
    (path, size and time, which Spark's file sources know of each row), reading no column. A
    table that is not a plain scan of files stands for its plan."""
    states, scans = {}, []
    for name, df in tables.items():
        try:
            file = df.select("_metadata.file_path", "_metadata.file_size",
                             "_metadata.file_modification_time")
        except AnalysisException:
            states[name] = f"plan {df.semanticHash()}"
            continue
        scans.append(file.select(F.lit(name).alias("table"),
                                 F.xxhash64(*file.columns).cast("decimal(38,0)").alias("h")))
    if scans:
        rows = functools.reduce(DataFrame.unionByName, scans)
        sums = rows.groupBy("table").agg(F.count("*").alias("n"), F.sum("h").alias("s"))
        found = {r["table"]: f"files {r['n']}:{r['s']}" for r in sums.collect()}
        states |= {n: found.get(n, "files 0") for n in tables if n not in states}
    return states


def input_state(df: DataFrame) -> str:
    """:func:`input_states` of one table."""
    return input_states({"table": df})["table"]


def _whole(name: str, column: str, kind: T.DataType) -> Column:
    """The column as a long; an amount or count with a fraction (12.5 cents) is an error,
    not a silent 12."""
    c = F.col(column)
    if not isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType, T.StringType)):
        return c.cast("long")
    exact = c.cast("decimal(38,10)")
    return F.when(exact != F.floor(exact), F.raise_error(F.concat(
        F.lit(f"{name}.{column} is not a whole number: "), c.cast("string")))).otherwise(
        exact.cast("long"))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the schema's columns, cast to the schema's types (extra columns dropped).
    Fractions in whole-number columns raise an error when the rows are read."""
    schema = BILLING_SCHEMAS[name]
    return df.select([
        (_whole(name, f.name, df.schema[f.name].dataType) if f.dataType == T.LongType()
         else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one billing table stored as ``{path}/{name}`` (a folder or a file).

    CSV files need a header line, by which columns are found whatever their order; whole
    numbers are read as text first, so that a fraction is noticed.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    return conform(reader.load(f"{path.rstrip('/')}/{name}"), name)


def read_billing_tables(spark: SparkSession, path: str, fmt: str = "parquet",
                        product_config: DataFrame | None = None) -> BillingTables:
    """Scan all billing tables under ``path``.

    ``product_config`` may be given explicitly; otherwise a stored
    ``product_config`` table is used if present, else the seed config.
    """
    tables = {}
    for name in BILLING_SCHEMAS:
        if name == "product_config":
            continue
        tables[name] = read_table(spark, path, name, fmt)
    if product_config is None:
        try:
            product_config = read_table(spark, path, "product_config", fmt)
        except AnalysisException as e:  # no stored config: every product is main, own name
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            product_config = seed_product_config(tables["product"])
    tables["product_config"] = conform(product_config, "product_config")
    return BillingTables(**tables)


def seed_product_config(product: DataFrame) -> DataFrame:
    """Default config: every product keeps its own name and is a main product."""
    return product.select(
        F.col("id").alias("product_id"),
        F.col("name"),
        F.lit(True).alias("is_main_product"),
    )


def product_config_from_mapping(spark: SparkSession,
                                mapping: dict[str, dict]) -> DataFrame:
    """Config from a ``product_id -> {name, is_main_product}`` mapping (as edited by a user)."""
    rows = [(pid, v.get("name"), bool(v.get("is_main_product", True)))
            for pid, v in mapping.items()]
    return spark.createDataFrame(rows, schema=PRODUCT_CONFIG)
