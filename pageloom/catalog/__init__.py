"""Registered queries: each operator run over the given tables, with its SQL check."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import BASE_TABLES, FIXTURES, SPARK_READS, VIEWS, oracle
from ..session import materialize, tune

MODULES = (
    "geometry", "detections", "blocks", "spans", "ordering", "paragraphs", "layouts", "tables", "rendering",
    "texts", "documents", "tasks", "files",
)


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, needs: list[str] | None = None, sql: str | None = None, ctes: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``sql`` is the check over base tables and fixtures."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        text = oracle(needs or [], sql, ctes) if sql else None
        REGISTRY[name] = Query(name, lambda tables: _widen(fn(tables)), text)
        return fn

    return add


def _widen(df: DataFrame) -> DataFrame:
    """32-bit results as BIGINT, so both engines report one integer type."""
    return df.select(*(
        F.col(f"`{c}`").cast("long").alias(c) if kind in ("int", "smallint", "tinyint") else F.col(f"`{c}`")
        for c, kind in df.dtypes
    ))


def load() -> dict[str, Query]:
    for module in MODULES:
        try:
            importlib.import_module(f"{__name__}.{module}")
        except ModuleNotFoundError as err:
            if err.name != f"{__name__}.{module}":
                raise
    return REGISTRY


_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """Base tables and derived fixtures of one data folder, as attributes.

    A fixture that takes a shuffle is written once per application as a table in the checkpoint folder,
    so queries that share it do not derive it again; the others are read through.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, write: bool = True):
        self.spark, self.sf_dir, self.write = spark, sf_dir.rstrip("/"), write
        tune(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in FIXTURES:
            return self.fixture(name)
        raise AttributeError(name)

    def fixture(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            reads, sql, _ = FIXTURES[name]
            for table in SPARK_READS.get(name, reads):
                self._spread(table).createOrReplaceTempView(table)
            df = self.spark.sql(sql)
            _WRITTEN[key] = materialize(df, name) if self.write and name not in VIEWS else df
        return _WRITTEN[key]

    def _spread(self, table: str) -> DataFrame:
        """A given table in fewer splits than there are cores is dealt out once; larger ones stay as they lie."""
        df, cores = getattr(self, table), self.spark.sparkContext.defaultParallelism
        if table not in BASE_TABLES or not self.write or df.rdd.getNumPartitions() >= cores:
            return df
        key = (self.spark.sparkContext.applicationId, self.sf_dir, table)
        if key not in _WRITTEN:
            _WRITTEN[key] = materialize(df.repartition(cores), table)
        return _WRITTEN[key]

    def folder(self, name: str) -> str:
        """Folder of a written fixture, for streams."""
        return os.path.dirname(self.fixture(name).inputFiles()[0])

    def sql(self, text: str, *reads: str) -> DataFrame:
        for table in reads:
            getattr(self, table).createOrReplaceTempView(table)
        return self.spark.sql(text)
