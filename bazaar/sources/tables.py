"""Table access: read a table by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def is_path(ref: str) -> bool:
    """Whether ``ref`` is a path (it has a slash) and not a catalog name; the
    driver's own disk is not asked."""
    return "/" in ref


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table stored as ``{base}/{name}.parquet`` (file or folder) or, when
    ``base`` is a catalog database, ``base.name``."""
    if is_path(base):
        return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return spark.table(f"{base}.{name}")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "base"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]
