"""Table sinks: full refresh, insert-if-absent, upsert, conditional upgrade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Rebuild a table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the smallest ``order`` per key; an aggregation, so map sides combine."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, "__row.*")


def insert_absent(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Target plus the new rows whose key it does not hold; one new row per key."""
    fresh = one_per_key(new, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def upsert(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Target with the new rows put over the old ones of the same key."""
    fresh = one_per_key(new, keys, order)
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def upgrade_status(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column], status: str = "status",
                   weak: str = "candidate_only") -> DataFrame:
    """New rows, one per key, replace absent rows and rows of the weak status; all others (also without a status) stay."""
    strong = target.filter(~F.col(status).eqNullSafe(weak))
    fresh = one_per_key(new, keys, order).join(strong.select(*keys), keys, "left_anti")
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)
