"""Seed entity import with column-name variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silsila.functions.text import PLAIN, Profile, normalize

#: Accepted spellings of every seed column, in order of preference.
SEED_COLUMNS = {
    "entity_id": ("id", "narrator_id", "shamela_id"),
    "short_name": ("shortName", "short_name", "short_name_ar"),
    "long_name": ("longName", "long_name", "long_name_ar"),
    "death_year": ("deathYear", "death_year", "death_hijri"),
    "biography": ("biography", "bio"),
    "metadata": ("metadata", "meta"),
}


def read_seed(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """``fmt``: parquet, json (an array or one object) or jsonl."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("multiLine", fmt == "json").json(path)


def _pick(df: DataFrame, names, kind: str) -> Column:
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast(kind)
    cols = []
    for n in present:
        nested = isinstance(df.schema[n].dataType, (T.StructType, T.ArrayType, T.MapType))
        cols.append((F.to_json(n) if nested and kind == "string" else F.col(n)).cast(kind))
    return F.coalesce(*cols)


def seed_entities(df: DataFrame, profile: Profile = PLAIN, names: dict | None = None) -> DataFrame:
    """Coalesce column variants, coerce types, add the two normalised names."""
    names = {**SEED_COLUMNS, **(names or {})}
    empty = F.lit("")
    out = df.select(
        _pick(df, names["entity_id"], "long").alias("entity_id"),
        F.coalesce(_pick(df, names["short_name"], "string"), empty).alias("short_name"),
        F.coalesce(_pick(df, names["long_name"], "string"), empty).alias("long_name"),
        _pick(df, names["death_year"], "int").alias("death_year"),
        F.coalesce(_pick(df, names["biography"], "string"), empty).alias("biography"),
        F.coalesce(_pick(df, names["metadata"], "string"), empty).alias("metadata"),
    )
    return out.withColumn("short_norm", normalize("short_name", profile)).withColumn("long_norm", normalize("long_name", profile))
