"""Phrase lookup: token n-grams of the pages joined to the names' source keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silsila.functions import keys as K


def phrase_pages(names: DataFrame, pages: DataFrame, per_source: int = 2,
                 lead: int = 350, length: int = 1200) -> DataFrame:
    """First ``per_source`` pages per (name, source) that hold the name's key as a phrase.

    ``names``: owner_id, name_text, key (three to five tokens). ``pages``: page_id, source,
    text, text_norm. Pages are found per distinct key, so names that share a key cost nothing;
    the rank limit is pushed below the shuffle by Spark, so a hot phrase stays cheap.
    """
    keys = names.select("key").filter(F.col("key").isNotNull()).distinct()
    keys = keys.select("key", F.split("key", " ").alias("kt"))
    keys = keys.select("key", F.size("kt").alias("n"), F.array_join(F.slice("kt", 1, 3), " ").alias("gram"))
    t = K.tokens("text_norm")
    # one row per distinct five-token run, found by its first three tokens
    runs = pages.select("page_id", "source", t.alias("t")).select(
        "page_id", "source",
        F.explode(F.array_distinct(F.transform(
            F.when(F.size("t") >= 3, F.sequence(F.lit(1), F.size("t") - 2)).otherwise(F.array().cast("array<int>")),
            lambda i: F.array_join(F.slice("t", i, 5), " ")))).alias("run"))
    runs = runs.withColumn("gram", F.substring_index("run", " ", 3))
    hits = runs.join(keys, "gram").filter(F.expr("substring_index(run, ' ', n)") == F.col("key"))
    hits = hits.select("key", "source", "page_id").distinct()
    first = W.partitionBy("key", "source").orderBy("page_id")
    hits = hits.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_source)
    found = names.join(hits, "key").join(pages.select("page_id", "text"), "page_id")
    at = F.greatest(F.expr("instr(text, substring_index(name_text, ' ', 1))") - 1, F.lit(0))
    start = F.greatest(at - lead, F.lit(0))
    return found.select(
        "owner_id", "source", "page_id", "rank", "key",
        F.substring("text", start + 1, at + length - start).alias("snippet"))
