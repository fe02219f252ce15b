"""Helpers the operators share: Arrow batches, bounded samples, joins that survive hot groups, reliable cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text that one step inside a task holds as Python objects (a longer text is a step of its own).
STEP_BYTES = 6_000_000
#: Shares are told in parts of this many.
GRAIN = 1 << 30


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes."""
    if batch.num_rows == 0:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(size)])
    low = 0
    while low < batch.num_rows:
        high = max(int(np.searchsorted(before, before[low] + limit, "right")) - 1, low + 1)
        yield batch.slice(low, high - low)
        low = high


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, column: str | None = "text",
             step: int = STEP_BYTES) -> DataFrame:
    """``mapInArrow`` in steps of bounded size (whole batches where no text column is named); ``fn`` gives the output
    columns of one step."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in steps(batch, column, step) if column else [batch]:
                yield pa.RecordBatch.from_pydict(fn(part), schema=arrow)

    return df.mapInArrow(run, schema)


def edit_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text", step: int = STEP_BYTES) -> DataFrame:
    """Filter or rewrite rows in place, all columns kept as they are, without a shuffle."""
    def run(batches):
        for batch in batches:
            for part in steps(batch, column, step):
                yield fn(part)

    return df.mapInArrow(run, df.schema)


def bounded_sample(df: DataFrame, key: str, limit: int, *others: DataFrame):
    """About ``limit`` rows chosen by a hash of the key; all rows where there are no more than that.

    The share is the same in every partition, so nothing is gathered to choose the rows. ``others`` are tables with the
    same key: they come back cut to the same keys, so a join with the sample moves no other rows.
    """
    n = df.count()
    part = int(GRAIN * min(1.0, limit / max(n, 1)))
    chosen = [d if n <= limit else d.filter(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(GRAIN)) < part)
              for d in (df, *others)]
    return chosen if others else chosen[0]


def without(docs: DataFrame, gone: DataFrame, mark: Column) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, ``mark``) is not in ``gone`` (doc_id, mark); columns unchanged.

    ``mark`` is computed from the row's own text, so a row goes for its text, not for an id it shares. Null is an id like
    any other.
    """
    pairs = gone.select(F.col("doc_id").alias("__gone_id"), F.col("mark").alias("__gone_mark")).distinct()
    marked = docs.withColumn("__mark", mark)
    return marked.join(pairs, marked["doc_id"].eqNullSafe(pairs["__gone_id"]) & (marked["__mark"] == pairs["__gone_mark"]),
                       "left_anti").drop("__mark")


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str, how: str = "left", share: int = 1000) -> DataFrame:
    """Join of rows with one class row per key where one class may own any share of the rows.

    ``size`` counts the rows of a class. Classes with more than one ``share``-th of all rows number fewer than
    ``share`` by arithmetic, so exactly these are broadcast; every other class meets its rows in a shuffle join.
    Both parts are disjoint and together complete. ``key`` must not be null.
    """
    total = classes.agg(F.sum(size)).first()[0] or 0
    heavy = classes.filter(F.col(size) * share > total)
    hot = [r[0] for r in heavy.select(key).collect()]       # fewer than ``share`` rows
    if not hot:
        return rows.join(classes, key, how)
    is_hot = F.col(key).isin(hot)
    return rows.filter(is_hot).join(F.broadcast(classes.filter(is_hot)), key, how).unionByName(
        rows.filter(~is_hot).join(classes.filter(~is_hot), key, how))


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; only in local mode without that setting (tests) a
    folder of our own."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="silsila-llm-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder. Rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write rows as Parquet into a new folder below the shared one and read them again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a step, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[start:end]`` per segment (empty segments give 0); segments are consecutive and ascending."""
    out = np.zeros((len(starts),) + values.shape[1:], dtype=np.float64)
    full = np.flatnonzero(ends > starts)
    if len(full):
        bounds = np.column_stack([starts[full], ends[full]]).ravel()
        padded = np.concatenate([values, np.zeros((1,) + values.shape[1:], dtype=values.dtype)])
        out[full] = np.add.reduceat(padded, bounds, axis=0)[::2]
    return out
