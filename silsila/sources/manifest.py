"""File inventory, file-name grammar, content dedup, manifest sinks, run audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silsila.functions.text import _col
from silsila.operators.scans import scan_before


def read_files(spark: SparkSession, path: str, glob: str = "*.htm") -> DataFrame:
    """Files as rows (path, size, SHA-256, content)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return inventory(files, "path", "content")


def inventory(files: DataFrame, name: str, content: str) -> DataFrame:
    """Add ``size_bytes`` and ``sha256`` of the content."""
    return files.select(
        F.col(name).alias("path"), F.octet_length(content).cast("long").alias("size_bytes"),
        F.sha2(F.col(content).cast("binary"), 256).alias("sha256"), F.col(content).alias("content"))


def clean_title(c) -> Column:
    text = F.regexp_replace(F.trim(_col(c)), r"[/\\]", " - ")
    return F.regexp_replace(text, r"\s+", " ")


def classify_name(book, stem, ext, volume_word: str = "المجلد", intro_words=("مقدمة", "المقدمة"),
                  intro_label: str = "المقدمة", supplement_mark: str = "م", supplement_word: str = "ملحق") -> Column:
    """Struct (canonical_name, kind, volume) for a file named ``stem + ext`` in folder ``book``."""
    book, stem, ext = _col(book), _col(stem), _col(ext)
    volume = F.regexp_extract(stem, r"(?i)^j?0*(\d+)$", 1)
    extra = F.regexp_extract(stem, rf"^{supplement_mark}\s*(\d+)$", 1)

    def named(suffix, kind, number=None):
        return F.struct(F.concat(book, suffix, ext).alias("canonical_name"), F.lit(kind).alias("kind"),
                        (F.lit(None) if number is None else number).try_cast("int").alias("volume"))

    return (
        F.when(volume != "", named(F.format_string(f" - {volume_word} %02d", volume.try_cast("int")), "volume", volume))
        .when(stem.isin(*intro_words), named(F.lit(f" - {intro_label}"), "intro"))
        .when(extra != "", named(F.format_string(f" - {supplement_word} %d", extra.try_cast("int")), "supplement"))
        .when(stem == book, named(F.lit(""), "standalone"))
        .otherwise(named(F.concat(F.lit(" - "), clean_title(stem)), "named"))
    )


def parse_name(stem, volume_word: str = "المجلد", intro_label: str = "المقدمة",
               supplement_word: str = "ملحق") -> Column:
    """Struct (book, volume, kind) read back from a canonical name."""
    stem = _col(stem)
    vol, sup, intro = rf"\s*-\s*{volume_word}\s+(\d+)$", rf"\s*-\s*{supplement_word}\s+(\d+)$", f" - {intro_label}"

    def parsed(book, kind, volume=None):
        return F.struct(F.trim(book).alias("book"), (F.lit(None) if volume is None else volume).try_cast("int").alias("volume"),
                        F.lit(kind).alias("kind"))

    return (
        F.when(stem.rlike(vol), parsed(F.regexp_replace(stem, vol, ""), "volume", F.regexp_extract(stem, vol, 1)))
        .when(stem.rlike(sup), parsed(F.regexp_replace(stem, sup, ""), "supplement"))
        .when(stem.endswith(intro), parsed(F.regexp_replace(stem, intro + "$", ""), "introduction"))
        .otherwise(parsed(stem, "standalone"))
    )


def dedup_content(files: DataFrame, key: str = "sha256", name: str = "name", order: str = "ord",
                  preferred: str | None = None) -> DataFrame:
    """Mark content copies: ``canonical_name`` for all, ``duplicate_of`` for the copies.

    The first file of a content is canonical unless a ``preferred`` one (0/1 column) exists.
    One aggregation and a join back, so a content held by a third of all files is no hot window.
    """
    rank = [F.col(order)] if preferred is None else [F.lit(1) - F.col(preferred), F.col(order)]
    first = files.groupBy(key).agg(
        F.min(F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col(name).alias("n"))).alias("__first"),
        F.count(F.lit(1)).alias("copies"))
    first = first.select(key, "copies", F.col(f"__first.r{len(rank) - 1}").alias("__order"), F.col("__first.n").alias("canonical_name"))
    return files.join(first, key).withColumn(
        "duplicate_of", F.when(F.col(order) == F.col("__order"), F.lit("")).otherwise(F.col("canonical_name"))).drop("__order")


def suffix_collisions(files: DataFrame, name: str = "name", order: str = "ord", out: str = "unique_name") -> DataFrame:
    """Append " (n)" to the second and later files that want the same name."""
    ranked = scan_before(files.withColumn("__one", F.lit(1)), [name], order, "__one", "__before", how="sum").drop("__one")
    number = F.col("__before") + 1
    return ranked.withColumn(
        out, F.when(number > 1, F.concat(F.col(name), F.lit(" ("), number.cast("string"), F.lit(")"))).otherwise(F.col(name))
    ).drop("__before")


BYTE_ORDER_MARK = "\ufeff"


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Manifest as CSV (UTF-8 with byte order mark and header in every file) and JSON, below ``path``."""
    first, *rest = manifest.columns
    marked = manifest.select(F.col(first).alias(BYTE_ORDER_MARK + first), *rest)
    marked.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"').option("emptyValue", "").csv(f"{path}/csv")
    manifest.write.mode("overwrite").json(f"{path}/json")


def read_manifest(spark: SparkSession, path: str, schema: str, kind: str = "csv") -> DataFrame:
    """A written manifest, columns by place (CSV) or by name (JSON). Line ends inside values are kept; CSV does not tell a
    null text from an empty one, both come back empty."""
    if kind == "json":
        return spark.read.schema(schema).json(f"{path}/json")
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/csv").na.fill("")


def run_audit(version: str, **layers: DataFrame) -> DataFrame:
    """One row per run: version and the row count of every layer."""
    counts = None
    for name, df in layers.items():
        row = df.select(F.lit(name).alias("layer")).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))
        counts = row if counts is None else counts.unionByName(row)
    sums = [F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("n"))), F.lit(0)).alias(f"{name}_count") for name in layers]
    return counts.agg(*sums).withColumn("version", F.lit(version))
