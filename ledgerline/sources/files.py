"""Raw CSV scans, layer reads and writes, Parquet export and its manifest.

Scale notes: a gzip file is one unsplittable partition, so a raw scan of
compressed text is repartitioned right after the read; the export writes as
many files as the caller asks for, gathered behind a shuffle so the work
before it stays parallel.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column of a landed file that holds a line which does not fit its schema.
MALFORMED = "_malformed"


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None,
                 sep: str = ",") -> DataFrame:
    """Header CSV as all-string, nullable columns (no schema inference pass).

    Compressed text (gzip) cannot be split, so a few large files give a few
    scan tasks.  When ``partitions`` is given and the scan has fewer splits
    than that, the rows are spread over ``partitions`` tasks right after the
    scan so everything downstream runs in parallel.  Uncompressed input is
    split by ``spark.sql.files.maxPartitionBytes`` and left alone.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = (spark.read.option("header", "true").option("inferSchema", "false")
          .option("sep", sep).option("multiLine", "false").csv(paths))
    if partitions:
        try:
            splits = df.rdd.getNumPartitions()
        except Exception:  # noqa: BLE001 - no RDD view under Spark Connect: always spread
            splits = 0
        if splits < partitions:
            df = df.repartition(partitions)
    return df


def land_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], layer: str,
             header: bool = True, sep: str = ",") -> int:
    """Land CSV text as a Parquet layer of string columns and return its lines.

    The columns are stated, so a line with too few or too many fields is not
    shifted or padded silently: it is stored whole in the ``_malformed`` column
    (all lines in one pass) and kept apart by :func:`landed_rows` and
    :func:`landed_rejects`.  Blank lines are skipped by the reader.
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*columns, MALFORMED]])
    lines = (spark.read.schema(schema).option("header", str(header).lower()).option("sep", sep)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
             .csv([path] if isinstance(path, str) else list(path)))
    return write_layer(lines, layer)


def landed_rows(spark: SparkSession, layer: str) -> DataFrame:
    """Lines that fit the schema."""
    return read_layer(spark, layer).where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def landed_rejects(spark: SparkSession, layer: str) -> DataFrame:
    """The other lines, as they came: ``line``."""
    return read_layer(spark, layer).where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"))


def write_csv(df: DataFrame, path: str, compression: str | None = "gzip", mode: str = "overwrite") -> None:
    """Header CSV, one file per partition; values are written verbatim
    (Spark's writer trims surrounding blanks unless told not to)."""
    w = (df.write.mode(mode).option("header", "true")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_layer(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A layer by catalog name (``silver.loans``) or by path (contains ``/``)."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def write_layer(df: DataFrame, name_or_path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> int:
    """Full-refresh (or append) write of a layer; returns the rows written,
    counted during the write by ``observe`` instead of a second scan."""
    obs = Observation(f"write_layer_{uuid.uuid4().hex[:12]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name_or_path:
        w.save(name_or_path)
    else:
        w.saveAsTable(name_or_path)
    return int(obs.get.get("rows", 0))


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{at}")


def create_table_if_missing(spark: SparkSession, name: str, ddl_columns: str) -> None:
    """``CREATE TABLE IF NOT EXISTS name (cols) USING parquet``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING parquet")


@dataclass(frozen=True)
class Digest:
    """Rows of a table and an order-free digest of their values."""

    rows: int
    hash_sum: Decimal | None
    hash_xor: int | None


def digest_columns(df: DataFrame) -> list[Column]:
    """Aggregates that make a :class:`Digest`: sum and xor of the row hashes do
    not depend on the order or the partitioning, and a repeated row, which
    cancels in the xor, counts in the sum."""
    maps = {f.name for f in df.schema if "map<" in f.dataType.simpleString()}
    row = F.xxhash64(*[F.to_json(F.struct(f"`{c}`")) if c in maps else F.col(f"`{c}`") for c in df.columns],
                     # nulls are skipped by the hash, so their places count too
                     *[F.col(f"`{c}`").isNull() for c in df.columns])
    return [F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(row).alias("hash_xor")]


def export_parquet(df: DataFrame, path: str, files: int | None = None) -> Digest:
    """Overwrite ``path`` with ``df`` as Parquet in one write and return its
    digest, observed during the write.

    ``files``: number of files, for a reader that expects one; the rows are
    gathered behind a shuffle, so the work before it stays parallel.  The
    caller decides, whatever the number of rows; by default the frame keeps its
    partitioning.
    """
    obs = Observation(f"export_{uuid.uuid4().hex[:12]}")
    rows = (df.repartition(files) if files else df).observe(obs, *digest_columns(df))
    rows.write.mode("overwrite").parquet(path)
    m = obs.get
    return Digest(int(m.get("rows", 0)), m.get("hash_sum"), m.get("hash_xor"))


def export_tables(tables: Mapping[str, DataFrame], root: str, files: int | None = None) -> dict[str, Digest]:
    """Export each table to ``<root>/<name>``; returns the digest per table."""
    return {name: export_parquet(df, f"{root.rstrip('/')}/{name}", files) for name, df in tables.items()}


def export_manifest(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Data files of each export folder: table, file_name, file_size, rows.

    Reads only the hidden file metadata columns and counts rows per file, so
    no data column is decoded.
    """
    out = None
    for name in names:
        df = (spark.read.parquet(f"{root.rstrip('/')}/{name}")
              .select(F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_size").alias("file_size"))
              .groupBy("file_name", "file_size").agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(name).alias("table"), "file_name", "file_size", "rows"))
        out = df if out is None else out.unionByName(df)
    return out


def verify_export(spark: SparkSession, root: str, expected: Mapping[str, Digest]) -> DataFrame:
    """Re-read each export and compare rows and content with what was written:
    table, expected_rows, exported_rows, matches, digest_matches."""
    out = None
    for name, d in expected.items():
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        same = (F.col("hash_sum").eqNullSafe(F.lit(d.hash_sum).cast("decimal(38,0)"))
                & F.col("hash_xor").eqNullSafe(F.lit(d.hash_xor).cast("bigint")))
        row = df.agg(*digest_columns(df)).select(
            F.lit(name).alias("table"), F.lit(d.rows).cast("bigint").alias("expected_rows"),
            F.col("rows").alias("exported_rows"), (F.col("rows") == F.lit(d.rows)).alias("matches"),
            same.alias("digest_matches"))
        out = row if out is None else out.unionByName(row)
    return out
