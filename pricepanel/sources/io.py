"""Sources and sinks: parquet / CSV / JSON readers, partitioned writers, listings, artifacts.

Everything goes through Spark's file sources and the Hadoop FileSystem API of
the running session, so the same code reads local paths in tests and object
stores on a cluster.  Scratch output goes under the cluster's shared
``spark.checkpoint.dir`` (see ``session.checkpoint_dir``), never a machine-local
temporary folder.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import year_week_key
from ..session import _scratch

CSV_SEPARATORS = [",", ";", "\t"]


# ---------------------------------------------------------------- reads
def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_many(spark: SparkSession, paths: Sequence[str], union_columns: bool = False) -> DataFrame:
    """Read and stack many parquet files; ``union_columns`` fills missing columns with NULL."""
    if not paths:
        raise ValueError("no parquet files to read")
    reader = spark.read.option("mergeSchema", "true") if union_columns else spark.read
    return reader.parquet(*paths)


def read_partitioned(spark: SparkSession, base: str, partitions: Sequence[str] | None = None,
                     partition_col: str = "year_week") -> DataFrame:
    """Hive-partitioned table ``base/year_week=YYYY_WW/*.parquet``; a partition filter is pruned
    at planning time (partition values stay strings)."""
    df = spark.read.option("basePath", base).parquet(base)
    if partitions is not None:
        df = df.filter(F.col(partition_col).isin(list(partitions)))
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, prefix: str, suffix: str = ".parquet") -> list[str]:
    """Recursive listing with a suffix filter; '_'- and '.'-prefixed files (e.g. _SUCCESS) are
    skipped; sorted.  Raises on an empty listing."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
             .load(prefix).select("path"))  # Spark lists in parallel; the files' contents are not read
    out = sorted(r[0] for r in files.collect())  # one row per file
    if not out:
        raise ValueError(f"no {suffix} files under {prefix}")
    return out


def read_tree(spark: SparkSession, prefix: str, suffix: str = ".parquet", union_columns: bool = False) -> DataFrame:
    """All parquet files below ``prefix`` as one table, listed by Spark's reader itself."""
    reader = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
    return (reader.option("mergeSchema", "true") if union_columns else reader).parquet(prefix)


def read_file_subset(spark: SparkSession, prefix: str, percent: int = 50, seed: int = 42, suffix: str = ".parquet") -> DataFrame:
    """The rows of about ``percent`` of the files below ``prefix`` (one file at least), the same ones each time.

    Files are drawn by a hash of their name below ``prefix``.  Spark lists and draws them; a file that is not drawn is
    not opened.  Only the drawn paths reach the driver, as a reader has to be given them.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
             .load(prefix).select("path"))
    root = re.sub(r"^[a-z]+:/*", "/", prefix.rstrip("/"))
    inner = F.regexp_replace("path", rf"^.*{re.escape(root)}/", "")
    draw = F.conv(F.substring(F.md5(F.concat(inner, F.lit(f":{seed}")).cast("binary")), 1, 8), 16, 10).cast("long")
    drawn = files.select("path", (draw % 10_000).alias("draw"))
    picked = [r.path for r in drawn.filter(F.col("draw") < percent * 100).orderBy("path").collect()]
    if not picked:
        least = drawn.orderBy("draw", "path").first()
        if least is None:
            raise ValueError(f"no {suffix} files under {prefix}")
        picked = [least.path]
    return spark.read.option("basePath", prefix).parquet(*picked)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """Optional source: the table when it exists, else None (plan-time check)."""
    return spark.read.parquet(path) if exists(spark, path) else None


def detect_separator(spark: SparkSession, path: str, sample_size: int = 10) -> str:
    """First of , ; TAB that splits the header of a small sample into > 1 column; default ','."""
    lines = [r[0] for r in spark.read.text(path).limit(sample_size).collect()]
    if not lines:
        return ","
    header = lines[0]
    for sep in CSV_SEPARATORS:
        if len(header.split(sep)) > 1:
            return sep
    return ","


def field_count(line, sep: str = ","):
    """Number of fields of a raw CSV record: separators inside quoted fields do not count."""
    # a quoted field opens at the record's start or behind a separator; doubled quotes stay inside
    s = re.escape(sep)
    bare = F.regexp_replace(line, rf'(^|{s})"(?:[^"]|"")*+"', "$1q")
    return F.regexp_count(bare, F.lit(s)) + 1


def read_csv_skip_bad(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",",
                      multi_line: bool = False) -> DataFrame:
    """CSV with header; rows with more fields than the header are dropped, also when the extra fields are empty or
    quoted; short rows are padded with NULL.

    The parser keeps a record that does not fit whole in ``_bad``, and its fields are counted.
    """
    schema = StructType([StructField(c, StringType()) for c in [*columns, "_bad"]])
    df = (spark.read.schema(schema).option("header", "true").option("sep", sep).option("multiLine", multi_line).option("escape", '"')
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("columnPruning", "false").csv(path))
    # the filter names a column of the file as well: Spark reads no CSV for the bad record alone
    bad = F.concat_ws("", "_bad", F.substring(F.col(columns[0]), 1, 0))
    return df.filter(F.col("_bad").isNull() | (field_count(bad, sep) <= len(columns))).drop("_bad")


def load_json_mapping(spark: SparkSession, path: str, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """A JSON object file ``{"k": "v", ...}`` -> rows (key, value)."""
    raw = spark.read.option("multiLine", "true").text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,string>")
    return raw.select(F.explode(m).alias(key_col, value_col))


def read_json_records(spark: SparkSession, path: str, array_field: str | None = "value") -> DataFrame:
    """Landed API responses: a top-level record array (or an object holding one) -> rows."""
    raw = spark.read.option("multiLine", "true").json(path)
    if array_field and array_field in raw.columns:
        return raw.select(F.explode(array_field).alias("_r")).select("_r.*")
    return raw


# ---------------------------------------------------------------- writes
def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, key_col: str = "year_week", max_records_per_file: int = 2_000_000,
                      mode: str = "overwrite") -> None:
    """``path/year_week=YYYY_WW/part-*.parquet`` with at most ``max_records_per_file`` rows per file.
    A 6-digit key becomes YYYY_WW, otherwise '-' becomes '_'."""
    out = df.withColumn(key_col, year_week_key(key_col))
    # rebalance: a key's rows come together, but adaptive execution splits a large key over tasks
    (out.hint("rebalance", key_col).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(key_col).parquet(path))


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """The rows as table ``name``, hashed into ``buckets`` by ``keys`` and sorted by them in each; read back.

    Aggregates over (at least) these keys and joins with tables bucketed alike need no exchange, also after such
    aggregates; with another number of buckets one side is exchanged.
    """
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys))
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def save_price_grid(grid: DataFrame, path: str) -> None:
    """Price grid as parquet with an array<double> column (no pickles)."""
    write_parquet(grid, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{_scratch(spark)}/io-{name}-{uuid.uuid4().hex[:12]}"


def sample_subset(df: DataFrame, key_col: str, percent: int = 50, seed: int = 42) -> DataFrame:
    """Reproducible subset by key hash (the sampling operator itself)."""
    digest = F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < percent)


# ---------------------------------------------------------------- artifacts
ARTIFACTS = {
    "raw": "raw", "preprocessed": "preprocessed", "price_grid": "price_grid", "features": "features",
    "model": "model", "predictions": "predictions", "elasticities": "elasticities",
    "category_elasticities": "category_elasticities",
}


def artifact_path(base: str, artifact: str, frequency: str = "daily", prefix: str | None = None,
                  overrides: dict[str, str] | None = None) -> str:
    """``base/[prefix_]artifact[_weekly]``; unknown artifacts raise; no prefix when None; ``overrides`` rename."""
    if artifact not in ARTIFACTS:
        raise ValueError(f"unknown artifact {artifact!r}")
    name = (overrides or {}).get(artifact, ARTIFACTS[artifact]) + ("_weekly" if frequency == "weekly" else "")
    if prefix:
        name = f"{prefix}_{name}"
    return f"{base.rstrip('/')}/{name}"
