"""Stacking parquet files whose types differ: footers are read in the executors, files grouped by schema and cast.

``mergeSchema`` refuses an integer column beside a double one.  Here a job over the listed paths reads only the
footers; what comes back to the driver is one row per distinct schema.  Each group is read with its own schema, its
columns are cast to the widest type, and the groups are stacked by name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_REAL = ["float", "double"]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _spark_type(t: pa.DataType) -> str:
    """Spark's name of a footer's type; what has none here keeps its own and must be equal in all files."""
    simple = {pa.bool_(): "boolean", pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
              pa.float32(): "float", pa.float64(): "double", pa.string(): "string", pa.large_string(): "string",
              pa.binary(): "binary", pa.date32(): "date"}
    if t in simple:
        return simple[t]
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz else "timestamp_ntz"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_list(t):
        return f"array<{_spark_type(t.value_type)}>"
    if pa.types.is_struct(t):
        return "struct<" + ",".join(f"{f.name}:{_spark_type(f.type)}" for f in t) + ">"
    return str(t)


def widest(a: str, b: str) -> str:
    """The narrowest type that holds the values of both; text if there is no other.  A BIGINT beside a real becomes DOUBLE."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} <= {*_WHOLE, *_REAL}:
        small = {a, b} <= {"tinyint", "smallint", "float"}
        return "float" if small else "double"
    if {a, b} <= {"date", "timestamp"} or {a, b} <= {"date", "timestamp_ntz"}:
        return max(a, b, key=len)
    decimals = [t for t in (a, b) if t.startswith("decimal")]
    if decimals:
        p = [tuple(map(int, t[8:-1].split(","))) if t.startswith("decimal") else
             (_DIGITS[t], 0) if t in _DIGITS else None for t in (a, b)]
        if None not in p:
            scale = max(s for _, s in p)
            whole = max(q - s for q, s in p)
            if whole + scale <= 38:
                return f"decimal({whole + scale},{scale})"
        if {a, b} & set(_REAL):
            return "double"
    if any(t.startswith(("array", "struct", "map", "binary")) for t in (a, b)):
        raise ValueError(f"no common type of {a} and {b}")
    return "string"


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for path in b["path"]:
            fs, inner = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(inner) as f:
                rows.append(json.dumps([[c.name, _spark_type(c.type)] for c in pq.read_schema(f)]))
        yield pd.DataFrame({"path": b["path"], "columns": rows})


def file_schemas(spark: SparkSession, prefix: str, suffix: str = ".parquet") -> DataFrame:
    """(path, columns) of every file below ``prefix``: its footer's names and types as JSON.

    Spark lists the files; their contents are not read.  The footers need a store that Arrow opens too (local and
    shared folders, HDFS, S3, GCS).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
             .load(prefix).select("path"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts).mapInPandas(_footers, "path string, columns string")


def read_reconciled(spark: SparkSession, prefix: str, suffix: str = ".parquet", file_col: str | None = None) -> DataFrame:
    """All files below ``prefix`` as one table; a missing column is NULL, a column has the widest of its types.

    Columns come in the order in which the schemas (most files first) name them.  ``file_col`` adds each row's file.
    """
    from ..session import cut_lineage
    schemas = cut_lineage(file_schemas(spark, prefix, suffix), "footers")
    groups = schemas.groupBy("columns").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("path")).alias("paths"))
    groups = sorted(groups.collect(), key=lambda r: (-r["n"], r["columns"]))  # a row per distinct schema
    if not groups:
        raise ValueError(f"no {suffix} files under {prefix}")
    types: dict[str, str] = {}
    for g in groups:
        for name, t in json.loads(g["columns"]):
            types[name] = widest(types[name], t) if name in types else t
    out = None
    for g in groups:
        own = dict(json.loads(g["columns"]))
        df = spark.read.schema(", ".join(f"`{n}` {t}" for n, t in own.items())).parquet(*g["paths"])
        cols = [F.col(f"`{n}`").cast(t).alias(n) if n in own else F.lit(None).cast(t).alias(n) for n, t in types.items()]
        df = df.select(*cols, *([F.input_file_name().alias(file_col)] if file_col else []))
        out = df if out is None else out.unionByName(df)
    return out
