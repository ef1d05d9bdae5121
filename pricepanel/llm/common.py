"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Fixed value: a word is a run of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_SPACES, _WORDS = re.compile(r"[\x20\x09-\x0D]"), re.compile(WORD)


#: Private name of a unique LONG row number that a caller may hand to an operator.
ROW = "__llm_row"


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """The input written once with a row number in ``ROW``: fixed from then on, whatever is lost or rerun."""
    return cut_lineage(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def segments(text: str, most: int = 1_000_000, back_words: int = 0) -> Iterator[str]:
    """Consecutive parts of a text of about ``most`` characters, cut at ASCII white space only.

    Each part after the first begins ``back_words`` words early (if the one before has more).  A very long
    text is worked on part by part, so memory follows ``most`` (or the longest word, if that is longer).
    """
    start, n = 0, len(text)
    while n - start > most:
        end = start + most
        m = _SPACES.search(text, end)
        if m is None:
            break
        yield text[start:m.start()]
        begins = [w.start() for w in _WORDS.finditer(text, start, m.start())] if back_words else []
        early = begins[-back_words] if len(begins) > back_words else start
        start = early if early > start else m.start()
    yield text[start:]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(col) -> F.Column:
    """Number of words as LONG; NULL text counts zero."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def join_small(df: DataFrame, dim: DataFrame, on, how: str = "inner", max_rows: int = 50_000) -> DataFrame:
    """Join with a table that is usually small: broadcast only after its rows were counted.

    ``dim`` is written once, so the count costs one pass over its result; beyond ``max_rows`` the
    join stays a shuffle join, which adaptive execution splits on skewed keys.
    """
    if dim.count() <= max_rows:
        dim = F.broadcast(dim)
    return df.join(dim, on, how)
