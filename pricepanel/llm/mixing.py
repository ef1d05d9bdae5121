"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their id.  A document's virtual finish time is the
source's cumulative tokens up to and including it, divided by the source's target; its second copy
finishes one whole round of the source later.  All copies are sorted globally by finish time and the
order is cut where the total budget is reached, so at every prefix the sources stand near their
weights.  Cumulative sums use per-partition totals; only ids, sizes and hashes are shuffled.

Targets: sources in code-point order (NULL last) get the weights in turn and share ``share`` times all
tokens; a target stops at ``cap`` times its source's tokens and the excess goes to the others by weight.

Defined cases: NULL or empty text has size 0 and is never taken; NULL source is a source of its own;
repeated rows are queued one by one; NULL ids share one hash and are ordered by row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import prefix_sums
from ..session import cut_lineage
from .common import ROW, join_small, with_rows, word_count


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per ``source`` from rows (source, size): ``source_size``, ``source_before``, ``target``.

    Water filling in closed form: sources sorted by cap / weight are capped until the common level
    (budget left over weight left) lies below their ratio.  The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", w.alias("w"), (F.lit(float(cap)) * F.col("source_size")).alias("most"),
        F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("source_before"))
    fill = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumns({
        "_left": F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0)),
        "_wleft": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        "_n": F.row_number().over(fill)}).withColumn("_level", F.col("_left") / F.col("_wleft"))
    free = F.when(F.col("_level") <= F.col("most") / F.col("w"), F.struct("_n", "_level"))
    s = s.withColumn("_first", F.min(free).over(every))
    return s.select("source", "source_size", "source_before",
                    F.least(F.col("most"), F.coalesce(F.col("w") * F.col("_first._level"), F.col("most"))).alias("target"))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, max_copies: int = 2,
        id_col: str = "doc_id", source_col: str = "source", size=None) -> DataFrame:
    """One row per document row: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``, ``row_key``.

    ``size`` is a LONG column expression (default: words of ``text``).  ``row_key`` is the input's
    ``ROW`` column if it has one, else a number given here.
    """
    size = word_count("text") if size is None else size
    key = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("row_key"),
        F.coalesce(F.conv(F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 15), 16, 10).cast("long"),
                   F.lit(0)).alias("shuffle")), "mix-sizes")
    targets = cut_lineage(source_targets(rows, weights, share, float(max_copies)), "mix-targets")
    queued, _ = prefix_sums(rows, [F.col("source").asc_nulls_last(), "shuffle", "id", "row_key"], {"size": "before"},
                            "mix-queues")
    dim = targets.withColumnRenamed("source", "_s")
    queued = join_small(queued, dim, queued["source"].eqNullSafe(dim["_s"])).drop("_s")
    finish = F.when((F.col("size") > 0) & (F.col("target") > 0),
                    (F.col("copy") * F.col("source_size") + F.col("before") - F.col("source_before") + F.col("size"))
                    / F.col("target")).otherwise(F.lit(float("inf")))
    copies = (queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
              .withColumn("finish", finish))
    lined, _ = prefix_sums(copies, ["finish", "shuffle", "id", "row_key", "copy"], {"size": "line"}, "mix-line")
    budget = targets.agg(F.sum("target")).scalar()
    kept = (F.lit(2) * F.col("line") + F.col("size")) <= F.lit(2.0) * budget
    return (lined.withColumn("kept", (kept & (F.col("size") > 0)).cast("int"))
            .groupBy("row_key").agg(
                *[F.first(c).alias(c) for c in ("id", "size", "source_size", "target")],
                F.sum("kept").cast("int").alias("copies"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), "row_key"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each as often as the mix takes it, with the input's columns."""
    keyed = with_rows(docs, "mix-docs")
    chosen = mix(keyed, **options).filter("copies > 0").select(
        F.col("row_key").alias(ROW), F.sequence(F.lit(1), F.col("copies")).alias("__llm_copies"))
    return (keyed.join(chosen, ROW).withColumn("__llm_copy", F.explode("__llm_copies")).select(*docs.columns))
