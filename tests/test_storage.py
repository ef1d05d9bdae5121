from datetime import date

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import competitors as comp, elasticity as el
from pricepanel.sources import io, reconcile
from pricepanel.streaming import partitions as P


def test_widest():
    w = reconcile.widest
    assert w("int", "bigint") == "bigint" and w("int", "double") == "double" and w("smallint", "float") == "float"
    assert w("date", "timestamp") == "timestamp" and w("int", "string") == "string"
    assert w("decimal(5,2)", "decimal(8,1)") == "decimal(9,2)" and w("decimal(5,2)", "int") == "decimal(12,2)"
    assert w("decimal(5,2)", "double") == "double"
    with pytest.raises(ValueError):
        w("array<int>", "int")


def test_files_of_different_types_are_stacked(spark, tmp_path):
    base = f"file://{tmp_path}/t"
    spark.createDataFrame([(1, "a", 2)], "k int, s string, only_a int").write.parquet(f"{base}/a")
    spark.createDataFrame([(2.5, "b")], "k double, s string").write.parquet(f"{base}/b")
    spark.createDataFrame([(2**40, 7, date(2024, 1, 1))], "k bigint, s int, d date").write.parquet(f"{base}/c")
    with pytest.raises(Exception):  # what Spark's own merge does with them
        spark.read.option("mergeSchema", "true").parquet(f"{base}/a", f"{base}/b").collect()
    out = reconcile.read_reconciled(spark, base, file_col="file")
    assert dict(out.dtypes) == {"k": "double", "s": "string", "only_a": "int", "d": "date", "file": "string"}
    assert sorted(tuple(r)[:1] + (r.s, r.only_a, r.d) for r in out.collect()) == [
        (1.0, "a", 2, None), (2.5, "b", None, None), (float(2**40), "7", None, date(2024, 1, 1))]
    with pytest.raises(Exception):
        reconcile.read_reconciled(spark, f"{base}/a/none")


def test_only_touched_months_are_rewritten(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    day = lambda m, d: date(2024, m, d)
    first = [(day(m, d), float(m)) for m in (1, 2, 3) for d in (1, 2)]
    schema = "date date, v double"
    assert P.upsert_by_month(spark, path, spark.createDataFrame([*first, (None, 1.0)], schema)) == ["2024_01", "2024_02", "2024_03"]
    files = lambda m: sorted(x.name for x in (tmp_path / "s" / f"_month=2024_{m:02d}").iterdir())
    before = {m: files(m) for m in (1, 2, 3)}
    fresh = spark.createDataFrame([(day(3, 2), 9.0), (day(3, 2), 8.0), (day(3, 3), 5.0), (day(1, 15), 7.0)], schema)
    for _ in range(2):  # again gives the same
        assert P.upsert_by_month(spark, path, fresh) == ["2024_01", "2024_03"]
        assert files(2) == before[2] and files(1) != before[1]
        got = sorted((r.date, r.v) for r in P.read_series(spark, path).collect())
        assert got == sorted([x for x in first if x[0] != day(3, 2)] + [(day(3, 2), 9.0), (day(3, 3), 5.0), (day(1, 15), 7.0)])
    assert P.read_series(spark, path, ["2024_02"]).count() == 2
    assert "Aggregate" not in P.read_series(spark, path)._jdf.queryExecution().toString()
    assert P.upsert_by_month(spark, path, fresh.limit(0)) == []


def test_bucketed_tables_join_without_exchange(spark, sf_small):
    from pricepanel.plans import queries as Q
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = Q.bucketed_join(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_report_of_the_write(spark, tmp_path):
    rows = [("p", "c", 1.0, 1.0, i < 2, i == 5, i < 2 or i == 5) for i in range(10)]
    flagged = spark.createDataFrame(rows, "product_code string, competitor_name string, normalized_price double, baseline double, "
                                    "is_high_outlier boolean, is_low_outlier boolean, is_outlier boolean")
    report = comp.write_with_report(flagged, f"file://{tmp_path}/clean")
    assert report.collect() == comp.outlier_report(flagged).collect()
    assert spark.read.parquet(f"file://{tmp_path}/clean").count() == 7


def test_own_curve_equals_the_grouped_regression(spark):
    rows = spark.createDataFrame([("a", 2.0, 5.0), ("a", 2.0, 1.0), ("a", 3.0, 4.0), ("a", 5.0, 1.0), ("b", 2.0, 1.0), ("b", 2.0, 3.0),
                                  ("c", 1.0, 0.0), ("c", 2.0, 4.0), ("c", 4.0, 4.0), ("d", -1.0, 4.0)],
                                 "product_code string, p double, q double")
    points = el.price_points(rows, "p", "q")
    own = {r.product_code: r for r in el.fit_custom_curves(points, el.power_law, "slope double, intercept double, r2 double, n long").collect()}
    want = {r.product_code: r for r in el.fit_demand_curves(points, "price", "quantity").collect()}
    assert own.keys() == want.keys() == {"a", "c"}
    for k in own:
        assert tuple(own[k])[1:] == pytest.approx(tuple(want[k])[1:])
    line = el.fit_custom_curves(points, lambda p, q: (float(p[0]), len(p)), "lowest double, n long").collect()
    assert sorted(map(tuple, line)) == [("a", 2.0, 3), ("b", 2.0, 1), ("c", 1.0, 3)]
    with pytest.raises(Exception, match="prices, more than 2"):
        el.fit_custom_curves(points, el.power_law, "s double, i double, r double, n long", max_points=2).collect()


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_own_curves_of_many_keys_in_a_batch(spark, batch):
    """A key's prices are fitted together wherever an Arrow batch ends, and no key has an exchange with Python of its own."""
    given = {(None, 1): 5, ("", 1): 1, ("a", None): 3, ("a", 1): 4, ("a", 2): 1, ("b", 1): 2, ("c", 9): 7}
    rows = [(k, n, float(p), p if k != "b" else None) for (k, n), size in given.items() for p in range(size, 0, -1)]
    points = spark.createDataFrame(rows, "k string, n int, price double, quantity long").repartition(3)

    def seen(price, quantity):
        out = (len(price), price.tolist(), str(quantity.dtype))
        price[:] = quantity[:] = 0  # the arrays are the function's own
        return None if out[0] == 2 else out

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = el.fit_custom_curves(points, seen, "size int, prices array<double>, kind string", ["k", "n"])
        got = [tuple(r) for r in out.collect()]
        with pytest.raises(Exception, match=r"\['c', 9\] has .* prices, more than 6"):
            el.fit_custom_curves(points, seen, "size int, prices array<double>, kind string", ["k", "n"], max_points=6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out.dtypes == [("k", "string"), ("n", "int"), ("size", "int"), ("prices", "array<double>"), ("kind", "string")]
    assert sorted(got, key=str) == sorted(((*key, size, [float(p + 1) for p in range(size)], "int64")
                                           for key, size in given.items() if key[0] != "b"), key=str)
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    assert el.fit_custom_curves(points.limit(0), seen, "size int, prices array<double>, kind string", "k").collect() == []


def test_power_law_values():
    import numpy as np
    price, quantity = np.array([2.0, 3.0, 5.0, 7.0]), np.array([6.0, 0.0, 4.0, 1.0])
    x, y = np.log([2.0, 5.0, 7.0]), np.log([6.0, 4.0, 1.0])
    slope = np.cov(x, y)[0, 1] / np.var(x, ddof=1)
    assert el.power_law(price, quantity) == pytest.approx((slope, y.mean() - slope * x.mean(), np.corrcoef(x, y)[0, 1] ** 2, 3))
    assert el.power_law(price, np.full(4, 3.0)) == (0.0, pytest.approx(np.log(3.0)), 1.0, 4)
    assert el.power_law(np.full(4, 2.0), quantity) is None and el.power_law(price[:1], quantity[:1]) is None
    assert el.power_law(price, np.full(4, np.nan)) is None and el.power_law(price[:0], quantity[:0]) is None


def test_bad_csv_lines(spark, tmp_path):
    lines = ["a,b,c", "1,2,3", "1,2", "1,2,3,4", "1,2,3,", '1,2,3,""', '"x,y",2,3', '"say ""hi, you""",2,3', '1,"2,2",3,4',
             'm"n,2,3', '"a,b","c,d","e,f"', '"a,b","c,d","e,f","g"', "1,2,"]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    got = [tuple(r) for r in io.read_csv_skip_bad(spark, f"file://{tmp_path}/f.csv", ["a", "b", "c"]).collect()]
    assert got == [("1", "2", "3"), ("1", "2", None), ("x,y", "2", "3"), ('say "hi, you"', "2", "3"), ('m"n', "2", "3"),
                   ("a,b", "c,d", "e,f"), ("1", "2", None)]
    one = io.read_csv_skip_bad(spark, f"file://{tmp_path}/f.csv", ["a", "b", "c"]).select("a")
    assert one.count() == len(got)  # the same whichever columns are read


def test_file_subset(spark, tmp_path):
    base = f"file://{tmp_path}/m"
    spark.range(400).withColumn("k", F.col("id") % 40).repartition("k").write.partitionBy("k").parquet(base)
    got = {r.k: r["n"] for r in io.read_file_subset(spark, base, 50).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert 8 <= len(got) <= 32 and set(got.values()) == {10}  # whole files
    assert got.keys() == {r.k for r in io.read_file_subset(spark, base, 50).select("k").distinct().collect()}
    assert io.read_file_subset(spark, base, 0).select("k").distinct().count() == 1
    assert io.read_file_subset(spark, base, 100).count() == 400
    with pytest.raises(Exception):
        io.read_file_subset(spark, f"{base}/none")
