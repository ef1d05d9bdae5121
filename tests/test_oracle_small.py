"""The driver's correctness gate in miniature: every SQL-checkable query vs DuckDB at sf0.001."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SLOW = {"demand_model_predict", "leakage_check", "time_cv", "model_elasticity"}


def test_all_oracles_match(spark, sf_small):
    import duckdb

    import __spark_entry__ as E
    from check_oracle import TABLES, norm
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    failures = []
    for name, sql in E.oracle_sql().items():
        if name in SLOW:
            continue
        s = E.queries()[name](spark, sf_small).toPandas()
        d = con.sql(sql).df()
        if sorted(s.columns) != sorted(d.columns) or norm(s) != norm(d):
            failures.append(name)
    assert not failures, failures


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0


def test_same_result_under_1_and_200_partitions(spark, sf_small):
    import __spark_entry__ as E
    from check_oracle import norm
    q = E.queries()
    results = []
    for parts in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append([norm(q[n](spark, sf_small).toPandas()) for n in
                        ("price_outlier_filter", "rolling_unique_stores", "quality_tiers")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
