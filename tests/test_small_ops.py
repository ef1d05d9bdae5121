import datetime as dt


from pricepanel.functions import rowwise as rw
from pricepanel.functions.scalars import iso_year_week, parse_date, year_week_key
from pricepanel.operators import clean, reference as ref, weekly
from pricepanel.sources import testdata as td

D = dt.date


def test_least_not_above_greatest_on_real_data(spark, sf_small):
    from pricepanel.plans.queries import brand_sales_competitors, WIDE_COLS
    df = brand_sales_competitors(spark, sf_small)
    bad = df.filter(rw.row_min(WIDE_COLS) > rw.row_max(WIDE_COLS)).count()
    assert bad == 0


def test_left_join_conserves_sales_rows(spark, sf_small):
    from pricepanel.plans.queries import brand_sales_competitors
    assert brand_sales_competitors(spark, sf_small).count() == td.brand_panel(spark, sf_small).count()


def test_competitor_names_ties_first_in_list(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (None, None, None)], "a_price double, b_price double, c_price double")
    out = df.select(rw.cheapest_name(["a_price", "b_price", "c_price"], ["a", "b", "c"]).alias("lo"),
                    rw.dearest_name(["a_price", "b_price", "c_price"], ["a", "b", "c"]).alias("hi")).collect()
    assert (out[0].lo, out[0].hi) == ("a", "c") and (out[1].lo, out[1].hi) == (None, None)


def test_key_formats_and_dates(spark):
    df = spark.createDataFrame([("202301", "20240105"), ("2023-01", "2024-01-06"), ("x", "bad")], "yw string, d string")
    out = df.select(year_week_key("yw").alias("k"), parse_date("d").alias("p"),
                    iso_year_week(parse_date("d")).alias("w")).collect()
    assert [r.k for r in out] == ["2023_01", "2023_01", "x"]
    assert [r.p for r in out] == [D(2024, 1, 5), D(2024, 1, 6), None]


def test_cpi_period_and_text_parsing(spark):
    raw = spark.createDataFrame([("2020MM01", 100.0), ("2020MM02", 101.0), ("2020JJ00", 100.5)],
                                "Perioden string, CPI_1 double")
    out = {r.month_year: (r.cpi, r.days_in_month) for r in ref.preprocess_cpi_periods(raw).collect()}
    assert out == {D(2020, 1, 1): (100.0, 31), D(2020, 2, 1): (101.0, 29)}
    text = spark.createDataFrame([("2020", "1,0", 0), ("2020 januari*", "100,5", 1), ("2020 februari", None, 2),
                                  ("rubbish", "1,0", 3)], "p string, v string, o int")
    got = {r.month_year: r.cpi for r in ref.clean_dutch_cpi(text, "p", "v", "o").collect()}
    assert got == {D(2020, 1, 1): 100.5, D(2020, 2, 1): 100.5}


def test_map_values_and_metadata(spark):
    df = spark.createDataFrame([("Zuivel",), ("Onbekend",)], "cat string")
    m = spark.createDataFrame([("Zuivel", "Dairy")], "key string, value string")
    out = {r.cat: r.cpi_category for r in clean.map_values(df, "cat", m, out_col="cpi_category").collect()}
    assert out == {"Zuivel": "Dairy", "Onbekend": None}
    assert clean.add_output_metadata(df, priceline="City").columns == ["cat", "priceline"]


def test_sequence_modulo_and_middle_mask(spark):
    df = spark.createDataFrame([("p", D(2024, 1, i + 1), float(i + 1)) for i in range(5)],
                               "product_code string, date date, q double")
    seq = [r.sequence_number for r in clean.sequence_modulo(df, 3).orderBy("date").collect()]
    assert seq == [1, 2, 3, 1, 2]
    mid = [r.q for r in clean.zero_except_middle(df, "q").orderBy("date").collect()]
    assert mid == [0.0, 0.0, 3.0, 0.0, 0.0]


def test_weekly_change_value(spark):
    rows = [("p", D(2024, 1, 1), True, 0), ("p", D(2024, 1, 2), False, 1),
            ("p", D(2024, 1, 9), False, 4), ("p", D(2024, 1, 10), False, 5)]
    df = spark.createDataFrame(rows, "product_code string, date date, price_change boolean, days_since_last_change int")
    out = {r.week: r.days_since_last_change for r in weekly.weekly_days_since_change(df).collect()}
    assert out == {D(2024, 1, 1): 0, D(2024, 1, 8): 5}
