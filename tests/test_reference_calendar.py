import datetime as dt


from pricepanel.operators import calendar as cal
from pricepanel.operators import reference as ref

D = dt.date


def test_cpi_interpolation_endpoint_inclusive_and_last_month_flat(spark):
    monthly = spark.createDataFrame([(D(2024, 2, 1), 100.0), (D(2024, 3, 1), 128.0), (D(2024, 5, 1), 130.0)],
                                    "month_year date, cpi double")
    daily = {r.date: r.cpi for r in ref.interpolate_cpi(monthly).collect()}
    assert daily[D(2024, 2, 1)] == 100.0 and daily[D(2024, 2, 2)] == 101.0 and daily[D(2024, 2, 29)] == 128.0
    # missing April: March..April interpolates to the May value over 61 days
    assert abs(daily[D(2024, 4, 30)] - 130.0) < 1e-12
    assert daily[D(2024, 5, 31)] == 130.0 and D(2024, 6, 1) not in daily


def test_cpi_carry_forward(spark):
    monthly = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 2, 1), 2.0)], "month_year date, cpi double")
    out = {r.month_year: r.cpi for r in ref.carry_cpi_forward(monthly, "2024-04-15").collect()}
    assert out == {D(2024, 1, 1): 1.0, D(2024, 2, 1): 2.0, D(2024, 3, 1): 2.0, D(2024, 4, 1): 2.0, D(2024, 5, 1): 2.0}


def test_easter_and_holidays(spark):
    years = spark.createDataFrame([(2024,), (2025,)], "year int")
    hol = {r.date: r.holiday for r in cal.holiday_calendar(years).collect()}
    assert hol[D(2024, 3, 31)] == cal.EASTER_SUNDAY and hol[D(2025, 4, 20)] == cal.EASTER_SUNDAY
    assert hol[D(2024, 6, 16)] == cal.FATHERS_DAY and hol[D(2024, 5, 12)] == cal.MOTHERS_DAY
    assert hol[D(2024, 4, 27)] == cal.KINGS_DAY


def test_holiday_distance(spark):
    dates = spark.createDataFrame([(D(2024, 12, 20),), (D(2024, 12, 25),)], "date date")
    out = {r.date: (r.time_until_next_holiday, r.time_after_previous_holiday)
           for r in cal.add_holiday_features(dates).collect()}
    assert out[D(2024, 12, 25)] == (0, 0)
    assert out[D(2024, 12, 20)] == (4, 15)  # next: Kerstavond 24 Dec; previous: Sinterklaas 5 Dec


def test_calendar_flags(spark):
    df = spark.createDataFrame([(D(2024, 3, 31),), (D(2024, 4, 1),)], "date date")
    r = {x.date: x for x in cal.calendar_features(df).collect()}
    assert r[D(2024, 3, 31)].is_quarter_end and r[D(2024, 4, 1)].is_quarter_start
    assert r[D(2024, 4, 1)].day_of_week == 0


def test_incremental_append_keeps_latest(spark):
    existing = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0)], "date date, v double")
    fresh = spark.createDataFrame([(D(2024, 1, 2), 2.5), (D(2024, 1, 3), 3.0)], "date date, v double")
    out = {r.date: r.v for r in ref.append_incremental(existing, fresh).collect()}
    assert out == {D(2024, 1, 1): 1.0, D(2024, 1, 2): 2.5, D(2024, 1, 3): 3.0}


def test_streaming_incremental_append_two_landings(spark, tmp_path):
    from pricepanel.streaming import incremental as inc
    base = str(tmp_path)
    schema = "date date, v double"
    inc.seed_table(spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0)], schema), f"{base}/seed")
    first = spark.createDataFrame([(D(2023, 12, 31), 9.0), (D(2024, 1, 2), 2.5), (D(2024, 1, 3), 3.0)], schema)
    first.write.parquet(f"{base}/landing/batch1")
    inc.run_incremental_append(spark, f"{base}/landing/*", f"{base}/stream", f"{base}/ckpt", first.schema)
    second = spark.createDataFrame([(D(2024, 1, 3), 3.5), (D(2024, 1, 4), 4.0)], schema)
    second.write.parquet(f"{base}/landing/batch2")
    inc.run_incremental_append(spark, f"{base}/landing/*", f"{base}/stream", f"{base}/ckpt", first.schema)
    out = {r.date: r.v for r in inc.current_view(spark, f"{base}/seed", f"{base}/stream").collect()}
    # a backfilled day is kept; revised days replace stored ones
    assert out == {D(2023, 12, 31): 9.0, D(2024, 1, 1): 1.0, D(2024, 1, 2): 2.5, D(2024, 1, 3): 3.5, D(2024, 1, 4): 4.0}
