"""DuckDB oracle SQL for every registered query.

The canonical tables of ``sources/testdata.py`` are restated here as plain SQL
CTEs over the driver's views, so the oracle is independent of the Spark code.
``R6(x)`` rounds half away from zero on the decimal value, as the Spark side does.
"""

from __future__ import annotations


def R(expr: str, d: int = 6) -> str:
    """Rounds half away from zero on the double itself."""
    scale = float(10 ** d)
    return f"(CAST(sign({expr}) AS DOUBLE) * CAST(floor(abs({expr}) * {scale} + 0.5) AS DOUBLE) / {scale} + 0.0)"


def FSUM(expr: str, scale: int) -> str:
    """Sum of a fixed-point column: a plain sum, freed of its noise at the end."""
    return f"round(sum({expr}), {scale})"


SALES = """sales AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_code, l_suppkey AS store_code,
         CAST(l_shipdate AS DATE) AS date, l_quantity AS quantity_sold,
         l_extendedprice / l_quantity AS product_selling_price,
         l_extendedprice AS revenue_before, l_extendedprice * (1 - l_discount) AS revenue_after,
         l_discount > 0 AS promotion_indicator, l_discount AS discount,
         l_linestatus AS product_status, l_returnflag AS return_flag, l_orderkey, l_linenumber
  FROM lineitem)"""

PART = """pdim AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_code, p_type AS category_name_level1,
         CAST(p_size AS VARCHAR) AS category_name_level2, p_brand AS brand_name,
         p_retailprice AS recommended_retail_price
  FROM part)"""


def _day_agg(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT product_code, date, quantity_sold, revenue_before, revenue_after, promotion_indicator, n_lines,
         revenue_before / quantity_sold AS product_selling_price
  FROM (SELECT product_code, date, sum(quantity_sold) AS quantity_sold,
               {FSUM('revenue_before', 2)} AS revenue_before,
               {FSUM('revenue_after', 4)} AS revenue_after,
               bool_or(promotion_indicator) AS promotion_indicator, count(*) AS n_lines
        FROM {src} GROUP BY product_code, date))"""


PANEL = _day_agg("sales", "panel")

BRAND_ROWS = """brand_rows AS (
  SELECT s.* EXCLUDE (product_code), s.product_code AS part_code, p.p_brand AS product_code
  FROM sales s JOIN part p ON s.product_code = CAST(p.p_partkey AS VARCHAR))"""

BRAND_PANEL = _day_agg("brand_rows", "bpanel")

COMP = """comp AS (
  SELECT p.p_brand AS product_code, r.r_name AS competitor_name, CAST(l.l_shipdate AS DATE) AS price_date,
         l.l_extendedprice / l.l_quantity AS normalized_price, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ---------------------------------------------------------------- competitors
OUTLIER_FLAGS = f"""flagged AS (
  SELECT *, CASE WHEN rc >= 5 THEN rm ELSE bm END AS baseline FROM (
    SELECT *, median(CASE WHEN obs_num <= 5 THEN normalized_price END)
                OVER (PARTITION BY product_code, competitor_name) AS bm
    FROM (SELECT *, median(normalized_price) OVER w AS rm, count(normalized_price) OVER w AS rc,
                 row_number() OVER (PARTITION BY product_code, competitor_name
                                    ORDER BY price_date, l_orderkey, l_linenumber) AS obs_num
          FROM comp WHERE normalized_price IS NOT NULL
          WINDOW w AS (PARTITION BY product_code, competitor_name ORDER BY price_date
                       RANGE BETWEEN INTERVAL 179 DAYS PRECEDING AND CURRENT ROW)))),
clean AS (
  SELECT product_code, competitor_name, price_date, normalized_price, l_orderkey, l_linenumber
  FROM flagged WHERE NOT (normalized_price > 2.0 * baseline OR normalized_price < 0.3 * baseline))"""

register("competitor_median_dedupe", with_(COMP) + f"""
SELECT product_code, price_date, competitor_name, {R('median(normalized_price)')} AS normalized_price
FROM comp GROUP BY product_code, price_date, competitor_name""")

PIVOT_COLS = [("AFRICA", "africa_price"), ("AMERICA", "america_price"), ("ASIA", "asia_price"),
              ("EUROPE", "europe_price"), ("MIDDLE EAST", "middle_east_price")]


def _pivot_sql(src: str) -> str:
    cols = ", ".join(f"max(CASE WHEN competitor_name = '{n}' THEN normalized_price END) AS {c}" for n, c in PIVOT_COLS)
    return f"""wide AS (
  SELECT product_code, price_date, {cols}
  FROM (SELECT product_code, price_date, competitor_name, median(normalized_price) AS normalized_price
        FROM {src} GROUP BY product_code, price_date, competitor_name)
  GROUP BY product_code, price_date)"""


WIDE_OUT = ", ".join(R(c) + " AS " + c for _, c in PIVOT_COLS)
register("competitor_pivot", with_(COMP, _pivot_sql("comp")) + f"SELECT product_code, price_date, {WIDE_OUT} FROM wide")

register("rolling_median_180d", with_(COMP) + f"""
SELECT product_code, competitor_name, price_date, l_orderkey, l_linenumber,
       {R('median(normalized_price) OVER w')} AS rolling_median, count(normalized_price) OVER w AS rolling_count
FROM comp WHERE normalized_price IS NOT NULL
WINDOW w AS (PARTITION BY product_code, competitor_name ORDER BY price_date
             RANGE BETWEEN INTERVAL 179 DAYS PRECEDING AND CURRENT ROW)""")

register("baseline_first_n", with_(COMP) + f"""
SELECT product_code, competitor_name, {R('median(normalized_price)')} AS baseline_median
FROM (SELECT *, row_number() OVER (PARTITION BY product_code, competitor_name
                                   ORDER BY price_date, l_orderkey, l_linenumber) AS rn
      FROM comp WHERE normalized_price IS NOT NULL)
WHERE rn <= 5 GROUP BY product_code, competitor_name""")

register("price_outlier_filter", with_(COMP, OUTLIER_FLAGS) + "SELECT * FROM clean")

register("outlier_report", with_(COMP, OUTLIER_FLAGS.split(",\nclean AS")[0]) + f"""
SELECT CAST(count_if(normalized_price > 2.0 * baseline) AS BIGINT) AS high_outliers,
       CAST(count_if(normalized_price < 0.3 * baseline) AS BIGINT) AS low_outliers,
       CAST(count_if(normalized_price > 2.0 * baseline OR normalized_price < 0.3 * baseline) AS BIGINT) AS total_outliers,
       count(*) AS rows,
       {R('count_if(normalized_price > 2.0 * baseline OR normalized_price < 0.3 * baseline) * 100.0 / count(*)')} AS outlier_pct
FROM flagged""")

register("sales_competitor_join", with_(SALES, BRAND_ROWS, BRAND_PANEL, COMP, OUTLIER_FLAGS, _pivot_sql("clean")) + f"""
SELECT b.product_code, b.date, b.quantity_sold, b.revenue_before, b.revenue_after, b.promotion_indicator,
       b.n_lines, b.product_selling_price,
       {WIDE_OUT},
       printf('%d_%02d', isoyear(b.date), week(b.date)) AS year_week
FROM bpanel b LEFT JOIN wide w ON b.product_code = w.product_code AND b.date = w.price_date""")


# ---------------------------------------------------------------- receipts -> panel
RCPT = """rcpt AS (
  SELECT p.p_brand AS product_code, l.l_suppkey AS store_code,
         strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') AS date_code, l.l_quantity AS quantity_sold,
         CASE WHEN l.l_linenumber = 7 THEN l.l_tax * 10 ELSE 0.0 END AS weight_sold,
         l.l_extendedprice / l.l_quantity AS product_selling_price,
         l.l_extendedprice * (1 - l.l_discount) / l.l_quantity AS calculated_price,
         l.l_extendedprice AS revenue_before_discount_incl_vat, l.l_discount > 0 AS promo_ind,
         l.l_linestatus AS product_status,
         """ + R("l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) / l.l_quantity", 2) + """ AS calculated_price_after_discount,
         p.p_type AS product_category_code_level1, CAST(p.p_size AS VARCHAR) AS product_category_code_level2,
         p.p_name AS product_category_code_level3,
         CASE WHEN l.l_returnflag <> 'R' THEN p.p_retailprice END AS ah_price, l.l_tax AS ah_content_factor,
         p.p_retailprice * 2 AS plus_price, l.l_discount AS plus_content_factor, substr(p.p_brand, 1, 7) AS brand_name,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

FIXED = f"""fixed AS (
  SELECT * REPLACE ({R('CASE WHEN weight_sold > 0 THEN calculated_price * quantity_sold / weight_sold ELSE product_selling_price END', 2)} AS calculated_price)
  FROM rcpt)"""

STORE_DAY = f"""sday AS (
  SELECT product_code, date, store_code, avg(product_selling_price) AS product_selling_price_mean,
         avg(calculated_price) AS calculated_price_mean, sum(quantity_sold) AS quantity_sold_sum
  FROM (SELECT *, CAST(strptime(date_code, '%Y%m%d') AS DATE) AS date FROM fixed
        WHERE product_selling_price IS NOT NULL)
  WHERE date <= DATE '1998-08-01' AND quantity_sold > 0
  GROUP BY product_code, date, store_code)"""

CHANGES = f"""chg AS (
  SELECT * FROM (
    SELECT product_code, store_code,
      {R('(product_selling_price_mean - lag(product_selling_price_mean) OVER w) * 100', 2)} AS product_selling_price_change,
      {R('(calculated_price_mean - lag(calculated_price_mean) OVER w) * 100', 2)} AS calculated_price_price_change
    FROM sday WINDOW w AS (PARTITION BY product_code, store_code ORDER BY date))
  WHERE product_selling_price_change <> 0)"""

CORR = """pairs AS (
  SELECT * FROM (
    SELECT product_code, store_code, count(*) AS n_changes,
           covar_pop(product_selling_price_change, calculated_price_price_change)
             / (stddev_pop(product_selling_price_change) * stddev_pop(calculated_price_price_change)) AS corr
    FROM chg GROUP BY product_code, store_code)
  WHERE n_changes > 1 AND corr > 0.9)"""

register("weighted_price_fix", with_(RCPT, FIXED) +
         "SELECT product_code, store_code, date_code, l_orderkey, l_linenumber, calculated_price FROM fixed")

register("store_day_agg", with_(RCPT, FIXED, STORE_DAY) + f"""
SELECT product_code, date, store_code, {R('product_selling_price_mean')} AS product_selling_price_mean,
       {R('calculated_price_mean')} AS calculated_price_mean, quantity_sold_sum FROM sday""")

register("store_price_corr", with_(RCPT, FIXED, STORE_DAY, CHANGES, CORR) +
         f"SELECT product_code, store_code, n_changes, {R('corr')} AS corr FROM pairs")

register("store_follower_select", with_(RCPT, FIXED, STORE_DAY, CHANGES, CORR) + """
SELECT * FROM fixed f WHERE EXISTS (SELECT 1 FROM pairs p WHERE p.product_code = f.product_code
                                    AND p.store_code = f.store_code)""")

USTORES = """seen AS (SELECT DISTINCT product_code, store_code, CAST(strptime(date_code, '%Y%m%d') AS DATE) AS date FROM {src}),
us AS (
  SELECT pd.product_code, pd.date,
         count(DISTINCT CASE WHEN s.date > pd.date - 7 THEN s.store_code END) AS unique_stores_last_7_days,
         count(DISTINCT s.store_code) AS unique_stores_last_30_days
  FROM (SELECT DISTINCT product_code, date FROM seen) pd
  JOIN seen s ON s.product_code = pd.product_code AND s.date <= pd.date AND s.date > pd.date - 30
  GROUP BY pd.product_code, pd.date)"""

register("rolling_unique_stores", with_(RCPT, USTORES.format(src="rcpt")) + "SELECT * FROM us")

ROLLUP = f"""
SELECT d.product_code, d.date, sum(quantity_sold) AS quantity_sold,
       {R('sum(revenue_before_discount_incl_vat)')} AS revenue_before_discount_incl_vat,
       min(unique_stores_last_7_days) AS unique_stores_last_7_days,
       min(unique_stores_last_30_days) AS unique_stores_last_30_days,
       """ + ", ".join(f"max(CASE WHEN first_store THEN {c} END) AS {c}" for c in [
    "product_selling_price", "product_category_code_level1", "product_category_code_level2",
    "product_category_code_level3", "product_status", "promo_ind", "ah_price", "plus_price", "plus_content_factor",
    "ah_content_factor", "brand_name"]) + f""",
       {R('avg(calculated_price)')} AS calculated_price,
       {R('avg(calculated_price_after_discount)')} AS calculated_price_after_discount
FROM (SELECT *, store_code = min(store_code) OVER (PARTITION BY product_code, date) AS first_store FROM dd) d
LEFT JOIN us u ON d.product_code = u.product_code AND d.date = u.date
GROUP BY d.product_code, d.date"""

register("product_day_rollup", with_(RCPT, FIXED, """dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, CAST(strptime(date_code, '%Y%m%d') AS DATE) AS date,
           row_number() OVER (PARTITION BY date_code, product_code, store_code ORDER BY l_orderkey, l_linenumber) AS rn
    FROM fixed) WHERE rn = 1)""", USTORES.format(src="dd")) + f"""
{ROLLUP}""")

register("keep_last_dedupe", with_(SALES) + """
SELECT product_code, date, store_code, quantity_sold, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY product_code, date ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn
  FROM sales) WHERE rn = 1""")


# ---------------------------------------------------------------- cleaning
PANEL_COLS = "product_code, date, quantity_sold, product_selling_price"

register("derive_price", with_(SALES) + f"""
SELECT product_code, date, l_orderkey, l_linenumber, {R('revenue_after / quantity_sold')} AS product_selling_price
FROM sales""")

register("status_filter", with_(SALES) + """
SELECT product_code, date, store_code, product_status, l_orderkey, l_linenumber FROM sales
WHERE product_status IN ('F')""")

register("price_level_filter", with_(SALES, PANEL, """stepped AS (
  SELECT * REPLACE (floor(product_selling_price / 5000) * 5000.0::DOUBLE AS product_selling_price) FROM panel)""") + f"""
SELECT {PANEL_COLS} FROM stepped WHERE product_code IN (
  SELECT product_code FROM stepped GROUP BY product_code HAVING count(DISTINCT product_selling_price) >= 5)""")

SOME_UNKNOWN = """known AS (
  SELECT * REPLACE (CASE WHEN NOT product_code LIKE '%7' THEN quantity_sold END AS quantity_sold) FROM panel)"""

register("low_seller_semi", with_(SALES, PANEL, SOME_UNKNOWN) + f"""
SELECT {PANEL_COLS} FROM known WHERE product_code IN (
  SELECT product_code FROM known GROUP BY product_code HAVING median(quantity_sold) >= 25.0)""")

register("low_seller_anti", with_(SALES, PANEL, SOME_UNKNOWN) + f"""
SELECT {PANEL_COLS} FROM known WHERE product_code NOT IN (
  SELECT product_code FROM known GROUP BY product_code HAVING median(quantity_sold) < 25.0)""")

register("iqr_filter", with_(SALES, PANEL) + f"""
SELECT {PANEL_COLS} FROM (
  SELECT *, quantile_cont(product_selling_price, 0.25) OVER (PARTITION BY product_code) AS q1,
            quantile_cont(product_selling_price, 0.75) OVER (PARTITION BY product_code) AS q3
  FROM panel)
WHERE product_selling_price >= greatest(q1 - 2.0 * (q3 - q1), 0.0)
  AND product_selling_price <= q3 + 2.0 * (q3 - q1)""")

register("live_products", with_(SALES, PANEL) + f"""
SELECT {PANEL_COLS} FROM panel WHERE product_code IN (
  SELECT product_code FROM panel GROUP BY product_code
  HAVING max(date) >= (SELECT max(date) FROM panel) - 180)""")

register("nonneg_filter", with_(SALES) + """
SELECT product_code, date, l_orderkey, l_linenumber, quantity_sold, revenue_before FROM (
  SELECT * REPLACE (CASE WHEN return_flag = 'R' THEN -quantity_sold ELSE quantity_sold END AS quantity_sold,
                    CASE WHEN discount < 0.045 THEN revenue_before WHEN discount > 0.055 THEN -revenue_before END AS revenue_before)
  FROM sales)
WHERE (quantity_sold IS NULL OR quantity_sold >= 0) AND (revenue_before IS NULL OR revenue_before >= 0)""")

register("impute_price", with_(SALES) + f"""
SELECT product_code, date, l_orderkey, l_linenumber, quantity_sold,
       {R('CASE WHEN (quantity_sold IS NULL OR quantity_sold = 0) AND calculated_price IS NULL THEN product_selling_price ELSE calculated_price END')} AS calculated_price
FROM (SELECT * REPLACE (CASE WHEN return_flag = 'R' THEN 0.0 ELSE quantity_sold END AS quantity_sold),
             CASE WHEN return_flag = 'R' THEN NULL ELSE revenue_after / quantity_sold END AS calculated_price
      FROM sales)""")

WEEKLY_UNFILLED = """wk AS (
  SELECT product_code, CAST(date_trunc('week', date) AS DATE) AS week,
         arg_max(product_selling_price, date) AS product_selling_price, sum(quantity_sold) AS quantity_sold
  FROM panel GROUP BY ALL),
grid AS (
  SELECT product_code, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
  FROM (SELECT product_code, min(week) AS lo, max(week) AS hi FROM wk GROUP BY ALL)),
wku AS (
  SELECT g.product_code, g.week, w.product_selling_price, coalesce(w.quantity_sold, 0.0) AS quantity_sold
  FROM grid g LEFT JOIN wk w ON g.product_code = w.product_code AND g.week = w.week)"""

register("weekly_resample", with_(SALES, PANEL, WEEKLY_UNFILLED) + """
SELECT product_code, week,
       last_value(product_selling_price IGNORE NULLS) OVER (PARTITION BY product_code ORDER BY week
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS product_selling_price, quantity_sold
FROM wku""")

register("zero_run_removal", with_(SALES, PANEL, WEEKLY_UNFILLED) + """
SELECT product_code, week, product_selling_price, coalesce(quantity_sold, 0.0) AS quantity_sold FROM (
  SELECT *, count(*) OVER (PARTITION BY product_code, zero, island) AS run FROM (
    SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY week)
              - row_number() OVER (PARTITION BY product_code, zero ORDER BY week) AS island
    FROM (SELECT *, (quantity_sold IS NULL OR quantity_sold = 0) AS zero FROM wku)))
WHERE NOT (zero AND run >= 7)""")

register("bounded_ffill", with_(SALES, PANEL, WEEKLY_UNFILLED) + """
SELECT product_code, week, CASE WHEN is_missing AND run <= 2 THEN prev ELSE product_selling_price END AS product_selling_price,
       quantity_sold FROM (
  SELECT *, count(*) OVER (PARTITION BY product_code, is_missing, island) AS run,
         last_value(product_selling_price IGNORE NULLS) OVER (PARTITION BY product_code ORDER BY week
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev
  FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY week)
                  - row_number() OVER (PARTITION BY product_code, is_missing ORDER BY week) AS island
        FROM (SELECT *, product_selling_price IS NULL AS is_missing FROM wku)))""")

BSC = with_(SALES, BRAND_ROWS, BRAND_PANEL, COMP, OUTLIER_FLAGS, _pivot_sql("clean"), """bsc AS (
  SELECT b.*, w.* EXCLUDE (product_code, price_date), printf('%d_%02d', isoyear(b.date), week(b.date)) AS year_week
  FROM bpanel b LEFT JOIN wide w ON b.product_code = w.product_code AND b.date = w.price_date)""")

register("sparse_competitor_share", BSC + "SELECT " + ", ".join(
    f"{R(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100')} AS {c}_null_pct" for _, c in PIVOT_COLS) + " FROM bsc")

register("weekly_iso", BSC + f"""
SELECT product_code, year_week, sum(quantity_sold) AS quantity_sold, {R(f"avg({R('product_selling_price', 2)})")} AS product_selling_price,
       min(date) AS date, """ + ", ".join(f"{R('avg(' + R(c, 2) + ')')} AS {c}" for _, c in PIVOT_COLS) + """
FROM bsc GROUP BY product_code, year_week""")

register("last_n_rows", with_(SALES, PANEL) + f"""
SELECT {PANEL_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY date DESC) AS rn FROM panel) WHERE rn <= 14""")


# ---------------------------------------------------------------- calendar & reference
DATES = "dates AS (SELECT DISTINCT date FROM sales)"

register("calendar_features", with_(SALES, DATES) + """
SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(month(date) AS INTEGER) AS month,
       CAST(year(date) AS INTEGER) AS year, day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end,
       day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS is_quarter_start,
       date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS is_quarter_end
FROM dates""")

register("calendar_features_weekly", with_(SALES, PANEL, WEEKLY_UNFILLED) + """
SELECT week AS date, CAST(week(week) AS INTEGER) AS week_of_year, CAST(year(week) AS INTEGER) AS year,
       isodow(week) = 1 AS is_week_start
FROM (SELECT DISTINCT week FROM wku)""")

EASTER = """easter AS (
  SELECT year, make_date(year, CAST((h + l - 7 * m + 114) // 31 AS INTEGER), CAST((h + l - 7 * m + 114) % 31 + 1 AS INTEGER)) AS easter
  FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
    SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
      SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM (
        SELECT *, (b - f + 1) // 3 AS g FROM (
          SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c, (year // 100) // 4 AS d,
                 (year // 100) % 4 AS e, ((year // 100) + 8) // 25 AS f FROM years))))))"""


def _nth_sunday_sql(month: int, n: int) -> str:
    first = f"make_date(year, {month}, 1)"
    return f"CAST({first} + CAST((7 - isodow({first})) % 7 + {7 * (n - 1)} AS INTEGER) AS DATE)"


HOLIDAYS = EASTER + """,
hol_rows AS (
  SELECT make_date(year, 1, 1) AS date, 'Nieuwjaarsdag' AS holiday FROM easter
  UNION ALL SELECT easter, 'Eerste paasdag' FROM easter
  UNION ALL SELECT CAST(easter + 1 AS DATE), 'Tweede paasdag' FROM easter
  UNION ALL SELECT CASE WHEN year >= 2014 THEN (CASE WHEN isodow(make_date(year, 4, 27)) = 7 THEN make_date(year, 4, 26) ELSE make_date(year, 4, 27) END)
                        ELSE (CASE WHEN isodow(make_date(year, 4, 30)) = 7 THEN make_date(year, 4, 29) ELSE make_date(year, 4, 30) END) END,
                   CASE WHEN year >= 2014 THEN 'Koningsdag' ELSE 'Koninginnedag' END FROM easter
  UNION ALL SELECT make_date(year, 5, 5), 'Bevrijdingsdag' FROM easter
  UNION ALL SELECT CAST(easter + 39 AS DATE), 'Hemelvaartsdag' FROM easter
  UNION ALL SELECT CAST(easter + 49 AS DATE), 'Eerste Pinksterdag' FROM easter
  UNION ALL SELECT CAST(easter + 50 AS DATE), 'Tweede Pinksterdag' FROM easter
  UNION ALL SELECT make_date(year, 12, 25), 'Eerste Kerstdag' FROM easter
  UNION ALL SELECT make_date(year, 12, 26), 'Tweede Kerstdag' FROM easter
  UNION ALL SELECT make_date(year, 12, 5), 'Sinterklaas' FROM easter
  UNION ALL SELECT make_date(year, 12, 24), 'Kerstavond' FROM easter
  UNION ALL SELECT """ + _nth_sunday_sql(6, 3) + """, 'Vaderdag' FROM easter
  UNION ALL SELECT """ + _nth_sunday_sql(5, 2) + """, 'Moederdag' FROM easter),
hol AS (SELECT date, string_agg(DISTINCT holiday, '; ' ORDER BY holiday) AS holiday FROM hol_rows GROUP BY date)"""

register("holiday_calendar", with_(SALES, """years AS (
  SELECT CAST(unnest(range(year(min(date)), year(max(date)) + 1)) AS INTEGER) AS year FROM sales)""", HOLIDAYS) +
         "SELECT date, holiday FROM hol")

HOLIDAY_FEATURES = """years AS (
  SELECT CAST(unnest(range(year(min(date)), year(max(date)) + 3)) AS INTEGER) AS year FROM dates),
""" + HOLIDAYS + """,
days AS (
  SELECT CAST(unnest(generate_series(CAST(make_date(year(min(date)), 1, 1) AS TIMESTAMP),
                                     CAST(max(date) + 365 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM dates),
calx AS (
  SELECT coalesce(d.date, h.date) AS date, h.holiday FROM days d FULL OUTER JOIN hol h ON d.date = h.date),
hfeat AS (
  SELECT date, coalesce(holiday, 'No holiday') AS holiday,
         CAST(first_value(CASE WHEN holiday IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - date AS INTEGER) AS time_until_next_holiday,
         CAST(date - last_value(CASE WHEN holiday IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS time_after_previous_holiday
  FROM calx)"""

register("holiday_distance", with_(SALES, DATES, HOLIDAY_FEATURES) + """
SELECT d.date, h.holiday, h.time_until_next_holiday, h.time_after_previous_holiday
FROM dates d LEFT JOIN hfeat h ON d.date = h.date""")

register("week_has_holiday", with_(SALES, DATES, HOLIDAY_FEATURES) + """
SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, bool_or(holiday <> 'No holiday') AS has_holiday
FROM hfeat GROUP BY 1""")

MONTHLY = f"""monthly AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_year,
         {FSUM('o_totalprice', 2)} / count(*) / 1000 AS cpi
  FROM orders GROUP BY 1)"""

MONTHLY_CAT = f"""monthly_cat AS (
  SELECT o_orderpriority AS category_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_year,
         {FSUM('o_totalprice', 2)} / count(*) / 1000 AS cpi
  FROM orders GROUP BY 1, 2)"""


def _interp_sql(src: str, name: str, part: str = "") -> str:
    pby = f"PARTITION BY {part}" if part else ""
    sel = f"{part}, " if part else ""
    return f"""{name} AS (
  SELECT {sel}CAST(month_year + CAST(k AS INTEGER) AS DATE) AS date,
         CASE WHEN next_c IS NULL THEN cpi WHEN k = n - 1 THEN next_c
              ELSE cpi + k * ((next_c - cpi) / CAST(n - 1 AS DOUBLE)) END AS cpi
  FROM (SELECT *, unnest(generate_series(0, n - 1)) AS k FROM (
          SELECT *, CAST(end_d - month_year AS BIGINT) + 1 AS n FROM (
            SELECT {sel}month_year, cpi, lead(cpi) OVER w AS next_c,
                   coalesce(CAST(lead(month_year) OVER w - 1 AS DATE), last_day(month_year)) AS end_d
            FROM {src} WINDOW w AS ({pby} ORDER BY month_year)))))"""


register("cpi_interpolate", with_(MONTHLY_CAT, _interp_sql("monthly_cat", "cpid", "category_name")) +
         f"SELECT category_name, date, {R('cpi')} AS cpi FROM cpid")

CPI_DAILY = _interp_sql("monthly", "cpid")

register("cpi_adjust_base_year", with_(SALES, PANEL, MONTHLY, CPI_DAILY) + f"""
SELECT p.product_code, p.date, {R('c.cpi')} AS cpi,
       {R('p.product_selling_price * ((SELECT avg(cpi) FROM cpid WHERE year(date) = 1998) / c.cpi)')} AS adjusted_price
FROM panel p LEFT JOIN cpid c ON p.date = c.date
WHERE p.date <= (SELECT max(date) FROM cpid)""")

register("cpi_adjust_first", with_(SALES, PANEL, MONTHLY, CPI_DAILY) + f"""
SELECT product_code, date, {R('cpi')} AS cpi,
       {R('coalesce(product_selling_price * (first_cpi / cpi), product_selling_price)')} AS adjusted_price
FROM (SELECT p.*, c.cpi, arg_min(CASE WHEN c.cpi IS NOT NULL THEN c.cpi END, CASE WHEN c.cpi IS NOT NULL THEN p.date END)
                           OVER (PARTITION BY p.product_code) AS first_cpi
      FROM panel p LEFT JOIN cpid c ON p.date = c.date)""")

register("cpi_carry_forward", with_(MONTHLY_CAT) + f"""
SELECT category_name, month_year, {R('cpi')} AS cpi FROM monthly_cat
UNION ALL
SELECT l.category_name, CAST(m AS DATE) AS month_year, {R('l.last_cpi')} AS cpi
FROM (SELECT category_name, arg_max(cpi, month_year) AS last_cpi FROM monthly_cat WHERE cpi IS NOT NULL GROUP BY 1) l,
     (SELECT unnest(generate_series(CAST(max(month_year) + INTERVAL 1 MONTH AS TIMESTAMP), TIMESTAMP '2002-02-01', INTERVAL 1 MONTH)) AS m
      FROM monthly_cat)""")

WEATHER = """weather AS (
  SELECT date, TG / 10 AS mean_temp, TN / 10 AS min_temp, TX / 10 AS max_temp, RH AS sum_rain, DR AS len_rain, SP AS perc_sun
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS TG, min(l_quantity) * 10 AS TN,
               max(l_quantity) * 10 AS TX, count(*) AS RH, count(DISTINCT l_suppkey) AS DR, count(DISTINCT l_partkey) AS SP
        FROM lineitem GROUP BY 1))"""

register("climatology", with_(WEATHER) + f"""
SELECT w.*, {R('avg(mean_temp) OVER (PARTITION BY month(date), day(date))')} AS mean_temp_over_years FROM weather w""")

register("weekly_weather", with_(WEATHER) + "SELECT CAST(date_trunc('week', date) AS DATE) AS week, " + ", ".join(
    R(f"round(sum({c}), 1) / count({c})", d) + f" AS {c}"
    for c, d in [("mean_temp", 1), ("min_temp", 1), ("max_temp", 1), ("sum_rain", 0), ("len_rain", 0)]) + """
FROM weather GROUP BY 1""")


# ---------------------------------------------------------------- features
SLUGS = ["africa", "america", "asia", "europe", "middle_east"]
FFILL = """ff AS (
  SELECT product_code, date, product_selling_price, promotion_indicator, """ + ", ".join(
    f"last_value({s}_price IGNORE NULLS) OVER w AS {s}_price" for s in SLUGS) + """
  FROM bsc WINDOW w AS (PARTITION BY product_code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _dist(own: str, other: str) -> str:
    return f"CASE WHEN ({own} + {other}) / 2 > 0 THEN ({own} - {other}) / (({own} + {other}) / 2) END"


LEAST = "least(" + ", ".join(f"{s}_price" for s in SLUGS) + ")"
GREATEST = "greatest(" + ", ".join(f"{s}_price" for s in SLUGS) + ")"
FEAT = """fe AS (
  SELECT *, """ + ", ".join(f"{_dist('product_selling_price', s + '_price')} AS price_distance_{s}" for s in SLUGS) + f""",
         {_dist('product_selling_price', LEAST)} AS price_distance_cheapest,
         {_dist('product_selling_price', GREATEST)} AS price_distance_most_expensive,
         CASE """ + " ".join(f"WHEN {s}_price = {LEAST} THEN '{s}'" for s in SLUGS) + """ END AS cheapest_competitor,
         CASE """ + " ".join(f"WHEN {s}_price = {GREATEST} THEN '{s}'" for s in SLUGS) + """ END AS most_expensive_competitor,
         """ + " + ".join(f"CASE WHEN {s}_price > 0 THEN 1 ELSE 0 END" for s in SLUGS) + """ AS n_pos,
         """ + " + ".join(f"CASE WHEN {s}_price > 0 THEN ln({s}_price) ELSE 0.0 END" for s in SLUGS) + """ AS sum_log
  FROM ff),
fe2 AS (
  SELECT *, """ + " + ".join(f"CASE WHEN price_distance_{s} IS NOT NULL THEN 1 ELSE 0 END" for s in SLUGS) + """ AS n_competitors_available,
         """ + " + ".join(f"CASE WHEN price_distance_{s} > 0 THEN 1 ELSE 0 END" for s in SLUGS) + """ AS n_competitors_cheaper,
         0.0 + """ + " + ".join(f"coalesce(price_distance_{s}, 0.0)" for s in SLUGS) + """ AS dist_sum,
         CASE WHEN n_pos > 0 THEN exp(sum_log / n_pos) END AS comp_price_index
  FROM fe),
fe3 AS (
  SELECT *, CASE WHEN n_competitors_available > 0 THEN dist_sum / n_competitors_available END AS price_distance_mean,
         CASE WHEN product_selling_price > 0 THEN ln(product_selling_price) END AS log_own_price,
         CASE WHEN comp_price_index > 0 THEN ln(comp_price_index) END AS log_comp_index
  FROM fe2)"""

register("competitor_ffill", BSC.rstrip() + ",\n" + FFILL + "\nSELECT product_code, date, " +
         ", ".join(f"{R(s + '_price')} AS {s}_price" for s in SLUGS) + " FROM ff")

register("price_distance", BSC.rstrip() + ",\n" + FFILL + ",\n" + FEAT + "\nSELECT product_code, date, " +
         ", ".join(f"{R('price_distance_' + s)} AS price_distance_{s}" for s in SLUGS + ["cheapest", "most_expensive"]) +
         " FROM fe3")

register("competitor_extremes", BSC.rstrip() + ",\n" + FFILL + ",\n" + FEAT +
         "\nSELECT product_code, date, cheapest_competitor, most_expensive_competitor FROM fe3")

register("competitor_counts", BSC.rstrip() + ",\n" + FFILL + ",\n" + FEAT + f"""
SELECT product_code, date, {R('price_distance_mean')} AS price_distance_mean,
       CAST(n_competitors_cheaper AS INTEGER) AS n_competitors_cheaper,
       CAST(n_competitors_available AS INTEGER) AS n_competitors_available FROM fe3""")

register("competitor_index", BSC.rstrip() + ",\n" + FFILL + ",\n" + FEAT + f"""
SELECT product_code, date, {R('comp_price_index')} AS comp_price_index, {R('log_own_price')} AS log_own_price,
       {R('log_comp_index')} AS log_comp_index, {R('log_own_price - log_comp_index')} AS log_relative_price FROM fe3""")

LAGS = [1, 7, 14]
register("price_lags", with_(SALES, PANEL) + "SELECT product_code, date, " + ", ".join(
    f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in ["product_selling_price", "quantity_sold"] for k in LAGS) +
    " FROM panel WINDOW w AS (PARTITION BY product_code ORDER BY date)")

register("price_change_pct", with_(SALES, PANEL) + "SELECT product_code, date, " + ", ".join(
    R(f"(product_selling_price - lag(product_selling_price, {k}) OVER w) / lag(product_selling_price, {k}) OVER w * 100")
    + f" AS price_change_product_selling_price_lag_{k}" for k in LAGS) +
    " FROM panel WINDOW w AS (PARTITION BY product_code ORDER BY date)")

register("price_runs", with_(SALES, PANEL) + """
SELECT product_code, date, price_change, CAST(price_change_group AS BIGINT) AS price_change_group,
       CAST(row_number() OVER (PARTITION BY product_code, price_change_group ORDER BY date) - 1 AS INTEGER) AS days_since_last_change,
       CAST(floor((row_number() OVER (PARTITION BY product_code, price_change_group ORDER BY date) - 1) / 7) AS INTEGER) AS weeks_since_last_change
FROM (SELECT *, sum(CAST(price_change AS INTEGER)) OVER (PARTITION BY product_code ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_change_group
      FROM (SELECT *, coalesce(product_selling_price <> lag(product_selling_price) OVER (PARTITION BY product_code ORDER BY date), false) AS price_change
            FROM panel))""")


# ---------------------------------------------------------------- elasticity on observed rows
def _elastic_ctes(src: str) -> str:
    return f"""est AS (
  SELECT product_code, {R('product_selling_price', 2)} AS product_selling_price_calc,
         sum(quantity_sold) AS predicted_quantity
  FROM {src} GROUP BY 1, 2),
fits AS (
  SELECT * FROM (
    SELECT product_code, regr_slope(ln(predicted_quantity), ln(product_selling_price_calc)) AS slope,
           regr_intercept(ln(predicted_quantity), ln(product_selling_price_calc)) AS intercept,
           regr_r2(ln(predicted_quantity), ln(product_selling_price_calc)) AS r2, count(*) AS n_points
    FROM est WHERE predicted_quantity > 0 AND product_selling_price_calc > 0 GROUP BY 1)
  WHERE n_points >= 2 AND slope IS NOT NULL),
curve AS (
  SELECT e.product_code AS product_code_elasticity, e.product_selling_price_calc AS price,
         exp(f.intercept + f.slope * ln(e.product_selling_price_calc)) AS sales
  FROM est e JOIN fits f ON e.product_code = f.product_code WHERE e.product_selling_price_calc > 0),
mid AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY product_code_elasticity) AS n,
         lag(sales) OVER w AS ps, lead(sales) OVER w AS ns, lag(price) OVER w AS pp, lead(price) OVER w AS np
  FROM curve WINDOW w AS (PARTITION BY product_code_elasticity ORDER BY price, sales)),
elas AS (
  SELECT product_code, avg(e) AS elasticity FROM (
    SELECT product_code_elasticity AS product_code,
           CASE WHEN np / pp - 1 <> 0 THEN (ns / ps - 1) / (np / pp - 1) END AS e
    FROM mid WHERE n >= 3 AND rn = n // 2 + 1)
  WHERE e IS NOT NULL AND e <> 0 GROUP BY 1)"""


DAYSTD = """dstd AS (
  SELECT product_code, CASE WHEN count(slope) > 1 THEN stddev_pop(slope) END AS day_std FROM (
    SELECT product_code, yr, CASE WHEN count(*) >= 2 THEN regr_slope(ln(quantity_sold), ln(product_selling_price)) END AS slope
    FROM (SELECT *, year(date) AS yr FROM panel) WHERE quantity_sold > 0 AND product_selling_price > 0
    GROUP BY product_code, yr)
  GROUP BY product_code)"""

CPANEL = """cpanel AS (
  SELECT p.*, d.category_name_level1, d.category_name_level2 FROM panel p LEFT JOIN pdim d ON p.product_code = d.product_code)"""

register("demand_curve", with_(SALES, PANEL, _elastic_ctes("panel")) +
         f"SELECT product_code_elasticity, price, {R('sales')} AS sales FROM curve")

register("demand_fit", with_(SALES, PANEL, _elastic_ctes("panel")) +
         f"SELECT product_code, {R('slope')} AS slope, {R('intercept')} AS intercept, {R('r2')} AS r2, n_points FROM fits")

register("arc_elasticity", with_(SALES, PANEL, _elastic_ctes("panel")) +
         f"SELECT product_code, {R('elasticity')} AS elasticity FROM elas")

register("day_slope_std", with_(SALES, PANEL, DAYSTD) + f"SELECT product_code, {R('day_std')} AS day_std FROM dstd")

register("quality_tiers", with_(SALES, PANEL, _elastic_ctes("panel"), DAYSTD) + f"""
SELECT product_code, {R('elasticity')} AS elasticity, {R('r2')} AS r2, {R('day_std')} AS day_std,
       CASE WHEN day_std IS NULL THEN (CASE WHEN r2 >= 0.95 THEN 'high' WHEN r2 >= 0.80 THEN 'medium' ELSE 'low' END)
            WHEN r2 >= 0.95 AND day_std <= 0.10 THEN 'high'
            WHEN r2 >= 0.80 AND day_std <= 0.20 THEN 'medium' ELSE 'low' END AS quality_tier
FROM (SELECT e.product_code, e.elasticity, coalesce(f.r2, 0.0) AS r2, s.day_std
      FROM elas e LEFT JOIN fits f ON e.product_code = f.product_code
      LEFT JOIN dstd s ON e.product_code = s.product_code)""")


def _category_elasticity_sql(src: str) -> str:
    return f"""catel AS (
  SELECT category_name_level1, {R('median(elasticity)', 2)} AS elasticity_median, {R('avg(elasticity)', 2)} AS elasticity_mean,
         count(DISTINCT product_code) AS num_products,
         {R('sum(elasticity * total_revenue) / sum(total_revenue)', 2)} AS elasticity_weighted
  FROM (SELECT e.*, c.category_name_level1, r.total_revenue FROM elas e
        JOIN (SELECT DISTINCT product_code, category_name_level1 FROM {src} WHERE category_name_level1 IS NOT NULL) c ON e.product_code = c.product_code
        LEFT JOIN (SELECT product_code, sum(revenue_before) AS total_revenue FROM {src} GROUP BY 1) r
          ON e.product_code = r.product_code)
  GROUP BY 1 HAVING count(DISTINCT product_code) >= 5)"""


register("category_elasticity", with_(SALES, PANEL, PART, CPANEL, _elastic_ctes("cpanel"),
                                      _category_elasticity_sql("cpanel")) + "SELECT * FROM catel")

FRACTION = """frac AS (
  SELECT category_name_level{lv}, product_code, total_sales,
         total_sales / sum(total_sales) OVER (PARTITION BY category_name_level{lv}) AS sales_fraction
  FROM (SELECT category_name_level{lv}, product_code, sum(quantity_sold) AS total_sales FROM cpanel GROUP BY 1, 2))"""

register("sales_fraction", with_(SALES, PANEL, PART, CPANEL, FRACTION.format(lv=1)) +
         f"SELECT category_name_level1, product_code, total_sales, {R('sales_fraction')} AS sales_fraction FROM frac")

register("category_elasticity_qty", with_(SALES, PANEL, PART, CPANEL, _elastic_ctes("cpanel"), FRACTION.format(lv=2)) + f"""
, merged AS (
  SELECT e.product_code, e.elasticity, c.category_name_level2 FROM elas e
  JOIN (SELECT DISTINCT product_code, category_name_level2 FROM cpanel WHERE category_name_level2 IS NOT NULL) c ON e.product_code = c.product_code
  WHERE e.elasticity <= 0)
SELECT s.category_name_level2, s.elasticity_median, s.elasticity_mean, s.num_products,
       {R('w.weighted_elasticities', 2)} AS weighted_elasticities
FROM (SELECT category_name_level2, {R('median(elasticity)', 2)} AS elasticity_median, {R('avg(elasticity)', 2)} AS elasticity_mean,
             count(product_code) AS num_products FROM merged GROUP BY 1) s
JOIN (SELECT m.category_name_level2, sum(m.elasticity * f.sales_fraction) AS weighted_elasticities
      FROM merged m JOIN frac f ON m.category_name_level2 = f.category_name_level2 AND m.product_code = f.product_code
      GROUP BY 1) w ON s.category_name_level2 = w.category_name_level2
WHERE s.num_products >= 5""")

register("elasticity_summary", with_(SALES, PANEL, _elastic_ctes("panel")) + f"""
SELECT count(*) AS total_products,
       CAST(count_if(elasticity < -1 AND elasticity > -5) AS BIGINT) AS elastic_count,
       CAST(count_if(elasticity > -1 AND elasticity < 0) AS BIGINT) AS inelastic_count,
       CAST(count_if(elasticity > 0) AS BIGINT) AS positive_count,
       CAST(count_if(elasticity < -5) AS BIGINT) AS outlier_count,
       {R('median(elasticity)')} AS median_elasticity, {R('avg(elasticity)')} AS mean_elasticity,
       {R('avg(CASE WHEN elasticity > 0 THEN 100.0 ELSE 0.0 END)')} AS positive_share_pct
FROM elas""")

register("overview_stats", with_(SALES, PANEL) + """
SELECT count(DISTINCT product_code) AS n_products, count(*) AS n_rows, min(product_selling_price) AS min_price,
       max(product_selling_price) AS max_price, median(product_selling_price) AS median_price,
       min(date) AS first_date, max(date) AS last_date,
       100.0 * count_if(product_selling_price IS NULL) / count(*) AS price_null_pct
FROM panel""")

register("overview_by_category", with_(SALES, PANEL, PART, CPANEL) + f"""
SELECT CASE WHEN isodow(date) < 6 THEN category_name_level1 END AS category, count(DISTINCT product_code) AS n_products,
       count(*) AS n_rows, {R('median(product_selling_price)')} AS median_price
FROM cpanel GROUP BY 1""")

register("products_per_status", with_(SALES) +
         "SELECT product_status, count(DISTINCT product_code) AS n_products FROM sales GROUP BY 1")

register("top_categories", with_(SALES, PART) + """
SELECT category_name_level2, count(*) AS n_rows
FROM sales s LEFT JOIN pdim d ON s.product_code = d.product_code
GROUP BY 1 ORDER BY n_rows DESC, category_name_level2 LIMIT 3""")


def _client_sql(status: str) -> str:
    src = f"sales_{status}"
    return (f"{src} AS (SELECT * FROM sales WHERE product_status = '{status}'),\n" +
            _day_agg(src, f"panel_{status}") + ",\n" +
            f"""cpanel_{status} AS (SELECT p.*, d.category_name_level1 FROM panel_{status} p
                LEFT JOIN pdim d ON p.product_code = d.product_code),\n""" +
            _elastic_ctes(f"cpanel_{status}").replace("est AS", f"est_{status} AS").replace("FROM est", f"FROM est_{status}")
            .replace("fits AS", f"fits_{status} AS").replace("JOIN fits", f"JOIN fits_{status}")
            .replace("curve AS", f"curve_{status} AS").replace("FROM curve", f"FROM curve_{status}")
            .replace("mid AS", f"mid_{status} AS").replace("FROM mid", f"FROM mid_{status}")
            .replace("elas AS", f"elas_{status} AS") + ",\n" +
            _category_elasticity_sql(f"cpanel_{status}").replace("catel AS", f"catel_{status} AS")
            .replace("FROM elas e", f"FROM elas_{status} e"))


register("union_clients", with_(SALES, PART, _client_sql("F"), _client_sql("O")) + """
SELECT *, 'F' AS client FROM catel_F UNION ALL SELECT *, 'O' AS client FROM catel_O""")


# ---------------------------------------------------------------- grid & simulation
def _ladder_sql(p: str) -> str:
    lo, hi = f"({p} * CAST(0.9 AS DOUBLE))", f"({p} * CAST(1.1 AS DOUBLE))"
    return R(f"CASE WHEN g = 20 THEN {hi} ELSE g * (({hi} - {lo}) / 20.0) + {lo} END", 2)


register("train_test_split", with_(SALES, PANEL) + """
SELECT product_code, date, date >= CAST(max(date) OVER (PARTITION BY product_code) - 13 AS DATE) AS is_test FROM panel""")

register("price_grid", with_(SALES, PANEL) + f"""
SELECT product_code, date, sequence_number, CAST(g AS INTEGER) AS grid_idx, {_ladder_sql('product_selling_price')} AS price
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_code ORDER BY date) - 1 AS INTEGER) AS sequence_number
      FROM (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY date DESC) <= 14)) r,
     unnest(generate_series(0, 20)) AS t(g)
WHERE product_selling_price > 0""")

MODEL = BSC.rstrip() + ",\n" + FFILL + ",\n" + FEAT + """,
mp AS (
  SELECT *, """ + ", ".join(f"lag(product_selling_price, {k}) OVER w AS product_selling_price_lag_{k}" for k in LAGS) + """
  FROM fe3 WINDOW w AS (PARTITION BY product_code ORDER BY date)),
tst AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_code ORDER BY date) - 1 AS INTEGER) AS sequence_number
  FROM (SELECT * FROM mp QUALIFY date >= CAST(max(date) OVER (PARTITION BY product_code) - 13 AS DATE))),
xp AS (
  SELECT r.* EXCLUDE (product_selling_price, promotion_indicator, """ + ", ".join(
    f"product_selling_price_lag_{k}" for k in LAGS) + f"""),
         CAST(g AS INTEGER) AS grid_idx, {_ladder_sql('r.product_selling_price')} AS product_selling_price,
         false AS promotion_indicator, """ + ", ".join(
    f"r.product_selling_price_lag_{k} AS old_lag_{k}" for k in LAGS) + """
  FROM tst r, unnest(generate_series(0, 20)) AS t(g) WHERE r.product_selling_price > 0),
xp2 AS (
  SELECT *, """ + ", ".join(
    f"CASE WHEN {k} <= sequence_number THEN product_selling_price ELSE old_lag_{k} END AS product_selling_price_lag_{k}"
    for k in LAGS) + """ FROM xp)"""

register("counterfactual_expand", MODEL + "\nSELECT product_code, date, sequence_number, grid_idx, product_selling_price, " +
         ", ".join(f"product_selling_price_lag_{k}" for k in LAGS) + ", promotion_indicator FROM xp2")

_RS_DIST = ", ".join(f"{_dist('product_selling_price', s + '_price')} AS d_{s}" for s in SLUGS)
register("resimulated_features", MODEL + f""",
rs AS (
  SELECT *, {_RS_DIST},
         {_dist('product_selling_price', LEAST)} AS d_cheapest, {_dist('product_selling_price', GREATEST)} AS d_most_expensive,
         CASE WHEN product_selling_price > 0 THEN ln(product_selling_price) END AS new_log_own
  FROM xp2),
rs2 AS (
  SELECT *, """ + " + ".join(f"CASE WHEN d_{s} IS NOT NULL THEN 1 ELSE 0 END" for s in SLUGS) + """ AS n_av,
         """ + " + ".join(f"CASE WHEN d_{s} > 0 THEN 1 ELSE 0 END" for s in SLUGS) + """ AS n_ch,
         0.0 + """ + " + ".join(f"coalesce(d_{s}, 0.0)" for s in SLUGS) + """ AS d_sum
  FROM rs)
SELECT product_code, date, sequence_number, grid_idx, """ + ", ".join(
    R(f"CASE WHEN product_selling_price_lag_{k} <> 0 THEN (product_selling_price - product_selling_price_lag_{k}) / product_selling_price_lag_{k} * 100 END")
    + f" AS price_change_product_selling_price_lag_{k}" for k in LAGS) + ", " + ", ".join(
    f"{R('d_' + s)} AS price_distance_{s}" for s in SLUGS + ["cheapest", "most_expensive"]) + f""",
       {R('CASE WHEN n_av > 0 THEN d_sum / n_av END')} AS price_distance_mean,
       {R('new_log_own')} AS log_own_price, {R('new_log_own - log_comp_index')} AS log_relative_price,
       CAST(n_ch AS INTEGER) AS n_competitors_cheaper, CAST(n_av AS INTEGER) AS n_competitors_available
FROM rs2""")


# ---------------------------------------------------------------- I/O round trips
register("csv_sniff_load", with_(RCPT) + """
SELECT product_code, date_code, CAST(quantity_sold AS VARCHAR) AS quantity_sold, CASE WHEN l_linenumber = 5 THEN 'p;q' END AS note
FROM rcpt WHERE l_linenumber NOT IN (6, 7)""")

register("partitioned_write_roundtrip", BSC + "SELECT * REPLACE (" + ", ".join(
    f"{R(c)} AS {c}" for _, c in PIVOT_COLS) + ") FROM bsc")

register("incremental_append", with_(WEATHER) + """
SELECT * REPLACE (CASE WHEN date >= DATE '1999-12-31' OR date_trunc('month', date) = DATE '1996-03-01' THEN mean_temp + 0.1 ELSE mean_temp END AS mean_temp)
FROM weather""")


# ---------------------------------------------------------------- smaller reference operators
LAST14 = "last14 AS (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY date DESC) <= 14)"

register("sequence_modulo", with_(SALES, PANEL, LAST14) + """
SELECT product_code, date, CAST((row_number() OVER (PARTITION BY product_code ORDER BY date) - 1) % 7 + 1 AS INTEGER) AS sequence_number
FROM last14""")

register("zero_except_middle", with_(SALES, PANEL, LAST14) + """
SELECT product_code, date,
       CASE WHEN row_number() OVER (PARTITION BY product_code ORDER BY date)
                 = count(*) OVER (PARTITION BY product_code) // 2 + 1 THEN quantity_sold ELSE 0.0 END AS quantity_sold
FROM last14""")

register("weekly_days_since_change", with_(SALES, PANEL) + """
SELECT product_code, CAST(date_trunc('week', date) AS DATE) AS week,
       CASE WHEN arg_min(CAST(price_change AS INTEGER), date) = 1 THEN 0 ELSE arg_max(days_since_last_change, date) END
         AS days_since_last_change
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_code, grp ORDER BY date) - 1 AS INTEGER) AS days_since_last_change
      FROM (SELECT *, sum(CAST(price_change AS INTEGER)) OVER (PARTITION BY product_code ORDER BY date
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
            FROM (SELECT *, coalesce(product_selling_price <> lag(product_selling_price) OVER (PARTITION BY product_code ORDER BY date), false) AS price_change
                  FROM panel)))
GROUP BY 1, 2""")

register("demand_curve_by_sequence", with_(SALES, PANEL) + f"""
SELECT product_code, sequence_number, {R('slope', 4)} AS slope, {R('intercept', 4)} AS intercept, {R('r2')} AS r2, n_points FROM (
  SELECT product_code, sequence_number, regr_slope(ln(q), ln(p)) AS slope, regr_intercept(ln(q), ln(p)) AS intercept,
         regr_r2(ln(q), ln(p)) AS r2, count(*) AS n_points
  FROM (SELECT product_code, CAST(year(date) AS INTEGER) AS sequence_number, {R('product_selling_price', 2)} AS p,
               sum(quantity_sold) AS q FROM panel GROUP BY 1, 2, 3)
  WHERE q > 0 AND p > 0 GROUP BY 1, 2)
WHERE n_points >= 2 AND slope IS NOT NULL""")

register("product_names_join", with_(SALES, PART, """names AS (
  SELECT product_code, category_name_level1, category_name_level2, brand_name FROM pdim
  UNION ALL
  SELECT product_code, 'A' || category_name_level1, category_name_level2, 'Z' || brand_name FROM pdim)""") + """
SELECT s.product_code, s.date, s.l_orderkey, s.l_linenumber, n.category_name_level1, n.category_name_level2, n.brand_name
FROM sales s LEFT JOIN (SELECT * FROM names QUALIFY row_number() OVER (
       PARTITION BY product_code ORDER BY category_name_level1, category_name_level2, brand_name) = 1) n
  ON s.product_code = n.product_code""")

register("weather_features", with_(SALES, PANEL, WEATHER) + f"""
SELECT p.product_code, p.date, w.mean_temp, w.min_temp, w.max_temp, w.sum_rain, {R('w.clim')} AS mean_temp_over_years
FROM panel p LEFT JOIN (SELECT *, avg(mean_temp) OVER (PARTITION BY month(date), day(date)) AS clim FROM weather) w
  ON p.date = w.date""")


# the asia column is emptied but for the first days of a year and goes; the other four stay
register("sparse_competitor_drop", BSC + "SELECT product_code, date, " + ", ".join(
    f"{R(c)} AS {c}" for _, c in PIVOT_COLS if c != "asia_price") + " FROM bsc")

register("cpi_period_parse", with_(MONTHLY) + f"""
SELECT month_year, {R('cpi')} AS cpi, CAST(year(month_year) AS INTEGER) AS year, CAST(month(month_year) AS INTEGER) AS month,
       CAST(day(last_day(month_year)) AS INTEGER) AS days_in_month FROM monthly""")

register("cpi_text_clean", with_(MONTHLY) + f"""
SELECT month_year, CASE WHEN month(month_year) IN (4, 7, 10)
                        THEN CAST(printf('%.3f', {R('prev_cpi', 3)}) AS DOUBLE)
                        ELSE CAST(printf('%.3f', {R('cpi', 3)}) AS DOUBLE) END AS cpi
FROM (SELECT *, lag(cpi) OVER (ORDER BY month_year) AS prev_cpi FROM monthly)""")

register("price_levels", with_(SALES, PANEL) + f"""
SELECT product_code, {R('min_price_level')} AS min_price_level, CAST(s - lo AS INTEGER) AS step,
       {R('last_price * (1 + s / 100.0)', 2)} AS price
FROM (SELECT *, CAST(round(min_price_level * 100) AS INTEGER) AS lo FROM (
        SELECT *, CASE WHEN price_80_perc < price_below_10_perc
                       THEN (round_even(price_80_perc / price_below_10_perc * 100 - 100, 0) - 10) / 100
                       ELSE -0.10 END AS min_price_level
        FROM (SELECT product_code, quantile_cont(product_selling_price, 0.8) AS price_80_perc,
                     arg_max(product_selling_price, date) AS last_price,
                     arg_max(product_selling_price, date) * 0.9 AS price_below_10_perc
              FROM panel GROUP BY 1))),
     unnest(generate_series(lo, 10)) AS t(s)""")

register("tier_filter", with_(SALES, PANEL, _elastic_ctes("panel"), DAYSTD) + """
SELECT product_code, quality_tier FROM (
  SELECT e.product_code,
         CASE WHEN s.day_std IS NULL THEN (CASE WHEN coalesce(f.r2, 0.0) >= 0.95 THEN 'high' WHEN coalesce(f.r2, 0.0) >= 0.80 THEN 'medium' ELSE 'low' END)
              WHEN coalesce(f.r2, 0.0) >= 0.95 AND s.day_std <= 0.10 THEN 'high'
              WHEN coalesce(f.r2, 0.0) >= 0.80 AND s.day_std <= 0.20 THEN 'medium' ELSE 'low' END AS quality_tier
  FROM elas e LEFT JOIN fits f ON e.product_code = f.product_code LEFT JOIN dstd s ON e.product_code = s.product_code)
WHERE quality_tier IN ('high', 'medium')""")


# ---------------------------------------------------------------- end-to-end chains
register("receipt_panel", with_(RCPT, FIXED, STORE_DAY, CHANGES, CORR, """fol AS (
  SELECT * FROM fixed f WHERE EXISTS (SELECT 1 FROM pairs p WHERE p.product_code = f.product_code
                                      AND p.store_code = f.store_code)),
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, CAST(strptime(date_code, '%Y%m%d') AS DATE) AS date,
           row_number() OVER (PARTITION BY date_code, product_code, store_code ORDER BY l_orderkey, l_linenumber) AS rn
    FROM fol) WHERE rn = 1)""", USTORES.format(src="dd")) + f"""
{ROLLUP}""")

register("preprocess_panel", with_(SALES, PANEL, PART, CPANEL, MONTHLY, CPI_DAILY, """c1 AS (
  SELECT * FROM cpanel WHERE product_code IN (
    SELECT product_code FROM cpanel GROUP BY 1 HAVING max(date) >= (SELECT max(date) FROM cpanel) - 180)),
c2 AS (
  SELECT * FROM c1 WHERE product_code IN (
    SELECT product_code FROM c1 GROUP BY 1 HAVING count(DISTINCT product_selling_price) >= 5)),
c3 AS (SELECT * FROM c2 WHERE category_name_level1 IS NOT NULL AND category_name_level2 IS NOT NULL),
c4 AS (
  SELECT * EXCLUDE (q1, q3) FROM (
    SELECT *, quantile_cont(product_selling_price, 0.25) OVER (PARTITION BY product_code) AS q1,
              quantile_cont(product_selling_price, 0.75) OVER (PARTITION BY product_code) AS q3 FROM c3)
  WHERE product_selling_price >= greatest(q1 - 2.0 * (q3 - q1), 0.0) AND product_selling_price <= q3 + 2.0 * (q3 - q1)),
c5 AS (
  SELECT * FROM c4 WHERE product_code IN (
    SELECT product_code FROM c4 GROUP BY 1 HAVING median(quantity_sold) >= 25.0))""") + f"""
SELECT p.product_code, p.date, p.quantity_sold, p.product_selling_price, p.category_name_level1, p.category_name_level2,
       {R('c.cpi')} AS cpi,
       {R('p.product_selling_price * ((SELECT avg(cpi) FROM cpid WHERE year(date) = 1998) / c.cpi)')} AS adjusted_price
FROM c5 p LEFT JOIN cpid c ON p.date = c.date
WHERE p.date <= (SELECT max(date) FROM cpid)""")


# ---------------------------------------------------------------- rows of the inventory without a chain of their own
GAPS = """gaps0 AS (
  SELECT * REPLACE (CASE WHEN epoch(date)::BIGINT // 86400 % 5 <> 0 THEN product_selling_price END AS product_selling_price,
                    CASE WHEN epoch(date)::BIGINT // 86400 % 7 <> 0 THEN quantity_sold END AS quantity_sold) FROM panel),
gaps AS (
  SELECT *, 0 AS version FROM gaps0
  UNION ALL SELECT * REPLACE (quantity_sold + 1 AS quantity_sold), 1 AS version FROM gaps0 WHERE epoch(date)::BIGINT // 86400 % 3 = 0)"""

register("weekly_resample_gaps", with_(SALES, PANEL, GAPS, """wk AS (
  SELECT product_code, CAST(date_trunc('week', date) AS DATE) AS week,
         arg_max(product_selling_price, date) FILTER (product_selling_price IS NOT NULL) AS product_selling_price,
         coalesce(sum(quantity_sold), 0) AS quantity_sold
  FROM gaps0 GROUP BY ALL)""", WEEKLY_UNFILLED[WEEKLY_UNFILLED.index("grid AS"):]) + "SELECT * FROM wku")

register("last_actual_price", with_(SALES, PANEL, GAPS) + """
SELECT product_code, arg_max(product_selling_price, date) FILTER (product_selling_price IS NOT NULL) AS product_selling_price
FROM gaps0 GROUP BY 1""")

register("preprocess_weekly", with_(SALES, PANEL, GAPS, f"""cents AS (
  SELECT * REPLACE ({R('product_selling_price', 2)} AS product_selling_price) FROM gaps),
inside AS (
  SELECT * FROM (
    SELECT *, quantile_cont(product_selling_price, 0.25) OVER (PARTITION BY product_code) AS q1,
              quantile_cont(product_selling_price, 0.75) OVER (PARTITION BY product_code) AS q3 FROM cents)
  WHERE product_selling_price >= greatest(q1 - 2.0 * (q3 - q1), 0.0) AND product_selling_price <= q3 + 2.0 * (q3 - q1)),
once AS (SELECT * FROM inside QUALIFY row_number() OVER (PARTITION BY product_code, date ORDER BY version DESC) = 1)""") + f"""
SELECT product_code, printf('%d_%02d', isoyear(date), week(date)) AS year_week, coalesce(sum(quantity_sold), 0) AS quantity_sold,
       {R('avg(product_selling_price)')} AS product_selling_price, min(date) AS date
FROM once GROUP BY 1, 2""")

register("category_elasticity_gaps", with_(SALES, PANEL, PART, CPANEL, _elastic_ctes("cpanel")) + f"""
SELECT category, {R('median(elasticity)', 2)} AS elasticity_median, count(DISTINCT product_code) AS num_products
FROM elas JOIN (SELECT DISTINCT product_code, category_name_level1 AS category FROM cpanel
                WHERE CAST(product_code AS BIGINT) % 4 <> 0 AND category_name_level1 IS NOT NULL) USING (product_code)
GROUP BY 1""")

register("column_hygiene", with_(SALES) + f"""
SELECT product_code, l_orderkey, l_linenumber, {R('quantity_sold', 2)} AS quantity_sold, {R('revenue_before', 2)} AS revenue_before,
       coalesce(CASE WHEN l_linenumber <> 1 THEN promotion_indicator END, false) AS promotion_indicator,
       {R('discount', 2)} AS note_2, 'shop' AS store_priceline_code, {R('product_selling_price', 2)} AS product_selling_price,
       date, 'demo' AS client
FROM sales WHERE return_flag NOT IN ('N', 'R')""")

register("content_factor", with_(RCPT) + f"""
SELECT product_code, date_code, l_orderkey, l_linenumber, {R('ah_price * ah_content_factor')} AS ah_price,
       {R('plus_price * plus_content_factor')} AS plus_price FROM rcpt""")

register("weighted_price_equal", with_(RCPT, FIXED) + """
SELECT product_code, store_code, date_code, l_orderkey, l_linenumber, calculated_price = product_selling_price AS is_selling_price
FROM fixed""")

register("cpi_adjust_category", with_(SALES, MONTHLY_CAT, _interp_sql("monthly_cat", "cpid", "category_name"), """based AS (
  SELECT category_name, avg(cpi) AS base FROM cpid WHERE year(date) = 1998 GROUP BY 1)""") + f"""
SELECT s.product_code, s.date, s.l_orderkey, s.l_linenumber, o.o_orderpriority AS category_name, {R('c.cpi')} AS cpi,
       {R('s.product_selling_price * (b.base / c.cpi)')} AS adjusted_price
FROM sales s JOIN orders o ON s.l_orderkey = o.o_orderkey
LEFT JOIN cpid c ON c.category_name = o.o_orderpriority AND c.date = s.date
LEFT JOIN based b ON b.category_name = o.o_orderpriority
WHERE s.date <= (SELECT max(date) FROM cpid)""")

register("read_many_roundtrip", with_(SALES, PANEL) + """
SELECT product_code, date, quantity_sold, product_selling_price, CASE WHEN year(date) < 1997 THEN revenue_before END AS revenue_before FROM panel""")

register("json_mapping_lookup", """
SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'unknown' ELSE CAST(s_nationkey AS VARCHAR) END AS code,
       CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS nation
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")

register("json_records_landed", with_(MONTHLY) + f"""
SELECT strftime(month_year, '%YMM%m') AS Perioden, {R('cpi')} AS CPI_1 FROM monthly""")

register("price_grid_persist", ORACLE["price_grid"])

register("rollups_sorted", with_(SALES, PANEL, PART, CPANEL, _elastic_ctes("cpanel"), _category_elasticity_sql("cpanel")) + """
SELECT category_name_level1, elasticity_weighted,
       CAST(row_number() OVER (ORDER BY elasticity_weighted, category_name_level1) AS INTEGER) AS place FROM catel""")

register("time_folds", with_(SALES, PANEL) + """
SELECT product_code, date, CAST(block AS INTEGER) AS block
FROM panel JOIN (SELECT date, ntile(4) OVER (ORDER BY date) - 1 AS block FROM (SELECT DISTINCT date FROM panel)) USING (date)""")

register("estimation_sums", with_(SALES, PANEL, GAPS) + f"""
SELECT g.product_code, {R('g.price', 2)} AS product_selling_price_calc, {R('sum(floor(1000.0 / g.price + 1))', 2)} AS predicted_quantity,
       {R('any_value(l.p)', 2)} AS product_selling_price
FROM ({ORACLE["price_grid"].replace("WITH " + SALES + ",", "WITH RECURSIVE " + SALES + ",")}) g
LEFT JOIN (SELECT product_code, arg_max(product_selling_price, date) FILTER (product_selling_price IS NOT NULL) AS p
           FROM gaps0 GROUP BY 1) l ON g.product_code = l.product_code
GROUP BY g.product_code, g.price""")

register("leakage_status", with_(SALES, PANEL) + f"""
SELECT {R('r2')} AS holdout_r2, CASE WHEN r2 > 0.87 THEN 'error' WHEN r2 > 0.82 THEN 'warning' ELSE 'ok' END AS status
FROM (SELECT 1 - sum((quantity_sold - guess) ** 2) / (count(*) * var_pop(quantity_sold)) AS r2
      FROM (SELECT quantity_sold, quantity_sold + day(date) % 3 - 1 AS guess FROM panel))""")

_FEATURES = (["product_code", "promotion_indicator", "product_selling_price"] + [f"price_distance_{s}" for s in SLUGS] +
             ["cheapest_competitor", "most_expensive_competitor", "price_distance_cheapest", "price_distance_most_expensive",
              "price_distance_mean", "n_competitors_cheaper", "n_competitors_available", "comp_price_index", "log_own_price",
              "log_comp_index", "log_relative_price"] + [f"price_change_product_selling_price_lag_{k}" for k in LAGS])
register("model_features", MODEL + ",\nmf AS (SELECT *, log_own_price - log_comp_index AS log_relative_price, " + ", ".join(
    f"(product_selling_price - product_selling_price_lag_{k}) / nullif(product_selling_price_lag_{k}, 0) AS price_change_product_selling_price_lag_{k}"
    for k in LAGS) + " FROM mp)\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n_values FROM mf" for c in _FEATURES))

ADJUSTED = f"""adj AS (
  SELECT b.*, c.cpi, b.product_selling_price * ((SELECT avg(cpi) FROM cpid WHERE year(date) = 1998) / c.cpi) AS adjusted_price
  FROM bsc b LEFT JOIN cpid c ON b.date = c.date WHERE b.date <= (SELECT max(date) FROM cpid))"""

register("build_features", BSC.rstrip() + ",\n" + ",\n".join([MONTHLY, CPI_DAILY, WEATHER, "dates AS (SELECT DISTINCT date FROM bsc WHERE date <= (SELECT max(date) FROM cpid))",
                                                           HOLIDAY_FEATURES, ADJUSTED]) + ",\n" +
         FFILL.replace("promotion_indicator, ", "promotion_indicator, adjusted_price, ").replace("FROM bsc", "FROM adj") + ",\n" + FEAT + f"""
SELECT f.product_code, f.date, CAST(isodow(f.date) - 1 AS INTEGER) AS day_of_week, CAST(month(f.date) AS INTEGER) AS month,
       f.date = last_day(f.date) AS is_month_end, w.mean_temp, w.sum_rain, h.holiday, h.time_until_next_holiday, """ + ", ".join(
    R(f"({c} - lag({c}, {k}) OVER p) / nullif(lag({c}, {k}) OVER p, 0) * 100") + f" AS price_change_{c}_lag_{k}"
    for c in ("product_selling_price", "adjusted_price") for k in LAGS) + f""",
       {R('price_distance_mean')} AS price_distance_mean, {R('log_own_price')} AS log_own_price,
       CAST(n_competitors_available AS INTEGER) AS n_competitors_available, coalesce(promotion_indicator, false) AS promotion_indicator
FROM fe3 f LEFT JOIN weather w ON f.date = w.date LEFT JOIN hfeat h ON f.date = h.date
WINDOW p AS (PARTITION BY product_code ORDER BY f.date)""")

register("counterfactual_two_prices", BSC.rstrip() + ",\n" + ",\n".join([MONTHLY, CPI_DAILY, ADJUSTED]) + """,
lagged AS (SELECT *, """ + ", ".join(f"lag(adjusted_price, {k}) OVER w AS al{k}" for k in LAGS) + """
  FROM adj WINDOW w AS (PARTITION BY product_code ORDER BY date)),
tst AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_code ORDER BY date) - 1 AS INTEGER) AS sequence_number
  FROM (SELECT * FROM lagged QUALIFY date >= CAST(max(date) OVER (PARTITION BY product_code) - 13 AS DATE))),
xp AS (
  SELECT *, """ + _ladder_sql("product_selling_price") + """ AS price, CAST(g AS INTEGER) AS grid_idx
  FROM tst, unnest(generate_series(0, 20)) AS t(g) WHERE product_selling_price > 0)
SELECT product_code, date, sequence_number, grid_idx, price AS product_selling_price,
       """ + R("adjusted_price * (price / product_selling_price)") + " AS adjusted_price, " + ", ".join(
    R(f"CASE WHEN {k} <= sequence_number THEN adjusted_price * (price / product_selling_price) ELSE al{k} END") + f" AS adjusted_price_lag_{k}"
    for k in LAGS) + " FROM xp")

register("demand_curve_sequences", with_(SALES, PANEL) + f""", est AS (
  SELECT product_code, CAST(year(date) AS INTEGER) AS yr, {R('product_selling_price', 0)} AS p, sum(quantity_sold) AS q
  FROM panel GROUP BY 1, 2, 3)
SELECT product_code AS product_code_elasticity, yr AS sequence_number_elasticity, p AS price,
       {R('exp(a + b * ln(p))')} AS sales
FROM est JOIN (SELECT product_code, yr, regr_slope(ln(q), ln(p)) AS b, regr_intercept(ln(q), ln(p)) AS a FROM est
               WHERE q > 0 AND p > 0 GROUP BY 1, 2 HAVING count(*) >= 2 AND regr_slope(ln(q), ln(p)) IS NOT NULL) f USING (product_code, yr)
WHERE p > 0""")

register("subset_sample", with_(SALES, PANEL) + """
SELECT * FROM panel WHERE ('0x' || substr(md5(product_code || ':42'), 1, 8))::BIGINT % 100 < 50""")

register("actual_by_sequence", with_(SALES, PANEL, LAST14, """seq AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_code ORDER BY date) - 1 AS INTEGER) AS sequence_number FROM last14)""") + f"""
SELECT a.product_code, a.sequence_number, {R('a.product_selling_price * CAST(0.9 AS DOUBLE)', 2)} AS product_selling_price_calc,
       b.product_selling_price AS product_selling_price_real
FROM seq a LEFT JOIN seq b ON a.product_code = b.product_code AND a.sequence_number = b.sequence_number AND b.sequence_number < 10
WHERE a.product_selling_price > 0""")

register("artifact_settings", f"""
SELECT '/demo_ladder_weekly' AS path, count(DISTINCT (product_code, date)) AS n FROM ({ORACLE["price_grid"]})
UNION ALL SELECT '/demo_features_weekly', count(*) FROM ({with_(SALES, PANEL)} SELECT * FROM panel)""")

_MU = "(SELECT avg(quantity_sold) FROM panel WHERE quantity_sold >= 0)"
_F = f"ln({_MU})"

register("tweedie_leaf_steps", with_(SALES, PANEL) + f""", g AS (
  SELECT product_code,
         -quantity_sold * exp(-0.24::DOUBLE * {_F}) + exp(0.76::DOUBLE * {_F}) AS g,
         0.24::DOUBLE * quantity_sold * exp(-0.24::DOUBLE * {_F}) + 0.76::DOUBLE * exp(0.76::DOUBLE * {_F}) AS h
  FROM panel WHERE quantity_sold >= 0),
leaf AS (SELECT product_code, sum(g) AS gradient, sum(h) AS hessian FROM g GROUP BY product_code)
SELECT product_code, {R('gradient')} AS gradient, {R('hessian')} AS hessian, {R('(-gradient / (hessian + 1))')} AS step FROM leaf""")

register("tweedie_deviance", with_(SALES, PANEL) + f""", d AS (
  SELECT 2 * (pow(quantity_sold, 0.76::DOUBLE) / (-0.24::DOUBLE * 0.76::DOUBLE)
              - quantity_sold * pow({_MU}, -0.24::DOUBLE) / -0.24::DOUBLE + pow({_MU}, 0.76::DOUBLE) / 0.76::DOUBLE) AS unit
  FROM panel WHERE quantity_sold >= 0)
SELECT {R('avg(unit)')} AS deviance, count(*) AS n_rows FROM d""")

register("strided_windows", with_(SALES, BRAND_ROWS, BRAND_PANEL, """ends AS (
  SELECT CAST(unnest(generate_series((SELECT max(date) FROM bpanel), (SELECT min(date) FROM bpanel), INTERVAL (-7) DAY)) AS DATE) AS e)""") + f"""
SELECT product_code, e AS date, sum(quantity_sold) AS quantity, {R('max(product_selling_price)')} AS highest_price,
       {R('median(product_selling_price)')} AS median_price, {R('avg(product_selling_price)')} AS mean_price,
       count(DISTINCT product_selling_price) AS n_prices
FROM bpanel JOIN ends ON date <= e AND date > e - INTERVAL 30 DAY GROUP BY 1, 2""")

register("read_reconciled", with_(RCPT) + """
SELECT product_code, date_code, CASE WHEN l_linenumber <= 4 THEN CAST(store_code AS DOUBLE) END AS store_code, quantity_sold,
       l_orderkey, l_linenumber FROM rcpt""")

register("upsert_by_month", with_(WEATHER) + """
SELECT * REPLACE (CASE WHEN date >= DATE '1997-12-01' THEN mean_temp + 0.1
                       WHEN date_trunc('month', date) = DATE '1996-03-01' THEN mean_temp + 0.2 ELSE mean_temp END AS mean_temp)
FROM weather""")

register("bucketed_sales_join", with_(SALES, BRAND_ROWS, BRAND_PANEL, COMP, """med AS (
  SELECT product_code, price_date, competitor_name, median(normalized_price) AS p FROM comp GROUP BY ALL)""") + f"""
SELECT b.product_code, b.date, b.quantity_sold, {', '.join(R(f"max(p) FILTER (competitor_name = '{n}')") + ' AS ' + c for n, c in PIVOT_COLS)},
       printf('%d_%02d', isoyear(b.date), week(b.date)) AS year_week
FROM bpanel b LEFT JOIN med m ON m.product_code = b.product_code AND m.price_date = b.date GROUP BY 1, 2, 3""")

register("outlier_report_observed", f"""
SELECT high_outliers, low_outliers, total_outliers, rows, outlier_pct, rows - total_outliers AS rows_written
FROM ({ORACLE["outlier_report"]})""")

register("custom_curves", with_(SALES, PANEL) + f""", est AS (
  SELECT product_code, CAST(year(date) AS INTEGER) AS yr, {R('product_selling_price', 0)} AS p, sum(quantity_sold) AS q
  FROM panel GROUP BY 1, 2, 3),
f AS (SELECT product_code, yr, regr_slope(ln(q), ln(p)) AS b, regr_intercept(ln(q), ln(p)) AS a, regr_r2(ln(q), ln(p)) AS r, count(*) AS n
      FROM est WHERE q > 0 AND p > 0 GROUP BY 1, 2 HAVING count(*) >= 2 AND regr_slope(ln(q), ln(p)) IS NOT NULL)
SELECT product_code, yr AS sequence_number, {R('b')} AS slope, {R('a')} AS intercept, {R('r')} AS r2, n AS n_points FROM f""")

register("tied_rows", with_(SALES) + """, r AS (
  SELECT *, lag(quantity_sold) OVER w AS quantity_sold_lag_1, row_number() OVER w AS rn,
         CASE WHEN return_flag <> 'R' THEN floor(product_selling_price) END AS p0
  FROM sales WINDOW w AS (PARTITION BY product_code ORDER BY date, l_orderkey, l_linenumber)),
i AS (SELECT *, rn - row_number() OVER (PARTITION BY product_code, p0 IS NULL ORDER BY rn) AS island FROM r),
c AS (SELECT *, count(*) OVER (PARTITION BY product_code, p0 IS NULL, island) AS run,
             last_value(p0 IGNORE NULLS) OVER (PARTITION BY product_code ORDER BY rn) AS prev FROM i),
f AS (SELECT *, CASE WHEN p0 IS NULL AND run <= 2 THEN prev ELSE p0 END AS p FROM c),
g AS (SELECT *, coalesce(p <> lag(p) OVER (PARTITION BY product_code ORDER BY rn), false) AS price_change FROM f),
h AS (SELECT *, sum(price_change::INT) OVER (PARTITION BY product_code ORDER BY rn)::BIGINT AS price_change_group FROM g)
SELECT product_code, date, l_orderkey, l_linenumber, quantity_sold_lag_1, p::DOUBLE AS price, price_change, price_change_group,
       (row_number() OVER (PARTITION BY product_code, price_change_group ORDER BY rn) - 1)::INTEGER AS days_since_last_change
FROM h""")
