"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs one operator (or a documented chain) over the whole canonical
tables of ``sources/testdata.py``; ``plans/oracle.py`` holds the DuckDB twin.
Computed doubles are rounded to 6 dp (half away from zero) on output only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_date, round_half_up
from ..operators import competitors as comp
from ..session import cut_lineage
from ..sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TB = td.TIEBREAK
COMPETITORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
WIDE_COLS = ["africa_price", "america_price", "asia_price", "europe_price", "middle_east_price"]


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c, name=None):
    return round_half_up(c, 6).alias(name or (c if isinstance(c, str) else None))


# ---------------------------------------------------------------- competitors
OUTLIER_KW = dict(keys=("product_code", "competitor_name"), date_col="price_date",
                  price_col="normalized_price", window_days=180, high=2.0, low=0.3,
                  min_observations=5, tiebreak=TB)


@query("competitor_median_dedupe")
def q_competitor_median_dedupe(spark, d):
    out = comp.median_dedupe(td.competitor_prices(spark, d))
    return out.select("product_code", "price_date", "competitor_name", r6("normalized_price"))


@query("competitor_pivot")
def q_competitor_pivot(spark, d):
    wide = comp.pivot_competitors(comp.median_dedupe(td.competitor_prices(spark, d)))
    return wide.select("product_code", "price_date", *[r6(c) for c in WIDE_COLS])


@query("rolling_median_180d")
def q_rolling_median(spark, d):
    cp = td.competitor_prices(spark, d).filter(F.col("normalized_price").isNotNull())
    out = comp.rolling_median(cp, ["product_code", "competitor_name"], "price_date", "normalized_price", 180)
    return out.select("product_code", "competitor_name", "price_date", *TB,
                      r6("rolling_median"), "rolling_count")


@query("baseline_first_n")
def q_baseline_first_n(spark, d):
    out = comp.first_n_median(td.competitor_prices(spark, d), ["product_code", "competitor_name"],
                              "price_date", "normalized_price", 5, TB)
    return out.select("product_code", "competitor_name", r6("baseline_median"))


@query("price_outlier_filter")
def q_price_outlier_filter(spark, d):
    return comp.filter_price_outliers(td.competitor_prices(spark, d), **OUTLIER_KW)


@query("outlier_report")
def q_outlier_report(spark, d):
    return comp.outlier_report(comp.flag_price_outliers(td.competitor_prices(spark, d), **OUTLIER_KW))


def competitor_wide_clean(spark, d):
    clean = comp.filter_price_outliers(td.competitor_prices(spark, d), **OUTLIER_KW)
    return comp.pivot_competitors(comp.median_dedupe(clean), COMPETITORS)


@query("sales_competitor_join")
def q_sales_competitor_join(spark, d):
    merged = comp.merge_sales_competitors(td.brand_panel(spark, d), competitor_wide_clean(spark, d))
    return merged.select(*[r6(c) if c in WIDE_COLS else c for c in merged.columns])


# ---------------------------------------------------------------- receipts -> panel
from ..operators import panel  # noqa: E402


CUTOFF = "1998-08-01"
ROLLUP_ROUNDED = ("calculated_price", "calculated_price_after_discount", "revenue_before_discount_incl_vat")


def fixed_receipts(spark, d):
    return panel.fix_weighted_products(td.receipts(spark, d))


@query("weighted_price_fix")
def q_weighted_price_fix(spark, d):
    return fixed_receipts(spark, d).select("product_code", "store_code", "date_code", *TB, "calculated_price")


@query("store_day_agg")
def q_store_day_agg(spark, d):
    out = panel.store_day_aggregate(panel.select_rows(fixed_receipts(spark, d), CUTOFF))
    return out.select("product_code", "date", "store_code", r6("product_selling_price_mean"),
                      r6("calculated_price_mean"), "quantity_sold_sum")


@query("store_price_corr")
def q_store_price_corr(spark, d):
    changes = panel.store_price_changes(panel.store_day_aggregate(panel.select_rows(fixed_receipts(spark, d), CUTOFF)))
    return panel.store_price_correlation(changes).select("product_code", "store_code", "n_changes", r6("corr"))


@query("store_follower_select")
def q_store_follower_select(spark, d):
    return panel.select_store_followers(fixed_receipts(spark, d), CUTOFF)


@query("rolling_unique_stores")
def q_rolling_unique_stores(spark, d):
    rows = td.receipts(spark, d).withColumn("date", F.to_date("date_code", "yyyyMMdd"))
    return panel.rolling_unique_stores(rows, [7, 30])


@query("product_day_rollup")
def q_product_day_rollup(spark, d):
    out = panel.product_day_rollup(fixed_receipts(spark, d), tiebreak=TB)
    return out.select(*[r6(c) if c in ROLLUP_ROUNDED else c for c in out.columns])


@query("keep_last_dedupe")
def q_keep_last_dedupe(spark, d):
    rows = td.sales_rows(spark, d).select("product_code", "date", "store_code", "quantity_sold", *TB)
    return panel.dedupe_keep_last(rows, ["product_code", "date"], TB)


# ---------------------------------------------------------------- cleaning
from ..operators import clean, weekly  # noqa: E402

PANEL_COLS = ["product_code", "date", "quantity_sold", "product_selling_price"]


def panel_(spark, d):
    return td.daily_panel(spark, d)


@query("derive_price")
def q_derive_price(spark, d):
    rows = clean.derive_price(td.sales_rows(spark, d).drop("product_selling_price"))
    return rows.select("product_code", "date", *TB, r6("product_selling_price"))


@query("status_filter")
def q_status_filter(spark, d):
    return clean.filter_status(td.sales_rows(spark, d), ["F"]).select(
        "product_code", "date", "store_code", "product_status", *TB)


@query("price_level_filter")
def q_price_level_filter(spark, d):
    """Prices in steps of 5,000, so that some products have too few."""
    stepped = panel_(spark, d).withColumn("product_selling_price", F.floor(F.col("product_selling_price") / 5000) * 5000.0)
    return clean.filter_price_levels(stepped, 5).select(*PANEL_COLS)


def some_unknown(spark, d):
    """The panel with unknown quantities for every product whose code ends in 7: their median is NULL."""
    return panel_(spark, d).withColumn("quantity_sold", F.when(~F.col("product_code").endswith("7"), F.col("quantity_sold")))


@query("low_seller_semi")
def q_low_seller_semi(spark, d):
    """A product without a median is not kept."""
    return clean.filter_low_sellers(some_unknown(spark, d), 25.0).select(*PANEL_COLS)


@query("low_seller_anti")
def q_low_seller_anti(spark, d):
    """A product without a median is not removed."""
    return clean.remove_low_sellers(some_unknown(spark, d), 25.0).select(*PANEL_COLS)


@query("iqr_filter")
def q_iqr_filter(spark, d):
    return clean.filter_iqr(panel_(spark, d)).select(*PANEL_COLS)


@query("live_products")
def q_live_products(spark, d):
    return clean.filter_live_products(panel_(spark, d), 180).select(*PANEL_COLS)


@query("nonneg_filter")
def q_nonneg_filter(spark, d):
    """Returned lines count negative, discounts of 5 % have an unknown revenue, larger ones are refunds."""
    rows = td.sales_rows(spark, d).withColumns({
        "quantity_sold": F.when(F.col("return_flag") == "R", -F.col("quantity_sold")).otherwise(F.col("quantity_sold")),
        "revenue_before": F.when(F.col("discount") < 0.045, F.col("revenue_before")).when(
            F.col("discount") > 0.055, -F.col("revenue_before"))})
    return clean.filter_non_negative(rows, ["quantity_sold", "revenue_before"]).select(
        "product_code", "date", *TB, "quantity_sold", "revenue_before")


def returned_as_unsold(spark, d):
    """Returned lines count as unsold with an unknown list price (a NULL-producing stand-in)."""
    rows = td.sales_rows(spark, d)
    ret = F.col("return_flag") == "R"
    return (rows.withColumn("quantity_sold", F.when(ret, F.lit(0.0)).otherwise(F.col("quantity_sold")))
            .withColumn("calculated_price", F.when(ret, F.lit(None).cast("double"))
                        .otherwise(F.try_divide("revenue_after", "quantity_sold"))))


@query("impute_price")
def q_impute_price(spark, d):
    out = clean.impute_price_when_unsold(returned_as_unsold(spark, d))
    return out.select("product_code", "date", *TB, "quantity_sold", r6("calculated_price"))


def weekly_unfilled(spark, d):
    return weekly.weekly_resample(panel_(spark, d), fill=False)


@query("weekly_resample")
def q_weekly_resample(spark, d):
    return weekly.weekly_resample(panel_(spark, d))


@query("zero_run_removal")
def q_zero_run_removal(spark, d):
    return clean.remove_zero_runs(weekly_unfilled(spark, d), 7, order_col="week")


@query("bounded_ffill")
def q_bounded_ffill(spark, d):
    return clean.bounded_ffill(weekly_unfilled(spark, d), "product_selling_price", 2, order_col="week")


def brand_sales_competitors(spark, d):
    return comp.merge_sales_competitors(td.brand_panel(spark, d), competitor_wide_clean(spark, d))


@query("sparse_competitor_share")
def q_sparse_competitor_share(spark, d):
    out = comp.null_share(brand_sales_competitors(spark, d), WIDE_COLS)
    return out.select(*[r6(c) for c in out.columns])


@query("weekly_iso")
def q_weekly_iso(spark, d):
    # prices in cents, as shops have them: the means then do not sit on rounding boundaries
    rows = brand_sales_competitors(spark, d)
    rows = rows.withColumns({c: round_half_up(c, 2) for c in ["product_selling_price", *WIDE_COLS]})
    out = weekly.weekly_iso(rows, competitor_cols=WIDE_COLS)
    return out.select("product_code", "year_week", "quantity_sold", r6("product_selling_price"), "date",
                      *[r6(c) for c in WIDE_COLS])


@query("last_n_rows")
def q_last_n_rows(spark, d):
    return weekly.last_n_rows(panel_(spark, d), 14).select(*PANEL_COLS)


# ---------------------------------------------------------------- calendar & reference
from ..operators import calendar as cal  # noqa: E402
from ..operators import reference as ref  # noqa: E402

CPI_BASE_YEAR = 1998
CPI_AS_OF = "2002-01-15"


def sales_dates(spark, d):
    return td.sales_rows(spark, d).select("date").distinct()


@query("calendar_features")
def q_calendar_features(spark, d):
    return cal.calendar_features(sales_dates(spark, d))


@query("calendar_features_weekly")
def q_calendar_features_weekly(spark, d):
    weeks = weekly_unfilled(spark, d).select(F.col("week").alias("date")).distinct()
    return cal.calendar_features(weeks, frequency="weekly")


@query("holiday_calendar")
def q_holiday_calendar(spark, d):
    return cal.holiday_calendar(cal.years_of(td.sales_rows(spark, d), extra_years=0))


@query("holiday_distance")
def q_holiday_distance(spark, d):
    return cal.add_holiday_features(sales_dates(spark, d))


@query("week_has_holiday")
def q_week_has_holiday(spark, d):
    return cal.week_has_holiday(cal.holiday_features(sales_dates(spark, d)))


def cpi_daily(spark, d):
    return ref.interpolate_cpi(td.monthly_index(spark, d))


@query("cpi_interpolate")
def q_cpi_interpolate(spark, d):
    out = ref.interpolate_cpi(td.monthly_index_by_category(spark, d), category_col="category_name")
    return out.select("category_name", "date", r6("cpi"))


@query("cpi_adjust_base_year")
def q_cpi_adjust_base_year(spark, d):
    out = ref.adjust_price_base_year(panel_(spark, d), cpi_daily(spark, d), CPI_BASE_YEAR)
    return out.select("product_code", "date", r6("cpi"), r6("adjusted_price"))


@query("cpi_adjust_first")
def q_cpi_adjust_first(spark, d):
    out = ref.adjust_price_first_cpi(panel_(spark, d), cpi_daily(spark, d))
    return out.select("product_code", "date", r6("cpi"), r6("adjusted_price"))


@query("cpi_carry_forward")
def q_cpi_carry_forward(spark, d):
    out = ref.carry_cpi_forward(td.monthly_index_by_category(spark, d), CPI_AS_OF, category_col="category_name")
    return out.select("category_name", "month_year", r6("cpi"))


def weather(spark, d):
    return ref.scale_weather(td.weather_raw(spark, d))


@query("climatology")
def q_climatology(spark, d):
    out = ref.add_climatology(weather(spark, d))
    return out.select(*[r6(c) if c == "mean_temp_over_years" else c for c in out.columns])


@query("weekly_weather")
def q_weekly_weather(spark, d):
    return weekly.weekly_weather(weather(spark, d), scale=1)


# ---------------------------------------------------------------- features
from ..operators import features as feat  # noqa: E402

COMP_SLUGS = ["africa", "america", "asia", "europe", "middle_east"]
LAGS = [1, 7, 14]


def competitor_features(spark, d):
    return feat.add_competitor_features(brand_sales_competitors(spark, d), COMP_SLUGS)


@query("competitor_ffill")
def q_competitor_ffill(spark, d):
    out = feat.ffill_columns(brand_sales_competitors(spark, d), WIDE_COLS)
    return out.select("product_code", "date", *[r6(c) for c in WIDE_COLS])


@query("price_distance")
def q_price_distance(spark, d):
    cols = [f"price_distance_{c}" for c in COMP_SLUGS] + ["price_distance_cheapest", "price_distance_most_expensive"]
    return competitor_features(spark, d).select("product_code", "date", *[r6(c) for c in cols])


@query("competitor_extremes")
def q_competitor_extremes(spark, d):
    return competitor_features(spark, d).select("product_code", "date", "cheapest_competitor",
                                                "most_expensive_competitor")


@query("competitor_counts")
def q_competitor_counts(spark, d):
    return competitor_features(spark, d).select("product_code", "date", r6("price_distance_mean"),
                                                "n_competitors_cheaper", "n_competitors_available")


@query("competitor_index")
def q_competitor_index(spark, d):
    return competitor_features(spark, d).select("product_code", "date", r6("comp_price_index"), r6("log_own_price"),
                                                r6("log_comp_index"), r6("log_relative_price"))


@query("price_lags")
def q_price_lags(spark, d):
    out = feat.add_lags(panel_(spark, d), ["product_selling_price", "quantity_sold"], LAGS)
    return out.select("product_code", "date", *[c for c in out.columns if "_lag_" in c])


@query("price_change_pct")
def q_price_change_pct(spark, d):
    out = feat.add_price_changes(feat.add_lags(panel_(spark, d), ["product_selling_price"], LAGS),
                                 ["product_selling_price"], LAGS)
    return out.select("product_code", "date", *[r6(c) for c in out.columns if c.startswith("price_change_")])


@query("price_runs")
def q_price_runs(spark, d):
    out = feat.add_price_runs(panel_(spark, d))
    return out.select("product_code", "date", "price_change", "price_change_group", "days_since_last_change",
                      "weeks_since_last_change")


# ---------------------------------------------------------------- elasticity on observed rows
from ..operators import elasticity as el  # noqa: E402

PRICE_CALC = "product_selling_price_calc"


def observed_estimations(panel_df):
    """Observed stand-in for model estimations: quantity summed per (product, price in cents)."""
    return (panel_df.withColumn(PRICE_CALC, round_half_up("product_selling_price", 2))
            .groupBy("product_code", PRICE_CALC).agg(F.sum("quantity_sold").alias("predicted_quantity")))


def observed_elasticity(panel_df):
    est = cut_lineage(observed_estimations(panel_df), "estimations")  # the fits and the curve read it
    fits = el.fit_demand_curves(est, PRICE_CALC, "predicted_quantity")
    curve = el.demand_curve(est, fits, PRICE_CALC)
    return est, fits, curve, el.arc_elasticity(curve)


def category_panel(spark, d):
    cats = td.part_dim(spark, d).select("product_code", "category_name_level1", "category_name_level2")
    return panel_(spark, d).join(cats, "product_code", "left")


@query("demand_curve")
def q_demand_curve(spark, d):
    _, _, curve, _ = observed_elasticity(panel_(spark, d))
    return curve.select("product_code_elasticity", "price", r6("sales"))


@query("demand_fit")
def q_demand_fit(spark, d):
    _, fits, _, _ = observed_elasticity(panel_(spark, d))
    return fits.select("product_code", r6("slope"), r6("intercept"), r6("r2"), "n_points")


@query("arc_elasticity")
def q_arc_elasticity(spark, d):
    _, _, _, e = observed_elasticity(panel_(spark, d))
    return e.select("product_code", r6("elasticity"))


def observed_day_std(panel_df):
    return el.slope_dispersion(panel_df.withColumn("year", F.year("date")), "product_selling_price",
                               "quantity_sold", period_col="year")


@query("day_slope_std")
def q_day_slope_std(spark, d):
    return observed_day_std(panel_(spark, d)).select("product_code", r6("day_std"))


def tiered(panel_df):
    panel_df = cut_lineage(panel_df.select("product_code", "date", "product_selling_price", "quantity_sold"), "product-prices")
    _, fits, _, e = observed_elasticity(panel_df)
    return el.quality_tiers(e, fits, observed_day_std(panel_df))


@query("quality_tiers")
def q_quality_tiers(spark, d):
    out = tiered(panel_(spark, d))
    return out.select("product_code", r6("elasticity"), r6("r2"), r6("day_std"), "quality_tier")


@query("category_elasticity")
def q_category_elasticity(spark, d):
    cp = cut_lineage(category_panel(spark, d).select("product_code", "category_name_level1", "product_selling_price",
                                                     "quantity_sold", "revenue_before"), "product-prices")
    _, _, _, e = observed_elasticity(cp)
    return el.category_elasticity(e, cp, "category_name_level1")


@query("sales_fraction")
def q_sales_fraction(spark, d):
    out = el.sales_fraction(category_panel(spark, d), "category_name_level1")
    return out.select("category_name_level1", "product_code", "total_sales", r6("sales_fraction"))


@query("category_elasticity_qty")
def q_category_elasticity_qty(spark, d):
    cp = category_panel(spark, d)
    _, _, _, e = observed_elasticity(cp)
    return el.category_elasticity_qty(e, cp, "category_name_level2")


@query("elasticity_summary")
def q_elasticity_summary(spark, d):
    _, _, _, e = observed_elasticity(panel_(spark, d))
    out = el.elasticity_summary(e)
    return out.select(*[r6(c) if c in ("median_elasticity", "mean_elasticity", "positive_share_pct") else c
                        for c in out.columns])


@query("overview_stats")
def q_overview_stats(spark, d):
    return el.overview_stats(panel_(spark, d))


@query("overview_by_category")
def q_overview_by_category(spark, d):
    """Per category; weekend rows stand for rows without one."""
    rows = category_panel(spark, d).withColumn(
        "category", F.when(F.weekday("date") < 5, F.col("category_name_level1")))
    return el.overview_stats(rows, category_col="category").select("category", "n_products", "n_rows", r6("median_price"))


@query("products_per_status")
def q_products_per_status(spark, d):
    return el.products_per_category(td.sales_rows(spark, d), "product_status")


@query("top_categories")
def q_top_categories(spark, d):
    return el.top_categories(td.sales_with_categories(spark, d), "category_name_level2", 3)


@query("union_clients")
def q_union_clients(spark, d):
    frames = []
    for status in ["F", "O"]:
        rows = td.sales_rows(spark, d).filter(F.col("product_status") == status)
        cats = td.part_dim(spark, d).select("product_code", "category_name_level1")
        cp = td._day_agg(rows).join(cats, "product_code", "left")
        _, _, _, e = observed_elasticity(cp)
        frames.append((status, el.category_elasticity(e, cp, "category_name_level1")))
    return el.union_clients(frames)


# ---------------------------------------------------------------- grid & simulation
from ..operators import simulate as sim  # noqa: E402

GRID_DAYS = 14
LAG_COLS = {k: [f"product_selling_price_lag_{k}"] for k in LAGS}


def model_panel(spark, d):
    """Brand-day panel with competitor features, price lags and price changes."""
    base = competitor_features(spark, d)
    base = feat.add_lags(base, ["product_selling_price"], LAGS)
    return feat.add_price_changes(base, ["product_selling_price"], LAGS)


def expanded(spark, d):
    test = sim.split_train_test(model_panel(spark, d), GRID_DAYS).filter("is_test").drop("is_test")
    return sim.expand_counterfactual(test, lag_cols=LAG_COLS)


@query("train_test_split")
def q_train_test_split(spark, d):
    return sim.split_train_test(panel_(spark, d), GRID_DAYS).select("product_code", "date", "is_test")


@query("price_grid")
def q_price_grid(spark, d):
    grid = sim.price_grid(sim.reference_rows(panel_(spark, d), GRID_DAYS))
    return grid.select("product_code", "date", "sequence_number", F.posexplode("prices").alias("grid_idx", "price"))


@query("counterfactual_expand")
def q_counterfactual_expand(spark, d):
    return expanded(spark, d).select("product_code", "date", "sequence_number", "grid_idx", "product_selling_price",
                                     *[f"product_selling_price_lag_{k}" for k in LAGS], "promotion_indicator")


@query("resimulated_features")
def q_resimulated_features(spark, d):
    out = sim.resimulate_features(expanded(spark, d), ["product_selling_price"], LAGS, COMP_SLUGS)
    cols = ([f"price_change_product_selling_price_lag_{k}" for k in LAGS] +
            [f"price_distance_{c}" for c in COMP_SLUGS] +
            ["price_distance_cheapest", "price_distance_most_expensive", "price_distance_mean",
             "log_own_price", "log_relative_price"])
    return out.select("product_code", "date", "sequence_number", "grid_idx", *[r6(c) for c in cols],
                      "n_competitors_cheaper", "n_competitors_available")


# ---------------------------------------------------------------- demand model (rows-only checks)
from ..operators import boosting as boost  # noqa: E402
from ..operators import model as mdl  # noqa: E402

MODEL_CFG = mdl.ModelConfig(price_change_weight=2.0)


def model_inputs(spark, d):
    # the feature table feeds several fits (indexer, encoder, trees) and the expansion: one reliable
    # checkpoint into the shared checkpoint folder instead of replaying the feature lineage each time
    mp = cut_lineage(sim.split_train_test(model_panel(spark, d), GRID_DAYS))
    feats = mdl.feature_columns(mp, MODEL_CFG, WIDE_COLS)
    return mp, feats


def trained(spark, d):
    """(panel, features, model) of the folder's tables."""
    mp, feats = model_inputs(spark, d)
    return mp, feats, mdl.train_demand_model(mp.filter(~F.col("is_test")), MODEL_CFG, feats)


def predictions_per_day(spark, d):
    mp, feats, model = trained(spark, d)
    test = mp.filter("is_test").drop("is_test")
    exp = sim.resimulate_features(sim.expand_counterfactual(test, lag_cols=LAG_COLS), ["product_selling_price"],
                                  LAGS, COMP_SLUGS)
    scored = mdl.predict_quantity(model, exp)
    return mp, scored.select("product_code", "date", "predicted_quantity",
                             F.col("product_selling_price").alias("product_selling_price_calc"))


@query("demand_model_predict")
def q_demand_model_predict(spark, d):
    mp, per_day = predictions_per_day(spark, d)
    return mdl.estimations(per_day, mp)


@query("leakage_check")
def q_leakage_check(spark, d):
    mp, feats, model = trained(spark, d)
    return mdl.leakage_check(model, mp.filter("is_test"), MODEL_CFG, feats)


@query("time_cv")
def q_time_cv(spark, d):
    mp, feats = model_inputs(spark, d)
    grid = [dict(max_depth=depth, step_size=step, subsampling_rate=rate, max_bins=bins)
            for depth in (3, 5) for step in (0.06, 0.2) for rate in (0.7, 1.0) for bins in (32, 64)]
    return mdl.successive_halving(mp.filter(~F.col("is_test")), MODEL_CFG, feats, grid, n_folds=3)


@query("tweedie_holdout")
def q_tweedie_holdout(spark, d):
    """Deviance on the hold-out rows of the two losses, same trees and depth."""
    mp, feats = model_inputs(spark, d)
    train, encoded = mdl.encode_training(mp.filter(~F.col("is_test")), MODEL_CFG, feats)
    test = mp.filter("is_test").withColumn("_y", F.log1p("quantity_sold"))
    out = None
    for loss in ("squared", "tweedie"):
        cfg = replace(MODEL_CFG, loss=loss, max_iter=20, max_depth=5, step_size=0.2)
        scored = mdl.predict_quantity(mdl.fit_trees(train, encoded, cfg), test, out_col="_p")
        scored = scored.withColumn("_mean", F.greatest(F.log1p("_p"), F.lit(1e-6)))
        one = boost.tweedie_deviance(scored, "_y", "_mean", MODEL_CFG.variance_power).withColumn("loss", F.lit(loss))
        out = one if out is None else out.unionByName(one)
    return out


def scored_panel(spark, d):
    """Panel rows with the log of the overall mean quantity as score."""
    rows = panel_(spark, d).filter("quantity_sold >= 0")
    return rows.withColumn("_f", F.log(rows.agg(F.avg("quantity_sold")).scalar()))


@query("tweedie_leaf_steps")
def q_tweedie_leaf_steps(spark, d):
    """Gradient and hessian sums and the Newton step of each product (as leaf) from the overall mean."""
    y, f = F.col("quantity_sold"), F.col("_f")
    out = boost.newton_leaf_values(scored_panel(spark, d), "product_code", boost.tweedie_gradient(y, f, 1.24),
                                   boost.tweedie_hessian(y, f, 1.24))
    return out.select("product_code", *[r6(c) for c in ("gradient", "hessian", "step")])


@query("tweedie_deviance")
def q_tweedie_deviance(spark, d):
    """Mean deviance of the overall mean as prediction."""
    out = boost.tweedie_deviance(scored_panel(spark, d).withColumn("_mean", F.exp("_f")), "quantity_sold", "_mean", 1.24)
    return out.select(r6("deviance"), "n_rows")


@query("model_elasticity")
def q_model_elasticity(spark, d):
    """Entry B end to end: predictions -> curves -> arc elasticity -> day dispersion -> tiers."""
    mp, per_day = predictions_per_day(spark, d)
    est = mdl.estimations(per_day, mp)
    fits = el.fit_demand_curves(est, PRICE_CALC, "predicted_quantity")
    e = el.arc_elasticity(el.demand_curve(est, fits, PRICE_CALC))
    day_std = el.slope_dispersion(per_day, PRICE_CALC, "predicted_quantity", period_col="date")
    return el.quality_tiers(e, fits, day_std)


# ---------------------------------------------------------------- I/O round trips (rows-only checks)
from ..sources import io as pio  # noqa: E402
from ..streaming import incremental as inc  # noqa: E402

CSV_COLS = ["product_code", "date_code", "quantity_sold", "note"]


@query("csv_sniff_load")
def q_csv_sniff_load(spark, d):
    """Write receipts as ';'-separated CSV in which every 7th order line carries one field too many and every 6th an
    empty one, every 5th a quoted separator and every 4th lacks its last field; detect the separator, skip the bad lines."""
    path = pio.scratch_path(spark, "csv")
    rows = td.receipts(spark, d).select(
        "product_code", "date_code", F.col("quantity_sold").cast("string").alias("quantity_sold"),
        "l_linenumber", F.when(F.col("l_linenumber") == 7, F.lit("x;y")).when(F.col("l_linenumber") == 6, F.lit("x;"))
        .when(F.col("l_linenumber") == 5, F.lit('"p;q"')).alias("note"))
    line = F.concat_ws(";", "product_code", "date_code", "quantity_sold",
                       F.when(F.col("l_linenumber") != 4, F.coalesce("note", F.lit(""))))
    rows.select(line.alias(";".join(CSV_COLS))).write.option("header", "true").option("sep", "\u0001").option(
        "quote", "\u0000").csv(path)
    sep = pio.detect_separator(spark, path)
    return pio.read_csv_skip_bad(spark, path, CSV_COLS, sep)


@query("partitioned_write_roundtrip")
def q_partitioned_write_roundtrip(spark, d):
    """Merged sales + competitors written as year_week=YYYY_WW/part-*.parquet, size-capped, read back."""
    path = pio.scratch_path(spark, "partitioned")
    out = brand_sales_competitors(spark, d)
    pio.write_partitioned(out, path, "year_week", max_records_per_file=5000)
    pio.list_files(spark, path)  # raises on an empty listing
    back = pio.read_partitioned(spark, path)
    return back.select(*[r6(c) if c in WIDE_COLS else c for c in back.columns])


@query("incremental_append")
def q_incremental_append(spark, d):
    """Weather history up to 1999 + a landed re-fetch from the last stored day onward (with revised
    values) and a backfill of one early month -> one row per day."""
    base = pio.scratch_path(spark, "incremental")
    w = weather(spark, d)
    inc.seed_table(w.filter(F.col("date") < F.lit("2000-01-01").cast("date")), f"{base}/seed")
    backfill = F.trunc("date", "month") == F.lit("1996-03-01").cast("date")
    revised = w.filter((F.col("date") >= F.lit("1999-12-31").cast("date")) | backfill).withColumn(
        "mean_temp", F.col("mean_temp") + 0.1)
    revised.write.parquet(f"{base}/landing")
    inc.run_incremental_append(spark, f"{base}/landing", f"{base}/stream", f"{base}/checkpoint", revised.schema)
    return inc.current_view(spark, f"{base}/seed", f"{base}/stream")


# ---------------------------------------------------------------- smaller reference operators
from ..functions.scalars import calc_prices, min_price_level  # noqa: E402


@query("sequence_modulo")
def q_sequence_modulo(spark, d):
    return clean.sequence_modulo(weekly.last_n_rows(panel_(spark, d), 14), 7).select(
        "product_code", "date", "sequence_number")


@query("zero_except_middle")
def q_zero_except_middle(spark, d):
    return clean.zero_except_middle(weekly.last_n_rows(panel_(spark, d), 14), "quantity_sold").select(
        "product_code", "date", "quantity_sold")


@query("weekly_days_since_change")
def q_weekly_days_since_change(spark, d):
    return weekly.weekly_days_since_change(feat.add_price_runs(panel_(spark, d)))


@query("demand_curve_by_sequence")
def q_demand_curve_by_sequence(spark, d):
    """Curves per (product, sequence), sequence = calendar year of the observation."""
    est = (panel_(spark, d).withColumn("sequence_number", F.year("date"))
           .withColumn(PRICE_CALC, round_half_up("product_selling_price", 2))
           .groupBy("product_code", "sequence_number", PRICE_CALC)
           .agg(F.sum("quantity_sold").alias("predicted_quantity")))
    fits = el.fit_demand_curves(est, PRICE_CALC, "predicted_quantity", ["product_code", "sequence_number"])
    # per-year fits often have 2-3 close prices (ill-conditioned): coefficients reported at 4 dp
    return fits.select("product_code", "sequence_number", round_half_up("slope", 4).alias("slope"),
                       round_half_up("intercept", 4).alias("intercept"), r6("r2"), "n_points")


@query("product_names_join")
def q_product_names_join(spark, d):
    # two name rows per product whose columns sort differently: they must not be mixed
    parts = td.part_dim(spark, d).select("product_code", "category_name_level1", "category_name_level2", "brand_name")
    names = parts.unionByName(parts.withColumns({"category_name_level1": F.concat(F.lit("A"), "category_name_level1"),
                                                 "brand_name": F.concat(F.lit("Z"), "brand_name")}))
    out = clean.merge_product_names(td.sales_rows(spark, d), names)
    return out.select("product_code", "date", *TB, "category_name_level1", "category_name_level2", "brand_name")


@query("weather_features")
def q_weather_features(spark, d):
    out = ref.add_weather(panel_(spark, d), ref.add_climatology(weather(spark, d)))
    return out.select("product_code", "date", "mean_temp", "min_temp", "max_temp", "sum_rain",
                      r6("mean_temp_over_years"))


@query("sparse_competitor_drop")
def q_sparse_competitor_drop(spark, d):
    # one competitor is known in the first days of a year only, so its column goes and the others stay
    rows = brand_sales_competitors(spark, d).select("product_code", "date", *WIDE_COLS).withColumn(
        "asia_price", F.when(F.dayofyear("date") <= 10, F.col("asia_price")))
    out = comp.drop_sparse_competitors(rows, COMP_SLUGS, 96.0)
    return out.select("product_code", "date", *[r6(c) for c in WIDE_COLS if c in out.columns])


def cpi_period_table(spark, d):
    """Monthly index restated as a statistics-office period table ('1995MM01', annual '1995JJ00')."""
    m = td.monthly_index(spark, d)
    months = m.select(F.format_string("%dMM%02d", F.year("month_year"), F.month("month_year")).alias("Perioden"),
                      F.col("cpi").alias("CPI_1"))
    years = m.groupBy(F.year("month_year").alias("y")).agg(F.avg("cpi").alias("CPI_1")) \
        .select(F.format_string("%dJJ00", F.col("y")).alias("Perioden"), "CPI_1")
    return months.unionByName(years)


@query("cpi_period_parse")
def q_cpi_period_parse(spark, d):
    out = ref.preprocess_cpi_periods(cpi_period_table(spark, d))
    return out.select("month_year", r6("cpi"), "year", "month", "days_in_month")


@query("cpi_text_clean")
def q_cpi_text_clean(spark, d):
    """Monthly index as Dutch text rows ('1995 januari*', '12,345') with annual all-digit rows
    and blank values on the first month of each quarter (filled from the row above)."""
    names = list(ref.DUTCH_MONTHS)
    m = td.monthly_index(spark, d)
    month_name = F.element_at(F.array(*[F.lit(n) for n in names]), F.month("month_year"))
    value = F.regexp_replace(F.format_string("%.3f", round_half_up("cpi", 3)), r"\.", ",")
    rows = m.select(F.concat(F.year("month_year").cast("string"), F.lit(" "), month_name, F.lit("*")).alias("period"),
                    F.when(F.month("month_year").isin(4, 7, 10), F.lit(None)).otherwise(value).alias("value"),
                    (F.unix_date("month_year") * 10 + 1).alias("ord"))
    years = m.groupBy(F.year("month_year").alias("y")).agg(F.min("month_year").alias("first")).select(
        F.col("y").cast("string").alias("period"), F.lit("0,0").alias("value"),
        (F.unix_date("first") * 10).alias("ord"))
    return ref.clean_dutch_cpi(rows.unionByName(years), "period", "value", "ord")


@query("price_levels")
def q_price_levels(spark, d):
    """Grid from the last price down to a data-driven minimum level: p80 = 80th percentile of the
    product's prices, p_below10 = last price x 0.9."""
    per = panel_(spark, d).groupBy("product_code").agg(
        F.percentile("product_selling_price", F.lit(0.8)).alias("price_80_perc"),
        F.max_by("product_selling_price", "date").alias("last_price"))
    per = per.withColumn("price_below_10_perc", F.col("last_price") * 0.9) \
        .withColumn("min_price_level", min_price_level("price_80_perc", "price_below_10_perc"))
    return per.select("product_code", r6("min_price_level"),
                      F.posexplode(calc_prices("last_price", "min_price_level")).alias("step", "price"))


@query("tier_filter")
def q_tier_filter(spark, d):
    return el.filter_min_tier(tiered(panel_(spark, d)), "medium").select("product_code", "quality_tier")


@query("subset_sample")
def q_subset_sample(spark, d):
    from ..sources import io as pio2
    return pio2.sample_subset(panel_(spark, d), "product_code", 50, 42)


# ---------------------------------------------------------------- end-to-end chains
from ..plans import pipelines as pl  # noqa: E402
from ..schema import ClientProfile  # noqa: E402

PREPROCESS_PROFILE = ClientProfile(name="parts", min_price_levels=5, min_sales=25.0, live_days=180,
                                   cpi_base_year=CPI_BASE_YEAR)


@query("receipt_panel")
def q_receipt_panel(spark, d):
    """Entry C: weighted-goods fix -> store-follower selection -> product-day roll-up."""
    out = pl.receipt_panel(td.receipts(spark, d), CUTOFF, tiebreak=TB)
    return out.select(*[r6(c) if c in ROLLUP_ROUNDED else c for c in out.columns])


@query("preprocess_panel")
def q_preprocess_panel(spark, d):
    """Entry B preprocessing: live products -> price levels -> categories -> IQR -> low sellers -> CPI."""
    out = pl.preprocess(category_panel(spark, d), PREPROCESS_PROFILE, td.monthly_index(spark, d))
    return out.select("product_code", "date", "quantity_sold", "product_selling_price", "category_name_level1",
                      "category_name_level2", r6("cpi"), r6("adjusted_price"))


# ---------------------------------------------------------------- rows of the inventory without a chain of their own
def with_gaps(panel_df):
    """The panel with unknown prices (every 5th day) and quantities (every 7th), and with repeated rows."""
    day = F.unix_date("date")
    gaps = panel_df.withColumns({
        "product_selling_price": F.when(day % 5 != 0, F.col("product_selling_price")),
        "quantity_sold": F.when(day % 7 != 0, F.col("quantity_sold"))})
    return gaps.withColumn("version", F.lit(0)).unionByName(
        gaps.filter(day % 3 == 0).withColumns({"version": F.lit(1), "quantity_sold": F.col("quantity_sold") + 1}))


@query("weekly_resample_gaps")
def q_weekly_resample_gaps(spark, d):
    """Last known price of a week, and 0 sold in a week of unknown quantities."""
    return weekly.weekly_resample(with_gaps(panel_(spark, d)).filter("version = 0"), fill=False)


@query("last_actual_price")
def q_last_actual_price(spark, d):
    return mdl.last_actual_price(with_gaps(panel_(spark, d)).filter("version = 0"), "product_selling_price")


@query("preprocess_weekly")
def q_preprocess_weekly(spark, d):
    """Repeated rows count once (the last version) in the weekly panel; no filter is set but IQR."""
    rows = with_gaps(panel_(spark, d)).withColumn("product_selling_price", round_half_up("product_selling_price", 2))
    out = pl.preprocess(rows, ClientProfile(name="weekly", status_vocabulary=["F", "O"]), weekly_output=True,
                        tiebreak=["version"])
    return out.select("product_code", "year_week", "quantity_sold", r6("product_selling_price"), "date")


@query("category_elasticity_gaps")
def q_category_elasticity_gaps(spark, d):
    """Products without a category belong to none; revenue falls back to the one after discount."""
    cp = category_panel(spark, d).withColumn(
        "category", F.when(F.col("product_code").cast("long") % 4 != 0, F.col("category_name_level1")))
    _, _, _, e = observed_elasticity(cp)
    return el.category_elasticity(e, cp.drop("revenue_before"), "category", fallback_revenue_col="revenue_after",
                                  min_products=1).select("category", "elasticity_median", "num_products")


@query("column_hygiene")
def q_column_hygiene(spark, d):
    """Aliases renamed, repeated names numbered, columns dropped, channel and price filters, rounding, casts."""
    rows = td.sales_rows(spark, d).select(
        "product_code", F.date_format("date", "yyyyMMdd").alias("date_code"), *TB, F.col("quantity_sold").alias("total_quantity_sold"),
        F.col("revenue_before").alias("total_revenue_before_discount"), F.col("promotion_indicator").alias("promo_ind"),
        F.col("discount").alias("note"), F.col("discount").alias("note"),
        F.when(F.col("return_flag") == "N", "web").otherwise("shop").alias("store_priceline_code"),
        F.when(F.col("return_flag") != "R", F.col("product_selling_price")).alias("product_selling_price"))
    rows = clean.deduplicate_column_names(clean.rename_columns(rows))
    rows = clean.filter_valid_price(clean.filter_channel(clean.drop_columns(rows, ["note"]), "shop"))
    rows = feat.cast_feature_types(rows.withColumn("date", parse_date("date_code")).withColumn(
        "promotion_indicator", F.when(F.col("l_linenumber") != 1, F.col("promotion_indicator"))))
    return clean.add_output_metadata(feat.round_doubles(rows.drop("date_code"), 2), client="demo")


@query("content_factor")
def q_content_factor(spark, d):
    rows = td.receipts(spark, d).select("product_code", "date_code", *TB, "ah_price", "ah_content_factor", "plus_price",
                                        "plus_content_factor")
    out = comp.apply_content_factor(rows, ["ah", "plus"])
    return out.select("product_code", "date_code", *TB, r6("ah_price"), r6("plus_price"))


@query("weighted_price_equal")
def q_weighted_price_equal(spark, d):
    out = panel.fix_weighted_products(td.receipts(spark, d), equal_col="is_selling_price")
    return out.select("product_code", "store_code", "date_code", *TB, "is_selling_price")


@query("cpi_adjust_category")
def q_cpi_adjust_category(spark, d):
    """Each row's own category index: the order priority stands for the category."""
    daily = ref.interpolate_cpi(td.monthly_index_by_category(spark, d), category_col="category_name")
    orders = td.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                 F.col("o_orderpriority").alias("category_name"))
    rows = td.sales_rows(spark, d).join(orders, "l_orderkey")
    out = ref.adjust_price_base_year(rows, daily, CPI_BASE_YEAR, category_col="category_name")
    return out.select("product_code", "date", *TB, "category_name", r6("cpi"), r6("adjusted_price"))


@query("read_many_roundtrip")
def q_read_many_roundtrip(spark, d):
    """Two files of which one lacks a column, listed, read together; an optional third is not there."""
    base = pio.scratch_path(spark, "many")
    rows = panel_(spark, d).select(*PANEL_COLS, "revenue_before")
    pio.write_parquet(rows.filter(F.year("date") < 1997), f"{base}/a")
    pio.write_parquet(rows.filter(F.year("date") >= 1997).drop("revenue_before"), f"{base}/b")
    if pio.read_optional(spark, f"{base}/c") is not None:
        raise ValueError("a table that was never written was found")
    both = pio.read_many(spark, pio.list_files(spark, base), union_columns=True)
    if set(both.columns) != set(pio.read_tree(spark, base, union_columns=True).columns):
        raise ValueError("the two ways of reading differ")
    return both.select(*PANEL_COLS, "revenue_before")


@query("json_mapping_lookup")
def q_json_mapping_lookup(spark, d):
    """Nation names as a JSON object file, loaded back as a dictionary and looked up per supplier."""
    path = pio.scratch_path(spark, "mapping")
    nation = td.table(spark, d, "nation")
    (nation.agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name"))).alias("m"))
     .select(F.to_json("m").alias("value")).write.text(path))
    # every fifth supplier carries a code that no nation has
    code = F.when(F.col("s_suppkey") % 5 == 0, F.lit("unknown")).otherwise(F.col("s_nationkey").cast("string"))
    rows = td.table(spark, d, "supplier").select("s_suppkey", code.alias("code"))
    return clean.map_values(rows, "code", pio.load_json_mapping(spark, path), out_col="nation")


@query("json_records_landed")
def q_json_records_landed(spark, d):
    """The monthly index landed as one API response {"value": [...]} and read back."""
    path = pio.scratch_path(spark, "landed")
    m = td.monthly_index(spark, d).select(F.date_format("month_year", "yyyy'MM'MM").alias("Perioden"), r6("cpi", "CPI_1"))
    (m.agg(F.sort_array(F.collect_list(F.struct("Perioden", "CPI_1"))).alias("value"))  # one row per month
     .select(F.to_json(F.struct("value")).alias("value")).write.text(path))
    return pio.read_json_records(spark, path).select("Perioden", r6("CPI_1"))


@query("price_grid_persist")
def q_price_grid_persist(spark, d):
    path = pio.scratch_path(spark, "grid")
    pio.save_price_grid(sim.price_grid(sim.reference_rows(panel_(spark, d), GRID_DAYS)), path)
    return pio.read_parquet(spark, path).select("product_code", "date", "sequence_number",
                                                F.posexplode("prices").alias("grid_idx", "price"))


@query("rollups_sorted")
def q_rollups_sorted(spark, d):
    """Rank of each category by its weighted elasticity."""
    from pyspark.sql import Window
    out = q_category_elasticity(spark, d)
    order = Window.orderBy("elasticity_weighted", "category_name_level1")  # one row per category
    return out.select("category_name_level1", "elasticity_weighted", F.row_number().over(order).alias("place"))


# ---------------------------------------------------------------- model parts that SQL can check
@query("time_folds")
def q_time_folds(spark, d):
    out = mdl.expanding_folds(panel_(spark, d), 3)
    return out.select("product_code", "date", F.col("_block").alias("block"))


def fixed_prediction(spark, d):
    """A prediction known in closed form on the price grid: 1000 / price, in whole units."""
    grid = sim.price_grid(sim.reference_rows(panel_(spark, d), GRID_DAYS))
    rows = grid.select("product_code", "date", F.explode("prices").alias(PRICE_CALC))
    return rows.withColumn("predicted_quantity", F.floor(F.lit(1000.0) / F.col(PRICE_CALC) + 1).cast("double"))


@query("estimation_sums")
def q_estimation_sums(spark, d):
    return mdl.estimations(fixed_prediction(spark, d), with_gaps(panel_(spark, d)).filter("version = 0"))


@query("leakage_status")
def q_leakage_status(spark, d):
    """A prediction that repeats the target but for a little is flagged."""
    rows = panel_(spark, d).withColumn("guess", F.col("quantity_sold") + F.dayofmonth("date") % 3 - 1)
    return mdl.fit_quality(rows, MODEL_CFG, "guess").select(r6("holdout_r2"), "status")


@query("model_features")
def q_model_features(spark, d):
    """The feature list, with the rows that have a value."""
    mp = sim.split_train_test(model_panel(spark, d), GRID_DAYS)
    feats = mdl.feature_columns(mp, MODEL_CFG, WIDE_COLS)
    counts = mp.agg(*[F.count(c).alias(c) for c in feats])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_values"))
                                             for c in feats])).alias("f")).select("f.*")


@query("model_persist")
def q_model_persist(spark, d):
    """A trained model saved, loaded and used; both predictions of each hold-out row."""
    mp, feats = model_inputs(spark, d)
    model = mdl.train_demand_model(mp.filter(~F.col("is_test")), MODEL_CFG, feats)
    path = pio.scratch_path(spark, "model")
    model.save(path)
    test = mdl.predict_quantity(model, mp.filter("is_test"), out_col="before")
    both = mdl.predict_quantity(mdl.load_model(spark, path, MODEL_CFG), test, out_col="after")
    return both.select("product_code", "date", r6("before"), r6("after"))


FEATURE_PROFILE = ClientProfile(name="features", competitors=COMP_SLUGS,
                                price_change_columns=["product_selling_price", "adjusted_price"])


def adjusted_rows(spark, d):
    return ref.adjust_price_base_year(brand_sales_competitors(spark, d), cpi_daily(spark, d), CPI_BASE_YEAR)


@query("build_features")
def q_build_features(spark, d):
    """The whole feature step: calendar, weather, holidays, lags and changes of two prices, competitors."""
    out = pl.build_features(adjusted_rows(spark, d), FEATURE_PROFILE, weather(spark, d))
    rounded = [f"price_change_{c}_lag_{k}" for c in FEATURE_PROFILE.price_change_columns for k in LAGS]
    return out.select("product_code", "date", "day_of_week", "month", "is_month_end", "mean_temp", "sum_rain", "holiday",
                      "time_until_next_holiday", *[r6(c) for c in rounded], r6("price_distance_mean"), r6("log_own_price"),
                      "n_competitors_available", "promotion_indicator")


@query("counterfactual_two_prices")
def q_counterfactual_two_prices(spark, d):
    """The adjusted price and its lags follow the simulated price."""
    rows = feat.add_lags(adjusted_rows(spark, d), ["product_selling_price", "adjusted_price"], LAGS)
    test = sim.split_train_test(rows, GRID_DAYS).filter("is_test").drop("is_test")
    lags = {k: [f"product_selling_price_lag_{k}", f"adjusted_price_lag_{k}"] for k in LAGS}
    out = sim.expand_counterfactual(test, lag_cols=lags, scaled_cols=["adjusted_price"])
    return out.select("product_code", "date", "sequence_number", "grid_idx", "product_selling_price", r6("adjusted_price"),
                      *[r6(f"adjusted_price_lag_{k}") for k in LAGS])


@query("demand_curve_sequences")
def q_demand_curve_sequences(spark, d):
    """Fitted curve per (product, sequence), sequence = calendar year of the observation."""
    est = (panel_(spark, d).withColumn("sequence_number", F.year("date"))
           .withColumn(PRICE_CALC, round_half_up("product_selling_price", 0))
           .groupBy("product_code", "sequence_number", PRICE_CALC)
           .agg(F.sum("quantity_sold").alias("predicted_quantity")))
    keys = ["product_code", "sequence_number"]
    est = td.spread(spark, d, est, *keys)  # the fits and the curve share this shuffle
    curve = el.demand_curve(est, el.fit_demand_curves(est, PRICE_CALC, "predicted_quantity", keys), PRICE_CALC, keys)
    return curve.select("product_code_elasticity", "sequence_number_elasticity", "price", r6("sales"))


@query("actual_by_sequence")
def q_actual_by_sequence(spark, d):
    """The lowest simulated price of each day index beside the actual price of that index (10 of 14 days known)."""
    ref_rows = sim.reference_rows(panel_(spark, d), GRID_DAYS)
    low = sim.price_grid(ref_rows).select("product_code", "sequence_number", F.col("prices")[0].alias("product_selling_price"))
    known = sim.with_sequence(ref_rows).filter("sequence_number < 10").drop("sequence_number")
    return sim.actual_by_sequence(low, known)


@query("artifact_settings")
def q_artifact_settings(spark, d):
    """Rows of two artifacts of a client whose grid has a name of its own, written under their names and read back."""
    profile = ClientProfile(name="demo", artifact_overrides={"price_grid": "ladder"})
    out, base = None, pio.scratch_path(spark, "artifacts")
    for artifact, rows in (("price_grid", sim.price_grid(sim.reference_rows(panel_(spark, d), GRID_DAYS))), ("features", panel_(spark, d))):
        path = pio.artifact_path(base, artifact, "weekly", "demo", profile.artifact_overrides)
        pio.write_parquet(rows, path)
        n = spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("path", F.lit(path.removeprefix(base)))
        out = n if out is None else out.unionByName(n)
    return out


# ---------------------------------------------------------------- strided windows
from ..operators import windows as win  # noqa: E402

STRIDED = {"quantity": ("sum", "quantity_sold"), "highest_price": ("max", "product_selling_price"),
           "median_price": ("median", "product_selling_price"), "mean_price": ("avg", "product_selling_price"),
           "n_prices": ("count_distinct", "product_selling_price")}


@query("strided_windows")
def q_strided_windows(spark, d):
    """Brand figures over 30 days, every 7 days, the last window ending on the last date."""
    out = win.strided_windows(td.brand_panel(spark, d), 7, 30, STRIDED, "product_code")
    return out.select("product_code", "date", "quantity", *[r6(c) for c in ("highest_price", "median_price", "mean_price")], "n_prices")


# ---------------------------------------------------------------- storage forms
from ..sources import reconcile  # noqa: E402
from ..streaming import partitions as months  # noqa: E402


@query("read_reconciled")
def q_read_reconciled(spark, d):
    """Receipts in three folders: whole-number stores, real-number stores, and one without store and with a text quantity."""
    path, rows = pio.scratch_path(spark, "typed"), td.receipts(spark, d).select("product_code", "date_code", "store_code", "quantity_sold", *TB)
    rows.filter("l_linenumber <= 2").withColumn("store_code", F.col("store_code").cast("int")).write.parquet(f"{path}/a")
    rows.filter("l_linenumber in (3, 4)").withColumn("store_code", F.col("store_code").cast("double")).write.parquet(f"{path}/b")
    (rows.filter("l_linenumber > 4").drop("store_code").withColumn("quantity_sold", F.col("quantity_sold").cast("float"))
     .write.parquet(f"{path}/c"))
    return reconcile.read_reconciled(spark, path).select(*rows.columns)


@query("upsert_by_month")
def q_upsert_by_month(spark, d):
    """Weather history, a re-fetch that revises the last month and goes on, and a backfill of an early month; one row a day."""
    path, w = pio.scratch_path(spark, "series"), weather(spark, d)
    months.upsert_by_month(spark, path, w.filter(F.col("date") < F.lit("1997-12-20").cast("date")))
    again = w.filter((F.col("date") >= F.lit("1997-12-01").cast("date"))).withColumn("mean_temp", F.col("mean_temp") + 0.1)
    months.upsert_by_month(spark, path, again)
    early = w.filter(F.trunc("date", "month") == F.lit("1996-03-01").cast("date")).withColumn("mean_temp", F.col("mean_temp") + 0.2)
    months.upsert_by_month(spark, path, early)
    return months.read_series(spark, path).select(*w.columns)


def bucketed_join(spark, d):
    """Brand sales and competitor prices as tables bucketed alike, de-duplicated, pivoted and joined in place."""
    tag, keys = pio.scratch_path(spark, "bucketed"), ["product_code", "date"]
    name = "b" + tag[-12:]
    sales = pio.write_bucketed(td.brand_panel(spark, d), f"{name}_sales", keys, 8, f"{tag}/sales")
    prices = pio.write_bucketed(td.competitor_prices(spark, d).withColumnRenamed("price_date", "date"), f"{name}_prices", keys, 8,
                                f"{tag}/prices")
    wide = comp.pivot_competitors(comp.median_dedupe(prices, ["product_code", "date", "competitor_name"]), COMPETITORS, keys)
    return comp.merge_sales_competitors(sales, wide, wide_date_col="date")


@query("bucketed_sales_join")
def q_bucketed_sales_join(spark, d):
    return bucketed_join(spark, d).select("product_code", "date", "quantity_sold", *[r6(c) for c in WIDE_COLS], "year_week")


@query("outlier_report_observed")
def q_outlier_report_observed(spark, d):
    """The report and the number of rows written, of one run over the flagged rows."""
    path = pio.scratch_path(spark, "clean-prices")
    report = comp.write_with_report(comp.flag_price_outliers(td.competitor_prices(spark, d), **OUTLIER_KW), path)
    return report.withColumn("rows_written", spark.read.parquet(path).agg(F.count("*")).scalar())


@query("custom_curves")
def q_custom_curves(spark, d):
    """A curve function of the caller's own (here the power law) per (product, year)."""
    rows = panel_(spark, d).withColumn("sequence_number", F.year("date")).withColumn("price", round_half_up("product_selling_price", 0))
    keys = ["product_code", "sequence_number"]
    out = el.fit_custom_curves(el.price_points(rows, "price", "quantity_sold", keys), el.power_law,
                               "slope double, intercept double, r2 double, n_points long", keys)
    return out.select(*keys, *[r6(c) for c in ("slope", "intercept", "r2")], "n_points")


@query("tied_rows")
def q_tied_rows(spark, d):
    """Lags, runs and fills on line items, of which a product has several a day: ordered by order and line."""
    rows = td.spread(spark, d, td.sales_rows(spark, d), "product_code").withColumn(
        "product_selling_price", F.when(F.col("return_flag") != "R", F.floor("product_selling_price")))
    out = feat.add_lags(rows, ["quantity_sold"], [1], tiebreak=TB)
    out = clean.bounded_ffill(out, "product_selling_price", 2, tiebreak=TB)
    out = feat.add_price_runs(out, tiebreak=TB)
    return out.select("product_code", "date", *TB, "quantity_sold_lag_1", F.col("product_selling_price").cast("double").alias("price"),
                      "price_change", "price_change_group", "days_since_last_change")
