"""End-to-end plans, each a chain of lazy operators (what a user of the library runs).

* ``sales_with_competitors`` - competitor outlier filter, dedupe, pivot, merge (entry A)
* ``receipt_panel``          - weighted goods, store followers, product-day roll-up (entry C)
* ``preprocess`` / ``build_features`` / ``simulate_and_predict`` / ``elasticities`` (entry B)

Long chains can cut lineage with a reliable checkpoint into the cluster's shared
checkpoint folder (``checkpoint=True``), so a lost executor does not replay the
whole plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_date
from ..operators import calendar as cal
from ..operators import clean, competitors as comp, elasticity as el, features as feat
from ..operators import model as mdl
from ..operators import panel, reference as ref, simulate as sim, weekly
from ..schema import RECEIPTS, ClientProfile, conform
from ..session import cut_lineage


def sales_with_competitors(sales: DataFrame, competitor_prices: DataFrame, competitors: list[str] | None = None,
                           window_days: int = 180, high: float = 2.0, low: float | None = 0.3,
                           tiebreak: list[str] | None = None) -> DataFrame:
    clean_prices = comp.filter_price_outliers(competitor_prices, window_days=window_days, high=high, low=low,
                                              tiebreak=tiebreak or [])
    wide = comp.pivot_competitors(comp.median_dedupe(clean_prices), competitors)
    return comp.merge_sales_competitors(sales, wide)


def receipt_panel(receipts: DataFrame, cutoff: str | None = None, min_corr: float = 0.9,
                  tiebreak: list[str] | None = None) -> DataFrame:
    """Receipts in the shape of ``RECEIPTS`` (missing columns are NULL) to product-day rows."""
    fixed = panel.fix_weighted_products(conform(receipts, RECEIPTS))
    return panel.product_day_rollup(panel.select_store_followers(fixed, cutoff, min_corr), tiebreak=tiebreak)


def preprocess(sales: DataFrame, profile: ClientProfile, cpi_monthly: DataFrame | None = None,
               weekly_output: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """Column hygiene, the filters that the profile sets, price adjustment, the weekly form on request, and doubles
    rounded to ``round_digits``.  ``preprocess_with_grid`` also gives the price grid.

    Before weeks are formed, repeated (product, date) rows are reduced to the last one by ``tiebreak``
    (default: all other columns in turn).
    """
    df = clean.deduplicate_column_names(clean.rename_columns(sales))
    if "date" not in df.columns and "date_code" in df.columns:
        df = df.withColumn("date", parse_date("date_code"))
    elif dict(df.dtypes).get("date") == "string":
        df = df.withColumn("date", parse_date("date"))
    df = clean.derive_price(df, profile.price_column, profile.target)
    df = clean.filter_channel(df, profile.channel) if "store_priceline_code" in df.columns else df
    df = clean.filter_status(df, profile.status_vocabulary)
    if profile.live_days is not None:
        df = clean.filter_live_products(df, profile.live_days)
    if profile.min_price_levels is not None:
        df = clean.filter_price_levels(df, profile.min_price_levels, price_col=profile.price_column)
    df = clean.drop_missing_categories(df)
    df = clean.filter_iqr(df, price_col=profile.price_column)
    if profile.min_sales is not None:
        df = clean.filter_low_sellers(df, profile.min_sales, profile.target)
    df = comp.apply_content_factor(df, profile.competitors)
    if profile.max_competitor_null_pct is not None:
        df = comp.drop_sparse_competitors(df, profile.competitors, profile.max_competitor_null_pct)
    if cpi_monthly is not None:
        df = ref.adjust_price_base_year(df, ref.interpolate_cpi(cpi_monthly), profile.cpi_base_year,
                                        profile.price_column)
    df = clean.drop_columns(df, profile.drop_columns)
    if profile.store_columns:
        df = feat.ffill_columns(df, profile.store_columns)
    if weekly_output:
        keys = ["product_code", "date"]
        df = panel.dedupe_keep_last(df, keys, tiebreak or [c for c in df.columns if c not in keys])
        comp_cols = [f"{c}_price" for c in profile.competitors if f"{c}_price" in df.columns]
        df = weekly.weekly_iso(df, profile.target, profile.price_column, comp_cols,
                               carry_last=[profile.category_column] if profile.category_column in df.columns else [],
                               sum_cols=[c for c in ("revenue_before",) if c in df.columns])
    return df if profile.round_digits is None else feat.round_doubles(df, profile.round_digits)


def preprocess_with_grid(sales: DataFrame, profile: ClientProfile, **options) -> tuple[DataFrame, DataFrame]:
    """The preprocessed rows, written once, and the price grid of their last ``grid_days`` days (the reference rows)."""
    rows = cut_lineage(preprocess(sales, profile, **options), "preprocessed")
    grid = sim.price_grid(sim.reference_rows(rows, profile.grid_days), profile.min_grid_pct, profile.max_grid_pct,
                          profile.price_column)
    return rows, grid


def build_features(df: DataFrame, profile: ClientProfile, weather: DataFrame | None = None,
                   holidays: bool | DataFrame = True) -> DataFrame:
    """Calendar, weather, holidays, lags and changes of every price column, competitors, casts.

    ``holidays`` may be a table (date, holiday) of the caller's country.
    """
    out = cal.calendar_features(df)
    if weather is not None:
        out = ref.add_weather(out, weather)
    if isinstance(holidays, DataFrame):
        out = cal.add_holiday_features(out, holidays=holidays)
    elif holidays:
        out = cal.add_holiday_features(out)
    prices = [c for c in profile.price_change_columns if c in out.columns]
    out = feat.add_lags(out, prices, profile.price_lags)
    out = feat.add_price_changes(out, prices, profile.price_lags)
    out = feat.add_competitor_features(out, profile.competitors, profile.price_column)
    return feat.cast_feature_types(out)


@dataclass
class Simulation:
    model: object
    features: list[str]
    predictions_per_day: DataFrame
    estimations: DataFrame
    leakage: DataFrame


def simulate_and_predict(featured: DataFrame, profile: ClientProfile, cfg: mdl.ModelConfig | None = None,
                         checkpoint: bool = True) -> Simulation:
    cfg = cfg or mdl.ModelConfig(target=profile.target, price_col=profile.price_column)
    data = sim.split_train_test(featured, profile.grid_days, profile.test_end_date)
    if checkpoint:
        data = cut_lineage(data)
    comp_cols = [f"{c}_price" for c in profile.competitors]
    feats = mdl.feature_columns(data, cfg, comp_cols)
    model = mdl.train_demand_model(data.filter(~F.col("is_test")), cfg, feats)
    test = data.filter("is_test").drop("is_test")
    prices = list(dict.fromkeys([profile.price_column, *[c for c in profile.price_change_columns if c in test.columns]]))
    scaled = [c for c in dict.fromkeys([*prices, "adjusted_price"]) if c in test.columns and c != profile.price_column]
    lag_cols = {k: [f"{c}_lag_{k}" for c in [profile.price_column, *scaled]] for k in profile.price_lags}
    expanded = sim.expand_counterfactual(test, None, profile.min_grid_pct, profile.max_grid_pct,
                                         profile.price_column, lag_cols, scaled_cols=scaled)
    expanded = sim.resimulate_features(expanded, prices, profile.price_lags, profile.competitors, profile.price_column)
    scored = mdl.predict_quantity(model, expanded)
    per_day = scored.select("product_code", "date", "predicted_quantity",
                            F.col(profile.price_column).alias(f"{profile.price_column}_calc"))
    est = mdl.estimations(per_day, data, profile.price_column)
    return Simulation(model, feats, per_day, est, mdl.leakage_check(model, data.filter("is_test"), cfg, feats))


def elasticities(result: Simulation, preprocessed: DataFrame, profile: ClientProfile) -> tuple[DataFrame, DataFrame]:
    calc = f"{profile.price_column}_calc"
    fits = el.fit_demand_curves(result.estimations, calc, "predicted_quantity")
    e = el.arc_elasticity(el.demand_curve(result.estimations, fits, calc))
    day_std = el.slope_dispersion(result.predictions_per_day, calc, "predicted_quantity", "date")
    products = el.filter_min_tier(el.quality_tiers(e, fits, day_std), profile.min_tier)
    products = clean.add_output_metadata(products, **profile.constants)
    categories = el.category_elasticity(products.select("product_code", "elasticity"), preprocessed,
                                        profile.category_column, min_products=profile.min_category_products,
                                        fallback_revenue_col="revenue_after")
    return products, clean.add_output_metadata(categories, **profile.constants)
