"""Registered queries of the panel engine over the benchmark tables, and the SQL that checks them.

The target period is 2000, the peer clusters are size bands inside segment x region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clusters, detect, evaluate, facts, items, seasonal, spread
from ..sources.tables import panel_items, panel_stores
from .params import Params
from .pipeline import Panel

PERIOD = 2000
CELL = ("PLATFORMNAME", "SHOPTYPE")
PARAMS = Params().replaced(clusters={"method": "size"})


_panels: dict = {}


def panel(spark: SparkSession, sf_dir: str, params: Params = PARAMS, period: int = PERIOD) -> Panel:
    """The engine on order lines, one for each set of parameters of a session, whose hub tables stay persisted.

    The part key of order lines is no unique item row, so duplicates are not dropped here; q_quality shows the tags.
    """
    key = (spark.sparkContext.applicationId, sf_dir, params, period)
    if key not in _panels:
        p = Panel(panel_items(spark, sf_dir), panel_stores(spark, sf_dir), period, params)
        p.__dict__["clean"] = p.raw
        p.__dict__["periods"] = [y for y in range(1995, 2002) if y <= period]
        _panels[key] = p
    return _panels[key]


def forget() -> None:
    """Lets all persisted tables go, as for a measurement from a cold start."""
    for p in _panels.values():
        p.release()
    _panels.clear()


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Doubles rounded, so that the order of additions doesn't show."""
    return df.select(*[F.round(F.col(f.name), special.get(f.name, digits)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


# ------------------------------------------------------------------ queries
def min_slice(spark, sf_dir):
    return rounded(facts.province_totals(panel(spark, sf_dir).matched), 2)


def q_quality(spark, sf_dir):
    p = Panel(panel_items(spark, sf_dir).withColumn("sales_value", F.when(F.col("l_returnflag") == "R", -F.col("sales_value")).otherwise(F.col("sales_value"))), panel_stores(spark, sf_dir), PERIOD, PARAMS)
    return facts.quality_summary(p.tagged)


def q_quality_clean(spark, sf_dir):
    p = Panel(panel_items(spark, sf_dir), panel_stores(spark, sf_dir), PERIOD, PARAMS)
    return rounded(p.clean.groupBy("period_id").agg(F.count("*").alias("n_rows"), F.sum("sales_value").alias("sales_value")), 2)


def j_match(spark, sf_dir):
    return rounded(panel(spark, sf_dir).matched.groupBy("period_id", *CELL, "PROVINCE").agg(F.count("*").alias("n_rows"), F.sum("sales_value").alias("sales_value")), 2)


def j_unmatched(spark, sf_dir):
    p = panel(spark, sf_dir)
    return facts.unmatched_stores(p.raw, p.stores)


def a_store_category(spark, sf_dir):
    return rounded(panel(spark, sf_dir).sc, 6, sales_value=2, sales_unit=2)


def a_item_totals(spark, sf_dir):
    return rounded(panel(spark, sf_dir).items.filter(F.col("period_id") == PERIOD), 2)


def a_store_totals(spark, sf_dir):
    return rounded(facts.store_totals(panel(spark, sf_dir).sc, CELL), 2)


def a_profile(spark, sf_dir):
    return rounded(facts.profile(panel(spark, sf_dir).sc), 4, cv=6, zero_rate=6)


def a_zero_fill(spark, sf_dir):
    p = panel(spark, sf_dir)
    return rounded(p.filled(PERIOD).select("store_id", "category", "cluster_id", "sales_value", "sales_unit", "n_item", "cat_share", "zero_filled"), 6, sales_value=2, sales_unit=2)


def c_size_bands(spark, sf_dir):
    return rounded(clusters.size_bands(panel(spark, sf_dir).sc, PERIOD, CELL, PARAMS.clusters).select("store_id", "cluster_id", "band", "n_band", "size", "size_periods", "size_source"), 2)


def c_band_summary(spark, sf_dir):
    return rounded(clusters.band_summary(clusters.size_bands(panel(spark, sf_dir).sc, PERIOD, CELL, PARAMS.clusters), CELL), 2, cv_value=6, cv_size=6)


def c_mix_distance(spark, sf_dir):
    return rounded(clusters.mix_distance(clusters.mix_profile(panel(spark, sf_dir).sc, CELL, [PERIOD]), CELL), 6)


def c_mix_profile_weighted(spark, sf_dir):
    return rounded(clusters.mix_profile(panel(spark, sf_dir).sc, CELL, [PERIOD - 2, PERIOD - 1, PERIOD]), 6)


def c_trend_distance(spark, sf_dir):
    p = panel(spark, sf_dir)
    links = clusters.province_links(p.sc.filter(F.col("period_id") <= PERIOD), CELL, 1)
    return rounded(clusters.trend_distance(links, CELL, 3), 6)


def c_merge_provinces(spark, sf_dir):
    return rounded(clusters.merge_provinces(panel(spark, sf_dir).sc, PERIOD, CELL, Params().clusters), 6)


def c_sample_check(spark, sf_dir):
    c = panel(spark, sf_dir).check
    return c.select("cluster_id", "category", "n_store", "n_store_cat", "n_item", "low_store", "low_store_cat", "low_item", "peer_level", "peer_set", F.array_join("members", ";").alias("members"))


def c_category_check(spark, sf_dir):
    c = panel(spark, sf_dir, PARAMS.replaced(clusters={"check_level": "category", "min_store_cat": 12, "vi_max": 1.5})).check
    return c.select("cluster_id", "category", "n_store_cat", "n_item", "low_store_cat", "low_item", "peer_level", "peer_set", F.array_join("members", ";").alias("members"))


def s_links(spark, sf_dir):
    p = panel(spark, sf_dir)
    x = p.panel(PERIOD)
    ranks = seasonal.period_ranks(x, PERIOD)
    return rounded(seasonal.links(x, ranks, seasonal.KEYS, "sales_value").join(ranks, "k").drop("k"), 6)


def s_factors(spark, sf_dir):
    f = panel(spark, sf_dir).factors(PERIOD)
    return rounded(f.select("peer_set", "category", "metric", "link_t", "n_common", "source", "idx_t", "idx_base", "base_periods_used", "n_links_borrowed", "n_links_missing", "T_raw", "n_plus", "n_minus", "sign_stat", "significant", "direction", "T_final", "reason"), 6)


def d_cross_stats(spark, sf_dir):
    p = panel(spark, sf_dir)
    return rounded(detect.cross_stats(p.panel(PERIOD).filter(F.col("period_id") == PERIOD)), 6)


def d_level_history(spark, sf_dir):
    p = panel(spark, sf_dir)
    return rounded(detect.level_history(p.panel(PERIOD), p.history, ["peer_set", "category"], PARAMS.detectors), 6)


def d_detail(spark, sf_dir):
    d = panel(spark, sf_dir).detail(PERIOD)
    names = ("store_id", "category", "peer_set", "peer_level", "n_peer", "n_sell", "T_final", "lv_q1", "lv_q3", "lv_mc", "lv_lo", "lv_hi", "adjbox_basis", "adjbox_shrink_w", "adjbox_value", "share_adjbox", "item_adjbox", "n_hist", "n_hist_cell", "n_hist_eff", "lon_src", "long_ll", "long_ul", "level_test", "trend_d", "td_fence_src", "td_q1", "td_q3", "td_mc", "trend_test", "history_flag")
    return rounded(d.select(*names), 5)


def e_graded(spark, sf_dir):
    g = panel(spark, sf_dir, PARAMS.replaced(detectors={"adjbox_c": 1.5})).graded(PERIOD)
    return g.select("store_id", "category", "n_high", "n_low", "n_evidence", "direction", "level", "evidence_list", "auto_action")


def loose(spark, sf_dir):
    """Narrow fences, so that every level occurs."""
    return panel(spark, sf_dir, PARAMS.replaced(detectors={"adjbox_c": 1.0, "level_iqr_coef": 0.8}, items={"min_peer_stores": 3}))


def e_level_summary(spark, sf_dir):
    return rounded(detect.level_summary(loose(spark, sf_dir).graded(PERIOD)), 6)


def g_store_drop(spark, sf_dir):
    p = panel(spark, sf_dir)
    return rounded(detect.store_drop(p.sc, p.clusters, PERIOD, PERIOD - 1, PARAMS.replaced(peer={"store_drop_ratio": 0.9}).peer), 4, sales_value=2, prev_sales_value=2)


def g_missing_sales(spark, sf_dir):
    p = panel(spark, sf_dir, PARAMS.replaced(peer={"missing_sell_ratio": 0.7}))
    return rounded(detect.missing_sales(p.assigned(PERIOD), p.panel(PERIOD), PERIOD, PERIOD - 1, p.params.peer), 4, prev_sales_value=2)


def i_drilldown(spark, sf_dir):
    return rounded(loose(spark, sf_dir).drill, 4)


def i_corrections(spark, sf_dir):
    return rounded(loose(spark, sf_dir).corrections, 4)


def i_recheck(spark, sf_dir):
    p = loose(spark, sf_dir)
    return rounded(items.recheck(p.graded(PERIOD), p.corrections, p.params), 4)


def i_impact(spark, sf_dir):
    p = loose(spark, sf_dir)
    return rounded(items.impact(p.corrections, p.graded(PERIOD)), 2)


def i_funnel(spark, sf_dir):
    return items.funnel(loose(spark, sf_dir).corrections)


def r_adjustments(spark, sf_dir):
    return rounded(items.adjustments(loose(spark, sf_dir).graded(PERIOD)), 4)


def r_by_dimension(spark, sf_dir):
    return rounded(items.summary_by_dimension(loose(spark, sf_dir).graded(PERIOD)), 4, sales_value=2)


def t_threshold_grid(spark, sf_dir):
    p = panel(spark, sf_dir)
    return rounded(detect.threshold_grid(p.detail(PERIOD), PARAMS.detectors, PARAMS.grid_adjbox_c), 6)


def t_rate_by_period(spark, sf_dir):
    p = loose(spark, sf_dir)
    return rounded(detect.rate_by_period(p.levels, 3.0), 6)


def f_packsize(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    text = F.concat(F.when(F.col("p_size") % 3 == 0, F.concat((F.col("p_size") % 7).cast("string"), F.lit(" x "))).otherwise(""), F.col("p_size").cast("string"), F.lit("gm"))
    out = p.select("p_partkey", S.parse_packsize(text).alias("k"))
    return out.select("p_partkey", "k.qty", "k.size", "k.unit", S.packsize_volume(F.col("k")).alias("volume"))


def f_tail_quantile(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_size").distinct()
    return p.select("p_size", F.round(S.f_quantile(0.995, F.greatest(2.0 * (F.col("p_size") - 2) - 0.5, F.lit(1.0))), 6).alias("quantile"))


def logged(spark, sf_dir):
    return panel(spark, sf_dir).sc.filter(F.col("period_id") == PERIOD).withColumn("lv", S.log_sales(F.col("sales_value")))


def b_leave_one_out(spark, sf_dir):
    out = spread.leave_one_out(logged(spark, sf_dir), [*CELL, "category"], "lv", ["store_id"], {"q1": 0.25, "med": 0.5, "q3": 0.75})
    return rounded(out.select("store_id", "category", "n_peer", "q1", "med", "q3"), 6)


def b_deviation(spark, sf_dir):
    return rounded(spread.deviation(logged(spark, sf_dir), [*CELL, "category"], "lv"), 6)


def b_kappa(spark, sf_dir):
    return rounded(spread.kappa(logged(spark, sf_dir), list(CELL), "lv"), 4)


def a_anova(spark, sf_dir):
    table = spread.anova(panel(spark, sf_dir).sc.filter(F.col("period_id") == PERIOD), PARAMS.eta2_strong, PARAMS.eta2_medium)
    return rounded(spark.createDataFrame([tuple(r.values()) for r in table], "factor string, df long, ss double, partial_eta2 double, strength string, n_obs long, r2_model double"), 6)


FLAG_COLUMNS = ("adjbox_value", "share_adjbox", "item_adjbox", "level_test", "trend_test", "history_flag")


def e_flag_counts(spark, sf_dir):
    return evaluate.flag_counts(panel(spark, sf_dir).detail(PERIOD), *FLAG_COLUMNS)


def e_province_lift(spark, sf_dir):
    return rounded(evaluate.province_lift(loose(spark, sf_dir).graded(PERIOD), F.col("level").isin("suspicious", "high_confidence"), 20), 6)


def e_systematic_share(spark, sf_dir):
    return rounded(evaluate.systematic_share(loose(spark, sf_dir).graded(PERIOD), F.col("history_flag")), 6)


def e_gated_flags(spark, sf_dir):
    d = panel(spark, sf_dir).detail(PERIOD)
    lv = S.log_sales(F.col("sales_value"))
    flag = evaluate.gated_flag(lv, F.col("lv_q1") - 1.5 * (F.col("lv_q3") - F.col("lv_q1")), F.col("lv_q3") + 1.5 * (F.col("lv_q3") - F.col("lv_q1")), F.col("n_peer"))
    return rounded(d.select("category", flag.alias("flag")).groupBy("category").agg(F.count("*").alias("n"), evaluate.flag_rate(F.col("flag")).alias("rate")), 6)


def a_group_statistics(spark, sf_dir):
    return rounded(evaluate.group_statistics(logged(spark, sf_dir), [*CELL, "PROVINCE"], "lv"), 6)


def a_period_changes(spark, sf_dir):
    totals = facts.store_totals(panel(spark, sf_dir).sc, CELL).withColumn("lv", S.log_sales(F.col("sales_value")))
    return rounded(evaluate.change_summary(evaluate.period_changes(totals, ["store_id"], "lv"), 0.5), 6)


def a_feature_matrix(spark, sf_dir):
    return rounded(evaluate.feature_matrix(panel(spark, sf_dir).sc, CELL, PERIOD).drop("PROVINCE"), 5)


def n_nearest_stores(spark, sf_dir):
    return rounded(evaluate.nearest_stores(evaluate.feature_matrix(panel(spark, sf_dir).sc, CELL, PERIOD), CELL, 5), 4)


def r_overview(spark, sf_dir):
    p = panel(spark, sf_dir)
    missing = detect.missing_sales(p.assigned(PERIOD), p.panel(PERIOD), PERIOD, PERIOD - 1, PARAMS.replaced(peer={"missing_sell_ratio": 0.7}).peer)
    return rounded(evaluate.key_figures(p.matched.filter(F.col("period_id") == PERIOD), p.clusters, p.graded(PERIOD), p.drops, missing), 2)


QUERIES = [
    e_flag_counts, e_province_lift, e_systematic_share, e_gated_flags, a_group_statistics, a_period_changes, a_feature_matrix, n_nearest_stores, r_overview,
    b_leave_one_out, b_deviation, b_kappa, a_anova,
    min_slice, q_quality, q_quality_clean, j_match, j_unmatched, a_store_category, a_item_totals, a_store_totals, a_profile, a_zero_fill, c_size_bands, c_band_summary, c_mix_distance, c_mix_profile_weighted,
    c_trend_distance, c_merge_provinces, c_sample_check, c_category_check, s_links, s_factors, d_cross_stats, d_level_history, d_detail, e_graded, e_level_summary, g_store_drop, g_missing_sales, i_drilldown,
    i_corrections, i_recheck, i_impact, i_funnel, r_adjustments, r_by_dimension, t_threshold_grid, t_rate_by_period, f_packsize, f_tail_quantile,
]


def queries():
    return {f.__name__: f for f in QUERIES}
