"""Detectors for the store x category rows of one period, their evidence grade, and gaps in sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from ..functions.robust import adjbox, with_medcouple
from ..plans.params import Detectors, Params, Peer
from .facts import ATTRS

KEYS = ["peer_set", "category"]
FLAGS = ("adjbox_value", "share_adjbox", "item_adjbox", "level_test", "trend_test", "history_flag")


def previous_period(panel: DataFrame, period: int) -> int | None:
    return panel.filter(F.col("period_id") < period).agg(F.max("period_id").alias("p")).first()["p"]


def cross_stats(current: DataFrame) -> DataFrame:
    """Per peer set: sizes, and quartiles and medcouple of log sales and share over all rows, of log item counts over sellers."""
    c = current.withColumns({"lv": S.log_sales(F.col("sales_value")), "it": F.when(F.col("sales_value") > 0, F.log1p(F.col("n_item").cast("double")))})
    out = c.groupBy(*KEYS).agg(
        F.count("*").alias("n_peer"), F.count_if(F.col("sales_value") > 0).alias("n_sell"), F.percentile("lv", 0.5).alias("lv_med"), *adjbox(F.col("lv"), "lv"), *adjbox(F.col("cat_share"), "sh"), *adjbox(F.col("it"), "it")
    )
    return with_medcouple(out, "lv", "sh", "it")


def seller_stats(current: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """The same over sellers only, by any keys."""
    c = current.filter("sales_value > 0").withColumn("lv", S.log_sales(F.col("sales_value")))
    out = with_medcouple(c.groupBy(*keys).agg(F.count("*").alias("n"), *adjbox(F.col("lv"), "lv"), *adjbox(F.col("cat_share"), "sh")), "lv", "sh")
    return out.select(*keys, *[F.col(x).alias(f"{prefix}{x}") for x in ("n", "lv_q1", "lv_q3", "lv_mc", "sh_q1", "sh_q3", "sh_mc")])


def stat_table(df: DataFrame, keys: list[str], value: str, prefix: str) -> DataFrame:
    """Quartiles, medcouple and number of the finite values by any keys."""
    x = F.when(S.finite(F.col(value)), F.col(value))
    out = with_medcouple(df.groupBy(*keys).agg(*adjbox(x, "v"), F.count(x).alias("n")), "v")
    return out.select(*keys, F.col("v_q1").alias(f"{prefix}q1"), F.col("v_q3").alias(f"{prefix}q3"), F.col("v_mc").alias(f"{prefix}mc"), F.col("n").alias(f"{prefix}n"))


def trend_values(panel: DataFrame, period: int, prev: int | None, factors: DataFrame) -> DataFrame:
    """Seasonally adjusted change of log sales since the previous period, for stores that sold in both."""
    rows = panel.filter(F.col("period_id").isin([p for p in (period, prev) if p is not None]) & (F.col("sales_value") > 0))
    two = rows.groupBy(*KEYS, "store_id").agg(F.max(F.when(F.col("period_id") == period, F.col("sales_value"))).alias("t"), F.max(F.when(F.col("period_id") == (prev or -1), F.col("sales_value"))).alias("p"))
    two = two.filter("t is not null and p is not null").join(factors, KEYS, "left")
    return two.select(*KEYS, "store_id", (F.log1p("t") - F.log1p("p") - F.log(F.coalesce("T_final", F.lit(1.0)))).alias("trend_d"))


def period_quartiles(panel: DataFrame, keys: list[str], d: Detectors) -> DataFrame:
    """keys, period_id, q: trimmed quartiles of log sales, the same for every later period that looks back on them."""
    h = panel.filter(F.col("sales_value") > 0).withColumn("lv", S.log_sales(F.col("sales_value")))
    w = Window.partitionBy(*keys, "period_id")
    n, k = F.count("*").over(w), F.row_number().over(w.orderBy("lv"))
    cut = F.floor(F.col("n") * d.trim_pct)
    kept = h.withColumns({"n": n, "k": k}).filter((F.col("k") > cut) & (F.col("k") <= F.col("n") - cut))
    return kept.groupBy(*keys, "period_id").agg(F.count("*").alias("m"), F.percentile("lv", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).filter("m >= 2")


def level_history(panel: DataFrame, periods: list[int], keys: list[str], d: Detectors, quartiles: DataFrame | None = None) -> DataFrame:
    """center, lo_w, hi_w, n_hist per key, in two aggregates: trimmed quartiles per period, then their medians and maxima.

    The skew is rounded, so that the last bits of symmetric quartiles don't decide which side is widened.
    """
    past = F.col("period_id").isin(periods)
    q = period_quartiles(panel.filter(past), keys, d) if quartiles is None else quartiles.filter(past)
    q1, med, q3 = (F.col("q")[i] for i in range(3))
    one = q.select(*keys, q1.alias("q1"), med.alias("med"), q3.alias("q3"), (q3 - q1).alias("iqr"))
    one = one.withColumn("skew", F.when(F.col("iqr") > 0, F.round((F.col("q3") - 2 * F.col("med") + F.col("q1")) / F.col("iqr"), 9)).otherwise(0.0))
    up = F.when((F.col("med") > 0) & (F.col("skew") > 0), F.col("q3") * F.col("q3") / F.col("med")).otherwise(F.col("q3"))
    down = F.when((F.col("med") > 0) & (F.col("skew") < 0), F.col("q1") * F.col("q1") / F.col("med")).otherwise(F.col("q1"))
    out = one.withColumn("adj", up - down).groupBy(*keys).agg(
        F.percentile("med", 0.5).alias("center"), F.max("iqr").alias("iqr"), F.max("adj").alias("adj"), F.percentile("skew", 0.5).alias("skew"), F.count("*").alias("n_hist")
    )
    return out.select(*keys, "center", F.when(F.col("skew") < 0, F.col("adj")).otherwise(F.col("iqr")).alias("lo_w"), F.when(F.col("skew") > 0, F.col("adj")).otherwise(F.col("iqr")).alias("hi_w"), "n_hist")


def once_a_store(panel: DataFrame, cell_keys: list[str]) -> DataFrame:
    """Rows that several peer sets share only once for the stratum."""
    rows, keys = panel.drop("peer_set"), [*cell_keys, "store_id", "period_id"]
    return rows.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rows.columns if c not in keys])


def fallback_basis(degenerate: Column, name: str, min_sell: int) -> Column:
    """all, sellers (of the set), cell_sellers (of the stratum) or none."""

    def usable(prefix: str) -> Column:
        q1, q3, mc = (F.col(f"{prefix}{name}_{s}") for s in ("q1", "q3", "mc"))
        return F.coalesce((F.col(f"{prefix}n") >= min_sell) & S.finite(q1) & S.finite(q3) & S.finite(mc) & (q1 != q3), F.lit(False))

    return F.when(~F.coalesce(degenerate, F.lit(False)), "all").when(usable("g_"), "sellers").when(usable("c_"), "cell_sellers").otherwise("none")


def detect(assigned: DataFrame, panel: DataFrame, factors: DataFrame, period: int, params: Params, prev: int | None = -1, history: list[int] | None = None, keep=lambda df: df, quartiles: tuple = (None, None)) -> DataFrame:
    """Flags of every row of `assigned` (one period, zero rows filled in). factors: seasonal table. keep: may write the joined rows.

    The order matters: stratum fallbacks come before the shrink, which therefore blends what they put in; the shrink's basis
    then gates the share's shrink; rows of sets marked na lose all flags last. quartiles: period_quartiles() by peer set and by stratum, if they are known.
    """
    d, peer, cell = params.detectors, params.peer, list(params.base_cell)
    if history is None:
        history = sorted(r["period_id"] for r in panel.filter(F.col("period_id") < period).select("period_id").distinct().collect())
    prev = (history[-1] if history else None) if prev == -1 else prev
    own = [p for p in history if p >= d.hist_start_period] if d.hist_start_filter else history
    cell_keys = [*cell, "category"]
    current = panel.filter(F.col("period_id") == period)
    t = factors.filter("metric = 'sales_value'").select(*KEYS, F.when(S.finite(F.col("T_final")) & (F.col("T_final") > 0), F.col("T_final")).otherwise(1.0).alias("T_final"))
    trend = trend_values(panel, period, prev, t)
    once = lambda df, keys: df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in df.columns if c not in keys])
    of_cell = assigned.groupBy("peer_set").agg(*[F.min(c).alias(c) for c in cell])
    cell_trend = trend.join(of_cell, "peer_set")
    cell_panel = panel
    if d.dedupe_cell_reference:
        cell_trend = once(cell_trend.drop("peer_set"), [*cell_keys, "store_id"])
        cell_panel = once_a_store(panel, cell_keys)
    one_store = current.select("store_id", *cell_keys, "sales_value", "cat_share").groupBy("store_id", *cell_keys).agg(F.min("sales_value").alias("sales_value"), F.min("cat_share").alias("cat_share"))
    out = (
        assigned.join(cross_stats(current), KEYS, "left")
        .join(level_history(panel, own[-d.recommended_hist_periods :], KEYS, d, quartiles[0]).withColumnsRenamed({"center": "g_center", "lo_w": "g_lo", "hi_w": "g_hi"}), KEYS, "left")
        .join(stat_table(trend, KEYS, "trend_d", "td_"), KEYS, "left")
        .join(stat_table(cell_trend, cell_keys, "trend_d", "c_td_"), cell_keys, "left")
        .join(trend, [*KEYS, "store_id"], "left")
        .join(t, KEYS, "left")
        .join(seller_stats(current, KEYS, "g_"), KEYS, "left")
        .join(seller_stats(one_store, cell_keys, "c_"), cell_keys, "left")
        .join(level_history(cell_panel, history[-d.recommended_hist_periods :], cell_keys, d, quartiles[1]).withColumnsRenamed({"center": "c_center", "lo_w": "c_lo", "hi_w": "c_hi", "n_hist": "n_hist_cell"}), cell_keys, "left")
        .withColumn("T_final", F.coalesce("T_final", F.lit(1.0)))
    )
    out = _trend_fence(keep(out), d)
    out = _cross_fences(out, d, peer)
    out = _level_limits(out, d)
    low, high = S.fence(F.col("td_q1"), F.col("td_q3"), F.col("td_mc"), d.adjbox_a, d.adjbox_b, d.adjbox_c)
    out = out.withColumn("trend_test", S.flag(F.col("trend_d"), low, high))
    out = out.withColumn("history_flag", S.combine(F.col("level_test"), F.col("trend_test")))
    out = out.withColumns({f: F.when(F.col("peer_level") == "na", "na").otherwise(F.col(f)) for f in FLAGS})
    out = out.withColumns({"period_id": F.lit(period).cast("int"), "zero_filled": F.coalesce("zero_filled", F.lit(False))})
    return out if peer.evaluate_zero_rows else out.filter(~F.col("zero_filled"))


def _trend_fence(out: DataFrame, d: Detectors) -> DataFrame:
    n = F.coalesce("td_n", F.lit(0))
    borrow = (n < d.fence_fallback_min_n) & (F.coalesce("c_td_n", F.lit(0)) >= d.borrow_min_peer) & F.lit(d.trend_fence_fallback)
    out = out.withColumn("td_fence_src", F.when(borrow, "cell").when(n < d.fence_fallback_min_n, "thin").otherwise("group"))
    return out.withColumns({f"td_{s}": F.when(F.col("td_fence_src") == "cell", F.col(f"c_td_{s}")).otherwise(F.col(f"td_{s}")) for s in ("q1", "q3", "mc", "n")})


def _cross_fences(out: DataFrame, d: Detectors, peer: Peer) -> DataFrame:
    abc, parts = (d.adjbox_a, d.adjbox_b, d.adjbox_c), ("q1", "q3", "mc")
    for name, basis in (("lv", "adjbox_basis"), ("sh", "share_basis")):
        out = out.withColumn(basis, fallback_basis(F.col(f"{name}_q1") == F.col(f"{name}_q3"), name, peer.fallback_min_sell))
        out = out.withColumns({f"{name}_{s}": F.when(F.col(basis) == "sellers", F.col(f"g_{name}_{s}")).when(F.col(basis) == "cell_sellers", F.col(f"c_{name}_{s}")).otherwise(F.col(f"{name}_{s}")) for s in parts})
    n = F.coalesce("n_peer", F.lit(0))
    weak = (n < d.shrink_min_n) | F.coalesce("soft_kept", F.lit(False)) | ~F.coalesce("final_ok", F.lit(True))
    weight = F.when(n > 0, n / (n + d.shrink_scale)).otherwise(0.0)
    out = out.withColumn("adjbox_shrink_w", F.lit(1.0))
    if d.shrink:
        for name in ("lv", "sh"):
            # the basis seen by the share's shrink is the one that the value's shrink has left
            take = F.coalesce(weak & (F.col("c_n") >= 1) & S.finite(F.col(f"c_{name}_q1")) & (F.col("adjbox_basis") != "none"), F.lit(False))
            out = out.withColumns({"_take": take, "_w": weight})
            if name == "lv":
                out = out.withColumn("adjbox_shrink_w", F.when(F.col("_take"), F.col("_w")).otherwise(1.0))
            blend = lambda s, name=name: F.col("_w") * F.coalesce(f"{name}_{s}", F.lit(0.0)) + (1 - F.col("_w")) * F.coalesce(f"c_{name}_{s}", F.lit(0.0))
            out = out.withColumns({f"{name}_{s}": F.when(F.col("_take"), blend(s)).otherwise(F.col(f"{name}_{s}")) for s in parts})
            if name == "lv":
                out = out.withColumn("adjbox_basis", F.when(F.col("_take"), "shrink").otherwise(F.col("adjbox_basis")))
            out = out.drop("_take", "_w")
    low, high = S.fence(F.col("lv_q1"), F.col("lv_q3"), F.col("lv_mc"), *abc)
    out = out.withColumns({"lv_lo": low, "lv_hi": high})
    out = out.withColumn("adjbox_value", value_flag(F.col("lv_lo"), F.col("lv_hi")))
    zero, basis, share = F.col("sales_value") <= 0, F.col("adjbox_basis"), F.col("share_basis")
    judged = (share == "all") | ((basis == "shrink") & (share != "none"))
    sh = S.flag(F.col("cat_share"), *S.fence(F.col("sh_q1"), F.col("sh_q3"), F.col("sh_mc"), *abc))
    out = out.withColumn("share_adjbox", F.when((share == "none") | (zero & ~judged), "na").otherwise(sh))
    return out.withColumn("item_adjbox", S.flag(F.log1p(F.col("n_item").cast("double")), *S.fence(F.col("it_q1"), F.col("it_q3"), F.col("it_mc"), *abc)))


def value_flag(low: Column, high: Column) -> Column:
    """Rows without sales are judged only against fences that include rows without sales."""
    basis, zero = F.col("adjbox_basis"), F.col("sales_value") <= 0
    return F.when((basis == "none") | (zero & ~basis.isin("all", "shrink")), "na").otherwise(S.flag(S.log_sales(F.col("sales_value")), low, high))


def _level_limits(out: DataFrame, d: Detectors) -> DataFrame:
    n, nc = F.coalesce("n_hist", F.lit(0)), F.coalesce("n_hist_cell", F.lit(0)) if d.level_borrow_cell else F.lit(0)
    has = F.col("g_center").isNotNull()
    has_cell = F.col("c_center").isNotNull() & F.lit(d.level_borrow_cell)
    w = F.when(has & has_cell, n / (n + d.level_borrow_scale)).when(has_cell, 0.0).otherwise(1.0)
    mix = lambda g, c: F.col("_w") * F.coalesce(g, F.lit(0.0)) + (1 - F.col("_w")) * F.coalesce(c, F.lit(0.0))
    effective = F.when(has, n).otherwise(0) + F.when(has_cell, nc).otherwise(0)
    out = out.withColumns({"_w": w, "n_hist_eff": effective.cast("int"), "lon_src": F.when(has & has_cell, "blend").when(has_cell, "cell").when(has, "group").otherwise("none")})
    center = mix("g_center", "c_center")
    known = F.col("lon_src") != "none"
    out = out.withColumns(
        {
            "long_ll": F.when(known, center - d.level_iqr_coef * mix("g_lo", "c_lo")),
            "long_ul": F.when(known, center + d.level_iqr_coef * mix("g_hi", "c_hi")),
            "n_hist": n.cast("int"),
            "n_hist_cell": nc.cast("int"),
        }
    ).drop("_w")
    adjusted = F.log1p(F.greatest(F.col("sales_value"), F.lit(0.0)) / F.col("T_final"))
    return out.withColumn("level_test", F.when(F.col("n_hist_eff") < d.min_hist_periods, "na").otherwise(S.flag(adjusted, F.col("long_ll"), F.col("long_ul"))))


# ------------------------------------------------------------------ evidence
def grade(detail: DataFrame, high_min: int = 3) -> DataFrame:
    """Counts agreeing tests: n_high, n_low, n_evidence, direction, level, evidence_list, auto_action."""
    out = detail.withColumns({c: F.lit("ok") for c in S.EVIDENCE if c not in detail.columns})
    out = out.withColumns({"n_high": S.count_of(S.EVIDENCE, "high"), "n_low": S.count_of(S.EVIDENCE, "low")})
    out = out.withColumn("n_evidence", F.col("n_high") + F.col("n_low"))
    out = out.withColumns({"direction": S.direction_of(F.col("n_high"), F.col("n_low")), "level": S.level_of(F.col("n_evidence"), high_min), "evidence_list": S.evidence_list()})
    zero = F.coalesce("zero_filled", F.lit(False)) | (F.coalesce("sales_value", F.lit(0.0)) <= 0)
    return out.withColumn("auto_action", S.auto_action(F.col("level"), F.col("direction"), F.col("peer_level"), zero))


def level_summary(graded: DataFrame) -> DataFrame:
    """Rows, rate, directions and fixes per period and level, levels without rows included; na sets don't count."""
    base = graded.filter("peer_level <> 'na'")
    count = base.groupBy("period_id", "level").agg(
        F.count("*").alias("n"), F.count_if(F.col("direction") == "high").alias("n_high"), F.count_if(F.col("direction") == "low").alias("n_low"), F.count_if(F.col("auto_action") == "fix").alias("n_fix")
    )
    total = base.groupBy("period_id").agg(F.count("*").alias("total"))
    grid = total.withColumn("level", F.explode(F.array(*map(F.lit, S.LEVELS))))
    out = grid.join(count, ["period_id", "level"], "left").fillna(0, subset=["n", "n_high", "n_low", "n_fix"])
    return out.select("period_id", "level", "n", (F.col("n") / F.col("total")).alias("rate"), "n_high", "n_low", "n_fix")


# ------------------------------------------------------------------ gaps in sales
def store_drop(sc: DataFrame, store_cluster: DataFrame, period: int, prev: int | None, peer: Peer) -> DataFrame:
    """Stores that sell in far fewer categories than in the previous period."""
    at = lambda p, x: F.when(F.col("period_id") == p, x)
    prev = -1 if prev is None else prev
    s = sc.filter(F.col("period_id").isin(period, prev) & (F.col("sales_value") > 0)).groupBy("store_id").agg(
        F.count_distinct(at(period, F.col("category"))).alias("n_cat"), F.count_distinct(at(prev, F.col("category"))).alias("prev_n_cat"), F.sum(at(period, F.col("sales_value"))).alias("sales_value"), F.sum(at(prev, F.col("sales_value"))).alias("prev_sales_value")
    )
    s = s.filter((F.col("n_cat") > 0) & (F.col("prev_n_cat") >= peer.store_drop_min_prev_cat) & (F.col("n_cat") < peer.store_drop_ratio * F.col("prev_n_cat")))
    attrs = sc.filter(F.col("period_id") == period).groupBy("store_id").agg(*[F.min(a).alias(a) for a in ATTRS])
    out = s.join(store_cluster.select("store_id", "cluster_id"), "store_id").join(attrs, "store_id", "left")
    return out.select(F.lit(period).cast("int").alias("period_id"), "store_id", *ATTRS, "cluster_id", "n_cat", "prev_n_cat", (F.col("n_cat") / F.col("prev_n_cat")).alias("cat_ratio"), "sales_value", "prev_sales_value", (F.col("sales_value") / F.col("prev_sales_value")).alias("sales_ratio"))


def missing_sales(assigned: DataFrame, panel: DataFrame, period: int, prev: int | None, peer: Peer, exclude: DataFrame | None = None) -> DataFrame:
    """Zero-filled rows of categories that most peers sell and that the store sold materially before."""
    rows = assigned.filter("peer_level <> 'na'")
    sold = ~F.coalesce("zero_filled", F.lit(False))
    stats = rows.groupBy(*KEYS).agg(F.count_distinct("store_id").alias("n_peer"), F.count_distinct(F.when(sold, F.col("store_id"))).alias("n_sell"), F.percentile(F.when(sold, F.col("sales_value")), 0.5).alias("peer_median_sales"))
    per_store = rows.filter(sold).groupBy("store_id").agg(F.count_distinct("category").alias("store_n_cat"))
    before = panel.filter(F.col("period_id") == (-1 if prev is None else prev)).groupBy(*KEYS, "store_id").agg(F.sum("sales_value").alias("prev_sales_value"))
    out = rows.filter(~sold).join(stats, KEYS).withColumn("sell_ratio", F.col("n_sell") / F.col("n_peer")).filter(F.col("sell_ratio") >= peer.missing_sell_ratio)
    if exclude is not None:
        out = out.join(exclude.select("store_id"), "store_id", "left_anti")
    out = out.join(before, [*KEYS, "store_id"], "left").withColumn("prev_sales_value", F.coalesce("prev_sales_value", F.lit(0.0)))
    least = F.greatest(peer.missing_min_prev_ratio * F.coalesce("peer_median_sales", F.lit(0.0)), F.lit(0.0))
    out = out.filter(F.col("prev_sales_value") > least).join(per_store, "store_id", "left")
    return out.select(
        F.lit(period).cast("int").alias("period_id"), "store_id", "category", *ATTRS, "cluster_id", "peer_set", "peer_level", "n_peer", "n_sell", "sell_ratio", "peer_median_sales", "prev_sales_value", F.coalesce("store_n_cat", F.lit(0)).alias("store_n_cat"), F.lit("suspicious").alias("level")
    )


# ------------------------------------------------------------------ stability
def flags_for_constant(detail: DataFrame, d: Detectors, c: float) -> Column:
    low, high = S.fence(F.col("lv_q1"), F.col("lv_q3"), F.col("lv_mc"), d.adjbox_a, d.adjbox_b, c)
    return F.when(F.col("peer_level") == "na", "na").otherwise(value_flag(low, high))


def threshold_grid(detail: DataFrame, d: Detectors, grid: tuple[float, ...]) -> DataFrame:
    """Jaccard of the flagged rows between neighbouring fence constants and against the configured one; all from one aggregate."""
    steps = sorted({float(c) for c in grid})
    hit = {c: flags_for_constant(detail, d, c).isin("high", "low") for c in {*steps, float(d.adjbox_c)}}
    pairs = [("neighbour", a, b) for a, b in zip(steps, steps[1:], strict=False)] + [("config", float(d.adjbox_c), c) for c in steps if c != float(d.adjbox_c)]
    aggs = []
    for i, (_, a, b) in enumerate(pairs):
        aggs += [F.count_if(hit[a] & hit[b]).alias(f"b{i}"), F.count_if(hit[a] | hit[b]).alias(f"e{i}"), F.count_if(hit[a]).alias(f"x{i}"), F.count_if(hit[b]).alias(f"y{i}")]
    one = detail.agg(*aggs)
    rows = [
        F.struct(F.lit(k).alias("kind"), F.lit(a).alias("c_from"), F.lit(b).alias("c_to"), F.col(f"x{i}").alias("n_from"), F.col(f"y{i}").alias("n_to"), F.when(F.col(f"e{i}") == 0, 1.0).otherwise(F.col(f"b{i}") / F.when(F.col(f"e{i}") > 0, F.col(f"e{i}"))).alias("jaccard"))
        for i, (k, a, b) in enumerate(pairs)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rate_by_period(levels: DataFrame, spike_ratio: float) -> DataFrame:
    """Rates of each level and of suspicious+ with their medians over periods; a spike is above ratio x median."""
    plus = levels.filter(F.col("level").isin("suspicious", "high_confidence")).groupBy("period_id").agg(F.sum("n").alias("n"), F.sum("rate").alias("rate")).withColumn("level", F.lit("suspicious+"))
    both = levels.filter("level <> 'normal'").select("period_id", "level", "n", "rate").unionByName(plus)
    median = both.groupBy("level").agg(F.percentile("rate", 0.5).alias("median_rate"))
    return both.join(median, "level").withColumn("spike", (F.col("median_rate") > 0) & (F.col("rate") > spike_ratio * F.col("median_rate"))).select("period_id", "level", "n", "rate", "median_rate", "spike")
