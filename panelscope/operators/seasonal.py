"""Peer panels and seasonal factors from chained same-store indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import sign_direction, sign_statistic
from ..plans.params import Seasonal

METRICS = ("sales_value", "n_item", "avg_price")
KEYS = ["peer_set", "category"]


def members(assigned: DataFrame) -> DataFrame:
    """(peer_set, category, cluster_id): one row per member cluster of the sets in use."""
    return assigned.filter("peer_level <> 'na'").select("peer_set", "category", F.explode("members").alias("cluster_id")).distinct()


def peer_panel(sc: DataFrame, store_cluster: DataFrame, member: DataFrame) -> DataFrame:
    """All periods of every store under its present cluster, once for each peer set that the cluster belongs to."""
    return sc.join(store_cluster.select("store_id", "cluster_id"), "store_id").join(member, ["cluster_id", "category"])


def period_ranks(panel: DataFrame, period: int) -> DataFrame:
    """Dense ranks of the available periods up to the target: a short table."""
    p = panel.select("period_id").distinct().filter(F.col("period_id") <= period)
    return p.withColumn("k", F.row_number().over(Window.orderBy("period_id")))


def links(panel: DataFrame, ranks: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Same-store link per key and pair of neighbouring periods: totals over stores with positive values in both."""
    x = panel.filter(F.col(metric) > 0).groupBy(*keys, "store_id", "period_id").agg(F.min(metric).alias("x")).join(F.broadcast(ranks), "period_id")
    w = Window.partitionBy(*keys, "store_id").orderBy("k")
    pairs = x.withColumn("p", F.when(F.lag("k").over(w) == F.col("k") - 1, F.lag("x").over(w))).filter("p is not null")
    return pairs.groupBy(*keys, "k").agg(
        (F.sum("x") / F.sum("p")).alias("link"), F.count("*").alias("n_common"), F.count_if(F.col("x") > F.col("p")).alias("n_plus"), F.count_if(F.col("x") < F.col("p")).alias("n_minus")
    )


def link_tables(panel: DataFrame, period: int, cell: tuple[str, ...], metrics=METRICS) -> dict[str, DataFrame]:
    """What the factors of the period and of all earlier ones come from: `sets` in each period, links of the sets and of the strata.

    A link of two periods is the same whichever later period it is asked for. The metrics are rows of one long table, so that all of them cost one pass.
    """
    cell, by = list(cell), [*KEYS, "metric"]
    ranks = period_ranks(panel, period)
    long = panel.filter(F.col("period_id") <= period).select(
        *KEYS, *cell, "store_id", "period_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])).alias("m")
    ).select(*KEYS, *cell, "store_id", "period_id", "m.metric", F.col("m.x").alias("value")).filter("value > 0")
    out = {"sets": long.groupBy(*by, "period_id").agg(*[F.min(c).alias(c) for c in cell] or [F.lit(1).alias("_one")]), "links": links(long, ranks, by, "value")}
    if cell:
        out["cell_links"] = links(long, ranks, [*cell, "category", "metric"], "value")
    return out


def seasonal_factors(panel: DataFrame, period: int, s: Seasonal, cell: tuple[str, ...] = (), metrics=METRICS, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """T per peer set, category and metric: index at the target over the mean index of the baseline.

    A link with too few common stores is replaced by its stratum's, else by 1 without signs. tables: link_tables() of this or a later period.
    """
    names, by = ["link", "n_common", "n_plus", "n_minus"], [*KEYS, "metric"]
    tables = tables or link_tables(panel, period, cell if s.borrow_cell else (), metrics)
    ranks, cell = period_ranks(panel, period), list(cell)
    sets = tables["sets"].filter(F.col("period_id") == period).drop("period_id")
    # periods are few: the grid is as long as the peer sets' history
    grid = sets.join(F.broadcast(ranks), how="cross").join(tables["links"], [*by, "k"], "left")
    enough = F.coalesce(F.col("n_common") >= s.min_common_stores, F.lit(False))
    if cell and s.borrow_cell:
        c = tables["cell_links"].select(*cell, "category", "metric", "k", *[F.col(n).alias(f"c_{n}") for n in names])
        grid = grid.join(c, [*cell, "category", "metric", "k"], "left")
        borrow = ~enough & F.coalesce(F.col("c_n_common") >= s.min_common_stores, F.lit(False))
    else:
        grid = grid.withColumns({f"c_{n}": F.lit(None).cast("double") for n in names})
        borrow = F.lit(False)
    grid = grid.withColumn("source", F.when(enough, "group").when(borrow, "base_cell").otherwise("none"))
    use = lambda n: F.when(F.col("source") == "base_cell", F.col(f"c_{n}")).otherwise(F.col(n))
    none = F.col("source") == "none"
    grid = grid.select(
        *by, "k", "period_id", "source",
        F.when(none, 1.0).otherwise(use("link")).alias("link"),
        F.coalesce(use("n_common"), F.lit(0)).cast("long").alias("n_common"),
        F.when(none, 0).otherwise(use("n_plus")).cast("long").alias("n_plus"),
        F.when(none, 0).otherwise(use("n_minus")).cast("long").alias("n_minus"),
    )
    so_far = Window.partitionBy(*by).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # the index starts at 1; links are positive, so that the running product is a sum of logarithms
    grid = grid.withColumn("idx", F.exp(F.sum(F.when(F.col("k") > 1, F.log("link")).otherwise(0.0)).over(so_far)))
    base = Window.partitionBy(*by).orderBy("k").rowsBetween(-s.baseline_periods, -1)
    later = F.col("k") > 1
    grid = grid.withColumns(
        {
            "idx_base": F.avg("idx").over(base),
            "base_periods_used": F.count("idx").over(base),
            "n_links_borrowed": F.sum(F.when(later & (F.col("source") == "base_cell"), 1).otherwise(0)).over(so_far),
            "n_links_missing": F.sum(F.when(later & none, 1).otherwise(0)).over(so_far),
        }
    )
    now = grid.filter(F.col("period_id") == period)
    first = F.col("k") == 1
    now = now.select(
        F.lit(period).cast("int").alias("period_id"), *by,
        F.when(~first, F.col("link")).alias("link_t"),
        F.when(first, 0).otherwise(F.col("n_common")).cast("long").alias("n_common"),
        F.when(first, "none").otherwise(F.col("source")).alias("source"),
        F.col("idx").alias("idx_t"), "idx_base", "base_periods_used", "n_links_borrowed", "n_links_missing",
        (F.col("idx") / F.col("idx_base")).alias("T_raw"),
        F.when(first, 0).otherwise(F.col("n_plus")).cast("long").alias("n_plus"),
        F.when(first, 0).otherwise(F.col("n_minus")).cast("long").alias("n_minus"),
    )
    return decide(now, s)


def decide(table: DataFrame, s: Seasonal) -> DataFrame:
    """The sign test's verdict: T_final is T_raw only where the stores' changes agree with it."""
    plus, minus, raw = F.col("n_plus"), F.col("n_minus"), F.col("T_raw")
    few = (plus + minus < s.min_common_stores) | raw.isNull()
    stat, way = sign_statistic(plus, minus), sign_direction(plus, minus)
    hit: Column = ~few & F.coalesce(stat > s.sign_crit, F.lit(False)) & (way != "")
    clash = ((way == "positive") & (raw < 1)) | ((way == "negative") & (raw > 1))
    return table.withColumns(
        {
            "sign_stat": F.when(~few, stat),
            "significant": hit,
            "direction": F.when(few, "").otherwise(way),
            "T_final": F.when(hit & ~clash, raw).otherwise(1.0),
            "reason": F.when(few, "few_common_stores").when(~hit, "not_significant").when(clash, "direction_conflict").otherwise("ok"),
        }
    )
