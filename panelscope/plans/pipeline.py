"""The whole analysis of one period as one lazy plan per table, from item rows and a store dimension."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clusters, detect, facts, items, seasonal
from ..sources.scratch import Hub
from .params import Params

ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "sales_value"]


class Panel:
    """Tables of one target period. Hub tables that several others read are written when first asked for; the rest is lazy.

    raw: item rows of all periods; stores: store dimension by period. order: columns that decide which duplicate is first.
    """

    def __init__(self, raw: DataFrame, stores: DataFrame, period: int, params: Params | None = None, item: str = "item", order: list[str] | None = None):
        self.raw, self.stores, self.period, self.params, self.item = raw, stores, period, params or Params(), item
        self.order = order or ORDER
        #: Most periods that the stability report replays, the target included.
        self.replayed = 13
        self.hub = Hub(raw.sparkSession)

    @cached_property
    def tagged(self) -> DataFrame:
        return facts.tag_quality(self.raw, self.order)

    @cached_property
    def quality(self) -> DataFrame:
        return facts.quality_summary(self.tagged).unionByName(facts.unmatched_summary(self.unmatched))

    @cached_property
    def unmatched(self) -> DataFrame:
        return facts.unmatched_stores(self.raw, self.stores)

    @cached_property
    def clean(self) -> DataFrame:
        return facts.drop_tagged(self.tagged)

    @cached_property
    def matched(self) -> DataFrame:
        return facts.match_stores(self.clean, self.stores)

    @cached_property
    def sc(self) -> DataFrame:
        return self.hub.keep(facts.store_category(self.matched, self.item), "sc")

    @cached_property
    def periods(self) -> list[int]:
        """Available periods up to the target: one short aggregate on the driver."""
        found = self.raw.select("period_id").distinct().join(self.stores.select("period_id").distinct(), "period_id", "left_semi")
        return sorted(r["period_id"] for r in found.collect() if r["period_id"] is not None and r["period_id"] <= self.period)

    @property
    def history(self) -> list[int]:
        return [p for p in self.periods if p < self.period]

    @property
    def prev(self) -> int | None:
        return self.history[-1] if self.history else None

    @cached_property
    def items(self) -> DataFrame:
        return self.hub.keep(facts.item_totals(self.matched.filter(F.col("period_id").isin([p for p in (self.period, self.prev) if p is not None])), self.item), "items")

    def items_of(self, period: int | None) -> DataFrame:
        own = self.items.filter(F.col("period_id") == (-1 if period is None else period))
        return own.join(self.clusters.select("store_id", "cluster_id"), "store_id")

    @cached_property
    def clusters(self) -> DataFrame:
        return self.hub.keep(clusters.store_clusters(self.sc, self.period, self.params.base_cell, self.params.clusters), "clusters")

    @cached_property
    def check(self) -> DataFrame:
        now = F.col("period_id") == self.period
        return self.hub.keep(clusters.sample_check(self.sc.filter(now), self.items.filter(now), self.clusters, self.params.base_cell, self.params.clusters, self.item), "check")

    @cached_property
    def members(self) -> DataFrame:
        return seasonal.members(clusters.assign(self.sc.filter(F.col("period_id") == self.period), self.clusters, self.check))

    def filled(self, period: int) -> DataFrame:
        return facts.zero_fill(self.sc.filter(F.col("period_id") == period), self.clusters)

    def assigned(self, period: int) -> DataFrame:
        return self.written("assigned", period, lambda: clusters.assign(self.filled(period), self.clusters, self.check))

    def written(self, name: str, period: int, make) -> DataFrame:
        name = f"{name}-{period}"
        return self.hub.tables[name] if name in self.hub.tables else self.hub.keep(make(), name)

    def panel(self, period: int) -> DataFrame:
        """History as it was sold, the target with its zero rows, under the present clusters."""
        return self.written("panel", period, lambda: self._panel(period))

    def _panel(self, period: int) -> DataFrame:
        past = self.sc.filter(F.col("period_id") < period).withColumn("zero_filled", F.lit(False))
        rows = past.unionByName(self.filled(period).select(*past.columns))
        return seasonal.peer_panel(rows, self.clusters, self.members)

    def factors(self, period: int) -> DataFrame:
        return self.written("factors", period, lambda: self._factors(period))

    def _factors(self, period: int) -> DataFrame:
        return seasonal.seasonal_factors(self.panel(period), period, self.params.seasonal, self.params.base_cell)

    def detail(self, period: int) -> DataFrame:
        return self.written("detail", period, lambda: self._detail(period))

    def _detail(self, period: int) -> DataFrame:
        past = [p for p in self.periods if p < period]
        return detect.detect(self.assigned(period), self.panel(period), self.factors(period), period, self.params, past[-1] if past else None, past, lambda df: self.hub.keep(df, f"wide-{period}"))

    @cached_property
    def replay(self) -> dict[str, DataFrame]:
        """What the replayed periods share: links and quartiles of all periods, from the target's panel."""
        panel, cell, d = self.panel(self.period), self.params.base_cell, self.params.detectors
        found = seasonal.link_tables(panel, self.period, cell, ("sales_value",))
        keys = [*cell, "category"]
        past = panel.filter(F.col("period_id") < self.period)
        found["quartiles"] = detect.period_quartiles(past, seasonal.KEYS, d)
        found["cell_quartiles"] = detect.period_quartiles(detect.once_a_store(past, keys) if d.dedupe_cell_reference else past, keys, d)
        return {name: self.hub.keep(df, f"replay-{name}") for name, df in found.items()}

    def replayed_detail(self, period: int) -> DataFrame:
        """The detail of an earlier period: its own rows and the one before it are read, the rest comes from what the periods share."""
        if period == self.period or f"detail-{period}" in self.hub.tables:
            return self.detail(period)
        past = [p for p in self.periods if p < period]
        now = self.hub.keep(seasonal.peer_panel(self.filled(period).drop("cluster_id"), self.clusters, self.members), f"now-{period}")
        before = self.panel(self.period).filter(F.col("period_id") == (past[-1] if past else -1))
        panel, r = before.unionByName(now.select(*before.columns)), self.replay
        factors = self.hub.keep(seasonal.seasonal_factors(self.panel(self.period), period, self.params.seasonal, self.params.base_cell, tables=r), f"T-{period}")
        return self.hub.keep(detect.detect(self.assigned(period), panel, factors, period, self.params, past[-1] if past else None, past, lambda df: self.hub.keep(df, f"wide-{period}"), (r["quartiles"], r["cell_quartiles"])), f"detail-{period}")

    def graded(self, period: int) -> DataFrame:
        return detect.grade(self.detail(period), self.params.evidence_high_min)

    @cached_property
    def drops(self) -> DataFrame:
        return detect.store_drop(self.sc, self.clusters, self.period, self.prev, self.params.peer)

    @cached_property
    def missing(self) -> DataFrame:
        return detect.missing_sales(self.assigned(self.period), self.panel(self.period), self.period, self.prev, self.params.peer, self.drops)

    def release(self) -> None:
        """Removes the written tables."""
        self.hub.drop()

    @cached_property
    def drill(self) -> DataFrame:
        return self.hub.keep(items.drilldown(self.graded(self.period), self.items_of(self.period), self.items_of(self.prev), self.factors(self.period), self.params, self.item), "drill")

    @cached_property
    def corrections(self) -> DataFrame:
        return self.hub.keep(items.corrections(self.drill, self.graded(self.period), self.items_of(self.period), self.drops, self.params, self.item), "corrections")

    @cached_property
    def levels(self) -> DataFrame:
        """Levels of the target and of the earlier periods that have level limits, under the present clusters."""
        out = None
        for p in self.periods[max(1, len(self.periods) - self.replayed) :]:
            one = detect.level_summary(detect.grade(self.replayed_detail(p), self.params.evidence_high_min))
            out = one if out is None else out.unionByName(one)
        return out


def run(raw: DataFrame, stores: DataFrame, period: int, params: Params | None = None, **kw) -> dict[str, DataFrame]:
    """All report tables of a period by name."""
    p = Panel(raw, stores, period, params, **kw)
    graded = p.graded(period)
    return {
        "data_quality": p.quality,
        "profile": facts.profile(p.sc.filter(F.col("period_id") == period)),
        "clusters": p.clusters,
        "sample_check": p.check,
        "seasonal": p.factors(period),
        "graded": graded,
        "levels": detect.level_summary(graded),
        "store_drop": p.drops,
        "missing_sales": p.missing,
        "drilldown": p.drill,
        "corrections": p.corrections,
        "recheck": items.recheck(graded, p.corrections, p.params),
        "impact": items.impact(p.corrections, graded),
        "funnel": items.funnel(p.corrections),
        "threshold_grid": detect.threshold_grid(graded, p.params.detectors, p.params.grid_adjbox_c),
        "rate_by_period": detect.rate_by_period(p.levels, p.params.rate_spike_ratio),
        "adjustments": items.adjustments(graded),
        "by_dimension": items.summary_by_dimension(graded),
    }
