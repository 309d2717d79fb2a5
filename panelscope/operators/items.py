"""Item level: drilldown of graded rows, corrections with their recheck and impact, and report tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from ..functions.robust import adjbox, right_tail, with_medcouple
from ..plans.params import Params
from .facts import ATTRS

#: How well an item is matched, best first, and what a correction by it is worth.
MATCHES = (("key_brand_packsize", 1.0), ("key_brand", 0.9), ("key", 0.8), ("brand_category_packsize", 0.6), ("category", 0.4))


def targets(graded: DataFrame, min_level: str) -> DataFrame:
    return graded.filter((S.level_rank(F.col("level")) >= S.LEVELS.index(min_level)) & F.col("direction").isin("high", "low") & (F.col("peer_level") != "na"))


def _prices(df: DataFrame) -> DataFrame:
    return df.withColumn("unit_price", F.when(F.col("sales_unit") > 0, F.col("sales_value") / F.col("sales_unit")))


def drilldown(graded: DataFrame, items_now: DataFrame, items_prev: DataFrame, factors: DataFrame, params: Params, item: str = "item") -> DataFrame:
    """The items that move each graded row most. Item frames carry cluster_id.

    Expected sales: the median over enough other stores of the peer set, else the store's own previous sales over T, else 0. A low row
    also gets the items that have vanished.
    """
    p = params.items
    t = factors.filter("metric = 'sales_value'").select("peer_set", "category", "T_final")
    keys = ["store_id", "category"]
    want = targets(graded, p.min_level).select("period_id", *keys, "peer_set", "members", "level", "direction").join(
        t.withColumnRenamed("T_final", "t"), ["peer_set", "category"], "left"
    ).withColumn("t", F.when(S.finite(F.col("t")) & (F.col("t") > 0), F.col("t")).otherwise(1.0))
    now = items_now.filter("sales_value > 0").drop("period_id")
    own = now.join(want, keys).select(*keys, "period_id", "peer_set", "level", "direction", "t", item, "sales_value", "sales_unit")
    before = items_prev.filter("sales_value > 0").groupBy(*keys, item).agg(F.sum("sales_value").alias("prev")).join(want, keys)
    before = before.select(*keys, "period_id", "peer_set", "level", "direction", "t", item, (F.col("prev") / F.col("t")).alias("prev_sales"))
    both = own.join(before, [*keys, "period_id", "peer_set", "level", "direction", "t", item], "full_outer").filter("sales_value is not null or direction = 'low'")
    # other stores of the peer set with the same item; the targets bound this join
    member = want.select(*keys, F.explode("members").alias("cluster_id"))
    peers = both.filter("sales_value is not null").select(*keys, item).join(member, keys).join(
        now.select(F.col("store_id").alias("other"), "category", "cluster_id", item, F.col("sales_value").alias("x")), ["category", "cluster_id", item]
    ).filter("other <> store_id")
    stats = peers.groupBy(*keys, item).agg(F.count_distinct("other").alias("n_peer"), F.percentile("x", 0.5).alias("peer_med"))
    rows = both.join(stats, [*keys, item], "left")
    gone = F.col("sales_value").isNull()
    enough = F.coalesce(F.col("n_peer") >= p.min_peer_stores, F.lit(False)) & ~gone
    has = F.col("prev_sales").isNotNull()
    rows = _prices(rows.withColumns(
        {
            "expected_sales": F.when(enough, F.col("peer_med")).otherwise(F.coalesce("prev_sales", F.lit(0.0))),
            "expected_source": F.when(enough, "peer_median").when(has, "prev_period").otherwise("new_item"),
            "item_flag": F.when(gone, "missing_item").when(~enough & ~has, "new_item").otherwise(""),
            "sales_value": F.coalesce("sales_value", F.lit(0.0)),
            "sales_unit": F.coalesce("sales_unit", F.lit(0.0)),
        }
    )).withColumn("delta", F.col("sales_value") - F.col("expected_sales"))
    rows = rows.filter(((F.col("direction") == "high") & (F.col("delta") > 0)) | ((F.col("direction") == "low") & (F.col("delta") < 0)))
    w = Window.partitionBy(*keys)
    rows = rows.withColumns({"contribution": F.col("delta") / F.sum("delta").over(w), "rank": F.row_number().over(w.orderBy(F.abs("delta").desc(), item))})
    return rows.filter(F.col("rank") <= p.top_n).select(
        "period_id", *keys, "peer_set", "level", "direction", "rank", item, "sales_value", "sales_unit", "unit_price", "n_peer", "expected_sales", "expected_source", "item_flag", "delta", "contribution"
    )


def store_shift(graded: DataFrame, params: Params) -> DataFrame:
    """Stores whose categories are mostly high at fix level: the whole store has moved, its items are left alone."""
    p, fix = params.items, F.col("auto_action") == "fix"
    s = graded.filter("peer_level <> 'na'").groupBy("period_id", "store_id").agg(
        F.count_distinct("category").alias("n_cat"), F.count_if(fix & (F.col("direction") == "high")).alias("n_high"), F.count_if(fix & (F.col("direction") == "low")).alias("n_low"), F.sum("sales_value").alias("sales_value"), *[F.min(a).alias(a) for a in ATTRS]
    )
    s = s.withColumn("high_ratio", F.col("n_high") / F.col("n_cat"))
    return s.filter((F.col("n_cat") >= p.store_shift_min_cat) & (F.col("high_ratio") >= p.store_shift_ratio)).withColumn("direction", F.lit("high"))


def _parsed(items: DataFrame, item: str) -> DataFrame:
    pack = S.packsize_volume(S.parse_packsize(F.col("packsize")))
    return items.withColumns({"brand_key": S.brand_key(F.col("brand")), "volume": pack}).select("store_id", "category", "cluster_id", item, "sales_value", "brand", "packsize", "brand_key", "volume")


def _rates(rows: DataFrame, parsed: DataFrame, totals: DataFrame, params: Params, item: str) -> DataFrame:
    """store_id, category, item, match, n_other, fixed_rate of rows: the best level at which other stores of their clusters match, how many
    such stores there are, and for tested rows the corrected rate; null if the test leaves it.

    Rows of one peer set and item meet the sellers of that item; those that nobody else sells meet the sellers of their category.
    A store's rows at the best level count as one.
    """
    keys = ["store_id", "category", item]
    wanted = rows.select(*keys, "members", F.concat_ws("\x1f", F.array_sort("members")).alias("set"), F.col("brand_key").alias("bk"), F.col("volume").alias("vol"), "own_rate", "tested")
    sets = wanted.select("set", F.explode("members").alias("cluster_id")).distinct()
    other = parsed.join(totals, "store_id").join(sets, "cluster_id").select(F.col("set").alias("other_set"), F.col("store_id").alias("other"), F.col("category").alias("other_cat"), F.col(item).alias("other_item"), "brand_key", "volume", F.col("sales_value").alias("x"), F.col("store_total").alias("total"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"store_id {types['store_id']}, category {types['category']}, {item} {types[item]}, match int, n_other int, fixed_rate double"

    def level(first: int, names: list[str]):
        def run(targets: pd.DataFrame, peers: pd.DataFrame) -> pd.DataFrame:
            out = matched_rates(targets, peers, first, params.items) if len(targets) and len(peers) else []
            return pd.DataFrame([(*(getattr(t, n) for n in names), *found) for t, *found in out], columns=[*names, "match", "n_other", "fixed_rate"]).astype({"match": "Int32", "n_other": "Int32", "fixed_rate": "float64"})

        return run

    by_item = wanted.drop("members").withColumnRenamed(item, "target").filter("target is not null").groupBy("set", "target").cogroup(other.groupBy("other_set", "other_item"))
    by_item = by_item.applyInPandas(level(0, ["store_id", "category", "target"]), schema.replace(f", {item} ", ", target "))
    by_item = by_item.withColumnRenamed("target", item)
    # the ends of the sellers' names tell whether there is another one
    ends = other.groupBy(F.col("other_set").alias("set"), F.col("other_item").alias(item)).agg(F.min("other").alias("first"), F.max("other").alias("last"))
    alone = F.col("first").isNull() | ((F.col("first") == F.col("store_id")) & (F.col("last") == F.col("store_id")))
    left = wanted.drop("members").join(ends, ["set", item], "left").filter(alone).drop("first", "last").withColumnRenamed(item, "target")
    by_category = left.groupBy("set", "category").cogroup(other.groupBy("other_set", "other_cat")).applyInPandas(level(3, ["store_id", "category", "target"]), schema.replace(f", {item} ", ", target "))
    return by_item.unionByName(by_category.withColumnRenamed("target", item))


def matched_rates(targets: pd.DataFrame, peers: pd.DataFrame, first: int, p) -> list[tuple]:
    """(target, match, n_other, fixed_rate) of the targets that another store matches. All peers share the item (first 0) or the category (first 3)."""
    codes, names = pd.factorize(peers["other"])
    number = {s: i for i, s in enumerate(names)}
    x, total = peers["x"].to_numpy(float), peers["total"].to_numpy(float)
    known = ~np.isnan(x)
    volume, brand = peers["volume"].to_numpy(float), peers["brand_key"].to_numpy(object)
    total_of = np.zeros(len(names))
    total_of[codes] = total
    no_brand = pd.isna(brand)

    def stores(hit: np.ndarray):
        """Stores of the rows and their rates, least first; a rate is NaN where the store has no sales in all."""
        who, where = np.unique(codes[hit], return_inverse=True)
        sums = np.bincount(where[known[hit]], x[hit & known], len(who))
        with np.errstate(invalid="ignore", divide="ignore"):
            return who, np.where((total_of[who] > 0) & (np.bincount(where[known[hit]], minlength=len(who)) > 0), sums / total_of[who], np.nan)

    out = []
    for (bk, vol), group in targets.groupby(["bk", "vol"], dropna=False, sort=False):
        same = no_brand if pd.isna(bk) else brand == bk
        with np.errstate(invalid="ignore", divide="ignore"):
            pack = np.abs(vol - volume) / np.maximum(vol, volume) <= p.packsize_tolerance
        steps = [same & pack, same, np.ones(len(x), bool)] if first == 0 else [same & pack, np.ones(len(x), bool)]
        found: dict = {}
        for t in group.itertuples(index=False):
            own = number.get(t.store_id, -1)
            for k, hit in enumerate(steps):
                if k not in found:
                    found[k] = stores(hit)
                who, rates = found[k]
                there = np.searchsorted(who, own) if own >= 0 else len(who)
                there = there if there < len(who) and who[there] == own else None
                if len(who) - (there is not None) == 0:
                    continue
                rest = rates if there is None else np.delete(rates, there)
                rest = rest[~np.isnan(rest)]
                fixed = None
                if t.tested and len(rest) and t.own_rate == t.own_rate and t.own_rate is not None:
                    mask, values = right_tail(np.append(np.sort(rest), t.own_rate), p.tail_detect, p.tail_correct, p.tail_max, p.critical_ratio, p.min_peer_stores)
                    fixed = float(values[-1]) if mask[-1] else None
                out.append((t, first + k, len(rest) or None, fixed))
                break
    return out


def corrections(drill: DataFrame, graded: DataFrame, items_now: DataFrame, drops: DataFrame, params: Params, item: str = "item") -> DataFrame:
    """Every drilled row with its reason; reason = corrected rows have corrected values.

    High items: the rates (share of the store's sales) of the best matching items in peer stores, tested for an exponential right tail.
    Low items: lifted to the lower fence of what peer stores sell in the category.
    """
    p, d = params.items, params.detectors
    keys = ["store_id", "category"]
    totals = items_now.groupBy("store_id").agg(F.sum("sales_value").alias("store_total"))
    parsed = _parsed(items_now, item)
    shift = store_shift(graded, params).select("store_id").withColumn("shifted", F.lit(True))
    dropped = drops.select("store_id").distinct().withColumn("dropped", F.lit(True))
    rows = drill.join(graded.select(*keys, "auto_action", "members", F.col("sales_value").alias("row_sales"), "zero_filled"), keys)
    info = parsed.select("store_id", item, "brand", "packsize", "brand_key", "volume").groupBy("store_id", item).agg(*[F.min(c).alias(c) for c in ("brand", "packsize", "brand_key", "volume")])
    rows = rows.join(shift, "store_id", "left").join(dropped, "store_id", "left").join(info, ["store_id", item], "left").join(totals, "store_id", "left")
    zero = F.coalesce("zero_filled", F.lit(False)) | (F.col("row_sales") <= 0) | (F.col("sales_value") <= 0)
    # rows whose reason does not depend on their peers need their number alone
    tested = (F.col("auto_action") == "fix") & F.col("shifted").isNull() & ~F.coalesce(zero, F.lit(False))
    rows = rows.withColumns({"own_rate": F.when(F.col("store_total") > 0, F.col("sales_value") / F.col("store_total")), "tested": F.coalesce(tested, F.lit(False))})
    rows = rows.join(_rates(rows.filter("direction = 'high'"), parsed, totals, params, item), ["store_id", "category", item], "left")
    sold = graded.filter("sales_value > 0").select(F.col("store_id").alias("other"), "category", "cluster_id", S.log_sales(F.col("sales_value")).alias("lv"))
    low = rows.filter("direction = 'low'").groupBy(*keys).agg(F.first("members").alias("members"), F.max(F.col("tested") & F.col("dropped").isNull()).alias("tested"))
    low = low.select(*keys, "tested", F.explode("members").alias("cluster_id")).distinct()
    # the number of peers from counts by cluster less the own row; fences only where they are asked for
    own = sold.groupBy(F.col("other").alias("store_id"), "category", "cluster_id").agg(F.count("*").alias("own"))
    n_low = low.join(sold.groupBy("category", "cluster_id").agg(F.count("*").alias("n")), ["category", "cluster_id"]).join(own, [*keys, "cluster_id"], "left")
    n_low = n_low.groupBy(*keys).agg(F.sum(F.col("n") - F.coalesce("own", F.lit(0))).alias("n_low_peer")).filter("n_low_peer > 0")
    low = low.filter("tested").join(sold, ["category", "cluster_id"]).filter("other <> store_id")
    low = with_medcouple(low.groupBy(*keys).agg(*adjbox(F.col("lv"), "pl")), "pl")
    low = low.withColumn("low_fence", S.fence(F.col("pl_q1"), F.col("pl_q3"), F.col("pl_mc"), d.adjbox_a, d.adjbox_b, d.adjbox_c)[0]).select(*keys, "low_fence")
    rows = rows.join(n_low, keys, "left").join(low, keys, "left")
    rows = rows.withColumn("n_rate", F.coalesce("n_other", F.lit(0)) + F.when(F.col("store_total") > 0, 1).otherwise(0))
    high = F.col("direction") == "high"
    reason = (
        F.when(F.col("auto_action") != "fix", "skip_not_fix_action")
        .when(F.col("shifted").isNotNull(), "skip_store_shift")
        .when(zero, "skip_missing_sales_warn")
        .when(F.size("members") == 0, "skip_no_peer_stores")
        .when(high & F.col("n_other").isNull(), "skip_match_empty")
        .when(high & (F.col("n_rate") < p.min_peer_stores), "skip_peer_rate_lt_min")
        .when(high & F.col("fixed_rate").isNull(), "skip_tail_not_flagged")
        .when(high, "corrected")
        .when(F.col("dropped").isNotNull(), "skip_store_drop")
        .when(F.coalesce("n_low_peer", F.lit(0)) < p.min_peer_stores, "skip_peer_sales_lt_min")
        .when(F.log1p("sales_value") >= F.col("low_fence"), "skip_above_left_fence")
        .otherwise("corrected")
    )
    rows = rows.withColumn("reason", reason)
    done = F.col("reason") == "corrected"
    value = F.when(done & high, F.col("fixed_rate") * F.col("store_total")).when(done, F.greatest(F.expm1("low_fence"), F.lit(0.0)))
    rows = rows.withColumn("corrected_value", value)
    rows = rows.withColumn("corrected_unit", S.corrected_units(F.col("corrected_value"), F.col("sales_value"), F.col("sales_unit")))
    matched = F.when(high, F.col("match")).otherwise(F.lit(4))
    name, worth = F.array(*[F.lit(m) for m, _ in MATCHES]), F.array(*[F.lit(c) for _, c in MATCHES])
    return rows.select(
        "period_id", *keys, item, "brand", "packsize", "brand_key", "direction", "reason",
        F.when(done, F.get(name, matched)).alias("match_level"), F.when(done, F.bround(F.get(worth, matched), 4)).alias("confidence"),
        F.when(high, F.col("n_rate")).otherwise(F.col("n_low_peer")).cast("int").alias("n_peer"),
        F.col("sales_value").alias("original_value"), F.col("sales_unit").alias("original_unit"), "corrected_value", "corrected_unit",
        (F.col("corrected_value") - F.col("sales_value")).alias("impact_value"), (F.col("corrected_unit") - F.col("sales_unit")).alias("impact_unit"),
    )


def funnel(rows: DataFrame) -> DataFrame:
    return rows.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("store_id", "category").alias("n_store_cat"))


def recheck(graded: DataFrame, corrected: DataFrame, params: Params) -> DataFrame:
    """Do corrected rows lie within the fence of their peers that were not corrected?"""
    d, keys = params.detectors, ["store_id", "category"]
    done = corrected.filter("reason = 'corrected'")
    change = done.groupBy(*keys).agg(F.sum("impact_value").alias("impact")).join(graded.select(*keys, "period_id", "peer_set", "sales_value"), keys)
    clean = graded.join(done.select("store_id").distinct(), "store_id", "left_anti").select(F.col("store_id").alias("other"), "peer_set", "category", S.log_sales(F.col("sales_value")).alias("lv"))
    stats = with_medcouple(change.join(clean, ["peer_set", "category"]).filter("other <> store_id").groupBy(*keys).agg(F.count("*").alias("n_peer"), *adjbox(F.col("lv"), "q")), "q")
    out = change.join(stats.filter(F.col("n_peer") >= params.items.min_peer_stores), keys)
    low, high = S.fence(F.col("q_q1"), F.col("q_q3"), F.col("q_mc"), d.adjbox_a, d.adjbox_b, d.adjbox_c)
    out = out.withColumns({"corrected_value": F.col("sales_value") + F.col("impact"), "lv_lo": low, "lv_hi": high})
    return out.select("period_id", *keys, F.col("sales_value").alias("original_value"), "corrected_value", "n_peer", "lv_lo", "lv_hi", F.log1p("corrected_value").between(F.col("lv_lo"), F.col("lv_hi")).alias("resolved"))


def impact(corrected: DataFrame, graded: DataFrame) -> DataFrame:
    """Net and absolute change overall and by five dimensions, from one scan."""
    attrs = graded.groupBy("store_id").agg(*[F.min(a).alias(a) for a in ATTRS])
    done = corrected.filter("reason = 'corrected'").join(attrs, "store_id")
    dims = (("overall", F.lit("overall")), ("platform", F.col("PLATFORMNAME")), ("shoptype", F.col("SHOPTYPE")), ("province", F.col("PROVINCE")), ("category", F.col("category")), ("brand", F.col("brand_key")))
    long = done.select("impact_value", F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("level")) for n, c in dims])).alias("d")).select("impact_value", "d.*")
    return long.groupBy("dimension", "level").agg(F.count("*").alias("n_items"), F.sum("impact_value").alias("net_impact"), F.sum(F.abs("impact_value")).alias("total_volume"))


def adjustments(graded: DataFrame, min_level: str = "suspicious") -> DataFrame:
    """What flagged rows would be at the fence and at their peers' median."""
    med = graded.filter("sales_value > 0").groupBy("peer_set", "category").agg(F.percentile("sales_value", 0.5).alias("peer_median_sales"))
    r = targets(graded, min_level).join(med, ["peer_set", "category"], "left")
    x, top = F.col("sales_value"), lambda c: F.expm1(F.least(F.col(c), F.lit(700.0)))
    floor, high = F.greatest(top("lv_lo"), F.lit(0.0)), F.col("direction") == "high"
    r = r.withColumns(
        {
            "fence": F.when(high, top("lv_hi")).otherwise(floor),
            "expected_fence": F.coalesce(F.when(F.col("lv_lo").isNull(), x).when(high, F.least(x, top("lv_hi"))).otherwise(F.greatest(x, floor)), x),
            "expected_median": F.coalesce("peer_median_sales", x),
        }
    )
    r = r.withColumns({"adj_to_fence": F.col("expected_fence") - x, "adj_to_median": F.col("expected_median") - x})
    r = r.withColumns({"adj_pct_fence": F.when(x > 0, F.col("adj_to_fence") / x), "adj_pct_median": F.when(x > 0, F.col("adj_to_median") / x)})
    return r.select("period_id", "store_id", "category", *ATTRS, "peer_set", "level", "direction", "evidence_list", "sales_value", "fence", "peer_median_sales", "expected_fence", "expected_median", "adj_to_fence", "adj_to_median", "adj_pct_fence", "adj_pct_median")


def summary_by_dimension(graded: DataFrame) -> DataFrame:
    """Counts of judged and flagged rows and stores by five dimensions."""
    base = graded.filter("peer_level <> 'na'")
    dims = ("PLATFORMNAME", "SHOPTYPE", "PROVINCE", "category", "cluster_id")
    plus = S.level_rank(F.col("level")) >= 2
    long = base.select("store_id", "level", "direction", "sales_value", F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("value")) for n in dims])).alias("d")).select("store_id", "level", "direction", "sales_value", "d.*")
    return long.groupBy("dimension", "value").agg(
        F.count("*").alias("n_rows"), F.count_distinct("store_id").alias("n_store"), F.count_if(plus).alias("n_flagged"), F.count_distinct(F.when(plus, F.col("store_id"))).alias("n_store_flagged"), F.count_if(plus & (F.col("direction") == "high")).alias("n_high"), F.count_if(plus & (F.col("direction") == "low")).alias("n_low"),
        (F.count_if(plus) / F.count("*")).alias("flagged_share"), F.sum("sales_value").alias("sales_value"),
    )


def tag_raw(raw: DataFrame, tagged: DataFrame, stores: DataFrame, graded: DataFrame, drops: DataFrame, corrected: DataFrame, keys: list[str], item: str = "item") -> DataFrame:
    """Every raw row with quality flags, attributes, grade, corrections and a list of its issues; left joins on unique keys only."""
    from .facts import DROPPED, TAGS

    flags = tagged.select(*keys, F.concat_ws(";", *[F.when(F.col(t), t) for t in TAGS]).alias("dq_flags"), (F.col(DROPPED[0]) | F.col(DROPPED[1])).alias("dq_dropped"))
    grade = graded.select("period_id", "store_id", "category", "peer_set", "level", "direction", "evidence_list", "auto_action")
    fixed = corrected.filter("reason = 'corrected'").select("period_id", "store_id", "category", item, "corrected_value", "corrected_unit")
    out = (
        raw.join(flags, keys, "left")
        .join(stores.select("period_id", "store_id", *ATTRS).withColumn("store_matched", F.lit(True)), ["period_id", "store_id"], "left")
        .join(grade, ["period_id", "store_id", "category"], "left")
        .join(drops.select("period_id", "store_id").withColumn("store_drop", F.lit(True)), ["period_id", "store_id"], "left")
        .join(fixed, ["period_id", "store_id", "category", item], "left")
        .withColumns({"store_matched": F.coalesce("store_matched", F.lit(False)), "store_drop": F.coalesce("store_drop", F.lit(False))})
    )
    plus = F.coalesce(S.level_rank(F.col("level")) >= 2, F.lit(False)) & F.col("level").isNotNull()
    issue = F.concat_ws(";", F.when(F.col("dq_dropped"), "dq_dropped"), F.when(~F.col("store_matched"), "store_unmatched"), F.when(F.col("store_drop"), "store_drop"), F.when(plus, F.concat_ws(":", "level", "direction")), F.when(F.col("corrected_value").isNotNull(), "corrected"))
    return out.withColumn("issue", issue)
