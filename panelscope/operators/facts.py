"""Quality tags, store matching, and the store x category facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ATTRS = ["PLATFORMNAME", "SHOPTYPE", "PROVINCE"]
DUPLICATE = ["period_id", "store_id", "prod_id"]
TAGS = ("dup_period_store_prod", "missing_value", "negative_value", "zero_unit_positive_value")
DROPPED = ("dup_period_store_prod", "negative_value")
DIMENSIONS = ("PLATFORMNAME", "SHOPTYPE", "PROVINCE", "category")


def tag_quality(items: DataFrame, order: list[str]) -> DataFrame:
    """Adds the four tags; order decides which of several duplicates is the first."""
    both = lambda c: F.coalesce(c, F.lit(False))
    value, unit = F.col("sales_value"), F.col("sales_unit")
    has_keys = set(DUPLICATE) <= set(items.columns)
    again = F.row_number().over(Window.partitionBy(*DUPLICATE).orderBy(*order)) > 1 if has_keys else F.lit(False)
    return items.withColumns(
        {
            TAGS[0]: again,
            TAGS[1]: value.isNull() | unit.isNull(),
            TAGS[2]: both(value < 0) | both(unit < 0),
            TAGS[3]: both((unit == 0) & (value > 0)),
        }
    )


def quality_summary(tagged: DataFrame, drop: tuple[str, ...] = DROPPED) -> DataFrame:
    """period_id, check, n_rows, n_stores, action: one pass, then turned to long form."""
    counts = [F.count("*").alias("rows_total_n"), F.count_distinct("store_id").alias("rows_total_s")]
    for t in TAGS:
        counts += [F.count_if(t).alias(f"{t}_n"), F.count_distinct(F.when(F.col(t), F.col("store_id"))).alias(f"{t}_s")]
    wide = tagged.groupBy("period_id").agg(*counts)
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("check"), F.col(f"{t}_n").alias("n_rows"), F.col(f"{t}_s").alias("n_stores"), F.lit("" if t == "rows_total" else "dropped" if t in drop else "tagged").alias("action"))
            for t in ("rows_total", *TAGS)
        ]
    )
    return wide.select("period_id", F.explode(rows).alias("r")).select("period_id", "r.*")


def unmatched_summary(unmatched: DataFrame) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.lit(None).cast("long").alias("n_rows"), F.col(c).alias("n_stores"), F.lit("" if c == "matched_stores" else "excluded").alias("action"))
            for c in ("item_only_stores", "target_only_stores", "matched_stores")
        ]
    )
    return unmatched.select("period_id", F.explode(rows).alias("r")).select("period_id", "r.*")


def drop_tagged(tagged: DataFrame, drop: tuple[str, ...] = DROPPED) -> DataFrame:
    bad = F.lit(False)
    for t in drop:
        bad = bad | F.col(t)
    return tagged.filter(~bad).drop(*TAGS)


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def match_stores(items: DataFrame, stores: DataFrame) -> DataFrame:
    """Inner join on period and store. The planner broadcasts the dimension while its size allows it."""
    return items.join(stores.select("period_id", "store_id", *ATTRS), ["period_id", "store_id"])


def unmatched_stores(items: DataFrame, stores: DataFrame) -> DataFrame:
    a = items.select("period_id", "store_id").distinct().withColumn("in_items", F.lit(True))
    b = stores.select("period_id", "store_id").distinct().join(a.select("period_id").distinct(), "period_id", "left_semi").withColumn("in_target", F.lit(True))
    both = a.join(b, ["period_id", "store_id"], "full_outer")
    left, right = F.col("in_items").isNotNull(), F.col("in_target").isNotNull()
    return both.groupBy("period_id").agg(
        F.count_if(left & right).alias("matched_stores"), F.count_if(left & ~right).alias("item_only_stores"), F.count_if(~left & right).alias("target_only_stores")
    )


def store_category(matched: DataFrame, item: str = "item") -> DataFrame:
    """Totals by period, store and category with item count, price and share of the store."""
    keys = ["period_id", "store_id", "category", *ATTRS]
    known = matched.dropna(subset=keys)
    sums = known.groupBy(*keys).agg(
        F.coalesce(F.sum("sales_value"), F.lit(0.0)).alias("sales_value"), F.coalesce(F.sum("sales_unit"), F.lit(0.0)).alias("sales_unit"), F.count_distinct(item).alias("n_item")
    )
    total = F.sum("sales_value").over(Window.partitionBy("period_id", "store_id"))
    return sums.withColumn("avg_price", F.when(F.col("sales_unit") > 0, F.col("sales_value") / F.col("sales_unit"))).withColumn("cat_share", F.when(total > 0, F.col("sales_value") / total))


def province_totals(matched: DataFrame) -> DataFrame:
    return matched.groupBy(
        "period_id", F.col("SHOPTYPE").alias("shoptype"), F.col("PROVINCE").alias("province"), "category", F.col("PLATFORMNAME").alias("platform")
    ).agg(F.sum("sales_value").alias("sales_value"), F.sum("sales_unit").alias("sales_unit"), F.count_distinct("store_id").alias("store_count"))


def item_totals(matched: DataFrame, item: str = "item", attrs: tuple[str, ...] = ("brand", "packsize")) -> DataFrame:
    """Totals by item; attributes are the least non-missing ones, which no file order can change."""
    return matched.groupBy("period_id", "store_id", "category", item).agg(
        F.sum("sales_value").alias("sales_value"), F.sum("sales_unit").alias("sales_unit"), *[F.min(c).alias(c) for c in attrs if c in matched.columns]
    )


def store_totals(sc: DataFrame, cell: tuple[str, ...]) -> DataFrame:
    return sc.groupBy("period_id", "store_id", *cell, "PROVINCE").agg(F.sum("sales_value").alias("sales_value"))


def zero_fill(sc: DataFrame, store_cluster: DataFrame) -> DataFrame:
    """Every store of a cluster with every category that the cluster sells; what was missing is 0 and marked. One period of sc."""
    cluster = store_cluster.select(F.col("store_id").alias("_s"), "cluster_id")
    df = sc.join(cluster, F.col("store_id") == F.col("_s")).drop("_s")
    stores = df.select("period_id", "store_id", "cluster_id", *ATTRS).distinct()
    grid = stores.join(df.select("cluster_id", "category").distinct(), "cluster_id")
    facts = sc.select("period_id", "store_id", "category", "sales_value", "sales_unit", "n_item", "avg_price", "cat_share")
    out = grid.join(facts, ["period_id", "store_id", "category"], "left").withColumn("zero_filled", F.col("sales_value").isNull())
    return out.fillna(0, subset=["sales_value", "sales_unit", "n_item", "cat_share"])


def profile(sc: DataFrame, dims: tuple[str, ...] = DIMENSIONS, value: str = "sales_value") -> DataFrame:
    """Distribution per period and level of each dimension by grouping sets over one scan."""
    long = sc.select(
        "period_id", "store_id", "n_item", F.when(~F.isnan(value), F.col(value)).alias("x"), F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("level")) for d in dims])).alias("d")
    ).select("period_id", "store_id", "n_item", "x", "d.*")
    q = F.percentile("x", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.9, 0.99)]))
    out = long.filter("level is not null").groupBy("period_id", "dimension", "level").agg(
        F.count_distinct("store_id").alias("n_store"),
        F.percentile("n_item", 0.5).alias("n_item_median"),
        F.count("*").alias("n_obs"),
        F.avg(F.when(F.col("x").isNotNull(), (F.col("x") == 0).cast("double"))).alias("zero_rate"),
        q.alias("q"),
        F.avg("x").alias("m"),
        F.stddev_samp("x").alias("s"),
        F.count("x").alias("n"),
    )
    return out.filter("n > 0").select(
        "period_id", "dimension", "level", "n_store", "n_item_median", "n_obs", "zero_rate", F.col("q")[1].alias("median"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"), F.col("q")[3].alias("p90"), F.col("q")[4].alias("p99"),
        F.when((F.col("n") > 1) & (F.col("m") != 0), F.col("s") / F.col("m")).alias("cv"),
    )
