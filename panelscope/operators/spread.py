"""Reference statistics of groups: leave-one-out quantiles, median absolute deviation, variance components, and the ANOVA monitor."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import log_sales

KAPPA = (0.25, 1e5)
FACTORS = ("PLATFORMNAME", "SHOPTYPE", "PROVINCE", "category")
CANDIDATES = ("PLATFORMNAME", "SHOPTYPE")


def leave_one_out(df: DataFrame, keys: list[str], value: str, tie: list[str], quantiles: dict[str, float], least: int = 3) -> DataFrame:
    """Quantiles of every row's group without the row itself; null in groups of fewer than `least` values.

    Without one value an interpolated quantile needs one of four neighbouring order statistics of the whole group, so each
    group carries four numbers per quantile, and no row sees its group's values.
    """
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    w = Window.partitionBy(*keys)
    r = known.withColumns({"_m": F.count("*").over(w), "_r": F.row_number().over(w.orderBy(value, *tie)) - 1}).filter(F.col("_m") >= least)
    at = {n: F.floor(q * (F.col("_m") - 2)) for n, q in quantiles.items()}
    after = {n: F.least(at[n] + 1, F.col("_m") - 2) for n in quantiles}
    need = [F.max(F.when(F.col("_r") == where[n] + o, F.col(value))).alias(f"_{n}_{x}{o}") for n in quantiles for x, where in (("i", at), ("j", after)) for o in (0, 1)]
    stats = r.groupBy(*keys).agg(*need)
    out = r.join(stats, keys)
    for n, q in quantiles.items():
        part = q * (F.col("_m") - 2) - at[n]
        low = F.when(F.col("_r") > at[n], F.col(f"_{n}_i0")).otherwise(F.col(f"_{n}_i1"))
        high = F.when(F.col("_r") > after[n], F.col(f"_{n}_j0")).otherwise(F.col(f"_{n}_j1"))
        out = out.withColumn(n, low * (1 - part) + high * part)
    return out.withColumn("n_peer", F.col("_m")).drop("_m", "_r", *[c for c in out.columns if c.startswith("_") and c[-1] in "01"])


def deviation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation."""
    med = df.groupBy(*keys).agg(F.percentile(value, 0.5).alias("median"), F.count(value).alias("n"))
    return df.join(med, keys).groupBy(*keys, "median", "n").agg(F.percentile(F.abs(F.col(value) - F.col("median")), 0.5).alias("mad"))


def kappa(df: DataFrame, cell: list[str], value: str, inner: str = "PROVINCE") -> DataFrame:
    """pi / 2 x variance within provinces over variance between them, by stratum and category, in two levels of sums."""
    keys = [*cell, "category"]
    g = df.filter(F.col(value).isNotNull()).groupBy(*keys, inner).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    a = g.groupBy(*keys).agg(F.sum("n").alias("n_obs"), F.count("*").alias("n_prov"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    n, k = F.col("n_obs"), F.col("n_prov")
    good = (k >= 2) & (n - k >= 1)
    between = F.when(good, (F.col("b") - F.col("s") * F.col("s") / n) / F.greatest(k - 1, F.lit(1)))
    within = F.when(good, F.greatest(F.col("q") - F.col("b"), F.lit(0.0)) / F.greatest(n - k, F.lit(1)))
    a = a.withColumns({"_within": within, "_tau": F.greatest((between - within) / (n / k), F.lit(0.0))})
    raw = F.when(F.coalesce(F.col("_tau") > 0, F.lit(False)), math.pi / 2 * F.col("_within") / F.when(F.col("_tau") > 0, F.col("_tau"))).otherwise(KAPPA[1])
    return a.select(*keys, F.greatest(F.least(raw, F.lit(KAPPA[1])), F.lit(KAPPA[0])).alias("kappa"), "n_obs", "n_prov")


# ------------------------------------------------------------------ ANOVA monitor
def _design(levels: list[tuple], factors: list[int], pair: tuple[int, int] | None = None) -> np.ndarray:
    """Intercept and a column for all but the first level of each factor, and of a pair of factors."""
    cols = [np.ones(len(levels))]
    for f in factors:
        names = sorted({x[f] for x in levels})
        cols += [np.array([x[f] == n for x in levels], float) for n in names[1:]]
    if pair:
        names = sorted({(x[pair[0]], x[pair[1]]) for x in levels})
        cols += [np.array([(x[pair[0]], x[pair[1]]) == n for x in levels], float) for n in names[1:]]
    return np.column_stack(cols)


def _fit(x: np.ndarray, n: np.ndarray, s: np.ndarray, q: float) -> tuple[float, int]:
    """Residual sum of squares and rank from counts and sums of the cells."""
    xtx, xty = x.T @ (x * n[:, None]), x.T @ s
    beta = np.linalg.lstsq(xtx, xty, rcond=None)[0]
    return float(max(q - 2 * beta @ xty + beta @ xtx @ beta, 0.0)), int(np.linalg.matrix_rank(xtx))


def anova(sc: DataFrame, strong: float, medium: float, factors: tuple[str, ...] = FACTORS, pair: tuple[str, str] = CANDIDATES) -> list[dict]:
    """Type-II partial eta squared of each factor and of one pair, on log sales.

    Only counts and sums per combination of factor levels reach the driver.
    """
    y = log_sales(F.col("sales_value"))
    cells = sc.dropna(subset=[*factors, "sales_value"]).groupBy(*factors).agg(F.count("*").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")).collect()
    if not cells:
        return []
    levels = [tuple(c[f] for f in factors) for c in cells]
    n, s, q = np.array([c["n"] for c in cells], float), np.array([c["s"] for c in cells]), float(sum(c["q"] for c in cells))
    every = list(range(len(factors)))
    full, rank = _fit(_design(levels, every), n, s, q)
    name = lambda e: "" if e is None else "strong" if e >= strong else "medium" if e >= medium else "weak"
    share = lambda ss, rest: ss / (ss + rest) if ss + rest > 0 else None
    out = []
    for i, f in enumerate(factors):
        if len({x[i] for x in levels}) > 1:
            rss, less = _fit(_design(levels, [j for j in every if j != i]), n, s, q)
            ss = max(rss - full, 0.0)
            out.append({"factor": f, "df": rank - less, "ss": ss, "partial_eta2": share(ss, full), "strength": name(share(ss, full))})
    rss, more = _fit(_design(levels, every, (factors.index(pair[0]), factors.index(pair[1]))), n, s, q)
    ss = max(full - rss, 0.0)
    out.append({"factor": ":".join(pair), "df": more - rank, "ss": ss, "partial_eta2": share(ss, rss), "strength": name(share(ss, rss))})
    total = q - s.sum() ** 2 / n.sum()
    out.append({"factor": "Residual", "df": int(n.sum()) - rank, "ss": full, "partial_eta2": None, "strength": ""})
    r2 = float(1 - full / total) if total > 0 else None
    return [dict(r, ss=float(r["ss"]), n_obs=int(n.sum()), r2_model=r2) for r in out]


def suggest_cell(table: list[dict], current: tuple[str, ...], candidates: tuple[str, ...] = CANDIDATES) -> list[str]:
    """Strata that the monitor would use: a strong factor or pair adds one, medium keeps one that is in use; nothing found keeps all."""
    strength = {r["factor"]: r["strength"] for r in table}
    pair = strength.get(":".join(candidates), "")
    chosen = [f for f in candidates if "strong" in (strength.get(f), pair) or f in current and "medium" in (strength.get(f), pair)]
    return chosen or list(current)
