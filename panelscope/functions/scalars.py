"""Scalar rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH, LOW, OK, NA = "high", "low", "ok", "na"
LEVELS = ("normal", "watch", "suspicious", "high_confidence")
EVIDENCE = ("adjbox_value", "share_adjbox", "item_adjbox", "history_flag")
#: Order in which a tie between high and low evidence is decided.
TIE_ORDER = ("history_flag", "adjbox_value", "share_adjbox", "item_adjbox")
UNKNOWN_PACK = ("", "UNKNOWN", "NAN", "NONE", "N/A", "NA")


def finite(x: Column) -> Column:
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is null or not positive."""
    return F.when(b > 0, a / b)


def log_sales(x: Column) -> Column:
    return F.log1p(F.greatest(x.cast("double"), F.lit(0.0)))


def fence(q1: Column, q3: Column, mc: Column, a: float, b: float, c: float) -> tuple[Column, Column]:
    """Medcouple-adjusted boxplot fence (Hubert and Vandervieren)."""
    iqr, up = q3 - q1, mc >= 0
    low = q1 - F.lit(float(c)) * F.exp(F.when(up, a * mc).otherwise(-b * mc)) * iqr
    high = q3 + F.lit(float(c)) * F.exp(F.when(up, b * mc).otherwise(-a * mc)) * iqr
    return low, high


def flag(x: Column, low: Column, high: Column) -> Column:
    """high, low or ok; na where the value or a limit is missing. NaN would be greater than all numbers, so it is tested first."""
    return F.when(~(finite(x) & finite(low) & finite(high)), NA).when(x > high, HIGH).when(x < low, LOW).otherwise(OK)


def sign_statistic(plus: Column, minus: Column) -> Column:
    n = plus + minus
    return F.when(n > 0, (F.abs(plus - minus) - 1) / F.sqrt(n.cast("double")))


def sign_direction(plus: Column, minus: Column) -> Column:
    return F.when(plus > minus, "positive").when(minus > plus, "negative").otherwise("")


def combine(level_flag: Column, trend_flag: Column) -> Column:
    """A flag of one test survives an ok of the other; in conflict the level test holds."""
    return F.when(level_flag.isin(NA, OK), F.when(trend_flag != NA, trend_flag).otherwise(level_flag)).otherwise(level_flag)


def count_of(columns, value: str) -> Column:
    out = F.lit(0)
    for c in columns:
        out = out + F.when(F.col(c) == value, 1).otherwise(0)
    return out


def level_of(n: Column, high_min: int) -> Column:
    return F.when(n <= 0, LEVELS[0]).when(n >= high_min, LEVELS[3]).when(n == 1, LEVELS[1]).otherwise(LEVELS[2])


def level_rank(level: Column) -> Column:
    out = F.lit(0)
    for i, name in enumerate(LEVELS):
        out = F.when(level == name, i).otherwise(out)
    return out


def direction_of(n_high: Column, n_low: Column) -> Column:
    tie = F.coalesce(*[F.when(F.col(c).isin(HIGH, LOW), F.col(c)) for c in TIE_ORDER], F.lit("mixed"))
    return F.when(n_high > n_low, HIGH).when(n_low > n_high, LOW).when(n_high + n_low > 0, tie).otherwise("")


def evidence_list() -> Column:
    return F.concat_ws(",", *[F.when(F.col(c).isin(HIGH, LOW), F.concat(F.lit(f"{c}:"), F.col(c))) for c in EVIDENCE])


def auto_action(level: Column, direction: Column, peer_level: Column, zero: Column) -> Column:
    """skip, flag_only or fix; rows without sales are never fixed."""
    fix = F.when(zero, "flag_only").otherwise("fix")
    return F.when((peer_level == NA) | (level == "normal") | ~direction.isin(HIGH, LOW), "skip").when(level_rank(level) >= 2, fix).otherwise("flag_only")


def strength(eta2: Column, strong: float, medium: float) -> Column:
    return F.when(eta2 >= strong, "strong").when(eta2 >= medium, "medium").when(eta2.isNotNull(), "weak").otherwise("")


def parse_packsize(text: Column) -> Column:
    """struct(qty, size, unit) of `QTY x SIZE UNIT` or `SIZE UNIT`; missing parts are null."""
    t = F.upper(F.trim(F.coalesce(text, F.lit(""))))
    t = F.when(t.isin(*UNKNOWN_PACK), F.lit("")).otherwise(t)
    pattern = r"^(?:([0-9]+(?:\.[0-9]+)?)\s*[X*]\s*)?([0-9]+(?:\.[0-9]+)?)\s*([A-Z]+)$"
    part = lambda i: F.nullif(F.regexp_extract(t, pattern, i), F.lit(""))
    return F.struct(part(1).cast("double").alias("qty"), part(2).cast("double").alias("size"), part(3).alias("unit"))


def packsize_volume(pack: Column) -> Column:
    return F.coalesce(pack["qty"], F.lit(1.0)) * pack["size"]


def same_packsize(a: Column, b: Column, tolerance: float) -> Column:
    return F.coalesce(F.abs(a - b) / F.greatest(a, b) <= tolerance, F.lit(False))


def split_brand(text: Column, parts: int = 3) -> Column:
    """Trimmed, non-empty parts between slashes, padded with null."""
    found = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "/"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array(*[F.get(found, F.lit(i)) for i in range(parts)])


def brand_key(text: Column) -> Column:
    p = split_brand(text)
    return F.coalesce(F.get(p, F.lit(1)), F.get(p, F.lit(0)))


def f_quantile(p: float, denominator: Column) -> Column:
    """Quantile of F(2, v) in closed form."""
    return denominator / 2 * (F.pow(F.lit(1 - p), -2 / denominator) - 1)


def corrected_units(corrected: Column, value: Column, units: Column) -> Column:
    """Units at the old price, half to even."""
    return F.when((units > 0) & (value > 0), F.bround(corrected / (value / units), 0))
