import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscope.functions import robust
from panelscope.functions import scalars as S
from panelscope.operators import clusters, detect, facts, items, seasonal, spread
from panelscope.plans.params import Clusters, Detectors, Params, Peer, Seasonal, load
from panelscope.sources import tables


def brute_medcouple(x):
    x = sorted(x)
    m = float(np.median(x))
    up, down = [v - m for v in x if v >= m], [v - m for v in x if v <= m]
    k = sum(v == m for v in x)
    h, i = [], 0
    for u in up:
        i += u == 0
        j = 0
        for d in down:
            j += d == 0
            h.append(float(np.sign(i + j - 1 - k)) if u == 0 and d == 0 else (u + d) / (u - d))
    return float(np.median(h))


@pytest.mark.parametrize("x", [[1, 2, 4, 8, 16], [1, 1, 1, 2, 9], [3, 3, 3, 3], [0, 0, 0, 5, 7, 9], list(range(50))])
def test_medcouple_small(x):
    assert robust.medcouple(x) == pytest.approx(brute_medcouple(x), abs=1e-12)


def test_medcouple_known_and_selected():
    assert robust.medcouple([1, 2, 4, 8, 16]) == pytest.approx(1 / 3)
    assert robust.medcouple([1, 2]) == 0.0
    rng = np.random.default_rng(3)
    for x in (rng.lognormal(size=701), np.round(rng.exponential(size=900), 1), np.concatenate([np.zeros(300), rng.random(500)])):
        z = np.sort(x) - np.median(x)
        up, down, ties = z[z >= 0], z[z <= 0], int((z == 0).sum())
        assert robust._selected(up, down, ties) == pytest.approx(float(np.median(robust._kernel(up, down, ties))), abs=1e-9)


def test_heterogeneity():
    rng = np.random.default_rng(1)
    a, b, far = rng.normal(8, 1, 60), rng.normal(8, 1, 60), rng.normal(11, 1, 60)
    limits = robust.Limits(1.2, 0.2, 0.25, 2.0)
    pool = lambda x, y, **k: robust.Pooling(robust.Sample(x), robust.Sample(y), limits)
    assert pool(a, b).allowed and not pool(a, far).allowed
    assert pool(a[:3], b).bins == 0 and math.isnan(pool(a[:3], b).psi)
    assert pool([2, 2], [2, 2]).vi == 1.0 and pool([2, 2], [3, 3]).vi == math.inf and math.isnan(pool([], [1]).vi)
    both = np.concatenate([a, far])
    assert pool(a, far).vi == pytest.approx(both.var() / ((a.var() + far.var()) / 2))
    assert pool([1, 1, np.nan] * 5, [1, 1] * 5).psi == 0.0
    whole = robust.Sample(a) + robust.Sample(b)
    assert whole.values.tolist() == sorted([*a, *b]) and whole.spread == pytest.approx(np.concatenate([a, b]).var() * 120)
    at = np.sort(both)
    assert pool(a, far).ks == pytest.approx(max(abs((a <= x).mean() - (far <= x).mean()) for x in at))
    cuts = np.quantile(both, np.arange(1, 10) / 10)
    f = [np.clip(np.histogram(x, [-np.inf, *cuts, np.inf])[0] / len(x), 1e-4, None) for x in (a, far)]
    assert pool(a, far).psi == pytest.approx(((f[1] - f[0]) * np.log(f[1] / f[0])).sum())
    assert robust.chi2_quantile(0.95, 1) == pytest.approx(3.8414588, abs=1e-6)
    assert robust.chi2_quantile(0.95, 9) == pytest.approx(16.9189776, abs=1e-6)
    assert robust.ks_p_value(1.0, 3, 3) == pytest.approx(0.1)
    assert robust.ks_p_value(0.0, 5, 5) == pytest.approx(1.0)


def test_right_tail():
    x = np.r_[np.arange(1, 21), 500.0]
    mask, fixed = robust.right_tail(x)
    assert mask.tolist() == [False] * 20 + [True] and 20 < fixed[-1] < 500
    for same in ([5.0] * 10, list(range(1, 21)), [1.0, 2.0, 90.0]):
        m, f = robust.right_tail(same)
        assert not m.any() and f.tolist() == list(map(float, same))
    y = np.r_[np.nan, x]
    assert robust.right_tail(y)[0].tolist() == [False, *mask.tolist()]
    assert robust.tail_quantile(0.995, 5.75 / 1) > 0


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_packsize_and_brand(spark):
    df = spark.createDataFrame([("1X48GM", "a/b/c"), ("2X24GM", "a"), ("1PCK", " / x / y"), ("unknown", ""), (None, None)], "p string, b string")
    got = df.select(S.parse_packsize(F.col("p")).alias("k"), S.brand_key(F.col("b")).alias("b")).select("k.*", S.packsize_volume(F.col("k")).alias("v"), "b")
    assert rows(got, "qty", "size", "unit", "v", "b") == [(1.0, 48.0, "GM", 48.0, "b"), (2.0, 24.0, "GM", 48.0, "a"), (None, 1.0, "PCK", 1.0, "y"), (None, None, None, None, None), (None, None, None, None, None)]


def test_flags_and_fence(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 2.0, 3.0), (2.5, 2.0, 3.0), (float("nan"), 2.0, 3.0), (None, 2.0, 3.0)], "x double, l double, h double")
    assert [r[0] for r in df.select(S.flag(F.col("x"), F.col("l"), F.col("h"))).collect()] == ["low", "high", "ok", "na", "na"]
    one = spark.range(1).select(*S.fence(F.lit(26.0), F.lit(76.0), F.lit(0.0), -4, 3, 1.5)).first()
    assert tuple(one) == (26 - 75, 76 + 75)


def test_sign_rule_and_combine(spark):
    df = spark.createDataFrame([(40, 10, 1.2), (12, 10, 1.2), (0, 0, 1.2), (40, 10, 0.8)], "n_plus long, n_minus long, T_raw double")
    got = rows(seasonal.decide(df, Seasonal()), "T_final", "reason", "sign_stat")
    assert [g[:2] for g in got] == [(1.2, "ok"), (1.0, "not_significant"), (1.0, "few_common_stores"), (1.0, "direction_conflict")]
    assert got[0][2] == pytest.approx(29 / math.sqrt(50))
    pairs = [("na", "na"), ("na", "high"), ("ok", "low"), ("ok", "na"), ("high", "ok"), ("high", "low"), ("low", "na"), ("ok", "ok")]
    out = spark.createDataFrame(pairs, "a string, b string").select(S.combine(F.col("a"), F.col("b")))
    assert [r[0] for r in out.collect()] == ["na", "high", "low", "ok", "high", "high", "low", "ok"]


ITEM = "period_id int, store_id string, category string, item string, prod_id long, sales_value double, sales_unit double"


def test_quality(spark):
    df = spark.createDataFrame([(1, "A", "c", "i", 1, 5.0, 1.0), (1, "A", "c", "i", 1, 6.0, 1.0), (1, "B", "c", "i", 2, -1.0, 1.0), (1, "B", "c", "i", 3, 2.0, 0.0), (1, "C", "c", "i", 4, None, 1.0)], ITEM)
    tagged = facts.tag_quality(df, ["sales_value"])
    assert facts.drop_tagged(tagged).count() == 3
    got = {r["check"]: (r["n_rows"], r["n_stores"], r["action"]) for r in facts.quality_summary(tagged).collect()}
    assert got == {"rows_total": (5, 3, ""), "dup_period_store_prod": (1, 1, "dropped"), "missing_value": (1, 1, "tagged"), "negative_value": (1, 1, "dropped"), "zero_unit_positive_value": (1, 1, "tagged")}


STORE = "period_id int, store_id string, PLATFORMNAME string, SHOPTYPE string, PROVINCE string"


def test_match_and_facts(spark):
    it = spark.createDataFrame([(1, "A", "c", "i", 1, 4.0, 2.0), (1, "A", "c", "j", 2, 16.0, 0.0), (1, "A", "d", "i", 3, 30.0, 0.0), (1, "Z", "c", "i", 4, 9.0, 1.0)], ITEM)
    st = spark.createDataFrame([(1, "A", "p", "s", "x"), (1, "C", "p", "s", "x"), (2, "A", "p", "s", "y")], STORE)
    assert rows(facts.unmatched_stores(it, st), "period_id", "matched_stores", "item_only_stores", "target_only_stores") == [(1, 1, 1, 1)]
    sc = facts.store_category(facts.match_stores(it, st)).orderBy("category")
    assert rows(sc, "category", "n_item", "avg_price", "cat_share") == [("c", 2, 10.0, 0.4), ("d", 1, None, 0.6)]


def test_zero_fill(spark):
    schema = STORE + ", category string, sales_value double, sales_unit double, n_item long, avg_price double, cat_share double"
    sc = spark.createDataFrame([(1, s, "p", "s", "x", c, 5.0, 1.0, 1, 5.0, 0.5) for s, c in (("A", "X"), ("A", "Y"), ("B", "X"), ("C", "X"), ("C", "Z"))], schema)
    cl = spark.createDataFrame([("A", "I1"), ("B", "I1"), ("C", "I2")], "store_id string, cluster_id string")
    out = facts.zero_fill(sc, cl)
    assert out.count() == 6
    assert rows(out.filter("zero_filled"), "store_id", "category", "sales_value", "avg_price") == [("B", "Y", 0.0, None)]


def test_links_use_common_stores(spark):
    data = [(p, s, "G", "c", float(v)) for s, vs in {"A": (10, 20, 30), "B": (50, 80, 100), "C": (7, 0, 9)}.items() for p, v in zip((1, 2, 4), vs)]
    panel = spark.createDataFrame(data, "period_id int, store_id string, peer_set string, category string, sales_value double")
    got = sorted(rows(seasonal.links(panel, seasonal.period_ranks(panel, 4), seasonal.KEYS, "sales_value"), "k", "link", "n_common", "n_plus", "n_minus"))
    assert got == [(2, pytest.approx(100 / 60), 2, 2, 0), (3, pytest.approx(1.3), 2, 2, 0)]
    f = seasonal.seasonal_factors(panel, 4, Seasonal(min_common_stores=1), metrics=("sales_value",)).first()
    assert f["T_raw"] == pytest.approx(130 / 80) and f["reason"] == "not_significant"


def test_grade(spark):
    base = dict(store_id="A", category="c", peer_level="cluster", zero_filled=False, sales_value=5.0)
    flags = [("ok", "ok", "ok", "ok"), ("high", "ok", "ok", "ok"), ("high", "high", "ok", "ok"), ("high", "high", "high", "ok"), ("high", "ok", "ok", "low"), ("na", "low", "low", "na")]
    df = spark.createDataFrame([dict(base, k=i, **dict(zip(S.EVIDENCE, f))) for i, f in enumerate(flags)] + [dict(base, k=9, sales_value=0.0, **dict(zip(S.EVIDENCE, flags[2])))])
    got = rows(detect.grade(df).orderBy("k"), "level", "direction", "auto_action", "evidence_list")
    assert [g[:3] for g in got] == [("normal", "", "skip"), ("watch", "high", "flag_only"), ("suspicious", "high", "fix"), ("high_confidence", "high", "fix"), ("suspicious", "low", "fix"), ("suspicious", "low", "fix"), ("suspicious", "high", "flag_only")]
    assert got[4][3] == "adjbox_value:high,history_flag:low"


def test_store_drop(spark):
    data = [(p, s, f"c{i}", 1.0) for s, a, b in (("A", 10, 2), ("B", 10, 8), ("C", 3, 1)) for p, n in ((1, a), (2, b)) for i in range(n)]
    sc = spark.createDataFrame(data, "period_id int, store_id string, category string, sales_value double").withColumns({c: F.lit("x") for c in facts.ATTRS})
    cl = spark.createDataFrame([(s, "I") for s in "ABC"], "store_id string, cluster_id string")
    assert rows(detect.store_drop(sc, cl, 2, 1, Peer()), "store_id", "n_cat", "prev_n_cat") == [("A", 2, 10)]


def test_level_history_matches_closed_form(spark):
    vals = {1: [1, 2, 3, 4, 100], 2: [2, 3, 4, 5, 6], 3: [10]}
    panel = spark.createDataFrame([(p, "G", "c", float(np.expm1(v / 10))) for p, vs in vals.items() for v in vs], "period_id int, peer_set string, category string, sales_value double")
    got = detect.level_history(panel, [1, 2, 3], ["peer_set", "category"], Detectors()).first()
    assert got["n_hist"] == 2 and got["center"] == pytest.approx(0.35) and got["hi_w"] == pytest.approx(0.2)


def test_merge_provinces():
    rng = np.random.default_rng(0)
    values = {f"P{i}": rng.normal(8, 0.4, n) for i, n in enumerate((40, 8, 8, 40), 1)}
    near = {("P1", "P2"): 0.1, ("P1", "P3"): 5.0, ("P1", "P4"): 4.0, ("P2", "P3"): 4.5, ("P2", "P4"): 3.0, ("P3", "P4"): 2.0}
    merged = lambda **k: clusters.Stratum(values, near, Clusters(min_store=30, min_store_soft=20, **k))
    m = merged(vi_max=1.5, ks_max=0.9, psi_max=9.0, max_median_ratio=3.0, max_distance_quantile=0.5)
    assert sorted(sorted(g.members) for g in m.groups.values()) == [["P1", "P2"], ["P3", "P4"]]
    assert {x["reason"] for x in m.steps} == {"accepted"} and m.fate["P2"] == ("accepted", 0.1) and all(m.still_fits(g, values) for g in m.groups.values())
    kept = merged(vi_max=0.5)
    assert len(kept.groups) == 4 and {g.name for g in kept.groups.values() if g.kept} >= {"P2", "P3"}
    forced = merged(vi_max=0.5, allow_forced_nearest=True)
    assert {x["reason"] for x in forced.steps} == {"forced_nearest"}
    assert clusters.mix_weights(3) == [1 / 7, 2 / 7, 4 / 7] and clusters.mix_weights(3, (1.0,)) == [0.0, 0.0, 1.0]
    assert clusters.mix_window([1, 2, 3, 4], 3, 2) == [2, 3] and clusters.mix_window([1, 2], 2, 2, 9) == [1, 2]


def test_adjustments(spark):
    base = dict(period_id=1, PLATFORMNAME="p", SHOPTYPE="s", PROVINCE="x", peer_set="G", category="c", peer_level="cluster", level="suspicious", evidence_list="", lv_lo=math.log1p(50), lv_hi=math.log1p(200))
    data = [dict(base, store_id="HI", sales_value=1000.0, direction="high"), dict(base, store_id="LO", sales_value=10.0, direction="low")] + [dict(base, store_id=f"M{i}", sales_value=100.0, direction="", level="normal") for i in range(5)]
    got = {r["store_id"]: r for r in items.adjustments(spark.createDataFrame(data)).collect()}
    assert got["HI"]["adj_to_fence"] == pytest.approx(-800) and got["HI"]["adj_to_median"] == pytest.approx(-900)
    assert got["LO"]["adj_to_fence"] == pytest.approx(40) and got["LO"]["adj_to_median"] == pytest.approx(90)


def test_anova_equals_least_squares(spark):
    rng = np.random.default_rng(4)
    data = [(f"p{rng.integers(2)}", f"s{rng.integers(3)}", f"x{rng.integers(4)}", f"c{rng.integers(2)}") for _ in range(400)]
    y = [8 + 0.8 * (a == "p1") + 0.3 * (b == "s1") * (1 if a == "p0" else -1) + rng.normal(0, 0.5) for a, b, _, _ in data]
    df = spark.createDataFrame([(*d, float(np.expm1(v))) for d, v in zip(data, y)], "PLATFORMNAME string, SHOPTYPE string, PROVINCE string, category string, sales_value double")
    got = {r["factor"]: r for r in spread.anova(df, 0.06, 0.01)}

    def rss(factors, pair=False):
        x = [np.ones(len(data))] + [np.array([d[f] == n for d in data], float) for f in factors for n in sorted({d[f] for d in data})[1:]]
        if pair:
            x += [np.array([d[:2] == n for d in data], float) for n in sorted({d[:2] for d in data})[1:]]
        x = np.column_stack(x)
        return float(((np.array(y) - x @ np.linalg.lstsq(x, np.array(y), rcond=None)[0]) ** 2).sum())

    full = rss([0, 1, 2, 3])
    for i, f in enumerate(spread.FACTORS):
        ss = rss([j for j in range(4) if j != i]) - full
        assert got[f]["ss"] == pytest.approx(ss, abs=1e-6) and got[f]["partial_eta2"] == pytest.approx(ss / (ss + full), abs=1e-9)
    both = rss([0, 1, 2, 3], True)
    assert got["PLATFORMNAME:SHOPTYPE"]["ss"] == pytest.approx(full - both, abs=1e-6) and got["Residual"]["df"] == 400 - 1 - 1 - 2 - 3 - 1
    assert got["PLATFORMNAME"]["strength"] == "strong" and "PLATFORMNAME" in spread.suggest_cell(list(got.values()), ("SHOPTYPE",))


def test_params(tmp_path):
    f = tmp_path / "p.json"
    f.write_text('{"clusters": {"min_store": 30}, "grid_adjbox_c": [2.0]}')
    assert load(str(f)).clusters.min_store == 30
    f.write_text('{"clusters": {"nothing": 1}}')
    with pytest.raises(KeyError):
        load(str(f))
    with pytest.raises(TypeError):
        Params().replaced(clusters={"min_store": "x"})
    with pytest.raises(ValueError):
        Params().replaced(peer={"missing_sell_ratio": 2.0})
    assert dict(Params().flat())["clusters.min_store"] == "10"


def test_csv_round_trip(spark, tmp_path):
    header = "period_id,store_id,category,sales_value,sales_unit,brand\n"
    (tmp_path / "itemcoding_output_20250101_a.csv").write_bytes((header + "20250101,A,饮料,1.5,2,甲\n").encode("gb18030"))
    (tmp_path / "itemcoding_output_20250101_a_fixed.csv").write_bytes((header + "20250101,A,饮料,7.5,x,甲\n20250102,A,饮料,1,1,甲\n").encode("gb18030"))
    (tmp_path / "itemcoding_output_20250102_a.csv").write_bytes((header + "20250102,,茶,3,1,\n").encode("gb18030"))
    df = tables.read_periods(spark, f"file://{tmp_path}", tables.ITEM_FILE, tables.read_items, encoding="GB18030")
    got = rows(df.orderBy("period_id"), "period_id", "store_id", "category", "sales_value", "sales_unit", "brand", "score")
    assert got == [(20250101, "A", "饮料", 7.5, None, "甲", None), (20250102, "nan", "茶", 3.0, 1.0, "", None)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        tables.read_items(spark, f"file://{tmp_path}/bad.csv")


def test_corrections_by_brute_force(spark):
    """Peers of high and low rows, their match and the corrected values, against plain loops over all pairs."""
    from panelscope.functions.robust import medcouple, right_tail

    rng = np.random.default_rng(31)
    p = Params().replaced(items={"tail_detect": 0.6, "critical_ratio": 1.2, "min_peer_stores": 4, "store_shift_ratio": 2.0})
    sold = {}
    for s in range(60):
        for _ in range(4):
            c, i = f"c{rng.integers(3)}", f"i{rng.integers(4)}" if s % 5 else f"own{s}"
            sold[f"s{s}", c, i] = (float(rng.integers(1, 100)) ** 2, f"b{int(i[1]) % 2}" if i[0] == "i" else f"b{s % 3}", f"1X{rng.integers(1, 40)}G" if s % 7 else "junk")
    cluster = {s: f"k{int(s[1:]) % 2}" for s, _, _ in sold}
    members = {s: ["k0", "k1"] if int(s[1:]) % 3 == 0 else [cluster[s]] for s in cluster}
    now = [(s, c, cluster[s], i, v, 1.0, b, k) for (s, c, i), (v, b, k) in sold.items()]
    rows = {(s, c): sum(v for (a, b, _), (v, _, _) in sold.items() if (a, b) == (s, c)) for s, c, _ in sold}
    way = {k: "high" if rng.integers(2) else "low" for k in sorted(rows)}
    action = {k: "fix" if rng.integers(3) else "review" for k in sorted(rows)}
    graded = spark.createDataFrame([(1, s, c, action[s, c], members[s], v, False, "cluster", way[s, c], cluster[s], "p", "t", "r") for (s, c), v in rows.items()], "period_id int, store_id string, category string, auto_action string, members array<string>, sales_value double, zero_filled boolean, peer_level string, direction string, cluster_id string, PLATFORMNAME string, SHOPTYPE string, PROVINCE string")
    drill = spark.createDataFrame([(1, s, c, way[s, c], i, v, 1.0) for (s, c, i), (v, _, _) in sold.items()], "period_id int, store_id string, category string, direction string, item string, sales_value double, sales_unit double")
    items_now = spark.createDataFrame(now, "store_id string, category string, cluster_id string, item string, sales_value double, sales_unit double, brand string, packsize string")
    got = {(r["store_id"], r["category"], r["item"]): r for r in items.corrections(drill, graded, items_now, spark.createDataFrame([], "store_id string"), p).collect()}
    total = {s: sum(v for (a, _, _), (v, _, _) in sold.items() if a == s) for s in cluster}
    size = lambda k: float(k[2:-1]) if k != "junk" else None
    least = lambda xs: min((x for x in xs if x is not None), default=None)
    seen = set()
    for (s, c, i), (v, brand, _) in sold.items():
        r = got[s, c, i]
        if way[s, c] == "low":
            lv = [math.log1p(x) for (o, k), x in rows.items() if k == c and o != s and cluster[o] in members[s]]
            assert r["n_peer"] == (len(lv) or None)
            if action[s, c] == "fix" and len(lv) >= 4:
                q1, q3 = np.quantile(lv, [0.25, 0.75])
                mc = medcouple(lv)
                low = q1 - p.detectors.adjbox_c * math.exp(p.detectors.adjbox_a * mc if mc >= 0 else -p.detectors.adjbox_b * mc) * (q3 - q1)
                assert r["reason"] == ("corrected" if math.log1p(v) < low else "skip_above_left_fence")
            continue
        vol = least(size(k) for (a, _, b), (_, _, k) in sold.items() if (a, b) == (s, i))
        found = {}
        for (o, oc, oi), (x, ob, k) in sold.items():
            if o != s and cluster[o] in members[s]:
                w = size(k)
                pack = vol is not None and w is not None and abs(vol - w) / max(vol, w) <= p.items.packsize_tolerance
                m = next((n for n, hit in enumerate((i == oi and brand == ob and pack, i == oi and brand == ob, i == oi, c == oc and brand == ob and pack, c == oc)) if hit), None)
                if m is not None:
                    found.setdefault(m, {}).setdefault(o, []).append(x)
        rates = sorted(sum(x) / total[o] for o, x in found[min(found)].items()) if found else []
        assert r["n_peer"] == len(rates) + 1
        if action[s, c] == "fix" and len(rates) >= 3:
            mask, fixed = right_tail([*rates, v / total[s]], p.items.tail_detect, p.items.tail_correct, p.items.tail_max, p.items.critical_ratio, p.items.min_peer_stores)
            assert r["reason"] == ("corrected" if mask[-1] else "skip_tail_not_flagged")
            if mask[-1]:
                assert r["match_level"] == items.MATCHES[min(found)][0] and r["corrected_value"] == pytest.approx(fixed[-1] * total[s])
        seen.add(min(found, default=None))
    assert len(seen) >= 4


def test_corrections_meet_sellers_of_the_item(spark):
    """What is joined grows with the sellers of an item, not with all pairs of a cluster."""
    targets = items.pd.DataFrame([("s0", "c", "i", "b", 1.0, 0.5, False)], columns=["store_id", "category", "target", "bk", "vol", "own_rate", "tested"])
    peers = items.pd.DataFrame([(f"s{k}", "b", 1.0 if k < 3 else 9.0, 2.0, 4.0) for k in range(6)], columns=["other", "brand_key", "volume", "x", "total"])
    assert [x[1:] for x in items.matched_rates(targets, peers, 0, Params().items)] == [(0, 2, None)]


@pytest.mark.parametrize("block", [7, 4096])
def test_nearest_stores_by_brute_force(spark, block):
    """Equal stores, ties and several blocks; only the nearest of each block leave a comparison."""
    from panelscope.operators import evaluate

    rng = np.random.default_rng(41)
    z = np.concatenate([rng.normal(0, 3, (20, 5)), np.zeros((6, 5)), np.full((1, 5), 9.0)])
    z[10:15] = z[0]
    at = {f"s{i}": "a" if i % 4 else "b" for i in range(len(z))}
    rows = [(s, at[s], "r", f"f{j}", float(z[i, j])) for i, s in enumerate(at) for j in range(5)]
    df = spark.createDataFrame(rows, "store_id string, PLATFORMNAME string, SHOPTYPE string, feature string, z double")
    got = {(r["store_id"], r["rank"]): (r["peer"], round(r["distance"], 6)) for r in evaluate.nearest_stores(df, ("PLATFORMNAME", "SHOPTYPE"), 3, block=block).collect()}
    want, number = {}, {s: i for i, s in enumerate(at)}
    for s in at:
        near = sorted((round(float(np.sqrt(((z[number[s]] - z[number[o]]) ** 2).sum())), 6), o) for o in at if o != s and at[o] == at[s])
        want |= {(s, i + 1): (o, d) for i, (d, o) in enumerate(near[:3])}
    assert got == want


def test_replayed_periods_share_what_is_the_same(spark):
    """Rows of an earlier period are graded as from its own panel, factors and history."""
    from panelscope.plans import queries

    p = queries.loose(spark, "/root/testdata/sf0.001")
    queries.forget()
    p = queries.loose(spark, "/root/testdata/sf0.001")
    period = p.periods[-3]
    shared = p.replayed_detail(period)
    own = detect.detect(p.assigned(period), p.panel(period), p.factors(period), period, p.params, p.periods[-4], p.periods[:-3])
    plain = lambda df: df.select(*[F.round(c, 8).alias(c) if t == "double" else F.col(c) for c, t in sorted(own.dtypes)])
    assert plain(shared).exceptAll(plain(own)).count() == plain(own).exceptAll(plain(shared)).count() == 0 < own.count()
