"""DuckDB SQL for the registered queries of the panel engine, built from shared common table expressions."""

from __future__ import annotations

PERIOD = 2000

ITEMS = """items AS (
  SELECT CAST(year(l_shipdate) AS INT) AS period_id, CAST(o_custkey AS VARCHAR) AS store_id, p_type AS category, p_brand AS item, l_partkey AS prod_id,
         l_extendedprice AS sales_value, l_quantity AS sales_unit, p_brand AS brand, '1X' || CAST(p_size AS VARCHAR) || 'G' AS packsize,
         l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
STORES = """stores AS (
  SELECT CAST(p AS INT) AS period_id, CAST(c_custkey AS VARCHAR) AS store_id, n_name AS PROVINCE, r_name AS SHOPTYPE, c_mktsegment AS PLATFORMNAME
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, range(1995, 2002) t(p))"""
MATCHED = """matched AS (SELECT * FROM items JOIN stores USING (period_id, store_id))"""
SC = """sums AS (
  SELECT period_id, store_id, category, PLATFORMNAME, SHOPTYPE, PROVINCE, sum(sales_value) AS sales_value, sum(sales_unit) AS sales_unit, count(DISTINCT item) AS n_item
  FROM matched GROUP BY ALL),
sc AS (
  SELECT *, CASE WHEN sales_unit > 0 THEN sales_value / sales_unit END AS avg_price,
         CASE WHEN sum(sales_value) OVER w > 0 THEN sales_value / sum(sales_value) OVER w END AS cat_share
  FROM sums WINDOW w AS (PARTITION BY period_id, store_id))"""
TOTALS = """totals AS (
  SELECT period_id, store_id, PLATFORMNAME, SHOPTYPE, PROVINCE, sum(sales_value) AS sales_value FROM sc GROUP BY ALL)"""
BANDS = f"""hist AS (
  SELECT store_id, avg(sales_value) AS size, count(*) AS size_periods
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY period_id DESC) AS n FROM totals WHERE period_id < {PERIOD} AND sales_value > 0) WHERE n <= 3 GROUP BY 1),
sized AS (
  SELECT t.store_id, t.PLATFORMNAME, t.SHOPTYPE, t.PROVINCE, t.sales_value, coalesce(size, sales_value) AS size, CAST(coalesce(size_periods, 0) AS INT) AS size_periods,
         CASE WHEN size IS NULL THEN 'current' ELSE 'history' END AS size_source
  FROM totals t LEFT JOIN hist USING (store_id) WHERE t.period_id = {PERIOD}),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY PLATFORMNAME, SHOPTYPE) AS n, row_number() OVER (PARTITION BY PLATFORMNAME, SHOPTYPE ORDER BY size, store_id) AS rk FROM sized),
bands AS (
  SELECT *, [['All'], ['Small', 'Large'], ['Small', 'Medium', 'Large'], ['Small', 'SmallMedium', 'LargeMedium', 'Large']][n_band]
            [CAST(least(floor(rk / n * n_band - 1e-9), n_band - 1) AS INT) + 1] AS band
  FROM (SELECT *, CAST(greatest(1, least(n // 10, 4)) AS INT) AS n_band FROM ranked)),
clusters AS (SELECT *, PLATFORMNAME || '|' || SHOPTYPE || '|' || band AS cluster_id FROM bands)"""
FILLED = f"""now AS (SELECT sc.*, cluster_id FROM sc JOIN (SELECT store_id, cluster_id FROM clusters) USING (store_id) WHERE period_id = {PERIOD}),
filled AS (
  SELECT g.period_id, g.store_id, g.cluster_id, g.category, g.PLATFORMNAME, g.SHOPTYPE, g.PROVINCE, coalesce(n.sales_value, 0) AS sales_value, coalesce(n.sales_unit, 0) AS sales_unit,
         coalesce(n.n_item, 0) AS n_item, n.avg_price, coalesce(n.cat_share, 0) AS cat_share, n.sales_value IS NULL AS zero_filled
  FROM (SELECT * FROM (SELECT DISTINCT period_id, store_id, cluster_id, PLATFORMNAME, SHOPTYPE, PROVINCE FROM now) JOIN (SELECT DISTINCT cluster_id, category FROM now) USING (cluster_id)) g
  LEFT JOIN now n ON g.store_id = n.store_id AND g.category = n.category)"""
CHECK = f"""per_cluster AS (SELECT cluster_id, PLATFORMNAME, SHOPTYPE, count(DISTINCT store_id) AS n_store FROM clusters GROUP BY ALL),
per_cat AS (SELECT cluster_id, category, count(DISTINCT store_id) AS n_store_cat FROM now WHERE sales_value > 0 GROUP BY ALL),
per_item AS (
  SELECT cluster_id, category, count(DISTINCT item) AS n_item FROM (
    SELECT store_id, category, item FROM matched WHERE period_id = {PERIOD} GROUP BY ALL HAVING sum(sales_value) > 0) JOIN (SELECT store_id, cluster_id FROM clusters) USING (store_id) GROUP BY ALL),
per_cell AS (SELECT PLATFORMNAME, SHOPTYPE, sum(n_store) AS cell_n, list_sort(list(DISTINCT cluster_id)) AS cell_members FROM per_cluster GROUP BY ALL),
levels AS (
  SELECT c.cluster_id, c.category, p.PLATFORMNAME, p.SHOPTYPE, n_store, n_store_cat, coalesce(n_item, 0) AS n_item, n_store < 10 AS low_store, n_store_cat <= 10 AS low_store_cat, coalesce(n_item, 0) < 10 AS low_item, cell_members,
         CASE WHEN n_store >= 10 THEN 'cluster' WHEN cell_n >= 10 THEN 'base_cell' ELSE 'na' END AS peer_level
  FROM per_cat c JOIN per_cluster p USING (cluster_id) JOIN per_cell s ON s.PLATFORMNAME = p.PLATFORMNAME AND s.SHOPTYPE = p.SHOPTYPE LEFT JOIN per_item i ON i.cluster_id = c.cluster_id AND i.category = c.category),
checked AS (
  SELECT *, CASE peer_level WHEN 'cluster' THEN cluster_id WHEN 'base_cell' THEN 'base_cell:' || PLATFORMNAME || '|' || SHOPTYPE ELSE 'na' END AS peer_set,
         CASE peer_level WHEN 'cluster' THEN [cluster_id] WHEN 'base_cell' THEN cell_members ELSE CAST([] AS VARCHAR[]) END AS members
  FROM levels)"""
PANEL = f"""assigned_now AS (
  SELECT n.*, coalesce(c.peer_set, n.cluster_id) AS peer_set, coalesce(c.peer_level, 'cluster') AS peer_level, coalesce(c.members, [n.cluster_id]) AS members
  FROM now n LEFT JOIN checked c ON n.cluster_id = c.cluster_id AND n.category = c.category),
member AS (SELECT DISTINCT peer_set, category, unnest(members) AS cluster_id FROM assigned_now WHERE peer_level <> 'na'),
assigned AS (
  SELECT f.*, coalesce(c.peer_set, f.cluster_id) AS peer_set, coalesce(c.peer_level, 'cluster') AS peer_level, coalesce(c.members, [f.cluster_id]) AS members
  FROM filled f LEFT JOIN checked c ON f.cluster_id = c.cluster_id AND f.category = c.category),
every AS (
  SELECT period_id, store_id, category, PLATFORMNAME, SHOPTYPE, PROVINCE, sales_value, sales_unit, n_item, avg_price, cat_share, cluster_id, false AS zero_filled
  FROM sc JOIN (SELECT store_id, cluster_id FROM clusters) USING (store_id) WHERE period_id < {PERIOD}
  UNION ALL
  SELECT period_id, store_id, category, PLATFORMNAME, SHOPTYPE, PROVINCE, sales_value, sales_unit, n_item, avg_price, cat_share, cluster_id, zero_filled FROM filled),
panel AS (SELECT e.*, m.peer_set FROM every e JOIN member m ON e.cluster_id = m.cluster_id AND e.category = m.category),
ranks AS (SELECT period_id, row_number() OVER (ORDER BY period_id) AS k FROM (SELECT DISTINCT period_id FROM panel))"""


def links(metric: str, keys: str, name: str) -> str:
    return f"""{name}_x AS (SELECT {keys}, store_id, period_id, k, min({metric}) AS x FROM panel JOIN ranks USING (period_id) WHERE {metric} > 0 GROUP BY ALL),
{name}_p AS (
  SELECT *, CASE WHEN lag(k) OVER w = k - 1 THEN lag(x) OVER w END AS p FROM {name}_x WINDOW w AS (PARTITION BY {keys}, store_id ORDER BY k)),
{name} AS (
  SELECT {keys}, k, sum(x) / sum(p) AS link, count(*) AS n_common, count(*) FILTER (x > p) AS n_plus, count(*) FILTER (x < p) AS n_minus FROM {name}_p WHERE p IS NOT NULL GROUP BY ALL)"""


def factors(metric: str, name: str) -> str:
    g, c = f"{name}_g", f"{name}_c"
    return f"""{links(metric, "peer_set, category", g)},
{links(metric, "PLATFORMNAME, SHOPTYPE, category", c)},
{name}_sets AS (SELECT peer_set, category, min(PLATFORMNAME) AS PLATFORMNAME, min(SHOPTYPE) AS SHOPTYPE FROM panel WHERE period_id = {PERIOD} AND {metric} > 0 GROUP BY 1, 2),
{name}_grid AS (
  SELECT s.peer_set, s.category, r.k, r.period_id,
         CASE WHEN coalesce(g.n_common, 0) >= 10 THEN 'group' WHEN coalesce(c.n_common, 0) >= 10 THEN 'base_cell' ELSE 'none' END AS source,
         g.link AS gl, g.n_common AS gn, g.n_plus AS gp, g.n_minus AS gm, c.link AS cl, c.n_common AS cn, c.n_plus AS cp, c.n_minus AS cm
  FROM {name}_sets s CROSS JOIN ranks r
  LEFT JOIN {g} g ON g.peer_set = s.peer_set AND g.category = s.category AND g.k = r.k
  LEFT JOIN {c} c ON c.PLATFORMNAME = s.PLATFORMNAME AND c.SHOPTYPE = s.SHOPTYPE AND c.category = s.category AND c.k = r.k),
{name}_idx AS (
  SELECT *, exp(sum(CASE WHEN k > 1 THEN ln(link) ELSE 0 END) OVER (PARTITION BY peer_set, category ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS idx FROM (
    SELECT peer_set, category, k, period_id, source, CASE source WHEN 'group' THEN gl WHEN 'base_cell' THEN cl ELSE 1.0 END AS link,
           CASE source WHEN 'base_cell' THEN cn ELSE coalesce(gn, 0) END AS n_common, CASE source WHEN 'group' THEN gp WHEN 'base_cell' THEN cp ELSE 0 END AS n_plus, CASE source WHEN 'group' THEN gm WHEN 'base_cell' THEN cm ELSE 0 END AS n_minus
    FROM {name}_grid)),
{name}_base AS (
  SELECT *, avg(idx) OVER b AS idx_base, count(idx) OVER b AS base_periods_used,
         sum(CASE WHEN k > 1 AND source = 'base_cell' THEN 1 ELSE 0 END) OVER f AS n_links_borrowed, sum(CASE WHEN k > 1 AND source = 'none' THEN 1 ELSE 0 END) OVER f AS n_links_missing
  FROM {name}_idx WINDOW b AS (PARTITION BY peer_set, category ORDER BY k ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING), f AS (PARTITION BY peer_set, category ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (
  SELECT peer_set, category, '{metric}' AS metric, link AS link_t, n_common, source, idx AS idx_t, idx_base, base_periods_used, n_links_borrowed, n_links_missing, idx / idx_base AS T_raw, n_plus, n_minus,
         CASE WHEN few THEN NULL ELSE stat END AS sign_stat, hit AS significant, CASE WHEN few THEN '' ELSE direction END AS direction,
         CASE WHEN hit AND NOT clash THEN idx / idx_base ELSE 1.0 END AS T_final, CASE WHEN few THEN 'few_common_stores' WHEN NOT hit THEN 'not_significant' WHEN clash THEN 'direction_conflict' ELSE 'ok' END AS reason
  FROM (
    SELECT *, NOT few AND coalesce(stat > 1.281552, false) AND direction <> '' AS hit, (direction = 'positive' AND idx / idx_base < 1) OR (direction = 'negative' AND idx / idx_base > 1) AS clash FROM (
      SELECT *, n_plus + n_minus < 10 OR idx_base IS NULL AS few, CASE WHEN n_plus + n_minus > 0 THEN (abs(n_plus - n_minus) - 1) / sqrt(n_plus + n_minus) END AS stat,
             CASE WHEN n_plus > n_minus THEN 'positive' WHEN n_minus > n_plus THEN 'negative' ELSE '' END AS direction
      FROM {name}_base WHERE period_id = {PERIOD})))"""


def medcouple(source: str, keys: str, name: str) -> str:
    """(keys, n, q1, q3, mc) from rows (keys, v): the kernel over pairs, pairs tied at the median by the sign rule."""
    using = ", ".join(k.strip() for k in keys.split(","))
    both = " AND ".join(f"u.{k.strip()} = d.{k.strip()}" for k in keys.split(","))
    cols = ", ".join(f"u.{k.strip()}" for k in keys.split(","))
    return f"""{name}_s AS (SELECT {keys}, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, quantile_cont(v, 0.5) AS med FROM {source} GROUP BY ALL),
{name}_z AS (
  SELECT *, row_number() OVER (PARTITION BY {keys}, z = 0 ORDER BY z) AS i, count(*) OVER (PARTITION BY {keys}, z = 0) AS m FROM (SELECT {keys}, v - med AS z FROM {source} JOIN {name}_s USING ({using}) WHERE v IS NOT NULL)),
{name}_k AS (
  SELECT {cols}, median(CASE WHEN u.z = 0 AND d.z = 0 THEN sign(CAST(u.i + d.i AS BIGINT) - 1 - CAST(u.m AS BIGINT)) ELSE (u.z + d.z) / (u.z - d.z) END) AS mc
  FROM {name}_z u JOIN {name}_z d ON {both} AND u.z >= 0 AND d.z <= 0 GROUP BY ALL),
{name} AS (SELECT {name}_s.*, CASE WHEN n = 0 THEN NULL WHEN n < 3 THEN 0.0 ELSE coalesce(mc, 0.0) END AS mc FROM {name}_s LEFT JOIN {name}_k USING ({using}))"""


KEYS = "peer_set, category"
CELL_KEYS = "PLATFORMNAME, SHOPTYPE, category"
LV = "ln(1 + greatest(sales_value, 0.0))"
CUR = f"cur AS (SELECT * FROM panel WHERE period_id = {PERIOD})"
CROSS = ",\n".join(
    [
        CUR,
        f"cur_lv AS (SELECT peer_set, category, {LV} AS v FROM cur)",
        "cur_sh AS (SELECT peer_set, category, cat_share AS v FROM cur)",
        "cur_it AS (SELECT peer_set, category, CASE WHEN sales_value > 0 THEN ln(1 + n_item) END AS v FROM cur)",
        medcouple("cur_lv", KEYS, "lv"),
        medcouple("cur_sh", KEYS, "sh"),
        medcouple("cur_it", KEYS, "it"),
        "cross_n AS (SELECT peer_set, category, count(*) AS n_peer, count(*) FILTER (sales_value > 0) AS n_sell FROM cur GROUP BY ALL)",
        """crossed AS (
  SELECT peer_set, category, n_peer, n_sell, lv.med AS lv_med, lv.q1 AS lv_q1, lv.q3 AS lv_q3, lv.mc AS lv_mc, sh.q1 AS sh_q1, sh.q3 AS sh_q3, sh.mc AS sh_mc, it.q1 AS it_q1, it.q3 AS it_q3, it.mc AS it_mc
  FROM cross_n JOIN lv USING (peer_set, category) JOIN sh USING (peer_set, category) JOIN it USING (peer_set, category))""",
    ]
)


def level_history(keys: str, name: str) -> str:
    return f"""{name}_r AS (
  SELECT {keys}, period_id, {LV} AS lv, count(*) OVER (PARTITION BY {keys}, period_id) AS n, row_number() OVER (PARTITION BY {keys}, period_id ORDER BY sales_value) AS k FROM panel WHERE period_id < {PERIOD} AND sales_value > 0),
{name}_q AS (
  SELECT {keys}, period_id, quantile_cont(lv, 0.25) AS q1, quantile_cont(lv, 0.5) AS med, quantile_cont(lv, 0.75) AS q3 FROM {name}_r WHERE k > floor(n * 0.01) AND k <= n - floor(n * 0.01) GROUP BY ALL HAVING count(*) >= 2),
{name}_a AS (SELECT *, q3 - q1 AS iqr, CASE WHEN q3 > q1 THEN round((q3 - 2 * med + q1) / (q3 - q1), 9) ELSE 0 END AS skew FROM {name}_q),
{name}_m AS (
  SELECT {keys}, quantile_cont(med, 0.5) AS center, max(iqr) AS iqr, quantile_cont(skew, 0.5) AS skew, count(*) AS n_hist,
         max((CASE WHEN med > 0 AND skew > 0 THEN q3 * q3 / med ELSE q3 END) - (CASE WHEN med > 0 AND skew < 0 THEN q1 * q1 / med ELSE q1 END)) AS adj
  FROM {name}_a GROUP BY ALL),
{name} AS (SELECT {keys}, center, CASE WHEN skew < 0 THEN adj ELSE iqr END AS lo_w, CASE WHEN skew > 0 THEN adj ELSE iqr END AS hi_w, n_hist FROM {name}_m)"""


def fence(p: str, c: float) -> tuple[str, str]:
    q1, q3, mc = f"{p}_q1", f"{p}_q3", f"{p}_mc"
    return (
        f"({q1} - {c} * exp(CASE WHEN {mc} >= 0 THEN -4 * {mc} ELSE -3 * {mc} END) * ({q3} - {q1}))",
        f"({q3} + {c} * exp(CASE WHEN {mc} >= 0 THEN 3 * {mc} ELSE 4 * {mc} END) * ({q3} - {q1}))",
    )


def flag(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {low} IS NULL OR {high} IS NULL THEN 'na' WHEN {x} > {high} THEN 'high' WHEN {x} < {low} THEN 'low' ELSE 'ok' END"


def detail(c: float = 7.0, coef: float = 1.9992) -> str:
    """The detectors of the target period, ending in the table `detail`."""
    basis = lambda p: (
        f"CASE WHEN NOT coalesce({p}_q1 = {p}_q3, false) THEN 'all' WHEN g_n >= 10 AND g_{p}_q1 <> g_{p}_q3 THEN 'sellers' WHEN c_n >= 10 AND c_{p}_q1 <> c_{p}_q3 THEN 'cell_sellers' ELSE 'none' END"
    )
    pick = lambda p, b: ", ".join(f"CASE {b} WHEN 'sellers' THEN g_{p}_{s} WHEN 'cell_sellers' THEN c_{p}_{s} ELSE {p}_{s} END AS {p}_{s}" for s in ("q1", "q3", "mc"))
    blend = lambda p, t: ", ".join(f"CASE WHEN {t} THEN w * coalesce({p}_{s}, 0) + (1 - w) * coalesce(c_{p}_{s}, 0) ELSE {p}_{s} END AS {p}_{s}" for s in ("q1", "q3", "mc"))
    lv_lo, lv_hi = fence("lv", c)
    sh_lo, sh_hi = fence("sh", c)
    it_lo, it_hi = fence("it", c)
    td_lo, td_hi = fence("td", c)
    parts = [
        factors("sales_value", "fs"),
        CROSS,
        level_history(KEYS, "gh"),
        level_history(CELL_KEYS, "ch"),
        f"""trend AS (
  SELECT peer_set, category, store_id, ln(1 + t) - ln(1 + p) - ln(coalesce(T_final, 1.0)) AS trend_d FROM (
    SELECT peer_set, category, store_id, max(CASE WHEN period_id = {PERIOD} THEN sales_value END) AS t, max(CASE WHEN period_id = {PERIOD - 1} THEN sales_value END) AS p
    FROM panel WHERE period_id IN ({PERIOD}, {PERIOD - 1}) AND sales_value > 0 GROUP BY ALL) x LEFT JOIN fs USING (peer_set, category) WHERE t IS NOT NULL AND p IS NOT NULL)""",
        "trend_g AS (SELECT peer_set, category, trend_d AS v FROM trend)",
        "of_cell AS (SELECT peer_set, min(PLATFORMNAME) AS PLATFORMNAME, min(SHOPTYPE) AS SHOPTYPE FROM assigned GROUP BY 1)",
        "trend_c AS (SELECT PLATFORMNAME, SHOPTYPE, category, trend_d AS v FROM trend JOIN of_cell USING (peer_set))",
        medcouple("trend_g", KEYS, "tg"),
        medcouple("trend_c", CELL_KEYS, "tc"),
        f"sell_g_lv AS (SELECT peer_set, category, {LV} AS v FROM cur WHERE sales_value > 0)",
        "sell_g_sh AS (SELECT peer_set, category, cat_share AS v FROM cur WHERE sales_value > 0)",
        "one_store AS (SELECT store_id, PLATFORMNAME, SHOPTYPE, category, min(sales_value) AS sales_value, min(cat_share) AS cat_share FROM cur GROUP BY ALL)",
        f"sell_c_lv AS (SELECT PLATFORMNAME, SHOPTYPE, category, {LV} AS v FROM one_store WHERE sales_value > 0)",
        "sell_c_sh AS (SELECT PLATFORMNAME, SHOPTYPE, category, cat_share AS v FROM one_store WHERE sales_value > 0)",
        medcouple("sell_g_lv", KEYS, "sgl"),
        medcouple("sell_g_sh", KEYS, "sgs"),
        medcouple("sell_c_lv", CELL_KEYS, "scl"),
        medcouple("sell_c_sh", CELL_KEYS, "scs"),
        """wide AS (
  SELECT a.*, n_peer, n_sell, lv_med, lv_q1, lv_q3, lv_mc, sh_q1, sh_q3, sh_mc, it_q1, it_q3, it_mc, coalesce(fs.T_final, 1.0) AS T_final, trend_d,
         gh.center AS g_center, gh.lo_w AS g_lo, gh.hi_w AS g_hi, gh.n_hist AS n_hist, ch.center AS c_center, ch.lo_w AS c_lo, ch.hi_w AS c_hi, ch.n_hist AS n_hist_cell,
         tg.n AS t_n, tg.q1 AS t_q1, tg.q3 AS t_q3, tg.mc AS t_mc, tc.n AS tc_n, tc.q1 AS tc_q1, tc.q3 AS tc_q3, tc.mc AS tc_mc,
         sgl.n AS g_n, sgl.q1 AS g_lv_q1, sgl.q3 AS g_lv_q3, sgl.mc AS g_lv_mc, sgs.q1 AS g_sh_q1, sgs.q3 AS g_sh_q3, sgs.mc AS g_sh_mc,
         scl.n AS c_n, scl.q1 AS c_lv_q1, scl.q3 AS c_lv_q3, scl.mc AS c_lv_mc, scs.q1 AS c_sh_q1, scs.q3 AS c_sh_q3, scs.mc AS c_sh_mc
  FROM assigned a LEFT JOIN crossed USING (peer_set, category) LEFT JOIN fs USING (peer_set, category) LEFT JOIN trend USING (peer_set, category, store_id) LEFT JOIN gh USING (peer_set, category)
  LEFT JOIN ch USING (PLATFORMNAME, SHOPTYPE, category) LEFT JOIN tg USING (peer_set, category) LEFT JOIN tc USING (PLATFORMNAME, SHOPTYPE, category)
  LEFT JOIN sgl USING (peer_set, category) LEFT JOIN sgs USING (peer_set, category) LEFT JOIN scl USING (PLATFORMNAME, SHOPTYPE, category) LEFT JOIN scs USING (PLATFORMNAME, SHOPTYPE, category))""",
        f"""based AS (
  SELECT *, {basis("lv")} AS basis0, {basis("sh")} AS share_basis, CASE WHEN coalesce(t_n, 0) < 10 AND coalesce(tc_n, 0) >= 5 THEN 'cell' WHEN coalesce(t_n, 0) < 10 THEN 'thin' ELSE 'group' END AS td_fence_src,
         CASE WHEN coalesce(n_peer, 0) > 0 THEN n_peer / (n_peer + 3.0) ELSE 0.0 END AS w FROM wide)""",
        f"""picked AS (
  SELECT * EXCLUDE (lv_q1, lv_q3, lv_mc, sh_q1, sh_q3, sh_mc), {pick("lv", "basis0")}, {pick("sh", "share_basis")},
         {", ".join(f"CASE td_fence_src WHEN 'cell' THEN tc_{s} ELSE t_{s} END AS td_{s}" for s in ("q1", "q3", "mc"))} FROM based)""",
        """take AS (
  SELECT *, coalesce(coalesce(n_peer, 0) < 30 AND c_n >= 1 AND c_lv_q1 IS NOT NULL AND basis0 <> 'none', false) AS t1, coalesce(coalesce(n_peer, 0) < 30 AND c_n >= 1 AND c_sh_q1 IS NOT NULL AND basis0 <> 'none', false) AS t2 FROM picked)""",
        f"""blended AS (
  SELECT * EXCLUDE (lv_q1, lv_q3, lv_mc, sh_q1, sh_q3, sh_mc), CASE WHEN t1 THEN 'shrink' ELSE basis0 END AS adjbox_basis, CASE WHEN t1 THEN w ELSE 1.0 END AS adjbox_shrink_w, {blend("lv", "t1")}, {blend("sh", "t2")},
         CASE WHEN g_center IS NOT NULL AND c_center IS NOT NULL THEN n_hist / (n_hist + 3.0) WHEN c_center IS NOT NULL THEN 0.0 ELSE 1.0 END AS lw,
         coalesce(n_hist, 0) + coalesce(n_hist_cell, 0) AS n_hist_eff, CASE WHEN g_center IS NOT NULL AND c_center IS NOT NULL THEN 'blend' WHEN c_center IS NOT NULL THEN 'cell' WHEN g_center IS NOT NULL THEN 'group' ELSE 'none' END AS lon_src
  FROM take)""",
        f"""limited AS (
  SELECT *, {lv_lo} AS lv_lo, {lv_hi} AS lv_hi,
         CASE WHEN lon_src <> 'none' THEN lw * coalesce(g_center, 0) + (1 - lw) * coalesce(c_center, 0) - {coef} * (lw * coalesce(g_lo, 0) + (1 - lw) * coalesce(c_lo, 0)) END AS long_ll,
         CASE WHEN lon_src <> 'none' THEN lw * coalesce(g_center, 0) + (1 - lw) * coalesce(c_center, 0) + {coef} * (lw * coalesce(g_hi, 0) + (1 - lw) * coalesce(c_hi, 0)) END AS long_ul
  FROM blended)""",
        f"""flagged AS (
  SELECT *, CASE WHEN peer_level = 'na' OR adjbox_basis = 'none' OR (sales_value <= 0 AND adjbox_basis NOT IN ('all', 'shrink')) THEN 'na' ELSE {flag(LV, "lv_lo", "lv_hi")} END AS adjbox_value,
         CASE WHEN peer_level = 'na' OR share_basis = 'none' OR (sales_value <= 0 AND NOT (share_basis = 'all' OR adjbox_basis = 'shrink')) THEN 'na' ELSE {flag("cat_share", sh_lo, sh_hi)} END AS share_adjbox,
         CASE WHEN peer_level = 'na' THEN 'na' ELSE {flag("ln(1 + n_item)", it_lo, it_hi)} END AS item_adjbox,
         CASE WHEN peer_level = 'na' OR n_hist_eff < 3 THEN 'na' ELSE {flag("ln(1 + greatest(sales_value, 0.0) / T_final)", "long_ll", "long_ul")} END AS level_test,
         CASE WHEN peer_level = 'na' THEN 'na' ELSE {flag("trend_d", td_lo, td_hi)} END AS trend_test
  FROM limited)""",
        """detail AS (
  SELECT *, CASE WHEN level_test IN ('na', 'ok') AND trend_test <> 'na' THEN trend_test ELSE level_test END AS history_flag FROM flagged WHERE NOT zero_filled)""",
    ]
    return ",\n".join(parts)


EV = ("adjbox_value", "share_adjbox", "item_adjbox", "history_flag")
GRADED = f"""counted AS (
  SELECT *, {" + ".join(f"CAST({e} = 'high' AS INT)" for e in EV)} AS n_high, {" + ".join(f"CAST({e} = 'low' AS INT)" for e in EV)} AS n_low FROM detail),
aimed AS (
  SELECT *, n_high + n_low AS n_evidence, CASE WHEN n_high > n_low THEN 'high' WHEN n_low > n_high THEN 'low' WHEN n_high + n_low > 0 THEN coalesce({", ".join(f"CASE WHEN {e} IN ('high', 'low') THEN {e} END" for e in ("history_flag", "adjbox_value", "share_adjbox", "item_adjbox"))}) ELSE '' END AS direction,
         CASE WHEN n_high + n_low <= 0 THEN 'normal' WHEN n_high + n_low >= 3 THEN 'high_confidence' WHEN n_high + n_low = 1 THEN 'watch' ELSE 'suspicious' END AS level,
         concat_ws(',', {", ".join(f"CASE WHEN {e} IN ('high', 'low') THEN '{e}:' || {e} END" for e in EV)}) AS evidence_list
  FROM counted),
graded AS (
  SELECT *, CASE WHEN peer_level = 'na' OR level = 'normal' OR direction NOT IN ('high', 'low') THEN 'skip' WHEN level IN ('suspicious', 'high_confidence') AND NOT (zero_filled OR sales_value <= 0) THEN 'fix' ELSE 'flag_only' END AS auto_action
  FROM aimed)"""

LOGGED = f"lg AS (SELECT *, {LV} AS lv FROM sc WHERE period_id = {PERIOD})"
BASE = [ITEMS, STORES, MATCHED, SC, TOTALS]
TO_CLUSTERS = [*BASE, BANDS]
TO_PANEL = [*TO_CLUSTERS, FILLED, CHECK, PANEL]


def sql(parts: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def r(names: str, digits: int) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"round({n.strip()}, {digits}) AS {n.strip()}" for n in names.split(","))


def quality() -> str:
    tags = {
        "dup_period_store_prod": "dup",
        "missing_value": "sales_value IS NULL OR sales_unit IS NULL",
        "negative_value": "coalesce(sales_value < 0, false) OR coalesce(sales_unit < 0, false)",
        "zero_unit_positive_value": "coalesce(sales_unit = 0 AND sales_value > 0, false)",
    }
    rows = ["SELECT period_id, 'rows_total' AS \"check\", count(*) AS n_rows, count(DISTINCT store_id) AS n_stores, '' AS action FROM t GROUP BY 1"]
    for k, cond in tags.items():
        action = "dropped" if k in ("dup_period_store_prod", "negative_value") else "tagged"
        rows.append(f"SELECT period_id, '{k}', count(*) FILTER ({cond}), count(DISTINCT CASE WHEN {cond} THEN store_id END), '{action}' FROM t GROUP BY 1")
    order = "l_orderkey, l_linenumber, l_suppkey, l_shipdate, sales_value"
    t = f"""s AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -sales_value ELSE sales_value END AS sales_value) FROM items),
t AS (SELECT *, row_number() OVER (PARTITION BY period_id, store_id, prod_id ORDER BY {order}) > 1 AS dup FROM s)"""
    return sql([ITEMS, t], " UNION ALL ".join(rows))


def profile() -> str:
    one = "SELECT period_id, '{0}' AS dimension, {0} AS level, count(DISTINCT store_id) AS n_store, quantile_cont(CAST(n_item AS DOUBLE), 0.5) AS n_item_median, count(*) AS n_obs, avg(CAST(sales_value = 0 AS INT)) AS zero_rate, quantile_cont(sales_value, 0.5) AS median, quantile_cont(sales_value, 0.75) - quantile_cont(sales_value, 0.25) AS iqr, quantile_cont(sales_value, 0.9) AS p90, quantile_cont(sales_value, 0.99) AS p99, CASE WHEN count(*) > 1 AND avg(sales_value) <> 0 THEN stddev_samp(sales_value) / avg(sales_value) END AS cv FROM sc GROUP BY period_id, {0}"
    long = "prof AS (" + " UNION ALL ".join(one.format(d) for d in ("PLATFORMNAME", "SHOPTYPE", "PROVINCE", "category")) + ")"
    return sql([*BASE, long], f"SELECT period_id, dimension, level, n_store, {r('n_item_median', 4)}, n_obs, {r('zero_rate', 6)}, {r('median, iqr, p90, p99', 4)}, {r('cv', 6)} FROM prof")


def mix(periods: str) -> str:
    return f"""mx_d AS (SELECT * FROM sc WHERE period_id IN ({periods})),
mx_grid AS (SELECT * FROM (SELECT DISTINCT period_id, store_id, PLATFORMNAME, SHOPTYPE, PROVINCE FROM mx_d) JOIN (SELECT DISTINCT period_id, PLATFORMNAME, SHOPTYPE, category FROM mx_d) USING (period_id, PLATFORMNAME, SHOPTYPE)),
mx_one AS (
  SELECT period_id, PLATFORMNAME, SHOPTYPE, PROVINCE, category, avg(ln(1 + 1000 * coalesce(cat_share, 0))) AS x
  FROM mx_grid LEFT JOIN (SELECT period_id, store_id, category, cat_share FROM mx_d) USING (period_id, store_id, category) GROUP BY ALL)"""


def by_dimension() -> str:
    plus = "level IN ('suspicious', 'high_confidence')"
    one = f"SELECT '{{0}}' AS dimension, {{0}} AS value, count(*) AS n_rows, count(DISTINCT store_id) AS n_store, count(*) FILTER ({plus}) AS n_flagged, count(DISTINCT CASE WHEN {plus} THEN store_id END) AS n_store_flagged, count(*) FILTER ({plus} AND direction = 'high') AS n_high, count(*) FILTER ({plus} AND direction = 'low') AS n_low, round(count(*) FILTER ({plus}) / count(*), 4) AS flagged_share, round(sum(sales_value), 2) AS sales_value FROM graded WHERE peer_level <> 'na' GROUP BY 2"
    return sql([*TO_PANEL, detail(1.0, 0.8), GRADED], " UNION ALL ".join(one.format(d) for d in ("PLATFORMNAME", "SHOPTYPE", "PROVINCE", "category", "cluster_id")))


def threshold_grid() -> str:
    steps, own = [1.5, 3.0, 7.0, 9.0], 7.0
    hit = {}
    for c in steps:
        lo, hi = fence("lv", c)
        hit[c] = f"(CASE WHEN peer_level = 'na' OR adjbox_basis = 'none' OR (sales_value <= 0 AND adjbox_basis NOT IN ('all', 'shrink')) THEN 'na' ELSE {flag(LV, lo, hi)} END IN ('high', 'low'))"
    cols = ", ".join(f"{hit[c]} AS h{i}" for i, c in enumerate(steps))
    pairs = [("neighbour", i, i + 1) for i in range(3)] + [("config", steps.index(own), i) for i, c in enumerate(steps) if c != own]
    rows = [
        f"SELECT '{k}' AS kind, CAST({steps[a]} AS DOUBLE) AS c_from, CAST({steps[b]} AS DOUBLE) AS c_to, count(*) FILTER (h{a}) AS n_from, count(*) FILTER (h{b}) AS n_to, CASE WHEN count(*) FILTER (h{a} OR h{b}) = 0 THEN 1.0 ELSE round(count(*) FILTER (h{a} AND h{b}) / count(*) FILTER (h{a} OR h{b}), 6) END AS jaccard FROM hits"
        for k, a, b in pairs
    ]
    return sql([*TO_PANEL, detail(), f"hits AS MATERIALIZED (SELECT {cols} FROM detail)"], " UNION ALL ".join(rows))


DROP = f"""drops AS (
  SELECT store_id, count(DISTINCT CASE WHEN period_id = {PERIOD} THEN category END) AS n_cat, count(DISTINCT CASE WHEN period_id = {PERIOD - 1} THEN category END) AS prev_n_cat,
         sum(CASE WHEN period_id = {PERIOD} THEN sales_value END) AS sales_value, sum(CASE WHEN period_id = {PERIOD - 1} THEN sales_value END) AS prev_sales_value
  FROM sc WHERE sales_value > 0 AND period_id IN ({PERIOD}, {PERIOD - 1}) GROUP BY 1)"""
MISSING = f"""ms AS (
  SELECT peer_set, category, count(DISTINCT store_id) AS n_peer, count(DISTINCT CASE WHEN NOT zero_filled THEN store_id END) AS n_sell, quantile_cont(CASE WHEN NOT zero_filled THEN sales_value END, 0.5) AS peer_median_sales
  FROM assigned WHERE peer_level <> 'na' GROUP BY ALL),
mp AS (SELECT peer_set, category, store_id, sum(sales_value) AS prev_sales_value FROM panel WHERE period_id = {PERIOD - 1} GROUP BY ALL),
mc AS (SELECT store_id, count(DISTINCT category) AS store_n_cat FROM assigned WHERE peer_level <> 'na' AND NOT zero_filled GROUP BY 1)"""
ADJUST = """med AS (SELECT peer_set, category, quantile_cont(sales_value, 0.5) AS peer_median_sales FROM graded WHERE sales_value > 0 GROUP BY ALL),
adj AS (
  SELECT g.*, peer_median_sales, exp(least(lv_lo, 700.0)) - 1 AS lo, exp(least(lv_hi, 700.0)) - 1 AS hi FROM graded g LEFT JOIN med USING (peer_set, category)
  WHERE level IN ('suspicious', 'high_confidence') AND direction IN ('high', 'low') AND peer_level <> 'na'),
adj2 AS (
  SELECT *, CASE WHEN direction = 'high' THEN hi ELSE greatest(lo, 0.0) END AS fence, CASE WHEN lv_lo IS NULL THEN sales_value WHEN direction = 'high' THEN least(sales_value, hi) ELSE greatest(sales_value, greatest(lo, 0.0)) END AS expected_fence,
         coalesce(peer_median_sales, sales_value) AS expected_median FROM adj)"""


def oracle_sql() -> dict[str, str]:
    loose = [*TO_PANEL, detail(1.0, 0.8), GRADED]
    detail_names = "T_final, lv_q1, lv_q3, lv_mc, lv_lo, lv_hi, adjbox_shrink_w, long_ll, long_ul, trend_d, td_q1, td_q3, td_mc"
    three = [factors(m, n) for m, n in (("sales_value", "fs"), ("n_item", "fn"), ("avg_price", "fa"))]
    factor_cols = f"peer_set, category, metric, n_common, source, base_periods_used, n_links_borrowed, n_links_missing, n_plus, n_minus, significant, direction, reason, {r('link_t, idx_t, idx_base, T_raw, sign_stat, T_final', 6)}"
    fl = " UNION ALL ".join(
        f"SELECT '{c}' AS flag_column, count(*) FILTER ({c} = 'high') AS n_high, count(*) FILTER ({c} = 'low') AS n_low, count(*) FILTER ({c} = 'ok') AS n_ok, count(*) FILTER ({c} = 'na') AS n_na FROM graded"
        for c in ("adjbox_value", "share_adjbox", "item_adjbox", "level_test", "trend_test", "history_flag")
    )
    features = f"""hp AS (SELECT * FROM sc WHERE period_id < {PERIOD}),
ft AS (SELECT DISTINCT store_id, PLATFORMNAME, SHOPTYPE FROM hp),
fx AS (
  SELECT store_id, PLATFORMNAME, SHOPTYPE, 'share:' || category AS feature, avg(ln(1 + 1000 * coalesce(cat_share, 0))) AS x FROM hp GROUP BY ALL
  UNION ALL SELECT store_id, PLATFORMNAME, SHOPTYPE, 'size', ln(1 + avg(v)) FROM (SELECT store_id, PLATFORMNAME, SHOPTYPE, period_id, sum(sales_value) AS v FROM hp GROUP BY ALL) GROUP BY ALL),
fg AS (SELECT t.*, f.feature, coalesce(x.x, 0) AS x FROM ft t JOIN (SELECT DISTINCT PLATFORMNAME, SHOPTYPE, feature FROM fx) f USING (PLATFORMNAME, SHOPTYPE)
  LEFT JOIN fx x ON x.store_id = t.store_id AND x.PLATFORMNAME = t.PLATFORMNAME AND x.SHOPTYPE = t.SHOPTYPE AND x.feature = f.feature),
fz AS (SELECT store_id, PLATFORMNAME, SHOPTYPE, feature, (x - avg(x) OVER w) / CASE WHEN stddev_pop(x) OVER w > 1e-9 THEN stddev_pop(x) OVER w ELSE 1 END AS z FROM fg WINDOW w AS (PARTITION BY PLATFORMNAME, SHOPTYPE, feature))"""
    changes = """ch AS (SELECT period_id, ln(1 + greatest(sales_value, 0)) - lag(ln(1 + greatest(sales_value, 0))) OVER (PARTITION BY store_id ORDER BY period_id) AS c FROM totals),
cp AS (SELECT period_id, count(*) AS n, avg(c) AS mean, quantile_cont(c, 0.1) AS p10, quantile_cont(c, 0.5) AS p50, quantile_cont(c, 0.9) AS p90, quantile_cont(abs(c), 0.5) AS jump, avg((abs(c) > 0.5)::int) AS share_wide
  FROM ch WHERE c IS NOT NULL GROUP BY 1)"""
    overview = " UNION ALL ".join(
        f"SELECT {i} AS position, '{a}' AS section, '{b}' AS figure, round(CAST(({x}) AS DOUBLE), 2) AS value"
        for i, a, b, x in (
            (1, "data", "item_rows", f"SELECT count(*) FROM matched WHERE period_id = {PERIOD}"),
            (2, "data", "item_sales", f"SELECT sum(sales_value) FROM matched WHERE period_id = {PERIOD}"),
            (10, "stores", "stores", "SELECT count(DISTINCT store_id) FROM clusters"),
            (11, "stores", "clusters", "SELECT count(DISTINCT cluster_id) FROM clusters"),
            (12, "stores", "soft_kept_stores", "SELECT 0"),
            (20, "detection", "rows_judged", "SELECT count(*) FROM graded"),
            (21, "detection", "zero_filled", "SELECT count(*) FROM graded WHERE zero_filled"),
            *[(22 + k, "detection", f"level_{x}", f"SELECT count(*) FROM graded WHERE level = '{x}'") for k, x in enumerate(("normal", "watch", "suspicious", "high_confidence"))],
            *[(30 + k, "direction", x, f"SELECT count(*) FROM graded WHERE level IN ('suspicious', 'high_confidence') AND direction = '{x}'") for k, x in enumerate(("high", "low"))],
            (32, "direction", "to_fix", "SELECT count(*) FROM graded WHERE level IN ('suspicious', 'high_confidence') AND auto_action = 'fix'"),
        )
    )
    return {
        "e_flag_counts": sql([*TO_PANEL, detail(), GRADED], fl),
        "e_province_lift": sql(
            loose,
            "SELECT PROVINCE, count(*) AS n, round(avg(f), 6) AS rate, round(CASE WHEN any_value(everything) > 0 THEN avg(f) / any_value(everything) END, 6) AS lift FROM (SELECT PROVINCE, (level IN ('suspicious', 'high_confidence'))::int AS f, avg((level IN ('suspicious', 'high_confidence'))::int) OVER () AS everything FROM graded) GROUP BY 1 HAVING count(*) >= 20",
        ),
        "e_systematic_share": sql(
            [*loose, "ce AS (SELECT PROVINCE, category, count(*) AS n, greatest(count(*) FILTER (history_flag = 'high'), count(*) FILTER (history_flag = 'low')) AS m FROM graded WHERE history_flag <> 'na' GROUP BY ALL HAVING count(*) >= 3)"],
            "SELECT count(*) AS n_cells, count(*) FILTER (2 * m > n) AS n_systematic, round(CASE WHEN count(*) > 0 THEN count(*) FILTER (2 * m > n) / count(*) END, 6) AS share FROM ce",
        ),
        "e_gated_flags": sql(
            [*TO_PANEL, detail(), GRADED, "gf AS (SELECT category, CASE WHEN lv_q1 IS NULL OR coalesce(n_peer, 0) < 5 THEN NULL ELSE (ln(1 + greatest(sales_value, 0)) > lv_q3 + 1.5 * (lv_q3 - lv_q1) OR ln(1 + greatest(sales_value, 0)) < lv_q1 - 1.5 * (lv_q3 - lv_q1))::int END AS f FROM graded)"],
            "SELECT category, count(*) AS n, round(avg(f), 6) AS rate FROM gf GROUP BY 1",
        ),
        "a_group_statistics": sql(
            [*BASE, LOGGED, "gs AS (SELECT *, quantile_cont(lv, 0.5) OVER (PARTITION BY PLATFORMNAME, SHOPTYPE, PROVINCE) AS median FROM lg)"],
            "SELECT PLATFORMNAME, SHOPTYPE, PROVINCE, count(*) AS n, round(quantile_cont(lv, 0.25), 6) AS q1, round(any_value(median), 6) AS med, round(quantile_cont(lv, 0.75), 6) AS q3, round(quantile_cont(abs(lv - median), 0.5), 6) AS mad FROM gs GROUP BY 1, 2, 3 HAVING count(*) >= 3",
        ),
        "a_period_changes": sql(
            [*BASE, changes],
            "SELECT a.period_id, n, round(mean, 6) AS mean, round(p10, 6) AS p10, round(p50, 6) AS p50, round(p90, 6) AS p90, round(jump, 6) AS jump, round(share_wide, 6) AS share_wide, round(jump / (SELECT quantile_cont(b.jump, 0.5) FROM cp b WHERE b.period_id <> a.period_id), 6) AS z FROM cp a",
        ),
        "a_feature_matrix": sql([*BASE, features], "SELECT store_id, PLATFORMNAME, SHOPTYPE, feature, round(z, 5) AS z FROM fz"),
        "n_nearest_stores": sql(
            [*BASE, features, "nd AS (SELECT a.store_id, b.store_id AS peer, sqrt(sum((a.z - b.z) * (a.z - b.z))) AS distance FROM fz a JOIN fz b USING (PLATFORMNAME, SHOPTYPE, feature) WHERE a.store_id <> b.store_id GROUP BY 1, 2)"],
            "SELECT store_id, peer, round(distance, 4) AS distance, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY store_id ORDER BY round(distance, 6), peer) AS INT) AS rank FROM nd) WHERE rank <= 5",
        ),
        "r_overview": sql([*TO_PANEL, detail(), GRADED, DROP, MISSING], overview + " UNION ALL SELECT 40, 'store_drop', 'dropped_stores', CAST((SELECT count(*) FROM drops d JOIN clusters USING (store_id) WHERE n_cat > 0 AND prev_n_cat >= 5 AND n_cat < 0.5 * prev_n_cat) AS DOUBLE) UNION ALL SELECT 50, 'missing_sales', 'missing_rows', CAST((SELECT count(*) FROM assigned a JOIN ms USING (peer_set, category) JOIN mp USING (peer_set, category, store_id) WHERE peer_level <> 'na' AND zero_filled AND n_sell / n_peer >= 0.7 AND prev_sales_value > greatest(0.5 * coalesce(peer_median_sales, 0), 0)) AS DOUBLE)"),
        "min_slice": sql([ITEMS, STORES, MATCHED], "SELECT period_id, SHOPTYPE AS shoptype, PROVINCE AS province, category, PLATFORMNAME AS platform, round(sum(sales_value), 2) AS sales_value, round(sum(sales_unit), 2) AS sales_unit, count(DISTINCT store_id) AS store_count FROM matched GROUP BY ALL"),
        "q_quality": quality(),
        "q_quality_clean": sql([ITEMS], "SELECT period_id, count(*) AS n_rows, round(sum(sales_value), 2) AS sales_value FROM (SELECT *, row_number() OVER (PARTITION BY period_id, store_id, prod_id ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, sales_value) AS n FROM items) WHERE n = 1 GROUP BY 1"),
        "j_match": sql([ITEMS, STORES, MATCHED], "SELECT period_id, PLATFORMNAME, SHOPTYPE, PROVINCE, count(*) AS n_rows, round(sum(sales_value), 2) AS sales_value FROM matched GROUP BY ALL"),
        "j_unmatched": sql(
            [ITEMS, STORES, "a AS (SELECT DISTINCT period_id, store_id FROM items)", "b AS (SELECT DISTINCT period_id, store_id FROM stores WHERE period_id IN (SELECT period_id FROM a))"],
            "SELECT coalesce(a.period_id, b.period_id) AS period_id, count(*) FILTER (a.store_id IS NOT NULL AND b.store_id IS NOT NULL) AS matched_stores, count(*) FILTER (b.store_id IS NULL) AS item_only_stores, count(*) FILTER (a.store_id IS NULL) AS target_only_stores FROM a FULL JOIN b ON a.period_id = b.period_id AND a.store_id = b.store_id GROUP BY 1",
        ),
        "a_store_category": sql(BASE, f"SELECT period_id, store_id, category, PLATFORMNAME, SHOPTYPE, PROVINCE, n_item, {r('sales_value, sales_unit', 2)}, {r('avg_price, cat_share', 6)} FROM sc"),
        "a_item_totals": sql([ITEMS, STORES, MATCHED], f"SELECT period_id, store_id, category, item, round(sum(sales_value), 2) AS sales_value, round(sum(sales_unit), 2) AS sales_unit, min(brand) AS brand, min(packsize) AS packsize FROM matched WHERE period_id = {PERIOD} GROUP BY ALL"),
        "a_store_totals": sql(BASE, f"SELECT period_id, store_id, PLATFORMNAME, SHOPTYPE, PROVINCE, {r('sales_value', 2)} FROM totals"),
        "a_profile": profile(),
        "a_zero_fill": sql([*TO_CLUSTERS, FILLED], f"SELECT store_id, category, cluster_id, n_item, zero_filled, {r('sales_value, sales_unit', 2)}, {r('cat_share', 6)} FROM filled"),
        "c_size_bands": sql(TO_CLUSTERS, f"SELECT store_id, cluster_id, band, n_band, size_periods, size_source, {r('size', 2)} FROM clusters"),
        "c_band_summary": sql(
            TO_CLUSTERS,
            "SELECT PLATFORMNAME, SHOPTYPE, cluster_id, band, n_band, count(*) AS n_store, count(DISTINCT PROVINCE) AS n_province, round(min(size), 2) AS size_min, round(quantile_cont(size, 0.5), 2) AS size_median, round(max(size), 2) AS size_max, count(*) FILTER (size_source = 'current') AS n_size_from_current, CASE WHEN count(*) > 1 THEN round(stddev_samp(sales_value) / avg(sales_value), 6) END AS cv_value, CASE WHEN count(*) > 1 THEN round(stddev_samp(size) / avg(size), 6) END AS cv_size FROM clusters GROUP BY ALL",
        ),
        "c_mix_distance": sql([*BASE, mix(str(PERIOD))], "SELECT PLATFORMNAME, SHOPTYPE, a.PROVINCE AS a, b.PROVINCE AS b, round(sqrt(avg((a.x - b.x) * (a.x - b.x))), 6) AS distance FROM mx_one a JOIN mx_one b USING (PLATFORMNAME, SHOPTYPE, category) WHERE a.PROVINCE < b.PROVINCE GROUP BY ALL"),
        "c_mix_profile_weighted": sql(
            [*BASE, mix(f"{PERIOD - 2}, {PERIOD - 1}, {PERIOD}"), f"mx_w AS (SELECT *, pow(2, period_id - {PERIOD - 2}) / 7.0 AS w FROM mx_one)"],
            "SELECT PLATFORMNAME, SHOPTYPE, PROVINCE, category, round(sum(w * x) / sum(w), 6) AS mix FROM mx_w GROUP BY ALL",
        ),
        "c_trend_distance": sql(
            [
                *BASE,
                f"tl AS (SELECT * FROM totals WHERE sales_value > 0 AND period_id <= {PERIOD})",
                "tp AS (SELECT a.PLATFORMNAME, a.SHOPTYPE, a.PROVINCE, a.period_id, ln(sum(a.sales_value) / sum(b.sales_value)) AS x FROM tl a JOIN tl b ON a.store_id = b.store_id AND a.PLATFORMNAME = b.PLATFORMNAME AND a.SHOPTYPE = b.SHOPTYPE AND a.PROVINCE = b.PROVINCE AND a.period_id = b.period_id + 1 GROUP BY ALL)",
            ],
            "SELECT PLATFORMNAME, SHOPTYPE, a.PROVINCE AS a, b.PROVINCE AS b, round(sqrt(sum((a.x - b.x) * (a.x - b.x))) / count(*), 6) AS distance FROM tp a JOIN tp b USING (PLATFORMNAME, SHOPTYPE, period_id) WHERE a.PROVINCE < b.PROVINCE GROUP BY ALL HAVING count(*) >= 3",
        ),
        "c_sample_check": sql([*TO_CLUSTERS, FILLED, CHECK], "SELECT cluster_id, category, n_store, n_store_cat, n_item, low_store, low_store_cat, low_item, peer_level, peer_set, array_to_string(members, ';') AS members FROM checked"),
        "s_links": sql([*TO_PANEL, links("sales_value", KEYS, "gl")], f"SELECT peer_set, category, period_id, n_common, n_plus, n_minus, {r('link', 6)} FROM gl JOIN ranks USING (k)"),
        "s_factors": sql([*TO_PANEL, *three], f"SELECT {factor_cols} FROM fs UNION ALL SELECT {factor_cols} FROM fn UNION ALL SELECT {factor_cols} FROM fa"),
        "d_cross_stats": sql([*TO_PANEL, CROSS], f"SELECT peer_set, category, n_peer, n_sell, {r('lv_med, lv_q1, lv_q3, lv_mc, sh_q1, sh_q3, sh_mc, it_q1, it_q3, it_mc', 6)} FROM crossed"),
        "d_level_history": sql([*TO_PANEL, level_history(KEYS, "gh")], f"SELECT peer_set, category, n_hist, {r('center, lo_w, hi_w', 6)} FROM gh"),
        "d_detail": sql([*TO_PANEL, detail()], f"SELECT store_id, category, peer_set, peer_level, n_peer, n_sell, adjbox_basis, adjbox_value, share_adjbox, item_adjbox, CAST(coalesce(n_hist, 0) AS INT) AS n_hist, CAST(coalesce(n_hist_cell, 0) AS INT) AS n_hist_cell, CAST(n_hist_eff AS INT) AS n_hist_eff, lon_src, level_test, td_fence_src, trend_test, history_flag, {r(detail_names, 5)} FROM detail"),
        "e_graded": sql([*TO_PANEL, detail(1.5), GRADED], "SELECT store_id, category, n_high, n_low, n_evidence, direction, level, evidence_list, auto_action FROM graded"),
        "e_level_summary": sql(
            [*loose, "lv_names AS (SELECT unnest(['normal', 'watch', 'suspicious', 'high_confidence']) AS level)", "gb AS (SELECT * FROM graded WHERE peer_level <> 'na')"],
            f"SELECT CAST({PERIOD} AS INT) AS period_id, n.level, count(g.store_id) AS n, round(count(g.store_id) / (SELECT count(*) FROM gb), 6) AS rate, count(*) FILTER (direction = 'high') AS n_high, count(*) FILTER (direction = 'low') AS n_low, count(*) FILTER (auto_action = 'fix') AS n_fix FROM lv_names n LEFT JOIN gb g ON g.level = n.level GROUP BY ALL",
        ),
        "g_store_drop": sql(
            [*TO_CLUSTERS, DROP],
            f"SELECT CAST({PERIOD} AS INT) AS period_id, d.store_id, PLATFORMNAME, SHOPTYPE, PROVINCE, cluster_id, n_cat, prev_n_cat, round(n_cat / prev_n_cat, 4) AS cat_ratio, round(d.sales_value, 2) AS sales_value, round(prev_sales_value, 2) AS prev_sales_value, round(d.sales_value / prev_sales_value, 4) AS sales_ratio FROM drops d JOIN clusters USING (store_id) WHERE n_cat > 0 AND prev_n_cat >= 5 AND n_cat < 0.9 * prev_n_cat",
        ),
        "g_missing_sales": sql(
            [*TO_PANEL, MISSING],
            f"SELECT CAST({PERIOD} AS INT) AS period_id, a.store_id, a.category, PLATFORMNAME, SHOPTYPE, PROVINCE, cluster_id, a.peer_set, peer_level, n_peer, n_sell, round(n_sell / n_peer, 4) AS sell_ratio, round(peer_median_sales, 4) AS peer_median_sales, round(prev_sales_value, 2) AS prev_sales_value, coalesce(store_n_cat, 0) AS store_n_cat, 'suspicious' AS level FROM assigned a JOIN ms USING (peer_set, category) JOIN mp USING (peer_set, category, store_id) LEFT JOIN mc ON mc.store_id = a.store_id WHERE peer_level <> 'na' AND zero_filled AND n_sell / n_peer >= 0.7 AND prev_sales_value > greatest(0.5 * coalesce(peer_median_sales, 0), 0)",
        ),
        "r_adjustments": sql(
            [*loose, ADJUST],
            f"SELECT CAST({PERIOD} AS INT) AS period_id, store_id, category, PLATFORMNAME, SHOPTYPE, PROVINCE, peer_set, level, direction, evidence_list, round(sales_value, 4) AS sales_value, round(fence, 4) AS fence, round(peer_median_sales, 4) AS peer_median_sales, round(expected_fence, 4) AS expected_fence, round(expected_median, 4) AS expected_median, round(expected_fence - sales_value, 4) AS adj_to_fence, round(expected_median - sales_value, 4) AS adj_to_median, CASE WHEN sales_value > 0 THEN round((expected_fence - sales_value) / sales_value, 4) END AS adj_pct_fence, CASE WHEN sales_value > 0 THEN round((expected_median - sales_value) / sales_value, 4) END AS adj_pct_median FROM adj2",
        ),
        "r_by_dimension": by_dimension(),
        "t_threshold_grid": threshold_grid(),
        "b_leave_one_out": sql(
            [*BASE, LOGGED],
            "SELECT a.store_id, a.category, count(*) + 1 AS n_peer, round(quantile_cont(b.lv, 0.25), 6) AS q1, round(quantile_cont(b.lv, 0.5), 6) AS med, round(quantile_cont(b.lv, 0.75), 6) AS q3 FROM lg a JOIN lg b ON a.PLATFORMNAME = b.PLATFORMNAME AND a.SHOPTYPE = b.SHOPTYPE AND a.category = b.category AND a.store_id <> b.store_id GROUP BY a.store_id, a.category HAVING count(*) >= 2",
        ),
        "b_deviation": sql(
            [*BASE, LOGGED, "md AS (SELECT *, quantile_cont(lv, 0.5) OVER (PARTITION BY PLATFORMNAME, SHOPTYPE, category) AS median FROM lg)"],
            "SELECT PLATFORMNAME, SHOPTYPE, category, round(median, 6) AS median, count(*) AS n, round(quantile_cont(abs(lv - median), 0.5), 6) AS mad FROM md GROUP BY PLATFORMNAME, SHOPTYPE, category, median",
        ),
        "b_kappa": sql(
            [
                *BASE,
                LOGGED,
                "kg AS (SELECT PLATFORMNAME, SHOPTYPE, category, PROVINCE, count(*) AS n, sum(lv) AS s, sum(lv * lv) AS q FROM lg GROUP BY ALL)",
                "ka AS (SELECT PLATFORMNAME, SHOPTYPE, category, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM kg GROUP BY ALL)",
                "kw AS (SELECT *, CASE WHEN k >= 2 AND n - k >= 1 THEN (b - s * s / n) / greatest(k - 1, 1) END AS msb, CASE WHEN k >= 2 AND n - k >= 1 THEN greatest(q - b, 0) / greatest(n - k, 1) END AS msw FROM ka)",
            ],
            "SELECT PLATFORMNAME, SHOPTYPE, category, CAST(n AS BIGINT) AS n_obs, k AS n_prov, round(greatest(least(CASE WHEN greatest((msb - msw) / (n / k), 0) > 0 THEN pi() / 2 * msw / ((msb - msw) / (n / k)) ELSE 1e5 END, 1e5), 0.25), 4) AS kappa FROM kw",
        ),
        "f_packsize": "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size % 7 AS DOUBLE) END AS qty, CAST(p_size AS DOUBLE) AS size, 'GM' AS unit, CASE WHEN p_size % 3 = 0 THEN CAST(p_size % 7 AS DOUBLE) ELSE 1.0 END * p_size AS volume FROM part",
        "f_tail_quantile": "SELECT p_size, round(v / 2 * (pow(1 - 0.995, -2 / v) - 1), 6) AS quantile FROM (SELECT DISTINCT p_size, greatest(2.0 * (p_size - 2) - 0.5, 1.0) AS v FROM part)",
    }
