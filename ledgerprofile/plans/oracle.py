"""DuckDB SQL for every compared query of ``ledgerprofile.plans.catalog``.

Independent formulations (a dense month grid for the autocorrelation, window row numbers
for every cut, a plain power iteration of many steps) over the same test tables, so a match is a
real cross-check.  Each text is one statement: the test-data mapping is inlined as CTEs.
"""

from __future__ import annotations

from ledgerprofile.plans.catalog import (
    CENTRALITY_DIGITS,
    DIAGONAL,
    END,
    LAG,
    MONEY_DIGITS,
    PAIR_DIGITS,
    PAIRS,
    RATIO,
    REGION,
    SHARE_DIGITS,
    START,
    TAG_TIME,
    TOP_N,
    VECTOR_DIGITS,
)

# The plain power iteration below must run until it has converged; Spark's Lanczos process
# needs a fraction of these products.
ORACLE_STEPS = 80

BASE = f"""
nsr AS (
  SELECT s_suppkey,
         lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey AS VARCHAR), 13, '0') AS nsrsbh,
         CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE 'H' || CAST(s_suppkey % 8 AS VARCHAR) END AS hy_dm,
         CASE WHEN s_suppkey % 5 = 0 THEN 'E' || CAST(s_suppkey AS VARCHAR) ELSE '' END AS nsrdj_no
  FROM supplier),
inv AS (
  SELECT x.nsrsbh AS xf_nsrsbh, g.nsrsbh AS gf_nsrsbh,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)
              AS DECIMAL(18,2)) AS je,
         strftime(l_shipdate, '%Y%m%d%H%M%S') AS kprq,
         CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ny,
         l_returnflag AS rf
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN nsr x ON x.s_suppkey = l_suppkey
  JOIN nsr g ON g.s_suppkey = o_custkey % (SELECT count(*) FROM supplier)),
xxfp AS (SELECT * FROM inv),
jxfp AS (SELECT * FROM inv WHERE rf <> 'R'),
tm AS (
  SELECT x.nsrsbh, x.hy_dm, x.ny, x.je AS xx_dec, j.je AS jx_dec
  FROM (SELECT n.nsrsbh, n.hy_dm, i.ny, sum(i.je) AS je
        FROM xxfp i JOIN nsr n ON i.xf_nsrsbh = n.nsrsbh WHERE n.hy_dm <> '' GROUP BY ALL) x
  JOIN (SELECT n.nsrsbh, i.ny, sum(i.je) AS je
        FROM jxfp i JOIN nsr n ON i.gf_nsrsbh = n.nsrsbh WHERE n.hy_dm <> '' GROUP BY ALL) j
    ON x.nsrsbh = j.nsrsbh AND x.ny = j.ny),
nsr_ay_hz AS (
  SELECT hy_dm, nsrsbh, ny, CAST(xx_dec - jx_dec AS DOUBLE) AS lr,
         CAST(jx_dec AS DOUBLE) AS jxje, CAST(xx_dec AS DOUBLE) AS xxje
  FROM tm),
hy_ay_hz AS (
  SELECT hy_dm, ny, CAST(sum(xx_dec) - sum(jx_dec) AS DOUBLE) AS lr,
         CAST(sum(jx_dec) AS DOUBLE) AS jxje, CAST(sum(xx_dec) AS DOUBLE) AS xxje
  FROM tm GROUP BY hy_dm, ny),
xf_gf_ay AS (
  SELECT n.hy_dm, i.xf_nsrsbh, i.gf_nsrsbh, i.ny, CAST(sum(i.je) AS DOUBLE) AS je
  FROM xxfp i JOIN nsr n ON i.xf_nsrsbh = n.nsrsbh WHERE n.hy_dm <> '' GROUP BY ALL),
per AS (SELECT * FROM nsr_ay_hz WHERE ny BETWEEN {START} AND {END}),
tot AS (
  SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, sum(je) AS zje
  FROM xf_gf_ay WHERE ny BETWEEN {START} AND {END} GROUP BY ALL),
sym AS (
  SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, zje FROM tot
  UNION ALL
  SELECT hy_dm, gf_nsrsbh AS xf_nsrsbh, xf_nsrsbh AS gf_nsrsbh, zje FROM tot),
adj AS (SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, sum(zje) AS w FROM sym GROUP BY ALL),
mmeans AS (SELECT nsrsbh, ny, avg(xxje) AS x FROM per GROUP BY ALL),
ridge AS ({{ridge}}),
ols AS ({{ols}}),
acf AS ({{acf}})
"""


def _digits(c: str) -> str:
    return f"CAST(length(CAST(CAST(least(floor(abs({c})), 2147483647) AS BIGINT) AS VARCHAR)) AS INTEGER)"


def _slope_sql(lam: float) -> str:
    return f"""
  SELECT nsrsbh,
         round(coalesce(covar_pop(i, y) / nullif(var_pop(i), 0)
                        * (stddev_pop(y) / nullif(stddev_pop(y) + {float(lam)!r}, 0)), 0.0), 3) AS slope
  FROM (SELECT nsrsbh, CAST(i AS DOUBLE) AS i, round(x, 3) / pow(10.0, {_digits('x_min')}) AS y
        FROM (SELECT nsrsbh, x,
                     row_number() OVER (PARTITION BY nsrsbh ORDER BY ny) - 1 AS i,
                     min(x) OVER (PARTITION BY nsrsbh) AS x_min,
                     count(x) OVER (PARTITION BY nsrsbh) AS n_x
              FROM mmeans)
        WHERE n_x = (SELECT count(DISTINCT ny) FROM per))
  GROUP BY nsrsbh"""


def _acf_sql(lag: int) -> str:
    return f"""
  WITH months AS (SELECT ny, row_number() OVER (ORDER BY ny) - 1 AS idx FROM (SELECT DISTINCT ny FROM per)),
       grid AS (SELECT t.nsrsbh, m.idx, coalesce(s.x, 0.0) AS x
                FROM (SELECT DISTINCT nsrsbh FROM mmeans) t CROSS JOIN months m
                LEFT JOIN mmeans s ON s.nsrsbh = t.nsrsbh AND s.ny = m.ny),
       dev AS (SELECT nsrsbh, idx, x - avg(x) OVER (PARTITION BY nsrsbh) AS d FROM grid),
       den AS (SELECT nsrsbh, sum(d * d) AS var FROM dev GROUP BY nsrsbh),
       num AS (SELECT a.nsrsbh, sum(a.d * b.d) AS num
               FROM dev a JOIN dev b ON a.nsrsbh = b.nsrsbh AND b.idx = a.idx + {int(lag)}
               GROUP BY a.nsrsbh)
  SELECT den.nsrsbh,
         CASE WHEN var = 0 THEN CAST('NaN' AS DOUBLE) ELSE round(coalesce(num, 0.0) / var, 6) END AS coefficient
  FROM den LEFT JOIN num ON den.nsrsbh = num.nsrsbh"""


def _with(body: str, lag: int = LAG) -> str:
    base = BASE.replace("{ridge}", _slope_sql(0.2)).replace("{ols}", _slope_sql(0.0)) \
               .replace("{acf}", _acf_sql(lag))
    return "WITH " + base.strip() + "\n" + body.strip()


def _tags(source: str, key: str, id_col: str, value: str) -> str:
    return (f"SELECT CAST({id_col} AS VARCHAR) AS nsr_key, '{key}' AS bq_key, CAST({value} AS DOUBLE) AS bq_value, "
            f"'{END}' AS bq_start_time, CAST(NULL AS VARCHAR) AS bq_end_time, '{TAG_TIME}' AS tag_time "
            f"FROM {source}")


def _cut(source: str, value: str, rule: str) -> str:
    """Rows of ``source`` (positive, non-NaN ``value``) kept by a top-fraction rule."""
    if rule == "growth":
        k = f"CASE WHEN cnt <= 1 THEN cnt ELSE least(cnt, CAST(trunc(cnt * CAST({RATIO!r} AS DOUBLE)) AS BIGINT) + 1) END"
    else:
        k = f"CASE WHEN cnt <= 2 THEN cnt ELSE least(cnt, CAST(trunc(cnt * CAST({RATIO!r} AS DOUBLE)) AS BIGINT)) END"
    return f"""(SELECT * FROM (
        SELECT *, row_number() OVER (ORDER BY {value} DESC, nsrsbh) AS rn, count(*) OVER () AS cnt
        FROM {source} WHERE {value} > 0 AND NOT isnan({value}))
      WHERE rn <= {k})"""


def _power(steps: int = ORACLE_STEPS) -> str:
    """CTE text: a_big (edges of industries with > 5 nodes), v0..v{steps}."""
    parts = [
        "big AS (SELECT hy_dm FROM (SELECT DISTINCT hy_dm, xf_nsrsbh FROM adj) GROUP BY hy_dm HAVING count(*) > 5)",
        "a_big AS (SELECT adj.* FROM adj JOIN big USING (hy_dm))",
        "v0 AS (SELECT DISTINCT hy_dm, gf_nsrsbh AS node, CAST(1.0 AS DOUBLE) AS v FROM a_big)",
    ]
    for s in range(1, steps + 1):
        parts.append(
            f"u{s} AS (SELECT a.hy_dm, a.xf_nsrsbh AS node, sum(a.w * p.v) AS u FROM a_big a "
            f"JOIN v{s-1} p ON a.hy_dm = p.hy_dm AND a.gf_nsrsbh = p.node GROUP BY ALL)")
        parts.append(
            f"v{s} AS (SELECT u.hy_dm, u.node, coalesce(u.u / nullif(n.norm, 0), 0.0) AS v FROM u{s} u "
            f"JOIN (SELECT hy_dm, sqrt(sum(u * u)) AS norm FROM u{s} GROUP BY hy_dm) n ON u.hy_dm = n.hy_dm)")
    parts.append(
        f"cent AS (SELECT a.hy_dm, a.xf_nsrsbh AS nsrsbh, sum(abs(a.w * p.v)) AS centrality FROM a_big a "
        f"JOIN v{steps} p ON a.hy_dm = p.hy_dm AND a.gf_nsrsbh = p.node GROUP BY ALL)")
    return ",\n".join(parts)


def _with_power(body: str) -> str:
    return _with(", " + _power() + "\n" + body)


SQUARINGS = 40


def _with_pairs(edges: str, pairs: int, value: str) -> str:
    """Leading pairs of the Gramian m of a dense matrix: squaring m SQUARINGS times leaves the leading
    vector's projector s; taking the pair out of m gives the next one.

    ``edges`` has (hy_dm, r, c, w); ``value`` is the shown value, of the vector v and the columns cols.
    """
    cycle = SQUARINGS + 1
    body = f""",
edges AS ({edges}),
nodes AS (SELECT hy_dm, node FROM (SELECT DISTINCT hy_dm, unnest([r, c]) AS node FROM edges)
  QUALIFY count(*) OVER (PARTITION BY hy_dm) > 5),
cells AS (SELECT a.hy_dm, a.node AS r, b.node AS c, coalesce(w, 0.0) AS w FROM nodes a JOIN nodes b ON a.hy_dm = b.hy_dm
  LEFT JOIN edges e ON e.hy_dm = a.hy_dm AND e.r = a.node AND e.c = b.node),
dense AS (SELECT hy_dm, list(col ORDER BY c) AS cols, list(c ORDER BY c) AS names
  FROM (SELECT hy_dm, c, list(w ORDER BY r) AS col FROM cells GROUP BY hy_dm, c) GROUP BY hy_dm),
gram AS (SELECT hy_dm, [[list_dot_product(x, y) for y in cols] for x in cols] AS m FROM dense),
steps(hy_dm, t, m, s) AS (
  SELECT hy_dm, 0, m, m FROM gram
  UNION ALL
  SELECT hy_dm, t + 1, n, [[x / list_sum([q[k][k] for k in range(1, len(q) + 1)]) for x in row] for row in q]
  FROM (SELECT hy_dm, t, n, CASE WHEN t % {cycle} < {SQUARINGS} THEN [[list_dot_product(x, y) for y in s] for x in s] ELSE n END AS q
    FROM (SELECT hy_dm, t, s, CASE WHEN t % {cycle} < {SQUARINGS} THEN m ELSE
            [[m[i][j] - size * v[i] * v[j] for j in range(1, len(m) + 1)] for i in range(1, len(m) + 1)] END AS n
      FROM (SELECT *, list_dot_product(v, [list_dot_product(row, v) for row in m]) AS size
        FROM (SELECT *, [x / sqrt(list_dot_product(p, p)) for x in p] AS v
          FROM (SELECT *, s[list_position([s[k][k] for k in range(1, len(s) + 1)], list_max([s[k][k] for k in range(1, len(s) + 1)]))] AS p
            FROM steps WHERE t < {pairs * cycle - 1})))))),
found AS (SELECT hy_dm, t // {cycle} + 1 AS rank, names, cols, [x / sqrt(list_dot_product(p, p)) * CASE WHEN list_sum(p) < 0 THEN -1 ELSE 1 END for x in p] AS v
  FROM (SELECT *, s[list_position([s[k][k] for k in range(1, len(s) + 1)], list_max([s[k][k] for k in range(1, len(s) + 1)]))] AS p
    FROM steps JOIN dense USING (hy_dm) WHERE t % {cycle} = {SQUARINGS}))
SELECT hy_dm, CAST(rank AS INTEGER) AS rank, unnest(names) AS nsrsbh, round(unnest(v), {PAIR_DIGITS}) AS v, {value} FROM found"""
    return _with(body).replace("WITH ", "WITH RECURSIVE ", 1)


def oracle_sql() -> dict[str, str]:
    money = MONEY_DIGITS
    q: dict[str, str] = {}
    q["scan_invoices"] = _with("SELECT xf_nsrsbh, gf_nsrsbh, CAST(je AS DOUBLE) AS je, kprq, rf FROM inv")
    q["scan_stored_table"] = ("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice "
                              "FROM lineitem")
    q["catalog_invoices"] = _with("SELECT gf_nsrsbh, xf_nsrsbh, CAST(je AS DOUBLE) AS je, kprq FROM inv")
    in_period = f"ny BETWEEN {START} AND {END}"
    q["catalog_invoices_period"] = _with(f"SELECT gf_nsrsbh, xf_nsrsbh, CAST(je AS DOUBLE) AS je, kprq FROM xxfp WHERE {in_period}")
    q["warehouse_taxpayer_monthly"] = _with(f"SELECT hy_dm, nsrsbh, ny, lr, jxje, xxje FROM nsr_ay_hz WHERE {in_period}")
    q["warehouse_industry_monthly"] = _with(f"SELECT hy_dm, ny, lr, jxje, xxje FROM hy_ay_hz WHERE {in_period}")
    q["warehouse_trade_pairs"] = _with(
        f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je FROM xf_gf_ay WHERE {in_period} "
        f"AND substr(xf_nsrsbh, 1, {len(REGION)}) = '{REGION}'")
    has_industry = "s_suppkey % 11 <> 0 AND s_suppkey % 7 <> 0"
    q["stored_registry_with_industry"] = _with(f"SELECT nsrsbh, hy_dm FROM nsr WHERE {has_industry} AND hy_dm <> ''")
    q["stored_registry_missing_industry"] = _with(f"SELECT nsrsbh, hy_dm FROM nsr WHERE {has_industry} AND hy_dm = ''")
    q["stored_foreign_trade_registry"] = _with(
        "SELECT nsrsbh FROM nsr WHERE s_suppkey % 11 <> 0 AND s_suppkey % 3 <> 0 AND nsrdj_no <> ''")
    q["sales_invoices"] = _with("SELECT xf_nsrsbh, gf_nsrsbh, CAST(je AS DOUBLE) AS je, kprq FROM xxfp")
    q["purchase_invoices"] = _with("SELECT xf_nsrsbh, gf_nsrsbh, CAST(je AS DOUBLE) AS je, kprq FROM jxfp")
    q["registry"] = _with("SELECT nsrsbh, hy_dm FROM nsr")
    q["registry_with_industry"] = _with("SELECT nsrsbh, hy_dm FROM nsr WHERE hy_dm <> ''")
    q["registry_missing_industry"] = _with("SELECT nsrsbh, hy_dm FROM nsr WHERE hy_dm = ''")
    q["foreign_trade_registry"] = _with("SELECT nsrsbh FROM nsr WHERE nsrdj_no <> ''")
    q["trade_pairs_monthly"] = _with("SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je FROM xf_gf_ay")
    q["trade_pairs_region"] = _with(
        f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je FROM xf_gf_ay "
        f"WHERE ny BETWEEN {START} AND {END} AND substr(xf_nsrsbh, 1, {len(REGION)}) = '{REGION}'")
    q["trade_pair_totals"] = _with(f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, round(zje, {money}) AS zje FROM tot")
    q["invoice_month"] = _with("SELECT xf_nsrsbh, kprq, strftime(try_strptime(kprq, '%Y%m%d%H%M%S'), '%Y%m') AS ny FROM xxfp")
    q["first_token"] = ("SELECT l_orderkey, l_linenumber, split_part(CAST(l_shipdate AS VARCHAR), ' ', 1) AS ship_day "
                        "FROM lineitem")
    q["period_filter"] = _with("SELECT hy_dm, nsrsbh, ny, lr, jxje, xxje FROM per")
    q["digit_count"] = _with(
        f"SELECT nsrsbh, ny, lr, {_digits('lr')} AS lr_digits, {_digits('xxje')} AS xxje_digits FROM nsr_ay_hz")
    q["series_min_max"] = _with("SELECT nsrsbh, min(x) AS x_min, max(x) AS x_max FROM mmeans GROUP BY nsrsbh")
    q["invoices_with_industry"] = _with(
        "SELECT i.xf_nsrsbh, i.gf_nsrsbh, CAST(i.je AS DOUBLE) AS je, i.kprq, n.hy_dm "
        "FROM xxfp i JOIN nsr n ON i.xf_nsrsbh = n.nsrsbh WHERE n.hy_dm <> ''")
    q["taxpayer_monthly"] = _with(
        "SELECT nsrsbh, hy_dm, ny, CAST(xx_dec AS DOUBLE) AS xxje, CAST(jx_dec AS DOUBLE) AS jxje, "
        "CAST(xx_dec - jx_dec AS DOUBLE) AS lirun FROM tm")
    q["industry_monthly"] = _with(
        "SELECT hy_dm, ny, CAST(sum(xx_dec) AS DOUBLE) AS hyyxx, CAST(sum(jx_dec) AS DOUBLE) AS hyyjx "
        "FROM tm GROUP BY hy_dm, ny")
    q["pair_monthly_sales"] = _with(
        "SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, ny, je AS xxyje FROM xf_gf_ay")
    q["pair_monthly_purchases"] = _with(
        "SELECT n.hy_dm, i.xf_nsrsbh, i.gf_nsrsbh, i.ny, CAST(sum(i.je) AS DOUBLE) AS jxyje "
        "FROM jxfp i JOIN nsr n ON i.gf_nsrsbh = n.nsrsbh WHERE n.hy_dm <> '' GROUP BY ALL")
    q["pair_totals"] = _with(
        f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, round(sum(je), {money}) AS xxnje FROM xf_gf_ay GROUP BY ALL")
    q["month_count"] = _with("SELECT count(DISTINCT ny) AS n_months FROM per")
    q["edges_per_industry"] = _with("SELECT hy_dm, count(*) AS n_rows FROM tot GROUP BY hy_dm")
    q["taxpayer_vs_industry"] = _with(
        f"SELECT n.hy_dm, n.ny, n.nsrsbh, n.xxje, n.jxje, h.xxje AS hyxxje, h.jxje AS hyjxje "
        f"FROM per n JOIN hy_ay_hz h ON n.hy_dm = h.hy_dm AND n.ny = h.ny")
    share_body = f"""
      SELECT n.nsrsbh, n.hy_dm, sum(n.xxje) AS zxxje, sum(n.jxje) AS zjxje,
             sum(h.xxje) AS hyzxxje, sum(h.jxje) AS hyzjxje,
             coalesce(sum(n.xxje) / nullif(sum(h.xxje), 0), 0.0) AS xxbl
      FROM per n JOIN hy_ay_hz h ON n.hy_dm = h.hy_dm AND n.ny = h.ny
      GROUP BY n.nsrsbh, n.hy_dm"""
    q["industry_share"] = _with(
        f"SELECT nsrsbh, hy_dm, round(zxxje, {money}) AS zxxje, round(zjxje, {money}) AS zjxje, "
        f"round(hyzxxje, {money}) AS hyzxxje, round(hyzjxje, {money}) AS hyzjxje, "
        f"round(xxbl, {SHARE_DIGITS}) AS xxbl FROM ({share_body})")
    ranked = (f"(SELECT hy_dm, nsrsbh, xxbl, row_number() OVER (PARTITION BY hy_dm ORDER BY xxbl DESC, nsrsbh) AS rank "
              f"FROM (SELECT hy_dm, nsrsbh, round(xxbl, {SHARE_DIGITS}) AS xxbl FROM ({share_body})))")
    q["industry_top_n"] = _with(
        f"SELECT hy_dm, nsrsbh, xxbl, CAST(rank AS INTEGER) AS rank FROM {ranked} WHERE rank <= {TOP_N}")
    months = [y * 100 + m for y in range(START // 100, END // 100 + 1) for m in range(1, 13)
              if START <= y * 100 + m <= END]
    q["monthly_pivot"] = _with("SELECT nsrsbh, " + ", ".join(
        f'avg(xxje) FILTER (WHERE ny = {m}) AS "{m}"' for m in months) + " FROM per GROUP BY nsrsbh")
    q["growth_slope_ridge"] = _with("SELECT nsrsbh, slope FROM ridge")
    q["growth_slope_ols"] = _with("SELECT nsrsbh, slope FROM ols")
    q["monthly_autocorrelation"] = _with("SELECT nsrsbh, coefficient FROM acf")
    q["coefficient_histogram"] = _with(
        "SELECT t.threshold, count(a.nsrsbh) AS n_rows "
        "FROM (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES (0.1), (0.2), (0.3), (0.4), (0.5)) v(t)) t "
        "LEFT JOIN acf a ON a.coefficient > t.threshold OR isnan(a.coefficient) GROUP BY t.threshold")
    q["trade_edges_symmetric"] = _with(f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, round(zje, {money}) AS zje FROM sym")
    q["trade_adjacency"] = _with(f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, round(w, {money}) AS w FROM adj")
    q["trade_degree"] = _with(
        "SELECT hy_dm, xf_nsrsbh AS nsrsbh, count(*) FILTER (WHERE xf_nsrsbh <> gf_nsrsbh AND abs(w) >= 1) AS degree "
        "FROM adj GROUP BY ALL")
    q["trade_nodes"] = _with(
        "SELECT hy_dm, count(DISTINCT xf_nsrsbh) AS n_nodes FROM sym GROUP BY hy_dm")
    q["trade_eigenvector"] = _with_power(
        f"SELECT hy_dm, node AS nsrsbh, round(v, {VECTOR_DIGITS}) AS v, "
        f"round(norm, {CENTRALITY_DIGITS}) AS eigenvalue FROM v{ORACLE_STEPS} "
        f"JOIN (SELECT hy_dm, sqrt(sum(u * u)) AS norm FROM u{ORACLE_STEPS} GROUP BY hy_dm) USING (hy_dm)")
    q["trade_eigenpairs"] = _with_pairs(
        "SELECT hy_dm, xf_nsrsbh AS r, gf_nsrsbh AS c, w FROM adj", PAIRS,
        f"round(list_dot_product(v, [list_dot_product(x, v) for x in cols]), {CENTRALITY_DIGITS}) AS eigenvalue")
    image = "[list_dot_product([x[i] for x in cols], v) for i in range(1, len(cols) + 1)]"      # A v, row by row
    sigma = f"round(sqrt(list_dot_product({image}, {image})), {CENTRALITY_DIGITS}) AS singular_value"
    for name, pairs in (("trade_singular_vectors", PAIRS), ("trade_singular_vectors_iterated", 1)):
        q[name] = _with_pairs("SELECT hy_dm, xf_nsrsbh AS r, gf_nsrsbh AS c, zje AS w FROM tot", pairs, sigma)
    q["trade_centrality"] = _with_power(
        f"SELECT hy_dm, nsrsbh, round(centrality, {CENTRALITY_DIGITS}) AS centrality FROM cent")
    q["trade_centrality_hubs"] = q["trade_centrality"]
    q["trade_adjacency_diagonal"] = _with(
        f"SELECT hy_dm, xf_nsrsbh, gf_nsrsbh, round(w, {money}) AS w FROM adj UNION ALL "
        f"SELECT DISTINCT hy_dm, xf_nsrsbh, xf_nsrsbh, CAST({DIAGONAL} AS DOUBLE) FROM adj a WHERE NOT EXISTS ("
        f"SELECT 1 FROM adj b WHERE b.hy_dm = a.hy_dm AND b.xf_nsrsbh = a.xf_nsrsbh AND b.gf_nsrsbh = a.xf_nsrsbh)")
    q["tag_foreign_trade_today"] = _with(_tags("nsr WHERE nsrdj_no <> ''", "1", "nsrsbh", "1.0").replace(
        f"'{TAG_TIME}'", "CAST(current_date AS VARCHAR)"))
    q["tag_foreign_trade"] = _with(_tags("nsr WHERE nsrdj_no <> ''", "1", "nsrsbh", "1.0"))
    q["tag_fast_growth"] = _with(_tags(_cut("ridge", "slope", "growth"), "2", "nsrsbh", "slope"))
    q["tag_fast_growth_ranked"] = q["tag_fast_growth"]
    q["tag_fast_growth_ols"] = _with(_tags(_cut("ols", "slope", "growth"), "2", "nsrsbh", "slope"))
    for name, lag in (("tag_periodic", LAG), ("tag_periodic_lag3", 3), ("tag_periodic_lag6", 6)):
        q[name] = _with(_tags(_cut("acf", "coefficient", "periodic"), "4", "nsrsbh", "coefficient"), lag)
    least = (f"(SELECT * FROM (SELECT hy_dm, nsrsbh, round(centrality, {CENTRALITY_DIGITS}) AS c, "
             f"row_number() OVER (PARTITION BY hy_dm ORDER BY round(centrality, {CENTRALITY_DIGITS}), nsrsbh) AS rn "
             f"FROM cent) WHERE rn <= 5)")
    q["tag_supply_core_least"] = _with_power(_tags(least, "5", "nsrsbh", "c"))
    core = (f"(SELECT * FROM (SELECT hy_dm, nsrsbh, round(centrality, {CENTRALITY_DIGITS}) AS c, "
            f"row_number() OVER (PARTITION BY hy_dm ORDER BY round(centrality, {CENTRALITY_DIGITS}) DESC, nsrsbh) AS rn "
            f"FROM cent) WHERE rn <= 5)")
    q["tag_supply_core"] = _with_power(_tags(core, "5", "nsrsbh", "c"))
    q["tag_industry_leader"] = _with(_tags(f"{ranked} WHERE rank = 1", "6", "nsrsbh", "xxbl"))
    q["tag_table"] = _with(_tags("nsr WHERE nsrdj_no <> ''", "1", "nsrsbh", "1.0") + " UNION ALL "
                           + _tags(f"{ranked} WHERE rank = 1", "6", "nsrsbh", "xxbl"))
    level = """
      SELECT nsrsbh, slope, CASE WHEN raw >= 1 THEN CAST(raw AS INTEGER) ELSE 0 END * sgn AS level FROM (
        SELECT nsrsbh, slope, sgn,
               5 - floor(((row_number() OVER (PARTITION BY sgn ORDER BY slope * sgn DESC, nsrsbh) - 1)
                         / CAST(count(*) OVER (PARTITION BY sgn) AS DOUBLE)) / CAST(0.01 AS DOUBLE)) AS raw
        FROM (SELECT nsrsbh, slope, CASE WHEN slope >= 0.1 THEN 1 ELSE -1 END AS sgn
              FROM ridge WHERE abs(slope) >= 0.1))
      UNION ALL
      SELECT nsrsbh, slope, 0 AS level FROM ridge WHERE abs(slope) < 0.1"""
    q["growth_level"] = _with(level)
    profile = " UNION ALL ".join([
        _tags("nsr WHERE nsrdj_no <> ''", "1", "nsrsbh", "1.0"),
        _tags(_cut("ridge", "slope", "growth"), "2", "nsrsbh", "slope"),
        _tags(_cut("acf", "coefficient", "periodic"), "4", "nsrsbh", "coefficient"),
        _tags(f"{ranked} WHERE rank = 1", "6", "nsrsbh", "xxbl"),
    ])
    q["enterprise_profile"] = _with(profile)
    q["enterprise_profile_all"] = _with_power(profile + " UNION ALL " + _tags(core, "5", "nsrsbh", "c"))
    q["profile_tags_rerun"] = q["enterprise_profile_all"]
    return q
