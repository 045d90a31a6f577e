"""DuckDB twins of the registered queries (ANSI SQL over the driver's views).

Each query is a set of named CTE fragments plus a final SELECT; ``sql()`` pulls
in the fragments a query needs, in dependency order.  Every double is rounded to
6 decimals (+0.0 folds -0.0) exactly as ``plans.catalog`` does on the Spark side.
"""
from __future__ import annotations

import re


def R(expr: str, alias: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0) AS {alias}"


SATURDAY = "({d} + CAST((6 - dayofweek({d})) % 7 AS INTEGER))"


def sat(d: str) -> str:
    return SATURDAY.format(d=d)


CTE: dict[str, str] = {}

CTE["s_raw"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
       l.l_discount, l.l_tax, l.l_shipdate,
       l.l_suppkey AS site, lower(n.n_name) AS state_raw,
       CAST(l.l_shipdate AS DATE) AS sample_collect_date,
       CASE WHEN l.l_linestatus = 'O' THEN 'raw wastewater' WHEN l.l_tax < 0.02 THEN 'sludge'
            ELSE 'post grit removal' END AS sample_matrix,
       l.l_returnflag AS gene,
       CASE WHEN l.l_returnflag = 'R' THEN log10(l.l_extendedprice) WHEN l.l_discount = 0 THEN 0.0
            ELSE l.l_extendedprice END AS conc0,
       CASE WHEN l.l_returnflag = 'R' THEN ' Log10 copies/L wastewater'
            WHEN l.l_returnflag = 'A' THEN 'copies/L wastewater '
            WHEN l.l_discount > 0.08 THEN 'copies/g dry sludge' ELSE 'copies/l wastewater' END AS units,
       CASE WHEN l.l_quantity >= 5 THEN l.l_quantity END AS lod,
       CAST(trunc(s.s_acctbal) AS BIGINT) AS population,
       l.l_extendedprice AS flow_rate,
       CASE WHEN l.l_linenumber IN (1, 3) THEN 'qpcr' WHEN l.l_linenumber IN (2, 4) THEN ' ddPCR'
            WHEN l.l_linenumber = 5 THEN 'dpcr' WHEN l.l_linenumber = 6 THEN 'rt-qpcr'
            ELSE 'lamp' END AS pcr_type,
       lower(l.l_returnflag || '-' || l.l_linestatus) AS concentration_method
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""

CTE["s_typed"] = """
SELECT *, starts_with(lower(trim(units)), 'log10') AS is_log,
       CASE WHEN starts_with(lower(trim(units)), 'log10') THEN 'copies/l wastewater'
            ELSE lower(trim(units)) END AS units_h,
       CASE WHEN starts_with(lower(trim(units)), 'log10') THEN pow(10, conc0) ELSE conc0 END AS conc
FROM s_raw"""

CTE["s_kept"] = """
SELECT * FROM s_typed
WHERE units_h = 'copies/l wastewater' AND sample_matrix IN ('raw wastewater', 'post grit removal')"""

CTE["s_medlod"] = "SELECT median(lod) AS med_lod FROM s_kept"

CTE["s_subst"] = """
SELECT k.*, CASE WHEN k.conc = 0 THEN 1 ELSE 0 END AS nondetect_flag,
       CASE WHEN k.conc = 0 AND k.lod IS NOT NULL THEN k.lod / 2
            WHEN k.conc = 0 THEN m.med_lod / 2 ELSE k.conc END AS conc2
FROM s_kept k CROSS JOIN s_medlod m"""

CTE["s_dedup"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY site, sample_collect_date, gene, sample_matrix
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               l_discount, l_tax, l_shipdate) AS rn
  FROM s_subst) WHERE rn = 1"""

CTE["s_logged"] = """
SELECT *, CASE WHEN conc2 IS NOT NULL THEN log10(greatest(conc2, 1.0)) END AS log10_conc
FROM s_dedup"""

CTE["s_site_med"] = """
SELECT site, median(log10_conc) AS med, stddev_samp(log10_conc) AS sd
FROM s_logged WHERE site IS NOT NULL GROUP BY site"""

CTE["s_site_mad"] = """
SELECT l.site, median(abs(l.log10_conc - m.med)) AS mad
FROM s_logged l JOIN s_site_med m ON l.site = m.site GROUP BY l.site"""

CTE["s_scored"] = """
SELECT l.*,
       0.6745 * ((l.log10_conc - m.med) / NULLIF(d.mad, 0)) AS robust_z,
       COALESCE(CAST(abs(0.6745 * ((l.log10_conc - m.med) / NULLIF(d.mad, 0))) > 5 AS INTEGER), 0)
           AS outlier_flag,
       COALESCE((l.log10_conc - m.med) / NULLIF(m.sd, 0), 0.0) AS conc_site_z,
       lower(trim(l.state_raw)) AS state_territory,
       """ + sat("l.sample_collect_date") + """ AS week_end
FROM s_logged l LEFT JOIN s_site_med m ON l.site = m.site LEFT JOIN s_site_mad d ON l.site = d.site"""

CTE["s_weekly_all"] = """
SELECT state_territory, week_end,
       avg(log10_conc) AS log10_conc_mean, median(log10_conc) AS log10_conc_median,
       avg(conc_site_z) AS conc_site_z_mean, CAST(count(*) AS BIGINT) AS n_samples,
       CAST(count(DISTINCT site) AS BIGINT) AS n_sites, avg(nondetect_flag) AS pct_nondetect,
       CAST(COALESCE(sum(population), 0) AS BIGINT) AS pop_served,
       CAST(COALESCE(sum(population) FILTER (WHERE first_of_site), 0) AS BIGINT) AS pop_served_distinct
FROM (SELECT *, site IS NOT NULL AND row_number() OVER (PARTITION BY state_territory, week_end, site
             ORDER BY population DESC NULLS LAST) = 1 AS first_of_site FROM s_scored)
WHERE state_territory IS NOT NULL AND week_end IS NOT NULL
GROUP BY state_territory, week_end"""

CTE["s_weekly"] = "SELECT * FROM s_weekly_all WHERE n_sites >= {min_sites}"

# ---- label side -------------------------------------------------------------
CTE["h_base"] = """
SELECT n.n_name, n.n_regionkey, """ + sat("CAST(o.o_orderdate AS DATE)") + """ AS wk,
       CASE WHEN o.o_orderstatus <> 'P' THEN 1 ELSE 0 END AS reported
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTE["h_raw"] = """
SELECT n_name AS jurisdiction, wk, CAST(count(*) AS DOUBLE) AS admits, avg(reported) * 100.0 AS pct
FROM h_base GROUP BY n_name, wk
UNION ALL
SELECT 'Region ' || CAST(n_regionkey AS VARCHAR), wk, CAST(count(*) AS DOUBLE), avg(reported) * 100.0
FROM h_base GROUP BY n_regionkey, wk
UNION ALL
SELECT 'USA', wk, CAST(count(*) AS DOUBLE), avg(reported) * 100.0 FROM h_base GROUP BY wk"""

CTE["h_tagged"] = """
SELECT lower(trim(jurisdiction)) AS state_territory, wk AS week_end, admits, pct / 100.0 AS coverage,
       CASE WHEN wk < DATE '{vol_start}' THEN 'mandatory_pre' WHEN wk <= DATE '{vol_end}' THEN 'voluntary'
            ELSE 'mandatory_post' END AS regime,
       CASE WHEN wk IS NULL OR admits IS NULL THEN '21_valid_date_and_admits'
            WHEN starts_with(lower(trim(jurisdiction)), 'region')
                 OR lower(trim(jurisdiction)) IN ('usa', 'us', 'national', 'all') THEN '22_drop_rollups'
            WHEN wk >= DATE '{vol_start}' AND wk <= DATE '{vol_end}' THEN '23_drop_voluntary_window'
       END AS fail
FROM h_raw"""

CTE["h_labels"] = """
SELECT state_territory, week_end, admits, coverage, regime FROM h_tagged WHERE fail IS NULL"""

# ---- panel ------------------------------------------------------------------
CTE["p_joined"] = """
SELECT w.*, h.admits, h.coverage, h.regime
FROM s_weekly w LEFT JOIN h_labels h
  ON w.state_territory = h.state_territory AND w.week_end = h.week_end"""

CTE["p_med"] = """
SELECT state_territory, median(admits) AS state_med FROM p_joined GROUP BY state_territory"""

CTE["p_win"] = """
SELECT j.*, m.state_med,
  j.admits AS admits_per100k,
  lead(j.admits, 1) OVER w AS admits_next_week,
  j.admits AS admits_this_week,
  lead(j.week_end, 1) OVER w AS next_week_end,
  lag(j.log10_conc_mean, 1) OVER w AS log10_conc_lag1,
  lag(j.log10_conc_mean, 2) OVER w AS log10_conc_lag2,
  lag(j.log10_conc_mean, 3) OVER w AS log10_conc_lag3,
  count(j.log10_conc_mean) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll_n,
  avg(j.log10_conc_mean) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll_avg
FROM p_joined j LEFT JOIN p_med m ON j.state_territory = m.state_territory
WINDOW w AS (PARTITION BY j.state_territory ORDER BY j.week_end)"""

CTE["p_feat"] = """
SELECT *,
  (admits_next_week - admits) / NULLIF(admits, 0) AS pct_change_next,
  CASE WHEN COALESCE(date_diff('day', week_end, next_week_end) = 7, false)
       THEN admits_next_week END AS y_reg_next_admits,
  CASE WHEN admits_next_week IS NULL
         OR NOT COALESCE(date_diff('day', week_end, next_week_end) = 7, false) THEN NULL
       ELSE CAST(COALESCE((admits_next_week - admits) / NULLIF(admits, 0) > {surge}
                          AND admits_next_week > state_med, false) AS INTEGER) END AS y_surge_next_week,
  log10_conc_mean - log10_conc_lag1 AS conc_delta_1w,
  CASE WHEN roll_n >= 2 THEN roll_avg END AS conc_roll3,
  COALESCE(date_diff('day', week_end, next_week_end) = 7, false) AS gap_ok
FROM p_win"""

CTE["p_ready"] = """
SELECT * FROM p_feat WHERE y_surge_next_week IS NOT NULL AND log10_conc_lag1 IS NOT NULL"""

CTE["p_era0"] = "SELECT * FROM p_ready WHERE week_end >= DATE '{era_start}'"

CTE["p_cut"] = """
SELECT quantile_cont(CAST(week_end - DATE '1970-01-01' AS DOUBLE), {split_q}) AS cut_days FROM p_era0"""

CTE["p_era"] = """
SELECT e.*, CASE WHEN CAST(e.week_end - DATE '1970-01-01' AS DOUBLE) <= c.cut_days
                 THEN 'train' ELSE 'test' END AS split_era
FROM p_era0 e CROSS JOIN p_cut c"""

DEFAULTS = {"min_sites": 2, "vol_start": "1998-05-01", "vol_end": "1998-10-31",
            "surge": 0.1, "era_start": "1997-01-01", "split_q": 0.75}


def _deps(body: str) -> list[str]:
    found = []
    for name in CTE:
        if re.search(rf"\b{name}\b", body):
            found.append(name)
    return found


def sql(final: str, extra: dict | None = None, **params) -> str:
    """Assemble ``WITH`` + the CTEs referenced (transitively) by ``final``."""
    ctes = dict(CTE)
    if extra:
        ctes.update(extra)
    order: list[str] = []

    def visit(name: str, seen: set):
        if name in order or name in seen:
            return
        seen.add(name)
        for d in [n for n in ctes if n != name and re.search(rf"\b{n}\b", ctes[name])]:
            visit(d, seen)
        order.append(name)

    for n in [n for n in ctes if re.search(rf"\b{n}\b", final)]:
        visit(n, set())
    p = dict(DEFAULTS)
    p.update(params)
    body = ",\n".join(f"{n} AS ({ctes[n]})" for n in order)
    text = (f"WITH {body}\n{final}" if order else final)
    return text.replace("{min_sites}", str(p["min_sites"])).replace("{vol_start}", p["vol_start"]) \
        .replace("{vol_end}", p["vol_end"]).replace("{surge}", str(p["surge"])) \
        .replace("{era_start}", p["era_start"]).replace("{split_q}", str(p["split_q"]))
