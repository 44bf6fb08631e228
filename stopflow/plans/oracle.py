"""DuckDB SQL giving the same results as the catalogue, for checking it."""

from __future__ import annotations

from stopflow.config import PROFILE_MEASURES, PROFILE_NAMES_K2, PROFILE_NAMES_K5

CATEGORY = """CASE l.l_returnflag WHEN 'N' THEN 'NON DEFINI' WHEN 'A' THEN 'Forfait Navigo' ELSE 'Imagine R' END"""
LINES = """lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def _validations(stop: str, extra: str = "") -> str:
    return f"""SELECT {extra} CAST(l.l_shipdate AS DATE) AS day, CAST(n.n_regionkey AS VARCHAR) AS carrier,
        CAST(n.n_nationkey AS VARCHAR) AS network, CAST(s.s_suppkey AS VARCHAR) AS stop_code, s.s_suppkey AS zone_id,
        {stop} AS stop, {CATEGORY} AS category, CAST(l.l_quantity AS BIGINT) AS n FROM {LINES}"""


CTES = {
    "v": _validations("n.n_name"),
    "vs": _validations("CAST(s.s_suppkey AS VARCHAR)"),
    "vq": _validations("n.n_name", "l.l_orderkey * 8 + l.l_linenumber AS seq,"),
    "cal_rows": """SELECT day, CASE WHEN strftime(day, '%m-%d') IN ('01-01','05-01','05-08','07-14','08-15','11-01','11-11','12-25') THEN 'ferie'
        WHEN month(day) = 9 AND day(day) <= 3 THEN 'rentree'
        WHEN (month(day) = 7 AND day(day) >= 5) OR month(day) = 8 OR (month(day) = 12 AND day(day) >= 20) THEN 'vacances'
        ELSE 'normal' END AS type
      FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem)""",
    "cal": "SELECT day, type = 'ferie' AS is_holiday, type IN ('vacances', 'rentree') AS is_vacation FROM cal_rows",
    "daily": "SELECT stop, day, CAST(sum(n) AS BIGINT) AS n FROM v GROUP BY stop, day",
    "totals": "SELECT day, CAST(sum(n) AS BIGINT) AS total FROM v GROUP BY day",
    "sub": f"""SELECT l.l_orderkey * 8 + l.l_linenumber AS seq,
        CASE WHEN l.l_linenumber = 7 AND l.l_quantity >= 49 THEN '31/12/1999' ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS day,
        CASE WHEN l.l_linenumber = 2 THEN CAST(n.n_regionkey AS VARCHAR) || '.0' WHEN l.l_linenumber = 5 THEN NULL ELSE CAST(n.n_regionkey AS VARCHAR) END AS carrier,
        CASE WHEN l.l_linenumber = 3 THEN ' R' || CAST(n.n_nationkey AS VARCHAR) || chr(160) ELSE CAST(n.n_nationkey AS VARCHAR) END AS network,
        CASE WHEN l.l_linenumber = 4 THEN CAST(s.s_suppkey AS VARCHAR) || 'D' ELSE CAST(s.s_suppkey AS VARCHAR) END AS stop_code,
        CASE WHEN l.l_linenumber = 6 THEN NULL ELSE CAST(s.s_suppkey AS VARCHAR) END AS zone_id,
        CASE WHEN l.l_linenumber = 1 THEN chr(160) || ' ' || lower(n.n_name) || ' ' WHEN l.l_linenumber = 2 AND l.l_quantity >= 50 THEN NULL ELSE n.n_name END AS stop,
        CASE l.l_returnflag WHEN 'N' THEN 'NON DEFINI' WHEN 'A' THEN 'Contrat Solidarite Transport' ELSE 'Imagine R ' END AS category,
        CASE WHEN l.l_linenumber = 3 AND l.l_quantity >= 45 THEN 'abc'
             WHEN l.l_linenumber = 4 THEN CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || '.7'
             WHEN l.l_linenumber = 5 AND l.l_quantity < 5 THEN '-' || CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR)
             ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS n
      FROM {LINES}""",
    "req": """SELECT o.o_orderkey AS request_id,
        CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P' THEN 'NO SUCH STOP' ELSE n.n_name END AS stop,
        CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 120 END AS day,
        CAST(floor(o.o_totalprice / 2000) - 5 AS BIGINT) AS n,
        CASE o.o_orderpriority WHEN '2-HIGH' THEN 'k2' WHEN '3-MEDIUM' THEN 'k99' ELSE 'k5' END AS version
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
}


def _stop_day(source: str) -> str:
    return f"""SELECT stop, day, CAST(sum(n) AS BIGINT) AS n, min(carrier) AS carrier, min(network) AS network,
        min(stop_code) AS stop_code, min(zone_id) AS zone_id FROM {source} WHERE category <> 'NON DEFINI' GROUP BY stop, day"""


CTES["sd"] = _stop_day("v")
CTES["sds"] = _stop_day("vs")
CTES["codes"] = "SELECT carrier, CAST(row_number() OVER (ORDER BY carrier) - 1 AS INTEGER) AS carrier_index FROM (SELECT DISTINCT carrier FROM sd)"
CTES["lagged"] = """SELECT *, CAST(lag(n, 1) OVER w AS DOUBLE) AS raw1, CAST(lag(n, 7) OVER w AS DOUBLE) AS raw7,
    avg(n) OVER (PARTITION BY stop ORDER BY day ROWS 6 PRECEDING) AS mean7,
    coalesce(stddev_samp(n) OVER (PARTITION BY stop ORDER BY day ROWS 6 PRECEDING), 0) AS std7,
    max(n) OVER (PARTITION BY stop) AS max_n
  FROM sd WINDOW w AS (PARTITION BY stop ORDER BY day)"""
CTES["feat"] = """SELECT l.stop, l.day, l.n, l.carrier, l.network, l.stop_code, l.zone_id,
    CAST(isodow(l.day) - 1 AS INTEGER) AS weekday, isodow(l.day) >= 6 AS is_weekend, CAST(month(l.day) AS INTEGER) AS month,
    CAST(week(l.day) AS INTEGER) AS iso_week, CAST(year(l.day) AS INTEGER) AS year,
    coalesce(cal.is_holiday, false) AS is_holiday, coalesce(cal.is_vacation, false) AS is_vacation,
    coalesce(raw1, median(raw1) OVER (PARTITION BY l.stop)) AS lag1, coalesce(raw7, median(raw7) OVER (PARTITION BY l.stop)) AS lag7,
    mean7, std7, CASE WHEN max_n > 0 THEN round_even(n / max_n, 4) ELSE 0 END AS congestion,
    coalesce(codes.carrier_index, 0) AS carrier_index
  FROM lagged l LEFT JOIN cal ON l.day = cal.day LEFT JOIN codes ON l.carrier = codes.carrier"""
CTES["z"] = """SELECT *, CASE WHEN stddev_samp(n) OVER (PARTITION BY stop) > 0
    THEN (n - avg(n) OVER (PARTITION BY stop)) / stddev_samp(n) OVER (PARTITION BY stop) ELSE 0 END AS z FROM feat"""
CTES["prof"] = """SELECT stop, weekday_mean, weekend_mean, CASE WHEN weekday_mean > 0 THEN weekend_mean / weekday_mean ELSE 0 END AS weekend_ratio,
    volume, coalesce(CASE WHEN m > 0 THEN sd / m ELSE 0 END, 0) AS variation, cluster FROM (
    SELECT stop, coalesce(avg(n) FILTER (isodow(day) < 6), 0) AS weekday_mean, coalesce(avg(n) FILTER (isodow(day) >= 6), 0) AS weekend_mean,
      CAST(sum(n) AS BIGINT) AS volume, avg(n) AS m, stddev_samp(n) AS sd, CAST(min(carrier) AS INTEGER) AS cluster FROM sds GROUP BY stop)"""
CTES["scaled"] = "SELECT stop, cluster, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END AS {c}_scaled"
    for c in PROFILE_MEASURES
) + " FROM prof"
CTES["centers"] = "SELECT cluster, count(*) AS size, " + ", ".join(
    f"avg({c}_scaled) AS {c}_center" for c in PROFILE_MEASURES
) + " FROM scaled GROUP BY cluster"
CTES["means"] = "SELECT cluster, count(*) AS size, " + ", ".join(f"avg({c}) AS {c}" for c in PROFILE_MEASURES) + " FROM prof GROUP BY cluster"
CTES["names5"] = f"""SELECT cluster, CASE cluster WHEN hub THEN '{PROFILE_NAMES_K5["hub"]}' WHEN residential THEN '{PROFILE_NAMES_K5["residential"]}'
    WHEN irregular THEN '{PROFILE_NAMES_K5["irregular"]}' WHEN large THEN '{PROFILE_NAMES_K5["large"]}' ELSE '{PROFILE_NAMES_K5["standard"]}' END AS profile
  FROM means, (SELECT *, (SELECT cluster FROM means WHERE cluster NOT IN (hub, residential, irregular) ORDER BY volume DESC, cluster LIMIT 1) AS large
    FROM (SELECT *, (SELECT cluster FROM means WHERE cluster NOT IN (hub, residential) ORDER BY variation DESC, cluster LIMIT 1) AS irregular
      FROM (SELECT hub, (SELECT cluster FROM means WHERE cluster <> hub ORDER BY weekend_ratio, cluster LIMIT 1) AS residential
        FROM (SELECT cluster AS hub FROM means ORDER BY volume DESC, cluster LIMIT 1)))) picks"""
CTES["per_stop"] = "SELECT stop, count(DISTINCT day) AS days, avg(n) AS mean, CAST(sum(n) AS BIGINT) AS volume, max(day) AS last_day FROM sd GROUP BY stop"

# Request answers: exact-day lookups and the last seven rows before the day.
CTES["pairs"] = "SELECT DISTINCT stop, day FROM req WHERE stop IN (SELECT stop FROM sd) AND day IS NOT NULL"
CTES["stop_facts"] = "SELECT stop, median(n) AS median_n, max(n) AS max_n, min(carrier) AS carrier FROM sd GROUP BY stop"
CTES["recent"] = """SELECT p.stop, p.day, h.mean7, h.std7 FROM pairs p ASOF LEFT JOIN (
    SELECT stop, day, avg(n) OVER w AS mean7, stddev_samp(n) OVER w AS std7 FROM sd
    WINDOW w AS (PARTITION BY stop ORDER BY day ROWS 6 PRECEDING)) h ON p.stop = h.stop AND p.day > h.day"""
CTES["looked"] = """SELECT p.stop, p.day, coalesce(CAST(a.n AS DOUBLE), f.median_n) AS lag1, coalesce(CAST(b.n AS DOUBLE), f.median_n) AS lag7,
    r.mean7, r.std7, s.n AS n_same, f.max_n, f.carrier
  FROM pairs p JOIN stop_facts f ON p.stop = f.stop LEFT JOIN sd a ON a.stop = p.stop AND a.day = p.day - 1
  LEFT JOIN sd b ON b.stop = p.stop AND b.day = p.day - 7 LEFT JOIN sd s ON s.stop = p.stop AND s.day = p.day
  LEFT JOIN recent r ON r.stop = p.stop AND r.day = p.day"""

# What each CTE needs, so that a query carries no more than it uses.
NEEDS = {
    "cal": ["cal_rows"],
    "daily": ["v"],
    "totals": ["v"],
    "sd": ["v"],
    "sds": ["vs"],
    "codes": ["sd"],
    "lagged": ["sd"],
    "feat": ["lagged", "cal", "codes"],
    "z": ["feat"],
    "prof": ["sds"],
    "scaled": ["prof"],
    "centers": ["scaled"],
    "means": ["prof"],
    "names5": ["means"],
    "per_stop": ["sd"],
    "pairs": ["req", "sd"],
    "stop_facts": ["sd"],
    "recent": ["pairs", "sd"],
    "looked": ["pairs", "stop_facts", "recent", "sd"],
}


def _order(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _order(NEEDS.get(name, []), seen)
        if name not in seen:
            seen.append(name)
    return seen


def sql(needs: str, body: str) -> str:
    names = _order(needs.split(), [])
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    return f"WITH {head}\n{body}" if names else body


def r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def half_up(expression: str, digits: int) -> str:
    """Round half away from zero on the decimal value."""
    return f"round(({expression}) + sign({expression}) * 1e-10, {digits}) + 0.0"


EN = "CASE isodow({0}) WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' ELSE 'Sunday' END"
FR = "CASE isodow({0}) WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi' WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' ELSE 'Dimanche' END"
V_COLUMNS = "day, carrier, network, stop_code, zone_id, stop, category, n"

STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\x{{a0}}]+', ''), '[\s\x{{a0}}]+$', '')"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: str) -> str:
    return STRIP.format(c)


def number(c: str) -> str:
    return f"CASE WHEN regexp_matches({strip(c)}, '{NUMBER}') THEN TRY_CAST({strip(c)} AS DOUBLE) END"


def count_or_zero(c: str) -> str:
    return f"coalesce(CAST(trunc({number(c)}) AS BIGINT), 0)"


def code(c: str) -> str:
    return f"coalesce(CAST(CAST(trunc({number(c)}) AS BIGINT) AS VARCHAR), {strip(c)}, '0')"


DAY = r"CASE WHEN regexp_matches({0}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST({0} AS DATE) END"
FIX = f"CASE WHEN {strip('category')} = 'Contrat Solidarite Transport' THEN 'Contrat Solidarité Transport' ELSE {strip('category')} END"
CLEAN = f"""{DAY.format('day')} AS day, {code('carrier')} AS carrier, {code('network')} AS network, {code('stop_code')} AS stop_code,
  {count_or_zero('zone_id')} AS zone_id, {strip('stop')} AS stop, {FIX} AS category, {count_or_zero('n')} AS n"""
TYPED = f"""SELECT seq, {DAY.format('day')} AS day, coalesce({strip('carrier')}, '100') AS carrier, coalesce({strip('network')}, '110') AS network,
  coalesce({strip('stop_code')}, '0') AS stop_code, coalesce(CAST(trunc({number('zone_id')}) AS BIGINT), 0) AS zone_id,
  upper({strip('stop')}) AS stop, {strip('category')} AS category, CAST(trunc({number('n')}) AS BIGINT) AS n FROM sub"""

FEATURE_COLUMNS = f"""stop, day, n, carrier, network, stop_code, zone_id, weekday, is_weekend, month, iso_week, year, is_holiday, is_vacation,
  {r('lag1')} AS lag1, {r('lag7')} AS lag7, {r('mean7')} AS mean7, {r('std7', 4)} AS std7, {r('congestion')} AS congestion, carrier_index"""

QUERIES: dict[str, str] = {}

# -- sources and sinks ---------------------------------------------------------
QUERIES["scan_raw_csv"] = sql("sub", f"SELECT {CLEAN} FROM sub")
QUERIES["scan_quarters_by_name"] = sql(
    "sub", f"SELECT {CLEAN}, 'T' || CAST(quarter(coalesce({DAY.format('day')}, DATE '1999-12-31')) AS VARCHAR) AS source FROM sub"
)
QUERIES["scan_table"] = sql("v", f"SELECT {V_COLUMNS} FROM v")
QUERIES["scan_features"] = sql("feat", f"SELECT {FEATURE_COLUMNS} FROM feat")
QUERIES["scan_calendar"] = sql("cal", "SELECT day, is_holiday, is_vacation FROM cal")
QUERIES["write_features"] = sql("feat", "SELECT year, month, count(*) AS rows, CAST(sum(n) AS BIGINT) AS n FROM feat GROUP BY year, month")
QUERIES["append_batches"] = sql("v", "SELECT carrier, count(*) AS rows, CAST(sum(n) AS BIGINT) AS n FROM v GROUP BY carrier")
QUERIES["truncate_reload"] = sql(
    "v", "SELECT category, count(*) AS rows, CAST(sum(n) AS BIGINT) AS n FROM v WHERE category <> 'NON DEFINI' GROUP BY category"
)
QUERIES["append_validated"] = sql(
    "sub",
    f"SELECT * FROM ({TYPED}) t WHERE day IS NOT NULL AND coalesce(stop, '') <> '' AND coalesce(category, '') <> '' AND n >= 0",
)
QUERIES["verify_load"] = sql(
    "v",
    """SELECT count(*) AS rows, count(DISTINCT day) AS days, count(DISTINCT stop) AS stops, count(DISTINCT category) AS categories,
    min(day) AS first_day, max(day) AS last_day, count(DISTINCT category) = 7 AS categories_ok, count(DISTINCT day) = 365 AS days_ok,
    count(*) = (SELECT count(*) FROM lineitem) AS rows_ok FROM v""",
)
QUERIES["latest_rows"] = sql(
    "vq", f"SELECT seq, {V_COLUMNS} FROM vq ORDER BY seq DESC, day, carrier, network, stop_code, zone_id, stop, category, n LIMIT 10"
)
QUERIES["dataset_inventory"] = sql(
    "sd",
    """SELECT CASE WHEN day < DATE '1999-01-01' THEN 'reference' ELSE 'current' END AS dataset, count(*) AS rows, count(DISTINCT day) AS days,
    min(day) AS first_day, max(day) AS last_day, array_to_string(list_sort(list(DISTINCT month(day))), ',') AS months FROM sd GROUP BY 1""",
)

# -- projections and cleaning ----------------------------------------------------
QUERIES["parse_day"] = sql("sub", f"SELECT day AS day_text, {DAY.format('day')} AS day, count(*) AS rows FROM sub GROUP BY ALL")
QUERIES["coerce_counts"] = sql("sub", f"SELECT n AS n_text, {count_or_zero('n')} AS n, count(*) AS rows FROM sub GROUP BY ALL")
QUERIES["strip_text"] = sql("sub", f"SELECT stop AS stop_text, {strip('stop')} AS stop, count(*) AS rows FROM sub GROUP BY ALL")
QUERIES["normalize_code"] = sql(
    "sub",
    f"""SELECT kind, text, {code('text')} AS code, count(*) AS rows FROM (SELECT 'carrier' AS kind, carrier AS text FROM sub
    UNION ALL SELECT 'network', network FROM sub UNION ALL SELECT 'stop_code', stop_code FROM sub) t GROUP BY ALL""",
)
QUERIES["relabel_category"] = sql("sub", f"SELECT category AS category_text, {FIX} AS category, count(*) AS rows FROM sub GROUP BY ALL")
QUERIES["project_columns"] = sql("vq", f"SELECT {V_COLUMNS} FROM vq")
QUERIES["flag_defined"] = sql("v", f"SELECT {V_COLUMNS}, category <> 'NON DEFINI' AS is_defined FROM v")
QUERIES["filter_defined"] = sql("v", f"SELECT {V_COLUMNS} FROM v WHERE category <> 'NON DEFINI'")
QUERIES["filter_stop_period"] = sql(
    "v", f"SELECT {V_COLUMNS} FROM v WHERE stop = 'NATION_3' AND day BETWEEN DATE '1997-07-01' AND DATE '1997-09-30'"
)
QUERIES["normalize_stop_name"] = sql("sub", f"SELECT stop AS stop_text, upper({strip('stop')}) AS stop, count(*) AS rows FROM sub GROUP BY ALL")
QUERIES["filter_zscore"] = sql(
    "z", f"SELECT stop, day, n, {r('z')} AS z, CASE WHEN z < 0 THEN 'low' ELSE 'high' END AS side FROM z WHERE abs(z) > 3"
)
QUERIES["validate_rows"] = sql(
    "req",
    """SELECT request_id, CASE WHEN stop IS NULL THEN 'stop missing' WHEN day IS NULL THEN 'day missing' WHEN n < 0 THEN 'count negative'
    WHEN version NOT IN ('k2', 'k5') THEN 'unknown version' END AS reason FROM req""",
)
QUERIES["incomplete_stops"] = sql(
    "vs", "SELECT stop, count(DISTINCT day) AS active_days FROM vs GROUP BY stop HAVING count(DISTINCT day) < 540"
)
QUERIES["date_position"] = sql(
    "req v",
    """SELECT request_id, stop, day, CASE WHEN day IS NULL THEN 'day missing' WHEN day < a THEN 'before' WHEN day > b THEN 'after' ELSE 'inside' END AS position,
    CASE WHEN day IS NOT NULL THEN CAST(greatest(day - b, 0) AS INTEGER) END AS days_past_end FROM req, (SELECT min(day) AS a, max(day) AS b FROM v) e""",
)
QUERIES["classify_day_type"] = sql(
    "cal",
    f"""SELECT day, {EN.format('day')} AS weekday_name, CASE WHEN is_holiday THEN 'holiday' WHEN is_vacation THEN 'vacation'
    WHEN isodow(day) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type FROM cal""",
)

# -- joins -------------------------------------------------------------------------
QUERIES["congestion_top20"] = sql(
    "daily",
    f"""SELECT t.stop, t.day, t.n, m.max_n, {half_up('t.n / m.max_n', 3)} AS score FROM daily t
    JOIN (SELECT stop, max(n) AS max_n FROM daily GROUP BY stop) m ON t.stop = m.stop ORDER BY score DESC, t.stop, t.day LIMIT 20""",
)
QUERIES["calendar_flags"] = sql(
    "sd cal",
    """SELECT stop, day, EXISTS (SELECT 1 FROM cal c WHERE c.day = sd.day AND c.is_holiday) AS is_holiday,
    EXISTS (SELECT 1 FROM cal c WHERE c.day = sd.day AND c.is_vacation) AS is_vacation FROM sd""",
)
QUERIES["semi_top_stops"] = sql(
    "vs",
    f"SELECT {V_COLUMNS} FROM vs WHERE stop IN (SELECT stop FROM vs GROUP BY stop ORDER BY sum(n) DESC, stop LIMIT 50)",
)
QUERIES["rate_by_aligned_division"] = sql(
    "v",
    f"""SELECT t.stop, {r('round_even(coalesce(u.u * 100.0 / t.t, 0), 2)')} AS undefined_pct FROM (SELECT stop, sum(n) AS t FROM v GROUP BY stop) t
    LEFT JOIN (SELECT stop, sum(n) AS u FROM v WHERE category = 'NON DEFINI' GROUP BY stop) u ON t.stop = u.stop
    ORDER BY undefined_pct DESC, t.stop LIMIT 20""",
)
QUERIES["map_labels"] = sql("prof names5", "SELECT p.stop, p.cluster, n.profile FROM prof p LEFT JOIN names5 n ON p.cluster = n.cluster")
QUERIES["calendar_lag_lookup"] = sql("looked", f"SELECT stop, day, {r('lag1')} AS lag1, {r('lag7')} AS lag7 FROM looked")
QUERIES["short_term_answers"] = sql(
    "looked",
    f"""SELECT request_id, req.stop, req.day, {r('lag1')} AS lag1, {r('lag7')} AS lag7, {r('mean7')} AS mean7, {r('std7', 4)} AS std7,
    CASE WHEN req.stop IS NULL THEN 'stop missing' WHEN req.day IS NULL THEN 'day missing' WHEN l.stop IS NULL THEN 'unknown stop' ELSE 'ok' END AS status
    FROM req LEFT JOIN looked l ON req.stop = l.stop AND req.day = l.day""",
)
QUERIES["asof_last7"] = sql("recent", f"SELECT stop, day, {r('mean7')} AS mean7, {r('std7', 4)} AS std7 FROM recent")
QUERIES["similar_stops"] = sql(
    "prof",
    """SELECT stop, cluster, CAST(rank AS INTEGER) AS rank, similar_stop FROM (SELECT a.stop, a.cluster, b.stop AS similar_stop,
    row_number() OVER (PARTITION BY a.stop ORDER BY b.volume DESC, b.stop) AS rank FROM prof a JOIN prof b ON a.cluster = b.cluster AND a.stop <> b.stop)
    WHERE rank <= 5""",
)
QUERIES["score_against_history"] = sql(
    "req sd",
    f"""SELECT q.request_id, q.stop, q.n, CASE WHEN q.stop IS NULL THEN 'stop missing' WHEN m.stop IS NULL THEN 'unknown stop' ELSE 'ok' END AS status,
    {r('m.mean')} AS mean, {r('CASE WHEN m.stop IS NULL THEN NULL WHEN m.std > 0 THEN (q.n - m.mean) / m.std ELSE 0 END')} AS z,
    {r('CASE WHEN m.stop IS NULL THEN NULL WHEN m.mx > 0 THEN q.n / m.mx ELSE 0 END')} AS norm
    FROM req q LEFT JOIN (SELECT stop, avg(n) AS mean, stddev_samp(n) AS std, max(n) AS mx FROM sd GROUP BY stop) m ON q.stop = m.stop""",
)

# -- aggregations --------------------------------------------------------------------
QUERIES["top10_stops"] = sql(
    "v", "SELECT stop, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT day) AS active_days FROM v GROUP BY stop ORDER BY total DESC, stop LIMIT 10"
)
QUERIES["weekday_mean"] = sql(
    "totals",
    f"""SELECT CAST(dayofweek(day) + 1 AS INTEGER) AS weekday_number, {FR.format('any_value(day)')} AS weekday_name, count(*) AS days,
    {half_up('avg(total)', 0)} AS mean_total, CAST(sum(total) AS BIGINT) AS total FROM totals GROUP BY dayofweek(day)""",
)
QUERIES["stop_day"] = sql("sd", "SELECT stop, day, n, carrier, network, stop_code, zone_id FROM sd")
PIVOT = {
    "forfait_navigo": "Forfait Navigo",
    "imagine_r": "Imagine R",
    "amethyste": "Amethyste",
    "forfaits_courts": "Forfaits courts",
    "contrat_solidarité_transport": "Contrat Solidarité Transport",
    "autres_titres": "Autres titres",
    "non_defini": "NON DEFINI",
}
QUERIES["pivot_category"] = sql(
    "v",
    "SELECT stop, day, "
    + ", ".join(f"CAST(coalesce(sum(n) FILTER (category = '{c}'), 0) AS BIGINT) AS \"{name}\"" for name, c in PIVOT.items())
    + " FROM v GROUP BY stop, day",
)
QUERIES["undefined_rate"] = sql(
    "v",
    f"""SELECT stop, total, undefined, {half_up('undefined * 100.0 / total', 1)} AS undefined_pct FROM (SELECT stop, CAST(sum(n) AS BIGINT) AS total,
    CAST(sum(CASE WHEN category = 'NON DEFINI' THEN n ELSE 0 END) AS BIGINT) AS undefined FROM v GROUP BY stop)
    ORDER BY undefined_pct DESC, stop LIMIT 20""",
)
QUERIES["daily_totals"] = sql("totals", f"SELECT day, total, {EN.format('day')} AS weekday_name, isodow(day) >= 6 AS is_weekend FROM totals")
QUERIES["max_daily_total"] = sql("daily", "SELECT max(n) AS max_total FROM daily WHERE stop = 'NATION_3'")
QUERIES["scalar_checks"] = sql(
    "v",
    """SELECT (SELECT CAST(sum(n) AS BIGINT) FROM v WHERE stop = 'NATION_3' AND day = DATE '1998-07-14') AS total, (SELECT max(day) FROM v) AS last_day""",
)
QUERIES["category_share"] = sql(
    "v",
    f"""SELECT category, total, {r('round_even(total * 100.0 / sum(total) OVER (), 1)')} AS pct
    FROM (SELECT category, CAST(sum(n) AS BIGINT) AS total FROM v GROUP BY category)""",
)
QUERIES["category_share_month"] = sql(
    "v",
    f"""SELECT CAST(m AS INTEGER) AS month, month_name, category, total, {r('round_even(total * 100.0 / sum(total) OVER (PARTITION BY m), 1)')} AS pct
    FROM (SELECT month(day) AS m, strftime(day, '%B') AS month_name, category, CAST(sum(n) AS BIGINT) AS total FROM v GROUP BY ALL)""",
)
QUERIES["monthly_stats"] = sql(
    "totals",
    f"""SELECT CAST(month(day) AS INTEGER) AS month, strftime(day, '%B %Y') AS month_name, {r('avg(total)')} AS mean_total,
    CAST(sum(total) AS BIGINT) AS total, count(*) AS days FROM totals GROUP BY ALL""",
)
QUERIES["week_weekend_ratio"] = sql(
    "totals",
    f"""SELECT {r('w')} AS week_mean, {r('e')} AS weekend_mean, {r('w / e')} AS ratio FROM (SELECT avg(m) FILTER (d < 6) AS w, avg(m) FILTER (d >= 6) AS e
    FROM (SELECT isodow(day) AS d, avg(total) AS m FROM totals GROUP BY isodow(day)))""",
)
QUERIES["category_by_day"] = sql("v", "SELECT day, category, CAST(sum(n) AS BIGINT) AS total FROM v GROUP BY day, category")
_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
QUERIES["stop_weekday_heatmap"] = sql(
    "vs",
    "SELECT stop, " + ", ".join(f"round(d{i} / greatest(d0, d1, d2, d3, d4, d5, d6), 6) AS {d}" for i, d in enumerate(_DAYS))
    + " FROM (SELECT stop, sum(n) AS t, " + ", ".join(f"sum(n) FILTER (isodow(day) = {i + 1}) AS d{i}" for i in range(7))
    + " FROM vs GROUP BY stop ORDER BY t DESC, stop LIMIT 50)",
)
QUERIES["describe_counts"] = sql(
    "v",
    f"""SELECT statistic, {r('value')} AS value FROM (SELECT unnest(['count','mean','std','min','25%','50%','75%','max']) AS statistic,
    unnest([CAST(count(n) AS DOUBLE), avg(n), stddev_samp(n), min(n), quantile_cont(n, 0.25), quantile_cont(n, 0.5), quantile_cont(n, 0.75), max(n)]) AS value FROM v)""",
)
QUERIES["null_profile"] = sql(
    "sub",
    " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(*) - count({c}) AS nulls, {half_up(f"(count(*) - count({c})) * 100.0 / count(*)", 2)} AS percent FROM sub'
        for c in ["seq", *V_COLUMNS.split(", ")]
    ),
)
QUERIES["duplicate_rows"] = sql(
    "v", f"SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates FROM (SELECT {V_COLUMNS}, count(*) AS c FROM v GROUP BY {V_COLUMNS})"
)
QUERIES["active_days"] = sql(
    "vs",
    f"""SELECT statistic, {r('value')} AS value FROM (SELECT unnest(['count','mean','std','min','25%','50%','75%','max']) AS statistic,
    unnest([CAST(count(a) AS DOUBLE), avg(a), stddev_samp(a), min(a), quantile_cont(a, 0.25), quantile_cont(a, 0.5), quantile_cont(a, 0.75), max(a)]) AS value
    FROM (SELECT count(DISTINCT day) AS a FROM vs GROUP BY stop))""",
)
QUERIES["defined_split"] = sql(
    "v",
    f"""SELECT is_defined, rows, volume, {r('round_even(rows * 100.0 / sum(rows) OVER (), 2)')} AS row_pct
    FROM (SELECT category <> 'NON DEFINI' AS is_defined, count(*) AS rows, CAST(sum(n) AS BIGINT) AS volume FROM v GROUP BY 1)""",
)
QUERIES["flag_effect"] = sql(
    "feat",
    " UNION ALL ".join(
        f"SELECT '{f}' AS flag, {f} AS \"on\", {r('avg(n)')} AS mean_n, count(*) AS rows FROM feat GROUP BY {f}"
        for f in ["is_weekend", "is_vacation", "is_holiday"]
    ),
)
QUERIES["lag_correlation"] = sql(
    "feat",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'corr(n, {c})', 4)} AS correlation FROM feat" for c in ["lag1", "lag7", "mean7", "std7"]),
)
QUERIES["mean_congestion_top20"] = sql(
    "feat", f"SELECT stop, {r('avg(congestion)')} AS mean_congestion FROM feat GROUP BY stop ORDER BY avg(congestion) DESC, stop LIMIT 20"
)
QUERIES["stop_stats"] = sql(
    "sd",
    f"""SELECT stop, count(DISTINCT day) AS days, {r('round_even(avg(n), 0)')} AS mean, {r('round_even(median(n), 0)')} AS median, min(n) AS min, max(n) AS max,
    CAST(sum(n) AS BIGINT) AS total, min(day) AS first_day, max(day) AS last_day FROM sd GROUP BY stop""",
)
QUERIES["stop_moments"] = sql(
    "sd", f"SELECT stop, {r('avg(n)')} AS mean, {r('stddev_samp(n)', 4)} AS std, max(n) AS max, min(n) AS min FROM sd GROUP BY stop"
)
QUERIES["stop_profile"] = sql("prof", "SELECT stop, volume, " + ", ".join(f"{r(c)} AS {c}" for c in PROFILE_MEASURES if c != "volume") + " FROM prof")
QUERIES["cluster_summary"] = sql(
    "prof names5",
    f"""SELECT p.cluster, any_value(n.profile) AS profile, count(*) AS stops, {r('round_even(avg(p.volume), 0)')} AS mean_volume,
    array_to_string(list(p.stop ORDER BY p.volume DESC, p.stop)[1:5], ', ') AS examples FROM prof p JOIN names5 n ON p.cluster = n.cluster GROUP BY p.cluster""",
)
QUERIES["cluster_means_scaled"] = sql(
    "means",
    "SELECT cluster, size, " + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in PROFILE_MEASURES) + " FROM means",
)


def _histogram(relation: str, column: str, bins: int) -> str:
    return f"""SELECT b AS bin, {r(f'lo + b * (hi - lo) / {bins}')} AS low, {r(f'lo + (b + 1) * (hi - lo) / {bins}')} AS high, coalesce(c.rows, 0) AS rows
    FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS b) s CROSS JOIN (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {relation}) e
    LEFT JOIN (SELECT CAST(least(floor(({column} - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS k, count(*) AS rows FROM {relation},
      (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {relation}) e GROUP BY 1) c ON c.k = s.b"""


QUERIES["histogram"] = sql(
    "v z vs",
    " UNION ALL ".join(
        f"SELECT '{column}' AS measure, * FROM ({_histogram(relation, column, bins)})"
        for relation, column, bins in [
            ("v", "n", 100),
            ("(SELECT count(DISTINCT day) AS active_days FROM vs GROUP BY stop)", "active_days", 30),
            ("z", "z", 100),
            ("z", "congestion", 50),
        ]
    ),
)
QUERIES["forecast_eligibility"] = sql(
    "per_stop",
    """SELECT count(*) AS stops, count(*) FILTER (days >= 180 AND mean >= 25) AS eligible, count(*) FILTER (days < 180) AS too_short,
    count(*) FILTER (days >= 180 AND mean < 25) AS too_quiet, CAST(floor(median(days)) AS BIGINT) AS median_days,
    CAST(floor(median(mean)) AS BIGINT) AS median_mean FROM per_stop""",
)
QUERIES["anomaly_by_weekday"] = sql(
    "z",
    f"""SELECT 'weekday' AS kind, label, coalesce(rows, 0) AS rows FROM (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS label) w
    LEFT JOIN (SELECT {EN.format('day')} AS label, count(*) AS rows FROM z WHERE abs(z) > 3 GROUP BY 1) c USING (label)
    UNION ALL SELECT 'day type', unnest(['holiday', 'weekend', 'vacation', 'ordinary']), unnest([h, e, va, greatest(c - h - e, 0)])
    FROM (SELECT count(*) AS c, count(*) FILTER (is_holiday) AS h, count(*) FILTER (is_weekend) AS e, count(*) FILTER (is_vacation) AS va FROM z WHERE abs(z) > 3)""",
)
QUERIES["regression_metrics"] = sql(
    "feat",
    f"""SELECT {r('sqrt(avg((n - lag7) * (n - lag7)))')} AS rmse, {r('avg(abs(n - lag7))')} AS mae,
    {r('1 - sum((n - lag7) * (n - lag7)) / (var_pop(n) * count(*))')} AS r2 FROM feat""",
)
QUERIES["list_stops"] = sql(
    "v",
    """SELECT kind, value, count(*) OVER (PARTITION BY kind) AS "values" FROM (SELECT DISTINCT 'stop' AS kind, stop AS value FROM v
    UNION ALL SELECT DISTINCT 'category', category FROM v)""",
)
QUERIES["data_range"] = sql("sd", "SELECT min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS days FROM sd WHERE stop = 'NATION_3'")
QUERIES["value_counts"] = sql(
    "feat cal_rows",
    """SELECT 'carrier' AS kind, carrier || '=' || CAST(carrier_index AS VARCHAR) AS value, count(*) AS rows FROM feat GROUP BY ALL
    UNION ALL SELECT 'calendar', type, count(*) FROM cal_rows GROUP BY ALL UNION ALL SELECT 'weekend', CAST(is_weekend AS VARCHAR), count(*) FROM feat GROUP BY ALL""",
)

# -- windows -----------------------------------------------------------------------------
QUERIES["week_over_week"] = sql(
    "v",
    f"""SELECT stop, day, n, n_lag7, {half_up('(n - n_lag7) * 100.0 / nullif(n_lag7, 0)', 1)} AS change_pct FROM (
    SELECT stop, day, CAST(sum(n) AS BIGINT) AS n, CAST(lag(sum(n), 7) OVER (PARTITION BY stop ORDER BY day) AS BIGINT) AS n_lag7 FROM v GROUP BY stop, day)""",
)
QUERIES["lag_features"] = sql("lagged", "SELECT stop, day, n, raw1 AS lag1, raw7 AS lag7 FROM lagged")
QUERIES["rolling_mean7"] = sql("lagged", f"SELECT stop, day, {r('mean7')} AS mean7 FROM lagged")
QUERIES["rolling_std7"] = sql("lagged", f"SELECT stop, day, {r('std7', 4)} AS std7 FROM lagged")
QUERIES["fill_group_median"] = sql(
    "lagged",
    """SELECT stop, day, coalesce(raw1, median(raw1) OVER (PARTITION BY stop)) AS lag1, coalesce(raw7, median(raw7) OVER (PARTITION BY stop)) AS lag7 FROM lagged""",
)
QUERIES["congestion_score"] = sql(
    "lagged", f"SELECT stop, day, {r('CASE WHEN max_n > 0 THEN round_even(n / max_n, 4) ELSE 0 END')} AS congestion FROM lagged"
)
QUERIES["zscore"] = sql("z", f"SELECT stop, day, {r('z')} AS z FROM z")
QUERIES["norm_and_gap"] = sql(
    "lagged",
    f"SELECT stop, day, {r('CASE WHEN max_n > 0 THEN n / max_n ELSE 0 END')} AS norm, {r('coalesce(n - mean7, 0)')} AS gap FROM lagged",
)
QUERIES["centered_mean7"] = sql(
    "totals",
    f"""SELECT day, total, {r('CASE WHEN count(*) OVER w = 7 THEN avg(total) OVER w END')} AS mean7 FROM totals
    WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
QUERIES["encode_carrier"] = sql("sd codes", "SELECT s.stop, s.day, s.carrier, c.carrier_index FROM sd s JOIN codes c ON s.carrier = c.carrier")
QUERIES["topk_per_group"] = sql(
    "prof",
    """SELECT cluster, stop, volume, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY volume DESC, stop) AS rank FROM prof)
    WHERE rank <= 4""",
)

# -- sorts and set operations ------------------------------------------------------------
QUERIES["top20_stops"] = sql(
    "vs",
    f"""SELECT stop, total, {r('round_even(total / 1000000.0, 2)')} AS millions FROM (SELECT stop, CAST(sum(n) AS BIGINT) AS total FROM vs GROUP BY stop)
    ORDER BY total DESC, stop LIMIT 20""",
)
QUERIES["busiest_quietest_days"] = sql(
    "totals",
    f"""SELECT day, {EN.format('day')} AS weekday_name, total, kind FROM ((SELECT *, 'busiest' AS kind FROM totals ORDER BY total DESC, day LIMIT 5)
    UNION ALL (SELECT *, 'quietest' AS kind FROM totals ORDER BY total, day LIMIT 5))""",
)
QUERIES["extreme_zscores"] = sql("z", f"SELECT stop, day, n, {r('z')} AS z FROM z ORDER BY round(abs(z), 9) DESC, stop, day LIMIT 10")
QUERIES["big_mid_small_sample"] = sql(
    "per_stop",
    f"""SELECT CASE WHEN p = 0 THEN 'big' WHEN p = c // 2 THEN 'middle' ELSE 'small' END AS size, stop, volume, days, {r('mean')} AS mean FROM (
    SELECT *, row_number() OVER (ORDER BY volume DESC, stop) - 1 AS p, count(*) OVER () AS c FROM per_stop WHERE days >= 180 AND mean >= 25)
    WHERE p IN (0, c // 2, c - 1)""",
)
_FIRST = """row_number() OVER (PARTITION BY day, stop, category ORDER BY seq, carrier, network, stop_code, zone_id, n)"""
QUERIES["sort_load"] = sql("vq", f"SELECT seq, {V_COLUMNS} FROM vq")
QUERIES["union_quarters"] = sql(
    "v",
    " UNION ALL ".join(f"SELECT {V_COLUMNS}, 'T{q}' AS source FROM v WHERE quarter(day) = {q}" for q in range(1, 5))
    + f" UNION ALL SELECT {V_COLUMNS}, 'undated' AS source FROM v WHERE day IS NULL",
)
QUERIES["dedup_keep_first"] = sql("vq", f"SELECT seq, {V_COLUMNS} FROM (SELECT *, {_FIRST} AS p FROM vq) WHERE p = 1")
QUERIES["dedup_report"] = sql(
    "vq",
    f"""SELECT count(*) AS rows_read, count(*) FILTER (p = 1) AS rows_kept, count(*) FILTER (p > 1) AS rows_dropped,
    CAST(sum(n) FILTER (p > 1) AS BIGINT) AS volume_dropped FROM (SELECT *, {_FIRST} AS p FROM vq)""",
)

# -- modelling with an exact answer --------------------------------------------------------
QUERIES["feature_pipeline"] = sql("feat", f"SELECT {FEATURE_COLUMNS} FROM feat")
QUERIES["refreshed_features"] = QUERIES["feature_pipeline"].replace(CTES["v"], f"SELECT DISTINCT * FROM ({CTES['vq']})")
QUERIES["temporal_split"] = sql(
    "feat",
    """SELECT CASE WHEN f.day < cut THEN 'train' ELSE 'test' END AS side, count(*) AS rows, count(DISTINCT f.day) AS days, min(f.day) AS first_day, max(f.day) AS last_day
    FROM feat f, (SELECT day AS cut FROM (SELECT day, row_number() OVER (ORDER BY day) AS p, count(*) OVER () AS c FROM (SELECT DISTINCT day FROM feat)) WHERE p = floor(c * 0.8) + 1) e
    GROUP BY 1""",
)
_F = ["weekday", "is_weekend", "month", "iso_week", "is_holiday", "is_vacation", "lag1", "lag7", "mean7", "std7", "congestion", "carrier_index"]
QUERIES["impute_train_median"] = sql(
    "feat",
    "SELECT feature, round(median, 6) + 0.0 AS median FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in _F)
    + "]) AS feature, unnest(["
    + ", ".join(f"CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE)" for c in _F)
    + """]) AS median FROM feat WHERE day < (SELECT day FROM (SELECT day, row_number() OVER (ORDER BY day) AS p, count(*) OVER () AS c
    FROM (SELECT DISTINCT day FROM feat)) WHERE p = floor(c * 0.8) + 1))""",
)
def _products(columns: list[str], source: str) -> str:
    """Rows of the matrix of sums of products of columns, as a list of lists."""
    return "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in columns) + "]" for a in columns) + f"]::DOUBLE[][] AS m FROM {source}"


#: Least squares: centred sums of products, then elimination, a column a round.
_X = [f"x{i}" for i in range(len(_F))]
QUERIES["linear_model"] = sql(
    "feat",
    "SELECT 1",
).removesuffix("\nSELECT 1").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
cut AS (SELECT day AS cut FROM (SELECT day, row_number() OVER (ORDER BY day) AS p, count(*) OVER () AS c FROM (SELECT DISTINCT day FROM feat)) WHERE p = floor(c * 0.8) + 1),
filled AS (SELECT {", ".join(f"coalesce(CAST({c} AS DOUBLE), CAST(median(CAST({c} AS DOUBLE)) OVER () AS DOUBLE)) AS {x}" for x, c in zip(_X, _F))}, CAST(n AS DOUBLE) AS y
  FROM feat, cut WHERE day < cut),
centred AS (SELECT {", ".join(f"{x} - avg({x}) OVER () AS {x}" for x in [*_X, "y"])} FROM filled),
gram AS (SELECT {_products([*_X, "y"], "centred")}),
solved AS (
  SELECT 1 AS k, m FROM gram
  UNION ALL
  SELECT k + 1, list_transform(m, lambda a, i: CASE WHEN i = k THEN list_transform(a, lambda v: v / a[k])
    ELSE list_transform(a, lambda v, j: v - a[k] / m[k][k] * m[k][j]) END)
  FROM solved WHERE k <= {len(_F)}
),
answer AS (SELECT list_transform(m[1:{len(_F)}], lambda a: a[{len(_F) + 1}]) AS b FROM solved WHERE k = {len(_F) + 1}),
means AS (SELECT [{", ".join(f"avg({x})" for x in _X)}] AS x, avg(y) AS y FROM filled)
SELECT feature, round(coefficient, 6) + 0.0 AS coefficient FROM (
  SELECT unnest([{", ".join(f"'{c}'" for c in _F)}, 'intercept']) AS feature, unnest(list_append(b, y - list_inner_product(b, x))) AS coefficient FROM answer, means)"""

#: Two components: squaring the matrix leaves the direction of greatest variance; taken out, squaring gives the next.
_S = [f"{c}_scaled" for c in PROFILE_MEASURES]


def _squared(name: str, start: str) -> str:
    entry = "list_transform(m, lambda q: list_inner_product(p, q) / size)"
    size = "list_sum(list_transform(m, lambda p: list_inner_product(p, p)))"
    return f"""{name}_powers AS (
  SELECT 1 AS k, m FROM {start}
  UNION ALL
  SELECT k + 1, list_transform(m, lambda p: {entry}) FROM (SELECT k, m, {size} AS size FROM {name}_powers WHERE k <= 30)
),
{name} AS (SELECT list_transform(a, lambda x: x / sqrt(list_inner_product(a, a))) AS v FROM (
  SELECT m[list_position(d, list_max(d))] AS a FROM (SELECT m, list_transform(m, lambda p, i: p[i]) AS d FROM {name}_powers WHERE k = 31)))"""


QUERIES["pca2"] = sql("scaled", "SELECT 1").removesuffix("\nSELECT 1").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
gram AS (SELECT {_products([f"({c} - mean_{c})" for c in _S], "scaled, (SELECT " + ", ".join(f"avg({c}) AS mean_{c}" for c in _S) + " FROM scaled)")}),
{_squared("first", "gram")},
one AS (SELECT v, list_inner_product(v, list_transform(m, lambda p: list_inner_product(p, v))) AS l, list_sum(list_transform(m, lambda p, i: p[i])) AS total FROM first, gram),
rest AS (SELECT list_transform(m, lambda p, i: list_transform(p, lambda x, j: x - l * v[i] * v[j])) AS m FROM gram, one),
{_squared("second", "rest")},
two AS (SELECT v, list_inner_product(v, list_transform(m, lambda p: list_inner_product(p, v))) AS l FROM second, gram)
SELECT stop, {r("list_inner_product(x, one.v)")} AS pca1, {r("list_inner_product(x, two.v)")} AS pca2, {r("one.l / total")} AS share1, {r("two.l / total")} AS share2
FROM (SELECT stop, [{", ".join(_S)}] AS x FROM scaled), one, two"""
QUERIES["short_term_features"] = sql(
    "looked cal codes",
    f"""SELECT l.stop, l.day, CAST(isodow(l.day) - 1 AS INTEGER) AS weekday, isodow(l.day) >= 6 AS is_weekend, CAST(month(l.day) AS INTEGER) AS month,
    CAST(week(l.day) AS INTEGER) AS iso_week, coalesce(cal.is_holiday, false) AS is_holiday, coalesce(cal.is_vacation, false) AS is_vacation,
    {r('lag1')} AS lag1, {r('lag7')} AS lag7, {r('coalesce(mean7, lag7)')} AS mean7, {r('coalesce(std7, 0)', 4)} AS std7,
    {r('CASE WHEN max_n > 0 THEN round_even(coalesce(n_same, mean7, lag7) / max_n, 4) ELSE 0 END')} AS congestion, coalesce(codes.carrier_index, 0) AS carrier_index
    FROM looked l LEFT JOIN cal ON l.day = cal.day LEFT JOIN codes ON l.carrier = codes.carrier""",
)
QUERIES["standardize"] = sql("scaled", "SELECT stop, " + ", ".join(f"{r(f'{c}_scaled')} AS {c}_scaled" for c in PROFILE_MEASURES) + " FROM scaled")
_D = lambda a, b: " + ".join(f"({a.format(c)} - {b.format(c)}) * ({a.format(c)} - {b.format(c)})" for c in PROFILE_MEASURES)
QUERIES["cluster_quality"] = sql(
    "scaled centers",
    f"""SELECT {r('sil')} AS silhouette, {r('db')} AS davies_bouldin, {r('ch')} AS calinski_harabasz, {r('inertia')} AS inertia FROM
    (SELECT avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) AS sil FROM (
      SELECT stop, max(CASE WHEN own THEN total / greatest(members - 1, 1) END) AS a, min(CASE WHEN NOT own THEN total / members END) AS b, max(CASE WHEN own THEN members END) AS size FROM (
        SELECT p.stop, p.cluster = q.cluster AS own, q.cluster, sum({_D('p.{}_scaled', 'q.{}_scaled')}) AS total, count(*) AS members FROM scaled p, scaled q GROUP BY p.stop, p.cluster, q.cluster)
      GROUP BY stop)),
    (SELECT avg(worst) AS db FROM (SELECT x.cluster, max((x.spread + y.spread) / sqrt({_D('x.{}_center', 'y.{}_center')})) AS worst
      FROM (SELECT c.*, s.spread FROM centers c JOIN (SELECT p.cluster, avg(sqrt({_D('p.{}_scaled', 'k.{}_center')})) AS spread FROM scaled p JOIN centers k ON p.cluster = k.cluster GROUP BY p.cluster) s ON c.cluster = s.cluster) x,
           (SELECT c.*, s.spread FROM centers c JOIN (SELECT p.cluster, avg(sqrt({_D('p.{}_scaled', 'k.{}_center')})) AS spread FROM scaled p JOIN centers k ON p.cluster = k.cluster GROUP BY p.cluster) s ON c.cluster = s.cluster) y
      WHERE x.cluster <> y.cluster GROUP BY x.cluster)),
    (SELECT sum({_D('p.{}_scaled', 'k.{}_center')}) AS inertia FROM scaled p JOIN centers k ON p.cluster = k.cluster),
    (SELECT (bss / (k - 1)) / (wss / (rows - k)) AS ch FROM (SELECT sum({_D('k.{}_center', 'w.{}')}) AS bss, sum({_D('p.{}_scaled', 'k.{}_center')}) AS wss,
      count(*) AS rows, count(DISTINCT p.cluster) AS k FROM scaled p JOIN centers k ON p.cluster = k.cluster,
      (SELECT {', '.join(f'avg({c}_scaled) AS {c}' for c in PROFILE_MEASURES)} FROM scaled) w))""",
)
QUERIES["name_clusters"] = sql(
    "means names5",
    f"""SELECT n.cluster, n.profile AS profile_k5, CASE WHEN m.volume = (SELECT max(volume) FROM means) THEN '{PROFILE_NAMES_K2["hub"]}'
    ELSE '{PROFILE_NAMES_K2["standard"]}' END AS profile_k2 FROM names5 n JOIN means m ON n.cluster = m.cluster""",
)
QUERIES["holiday_frame"] = sql("cal_rows", "SELECT 'ferie' AS holiday, day, 0 AS lower_window, 0 AS upper_window FROM cal_rows WHERE type = 'ferie'")
QUERIES["detect_zscore"] = sql(
    "req sd",
    f"""SELECT request_id, stop, n, status, {r('round_even(z, 2)')} AS z, CASE WHEN z IS NULL THEN NULL WHEN z < -2 THEN 'low' WHEN z > 2 THEN 'high' ELSE 'normal' END AS side,
    {r('round_even(mean, 0)')} AS mean, {r('n - recent_mean')} AS gap FROM (
    SELECT q.request_id, q.stop, q.n, CASE WHEN q.stop IS NULL THEN 'stop missing' WHEN m.stop IS NULL THEN 'unknown stop' ELSE 'ok' END AS status, m.mean, m.recent_mean,
      CASE WHEN m.stop IS NULL THEN NULL WHEN m.std > 0 THEN (q.n - m.mean) / m.std ELSE 0 END AS z FROM req q LEFT JOIN (
      SELECT stop, avg(n) AS mean, stddev_samp(n) AS std, avg(n) FILTER (newest <= 7) AS recent_mean
      FROM (SELECT *, row_number() OVER (PARTITION BY stop ORDER BY day DESC) AS newest FROM sd) GROUP BY stop) m ON q.stop = m.stop)""",
)
_CUT = "DATE '1999-01-01'"
_SPLIT = """(SELECT day FROM (SELECT day, row_number() OVER (ORDER BY day) AS p, count(*) OVER () AS c FROM (SELECT DISTINCT day FROM feat))
    WHERE p = floor(c * 0.8) + 1)"""
QUERIES["model_store"] = sql(
    "feat",
    f"""SELECT carrier, carrier_index, count(*) AS rows, CAST(0 AS DOUBLE) AS largest_difference FROM feat
    WHERE day >= {_SPLIT} GROUP BY carrier, carrier_index""",
)
QUERIES["run_metrics_table"] = sql(
    "feat",
    f"""SELECT 'naive-' || side AS run, 'naive' AS model, kind, name, round(metric, 6) + 0.0 AS metric, param FROM (
    SELECT side, unnest(['metric', 'metric', 'metric', 'param', 'param', 'param']) AS kind,
      unnest(['rmse', 'mae', 'r2', 'features', 'split_day', 'side']) AS name,
      unnest([sqrt(avg((n - lag7) * (n - lag7))), avg(abs(n - lag7)), 1 - sum((n - lag7) * (n - lag7)) / (var_pop(n) * count(*)), NULL, NULL, NULL]) AS metric,
      unnest([NULL, NULL, NULL, '1', CAST(any_value(cut) AS VARCHAR), side]) AS param
    FROM (SELECT *, {_SPLIT} AS cut, CASE WHEN day < {_SPLIT} THEN 'train' ELSE 'test' END AS side FROM feat) GROUP BY side)""",
)
QUERIES["backtest_metrics"] = sql(
    "sd",
    f"""SELECT stop, count(*) AS held_out, {r('avg(abs(n - yhat))')} AS mae, {r('avg(abs(n - yhat) / n) FILTER (n > 0) * 100')} AS mape FROM (
    SELECT stop, n, age, max(CASE WHEN age = 31 THEN n END) OVER (PARTITION BY stop) AS yhat
    FROM (SELECT *, row_number() OVER (PARTITION BY stop ORDER BY day DESC) AS age FROM sd)) WHERE age <= 30 GROUP BY stop""",
)
QUERIES["backtest_verdict"] = (
    f"SELECT count(*) AS stops, {r('median(mape)')} AS median_mape, median(mape) < 20 AS good FROM ({QUERIES['backtest_metrics']}) WHERE mape IS NOT NULL"
)
QUERIES["forecast_refusals"] = sql(
    "req per_stop",
    """SELECT * FROM (SELECT stop, CASE WHEN days IS NULL THEN 'unknown stop' WHEN days < 180 THEN 'history too short' WHEN mean < 37 THEN 'traffic too low' END AS reason
    FROM (SELECT DISTINCT stop FROM req) LEFT JOIN per_stop USING (stop)) WHERE reason IS NOT NULL""",
)
QUERIES["residuals"] = sql(
    "feat",
    f"""SELECT stop, day, CAST(n AS BIGINT) AS n, {r('lag7')} AS prediction, {r('n - lag7')} AS residual FROM feat
    WHERE day >= (SELECT day FROM (SELECT day, row_number() OVER (ORDER BY day) AS p, count(*) OVER () AS c FROM (SELECT DISTINCT day FROM feat)) WHERE p = floor(c * 0.8) + 1)""",
)

#: The literal forest: lengths of both paths, their mean against that of an unsuccessful search among four.
CTES["labelled"] = """SELECT *, score < -0.55 AS is_isolated FROM (SELECT *, -power(2, -((first_path + second_path) / 2) / (2 * (ln(3) + 0.5772156649015329) - 1.5)) AS score FROM (
    SELECT *, CASE WHEN z <= 1.5 THEN 2.0 WHEN norm <= 0.8 THEN 1.5 ELSE 1.0 END::DOUBLE AS first_path,
      CASE WHEN gap > 10 THEN 1.1 WHEN z <= -1 THEN 1.2 ELSE 2.4 END::DOUBLE AS second_path
    FROM (SELECT *, CASE WHEN max(n) OVER (PARTITION BY stop) > 0 THEN n / max(n) OVER (PARTITION BY stop) ELSE 0 END AS norm, coalesce(n - mean7, 0) AS gap FROM z)))"""
NEEDS["labelled"] = ["z"]
QUERIES["stored_detector"] = sql("labelled", f"SELECT stop, day, n, {r('score')} AS score, is_isolated FROM labelled")
QUERIES["literal_detector_agreement"] = sql(
    "labelled",
    """SELECT detector, count(*) AS rows FROM (SELECT CASE WHEN abs(z) > 1.8 AND is_isolated THEN 'both' WHEN abs(z) > 1.8 THEN 'z-score only'
    WHEN is_isolated THEN 'forest only' END AS detector FROM labelled) WHERE detector IS NOT NULL GROUP BY detector""",
)
QUERIES["literal_anomaly_summary"] = sql(
    "labelled",
    f"""SELECT count(*) AS rows, count_if(is_isolated)::BIGINT AS isolated, count_if(abs(z) > 1.8)::BIGINT AS beyond_z, count_if(is_isolated AND abs(z) > 1.8)::BIGINT AS consensus,
    {r('avg(is_weekend::INTEGER) FILTER (is_isolated) * 100')} AS weekend_pct, {r('avg(is_holiday::INTEGER) FILTER (is_isolated) * 100')} AS holiday_pct FROM labelled""",
)
QUERIES["literal_lowest_scores"] = sql("labelled", f"SELECT stop, day, {r('score')} AS score FROM labelled ORDER BY labelled.score, stop, day LIMIT 10")
QUERIES["stored_segments"] = sql(
    "scaled",
    "SELECT stop, nearest AS stored_cluster, 'Cluster ' || nearest AS profile, nearest AS cluster FROM (SELECT stop, CASE WHEN "
    + " <= ".join(
        "(" + " + ".join(f"power({c}_scaled - ({x}), 2)" for c, x in zip(PROFILE_MEASURES, centre)) + ")"
        for centre in ([0.5, 0.4, -0.2, 0.6, -0.3], [-0.6, -0.5, 0.3, -0.7, 0.2])
    )
    + " THEN 0 ELSE 1 END AS nearest FROM scaled)",
)


def _long(relation: str, columns: list[str], side: str, digits: int = 9) -> str:
    """(feature, is_ref, value) of a relation."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {side} AS is_ref, round(CAST({c} AS DOUBLE), {digits}) AS value FROM {relation}" for c in columns
    )


def _distances(long: str) -> str:
    return f"""SELECT w.feature, w.reference_rows, w.current_rows, w.move / greatest(s.spread, 0.001) AS wasserstein, w.ks, w.js FROM (
    SELECT feature, CAST(max(rt) AS BIGINT) AS reference_rows, CAST(max(ct) AS BIGINT) AS current_rows,
      sum(abs(rc / rt - cc / ct) * (coalesce(nx, value) - value)) AS move, max(abs(rc / rt - cc / ct)) AS ks,
      sqrt(greatest(sum((CASE WHEN ref > 0 THEN (ref / rt) * ln((ref / rt) / ((ref / rt + cur / ct) / 2)) ELSE 0 END
        + CASE WHEN cur > 0 THEN (cur / ct) * ln((cur / ct) / ((ref / rt + cur / ct) / 2)) ELSE 0 END) / 2), 0)) AS js
    FROM (SELECT feature, value, ref, cur, sum(ref) OVER w AS rc, sum(cur) OVER w AS cc, sum(ref) OVER (PARTITION BY feature) AS rt,
        sum(cur) OVER (PARTITION BY feature) AS ct, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nx
      FROM (SELECT feature, value, count(*) FILTER (is_ref) AS ref, count(*) FILTER (NOT is_ref) AS cur FROM ({long}) GROUP BY feature, value)
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)) GROUP BY feature) w
    JOIN (SELECT feature, stddev_pop(value) AS spread FROM ({long}) WHERE is_ref GROUP BY feature) s ON w.feature = s.feature"""


_TRAFFIC = ["n", "weekday", "is_weekend", "month", "lag1", "lag7", "mean7", "std7", "congestion"]
_FEAT_LONG = _long("feat", _TRAFFIC, f"day < {_CUT}")
QUERIES["drift_distances"] = sql(
    "feat",
    f"""SELECT feature, reference_rows, current_rows, {r('wasserstein')} AS wasserstein, {r('ks')} AS ks, {r('js')} AS js
    FROM ({_distances(_FEAT_LONG)})""",
)
_HALF_PROFILE = """SELECT stop, {side} AS is_ref, weekday_mean, weekend_mean, CASE WHEN weekday_mean > 0 THEN weekend_mean / weekday_mean ELSE 0 END AS weekend_ratio,
    volume, coalesce(CASE WHEN m > 0 THEN sd / m ELSE 0 END, 0) AS variation FROM (
    SELECT stop, coalesce(avg(n) FILTER (isodow(day) < 6), 0) AS weekday_mean, coalesce(avg(n) FILTER (isodow(day) >= 6), 0) AS weekend_mean,
      CAST(sum(n) AS BIGINT) AS volume, avg(n) AS m, stddev_samp(n) AS sd FROM sds WHERE {where} GROUP BY stop)"""
_PROFILES = f"({_HALF_PROFILE.format(side='true', where=f'day < {_CUT}')} UNION ALL {_HALF_PROFILE.format(side='false', where=f'day >= {_CUT}')})"
_VERDICT = """SELECT feature, CASE WHEN feature = 'is_weekend' THEN js > 0.1 WHEN {named} THEN wasserstein > 0.1 ELSE p < 0.05 END AS drifted FROM (
    SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE greatest(least(2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam * lam))), 1), 0) END AS p
    FROM (SELECT *, (sz + 0.12 + 0.11 / sz) * ks AS lam FROM (SELECT *, sqrt(reference_rows * current_rows / (reference_rows + current_rows)) AS sz FROM ({distances}))))"""
_FEAT_VERDICT = _VERDICT.format(distances=_distances(_FEAT_LONG), named="true")
_PROFILE_VERDICT = _VERDICT.format(distances=_distances(_long(_PROFILES, PROFILE_MEASURES, "is_ref", 12)), named="false")


def _report(name: str, verdicts: str, where: str = "true") -> str:
    return f"""SELECT '{name}' AS model, CASE WHEN count(*) FILTER (drifted) / count(*) > 0.3 THEN 'DRIFT' ELSE 'OK' END AS status,
    count(*) FILTER (drifted) AS drifted, count(*) AS features, {r('count(*) FILTER (drifted) / count(*)')} AS share FROM ({verdicts}) WHERE {where}"""


QUERIES["drift_report"] = sql(
    "feat sds",
    " UNION ALL ".join(
        [
            _report("traffic", _FEAT_VERDICT),
            _report("anomaly", _FEAT_VERDICT, "feature IN ('n', 'mean7', 'std7', 'congestion')"),
            _report("clustering", _PROFILE_VERDICT),
            "SELECT 'missing', 'REFERENCE MISSING', NULL, NULL, NULL",
        ]
    ),
)
QUERIES["density_clusters"] = sql(
    "scaled",
    f"""SELECT stop, CAST(coalesce(min(cluster), -1) AS INTEGER) AS cluster FROM (
    WITH near AS (SELECT p.stop AS a, q.stop AS b FROM scaled p, scaled q WHERE {_D('p.{}_scaled', 'q.{}_scaled')} <= 0.8 * 0.8),
    core AS (SELECT a FROM near GROUP BY a HAVING count(*) >= 5),
    reach AS (WITH RECURSIVE walk AS (SELECT a, a AS b FROM core UNION SELECT w.a, n.b FROM walk w JOIN near n ON w.b = n.a WHERE n.b IN (SELECT a FROM core)) SELECT * FROM walk),
    numbered AS (SELECT a, dense_rank() OVER (ORDER BY first) - 1 AS cluster FROM (SELECT a, min(b) AS first FROM reach GROUP BY a))
    SELECT s.stop, k.cluster FROM scaled s LEFT JOIN (SELECT n.a AS stop, m.cluster FROM near n JOIN numbered m ON n.b = m.a) k ON s.stop = k.stop) GROUP BY stop""",
)
QUERIES["incremental_refresh"] = """SELECT CAST(user_id AS VARCHAR) AS stop, count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS days
  FROM (SELECT DISTINCT event_id, ts, user_id, event_type FROM events) GROUP BY user_id"""
