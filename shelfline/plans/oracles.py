"""The same results in DuckDB SQL, over views of the test tables."""

from __future__ import annotations

from shelfline import fixed_values as fv
from shelfline.operators.forecast import BASELINE_VERSION
from shelfline.operators.models import FOLDS, INDEXED, PRIOR_ROWS
from shelfline.operators.textjobs import intent_expressions
from shelfline.plans.queries import PROFILES
from shelfline.schema import CANONICAL
from shelfline.sources import testtables as T

ORACLES: dict[str, str] = {}


def _values(rows) -> str:
    def cell(v):
        return f"'{v}'" if isinstance(v, str) else (f"{v!r}::DOUBLE" if isinstance(v, float) else str(v))
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def rnd(x: str, places: int = 4) -> str:
    return f"(floor(({x}) * 1e{places} + 5e-1) / 1e{places})"


def avg(x: str, places: int = 0) -> str:
    mean = f"CAST(sum({x}) AS DOUBLE) / count({x})"
    return f"({mean} / 1e{places})" if places else f"({mean})"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def band(hour: str) -> str:
    whens = " ".join(f"WHEN {hour} BETWEEN {a} AND {b} THEN {f!r}::DOUBLE" for a, b, f in fv.TIME_BANDS)
    return f"CASE {whens} ELSE 1::DOUBLE END"


LISTINGS = f"""
l0 AS (
  SELECT *, CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS INTEGER) AS hour_of_day,
    CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS mrp_cents,
    CAST(round(l_discount * 100, 0) AS INTEGER) AS discount,
    CAST(greatest(0, (l_partkey * 31 + l_orderkey * 17 + l_linenumber) % 50 - 5) AS INTEGER) AS stock_remaining
  FROM lineitem JOIN part ON l_partkey = p_partkey),
l1 AS (
  SELECT *, CAST(floor(mrp_cents * (100 - discount) / 1e2) AS BIGINT) AS eff_cents, stock_remaining > 0 AS in_stock,
    l_shipdate + to_hours(hour_of_day) + to_minutes(CAST(15 * ((l_orderkey + l_partkey) % 4) AS BIGINT)) AS snapshot_time
  FROM l0),
l2 AS (
  SELECT *, CASE WHEN in_stock THEN least(CAST(l_quantity AS INTEGER), stock_remaining) ELSE 0 END AS units_ordered
  FROM l1),
fact AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS record_id,
    snapshot_time, CAST(snapshot_time AS DATE) AS date, '{T.LOCATION}' AS location, p_name AS product_name,
    split_part(p_name, ' ', 1) AS category, CAST(p_size AS INTEGER) AS pack_size,
    CASE WHEN p_partkey % 2 = 0 THEN 'g' ELSE 'ml' END AS pack_unit,
    CASE l_suppkey % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS platform,
    mrp_cents, discount, eff_cents, mrp_cents / 1e2 AS mrp, CAST(discount AS DOUBLE) AS discount_pct,
    eff_cents / 1e2 AS effective_price, {rnd('eff_cents / 1e2 / p_size')} AS price_per_unit,
    CAST(floor(eff_cents / 1e2 / p_size * 1e4 + 5e-1) AS BIGINT) AS ppu_e4,
    in_stock, stock_remaining, units_ordered, eff_cents * units_ordered AS rev_cents,
    eff_cents * units_ordered / 1e2 AS revenue_inr,
    CAST(7 + (l_orderkey * 13 + l_suppkey * 7) % 54 AS INTEGER) AS delivery_minutes,
    (10 + (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 41) AS rating_x10,
    (10 + (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 41) / 1e1 AS rating, hour_of_day,
    dayofweek(snapshot_time) IN (0, 6) AS is_weekend, ({band('hour_of_day')}) > 1.1::DOUBLE AS is_peak_hour,
    CAST(month(snapshot_time) AS INTEGER) AS month
  FROM l2)"""

_FESTIVALS = _values([(i, m, d, dm, pm, n) for i, (m, d, dm, pm, n) in enumerate(fv.FESTIVALS)])
_SEASONS = _values([(p, m + 1, f) for p, months in T.SEASONS.items() for m, f in enumerate(months)])

ENRICHED = LISTINGS + f""",
weather(w_month, weather, rain_probability, rain_delay) AS (VALUES {_values(fv.WEATHER_BY_MONTH)}),
seasons(s_product, s_month, s_factor) AS (VALUES {_SEASONS}),
festivals(nr, f_month, f_day, f_demand, f_price, f_days) AS (VALUES {_FESTIVALS}),
hits AS (
  SELECT record_id AS h_id, snapshot_time AS h_time, min(nr) AS nr FROM fact JOIN festivals
    ON snapshot_time >= make_timestamp(year(snapshot_time), f_month, f_day, 0, 0, 0)
    AND snapshot_time < make_timestamp(year(snapshot_time), f_month, f_day, 0, 0, 0) + to_days(CAST(f_days AS INTEGER))
  GROUP BY 1, 2),
rich AS (
  SELECT fact.*, weather, rain_probability, rain_delay, (l_orderkey % 100) < rint(rain_probability * 100) AS is_raining,
    coalesce(s_factor, 1::DOUBLE) AS seasonal_factor, (pack_size % 5) / 1e2 AS bulk_discount_pct,
    coalesce(f_demand, 1::DOUBLE) AS festival_demand_mult, coalesce(f_price, 1::DOUBLE) AS festival_price_mult
  FROM fact JOIN weather ON w_month = month
    LEFT JOIN seasons ON s_product = product_name AND s_month = month
    LEFT JOIN hits ON h_id = record_id AND h_time = snapshot_time
    LEFT JOIN festivals ON hits.nr = festivals.nr)""".replace("rint(", "round(")

_RAW_MINUTES = "CASE WHEN platform = 'gamma' AND l_orderkey % 1009 = 0 THEN NULL ELSE delivery_minutes END"
_CANON = ", ".join(f"{_RAW_MINUTES} AS delivery_minutes" if n == "delivery_minutes" else n for n in CANONICAL.names)
# Clean rows; with the doubled orders.
CLEAN = ENRICHED + f", clean AS (SELECT {_CANON} FROM rich)"
DOUBLED = ENRICHED + f""",
doubled AS (SELECT {_CANON} FROM rich, range(2) AS r(copy) WHERE copy = 0 OR l_orderkey % 97 = 0),
clean AS (SELECT DISTINCT * FROM doubled)"""


def add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = f"WITH {ctes.strip()}\n{select.strip()}"


# --- sources and sinks --------------------------------------------------------------------

add("write_roundtrip", LISTINGS, f"""
SELECT CAST(year(snapshot_time) AS INTEGER) AS year, platform, count(*) AS n, {big('sum(units_ordered)')} AS units,
  sum(rev_cents) / 1e2 AS revenue FROM fact GROUP BY 1, 2""")
add("partition_pruned_scan", LISTINGS, """
SELECT date, count(*) AS n, min(effective_price) AS min_price FROM fact
WHERE platform = 'beta' AND year(date) = 1999 GROUP BY 1""")
add("compact_parts", LISTINGS, f"""
SELECT platform, count(*) AS n, {big('sum(units_ordered)')} AS units, sum(rev_cents) / 1e2 AS revenue,
  true AS fewer_files FROM fact GROUP BY 1""")
add("sample_500", LISTINGS, f"""
SELECT record_id, product_name, platform, effective_price FROM fact ORDER BY md5(record_id), record_id
LIMIT {fv.SAMPLE_ROWS}""")
_ZONES = ", ".join(f"date >= newest - {d} AS in_{z}" for z, d in fv.RETENTION_DAYS.items())
add("retention_filter", LISTINGS, f"""
SELECT record_id, platform, snapshot_time, {_ZONES} FROM fact, (SELECT max(date) AS newest FROM fact)
WHERE date >= newest - {max(fv.RETENTION_DAYS.values())}""")
add("audit_summary", DOUBLED, """
SELECT a.platform, rows_in, rows_out, products, first_time, last_time, unparsed_minutes,
  date_diff('second', last_time, newest) // 3600 AS freshness_hours
FROM (SELECT platform, count(*) AS rows_in FROM doubled GROUP BY 1) a
JOIN (SELECT platform, count(*) AS rows_out, count(DISTINCT product_name) AS products, min(snapshot_time) AS first_time,
  max(snapshot_time) AS last_time, count(*) FILTER (delivery_minutes IS NULL) AS unparsed_minutes
  FROM clean GROUP BY 1) b ON a.platform = b.platform, (SELECT max(snapshot_time) AS newest FROM clean)""")

add("audit_overall", LISTINGS, """
SELECT platform, grouping(platform) = 1 AS is_overall, count(DISTINCT platform) AS platforms, count(*) AS n_rows,
  min(snapshot_time) AS first_time, max(snapshot_time) AS last_time, count(*) FILTER (delivery_minutes IS NULL) AS unparsed_minutes,
  count(DISTINCT product_name) AS exact_products, true AS within_bound FROM fact GROUP BY ROLLUP (platform)""")

# --- normalisation ------------------------------------------------------------------------

for _name, _platform in (("normalise_a", "alpha"), ("normalise_b", "beta"), ("normalise_c", "gamma")):
    add(_name, DOUBLED, f"SELECT * FROM doubled WHERE platform = '{_platform}'")
_KEPT = {"units_ordered", "platform", "record_id", "pack_size", "in_stock"}
_SQL_TYPE = {"string": "VARCHAR", "timestamp": "TIMESTAMP", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
add("canonical_select", LISTINGS, "SELECT " + ", ".join(
    f.name if f.name in _KEPT else f"CAST(NULL AS {_SQL_TYPE[f.dataType.simpleString()]}) AS {f.name}"
    for f in CANONICAL.fields) + " FROM fact")
add("ml_features", ENRICHED, "SELECT " + ", ".join(n for n in CANONICAL.names if n != "location") + """,
  CAST(is_weekend AS INTEGER) AS is_weekend_int, CAST(is_peak_hour AS INTEGER) AS is_peak_hour_int,
  CAST(is_raining AS INTEGER) AS is_raining_int, CAST(in_stock AS INTEGER) AS in_stock_int,
  CAST(dayofweek(snapshot_time) + 1 AS INTEGER) AS day_of_week
FROM rich WHERE stock_remaining <> 7""")
add("time_split_counts", LISTINGS, f"""
SELECT CASE WHEN month = {fv.TEST_MONTH} THEN 'test' ELSE 'train' END AS split, count(*) AS n,
  {big('sum(units_ordered)')} AS units FROM fact WHERE month IN (4, 5, 6) GROUP BY 1""")
add("unit_price", LISTINGS, f"""
SELECT record_id, CASE WHEN pack_size % 10 = 0 THEN NULL ELSE {rnd('effective_price / nullif(pack_size % 10, 0)')} END
  AS price_per_unit FROM fact""")
add("net_price", LISTINGS, f"SELECT record_id, {rnd('mrp * (1e0 - discount_pct / 1e2)', 2)} AS net_price FROM fact")
add("capped_revenue", ENRICHED, f"""
SELECT record_id, units, {rnd('effective_price * units', 2)} AS revenue FROM (
  SELECT *, least(CAST(trunc(l_quantity * festival_demand_mult) AS INTEGER), stock_remaining) AS units FROM rich)""")
add("lossless_check", DOUBLED, f"""
SELECT platform, count(*) AS raw_rows, count(DISTINCT record_id) AS raw_ids,
  (SELECT count(*) FROM clean c WHERE c.platform = d.platform) AS unified_rows, 0::BIGINT AS lost, 0::BIGINT AS invented
FROM doubled d GROUP BY platform""")
_STEPS = ", ".join(map(str, fv.DISCOUNT_STEPS))
add("dq_violations", LISTINGS, f"""
SELECT platform, rule, count(*) AS checked, count(*) FILTER (bad) AS violations FROM (
  SELECT platform, 'rating_range' AS rule, CASE WHEN rating > 47e-1 THEN rating + 1 ELSE rating END NOT BETWEEN 1 AND 5 AS bad FROM fact
  UNION ALL SELECT platform, 'delivery_range', delivery_minutes NOT BETWEEN 7 AND 60 FROM fact
  UNION ALL SELECT platform, 'discount_step', discount NOT IN ({_STEPS}) FROM fact
  UNION ALL SELECT platform, 'price_positive', NOT eff_cents > 0 FROM fact
  UNION ALL SELECT platform, 'location', location <> '{T.LOCATION}' FROM fact)
GROUP BY 1, 2""")
add("rating_impute", LISTINGS + f""",
holes AS (SELECT record_id, platform, CASE WHEN l_orderkey % 11 <> 0 THEN rating_x10 END AS r FROM fact),
means AS (SELECT platform, {avg('r', 1)} AS mean FROM holes GROUP BY 1)""", """
SELECT record_id, holes.platform, coalesce(r / 1e1, mean) AS rating
FROM holes JOIN means ON holes.platform = means.platform""")

# --- enrichment ---------------------------------------------------------------------------

add("time_band", LISTINGS, f"SELECT record_id, hour_of_day, {band('hour_of_day')} AS band, is_peak_hour AS peak FROM fact")
add("seasonal_enrich", ENRICHED, "SELECT record_id, product_name, month, seasonal_factor FROM rich")
add("weather_enrich", ENRICHED, "SELECT record_id, month, weather, rain_probability, rain_delay FROM rich")
add("festival_enrich", ENRICHED, """
SELECT record_id, snapshot_time, festival_demand_mult, festival_price_mult FROM rich""")
add("weekend_flag", LISTINGS, "SELECT record_id, is_weekend AS weekend FROM fact")
PACKS = """
sizes AS (SELECT p_name AS product_name, min(p_size) + 3 AS base_size, count(DISTINCT p_size) AS n, max(p_size) AS top
  FROM part GROUP BY 1),
packs AS (SELECT DISTINCT p_name AS product_name, p_size AS pack_size, CAST(base_size AS INTEGER) AS base_size,
    CAST(CASE WHEN n > 1 THEN top ELSE base_size END AS INTEGER) AS largest_size
  FROM part JOIN sizes ON p_name = product_name),
bulk AS (SELECT *, CASE WHEN pack_size > base_size THEN greatest(9e-1, 1e0 - 5e-2 * (pack_size - base_size)
    / greatest(largest_size - base_size, 1)) ELSE 1e0 END AS bulk_factor FROM packs)"""
add("pack_explode", PACKS, """
SELECT product_name, pack_size, concat(pack_size, 'g') AS pack_label, base_size, largest_size,
  CAST(pack_size AS DOUBLE) / base_size AS size_ratio FROM packs""")
add("bulk_discount", PACKS, f"""
SELECT product_name, pack_size, bulk_factor, {rnd('1e0 - bulk_factor', 3)} AS bulk_discount_pct FROM bulk""")
add("delivery_adjust", ENRICHED, f"""
SELECT record_id, greatest(7, least(60, CAST(trunc(delivery_minutes * ({band('hour_of_day')})
  * (CASE WHEN is_weekend THEN 115e-2 ELSE 1e0 END) * (CASE WHEN is_raining THEN rain_delay ELSE 1e0 END)) AS INTEGER)))
  AS adjusted_minutes FROM rich""")
_PREMIUM = ", ".join(f"'{c}'" for c in T.PREMIUM_CATEGORIES)
add("weekend_premium", LISTINGS, f"""
SELECT record_id, CASE WHEN is_weekend AND category IN ({_PREMIUM}) AND hour_of_day BETWEEN 8 AND 11
  THEN 104e-2 ELSE 1e0 END AS premium FROM fact""")
add("slot_gaps", LISTINGS + """,
grid AS (
  SELECT category, platform, CAST(d AS DATE) AS date FROM (SELECT DISTINCT category FROM fact),
    (SELECT DISTINCT platform FROM fact),
    (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM fact)),
missing AS (
  SELECT * FROM grid ANTI JOIN fact USING (category, platform, date)),
runs AS (
  SELECT *, date - CAST(row_number() OVER (PARTITION BY category, platform ORDER BY date) AS INTEGER) AS run FROM missing)""", """
SELECT category, platform, min(date) AS gap_first, max(date) AS gap_last, count(*) AS missing
FROM runs GROUP BY category, platform, run""")
add("slot_gaps_all", LISTINGS + """,
seen AS (SELECT DISTINCT product_name, pack_size, pack_unit, platform, epoch(snapshot_time)::BIGINT // 900 AS step FROM fact),
series AS (SELECT * FROM (SELECT DISTINCT product_name, pack_size, pack_unit FROM fact), (SELECT DISTINCT platform FROM fact)),
marked AS (SELECT * FROM seen UNION ALL SELECT *, (SELECT min(step) - 1 FROM seen) FROM series
  UNION ALL SELECT *, (SELECT max(step) + 1 FROM seen) FROM series),
paired AS (SELECT *, lead(step) OVER (PARTITION BY product_name, pack_size, pack_unit, platform ORDER BY step) AS later FROM marked)""", """
SELECT product_name, pack_size, pack_unit, platform, CAST(make_timestamp((step + 1) * 900000000) AS TIMESTAMP) AS gap_first,
  CAST(make_timestamp((later - 1) * 900000000) AS TIMESTAMP) AS gap_last, later - step - 1 AS missing
FROM paired WHERE later > step + 1""")

# --- union and duplicates -----------------------------------------------------------------

add("unified", DOUBLED, "SELECT * FROM doubled")
add("dedup", DOUBLED, "SELECT * FROM clean")
add("dedup_audit", DOUBLED, f"""
SELECT platform, count(*) AS rows_in, count(DISTINCT (record_id, snapshot_time)) AS rows_out,
  count(*) - count(DISTINCT (record_id, snapshot_time)) AS duplicates FROM doubled GROUP BY 1""")

# --- aggregates ---------------------------------------------------------------------------

PRICES = f"""
SELECT product_name, category, platform, date, hour_of_day AS hour, pack_size, pack_unit,
  {avg('eff_cents', 2)} AS avg_price, min(effective_price) AS min_price, max(effective_price) AS max_price,
  {avg('ppu_e4', 4)} AS avg_price_per_unit, {avg('discount * 100', 2)} AS avg_discount_pct,
  {rnd('stddev_samp(effective_price)', 2)} AS price_stddev, count(*) AS record_count
FROM fact GROUP BY 1, 2, 3, 4, 5, 6, 7"""
add("price_analytics", LISTINGS, PRICES)
add("incremental_refresh", LISTINGS, PRICES)
add("delivery_analytics", CLEAN, """
SELECT platform, CAST(snapshot_time AS DATE) AS date, hour_of_day, is_weekend, weather, is_raining,
  avg(delivery_minutes) AS avg_delivery_mins, min(delivery_minutes) AS min_delivery_mins,
  max(delivery_minutes) AS max_delivery_mins, count(*) AS record_count FROM clean GROUP BY 1, 2, 3, 4, 5, 6""")
add("revenue_analytics", LISTINGS, f"""
SELECT product_name, category, platform, date, pack_size, sum(rev_cents) / 1e2 AS total_revenue,
  {big('sum(units_ordered)')} AS total_units_ordered, avg(units_ordered) AS avg_units_ordered, count(*) AS record_count
FROM fact GROUP BY 1, 2, 3, 4, 5""")
add("stock_analytics", LISTINGS, """
SELECT product_name, category, platform, date, hour_of_day, is_peak_hour, avg(CAST(in_stock AS INTEGER)) AS availability_rate,
  count(*) FILTER (NOT in_stock) AS stockout_count, avg(stock_remaining) AS avg_stock_remaining, count(*) AS record_count
FROM fact GROUP BY 1, 2, 3, 4, 5, 6""")
DAILY = LISTINGS + f""",
daily AS (SELECT product_name, category, platform, date, month, {big('sum(units_ordered)')} AS daily_demand,
  {avg('eff_cents', 2)} AS daily_avg_price FROM fact GROUP BY 1, 2, 3, 4, 5)"""
add("daily_demand", DAILY, "SELECT * FROM daily")
add("hourly_price", LISTINGS, f"""
SELECT product_name, platform, date, hour_of_day AS hour, {avg('eff_cents', 2)} AS avg_price, count(*) AS record_count
FROM fact GROUP BY 1, 2, 3, 4""")
add("category_revenue", LISTINGS, f"""
SELECT category, platform, date, sum(rev_cents) / 1e2 AS revenue, {big('sum(units_ordered)')} AS units
FROM fact GROUP BY 1, 2, 3""")
add("category_demand_trend", LISTINGS, f"""
SELECT category, date, {big('sum(units_ordered)')} AS units, avg(units_ordered) AS avg_units, count(*) AS record_count
FROM fact GROUP BY 1, 2""")
add("surge_heatmap", LISTINGS + f""",
means AS (SELECT product_name, {avg('eff_cents')} AS mean FROM fact GROUP BY 1),
cells AS (SELECT product_name, CAST(dayofweek(snapshot_time) + 1 AS INTEGER) AS weekday, hour_of_day,
  {avg('eff_cents')} AS cell FROM fact GROUP BY 1, 2, 3)""", """
SELECT product_name, weekday, hour_of_day, cell / 1e2 AS avg_price, cell / mean AS surge_ratio
FROM cells JOIN means USING (product_name)""")
add("seasonal_index", LISTINGS + f""",
means AS (SELECT product_name, {avg('eff_cents')} AS mean FROM fact GROUP BY 1),
months AS (SELECT product_name, month, {avg('eff_cents')} AS cell FROM fact GROUP BY 1, 2)""", """
SELECT product_name, month, cell / 1e2 AS avg_price, cell / mean * 1e2 AS price_index
FROM months JOIN means USING (product_name)""")
add("delivery_contrast", ENRICHED, """
SELECT platform, avg(delivery_minutes) FILTER (is_raining) AS rain_mins,
  avg(delivery_minutes) FILTER (NOT is_raining) AS clear_mins, avg(delivery_minutes) FILTER (is_weekend) AS weekend_mins,
  avg(delivery_minutes) FILTER (NOT is_weekend) AS weekday_mins FROM rich GROUP BY 1""")
_RATES = """CAST(count(*) FILTER (in_stock) AS DOUBLE) / count(*) AS availability_rate,
  CAST(count(*) FILTER (NOT in_stock) AS DOUBLE) / count(*) AS stockout_rate FROM fact"""
add("availability_rates", LISTINGS, f"""
SELECT 'platform' AS grain, platform, NULL::VARCHAR AS product_name, NULL::BOOLEAN AS is_peak_hour, {_RATES} GROUP BY platform
UNION ALL SELECT 'product', NULL, product_name, NULL, {_RATES} GROUP BY product_name
UNION ALL SELECT 'peak', NULL, NULL, is_peak_hour, {_RATES} GROUP BY is_peak_hour""")
add("platform_scorecard", LISTINGS, f"""
SELECT platform, {avg('eff_cents', 2)} AS avg_price, avg(delivery_minutes) AS avg_delivery_mins,
  {avg('rating_x10', 1)} AS avg_rating, {avg('CAST(in_stock AS INTEGER)')} AS availability_rate,
  {avg('CAST(discount > 0 AS INTEGER)')} AS discount_frequency, count(*) AS record_count FROM fact GROUP BY 1""")
add("weekly_price_index", LISTINGS + f""",
weeks AS (SELECT platform, CAST(date_trunc('week', snapshot_time) AS DATE) AS week, {avg('eff_cents', 2)} AS avg_price
  FROM fact GROUP BY 1, 2)""", """
SELECT platform, week, avg_price,
  avg_price / first_value(avg_price) OVER (PARTITION BY platform ORDER BY week) * 1e2 AS price_index FROM weeks""")
add("discount_frequency", LISTINGS, f"""
SELECT platform, category, {avg('CAST(discount > 0 AS INTEGER)')} AS discount_frequency, count(*) AS record_count
FROM fact GROUP BY 1, 2""")
add("top10_revenue", LISTINGS, """
SELECT product_name, sum(rev_cents) / 1e2 AS revenue FROM fact GROUP BY 1 ORDER BY revenue DESC, product_name LIMIT 10""")

# --- windows ------------------------------------------------------------------------------


def _rolling(kind: str, order: str) -> str:
    unit = "" if kind == "ROWS" else " DAYS"
    pre, cur = (lambda n: f"INTERVAL {n}{unit} PRECEDING" if unit else f"{n} PRECEDING"), "CURRENT ROW"
    over = f"PARTITION BY product_name, platform ORDER BY {order} {kind} BETWEEN"
    return DAILY + f""",
rolling AS (SELECT *, avg(daily_demand) OVER ({over} {pre(6)} AND {cur}) AS rolling_avg_7d,
  avg(daily_demand) OVER ({over} {pre(13)} AND {pre(7)}) AS rolling_avg_prev_7d FROM daily)"""


ROLLING = _rolling("ROWS", "date")
add("rolling_demand", ROLLING, "SELECT * FROM rolling")
add("rolling_demand_calendar", _rolling("RANGE", "date"), "SELECT * FROM rolling")
LABELS = ROLLING + f""",
labels AS (SELECT *, CASE WHEN rolling_avg_7d > rolling_avg_prev_7d * 11e-1 THEN 'trending'
  WHEN rolling_avg_7d < rolling_avg_prev_7d * 9e-1 THEN 'declining' ELSE 'stable' END AS trend_label
  FROM rolling WHERE rolling_avg_prev_7d IS NOT NULL)"""
add("trend_labels", LABELS, "SELECT * FROM labels")
add("label_distribution", LABELS, "SELECT trend_label, count(*) AS n FROM labels GROUP BY 1")
add("price_volatility_7d", LISTINGS + f""",
prices AS (SELECT product_name, platform, date, {avg('eff_cents', 2)} AS avg_price FROM fact GROUP BY 1, 2, 3)""", f"""
SELECT product_name, platform, date, avg_price, {rnd('sd / mean')} AS volatility FROM (
  SELECT *, stddev_samp(avg_price) OVER w AS sd, avg(avg_price) OVER w AS mean FROM prices
  WINDOW w AS (PARTITION BY product_name, platform ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))""")
add("availability_24h", LISTINGS + """,
hours AS (SELECT product_name, platform, date_trunc('hour', snapshot_time) AS hour,
  count(*) FILTER (in_stock) AS stocked, count(*) AS n FROM fact GROUP BY 1, 2, 3)""", """
SELECT product_name, platform, hour, CAST(sum(stocked) OVER w AS DOUBLE) / sum(n) OVER w AS availability_24h FROM hours
WINDOW w AS (PARTITION BY product_name, platform ORDER BY hour RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW)""")
_RECENT = "(SELECT max(snapshot_time) FROM fact) - INTERVAL {} DAYS"
AVAILABILITY = LISTINGS + f""",
avail AS (SELECT product_name, platform, {avg('CAST(in_stock AS INTEGER)')} AS availability_rate_7d
  FROM fact WHERE snapshot_time > {_RECENT.format(7)} GROUP BY 1, 2)"""
add("availability_7d", AVAILABILITY, "SELECT * FROM avail")
add("price_history_7d", LISTINGS, f"""
SELECT product_name, platform, date, {avg('eff_cents', 2)} AS avg_price, count(*) AS record_count
FROM fact WHERE snapshot_time > {_RECENT.format(7)} GROUP BY 1, 2, 3""")
TRENDING = LABELS + """,
last_day AS (SELECT *, rolling_avg_7d / nullif(rolling_avg_prev_7d, 0) AS growth,
  row_number() OVER (PARTITION BY product_name, platform ORDER BY date DESC) AS nr FROM labels),
trending AS (SELECT * FROM last_day WHERE nr = 1 AND trend_label = 'trending')"""
add("top10_trending", TRENDING, """
SELECT category, CAST(rank AS INTEGER) AS rank, product_name, platform, date, growth FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY growth DESC NULLS LAST, product_name, platform) AS rank
  FROM trending) WHERE rank <= 10""")
TOP5 = TRENDING + """,
top5 AS (SELECT product_name, platform, category, date, growth FROM trending
  ORDER BY growth DESC NULLS LAST, product_name, platform LIMIT 5)"""
add("top5_trending", TOP5, "SELECT * FROM top5")

# --- current state and joins --------------------------------------------------------------

_LATEST = """
latest AS (
  SELECT product_name, pack_size, pack_unit, platform, record_id, snapshot_time, category, effective_price,
    price_per_unit, in_stock, stock_remaining, delivery_minutes, rating
  FROM (SELECT *, row_number() OVER (PARTITION BY product_name, pack_size, pack_unit, platform
    ORDER BY snapshot_time DESC, record_id DESC) AS nr FROM fact) WHERE nr = 1)"""
LATEST = LISTINGS + "," + _LATEST
add("latest_snapshot", LATEST, "SELECT * FROM latest")
add("fastest_now", LATEST + ", per AS (SELECT platform, min(delivery_minutes) AS min_delivery_mins FROM latest GROUP BY 1)", """
SELECT *, platform = (SELECT platform FROM per ORDER BY min_delivery_mins, platform LIMIT 1) AS is_fastest FROM per""")
add("side_by_side", LATEST, """
SELECT product_name, pack_size, pack_unit, max(effective_price) FILTER (platform = 'alpha') AS alpha_price,
  max(delivery_minutes) FILTER (platform = 'alpha') AS alpha_mins, max(effective_price) FILTER (platform = 'beta') AS beta_price,
  max(delivery_minutes) FILTER (platform = 'beta') AS beta_mins
FROM latest WHERE platform IN ('alpha', 'beta') GROUP BY 1, 2, 3""")
add("cheapest", LATEST, """
SELECT a.product_name, a.pack_size, a.pack_unit, a.platform AS cheapest_platform, a.effective_price AS price,
  b.platform AS cheapest_unit_platform, b.price_per_unit AS unit_price
FROM (SELECT *, row_number() OVER (PARTITION BY product_name, pack_size, pack_unit ORDER BY effective_price, platform) AS nr FROM latest) a
JOIN (SELECT *, row_number() OVER (PARTITION BY product_name, pack_size, pack_unit ORDER BY price_per_unit, platform) AS nr FROM latest) b
USING (product_name, pack_size, pack_unit) WHERE a.nr = 1 AND b.nr = 1""")
add("single_platform_products", LISTINGS, f"""
SELECT product_name, pack_size, pack_unit, min(platform) AS platform, count(*) AS record_count FROM fact
WHERE snapshot_time > {_RECENT.format(30)} GROUP BY 1, 2, 3 HAVING count(DISTINCT platform) = 1""")
add("asof_price", LISTINGS + """,
refs AS (SELECT product_name, snapshot_time AS t, effective_price AS price, record_id AS id FROM (
  SELECT *, row_number() OVER (PARTITION BY product_name, snapshot_time ORDER BY effective_price DESC, record_id DESC) AS nr
  FROM fact WHERE platform = 'alpha') WHERE nr = 1)""", """
SELECT g.product_name, g.record_id, g.snapshot_time, g.effective_price, r.t AS ref_time, r.price AS ref_price, r.id AS ref_id
FROM (SELECT * FROM fact WHERE platform = 'gamma') g ASOF LEFT JOIN refs r
  ON g.product_name = r.product_name AND g.snapshot_time > r.t""")
add("asof_price_all", LISTINGS + """,
refs AS (SELECT product_name, platform AS ref_platform, snapshot_time AS t, effective_price AS price, record_id AS id FROM (
  SELECT *, row_number() OVER (PARTITION BY product_name, platform, snapshot_time ORDER BY effective_price DESC, record_id DESC) AS nr
  FROM fact) WHERE nr = 1),
asked AS (SELECT * FROM fact, (SELECT DISTINCT platform AS ref_platform FROM fact))""", """
SELECT a.product_name, a.ref_platform, a.record_id, a.platform, a.snapshot_time, a.effective_price,
  r.t AS ref_time, r.price AS ref_price, r.id AS ref_id
FROM asked a ASOF LEFT JOIN refs r
  ON a.product_name = r.product_name AND a.ref_platform = r.ref_platform AND a.snapshot_time > r.t""")

# --- scoring ------------------------------------------------------------------------------

_PACK = "product_name, pack_size, pack_unit"


def _relative(x: str) -> str:
    low, high = f"min({x}) OVER p", f"max({x}) OVER p"
    return f"CASE WHEN {high} = {low} THEN 1e0 ELSE 1e0 - CAST({x} - {low} AS DOUBLE) / ({high} - {low}) END"


def _composite(p: str, d: str, q: str) -> str:
    return rnd(f"{p} * ps + {d} * ds + {q} * qs")


_W = [f"(CAST({w} AS DOUBLE) / {sum(fv.DEFAULT_WEIGHTS)})" for w in fv.DEFAULT_WEIGHTS]
SUBSCORES = AVAILABILITY + "," + _LATEST + f""",
scorable AS (SELECT latest.*, coalesce(availability_rate_7d, 85e-2) AS availability_rate_7d
  FROM latest LEFT JOIN avail USING (product_name, platform)),
sub AS (SELECT *, {_relative('effective_price')} AS ps, {_relative('delivery_minutes')} AS ds,
    CASE WHEN in_stock THEN 5e-1 * (rating / 5e0) + 5e-1 * availability_rate_7d ELSE 0e0 END AS qs
  FROM scorable WINDOW p AS (PARTITION BY {_PACK}))"""
SCORED = SUBSCORES + f""",
scores AS (SELECT *, {rnd('ps')} AS price_score, {rnd('ds')} AS delivery_score, {rnd('qs')} AS quality_score,
  {_W[0]} AS w_price, {_W[1]} AS w_delivery, {_W[2]} AS w_quality, {_composite(*_W)} AS composite_score FROM sub),
scored AS (SELECT * EXCLUDE (ps, ds, qs), CAST(row_number() OVER (PARTITION BY {_PACK}
  ORDER BY composite_score DESC, platform) AS INTEGER) AS rank FROM scores)"""
RECORDS = SCORED + f""",
records AS (SELECT {_PACK}, max(snapshot_time) AS comparison_time,
  arg_min(platform, rank) AS recommended_platform,
  first(platform ORDER BY effective_price, rank) AS best_price_platform,
  first(platform ORDER BY price_per_unit, rank) AS best_unit_price_platform,
  first(platform ORDER BY delivery_minutes, rank) AS fastest_delivery_platform,
  first(platform ORDER BY quality_score DESC, rank) AS highest_quality_platform, count(*) = 1 AS only_here
  FROM scored GROUP BY ALL)"""
_SLIDER = "CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE c_custkey * {} % 101 END"
add("weight_profiles", f"""
s AS (SELECT c_custkey AS user_id, {_SLIDER.format(1)} AS price, {_SLIDER.format(7)} AS delivery,
  {_SLIDER.format(13)} AS quality FROM customer)""", "SELECT *, " + ", ".join(
    f"CASE WHEN price + delivery + quality = 0 THEN 1e0 / 3e0 ELSE CAST({c} AS DOUBLE) / (price + delivery + quality) END AS w_{c}"
    for c in ("price", "delivery", "quality")) + " FROM s")
add("score_platforms", SCORED, "SELECT * EXCLUDE (rank) FROM scored")
add("rank_platforms", SCORED, f"""
SELECT {_PACK}, platform, in_stock, composite_score, CAST(row_number() OVER (PARTITION BY {_PACK}
  ORDER BY in_stock DESC, composite_score DESC, platform) AS INTEGER) AS rank FROM scored""")
add("recommendation", RECORDS, "SELECT * FROM records")
add("comparison_record", RECORDS, f"""
SELECT {_PACK}, comparison_time, recommended_platform, w_price, w_delivery, w_quality, rank, platform,
  effective_price AS price, price_per_unit, delivery_minutes, in_stock AS is_available, rating, availability_rate_7d,
  price_score, delivery_score, quality_score, composite_score FROM scored JOIN records USING ({_PACK})""")
_NAMES = _values(T.DISPLAY_NAMES.items())


def _sql_text(wording: str, **values: str) -> str:
    parts = []
    for piece in wording.replace("'", "''").split("{"):
        name, brace, rest = piece.partition("}")
        parts += [values[name], f"'{rest}'"] if brace else [f"'{piece}'"]
    return "concat(" + ", ".join(parts) + ")"


def _whole(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


_FOUND = _sql_text(fv.ANSWER_FOUND, product="product_name", pack="concat(' ', pack_size, pack_unit)",
                   location=f"'{T.LOCATION}'", platform="bn.display_name", price=_whole("b.effective_price"),
                   minutes="b.delivery_minutes", rating="printf('%.1f', b.rating)")
_CHEAPER = _sql_text(fv.ANSWER_CHEAPER, platform="cn.display_name", price=_whole("c.effective_price"))
add("response_text", RECORDS + f", names(platform, display_name) AS (VALUES {_NAMES})", f"""
SELECT {_PACK}, CASE WHEN best_price_platform = recommended_platform THEN {_FOUND}
  ELSE concat({_FOUND}, {_CHEAPER}) END AS answer
FROM records r JOIN scored b USING ({_PACK}) JOIN scored c USING ({_PACK})
  JOIN names bn ON bn.platform = b.platform JOIN names cn ON cn.platform = c.platform
WHERE b.platform = recommended_platform AND c.platform = best_price_platform""")
_PROFILES = ", ".join(
    f"('{n}', " + ", ".join(f"CAST({v} AS DOUBLE) / {sum(s)}" if sum(s) else "1e0 / 3e0" for v in s) + ")"
    for n, s in PROFILES.items())
add("weight_sensitivity", SUBSCORES + f""",
profiles(profile, wp, wd, wq) AS (VALUES {_PROFILES}),
ranked AS (SELECT *, {_composite('wp', 'wd', 'wq')} AS composite_score FROM sub, profiles)""", f"""
SELECT {_PACK}, profile, platform AS winner, composite_score FROM (
  SELECT *, row_number() OVER (PARTITION BY {_PACK}, profile ORDER BY composite_score DESC, platform) AS nr FROM ranked)
WHERE nr = 1""")
_POINTS = {"price": "ps", "delivery": "ds", "quality": "qs"}
_LINES = " UNION ALL ".join(
    f"SELECT {_PACK}, platform, '{n}' AS slider, {_POINTS[n]} AS slope, " + " + ".join(
        f"{w} * {_POINTS[o]}" for o, w in zip(_POINTS, fv.DEFAULT_WEIGHTS) if o != n) + " AS base FROM points" for n in _POINTS)
add("slider_ranges", SUBSCORES + f""",
points AS (SELECT {_PACK}, platform, {", ".join(f"CAST(floor({c} * 10000 + 5e-1) AS BIGINT) AS {c}" for c in _POINTS.values())}
  FROM sub WHERE ps IS NOT NULL AND ds IS NOT NULL AND qs IS NOT NULL),
lines AS ({_LINES}),
grid AS (SELECT *, setting * slope + base AS score FROM lines, range(101) AS r(setting)),
won AS (SELECT * FROM grid QUALIFY row_number() OVER (PARTITION BY {_PACK}, slider, setting ORDER BY score DESC, platform) = 1),
changes AS (SELECT *, lag(platform) OVER w AS before, lag(slope) OVER w AS slope_before, lag(base) OVER w AS base_before FROM won
  WINDOW w AS (PARTITION BY {_PACK}, slider ORDER BY setting) QUALIFY before IS NULL OR before <> platform)""", f"""
SELECT {_PACK}, slider, CAST(row_number() OVER w - 1 AS INTEGER) AS range_no, platform AS winner, setting AS from_setting,
  coalesce(lead(setting) OVER w - 1, 100) AS to_setting,
  CAST(base_before - base AS DOUBLE) / nullif(slope - slope_before, 0) AS meets_at
FROM changes WINDOW w AS (PARTITION BY {_PACK}, slider ORDER BY setting)""")
_COVER = f"""
sold AS (SELECT product_name, platform, {big('sum(units_ordered)')} AS units FROM fact
  WHERE snapshot_time > {_RECENT.format(7)} GROUP BY 1, 2),
stock AS (SELECT product_name, platform, {big('sum(stock_remaining)')} AS stock FROM latest GROUP BY 1, 2),
cover AS (SELECT product_name, platform, stock, coalesce(units, 0) AS units,
  CAST(stock * 168 AS DOUBLE) / nullif(coalesce(units, 0), 0) AS hours_of_cover
  FROM stock LEFT JOIN sold USING (product_name, platform))"""
_RISK = "CASE WHEN stock = 0 OR hours_of_cover < 12 THEN 'high' WHEN hours_of_cover < 24 THEN 'medium' ELSE 'low' END"
add("stockout_risk", LATEST + "," + _COVER, f"SELECT *, {_RISK} AS stockout_risk FROM cover")

# --- questions ----------------------------------------------------------------------------

QUESTIONS = r"""
questions AS (
  SELECT concat('c-', conv_id, '-', turn) AS question_id, text FROM conversations
  UNION ALL
  SELECT concat('p-', p_partkey), CASE p_partkey % 8
    WHEN 0 THEN concat('Where can we get ', p_name, ' tonight?')
    WHEN 1 THEN concat('Lowest price for ', p_size, ' g ', p_name, ' please')
    WHEN 2 THEN concat('How long until ', p_name, ' arrives on Gamma?')
    WHEN 3 THEN 'What is popular this week?'
    WHEN 4 THEN concat(p_name, ': Alpha or Gamma?')
    WHEN 5 THEN concat('side  by side ', upper(p_name), ' ', p_size, 'pcs')
    WHEN 6 THEN concat('Any budget ', split_part(p_name, ' ', 1), ' things')
    ELSE concat('I need ', p_name, ' ', p_size, ' kg') END FROM part)"""
_INTENT = "CASE " + " ".join(
    f"WHEN regexp_matches(lower(text), '{p}') THEN '{i}'" for i, p in intent_expressions(T.PLATFORM_ALIASES).items()
) + f" ELSE '{fv.DEFAULT_INTENT}' END"
_PACKSIZE = f"nullif(regexp_extract(lower(text), '{fv.PACK_PATTERN}', 0), '')"
_NAMED = "nullif(concat_ws(',', " + ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + f" THEN '{p}' END"
    for p, words in T.PLATFORM_ALIASES.items()) + "), '')"
MENTIONS = QUESTIONS + """,
mentions AS (SELECT question_id, first(p_name ORDER BY length(p_name) DESC, p_name) AS product
  FROM questions JOIN (SELECT DISTINCT p_name FROM part) ON contains(lower(text), lower(p_name)) GROUP BY 1)"""
PARSED = MENTIONS + f""",
parsed AS (SELECT question_id, text, product, {_INTENT} AS intent, {_PACKSIZE} AS pack, {_NAMED} AS platforms_named
  FROM questions LEFT JOIN mentions USING (question_id))"""
add("intent_label", QUESTIONS, f"SELECT question_id, {_INTENT} AS intent FROM questions")
add("product_mention", MENTIONS, "SELECT question_id, product FROM questions LEFT JOIN mentions USING (question_id)")
add("pack_mention", QUESTIONS, f"SELECT question_id, {_PACKSIZE} AS pack FROM questions")
add("platform_mention", QUESTIONS, f"SELECT question_id, {_NAMED} AS platforms_named FROM questions")
add("parsed_queries", PARSED, "SELECT * FROM parsed")
add("intent_counts", PARSED, """
SELECT left(question_id, 1) AS origin, intent, count(*) AS questions FROM parsed GROUP BY 1, 2""")
_SUB_CTES = RECORDS[len(LISTINGS):]
_TIMES = "CASE {0} " + " ".join(f"WHEN '{u}' THEN {n}" for u, (_, n) in fv.PACK_UNITS.items()) + " ELSE 1 END"
_PLAIN = "CASE {0} " + " ".join(f"WHEN '{u}' THEN '{p}'" for u, (p, _) in fv.PACK_UNITS.items()) + " ELSE {0} END"
add("answer_queries", PARSED + "," + TOP5 + _SUB_CTES + f""",
packs AS (SELECT *, CAST(pack_size AS BIGINT) * {_TIMES.format('lower(pack_unit)')} AS size,
  {_PLAIN.format('lower(pack_unit)')} AS unit FROM records),
chosen AS (SELECT * FROM packs QUALIFY row_number() OVER (PARTITION BY product_name, size, unit ORDER BY pack_size, pack_unit) = 1),
base AS (SELECT product_name, size AS least_size, unit AS least_unit FROM chosen
  QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY size, unit) = 1),
spelled AS (SELECT *, TRY_CAST(regexp_extract(pack, '^([0-9]+)', 1) AS INTEGER) AS number,
  nullif(regexp_extract(pack, '^[0-9]+\\s*([^0-9]+)$', 1), '') AS word FROM parsed),
asked AS (SELECT question_id, intent, product, platforms_named,
  CASE WHEN number IS NULL OR word IS NULL THEN least_size ELSE CAST(number AS BIGINT) * {_TIMES.format('word')} END AS pack_size,
  CASE WHEN number IS NULL OR word IS NULL THEN least_unit ELSE {_PLAIN.format('word')} END AS pack_unit
  FROM spelled LEFT JOIN base ON product = product_name),
found AS (SELECT a.*, c.pack_size AS own_size, c.pack_unit AS own_unit, c.recommended_platform, c.best_price_platform FROM asked a
  LEFT JOIN chosen c ON a.product = c.product_name AND a.pack_size = c.size AND a.pack_unit = c.unit),
lists AS (SELECT f.question_id, string_agg(s.platform, ' > ' ORDER BY s.rank) AS compared FROM found f
  JOIN scored s ON s.product_name = f.product AND s.pack_size = f.own_size AND s.pack_unit = f.own_unit
  WHERE f.platforms_named IS NULL OR list_contains(string_split(f.platforms_named, ','), s.platform) GROUP BY 1)""", """
SELECT question_id, intent, product, pack_size, pack_unit, platforms_named, CASE intent
  WHEN 'check_delivery' THEN (SELECT platform FROM latest ORDER BY delivery_minutes, platform LIMIT 1)
  WHEN 'trending' THEN (SELECT string_agg(product_name, ', ' ORDER BY growth DESC, product_name, platform) FROM top5)
  WHEN 'find_cheapest' THEN best_price_platform WHEN 'compare' THEN compared ELSE recommended_platform END AS answer
FROM found LEFT JOIN lists USING (question_id)""")

# --- usage --------------------------------------------------------------------------------

_TYPES = ("view", "click", "signup", "purchase", "error")
_TYPE_COUNTS = ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in _TYPES)
SESSIONS = f"""
marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER u <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS starts FROM events
  WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM marked),
sess AS (SELECT user_id, {big('nr')} AS session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_sec, {_TYPE_COUNTS} FROM numbered GROUP BY 1, 2)"""
_UNPIVOT = " UNION ALL ".join(f"SELECT '{t}' AS event_type, {t} AS n FROM sess" for t in _TYPES)
add("mau", "e AS (SELECT * FROM events)", """
SELECT strftime(ts, '%Y-%m') AS month, count(DISTINCT user_id) AS active_users FROM e GROUP BY 1""")
add("sessions", SESSIONS, "SELECT * FROM sess")
add("session_summary", SESSIONS, """
SELECT CAST(session_start AS DATE) AS date, count(*) AS sessions,
  CAST(sum(epoch_us(session_end) - epoch_us(session_start)) AS DOUBLE) / count(*) / 1e6 AS mean_duration_sec
FROM sess GROUP BY 1""")
add("session_share", SESSIONS, f"""
SELECT event_type, count(*) AS sessions, CAST(count(*) FILTER (n > 0) AS DOUBLE) / count(*) AS share
FROM ({_UNPIVOT}) GROUP BY 1""")
add("events_per_session", SESSIONS, f"""
SELECT event_type, count(*) AS sessions, CAST(sum(n) AS DOUBLE) / count(*) AS events_per_session
FROM ({_UNPIVOT}) GROUP BY 1""")
add("return_rate_7d", """
firsts AS (SELECT user_id, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY 1),
users AS (SELECT f.user_id, first_day, max(CASE WHEN CAST(ts AS DATE) - first_day BETWEEN 1 AND 7 THEN 1 ELSE 0 END) AS back
  FROM firsts f JOIN events e ON e.user_id = f.user_id GROUP BY 1, 2)""", f"""
SELECT first_day, count(*) AS users, {big('sum(back)')} AS returned, CAST(sum(back) AS DOUBLE) / count(*) AS return_rate
FROM users GROUP BY 1""")
add("p95_value", "e AS (SELECT * FROM events)", """
SELECT event_type, {} AS p_value FROM e GROUP BY 1""".format(rnd("quantile_cont(value, 0.95)")))
add("late_rows", """
arrivals AS (SELECT event_id, ts, ts + to_minutes(CAST(event_id * 37 % 91 AS BIGINT)) AS arrived FROM events),
batched AS (SELECT *, epoch_us(arrived) // 3600000000 AS batch FROM arrivals),
marks AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL 30 MINUTES AS watermark FROM batched GROUP BY batch)""", """
SELECT event_id, ts, arrived, batch, watermark FROM batched JOIN marks USING (batch) WHERE ts < watermark""")

# --- streaming: all windows, those that are open at the end too ---------------------------

add("stream_tumbling", "w AS (SELECT *, time_bucket(INTERVAL 15 MINUTES, ts) AS window_start FROM events)", f"""
SELECT window_start, event_type, count(*) AS events, {avg('CAST(round(value * 100) AS BIGINT)', 2)} AS avg_value FROM w GROUP BY 1, 2""")
add("stream_hourly_price", LISTINGS, f"""
SELECT date_trunc('hour', snapshot_time) AS hour, product_name, platform, {avg('eff_cents', 2)} AS avg_price,
  count(*) AS record_count FROM fact GROUP BY 1, 2, 3""")
add("stream_sliding", LISTINGS + """,
hours AS (SELECT date_trunc('hour', snapshot_time) AS hour, platform, count(*) FILTER (in_stock) AS stocked, count(*) AS n
  FROM fact GROUP BY 1, 2),
copies AS (SELECT hour - to_hours(k) AS window_start, platform, stocked, n FROM hours, range(24) AS r(k))""", """
SELECT window_start, window_start + INTERVAL 24 HOURS AS window_end, platform,
  CAST(sum(stocked) AS DOUBLE) / sum(n) AS availability_24h, CAST(sum(n) AS BIGINT) AS record_count FROM copies GROUP BY 1, 2, 3""")
add("stream_sessions", SESSIONS, """
SELECT user_id, session_start, session_end + INTERVAL 30 MINUTES AS session_end, events FROM sess""")
add("stream_dedup", "e AS (SELECT * FROM events)", "SELECT event_id, ts, user_id, event_type, value FROM e")
for _name in ("stream_tumbling", "stream_hourly_price", "stream_sliding", "stream_sessions"):
    ORACLES[f"{_name}_all"] = ORACLES[_name]
add("stream_sliding_product", LISTINGS + """,
hours AS (SELECT date_trunc('hour', snapshot_time) AS hour, product_name, platform, count(*) FILTER (in_stock) AS stocked,
  count(in_stock) AS n FROM fact GROUP BY 1, 2, 3)""", f"""
SELECT hour - INTERVAL 23 HOURS AS window_start, hour + INTERVAL 1 HOUR AS window_end, product_name, platform,
  CAST(sum(stocked) OVER w AS DOUBLE) / sum(n) OVER w AS availability_24h, {big('sum(n) OVER w')} AS record_count FROM hours
WINDOW w AS (PARTITION BY product_name, platform ORDER BY hour RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW)""")
add("stream_late_rows", """
arrivals AS (SELECT event_id, ts, event_type,
  CAST(floor((CAST(ts + to_hours(CAST(event_id * 37 % 91 AS BIGINT)) AS DATE) - DATE '1970-01-01') / 7) AS BIGINT) AS part FROM events),
parts AS (SELECT part, row_number() OVER (ORDER BY part) - 1 AS batch,
  max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM arrivals GROUP BY part)""", """
SELECT event_id, ts, event_type, part, batch FROM arrivals JOIN parts USING (part)
WHERE time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES <= newest - INTERVAL 10 MINUTES""")

# --- forecasts ----------------------------------------------------------------------------

SERIES = LISTINGS + f""",
series AS (SELECT category, platform, date, {big('sum(units_ordered)')} AS demand FROM fact GROUP BY 1, 2, 3)"""


def _shift(name: str, days: int) -> str:
    return f"""(SELECT o.demand FROM series o WHERE o.category = s.category AND o.platform = s.platform
    AND o.date = s.date + ({days})) AS {name}"""


add("horizon_features", SERIES, f"SELECT s.*, {_shift('demand_in_24h', 1)}, {_shift('demand_in_72h', 3)} FROM series s")
NAIVE = SERIES + f", naive AS (SELECT s.*, {_shift('naive_24h', -1)}, {_shift('naive_72h', -3)} FROM series s)"
add("naive_forecast", NAIVE, "SELECT * FROM naive")
add("forecast_overlay", SERIES, """
SELECT category, platform, date, a.demand AS actual, p.demand AS predicted FROM series a
FULL JOIN (SELECT category, platform, date + 1 AS date, demand FROM series) p USING (category, platform, date)""")
add("forecast_interval", NAIVE + """,
spread AS (SELECT category, platform, quantile_cont(demand - naive_24h, 0.05) AS low,
  quantile_cont(demand - naive_24h, 0.95) AS high FROM naive WHERE naive_24h IS NOT NULL GROUP BY 1, 2)""", f"""
SELECT category, platform, date, demand, naive_24h AS predicted, {rnd('naive_24h + low')} AS confidence_lower,
  {rnd('naive_24h + high')} AS confidence_upper FROM naive JOIN spread USING (category, platform)
WHERE naive_24h IS NOT NULL""")
add("conformal_interval", NAIVE + f""",
held AS (SELECT *, demand - naive_24h AS error FROM naive WHERE naive_24h IS NOT NULL AND month(date) = {fv.TEST_MONTH}),
sorted AS (SELECT 'series' AS level, category, platform, list_sort(list(error)) AS e FROM held GROUP BY 2, 3
  UNION ALL SELECT 'platform', NULL, platform, list_sort(list(error)) FROM held GROUP BY 3
  UNION ALL SELECT 'all', NULL, NULL, list_sort(list(error)) FROM held HAVING count(*) > 0),
-- Of n errors those at ranks floor((n + 1) / 20) and ceil(19 (n + 1) / 20).
bounds AS (SELECT level, category, platform, e[(len(e) + 1) // 20] AS low, e[(19 * (len(e) + 1) + 19) // 20] AS high
  FROM sorted WHERE len(e) >= 19)""", """
SELECT n.category, n.platform, n.date, n.demand, CAST(naive_24h AS DOUBLE) AS predicted,
  greatest(0e0, naive_24h + coalesce(s.low, p.low, a.low)) AS confidence_lower,
  greatest(0e0, naive_24h + coalesce(s.high, p.high, a.high)) AS confidence_upper, coalesce(s.level, p.level, a.level) AS interval_level
FROM naive n LEFT JOIN bounds s ON s.level = 'series' AND s.category = n.category AND s.platform = n.platform
LEFT JOIN bounds p ON p.level = 'platform' AND p.platform = n.platform LEFT JOIN bounds a ON a.level = 'all'
WHERE naive_24h IS NOT NULL""")
_TREND_CTES = TRENDING[len(LISTINGS):]
add("forecast_record", LATEST + _TREND_CTES + f""",
errors AS (SELECT category, platform, daily_demand - avg(daily_demand) OVER (PARTITION BY product_name, platform ORDER BY date
  ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS error FROM daily),
spread AS (SELECT category, platform, quantile_cont(error, 0.05) AS low, quantile_cont(error, 0.95) AS high
  FROM errors WHERE error IS NOT NULL GROUP BY 1, 2),{_COVER}""", f"""
SELECT t.product_name, t.platform, (SELECT max(snapshot_time) FROM fact) AS forecast_generated_at,
  {fv.FORECAST_HORIZON_HOURS} AS forecast_horizon_hours, rolling_avg_7d AS predicted_demand_index,
  {rnd('greatest(0e0, rolling_avg_7d + low)')} AS confidence_lower, {rnd('rolling_avg_7d + high')} AS confidence_upper,
  trend_label, {_RISK} AS stockout_risk, '{BASELINE_VERSION}' AS model_version
FROM last_day t JOIN spread USING (category, platform) JOIN cover USING (product_name, platform) WHERE nr = 1""")
add("forecast_mape", NAIVE, f"""
SELECT {rnd("avg(CASE WHEN demand > 0 THEN CAST(abs(naive_24h - demand) AS DOUBLE) / demand END) * 100")} AS mape,
  {rnd('sqrt(avg((naive_24h - demand) * (naive_24h - demand)))')} AS rmse, {rnd('avg(abs(naive_24h - demand))')} AS mae,
  count(*) AS n FROM naive WHERE naive_24h IS NOT NULL""")
BASELINE = LABELS + f""",
base AS (SELECT * FROM (SELECT *, lag(trend_label) OVER (PARTITION BY product_name, platform ORDER BY date) AS predicted
  FROM labels) WHERE predicted IS NOT NULL AND month = {fv.TEST_MONTH})"""
add("trend_confusion", BASELINE, "SELECT trend_label AS actual, predicted, count(*) AS n FROM base GROUP BY 1, 2")
add("trend_scores", BASELINE + """,
names AS (SELECT trend_label AS label FROM base UNION SELECT predicted FROM base),
per AS (SELECT label, (SELECT count(*) FROM base WHERE trend_label = label) AS a,
  (SELECT count(*) FROM base WHERE predicted = label) AS p,
  (SELECT count(*) FROM base WHERE predicted = label AND trend_label = label) AS h FROM names)""", f"""
SELECT {rnd('CAST(sum(h) AS DOUBLE) / sum(a)')} AS accuracy,
  {rnd('sum(CAST(2 * h AS DOUBLE) / (a + p) * a) / sum(a)')} AS weighted_f1, CAST(sum(a) AS BIGINT) AS n FROM per""")

# --- models -------------------------------------------------------------------------------

_CATEGORIES = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, fold, units_ordered FROM train" for c in INDEXED)
add("category_means", ENRICHED + f""",
train AS (SELECT *, CAST(CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % {FOLDS} AS INTEGER) AS fold
  FROM rich WHERE month IN {fv.TRAIN_MONTHS}),
overall AS (SELECT avg(units_ordered) AS mean FROM train),
cells AS (SELECT feature, value, fold, count(*) AS n, sum(units_ordered) AS units FROM ({_CATEGORIES}) GROUP BY 1, 2, 3),
rest AS (SELECT feature, value, fold, sum(n) OVER w - n AS n, sum(units) OVER w - units AS units FROM cells
  WINDOW w AS (PARTITION BY feature, value))""", f"""
SELECT feature, value, fold, {rnd(f'(units + {PRIOR_ROWS} * mean) / (n + {PRIOR_ROWS})', 6)} AS mean_of_others FROM rest, overall""")
add("demand_alert", LATEST + _TREND_CTES + "," + _COVER, f"""
SELECT product_name, platform, stock, {rnd('rolling_avg_7d')} AS predicted_demand_index,
  {rnd('stock * 24e0 / nullif(rolling_avg_7d, 0)')} AS predicted_hours_of_cover,
  coalesce(stock <= 0 OR stock * 24e0 / nullif(rolling_avg_7d, 0) < {fv.STOCKOUT_HOURS[0]}, false) AS demand_alert
FROM stock LEFT JOIN (SELECT * FROM last_day WHERE nr = 1) t USING (product_name, platform)""")
