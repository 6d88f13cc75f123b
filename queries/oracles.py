"""SQL for the registered queries, written for DuckDB over the given tables."""

from __future__ import annotations

from queries.views import HOLIDAYS, ITEMS, OIL, PROMOS, SALES, STORE_PRICES, STORES, TEXT_PROMOS

SERIES = "PARTITION BY store_nbr, item_nbr ORDER BY date"
LO, HI = "DATE '1997-03-01'", "DATE '1999-06-30'"
Y_LO, Y_HI = 1996, 2000
STATS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min", "sum": "sum"}
EMBARGO, VAL, STRIDE, MIN_TRAIN, N_FOLDS = 84 + 14 - 1, 14, 14, 365, 3


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rounded(column: str, digits: int = 6) -> str:
    return f"ROUND({column}, {digits}) AS {column}"


# --- Joins and deduplication ----------------------------------------------------------------------------------------

ENRICHED = """first_items AS (
  SELECT item_nbr, family, class FROM items QUALIFY row_number() OVER (PARTITION BY item_nbr ORDER BY p_partkey) = 1),
enriched AS (
  SELECT s.*, family, class, city, state FROM sales s
  LEFT JOIN first_items USING (item_nbr) LEFT JOIN stores USING (store_nbr))"""

ENRICH_SALES = with_(SALES, ITEMS, STORES, ENRICHED) + "SELECT * FROM enriched"

ENRICHED_LAG = with_(SALES, ITEMS, STORES, ENRICHED) + f"""
SELECT *, lag(unit_sales, 7) OVER ({SERIES}) AS unit_sales_lag_7,
       ROUND(CASE WHEN count(unit_sales) OVER w = 7 THEN avg(unit_sales) OVER w END, 6) AS unit_sales_roll7_mean_lag1
FROM enriched WINDOW w AS ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""

KEEP_FIRST = with_(ITEMS) + """
SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY item_nbr ORDER BY p_partkey) = 1"""

LAST_PROMOS = """last_promos AS (
  SELECT * FROM promos QUALIFY row_number() OVER (PARTITION BY date, store_nbr, item_nbr
    ORDER BY l_orderkey DESC, l_linenumber DESC, onpromotion DESC, unit_sales DESC, list_price DESC) = 1)"""

KEEP_LAST = with_(PROMOS, LAST_PROMOS) + "SELECT * FROM last_promos"

OIL_PROMO_JOIN = with_(SALES, OIL, PROMOS, LAST_PROMOS) + """
SELECT s.date, s.store_nbr, s.item_nbr, s.unit_sales, o.dcoilwtico AS oil_price, p.onpromotion,
       p.unit_sales AS promo_unit_sales, p.list_price, p.l_orderkey, p.l_linenumber
FROM sales s LEFT JOIN oil o ON s.date = o.date
LEFT JOIN last_promos p ON s.date = p.date AND s.store_nbr = p.store_nbr AND s.item_nbr = p.item_nbr"""

OIL_PROMO_KEPT = with_(SALES, PROMOS) + """,
store_promos AS (
  SELECT date, store_nbr, onpromotion, list_price, l_orderkey, l_linenumber FROM promos
  QUALIFY row_number() OVER (PARTITION BY date, store_nbr
    ORDER BY l_orderkey DESC, l_linenumber DESC, onpromotion DESC, list_price DESC) = 1)
SELECT s.*, p.onpromotion AS promo_onpromotion, p.list_price, p.l_orderkey, p.l_linenumber
FROM sales s LEFT JOIN store_promos p ON s.date = p.date AND s.store_nbr = p.store_nbr"""

OIL_PROMO_BY_DATE = with_(SALES, PROMOS) + """,
day_promos AS (
  SELECT date, onpromotion, list_price, l_orderkey, l_linenumber FROM promos
  QUALIFY row_number() OVER (PARTITION BY date
    ORDER BY l_orderkey DESC, l_linenumber DESC, onpromotion DESC, list_price DESC) = 1)
SELECT s.date, s.store_nbr, s.item_nbr, s.unit_sales, p.onpromotion, p.list_price, p.l_orderkey, p.l_linenumber
FROM sales s LEFT JOIN day_promos p ON s.date = p.date"""

PARSED = r"""parsed AS (
  SELECT *, trim(coalesce(description, '')) AS txt FROM holidays),
cleaned AS (
  SELECT holiday_id, date, type, locale AS scope, locale_name AS scope_name, description, transferred,
         CASE WHEN type = 'Holiday' AND sfx <> '' THEN 'additional'
              WHEN type = 'Holiday' THEN 'holiday' WHEN type = 'Transfer' THEN 'transfer'
              WHEN type = 'Bridge' THEN 'bridge' WHEN type = 'Work Day' THEN 'work_day'
              WHEN type = 'Additional' THEN 'additional' WHEN type = 'Event' THEN 'event'
              ELSE replace(lower(type), ' ', '_') END AS role,
         CASE WHEN type IN ('Holiday', 'Additional', 'Event') AND sfx <> '' THEN trim(stem)
              WHEN type = 'Transfer' THEN trim(regexp_replace(txt, '(?i)^traslado\s+', ''))
              WHEN type = 'Bridge' THEN trim(regexp_replace(txt, '(?i)^puente\s+', ''))
              WHEN type = 'Work Day' THEN trim(regexp_replace(txt, '(?i)^recupero\s+puente\s+', ''))
              ELSE txt END AS anchor_label,
         CASE WHEN type IN ('Holiday', 'Additional', 'Event') AND sfx <> '' THEN CAST(sfx AS INTEGER) ELSE 0 END
           AS offset_days
  FROM (SELECT *, regexp_extract(txt, '^(.*?)([+-][0-9]+)$', 2) AS sfx,
               regexp_extract(txt, '^(.*?)([+-][0-9]+)$', 1) AS stem FROM parsed)),
keyed AS (
  SELECT *, regexp_replace(trim(lower(strip_accents(anchor_label))), '\s+', ' ', 'g') AS anchor_key FROM cleaned)"""

HOLIDAY_PARSE = with_(HOLIDAYS, PARSED) + """
SELECT holiday_id, date, scope, scope_name, role, anchor_label, offset_days, anchor_key FROM keyed"""

DIM = """holiday_dim AS (
  SELECT holiday_id, date, scope, role, offset_days, anchor_key,
         CASE WHEN scope = 'Local' THEN scope_name END AS city, CASE WHEN scope = 'Regional' THEN scope_name END AS state,
         scope = 'National' AS is_national, role = 'holiday' AS is_holiday, role = 'event' AS is_event,
         (role = 'holiday' AND NOT transferred) OR role IN ('transfer', 'bridge') AS is_day_off,
         CAST(max(offset_days) OVER k - min(offset_days) OVER k + 1 AS INTEGER) AS holiday_duration
  FROM keyed WINDOW k AS (PARTITION BY anchor_key))"""

HOLIDAY_DIM = with_(HOLIDAYS, PARSED, DIM) + "SELECT * FROM holiday_dim"

HOLIDAY_JOIN = with_(SALES, STORES, HOLIDAYS, PARSED, DIM) + """,
matched AS (
  SELECT date, NULL AS city, NULL AS state, is_holiday, holiday_duration, is_day_off, is_event, 'n' AS k
  FROM holiday_dim WHERE scope = 'National'
  UNION ALL SELECT date, city, NULL, is_holiday, holiday_duration, is_day_off, is_event, 'l'
  FROM holiday_dim WHERE scope = 'Local'
  UNION ALL SELECT date, NULL, state, is_holiday, holiday_duration, is_day_off, is_event, 'r'
  FROM holiday_dim WHERE scope = 'Regional'),
days AS (SELECT DISTINCT s.date, s.store_nbr, city, state FROM sales s JOIN stores t ON s.store_nbr = t.store_nbr),
flags AS (
  SELECT d.date, d.store_nbr, max(CAST(is_holiday AS INTEGER)) AS h, max(holiday_duration) AS n,
         max(CAST(is_day_off AS INTEGER)) AS o, max(CAST(is_event AS INTEGER)) AS e
  FROM days d LEFT JOIN matched m
    ON d.date = m.date AND (m.k = 'n' OR m.city = d.city OR m.state = d.state) GROUP BY 1, 2)
SELECT s.*, coalesce(h, 0) AS is_holiday, coalesce(n, 0) AS holiday_duration, coalesce(o, 0) AS is_day_off,
       coalesce(e, 0) AS is_event
FROM sales s LEFT JOIN flags f ON s.date = f.date AND s.store_nbr = f.store_nbr"""

# --- Calendar -------------------------------------------------------------------------------------------------------


def calendar(origin: str) -> str:
    return f"""
  CAST(extract(day FROM date) AS INTEGER) AS day_in_the_month, CAST(isodow(date) - 1 AS INTEGER) AS day_of_the_week,
  CAST(extract(week FROM date) AS INTEGER) AS week_of_the_year, CAST(extract(month FROM date) AS INTEGER) AS month,
  CAST(extract(year FROM date) AS INTEGER) AS year, CAST(extract(quarter FROM date) AS INTEGER) AS quarter,
  isodow(date) >= 6 AS is_weekend, extract(day FROM date) = 1 AS is_month_start, date = last_day(date) AS is_month_end,
  date = CAST(date_trunc('quarter', date) AS DATE) AS is_quarter_start,
  CAST(date + INTERVAL 1 DAY AS DATE) = CAST(date_trunc('quarter', date + INTERVAL 1 DAY) AS DATE) AS is_quarter_end,
  CAST(date_diff('day', {origin}, date) AS INTEGER) AS days_since_start"""


CALENDAR = with_(SALES) + f"SELECT *, {calendar('(SELECT min(date) FROM sales)')} FROM sales"

RANGE_CALENDAR = with_(SALES) + f"""
SELECT *, CASE WHEN date BETWEEN {LO} AND {HI} THEN CAST(extract(week FROM date) AS INTEGER) END AS week_of_year,
       CASE WHEN date BETWEEN {LO} AND {HI} THEN CAST(extract(month FROM date) AS INTEGER) END AS month_of_year,
       CASE WHEN date BETWEEN {LO} AND {HI} THEN CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END END AS is_weekend
FROM sales"""

SLICE_DATES = with_(SALES) + f"""
SELECT date, store_nbr, item_nbr, onpromotion FROM sales WHERE date BETWEEN {LO} AND {HI}"""

DATE_BOUNDS = with_(SALES) + "SELECT min(date) AS min_date, max(date) AS max_date FROM sales"

DISTINCT_DATES = with_(SALES) + "SELECT DISTINCT date FROM sales"

# --- Windows --------------------------------------------------------------------------------------------------------


def lags(offsets: list[int], over: str = SERIES) -> list[str]:
    return [f"lag(unit_sales, {k}) OVER ({over}) AS unit_sales_lag_{k}" for k in offsets]


def rolling(shifts: list[int], widths: list[int], stats: list[str] | None = None) -> list[str]:
    out = []
    for stat in stats or list(STATS):
        for v in shifts:
            for w in widths:
                frame = f"({SERIES} ROWS BETWEEN {v + w - 1} PRECEDING AND {v} PRECEDING)"
                value = f"CASE WHEN count(unit_sales) OVER {frame} = {w} THEN {STATS[stat]}(unit_sales) OVER {frame} END"
                out.append(f"ROUND({value}, 6) AS unit_sales_roll{w}_{stat}_lag{v}")
    return out


def expanding(shifts: list[int], stats: list[str] | None = None, over: str = SERIES) -> list[str]:
    return [
        f"ROUND({STATS[stat]}(unit_sales) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND {v} PRECEDING), 6)"
        f" AS unit_sales_exp_{stat}_lag{v}"
        for stat in stats or list(STATS)
        for v in shifts
    ]


def over_sales(columns: list[str]) -> str:
    return with_(SALES) + "SELECT *,\n  " + ",\n  ".join(columns) + "\nFROM sales"


LAGS = over_sales(lags([1, 7, 14, 28]))
LAGS_UNGROUPED = over_sales(lags([1, 7], "ORDER BY date, store_nbr, item_nbr"))
ROLLING = over_sales(rolling([1], [7, 14]))
EXPANDING = over_sales(expanding([1, 7]))
# Where the tables of the engine hold NaN, SQL holds NULL.
NAN_SALES = """all_sales AS (SELECT * FROM sales_before),
sales AS (SELECT date, store_nbr, item_nbr, CASE WHEN (item_nbr + extract(day FROM date)) % 5 = 0 THEN NULL
  ELSE CAST(unit_sales AS DOUBLE) END AS unit_sales, onpromotion FROM all_sales)"""
ROLLING_NAN = ROLLING.replace(SALES, SALES.replace("sales AS (", "sales_before AS (", 1) + ",\n" + NAN_SALES)
EXPANDING_NAN = EXPANDING.replace(SALES, SALES.replace("sales AS (", "sales_before AS (", 1) + ",\n" + NAN_SALES)
EXPANDING_BY_STORE = over_sales(
    expanding([1], ["mean", "max", "min", "sum"], "PARTITION BY store_nbr ORDER BY date, item_nbr")
)

SEEN = f"({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
COMING = f"({SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
PROMO_DATE = "CASE WHEN onpromotion THEN date END"
SINCE = (
    f"CAST(date_diff('day', last_value({PROMO_DATE} IGNORE NULLS) OVER {SEEN}, date) AS INTEGER)"
    " AS days_since_last_promo"
)
UNTIL = (
    f"CAST(date_diff('day', date, first_value({PROMO_DATE} IGNORE NULLS) OVER {COMING}) AS INTEGER)"
    " AS days_until_next_promo"
)
NEXT = f"""CASE WHEN max(CAST(onpromotion AS INTEGER)) OVER ({SERIES} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) = 1 THEN 1
       WHEN count(onpromotion) OVER ({SERIES} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) = 7 THEN 0 END
       AS promo_in_next_7days"""

DAYS_SINCE = over_sales([SINCE])
DAYS_UNTIL = over_sales([UNTIL])
NEXT_7 = over_sales([NEXT])

# Gaps and islands: every row that is not a promo starts a new run.
RUNS = f"""runs AS (
  SELECT *, sum(CASE WHEN onpromotion THEN 0 ELSE 1 END) OVER {SEEN} AS run FROM sales)"""
RUN_LENGTH = """CASE WHEN onpromotion THEN CAST(count(CASE WHEN onpromotion THEN 1 END) OVER (
         PARTITION BY store_nbr, item_nbr, run ORDER BY date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
       WHEN NOT onpromotion THEN 0 END AS promo_streak"""
STREAK = with_(SALES, RUNS) + f"SELECT * EXCLUDE (run), {RUN_LENGTH} FROM runs"

PROMO_WORDS = with_(TEXT_PROMOS) + """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE lower(trim(promo_text)) WHEN 'true' THEN TRUE WHEN 'yes' THEN TRUE WHEN 'false' THEN FALSE
            WHEN 'no' THEN FALSE END AS from_words,
       l_tax <> 0 AS from_numbers, l_tax <> 0 AS from_number_text
FROM text_promos"""

PROMO_STRATEGY = with_(SALES) + """
SELECT *, CASE WHEN onpromotion THEN 'true' WHEN NOT onpromotion THEN 'false' ELSE 'NO_PROMO_INFO' END
       AS onpromotion_processed FROM sales"""

# --- Seasonality ----------------------------------------------------------------------------------------------------

WEEK = "CAST(extract(week FROM date) AS INTEGER)"
MONTH = "CAST(extract(month FROM date) AS INTEGER)"
DATED = f"""dated AS (
  SELECT *, CAST(extract(year FROM date) AS INTEGER) AS year, {WEEK} AS week_of_year, {MONTH} AS month_of_year
  FROM sales)"""


def index(kind: str, period: str, where: str = "TRUE", extra: str = "") -> str:
    e = f"{extra}, " if extra else ""
    join = f"USING ({e}year)"
    return f"""idx_{kind} AS (
  SELECT {e}year, {period}, p / nullif(y, 0) AS v FROM
    (SELECT {e}year, {period}, avg(unit_sales) AS p FROM dated WHERE {where} GROUP BY ALL)
    JOIN (SELECT {e}year, avg(unit_sales) AS y FROM dated WHERE {where} GROUP BY ALL) {join})"""


def coefficient(kind: str, period: str, where: str = "TRUE", extra: str = "") -> str:
    """Literal weighted average over all pairs of a year and an earlier year of the same period."""
    e = f"{extra}, " if extra else ""
    ce = f"c.{extra}, " if extra else ""
    same = f"AND c.{extra} = p.{extra}" if extra else ""
    return f"""hist_{kind} AS (
  SELECT *, row_number() OVER (PARTITION BY {e}{period} ORDER BY year) AS rn FROM idx_{kind} WHERE {where}),
coef_{kind} AS (
  SELECT {ce}c.year, c.{period},
         CASE WHEN count(p.rn) = 0 OR count(p.v) < count(p.rn) THEN NULL
              WHEN count(p.rn) = 1 THEN max(p.v)
              ELSE 0.8 * max(p.v) FILTER (p.rn = c.rn - 1)
                   + 0.2 * sum(exp(-CAST(p.rn AS DOUBLE)) * p.v) FILTER (p.rn < c.rn - 1)
                         / sum(exp(-CAST(p.rn AS DOUBLE))) FILTER (p.rn < c.rn - 1) END AS coeff
  FROM hist_{kind} c LEFT JOIN hist_{kind} p ON c.{period} = p.{period} AND p.rn < c.rn {same}
  GROUP BY {ce}c.year, c.{period}, c.rn)"""


IN_YEARS = f"year BETWEEN {Y_LO} AND {Y_HI}"
SEASONAL_W = with_(SALES, DATED, index("w", "week_of_year", IN_YEARS)) + """
SELECT d.* EXCLUDE (month_of_year), ROUND(v, 6) AS seasonal_idx_w
FROM dated d LEFT JOIN idx_w USING (year, week_of_year)"""
SEASONAL_M = with_(SALES, DATED, index("m", "month_of_year")) + """
SELECT d.* EXCLUDE (week_of_year), ROUND(v, 6) AS seasonal_idx_m
FROM dated d LEFT JOIN idx_m USING (year, month_of_year)"""
COEFF_W = with_(SALES, DATED, index("w", "week_of_year"), coefficient("w", "week_of_year", IN_YEARS)) + f"""
SELECT d.* EXCLUDE (month_of_year), ROUND(v, 6) AS seasonal_idx_w, ROUND(coeff, 6) AS regular_coeff
FROM dated d LEFT JOIN idx_w USING (year, week_of_year) LEFT JOIN coef_w USING (year, week_of_year) WHERE {IN_YEARS}"""
COEFF_M = with_(SALES, DATED, index("m", "month_of_year"), coefficient("m", "month_of_year")) + """
SELECT d.* EXCLUDE (week_of_year), ROUND(v, 6) AS seasonal_idx_m, ROUND(coeff, 6) AS regular_coeff
FROM dated d LEFT JOIN idx_m USING (year, month_of_year) LEFT JOIN coef_m USING (year, month_of_year)"""


def seasonal_tables(extra: str = "") -> list[str]:
    return [
        DATED,
        index("w", "week_of_year", extra=extra),
        index("m", "month_of_year", extra=extra),
        coefficient("w", "week_of_year", extra=extra),
        coefficient("m", "month_of_year", extra=extra),
    ]


SEASONAL_COLUMNS = """ROUND(iw.v, 6) AS seasonal_idx_w, ROUND(im.v, 6) AS seasonal_idx_m,
       ROUND(cw.coeff, 6) AS regular_coeff_w, ROUND(cm.coeff, 6) AS regular_coeff_m"""


def seasonal_joins(extra: str = "") -> str:
    e = f"{extra}, " if extra else ""
    return "\n".join(
        f"LEFT JOIN {table} {alias} USING ({e}year, {period})"
        for table, alias, period in (
            ("idx_w", "iw", "week_of_year"),
            ("idx_m", "im", "month_of_year"),
            ("coef_w", "cw", "week_of_year"),
            ("coef_m", "cm", "month_of_year"),
        )
    )


SEASONALITY = with_(SALES, *seasonal_tables()) + f"SELECT d.*, {SEASONAL_COLUMNS}\nFROM dated d\n{seasonal_joins()}"
SEASONALITY_BY_STORE = (
    with_(SALES, *seasonal_tables("store_nbr"))
    + f"SELECT d.*, {SEASONAL_COLUMNS}\nFROM dated d\n{seasonal_joins('store_nbr')}"
)

# --- Gap-free series ------------------------------------------------------------------------------------------------


def cubic(name: str, source: str, value: str, out: str, keys: str = "") -> str:
    """Rows of ``source`` with ``out``: the shape-preserving cubic through the known values, by an as-of join."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    w = f"({part} ORDER BY x)"
    same = f"s.{keys} = p.{keys} AND" if keys else ""
    first = f"s.{keys} = f.{keys}" if keys else "TRUE"
    return f"""{name}_p AS (
  SELECT {k}x, y, lead(x) OVER {w} - x AS h, (lead(y) OVER {w} - y) / (lead(x) OVER {w} - x) AS s FROM
    (SELECT {k}CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE) AS x, CAST({value} AS DOUBLE) AS y
     FROM {source} WHERE {value} IS NOT NULL)),
{name}_n AS (
  SELECT *, lag(h) OVER {w} AS hp, lag(s) OVER {w} AS sp, lead(h) OVER {w} AS hn, lead(s) OVER {w} AS sn,
         lag(h, 2) OVER {w} AS hpp, lag(s, 2) OVER {w} AS spp FROM {name}_p),
{name}_e AS (
  SELECT *, CASE WHEN sp IS NULL THEN ((2 * h + hn) * s - h * sn) / (h + hn)
                 WHEN s IS NULL THEN ((2 * hp + hpp) * sp - hp * spp) / (hp + hpp) END AS e FROM {name}_n),
{name}_d AS (
  SELECT *, CASE WHEN sp IS NULL THEN CASE WHEN sign(e) <> sign(s) THEN 0
                                           WHEN sign(s) <> sign(sn) AND abs(e) > 3 * abs(s) THEN 3 * s ELSE e END
                 WHEN s IS NULL THEN CASE WHEN sign(e) <> sign(sp) THEN 0
                                          WHEN sign(sp) <> sign(spp) AND abs(e) > 3 * abs(sp) THEN 3 * sp ELSE e END
                 WHEN sp * s <= 0 THEN 0
                 ELSE (3 * hp + 3 * h) / ((2 * h + hp) / sp + (h + 2 * hp) / s) END AS d FROM {name}_e),
{name}_c AS (
  SELECT {k}x, y, h, s, d AS d0, lead(d) OVER {w} AS d1 FROM {name}_d QUALIFY lead(d) OVER {w} IS NOT NULL),
{name}_f AS (SELECT {k}min(x) AS x0 FROM {name}_c GROUP BY ALL),
{name}_s AS (
  SELECT s.*, CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE) AS t, greatest(
    CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE), f.x0) AS t_at
  FROM {source} s JOIN {name}_f f ON {first}),
{name} AS (
  SELECT s.* EXCLUDE (t, t_at), p.y + (t - p.x) * (d0 + (t - p.x) * ((3 * p.s - 2 * d0 - d1) / h
         + (t - p.x) * (d0 + d1 - 2 * p.s) / (h * h))) AS {out}
  FROM {name}_s s ASOF LEFT JOIN {name}_c p ON {same} s.t_at >= p.x)"""


OIL_NUMBERED = """oil_n AS (
  SELECT *, CAST(date_diff('day', (SELECT min(date) FROM oil), date) AS INTEGER) AS date_numeric FROM oil)"""
OIL_FILLED = cubic("oil_filled", "oil_n", "dcoilwtico", "dcoilwtico_filled")
OIL_PCHIP = with_(OIL, OIL_NUMBERED, OIL_FILLED) + """
SELECT date, ROUND(dcoilwtico, 6) AS dcoilwtico, date_numeric, ROUND(dcoilwtico_filled, 6) AS dcoilwtico_filled
FROM oil_filled"""

SPINE = """spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(date) AS lo, max(date) AS hi FROM oil_filled)),
oil_full AS (SELECT date, dcoilwtico, dcoilwtico_filled FROM spine LEFT JOIN oil_filled USING (date))"""
OIL_DENSE = (
    with_(OIL, OIL_NUMBERED, OIL_FILLED, SPINE, cubic("dense", "oil_full", "dcoilwtico_filled", "dcoilwtico_complete"))
    + f"SELECT date, {rounded('dcoilwtico', 6)}, {rounded('dcoilwtico_filled', 6)}, {rounded('dcoilwtico_complete', 6)}"
    + " FROM dense"
)
OIL_REVIEW = with_(OIL, OIL_NUMBERED, OIL_FILLED) + f"""
SELECT date, ROUND(dcoilwtico, 6) AS value, ROUND(dcoilwtico_filled, 6) AS filled, dcoilwtico IS NULL AS is_filled,
       date BETWEEN {LO} AND {HI} AS in_zoom FROM oil_filled"""

ITEM_PRICE_DENSE = (
    with_(STORE_PRICES, cubic("price_f", "store_prices", "price", "price_filled", "item_nbr"))
    + """,
ends AS (SELECT item_nbr, min(date) AS lo, max(date) AS hi FROM price_f GROUP BY 1),
spine AS (SELECT item_nbr, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
price_full AS (SELECT item_nbr, date, price, price_filled FROM spine LEFT JOIN price_f USING (item_nbr, date)),
"""
    + cubic("price_c", "price_full", "price_filled", "price_complete", "item_nbr")
    + """
SELECT item_nbr, date, ROUND(price, 6) AS price, ROUND(price_filled, 6) AS price_filled,
       ROUND(price_complete, 6) AS price_complete FROM price_c"""
)

GAPS = """every_day AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (
    SELECT least((SELECT min(date) FROM oil), (SELECT min(date) FROM sales)) AS lo,
           greatest((SELECT max(date) FROM oil), (SELECT max(date) FROM sales)) AS hi)),
gaps AS (
  SELECT date, date NOT IN (SELECT date FROM oil) AS missing_in_oil,
         date NOT IN (SELECT date FROM sales) AS missing_in_train FROM every_day)"""
CALENDAR_GAPS = with_(SALES, OIL, GAPS) + "SELECT * FROM gaps"
CALENDAR_GAP_COUNTS = with_(SALES, OIL, GAPS) + """
SELECT count(*) FILTER (missing_in_oil) AS missing_in_oil, count(*) FILTER (missing_in_train) AS missing_in_train,
       count(*) FILTER (missing_in_oil AND NOT missing_in_train) AS missing_in_oil_present_in_train FROM gaps"""
CALENDAR_GAP_SAMPLE = with_(SALES, OIL, GAPS) + """
SELECT date FROM gaps WHERE missing_in_oil AND NOT missing_in_train ORDER BY date LIMIT 10"""

# --- Folds, scores and profiles -------------------------------------------------------------------------------------

FOLDS = f"""dates AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos FROM (SELECT DISTINCT date FROM sales)),
positions AS (
  SELECT i AS fold, n - i * {STRIDE} AS ve, n - i * {STRIDE} - {VAL} AS vs, n - i * {STRIDE} - {VAL} - {EMBARGO} AS te
  FROM (SELECT count(*) AS n FROM dates), unnest(range({N_FOLDS})) AS r(i)),
folds AS (
  SELECT CAST(fold AS INTEGER) AS fold, a.date AS train_start, b.date AS train_end, c.date AS val_start, d.date AS val_end
  FROM positions JOIN dates a ON a.pos = 0 JOIN dates b ON b.pos = te - 1 JOIN dates c ON c.pos = vs
       JOIN dates d ON d.pos = ve - 1 WHERE te >= {MIN_TRAIN})"""
CV_FOLDS = with_(SALES, FOLDS) + "SELECT * FROM folds"
CV_FEASIBILITY = with_(SALES) + f"""
SELECT count(DISTINCT date) AS n_dates, CAST({MIN_TRAIN + EMBARGO + VAL} AS INTEGER) AS required_min_dates,
       count(DISTINCT date) >= {MIN_TRAIN + EMBARGO + VAL} AS feasible FROM sales"""

SCORES = f"""lagged AS (SELECT date, unit_sales AS y, lag(unit_sales) OVER ({SERIES}) AS yhat FROM sales),
scores AS (
  SELECT fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, sum(abs(y - yhat)) / (sum(abs(y)) + 1e-8) AS wmape
  FROM lagged JOIN folds ON date BETWEEN val_start AND val_end WHERE yhat IS NOT NULL GROUP BY fold)"""
METRICS = with_(SALES, FOLDS, SCORES) + 'SELECT fold, ROUND(rmse, 6) AS "RMSE", ROUND(wmape, 6) AS "WMAPE" FROM scores'
FOLD_SUMMARY = with_(SALES, FOLDS, SCORES) + """
SELECT 'RMSE' AS metric, ROUND(avg(rmse), 6) AS mean, ROUND(stddev_pop(rmse), 6) AS std FROM scores
UNION ALL SELECT 'WMAPE', ROUND(avg(wmape), 6), ROUND(stddev_pop(wmape), 6) FROM scores"""

PROFILE_COLUMNS = ["date", "store_nbr", "item_nbr", "unit_sales", "onpromotion", "family", "class", "city", "state"]
PROFILE_TYPES = {"date": 1, "bigint": 1, "int": 2, "double": 1, "boolean": 1, "string": 3}


def _profile() -> str:
    lines = ["SELECT 'shape' AS section, 'rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM enriched"]
    lines.append(f"SELECT 'shape', 'columns', CAST({len(PROFILE_COLUMNS)} AS DOUBLE)")
    lines += [f"SELECT 'dtype', '{kind}', CAST({n} AS DOUBLE)" for kind, n in PROFILE_TYPES.items()]
    for c in PROFILE_COLUMNS:
        lines.append(f"SELECT 'null_ratio', '{c}', ROUND(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM enriched")
        lines.append(
            f"SELECT 'constant', '{c}', 1.0 FROM enriched"
            f" HAVING count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1"
        )
    for c in ("family", "city", "state"):
        lines.append(
            f"SELECT 'cardinality', '{c}', CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE)"
            " FROM enriched"
        )
    for name, value in (
        ("count", "CAST(count(unit_sales) AS DOUBLE)"),
        ("nulls", "CAST(count(*) - count(unit_sales) AS DOUBLE)"),
        ("mean", "ROUND(avg(unit_sales), 6)"),
        ("std", "ROUND(stddev_samp(unit_sales), 6)"),
    ):
        lines.append(f"SELECT 'target', '{name}', {value} FROM enriched")
    return "\nUNION ALL ".join(lines)


PROFILE = with_(SALES, ITEMS, STORES, ENRICHED) + _profile()

FIRST_ROWS = with_(SALES) + "SELECT * FROM sales ORDER BY date, store_nbr, item_nbr LIMIT 2000"

PROMO_COLUMNS = [SINCE, UNTIL, NEXT]


def features(visible: str, columns: list[str]) -> str:
    """All features of the rows in ``sales``; calendar and seasonal columns are measured on the rows in ``visible``."""
    seasonal = [t.replace("FROM sales)", f"FROM {visible})") for t in seasonal_tables()]
    streaks = f"streaks AS (SELECT date, store_nbr, item_nbr, {RUN_LENGTH} FROM runs)"
    selected = ",\n  ".join([*PROMO_COLUMNS, *columns])
    return ",\n".join([RUNS, streaks, *seasonal]) + f""",
wide AS (SELECT *, {calendar(f"(SELECT min(date) FROM {visible})")},
  {selected}
  FROM sales)
SELECT w.*, d.week_of_year, d.month_of_year, promo_streak, {SEASONAL_COLUMNS}
FROM wide w JOIN dated d USING (date, store_nbr, item_nbr) JOIN streaks USING (date, store_nbr, item_nbr)
LEFT JOIN idx_w iw ON d.year = iw.year AND d.week_of_year = iw.week_of_year
LEFT JOIN idx_m im ON d.year = im.year AND d.month_of_year = im.month_of_year
LEFT JOIN coef_w cw ON d.year = cw.year AND d.week_of_year = cw.week_of_year
LEFT JOIN coef_m cm ON d.year = cm.year AND d.month_of_year = cm.month_of_year"""


ALL_SALES = "all_" + SALES
LIGHT = [*lags([7, 14]), *rolling([1], [7], ["mean"])]

FEATURE_MATRIX = with_(
    SALES, features("sales", [*lags([7, 14, 28]), *rolling([1], [7, 14, 28]), *expanding([1])])
)

FEATURE_MATRIX_QTY = FEATURE_MATRIX.replace("unit_sales", "qty")

# Windows read up to 400 days before the slice; calendar and seasonal columns see the slice alone.
FEATURE_SLICE = with_(
    ALL_SALES,
    f"sales AS (SELECT * FROM all_sales WHERE date BETWEEN {LO} - INTERVAL 400 DAY AND {HI})",
    f"visible AS (SELECT * FROM sales WHERE date >= {LO})",
    features("visible", LIGHT),
)

DEFAULT_FEATURES = [*lags([7, 14, 28]), *rolling([1], [7, 14, 28]), *expanding([1])]


def _fold_features() -> str:
    """Features of both sides of every fold, each from the rows of its own slice."""
    parts = []
    for fold in range(N_FOLDS):
        for part in ("train", "val"):
            inside = f"(SELECT {part}_start FROM folds WHERE fold = {fold}) AND (SELECT {part}_end FROM folds WHERE fold = {fold})"
            one = with_(
                ALL_SALES,
                FOLDS.replace("FROM sales", "FROM all_sales"),
                f"sales AS (SELECT * FROM all_sales WHERE date BETWEEN {inside})",
                features("sales", DEFAULT_FEATURES),
            )
            parts.append(f"SELECT CAST({fold} AS INTEGER) AS fold, '{part}' AS part, * FROM ({one})")
    return "\nUNION ALL BY NAME ".join(parts)


FOLD_FEATURES = _fold_features()
STORED_FEATURES = f"SELECT * EXCLUDE (fold, part) FROM ({_fold_features()}) WHERE fold = 0 AND part = 'val'"


def naive_scores(name: str = "scores", smoothing: str = "0.0") -> str:
    """Scores per fold of the mean of the week in training, drawn towards the overall mean by ``smoothing`` rows."""
    return f"""week_{name} AS (
  SELECT fold, extract(week FROM date) AS week, sum(unit_sales) AS total, count(unit_sales) AS known
  FROM sales JOIN folds ON date BETWEEN train_start AND train_end GROUP BY 1, 2),
overall_{name} AS (SELECT fold, sum(total) / sum(known) AS mean FROM week_{name} GROUP BY 1),
forecast_{name} AS (
  SELECT f.fold, s.unit_sales AS y, coalesce((w.total + {smoothing} * o.mean) / (w.known + {smoothing}), o.mean) AS yhat
  FROM sales s JOIN folds f ON s.date BETWEEN f.val_start AND f.val_end JOIN overall_{name} o ON o.fold = f.fold
       LEFT JOIN week_{name} w ON w.fold = f.fold AND w.week = extract(week FROM s.date)),
{name} AS (
  SELECT fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, sum(abs(y - yhat)) / (sum(abs(y)) + 1e-8) AS wmape
  FROM forecast_{name} GROUP BY fold)"""


BACKTEST_SCORES = with_(SALES, FOLDS, naive_scores()) + '''
SELECT fold, ROUND(rmse, 6) AS "RMSE", ROUND(wmape, 6) AS "WMAPE" FROM scores'''
BACKTEST_SUMMARY = with_(SALES, FOLDS, naive_scores()) + """
SELECT 'RMSE' AS metric, ROUND(avg(rmse), 6) AS mean, ROUND(stddev_pop(rmse), 6) AS std FROM scores
UNION ALL SELECT 'WMAPE', ROUND(avg(wmape), 6), ROUND(stddev_pop(wmape), 6) FROM scores"""
RUN_RECORDS = with_(SALES, FOLDS, naive_scores()) + """
SELECT 'fold_scores' AS record, CAST(fold AS INTEGER) AS fold, 'RMSE' AS name, ROUND(rmse, 6) AS value FROM scores
UNION ALL SELECT 'fold_scores', fold, 'WMAPE', ROUND(wmape, 6) FROM scores
UNION ALL SELECT 'cv_summary', NULL, 'RMSE', ROUND(avg(rmse), 6) FROM scores
UNION ALL SELECT 'cv_summary', NULL, 'WMAPE', ROUND(avg(wmape), 6) FROM scores
UNION ALL SELECT 'importance', fold, 'week_of_year', 1.0 FROM scores"""


def sweep_states(smoothings: list[float], startup: int) -> str:
    """Every trial judged in order by the median of the complete ones before it."""
    parts = [naive_scores(f"scores{i}", f"CAST({x!r} AS DOUBLE)") for i, x in enumerate(smoothings)]
    lists = ", ".join(f"(SELECT list(rmse ORDER BY fold) FROM scores{i}) AS s{i}" for i in range(len(smoothings)))
    parts.append(f"judged0 AS (SELECT {lists}, CAST([] AS DOUBLE[][]) AS done)")
    for i in range(len(smoothings)):
        worse = f"""len(list_filter(range(1, len(s{i}) + 1), lambda k: list_min(s{i}[1:k])
  > list_aggregate(list_transform(done, lambda d: d[k]), 'median'))) > 0"""
        parts.append(f"asked{i} AS (SELECT *, len(done) >= {startup} AND {worse} AS p{i} FROM judged{i})")
        parts.append(f"judged{i + 1} AS (SELECT * EXCLUDE (done), CASE WHEN p{i} THEN done ELSE list_append(done, s{i}) END AS done FROM asked{i})")
    rows = [
        f"SELECT CAST({i} AS INTEGER) AS number, CASE WHEN p{i} THEN 'PRUNED' ELSE 'COMPLETE' END AS state,"
        f" CASE WHEN NOT p{i} THEN ROUND(list_avg(s{i}), 6) END AS value FROM judged{len(smoothings)}"
        for i in range(len(smoothings))
    ]
    return with_(SALES, FOLDS, *parts) + "\n" + "\nUNION ALL ".join(rows)


def encoded(column: str) -> str:
    """Label codes: the most frequent label first, then by name; a missing one after all others."""
    return f"""codes_{column} AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS code, 1 AS one
  FROM enriched JOIN folds ON fold = 0 AND date BETWEEN train_start AND train_end WHERE {column} IS NOT NULL GROUP BY 1)"""


MODEL_INPUTS = with_(SALES, ITEMS, STORES, ENRICHED, FOLDS, *[encoded(c) for c in ("family", "city", "state")]) + """
SELECT e.date, e.store_nbr, e.item_nbr, CAST(e.onpromotion IS NULL AS DOUBLE) AS promotion_missing,
  coalesce(CAST(e.onpromotion AS DOUBLE), 0) AS promotion,
  coalesce(f.code, (SELECT CAST(count(*) AS DOUBLE) FROM codes_family)) AS family_code,
  coalesce(c.code, (SELECT CAST(count(*) AS DOUBLE) FROM codes_city)) AS city_code,
  coalesce(t.code, (SELECT CAST(count(*) AS DOUBLE) FROM codes_state)) AS state_code
FROM enriched e JOIN folds ON folds.fold = 0 AND (e.date BETWEEN train_start AND train_end OR e.date BETWEEN val_start AND val_end)
LEFT JOIN codes_family f ON f.family = e.family LEFT JOIN codes_city c ON c.city = e.city LEFT JOIN codes_state t ON t.state = e.state"""

CHANGED_DAY = "1997-06-15"
FOLD_CACHE_REUSE = with_(SALES, FOLDS) + f"""
SELECT DISTINCT date, date = DATE '{CHANGED_DAY}' AS rebuilt FROM sales
WHERE date <= (SELECT max(train_end) FROM folds)"""

NEW_DAYS = 14
NEW_DAY_FEATURES = f"SELECT * FROM ({FEATURE_MATRIX}) WHERE date > (SELECT CAST(max(l_shipdate) AS DATE) - {NEW_DAYS} FROM lineitem)"

CSV_TOLERANT = with_(SALES) + """
SELECT date, CAST(store_nbr AS INTEGER) AS store_nbr, item_nbr, unit_sales, onpromotion FROM sales WHERE item_nbr % 2 = 0"""

PROFILE_RANGE = PROFILE.replace("FROM enriched", "FROM ranged").replace(
    "SELECT 'shape' AS section", f", ranged AS (SELECT * FROM enriched WHERE date BETWEEN {LO} AND {HI})\nSELECT 'shape' AS section", 1
).replace("USING (store_nbr))\n,", "USING (store_nbr)),\n")

WINDOWS_CUT = over_sales([*lags([1, 28]), *rolling([1], [7, 28]), *expanding([1, 7])])

PLAIN_SLICE = with_(SALES) + f"SELECT * FROM sales WHERE date BETWEEN {LO} AND {HI}"
ALIGNED_JOIN = with_(SALES, STORES) + "SELECT sales.*, city, state FROM sales LEFT JOIN stores USING (store_nbr)"
RESOLVED_GROUPS = with_(SALES) + "SELECT store_nbr, sum(unit_sales) AS unit_sales, count(*) AS n FROM sales GROUP BY 1"
STORED_MODEL = with_(SALES, FOLDS, naive_scores()) + """
SELECT s.date, s.store_nbr, s.item_nbr, ROUND(coalesce(w.total / w.known, o.mean), 6) AS prediction
FROM sales s JOIN folds f ON s.date BETWEEN f.val_start AND f.val_end AND f.fold = 0 JOIN overall_scores o ON o.fold = 0
     LEFT JOIN week_scores w ON w.fold = 0 AND w.week = extract(week FROM s.date)"""

CSV_LOAD = with_(SALES) + """
SELECT date, CAST(store_nbr AS INTEGER) AS store_nbr, item_nbr, unit_sales, onpromotion FROM sales"""
