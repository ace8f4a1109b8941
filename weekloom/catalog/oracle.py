"""The same results in plain SQL, for checking the named queries.

Written against the given tables only; every text starts from one shared list of
common table expressions.
"""

from __future__ import annotations

from weekloom.catalog.texts import ANSWER_KINDS, ANSWER_TEXTS, QUERY_TEXTS, QUESTION_TEXT
from weekloom.fixed_values import (
    ALLOWED_TABLES, BLOCKED_PATTERN, CTE_PATTERN, LIMIT_PATTERN, MESSAGE_MULTI, MESSAGE_READ_ONLY, MESSAGE_TABLE,
    NA_TOKENS, NUMBER_PATTERN, READ_START_PATTERN, TABLE_PATTERN,
)


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _list(texts: list[str | None]) -> str:
    return "[" + ", ".join(_q(t) for t in texts) + "]"


def _date(column: str) -> str:
    return rf"CASE WHEN regexp_matches({column}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST({column} AS DATE) END"


def _long(column: str) -> str:
    return f"CAST(TRY_CAST({column} AS DECIMAL(38,0)) AS BIGINT)"


def _double(column: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({column} AS DOUBLE)) THEN TRY_CAST({column} AS DOUBLE) END"


STAGING = rf"""
raw_train AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "DATE", CAST(l_suppkey + 1 AS VARCHAR) AS STORE_NBR,
         p_type AS FAMILY, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS SALES,
         CAST(COUNT(*) FILTER (WHERE CAST(l_discount AS DECIMAL(4,2)) >= 0.05) AS VARCHAR) AS ONPROMOTION
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY CAST(l_shipdate AS DATE), l_suppkey, p_type),
raw_stores AS (
  SELECT CAST(s_suppkey + 1 AS VARCHAR) AS STORE_NBR, n_name AS CITY, r_name AS STATE,
         substr('ABCDE', CAST(s_suppkey % 5 + 1 AS INTEGER), 1) AS TYPE, CAST(s_suppkey % 17 + 1 AS VARCHAR) AS CLUSTER
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_oil AS (
  SELECT CAST(d AS VARCHAR) AS "DATE", CASE WHEN k % 29 <> 0 THEN CAST(p AS VARCHAR) END AS DCOILWTICO
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS p, MIN(o_orderkey) AS k
        FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY 1)),
raw_holidays AS (
  SELECT CAST(CAST(o_orderdate AS DATE) + 95 AS VARCHAR) AS "DATE",
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Work Day' ELSE 'Holiday' END AS TYPE,
         CASE o_orderkey % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional' ELSE 'Local' END AS LOCALE,
         CASE o_orderkey % 3 WHEN 0 THEN 'Ecuador' WHEN 1 THEN r_name ELSE n_name END AS LOCALE_NAME,
         CASE WHEN o_orderkey % 10 = 0 THEN 'True' ELSE 'False' END AS TRANSFERRED
  FROM (SELECT unnest([MIN(o_orderkey), MAX(o_orderkey)]) AS picked FROM orders
        WHERE day(CAST(o_orderdate AS DATE) + 95) IN (1, 15) GROUP BY CAST(o_orderdate AS DATE))
  JOIN orders ON o_orderkey = picked JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
raw_transactions AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "DATE", CAST(l_suppkey + 1 AS VARCHAR) AS STORE_NBR,
         CAST(COUNT(DISTINCT l_orderkey) AS VARCHAR) AS TRANSACTIONS
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_suppkey),
daily AS (
  SELECT {_date('"DATE"')} AS "DATE", {_long('STORE_NBR')} AS STORE_NBR, FAMILY, {_double('SALES')} AS SALES,
         {_long('ONPROMOTION')} AS ONPROMOTION FROM raw_train),
stores AS (
  SELECT {_long('STORE_NBR')} AS STORE_NBR, CITY, STATE, TYPE AS STORE_TYPE, {_long('CLUSTER')} AS STORE_CLUSTER
  FROM raw_stores),
prices AS (SELECT {_date('"DATE"')} AS "DATE", {_double('DCOILWTICO')} AS OIL_PRICE FROM raw_oil),
days AS (
  SELECT CAST(unnest(generate_series((SELECT MIN("DATE") FROM daily), (SELECT MAX("DATE") FROM daily), INTERVAL 1 DAY)) AS DATE) AS "DATE"),
oil AS (
  SELECT days."DATE", LAST_VALUE(OIL_PRICE IGNORE NULLS) OVER (
    ORDER BY days."DATE" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS OIL_PRICE
  FROM days LEFT JOIN prices ON days."DATE" = prices."DATE"),
holidays AS (
  SELECT DISTINCT s.STORE_NBR, h."DATE", 1 AS IS_HOLIDAY
  FROM (SELECT {_date('"DATE"')} AS "DATE", LOCALE, LOCALE_NAME FROM raw_holidays
        WHERE upper(TRANSFERRED) <> 'TRUE' AND TYPE <> 'Work Day') h
  JOIN stores s ON h.LOCALE = 'National' OR (h.LOCALE = 'Regional' AND h.LOCALE_NAME = s.STATE)
    OR (h.LOCALE = 'Local' AND h.LOCALE_NAME = s.CITY)),
traffic AS (
  SELECT {_date('"DATE"')} AS "DATE", {_long('STORE_NBR')} AS STORE_NBR, {_long('TRANSACTIONS')} AS TRANSACTIONS
  FROM raw_transactions),
enriched AS (
  SELECT d."DATE", d.STORE_NBR, d.FAMILY, d.SALES, d.ONPROMOTION, s.CITY, s.STATE, s.STORE_TYPE, s.STORE_CLUSTER,
         o.OIL_PRICE, COALESCE(h.IS_HOLIDAY, 0) AS IS_HOLIDAY, t.TRANSACTIONS
  FROM daily d LEFT JOIN stores s ON d.STORE_NBR = s.STORE_NBR LEFT JOIN oil o ON d."DATE" = o."DATE"
  LEFT JOIN holidays h ON d.STORE_NBR = h.STORE_NBR AND d."DATE" = h."DATE"
  LEFT JOIN traffic t ON d.STORE_NBR = t.STORE_NBR AND d."DATE" = t."DATE"),
weekly AS (
  SELECT STORE_NBR, FAMILY, CAST(date_trunc('week', "DATE") AS DATE) AS WEEK_START, any_value(CITY) AS CITY,
         any_value(STATE) AS STATE, any_value(STORE_TYPE) AS STORE_TYPE, any_value(STORE_CLUSTER) AS STORE_CLUSTER,
         SUM(SALES) AS SALES, CAST(SUM(ONPROMOTION) AS BIGINT) AS PROMO_ITEMS,
         CAST(SUM(IS_HOLIDAY) AS BIGINT) AS HOLIDAY_DAYS, AVG(OIL_PRICE) AS AVG_OIL_PRICE,
         CAST(SUM(TRANSACTIONS) AS BIGINT) AS STORE_TRANSACTIONS, COUNT(*) AS DAYS_IN_WEEK
  FROM enriched GROUP BY 1, 2, 3)"""

FEATURES = """
edges AS (SELECT MIN(WEEK_START) AS lo, MAX(WEEK_START) AS hi FROM weekly),
kept AS (SELECT weekly.* FROM weekly, edges WHERE WEEK_START > lo AND WEEK_START < hi),
series AS (SELECT STORE_NBR, FAMILY, any_value(CITY) AS CITY, any_value(STATE) AS STATE, any_value(STORE_TYPE) AS STORE_TYPE,
                  any_value(STORE_CLUSTER) AS STORE_CLUSTER FROM kept GROUP BY 1, 2),
weeks AS (SELECT CAST(unnest(generate_series((SELECT lo + 7 FROM edges), (SELECT hi - 7 FROM edges), INTERVAL 7 DAY)) AS DATE) AS WEEK_START),
dense AS (
  SELECT s.STORE_NBR, s.FAMILY, w.WEEK_START, s.CITY, s.STATE, s.STORE_TYPE, s.STORE_CLUSTER,
         COALESCE(k.SALES, 0.0) AS SALES, COALESCE(k.PROMO_ITEMS, 0) AS PROMO_ITEMS, COALESCE(k.HOLIDAY_DAYS, 0) AS HOLIDAY_DAYS,
         k.AVG_OIL_PRICE, k.STORE_TRANSACTIONS, COALESCE(k.DAYS_IN_WEEK, 0) AS DAYS_IN_WEEK
  FROM series s CROSS JOIN weeks w
  LEFT JOIN kept k ON k.STORE_NBR = s.STORE_NBR AND k.FAMILY = s.FAMILY AND k.WEEK_START = w.WEEK_START),
next_holidays AS (
  SELECT STORE_NBR, COUNT(*) AS N FROM holidays, edges WHERE "DATE" >= hi AND "DATE" < hi + 7 GROUP BY 1)"""


def _with_future(source: str) -> str:
    return f"""
  SELECT STORE_NBR, FAMILY, WEEK_START, STORE_TYPE, STORE_CLUSTER, SALES, PROMO_ITEMS, HOLIDAY_DAYS, AVG_OIL_PRICE,
         STORE_TRANSACTIONS, 0 AS IS_FUTURE FROM {source}
  UNION ALL
  SELECT l.STORE_NBR, l.FAMILY, (SELECT hi FROM edges), l.STORE_TYPE, l.STORE_CLUSTER, NULL, l.PROMO_ITEMS,
         COALESCE(n.N, 0), l.AVG_OIL_PRICE, NULL, 1
  FROM (SELECT *, row_number() OVER (PARTITION BY STORE_NBR, FAMILY ORDER BY WEEK_START DESC) AS rn FROM {source}) l
  LEFT JOIN next_holidays n ON n.STORE_NBR = l.STORE_NBR WHERE rn = 1"""


def _features_of(source: str) -> str:
    """Sums of decimals are exact; of doubles, the last digits depend on the engine."""
    lags = ", ".join(f"lag(SALES, {k}) OVER w AS SALES_LAG_{k}" for k in (1, 2, 4, 52))
    order = "PARTITION BY STORE_NBR, FAMILY ORDER BY WEEK_START"
    exact, past4, past12 = "CAST(SALES AS DECIMAL(19, 4))", f"({order} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)", f"({order} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"
    spread = f"COUNT(SALES) OVER {past12} * SUM({exact} * {exact}) OVER {past12} - CAST(SUM({exact}) OVER {past12} AS DECIMAL(19, 4)) * CAST(SUM({exact}) OVER {past12} AS DECIMAL(19, 4))"
    return f"""
  SELECT *, {lags},
         CAST(SUM({exact}) OVER {past4} AS DOUBLE) / COUNT(SALES) OVER {past4} AS SALES_ROLL_MEAN_4,
         CAST(SUM({exact}) OVER {past12} AS DOUBLE) / COUNT(SALES) OVER {past12} AS SALES_ROLL_MEAN_12,
         CASE WHEN COUNT(SALES) OVER {past12} > 1 THEN sqrt(CAST({spread} AS DOUBLE)
             / (COUNT(SALES) OVER {past12} * (COUNT(SALES) OVER {past12} - 1))) END AS SALES_ROLL_STD_12,
         CAST(week(WEEK_START) AS INTEGER) AS WEEK_OF_YEAR, CAST(month(WEEK_START) AS INTEGER) AS MONTH,
         CAST(year(WEEK_START) AS INTEGER) AS YEAR
  FROM {source} WINDOW w AS ({order})"""


SCORES = f"""
history AS ({_with_future('dense')}),
features AS ({_features_of('history')}),
actuals AS (SELECT * FROM features WHERE IS_FUTURE = 0),
test_weeks AS (SELECT DISTINCT WEEK_START FROM actuals ORDER BY WEEK_START DESC LIMIT 8),
top_series AS (SELECT STORE_NBR, FAMILY, round(SUM(SALES), 2) AS TOTAL_SALES FROM actuals GROUP BY 1, 2
               ORDER BY TOTAL_SALES DESC, STORE_NBR, FAMILY LIMIT 10),
tested AS (
  SELECT a.*, t.STORE_NBR IS NOT NULL AS IS_TOP, COALESCE(SALES_LAG_52, 0.0) AS PRED_NAIVE52,
         CASE WHEN t.STORE_NBR IS NOT NULL THEN SALES_ROLL_MEAN_4 END AS PRED_MEAN4
  FROM actuals a LEFT JOIN top_series t ON a.STORE_NBR = t.STORE_NBR AND a.FAMILY = t.FAMILY
  WHERE a.WEEK_START IN (SELECT WEEK_START FROM test_weeks)),
long AS (SELECT 'naive_52' AS MODEL, SALES, IS_TOP, PRED_NAIVE52 AS PRED FROM tested
         UNION ALL SELECT 'mean_4', SALES, IS_TOP, PRED_MEAN4 FROM tested),
results AS (
  SELECT MODEL, 'all' AS SCOPE, COUNT(PRED) AS N, SUM(abs(SALES - PRED)) / nullif(SUM(abs(SALES)) FILTER (WHERE PRED IS NOT NULL), 0) AS WAPE,
         sqrt(AVG((SALES - PRED) * (SALES - PRED))) AS RMSE
  FROM long GROUP BY MODEL HAVING COUNT(PRED) = COUNT(*)
  UNION ALL
  SELECT MODEL, 'top10', COUNT(PRED), SUM(abs(SALES - PRED)) / nullif(SUM(abs(SALES)) FILTER (WHERE PRED IS NOT NULL), 0),
         sqrt(AVG((SALES - PRED) * (SALES - PRED)))
  FROM long WHERE IS_TOP GROUP BY MODEL),
held_out AS (SELECT * FROM actuals WHERE WEEK_START = (SELECT MAX(WEEK_START) FROM actuals)),
accuracy_log AS (
  SELECT RUN_TS, MODEL, strftime(MAX(WEEK_START), '%Y-%m-%d') AS EVAL_WEEK, SUM(abs(SALES - PRED)) / nullif(SUM(abs(SALES)), 0) AS WAPE,
         COUNT(*) AS N_SERIES, CAST(1.5 AS DOUBLE) AS THRESHOLD, SUM(abs(SALES - PRED)) / nullif(SUM(abs(SALES)), 0) <= 1.5 AS PASSED
  FROM (SELECT '2001-10-22 06:00:00' AS RUN_TS, 'mean_4' AS MODEL, WEEK_START, SALES, COALESCE(SALES_ROLL_MEAN_4, 0.0) AS PRED FROM held_out
        UNION ALL
        SELECT '2001-10-29 06:00:00', 'naive_52', WEEK_START, SALES, COALESCE(SALES_LAG_52, 0.0) FROM held_out) GROUP BY 1, 2),
forecasts AS (
  SELECT STORE_NBR, FAMILY, WEEK_START, COALESCE(SALES_ROLL_MEAN_4, 0.0) AS FORECAST, 'mean_4' AS MODEL, '2001-10-22 06:00:00' AS RUN_TS
  FROM features WHERE IS_FUTURE = 1
  UNION ALL
  SELECT STORE_NBR, FAMILY, WEEK_START, COALESCE(SALES_LAG_52, 0.0), 'naive_52', '2001-10-29 06:00:00' FROM features WHERE IS_FUTURE = 1),
latest AS (SELECT * FROM forecasts WHERE RUN_TS = (SELECT MAX(RUN_TS) FROM forecasts)),
facts AS (
  SELECT f.STORE_NBR, f.FAMILY, f.WEEK_START, f.FORECAST, x.SALES_LAG_1 AS LAST_WEEK, x.SALES_LAG_52 AS SAME_WEEK_LAST_YEAR,
         x.SALES_ROLL_MEAN_4 AS AVG_4WK, CAST(x.PROMO_ITEMS AS DOUBLE) AS PROMO_ITEMS,
         COALESCE(CAST(x.HOLIDAY_DAYS AS DOUBLE), 0.0) AS HOLIDAY_DAYS, s.CITY, s.STATE, s.STORE_TYPE
  FROM latest f JOIN features x ON x.STORE_NBR = f.STORE_NBR AND x.FAMILY = f.FAMILY AND x.WEEK_START = f.WEEK_START
  JOIN stores s ON s.STORE_NBR = f.STORE_NBR)"""


def _pct(new: str, old: str) -> str:
    return f"(CASE WHEN {old} <> 0 THEN ({new} - {old}) / {old} * 100 END)"


def _direction(pct: str) -> str:
    return (
        f"COALESCE(CASE WHEN {pct} >= 0 THEN 'up ' ELSE 'down ' END || "
        f"CASE WHEN isinf({pct}) THEN 'inf' ELSE format('{{:.1f}}', abs({pct})) END || '%', 'n/a')"
    )


def _thousands(value: str) -> str:
    return f"format('{{:,.0f}}', {value})"


def _total(column: str) -> str:
    return f"round(COALESCE(SUM({column}), 0.0), 6)"


_LINE = (
    f"FAMILY || ' (' || {_thousands('FORECAST')} || ' vs ' || {_thousands('AVG_4WK')} || ', ' || "
    f"{_direction(_pct('FORECAST', 'AVG_4WK'))} || ')'"
)
DOCUMENTS = f"""
lines AS (
  SELECT STORE_NBR, LINE, row_number() OVER (PARTITION BY STORE_NBR ORDER BY CHANGE DESC, FAMILY) AS up_rank,
         row_number() OVER (PARTITION BY STORE_NBR ORDER BY CHANGE, FAMILY) AS down_rank
  FROM (SELECT STORE_NBR, FAMILY, round(FORECAST - AVG_4WK, 6) AS CHANGE, {_LINE} AS LINE FROM facts)
  WHERE CHANGE IS NOT NULL),
moves AS (
  SELECT STORE_NBR, string_agg(LINE, '; ' ORDER BY up_rank) FILTER (WHERE up_rank <= 3) AS MOVES_UP,
         string_agg(LINE, '; ' ORDER BY down_rank) FILTER (WHERE down_rank <= 3) AS MOVES_DOWN
  FROM lines GROUP BY STORE_NBR),
totals AS (
  SELECT STORE_NBR, any_value(CITY) AS CITY, any_value(STATE) AS STATE, any_value(STORE_TYPE) AS STORE_TYPE,
         {_total('FORECAST')} AS FC, {_total('LAST_WEEK')} AS LW, {_total('SAME_WEEK_LAST_YEAR')} AS LY, {_total('AVG_4WK')} AS A4,
         COUNT(*) FILTER (WHERE PROMO_ITEMS > 0) AS PROMO, COUNT(*) AS N, CAST(MAX(HOLIDAY_DAYS) AS BIGINT) AS HOL
  FROM facts GROUP BY STORE_NBR),
week AS (SELECT strftime(MAX(WEEK_START), '%Y-%m-%d') AS W FROM facts),
store_docs AS (
  SELECT t.STORE_NBR, W AS WEEK_START, 'Store ' || t.STORE_NBR || ' (' || COALESCE(CITY, 'None') || ', ' || COALESCE(STATE, 'None')
    || '; store type ' || COALESCE(STORE_TYPE, 'None') || ') - forecast for the week of ' || W || '. Total forecast sales: ' || {_thousands('FC')}
    || ', ' || {_direction(_pct('FC', 'LW'))} || ' vs last week (' || {_thousands('LW')} || '), ' || {_direction(_pct('FC', 'A4'))}
    || ' vs its 4-week average (' || {_thousands('A4')} || '), and ' || {_direction(_pct('FC', 'LY'))}
    || ' vs the same week last year (' || {_thousands('LY')} || '). Largest expected increases vs the 4-week average: '
    || COALESCE(MOVES_UP, '') || '. Largest expected decreases: ' || COALESCE(MOVES_DOWN, '')
    || '. Product families with items on promotion last week: ' || PROMO || ' of ' || N
    || '. Holiday days at this store during the forecast week: ' || HOL || '.' AS SUMMARY
  FROM totals t LEFT JOIN moves m ON t.STORE_NBR = m.STORE_NBR, week),
changes AS (
  SELECT STORE_NBR, PCT, 'store ' || STORE_NBR || ' (' || {_direction('PCT')} || ')' AS LINE
  FROM (SELECT STORE_NBR, CASE WHEN LW <> 0 THEN (FC - LW) / LW * 100 WHEN FC > 0 THEN CAST('inf' AS DOUBLE)
                               WHEN FC < 0 THEN CAST('-inf' AS DOUBLE) END AS PCT FROM totals)
  WHERE PCT IS NOT NULL),
chain_docs AS (
  SELECT CAST(0 AS BIGINT) AS STORE_NBR, W AS WEEK_START, 'Chain-wide forecast for the week of ' || W || ': total forecast sales '
    || {_thousands('FC')} || ' across ' || S || ' stores and ' || N || ' product families, ' || {_direction(_pct('FC', 'LW'))}
    || ' vs last week (' || {_thousands('LW')} || '). Stores with the largest expected increase vs last week: '
    || (SELECT string_agg(LINE, ', ' ORDER BY PCT DESC, STORE_NBR) FROM (SELECT * FROM changes ORDER BY PCT DESC, STORE_NBR LIMIT 5))
    || '. Stores with the largest expected decrease vs last week: '
    || (SELECT string_agg(LINE, ', ' ORDER BY PCT, STORE_NBR) FROM (SELECT * FROM changes ORDER BY PCT, STORE_NBR LIMIT 5)) || '.' AS SUMMARY
  FROM (SELECT {_total('FORECAST')} AS FC, {_total('LAST_WEEK')} AS LW, COUNT(DISTINCT STORE_NBR) AS S, COUNT(DISTINCT FAMILY) AS N FROM facts), week)"""

VECTORS = """
parts AS (
  SELECT vec_id, CAST(label AS BIGINT) AS store_nbr, unnest(generate_series(0, len(embedding) - 1)) AS POS,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
norms AS (SELECT vec_id, sqrt(SUM(x * x)) AS n FROM parts GROUP BY 1),
units AS (SELECT p.vec_id, store_nbr, POS, x / n AS VALUE FROM parts p JOIN norms USING (vec_id)),
asked AS (SELECT POS, VALUE FROM units WHERE vec_id = (SELECT MIN(vec_id) FROM embeddings)),
scored AS (SELECT vec_id, store_nbr, round(SUM(u.VALUE * a.VALUE), 9) AS RAW FROM units u JOIN asked a USING (POS) GROUP BY 1, 2),
means AS (SELECT store_nbr AS QUESTION_ID, POS, round(AVG(x), 9) AS m FROM parts GROUP BY 1, 2),
question_norms AS (SELECT QUESTION_ID, sqrt(SUM(m * m)) AS n FROM means GROUP BY 1),
questions AS (SELECT QUESTION_ID, POS, m / n AS VALUE FROM means JOIN question_norms USING (QUESTION_ID)),
pairs AS (
  SELECT QUESTION_ID, vec_id, store_nbr, round(SUM(u.VALUE * q.VALUE), 9) AS RAW, store_nbr = QUESTION_ID AS NAMED
  FROM units u JOIN questions q USING (POS) GROUP BY 1, 2, 3)"""

_CTES = {"staging": STAGING, "features": FEATURES, "scores": SCORES, "documents": DOCUMENTS}


def _refreshed() -> str:
    """The documents without every fifth store, and what became of each."""
    scores = SCORES.strip().replace("\nfacts AS (", "\nevery_fact AS (") + ",\nfacts AS (SELECT * FROM every_fact WHERE STORE_NBR % 5 <> 2)"
    shared = ",\n".join([STAGING.strip(), FEATURES.strip(), scores, DOCUMENTS.strip()])
    return f"""WITH {shared}
SELECT STORE_NBR, CASE STORE_NBR % 5 WHEN 0 THEN 'new' WHEN 1 THEN 'changed' ELSE 'same' END AS STATE,
       CAST(CASE STORE_NBR % 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS N_LOGGED, WEEK_START, SUMMARY FROM store_docs
UNION ALL SELECT STORE_NBR, 'changed', 2, WEEK_START, SUMMARY FROM chain_docs
UNION ALL SELECT DISTINCT STORE_NBR, 'vanished', 2, NULL, NULL FROM every_fact WHERE STORE_NBR % 5 = 2"""


def _with(level: str, select: str) -> str:
    """``select`` after all shared expressions up to ``level``."""
    if level == "vectors":
        return f"WITH {VECTORS.strip()}\n{select.strip()}"
    names = list(_CTES)
    used = [_CTES[n].strip() for n in names[: names.index(level) + 1]]
    return "WITH " + ",\n".join(used) + "\n" + select.strip()


_WEEKLY = """STORE_NBR, FAMILY, WEEK_START, CITY, STATE, STORE_TYPE, STORE_CLUSTER, round(SALES, 2) AS SALES, PROMO_ITEMS,
  HOLIDAY_DAYS, round(AVG_OIL_PRICE, 6) AS AVG_OIL_PRICE, STORE_TRANSACTIONS, DAYS_IN_WEEK"""
_INPUTS = """STORE_NBR, FAMILY, WEEK_START, STORE_TYPE, STORE_CLUSTER, round(SALES, 2) AS SALES, PROMO_ITEMS, HOLIDAY_DAYS,
  round(AVG_OIL_PRICE, 6) AS AVG_OIL_PRICE, STORE_TRANSACTIONS, IS_FUTURE"""
_LAGS = ", ".join(f"round(SALES_LAG_{k}, 2) AS SALES_LAG_{k}" for k in (1, 2, 4, 52))
_ROLLS = ", ".join(f"round({c}, 6) AS {c}" for c in ("SALES_ROLL_MEAN_4", "SALES_ROLL_MEAN_12", "SALES_ROLL_STD_12"))
_KEYS = "STORE_NBR, FAMILY, WEEK_START"
_AVG_CENTS = "round(CAST(SUM(CAST(SALES AS DECIMAL(18,2))) AS DOUBLE) / COUNT(SALES), 6) AS AVG_SALES"
_FORECAST_SUM = "round(SUM(FORECAST), 6)"


def _waves() -> str:
    parts = []
    for k in (1, 2, 3):
        for fn in ("sin", "cos"):
            parts.append(f"round({fn}(2 * pi() * {k} * T / 52), 6) AS {fn.upper()}_{k}")
    return ", ".join(parts)


def _filled(expression: str, fills: dict[str, str]) -> str:
    for name, value in fills.items():
        expression = f"replace({expression}, '{{{name}}}', {value})"
    return expression


def _audit() -> str:
    text = _filled(
        f"({_list(QUERY_TEXTS)})[CAST(o_orderkey % {len(QUERY_TEXTS)} AS INTEGER) + 1]",
        {"k": "CAST(o_orderkey AS VARCHAR)", "c": "CAST(o_custkey AS VARCHAR)"},
    )
    blocked = "(?i)" + BLOCKED_PATTERN
    comma = r"(?i)\bfrom\s+[A-Za-z0-9_.\"]+(?:\s+(?:as\s+)?[A-Za-z0-9_]+)?\s*,"
    message = _q(MESSAGE_TABLE).replace("%s", "' || BAD || '")
    return rf"""
log AS (SELECT o_orderkey AS QUERY_ID, {text} AS QUERY FROM orders),
clean AS (SELECT *, regexp_replace(regexp_replace(QUERY, '^\s+|\s+$', '', 'g'), ';+$', '') AS T FROM log),
parsed AS (
  SELECT *, list_transform(regexp_extract_all(T, {_q(CTE_PATTERN)}, 1), lambda x: upper(x)) AS ctes,
         regexp_extract_all(T, {_q(TABLE_PATTERN)}, 1) AS names FROM clean),
offending AS (
  SELECT *, list_filter(names, lambda x: NOT list_contains({_list(ALLOWED_TABLES)}, upper(replace(x, '"', '')))
                                         AND NOT list_contains(ctes, upper(replace(x, '"', ''))))[1] AS BAD FROM parsed),
judged AS (
  SELECT *, CASE WHEN contains(T, ';') THEN 'multi_statement'
                 WHEN T IS NULL OR NOT regexp_matches(T, {_q(READ_START_PATTERN)}) OR regexp_matches(T, {_q(blocked)}) THEN 'not_read_only'
                 WHEN BAD IS NOT NULL THEN 'table_not_allowed' ELSE 'accepted' END AS VERDICT FROM offending),
audited AS (
  SELECT QUERY_ID, QUERY, VERDICT, CASE WHEN VERDICT = 'table_not_allowed' THEN BAD END AS OFFENDER,
         CASE VERDICT WHEN 'multi_statement' THEN {_q(MESSAGE_MULTI)} WHEN 'not_read_only' THEN {_q(MESSAGE_READ_ONLY)}
                      WHEN 'table_not_allowed' THEN {message} END AS ERROR,
         CASE WHEN VERDICT = 'accepted' THEN
           CASE WHEN regexp_matches(T, {_q(LIMIT_PATTERN)}) THEN T ELSE T || ' LIMIT 100' END END AS EXECUTED_SQL,
         regexp_matches(T, {_q(comma)}) AS COMMA_JOIN
  FROM judged)""".strip()


def _answers() -> str:
    kinds = "CAST(o_orderkey % 4 AS INTEGER) + 1"
    variant = "CAST((o_orderkey // 4) % 3 AS INTEGER) + 1"
    texts = "CASE KIND " + " ".join(f"WHEN '{k}' THEN ({_list(ANSWER_TEXTS[k])})[{variant}]" for k in ANSWER_KINDS) + " END"
    fills = {
        "k": "CAST(o_orderkey AS VARCHAR)", "c": "CAST(o_custkey AS VARCHAR)", "p": "o_orderpriority", "s": "o_orderstatus",
        "n": "format('{:,.2f}', o_totalprice)", "h": "format('{:,.1f}', o_totalprice / 1000)",
        "m": "format('{:,.3f}', o_totalprice / 1000000)",
    }
    return rf"""
kinds AS (SELECT *, ({_list(ANSWER_KINDS)})[{kinds}] AS KIND FROM orders),
cases AS (SELECT *, {_filled(texts, fills)} AS ANSWER FROM kinds),
found AS (
  SELECT *, list_transform(regexp_extract_all(replace(ANSWER, ',', ''), {_q(NUMBER_PATTERN)}), lambda x: CAST(x AS DOUBLE)) AS nums,
         lower(ANSWER) AS a FROM cases),
scored AS (
  SELECT o_orderkey AS CASE_ID, KIND, ANSWER, CASE KIND
    WHEN 'ints' THEN list_contains(nums, CAST(o_custkey AS DOUBLE)) AND list_contains(nums, CAST(o_orderkey AS DOUBLE))
    WHEN 'text' THEN contains(a, lower(split_part(replace(o_orderpriority, ' ', '_'), '_', 1)))
    WHEN 'number' THEN len(list_filter(nums, lambda n:
         (o_totalprice <> 0 AND abs(n - o_totalprice) <= abs(o_totalprice) * 0.015)
      OR (o_totalprice <> 0 AND abs(n - o_totalprice * 100.0) <= abs(o_totalprice * 100.0) * 0.015)
      OR (o_totalprice <> 0 AND abs(n - o_totalprice * CAST(1e-3 AS DOUBLE)) <= abs(o_totalprice * CAST(1e-3 AS DOUBLE)) * 0.015)
      OR (o_totalprice <> 0 AND abs(n - o_totalprice * CAST(1e-6 AS DOUBLE)) <= abs(o_totalprice * CAST(1e-6 AS DOUBLE)) * 0.015))) > 0
    ELSE CASE WHEN o_orderstatus = 'F' THEN contains(a, 'pass') OR contains(a, 'yes')
              ELSE contains(a, 'fail') OR contains(a, 'no') END END AS PASSED
  FROM found)""".strip()


def _tolerant() -> str:
    return rf"""
WITH texts AS (
  SELECT o_orderkey AS ORDER_KEY, CAST(o_orderkey AS VARCHAR) AS k, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d,
         CAST(o_orderkey % 8 AS INTEGER) + 1 AS i FROM orders),
picked AS (
  SELECT ORDER_KEY, ([d, substr(d, 1, 4), '01/02/2013', '2013-13-01', '', NULL, d || 'x', substr(d, 1, 7)])[i] AS D,
         ([k, k || '.5', k || '.4', '  ' || k || ' ', 'x', 'NaN', 'n/a', '-' || k || '.7'])[i] AS N FROM texts),
cleaned AS (
  SELECT ORDER_KEY, CASE WHEN D NOT IN ({", ".join(_q(t) for t in NA_TOKENS)}) THEN D END AS D,
         CASE WHEN N NOT IN ({", ".join(_q(t) for t in NA_TOKENS)}) THEN N END AS N FROM picked)
SELECT ORDER_KEY, {_date('D')} AS DAY, {_long('N')} AS WHOLE, {_double('N')} AS REAL, N AS TEXT FROM cleaned""".strip()


def all_sql() -> dict[str, str]:
    staging, features = lambda s: _with("staging", s), lambda s: _with("features", s)
    scores, documents = lambda s: _with("scores", s), lambda s: _with("documents", s)
    vectors = lambda s: _with("vectors", s)
    question = _q(QUESTION_TEXT)  # the question names its own store, so NAMED is store_nbr = QUESTION_ID
    assert "{k}" in question
    sparse = f", sparse_history AS ({_with_future('kept')}), sparse AS ({_features_of('sparse_history')})"
    return {
        # sources and sinks
        "csv_scan": staging('SELECT "DATE", DCOILWTICO FROM raw_oil'),
        "raw_load_counts": staging("""
SELECT TABLE_NAME, N AS N_ROWS, N AS N_REPORTED FROM (
  SELECT 'TRAIN' AS TABLE_NAME, COUNT(*) AS N FROM raw_train UNION ALL SELECT 'STORES', COUNT(*) FROM raw_stores
  UNION ALL SELECT 'OIL', COUNT(*) FROM raw_oil UNION ALL SELECT 'HOLIDAYS_EVENTS', COUNT(*) FROM raw_holidays
  UNION ALL SELECT 'TRANSACTIONS', COUNT(*) FROM raw_transactions UNION ALL SELECT 'TEST', COUNT(*) FROM raw_train)"""),
        "overwrite_sink": staging("SELECT * FROM stores WHERE STORE_TYPE <> 'A'"),
        "append_log": scores("SELECT RUN_TS, MODEL, COUNT(*) AS N_ROWS, round(SUM(FORECAST), 6) AS TOTAL_FORECAST FROM forecasts GROUP BY 1, 2"),
        "latest_run": scores("SELECT STORE_NBR, FAMILY, WEEK_START, round(FORECAST, 2) AS FORECAST, MODEL, RUN_TS FROM latest"),
        "rows_json": staging("""
SELECT '{"WEEK_START":"' || strftime(WEEK_START, '%Y-%m-%dT00:00:00.000') || '","STORE_NBR":' || STORE_NBR || ',"FAMILY":"' || FAMILY
  || '","PROMO_ITEMS":' || PROMO_ITEMS || ',"STORE_TRANSACTIONS":' || COALESCE(CAST(STORE_TRANSACTIONS AS VARCHAR), 'null')
  || ',"SALES":' || CAST(round(SALES, 2) AS VARCHAR) || ',"AVG_OIL_PRICE":' || COALESCE(CAST(round(AVG_OIL_PRICE, 6) AS VARCHAR), 'null')
  || ',"TENTHS":0.3'
  || ',"CITY":"' || CITY || '"}' AS ROW
FROM (SELECT * FROM weekly ORDER BY WEEK_START DESC, STORE_NBR, FAMILY LIMIT 100)"""),
        "vector_index_roundtrip": vectors("""
SELECT vec_id AS store_nbr, '2001-10-29' AS week_start, 'document ' || vec_id AS text, COUNT(*) AS dims,
       round(CAST(CAST(MAX(VALUE) FILTER (WHERE POS = 0) AS FLOAT) AS DOUBLE), 5) AS first_value FROM units GROUP BY vec_id"""),
        # staging
        "typed_sales": staging("SELECT * FROM daily"),
        "typed_stores": staging("SELECT * FROM stores"),
        "typed_transactions": staging("SELECT * FROM traffic"),
        "tolerant_casts": _tolerant(),
        "calendar_oil_fill": staging("SELECT * FROM oil"),
        "oil_fill_bucketed": staging("SELECT * FROM oil"),
        "store_holidays": staging("SELECT * FROM holidays"),
        "sales_enriched": staging("SELECT * FROM enriched"),
        "weekly_rollup": staging(f"SELECT {_WEEKLY} FROM weekly"),
        "weekly_from_enriched": staging(f"SELECT {_WEEKLY} FROM weekly"),
        "weekly_preview": staging(f"SELECT {_WEEKLY} FROM (SELECT * FROM weekly ORDER BY {_KEYS} LIMIT 20)"),
        # data quality
        "dq_reconcile": staging("SELECT (SELECT CAST(round(SUM(CAST(SALES AS DECIMAL(28, 6)))) AS DOUBLE) FROM daily) AS DAILY_TOTAL, (SELECT CAST(round(SUM(CAST(SALES AS DECIMAL(28, 6)))) AS DOUBLE) FROM weekly) AS WEEKLY_TOTAL"),
        "dq_unparsed_dates": staging('SELECT COUNT(*) AS UNPARSED_DATES FROM daily WHERE "DATE" IS NULL'),
        "dq_oil_gaps": staging("SELECT COUNT(*) AS OIL_GAPS FROM oil WHERE OIL_PRICE IS NULL"),
        "dq_partial_weeks": staging("SELECT WEEK_START, COUNT(*) FILTER (WHERE DAYS_IN_WEEK < 7) AS PARTIAL_SERIES, COUNT(*) AS SERIES FROM weekly GROUP BY 1"),
        "dq_duplicate_keys": 'SELECT l_suppkey + 1 AS STORE_NBR, CAST(l_shipdate AS DATE) AS "DATE", COUNT(*) AS N_ROWS FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1',
        "dq_store_columns": staging("SELECT STORE_NBR FROM enriched GROUP BY 1 HAVING COUNT(DISTINCT (CITY, STATE, STORE_TYPE, STORE_CLUSTER)) > 1"),
        # features
        "weekly_trimmed": features(f"SELECT {_WEEKLY} FROM kept"),
        "weekly_dense": features(f"SELECT {_WEEKLY} FROM dense"),
        "feature_lags": scores(f"SELECT {_KEYS}, IS_FUTURE, {_LAGS} FROM features"),
        "feature_rolling": scores(f"SELECT {_KEYS}, IS_FUTURE, {_ROLLS} FROM features"),
        "feature_calendar": scores(f"SELECT {_KEYS}, IS_FUTURE, WEEK_OF_YEAR, MONTH, YEAR FROM features"),
        "feature_table": scores(f"SELECT {_INPUTS}, {_LAGS}, {_ROLLS}, WEEK_OF_YEAR, MONTH, YEAR FROM features"),
        "features_sparse": features(f"{sparse} SELECT {_INPUTS}, {_LAGS}, {_ROLLS}, WEEK_OF_YEAR, MONTH, YEAR FROM sparse"),
        "future_rows": features(f"{sparse} SELECT {_INPUTS} FROM sparse_history"),
        "category_codes": staging("""
SELECT DISTINCT STORE_NBR, FAMILY, STORE_TYPE,
       CAST((SELECT COUNT(DISTINCT x.FAMILY) FROM weekly x WHERE x.FAMILY < w.FAMILY) AS INTEGER) AS FAMILY_CODE,
       CAST(CASE WHEN STORE_TYPE IS NULL THEN -1 ELSE (SELECT COUNT(DISTINCT x.STORE_TYPE) FROM weekly x WHERE x.STORE_TYPE < w.STORE_TYPE) END AS INTEGER) AS STORE_TYPE_CODE
FROM weekly w"""),
        "fourier_terms": features(f"SELECT {_KEYS}, CAST(T AS INTEGER) AS T, {_waves()} FROM (SELECT {_KEYS}, row_number() OVER (PARTITION BY STORE_NBR, FAMILY ORDER BY WEEK_START) - 1 AS T FROM dense)"),
        "top_series": scores("SELECT STORE_NBR, FAMILY, TOTAL_SALES FROM top_series"),
        "test_weeks": scores("SELECT WEEK_START FROM test_weeks"),
        "arima_fourier_checked": scores(f"SELECT {_KEYS}, round(SALES, 2) AS SALES, TRUE AS VALID FROM tested"),
        "trend_season_checked": scores(f"SELECT {_KEYS}, round(SALES, 2) AS SALES, TRUE AS VALID FROM tested"),
        "series_tail": scores("""
SELECT a.STORE_NBR, a.FAMILY, a.WEEK_START, round(a.SALES, 2) AS SALES, round(t.PRED_NAIVE52, 2) AS PRED_NAIVE52, round(t.PRED_MEAN4, 6) AS PRED_MEAN4
FROM (SELECT * FROM actuals WHERE (STORE_NBR, FAMILY) = (SELECT (STORE_NBR, FAMILY) FROM top_series ORDER BY TOTAL_SALES DESC, STORE_NBR, FAMILY LIMIT 1)
      ORDER BY WEEK_START DESC LIMIT 30) a
LEFT JOIN tested t ON a.STORE_NBR = t.STORE_NBR AND a.FAMILY = t.FAMILY AND a.WEEK_START = t.WEEK_START"""),
        "forecast_example": scores("""
SELECT a.STORE_NBR, a.FAMILY, a.WEEK_START, round(a.SALES, 2) AS SALES, round(t.PRED_NAIVE52, 2) AS PRED_NAIVE52,
       t.STORE_NBR IS NOT NULL AS VALID_ARIMA, t.STORE_NBR IS NOT NULL AS VALID_TREND, t.STORE_NBR IS NOT NULL AS VALID_GBT
FROM (SELECT * FROM actuals WHERE (STORE_NBR, FAMILY) = (SELECT (STORE_NBR, FAMILY) FROM top_series ORDER BY TOTAL_SALES DESC, STORE_NBR, FAMILY LIMIT 1)
      ORDER BY WEEK_START DESC LIMIT 30) a
LEFT JOIN tested t ON a.STORE_NBR = t.STORE_NBR AND a.FAMILY = t.FAMILY AND a.WEEK_START = t.WEEK_START"""),
        "backtest_predictions": scores(f"""SELECT {_KEYS}, round(SALES, 2) AS SALES, IS_TOP, round(PRED_NAIVE52, 2) AS PRED_NAIVE52,
       TRUE AS VALID_ARIMA, TRUE AS VALID_TREND, TRUE AS VALID_GBT FROM tested"""),
        "series_fits_checked": scores("""SELECT DISTINCT STORE_NBR, FAMILY, (SELECT MAX(WEEK_START) FROM test_weeks) AS WEEK_START,
       TRUE AS ARIMA_EXACT, TRUE AS ARIMA_BEST, TRUE AS TREND_OPTIMAL FROM tested"""),
        # models and scores
        "naive_backtest": scores(f"SELECT {_KEYS}, round(SALES, 2) AS SALES, IS_TOP, round(PRED_NAIVE52, 2) AS PRED_NAIVE52 FROM tested"),
        "ma4_backtest": scores(f"SELECT {_KEYS}, round(SALES, 2) AS SALES, IS_TOP, round(PRED_MEAN4, 6) AS PRED_MEAN4 FROM tested"),
        "model_results": scores("SELECT MODEL, SCOPE, N, round(WAPE, 6) AS WAPE, round(RMSE, 4) AS RMSE FROM results"),
        "model_comparison": scores("""
SELECT MODEL, ALL_SERIES, TOP10, COALESCE(format('{:.1f}', (base - TOP10) / nullif(base, 0) * 100) || '%', 'nan%') AS IMPROVEMENT_VS_NAIVE_TOP10
FROM (SELECT MODEL, round(MAX(WAPE) FILTER (WHERE SCOPE = 'all'), 4) AS ALL_SERIES, round(MAX(WAPE) FILTER (WHERE SCOPE = 'top10'), 4) AS TOP10
      FROM results GROUP BY MODEL),
     (SELECT round(WAPE, 4) AS base FROM results WHERE MODEL = 'naive_52' AND SCOPE = 'top10')"""),
        "model_ranking": scores("SELECT MODEL, round(WAPE, 6) AS WAPE FROM results WHERE SCOPE = 'top10'"),
        "gate_log": scores("SELECT RUN_TS, MODEL, EVAL_WEEK, round(WAPE, 6) AS WAPE, N_SERIES, THRESHOLD, PASSED FROM accuracy_log WHERE MODEL = 'naive_52'"),
        "forecast_naive": scores("SELECT STORE_NBR, FAMILY, WEEK_START, round(FORECAST, 2) AS FORECAST, MODEL, RUN_TS FROM forecasts WHERE MODEL = 'naive_52'"),
        # reports
        "eda_weekly_total": features("SELECT WEEK_START, CAST(SUM(CAST(SALES AS DECIMAL(18,2))) AS DOUBLE) AS SALES FROM kept GROUP BY 1"),
        "eda_top_families": features("SELECT FAMILY, CAST(SUM(CAST(SALES AS DECIMAL(18,2))) AS DOUBLE) AS SALES FROM kept GROUP BY 1 ORDER BY SALES DESC, FAMILY LIMIT 10"),
        "eda_seasonality": features(f"SELECT CAST(week(WEEK_START) AS INTEGER) AS WEEK_OF_YEAR, {_AVG_CENTS} FROM kept GROUP BY 1"),
        "eda_promo": features(f"SELECT COALESCE(PROMO_ITEMS > 0, false) AS HAS_PROMO, {_AVG_CENTS} FROM kept GROUP BY 1"),
        "eda_holiday": features(f"SELECT COALESCE(HOLIDAY_DAYS > 0, false) AS HAS_HOLIDAY, {_AVG_CENTS} FROM kept GROUP BY 1"),
        "q_top_stores": scores(f"SELECT STORE_NBR, round({_FORECAST_SUM}, 2) AS TOTAL_FORECAST FROM latest GROUP BY 1 ORDER BY {_FORECAST_SUM} DESC, STORE_NBR LIMIT 5"),
        "q_top_family": scores(f"SELECT FAMILY, round({_FORECAST_SUM}, 2) AS TOTAL_FORECAST FROM latest GROUP BY 1 ORDER BY {_FORECAST_SUM} DESC, FAMILY LIMIT 1"),
        "q_latest_wape": scores("SELECT round(WAPE, 6) AS WAPE FROM accuracy_log ORDER BY RUN_TS DESC, MODEL LIMIT 1"),
        "q_best_model": scores("SELECT MODEL, round(WAPE, 6) AS WAPE FROM results WHERE SCOPE = 'top10' ORDER BY results.WAPE NULLS LAST, MODEL LIMIT 1"),
        "q_series_count": scores("SELECT COUNT(*) AS N_SERIES FROM latest"),
        "q_top_city": staging("SELECT CITY, COUNT(*) AS N_STORES FROM stores GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
        "q_total_forecast": scores(f"SELECT round({_FORECAST_SUM}, 2) AS TOTAL_FORECAST FROM latest"),
        "q_store_declines": scores("""
SELECT STORE_NBR, round(f, 2) AS TOTAL_FORECAST, round(l, 2) AS LAST_WEEK, round(c, 6) AS CHANGE_RATIO
FROM (SELECT *, round((f - l) / nullif(l, 0), 9) AS c
      FROM (SELECT STORE_NBR, round(SUM(FORECAST), 6) AS f, round(SUM(LAST_WEEK), 6) AS l FROM facts GROUP BY 1))
ORDER BY c ASC NULLS LAST, STORE_NBR LIMIT 3"""),
        "q_gate_passed": scores("SELECT MODEL, PASSED FROM accuracy_log ORDER BY RUN_TS DESC, MODEL LIMIT 1"),
        "q_family_change": scores("""
SELECT FAMILY, round(f, 2) AS TOTAL_FORECAST, round(l, 2) AS LAST_WEEK, round(CASE WHEN l <> 0 THEN (f - l) / l * 100 END, 6) AS PCT_CHANGE
FROM (SELECT FAMILY, round(SUM(FORECAST), 6) AS f, round(SUM(LAST_WEEK), 6) AS l FROM facts GROUP BY 1) ORDER BY f DESC, FAMILY LIMIT 1"""),
        # documents and retrieval
        "fact_frame": scores("""
SELECT STORE_NBR, FAMILY, WEEK_START, round(FORECAST, 2) AS FORECAST, round(LAST_WEEK, 2) AS LAST_WEEK,
       round(SAME_WEEK_LAST_YEAR, 2) AS SAME_WEEK_LAST_YEAR, round(AVG_4WK, 6) AS AVG_4WK, PROMO_ITEMS, HOLIDAY_DAYS, CITY, STATE, STORE_TYPE FROM facts"""),
        "family_moves": documents("SELECT * FROM moves"),
        "store_documents": documents("SELECT * FROM store_docs"),
        "chain_document": documents("SELECT * FROM chain_docs"),
        "document_refresh": _refreshed(),
        "append_replay": scores("""SELECT RUN_TS, MODEL, COUNT(*) AS N_ROWS, COUNT(*) AS N_DIFFERENT, round(SUM(FORECAST), 6) AS TOTAL_FORECAST,
       COUNT(*) AS N_NOTED, TRUE AS SETTLED FROM forecasts GROUP BY 1, 2"""),
        "store_summaries": documents("SELECT * FROM store_docs UNION ALL SELECT * FROM chain_docs"),
        "vector_normalise": vectors("SELECT vec_id, POS, round(VALUE, 6) AS VALUE FROM units"),
        "cosine_topk": vectors("SELECT vec_id, store_nbr, round(RAW, 3) AS score FROM (SELECT * FROM scored ORDER BY RAW DESC, vec_id LIMIT 10)"),
        "hybrid_search": vectors("""
SELECT vec_id, store_nbr, round(RAW, 3) AS score, CASE WHEN store_nbr IN (3, 7) THEN 'store filter' ELSE 'semantic' END AS matched_by
FROM (SELECT * FROM scored ORDER BY store_nbr IN (3, 7) DESC, RAW DESC, vec_id LIMIT 150)"""),
        "batch_topk": vectors("""
SELECT QUESTION_ID, RANK, vec_id, store_nbr, round(RAW, 3) AS score, CASE WHEN NAMED THEN 'store filter' ELSE 'semantic' END AS matched_by
FROM (SELECT *, row_number() OVER (PARTITION BY QUESTION_ID ORDER BY NAMED DESC, RAW DESC, vec_id) AS RANK FROM pairs) WHERE RANK <= 5"""),
        "clustered_topk": vectors("""
SELECT QUESTION_ID, RANK, vec_id, store_nbr, round(RAW, 3) AS score, CASE WHEN NAMED THEN 'store filter' ELSE 'semantic' END AS matched_by
FROM (SELECT *, row_number() OVER (PARTITION BY QUESTION_ID ORDER BY NAMED DESC, RAW DESC, vec_id) AS RANK FROM pairs) WHERE RANK <= 5"""),
        # query log and answers
        "sql_audit": f"WITH {_audit()}\nSELECT * FROM audited",
        "audit_summary": f"WITH {_audit()}\nSELECT VERDICT, COUNT(*) AS N_QUERIES, COUNT(*) FILTER (WHERE COMMA_JOIN) AS N_COMMA_JOINS FROM audited GROUP BY 1",
        "document_numbers": rf"""
WITH found AS (SELECT doc_id, list_transform(regexp_extract_all(replace(text, ',', ''), {_q(NUMBER_PATTERN)}), lambda x: CAST(x AS DOUBLE)) AS n FROM documents)
SELECT doc_id, CAST(len(n) AS BIGINT) AS N_NUMBERS, CAST(len(list_filter(n, lambda x: x = floor(x))) AS BIGINT) AS N_WHOLE, list_max(n) AS MAX_NUMBER FROM found""",
        "answer_scoring": f"WITH {_answers()}\nSELECT CASE_ID, KIND, ANSWER, PASSED FROM scored",
        "answer_report": f"WITH {_answers()}\nSELECT CASE_ID, CASE WHEN PASSED THEN 'PASS' ELSE 'FAIL' END AS RESULT, KIND, substr(ANSWER, 1, 250) AS SHOWN_ANSWER FROM scored",
        "answer_accuracy": f"WITH {_answers()}\nSELECT KIND, COUNT(*) FILTER (WHERE PASSED) AS N_PASSED, COUNT(*) AS N_CASES, round(AVG(CAST(PASSED AS INTEGER)), 6) AS ACCURACY FROM scored GROUP BY 1",
    }
