"""Fixed text patterns from which the log and answer tables are derived, one row
per order. ``{k}`` is the order key, ``{c}`` the customer key, ``{p}`` the priority,
``{s}`` the status. The Spark queries and the SQL counterparts share the lists."""

#: The last one is a missing query.
QUERY_TEXTS = [
    "SELECT * FROM SALES_DB.STAGING.STORES WHERE STORE_NBR = {k};",
    "  with t as (select FAMILY from SALES_DB.ANALYTICS.FORECASTS where STORE_NBR = {k}) select * from t limit 5  ",
    "SELECT 1; SELECT {k}",
    "DELETE FROM SALES_DB.STAGING.STORES WHERE STORE_NBR = {k}",
    "SELECT * FROM SALES_DB.STAGING.STORES WHERE CITY = 'drop {k}'",
    "SELECT * FROM SALES_DB.RAW.TRAIN WHERE STORE_NBR = {k}",
    "SELECT a.FAMILY FROM \"SALES_DB\".\"ANALYTICS\".\"FEATURES\" a JOIN x_{k} b ON a.FAMILY = b.FAMILY",
    "select f.FAMILY from SALES_DB.ANALYTICS.FORECASTS f, SALES_DB.RAW.OIL o where f.STORE_NBR = {k} LIMIT 20 ",
    "SELECT * FROM (SELECT * FROM SALES_DB.STAGING.SALES_WEEKLY LIMIT 10) q WHERE STORE_NBR = {k}",
    "EXPLAIN SELECT {k}",
    "SELECT 'used {k}' AS NOTE FROM SALES_DB.ANALYTICS.ACCURACY_LOG\nLIMIT 3;;",
    "WITH a AS (SELECT {k} AS K), b AS (SELECT * FROM a) SELECT * FROM b JOIN missing_{c} ON 1 = 1",
    None,
]

# One list per kind, in the order of ANSWER_KINDS; {n}, {h} and {m} are the order
# total with cents, in thousands and in millions.
ANSWER_KINDS = ["ints", "text", "number", "yesno"]
ANSWER_TEXTS = {
    "ints": ["Stores {c} and {k} lead.", "Only store {c} stands out.", "Totals: {k}.0 and {c}, both up 1.5%."],
    "text": ["The priority is {p}.", "It is unknown.", "Priority {p}, status {s}."],
    "number": ["The total is {n}.", "About {h} thousand.", "Roughly {m} million in all."],
    "yesno": ["Yes, it passed the gate.", "The run failed.", "Hard to say."],
}
QUESTION_TEXT = "Why is store {k}'s forecast different from its recent average?"
