"""Explicit schemas of the stored tables."""

RAW_COLUMNS = {
    "TRAIN": ["DATE", "STORE_NBR", "FAMILY", "SALES", "ONPROMOTION"],
    "STORES": ["STORE_NBR", "CITY", "STATE", "TYPE", "CLUSTER"],
    "OIL": ["DATE", "DCOILWTICO"],
    "HOLIDAYS_EVENTS": ["DATE", "TYPE", "LOCALE", "LOCALE_NAME", "TRANSFERRED"],
    "TRANSACTIONS": ["DATE", "STORE_NBR", "TRANSACTIONS"],
}

SALES_DAILY = "DATE date, STORE_NBR bigint, FAMILY string, SALES double, ONPROMOTION bigint"
STORES = "STORE_NBR bigint, CITY string, STATE string, STORE_TYPE string, STORE_CLUSTER bigint"
OIL_DAILY = "DATE date, OIL_PRICE double"
STORE_HOLIDAYS = "STORE_NBR bigint, DATE date, IS_HOLIDAY int"
TRANSACTIONS_DAILY = "DATE date, STORE_NBR bigint, TRANSACTIONS bigint"
SALES_DAILY_ENRICHED = (
    "DATE date, STORE_NBR bigint, FAMILY string, SALES double, ONPROMOTION bigint, CITY string, STATE string, "
    "STORE_TYPE string, STORE_CLUSTER bigint, OIL_PRICE double, IS_HOLIDAY int, TRANSACTIONS bigint"
)
SALES_WEEKLY = (
    "STORE_NBR bigint, FAMILY string, WEEK_START date, CITY string, STATE string, STORE_TYPE string, "
    "STORE_CLUSTER bigint, SALES double, PROMO_ITEMS bigint, HOLIDAY_DAYS bigint, AVG_OIL_PRICE double, "
    "STORE_TRANSACTIONS bigint, DAYS_IN_WEEK bigint"
)
# IS_FUTURE is a partition column: the forecast week is read without the history.
FEATURES = (
    "STORE_NBR bigint, FAMILY string, WEEK_START date, STORE_TYPE string, STORE_CLUSTER bigint, SALES double, "
    "PROMO_ITEMS bigint, HOLIDAY_DAYS bigint, AVG_OIL_PRICE double, STORE_TRANSACTIONS bigint, "
    "SALES_LAG_1 double, SALES_LAG_2 double, SALES_LAG_4 double, SALES_LAG_52 double, SALES_ROLL_MEAN_4 double, "
    "SALES_ROLL_MEAN_12 double, SALES_ROLL_STD_12 double, WEEK_OF_YEAR int, MONTH int, YEAR int, IS_FUTURE int"
)
# RUN_TS is a partition column of the two logs: it must stay text, so both are
# always read with these schemas (inference would turn it into a timestamp).
FORECASTS = "STORE_NBR bigint, FAMILY string, WEEK_START date, FORECAST double, MODEL string, RUN_TS string"
ACCURACY_LOG = (
    "MODEL string, EVAL_WEEK string, WAPE double, N_SERIES bigint, THRESHOLD double, PASSED boolean, RUN_TS string"
)
MODEL_RESULTS = "MODEL string, SCOPE string, N bigint, WAPE double, RMSE double"
STORE_SUMMARIES = "STORE_NBR bigint, WEEK_START string, SUMMARY string"
VECTOR_INDEX = "store_nbr bigint, week_start string, text string, vector array<float>"
# What each refresh wrote: a document as it stands from that run on, or that it is gone.
DOCUMENT_LOG = (
    "STORE_NBR bigint, WEEK_START string, SUMMARY string, VECTOR array<float>, DIGEST string, GONE boolean, RUN_TS string"
)
