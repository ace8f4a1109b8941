import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import by, rows
from weekloom.functions.vectors import l2_normalise
from weekloom.operators import answers, audit, clustered_search, retrieval


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    made = rng.normal(size=(120, 8))
    made[7] = made[3]  # exact copies tie; the smaller id wins
    return made / np.linalg.norm(made, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def index(spark, vectors):
    data = [(i, i % 9, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, "doc bigint, store_nbr bigint, vector array<double>").repartition(7)


def ranked(vectors, question, named, k):
    scores = np.round(vectors @ question, 9)
    order = sorted(range(len(vectors)), key=lambda i: (i % 9 not in named, -scores[i], i))
    return order[:k]


def test_unit_length(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in rows(df.select(l2_normalise(F.col("v"))))] == [[0.6, 0.8], [None, None]]


@pytest.mark.parametrize("question, stores", [
    ("Why is store 44 low?", [44]), ("Stores #12 please", [12]), ("store no. 7 and store number 8", [7, 8]),
    ("stores 25 and 18", [25]), ("the chain", []), ("restore 5", []),
])
def test_named_stores(spark, question, stores):
    assert rows(spark.range(1).select(retrieval.named_stores(F.lit(question))))[0][0] == stores


def test_searches_equal_brute_force(spark, index, vectors):
    asked = vectors[3]
    literal = F.array(*[F.lit(float(x)) for x in asked])
    semantic = rows(retrieval.semantic_search(index, literal, "doc", 5).select("doc"))
    assert [r[0] for r in semantic] == ranked(vectors, asked, set(), 5)
    hits = retrieval.hybrid_search(index, F.lit("stores 4 and store 2"), literal, "doc", 30).collect()
    assert [r["doc"] for r in hits] == ranked(vectors, asked, {2, 4}, 30)
    assert {r["matched_by"] for r in hits if r["store_nbr"] in (2, 4)} == {"store filter"}
    assert {r["matched_by"] for r in hits if r["store_nbr"] not in (2, 4)} == {"semantic"}
    assert hits[0]["score"] == pytest.approx(float(vectors[hits[0]["doc"]] @ asked), abs=6e-4)


@pytest.mark.parametrize("block", [1000, 4])
def test_batch_search_equals_brute_force_in_any_block_size(spark, index, vectors, block):
    texts = {i: (f"store {i % 9}" if i % 2 else "all stores together") for i in range(17)}
    questions = spark.createDataFrame([(i, t, vectors[i + 20].tolist()) for i, t in texts.items()], "QUESTION_ID bigint, QUESTION string, VECTOR array<double>")
    got = retrieval.batch_search(index, questions, "doc", k=4, block=block).collect()
    for i in texts:
        mine = [r["doc"] for r in sorted((r for r in got if r["QUESTION_ID"] == i), key=lambda r: r["RANK"])]
        assert mine == ranked(vectors, vectors[i + 20], {i % 9} if i % 2 else set(), 4)


def test_batch_search_needs_no_driver_and_skips_missing_vectors(spark, index, vectors):
    schema = "QUESTION_ID bigint, QUESTION string, VECTOR array<double>"
    questions = spark.createDataFrame([(1, None, vectors[5].tolist()), (2, "store 3", None)], schema)
    more = index.union(spark.createDataFrame([(500, 3, None)], index.schema))
    found = retrieval.batch_search(more, questions, "doc", k=3, block=16)
    assert [r["doc"] for r in found.orderBy("RANK").collect()] == ranked(vectors, vectors[5], set(), 3)
    assert retrieval.batch_search(index, questions.limit(0), "doc").count() == 0
    assert retrieval.batch_search(index.limit(0), questions, "doc").count() == 0


def questions_of(spark, vectors, n):
    texts = {i: (f"store {i % 9} and store {(i + 3) % 9}" if i % 2 else None) for i in range(n)}
    frame = spark.createDataFrame([(i, t, vectors[i].tolist()) for i, t in texts.items()], "QUESTION_ID bigint, QUESTION string, VECTOR array<double>")
    return frame, {i: {i % 9, (i + 3) % 9} if t else set() for i, t in texts.items()}


def test_clustered_search_equals_brute_force(spark, index, vectors):
    questions, named = questions_of(spark, vectors, 12)
    clusters = clustered_search.ClusteredIndex(index, "doc", per_cluster=10, block=4)
    got = clustered_search.clustered_search(clusters, questions, "doc", k=20).collect()
    for i, stores in named.items():
        mine = sorted((r for r in got if r["QUESTION_ID"] == i), key=lambda r: r["RANK"])
        assert [r["doc"] for r in mine] == ranked(vectors, vectors[i], stores, 20)
        assert all((r["matched_by"] == "store filter") == (r["store_nbr"] in stores) for r in mine)


def test_bounds_rule_out_most_clusters(spark, monkeypatch):
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(30, 16))
    made = (middles[:, None, :] + rng.normal(size=(30, 40, 16)) / 50).reshape(-1, 16)
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    index = spark.createDataFrame([(i, i % 9, v.tolist()) for i, v in enumerate(made)], "doc bigint, store_nbr bigint, vector array<double>")
    met = []
    plain = clustered_search._asked_blocks
    monkeypatch.setattr(clustered_search, "_asked_blocks", lambda i, pairs, k: met.append(pairs.agg(F.sum("SIZE")).first()[0] or 0) or plain(i, pairs, k))
    questions = spark.createDataFrame([(i, None, made[i].tolist()) for i in range(0, 1200, 40)], "QUESTION_ID bigint, QUESTION string, VECTOR array<double>")
    clusters = clustered_search.ClusteredIndex(index, "doc", per_cluster=20)
    got = clustered_search.clustered_search(clusters, questions, "doc", k=5).collect()
    assert sum(met) < 0.25 * 30 * 1200
    for i in range(0, 1200, 40):
        assert [r["doc"] for r in sorted((r for r in got if r["QUESTION_ID"] == i), key=lambda r: r["RANK"])] == ranked(made, made[i], set(), 5)


def test_clustered_search_skips_missing_vectors_and_empty_sides(spark, index, vectors):
    schema = "QUESTION_ID bigint, QUESTION string, VECTOR array<double>"
    questions = spark.createDataFrame([(1, "store 77", vectors[5].tolist()), (2, "store 3", None)], schema)
    more = index.union(spark.createDataFrame([(500, 3, None), (501, 3, [None] * 8), (502, None, vectors[5].tolist())], index.schema))
    clusters = clustered_search.ClusteredIndex(more, "doc", per_cluster=30)
    found = clustered_search.clustered_search(clusters, questions, "doc", k=3).orderBy("RANK").collect()
    assert [r["doc"] for r in found] == [5, 502, *ranked(vectors, vectors[5], set(), 2)[1:]] and found[1]["store_nbr"] is None
    assert clustered_search.clustered_search(clusters, questions.limit(0), "doc").count() == 0
    assert clustered_search.clustered_search(clustered_search.ClusteredIndex(index.limit(0), "doc"), questions.limit(0), "doc").count() == 0


def test_unit_length_takes_one_length_per_vector(spark):
    vector = F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda x: x.cast("double"))
    made = spark.range(1).select(l2_normalise(vector).alias("v")).first()[0]
    assert np.linalg.norm(made) == pytest.approx(1.0)


def test_missing_query_is_refused_and_blocked_words_are_whole_words(spark):
    texts = [None, "select updated_at, caller from SALES_DB.STAGING.STORES"] + [
        f"select 1 as {w} from SALES_DB.STAGING.STORES" for w in (
            "insert", "UPDATE", "delete", "merge", "drop", "create", "alter", "truncate", "grant", "revoke", "copy", "put", "call", "Use")]
    got = [r["VERDICT"] for r in audit.audit_queries(spark.createDataFrame([(t,) for t in texts], "QUERY string")).collect()]
    assert got == ["not_read_only", "accepted"] + ["not_read_only"] * 14


F_TABLE, W_TABLE = "SALES_DB.ANALYTICS.FORECASTS", "SALES_DB.STAGING.SALES_WEEKLY"
CASES = [
    (f"SELECT * FROM {F_TABLE}", "accepted", None, f"SELECT * FROM {F_TABLE} LIMIT 100"),
    (f"  select * from {F_TABLE.lower()} limit 5;; ", "accepted", None, f"select * from {F_TABLE.lower()} limit 5"),
    (f"WITH t AS (SELECT * FROM {W_TABLE}) SELECT * FROM T", "accepted", None, f"WITH t AS (SELECT * FROM {W_TABLE}) SELECT * FROM T LIMIT 100"),
    ("SELECT 1; SELECT 2", "multi_statement", None, None),
    (f"DELETE FROM {F_TABLE}", "not_read_only", None, None),
    (f"SELECT 'please update' FROM {F_TABLE}", "not_read_only", None, None),
    (f"SELECT updated FROM {F_TABLE}\nLIMIT 7\n", "accepted", None, f"SELECT updated FROM {F_TABLE}\nLIMIT 7"),
    ("SHOW TABLES", "not_read_only", None, None),
    (f"SELECT * FROM {F_TABLE} JOIN raw.x ON 1=1 JOIN y ON 1=1", "table_not_allowed", "raw.x", None),
    ('SELECT * FROM "SALES_DB"."STAGING"."STORES"', "accepted", None, 'SELECT * FROM "SALES_DB"."STAGING"."STORES" LIMIT 100'),
    (f"SELECT * FROM {F_TABLE} f, secret s", "accepted", None, f"SELECT * FROM {F_TABLE} f, secret s LIMIT 100"),
    (f"SELECT * FROM (SELECT * FROM {F_TABLE} LIMIT 3) x", "accepted", None, f"SELECT * FROM (SELECT * FROM {F_TABLE} LIMIT 3) x LIMIT 100"),
    ("INSERT INTO x VALUES (1); SELECT 1", "multi_statement", None, None),
]


def test_query_audit(spark):
    log = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "QUERY_ID int, QUERY string")
    got = by(audit.audit_queries(log), "QUERY_ID")
    for i, (_, verdict, offender, executed) in enumerate(CASES):
        assert (got[i]["VERDICT"], got[i]["OFFENDER"], got[i]["EXECUTED_SQL"]) == (verdict, offender, executed), CASES[i]
    assert got[8]["ERROR"] == "Table raw.x is not allowed. Use fully qualified names from the schema."
    assert got[0]["ERROR"] is None and got[3]["ERROR"] == "Only one statement is allowed."
    assert [i for i in got if got[i]["COMMA_JOIN"]] == [10]


ANSWERS = [
    ("ints", ["25", "18"], "Stores 18 and 25.0 fall most", True), ("ints", ["25", "18"], "Store 25 falls 18.5%", False),
    ("ints", ["1200"], "It is 1,200", True),
    ("text", ["GROCERY_I"], "Mostly grocery items", True), ("text", ["GROCERY_I"], "Beverages", False), ("text", ["Quito"], "QUITO has most", True),
    ("number", ["0.0999"], "WAPE was 9.99%", True), ("number", ["1234567"], "about 1.23 million", True),
    ("number", ["1234567"], "about 1,235 thousand", True), ("number", ["1234567"], "about 1.3 million", False),
    ("number", ["0"], "It is 0", False), ("number", ["100"], "101.5", True), ("number", ["100"], "101.6", False),
    ("yesno", ["true"], "It passed", True), ("yesno", ["True"], "No", False), ("yesno", ["false"], "It did not", True),
    ("yesno", ["false"], "Yes", False), ("text", ["x"], None, False),
]


def test_answer_scoring(spark):
    cases = spark.createDataFrame([(i, k, t, a) for i, (k, t, a, _) in enumerate(ANSWERS)], "CASE_ID int, KIND string, TRUTH array<string>, ANSWER string")
    scored = answers.score_answers(cases)
    got = by(scored, "CASE_ID")
    for i, case in enumerate(ANSWERS):
        assert got[i]["PASSED"] is case[3], case
    passed = sum(c[3] for c in ANSWERS)
    assert rows(answers.accuracy(scored)) == [(passed, len(ANSWERS), pytest.approx(passed / len(ANSWERS)))]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("1,234.50 then 7. and -3",)], "t string")
    assert rows(df.select(answers.numbers_in(F.col("t"))))[0][0] == [1234.5, 7.0, 3.0]
