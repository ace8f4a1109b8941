"""Incremental refresh of documents and vectors: only what changed is written and embedded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom import schemas
from weekloom.functions.dates import iso_text
from weekloom.operators import narrative
from weekloom.session import scratch_path
from weekloom.sources.tables import append_run, exists, overwrite_table, read_table

CHAIN = 0
LOG = "ANALYTICS/DOCUMENT_LOG"


def facts_digests(facts: DataFrame) -> DataFrame:
    """STORE_NBR, DIGEST of all that a store's document says, and of the whole for the chain's (store 0).

    A store's facts are at most its product families. The chain's digest adds up the stores', in any order.
    """
    columns = [c for c in facts.columns if c != "STORE_NBR"]
    week = F.coalesce(iso_text(facts.agg(F.max("WEEK_START")).scalar()), F.lit(""))
    told = F.to_json(F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("string") for c in columns]))), {"ignoreNullFields": "false"})
    stores = facts.groupBy("STORE_NBR").agg(told.alias("TOLD")).select(
        F.col("STORE_NBR").cast("bigint"), F.sha2(F.concat(week, F.lit(" "), "TOLD"), 256).alias("DIGEST"))
    lane = lambda at: F.sum(F.conv(F.substring("DIGEST", at, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    chain = stores.agg(F.count(F.lit(1)).alias("N"), F.concat_ws(" ", *[lane(at) for at in (1, 16, 31, 46)]).alias("ALL")).where("N > 0")
    return stores.unionByName(chain.select(F.lit(CHAIN).cast("bigint").alias("STORE_NBR"), F.sha2("ALL", 256).alias("DIGEST")))


def current_documents(log: DataFrame) -> DataFrame:
    """The newest entry of each document that isn't gone."""
    newest = Window.partitionBy("STORE_NBR").orderBy(F.desc("RUN_TS"))
    return log.withColumn("_RN", F.row_number().over(newest)).where("_RN = 1 AND NOT GONE").drop("_RN")


def document_states(log: DataFrame, digests: DataFrame) -> DataFrame:
    """STORE_NBR, DIGEST, STATE: new, changed, same or vanished."""
    old = current_documents(log).select("STORE_NBR", F.col("DIGEST").alias("OLD"), F.lit(True).alias("KNOWN"))
    both = digests.withColumn("TOLD", F.lit(True)).join(old, "STORE_NBR", "full")
    state = (
        F.when(F.col("KNOWN").isNull(), "new").when(F.col("TOLD").isNull(), "vanished")
        .when(F.col("DIGEST").eqNullSafe(F.col("OLD")), "same").otherwise("changed")
    )
    return both.select("STORE_NBR", "DIGEST", state.alias("STATE"))


def refresh_changed(
    spark: SparkSession, facts: DataFrame, out: str, run_ts: str, embed: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Write the documents whose facts differ from those of earlier runs; returns document_states.

    Documents are kept as a log: a run adds those it wrote, and an entry for each that is gone. ``embed``
    (adds VECTOR) sees the written ones only. A run repeated under its ``run_ts`` replaces its entries.
    ``facts`` (fact_frame) should be stored.
    """
    path = f"{out.rstrip('/')}/{LOG}"
    log = read_table(spark, path, schemas.DOCUMENT_LOG) if exists(spark, path) else spark.createDataFrame([], schemas.DOCUMENT_LOG)
    states_path = scratch_path(spark, "document-states")
    overwrite_table(document_states(log.where(F.col("RUN_TS") < run_ts), facts_digests(facts)), states_path)
    states = read_table(spark, states_path, "STORE_NBR bigint, DIGEST string, STATE string")
    written = states.where("STATE IN ('new', 'changed')")
    stores = narrative.store_documents(
        facts.join(written, facts["STORE_NBR"].eqNullSafe(written["STORE_NBR"]), "left_semi"), iso_text(facts.agg(F.max("WEEK_START")).scalar()))
    documents = stores.unionByName(narrative.chain_document(facts)).join(written.drop("STATE"), "STORE_NBR")
    documents = embed(documents) if embed else documents.withColumn("VECTOR", F.lit(None))
    gone = states.where("STATE = 'vanished'").select("STORE_NBR")
    vector = F.col("VECTOR").cast("array<float>").alias("VECTOR")
    entries = documents.select("STORE_NBR", "WEEK_START", "SUMMARY", vector, "DIGEST", F.lit(False).alias("GONE")).unionByName(
        gone.withColumn("GONE", F.lit(True)), allowMissingColumns=True).withColumn("RUN_TS", F.lit(run_ts))
    append_run(entries, path)
    return states


def document_log(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, f"{out.rstrip('/')}/{LOG}", schemas.DOCUMENT_LOG)
