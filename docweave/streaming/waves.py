"""Acquisition waves as Structured Streaming over a folder of attempts.

Attempts arrive as JSON files.  Every micro-batch joins the known identities,
is settled and appended; the stream's checkpoint is the progress record, so a
run that stops goes on where it was, and a batch that is tried again replaces
what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ATTEMPT = "attempt bigint, wave int, scope string, url string, document_id string, family string, type string, bucket string, decade string, result string, error string, capture string, found_scope string"


def settle(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Results of new attempts.

    Name-service errors are the environment's, not the source's; an identity
    already known, or met earlier in the batch, is a duplicate; a found scope
    other than the hint is a mismatch, whose capture is kept.
    """
    w = Window.partitionBy("document_id").orderBy("attempt")
    x = batch.join(known.select("document_id").distinct().withColumn("_known", F.lit(True)), "document_id", "left")
    first = F.row_number().over(w) == 1
    done = F.col("result").isin("complete", "reused_capture", "existing_capture")
    settled = (
        F.when(F.coalesce(F.col("error").rlike("(?i)name.*resol|dns|getaddrinfo"), F.lit(False)), "environment")
        .when(done & F.col("document_id").isNotNull() & (F.coalesce("_known", F.lit(False)) | ~first), "duplicate")
        .when(done & F.col("found_scope").isNotNull() & (F.col("found_scope") != F.col("scope")), "scope_hint_mismatch")
        .otherwise(F.col("result"))
    )
    return x.withColumn("result", settled).drop("_known").select(*batch.columns)


def run_waves(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Settle all attempts in ``source`` that no earlier run has seen; results go to ``target`` by batch."""
    attempts = spark.readStream.schema(ATTEMPT).option("maxFilesPerTrigger", files_per_batch).json(source)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        try:
            before = session.read.parquet(target).where(F.col("batch") != number)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            before = session.createDataFrame([], ATTEMPT)
        kept = before.where("result in ('complete', 'reused_capture', 'existing_capture')")
        # the folder of the batch is replaced, so a batch tried again counts once
        settle(batch, kept).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return attempts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def wave_complete(attempts: DataFrame, wave: int, target: int) -> DataFrame:
    """One row: distinct usable identities of a wave, whether they reach the target, and attempts left of 60."""
    x = attempts.where(F.col("wave") == wave)
    usable = F.count_distinct(F.when(F.col("result").isin("complete", "reused_capture", "existing_capture"), F.col("document_id")))
    return x.agg(usable.alias("usable"), F.greatest(F.lit(0), F.lit(60) - F.count(F.lit(1))).alias("attempts_left")).withColumn("complete", F.col("usable") >= target)


def fill_from_captures(captures: DataFrame, attempts: DataFrame, wave: int, scope: str, most: int) -> DataFrame:
    """Up to ``most`` usable local captures of a scope that no attempt used, as attempts of a wave."""
    free = captures.where(F.col("usable") & F.col("preferred") & (F.col("document_scope") == scope)).join(attempts.select("document_id").distinct(), "document_id", "left_anti")
    return free.orderBy(F.sha2("source_url", 256), "document_id").limit(most).select("document_id", F.col("source_url").alias("url"), "capture", F.lit(wave).alias("wave"), F.lit(scope).alias("scope"), F.lit("existing_capture").alias("result"))
