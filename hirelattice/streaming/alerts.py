"""Alerts as a stream: every run that fails is alerted once.

The batch functions for the rule and the text apply unchanged to a streaming frame. A summary may be published again (a retried
run, a copied file), so the stream remembers the failing runs it has seen. The clock of that memory is the time of the
micro-batch that reads a summary, which a repeated batch keeps: no summary is ever too late, and a run is forgotten once the
watermark has passed it by the bound. Progress and state live in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.runs import alert_message, needs_alert
from ..schemas import PAYLOAD


def publish_summary(payload: DataFrame, folder: str) -> None:
    """Append a summary to the folder that the alert stream watches."""
    payload.write.mode("append").option("ignoreNullFields", "false").json(folder)


def summary_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(PAYLOAD).json(folder)


def once_per_run(summaries: DataFrame, remembered: str) -> DataFrame:
    """Failing summaries, the first of each run; a run is remembered for at least that long."""
    seen = summaries.where(needs_alert()).withColumn("_seen_at", F.current_timestamp())
    return seen.withWatermark("_seen_at", remembered).dropDuplicatesWithinWatermark(["run_id"]).drop("_seen_at")


def start_alerts(summaries: DataFrame, folder: str, checkpoint: str, remembered: str = "1 day") -> StreamingQuery:
    """Write the alert of each failing run to ``folder`` and stop when caught up."""
    return (
        alert_message(once_per_run(summaries, remembered))
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
