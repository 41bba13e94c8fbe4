"""Progress reports of streaming queries, kept beyond a run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ReportLog(StreamingQueryListener):
    """Writes the report of each batch of one run that had rows to a folder of its own."""

    def __init__(self, spark: SparkSession, run_id: str, path: str):
        self.spark, self.run_id, self.path = spark, run_id, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        if str(report.runId) != self.run_id or not report.numInputRows:
            return
        row = self.spark.range(1, numPartitions=1).select(F.lit(report.json).alias("json"))
        row.write.mode("overwrite").parquet(
            f"{self.path}/run_id={self.run_id}/batch_id={report.batchId}"
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        """Reports of a run come before its end; later runs have listeners of their own."""
        if str(event.runId) == self.run_id:
            self.spark.streams.removeListener(self)


def keep_reports(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Keep the reports of a query that was just started.

    They arrive shortly after their batch and serve health figures only; what the job
    relies on is in its progress table.
    """
    spark.streams.addListener(ReportLog(spark, str(query.runId), path))
