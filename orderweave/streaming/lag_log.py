"""Lag of running queries, written down while they run."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from orderweave.operators.lag import progress_lag

LAG_ROWS = ("group_id string, topic string, partition_id int, committed_offset long, end_offset long, lag long, "
            "batch_id long, noted_at string")


def offset_rows(progress: Mapping, group_id: str) -> list[dict]:
    """Lag rows of one progress. Topic sources report an offset for each partition.

    A source of another kind reports one number for all it has read (a file source its log position); it counts as the
    only partition of a topic that bears the description of the source. A source that has no offset yet gives none.
    """
    def read(value):
        return json.loads(value) if isinstance(value, str) else value

    rows = []
    for source in progress["sources"]:
        done, end = read(source["endOffset"]), read(source.get("latestOffset"))
        if done is None:
            continue
        end = done if end is None else end
        if set(done) == {"logOffset"}:  # a file source
            done, end = ({source["description"]: {"0": offset["logOffset"]}} for offset in (done, end))
        rows += progress_lag({"sources": [{"endOffset": done, "latestOffset": end}]}, group_id)
    return rows


class LagLog(StreamingQueryListener):
    """Appends the lag rows of each progress of the queries of one name to a folder; the query's name is the group.

    A progress has one row for each topic partition, which the driver has in hand already. Progress without a new batch
    is left out. A repeated batch writes its rows again; ``latest`` takes the newest of a partition.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        super().__init__()
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.name:
            return
        progress = json.loads(event.progress.json)
        rows = [{**r, "batch_id": progress["batchId"], "noted_at": progress["timestamp"]}
                for r in offset_rows(progress, self.name)]
        if rows:
            self.spark.createDataFrame(rows, LAG_ROWS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def history(self) -> DataFrame:
        return self.spark.read.schema(LAG_ROWS).parquet(self.path)

    def latest(self) -> DataFrame:
        """The newest row of each partition, in the columns of ``lag.consumer_lag``."""
        place = ["group_id", "topic", "partition_id"]
        value = F.struct("committed_offset", "end_offset", "lag")
        return self.history().groupBy(*place).agg(
            F.max_by(value, F.struct("batch_id", "noted_at")).alias("v")).select(*place, "v.*")
