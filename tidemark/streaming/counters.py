"""Counters of streaming jobs that outlast the job: what `observe` counts, stored by run and batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources.keyed import Folder

INTENT_COUNTERS = "run bigint, batch_id bigint, at string, score_updates bigint, events bigint"


class CounterLog(StreamingQueryListener):
    """Stores the observed counters of one query, a small file for each batch that counted anything.

    A file is put in place whole and once, so a batch that runs again after a restart is not counted twice.
    """

    def __init__(self, spark: SparkSession, path: str, run: int, query: str, metric: str) -> None:
        self.folder, self.run, self.query, self.metric = Folder(spark, path), run, query, metric

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = progress.observedMetrics.get(self.metric) if progress.name == self.query else None
        if counted is None or not any(counted.asDict().values()):
            return
        note = {"run": self.run, "batch_id": progress.batchId, "at": progress.timestamp, **counted.asDict()}
        try:
            self.folder.put(f"run={self.run}/batch-{progress.batchId}.json", json.dumps(note))
        except FileExistsError:
            pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stored_counters(spark: SparkSession, path: str, schema: str = INTENT_COUNTERS) -> DataFrame:
    """One row for each run and batch."""
    return spark.read.schema(schema).json(f"{path}/run=*/*.json")


def totals(counters: DataFrame) -> DataFrame:
    """Each counter summed over all runs and batches."""
    told = [c for c in counters.columns if c not in ("run", "batch_id", "at")]
    return counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in told])
