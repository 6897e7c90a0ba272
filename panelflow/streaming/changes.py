"""Online change detection with bounded state per key.

Each micro-batch is scored with the same block plan as a batch job, on the new rows plus
the last ``2w - 1`` rows of each key from the batch before. So a key that holds most of a
batch is still spread over many tasks, which a per-key state function would not allow.
State and output are written per batch id, so a batch that runs again replaces its own
files and nothing else. The states of the last two batches are kept; older ones go. A batch is read
once: its rows are persisted while late rows, scores and state are derived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.operators.regimes import cusum_columns
from panelflow.plans.series import Series, frames, public
from panelflow.sources.storage import children, exists, remove


@dataclass(frozen=True)
class ChangeStream:
    """Scores a stream of (key, time, value) rows.

    Rows must reach the stream in time order per key, up to the order inside a batch. Rows
    not newer than their key's last scored row go to the ``late`` folder, unscored.
    """

    series: Series
    value: str
    root: str
    window: int = 10
    threshold: float = 2.5
    normalise: bool = False

    @property
    def output(self) -> str:
        return f"{self.root}/scores"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    def _state_before(self, spark, batch_id: int) -> str | None:
        ids = [int(n.split("=")[1]) for n in children(spark, f"{self.root}/state") if n.startswith("batch_id=")]
        ids = [i for i in ids if i < batch_id and exists(spark, f"{self.root}/state/batch_id={i}/_SUCCESS")]
        return f"{self.root}/state/batch_id={max(ids)}" if ids else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        keys, order = list(self.series.keys), list(self.series.order)
        rows = batch.select(*keys, *order, self.value).withColumn("_new", F.lit(True)).persist()
        try:
            self._score(rows, batch_id)
        finally:
            rows.unpersist()
        self._forget(batch.sparkSession, batch_id)

    def _forget(self, spark, batch_id: int) -> None:
        """Drop states that no replay can need: a replay is of the last batch, on the state before it."""
        for name in children(spark, f"{self.root}/state"):
            if name.startswith("batch_id=") and int(name.split("=")[1]) < batch_id - 1:
                remove(spark, f"{self.root}/state/{name}")

    def _score(self, rows: DataFrame, batch_id: int) -> None:
        s, spark = self.series, rows.sparkSession
        keys, order = list(s.keys), list(s.order)
        before = self._state_before(spark, batch_id)
        if before:
            tail = spark.read.parquet(before)
            # One row per key: the newest position already scored.
            seen = tail.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_seen"))
            marked = rows.join(seen, keys, "left").withColumn(
                "_late", F.coalesce(F.struct(*order) <= F.col("_seen"), F.lit(False))
            )
            marked.where("_late").drop("_new", "_seen", "_late").write.mode("overwrite").parquet(
                f"{self.late}/batch_id={batch_id}"
            )
            rows = marked.where(~F.col("_late")).drop("_seen", "_late")
            rows = rows.unionByName(tail.withColumn("_new", F.lit(False)))
        reach = 2 * self.window - 1
        scored = frames(rows, s, cusum_columns(self.value, self.window, self.normalise), back=reach)
        out = public(scored).where(F.col("_new") & F.col("score").isNotNull()).drop("_new")
        out = out.withColumn("is_change", F.abs("score") > self.threshold)
        out.write.mode("overwrite").parquet(f"{self.output}/batch_id={batch_id}")
        w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
        tail = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= reach)
        tail.drop("_r", "_new").write.mode("overwrite").parquet(f"{self.root}/state/batch_id={batch_id}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Process all available input."""
        (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(self.process)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
