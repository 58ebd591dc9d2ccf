"""The batch features on a stream, with the last rows of each entity as state.

Each micro-batch joins the stored last rows, runs the same window columns as the batch code, writes its
rows, and stores the new last rows. Nothing is kept in a worker: state is a table in the shared folder, so
a lost executor costs a retry, and an entity with very many rows in a batch is split in blocks like in a
batch job.

Output and state of batch k are written to places that depend only on k. A batch that is run again after a
failure reads the state of batch k-1, which it does not touch, and overwrites its own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import schema as S
from tickloom.functions.scalar import clipped, ensure_columns, nan_to_null
from tickloom.operators.joins import semi_join_last_steps
from tickloom.plans import sizing
from tickloom.plans.features import EntityStep, add_entity_steps
from tickloom.session import scratch_path

_NEW = "_new"


class BatchLimit(Exception):
    """Ends a run before a batch beyond the cap is committed, so that a later run still gets it."""


@dataclass
class Scorer:
    """What happens to a batch after its features: columns a model needs, prediction, limits."""

    predict: Callable[[DataFrame], DataFrame]
    required: Sequence[str] = ()
    low: float | None = -5.0
    high: float | None = 5.0
    prediction: str = S.PREDICTION

    def __call__(self, df: DataFrame) -> DataFrame:
        scored = self.predict(ensure_columns(df, self.required))
        return scored.withColumn(self.prediction, clipped(F.col(self.prediction), self.low, self.high))


@dataclass
class LagTable:
    """Lag rows that keep landing in a folder, partitioned by date, while a stream runs: a second, changing input.

    A batch row takes the lag row of its key that is in the folder when its batch runs, read afresh and pruned to
    the batch's dates. A row whose lag row is not there yet gets null lag columns (the missing value) and its key is
    recorded; a lag row that lands after its row's batch is late: it is counted and kept apart (``late_lags``) and
    never changes rows already written, which stay append-only. A key must have at most one lag row.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str] = tuple(S.KEYS)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.keys]

    def land(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("append").partitionBy(S.DATE).parquet(self.path)

    def read(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """What has landed so far, of the dates from ``first`` to ``last`` if given (read from those folders only)."""
        try:
            rows = spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)
        if first is not None:
            rows = rows.where(F.col(S.DATE).between(first, last))
        return rows


@dataclass
class FeatureStream:
    """Lag and rolling features of a stream of panel rows."""

    spark: SparkSession
    steps: list[EntityStep]
    columns: T.StructType
    buffer_size: int = 30
    scorer: Scorer | None = None
    max_batches: int | None = None
    home: str = ""
    lags: LagTable | None = None
    late_rows: int = 0
    batches: list[dict] = field(default_factory=list)
    _full: bool = False

    def __post_init__(self) -> None:
        need = max(step.reach for step in self.steps)
        if self.buffer_size < need:
            raise ValueError(f"a buffer of {self.buffer_size} rows cannot feed steps that reach back {need}")
        self.entity = list(self.steps[0].entity)
        self.order = list(self.steps[0].order)
        # With the home of an earlier stream this one goes on where that one stopped.
        if not self.home:
            self.reset()

    def reset(self) -> None:
        """Forget everything: new folders for checkpoint, state and output, counters at zero."""
        self.home = scratch_path(self.spark, "stream")
        self.late_rows = 0
        self.batches = []
        self.spark.createDataFrame([], self.columns).write.parquet(self._slot(-1))

    # State

    def _slot(self, batch_id: int) -> str:
        """Two places in turn: batch k reads the one it does not write."""
        return f"{self.home}/state/slot={batch_id % 2}"

    def warm_up(self, history: DataFrame) -> None:
        """Fill the buffers from the last ``buffer_size`` steps of history, before the first batch."""
        recent = semi_join_last_steps(history.select(*self.columns.names), self.buffer_size)
        self._last_rows(recent).write.mode("overwrite").parquet(self._slot(-1))

    def _last_rows(self, df: DataFrame) -> DataFrame:
        """The newest ``buffer_size`` rows per entity; Spark limits each group before the shuffle too."""
        newest = Window.partitionBy(*self.entity).orderBy(*[F.col(c).desc() for c in self.order])
        ranked = df.withColumn("_k", F.row_number().over(newest))
        return ranked.where(F.col("_k") <= self.buffer_size).drop("_k")

    def state(self) -> DataFrame:
        """The buffered rows after the last finished batch."""
        return self._read(self._last_batch())

    def _last_batch(self) -> int:
        """The last finished batch, also of an earlier stream with this home; -1 if there is none."""
        if self.batches:
            return self.batches[-1]["batch_id"]
        found = self._table("progress")
        return -1 if found is None else found.agg(F.max("batch_id")).first()[0]

    def _table(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.home}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def late(self) -> DataFrame:
        """Rows that came too late for features, with their batch number."""
        found = self._table("late")
        return self.spark.createDataFrame([], T.StructType([*self.columns.fields, T.StructField("batch", T.IntegerType())])) if found is None else found

    def _read(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.columns).parquet(self._slot(batch_id))

    @property
    def n_updates(self) -> int:
        """Finished batches since the last reset, also those before a restart."""
        found = self._table("progress")
        return 0 if found is None else found.count()

    def n_symbols(self) -> int:
        return self.state().select(*self.entity).distinct().count()

    # Batches

    def process(self, batch: DataFrame, batch_id: int) -> None:
        if self.max_batches is not None and batch_id >= self.max_batches:
            self._full = True
            raise BatchLimit(f"batch {batch_id} is beyond the cap of {self.max_batches}")
        start = time.perf_counter()
        rows = batch.select(*self.columns.names)
        past = self._read(batch_id - 1)
        # Rows not later than what their entity has already seen would rewrite the past; they get no features,
        # and are counted and kept in a table of their own.
        seen = past.groupBy(*self.entity).agg(F.max(F.struct(*self.order)).alias("_seen"))
        late = F.coalesce(F.struct(*self.order) <= F.col("_seen"), F.lit(False))
        marked = rows.join(sizing.lookup_side(seen), self.entity, "left").withColumn("_late", late)
        joined = (
            past.withColumns({_NEW: F.lit(False), "_late": F.lit(False)})
            .unionByName(marked.drop("_seen").withColumn(_NEW, F.lit(True)))
            .persist()
        )
        try:
            new_date = F.when(F.col(_NEW), F.col(S.DATE))
            counts = joined.agg(
                F.count_if(F.col(_NEW)).alias("n"), F.count_if("_late").alias("late"), F.min(new_date).alias("first"), F.max(new_date).alias("last")
            ).first()
            usable = joined.where(~F.col("_late")).drop("_late")
            out = add_entity_steps(usable, self.steps).where(F.col(_NEW)).drop(_NEW)
            if self.lags is not None:
                out = self._with_lags(out, batch_id, counts["first"], counts["last"])
            if self.scorer is not None:
                out = self.scorer(out)
            out.write.mode("overwrite").parquet(f"{self.home}/output/batch={batch_id}")
            if counts["late"]:
                late = joined.where("_late").drop(_NEW, "_late")
                late.write.mode("overwrite").parquet(f"{self.home}/late/batch={batch_id}")
            self._last_rows(usable.drop(_NEW)).write.mode("overwrite").parquet(self._slot(batch_id))
            done = self.spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1)
            done.write.mode("overwrite").parquet(f"{self.home}/progress/batch={batch_id}")
        finally:
            joined.unpersist()
        self.late_rows += counts["late"]
        took = (time.perf_counter() - start) * 1000
        self.batches.append({"batch_id": batch_id, "n_rows": counts["n"], "latency_ms": took})

    def _with_lags(self, out: DataFrame, batch_id: int, first: int | None, last: int | None) -> DataFrame:
        """The batch's rows with their lag columns; keys without a lag row are recorded for the late rule."""
        lags = self.lags.read(self.spark, first, last) if first is not None else self.spark.createDataFrame([], self.lags.schema)
        keys = list(self.lags.keys)
        found = lags.withColumn("_has_lag", F.lit(True))
        # Batch rows and the lag rows of their dates: both sides grow with one batch, not with the stream.
        joined = out.join(found, keys, "left")
        missing = joined.where(F.col("_has_lag").isNull()).select(*keys).distinct()
        missing.write.mode("overwrite").parquet(f"{self.home}/missing_lags/batch={batch_id}")
        return joined.drop("_has_lag")

    def late_lags(self) -> DataFrame:
        """Lag rows that landed after the batch of their key's rows, with that batch; empty without a lag table."""
        if self.lags is None:
            return self.spark.createDataFrame([], "batch int")
        missing = self._table("missing_lags")
        schema = T.StructType([*self.lags.schema.fields, T.StructField("batch", T.IntegerType())])
        if missing is None:
            return self.spark.createDataFrame([], schema)
        return self.lags.read(self.spark).join(missing, list(self.lags.keys), "inner").select(*schema.names)

    def run(self, stream: DataFrame) -> StreamingQuery:
        """Process all data that is there, batch by batch, then stop; call again to go on.

        With ``max_batches`` it stops before the first batch beyond the cap; that batch is not committed.
        """
        self._full = False
        query = (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.home}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not self._full:
                raise
        return query

    def output(self) -> DataFrame:
        """Rows of all batches, with their batch number."""
        return self.spark.read.parquet(f"{self.home}/output")

    def latencies(self) -> DataFrame:
        rows = [(b["batch_id"], b["n_rows"], b["latency_ms"]) for b in self.batches]
        return self.spark.createDataFrame(rows, "batch_id int, n_rows bigint, latency_ms double")


def latency_summary(latencies: DataFrame) -> DataFrame:
    return latencies.agg(
        F.count("*").alias("n_batches"), F.sum("n_rows").alias("n_rows"), F.avg("latency_ms").alias("mean_latency_ms")
    )


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files in order of arrival, at most ``files_per_batch`` of them per micro-batch; NaN becomes NULL."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.parquet(path))


def running_score(
    stream: DataFrame,
    home: str,
    truth: str = S.TARGET,
    prediction: str = S.PREDICTION,
    weight: str = S.WEIGHT,
    checkpoint: str | None = None,
) -> tuple[str, StreamingQuery]:
    """Keep the sums per date as streaming state and write the daily scores after each batch."""
    from tickloom.operators import metrics

    def write(sums: DataFrame, batch_id: int) -> None:
        metrics.score_per_date(sums).write.mode("overwrite").parquet(f"{home}/scores")

    query = (
        metrics.date_sums(stream, truth, prediction, weight)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{home}/scores", query
