"""Live pick-up: fields that land in a folder become cells of a store, micro-batch by micro-batch, or run by run once these are whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import normalise, runs
from ..operators.layout import Layout, layout_of
from ..sources import storage


def follow(spark: SparkSession, landing: str, schema, store: str, variables: list[str], checkpoint: str, files_each: int | None = None, order: str = "event_id", layout: Layout | None = None) -> DataFrame:
    """Takes up all files that have landed since the checkpoint, and returns the store: empty if nothing has.

    Each micro-batch is normalised and upserted; of equal fields in a batch the first by `order` stays, and a later batch wins
    over an earlier one. A batch that runs again writes the same folders again.
    """
    layout = layout or layout_of(storage.KEYS)
    stream = spark.readStream.schema(schema)
    stream = stream.option("maxFilesPerTrigger", files_each) if files_each else stream

    def take(batch: DataFrame, number: int) -> None:
        cells = normalise.normalise_fields(batch, variables, order).withColumn("seq", F.lit(number).cast("long"))
        old = storage.found(batch.sparkSession, store, f"seq long, {layout.schema}")
        if old is None:  # the first batch finds no store
            storage.write(cells, store)
        else:
            storage.upsert(old.select(*cells.columns), cells, store)

    stream.parquet(landing).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    found = storage.found(spark, store, f"seq long, {layout.schema}")
    return found if found is not None else spark.createDataFrame([], f"seq long, {layout.schema}")


def follow_runs(
    spark: SparkSession, landing: str, schema, path: str, model: str, axis: DataFrame, expected: DataFrame, allowed: list[str], checkpoint: str, patience: int = 8, files_each: int | None = None, kind: str = "gfs", rules: runs.Rules = runs.Rules()
) -> DataFrame:
    """Takes up what has landed since the checkpoint, and judges each run once, as consume() does, when it is whole or time is up.

    expected: (init_time, n_files). A run is whole when so many different files (url) have landed; time is up when its last
    file came `patience` micro-batches ago, or its first one twice as many. Until then its fields lie in path + ".pending",
    a folder for each micro-batch: one that runs again writes its folder again, finds its runs judged or judges them from
    the same fields, so that nothing changes. Fields of a run that come after it was judged are kept there, and change
    nothing. Pending fields of judged runs may be deleted at any time.

    Returns the rows of all runs that were judged so far (see consume).
    """
    stream = spark.readStream.schema(schema)
    stream = stream.option("maxFilesPerTrigger", files_each) if files_each else stream

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}.pending/batch={number}")
        pending = own.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}.pending")
        judged = storage.found(own, f"{path}.runs")
        state = pending.groupBy("init_time").agg(F.count_distinct("url").alias("n"), F.min("batch").alias("first"), F.max("batch").alias("last")).join(expected, "init_time", "left")
        late = (F.col("last") <= number - patience) | (F.col("first") <= number - 2 * patience)
        ready = state.where((F.col("n") >= F.col("n_files")) | late).select("init_time")
        ready = ready if judged is None else ready.join(judged.select("init_time"), "init_time", "left_anti")
        with storage.scratch(own):
            ready = storage.kept(ready, "ready")
            if ready.limit(1).count():
                runs.consume(own, path, model, axis, ready, lambda missing: pending.drop("batch").join(missing, "init_time", "left_semi"), allowed, kind, rules)

    stream.parquet(landing).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    judged = storage.found(spark, f"{path}.runs")
    return judged.drop("call") if judged is not None else spark.createDataFrame([], "init_time timestamp_ntz, status string")
