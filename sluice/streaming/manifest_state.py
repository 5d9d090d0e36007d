"""The manifest kept up to date from new events only.

A file stream over the event log hands each event file to one micro-batch;
``foreachBatch`` merges what they say into the state of all earlier ones (one
row per upload). So a stage reads the state and the events appended since,
never the whole history. The stream's checkpoint decides which files are new,
not a clock, so no event is missed, whoever appended it and when.

The state of a micro-batch is a folder of its own, written whole; a batch
that is run again after a crash starts from the state before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.operators import manifest as MF


def _epochs(spark: SparkSession, root: str) -> list[int]:
    """The micro-batches whose state is whole."""
    from sluice.sources.landing import _fs_path

    fs, folder = _fs_path(spark, root)
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder) if st.isDirectory()]
    numbers = [int(n[len("epoch-"):]) for n in names if n.startswith("epoch-")]
    return sorted(n for n in numbers if fs.exists(_fs_path(spark, f"{root}/epoch-{n}/_SUCCESS")[1]))


def advance(spark: SparkSession, events_path: str, root: str, ts_type: T.DataType = T.TimestampType()) -> int:
    """Take up the event files that are new since the last call; returns how
    many events they held. ``root`` holds the states and the checkpoint."""
    from sluice.operators.bronze import drop_folder

    schema = T.StructType(MF.event_schema(ts_type).fields + [T.StructField("event_day", T.DateType())])
    taken = 0

    def merge(events: DataFrame, epoch: int) -> None:
        earlier = [e for e in _epochs(spark, root) if e < epoch]
        state = MF.state_of(events.drop("event_day"))
        if earlier:
            before = spark.read.schema(state.schema).parquet(f"{root}/epoch-{earlier[-1]}")
            state = MF.merge_states(before.unionByName(state))
        state.hint("rebalance").write.mode("overwrite").parquet(f"{root}/epoch-{epoch}")
        for old in earlier[:-1]:  # the one before stays, should this batch be run again
            drop_folder(spark, f"{root}/epoch-{old}")

    query = (
        spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(events_path)
        .writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    for progress in query.recentProgress:
        taken += progress["numInputRows"]
    return taken


def current(spark: SparkSession, events_path: str, root: str, ts_type: T.DataType = T.TimestampType()) -> DataFrame:
    """The manifest of all events so far."""
    advance(spark, events_path, root, ts_type)
    epochs = _epochs(spark, root)
    empty = MF.state_of(MF.empty_events(spark, ts_type))
    if not epochs:
        return MF.manifest_of(empty)
    return MF.manifest_of(spark.read.schema(empty.schema).parquet(f"{root}/epoch-{epochs[-1]}"))
