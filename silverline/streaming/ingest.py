"""Checkpointed raw -> bronze ingest (Structured Streaming).

A batch reader cannot know which raw files it has already read; a file
stream source with a checkpoint can. Each run processes only files that
arrived since the last run (``trigger(availableNow=True)``). A micro-batch is
written as its own folder ``batch_id=B``; a micro-batch that is run again after
a failure has the same files and overwrites that folder, so each line is there
exactly once, and later readers can take micro-batches by their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.ingest import DEFAULT_SOURCE, record_key
from ..operators.bronze import to_bronze


def raw_lines(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """The lines of raw files that a checkpoint has not seen, with their file and its time; blank lines are no records.

    A file is told by its path: deliver new content under a new name.
    """
    reader = spark.readStream.schema("value STRING").option("recursiveFileLookup", recursive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return (reader.text(raw_dir)
            .select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("arrived"))
            .where(F.length(F.trim(F.col("value"))) > 0))


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, timeout_s: float | None = None,
                  state: dict | None = None) -> bool:
    """Hand everything available to ``write(micro-batch, number)`` and stop; False if ``timeout_s`` ended it earlier.

    ``state`` is told the rows that the query's state holds at the end (``state_rows``).

    A micro-batch that is run again after a failure has the same rows and number,
    so ``write`` has to replace what it wrote under that number.
    """
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finished = True
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        finished = False
    if state is not None:
        progress = query.lastProgress
        held = [o["numRowsTotal"] for o in (progress["stateOperators"] if progress else [])]
        state["state_rows"] = sum(held)
    return finished


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_arrivals(lines: DataFrame, within: str) -> DataFrame:
    """Stream of ``raw_lines`` without lines that arrived before, as far back as ``within`` (an interval).

    A line's time is when its file was last changed. The state holds the
    SHA-256 key of every line until the watermark, the latest time less the
    interval, has passed it: across micro-batches and restarts a line comes once.
    """
    return lines.withWatermark("arrived", within).withColumn("record_key", record_key("value")) \
        .dropDuplicatesWithinWatermark(["record_key"]).drop("record_key", "arrived")


def stream_ingest(spark: SparkSession, raw_dir: str, sink_path: str, checkpoint: str,
                  source: str = DEFAULT_SOURCE, timeout_s: float | None = None,
                  max_files_per_trigger: int | None = None, dedupe_within: str | None = None) -> dict:
    """Run the ingest once over everything available and stop.

    Output rows are bronze rows (status ``new``) plus ``source_file`` and the
    partition column ``batch_id``. Returns the number of micro-batches, rows and
    files that this run wrote, as the write itself observed them, so nothing is
    read again; ``files`` are those that rows came from. With ``dedupe_within`` repeated lines are left out
    (``first_arrivals``), and ``state_rows`` says how many keys the state holds;
    the state is kept in RocksDB, on the executors' disks. It runs until all is
    read; ``timeout_s`` stops it earlier, with ``finished`` False, and a later run
    goes on from there.
    """
    lines = raw_lines(spark, raw_dir, max_files_per_trigger)
    if dedupe_within:
        lines = first_arrivals(lines, dedupe_within)
    written: dict[int, dict] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        # hashes of the files of one micro-batch: as many as a trigger takes
        batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.size(F.collect_set(F.xxhash64("source_file"))).alias("files")) \
            .write.mode("overwrite").partitionBy("p_ingestdate").parquet(f"{sink_path}/batch_id={batch_id}")
        written[batch_id] = seen.get

    state: dict = {}
    with _state_store(spark, ROCKSDB if dedupe_within else None):
        finished = run_available(to_bronze(lines, source, keep=("source_file",)), write, checkpoint, timeout_s, state)
    out = {"finished": finished, "batches": len(written), **{k: sum(w[k] for w in written.values()) for k in ("rows", "files")}}
    return {**out, **state} if dedupe_within else out


@contextmanager
def _state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """The session's state store provider while a query is started and run."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    if provider:
        spark.conf.set(name, provider)
    try:
        yield
    finally:
        if provider:
            spark.conf.set(name, before) if before else spark.conf.unset(name)
