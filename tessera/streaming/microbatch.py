"""Continuous upsert: a Structured Streaming source of input batches, merged per micro-batch.

Each stored-procedure call is already "apply one batch", so the stream form is
``readStream`` of the entity's input rows and ``foreachBatch`` running the same
merge on every micro-batch, publishing through :mod:`tessera.sources.sinks`
with the micro-batch id.  The stream's checkpoint records which batch ids were
handed to ``foreachBatch``; the table's commits make a replayed batch a no-op, so
the change feed is exactly-once even when a batch is retried after a failure.  A
stream with another checkpoint counts from 0 again and is another run.

Pickups and visits also roll facts up into the patients: both tables lie in one
published folder and move in one commit.  Deletes are streams of id lists.

The snapshot is re-read from its published path at the start of each batch, so
the lineage of batch ``n`` never contains batch ``n - 1``'s plan.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.operators.merge import MergeResult
from tessera.sources.sinks import Touch, publish, publish_tables, read_feed

MergeFn = Callable[[DataFrame, DataFrame, dt.datetime], MergeResult]
MergeWithPatientFn = Callable[[DataFrame, DataFrame, DataFrame, dt.datetime], tuple[MergeResult, DataFrame]]

PATIENTS = "patient"
#: The patient column by which the patients of a batch are found (trimmed, as the lookups and rollups compare it).
PATIENT_KEY = "PmsPatientId"


def upsert_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    merge_fn: MergeFn,
    snapshot_path: str,
    delta_path: str,
    as_of: dt.datetime | None = None,
    key: Column | None = None,
    buckets: int = 0,
    run_id: str = "",
) -> bool:
    """Merge one batch into the published snapshot and publish the result; False when it was published before.

    With ``buckets`` > 0 the snapshot is laid out by (tenant, hash bucket of
    ``key``), ``key`` being the normalised key expression of the entity; only
    the touched buckets are read and written.  ``merge_fn`` may as well be a
    soft delete or a slot delete of a batch of ids.
    """
    clock = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def change(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        result = merge_fn(rows, batch, clock)
        return result.snapshot, result.delta

    return publish(spark, snapshot_path, batch_id, batch, change, delta_path, key, buckets, run_id)


def upsert_batch_with_patients(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    merge_fn: MergeWithPatientFn,
    path: str,
    entity: str,
    delta_path: str,
    as_of: dt.datetime | None = None,
    key: Column | None = None,
    buckets: int = 0,
    patient_buckets: int = 0,
    run_id: str = "",
) -> bool:
    """As :func:`upsert_batch` for the tables ``entity`` and ``patient`` under ``path``, in one commit.

    Read and written are the partitions that the batch's keys and its patients
    fall in; the rest of the patient table is neither read nor copied.
    """
    clock = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def change(rows: dict[str, DataFrame]) -> dict:
        result, patients = merge_fn(rows[entity], batch, rows[PATIENTS], clock)
        return {entity: (result.snapshot, result.delta), PATIENTS: (patients, None)}

    touches = {
        entity: Touch(batch, key, buckets, delta_path),
        PATIENTS: Touch(batch, F.trim(F.col(PATIENT_KEY)) if patient_buckets else None, patient_buckets),
    }
    return publish_tables(spark, path, batch_id, batch, touches, change, run_id)


def _run_id(checkpoint_location: str) -> str:
    return hashlib.sha1(checkpoint_location.encode()).hexdigest()[:12]


def _start(
    spark: SparkSession, source_dir: str, schema: StructType | str, run: Callable[[DataFrame, int], None],
    checkpoint_location: str, max_files_per_trigger: int | None, trigger_available_now: bool,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(source_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def start_upsert_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    merge_fn: MergeFn,
    snapshot_path: str,
    delta_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
    trigger_available_now: bool = True,
    key: Column | None = None,
    buckets: int = 0,
) -> StreamingQuery:
    """Stream parquet input batches (or id lists) from ``source_dir`` into the snapshot at ``snapshot_path``."""
    run_id = _run_id(checkpoint_location)

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(
            spark, batch, batch_id, merge_fn, snapshot_path, delta_path, key=key, buckets=buckets, run_id=run_id
        )

    return _start(spark, source_dir, schema, run, checkpoint_location, max_files_per_trigger, trigger_available_now)


def start_patient_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    merge_fn: MergeWithPatientFn,
    path: str,
    entity: str,
    delta_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
    trigger_available_now: bool = True,
    key: Column | None = None,
    buckets: int = 0,
    patient_buckets: int = 0,
) -> StreamingQuery:
    """Stream visits or pickups into ``entity`` and the patients under ``path``, one commit a micro-batch.

    Streams of several entities may share the patients: a commit that another
    stream was faster with is prepared again from the newer tables.
    """
    run_id = _run_id(checkpoint_location)

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_batch_with_patients(
            spark, batch, batch_id, merge_fn, path, entity, delta_path, key=key, buckets=buckets,
            patient_buckets=patient_buckets, run_id=run_id,
        )

    return _start(spark, source_dir, schema, run, checkpoint_location, max_files_per_trigger, trigger_available_now)


def start_feed_stream(
    spark: SparkSession,
    path: str,
    feed_path: str,
    consume: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    max_commits_per_trigger: int = 1000,
    trigger_available_now: bool = True,
) -> StreamingQuery:
    """Stream a change feed: each committed row is handed to ``consume(rows, batch_id)`` in one micro-batch.

    The stream follows the commit files, which appear whole and never change, and
    reads the rows of new commits in one scan.  Rows carry their ``_commit``; a
    micro-batch that is repeated after a failure has the same rows.
    """
    commits = spark.readStream.schema("commit int").option("maxFilesPerTrigger", max_commits_per_trigger)
    commits = commits.option("pathGlobFilter", "*.json").json(f"{path}/commits")

    def run(new: DataFrame, batch_id: int) -> None:
        numbers = sorted(r.commit for r in new.collect())  # one number a commit
        if not numbers:
            return
        rows = read_feed(spark, path, feed_path, after=numbers[0] - 1, upto=numbers[-1], with_commit=True)
        if rows is not None:
            consume(rows.filter(F.col("_commit").isin(numbers)), batch_id)

    writer = commits.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()
