"""DED-3: the history folder as the source of a second stream.

Loads write the history and nothing else.  This query lists the history's
batch folders like any file source, and appends each row it has not yet read to
the latest table; its own checkpoint says how far it is.  So the two tables
cannot be left apart for good: a crash between a load and its propagation only
means that the next run carries the rows over.  A batch of this query that is
replayed appends rows a second time to the latest table, where rows of one key
and version count once.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wickline.plans import fs
from wickline.schemas import MONTH

if TYPE_CHECKING:
    from wickline.plans.store import CandleStore

POLL_SECONDS = 5


def history_stream(store: CandleStore, max_files: int | None = None) -> DataFrame:
    """New files of the history's load and stream batches, of any age.

    Merged batches (``optimize_history``) hold only rows read before and are
    not listed.  A load that is run again overwrites its folder under new file
    names: files of the earlier attempt that are gone by the time they are
    read are passed over, since their rows are in the new ones.
    """
    from wickline.plans.store import BATCH, LOADED, STREAMED

    base = store.append_only_path
    schema = store.spark.read.parquet(base).schema
    reader = (
        store.spark.readStream.schema(schema)
        .option("basePath", base)
        .option("ignoreMissingFiles", "true")
        # the default skips files a week older than the newest one seen
        .option("maxFileAge", "36500d")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{base}/{BATCH}={{{LOADED},{STREAMED}}}-*")


def start_propagation(
    store: CandleStore,
    checkpoint: str | None = None,
    available_now: bool = False,
    poll_seconds: int = POLL_SECONDS,
    max_files: int | None = None,
) -> StreamingQuery | None:
    """Start carrying history rows to the latest table: all that is there now
    (``available_now``), or on and on.  None where there is no history yet.
    One such query a store at a time, and none during ``compact``."""
    if not fs.has_data(store.spark, store.append_only_path):
        return None
    table = store.latest_table

    def run_batch(rows: DataFrame, batch_id: int) -> None:
        table.append(rows.select(*table.stored, MONTH))

    writer = history_stream(store, max_files).writeStream.foreachBatch(run_batch)
    writer = writer.option("checkpointLocation", checkpoint or store.propagation_checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{poll_seconds} seconds")
    return writer.start()
