"""Landing of order pages with Structured Streaming.

Page files that arrive in an inbox (one JSON page per line) are dealt over the
day folders that the batch reader reads: ``dia=yyyy-MM-dd/lote=<batch>``, the day
being that of the page's first order.  A batch replaces its own ``lote``
folders, so one that is replayed after a failure lands its pages once.  Within
a folder pages are in the order of their files and lines, and later batches
sort behind earlier ones, so "the later line wins" means the same as for pages
that were landed at once.  ``order_feed.read_pages`` reads the result, windows
and all; a run on landed pages equals a run on pages landed by a batch job.

Pages whose day can't be read (cut, or without orders) land under ``dia=sem-data``,
which no window reads and ``order_feed.feed_rejects`` of the whole feed lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesabc.functions.dates import iso_wall_date
from salesabc.sources.order_feed import DAY_DIR, PAGE

NO_DAY = "sem-data"


def _day() -> Column:
    page = F.from_json(F.col("value"), PAGE)
    return F.coalesce(F.date_format(iso_wall_date(F.get(page["orders"], 0)["dateCreated"]), "yyyy-MM-dd"), F.lit(NO_DAY))


def land_batch(pages: DataFrame, batch_id: int, feed_dir: str) -> None:
    """Land pages (value, arquivo) under the day folders, replacing what this batch landed before."""
    own = pages.select("value", "arquivo", F.monotonically_increasing_id().alias("linha")).withColumn(DAY_DIR, _day())
    # Fixed-width batch numbers sort as numbers.
    placed = own.withColumn("lote", F.lit(f"{batch_id:012d}")).repartition(DAY_DIR).sortWithinPartitions(DAY_DIR, "arquivo", "linha")
    (placed.select("value", DAY_DIR, "lote").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_DIR, "lote").text(feed_dir))


def start_feed_landing(spark: SparkSession, inbox: str, feed_dir: str, checkpoint_dir: str, available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start landing the inbox; ``available_now`` lands what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(inbox).select("value", F.col("_metadata.file_path").alias("arquivo"))
    writer = lines.writeStream.foreachBatch(lambda batch, n: land_batch(batch, n, feed_dir)).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
