"""Pages landed by a stream give the runs that pages landed at once give."""

import datetime as dt

from pyspark.sql import functions as F

from salesabc import session
from salesabc.plans import registry as R
from salesabc.plans.sales_run import run_sales
from salesabc.sources import order_feed
from salesabc.sources import testviews as tv
from salesabc.streaming.feed_stream import land_batch, start_feed_landing

from .conftest import SF_SMALL


def _inbox(spark):
    """Two arrivals: files of a few days each, then corrections of some orders."""
    inbox = session.scratch_path(spark, "inbox")
    pages = tv.order_pages_text(spark, SF_SMALL).where("dia between '1998-03-01' and '1998-03-20'")
    pages.repartition(5, "dia").sortWithinPartitions("dia", "pg").select("value").write.text(inbox)
    return inbox, pages


def test_stream_then_batch_equals_batch(spark):
    inbox, pages = _inbox(spark)
    feed, checkpoint = session.scratch_path(spark, "feed"), session.scratch_path(spark, "feed-checkpoint")
    start_feed_landing(spark, inbox, feed, checkpoint, max_files_per_trigger=2).awaitTermination(300)
    pages.where("dia = '1998-03-14'").select(F.regexp_replace("value", r'"quantity":\d+', '"quantity":77').alias("value")).write.mode("append").text(inbox)
    start_feed_landing(spark, inbox, feed, checkpoint).awaitTermination(300)
    landed = order_feed.read_pages(spark, feed, dt.date(1998, 3, 14), dt.date(1998, 3, 15))
    assert landed.where("page is null").count() == 0 and landed.select("page").distinct().count() == landed.count() > 0
    once = session.scratch_path(spark, "once")
    again = pages.where("dia = '1998-03-14'").withColumn("value", F.regexp_replace("value", r'"quantity":\d+', '"quantity":77')).withColumn("pg", F.col("pg") + 1000)
    pages.unionByName(again).repartition("dia").sortWithinPartitions("dia", "pg").select("dia", "value").write.partitionBy("dia").text(once)
    facts = []
    for path in (feed, once):
        inputs = R.run_inputs(spark, SF_SMALL, R.AS_OF)
        inputs.feed_pages = lambda lo, hi, p=path: order_feed.read_pages(spark, p, lo, hi)
        facts.append(run_sales(inputs, R.AS_OF, R.PROFILE).fact)
    a, b = facts
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where("quantidade = 77").count() > 0


def test_replayed_batch_lands_once(spark):
    inbox, _ = _inbox(spark)
    feed = session.scratch_path(spark, "replay")
    pages = spark.read.text(inbox).select("value", F.col("_metadata.file_path").alias("arquivo")).unionAll(spark.createDataFrame([('{"total": 1, "orders": [{', "cut")], "value string, arquivo string"))
    land_batch(pages, 0, feed)
    n = order_feed.read_pages(spark, feed).count()
    land_batch(pages, 0, feed)
    assert order_feed.read_pages(spark, feed).count() == n == pages.count()
    assert [r.dia for r in order_feed.feed_rejects(order_feed.read_pages(spark, feed)).collect()] == ["sem-data"]
