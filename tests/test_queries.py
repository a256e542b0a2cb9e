"""Every registered query against its DuckDB oracle, plus plan invariants."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesabc import config
from salesabc.plans import registry as R
from salesabc.sources import order_feed
from salesabc.sources.testviews import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(R.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    res = duck.sql(E.oracle_sql()[name])
    want = _rows(res.fetchall(), res.columns)
    assert sorted(df.columns) == sorted(res.columns)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(R.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "curva_abc_gmv" in df.columns


def test_pareto_invariants(spark):
    p = R.QUERIES["pareto_abc"](spark, SF_SMALL)
    # running share never decreases along the value order (non-negative values)
    from pyspark.sql import Window
    w = Window.partitionBy("grupo", "mes").orderBy(F.col("quantidade_total_vendida").desc(), "sku", "titulo")
    bad = (p.withColumn("prev", F.lag("pareto_quantidade_acumulada").over(w))
            .filter(F.col("prev") > F.col("pareto_quantidade_acumulada")).count())
    assert bad == 0
    # the overall group equals the sum of the stores ("<region> - <nation>")
    overall = p.filter(F.col("grupo") == config.TEST_PROFILE.overall_label).agg(F.sum("valor_total_gmv")).first()[0]
    stores = p.filter(F.col("grupo").contains(" - ")).agg(F.sum("valor_total_gmv")).first()[0]
    assert abs(overall - stores) < 1e-3


def test_fact_unique_and_order_independent(spark):
    st = R._run(spark, SF_SMALL)
    fact = st.fact
    assert fact.count() == fact.select("numero_pedido", "sku").distinct().count()
    # Same result when every input is randomly repartitioned.
    inputs = R.run_inputs(spark, SF_SMALL, R.AS_OF)
    for k in ("closed_sheets", "current_sheet"):
        setattr(inputs, k, getattr(inputs, k).repartition(7))
    pages = inputs.feed_pages
    inputs.feed_pages = lambda lo, hi: pages(lo, hi).repartition(7)
    from salesabc.plans.sales_run import run_sales
    again = run_sales(inputs, R.AS_OF, R.PROFILE).fact
    assert fact.exceptAll(again).count() == 0 and again.exceptAll(fact).count() == 0


def test_feed_reads_the_window_only(spark):
    """The days of the window reach the scan as a partition filter; pages carry no number."""
    import datetime as dt
    pages = R._feed_pages(spark, SF_SMALL, dt.date(1998, 3, 14), dt.date(1998, 3, 15))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan
    assert {r[0] for r in pages.select("dia").distinct().collect()} == {"1998-03-14", "1998-03-15"}
    assert '"page"' not in spark.read.text(R.landed_feed(spark, SF_SMALL)).first()[0]


def test_missing_page_is_seen(spark):
    pages = R._feed_pages(spark, SF_SMALL)
    day = pages.groupBy("dia").count().orderBy("dia").first()[0]
    left = order_feed.page_completeness(pages.where(F.col("dia") == day).limit(0).unionByName(pages.where(F.col("dia") != day)))
    assert left.where(F.col("dia") == day).count() == 0
    short = pages.withColumn("orders", F.when(F.col("dia") == day, F.slice("orders", 1, 0)).otherwise(F.col("orders")))
    got = order_feed.page_completeness(short).where(~F.col("completo")).collect()
    assert [r.dia for r in got] == [day]
