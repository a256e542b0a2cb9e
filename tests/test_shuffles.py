"""What the sales run shuffles and writes, on rows of the tests' own."""

import datetime as dt
import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from salesabc.functions.numeric import share_milli
from salesabc.operators import cumulative, dedup, pareto
from salesabc.sinks import writers
from salesabc.sources import files
from salesabc.sources import testviews as tv

DAY = dt.datetime(1998, 3, 2)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """An order with equal lines, one twice, one without lines, one whose customer is unknown, one of no day; null keys."""
    base = str(tmp_path_factory.mktemp("own"))
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ln = lambda k, p, n, q=1.0: (k, p, 1, n, q, 10.0, 0.0, 0.0, "A", "F", DAY)
    rows = {
        "region": ("r_regionkey long, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "N0", 0)]),
        "customer": ("c_custkey long, c_nationkey long, c_mktsegment string", [(1, 0, "AUTO")]),
        "supplier": ("s_suppkey long, s_name string", [(1, "S1")]),
        "part": ("p_partkey long, p_name string, p_retailprice double, p_type string, p_brand string", [(1, "b", 2.0, "t", "x"), (2, "a", 1.0, "t", "x"), (2, "c", 1.0, "t", "x")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "F", 1.0, DAY, "1-U"), (2, 1, "O", 1.0, DAY, "2-H"), (2, 1, "F", 1.0, DAY, "2-H"), (3, 1, "F", 1.0, DAY, "5-L"), (4, 9, "F", 1.0, DAY, "5-L"), (5, 1, "P", 1.0, None, "5-L"), (None, 1, "F", 1.0, DAY, "5-L")]),
        "lineitem": (line, [ln(1, 1, 2), ln(1, 2, 1), ln(1, 1, 1), ln(2, 1, 1, 3.0), ln(4, 1, 1), ln(5, 1, 1), ln(None, 1, 1), ln(1, None, 3), ln(1, 7, 4)]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{base}/{name}.parquet")
    return base


def test_feed_pages_by_hand(spark, tables):
    pages = {(r["dia"], r["pg"]): json.loads(r["value"]) for r in tv.order_pages_text(spark, tables, page_size=4).collect()}
    assert sorted(pages, key=str) == [("1998-03-02", 0), ("1998-03-02", 1), (None, 0)]
    day = [o for pg in (0, 1) for o in pages["1998-03-02", pg]["orders"]]
    assert pages["1998-03-02", 0]["total"] == 5 and [o.get("id") for o in day] == [None, "1", "2", "2", "3"]
    items = lambda o: [(i["item"]["seller_custom_field"], i["item"]["title"], i["unit_price"], i["quantity"]) for i in o["order_items"]]
    # Equal lines come by price, then title; a product that is there twice gives two items.
    assert items(day[1]) == [("2", "a", "1.00", 1), ("2", "c", "1.00", 1), ("1", "b", "2.00", 1), ("1", "b", "2.00", 1)]
    assert items(day[2]) == items(day[3]) == [("1", "b", "2.00", 3)] and items(day[0]) == items(day[4]) == []
    assert items(pages[None, 0]["orders"][0]) == [("1", "b", "2.00", 1)]


def test_feed_lands_compressed_and_shuffles_lines_without_their_order_columns(spark, tables, tmp_path):
    tv.land_feed(spark, tables, str(tmp_path / "feed"))
    found = glob.glob(f"{tmp_path}/feed/dia=1998-03-02/part-*")
    assert len(found) == 1 and found[0].endswith(".gz")
    plan = tv.order_pages_text(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    collected = next(x for x in plan.splitlines() if "collect_list(e#" in x)
    assert "l_extendedprice" not in collected and "array_sort" in plan


def test_stores_join_orders_before_lines_do(spark, tables):
    for df in (tv.sales_lines(spark, tables), tv.settlement_rows(spark, tables)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [x for x in plan if "Join Inner" in x]
        by_store, by_order = (next(x for x in joins if c in x) for c in ("c_custkey", "l_orderkey"))
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        assert depth(by_store) > depth(by_order)
    assert tv.sales_lines(spark, tables).count() == 7


def test_keep_last_by_columns_carries_them_once_and_keeps_null_orders(spark):
    df = spark.createDataFrame([("a", 0, None, "x"), ("a", 1, 5, "y"), ("a", 1, None, "z"), ("b", None, None, "w"), ("c", 2, 1, None)], "k string, r int, n int, v string")
    now = dedup.keep_last(df, ["k"], ["r", "n"])
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, dedup.keep_last(df, ["k"], F.struct("r", "n")).collect())) == [("a", 1, 5, "y"), ("b", None, None, "w"), ("c", 2, 1, None)]
    assert now.columns == df.columns
    assert now._jdf.queryExecution().optimizedPlan().toString().count("r#") < dedup.keep_last(df, ["k"], F.struct("r", "n"))._jdf.queryExecution().optimizedPlan().toString().count("r#")


def test_range_slices_are_written_as_columns_not_checkpointed(spark):
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", F.lit(1).alias("v"))
    got = cumulative.running_sum(df, ["g"], [F.col("id")], "v", "s", strategy="range", slices=5)
    assert got.where(F.col("s") != F.floor(F.col("id") / 3) + 1).count() == 0 and got.count() == 1000
    assert {x for x in os.listdir(folder) if x.startswith("rdd-")} == {x for x in before if x.startswith("rdd-")}


def test_few_repeated_keys_leave_stored_lines_unshuffled(spark, tmp_path):
    df = spark.range(500).select((F.col("id") % 499).cast("string").alias("k"), F.col("id").alias("o"))
    df.write.parquet(f"{tmp_path}/t")
    got = dedup.keep_last_of_stored(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["o"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert got.count() == 499 and got.where("k = '0'").first()["o"] == 499


def test_sheets_land_compressed_by_month_and_headers_are_read_from_them(spark, tmp_path):
    text = spark.range(4000).repartition(6).select(F.col("id").cast("string").alias("numero_pedido"), F.lit("u\nv").alias("titulo"), F.concat(F.lit("2025-0"), F.col("id") % 4 + 1).alias("mes"))
    base = f"{tmp_path}/s"
    files.write_month_sheets(text.hint("rebalance", "mes"), base)
    found = glob.glob(f"{base}/mes=*/*.csv.gz")
    assert len(found) == 4 and files.csv_headers(spark, base, F.col("mes") != "2025-04").count() == 3
    closed, current = files.read_month_sheets(spark, base, dt.date(2025, 4, 9))
    assert closed.count() == 3000 and current.where("titulo = 'u\\nv'").count() == 1000
    long = ",".join(f"c{i}" for i in range(30_000)) + "\n1,2\n"
    os.makedirs(f"{tmp_path}/l")
    for name, opened in (("a.csv", open), ("b.csv.gz", gzip.open), ("c.csv", open)):
        with opened(f"{tmp_path}/l/{name}", "wt") as out:
            out.write("a,b" if name == "c.csv" else long)
    assert sorted(len(r["names"]) for r in files.csv_headers(spark, f"{tmp_path}/l").collect()) == [2, 30_000, 30_000]


def test_markdown_is_written_compressed_unless_asked_plain(spark, tmp_path):
    df = spark.createDataFrame([("2", "b"), ("1", "a|")], "numero_pedido string, sku string")
    for compression, end in (("gzip", ".gz"), ("none", ".txt")):
        path = f"{tmp_path}/{compression}"
        writers.write_markdown(df, path, compression)
        assert all(x.endswith(end) for x in glob.glob(f"{path}/*/part-*"))
        assert sorted(map(tuple, files.read_markdown_table(spark, path).collect())) == [("1", "a-"), ("2", "b")]


def test_curves_shuffle_store_rows_once_and_both_windows_once(spark):
    sales = spark.createDataFrame([("X - 1", "a", "t", 3, 9.0, DAY), ("X - 1", "b", "t", 1, 1.0, DAY), ("X - 2", "a", "t", 2, -4.0, DAY), ("X - 2", "c", None, 0, 0.0, DAY)],
                                  "loja string, sku string, titulo string, quantidade long, valor_total_produto double, data_do_pedido timestamp").withColumn("valor_total_produto", F.col("valor_total_produto").cast("decimal(18,3)"))
    stores = pareto.monthly_store_totals(sales)
    totals, sums = pareto.group_totals(stores), pareto.group_sums(stores)
    direct = totals.groupBy("grupo", "mes_data").agg(F.sum("quantidade_total_vendida"), F.sum("valor_total_gmv"))
    assert sorted(map(str, map(tuple, sums.collect()))) == sorted(map(str, map(tuple, direct.collect()))) != []
    curves = pareto.pareto_abc(sales)
    assert sorted(map(str, curves.collect())) == sorted(map(str, pareto.pareto_abc(sales, strategy="window").collect()))
    dealt = [x for x in pareto.pareto_abc(sales)._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in x]
    assert sum("_spread" in x for x in dealt) == 1 and not any("hashpartitioning(grupo" in x and "sku" in x for x in dealt)


def test_share_of_thousandths_beyond_long_bounds(spark):
    rows = [(v, t) for v in (0, 1, -1, 12345, -12345, 20_000_000_000_000, 10**17, -10**17) for t in (7, -7, 10**6, 4 * 10**18, -(9 * 10**18), 0) if abs(v) < 10**13 * abs(t) or not t]
    got = spark.createDataFrame(rows, "v long, t long").select("v", "t", share_milli(F.col("v"), F.col("t")).alias("s")).collect()
    for v, t, s in got:
        q = (abs(v) * 200_000 + abs(t)) // (2 * abs(t)) if t else 0
        assert s == (-q if (v < 0) != (t < 0) else q), (v, t)


def test_catalogue_rows_are_not_sorted_by_product(spark, tables):
    """Lines stream past a hash table of their products; a sort of all lines by product spilled."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tv.catalog_rows(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("ShuffledHashJoin") == 1 and plan.count("SortMergeJoin") == 1  # the suppliers' join has no hint
