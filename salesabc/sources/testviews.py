"""Domain views over the synthetic TPC-H-like test tables.

The test tables are not sales sheets, so these views give them the shape
of the real inputs (see FIXTURES.md section 3).  Every view is a lazy
DataFrame over the parquet files; nothing is materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc.config import MONEY
from salesabc.session import shuffles_freed

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Columns that order the lines of one (order, part) pair, used wherever the
# source semantics say "first"/"last" in file order.
LINE_ORDER = ("l_shipdate", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_order(prefix: str = "") -> Column:
    """The total ingest order of lines as one struct (compared field by field)."""
    return F.struct(*[F.col(prefix + c).alias(c) for c in ("l_orderkey",) + LINE_ORDER])


def _status_raw(c: Column) -> Column:
    return (F.when(c == "F", "delivered").when(c == "O", "sent")
            .when(c == "P", "custom_p").otherwise(c))


def _logistic_raw(priority: Column) -> Column:
    d = F.substring(priority, 1, 1)
    return (F.when(d == "1", "fulfillment").when(d == "2", "self_service")
            .when(d == "3", "xd_drop_off").when(d == "4", "drop_off").otherwise("other"))


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> store name '<region> - <nation>' and marketplace segment."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey", "c_mktsegment", "r_name",
                     F.concat_ws(" - ", "r_name", "n_name").alias("loja")))


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed sales line per lineitem, shaped like a cleaned sheet row
    before business rules (raw status and logistic type)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_type", "p_brand")
    st = store_dim(spark, sf_dir)
    # Stores join the orders first, so that lines are shuffled once less.
    placed = o.join(st, o.o_custkey == st.c_custkey)
    j = li.join(placed, li.l_orderkey == placed.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("numero_pedido"),
        F.concat(F.lit("ERP-"), F.col("l_orderkey").cast("string")).alias("numero_pedido_erp"),
        F.col("o_custkey").cast("string").alias("numero_carrinho"),
        F.to_date("o_orderdate").alias("data_do_pedido"),
        F.col("loja"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_extendedprice").cast(MONEY).alias("valor_total_produto"),
        F.col("p_retailprice").cast(MONEY).alias("valor_unitario_venda"),
        F.col("l_quantity").cast("long").alias("quantidade"),
        F.col("p_name").alias("titulo"),
        F.col("c_mktsegment").alias("id_canal_marketplace"),
        F.concat(F.lit("BR"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("rastreio"),
        _status_raw(F.col("o_orderstatus")).alias("status"),
        _logistic_raw(F.col("o_orderpriority")).alias("tipo_logistica"),
        F.col("r_name").alias("regiao"),
        F.col("l_returnflag"), F.col("l_tax"), F.col("l_discount"), F.col("o_totalprice"),
        F.col("l_suppkey"),
        line_order().alias("ingest_order"),
    )


SALES_COLUMNS = ["numero_pedido", "numero_pedido_erp", "numero_carrinho", "data_do_pedido",
                 "loja", "sku", "valor_total_produto", "valor_unitario_venda", "quantidade",
                 "titulo", "id_canal_marketplace", "rastreio", "status", "tipo_logistica"]


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue CSV rows (all text, comma decimals): one stock receipt per lineitem."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # The product joins last: rows then lie by product, as the catalogue's aggregate wants them.
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_partkey").cast("string").alias("Código"),
        F.col("p_name").alias("Produto"),
        F.lit("UN").alias("UN"),
        F.col("l_quantity").cast("long").cast("string").alias("Quantidade"),
        F.replace(F.col("l_extendedprice").cast(T.DecimalType(18, 2)).cast("string"),
                  F.lit("."), F.lit(",")).alias("Valor unitario"),
        F.col("s_name").alias("Fornecedores"),
        F.col("p_type").alias("Categoria"),
        F.col("p_brand").alias("Subcategoria"),
        F.when(F.col("l_linestatus") == "F", F.lit("Atacado")).alias("Tipo de Venda"),
        line_order().alias("ingest_order"),
    )


def settlement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlement report rows for the settling marketplace (region ASIA).

    One report file per return flag (A, N, R in that order)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    st = store_dim(spark, sf_dir).filter(F.col("r_name") == "ASIA").select("c_custkey")
    placed = o.join(st, o.o_custkey == st.c_custkey)
    j = li.join(placed, li.l_orderkey == placed.o_orderkey)
    return j.select(
        F.col("l_returnflag").alias("arquivo"),
        F.col("l_orderkey").cast("string").alias("id_pedido"),
        (F.col("l_tax").cast(T.DecimalType(18, 3)) * 1000).cast(T.DecimalType(18, 3)).alias("moedas"),
        F.col("l_discount").cast(T.DecimalType(18, 3)).alias("cupom"),
        F.round(F.col("l_extendedprice").cast(T.DecimalType(18, 3)) * F.lit(0.1).cast(T.DecimalType(2, 1)), 3)
         .cast(T.DecimalType(18, 3)).alias("taxa_comissao"),
        F.col("l_tax").cast(T.DecimalType(18, 3)).alias("taxa_servico"),
        F.col("o_totalprice").cast(T.DecimalType(18, 3)).alias("preco_acordado"),
        line_order().alias("ingest_order"),
    )


def _feed_time(o: str = "o_orderkey", c: str = "o_custkey") -> Column:
    """A wall-clock time per order, so the feed carries real times."""
    return F.format_string("%02d:%02d:%02d", F.col(o) % 24, F.col(c) % 60, F.floor(F.col(o) / 24) % 60)


def order_pages_text(spark: SparkSession, sf_dir: str, page_size: int = 50) -> DataFrame:
    """The order feed as JSON pages (dia, page of the day, ``value``).

    Orders carry their items in line order; orders without lines keep an
    empty item list.  Pages hold up to ``page_size`` consecutive orders of a
    day and, as the real ones, only the announced total and the orders.

    Lines get their rank in the order first, on the line's own columns; from
    then on only the rank travels, with the day of the order.  Titles and
    prices join these narrow rows, and orders and items meet once, by day.
    """
    li = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull())
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    o = table(spark, sf_dir, "orders")
    st = store_dim(spark, sf_dir)
    day_of = F.date_format("o_orderdate", "yyyy-MM-dd")
    # Equal lines share a rank, so their items decide as they would beside the whole line.
    ranked = li.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("quantity"),
                       F.rank().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)).alias("pos"))
    days = o.groupBy("o_orderkey").agg(F.collect_set(F.struct(day_of.alias("dia"))).alias("days"))
    item = F.struct(
        F.col("p_retailprice").cast(T.DecimalType(18, 2)).cast("string").alias("unit_price"),
        "quantity",
        F.struct(F.col("l_partkey").cast("string").alias("seller_custom_field"),
                 F.col("p_name").alias("title")).alias("item"))
    items = (ranked.join(days, ranked.l_orderkey == days.o_orderkey)
             .select("l_orderkey", "l_partkey", "quantity", "pos", F.explode("days").alias("d"))
             .join(p, F.col("l_partkey") == p.p_partkey)
             .select(F.col("d.dia").alias("dia"), F.col("l_orderkey").alias("k"), F.lit(None).alias("o"), F.struct("pos", item.alias("it")).alias("e")))
    order = F.struct("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "loja", "c_mktsegment")
    placed = o.join(st, o.o_custkey == st.c_custkey).select(day_of.alias("dia"), F.col("o_orderkey").alias("k"), order.alias("o"), F.lit(None).alias("e"))
    whole = (placed.unionByName(items).repartition("dia").groupBy("dia", "k")
             .agg(F.collect_list("o").alias("os"), F.transform(F.array_sort(F.collect_list("e")), lambda x: x["it"]).alias("items"))
             .select("dia", "k", "items", F.explode("os").alias("o")))
    orders = whole.select("dia", "k", F.struct(
        F.col("k").cast("string").alias("id"),
        F.concat(F.date_format("o.o_orderdate", "yyyy-MM-dd"), F.lit("T"), _feed_time("k", "o.o_custkey"),
                 F.lit(".000-03:00")).alias("dateCreated"),
        F.col("o.loja").alias("channelName"),
        F.col("o.c_mktsegment").alias("channel"),
        _status_raw(F.col("o.o_orderstatus")).alias("status"),
        F.concat(F.lit("ERP-"), F.col("k").cast("string")).alias("erpId"),
        F.col("o.o_custkey").cast("string").alias("packId"),
        F.struct(F.concat(F.lit("BR"), F.col("k").cast("string")).alias("shipping_number"),
                 _logistic_raw(F.col("o.o_orderpriority")).alias("logistic_type")).alias("shipping"),
        F.col("items").alias("order_items")).alias("o"))
    # A day's orders are few; their place in the day gives the page.
    day = Window.partitionBy("dia")
    placed = orders.select("dia", "k", "o", F.floor((F.row_number().over(day.orderBy("k")) - 1) / page_size).alias("pg"), F.count("*").over(day).alias("total"))
    pages = (placed.groupBy("dia", "total", "pg")
                   .agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "o"))), lambda x: x["o"]).alias("orders")))
    return pages.select("dia", "pg", F.to_json(F.struct("total", "orders")).alias("value"))


def land_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the feed's pages as compressed JSON lines, one folder per day."""
    with shuffles_freed(spark):
        (order_pages_text(spark, sf_dir).repartition("dia").sortWithinPartitions("dia", "pg")
            .select("dia", "value").write.mode("overwrite").option("compression", "gzip").partitionBy("dia").text(path))


def product_pages_text(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Product pages as landed JSON (one page per row, column ``value``)."""
    p = table(spark, sf_dir, "part")
    prod = F.struct(F.col("p_partkey").cast("string").alias("codigo"), F.col("p_name").alias("nome"),
                    F.col("p_retailprice").alias("precoCusto"),
                    F.struct(F.col("p_size").cast("long").alias("saldoVirtualTotal")).alias("estoque"))
    pages = (p.select(F.floor(F.col("p_partkey") / page_size).cast("long").alias("pagina"),
                      F.struct(F.col("p_partkey").alias("k"), prod.alias("d")).alias("e"))
              .groupBy("pagina")
              .agg(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["d"]).alias("data")))
    return pages.select(F.to_json(F.struct("pagina", "data")).alias("value"))


def enrichment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment sheet rows (sku, supplier, category...), one per lineitem in file order."""
    rows = catalog_rows(spark, sf_dir)
    return rows.select(F.col("Código").alias("sku"), "Fornecedores", "Categoria", "Subcategoria",
                       F.col("Tipo de Venda").alias("tipo_de_venda"), "ingest_order")
