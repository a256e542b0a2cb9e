"""Order feed: landed JSON pages -> one row per order item.

The feed is read from landed pages (one JSON document per line, one page
per document, one folder per day) instead of a paged HTTP loop; every page is
parsed in parallel and items are flattened with ``posexplode_outer``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc import config
from salesabc.config import MONEY
from salesabc.functions.dates import iso_wall_date, iso_wall_time
from salesabc.functions.numeric import parse_decimal, zero
from salesabc.sources.catalog_sources import file_order

ITEM = T.StructType([
    T.StructField("unit_price", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("item", T.StructType([
        T.StructField("seller_custom_field", T.StringType()),
        T.StructField("title", T.StringType()),
    ])),
])
ORDER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dateCreated", T.StringType()),
    T.StructField("channelName", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("erpId", T.StringType()),
    T.StructField("packId", T.StringType()),
    T.StructField("shipping", T.StructType([
        T.StructField("shipping_number", T.StringType()),
        T.StructField("logistic_type", T.StringType()),
    ])),
    T.StructField("order_items", T.ArrayType(ITEM)),
])
PAGE = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("orders", T.ArrayType(ORDER)),
])


DAY_DIR = "dia"
CORRUPT = "rejeitado"
FILE_ORDER_TYPE = "struct<f:string,b:bigint,r:bigint>"


#: Longest window whose day folders are looked up one by one; a longer one lists the feed.
LOOKED_UP_DAYS = 100


def window_folders(spark: SparkSession, path: str, lo: dt.date, hi: dt.date) -> list[str]:
    """The day folders of an inclusive window that are there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    days = [(lo + dt.timedelta(n)).isoformat() for n in range((hi - lo).days + 1)]
    found = [f"{path.rstrip('/')}/{DAY_DIR}={d}" for d in days]
    return [f for f in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]


def read_pages(spark: SparkSession, path: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """Landed pages, one folder ``dia=yyyy-MM-dd`` per day of order creation.

    Only the folders of the inclusive window are read, and only they are
    listed; a day without a folder has no pages.  Pages carry no number
    of their own: a page is known by its file and its place in it, and that
    order decides which of two lines is the later one.  A page that is no
    whole JSON document has its text in ``rejeitado`` and no orders.
    """
    schema = T.StructType([*PAGE.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(DAY_DIR, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("basePath", path)
    if lo is not None and hi is not None and (hi - lo).days < LOOKED_UP_DAYS:
        folders = window_folders(spark, path, lo, hi)
        if not folders:
            return spark.createDataFrame([], f"{DAY_DIR} string, total long, orders {PAGE['orders'].dataType.simpleString()}, {CORRUPT} string, page {FILE_ORDER_TYPE}")
        pages = reader.json(folders)
    else:
        pages = reader.json(path)
    day = F.col(DAY_DIR)
    if lo is not None:
        pages = pages.where(day >= lo.isoformat())
    if hi is not None:
        pages = pages.where(day <= hi.isoformat())
    return pages.select(DAY_DIR, "total", "orders", CORRUPT, file_order().alias("page"))


def parse_pages(text: DataFrame, col: str = "value") -> DataFrame:
    """Pages held as JSON text in a column -> the page struct columns."""
    return text.select(F.from_json(F.col(col), PAGE).alias("p")).select("p.*")


def orders_of(pages: DataFrame) -> DataFrame:
    """One row per order with its page and position in the page."""
    return pages.select("page", F.posexplode("orders").alias("order_pos", "o"))


def flatten_orders(orders: DataFrame) -> DataFrame:
    """Orders -> one sales row per item; an order without items gives one
    row with sku/title 'N/A', quantity 0 and price 0 (N7)."""
    items = orders.select("page", "order_pos", "o",
                          F.posexplode_outer("o.order_items").alias("item_pos", "it"))
    created = F.col("o.dateCreated")
    return items.select(
        iso_wall_date(created).alias("data_do_pedido"),
        F.coalesce(iso_wall_time(created), F.lit("")).alias("hora_do_pedido"),
        F.col("o.channelName").alias("loja"),
        F.coalesce(F.col("it.item.seller_custom_field"), F.lit(config.MISSING_ITEM_MARK)).alias("sku"),
        F.col("o.status").alias("status"),
        parse_decimal(F.col("it.unit_price"), 2).cast(MONEY).alias("valor_unitario_venda"),
        F.coalesce(F.col("it.quantity"), F.lit(0)).cast("long").alias("quantidade"),
        F.col("o.id").alias("numero_pedido"),
        F.coalesce(F.col("o.erpId"), F.lit("")).alias("numero_pedido_erp"),
        F.coalesce(F.col("o.packId"), F.lit("")).alias("numero_carrinho"),
        F.coalesce(F.col("it.item.title"), F.lit(config.MISSING_ITEM_MARK)).alias("titulo"),
        F.coalesce(F.col("o.channel"), F.lit("")).alias("id_canal_marketplace"),
        F.coalesce(F.col("o.shipping.shipping_number"), F.lit("")).alias("rastreio"),
        F.coalesce(F.col("o.shipping.logistic_type"), F.lit("")).alias("tipo_logistica"),
        zero(3).alias("valor_total_produto"),
        zero(3).alias("cashback_cupom"), zero(3).alias("Comissão"), zero(3).alias("custo_unitario"),
        F.lit(0).cast("long").alias("Estq"),
        F.lit(None).cast("string").alias("Fornecedores"),
        F.lit(None).cast("string").alias("Categoria"),
        F.lit(None).cast("string").alias("Subcategoria"),
        F.struct("page", "order_pos", "item_pos").alias("feed_order"),
    )


def feed_rows(pages: DataFrame, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """Flattened feed rows for the inclusive day window [lo, hi].

    Orders outside the window are dropped inside each page (array filter)
    before any explode, so only the window's items are materialised.
    """
    if lo is not None or hi is not None:
        def in_window(o):
            d = iso_wall_date(o["dateCreated"])
            cond = F.lit(True)
            if lo is not None:
                cond = cond & (d >= F.lit(lo))
            if hi is not None:
                cond = cond & (d <= F.lit(hi))
            return F.coalesce(cond, F.lit(False))
        pages = pages.withColumn("orders", F.filter("orders", in_window))
    rows = flatten_orders(orders_of(pages))
    if lo is not None:
        rows = rows.filter(F.col("data_do_pedido") >= F.lit(lo))
    if hi is not None:
        rows = rows.filter(F.col("data_do_pedido") <= F.lit(hi))
    return rows


def page_completeness(pages: DataFrame, page_size: int = config.FEED_PAGE_SIZE) -> DataFrame:
    """Landed pages of each day against the order count the feed announced for it.

    A page without readable orders (cut, or no JSON) is not received.
    """
    agg = pages.groupBy(DAY_DIR).agg(F.max("total").alias("total"), F.count("orders").alias("paginas_recebidas"),
                                     F.sum(F.size(F.coalesce(F.col("orders"), F.array()))).alias("pedidos_recebidos"))
    expected = F.ceil(F.col("total") / F.lit(page_size)).cast("long")
    return agg.select(
        DAY_DIR,
        F.col("total").cast("long").alias("total"),
        F.lit(page_size).cast("long").alias("tamanho_pagina"),
        expected.alias("paginas_esperadas"),
        F.col("paginas_recebidas").cast("long").alias("paginas_recebidas"),
        (expected - F.col("paginas_recebidas")).cast("long").alias("paginas_faltantes"),
        F.col("pedidos_recebidos").cast("long").alias("pedidos_recebidos"),
        ((expected == F.col("paginas_recebidas")) & (F.col("total") == F.col("pedidos_recebidos")))
        .alias("completo"),
    )


def feed_rejects(pages: DataFrame) -> DataFrame:
    """What the feed could not give, with its place: (dia, arquivo, bloco, linha, motivo, numero_pedido, sku, texto).

    ``pagina_ilegivel``: the text of a page that is no whole JSON document;
    ``campo_ilegivel``: that of a page with a field of another type, which is
    null while the rest counts; ``quantidade_nula``: an item without a
    quantity, which is sold as 0.
    """
    place = [F.col(DAY_DIR), F.col("page.f").alias("arquivo"), F.col("page.b").alias("bloco"), F.col("page.r").alias("linha")]
    none = F.lit(None).cast("string")
    cut = pages.where(F.col(CORRUPT).isNotNull()).select(*place, F.when(F.col("orders").isNull(), "pagina_ilegivel").otherwise("campo_ilegivel").alias("motivo"), none.alias("numero_pedido"), none.alias("sku"),
                                                         F.col(CORRUPT).alias("texto"))
    items = pages.select(*place, F.explode("orders").alias("o")).select(DAY_DIR, "arquivo", "bloco", "linha", F.col("o.id").alias("numero_pedido"), F.explode("o.order_items").alias("it"))
    void = items.where(F.col("it.quantity").isNull()).select(DAY_DIR, "arquivo", "bloco", "linha", F.lit("quantidade_nula").alias("motivo"), "numero_pedido",
                                                             F.col("it.item.seller_custom_field").alias("sku"), none.alias("texto"))
    return cut.unionByName(void)


def order_sample(pages: DataFrame, as_of: dt.date, n: int = 10) -> DataFrame:
    """The first ``n`` orders of the month up to ``as_of``, with their items.

    ``orderBy(...).limit(n)`` plans as a per-task top-n and a merge of n
    rows per task; the sample size is the feature, not a cost cap.
    """
    orders = orders_of(pages)
    d = iso_wall_date(F.col("o.dateCreated"))
    month_start = as_of.replace(day=1)
    first = (orders.filter(d.between(F.lit(month_start), F.lit(as_of)))
                   .orderBy(F.col("o.dateCreated"), F.col("o.id"))
                   .limit(n))
    rows = flatten_orders(first)
    return rows.select("numero_pedido", "data_do_pedido", "hora_do_pedido", "loja", "status",
                       "numero_pedido_erp", "id_canal_marketplace", "rastreio", "tipo_logistica",
                       "numero_carrinho", "sku", "titulo", "valor_unitario_venda", "quantidade")
