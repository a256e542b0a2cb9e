"""The registered query set: one Spark query per inventory item.

Each query takes (spark, sf_dir), builds its input from the test tables
through ``sources.testviews`` and runs the library operator on it.  The
last step, ``interchange``, only changes the representation for the
cross-engine check: decimals become DOUBLE (exact decimals convert to
the same double in both engines) and dates become ISO text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc import config, session
from salesabc.functions import business, dates, numeric
from salesabc.functions import text as text_fn
from salesabc.operators import catalog, clean, consolidate, pareto, quality, settlement
from salesabc.plans import jobs, sales_run
from salesabc.sinks import published, writers
from salesabc.sources import catalog_sources, files, order_feed
from salesabc.sources import testviews as tv

PROFILE = config.TEST_PROFILE
AS_OF = dt.date(1998, 3, 15)       # an ordinary day with a sheet for the month
AS_OF_DAY1 = dt.date(1998, 3, 1)   # first day of a month

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


def interchange(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            cols.append(c.cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


# --- Pareto -----------------------------------------------------------------

@query
def pareto_abc(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = tv.sales_lines(spark, sf_dir)
    return interchange(pareto.pareto_abc(sales, PROFILE))


@query
def pareto_abc_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same curves with the distributed range-sliced running sums."""
    sales = tv.sales_lines(spark, sf_dir)
    return interchange(pareto.pareto_abc(sales, PROFILE, strategy="range"))


@query
def pareto_table_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = tv.sales_lines(spark, sf_dir)
    return interchange(pareto.pareto_table_rows(pareto.pareto_abc(sales, PROFILE)))


@query
def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(pareto.missing_months(tv.sales_lines(spark, sf_dir), PROFILE))


# --- Shared inputs built from the test tables -------------------------------------

def _sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tv.sales_lines(spark, sf_dir)
    return lines.select(*tv.SALES_COLUMNS, F.col("ingest_order").alias("sheet_order"))


def _catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tv.catalog_rows(spark, sf_dir).withColumnsRenamed(config.CATALOG_CSV_RENAME)


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.aggregate_catalog(_catalog_rows(spark, sf_dir))


def _settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settlement.aggregate_settlement(tv.settlement_rows(spark, sf_dir))


_LANDED: dict[tuple[str, str], str] = {}


def landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the landed feed; it is written once in a session for each input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        path = session.scratch_path(spark, "feed")
        tv.land_feed(spark, sf_dir, path)
        _LANDED[key] = path
    return _LANDED[key]


def _feed_pages(spark: SparkSession, sf_dir: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    return order_feed.read_pages(spark, landed_feed(spark, sf_dir), lo, hi)


def run_inputs(spark: SparkSession, sf_dir: str, as_of: dt.date) -> sales_run.RunInputs:
    rows = _sheet_rows(spark, sf_dir)
    key = as_of.strftime("%Y-%m")
    month = F.date_format("data_do_pedido", "yyyy-MM")
    return sales_run.RunInputs(
        closed_sheets=rows.filter(month != key),
        current_sheet=None if as_of.day == 1 else rows.filter(month == key),
        feed_pages=lambda lo, hi: _feed_pages(spark, sf_dir, lo, hi),
        catalog=_catalog(spark, sf_dir),
        settlement=_settlement(spark, sf_dir),
    )


def _run(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> sales_run.RunStages:
    return sales_run.run_sales(run_inputs(spark, sf_dir, as_of), as_of, PROFILE)


def _stored_run(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF, **how) -> sales_run.RunStages:
    return sales_run.stored_run(run_inputs(spark, sf_dir, as_of), as_of, PROFILE, **how)


def _stored_fact(spark: SparkSession, sf_dir: str, scratch: ExitStack | None = None) -> DataFrame:
    """The fact of a run, stored; its other tables go."""
    with ExitStack() as run:
        return session.written(_stored_run(spark, sf_dir, scratch=run).fact, "fact", scratch)


def _clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sales(tv.sales_lines(spark, sf_dir), PROFILE)


# --- Cleaning rules -------------------------------------------------------------------

@query
def status_store_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tv.sales_lines(spark, sf_dir).select(
        "loja", "status", F.col("loja").alias("loja_original"), F.col("status").alias("status_original"))
    std = raw.select("loja_original", "status_original",
                     business.standard_store(F.col("loja"), PROFILE).alias("loja"),
                     business.standard_status(F.col("status")).alias("status"))
    return std.groupBy("loja_original", "status_original", "loja", "status").agg(
        F.count("*").alias("linhas"))


@query
def logistics_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tv.sales_lines(spark, sf_dir)
    out = lines.select("loja", F.col("tipo_logistica").alias("tipo_logistica_original"),
                       business.logistics_class(business.standard_store(F.col("loja"), PROFILE),
                                                F.col("tipo_logistica"), PROFILE).alias("tipo_logistica"))
    return out.groupBy("loja", "tipo_logistica_original", "tipo_logistica").agg(F.count("*").alias("linhas"))


@query
def line_revenue_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _clean_lines(spark, sf_dir)
    return interchange(c.select("numero_pedido", "sku", "rastreio", "loja", "quantidade",
                                "valor_unitario_venda", "valor_total_produto"))


# --- Catalogue ---------------------------------------------------------------------------

@query
def catalog_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(_catalog(spark, sf_dir))


@query
def catalog_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = catalog_sources.flatten_products(
        catalog_sources.parse_product_pages(tv.product_pages_text(spark, sf_dir)))
    return catalog.enrich_catalog(products, tv.enrichment_rows(spark, sf_dir))


@query
def sales_with_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = catalog.join_catalog(_clean_lines(spark, sf_dir), _catalog(spark, sf_dir))
    return interchange(j.select("numero_pedido", "sku", "rastreio", "quantidade", "titulo", "custo_unitario",
                                "custo_total_produto", "Estq", "Fornecedores", "Categoria", "Subcategoria",
                                "tipo_de_venda"))


# --- Settlement ------------------------------------------------------------------------------

@query
def settlement_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(_settlement(spark, sf_dir))


@query
def sales_with_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = settlement.apply_settlement(_clean_lines(spark, sf_dir), _settlement(spark, sf_dir))
    return interchange(j.select("numero_pedido", "sku", "rastreio", "loja", "quantidade", "valor_total_produto",
                                "cashback_cupom", "Comissão"))


@query
def sales_settlement_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled prices split over the lines of an order."""
    j = settlement.apply_settlement(_clean_lines(spark, sf_dir), _settlement(spark, sf_dir), allocate=True)
    return interchange(j.select("numero_pedido", "sku", "rastreio", "valor_total_produto"))


# --- Consolidation -----------------------------------------------------------------------------

@query
def rolling_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _run(spark, sf_dir, AS_OF)
    return interchange(st.union.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido", "loja",
                                       "quantidade", "rastreio", "source_rank", "origem_dados"))


@query
def rolling_refresh_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _run(spark, sf_dir, AS_OF_DAY1)
    return interchange(st.union.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido", "loja",
                                       "quantidade", "rastreio", "source_rank", "origem_dados"))


@query
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _stored_run(spark, sf_dir, costs=False)
    return interchange(st.deduped.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido",
                                         "rastreio", "source_rank", "origem_dados", "valor_total_produto"))


@query
def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(_stored_run(spark, sf_dir).fact)


@query
def month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _run(spark, sf_dir, AS_OF)
    m = consolidate.month_filter(st.enriched, AS_OF.year, AS_OF.month).drop("origem_dados")
    return interchange(m.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido", "rastreio",
                                "quantidade", "custo_unitario", "custo_total_produto", "source_rank"))


@query
def pareto_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(pareto.pareto_abc(_stored_fact(spark, sf_dir), PROFILE))


@query
def store_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tv.sales_lines(spark, sf_dir)
    g = lines.select(F.explode(business.group_labels(F.col("loja"), PROFILE)).alias("grupo"),
                     "quantidade", "valor_total_produto")
    return interchange(g.groupBy("grupo").agg(
        F.count("*").alias("linhas"), F.sum("quantidade").alias("quantidade"),
        F.sum("valor_total_produto").cast(config.MONEY).alias("valor_total_produto")))


# --- Sources ------------------------------------------------------------------------------------

@query
def order_items_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_feed.feed_rows(_feed_pages(spark, sf_dir))
    return interchange(rows.select("numero_pedido", "data_do_pedido", "hora_do_pedido", "loja", "sku", "status",
                                   "valor_unitario_venda", "quantidade", "numero_pedido_erp", "numero_carrinho",
                                   "titulo", "id_canal_marketplace", "rastreio", "tipo_logistica"))


@query
def product_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_sources.flatten_products(catalog_sources.parse_product_pages(tv.product_pages_text(spark, sf_dir)))


@query
def order_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interchange(order_feed.order_sample(_feed_pages(spark, sf_dir), AS_OF, 10))


@query
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_feed.page_completeness(_feed_pages(spark, sf_dir), config.FEED_PAGE_SIZE)


@query
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with cut pages and void quantities: what was refused by day, and what was received all the same (Q4, Q5)."""
    path = _scratch(spark, "feed-rejects")
    day, first = F.substring("dia", 9, 2).cast("int"), F.col("pg") == 0
    pages = tv.order_pages_text(spark, sf_dir)
    damaged = (F.when(first & (day % 7 == 0), F.expr("substring(value, 1, length(value) div 2)"))
                .when(first & (day % 5 == 0), F.regexp_replace("value", r'"quantity":\d+', '"quantity":null')).otherwise(F.col("value")))
    (pages.withColumn("value", damaged).repartition("dia").sortWithinPartitions("dia", "pg").select("dia", "value")
        .write.mode("overwrite").option("compression", "gzip").partitionBy("dia").text(path))
    found = order_feed.read_pages(spark, path)
    refused = order_feed.feed_rejects(found).groupBy("dia").agg(F.count_if(F.col("motivo") == "pagina_ilegivel").alias("paginas_ilegiveis"),
                                                                F.count_if(F.col("motivo") == "quantidade_nula").alias("quantidades_nulas"))
    return (order_feed.page_completeness(found).select("dia", "paginas_recebidas").join(refused, "dia", "left")
            .fillna(0, ["paginas_ilegiveis", "quantidades_nulas"]))


# --- Scalar functions ------------------------------------------------------------------------------

@query
def safe_decimal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tv.table(spark, sf_dir, "lineitem")
    dec2 = T.DecimalType(18, 2)
    texts = li.select(
        F.col("l_orderkey").cast("string").alias("numero_pedido"),
        F.col("l_linenumber").cast("long").alias("linha"),
        F.replace(F.col("l_extendedprice").cast(dec2).cast("string"), F.lit("."), F.lit(",")).alias("t_virgula"),
        (F.col("l_extendedprice").cast(dec2) * 10000).cast(T.DecimalType(20, 2)).cast("string").alias("t_grande"),
        F.col("l_returnflag").alias("t_lixo"),
        F.when(F.col("l_linenumber") != 1, F.col("l_discount").cast(dec2).cast("string")).alias("t_nulo"),
        F.col("l_quantity").cast("string").alias("t_qtd"))
    out = texts.select(
        "numero_pedido", "linha",
        numeric.parse_decimal(F.col("t_virgula"), 3).alias("v_virgula"),
        numeric.parse_decimal(F.col("t_grande"), 3).alias("v_grande"),
        numeric.parse_decimal(F.col("t_lixo"), 3).alias("v_lixo"),
        numeric.parse_decimal(F.col("t_nulo"), 2).alias("v_nulo"),
        numeric.parse_long(F.col("t_qtd")).alias("v_qtd"))
    return interchange(out)


@query
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tv.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    digit, key = F.substring("o_orderpriority", 1, 1), F.col("o_orderkey") % 4
    text = (F.when(digit == "1", F.date_format(d, "dd/MM/yyyy HH:mm:ss"))
             .when(digit == "2", F.date_format(d, "dd/MM/yyyy"))
             .when(digit == "3", F.date_format(d, "yyyy-MM-dd"))
             .when(digit == "4", F.when(key == 0, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:05:00")))
                                  .when(key == 1, F.date_format(d, "d/M/yyyy' 9:30'"))
                                  .when(key == 2, F.concat(F.lit("\xa0"), F.date_format(d, "yyyy-MM-dd"), F.lit(" 23:59:59.123\u2003")))
                                  .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T23:30:00.000-03:00"))))
             .otherwise(F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))))
    t = o.select(F.col("o_orderkey").cast("string").alias("numero_pedido"), text.alias("texto"))
    p = t.withColumn("data", dates.parse_sheet_date(F.col("texto")))
    out = p.select("numero_pedido", "texto", "data",
                   F.date_sub("data", 1).alias("dia_anterior"),
                   F.trunc("data", "MM").alias("inicio_mes"),
                   F.last_day("data").alias("fim_mes"),
                   F.month("data").cast("long").alias("mes"),
                   F.year("data").cast("long").alias("ano"),
                   dates.month_label(F.col("data")).alias("mes_referencia"))
    return interchange(out)


@query
def markdown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 cleaning on whole document texts, and the Markdown row of each document."""
    docs = tv.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return docs.select("doc_id", text_fn.markdown_cell(F.col("text")).alias("texto_limpo"),
                       writers.markdown_row(docs).alias("linha"))


# --- File round trips and sinks ------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    return session.scratch_path(spark, name)


@query
def sheet_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sheets landed as CSV (dates as dd/MM/yyyy HH:mm:ss, comma decimals),
    read back, closed months selected by folder, cleaned (S1, S2)."""
    lines = tv.sales_lines(spark, sf_dir)
    text = lines.select(
        *[F.col(c) for c in ["numero_pedido", "numero_pedido_erp", "numero_carrinho", "loja", "sku", "titulo",
                             "id_canal_marketplace", "rastreio", "status", "tipo_logistica"]],
        F.date_format("data_do_pedido", "dd/MM/yyyy HH:mm:ss").alias("data_do_pedido"),
        F.replace(F.col("valor_total_produto").cast("string"), F.lit("."), F.lit(",")).alias("valor_total_produto"),
        F.replace(F.col("valor_unitario_venda").cast("string"), F.lit("."), F.lit(",")).alias("valor_unitario_venda"),
        F.col("quantidade").cast("string").alias("quantidade"),
        F.date_format("data_do_pedido", "yyyy-MM").alias("mes"))
    base = _scratch(spark, "sheets")
    files.write_month_sheets(text.hint("rebalance", "mes"), base)
    closed, _ = files.read_month_sheets(spark, base, AS_OF)
    out = clean.clean_sales(closed, PROFILE)
    return interchange(out.select("numero_pedido", "sku", "data_do_pedido", "loja", "valor_total_produto",
                                  "valor_unitario_venda", "quantidade", "titulo", "status", "tipo_logistica",
                                  "mes", "origem_dados"))


def _uneven_sheets(spark: SparkSession, sf_dir: str) -> str:
    """Month sheets in three layouts by month: as fixed; reversed, with a line break in each
    title; and without the order's ERP number, with a column of its own."""
    lines = tv.sales_lines(spark, sf_dir)
    money = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    turn = F.month("data_do_pedido") % 3
    text = lines.select(
        "numero_pedido", "numero_pedido_erp", "numero_carrinho", "loja", "sku", "id_canal_marketplace", "rastreio", "status", "tipo_logistica",
        F.when(turn == 1, F.concat(F.col("titulo"), F.lit('\nlinha "2", fim'))).otherwise(F.col("titulo")).alias("titulo"),
        F.date_format("data_do_pedido", "d/M/yyyy H:mm").alias("data_do_pedido"),
        money("valor_total_produto").alias("valor_total_produto"), money("valor_unitario_venda").alias("valor_unitario_venda"),
        F.col("quantidade").cast("string").alias("quantidade"), F.date_format("data_do_pedido", "yyyy-MM").alias("mes"), turn.alias("turn"))
    base = _scratch(spark, "uneven-sheets")
    header = {v: k for k, v in config.SHEET_HEADERS.items()}
    named = [c for c in files.SHEET_COLUMNS if c in text.columns]
    layouts = [named, named[::-1], [c for c in named if c != "numero_pedido_erp"]]
    for k, cols in enumerate(layouts):
        own = text.where(F.col("turn") == k).select(*[F.col(c).alias(header[c]) for c in cols], *([F.lit("x").alias("Observação")] if k == 2 else []), "mes")
        # A month's rows meet before the write, so it gets a few files and not one from every task.
        own.hint("rebalance", "mes").write.mode("append").option("header", True).option("escape", '"').option("compression", "gzip").partitionBy("mes").csv(base)
    return base


@query
def sheet_union_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets whose headers differ in order and number, united by name."""
    closed, _ = files.read_month_sheets(spark, _uneven_sheets(spark, sf_dir), AS_OF)
    out = clean.clean_sales(closed, PROFILE)
    return interchange(out.select("numero_pedido", "numero_pedido_erp", "sku", "data_do_pedido", "loja", "valor_total_produto",
                                  "valor_unitario_venda", "quantidade", "titulo", "status", "tipo_logistica", "mes", "rastreio"))


@query
def sheet_missing_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with a file that lacks an expected header (Q1)."""
    gaps = files.missing_sheet_headers(spark, _uneven_sheets(spark, sf_dir))
    return gaps.select(F.regexp_extract("file", "mes=([^/]*)", 1).alias("mes"), "coluna").distinct()


@query
def settlement_files_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report members whose columns differ by archive (S9): one reversed, one without the coupon."""
    base = _scratch(spark, "uneven-settlement")
    rows = tv.settlement_rows(spark, sf_dir)
    header = {v: k for k, v in config.SETTLEMENT_HEADERS.items()}
    layouts = {"A": list(header), "N": list(header)[::-1], "R": [c for c in header if c != "cupom"]}
    for name, cols in layouts.items():
        own = rows.where(F.col("arquivo") == name).select("arquivo", *[F.col(c).cast("string").alias(header[c]) for c in cols])
        (own.repartition("arquivo", header["id_pedido"]).sortWithinPartitions(header["id_pedido"])
            .write.mode("append").option("header", True).partitionBy("arquivo").csv(base))
    return interchange(settlement.aggregate_settlement(files.read_settlement_reports(spark, base)))


@query
def catalog_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sheet (',' CSV) -> S7 -> catalogue CSV (';', K1) -> S6 -> A1.

    Each write sorts by the ingest order so file order carries row order."""
    rows = tv.catalog_rows(spark, sf_dir)
    sheet = rows.orderBy("ingest_order").select(
        F.col("Código").alias("Codigo"), "Produto", "Quantidade", "Valor unitario", "Fornecedores",
        "Categoria", "Subcategoria", "Tipo de Venda")
    sheet_path, csv_path = _scratch(spark, "catalog-sheet"), _scratch(spark, "catalog-csv")
    with session.shuffles_freed(spark):
        sheet.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(sheet_path)
    published = catalog_sources.read_catalog_sheet(spark, sheet_path)
    writers.write_catalog_csv(published.orderBy("ingest_order"), csv_path)
    return interchange(catalog_sources.load_catalog(spark, csv_path))


@query
def settlement_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report members landed per archive plus system-folder junk and a
    non-report file; only real members are read (S9, P13)."""
    base = _scratch(spark, "settlement")
    rows = tv.settlement_rows(spark, sf_dir)
    files.write_settlement_reports(rows, base)
    # Junk that must be ignored: every row again with another price, in a system folder.
    junk = rows.withColumn("preco_acordado", F.lit(1).cast(config.MONEY))
    files.write_settlement_reports(junk, base + "/__MACOSX")
    junk.select(F.col("id_pedido").alias("value")).write.mode("overwrite").text(base + "/notas")
    reports = files.read_settlement_reports(spark, base)
    return interchange(settlement.aggregate_settlement(reports))


@query
def markdown_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact -> Markdown table (K7) -> read back (S10, P7) -> typed fact."""
    path = _scratch(spark, "markdown")
    with ExitStack() as scratch:
        writers.write_markdown(_stored_fact(spark, sf_dir, scratch), path)
    return interchange(consolidate.fact_from_text(files.read_markdown_table(spark, path)))


@query
def fact_full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full replace leaves exactly the new fact, whatever was there (K2)."""
    path = _scratch(spark, "fact")
    with ExitStack() as scratch:
        fact = _stored_fact(spark, sf_dir, scratch)  # one run for both writes
        writers.write_fact_full(consolidate.month_filter(fact, 1998, 2), path)
        writers.write_fact_full(fact, path)
    return interchange(writers.read_table(spark, path))


@query
def fact_publish_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that dies while it writes leaves the fact as published before (K2)."""
    path = _scratch(spark, "fact-published")
    with ExitStack() as scratch:
        writers.write_fact_full(_stored_run(spark, sf_dir, scratch=scratch).fact, path)
    stored = writers.read_table(spark, path)
    dying = stored.withColumn("sku", F.when(F.col("quantidade") > 45, F.raise_error(F.lit("job lost"))).otherwise(F.lit("another")))
    try:
        writers.write_fact_full(dying, path)
    except PySparkException:
        pass
    else:
        raise AssertionError("the second job was to fail")
    return interchange(writers.read_table(spark, path))


@query
def month_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace one month of a month-partitioned fact with a re-run (K3, K5):
    other months stay as first written."""
    path = _scratch(spark, "fact-months")
    with ExitStack() as scratch:
        writers.write_fact_months(_stored_fact(spark, sf_dir, scratch), path)
    with ExitStack() as scratch:
        rerun = _stored_run(spark, sf_dir, dt.date(1998, 3, 31), prices=False, scratch=scratch).fact
        writers.write_fact_months(consolidate.month_filter(rerun, 1998, 3), path)
    return interchange(writers.read_table(spark, path).select(*[F.col(f"`{c}`") for c in config.FACT_COLUMNS]))


def _read_curves(spark: SparkSession, path: str) -> DataFrame:
    return writers.read_table(spark, path)


@query
def pareto_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing the curves replaces whatever was there (K4)."""
    path = _scratch(spark, "pareto")
    lines = tv.sales_lines(spark, sf_dir)
    jobs.pareto_job(lines.where(F.col("regiao") == "ASIA").withColumn("loja", F.lit("loja antiga")), path, profile=PROFILE)
    jobs.pareto_job(lines, path, profile=PROFILE)
    return _read_curves(spark, path)


@query
def pareto_months_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the listed months of the curves are replaced."""
    path = _scratch(spark, "pareto-months")
    with ExitStack() as scratch:
        jobs.pareto_job(_stored_fact(spark, sf_dir, scratch), path, profile=PROFILE)
    with ExitStack() as scratch:
        rerun = _stored_run(spark, sf_dir, dt.date(1998, 3, 31), prices=False, scratch=scratch).fact
        jobs.pareto_job(rerun, path, ["1998-03"], PROFILE)
    return _read_curves(spark, path)


@query
def month_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current month's processed rows through the sink (K6)."""
    path = _scratch(spark, "month-export")
    writers.export_month(_run(spark, sf_dir, AS_OF).enriched, path, AS_OF.year, AS_OF.month)
    out = writers.read_table(spark, path)
    assert "origem_dados" not in out.columns
    return interchange(out.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido", "rastreio",
                                  "quantidade", "custo_unitario", "custo_total_produto", "source_rank"))


@query
def pareto_from_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact kept as Markdown, repaired to its types, gives the same curves (entry B)."""
    path, out = _scratch(spark, "markdown-in"), _scratch(spark, "markdown-out")
    with ExitStack() as scratch:
        writers.write_markdown(_stored_fact(spark, sf_dir, scratch), path)
    fact = jobs.markdown_job(spark, path, out, PROFILE)
    return interchange(pareto.pareto_abc(fact, PROFILE))


@query
def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sheet -> catalogue CSV -> catalogue (entry C)."""
    rows = tv.catalog_rows(spark, sf_dir)
    sheet, out = _scratch(spark, "refresh-sheet"), _scratch(spark, "refresh-csv")
    with session.shuffles_freed(spark):
        rows.orderBy("ingest_order").select(F.col("Código").alias("Codigo"), "Produto", "Quantidade", "Valor unitario", "Fornecedores", "Categoria",
                                            "Subcategoria", "Tipo de Venda").write.option("header", True).option("compression", "gzip").csv(sheet)
    jobs.catalog_job(spark, sheet, out)
    return interchange(catalog_sources.load_catalog(spark, out))


def land_inputs(spark: SparkSession, sf_dir: str) -> jobs.Landed:
    """Every input of the sales run as files, rows in ingest order."""
    base = _scratch(spark, "landed")
    lines = tv.sales_lines(spark, sf_dir)
    money = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(",")).alias(c)
    text = lines.select("numero_pedido", "numero_pedido_erp", "numero_carrinho", "loja", "sku", "titulo", "id_canal_marketplace", "rastreio", "status",
                        "tipo_logistica", F.date_format("data_do_pedido", "dd/MM/yyyy HH:mm:ss").alias("data_do_pedido"), money("valor_total_produto"),
                        money("valor_unitario_venda"), F.col("quantidade").cast("string").alias("quantidade"),
                        F.date_format("data_do_pedido", "yyyy-MM").alias("mes"), "ingest_order")
    files.write_month_sheets(text.orderBy("mes", "ingest_order"), f"{base}/sheets")
    names = dict(zip(catalog_sources.SHEET_COLUMNS, config.CATALOG_CSV_COLUMNS))
    cat = tv.catalog_rows(spark, sf_dir).orderBy("ingest_order")
    with session.shuffles_freed(spark):
        cat.select(*[F.col(c) for c in cat.columns if c in names.values()]).write.option("header", True).option("sep", ";").option("compression", "gzip").csv(f"{base}/catalog")
    files.write_settlement_reports(tv.settlement_rows(spark, sf_dir), f"{base}/settlements")
    return jobs.Landed(f"{base}/sheets", landed_feed(spark, sf_dir), f"{base}/catalog", f"{base}/settlements")


@query
def sales_job_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole sales job from landed files to the stored fact (entry A)."""
    out = _scratch(spark, "sales-job")
    stages = jobs.sales_job(spark, land_inputs(spark, sf_dir), out, AS_OF, PROFILE)
    return interchange(writers.read_table(spark, f"{out}/fact").select(*[F.col(f"`{c}`") for c in config.FACT_COLUMNS]))


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """The tables of a run on the day before, brought up to the day."""
    out, landed = _scratch(spark, "refresh"), land_inputs(spark, sf_dir)
    jobs.sales_job(spark, landed, out, AS_OF - dt.timedelta(days=1), PROFILE, markdown=False)
    jobs.refresh_job(spark, landed, out, AS_OF, PROFILE)
    return out


@query
def fact_incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact brought up to a later day equals that day's full run."""
    return interchange(writers.read_table(spark, f"{_refreshed(spark, sf_dir)}/fact").select(*[F.col(f"`{c}`") for c in config.FACT_COLUMNS]))


@query
def pareto_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curves after a refresh: touched months from their kept totals, the others as published (A3, A5, K5)."""
    return _read_curves(spark, f"{_refreshed(spark, sf_dir)}/pareto")


@query
def pareto_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All curves from kept monthly store totals (A3, A5)."""
    path = _scratch(spark, "partials")
    with ExitStack() as scratch:
        jobs.store_partials(_stored_fact(spark, sf_dir, scratch), path)
    return interchange(jobs.curves_from_partials(spark, path, None, PROFILE))


@query
def job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the job observed while it wrote."""
    out = _scratch(spark, "report-job")
    jobs.sales_job(spark, land_inputs(spark, sf_dir), out, AS_OF, PROFILE, markdown=False)
    return writers.read_table(spark, f"{out}/report")


@query
def rolling_refresh_no_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a sheet for the month the feed gives the month so far."""
    inputs = run_inputs(spark, sf_dir, AS_OF)
    inputs.current_sheet = None
    st = sales_run.run_sales(inputs, AS_OF, PROFILE)
    return interchange(st.union.select("numero_pedido", "sku", "data_do_pedido", "hora_do_pedido", "loja",
                                       "quantidade", "rastreio", "source_rank", "origem_dados"))


@query
def sheet_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled date and number cells that parse to nothing, counted before any filter (Q5)."""
    o = tv.table(spark, sf_dir, "orders")
    price = F.replace(F.col("o_totalprice").cast(T.DecimalType(18, 2)).cast("string"), F.lit("."), F.lit(","))
    raw = o.select(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("dia "), F.col("o_orderkey").cast("string")))
                    .otherwise(F.date_format("o_orderdate", "d/M/yyyy HH:mm")).alias("data_do_pedido"),
                   F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).when(F.col("o_orderkey") % 7 == 0, "n/d").otherwise(price).alias("valor_total_produto"),
                   F.when(F.col("o_orderkey") % 2 == 0, "  ").otherwise(F.col("o_orderkey").cast("string")).alias("quantidade"))
    return quality.unreadable(raw, ["data_do_pedido"], ["valor_total_produto", "quantidade"])


@query
def load_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _run(spark, sf_dir, AS_OF)
    cat = _catalog(spark, sf_dir).select("sku")
    settled_ids = _settlement(spark, sf_dir).select(F.col("id_pedido").alias("numero_pedido"))
    return quality.load_report(st, cat, settled_ids, missing_columns=len(pareto.missing_required(st.fact)))
