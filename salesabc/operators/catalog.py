"""Product catalogue: aggregation, enrichment and the sales join.

A1  aggregate_catalog   one row per sku: max cost, summed stock, first text
J5  enrich_catalog      product pages + enrichment sheet (keep last per sku)
J1  join_catalog        sales left join catalogue on trimmed sku
J2  (inside J1)         catalogue wins for cost/stock/text; sheet wins for title
B5  (inside J1)         line cost = round(quantity x unit cost, 3)

The catalogue is keyed by sku, so its size is bounded by the product
list, not by sales.  The join is written without a hint: the planner
broadcasts it when its measured size is below the broadcast threshold
and falls back to a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc.config import MONEY
from salesabc.functions.numeric import money, parse_decimal, parse_long, times_qty
from salesabc.functions.text import clean_text, strip
from salesabc.operators.dedup import keep_last

CATALOG_TEXT = ["titulo_bling", "Fornecedores", "Categoria", "Subcategoria", "tipo_de_venda"]
CATALOG_COLUMNS = ["sku", "custo_unitario", "Estq"] + CATALOG_TEXT


def first_non_null(c: str, order: Column) -> Column:
    """First non-null value of ``c`` in ingest order (pandas ``first``)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def aggregate_catalog(rows: DataFrame, order_col: str = "ingest_order") -> DataFrame:
    """Catalogue rows (text, comma decimals) -> one row per trimmed sku (A1).

    Expects columns sku, custo_unitario, Estq, the text columns and an
    ingest-order column.  Partial aggregation runs map-side, so a sku
    repeated in many rows costs one row per task in the shuffle.
    """
    present = set(rows.columns)
    typed = rows.select(
        strip(F.col("sku").cast("string")).alias("sku"),
        parse_decimal(F.col("custo_unitario"), 3).alias("custo_unitario")
        if "custo_unitario" in present else F.lit(0).cast(MONEY).alias("custo_unitario"),
        parse_long(F.col("Estq")).alias("Estq") if "Estq" in present else F.lit(0).cast("long").alias("Estq"),
        *[(F.col(c).cast("string") if c in present else F.lit(None).cast("string")).alias(c)
          for c in CATALOG_TEXT],
        F.col(order_col).alias("_order"),
    ).filter(F.col("sku").isNotNull() & (F.col("sku") != ""))
    agg = typed.groupBy("sku").agg(
        F.max("custo_unitario").alias("custo_unitario"),
        F.sum("Estq").alias("Estq"),
        *[first_non_null(c, F.col("_order")).alias(c) for c in CATALOG_TEXT])
    return agg.select(
        "sku",
        money(F.col("custo_unitario"), 3).alias("custo_unitario"),
        F.col("Estq").cast("long").alias("Estq"),
        clean_text(F.col("titulo_bling")).alias("titulo_bling"),
        *[strip(F.col(c)).alias(c) for c in CATALOG_TEXT[1:]])


def enrich_catalog(products: DataFrame, sheet: DataFrame, order_col: str = "ingest_order") -> DataFrame:
    """Product-page catalogue left join the enrichment sheet.

    The sheet is cut to its last row per sku first, so the join cannot fan
    out; missing enrichment becomes ''.
    """
    cols = ["Fornecedores", "Categoria", "Subcategoria", "tipo_de_venda"]
    s = sheet.select(strip(F.col("sku").cast("string")).alias("sku"),
                     *[clean_text(F.col(c)).alias(c) for c in cols], F.col(order_col).alias("_order"))
    last = keep_last(s, ["sku"], F.col("_order")).drop("_order")
    p = products.withColumn("sku", strip(F.col("sku").cast("string")))
    j = p.join(last, "sku", "left")
    return j.select(*[F.col(c) for c in p.columns],
                    *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


def join_catalog(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales left join catalogue on trimmed sku, with precedence rules and line cost."""
    cat = catalog.select(
        F.col("sku").alias("_cat_sku"),
        *[F.col(c).alias(f"_cat_{c}") for c in CATALOG_COLUMNS if c != "sku"])
    s = sales.withColumn("sku", strip(F.col("sku")))
    j = s.join(cat, s.sku == cat._cat_sku, "left")

    def sales_col(c: str, dtype: T.DataType) -> Column:
        return F.col(c) if c in s.columns else F.lit(None).cast(dtype)

    unit_cost = money(F.coalesce(F.col("_cat_custo_unitario"), sales_col("custo_unitario", MONEY)), 2)
    out = j.withColumns({
        "custo_unitario": unit_cost.cast(MONEY),
        "Estq": F.coalesce(F.col("_cat_Estq"), sales_col("Estq", T.LongType()), F.lit(0)).cast("long"),
        "titulo": F.coalesce(F.col("titulo"), F.col("_cat_titulo_bling")),
        **{c: clean_text(F.coalesce(F.col(f"_cat_{c}"), sales_col(c, T.StringType())))
           for c in ["Fornecedores", "Categoria", "Subcategoria", "tipo_de_venda"]},
    })
    out = out.withColumn("custo_total_produto", times_qty(F.col("custo_unitario"), F.col("quantidade")))
    return out.drop(*[c for c in out.columns if c.startswith("_cat_")])
