"""Catalogue inputs: product pages (S8), published sheet (S7), catalogue CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc import config
from salesabc.functions.numeric import parse_long
from salesabc.operators.catalog import aggregate_catalog

PRODUCT = T.StructType([
    T.StructField("codigo", T.StringType()),
    T.StructField("nome", T.StringType()),
    T.StructField("precoCusto", T.DoubleType()),
    T.StructField("estoque", T.StructType([T.StructField("saldoVirtualTotal", T.LongType())])),
])
PRODUCT_PAGE = T.StructType([
    T.StructField("pagina", T.LongType()),
    T.StructField("data", T.ArrayType(PRODUCT)),
])

SHEET_COLUMNS = config.CATALOG_SHEET_COLUMNS


def file_order() -> Column:
    """Ingest position of a CSV/JSON row: file, block, then row within the block.

    ``monotonically_increasing_id`` grows with the row position inside a
    task's split, and a split is one block of one file, so the triple is
    a total order matching file order.
    """
    return F.struct(F.col("_metadata.file_path").alias("f"),
                    F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("r"))


def comma_money_text(c: Column) -> Column:
    """Number -> text with 2 decimals and a comma decimal point."""
    return F.replace(c.cast(T.DecimalType(18, 2)).cast("string"), F.lit("."), F.lit(","))


def parse_product_pages(text: DataFrame, col: str = "value") -> DataFrame:
    return text.select(F.from_json(F.col(col), PRODUCT_PAGE).alias("p")).select("p.*")


def read_product_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRODUCT_PAGE).json(path)


def flatten_products(pages: DataFrame) -> DataFrame:
    """Product pages -> catalogue rows: sku, name, unit, stock, cost text."""
    p = pages.select(F.explode("data").alias("d"))
    return p.select(
        F.coalesce(F.col("d.codigo"), F.lit("")).alias("sku"),
        F.coalesce(F.col("d.nome"), F.lit("")).alias("Produto"),
        F.lit("UN").alias("UN"),
        F.coalesce(F.col("d.estoque.saldoVirtualTotal"), F.lit(0)).cast("long").alias("Quantidade"),
        comma_money_text(F.coalesce(F.col("d.precoCusto"), F.lit(0.0))).alias("Valor unitario"),
    )


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    # A UTF-8 byte-order mark may stick to the first header.
    fixed = {c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")}
    if fixed:
        df = df.withColumnsRenamed(fixed)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def read_catalog_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Published catalogue sheet (',' CSV) -> the 9 catalogue columns.

    Missing columns are created empty; stock becomes an integer.
    """
    raw = spark.read.option("header", True).option("sep", ",").option("multiLine", True).option("escape", '"').csv(path)
    df = _rename(raw, config.CATALOG_SHEET_RENAME).withColumn("UN", F.lit("UN"))
    missing = [c for c in SHEET_COLUMNS if c not in df.columns]
    cols = [F.col(f"`{c}`") if c not in missing else F.lit("").alias(c) for c in SHEET_COLUMNS]
    out = df.select(*cols, file_order().alias("ingest_order"))
    return out.withColumn("Quantidade", parse_long(F.col("Quantidade")))


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV (';', comma decimals) -> raw renamed rows with ingest order."""
    raw = spark.read.option("header", True).option("sep", ";").option("multiLine", True).option("escape", '"').csv(path)
    df = _rename(raw, config.CATALOG_CSV_RENAME)
    return df.withColumn("ingest_order", file_order())


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV -> one row per sku, ready for the sales join (S6 + A1)."""
    return aggregate_catalog(read_catalog_csv(spark, path))


def sheet_to_csv_rows(sheet: DataFrame) -> DataFrame:
    """Catalogue columns in CSV order and header names (K1 projection)."""
    names = dict(zip(SHEET_COLUMNS, config.CATALOG_CSV_COLUMNS))
    out = []
    for c in SHEET_COLUMNS:
        col = F.col(f"`{c}`") if c in sheet.columns else F.lit("")
        out.append(col.cast("string").alias(names[c]))
    return sheet.select(*out)
