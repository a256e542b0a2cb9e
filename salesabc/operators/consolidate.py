"""Union of sources, rolling refresh, keep-last and the fact projection.

U1  union_sources     sources by name, tagged with a source rank
P8  refresh_filter    drop the days the feed re-reads
W4  dedup_sales       keep the last line per (order, sku)
B7  fact_table        22 typed columns, money at 2 decimals
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc import config
from salesabc.config import MONEY2
from salesabc.functions.dates import parse_sheet_date
from salesabc.functions.numeric import parse_decimal, parse_long
from salesabc.functions.text import clean_text, strip
from salesabc.operators.clean import conform
from salesabc.operators.dedup import keep_last, keep_last_of_stored

# Order columns a source may carry; "last" compares source rank first,
# then the source's own ingest position.
ORDER_COLUMNS = ["source_rank", "sheet_order", "feed_order"]
WORK_COLUMNS = list(config.WORK_DEFAULTS)


def tag_source(df: DataFrame, rank: int, origin: str, order_col: str | None = None,
               kind: str = "sheet") -> DataFrame:
    """Add the source rank, origin label and ingest order (as sheet_order or feed_order)."""
    out = df.withColumns({"source_rank": F.lit(rank), "origem_dados": F.lit(origin)})
    if order_col:
        out = out.withColumnRenamed(order_col, f"{kind}_order")
    return out


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from a source is null there."""
    if not parts:
        raise ValueError("no sales source to union")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def refresh_filter(df: DataFrame, lo: dt.date, hi: dt.date, date_col: str = "data_do_pedido") -> DataFrame:
    """Keep rows strictly before ``lo`` or after ``hi`` (null dates drop out)."""
    d = F.col(date_col)
    return df.filter((d < F.lit(lo)) | (d > F.lit(hi)))


def months_filter(df: DataFrame, months: list[str], month_col: str = "mes") -> DataFrame:
    """Rows of the listed months ``yyyy-MM``."""
    return df.filter(F.col(month_col).isin(*months))


def month_filter(df: DataFrame, year: int, month: int, date_col: str = "data_do_pedido") -> DataFrame:
    """Rows of one calendar month, as a range so it prunes partitions/row groups."""
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    d = F.col(date_col)
    return df.filter((d >= F.lit(start)) & (d < F.lit(end)))


def dedup_sales(df: DataFrame, stored: bool = False) -> DataFrame:
    """Last line per (numero_pedido, sku) after trimming both keys (W4); ``stored`` if ``df`` reads a table."""
    keyed = df.withColumns({"numero_pedido": clean_text(F.col("numero_pedido")),
                            "sku": clean_text(F.col("sku"))})
    for c in ORDER_COLUMNS:
        if c not in keyed.columns:
            keyed = keyed.withColumn(c, F.lit(None))
    return (keep_last_of_stored if stored else keep_last)(keyed, ["numero_pedido", "sku"], ORDER_COLUMNS)


MONEY_FINAL = ["valor_total_produto", "custo_total_produto", "Comissão", "custo_unitario"]
TEXT_FILLED = ["Categoria", "Subcategoria", "Fornecedores", "tipo_de_venda"]


def fact_table(df: DataFrame) -> DataFrame:
    """The 22-column fact: money HALF_UP to 2 decimals, filled text, typed stock."""
    d = conform(df, WORK_COLUMNS)
    d = d.withColumns({
        **{c: F.coalesce(F.round(F.col(f"`{c}`"), 2), F.lit(0)).cast(MONEY2) for c in MONEY_FINAL},
        **{c: F.coalesce(strip(F.col(c)), F.lit("")) for c in TEXT_FILLED},
        "Estq": F.coalesce(F.col("Estq"), F.lit(0)).cast("long"),
        "quantidade": F.coalesce(F.col("quantidade"), F.lit(0)).cast("long"),
    })
    return d.select(*[F.col(f"`{c}`") for c in config.FACT_COLUMNS])


def fact_from_text(table: DataFrame) -> DataFrame:
    """A fact read back as text (Markdown) -> typed fact; columns it lacks are null or empty."""
    typed = []
    for f in config.FACT_SCHEMA.fields:
        c = F.col(f"`{f.name}`") if f.name in table.columns else F.lit(None).cast("string")
        if isinstance(f.dataType, T.DecimalType):
            typed.append(parse_decimal(c, 2).alias(f.name))
        elif isinstance(f.dataType, T.LongType):
            typed.append(parse_long(c).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            typed.append(parse_sheet_date(c).alias(f.name))
        else:
            typed.append(F.coalesce(c, F.lit("")).alias(f.name))
    return table.select(*typed)
