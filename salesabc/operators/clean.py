"""Typing and business rules for unioned sales rows.

Everything is one projection: no joins, no shuffles, whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc import config
from salesabc.config import Profile
from salesabc.functions.business import (logistics_class, marketplace_revenue, standard_status,
                                         standard_store)
from salesabc.functions.dates import parse_sheet_date
from salesabc.functions.numeric import parse_decimal, parse_long


def default_value(name: str) -> Column:
    dtype, value = config.WORK_DEFAULTS[name]
    return F.lit(value).cast(dtype)


def conform(df: DataFrame, columns: list[str], keep_extra: bool = False) -> DataFrame:
    """Select ``columns`` in order, adding missing ones with their typed default."""
    present = set(df.columns)
    cols = [F.col(f"`{c}`") if c in present else default_value(c).alias(c) for c in columns]
    if keep_extra:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in set(columns)]
    return df.select(*cols)


def _as_date(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name)
    return parse_sheet_date(F.col(name))


def _as_money(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DecimalType):
        return F.coalesce(F.round(F.col(name), 3).cast(config.MONEY), F.lit(0).cast(config.MONEY))
    return parse_decimal(F.col(name), 3)


def _as_long(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))
    return parse_long(F.col(name))


def clean_sales(df: DataFrame, profile: Profile = config.DEFAULT_PROFILE) -> DataFrame:
    """Types, standard names and statuses, logistics class, marketplace revenue.

    Text columns may arrive raw (sheet text) or typed (already parsed);
    both give the same result.
    """
    d = df
    loja = standard_store(F.col("loja"), profile)
    out = {
        "data_do_pedido": _as_date(d, "data_do_pedido"),
        "numero_pedido_erp": F.coalesce(F.col("numero_pedido_erp").cast("string"), F.lit("")),
        "numero_pedido": F.coalesce(F.col("numero_pedido").cast("string"), F.lit("")),
        "valor_total_produto": _as_money(d, "valor_total_produto"),
        "valor_unitario_venda": _as_money(d, "valor_unitario_venda"),
        "quantidade": _as_long(d, "quantidade"),
        "loja": loja,
        "status": standard_status(F.col("status")),
    }
    d = d.withColumns(out)
    d = d.withColumn("tipo_logistica", logistics_class(F.col("loja"), F.col("tipo_logistica"), profile))
    d = d.withColumn("valor_total_produto",
                     marketplace_revenue(F.col("loja"), F.col("valor_unitario_venda"),
                                         F.col("quantidade"), F.col("valor_total_produto"), profile))
    return d
