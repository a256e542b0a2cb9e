"""Marketplace settlement reports.

Reports are pre-aggregated per (file, order) before the join, so the join
build side has one row per order and cannot fan out sales lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesabc.config import MONEY
from salesabc.functions.numeric import from_milli, int_div, money, parse_decimal, times_qty, to_milli, zero
from salesabc.functions.text import strip
from salesabc.operators.dedup import keep_last

NUMERIC = ["moedas", "cupom", "taxa_comissao", "taxa_servico", "preco_acordado"]


def aggregate_settlement(rows: DataFrame, file_col: str = "arquivo",
                         order_col: str = "ingest_order") -> DataFrame:
    """Report rows -> one row per order: settled price, cashback, commission.

    Within a file: cashback = sum(round(coins/100, 3) + coupon), commission =
    sum(fee + service fee), price = first row's.  Across files the later
    file wins (file order = ``file_col`` order).
    """
    present = set(rows.columns)
    nums = {c: (parse_decimal(F.col(c), 3) if c in present else zero(3)) for c in NUMERIC}
    typed = rows.select(
        F.col(file_col).alias("_file"),
        strip(F.col("id_pedido").cast("string")).alias("id_pedido"),
        (money(nums["moedas"] / 100, 3) + nums["cupom"]).alias("_cashback"),
        (nums["taxa_comissao"] + nums["taxa_servico"]).alias("_comissao"),
        nums["preco_acordado"].alias("_preco"),
        F.col(order_col).alias("_order"),
    ).filter(F.col("id_pedido").isNotNull())
    per_file = typed.groupBy("_file", "id_pedido").agg(
        money(F.sum("_cashback"), 3).alias("cashback_cupom"),
        money(F.sum("_comissao"), 3).alias("Comissão"),
        money(F.min_by("_preco", "_order"), 3).alias("preco_acordado"))
    last = keep_last(per_file, ["id_pedido"], F.col("_file"))
    return last.select("id_pedido", "preco_acordado", "cashback_cupom", "Comissão")


def apply_settlement(sales: DataFrame, settled: DataFrame, allocate: bool = False) -> DataFrame:
    """Sales left join settlement on order id (J3), then J4/B6:

    settled orders take the agreed price as line revenue, on every line of
    the order, or with ``allocate`` split over its lines by their value so
    that they add up to it (N9); all other lines get unit price x quantity.
    Fees come from the report when present.
    """
    r = settled.select(F.col("id_pedido").alias("_r_id"),
                       F.col("preco_acordado").alias("_r_preco"),
                       F.col("cashback_cupom").alias("_r_cashback"),
                       F.col("Comissão").alias("_r_comissao"))
    j = sales.join(r, sales.numero_pedido == r._r_id, "left")
    cash = F.col("cashback_cupom") if "cashback_cupom" in sales.columns else zero(3)
    com = F.col("`Comissão`") if "Comissão" in sales.columns else zero(3)
    if allocate:
        j = _with_line_shares(j)
    out = j.withColumns({
        "valor_total_produto": F.when(F.col("_r_id").isNotNull(), F.col("_share") if allocate else F.col("_r_preco").cast(MONEY))
                                .otherwise(times_qty(F.col("valor_unitario_venda"), F.col("quantidade"))),
        "cashback_cupom": F.coalesce(F.col("_r_cashback"), cash).cast(MONEY),
        "Comissão": F.coalesce(F.col("_r_comissao"), com).cast(MONEY),
    })
    return out.drop("_r_id", "_r_preco", "_r_cashback", "_r_comissao", "_share")


#: Lines of an order are dealt by so many first characters of their sku.
SLICE_CHARS = 4


def _with_line_shares(j: DataFrame) -> DataFrame:
    """Add ``_share``: the agreed price split over the lines of a settled order by value, equally if they have none.

    A line gets the rounded price up to it less the rounded price up to the
    line before, in thousandths, so the lines add up exactly.  Lines are in
    the order of sku and tracking code.

    Two levels, so that an order with a large part of all lines is no task of
    its own: a slice of an order holds the lines whose skus begin alike, so
    slices are contiguous in the order and a function of the line alone.
    Running values inside a slice are added to the sums of the slices before,
    which are a row per order and slice, summed before they are shuffled.
    """
    dec = "decimal(20,0)"
    order = F.when(F.col("_r_id").isNotNull(), F.col("_r_id")).otherwise(F.concat_ws("\x01", "numero_pedido", "sku", "rastreio"))
    value = F.greatest(F.coalesce(to_milli(times_qty(F.col("valor_unitario_venda"), F.col("quantidade"))), F.lit(0)), F.lit(0)).cast(dec)
    key = ["_order", "_slice"]
    # Null skus come first in the order, as the empty beginning does.
    rows = j.withColumns({"_order": order, "_slice": F.coalesce(F.substring("sku", 1, SLICE_CHARS), F.lit("")), "_value": value})
    sums = (rows.where(F.col("_r_id").isNotNull()).groupBy(*key).agg(F.sum("_value").cast(dec).alias("_v"), F.count("*").cast(dec).alias("_n")))
    lines = Window.partitionBy("_order")
    before = lines.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*key, *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast(dec).alias(f"{c}_before") for c in ("_v", "_n")],
                          *[F.sum(c).over(lines).cast(dec).alias(f"{c}_all") for c in ("_v", "_n")])
    upto = Window.partitionBy(*key).orderBy("sku", "rastreio").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.join(offsets, key, "left")
    none = F.col("_v_all") == 0
    whole = F.when(none, F.col("_n_all")).otherwise(F.col("_v_all"))
    own = F.when(none, F.lit(1).cast(dec)).otherwise(F.col("_value"))
    part = (F.when(none, F.col("_n_before") + F.count("*").over(upto).cast(dec)).otherwise(F.col("_v_before") + F.sum("_value").over(upto))).cast(dec)
    price = to_milli(F.col("_r_preco")).cast("decimal(18,0)")
    rounded = lambda p: int_div(price * p * 2 + whole, whole * 2)
    named = both.withColumns({"_part": part, "_own": own})
    share = from_milli(rounded(F.col("_part")) - rounded(F.col("_part") - F.col("_own"))).cast(MONEY)
    return named.withColumn("_share", share).select(*j.columns, "_share")
