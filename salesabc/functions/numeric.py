"""Numeric column expressions: safe parsing, rounding, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesabc.functions.text import strip


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def zero(scale: int = 3) -> Column:
    return F.lit(0).cast(_dec(18, scale))


def number_or_null(c: Column) -> Column:
    """Text -> decimal, a comma read as the decimal point; unreadable -> null."""
    return F.replace(strip(c.cast("string")), F.lit(","), F.lit(".")).try_cast(_dec(38, 10))


def parse_decimal(c: Column, scale: int = 3, precision: int = 18) -> Column:
    """Text or number -> decimal(precision, scale), HALF_UP; bad/blank/null -> 0.

    A comma is read as the decimal point ("1,5" -> 1.5).
    """
    rounded = F.round(number_or_null(c), scale).try_cast(_dec(precision, scale))
    return F.coalesce(rounded, F.lit(0).cast(_dec(precision, scale)))


def parse_long(c: Column) -> Column:
    """Text or number -> bigint, truncating decimals; bad/blank/null -> 0."""
    txt = F.replace(strip(c.cast("string")), F.lit(","), F.lit("."))
    return F.coalesce(txt.try_cast(_dec(38, 6)).try_cast(T.LongType()), F.lit(0).cast("long"))


def money(c: Column, scale: int = 3) -> Column:
    """Round a decimal HALF_UP to ``scale`` places; null -> 0."""
    return F.coalesce(F.round(c, scale).cast(_dec(18, scale)), zero(scale))


def times_qty(unit: Column, qty: Column, scale: int = 3) -> Column:
    """round(unit x quantity, scale) in decimal."""
    return money(unit * qty.cast(_dec(20, 0)), scale)


def int_div(a: Column, b: Column) -> Column:
    """Exact integral division of decimals or integers (SQL ``div``)."""
    return F.call_function("div", a, b)


def share_pct(value: Column, total: Column) -> Column:
    """value * 100 / total rounded HALF_UP to 3 places, exactly; 0 when total is 0.

    Works on thousandths so the rounding is exact integer arithmetic:
    q = (2|v|*100000 + |t|) div (2|t|), carrying the sign of v/t.
    """
    vm = F.abs((value * 1000).cast(_dec(38, 0)))
    tm = F.abs((total * 1000).cast(_dec(38, 0)))
    q = int_div(vm * 200000 + tm, tm * 2)
    signed = F.when((value < 0) != (total < 0), -q).otherwise(q)
    res = signed.cast(_dec(20, 0)) * F.lit(0.001).cast(_dec(3, 3))
    return F.when(total == 0, zero(3)).otherwise(res).cast(_dec(18, 3))


def abc_class(running: Column, a_max: str = "80.000", b_max: str = "95.000") -> Column:
    """A up to 80, B up to 95, C above (the running share includes the row)."""
    return (F.when(running <= F.lit(a_max).cast(_dec(18, 3)), "A")
            .when(running <= F.lit(b_max).cast(_dec(18, 3)), "B")
            .otherwise("C"))


# Bounds under which the thousandths formula cannot overflow a long:
# |v| * 200000 + |t| and 2|t| stay below 2^63.
_V_SAFE = 20_000_000_000_000
_T_SAFE = 4_000_000_000_000_000_000


def to_milli(c: Column) -> Column:
    """Decimal with 3 places -> exact integer thousandths (long)."""
    return (c * 1000).cast(T.LongType())


def from_milli(c: Column) -> Column:
    """Integer thousandths -> decimal(18,3)."""
    return (c.cast(_dec(18, 0)) * F.lit(0.001).cast(_dec(3, 3))).cast(_dec(18, 3))


def share_milli(v_milli: Column, t_milli: Column) -> Column:
    """``share_pct`` on integer thousandths, returning thousandths of a percent.

    Long arithmetic (fixed width, code-generated) for every realistic
    value; rows beyond the overflow bounds take the same formula in decimals.
    The expression is kept short: two of them share a generated method, and
    the JVM only interprets methods over 8,000 bytes.
    """
    av, at = F.abs(v_milli), F.abs(t_milli)
    wide_v, wide_t = av.cast(_dec(20, 0)), at.cast(_dec(20, 0))
    q = (F.when((av < _V_SAFE) & (at < _T_SAFE), int_div(av * 200000 + at, at * 2))
          .otherwise(int_div(wide_v * 200000 + wide_t, wide_t * 2)))
    return (F.when(t_milli == 0, F.lit(0).cast("long"))
             .when((v_milli < 0) != (t_milli < 0), -q).otherwise(q))


def abc_class_milli(running_milli: Column, a_max: str = "80.000", b_max: str = "95.000") -> Column:
    a, b = round(float(a_max) * 1000), round(float(b_max) * 1000)
    return F.when(running_milli <= a, "A").when(running_milli <= b, "B").otherwise("C")
