"""Column expressions against literal rows (FIXTURES.md section 2)."""

import datetime as dt
import random
import unicodedata
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from salesabc.functions import dates, numeric, text
from salesabc.functions.dates import refresh_window


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_n1_n3_decimal_parse(spark):
    got = one_col(spark, ["1,5", "x", None, "123456789.12", " 2.0005 ", ""], lambda c: numeric.parse_decimal(c, 3))
    assert got == [Decimal("1.500"), Decimal("0.000"), Decimal("0.000"), Decimal("123456789.120"),
                   Decimal("2.001"), Decimal("0.000")]


def test_parse_long_truncates(spark):
    assert one_col(spark, ["17.0", "2,7", "-3.9", "abc", None], numeric.parse_long) == [17, 2, -3, 0, 0]


def test_n4_sheet_dates(spark):
    got = one_col(spark, ["05/10/2025 10:00:00", "06/10/2025", "2025-10-08", "x", None], dates.parse_sheet_date)
    assert got == [dt.date(2025, 10, 5), dt.date(2025, 10, 6), dt.date(2025, 10, 8), None, None]


def test_n6_iso_wall_clock(spark):
    v = ["2025-10-24T23:30:00.000-03:00", "2025-10-24T01:02:03Z"]
    assert one_col(spark, v, dates.iso_wall_date) == [dt.date(2025, 10, 24)] * 2
    assert one_col(spark, v, dates.iso_wall_time) == ["23:30:00", "01:02:03"]


def test_n27_month_label(spark):
    got = one_col(spark, [dt.date(2025, 3, 2), dt.date(2025, 12, 31), None], dates.month_label, "date")
    assert got == ["03/marco/2025", "12/dezembro/2025", None]


def test_b9_slug(spark):
    got = one_col(spark, ["Amazon - Nanu Shop", "Ali Express - NANU.SHOP", " Shopee/X "], text.table_slug)
    assert got == ["amazon__nanu_shop", "ali_express__nanushop", "shopee_x"]


def test_strip_matches_python(spark):
    vals = [" a ", "\tb\n", "c\r\n", "  ", None]
    assert one_col(spark, vals, text.strip) == [v.strip() if v is not None else None for v in vals]


def test_ascii_fold_matches_nfkd(spark):
    rnd = random.Random(7)
    pool = [chr(c) for c in range(0x20, 0x7F)] + [chr(c) for c in range(0xA0, 0x250)] + list("™ﬁ½①Ａｂ𝐀…ẞ")
    vals = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    want = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().strip() for v in vals]
    assert one_col(spark, vals, text.ascii_fold) == want


def test_markdown_cell(spark):
    assert one_col(spark, ["a|b\nc\rd"], text.markdown_cell) == ["a-b c d"]


def _half_up_share(v, t):
    if t == 0:
        return Decimal("0.000")
    return (Decimal(v) * 100 / Decimal(t)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP)


def test_share_is_exact_half_up(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 10**9), rnd.randint(1, 10**10)) for _ in range(2000)] + [(1, 8), (1, 3), (2, 3), (0, 0)]
    df = spark.createDataFrame(rows, "v long, t long")
    got = df.select(numeric.share_milli(F.col("v"), F.col("t")).alias("s"), "v", "t").collect()
    for r in got:
        assert Decimal(r.s) / 1000 == _half_up_share(Decimal(r.v) / 1000, Decimal(r.t) / 1000)


def test_share_slow_path_for_huge_values(spark):
    df = spark.createDataFrame([(10**17, 3 * 10**17), (-(10**14), 3 * 10**14)], "v long, t long")
    got = [r[0] for r in df.select(numeric.share_milli(F.col("v"), F.col("t"))).collect()]
    assert got == [33333, -33333]


def test_w3_classes(spark):
    got = one_col(spark, [80000, 80001, 95000, 95001], numeric.abc_class_milli, "long")
    assert got == ["A", "B", "B", "C"]


def test_refresh_window():
    assert refresh_window(dt.date(2025, 10, 1), True) == (dt.date(2025, 10, 1), dt.date(2025, 10, 1))
    assert refresh_window(dt.date(2025, 10, 15), True) == (dt.date(2025, 10, 14), dt.date(2025, 10, 15))
    assert refresh_window(dt.date(2025, 10, 15), False) == (dt.date(2025, 10, 1), dt.date(2025, 10, 15))


def test_dates_in_all_common_forms(spark):
    import datetime as dt
    d = dt.date(2025, 10, 5)
    forms = ["05/10/2025 10:00", "5/10/2025", "5/10/2025 9:05", "2025-10-05T10:00:00", "2025-10-05 10:00:00.123", "2025-10-05T23:30:00.000-03:00",
             "2025-10-5", "\xa005/10/2025\u2003", "2025-10-05T10:00Z"]
    assert one_col(spark, forms, dates.parse_sheet_date) == [d] * len(forms)
    bad = ["31/02/2025", "05/13/2025", "05/10/25", "2025-10-05 25:00", "05/10/2025 10:61", "10/2025", "", "x"]
    assert one_col(spark, bad, dates.parse_sheet_date) == [None] * len(bad)


def test_iso_time_without_seconds(spark):
    got = one_col(spark, ["2025-10-24T23:30-03:00", "2025-10-24T23:30:15.000-03:00", "2025-10-24", None], dates.iso_wall_time)
    assert got == ["23:30:00", "23:30:15", "", ""]


def test_strip_is_python_strip(spark):
    vals = [chr(c) + "a b" + chr(c) for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    assert one_col(spark, vals, text.strip) == [v.strip() for v in vals]


def test_ascii_fold_is_nfkd(spark):
    import time
    import unicodedata
    t0 = time.perf_counter()
    text.ascii_fold(F.col("c"))
    text.ascii_fold(F.col("c"))
    assert time.perf_counter() - t0 < 3  # building the expression costs no row-wise calls
    vals = ["x" + chr(c) + "y" for c in range(1, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF] + ["São João", "ﬁm ½ ㎏ Ⅷ", "ça", "日本 a"]
    want = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().strip() for v in vals]
    assert one_col(spark, vals, text.ascii_fold) == want
