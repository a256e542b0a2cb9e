"""Business rules and operators on literal rows (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesabc import config, session
from salesabc.functions import business
from salesabc.operators import catalog, consolidate, pareto, settlement
from salesabc.operators.cumulative import running_sum
from salesabc.sources import files, order_feed

PROFILE = config.DEFAULT_PROFILE


def test_b1_b2_status_and_store(spark):
    df = spark.createDataFrame([(" sent ", "Amazon - NANU SHOP"), ("odd", "Loja X")], "s string, l string")
    got = df.select(business.standard_status(F.col("s")), business.standard_store(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [("Enviado", "Amazon - Nanu Shop"), ("odd", "Loja X")]


def test_b3_logistics_priority(spark):
    rows = [("Amazon - A", "fulfillment"), ("Shopee - A", "drop_off"), ("Kabum - A", "drop_off"),
            ("Kabum - A", "zzz"), ("Mercado Livre - A", "self_service"), ("Kabum - A", "xd_drop_off"),
            ("Mercado Livre - A", "drop_off")]
    df = spark.createDataFrame(rows, "loja string, raw string")
    got = [r[0] for r in df.select(business.logistics_class(F.col("loja"), F.col("raw"), PROFILE)).collect()]
    assert got == ["Fulfillment", "Shopee Xpress", "Correios Outros", "Outros", "Envio Flex", "Coleta Outros",
                   "Mercado Envios"]


def test_b4_recomputed_revenue(spark):
    rows = [("Amazon - A", Decimal("2.500"), 3, Decimal("99.000")), ("Shopee - A", Decimal("2.500"), 3, Decimal("99.000")),
            ("Mercado Livre - A", Decimal("2.500"), 0, Decimal("99.000"))]
    df = spark.createDataFrame(rows, "loja string, u decimal(18,3), q long, t decimal(18,3)")
    got = [r[0] for r in df.select(business.marketplace_revenue(F.col("loja"), F.col("u"), F.col("q"), F.col("t"),
                                                                  PROFILE)).collect()]
    assert got == [Decimal("7.500"), Decimal("99.000"), Decimal("99.000")]


def test_n21_group_labels(spark):
    df = spark.createDataFrame([("Shopee - X",), ("Shopee",), ("Kabum - Y",)], "loja string")
    got = [sorted(r[0]) for r in df.select(business.group_labels(F.col("loja"), PROFILE)).collect()]
    assert got == [sorted(["Shopee - X", "Shopee", "PARETO_GERAL"]), sorted(["Shopee", "PARETO_GERAL"]),
                   sorted(["Kabum - Y", "PARETO_GERAL"])]


def test_n12_catalog_trim_then_group(spark):
    rows = [("A", "1", "2", "t1", 1), ("A ", "4", "3", None, 2), (None, "9", "9", "x", 3)]
    df = spark.createDataFrame(rows, "sku string, custo_unitario string, Estq string, titulo_bling string, o long")
    got = catalog.aggregate_catalog(df.withColumnRenamed("o", "ingest_order")).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.sku, r.custo_unitario, r.Estq, r.titulo_bling) == ("A", Decimal("4.000"), 5, "t1")


def test_first_non_null_in_ingest_order(spark):
    rows = [("A", None, 1), ("A", "second", 2), ("A", "third", 3)]
    df = spark.createDataFrame(rows, "sku string, Fornecedores string, ingest_order long")
    r = catalog.aggregate_catalog(df).collect()[0]
    assert r.Fornecedores == "second" and r.titulo_bling == ""


def test_n9_n10_n11_settlement(spark):
    rows = [("1", "100", "0", "3", "0", "100", 1), ("2", "0", "0", "5", "0", "10", 1)]
    files = [("f1",) + r for r in rows] + [("f2", "2", "0", "0", "7", "1", "20", 1)]
    rep = spark.createDataFrame(files, "arquivo string, id_pedido string, moedas string, cupom string, "
                                       "taxa_comissao string, taxa_servico string, preco_acordado string, "
                                       "ingest_order long")
    agg = {r.id_pedido: r for r in settlement.aggregate_settlement(rep).collect()}
    assert agg["1"].cashback_cupom == Decimal("1.000") and agg["1"]["Comissão"] == Decimal("3.000")
    assert agg["2"]["Comissão"] == Decimal("8.000") and agg["2"].preco_acordado == Decimal("20.000")
    sales = spark.createDataFrame([("1", Decimal("2.5"), 3), ("1", Decimal("1"), 1), ("9", Decimal("2.5"), 3)],
                                  "numero_pedido string, valor_unitario_venda decimal(18,3), quantidade long")
    out = settlement.apply_settlement(sales, settlement.aggregate_settlement(rep)).collect()
    assert [r.valor_total_produto for r in out if r.numero_pedido == "1"] == [Decimal("100.000")] * 2
    assert [r.valor_total_produto for r in out if r.numero_pedido == "9"] == [Decimal("7.500")]


def test_n14_keep_last_prefers_feed(spark):
    rows = [("1", "A", 0, 5, "sheet"), ("1", "A", 2, 1, "feed"), ("1", "B", 0, 1, "x"), ("1", "B", 0, 2, "y")]
    df = spark.createDataFrame(rows, "numero_pedido string, sku string, source_rank int, sheet_order long, v string")
    got = {(r.numero_pedido, r.sku): r.v for r in consolidate.dedup_sales(df).collect()}
    assert got == {("1", "A"): "feed", ("1", "B"): "y"}


def test_p8_refresh_filter(spark):
    days = [dt.date(2025, 10, d) for d in (13, 14, 15, 16)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "data_do_pedido date")
    kept = consolidate.refresh_filter(df, dt.date(2025, 10, 14), dt.date(2025, 10, 15)).collect()
    assert sorted(r[0] for r in kept) == [dt.date(2025, 10, 13), dt.date(2025, 10, 16)]


def _pareto(spark, rows):
    df = spark.createDataFrame(rows, "loja string, sku string, titulo string, quantidade long, "
                                     "valor_total_produto decimal(18,3), data_do_pedido date")
    return pareto.pareto_abc(df, PROFILE).filter(F.col("grupo") == "Kabum - A").orderBy(
        "pareto_quantidade_acumulada").collect()


def test_n16_n17_ties_and_rounded_running_share(spark):
    d = dt.date(2025, 1, 5)
    rows = [("Kabum - A", s, "t", 1, Decimal("1.000"), d) for s in ("c", "b", "a")]
    got = _pareto(spark, rows)
    assert [r.sku for r in got] == ["a", "b", "c"]
    assert [str(r.share_quantidade_vendas) for r in got] == ["33.333"] * 3
    assert [str(r.pareto_quantidade_acumulada) for r in got] == ["33.333", "66.666", "99.999"]
    assert [r.curva_abc_quantidade for r in got] == ["A", "A", "C"]


def test_n18_n19_n20_n5(spark):
    d = dt.date(2025, 1, 5)
    one = _pareto(spark, [("Kabum - A", "a", "t", 2, Decimal("5.000"), d), ("Kabum - A", "z", "t", 1, Decimal("1.000"), None)])
    assert [(str(r.share_quantidade_vendas), r.curva_abc_quantidade) for r in one] == [("100.000", "C")]
    zero = _pareto(spark, [("Kabum - A", "a", "t", 0, Decimal("0.000"), d), ("Kabum - A", "b", "t", 0, Decimal("0.000"), d)])
    assert {(str(r.share_gmv), r.curva_abc_gmv) for r in zero} == {("0.000", "A")}
    two = _pareto(spark, [("Kabum - A", "a", "t1", 1, Decimal("1.000"), d), ("Kabum - A", "a", "t2", 1, Decimal("1.000"), d)])
    assert len(two) == 2


def test_n7_order_without_items(spark):
    page = ('{"page": 1, "total": 1, "orders": [{"id": "7", "dateCreated": "2025-10-24T23:30:00.000-03:00", '
            '"channelName": "Shopee - X", "order_items": []}]}')
    pages = order_feed.parse_pages(spark.createDataFrame([(page,)], "value string"))
    r = order_feed.feed_rows(pages).collect()
    assert len(r) == 1
    assert (r[0].sku, r[0].titulo, r[0].quantidade, r[0].valor_unitario_venda) == ("N/A", "N/A", 0, Decimal("0.000"))
    assert (r[0].data_do_pedido, r[0].hora_do_pedido) == (dt.date(2025, 10, 24), "23:30:00")


def test_range_running_sum_equals_window(spark):
    rows = [("g1" if i % 3 else "g2", i % 17, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v long, k long")
    order = [F.col("v").desc(), F.col("k")]
    a = running_sum(df, ["g"], order, "v", "r", strategy="window").collect()
    b = running_sum(df, ["g"], order, "v", "r", strategy="range", slices=7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_curves_never_gather_a_group(spark):
    """Windows of the default curves hold rows with a share only, at most 200,000 a group; nothing runs while they are built."""
    from salesabc.plans import registry
    plan = registry.QUERIES["pareto_abc"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    over = [line for line in plan.splitlines() if "Window [" in line]
    assert len(over) == 2  # one for each measure
    assert all("_spread" in line for line in over)


def test_sheets_read_chosen_months_only(spark):
    """The month condition reaches the scan as a partition filter; headers are bound by name."""
    base = session.scratch_path(spark, "sheet-test")
    head = {v: k for k, v in config.SHEET_HEADERS.items()}
    a, b = head["numero_pedido"], head["sku"]
    spark.createDataFrame([("p1", "A\nx"), ("p2", 'q "B"')], f"`{a}` string, `{b}` string").coalesce(1).write.option("header", True).option("escape", '"').csv(f"{base}/mes=2025-09")
    spark.createDataFrame([("C", "p3", "?")], f"`{b}` string, `{a}` string, extra string").coalesce(1).write.option("header", True).csv(f"{base}/mes=2025-10")
    spark.createDataFrame([("p4",)], f"`{a}` string").coalesce(1).write.option("header", True).csv(f"{base}/mes=2025-11")
    closed, current = files.read_month_sheets(spark, base, dt.date(2025, 11, 5))
    assert sorted((r.numero_pedido, r.sku, r.mes) for r in closed.collect()) == [("p1", "A\nx", "2025-09"), ("p2", 'q "B"', "2025-09"), ("p3", "C", "2025-10")]
    assert [(r.numero_pedido, r.sku) for r in current.collect()] == [("p4", None)]
    plan = closed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes" in plan
    gaps = {(r.file.split("mes=")[1][:7], r.coluna) for r in files.missing_sheet_headers(spark, base).collect()}
    assert ("2025-11", b) in gaps and ("2025-10", b) not in gaps and ("2025-09", a) not in gaps


def test_published_types(spark):
    """The fact and the curves carry their published types, not the checker's."""
    from salesabc.plans import registry
    from salesabc.plans.sales_run import run_sales
    fact = run_sales(registry.run_inputs(spark, "/root/testdata/sf0.001", registry.AS_OF), registry.AS_OF, registry.PROFILE).fact
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in config.FACT_SCHEMA.fields]


def test_shared_folder_is_needed_on_a_cluster(spark):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda k, d=None: d)

    try:
        session.ensure_checkpoint_dir(Cluster)
    except ValueError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("a private folder was taken on a cluster")


def test_n9_allocated_price_adds_up(spark):
    settled = spark.createDataFrame([("1", Decimal("100.000"), Decimal(0), Decimal(0)), ("2", Decimal("10.000"), Decimal(0), Decimal(0))],
                                    "id_pedido string, preco_acordado decimal(18,3), cashback_cupom decimal(18,3), `Comissão` decimal(18,3)")
    rows = [("1", "a", "r1", Decimal("1.000"), 1), ("1", "b", "r2", Decimal("1.000"), 2), ("2", "a", "r3", Decimal("0.000"), 5), ("2", "b", "r4", Decimal("0.000"), 5),
            ("2", "c", "r5", Decimal("0.000"), 5), ("9", "a", "r6", Decimal("2.500"), 2)]
    sales = spark.createDataFrame(rows, "numero_pedido string, sku string, rastreio string, valor_unitario_venda decimal(18,3), quantidade long")
    got = {(r.numero_pedido, r.sku): r.valor_total_produto for r in settlement.apply_settlement(sales, settled, allocate=True).collect()}
    assert got[("1", "a")] == Decimal("33.333") and got[("1", "b")] == Decimal("66.667")
    assert sum(v for (o, _), v in got.items() if o == "2") == Decimal("10.000") and got[("9", "a")] == Decimal("5.000")


def test_b2_store_names_of_the_business(spark):
    """The fixed store names are looked up, padded ones too, and unknown ones pass."""
    names = [*config.STORE_NAMES, "Loja nova"]
    df = spark.createDataFrame([(f" {n} ",) for n in names], "l string")
    assert [r[0] for r in df.select(business.standard_store(F.col("l"))).collect()] == [*config.STORE_NAMES.values(), "Loja nova"]


def test_bounded_running_share_equals_window(spark):
    """Any values: ties, zero, negative, zero totals, shares too small to show."""
    import random
    r = random.Random(3)
    rows = []
    for g, pick in (("tail", lambda i: 10**9 if i < 5 else r.randint(0, 30)), ("mixed", lambda i: r.randint(-4000, 9000)), ("none", lambda i: 0),
                    ("cancelled", lambda i: 5000 if i % 2 else -5000), ("below", lambda i: -r.randint(0, 10**6))):
        rows += [(g, dt.date(2025, 1, 1), f"{i:04d}", "t", pick(i) * 1000, pick(i)) for i in range(400)]
    totals = spark.createDataFrame(rows, "grupo string, mes_data date, sku string, titulo string, quantidade_total_vendida long, valor_total_gmv long")
    a, b = (sorted(map(str, pareto.pareto_curves(totals, s).collect())) for s in ("bounded", "window"))
    assert a == b and len(a) == 2000


def test_rows_without_a_share_are_dealt(spark):
    """Of a group with a long tail, a window partition holds the rows with a share only."""
    rows = [("g", dt.date(2025, 1, 1), f"{i:05d}", "t", 10**9 if i < 3 else 1, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "grupo string, mes_data date, sku string, titulo string, v long, w long").withColumn("s", F.when(F.col("v") > 1, 33_333).otherwise(0))
    out = pareto.running_share(df.withColumn("b", F.lit(99_999)), ["grupo"], [F.col("v").desc(), F.col("sku")], "v", "s", "b", "r")
    assert [r.r for r in out.orderBy("sku").limit(4).collect()] == [33_333, 66_666, 99_999, 99_999]
    assert "_spread" in out._jdf.queryExecution().sparkPlan().toString().split("Window [")[1]


def _pages_of(spark, base, days):
    import json
    for day, texts in days.items():
        spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/dia={day}")


def test_window_lists_its_own_folders(spark):
    """Other days are not listed, a missing day has no pages."""
    import time
    base = session.scratch_path(spark, "days")
    page = {"total": 1, "orders": [{"id": "1", "dateCreated": "2025-01-03T10:00:00", "order_items": []}]}
    _pages_of(spark, base, {f"2025-01-{d:02d}": [page] for d in (1, 2, 3, 5)})
    start = time.time()
    pages = order_feed.read_pages(spark, base, dt.date(2025, 1, 3), dt.date(2025, 1, 5))
    assert time.time() - start < 1
    assert sorted(f.split("dia=")[1][:10] for f in pages.inputFiles()) == ["2025-01-03", "2025-01-05"]
    assert sorted(r.dia for r in pages.collect()) == ["2025-01-03", "2025-01-05"]
    assert order_feed.read_pages(spark, base, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).count() == 0
    assert order_feed.feed_rows(order_feed.read_pages(spark, base, dt.date(2024, 1, 1), dt.date(2024, 1, 2))).count() == 0


def test_cut_pages_are_refused_and_not_received(spark):
    import json
    base = session.scratch_path(spark, "cut")
    item = {"unit_price": "1", "quantity": 2, "item": {"seller_custom_field": "s", "title": "t"}}
    order = lambda i, *items: {"id": str(i), "dateCreated": "2025-01-01T10:00:00", "order_items": list(items)}
    whole = {"total": 3, "orders": [order(1, item), order(2, {**item, "quantity": None}, item)]}
    odd = {"total": 3, "orders": [order(3, {**item, "quantity": "many"})]}
    _pages_of(spark, base, {"2025-01-01": [whole, json.dumps(whole)[:40], odd]})
    pages = order_feed.read_pages(spark, base)
    got = sorted((r.motivo, r.linha % 2**33, r.numero_pedido) for r in order_feed.feed_rejects(pages).collect())
    assert [g[0] for g in got] == ["campo_ilegivel", "pagina_ilegivel", "quantidade_nula", "quantidade_nula"][:len(got)]
    day = order_feed.page_completeness(pages, 1).first()
    assert (day.paginas_recebidas, day.paginas_faltantes, day.completo) == (2, 1, False)
    assert {r.quantidade for r in order_feed.feed_rows(pages).where("numero_pedido = '2'").collect()} == {0, 2}


def test_sheet_records_of_another_width(spark):
    base = session.scratch_path(spark, "width")
    head = [k for k, v in config.SHEET_HEADERS.items() if v in ("numero_pedido", "sku")]
    spark.createDataFrame([(",".join(head),), ("a,b",), ("c",), ("d,e,f",)], "value string").coalesce(1).write.text(f"{base}/mes=2025-01")
    import glob
    import os
    for f in glob.glob(f"{base}/mes=2025-01/*.txt"):
        os.link(f, f.replace(".txt", ".csv"))
    bad = {r.texto for r in files.sheet_rejects(spark, base).collect()}
    assert bad == {"c", "d,e,f"}
    assert files.read_sheets(spark, base).count() == 3


def test_markdown_reader_takes_odd_lines(spark):
    base = session.scratch_path(spark, "md")
    text = ["title", "", "| a | b | c | d |", "|:---|---|---|---|", "| 1 | x | | 4 |", "", "| 2 |", "| a | b | c | d |", "| 3 | y | | 5 | 6 |", "no table"]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(base)
    got = sorted(map(tuple, files.read_markdown_table(spark, base).collect()), key=str)
    # the line that equals the header is a record here, so c isn't empty everywhere
    assert got == sorted([("1", "x", "", "4"), ("2", None, None, None), ("a", "b", "c", "d"), ("3", "y", "", "5")], key=str)
    base = session.scratch_path(spark, "md")
    spark.createDataFrame([(t,) for t in text if t != "| a | b | c | d |" or text.index(t) == 2][:7], "value string").coalesce(1).write.text(base)
    assert files.read_markdown_table(spark, base).columns == ["a", "b", "d"]  # P7


def test_hot_order_is_split_over_tasks(spark):
    """An order with a third of all lines; slices add up to its price and none holds most of it."""
    import random
    r = random.Random(6)
    rows = [("hot" if i % 3 == 0 else f"o{i % 500}", f"{r.randint(0, 10**7):07d}", f"r{i}", Decimal(r.randint(0, 9000)) / 1000, r.randint(0, 4)) for i in range(6000)]
    sales = spark.createDataFrame(rows, "numero_pedido string, sku string, rastreio string, valor_unitario_venda decimal(18,3), quantidade long")
    settled = spark.createDataFrame([("hot", Decimal("12345.678"), Decimal(0), Decimal(0)), ("o1", Decimal("0.005"), Decimal(0), Decimal(0))],
                                    "id_pedido string, preco_acordado decimal(18,3), cashback_cupom decimal(18,3), `Comissão` decimal(18,3)")
    got = settlement.apply_settlement(sales, settled, allocate=True)
    assert got.where("numero_pedido = 'hot'").agg(F.sum("valor_total_produto")).first()[0] == Decimal("12345.678")
    assert got.where("numero_pedido = 'o1'").agg(F.sum("valor_total_produto")).first()[0] == Decimal("0.005")
    value = lambda x: int(x[3] * 1000) * x[4]
    hot = sorted((x for x in rows if x[0] == "hot"), key=lambda x: (x[1], x[2]))
    total, run, want = sum(map(value, hot)), 0, {}
    up = lambda v: (12345678 * v * 2 + total) // (2 * total)
    for x in hot:
        want[x[2]] = Decimal(up(run + value(x)) - up(run)) / 1000
        run += value(x)
    assert {x.rastreio: x.valor_total_produto for x in got.where("numero_pedido = 'hot'").collect()} == want
    over = [line for line in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Window [" in line]
    assert sum("_slice" in line.split("windowspecdefinition")[1].split("ASC")[0] for line in over) >= 1


def test_keep_last_of_stored_rows(spark):
    """Same rows as the plain form; keys that occur once are neither sorted nor aggregated."""
    import random
    from salesabc.operators.dedup import keep_last, keep_last_of_stored
    r = random.Random(1)
    path = session.scratch_path(spark, "stored")
    rows = [(f"o{i}" if r.random() < 0.7 else "hot", f"s{r.randint(0, 300)}", i, f"text {i}") for i in range(3000)]
    spark.createDataFrame(rows, "numero_pedido string, sku string, n long, t string").write.parquet(path)
    df = spark.read.parquet(path)
    keys, order = ["numero_pedido", "sku"], F.struct("n")
    a, b = keep_last_of_stored(df, keys, order), keep_last(df, keys, order)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = a._jdf.queryExecution().sparkPlan().toString()
    assert "LeftAnti" in plan and plan.count("SortAggregate(") == 2  # both halves of the aggregate over repeated keys


def test_headers_read_first_blocks_only(spark, monkeypatch):
    """The bytes read for headers don't grow with the files; quoted names may hold separators and line breaks."""
    base = session.scratch_path(spark, "headers")
    import os
    import types
    for month, lines in (("2025-01", 10), ("2025-02", 200_000)):
        os.makedirs(f"{base}/mes={month}")
        with open(f"{base}/mes={month}/a.csv", "w") as f:
            f.write('\ufeffA,"B, ""b""","C\nc"\n' + "1,2,3\n" * lines)
    import pyarrow.fs as pafs
    read = []
    real = pafs.FileSystem.from_uri

    class Counted:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, name):
            source = self.fs.open_input_file(name)

            class Source:
                __enter__ = lambda s: s
                __exit__ = lambda s, *a: source.close()
                size = staticmethod(source.size)
                read_at = staticmethod(lambda n, at: read.append(n) or source.read_at(n, at))
            return Source()

    monkeypatch.setattr(pafs, "FileSystem", types.SimpleNamespace(from_uri=lambda u: (Counted(real(u)[0]), real(u)[1])))
    import pyarrow as pa
    paths = pa.RecordBatch.from_arrays([pa.array([f"file://{base}/mes={m}/a.csv" for m in ("2025-01", "2025-02")])], ["file"])
    got = next(iter(files._read_headers(",")([paths])))
    monkeypatch.undo()
    assert got.column(2).to_pylist() == [["A", 'B, "b"', "C\nc"]] * 2
    assert len(read) == 2 and max(read) <= files.HEADER_BLOCK
    found = files.csv_headers(spark, base, F.col("mes") == "2025-02").collect()
    assert [r.names for r in found] == [["A", 'B, "b"', "C\nc"]] and "2025-02" in found[0].file
    rows = files.read_csv_by_header(spark, base, {'B, "b"': "b", "C\nc": "c"}, files.csv_headers(spark, base, F.lit(True)), ["mes"], F.lit(True))
    assert rows.count() == 200_010 and rows.select("b", "c").distinct().collect() == [("2", "3")]
    monkeypatch.setattr(files, "_opens_in_tasks", lambda *a: False)
    assert len(files.csv_headers(spark, base, F.lit(True)).collect()) == 2
