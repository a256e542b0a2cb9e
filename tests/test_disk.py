"""What a run leaves on disk, and what it makes once, on rows of the tests' own."""

import datetime as dt
import glob
import os
import time
from contextlib import ExitStack

import pytest
from pyspark.sql import functions as F

from salesabc import config, session
from salesabc.operators import pareto
from salesabc.plans import jobs, sales_run
from salesabc.plans import registry as R
from salesabc.sinks import published, writers
from salesabc.sources import files

from .conftest import SF_SMALL

DAY = dt.date(1998, 3, 2)


def _scratch(spark):
    return set(glob.glob(os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "scratch", "*")))


def _shuffles(spark):
    tracker = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    return {str(f) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.getAllFiles()) if "shuffle_" in str(f)}


def _lines(spark, rows):
    return spark.createDataFrame(rows, "numero_pedido string, sku string, titulo string, loja string, quantidade long, valor_unitario_venda double, data_do_pedido date").select(
        "*", F.lit(0).cast("decimal(18,3)").alias("valor_total_produto"), *[F.lit("").alias(c) for c in ("numero_pedido_erp", "numero_carrinho", "id_canal_marketplace", "rastreio", "status", "tipo_logistica")],
        F.monotonically_increasing_id().alias("sheet_order"))


@pytest.fixture
def inputs(spark):
    rows = [("1", "a", "t", "X", 1, 2.0, DAY), (" 1", "a", "u", "X", 3, 2.0, DAY), ("2", "b", None, "X", 1, 5.0, DAY), (None, None, "n", None, 1, 1.0, None), ("2", "c", "w", "X", 1, 5.0, dt.date(1998, 2, 1))]
    catalog = spark.createDataFrame([("a", 1.5, 7, "A", "f", "g", "s", "v"), ("b", 2.0, 1, "B", None, "g", "s", "v")],
                                    "sku string, custo_unitario double, Estq long, titulo_bling string, Fornecedores string, Categoria string, Subcategoria string, tipo_de_venda string")
    settled = spark.createDataFrame([("2", 9.0, 1.0, 2.0)], "id_pedido string, preco_acordado double, cashback_cupom double, `Comissão` double")
    money = lambda df, *cols: df.withColumns({c: F.col(f"`{c}`").cast(config.MONEY) for c in cols})
    return sales_run.RunInputs(closed_sheets=_lines(spark, rows), catalog=money(catalog, "custo_unitario"), settlement=money(settled, "preco_acordado", "cashback_cupom", "Comissão"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    df = spark.range(5000).groupBy((F.col("id") % 100).alias("numero_pedido")).count().withColumn("mes", F.lit("m"))
    before = spark.conf.get(session.FREE_SHUFFLES, "false")
    for write in (lambda: published.publish(df.hint("rebalance", "mes"), f"{tmp_path}/t", ("mes",)), lambda: session.written(df, "x"), lambda: writers.write_markdown(df, f"{tmp_path}/m")):
        here = _shuffles(spark)
        write()
        until = time.time() + 20  # they go in the background
        while not _shuffles(spark) <= here and time.time() < until:
            time.sleep(0.1)
        assert _shuffles(spark) <= here and spark.conf.get(session.FREE_SHUFFLES, "false") == before


@pytest.mark.parametrize("prices", [True, False])
def test_stored_run_equals_the_lazy_one_and_its_tables_go(spark, inputs, prices):
    lazy = sales_run.run_sales(inputs, DAY, R.PROFILE).fact
    before = _scratch(spark)
    with ExitStack() as scratch:
        fact = sales_run.stored_run(inputs, DAY, R.PROFILE, prices=prices, scratch=scratch).fact
        assert fact.columns == lazy.columns and sorted(map(str, fact.collect())) == sorted(map(str, lazy.collect())) and fact.count() == 4
        kept = {os.path.basename(p).rpartition("-")[0] for p in _scratch(spark) - before}
        assert kept - {"repeated"} == ({"catalog", "paid-lines"} if prices else {"catalog", "settlement", "lines"})
    assert {os.path.basename(p).rpartition("-")[0] for p in _scratch(spark) - before} <= {"repeated"}


def test_lines_are_joined_to_one_table_in_a_step(spark, inputs):
    """Priced lines are read from where they were stored, so the catalogue's join is the only one left."""
    plan = sales_run.stored_run(inputs, DAY, R.PROFILE).fact._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Aggregate" not in plan and "feed_order" not in plan


def test_a_failed_write_drops_its_scratch(spark):
    before = _scratch(spark)
    with pytest.raises(Exception, match="lost"), ExitStack() as scratch:
        session.written(spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("x")), "failing", scratch)
    assert _scratch(spark) == before


def test_only_the_last_slices_stay(spark):
    sales = spark.createDataFrame([("X - 1", "a", "t", 3, 9.0, DAY), ("X - 1", "b", "t", 1, 1.0, DAY), ("X - 2", "a", None, 2, -4.0, DAY)],
                                  "loja string, sku string, titulo string, quantidade long, valor_total_produto double, data_do_pedido date").withColumn("valor_total_produto", F.col("valor_total_produto").cast("decimal(18,3)"))
    before = _scratch(spark)
    curves = pareto.pareto_abc(sales, strategy="range")
    assert [os.path.basename(p).split("-")[0] for p in _scratch(spark) - before] == ["slices"]
    assert sorted(map(str, curves.collect())) == sorted(map(str, pareto.pareto_abc(sales).collect())) != []


def test_curves_of_some_months_are_made_of_their_lines_only(spark, tmp_path):
    fact = spark.createDataFrame([("X", "a", "t", 3, DAY), ("X", "b", "t", 1, dt.date(1998, 2, 1)), ("X", "b", "t", 1, None)], "loja string, sku string, titulo string, quantidade long, data_do_pedido date").withColumn("valor_total_produto", F.lit(1).cast("decimal(18,3)"))
    jobs.pareto_job(fact, f"{tmp_path}/p")
    lost = fact.withColumn("quantidade", F.when(F.col("sku") == "b", F.raise_error(F.lit("read"))).otherwise(F.lit(9)).cast("long"))
    jobs.pareto_job(lost, f"{tmp_path}/p", ["1998-03"])
    got = {(r.mes, r.sku, r.quantidade_total_vendida) for r in writers.read_table(spark, f"{tmp_path}/p").collect()}
    assert got == {("1998-03", "a", "9.000"), ("1998-02", "b", "1.000")}


def test_catalogue_and_reports_land_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("1", "p;q", 2)], "Codigo string, Produto string, Quantidade long")
    writers.write_catalog_csv(rows, f"{tmp_path}/c")
    from salesabc.sources.catalog_sources import read_catalog_csv
    assert all(f.endswith(".csv.gz") for f in glob.glob(f"{tmp_path}/c/part-*")) and read_catalog_csv(spark, f"{tmp_path}/c").count() == 1
    report = spark.createDataFrame([("A", "1", "1", "1", "1", "1", "1"), ("Z", "1", "1", "1", "1", "1", "2")], "arquivo string, id_pedido string, moedas string, cupom string, taxa_comissao string, taxa_servico string, preco_acordado string")
    files.write_settlement_reports(report, f"{tmp_path}/s")
    found = glob.glob(f"{tmp_path}/s/*/part-*")
    assert len(found) == 2 and all(f.endswith(".csv.gz") for f in found)
    assert sorted(r.preco_acordado for r in files.read_settlement_reports(spark, f"{tmp_path}/s").collect()) == ["1", "2"]


def test_refresh_makes_its_lookup_tables_once(spark, monkeypatch):
    """They are compared with those of before in both directions, joined and published."""
    landed, out, seen = R.land_inputs(spark, SF_SMALL), session.scratch_path(spark, "refresh-once"), []
    jobs.sales_job(spark, landed, out, dt.date(1998, 3, 10), R.PROFILE, markdown=False)
    changed = jobs._changed

    def watched(new, *rest):
        seen.extend(new.inputFiles())
        return changed(new, *rest)

    monkeypatch.setattr(jobs, "_changed", watched)
    jobs.refresh_job(spark, landed, out, dt.date(1998, 3, 11), R.PROFILE)
    assert seen and all(f.endswith(".parquet") for f in seen)
