"""The pipeline against a plain version, stage by stage, and on awkward documents."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesabc.llm import toxicity
from salesabc.llm.common import written

from .test_decontam import brute as brute_leaks
from .test_decontam import plain
from .test_line_dedup import brute as brute_lines
from .test_packing import check as check_packing
from .test_packing import tokenizer  # noqa: F401
from .test_simhash_dup import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"


def test_order_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_run_equals_plain_version(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"), learn).collect()}
    rows = [r for r in rows if scores[r[0]] < corpus_pipeline.TOXIC]
    rows = sorted((k, t) for k, t, _ in brute_lines(rows))
    groups = brute_groups([brute_fp(t) for _, t in rows], 4)
    rows = [r for i, r in enumerate(rows) if groups[i] == i]  # sorted by id, so the first of a group has its least id
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {}
    for item, t in items:
        w = plain(t)
        for j in range(len(w) - 4):
            grams.setdefault(tuple(w[j:j + 5]), set()).add(item)
    left = []
    for key, text in rows:
        d = plain(text)
        near = set().union(*(grams.get(tuple(d[j:j + 5]), set()) for j in range(len(d) - 4)), set())
        if not near or not brute_leaks([(key, text)], [x for x in items if x[0] in near]):
            left.append((key, text))
    check_packing(corpus_pipeline.run(spark, SF).collect(), left, tokenizer)


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_documents(spark, awkward, nothing, empty):
    docs = nothing if empty else awkward.unionByName(awkward.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, SF), "test-stage")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
            docs = out
    assert out.where("offset is null").count() == 0 and (out.count() == 0) == empty


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (4, None), (5, ""), (9, "q r s t u v w x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert got == [2, 4, 9]


def test_library_runs_without_this_subpackage(tmp_path):
    """__spark_entry__ imports and lists the library's own queries when the llm folders and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{repo}/salesabc", tmp_path / "salesabc", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') or k == 'pipeline' for k in e.queries() if k[2:3].isdigit() or k == 'pipeline'))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode == 0 and said.stdout.split()[-1] == "False", said.stderr[-500:]


def test_all_eleven_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
