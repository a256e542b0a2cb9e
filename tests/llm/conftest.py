import random

import pytest

#: Names that the operators use for columns of their own.
CLASHES = ["id", "key", "piece", "start", "length", "fp", "bucket", "score", "digest", "line", "words", "found", "hits", "label", "payload", "uri", "cell", "kind", "first", "tail", "_text", "_learn", "count", "n"]


def prose(r, n):
    return " ".join("".join(r.choices(["ta", "ri", "mo", "né", "lu", "sk", "and", "the"], k=r.randint(1, 3))) for _ in range(n))


def awkward_rows():
    """(doc_id, text): nulls, blanks, very long texts, repeated rows, equal and similar texts."""
    r = random.Random(5)
    base = [prose(r, r.randint(1, 120)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, "  \t\n"), (103, "one"), (104, "\n\n\n"), (105, prose(r, 30_000)), (106, "x" * 200_000), (107, "A.\nB.\n" * 400)]
    rows += [(110, base[3]), (111, base[3]), (112, base[4] + " end"), (113, "tail " + base[5]), (120, base[6]), (120, base[6]), (121, "same id a"), (121, "same id b")]
    rows += [(130, "日本語 テキスト 𝄞 é"), (131, " nbsp only ")]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above with clashing extra columns, over several partitions."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3, "doc_id", "text")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("doc_id < -1")
