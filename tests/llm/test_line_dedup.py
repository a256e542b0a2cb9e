"""Line de-duplication against a plain version and against its SQL."""

import duckdb
from pyspark.sql import functions as F

from salesabc.llm import line_dedup


def brute(rows, threshold=line_dedup.THRESHOLD):
    """(id, text) in any order -> cleaned rows, by trying every run of lines."""
    docs = sorted({(k, t) for k, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = {d: [x.strip(" ").lower() for x in d[1].split("\n")] for d in docs}
    first, gone = {}, {d: set() for d in docs}
    for d in docs:
        own = lines[d]
        for s in range(len(own)):
            size = 0
            for e in range(s, len(own)):
                size += len(own[e]) + 1
                if size >= threshold:
                    run = tuple(own[s:e + 1])
                    if first.setdefault(run, (d, s)) != (d, s):
                        gone[d].update(range(s, e + 1))
                    if e - s > threshold:  # longer runs add nothing that their parts don't have
                        break
    out = []
    for k, t in rows:
        if t is None:
            out.append((k, None, 0))
        else:
            cut = t.split("\n")
            out.append((k, "\n".join(x for i, x in enumerate(cut) if i not in gone[k, t]), len(gone[k, t])))
    return sorted(out, key=str)


def cases():
    long = "this line is long enough alone"
    return [(1, f"a\nb\n{long}\nc\nd"), (2, f"x\nb\n{long} \nc\ny"), (3, f"{long.upper()}"), (4, "ab\ncd\nef\ngh\nij\nkl\nmn"), (5, "zz\nab\ncd\nef\ngh\nij\nkl\nmn\nzz"), (6, "ab\ncd"), (7, None), (8, ""),
            (9, "\n" * 30), (10, "\n" * 45), (11, f"{long}\n{long}\n{long}"), (12, f"a\nb\n{long}\nc\nd"), (12, f"a\nb\n{long}\nc\nd"), (None, "only here, a line of its own"), (13, "only here, a line of its own\nnew"), (14, "q" * 100_000 + "\nshort"),
            (15, "É" * 30), (16, "é" * 30)]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(cases(), "doc_id long, text string")
    for name in ("line", "id", "tk", "gram", "mark", "first", "last", "h", "at", "around", "lead", "size", "left", "right"):
        df = df.withColumn(name, F.lit("clash"))
    out = line_dedup.dedup_lines(df.repartition(3, "doc_id"))
    assert out.columns == [*df.columns, "removed_lines"]
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out.collect()), key=str) == brute(cases())


def test_fingerprints_are_window_minima(spark):
    """Every window of 20 characters selects one line; a repeated run selects the same lines in each copy."""
    text = "\n".join("abcdefg"[i % 7] * (1 + i * i % 9) for i in range(300))
    df = spark.createDataFrame([(1, text), (2, "other words\n" + text), (3, "short")], "doc_id long, text string")
    rows = line_dedup.fingerprints(df, "doc_id", "text", line_dedup.THRESHOLD).collect()
    size = [len(x) + 1 for x in text.split("\n")]
    want = {(s, e) for s in range(300) for e in range(s, 300) if sum(size[s:e + 1]) >= 20 and sum(size[s + 1:e + 1]) < 20 and sum(size[s:e]) < 20}
    assert {(r["first"], r["first"] + r["size"] - 1) for r in rows if r["id"] == 1} == want
    for r in rows:
        core = r["around"][r["lead"]:r["lead"] + r["size"]]
        assert r["mark"] == min(core) and r["at"] == r["first"] + core.index(min(core))
    chosen = {k: {r["at"] for r in rows if r["id"] == k} for k in (1, 2, 3)}
    assert {a + 1 for a in chosen[1]} <= chosen[2] and not chosen[3] and len(chosen[1]) < 0.6 * 300


def test_earliest_of_a_run_and_of_its_window_differ(spark):
    """The window is first met without the line behind it; that line goes with the earliest run that holds both."""
    long = "this line is long enough alone"
    rows = [(1, f"{long}\ny"), (2, f"q\n{long}\nx"), (3, f"{long}\nx\nz"), (4, f"q\n{long}\ny")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, f"{long}\ny"), (2, "q\nx"), (3, "z"), (4, "")]
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out.collect()), key=str) == brute(rows)


def test_native_plan(spark):
    plan = line_dedup.dedup_lines(spark.createDataFrame(cases(), "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_awkward_documents(awkward, nothing):
    got = sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in line_dedup.dedup_lines(awkward).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_query_equals_sql(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES["op7_line_dedup"](spark, sf)
    want = con.sql(line_dedup.ORACLE)
    assert sorted(df.columns) == sorted(want.columns)
    names = ["doc_id", "text", "removed_lines"]
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(want.project(", ".join(names)).fetchall())
