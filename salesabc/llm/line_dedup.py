"""Line de-duplication by winnowing over line hashes, in DataFrame functions alone.

A window is a run of lines with at least ``threshold`` characters that holds
no shorter such run.  Every window selects its least line hash, the leftmost
of equal ones; neighbouring windows mostly select the same line, so the
selected places are the sparse fingerprints of a text.  Any repeated run of
``threshold`` characters holds a whole window, which selects the same line in
every copy, so none is missed.

Fingerprints are joined on their hash, and only places whose hash stands
elsewhere too are extended: line by line to the right and to the left of
their window, as far as no other window fits in (that one extends itself).
A match is extended by groups, not by pairs of places: all places with equal
extended lines meet at the earliest of them, so a frequent line gives no
pairs, and the earliest copy of a long run may be another than that of its
window.  Later runs are deleted, the earliest stays.

So a line goes exactly if it lies in a run of at least ``threshold``
characters (each line counted with its break) that occurs at an earlier
place; places are ordered by document id, then line.

Lines are compared trimmed of spaces and in lower case.  Defined cases: a null
text stays null; an empty text is one empty line; texts below the threshold
stay whole; rows with equal id and text share their places, so they don't
delete each other; a null id ranks first; an empty table stays empty; other
columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

THRESHOLD = 20


def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """(id, tk, first, size, lead, around, mark, at): every window with its selected line.

    ``around`` holds the line hashes of the window (``size`` from index
    ``lead`` on) and of the lines that it may be extended by.  ``mark`` is the
    selected hash and ``at`` its line.  ``tk`` tells texts under the same id
    apart.  Frames hold at most ``threshold`` lines, as each line counts at
    least one character.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = texts.select("id", F.xxhash64("text").alias("tk"), F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    hashed = lines.select("id", "tk", "line", F.xxhash64(_normal(F.col("text"))).alias("h"), (F.length(_normal(F.col("text"))) + 1).cast("long").alias("chars"))
    hashed = hashed.groupBy("id", "tk", "line").agg(F.first("h").alias("h"), F.first("chars").alias("chars"))  # equal rows share places
    doc = Window.partitionBy("id", "tk")
    placed = hashed.withColumn("upto", F.sum("chars").over(doc.orderBy("line"))).withColumn("before", F.col("upto") - F.col("chars"))
    # From a window's first line to where the lines behind that one would make a window of their own ...
    reach = doc.orderBy("upto").rangeBetween(0, threshold - 1)
    # ... likewise back from a window's last line, and the window itself.
    back = doc.orderBy("before").rangeBetween(-(threshold - 1), 0)
    ahead = doc.orderBy("before").rangeBetween(0, threshold - 1)
    near = placed.withColumn("right", F.collect_list("h").over(reach)).withColumn("left", F.collect_list("h").over(back))
    both = near.select("id", "tk", "line", "chars", "right", F.last("left").over(ahead).alias("left"),
                       F.sum("chars").over(ahead).alias("total"), F.count("h").over(ahead).cast("int").alias("size"))
    own = both.where((F.col("total") >= threshold) & (F.col("total") - F.col("chars") < threshold))
    lead = F.size("left") - F.col("size")
    core = F.slice("right", F.lit(1), F.col("size"))
    found = own.select("id", "tk", F.col("line").alias("first"), "size", lead.alias("lead"),
                       F.concat(F.slice("left", F.lit(1), lead), "right").alias("around"), core.alias("core"), F.array_min(core).alias("mark"))
    return found.withColumn("at", (F.col("first") + F.array_position("core", F.col("mark")) - 1).cast("int")).drop("core")


def _extents(found: DataFrame) -> DataFrame:
    """(id, tk, first, last, gram): each window, and it with one more line at a time on either side."""
    lead, size, n = F.col("lead"), F.col("size"), F.size("around")
    right = F.transform(F.sequence(lead + size, n), lambda end: F.struct(lead.alias("a"), end.alias("b")))
    left = F.when(lead > 0, F.transform(F.sequence(F.lit(0), lead - 1), lambda start: F.struct(start.alias("a"), (lead + size).alias("b")))).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
    one = found.select("id", "tk", "first", "lead", "around", F.explode(F.concat(right, left)).alias("e"))
    length = F.col("e.b") - F.col("e.a")
    start = F.col("first") - F.col("lead") + F.col("e.a")
    return one.select("id", "tk", start.alias("first"), (start + length - 1).alias("last"), F.xxhash64(F.slice("around", F.col("e.a") + 1, length), length).alias("gram"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(id, tk, line) of every line to delete."""
    found = written(fingerprints(docs, id_col, text_col, threshold), "line-fingerprints")
    # Selected hashes at more than one place; combined before the shuffle.
    at = F.struct("id", "tk", "at")
    marks = written(found.groupBy(F.col("mark").alias("_mark")).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo < hi").select("_mark"), "line-marks")
    extents = written(_extents(found.join(marks, F.col("mark") == F.col("_mark"), "left_semi")), "line-extents")
    # Runs that agree in all their lines meet at the earliest of them.
    place = F.struct("id", "tk", "first")
    earliest = written(extents.groupBy(F.col("gram").alias("_gram")).agg(F.min(place).alias("_kept"), F.max(place).alias("_last")).where("_kept < _last").select("_gram", "_kept"), "line-grams")
    later = extents.join(earliest, F.col("gram") == F.col("_gram")).where(place > F.col("_kept"))
    return later.select("id", "tk", F.explode(F.sequence("first", "last")).alias("line")).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, count_col: str = "removed_lines") -> DataFrame:
    """The documents with later repeated runs of lines deleted, and their number in ``count_col``.

    All columns are kept; a column of that name is replaced.
    """
    lines = repeated_lines(docs, id_col, text_col, threshold)
    per_doc = lines.groupBy(F.col("id").alias("__id"), F.col("tk").alias("__tk")).agg(F.collect_list("line").alias("__gone"))
    own = docs.join(per_doc, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__tk")), "left")
    cut = F.split(F.col(text_col), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("__cut"), i)), "\n"))
    names = [c for c in docs.columns if c != count_col]
    out = own.withColumn("__cut", F.when(F.col("__gone").isNotNull(), cut)).withColumn(text_col, text)
    return out.select(*names, F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).alias(count_col))


#: The same rows by comparing line texts themselves (DuckDB).
ORACLE = f"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
cut AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM docs),
lines AS (SELECT doc_id, text, line, no, lower(trim(line, ' ')) AS norm, length(lower(trim(line, ' '))) + 1 AS size FROM cut),
runs AS (
  SELECT a.doc_id, a.text, a.no AS s, b.no AS e, string_agg(b2.norm, chr(10) ORDER BY b2.no) AS gram, sum(b2.size) AS size, any_value(a.size) AS head, any_value(b.size) AS tail
  FROM lines a JOIN lines b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.text = b.text AND b.no BETWEEN a.no AND a.no + {THRESHOLD}
  JOIN lines b2 ON a.doc_id IS NOT DISTINCT FROM b2.doc_id AND a.text = b2.text AND b2.no BETWEEN a.no AND b.no
  GROUP BY a.doc_id, a.text, a.no, b.no),
wins AS (SELECT * FROM runs WHERE size >= {THRESHOLD} AND (size - tail < {THRESHOLD} OR size - head < {THRESHOLD})),
ranked AS (SELECT *, row_number() OVER (PARTITION BY gram, e - s ORDER BY doc_id NULLS FIRST, s) AS k FROM (SELECT DISTINCT doc_id, text, s, e, gram FROM wins)),
gone AS (SELECT DISTINCT l.doc_id, l.text, l.no FROM ranked r JOIN lines l ON r.doc_id IS NOT DISTINCT FROM l.doc_id AND r.text = l.text AND l.no BETWEEN r.s AND r.e WHERE r.k > 1),
clean AS (
  SELECT l.doc_id, l.text, coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL), '') AS kept, count(g.no) AS removed_lines
  FROM lines l LEFT JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.text = g.text AND l.no = g.no GROUP BY l.doc_id, l.text)
SELECT d.doc_id, c.kept AS text, coalesce(c.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN clean c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text = c.text
"""
