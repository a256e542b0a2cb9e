"""Repeated-unit removal: hash normalised units, keep the earliest occurrence, cut out the others.

A unit is a line, a paragraph (lines up to a blank one) or a sentence of a
line.  It is normalised to its lower-case words without punctuation and
hashed to 128 bits.  Digests are grouped over all documents with their
earliest place (combined before the shuffle); units of repeated digests that
stand elsewhere are removed.  Places are code point offsets in the original
text.

The unit "passage" takes all of them together: paragraphs, lines, and runs of
sentences, which are the shortest with ``min_words`` words from every sentence
onwards and back, over line breaks too.  So any row of whole sentences with
that many words in all goes if it stands earlier, short sentences with their
neighbours.  A unit that overlaps the place that is kept stays.  Spans of a
passage overlap, as each of its runs is a unit.

How many words make a true repeat is the caller's choice.  Sentences and lines
of five words also repeat by chance or are phrases that everybody writes;
from ``PASSAGE_WORDS`` on almost only copied passages repeat.

Defined cases: units with fewer than ``min_words`` words stay; a null or empty
text has no units; documents are ranked by ``rank`` columns, then id, then
text hash; a null ranks first; rows with the same rank, id and text are the
same document, so equal rows don't remove each other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_array, written

MIN_WORDS = 5
#: Words of a copied passage, for callers who leave chance repeats of short lines and sentences alone.
PASSAGE_WORDS = 20
UNITS = {
    "line": r"[^\n]+",
    "paragraph": r"(?:[^\n]*\S[^\n]*(?:\n|$))+",
    "sentence": r"[^.!?\n]+[.!?]*",
}


def _single(cutter: re.Pattern, words: re.Pattern, text: str, min_words: int):
    """(start, end, words) of every match of one unit."""
    for m in cutter.finditer(text):
        own = words.findall(m.group().lower())
        if len(own) >= min_words:
            yield m.start(), m.end(), own


def _passages(cutter: re.Pattern, words: re.Pattern, text: str, min_words: int):
    """(start, end, words) of paragraphs, lines and runs of sentences; a line that is one sentence is not given twice."""
    cut = [(m.start(), m.end(), own) for m in cutter.finditer(text) if (own := words.findall(m.group().lower()))]
    joined = [w for _, _, own in cut for w in own]
    upto = [0]  # words before each sentence
    for _, _, own in cut:
        upto.append(upto[-1] + len(own))
    n, at, low, high = len(cut), 0, 0, 0
    top = first = None  # where the paragraph begins: offset, sentence
    lines = end = 0
    for line in [*text.split("\n"), ""]:  # the last blank line ends the last paragraph
        size, begin = len(line), high
        while high < n and cut[high][0] < at + size:
            high += 1
        if upto[high] - upto[begin] >= min_words and (high - begin > 1 or cut[begin][:2] != (at, at + size)):
            yield at, at + size, joined[upto[begin]:upto[high]]
        if line.strip():
            if top is None:
                top, first, lines = at, begin, 0
            lines, end = lines + 1, at + size
        elif top is not None:
            if lines > 1 and upto[high] - upto[first] >= min_words:
                yield top, end, joined[upto[first]:upto[high]]
            top = None
        at += size + 1
    runs, high = set(), 0
    for low in range(n):  # onwards
        while high <= n and upto[min(high, n)] - upto[low] < min_words:
            high += 1
        if high > n:
            break
        runs.add((low, high))
    low = 0
    for high in range(1, n + 1):  # back
        while upto[high] - upto[low + 1] >= min_words:
            low += 1
        if upto[high] - upto[low] >= min_words:
            runs.add((low, high))
    for low, high in runs:
        yield cut[low][0], cut[high - 1][1], joined[upto[low]:upto[high]]


def _text_key(text_col: str) -> Column:
    """Tells texts under the same id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = MIN_WORDS,
          rank: list[str] | None = None) -> DataFrame:
    """(rank columns, id, text_key, start, end, words, digest) of every unit of at least ``min_words`` words."""
    keys = [*(rank or []), id_col]
    cut, word = UNITS["sentence" if unit == "passage" else unit], r"[^\W_]+"
    find = _passages if unit == "passage" else _single

    def run(batches):
        import xxhash

        cutter, words = re.compile(cut), re.compile(word)
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows: list[tuple] = []

            def flush():
                row, start, end, size, sums = zip(*rows)
                at = pa.array(row, pa.int64())
                return pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(keys) + 1)), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(size, pa.int32()), pa.array(sums, pa.binary())],
                                                  [*keys, "text_key", "start", "end", "words", "digest"])

            for i, text in enumerate(text_array(batch.column(len(keys) + 1))):
                for start, end, own in find(cutter, words, text.as_py(), min_words):
                    rows.append((i, start, end, len(own), digest(" ".join(own))))
                if len(rows) >= 20_000:
                    yield flush()
                    rows.clear()
            if rows:
                yield flush()

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    own = docs.select(*keys, _text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("_text"))
    return own.mapInArrow(run, f"{kinds}, text_key long, start long, end long, words int, digest binary")


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = MIN_WORDS,
                   rank: list[str] | None = None) -> DataFrame:
    """The units to remove: rank columns, id, text_key, start, end, words, digest, and the id and start of the occurrence that is kept.

    Only digests that repeat are written and joined to the units, which are
    cut a second time from the texts rather than stored; Spark broadcasts them
    if they are under the session's threshold and splits hot digests if not.
    """
    keys = [*(rank or []), id_col]
    found = units(docs, id_col, text_col, unit, min_words, rank)
    place = F.struct(*keys, "text_key", "start", "end")

    def after(p, kept):
        """In a later document, or behind the kept place in its own."""
        doc = lambda x: F.struct(*(x[k] for k in [*keys, "text_key"]))
        return (doc(p) > doc(kept)) | ((doc(p) == doc(kept)) & (p["start"] >= kept["end"]))

    repeats = written(found.groupBy("digest").agg(F.min(place).alias("_kept"), F.max(place).alias("_last")).where(after(F.col("_last"), F.col("_kept"))).select(F.col("digest").alias("_digest"), "_kept"), "repeated-units")
    return (found.join(repeats, F.col("digest") == F.col("_digest")).where(after(place, F.col("_kept")))
            .select(*keys, "text_key", "start", "end", "words", F.lower(F.hex("digest")).alias("digest"),
                    F.col("_kept")[id_col].alias("kept_id"), F.col("_kept")["start"].alias("kept_start")))


def remove_units(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: list[str] | None = None,
                 spans_col: str | None = None) -> DataFrame:
    """Documents without the given spans, with ``kept_spans``: start and end in the original text of each part that stays.

    ``removed`` is as ``repeated_units`` gives it, with the same ``rank``.  A
    span belongs to rows with its rank, id and text hash.  Spans inside others
    are left out; ``spans_col`` names a column for the others, with the place
    that is kept.
    """
    keys = [*(rank or []), id_col]
    own = [f"_key{i}" for i in range(len(keys))]
    doc = Window.partitionBy(*own, "_tk")
    before = doc.orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    named = removed.select(*(F.col(k).alias(o) for k, o in zip(keys, own)), F.col("text_key").alias("_tk"), "start", "end", "words", "kept_id", "kept_start")
    outer = named.withColumn("_upto", F.max("end").over(before)).where("_upto is null or end > _upto")
    spans = outer.groupBy(*own, "_tk").agg(F.array_sort(F.collect_list(F.struct("start", "end", "words", F.col("kept_id").alias(f"kept_{id_col}"), "kept_start"))).alias("_spans"))
    size = F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    cuts = F.coalesce(F.col("_spans"), F.array().cast(spans.schema["_spans"].dataType))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(size))
    kept = F.filter(F.transform(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), lambda s: s["end"] > s["start"])
    text = F.array_join(F.transform(F.col("kept_spans"), lambda s: F.substring(F.col(text_col), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))), "")
    same = _text_key(text_col) == F.col("_tk")
    for k, o in zip(keys, own):
        same = same & F.col(k).eqNullSafe(F.col(o))
    out = docs.join(spans, same, "left").withColumn("kept_spans", kept).withColumn("_text", F.when(F.col(text_col).isNotNull(), text))
    return out.select(*(F.col("_text").alias(c) if c == text_col else F.col(c) for c in docs.columns), "kept_spans", *([cuts.alias(spans_col)] if spans_col else []))
