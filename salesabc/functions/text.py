"""Text column expressions (all JVM-side)."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesabc import config

# The characters Python's str.strip() removes: ASCII and Unicode white space.
_WS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` only drops spaces)."""
    return F.trim(c, F.lit(_WS))


def clean_text(c: Column) -> Column:
    """Trimmed text with null as '' (never the words nan/None)."""
    return F.coalesce(strip(c), F.lit(""))


@functools.cache
def _ascii_folds() -> dict[str, str]:
    """Code point -> ASCII text under NFKD, for all that keep at least one ASCII character; built by rule."""
    folds = {}
    for cp in range(0x80, 0x30000):
        if not 0xD800 <= cp <= 0xDFFF:
            folded = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode()
            if folded:
                folds[chr(cp)] = folded
    return folds


def ascii_fold(c: Column) -> Column:
    """NFKD, drop what is not ASCII, then strip.

    One-to-one folds (accented letters and the like) are one ``translate``;
    the few characters that become several (ligatures, fractions) go through
    a literal map, and only texts that hold one of them.  ASCII texts skip
    both.
    """
    folds = _ascii_folds()
    single = {k: v for k, v in folds.items() if len(v) == 1}
    several = {k: v for k, v in folds.items() if len(v) > 1}
    spread = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02"))
    wide = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.element_at(spread, ch), ch)), "")
    c1 = F.when(c.rlike("[" + "".join(several) + "]"), wide).otherwise(c)
    folded = F.regexp_replace(F.translate(c1, "".join(single), "".join(single.values())), r"[^\x00-\x7F]", "")
    return strip(F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c))


def markdown_cell(c: Column) -> Column:
    """Line breaks to spaces and '|' to '-', so a value fits one table cell."""
    return F.translate(c, "\n\r|", "  -")


def table_slug(c: Column) -> Column:
    """Store/group name -> table suffix.

    Lower case; ' ', '-', '/' become '_'; '.' is removed; one pass of
    '__' -> '_'; then at most one '_' is cut from the end and one from the
    start.
    """
    s = F.lower(c)
    s = F.replace(s, F.lit(" "), F.lit("_"))
    s = F.replace(s, F.lit("-"), F.lit("_"))
    s = F.replace(s, F.lit("."), F.lit(""))
    s = F.replace(s, F.lit("/"), F.lit("_"))
    s = F.replace(s, F.lit("__"), F.lit("_"))
    s = F.regexp_replace(s, "_$", "")
    s = F.regexp_replace(s, "^_", "")
    return s


def pareto_table_name(group: Column) -> Column:
    return F.concat(F.lit(config.PARETO_TABLE_PREFIX + "_"), table_slug(group))
