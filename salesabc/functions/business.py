"""Business-rule columns: names, statuses, logistics class, revenue, groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesabc import config
from salesabc.config import Profile
from salesabc.functions.numeric import times_qty
from salesabc.functions.text import strip


def _map_literal(mapping: dict[str, str]) -> Column:
    keys = list(mapping)
    return F.map_from_arrays(F.lit(keys), F.lit([mapping[k] for k in keys]))


def lookup_or_keep(c: Column, mapping: dict[str, str]) -> Column:
    """Replace by a fixed mapping; unmapped values pass through.

    The mapping is a literal map of a few dozen entries (constant-folded)
    that is searched inside the generated code; no join and no shuffle.
    """
    if not mapping:
        return c
    return F.coalesce(F.element_at(_map_literal(mapping), c), c)


def standard_store(loja: Column, profile: Profile = config.DEFAULT_PROFILE) -> Column:
    mapping = {**config.STORE_NAMES, **profile.extra_store_names}
    return lookup_or_keep(F.coalesce(strip(loja), F.lit("")), mapping)


def standard_status(status: Column) -> Column:
    return lookup_or_keep(F.coalesce(strip(status), F.lit("")), config.STATUS_LABELS)


def logistics_class(loja: Column, raw: Column, profile: Profile = config.DEFAULT_PROFILE) -> Column:
    """One CASE, highest priority first (raw top types, store prefix, raw low types)."""
    r = F.coalesce(strip(raw), F.lit(""))
    expr = None
    for value, label in config.LOGISTICS_TOP_RAW:
        cond = r == value
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    for m in sorted(profile.marketplaces, key=lambda m: -m.priority):
        expr = expr.when(loja.startswith(m.prefix), m.logistics_class)
    for value, label in config.LOGISTICS_LOW_RAW:
        expr = expr.when(r == value, label)
    return expr.otherwise(config.LOGISTICS_DEFAULT)


def starts_with_any(loja: Column, prefixes: list[str]) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.coalesce(loja.startswith(p), F.lit(False))
    return cond


def marketplace_revenue(loja: Column, unit: Column, qty: Column, total: Column,
                        profile: Profile = config.DEFAULT_PROFILE) -> Column:
    """Recomputed line revenue for marketplaces that report unit prices."""
    cond = starts_with_any(loja, profile.recompute_prefixes) & (qty > 0)
    return F.when(cond, times_qty(unit, qty)).otherwise(total)


def group_labels(loja: Column, profile: Profile = config.DEFAULT_PROFILE) -> Column:
    """Every Pareto group a store belongs to: itself, each marketplace whose
    prefix it carries, and the overall group; each label once."""
    parts = [loja]
    for p in profile.group_prefixes:
        parts.append(F.when(loja.startswith(p), F.lit(p)))
    parts.append(F.lit(profile.overall_label))
    return F.array_distinct(F.array_compact(F.array(*parts)))
