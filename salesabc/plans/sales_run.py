"""Entry A: the full sales run as one lazy plan.

closed sheets --+
current sheet --+-- (refresh filter) --+-- clean -- union
feed pages -----+---- (window filter) -+
    -- keep last per (order, sku) -- settlement join -- catalogue join -- fact (22 columns)

Each source is cleaned on its own (a projection) so the union sees one
typed schema.  The only shuffles are the two joins (each skipped by a
runtime broadcast when the catalogue / settlement side is small) and the
keep-last aggregate.

``stored_run`` makes the same in steps with a stored table between each two,
so that disk holds the shuffles of one step at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from salesabc import config
from salesabc.config import Profile
from salesabc.functions.dates import refresh_window
from salesabc.operators.catalog import join_catalog
from salesabc.operators.clean import clean_sales, conform
from salesabc.operators.consolidate import (ORDER_COLUMNS, WORK_COLUMNS, dedup_sales, fact_table, refresh_filter,
                                            tag_source, union_sources)
from salesabc.operators.settlement import apply_settlement
from salesabc.session import written
from salesabc.sources.order_feed import feed_rows


@dataclass
class RunInputs:
    closed_sheets: DataFrame | None = None   # every month but the current one (S2)
    current_sheet: DataFrame | None = None   # the current month's sheet, if landed
    feed_pages: Callable[[dt.date, dt.date], DataFrame] | None = None  # order pages of a window of days (S3, S4)
    catalog: DataFrame | None = None         # aggregated catalogue (A1)
    settlement: DataFrame | None = None      # aggregated settlement (A2)


@dataclass
class RunStages:
    window: tuple[dt.date, dt.date]
    sources: dict[str, DataFrame]
    union: DataFrame
    enriched: DataFrame
    settled: DataFrame
    deduped: DataFrame
    fact: DataFrame


def run_sales(inputs: RunInputs, as_of: dt.date, profile: Profile = config.DEFAULT_PROFILE,
              allocate: bool = False) -> RunStages:
    def prepared(df: DataFrame) -> DataFrame:
        # Every source gets the same typed columns (missing ones with their
        # defaults) before the union, like the conform step of each loader.
        return conform(clean_sales(df, profile), WORK_COLUMNS, keep_extra=True)

    has_sheet = inputs.current_sheet is not None
    lo, hi = refresh_window(as_of, has_sheet)
    sources: dict[str, DataFrame] = {}
    if inputs.closed_sheets is not None:
        sources["closed_sheets"] = tag_source(prepared(inputs.closed_sheets), 0, "Excel")
    if has_sheet and as_of.day != 1:
        cur = prepared(inputs.current_sheet)
        sources["current_sheet_loaded"] = cur
        sources["current_sheet"] = tag_source(refresh_filter(cur, lo, hi), 1, "Excel")
    if inputs.feed_pages is not None:
        sources["feed"] = tag_source(prepared(feed_rows(inputs.feed_pages(lo, hi), lo, hi)), 2, "Feed")
    parts = [v for k, v in sources.items() if k != "current_sheet_loaded"]
    union = union_sources(parts)
    settlement = inputs.settlement if inputs.settlement is not None else _no_settlement(union)

    # The stages before keep-last stay available for exports and checks.
    enriched = with_costs(union, inputs.catalog)
    settled = apply_settlement(enriched, settlement)
    deduped = last_lines(union, inputs.catalog, settlement, allocate)
    return RunStages((lo, hi), sources, union, enriched, settled, deduped, fact_table(deduped))


def stored_run(inputs: RunInputs, as_of: dt.date, profile: Profile = config.DEFAULT_PROFILE, costs: bool = True, prices: bool = True,
               scratch: ExitStack | None = None) -> RunStages:
    """``run_sales`` with its united lines, lookup tables and priced last lines stored on the way.

    ``costs``: a caller that uses no column of the catalogue leaves it lazy.
    ``prices``: one that wants some lines only leaves the priced lines lazy, so
    that its condition reaches the stored lines; else those go as soon as the
    priced ones are there.  ``scratch``: the tables go as that stack closes.
    """
    stages = run_sales(inputs, as_of, profile)
    catalog = written(inputs.catalog, "catalog", scratch) if costs and inputs.catalog is not None else inputs.catalog
    with ExitStack() as own:
        kept = own if prices else scratch
        settled = written(inputs.settlement, "settlement", kept) if inputs.settlement is not None else None
        lines = written(stages.union, "lines", kept)
        deduped = with_costs(paid_lines(lines, settled, scratch) if prices else last_lines(lines, None, settled, stored=True), catalog)
    return replace(stages, deduped=deduped, fact=fact_table(deduped))


def paid_lines(lines: DataFrame, settlement: DataFrame | None, scratch: ExitStack | None = None) -> DataFrame:
    """The last lines of stored ones with their settled prices (``last_lines`` before the catalogue), stored without their places in a source."""
    return written(last_lines(lines, None, settlement, stored=True).drop(*ORDER_COLUMNS[1:]), "paid-lines", scratch)


def with_costs(lines: DataFrame, catalog: DataFrame | None) -> DataFrame:
    return join_catalog(lines, catalog) if catalog is not None else lines


def last_lines(lines: DataFrame, catalog: DataFrame | None, settlement: DataFrame | None, allocate: bool = False, stored: bool = False) -> DataFrame:
    """The last line of each (order, sku) with its costs and settled price.

    Both joins have one row per key on their build side, so they commute with
    keep-last and with each other; it runs first, then the settled prices, so
    that the catalogue's texts are shuffled for no other join.
    """
    paid = settlement if settlement is not None else _no_settlement(lines)
    return with_costs(apply_settlement(dedup_sales(lines, stored), paid, allocate), catalog)


def _no_settlement(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame(
        [], "id_pedido string, preco_acordado decimal(18,3), cashback_cupom decimal(18,3), "
            "`Comissão` decimal(18,3)")
