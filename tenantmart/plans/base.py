"""Model registry types.

A model is a named function ``build(src, params) -> DataFrame`` over a
``Source`` (a callable ``table name -> DataFrame``).  It only declares the
plan; nothing runs until a sink or an action asks for rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Source = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Params:
    """Cut-offs and calendar choices of the models.

    ``*_since`` are inclusive lower bounds on the business date of a branch
    (``None`` = no bound); ``until`` is an optional exclusive upper bound on
    every one of them.  Defaults are the values hard-coded in the original
    models.
    """

    sales_since: dt.date | None = dt.date(2023, 1, 1)
    labour_cost_since: dt.date | None = dt.date(2024, 1, 1)
    expense_since: dt.date | None = dt.date(2024, 1, 1)
    stock_since: dt.date | None = dt.date(2024, 1, 1)
    until: dt.date | None = None
    week_start: str = "sunday"
    excluded_variety: int = 15

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Cut-offs used against the driver's fixture tables (orders end in 2001,
# events cover January 2024).
FIXTURE_PARAMS = Params(sales_since=dt.date(1998, 1, 1), labour_cost_since=dt.date(1998, 1, 1),
                        expense_since=dt.date(2024, 1, 1), stock_since=dt.date(2024, 1, 1))


def ts_literal(d: dt.date) -> Column:
    """Midnight of ``d`` as a timestamp without time zone."""
    return F.lit(d).cast("timestamp_ntz")


def date_window(col: Column, since: dt.date | None, until: dt.date | None) -> Column:
    """``since <= col < until``; a missing bound is open.  Pushed to the scan."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (col >= ts_literal(since))
    if until is not None:
        cond = cond & (col < ts_literal(until))
    return cond


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Source, Params], DataFrame]
    keys: tuple[str, ...] = ()
    date_cols: tuple[str, ...] = ()
    merge: bool = False          # appended into the central tenant merge
    grain: str = ""
    unique: bool = True          # one row per key; else incremental loads replace all rows of a key
    distinct: bool = False       # the build ends by dropping duplicate rows
    # the same rows as (rows, unit) pieces: no row of one is in another, and with a unit column none is in two units
    pieces: Callable[[Source, Params], list[tuple[DataFrame, str | None]]] | None = None

    def __call__(self, src: Source, params: Params | None = None) -> DataFrame:
        return self.build(src, params or Params())

    def in_pieces(self, src: Source, params: Params) -> list[tuple[DataFrame, str | None]]:
        return self.pieces(src, params) if self.pieces else [(self.build(src, params), None)]

    @property
    def table(self) -> str:
        return self.name
