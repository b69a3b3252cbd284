"""The calendar dimension of a tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.calendar import calendar_for
from .base import Params, Source

# Tables and columns whose business dates the calendar spans.
DATED = (("vente", "date"), ("pointage", "date"), ("depence", "date_depense"), ("mouvement_stock", "date"))


def tenant_calendar(src: Source, params: Params) -> DataFrame:
    """One row per day from the tenant's first to its last business date."""
    return calendar_for([(src(t), c) for t, c in DATED])
