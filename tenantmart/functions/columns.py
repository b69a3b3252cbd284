"""Column-expression helpers.

All of them return plain ``Column`` expressions built from
``pyspark.sql.functions``, so they stay JVM-side and inside whole-stage
codegen; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null(dtype) -> Column:
    """A NULL literal of a given type (``CAST(NULL AS <type>)``)."""
    return F.lit(None).cast(dtype)


def nullif_zero(c) -> Column:
    """``NULLIF(c, 0)``: a zero divisor becomes NULL instead of an ANSI error."""
    c = _c(c)
    return F.when(c != 0, c)


def safe_ratio(num, *divisors) -> Column:
    """``num / NULLIF(d1, 0) / NULLIF(d2, 0) ...`` evaluated left to right."""
    out = _c(num)
    for d in divisors:
        out = out / nullif_zero(d)
    return out


def concat_null_as_empty(*cols) -> Column:
    """String concatenation where NULL counts as '' (T-SQL ``CONCAT``)."""
    return F.concat_ws("", *[_c(c) for c in cols])


def week_start_date(year, week, week_start: str = "sunday") -> Column:
    """Date of week ``week`` of ``year``: the first day of the week holding
    1 January, plus ``week - 1`` weeks (T-SQL ``DATEFIRST 7`` when
    ``week_start='sunday'``; ``'monday'`` gives ``DATEFIRST 1``)."""
    jan1 = F.make_date(_c(year), F.lit(1), F.lit(1))
    dow = F.dayofweek(jan1)  # 1 = Sunday ... 7 = Saturday
    if week_start == "monday":
        back = (dow + 5) % 7  # days since the Monday on or before
    elif week_start == "sunday":
        back = dow - 1
    else:
        raise ValueError("week_start must be 'sunday' or 'monday'")
    return F.date_add(jan1, (F.lit(7) * (_c(week) - 1) - back).cast("int"))
