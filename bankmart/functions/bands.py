"""Band tables → CASE expressions (JVM-side, constant-folded thresholds)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart import domains as D


def band(col: Column | str, table) -> Column:
    """``table`` = [(exclusive upper bound, label), …, (None, else-label)].

    Like the source rules, there is no NULL arm: a NULL input falls through
    every comparison and gets the ``else`` label.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for upper, label in table:
        if upper is None:
            return expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
        cond = c < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def lower_bound_band(col: Column | str, table) -> Column:
    """Bins with inclusive lower bound; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for upper, label in table:
        expr = expr.when(c < F.lit(upper), F.lit(label)) if upper is not None \
            else expr.otherwise(F.lit(label))
    return expr


def age_band(col="age") -> Column:
    return band(col, D.AGE_BANDS)


def income_tier(col="annual_income") -> Column:
    return band(col, D.INCOME_TIERS)


def credit_band(col="credit_score") -> Column:
    return band(col, D.CREDIT_BANDS)
