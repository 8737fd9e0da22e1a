"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_norm(vector: Column) -> Column:
    return F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays as it is.

    The norm is bound through a one-element array so it is computed once per row
    and not once per component.
    """
    norm = F.sqrt(squared_norm(vector))
    unit = F.transform(
        F.array(norm),
        lambda n: F.transform(
            vector, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double"))
        ),
    )
    return F.element_at(unit, 1)


def has_dim(vector: Column, dim: int) -> Column:
    return vector.isNotNull() & (F.size(vector) == dim)


def not_zero(vector: Column) -> Column:
    """True if some component differs from zero; stops at the first one."""
    return F.exists(vector, lambda x: x != 0)
