"""Look-back inside groups of any size, by one plan.

A window over a key puts all of a group into one task.  Here the window runs inside
(key, bucket), where ``bucket`` grows with the order, and one row per bucket is
carried over the seams.  So a group with a third of all rows spans as many tasks as
it has buckets, rows of a null key are a group like others, and nothing is counted
or run while the plan is made.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _LAST, _FIRST = "_qb_bucket", "_qb_last", "_qb_first"


def previous_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """Add the value of the row before in its group, null for the first.

    ``bucket`` must not fall as ``order`` grows.
    """
    placed = df.withColumn(_BUCKET, bucket)
    by = [*keys, _BUCKET]
    last = F.max_by(F.struct(value), F.struct(*order))
    seams = placed.groupBy(*by).agg(last.alias(_LAST)).select(
        *[F.col(c).alias(f"_qb_key_{c}") for c in by],
        F.lag(_LAST).over(Window.partitionBy(*keys).orderBy(_BUCKET)).alias(_LAST),
    )
    inside = Window.partitionBy(*by).orderBy(*order)
    local = placed.withColumns(
        {_FIRST: F.row_number().over(inside) == 1, out: F.lag(value).over(inside)}
    )
    met = F.lit(True)
    for c in by:
        met = met & local[c].eqNullSafe(F.col(f"_qb_key_{c}"))
    return (
        local.join(seams, met)
        .withColumn(out, F.when(F.col(_FIRST), F.col(_LAST)[value]).otherwise(F.col(out)))
        .select(*df.columns, out)
    )
