"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_PARTS of the counted rows, so
# there are fewer than HOT_PARTS hot keys whatever the data: their table is
# small enough to broadcast at every scale.
HOT_PARTS = 1000
# below this many rows a key is never worth splitting
HOT_FLOOR = 2000


def join_counted(left: DataFrame, right: DataFrame, key: list[str], count: str) -> DataFrame:
    """``left`` inner-joined with ``right`` on ``key`` without a hot task.

    ``right`` has one row per key and, in ``count``, how many rows of ``left``
    carry that key.  Keys holding more than a thousandth of the rows (fewer
    than a thousand keys, so a bounded broadcast) are joined map-side, in the
    tasks that read ``left``; all others by a shuffle join, where no key has
    more than that thousandth.  Null keys match null keys.  Both inputs are
    read twice and should be written tables.
    """
    total = right.agg(F.sum(count)).scalar()
    is_hot = F.col(count) > F.greatest(F.lit(HOT_FLOOR), F.coalesce(total, F.lit(0)) / HOT_PARTS)
    payload = [c for c in right.columns if c not in key]
    hot = right.where(is_hot).select(*[F.col(k).alias(f"__r_{k}") for k in key], *payload)
    rest = right.where(~is_hot).select(*[F.col(k).alias(f"__r_{k}") for k in key], *payload)
    on = None
    for k in key:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = c if on is None else on & c
    out = [F.col(c) for c in left.columns] + [F.col(c) for c in payload]
    mapped = left.join(F.broadcast(hot), on, "inner").select(*out)
    shuffled = (left.join(F.broadcast(hot.select(*[f"__r_{k}" for k in key])), on, "left_anti")
                .join(rest, on, "inner").select(*out))
    return mapped.unionByName(shuffled)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, as ``repartition`` needs a number
    where adaptive coalescing must not merge partitions that then run Python."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
