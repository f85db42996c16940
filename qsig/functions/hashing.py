"""Seeded, partition-independent pseudo-random draws as column expressions.

The reference draws with Python's ``random`` inside tasks, so its output
changes from run to run and with the partitioning.  Ours hash the identity of
the draw (its key columns plus a draw number and the seed) with md5: the same
inputs give the same value on every executor, after every retry, for any
number of partitions, and DuckDB can compute the identical value.

Fixed encodings (must match on both engines):
  * the hashed text is ``concat_ws('#', key..., seed)``;
  * an integer draw uses the first 15 hex digits (60 bits, fits a BIGINT);
  * a uniform draw in [0, 1) uses the first 13 hex digits divided by 2**52.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_INT_DIGITS = 15
HEX_UNIFORM_DIGITS = 13
UNIFORM_SCALE = float(2 ** 52)


def _digest(parts, seed) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    cols = [c.cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("#", *cols))


def hash_int(parts, seed) -> Column:
    """A non-negative 60-bit integer determined by ``parts`` and ``seed``."""
    return F.conv(F.substring(_digest(parts, seed), 1, HEX_INT_DIGITS), 16, 10).cast("bigint")


def draw_int(n, parts, seed) -> Column:
    """Uniform integer in ``[0, n)``; ``n`` may be a column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(hash_int(parts, seed), n.cast("bigint"))


def uniform(parts, seed) -> Column:
    """Uniform double in ``[0, 1)``, exact in 52 bits."""
    bits = F.conv(F.substring(_digest(parts, seed), 1, HEX_UNIFORM_DIGITS), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(UNIFORM_SCALE)


def sql_hash_int(parts_sql: list[str], seed) -> str:
    """DuckDB text of :func:`hash_int` (used by the oracle SQL)."""
    inner = ", ".join([f"CAST({p} AS VARCHAR)" for p in parts_sql] + [f"'{seed}'"])
    return f"CAST(('0x' || substr(md5(concat_ws('#', {inner})), 1, {HEX_INT_DIGITS})) AS BIGINT)"


def sql_draw_int(n_sql: str, parts_sql: list[str], seed) -> str:
    h = sql_hash_int(parts_sql, seed)
    return f"(({h}) % CAST({n_sql} AS BIGINT))"


def sql_uniform(parts_sql: list[str], seed) -> str:
    inner = ", ".join([f"CAST({p} AS VARCHAR)" for p in parts_sql] + [f"'{seed}'"])
    bits = f"CAST(('0x' || substr(md5(concat_ws('#', {inner})), 1, {HEX_UNIFORM_DIGITS})) AS BIGINT)"
    return f"(CAST({bits} AS DOUBLE) / {UNIFORM_SCALE!r})"
