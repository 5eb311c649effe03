"""Join helpers: broadcast only what is proven small.

A side is broadcast only after one aggregation over it (pass a side that is
written or checkpointed, so that this is a scan) shows it is under a row
bound and a byte bound; beyond them the join is a shuffle join (sort-merge, AQE
skew handling), which is asked for by a hint: Spark's own estimate of a stage comes
from the size of the files it was made from, and is far too small where those are
well compressed or rows are exploded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a side may have and still be broadcast (a gazetteer of "thousands of
# names" is far below this), and its size in bytes, estimated as the JSON
# length of its rows. The driver holds a broadcast several times while it is built.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> F.Column:
    """Approximate in-memory size of a row: the length of its JSON form."""
    return F.octet_length(F.to_json(F.struct(*[df[c] for c in df.columns])))


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes), by one aggregation that is partial in every task."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` is proven small (rows and bytes), else ``df`` with the hint for a sort-merge
    join, so that neither side is broadcast by an estimate."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df.hint("merge")


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast: one aggregation over it."""
    n, b = size_of(df)
    return n <= max_rows and b <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on, how: str = "left",
                max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a fact table to a dimension, broadcasting the dimension if small."""
    return facts.join(checked_broadcast(dim, max_rows), on=on, how=how)


def exploded(df: DataFrame, columns, array, position: str = "pos", name: str = "item") -> DataFrame:
    """``columns`` of ``df`` with a row per element of ``array``, its position (from 0) and the element.

    An inner ``explode`` makes the optimizer test the array for being null or empty before, which computes a costly
    array three times; the outer form does not, and its rows without an element are dropped after.
    """
    return df.select(*columns, F.posexplode_outer(array).alias(position, name)).filter(F.col(position).isNotNull())
