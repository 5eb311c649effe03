"""Range and grid generation (R1-R6, J8) with ``sequence`` + ``explode``.

Each function takes Columns, so the grid is built per input row on the
executors; nothing is looped on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import NEWS_FIXED_QUERIES, QUERY_TEMPLATES


def window_starts(start: Column, end: Column, days: int = 2) -> Column:
    """``array<struct<start, end>>`` of ``days``-long windows from ``start`` while start <= end."""
    seq = F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS"))
    return F.transform(seq, lambda d: F.struct(d.alias("win_start"),
                                               (d + F.expr(f"INTERVAL {days} DAYS")).alias("win_end")))


def day_ranges(start: Column, end: Column) -> Column:
    """R2: one-day ranges, the last one may end after ``end``."""
    return window_starts(start, end, 1)


def month_starts(start: Column, end: Column) -> Column:
    """``start``, then the first of each following month until one is >= ``end``."""
    first = F.trunc(start, "month")
    nxt = F.add_months(first, 1)
    last = F.add_months(F.trunc(end, "month"), F.when(F.trunc(end, "month") < end, 1).otherwise(0))
    rest = F.when(nxt <= last, F.sequence(nxt, last, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array())
    return F.when(start < end, F.concat(F.array(start), rest)).otherwise(F.array(start))


def month_ranges(start: Column, end: Column) -> Column:
    """(from, to) per month; the first may start mid-month, the last is cut at ``end``."""
    firsts = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    ranges = F.transform(firsts, lambda m: F.struct(F.greatest(m, start).alias("range_start"),
                                                    F.least(F.add_months(m, 1), end).alias("range_end")))
    return F.filter(ranges, lambda r: r["range_start"] < r["range_end"])


def page_offsets(limit: int = 50000, page_size: int = 100) -> Column:
    """0, 100, ... below ``limit``."""
    return F.sequence(F.lit(0), F.lit(limit - page_size), F.lit(page_size))


def fixed_queries(spark) -> DataFrame:
    """The fixed query list as a one-column DataFrame (for ``query_grid``)."""
    return spark.createDataFrame([(q,) for q in NEWS_FIXED_QUERIES], "query string")


def query_grid(terms: DataFrame, start: Column, end: Column, days: int = 2,
               fixed: DataFrame | None = None, term_col: str = "term", context: str = "Iraq") -> DataFrame:
    """R6 + J8: distinct terms x 4 templates (+ fixed queries) x time windows.

    Both the templates and the windows are arrays generated per row and
    exploded (no join, no cartesian product operator): each query row
    expands to its own windows on the executor that holds it.
    """
    texts = F.array(*[F.format_string(t.replace("{ctx}", context).replace("{term}", "%s"), F.col(term_col))
                      for t in QUERY_TEMPLATES])
    q = terms.select(term_col).distinct().select(F.explode(texts).alias("query"))
    if fixed is not None:
        q = q.unionByName(fixed.select(F.col(fixed.columns[0]).alias("query")))
    return (q.select("query", F.explode(window_starts(start, end, days)).alias("w"))
            .select("query", "w.win_start", "w.win_end"))
