"""Row counts of a stage without an extra job.

``with_counts`` attaches an ``Observation``: the counts are filled in by
the first action on the returned DataFrame, inside the same job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def with_counts(df: DataFrame, name: str, flag_cols=()) -> tuple[DataFrame, Observation]:
    """Return ``(df, observation)``; after an action, ``observation.get`` holds
    ``rows`` and, for each boolean column in ``flag_cols``, how many are true."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.col(c).cast("long")).alias(f"{c}_true") for c in flag_cols]
    return df.observe(obs, *metrics), obs
