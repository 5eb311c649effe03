"""Category labels by lookup with an ordered regex fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import category_by_rules
from ..functions.text import clean_label
from .joins import checked_broadcast


def label_map(report: DataFrame, text_col: str = "text", order_col: str = "ord") -> DataFrame:
    """Label report -> ``(map_text, labels array<string>)``, last row per text wins.

    ``label_0`` / ``label_1`` are cleaned (text between the first quotes);
    a null ``label_0`` lets ``label_1`` take the first slot.
    """
    labels = F.filter(F.array(clean_label(F.col("label_0")), clean_label(F.col("label_1"))),
                      lambda x: x.isNotNull())
    w = Window.partitionBy(text_col).orderBy(F.col(order_col).desc())
    return (report.filter(F.col(text_col).isNotNull())
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(F.col(text_col).alias("map_text"), labels.alias("labels")))


def match_labels(df: DataFrame, mapping: DataFrame, text_col: str = "category_text",
                 regex_fallback: bool = True) -> DataFrame:
    """``category_0`` / ``category_1`` for each row.

    A text found in the map takes its labels (an empty label list stays
    unlabelled: "known, no label"); a text not in the map takes the first
    matching category rule as ``category_0`` when ``regex_fallback``.
    """
    m = checked_broadcast(mapping.withColumn("_known", F.lit(True)))
    j = df.join(m, df[text_col] == m["map_text"], "left")
    known = F.col("_known").isNotNull()
    c0 = F.when(known, F.get(F.col("labels"), 0))
    if regex_fallback:
        c0 = c0.otherwise(category_by_rules(F.col(text_col)))
    c1 = F.when(known, F.get(F.col("labels"), 1))
    return j.withColumns({"category_0": c0, "category_1": c1}).drop("map_text", "labels", "_known")
