"""Operator 3: licence scan with a positional rare-token index.

Each template (a licence phrase or notice) posts the rarest words of its mandatory key phrase, by their
document frequency in the scanned corpus, with their positions. A file looks up only those words; each
hit proposes one place of the template (hit position minus template position), proposals of a template's
words must agree on that relative position, and the mandatory key phrase is then verified word by word.

Only DataFrame functions are used. The text is read twice: once to count the words of each file and the
document frequencies of the licence words, once to locate the rare words in the files that have any.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import register, staged, table, texts

# Fixed values: (label, template text, mandatory key phrase). The first four are the base phrases.
BASE = [
    ("gpl", "gnu general public license", "gnu general public license"),
    ("apache", "apache license", "apache license"),
    ("cc-by", "cc by", "cc by"),
    ("mit", "mit license", "mit license"),
]
NOTICES = [
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("spdx", "spdx license identifier", "spdx license identifier"),
]
# Words that separate: everything below 0x80 that is neither a digit nor a letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rare words of a key phrase that are posted and must agree on the place.
ANCHORS = 2


def ascii_lower(text: Column) -> Column:
    """Lower-case letters. The two letters outside A-Z whose lower case holds an ASCII letter (Kelvin
    sign, capital I with dot) are replaced first, so no ASCII word can arise from them."""
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("�")), F.lit("İ"), F.lit("�")))


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _templates(templates):
    out = []
    for label, text, key in templates:
        t, k = text.split(), key.split()
        at = next(i for i in range(len(t) - len(k) + 1) if t[i:i + len(k)] == k)
        out.append((label, t, k, at))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_places).

    One row per input row (repeated rows repeat their result). Null texts count as empty: no words, no
    labels, score 0. Null ids and extra columns are allowed. ``n_base``, ``first_word`` and
    ``last_word`` cover every place of a base phrase, overlaps included; ``score`` is the largest share
    of a template's words found at a verified place, 0 without one.
    """
    templates = _templates([*base, *notices])
    vocabulary = sorted({w for _, _, k, _ in templates for w in k})
    src = texts(docs, id_col, text_col)
    ws = words(F.col("text"))
    files = staged(
        src.select("key", "doc_id", ws.alias("ws"))
        .select("key", "doc_id", F.size("ws").cast("long").alias("n_words"),
                F.array_intersect("ws", F.array(*map(F.lit, vocabulary))).alias("licence_words")), "licence-files")
    # The vocabulary is a fixed list, so these counts are a handful of rows.
    df = {r["w"]: r["n"] for r in files.select(F.explode("licence_words").alias("w")).groupBy("w")
          .agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(df.values()) + 1
    idf = {w: math.log(total / (df.get(w, 0) + 0.5)) for w in vocabulary}

    postings, rare = {}, set()
    for n, (_, _, k, _) in enumerate(templates):
        order = sorted(range(len(k)), key=lambda i: (-idf[k[i]], i))[:ANCHORS]
        postings[n] = sorted(order)
        rare |= {k[i] for i in order}
    lowered = src.select("key", ascii_lower(F.col("text")).alias("text"))
    has_rare = F.exists(F.array(*map(F.lit, sorted(rare))), lambda w: F.contains(F.col("text"), w))
    hits = (lowered.where(has_rare)
            .select("key", F.array_remove(F.split("text", SEPARATORS), "").alias("ws"))
            .select("key", "ws", F.posexplode("ws").alias("pos", "word"))
            .where(F.col("word").isin(sorted(rare))))

    # Word -> (template, position of that word in the key phrase): a fixed list of a few dozen rows.
    def proposals(word: Column, pos: Column) -> Column:
        listed = [F.struct(F.lit(n).alias("t"), F.lit(i).alias("i"), F.lit(templates[n][2][i]).alias("w"))
                  for n, at in postings.items() for i in at]
        return F.transform(F.filter(F.array(*listed), lambda p: p["w"] == word),
                           lambda p: F.struct(p["t"].alias("t"), (pos - p["i"]).alias("place")))

    def case(values):
        out = F.when(F.col("t") == 0, values[0])
        for n in range(1, len(values)):
            out = out.when(F.col("t") == n, values[n])
        return out

    def verified(n):
        k = templates[n][2]
        return (F.slice(F.col("ws"), F.col("place") + 1, F.lit(len(k))) == F.array(*map(F.lit, k)))

    def share(n):
        _, t, _, at = templates[n]
        found = [F.when(F.get(F.col("ws"), F.col("place") + (j - at)) == w, 1).otherwise(0) for j, w in enumerate(t)]
        total_found = found[0]
        for x in found[1:]:
            total_found = total_found + x
        return total_found / F.lit(float(len(t)))

    n_anchors = case([F.lit(len(postings[n])) for n in range(len(templates))])
    places = (hits.select("key", "ws", F.explode(proposals(F.col("word"), F.col("pos"))).alias("p"))
              .select("key", "ws", "p.t", "p.place").where("place >= 0")
              .withColumn("ok", case([verified(n) for n in range(len(templates))])).where("ok")
              .withColumn("share", case([share(n) for n in range(len(templates))]))
              # all posted words of the template have to name the same place
              .groupBy("key", "t", "place").agg(F.count(F.lit(1)).alias("agree"), F.max("share").alias("share"),
                                                F.max(n_anchors).alias("needed"))
              .where("agree >= needed"))
    is_base = F.col("t") < len(base)
    label = case([F.lit(x[0]) for x in templates])
    found = (places.withColumn("label", label).groupBy("key").agg(
        F.sum(is_base.cast("long")).alias("n_base"),
        F.min(F.when(is_base, F.col("place"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("place"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"), F.count(F.lit(1)).alias("n_places")))
    return files.drop("licence_words").join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_places", F.lit(0).cast("long")).alias("n_places"))


def _oracle() -> str:
    def places(k):
        n = len(k)
        lit = "[" + ", ".join(f"'{w}'" for w in k) + "]"
        return f"list_filter(range(0, greatest(len(w) - {n - 1}, 0)), lambda i: w[i + 1:i + {n}] = {lit})"

    templates = _templates([*BASE, *NOTICES])
    cols = ",\n  ".join(f"{places(k)} AS p{n}" for n, (_, _, k, _) in enumerate(templates))
    nb = len(BASE)
    base = "[" + ", ".join(f"p{n}" for n in range(nb)) + "]"

    def labels(idx):
        each = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{templates[n][0]}' END" for n in idx)
        return f"array_to_string(list_sort(list_filter([{each}], lambda x: x IS NOT NULL)), ',')"

    def best(n):
        _, t, _, at = templates[n]
        terms = " + ".join(f"(CASE WHEN i + 1 + {j - at} >= 1 AND w[i + 1 + {j - at}] = '{x}' THEN 1 ELSE 0 END)" for j, x in enumerate(t))
        return f"coalesce(list_max(list_transform(p{n}, lambda i: ({terms}) / {float(len(t))})), 0.0)"

    score = "greatest(" + ", ".join(best(n) for n in range(len(templates))) + ")"
    every = " + ".join(f"len(p{n})" for n in range(len(templates)))
    # places only matter in texts that hold one of these words at all
    return f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
ws AS (SELECT doc_id, regexp_extract_all(x, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
slim AS (SELECT doc_id, len(w) AS n_words, CASE WHEN list_has_any(w, {sorted({k[0] for _, _, k, _ in templates})}) THEN w ELSE [] END AS w FROM ws),
p AS (SELECT doc_id, n_words, w, {cols} FROM slim)
SELECT doc_id, n_words, CAST(len(flatten({base})) AS BIGINT) AS n_base,
  list_min(flatten({base})) AS first_word, list_max(flatten({base})) AS last_word,
  {labels(range(nb))} AS base_labels, {labels(range(len(templates)))} AS labels,
  CAST({score} AS DOUBLE) AS score, CAST({every} AS BIGINT) AS n_places
FROM p"""


@register("op3_license_scan", _oracle())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
