"""Operator 6: removal of repeated runs of lines.

The corpus is a set of sequences of line ids. Prefix doubling labels, for k = 0, 1, 2, ..., every run of
2^k lines that occurs at two places; each round joins the labels of two neighbouring runs and keeps those
that occur twice, so it ends after log2 of the longest repeated run. Then the intervals of the suffix
array (the sets of suffixes with a common prefix) are walked from long to short steps: a suffix that shares
its first n lines with others is extended by 2^k lines if the longer prefix is shared too, and also stays
at n lines if its interval branches there. The longest prefix that a suffix shares with an earlier place is
its run; runs of at least ``MIN_WORDS`` words are deleted, and so the first copy of everything stays.

Only DataFrame functions are used; what is shuffled is line ids, not lines, and after the first round
only those of lines that occur twice. The texts are read once for the ids and once to apply the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factloom.operators.joins import checked_broadcast

from .common import fresh, register, row_key, staged, table, texts

MIN_WORDS = 50


def _count(text, char: str):
    """How often an ASCII character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def word_count(line):
    """Runs of characters other than ASCII white space. Lines whose words stand one space apart, as most do,
    are counted without a regular expression."""
    odd = F.contains(line, F.lit("  ")) | line.startswith(" ") | line.endswith(" ")
    for char in "\t\r\x0b\x0c":
        odd = odd | F.contains(line, F.lit(char))
    return F.when(line == "", 0).when(odd, F.size(F.array_remove(F.split(line, r"\s+"), ""))).otherwise(_count(line, " ") + 1)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(key, n): the lines (numbers from 0) that are later copies."""
    src = texts(docs, id_col, text_col)
    # place in the corpus: by doc_id (nulls last), then key, then line, as one sortable number
    doc_order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit((1 << 63) - 1).cast("decimal(20,0)"))
    lines = (src.select("key", doc_order.alias("d"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
             .select("key", "n", F.xxhash64("line").alias("label"),
                     word_count(F.col("line")).alias("words"),
                     (F.col("d") * F.lit(1 << 62).cast("decimal(19,0)")
                      + (F.pmod("key", F.lit(1 << 31)) * F.lit(1 << 31) + F.col("n")).cast("decimal(20,0)"))
                     .cast("decimal(38,0)").alias("place")))

    def twice(df):
        """Labels at two places. A row that is repeated with its id is one place."""
        return (df.groupBy("label").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                .where("first <> last"))

    lines = staged(lines, "line-ids")
    level = staged(lines.join(twice(lines).select("label"), "label").select("key", "n", "label", "place").distinct(), "runs")
    levels = []
    while not level.isEmpty():
        levels.append(level)
        step = 1 << (len(levels) - 1)
        after = level.select("key", (F.col("n") - step).alias("n"), F.col("label").alias("then"))
        longer = level.join(after, ["key", "n"]).select("key", "n", F.xxhash64("label", "then").alias("label"), "place")
        longer = staged(longer, "doubled")
        level = staged(longer.join(twice(longer).select("label"), "label").select("key", "n", "label", "place"), "runs")

    spark = docs.sparkSession
    empty = spark.createDataFrame([], "key long, n int, size int, label long, place decimal(38,0), members long")
    state, runs = empty, None
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        short = levels[k]
        start = short.select("key", "n", F.lit(step).alias("size"), F.xxhash64("label", F.lit(step)).alias("label"),
                             "place", F.lit(None).cast("long").alias("parent"))
        longer = (state.withColumn("at", F.col("n") + F.col("size"))
                  .join(short.select("key", F.col("n").alias("at"), F.col("label").alias("then")), ["key", "at"])
                  .select("key", "n", (F.col("size") + step).alias("size"),
                          F.xxhash64("label", "then", F.lit(step)).alias("label"), "place", F.col("label").alias("parent")))
        tried = staged(start.unionByName(longer), "tried")
        shared = (tried.groupBy("label").agg(F.min("place").alias("first"), F.max("place").alias("last"),
                                             F.count(F.lit(1)).alias("members"), F.max("parent").alias("parent"))
                  .where("first <> last"))
        grown = tried.drop("parent").join(shared.select("label", "first", "members"), "label")
        # an interval whose members all go on alike has no branch here
        largest = (shared.where("parent IS NOT NULL").groupBy(F.col("parent").alias("label")).agg(F.max("members").alias("largest")))
        branching = (state.join(largest, "label", "left").where("largest IS NULL OR largest < members").drop("largest"))
        grown = staged(grown.select("key", "n", "size", "label", "place", "members", "first"), "intervals")
        found = grown.where("place > first").select("key", "n", "size")
        runs = found if runs is None else runs.unionByName(found)
        if k:
            state = staged(grown.drop("first").unionByName(branching), "state")
    if runs is None:
        return spark.createDataFrame([], "key long, n int")

    longest = staged(runs.groupBy("key", "n").agg(F.max("size").alias("size")), "longest-runs")
    words = lines.join(longest.select("key").distinct(), "key", "left_semi").select("key", "n", "words").distinct()
    per_doc = Window.partitionBy("key").orderBy("n")
    upto = words.select("key", "n", F.sum("words").over(per_doc).alias("upto"), "words")
    begin = longest.join(upto, ["key", "n"]).select("key", "n", (F.col("n") + F.col("size") - 1).alias("end"),
                                                     (F.col("upto") - F.col("words")).alias("before"))
    long_runs = (begin.join(upto.select("key", F.col("n").alias("end"), "upto"), ["key", "end"])
                 .where(F.col("upto") - F.col("before") >= min_words).select("key", "n", "end"))
    reach = words.select("key", "n").join(long_runs, ["key", "n"], "left").select(
        "key", "n", F.max("end").over(per_doc.rowsBetween(Window.unboundedPreceding, 0)).alias("reach"))
    return reach.where("reach >= n").select("key", "n")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every input row and column, with the kept text, and (n_lines, n_removed).

    A line is deleted if it lies in a run of lines of its document that holds at least ``min_words``
    words (runs of characters other than ASCII white space) and occurs at an earlier place: in a document with
    a smaller doc_id (nulls last), or further up in the same one. Lines are compared byte by byte and
    split at \\n; kept lines are joined by \\n. A null text stays null and has no lines; an empty one has
    one empty line. Rows that repeat both id and text count as one place and get the same result. Input
    columns named n_lines or n_removed are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    key, gone, flags = (fresh(docs, x) for x in ("_key", "_gone", "_flags"))
    removed = (repeated_lines(docs, id_col, text_col, min_words).groupBy(F.col("key").alias(key))
               .agg(F.array_sort(F.collect_list("n")).alias(gone)))
    # line numbers of the documents that lose some: broadcast if that is proven small, so that texts stay in place
    removed = checked_broadcast(staged(removed, "removed-lines"))
    joined = docs.withColumn(key, row_key(docs, id_col, text_col)).join(removed, key, "left")
    lines, gap = F.split(F.col(text_col), "\n"), F.col(gone)

    def stretch(i):
        """Zeros for the kept lines before the i-th deleted one (or up to the end), then a one for it."""
        begin = F.when(i == 0, 0).otherwise(F.get(gap, i - 1) + 1)
        last = i == F.size(gap)
        zeros = F.array_repeat(F.lit(0), (F.when(last, F.size(lines)).otherwise(F.get(gap, i)) - begin).cast("int"))
        return F.when(last, zeros).otherwise(F.concat(zeros, F.array(F.lit(1))))

    # one flag per line, so that filtering needs one look per line
    marked = F.flatten(F.transform(F.sequence(F.lit(0), F.size(gap)), stretch))
    kept = F.array_join(F.filter(lines, lambda _, i: F.get(F.col(flags), i) == 0), "\n")
    return (joined.withColumn(flags, F.when(gap.isNotNull(), marked))
            .withColumn("n_lines", F.coalesce(_count(F.col(text_col), "\n") + 1, F.lit(0)).cast("long"))
            .withColumn("n_removed", F.when(gap.isNull(), 0).otherwise(F.size(gap)).cast("long"))
            .withColumn(text_col, F.when(gap.isNull(), F.col(text_col)).otherwise(kept))
            .select(*docs.columns, "n_lines", "n_removed"))


@register("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later copies of repeated line runs are deleted; n_chars follows the text. A document
    of which nothing is left stays as an empty text, so that later stages see it."""
    out = line_dedup(docs.select("doc_id", "text", *(c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_removed"))))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*(c for c in docs.columns if c not in ("n_lines", "n_removed")))
