"""Operator 11: mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words from its weight. A document's expected number of copies is its
preference times a factor of its source, at most ``MOST``, and the factors are solved so that the expected
words of each source equal its target. The whole part of that number is allocated for certain. The rest is an
inclusion probability, so it differs from document to document: documents are ranked by random odds divided
by inclusion odds (Pareto order sampling), and the first of that order are taken, up to the number of words
that is still missing. The sample is of a fixed size in words, not in documents. What the last document would overshoot is a gap;
at most ``FITS`` documents a source are then added to the sample, or taken out of it, each the one that brings the total nearest.

The place in the order where a source is cut is found by counting words in ever narrower ranges of the
order, so nothing is sorted, and a source that holds most of the rows is only ever counted in parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factloom.operators.joins import MAX_BROADCAST_ROWS, checked_broadcast
from factloom.operators.merge import rank_within

from .common import fresh, register, staged, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
FITS = 3
# Ranges a source's order is cut into at a time, and rows of a range that are few enough to be listed.
RANGES = 4096
LISTED = 20_000
PREFERENCES = 1000


def words_in(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def longer_first(size: F.Column) -> F.Column:
    """The default preference: the number of binary digits of the size, so 1 for a word, 9 for 400, 15 for 20,000."""
    return F.length(F.bin(size))


def random_place(doc_id: F.Column, size: F.Column, seed: str) -> F.Column:
    """A number between 0 and 1 that depends on the id, the size and the seed alone."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def sized(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", seed: str = "mix",
          preference=longer_first, whole: bool = False) -> DataFrame:
    """(doc_id, source, size, likes, u) per row of ``docs``, and with ``whole`` the row itself as the struct ``row``.

    Source names get a prefix, so that null is a name too, and the last one."""
    source = F.when(docs[source_col].isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), docs[source_col].cast("string")))
    size = words_in(docs[text_col].cast("string"))
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if whole else []
    slim = docs.select(*row, docs[id_col].alias("doc_id"), source.alias("source"), size.alias("size"))
    likes = F.least(F.greatest(preference(F.col("size")).cast("long"), F.lit(1)), F.lit(PREFERENCES)).cast("long")
    return slim.withColumn("likes", likes).withColumn("u", random_place(F.col("doc_id"), F.col("size"), seed))


def targets(classes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): the words every source should get.

    Sources in the order of their code points weigh ``weights``, repeating. Targets stop at ``most`` times
    the source; the excess is shared again by weight until none is above. Each turn is one aggregation over
    the sources and there are at most as many turns as sources, in practice a few.
    """
    sources = classes.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")).withColumn("all", F.lit(1))
    numbered = rank_within(sources, "all", [F.col("source")], name="number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = staged(numbered.select("source", "source_size", weight.alias("weight")), "mix-sources")
    bound = F.col("source_size") * float(most)
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        full = F.col("weight") * F.lit(level) >= bound
        got = src.agg(F.sum(F.when(full, bound).otherwise(0.0)).alias("full"),
                      F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not got["weight"]:
            break
        new = (float(total) - got["full"]) / got["weight"]
        if new <= level:
            break
        level = new
    return src.select("source", "source_size",
                      F.when(F.lit(level) < 0, bound).otherwise(F.least(bound, F.col("weight") * F.lit(level))).alias("target"))


def factors(classes: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """Adds (factor, missing) to ``wanted``: the copies of a document are min(most, factor * likes), and
    ``missing`` are the words of the target beyond whole copies.

    ``classes`` holds the words per (source, likes), at most ``PREFERENCES`` rows a source. The classes of
    the largest likes are at the bound; the factor is that of the fewest such classes for which the others stay under it.
    """
    c = classes.join(wanted, "source")
    larger = Window.partitionBy("source").orderBy(F.desc("likes")).rowsBetween(Window.unboundedPreceding, -1)
    others = Window.partitionBy("source").orderBy(F.desc("likes")).rowsBetween(0, Window.unboundedFollowing)
    c = c.withColumn("at_bound", F.coalesce(F.sum("words").over(larger), F.lit(0)))
    c = c.withColumn("weighed", F.sum(F.col("likes") * F.col("words")).over(others))
    c = c.withColumn("try", F.when(F.col("weighed") > 0, (F.col("target") - F.col("at_bound") * float(most)) / F.col("weighed").cast("double")))
    fits = F.col("try") * F.col("likes") <= float(most)
    solved = c.groupBy("source").agg(F.max_by(F.when(fits, F.col("try")), F.when(fits, F.col("likes"))).alias("factor"))
    # no class under the bound: every document is taken as often as may be
    solved = solved.select("source", F.coalesce("factor", F.lit(float(most))).alias("factor"))
    whole = F.floor(F.least(F.lit(float(most)), F.col("factor") * F.col("likes"))).cast("long")
    certain = (classes.join(solved, "source").groupBy("source")
               .agg(F.sum(whole * F.col("words")).alias("certain")))
    return (wanted.join(solved, "source").join(certain, "source")
            .withColumn("missing", F.greatest(F.lit(0.0), F.col("target") - F.col("certain"))).drop("certain"))


def placed(rows: DataFrame, plan: DataFrame, most: int = MOST) -> DataFrame:
    """``rows`` with the columns of ``plan``, the whole copies and the place in the Pareto order, from 0 to 1
    (null where no copy is left to chance).

    The place is q / (1 + q) of the odds ratio q = (u / (1 - u)) / (share / (1 - share)), which keeps its order."""
    e = F.least(F.lit(float(most)), F.col("factor") * F.col("likes"))
    both = rows.join(plan, "source").withColumn("whole", F.floor(e).cast("long")).withColumn("share", e - F.floor(e))
    up, down = F.col("u") * (1 - F.col("share")), F.col("share") * (1 - F.col("u"))
    return both.withColumn("place", F.when(F.col("share") > 0, F.least(up / (up + down), F.lit(1 - 2.0 ** -53))))


def _running(df: DataFrame, by: str) -> DataFrame:
    """Words before and up to each row of a source, in the order of ``by``; the rows are ranges or listed places."""
    w = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("upto", F.sum("words").over(w)).withColumn("before", F.col("upto") - F.col("words"))


def cuts(rows: DataFrame, plan: DataFrame, near) -> DataFrame:
    """(source, cut, open, gap): the last place that is taken, or the place under which all are (``open``), and the
    words that are missing then.

    The place where the missing words are reached is narrowed by counting words in ``RANGES`` ranges of the
    range before, until few rows share it or the numbers end; then equal places are listed as one row each.
    """
    # the range in which a source reaches its missing words, and the words of the ranges before it
    state = plan.select("source", "missing", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), F.lit(0).cast("long").alias("done"))
    held = ["missing", "low", "width", "done"]
    for _ in range(4):
        inside = rows.join(near(state), "source").where("place >= low and place < low + width")
        step = F.least(F.floor((F.col("place") - F.col("low")) / F.col("width") * RANGES), F.lit(RANGES - 1)).cast("long")
        counted = inside.withColumn("range", step).groupBy("source", "range", *held).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        crossing = _running(counted, "range").where("done + upto > missing and done + before <= missing and words > 0")
        found = staged(crossing.select(
            "source", "missing", (F.col("low") + F.col("range") * F.col("width") / RANGES).alias("low"),
            (F.col("width") / RANGES).alias("width"), (F.col("done") + F.col("before")).alias("done"), "n"), "mix-range")
        state = found.drop("n")
        if (found.agg(F.max("n")).first()[0] or 0) <= LISTED:
            break
    inside = rows.join(near(state), "source").where("place >= low and place < low + width")
    listed = inside.groupBy("source", "place", *held).agg(F.sum("size").alias("words"))
    kept = _running(listed, "place").where("done + upto <= missing").groupBy("source").agg(
        F.max("place").alias("cut"), F.max("upto").alias("words"))
    reached = state.join(kept, "source", "left").select(
        "source", F.coalesce("cut", "low").alias("cut"), F.col("cut").isNull().alias("open"),
        (F.col("missing") - F.col("done") - F.coalesce(F.col("words"), F.lit(0))).alias("gap"))
    # a source that never reaches its missing words has no such range: all its places are taken
    return plan.select("source").join(reached, "source", "left").select(
        "source", F.coalesce("cut", F.lit(1.0)).alias("cut"), F.coalesce("open", F.lit(False)).alias("open"),
        F.coalesce("gap", F.lit(0.0)).alias("gap"))


def _by_rank() -> F.Column:
    """Taken by its place: up to the cut, or under it where the cut is the start of a range none of which is taken."""
    return F.coalesce(F.when(F.col("open"), F.col("place") < F.col("cut")).otherwise(F.col("place") <= F.col("cut")), F.lit(False))


def fitted(rows: DataFrame, cut: DataFrame, near, fits: int = FITS) -> DataFrame:
    """``cut`` with the places (array ``turned``) whose documents are added to the sample or taken out of it: in each
    turn the one that leaves the smallest gap, if that is smaller than the gap before."""
    state = staged(cut.withColumn("turned", F.array().cast("array<double>")), "mix-fits")
    for _ in range(fits):
        signed = F.when(_by_rank(), -F.col("size")).otherwise(F.col("size"))
        units = rows.join(near(state.where("abs(gap) >= 1")), "source").where(
            (F.abs(F.col("gap") - signed) < F.abs("gap")) & ~F.array_contains("turned", F.col("place"))
        ).groupBy("source", "place", "gap").agg(F.sum(signed).alias("words"))
        left = F.col("gap") - F.col("words")
        best = units.where(F.abs(left) < F.abs("gap")).groupBy("source").agg(
            F.min(F.struct(F.abs(left).alias("off"), F.col("place"), F.col("words"))).alias("best"))
        none = F.col("best").isNull()
        state = staged(state.join(best, "source", "left").select(
            "source", "cut", "open", (F.col("gap") - F.when(none, 0).otherwise(F.col("best.words"))).alias("gap"),
            F.when(none, F.col("turned")).otherwise(F.concat("turned", F.array("best.place"))).alias("turned")), "mix-fits")
    return state


def decide(rows: DataFrame, plan: DataFrame, most: int = MOST) -> DataFrame:
    """``rows`` (of ``sized``) with source_size, target and copies."""
    taken = _by_rank() != F.coalesce(F.array_contains("turned", F.col("place")), F.lit(False))
    return (placed(rows, checked_broadcast(plan), most)
            .withColumn("copies", F.col("whole") + F.when(taken, 1).otherwise(0)))


def mix_plan(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, factor, missing, cut, open, gap, turned): what decides the copies of every row of ``sized``."""
    classes = staged(rows.groupBy("source", "likes").agg(F.sum("size").cast("long").alias("words")), "mix-classes")
    plan = staged(factors(classes, targets(classes, weights, most), most), "mix-plan")
    # the tables of a row per source, a few numbers each, are broadcast while the sources are few
    few = plan.count() <= MAX_BROADCAST_ROWS // 10

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    order = staged(placed(rows, near(plan), most).where("place is not null").select("source", "place", "size"), "mix-order")
    return staged(plan.join(fitted(order, cuts(order, plan, near), near), "source"), "mix-plan")


def mixed(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", weights=WEIGHTS,
          most: int = MOST, preference=longer_first, seed: str = "mix") -> DataFrame:
    """``docs`` with one more column, ``copies`` (with underscores if there is one): how often the mix takes each row.

    ``preference`` gives a document's preference (a whole number from 1 to 1,000) from its size in words. Texts are
    never shuffled: a row's copies follow from its own columns and the plan of its source. Null and empty texts have no
    words, so their copies change no total. Null sources are a source of their own, the last one. Rows with a null id
    draw by their size; rows that repeat id, source and size tie, and are taken or left together. Very long texts are
    documents like others. An empty table gives none. Further columns stay, whatever their names. The same rows and
    seed give the same copies, however the rows are dealt over files.
    """
    args = (source_col, text_col, id_col, seed, preference)
    plan = mix_plan(staged(sized(docs, *args), "mix-rows"), weights, most)
    return decide(sized(docs, *args, whole=True), plan, most).select("row.*", F.col("copies").alias(fresh(docs, "copies")))


def op11_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies): the contract's columns, from sizes that are counted once."""
    rows = staged(sized(docs), "mix-rows")
    return decide(rows, mix_plan(rows)).select("doc_id", "size", "source_size", "target",
                                               (F.col("copies") * F.col("size")).alias("taken"), "copies")


def _fit_sql(n: int) -> str:
    """One turn of ``fitted``."""
    return f"""
u{n} AS (SELECT r.source, r.place, sum(CASE WHEN r.by_rank THEN -r.size ELSE r.size END) AS words, any_value(f.gap) AS gap
        FROM ranked r JOIN f{n - 1} f USING (source)
        WHERE r.place IS NOT NULL AND abs(f.gap) >= 1 AND NOT list_contains(f.turned, r.place)
          AND abs(f.gap - CASE WHEN r.by_rank THEN -r.size ELSE r.size END) < abs(f.gap)
        GROUP BY r.source, r.place HAVING abs(any_value(f.gap) - sum(CASE WHEN r.by_rank THEN -r.size ELSE r.size END)) < abs(any_value(f.gap))),
b{n} AS (SELECT source, arg_min(words, (abs(gap - words), place)) AS words, arg_min(place, (abs(gap - words), place)) AS place FROM u{n} GROUP BY source),
f{n} AS (SELECT f.source, f.gap - coalesce(b.words, 0) AS gap,
               CASE WHEN b.words IS NULL THEN f.turned ELSE list_append(f.turned, b.place) END AS turned
        FROM f{n - 1} f LEFT JOIN b{n} b USING (source))"""


OP11_SQL = f"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS source,
                  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
r AS (SELECT *, greatest(1, length(bin(size)))::BIGINT AS likes,
             ((('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || size), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source) - 1) % 3 + 1)::DOUBLE AS weight FROM r GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source) AS nth, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower,
             sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM o),
level AS (SELECT arg_min(v, nth) AS level FROM (SELECT nth, source_size, weight, (total::DOUBLE - lower::DOUBLE * 3) / weights AS v FROM l)
          WHERE weight * v < source_size * 3.0::DOUBLE OR source_size = 0),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN source_size * 3.0::DOUBLE
             ELSE least(source_size * 3.0::DOUBLE, weight * level) END AS target FROM s, level),
c AS (SELECT source, likes, sum(size)::BIGINT AS words FROM r GROUP BY source, likes),
c2 AS (SELECT c.*, t.target, coalesce(sum(words) OVER (PARTITION BY source ORDER BY likes DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_bound,
              sum(likes * words) OVER (PARTITION BY source ORDER BY likes DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weighed
       FROM c JOIN t USING (source)),
c3 AS (SELECT *, CASE WHEN weighed > 0 THEN (target - at_bound::DOUBLE * 3) / weighed::DOUBLE END AS try FROM c2),
fac AS (SELECT source, coalesce(arg_max(try, likes) FILTER (WHERE try * likes <= 3), 3.0::DOUBLE) AS factor FROM c3 GROUP BY source),
e AS (SELECT r.*, t.source_size, t.target, least(3.0::DOUBLE, factor * likes) AS e FROM r JOIN t USING (source) JOIN fac USING (source)),
p AS (SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS share FROM e),
q AS (SELECT *, CASE WHEN share > 0 THEN least((u * (1 - share)) / (u * (1 - share) + share * (1 - u)), 1 - power(2.0::DOUBLE, -53)) END AS place FROM p),
m AS (SELECT source, greatest(0, any_value(target) - sum(whole * size)::DOUBLE) AS missing FROM p GROUP BY source),
places AS (SELECT source, place, sum(size) AS words FROM q WHERE place IS NOT NULL GROUP BY source, place),
run AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
first AS (SELECT run.source, max(upto) FILTER (WHERE upto <= missing) AS words, max(place) FILTER (WHERE upto <= missing) AS cut,
                 bool_or(upto > missing) AS reached, any_value(missing) AS missing FROM run JOIN m USING (source) GROUP BY run.source),
ranked AS (SELECT q.*, first.source IS NOT NULL AND q.place IS NOT NULL AND (NOT reached OR coalesce(place <= cut, false)) AS by_rank
           FROM q LEFT JOIN first USING (source)),
f0 AS (SELECT m.source, CASE WHEN reached THEN m.missing - coalesce(words, 0) ELSE 0 END AS gap, []::DOUBLE[] AS turned
       FROM m LEFT JOIN first USING (source)),{",".join(_fit_sql(n + 1) for n in range(FITS))}
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (SELECT ranked.*, whole + CASE WHEN place IS NOT NULL AND by_rank <> list_contains(turned, place) THEN 1 ELSE 0 END AS copies
      FROM ranked JOIN f{FITS} USING (source))
"""


@register("op11_pareto_mix", OP11_SQL)
def op11_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_rows(table(spark, sf_dir, "documents"))
