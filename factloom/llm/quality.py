"""Operator 10: quality classifier by positive-unlabelled learning.

Every text becomes a short vector of surface statistics (shares of character classes, word and line
shapes, repetition), computed over the whole text in one pass and written to the shared folder. A
logistic model over binned statistics is fitted on a bounded sample of trusted positives and a bounded
sample of unlabelled texts by minimising the non-negative unbiased risk

    prior * R_P(f, +1) + max(0, R_U(f, -1) - prior * R_P(f, -1))

with the logistic loss, and then scores every text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, register, row_key, staged, table

FEATURES = ("log_words", "log_chars", "upper", "digit", "white", "high", "control", "bang", "pipe",
            "common_mark", "other_mark", "marked_words", "upper_words", "digit_words", "word_len", "long_words",
            "distinct_words", "top_word", "same_next", "distinct_lines", "words_per_line", "short_lines",
            "distinct_pairs", "lower_start", "line_end_mark", "entropy")
# Sample sizes of the fit: texts with a trusted positive label, and unlabelled texts.
MAX_POSITIVES = 8000
MAX_UNLABELLED = 24000
BINS = 12
_MARKED = re.compile(rb"[^A-Za-z0-9\x80-\xff.,;:'\"()-]")
_COMMON = np.frombuffer(b".,;:'\"()-?", dtype=np.uint8)


def text_features(raw: bytes) -> list[float]:
    """The statistics of one text, given as UTF-8; zeros for a text without words."""
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(raw), len(words)
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256).astype(float)
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    digit, high = hist[48:58].sum(), hist[128:].sum()
    white = hist[9:14].sum() + hist[32]
    control = hist[:9].sum() + hist[14:32].sum() + hist[127]
    common = hist[_COMMON].sum()
    other = n - upper - lower - digit - high - white - control - common
    lowered = [x.lower() for x in words]
    counts: dict[bytes, int] = {}
    for x in lowered:
        counts[x] = counts.get(x, 0) + 1
    pairs = len(set(zip(lowered, lowered[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    p = hist[hist > 0] / n
    return [np.log1p(w), np.log1p(n), upper / n, digit / n, white / n, high / n, control / n, hist[33] / n,
            hist[124] / n, common / n, other / n,
            sum(_MARKED.search(x) is not None for x in words) / w,
            sum(x.isupper() for x in words) / w,
            sum(any(48 <= c < 58 for c in x) for x in words) / w if digit else 0.0,
            (n - white) / w, sum(len(x) > 18 for x in words) / w,
            len(counts) / w, max(counts.values()) / w,
            sum(a == b for a, b in zip(lowered, lowered[1:])) / w,
            len(set(lines)) / len(lines), np.log1p(w / len(lines)),
            sum(len(x.split()) < 4 for x in lines) / len(lines),
            pairs / max(1, w - 1),
            sum(97 <= x.lstrip()[0] < 123 for x in lines) / len(lines),
            sum(x.rstrip()[-1:] in b".!?\"" for x in lines) / len(lines),
            float(-(p * np.log2(p)).sum())]


def _featurise(batches):
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            rows = [text_features(x) for x in part.column("raw").to_pylist()]
            values = pa.array(np.asarray(rows, dtype=np.float32).ravel())
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.ListArray.from_arrays(offsets, values)],
                names=["doc_id", "key", "features"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, features): one row per input row; a null text counts as empty."""
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), row_key(docs, id_col, text_col).alias("key"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("raw"))
    return slim.mapInArrow(_featurise, "doc_id long, key long, features array<float>")


class PUModel:
    """Binned logistic model; ``edges`` hold the quantiles of the unlabelled sample per statistic."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray):
        self.edges, self.weights = edges, weights

    @staticmethod
    def expand(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Column numbers of the active bin of each statistic."""
        cols = np.empty(x.shape, dtype=np.int64)
        for j in range(x.shape[1]):
            cols[:, j] = j * (BINS + 1) + np.searchsorted(edges[j], x[:, j], side="right")
        return cols

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[self.expand(x, self.edges)].sum(axis=1) + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-z))


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Half of the edges are quantiles of all values, half of the values beyond the median, so that a
    statistic that is zero for most texts still has bins for the others."""
    tail = x[x > np.median(x)]
    parts = [np.quantile(v if len(v) else x, np.linspace(0, 1, BINS // 2 + 2)[1:-1]) for v in (x, tail)]
    return np.sort(np.concatenate(parts))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600,
           rate: float = 0.05, penalty: float = 2e-4) -> PUModel:
    """Minimise the non-negative risk by Adam; when the negative part of the risk drops below zero, the
    step goes against that part instead of following it."""
    edges = np.stack([bin_edges(unlabelled[:, j]) for j in range(unlabelled.shape[1])])
    size = unlabelled.shape[1] * (BINS + 1) + 1
    pc, uc = PUModel.expand(positive, edges), PUModel.expand(unlabelled, edges)
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = np.log(prior / (1 - prior))

    def pull(cols, g):
        out = np.bincount(cols.ravel(), weights=np.repeat(g, cols.shape[1]), minlength=size)
        out[-1] = g.sum()
        return out

    for t in range(1, steps + 1):
        zp, zu = w[pc].sum(axis=1) + w[-1], w[uc].sum(axis=1) + w[-1]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        # logistic loss: d/dz log(1+e^-z) = s - 1 for the positive side, d/dz log(1+e^z) = s for the negative
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = pull(uc, su / len(zu)) - prior * pull(pc, sp / len(zp))
        g = prior * pull(pc, (sp - 1) / len(zp)) + g_neg if negative_risk >= 0 else -g_neg
        g[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return PUModel(edges, w)


def _matrix(df: DataFrame) -> np.ndarray:
    got = df.select("features").toArrow().column(0).combine_chunks()
    return got.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)


def fold(id_col: F.Column) -> F.Column:
    """crc32 of the id as text, modulo 3; a null id falls into fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3, F.lit(0))


def fit(feats: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
        max_unlabelled: int = MAX_UNLABELLED) -> PUModel | None:
    """Fit on rows outside fold 1. The prior is the share of label 1 among the labelled rows of those
    folds. None without a trusted positive."""
    # an id with several labels counts as positive only if all of them are 1
    known = (labels.where((fold(labels["doc_id"]) != 1) & labels["quality"].isNotNull() & labels["doc_id"].isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    row = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("quality") == 1).cast("long")).alias("p")).first()
    if not row["p"]:
        return None
    prior = min(0.98, max(0.02, (row["p"] + 0.5) / (row["n"] + 1)))
    train = feats.where(fold(feats["doc_id"]) != 1)
    order = [F.xxhash64("key", F.lit(7)), F.col("key")]
    positives = (train.join(known.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
                 .orderBy(*order).limit(max_positives))
    unlabelled = train.orderBy(*order).limit(max_unlabelled)
    p, u = _matrix(positives), _matrix(unlabelled)
    return fit_pu(p, u, prior) if len(p) else None


def score(feats: DataFrame, model: PUModel | None) -> DataFrame:
    """Adds ``score``; 0.5 for every row when there was nothing to learn from."""
    if model is None:
        return feats.withColumn("score", F.lit(0.5))

    def scored(batches):
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], names=[*b.schema.names, "score"])

    return feats.mapInArrow(scored, "doc_id long, key long, features array<float>, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, held_out, score, predicted): one row per input row.

    Null texts and null ids, repeated rows and extra columns are allowed; empty texts get the score of
    all-zero statistics; without usable labels every score is 0.5; an empty table gives no rows. Labels,
    language, source and id are never inputs of a score.
    """
    feats = staged(features(docs, id_col, text_col), "quality-features")
    out = score(feats, fit(feats, labels))
    return out.select("doc_id", "key", (fold(F.col("doc_id")) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go; the others keep all their columns."""
    verdicts = classify(docs, table(spark, sf_dir, "labels"))
    return only(docs, verdicts.where("predicted = 0"), kept=False)
