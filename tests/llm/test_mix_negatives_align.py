"""Operators 11 to 13 against brute force, odd rows and empty tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import hard_negatives as HN
from factloom.llm import mixing as MX
from factloom.llm import token_align as TA

# ---------------------------------------------------------------- 11


def _mix_docs(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choice(["a"] * 6 + ["b", "c", "d", None, "é"])
        rows.append((i, " ".join("w" for _ in range(int(rnd.paretovariate(1.1) * 10) % 3000)), source))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _targets(sizes):
    """The contract's sharing, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    left, full = set(order), {}
    while True:
        rest = sum(sizes.values()) - sum(full.values())
        level = rest / sum(weight[s] for s in left)
        above = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not above:
            return {**full, **{s: weight[s] * level for s in left}}
        full.update({s: 3.0 * sizes[s] for s in above})
        left -= above


@pytest.fixture(scope="module")
def mix(spark):
    docs = _mix_docs(spark)
    return docs, MX.op11_rows(docs).collect()


def test_mix_targets_totals_and_bounds(mix):
    docs, got = mix
    by_id = {r.doc_id: r for r in got}
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    want = _targets(sizes)
    for d, r in by_id.items():
        assert r.source_size == sizes[source[d]] and r.target == pytest.approx(want[source[d]])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    for s, w in want.items():
        assert abs(taken[s] - w) <= max(0.01 * w, 20), s


def test_mix_is_the_same_however_rows_are_dealt_and_ranges_narrowed(mix, monkeypatch):
    docs, got = mix
    monkeypatch.setattr(MX, "RANGES", 2)
    monkeypatch.setattr(MX, "LISTED", 3)
    again = MX.op11_rows(docs.repartition(7).orderBy(F.desc("doc_id"))).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_longer_documents_are_likelier_and_never_above_the_bound(spark):
    docs = spark.createDataFrame([(i, "w " * (1 if i % 2 else 500), "s" if i < 400 else "t") for i in range(800)],
                                 "doc_id long, text string, source string")
    rows = MX.mixed(docs, weights=(1, 3)).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "source", "copies"]
    mean = {(s, odd): np.mean([r.copies for r in rows if r.source == s and r.doc_id % 2 == odd]) for s in "st" for odd in (0, 1)}
    assert mean["s", 0] > 2 * mean["s", 1] and max(r.copies for r in rows) <= 3


def test_mix_odd_rows(odd, empty):
    rows = MX.mixed(odd, source_col="label").collect()
    assert len(rows) == odd.count() and set(odd.columns) | {"copies"} == set(rows[0].__fields__)
    same = Counter((r.doc_id, r.text, r.label, r.copies) for r in rows)
    assert all(0 <= r.copies <= 3 for r in rows) and same
    assert MX.mixed(empty, source_col="label").count() == 0
    assert MX.op11_rows(empty.withColumn("source", F.lit(None).cast("string"))).count() == 0


def test_mix_one_source_and_sources_without_words(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, None, "y"), (3, "", "z"), (4, " \t", None)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in MX.op11_rows(docs).collect()}
    assert got == {1: (3, 3, 3.0, 3), 2: (0, 0, 0.0, 0), 3: (0, 0, 0.0, 0), 4: (0, 0, 0.0, 0)}


# ---------------------------------------------------------------- 12


def _brute_negatives(rows, positives=5, negatives=5, least=80):
    usable = {i: (lab, [int(np.floor(float(x) * 256)) for x in v]) for i, v, lab in rows
              if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for a in (i for i in usable if i % 10 == 0):
        scored = sorted((-sum(x * y for x, y in zip(usable[a][1], v)), i) for i, (_, v) in usable.items()
                        if i != a and len(v) == len(usable[a][1]))
        for ps, p in [x for x in scored if usable[x[1]][0] == usable[a][0]][:positives]:
            fit = [(s, n) for s, n in scored if usable[n][0] != usable[a][0] and least * -ps <= 100 * -s <= 100 * -ps][:negatives]
            out += [(a, p, k + 1, n, -ps, -s) for k, (s, n) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [8192, 24])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(6, 12))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + rnd.normal(size=12) * 0.3)], int(rnd.integers(3))) for i in range(300)]
    rows += [(300 + i, rows[7][1], 1 + i % 2) for i in range(60)]       # a great many copies of one vector
    rows += [(400, None, 1), (401, [0.0] * 12, 1), (402, [float("nan")] + [1.0] * 11, 0), (403, rows[0][1], None), (410, [1.0, 2.0], 0),
             (411, [1.0, 1.9], 1), (412, [1.0, 2.1], 0), (413, [], 0), (None, rows[0][1], 0), (414, [None] + [1.0] * 11, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = HN.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=block_rows)
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == _brute_negatives(rows)


def test_segment_bounds_hold():
    rnd = np.random.default_rng(4)
    for dim in (1, 3, 5, 16, 64):
        x = np.floor(rnd.normal(size=(40, dim)) * 256)
        s = HN.summaries(x)
        exact = x @ x.T
        for level in range(len(HN.LEVELS)):
            m, d = HN.level_columns(dim, level)
            middle, spread = s[:, m] @ s[:, m].T, s[:, d] @ s[:, d].T
            assert (middle + spread + 1e-3 >= exact).all() and (middle - spread - 1e-3 <= exact).all()


def test_hard_negatives_repeated_ids_large_and_empty(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.9], 2), (2, [1.0, 0.9], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit("x"))
    got = HN.hard_negatives(df, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 131072, 256 * 256 + 256 * 230)]
    big = spark.createDataFrame([(0, [2.0 ** 40], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError):
        HN.hard_negatives(big, F.col("vec_id") == 0)
    assert HN.hard_negatives(df.limit(0), F.col("vec_id") == 0).count() == 0


# ---------------------------------------------------------------- 13

PATHS = TA.default_tokenizers()


@pytest.fixture(scope="module")
def plain_tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def _brute_alignment(texts, plain_tokenizers):
    first, second = plain_tokenizers
    letters = TA.byte_letters()
    docs = []
    for text in texts:
        spelled = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        ab = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bb = [bytes([int(p[1:-1], 16)]) if re.fullmatch(r"<0x..>", p := second.id_to_piece(i)) else p.replace("▁", " ").encode() for i in b]
        if not text or b"".join(ab) != spelled or b"".join(bb) != spelled:
            docs.append(None)
            continue
        spans = [], []
        for out, parts in zip(spans, (ab, bb)):
            at = 0
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, links = [], []
        for lo, hi in zip([0, *ends], ends):
            groups.append(",".join(str(i) for i, (s, _) in zip(a, spans[0]) if lo <= s < hi) + "|"
                          + ",".join(str(i) for i, (s, _) in zip(b, spans[1]) if lo <= s < hi))
        y0 = 0
        for i, (s, e) in zip(a, spans[0]):
            while y0 < len(b) and spans[1][y0][1] <= s:
                y0 += 1
            y = y0
            while y < len(b) and spans[1][y][0] < e:
                links.append((i, b[y]))
                y += 1
        docs.append((len(a), len(b), groups, links))
    count = Counter(x for d in docs if d for x in d[3])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _odd_texts():
    rnd = random.Random(9)
    some = ["the cat", "Straße İ ﬁ", "日本語のテキスト です", "a▁b", "\x00\x01 x", "<|endoftext|> <s> </s> <unk> <0x41>", "  two   spaces ", "\t\n\r\n x",
            "🙂🙂 👩‍👩‍👧 é", "", None, " ", "x" * 3000, "the the the", "don't they're", "١٢٣ ½ ²", " nbsp em", "﻿bom", " lead", "trail "]
    alphabet = "abc  \n\t'.,0159éß日▁🙂 -"
    return some + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 60))) for _ in range(150)]


def test_alignment_equals_brute_force(spark, plain_tokenizers):
    texts = _odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in TA.align(df, *PATHS).collect()}
    want = _brute_alignment(texts, plain_tokenizers)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] > 0 for w in want) > 60 and sum(w[0] == 0 for w in want) >= 3


def test_alignment_of_the_given_documents(spark, docs, plain_tokenizers):
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in TA.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    assert [got[r.doc_id] for r in rows] == _brute_alignment([r.text for r in rows], plain_tokenizers)


def test_alignment_when_windows_are_forgotten(spark, docs, monkeypatch):
    some = docs.limit(30)
    want = sorted(TA.align(some, *PATHS, with_groups=True).collect(), key=str)
    monkeypatch.setattr(TA, "WINDOWS", 20)
    monkeypatch.setattr(TA, "TOGETHER", 500)
    assert sorted(TA.align(some, *PATHS, with_groups=True).collect(), key=str) == want
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in want if r.n_a)


def test_long_white_space_and_encoders_agree(plain_tokenizers):
    encode, _ = TA.first_tokenizer(PATHS[0])
    texts = [" " * 5000 + "x", " a" + "\n" * 1500, " " + "ab" * 20000] + [" " + (t or "") for t in _odd_texts()]
    assert encode(texts) == [plain_tokenizers[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_alignment_odd_rows(odd, empty):
    rows = TA.align(odd, *PATHS).collect()
    assert len(rows) == odd.count()
    assert {(r.n_a, r.n_links, r.groups_sha256) for r in rows if r.n_a == 0} == {(0, 0, "")}
    assert TA.align(empty, *PATHS).count() == 0
