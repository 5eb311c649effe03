"""Operators on documents against brute force, and on odd rows."""

import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.llm import decontamination, licenses, line_dedup, lm_score, near_dups, packing, quality, suffix_dedup
from factloom.llm.shingles import shingles


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# ------------------------------------------------------------------ 1: decontamination
def test_contained_items_match_brute_force(spark, docs, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in decontamination.contained_items(docs, items).collect()}

    def sets(rows):
        import regex
        out = {}
        for i, t in rows:
            w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
            out[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
        return out

    d, b = (sets(x.select(c, "text").collect()) for x, c in ((docs, "doc_id"), (items, "item_id")))
    want = {(i, j, len(s & t)) for i, s in d.items() for j, t in b.items() if t and len(s & t) >= 0.8 * len(t)}
    assert got == want and want


def test_contained_items_partial_long_and_odd(spark, make, odd, empty):
    words = [f"w{i}" for i in range(30)]
    filler = [f"f{i}" for i in range(40_000)]
    items = make([(1, " ".join(words)), (2, "too short item"), (3, None), (4, " ".join(words))]).withColumnRenamed("doc_id", "item_id")
    rows = [(10, " ".join(filler[:20_000] + words + filler[20_000:])), (11, " ".join(words[:26])), (12, " ".join(words[:20])),
            (13, " ".join(w.upper() + "," for w in words)), (14, "too short item")]
    got = {(r.doc_id, r.item_id) for r in decontamination.contained_items(make(rows), items).collect()}
    assert got == {(d, i) for d in (10, 11, 13) for i in (1, 4)}
    assert decontamination.contained_items(odd, items).count() == 0
    assert decontamination.contained_items(empty, items).count() == 0
    assert decontamination.contained_items(make(rows), items.where("false")).count() == 0


# ------------------------------------------------------------------ 2: near duplicates
def test_signatures_agree_like_weighted_jaccard():
    rng = np.random.default_rng(1)
    e = np.unique(rng.integers(0, 1 << 63, size=500).astype(np.uint64))
    w = rng.integers(1, 4, size=len(e)).astype(float)
    a, b = (e[:400], w[:400]), (e[60:], w[60:].copy())
    want = near_dups.jaccard(near_dups.elements_of(a), near_dups.elements_of(b))
    same = near_dups.dart_minhash(*a, 3000) == near_dups.dart_minhash(*b, 3000)
    assert abs(same.mean() - want) < 0.04


@pytest.mark.parametrize("counted", [False, True])
def test_near_dup_classes_match_brute_force(docs, counted):
    got = by_id(near_dups.near_dup_classes(docs, counted=counted), "class_id", "kept")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [near_dups.elements_of(near_dups.weighted_set(t.encode(), counted)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or len(sets[i]) and near_dups.jaccard(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        classes[root(i)].append(d)
    want = {d: (min(c), d == min(c)) for c in classes.values() for d in c}
    assert got == want


def test_near_dup_chain_and_hot_group(make):
    """A chain whose ends are unlike each other is one class, also next to many copies."""
    base = [f"w{i}" for i in range(200)]
    chain = []
    for step in range(8):
        base = base.copy()
        base[step * 20] = f"new{step}"
        base[step * 20 + 1] = f"new{step}b"
        chain.append(" ".join(base))
    rows = [(i, t) for i, t in enumerate(chain)] + [(100 + i, "one copy of many with some words") for i in range(300)]
    rows += [(500 + i, " ".join(f"q{j}" for j in range(300)) + f" tail{i}") for i in range(200)]
    got = by_id(near_dups.near_dup_classes(make(rows)), "class_id", "class_size", "kept")
    assert {got[i][0] for i in range(8)} == {0} and got[0][1] == 8
    assert {got[100 + i][:2] for i in range(300)} == {(100, 300)}
    assert {got[500 + i][:2] for i in range(200)} == {(500, 200)}
    assert sum(k for *_, k in got.values()) == 3


def test_near_dups_of_texts_that_share_a_passage(make):
    """Many texts around one passage, at similarities on both sides of the bound, by brute force."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(120)]
    rows = [(i, " ".join([*passage, *(f"t{rng.randrange(9)}x{j}" for j in range(rng.randrange(10, 60)))])) for i in range(150)]
    got = by_id(near_dups.near_dup_classes(make(rows)), "class_id")
    sets = [near_dups.elements_of(near_dups.weighted_set(t.encode(), False)) for _, t in rows]
    low = list(range(len(rows)))
    for _ in range(len(rows)):
        before = low.copy()
        for i in range(len(rows)):
            for j in range(i):
                if low[i] != low[j] and near_dups.jaccard(sets[i], sets[j]) >= 0.8:
                    low[i] = low[j] = min(low[i], low[j])
        if low == before:
            break
    assert {d: c for d, (c,) in got.items()} == dict(enumerate(low)) and 1 < len(set(low)) < 150


def test_rare_shingles_find_all_similar_pairs_of_different_roots(spark):
    rng = random.Random(5)
    rows, n_rows = [], 120
    for i in range(n_rows):
        core = [(i % 3) * 10_000 + j for j in range(60)]
        mine = set(core[:rng.randint(50, 60)]) | {50_000 + rng.randrange(40) for _ in range(rng.randint(0, 8))}
        rows.append((i, i % 5, sorted((x * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) - (1 << 63) for x in mine)))
    sets = spark.createDataFrame(rows, "tkey long, root long, elements array<long>")
    found = [(r.a, r.b) for r in near_dups.sharing_rare(sets, 0.8).distinct().collect()]
    assert all(rows[a][1] != rows[b][1] for a, b in found)
    like = {(a, b) for a in range(n_rows) for b in range(a + 1, n_rows) if rows[a][1] != rows[b][1]
            and near_dups.jaccard(np.array(rows[a][2]), np.array(rows[b][2])) >= 0.8}
    assert like and like <= set(found) and len(found) < n_rows * n_rows // 4


def test_near_dups_odd_rows(spark, odd, empty):
    out = near_dups.near_dup_classes(odd)
    assert out.count() == odd.count() and near_dups.near_dup_classes(empty).count() == 0
    rows = [(r.doc_id, r.class_id, r.class_size) for r in out.collect()]
    assert (3, 3, 3) in rows and (4, 3, 3) in rows
    kept = near_dups.near_dup_stage(spark, odd, "")
    assert kept.columns == odd.columns
    # empty and null texts are one class, the three long ones another, all others alone
    assert kept.count() == 9


# ------------------------------------------------------------------ 3: licences
def brute_licenses(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels = [], set()
    for label, _, key in [*licenses.BASE, *licenses.NOTICES]:
        k = key.split()
        at = [i for i in range(len(w)) if w[i:i + len(k)] == k]
        if at:
            labels.add(label)
        if (label, key, key) in licenses.BASE:
            starts += at
    base = labels & {x[0] for x in licenses.BASE}
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)))


COLS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")


def test_licenses_match_brute_force(make, docs):
    texts = ["GNU General-Public LICENSE, version 3", "mit license mit license", "MIT\nLicense cc by cc by 4 0", "cc cc by by",
             "Apache License, Version 2.0", "licensed under the apache license version 2 0", "gnu general public", "", None,
             "K mit licensİ license", "Permission is hereby granted, free of charge, to any person", "é" * 3 + " mit license"]
    rows = list(enumerate(texts)) + [(100, "mit license"), (100, "mit license")]
    df = make(rows)
    got = [(r.doc_id, *(r[c] for c in COLS)) for r in licenses.scan(df).collect()]
    want = [(i, *brute_licenses(t)) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    got = by_id(licenses.scan(docs), *COLS)
    assert got == {r.doc_id: brute_licenses(r.text) for r in docs.collect()}


def test_licenses_odd_rows(odd, empty):
    out = licenses.scan(odd).collect()
    assert len(out) == odd.count() and all(r.score == 0.0 and r.base_labels == "" for r in out)
    assert licenses.scan(empty).count() == 0


# ------------------------------------------------------------------ 4: suffix arrays
def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(2)
    for turn in range(20):
        data = rng.integers(97, 99 if turn % 2 else 120, size=rng.integers(30, 400)).astype(np.uint8)
        depth, raw = int(rng.integers(9, 40)), data.tobytes()
        sa, head, _ = suffix_dedup.refine_suffixes(data, depth)
        common = suffix_dedup.kasai(data, sa, head, depth, lanes=7)
        for r in range(1, len(sa)):
            a, b = raw[sa[r - 1]:], raw[sa[r]:]
            n = next((i for i in range(min(len(a), len(b), depth)) if a[i] != b[i]), min(len(a), len(b), depth))
            assert common[r] == n
            if min(len(a), len(b)) >= depth:
                assert a[:depth] <= b[:depth]


def brute_spans(texts, span=suffix_dedup.SPAN):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + span] for r in raws for p in range(len(r) - span + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for p in range(len(r) - span + 1):
            if seen[r[p:p + span]] > 1:
                gone[p:p + span] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot,shard", [(2000, 1 << 20), (2000, 1 << 9), (2, 1 << 12)])
def test_suffix_dedup_matches_brute_force(make, monkeypatch, hot, shard):
    """Also with shards so small that one passage fills several, and with every group counted as hot."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    rng = random.Random(4)

    def prose(n):
        return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "ämet", "x"]) + str(rng.randrange(99)) for _ in range(n))

    shared = [prose(n) for n in (30, 36, 60, 200)]
    texts = [prose(rng.randrange(0, 150)) + rng.choice(shared)[rng.randrange(40):] + prose(rng.randrange(60)) for _ in range(40)]
    texts += ["ab" * 300, "ab" * 101, "", None, prose(100), texts[0], "z" * 199, "y" * 201]
    got = by_id(suffix_dedup.suffix_dedup(make(list(enumerate(texts)))), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == dict(enumerate(brute_spans(texts)))


def test_suffix_dedup_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = suffix_dedup.suffix_dedup(odd, with_text=False).collect()
    want = brute_spans([t for _, t in rows if t is None or len(t) < 10_000])
    assert len(got) == len(rows)
    short = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.n_bytes < 10_000)
    assert short == sorted(want)
    assert all(r.n_removed == r.n_bytes for r in got if r.n_bytes >= 10_000)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_spans_leave_a_task_together():
    """Not a batch for each hash, of which there are as many as windows: its cost was far above that of the spans."""
    rng = random.Random(5)
    rows = []
    for gram in range(600):
        body = bytes(rng.choices(range(97, 123), k=suffix_dedup.SPAN + 9))
        # equal ranges, and one that shares all windows but the first
        rows += [(gram, 1, 0, body), (gram, 2, 7, body), (gram, 3, 5, b"." + body[1:])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
        names=["gram", "tkey", "first", "raw"])
    out = list(suffix_dedup._mark_sorted([batch.slice(0, 700), batch.slice(700)]))
    assert len(out) == 1
    found = Counter((r["tkey"], r["lo"], r["hi"]) for b in out for r in b.to_pylist())
    whole, later = suffix_dedup.SPAN + 9, suffix_dedup.SPAN + 8
    assert found[1, 0, whole] == found[2, 7, 7 + whole] == found[3, 6, 6 + later] == 600


# ------------------------------------------------------------------ 6: lines
def brute_lines(rows, least):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    lines = [[] if t is None else t.split("\n") for _, t in rows]
    out = {}
    for d, own in enumerate(lines):
        gone = set()
        for i in range(len(own)):
            best = 0
            for e in range(d + 1):
                for j in range(len(lines[e]) if e < d else i):
                    k = 0
                    while i + k < len(own) and j + k < len(lines[e]) and own[i + k] == lines[e][j + k]:
                        k += 1
                    best = max(best, k)
            if best and sum(len(x.split()) for x in own[i:i + best]) >= least:
                gone.update(range(i, i + best))
        out[rows[d]] = ("\n".join(x for i, x in enumerate(own) if i not in gone), len(gone))
    return out


@pytest.mark.parametrize("least", [3, 9])
def test_line_dedup_matches_brute_force(make, least):
    rng = random.Random(least)
    rows = [(i, "\n".join(rng.choice(["a a", "b", "c c c", "", "e e"]) for _ in range(rng.randrange(25)))) for i in range(20)]
    rows += [(30, rows[3][1]), (31, rows[3][1] + "\n" + rows[4][1])]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.line_dedup(make(rows), min_words=least).collect()}
    assert got == {d: v for (d, _), v in brute_lines(rows, least).items()}


def test_line_dedup_odd_rows(spark, odd, empty):
    out = line_dedup.line_dedup(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_removed"]
    rows = {(r.doc_id, r.n_removed) for r in out.collect()}
    assert out.count() == odd.count() and (7, 1) in rows and (6, 0) in rows and (4, 1) in rows
    assert line_dedup.line_dedup(empty).count() == 0
    assert line_dedup.line_dedup_stage(spark, odd, "").columns == odd.columns


# ------------------------------------------------------------------ 7: packing
def test_token_ids_equal_the_tokenizer(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    texts = [r.text for r in docs.collect()] + ["it's İ Σας don't a.b,c. x.,y 3.14 \x1c z", "", "ﬁ Å ñ", "a b 'll we'll 12abc", "…” “q”"]
    got = packing.TokenIds(packing.default_tokenizer()).batch(texts)
    assert got == [np.asarray(x.ids, dtype="<u4").tobytes() for x in tok.encode_batch(texts, add_special_tokens=False)]


def test_words_before_marks_are_learned_by_their_parts():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    texts = ["this.### that### (this) that's' été!? this--that a...", "'s### ###'s x###'s y'### z`~|{}"]
    ids, whole = packing.TokenIds(packing.default_tokenizer()), []
    encode = ids._encode
    ids._encode = lambda parts: whole.extend(parts) or encode(parts)
    assert ids.batch(texts) == [np.asarray(x.ids, dtype="<u4").tobytes() for x in tok.encode_batch(texts, add_special_tokens=False)]
    assert not {"this.###", "that###", "été!?", "a...", "z`~|{}"} & set(whole)


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_documents(docs, odd, empty):
    for df in (docs, odd):
        rows = packing.op7_rows(df, packing.default_tokenizer()).collect()
        n = check_packing(rows, packing.CAPACITY)
        assert n == -(-sum(r.length for r in rows) // packing.CAPACITY)
        assert all(r.certified for r in rows)
        per_doc = Counter((r.doc_id, r.piece) for r in rows)
        if df is docs:
            assert set(per_doc.values()) == {1} and {d for d, _ in per_doc} == {r.doc_id for r in docs.collect()}
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(packing.default_tokenizer())
            ids = {r.doc_id: np.array([*tok.encode(r.text, add_special_tokens=False).ids, 1], dtype="<u4") for r in docs.collect()}
            for r in rows:
                part = ids[r.doc_id][r.start:r.start + r.length]
                assert r.start == 4096 * r.piece and r.length == len(part) and r.ids_crc32 == zlib.crc32(part.tobytes())
    assert packing.op7_rows(empty, packing.default_tokenizer()).count() == 0


def optimum(sizes, capacity):
    """Fewest bins, by trying every placement."""
    items, best = sorted(sizes, reverse=True), len(sizes)

    def place(at, filled):
        nonlocal best
        if len(filled) >= best:
            return
        if at == len(items):
            best = len(filled)
            return
        for level in sorted(set(filled)):
            if level + items[at] <= capacity:
                rest = list(filled)
                rest.remove(level)
                place(at + 1, [*rest, level + items[at]])
        place(at + 1, [*filled, items[at]])

    place(0, [])
    return best


def rerun_of(sizes, capacity):
    bins, _ = packing.best_fit_decreasing(sizes, capacity)
    bins = packing.rerun(sizes, bins, capacity, packing.lower_bound(sizes, capacity))
    rows = [SimpleNamespace(sequence_id=b, offset=o, length=int(n))
            for b, o, n in zip(bins.tolist(), packing.offsets_of(sizes, bins).tolist(), sizes)]
    return check_packing(rows, capacity)


def test_last_group_is_packed_again_until_nothing_is_gained():
    # best-fit decreasing takes 4 sequences for both
    assert rerun_of(np.array([5, 5, 4, 4, 3, 3, 3, 3]), 10) == 3
    assert rerun_of(np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6]), 61) == 3
    rng = np.random.default_rng(11)
    for _ in range(200):
        capacity = int(rng.integers(10, 100))
        sizes = rng.integers(1, capacity // 2 + 2, size=rng.integers(6, 11))
        assert rerun_of(sizes, capacity) == optimum(sizes.tolist(), capacity)
    sizes = rng.integers(600, 1500, size=3000)
    first = int(packing.best_fit_decreasing(sizes, 4096)[0].max()) + 1
    assert packing.lower_bound(sizes, 4096) <= rerun_of(sizes, 4096) < first


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
found = spark.range(1).mapInPandas(lambda parts: (p.assign(id=int(bool(__import__("importlib.util").util.find_spec("factloom")))) for p in parts), "id long")
assert found.first()["id"] == 0
from factloom.llm import lm_score, packing
docs = spark.createDataFrame([(i, f"alpha beta gamma {i % 5} delta") for i in range(40)], "doc_id long, text string")
print("rows", packing.op7_rows(docs, packing.default_tokenizer()).count(), lm_score.score_texts(docs).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", WITHOUT_PACKAGE, str(Path(__file__).parents[2]), str(tmp_path / "shared")],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 40 40" in got.stdout, got.stderr[-2000:]


def test_packing_rounds_bounds_and_optimum(spark):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, size=900)
    parts = spark.createDataFrame([(i, i, 0, 0, int(s), 0) for i, s in enumerate(sizes)],
                                  "doc_id long, key long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(parts, capacity=100, per_partition=60).collect()
    assert len(rows) == 900
    n, bound = check_packing(rows, 100), packing.lower_bound(sizes, 100)
    assert bound <= n <= math.ceil(1.03 * bound)
    # two thirds of the space cannot hold two of these
    assert packing.lower_bound(np.full(7, 51), 100) == 7
    assert packing.lower_bound(np.full(9, 34), 100) == 5
    for turn in range(30):
        sizes = rng.integers(1, 100, size=rng.integers(1, 40))
        bins, offsets = packing.best_fit_decreasing(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= bins.max() + 1
        fill = np.bincount(bins, weights=sizes)
        assert fill.max() <= 100 and len(fill) == len(set(bins.tolist()))


# ------------------------------------------------------------------ 9: language model
def test_lm_base_and_totals(docs):
    got = by_id(lm_score.score_texts(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    words = {r.doc_id: [*r.text.encode().lower().split(), b""] for r in docs.collect()}
    train = Counter()
    for d, w in words.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            train.update(w)
    n, v = sum(train.values()), len(train)
    for d, w in words.items():
        held, n_tokens, known, total, base, score = got[d]
        assert held == (zlib.crc32(str(d).encode()) % 5 == 1) and total == n
        assert n_tokens == len(w) and known == sum(train[x] > 0 for x in w)
        assert base == pytest.approx(sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
        assert score < 0
    learned = [d for d in words if not got[d][0]]
    assert sum(got[d][5] for d in learned) > sum(got[d][4] for d in learned)


def test_lm_predictions_of_all_symbols_sum_to_one():
    """The walk down a Huffman tree is a distribution: Kraft's sum of every code is one."""
    for weights in (np.array([5, 1, 1, 2]), np.ones(256), np.arange(1, 40)):
        code = lm_score.Code(*lm_score.huffman(weights))
        assert (0.5 ** code.size.astype(float)).sum() == pytest.approx(1.0)


def test_lm_byte_tree_weighs_all_tokens(make):
    """Bytes weigh as often as they occur in all training tokens, also in frequent words and in words seen once."""
    train = make([(i, "zzzz common " + "q" * (i + 3)) for i in range(40)]).select(F.col("text").cast("binary").alias("raw"))
    counts = lm_score.count_tokens(train)
    want = Counter(b"".join(t + b" " for r in train.collect() for t in bytes(r.raw).split()))
    assert {i: n for i, n in enumerate(lm_score.count_bytes(counts).tolist()) if n} == want
    tree = lm_score.learn_trees(counts, 160, 40).byte_tree
    size = lm_score.Code(*tree).size
    # the words of q are seen once each, and q is the most frequent byte
    assert size[ord("q")] == size.min() < size[ord("z")] < size[ord("!")]


def test_lm_plain_predictor_learns_too(monkeypatch):
    """With the map off and nothing seen in the contexts, only the plain counts' weight can adapt to a document."""
    monkeypatch.setattr(lm_score, "MAP_RATE", 0.0)
    coder = lm_score.Coder([b"a", b"b"], lm_score.huffman(np.array([8, 4, 2, 1])), lm_score.huffman(np.ones(256)))
    odds = np.zeros(lm_score.first_table(2) + 2 * (1 << lm_score.SLOT_BITS), dtype=np.float16)
    odds[:lm_score.first_table(2)] = 1
    start = {k: np.full((5, 3), 1 / 3, dtype=np.float32) for k in ("words", "bytes")}
    mixer = lm_score.Mixer(coder, odds, np.zeros(len(odds), dtype=np.uint8), start)
    block = lm_score.BLOCK

    def per_token(blocks):
        return mixer.score([[b"a"] * (block * blocks - 1)], np.zeros(4))[0][0] / blocks

    assert abs(per_token(20) - per_token(1)) > 1e-3 * abs(per_token(1))


def test_lm_start_weights_are_fitted():
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (40_000, 3)).astype(float)
    want = np.array([0.1, 0.7, 0.4])
    outcome = (rng.random(len(x)) < 1 / (1 + np.exp(-x @ want))).astype(np.int64)
    assert lm_score.fit_weights(x, outcome, np.ones(len(x))) == pytest.approx(want, abs=0.05)
    assert lm_score.fit_weights(x[:0], outcome[:0], np.ones(0)) == pytest.approx(np.full(3, 1 / 3))


def test_lm_reads_bytes_and_looks_up_distinct_words():
    """tokens of any bytes, also outside UTF-8; a word that repeats is looked up once a batch."""
    raws = [b"", b" \t\r\n\x0b\x0c", b"  The the THE\x1cx \x85\xff cat\n", "\u0130A \u2003 b".encode(), b"the cat the dog"]
    want = [r.lower().split() for r in raws]
    tokens = lm_score.tokens_of(pa.array(raws, pa.binary()))
    assert tokens.to_pylist() == want and tokens.flatten().to_pylist() == [w for d in want for w in d]

    class Asked(dict):
        def get(self, word, other):
            asked.append(word)
            return super().get(word, other)

    coder, asked = lm_score.Coder([b"the", b"cat"], lm_score.huffman(np.array([8, 4, 2, 1])), lm_score.huffman(np.ones(256))), []
    coder.number = Asked(coder.number)
    got = coder.read(tokens)
    assert [(ids.tolist(), other) for ids, other in got] == [
        ([coder.number.setdefault(w, coder.escape) if w in (b"the", b"cat") else coder.escape for w in d], [w for w in d if w not in (b"the", b"cat")])
        for d in want]
    assert len(asked) == len(set(asked)) == len({w for d in want for w in d})


def test_lm_chances_of_symbols():
    """one logarithm a symbol tells the sum over its decisions, also where their product is beyond a double."""
    rng = np.random.default_rng(5)
    against, first = np.exp(rng.uniform(-14, 14, 400)), np.arange(0, 400, 8)
    assert lm_score.log_chances(against, first) == pytest.approx(-np.add.reduceat(np.log1p(against), first), rel=1e-12)
    assert lm_score.log_chances(np.full(120, np.exp(14.0)), np.array([0, 60])) == pytest.approx([-60 * np.log1p(np.exp(14.0))] * 2)
    assert len(lm_score.log_chances(np.zeros(0), np.zeros(0, dtype=np.int64))) == 0


def test_lm_odd_rows(odd, empty):
    out = lm_score.score_texts(odd).collect()
    assert len(out) == odd.count() and all(math.isfinite(r.score) for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 8)} == {1}
    assert lm_score.score_texts(empty).count() == 0


# ------------------------------------------------------------------ 10: quality
def test_pu_learning_separates(spark, docs, sf):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.classify(big, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    assert all(r.predicted == 1 for r in out if r.quality == 1)


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (5, 1), (5, 0), (None, 1), (6, None), (10, 0)], "doc_id long, quality int")
    out = quality.classify(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    none = quality.classify(odd, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(empty, labels).count() == 0
