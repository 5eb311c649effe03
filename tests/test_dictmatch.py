import random

from pyspark.sql import functions as F

from factloom.functions.text import running_total
from factloom.operators import dictmatch as dm
from factloom.plans.composites import document_matches

GAZ_SCHEMA = ("loc_id bigint, loc_type string, lat double, lon double, town_en string, town_ar string, "
              "admin3_en string, admin3_ar string, admin2_en string, admin2_ar string")


def gaz(spark, rows):
    full = [(r + (None,) * 10)[:10] for r in rows]
    return spark.createDataFrame(full, GAZ_SCHEMA)


def hits_of(spark, texts, names):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    g = gaz(spark, [(i + 1, "t", 0.0, 0.0, n) for i, n in enumerate(names)])
    d = dm.place_dictionary(g)
    h = dm.match_terms(docs, d)
    return sorted((r.doc_id, r.start, r.end, r.term) for r in h.collect())


def greedy(tokens, terms):
    """Plain-Python leftmost-longest scan (the rule under test)."""
    out, i = [], 0
    by_len = sorted(terms, key=lambda t: -len(t))
    while i < len(tokens):
        for t in by_len:
            if tuple(tokens[i:i + len(t)]) == t:
                out.append((i, i + len(t), " ".join(t)))
                i += len(t)
                break
        else:
            i += 1
    return out


def test_leftmost_longest_and_resume(spark):
    h = hits_of(spark, ["New York City is new", "york city new york"], ["New York", "York City", "New"])
    assert h == [(0, 0, 2, "New York"), (0, 4, 5, "New"), (1, 0, 2, "York City"), (1, 2, 4, "New York")]


def test_overlap_chain_is_resolved_greedily(spark):
    h = hits_of(spark, ["a b c d e"], ["a b", "b c", "c d", "d e"])
    assert [(s, e) for _, s, e, _ in h] == [(0, 2), (2, 4)]


def test_case_and_punctuation(spark):
    h = hits_of(spark, ["Visit AL-HILLAH, then Al Hillah."], ["Al-Hillah"])
    # the variant with a space is the reported term (added after the original)
    assert [(s, e, t) for _, s, e, t in h] == [(1, 3, "Al Hillah"), (4, 6, "Al Hillah")]


def test_random_texts_agree_with_plain_scan(spark):
    rnd = random.Random(7)
    vocab = ["a", "b", "c", "d", "e"]
    terms = [("a",), ("a", "b"), ("b", "c", "d"), ("c",), ("d", "e"), ("e", "a", "b")]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    got = hits_of(spark, texts, [" ".join(t) for t in terms])
    want = sorted((i, s, e, t) for i, x in enumerate(texts) for s, e, t in greedy(x.split(), terms))
    assert [(i, s, e, t.lower()) for i, s, e, t in got] == want


def test_last_payload_wins_and_null_id_skipped(spark):
    g = gaz(spark, [(1, "t", 0.0, 0.0, "Basra"), (2, "t", 0.0, 0.0, "basra"), (None, "t", 0.0, 0.0, "Mosul")])
    d = dm.place_dictionary(g)
    rows = {r.term_norm: r.key for r in d.collect()}
    assert rows == {"basra": "2"}


def test_winner_most_frequent_then_first_seen(spark):
    docs = spark.createDataFrame([(1, "Erbil Duhok Duhok Erbil Basra"), (2, "Basra Erbil Erbil")],
                                 "doc_id bigint, content string")
    g = gaz(spark, [(10, "t", 1.0, 2.0, "Erbil"), (20, "t", 3.0, 4.0, "Duhok"), (30, "t", 5.0, 6.0, "Basra")])
    m = document_matches(docs, g, None)
    got = {r.doc_id: (r.loc_id, r.matched_term, r.lat) for r in m.collect()}
    assert got == {1: (10, "Erbil", 1.0), 2: (10, "Erbil", 1.0)}


def test_special_term_needs_context(spark):
    docs = spark.createDataFrame(
        [(1, "The Key market in Iraq is open"), (2, "A Key to the door. Key again"), (3, "Key near iraq")],
        "doc_id bigint, content string")
    g = gaz(spark, [(1, "market", 0.0, 0.0, "Key")])
    fixed = {r.doc_id for r in document_matches(docs, g, None).collect()}
    assert fixed == {1, 3}
    compat = {r.doc_id for r in document_matches(docs, g, None, compat=True).collect()}
    assert compat == set()


def test_topic_labels_in_text_order_and_gate(spark):
    docs = spark.createDataFrame([(1, "we build a new project"), (2, "nothing here")], "doc_id bigint, content string")
    topics = spark.createDataFrame([(1, "build OR construct", "Build", "T"), (2, "project", "Project", "T")],
                                   "ord int, keywords string, label string, topic_type string")
    d = dm.topic_dictionary(topics)
    h = dm.match_terms(docs, d)
    lab = dm.summarize(dm.per_term(h)).collect()
    assert [(r.doc_id, r.topic_terms) for r in lab] == [(1, "Build, Project")]
    row = lab[0]
    assert spark.createDataFrame([(row.topic_terms,)], "t string").select(dm.passes_gate(F.col("t"))).first()[0]


def test_shuffle_join_path_gives_the_same_hits(spark):
    texts = ["new york city is new", "a b c d e", "york city new york"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    g = gaz(spark, [(1, "t", 0.0, 0.0, "New York"), (2, "t", 0.0, 0.0, "York City"), (3, "t", 0.0, 0.0, "New"),
                    (4, "t", 0.0, 0.0, "b c"), (5, "t", 0.0, 0.0, "c d e")])
    d = dm.place_dictionary(g)
    index, small = dm.index_terms(d)
    index1, big = dm.index_terms(d, max_rows=1)
    # the bound decides about broadcasting and nothing else
    assert (big.rows, big.max_tokens, big.has_special, big.before, big.after) == (small.rows, small.max_tokens, small.has_special, small.before, small.after)
    key = dm.place_dictionary(gaz(spark, [(i, "t", 0.0, 0.0, n) for i, n in enumerate(["Aa", "Bb", "Key", "Cc"])]))
    assert dm.index_terms(key, max_rows=1)[1].has_special and dm.index_terms(key)[1].has_special
    assert small.broadcast and not big.broadcast and big.max_tokens == small.max_tokens == 3
    a = sorted(tuple(r) for r in dm.match_terms(docs, index, info=small).collect())
    b = sorted(tuple(r) for r in dm.match_terms(docs, index1, info=big).collect())
    assert a == b and len(a) == 5          # "c d e" overlaps the earlier "b c"


def test_terms_are_looked_up_by_their_rarest_token(spark):
    names = ["Al Basra", "Al Kut", "Al Amarah", "Al Hillah", "Al Najaf", "Kut", "the green zone"]
    texts = ["al kut and al basra near kut", "al al najaf al", "nothing", "the the the the green the green zone", "green " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    d = dm.place_dictionary(gaz(spark, [(i + 1, "t", 0.0, 0.0, n) for i, n in enumerate(names)]))
    index, info = dm.index_terms(d, docs)
    probes = {r.term_norm: (r.probe, r.probe_at) for r in index.collect()}
    assert probes == {"al basra": ("basra", 1), "al kut": ("kut", 1), "al amarah": ("amarah", 1), "al hillah": ("hillah", 1),
                      "al najaf": ("najaf", 1), "kut": ("kut", 0), "the green zone": ("zone", 2)}
    # a row per occurrence of a rare token, whatever the 60 times that "al", "the" and "green" stand in the texts
    assert dm.probed(docs, index, "doc_id", "content", info).count() == 7
    a = sorted(tuple(r) for r in dm.match_terms(docs, index, info=info).collect())
    assert sorted((r[0], r[4], r[5], r[3]) for r in a) == [
        (0, 0, 2, "Al Kut"), (0, 3, 5, "Al Basra"), (0, 6, 7, "Kut"), (1, 1, 3, "Al Najaf"), (3, 5, 8, "the green zone")]
    # without a look at the texts the choice may differ, the hits may not
    assert sorted(tuple(r) for r in dm.match_terms(docs, d).collect()) == a
    first, blind = dm.index_terms(d)
    assert sorted(tuple(r) for r in dm.match_terms(docs, first, info=blind).collect()) == a


def test_random_dictionaries_agree_with_plain_scan_both_ways(spark):
    rnd = random.Random(11)
    vocab = ["al", "the", "x", "y", "z", "w"]
    terms = sorted({tuple(rnd.choice(vocab) for _ in range(rnd.randint(1, 4))) for _ in range(14)})
    texts = ["  ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    d = dm.place_dictionary(gaz(spark, [(i + 1, "t", 0.0, 0.0, " ".join(t)) for i, t in enumerate(terms)]))
    want = sorted((i, s, e, t) for i, x in enumerate(texts) for s, e, t in greedy(x.split(), terms))
    for max_rows in (1, 1000):
        index, info = dm.index_terms(d, docs, max_rows=max_rows)
        got = dm.match_terms(docs, index, info=info, spans=True).collect()
        assert sorted((r.doc_id, r.start, r.end, r.term) for r in got) == want
        assert all(" ".join(texts[r.doc_id][r.from_char:r.to_char].split()) == r.term for r in got)


def test_character_spans_and_spelling(spark):
    texts = ["Visit AL-HILLAH, then Al  Hillah.", "\u0130n Al.Hillah \u00dcber al/hillah", "x" * 300 + " " + "word " * 400 + "al-hillah", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, content string")
    d = dm.place_dictionary(gaz(spark, [(1, "t", 0.0, 0.0, "Al-Hillah")]))
    hits = dm.match_terms(docs, d, spans=True)
    got = sorted((r.doc_id, r.from_char, r.spelling, r.term) for r in dm.with_spelling(hits, docs).collect())
    assert got == [(0, 6, "AL-HILLAH", "Al Hillah"), (0, 22, "Al  Hillah", "Al Hillah"), (1, 3, "Al.Hillah", "Al Hillah"),
                   (1, 18, "al/hillah", "Al Hillah"), (2, 2301, "al-hillah", "Al Hillah")]


def test_running_totals_of_long_arrays(spark):
    for n in (0, 1, 127, 128, 129, 1000, 40_000):
        row = spark.range(1).select(F.when(F.lit(n) == 0, F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda x: (x % 7).cast("int"))).alias("a")).select("a", running_total(F.col("a")).alias("t")).first()
        total, want = 0, []
        for x in row.a:
            total += x
            want.append(total)
        assert row.t == want
