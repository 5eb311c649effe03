"""Operator 13: alignment of the tokens of two tokenizers.

Both tokenizers run over the whole text. Places where a token of each ends and the next token of each starts
with a space are anchors; they split a document into windows, usually a word each. A window is known by its
token ids, and what its alignment gives (groups, links) is remembered by them, so a word is aligned once and
then looked up. Groups and links are then counted for the document, and links of the same two ids for the
corpus, in Spark.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.joins import checked_broadcast

from .common import register, staged, table

# Ids of the second tokenizer are told apart from those of the first by this offset.
SECOND = 1 << 20
# Windows and links a task remembers before it starts afresh, bytes of text that are aligned at a time, and
# the longest run of white space that the fast encoder gets (its pattern looks back over the whole of a run).
WINDOWS = 200_000
LINKS = 4_000_000
TOGETHER = 2_000_000
LONGEST_RUN = 1_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next free one from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(hidden)}


def first_tokenizer(path: str):
    """(encode a list of texts, bytes of each id) of a byte-level tokenizer in the JSON form of ``tokenizers``.

    Special tokens are ordinary text. Where ids are the ranks of merges and the pattern is the usual one, texts are
    encoded by ``tiktoken`` from the same vocabulary, which gives the same ids several times as fast.
    """
    import tiktoken
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    letters = byte_letters()
    vocabulary = whole.get_vocab(with_added_tokens=True)
    plain = {t: i for t, i in vocabulary.items() if t not in special}
    token_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        token_bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranked = [plain.get(a + b) for a, b in merges] == list(range(len(letters), len(letters) + len(merges)))
    pre = spec.get("pre_tokenizer") or {}
    usual = (ranked and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True))

    def encode_whole(texts):
        return [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]

    if not usual:
        return encode_whole, token_bytes
    from public_tokenizers import PATTERN
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={token_bytes[i]: i for i in plain.values()}, special_tokens={})
    import regex
    run = regex.compile(r"\s{%d}" % LONGEST_RUN)

    def encode(texts):
        return [encode_whole([t])[0] if run.search(t) else fast.encode_ordinary(t) for t in texts]
    return encode, token_bytes


def second_tokenizer(path: str):
    """(encode a list of texts, bytes of each id) of a ``sentencepiece`` model, which puts a space before a text."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token_bytes = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        token_bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return (lambda texts: model.encode(texts, num_threads=1)), token_bytes


def token_tables(token_bytes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(length in bytes, starts with a space) of each id."""
    return np.array([len(b) for b in token_bytes], dtype=np.int64), np.array([b[:1] == b" " for b in token_bytes])


class Windows:
    """What is remembered of windows: by number, the text of its groups, its groups and its links."""

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray):
        self.lengths_a, self.lengths_b = lengths_a, lengths_b
        self.names = [str(i) for i in range(max(len(lengths_a), len(lengths_b)))]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.groups, self.n_links, self.starts = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.links = np.zeros(0, dtype=np.int64)

    def of(self, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The numbers of the windows that ``cuts`` makes of ``ids`` (those of the first tokenizer, then of the second, each)."""
        if len(self.texts) > WINDOWS or len(self.links) > LINKS:
            self.forget()
        raw, at = ids.tobytes(), (cuts * ids.itemsize).tolist()
        keys = [raw[a:b] for a, b in zip(at, at[1:])]
        numbers = self.numbers
        new: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            if key not in numbers and key not in new:
                new[key] = i
        if new:
            base = len(self.texts)
            self._align(ids, cuts, np.fromiter(new.values(), dtype=np.int64))
            numbers.update(zip(new, range(base, base + len(new))))
        return np.fromiter(map(numbers.__getitem__, keys), dtype=np.int64, count=len(keys))

    def _align(self, ids: np.ndarray, cuts: np.ndarray, which: np.ndarray) -> None:
        """Aligns windows, all at once: in each, the tokens of both tokenizers cover the same bytes."""
        sizes = cuts[which + 1] - cuts[which]
        ids = ids[ranges(cuts[which], sizes)].astype(np.int64)
        window = np.repeat(np.arange(len(which)), sizes)
        second = ids >= SECOND
        a, b = ids[~second], ids[second] - SECOND
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        kind = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
        kind[ends_a] = 1
        kind[ends_b] |= 2
        # a link for each stretch between ends of either kind: the two tokens that cover it
        ends = np.flatnonzero(kind)
        of_a, of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = a[of_a] * len(self.lengths_b) + b[of_b]
        window_a, window_b = window[~second], window[second]
        n_links = np.bincount(window_a[of_a], minlength=len(which))
        shared = kind[ends] == 3
        n_groups = np.bincount(window_a[of_a[shared]], minlength=len(which))
        # tokens in the order of groups, the first tokenizer's before the second's
        stops = ends[shared]
        group_a, group_b = np.searchsorted(stops, ends_a), np.searchsorted(stops, ends_b)
        up_a, up_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(stops)))]) for g in (group_a, group_b))
        order = np.zeros(len(ids), dtype=np.int64)
        marks = np.zeros(len(ids), dtype=np.int64)
        place_a, place_b = np.arange(len(a)) + up_b[group_a], np.arange(len(b)) + up_a[group_b + 1]
        order[place_a], order[place_b] = a, b
        marks[place_a[up_a[1:] - 1]], marks[place_b[up_b[1:] - 1]] = 1, 2
        pieces = [""] * (2 * len(ids))
        pieces[0::2] = map(self.names.__getitem__, order.tolist())
        pieces[1::2] = map([",", "|", ";"].__getitem__, marks.tolist())
        stop = (2 * np.cumsum(sizes)).tolist()
        self.texts += ["".join(pieces[x:y - 1]) for x, y in zip([0, *stop], stop)]
        self.groups, self.n_links = np.concatenate([self.groups, n_groups]), np.concatenate([self.n_links, n_links])
        self.starts = np.concatenate([self.starts, len(self.links) + np.cumsum(n_links) - n_links])
        self.links = np.concatenate([self.links, links])


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def aligned_texts(texts: list[str], first, second, windows: Windows, spaces_a: np.ndarray, spaces_b: np.ndarray):
    """(n_a, n_b, n_groups, n_links, text of groups, links packed with their counts) of each text."""
    encode_a, bytes_a = first
    encode_b, bytes_b = second
    out: list = [(0, 0, 0, 0, "", [])] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    spaced = [" " + texts[i] for i in some]
    tokens = zip(some, spaced, encode_a(spaced), encode_b([texts[i] for i in some]))
    kept = [(i, a, b) for i, t, a, b in tokens
            if b"".join(map(bytes_a.__getitem__, a)) == t.encode() == b"".join(map(bytes_b.__getitem__, b))]
    if not kept:
        return out
    n_a, n_b = np.array([len(a) for _, a, _ in kept]), np.array([len(b) for _, _, b in kept])
    a, b = (np.fromiter((x for row in kept for x in row[side]), dtype=np.int64) for side in (1, 2))
    lengths_a, lengths_b = windows.lengths_a[a], windows.lengths_b[b]
    ends_a = np.cumsum(lengths_a)
    starts_a, starts_b = ends_a - lengths_a, np.cumsum(lengths_b) - lengths_b
    # a window starts where texts start, and where a token of each starts with a space: what is before ends for both
    kind = np.zeros(int(ends_a[-1]), dtype=np.uint8)
    kind[starts_a[spaces_a[a]]] = 1
    kind[starts_b[spaces_b[b]]] |= 2
    doc_a = np.cumsum(n_a) - n_a
    kind[starts_a[doc_a]] = 3
    begins = np.flatnonzero(kind == 3)
    from_a, from_b = np.searchsorted(starts_a, begins), np.searchsorted(starts_b, begins)
    at_a, at_b = np.searchsorted(begins, starts_a, "right") - 1, np.searchsorted(begins, starts_b, "right") - 1
    ids = np.zeros(len(a) + len(b), dtype="<u4")
    ids[np.arange(len(a)) + from_b[at_a]] = a
    ids[np.arange(len(b)) + np.append(from_a, len(a))[at_b + 1]] = b + SECOND
    numbers = windows.of(ids, np.append(from_a + from_b, len(ids)))
    doc_w = np.append(np.searchsorted(begins, starts_a[doc_a]), len(begins))
    n_links = windows.n_links[numbers]
    links = windows.links[ranges(windows.starts[numbers], n_links)]
    total = np.add.reduceat(n_links, doc_w[:-1])
    groups = np.add.reduceat(windows.groups[numbers], doc_w[:-1])
    pairs, counts = np.unique(np.repeat(np.arange(len(kept)), total) << 31 | links, return_counts=True)
    doc_p = np.searchsorted(pairs, np.arange(len(kept) + 1) << 31)
    packed = (pairs & ((1 << 31) - 1)) << 32 | counts
    named = list(map(windows.texts.__getitem__, numbers.tolist()))
    for n, (i, _, _) in enumerate(kept):
        out[i] = (int(n_a[n]), int(n_b[n]), int(groups[n]), int(total[n]), ";".join(named[doc_w[n]:doc_w[n + 1]]),
                  packed[doc_p[n]:doc_p[n + 1]])
    return out


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
               with_groups: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, row (a number of its own), n_a, n_b, n_groups, n_links, groups_sha256, pairs (links of
    equal ids: both ids in the upper half, their count in the lower), and with ``with_groups`` the text of the groups.

    Null and empty texts, and texts that the tokens of one tokenizer do not spell, have zeros, an empty sha256 and no
    pairs. Rows that repeat are aligned each. A very long text, or a word of any length, is aligned whole.
    """
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>"
              + (", groups string" if with_groups else ""))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        first, second = first_tokenizer(path_a), second_tokenizer(path_b)
        (lengths_a, spaces_a), (lengths_b, spaces_b) = token_tables(first[1]), token_tables(second[1])
        if len(lengths_a) * len(lengths_b) >= 1 << 31 or len(lengths_a) >= SECOND:
            raise ValueError("the vocabularies are too large for pairs of ids")
        windows = Windows(lengths_a, lengths_b)
        for b in batches:
            sizes = pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(sizes) // TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                some = b.slice(lo, hi - lo)
                got = aligned_texts(some.column("text").to_pylist(), first, second, windows, spaces_a, spaces_b)
                numbers = [pa.array([g[c] for g in got], pa.int64()) for c in range(4)]
                sha = [hashlib.sha256(g[4].encode()).hexdigest() if g[0] else "" for g in got]
                ends = np.cumsum([0] + [len(g[5]) for g in got]).astype(np.int32)
                pairs = np.concatenate([np.asarray(g[5], dtype=np.int64) for g in got])
                columns = [some.column("row"), some.column("doc_id"), *numbers, pa.array(sha),
                           pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs))]
                if with_groups:
                    columns.append(pa.array([g[4] for g in got]))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    slim = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): the links of each pair of ids in the corpus, and whether no other pair of its second id has more."""
    links = aligned.select(F.explode("pairs").alias("x"))
    pairs = staged(links.groupBy(F.shiftright("x", 32).alias("pair")).agg(F.sum(F.col("x").bitwiseAND((1 << 32) - 1)).alias("n")), "pairs")
    most = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return staged(pairs.withColumn("b", F.col("pair") % size_b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups).

    ``n_best`` are the links whose pair of ids is, over all rows, the most linked of its second id (ties count), and
    ``count_sum`` is the sum of that pair's links over the row's links. See ``alignments`` for odd texts; an empty table
    gives no rows, and further columns are not looked at. Ids that are no whole numbers are an error.
    """
    aligned = staged(alignments(docs, path_a, path_b, id_col, text_col, with_groups), "aligned")
    size_b = len(second_tokenizer(path_b)[1])
    counts = pair_counts(aligned, size_b)
    links = aligned.select("row", F.explode("pairs").alias("x")).select(
        "row", F.shiftright("x", 32).alias("pair"), F.col("x").bitwiseAND((1 << 32) - 1).alias("times"))
    # pair counts are bounded by the vocabularies: beyond the usual bound still cheaper than every link shuffled
    sums = links.join(checked_broadcast(counts, max_bytes=256 << 20), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *(["groups"] if with_groups else []))


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@register("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), *default_tokenizers())
