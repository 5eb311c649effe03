"""Operator 7: best-fit packing with certified partitions.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. The pieces are dealt over
partitions; each partition is packed best-fit decreasing and compared with a lower bound on its number of
sequences from dual feasible functions. A partition whose count equals its bound is certified optimal and
done. The others keep their full enough sequences, give up the documents of the loose ones, meet other
open partitions, and are packed again, until everything is certified or a single group is left. That one has
no partition to meet: its loose sequences are rerun among themselves, with more and more of the others,
until its count is certified or a rerun of all of them gains nothing (``certified`` is false then).
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from bisect import bisect_left
from operator import neg

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import register, row_key, staged, table

CAPACITY = 4096
END_ID = 1
# Pieces that one partition packs at a time, and open partitions that meet in a round.
PIECES_PER_PARTITION = 100_000
FAN_IN = 8
# Orders in which the open sequences of the last group are packed again before more of them join.
TRIES = 6
# Items up to which the open sequences are searched exactly as well.
EXACT_ITEMS = 12
# Words whose ids a task remembers, before the memory turns over.
CACHE_WORDS = 300_000

# Texts of these characters only can be cut at white space before tokenising: lower case, white space and
# composition of each of them is the same everywhere. Any other text goes through the tokenizer whole.
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ž]*")

# Runs of these at the end of a word are one unit of the tokenizer (an apostrophe may begin another).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class TokenIds:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never joins tokens across it, so ids are remembered by word:
    in the current memory, and in the one before it, from which words in use move on.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self._tokenizer.to_str())
        steps = [x["type"] for key, part in (("normalizers", "normalizer"), ("pretokenizers", "pre_tokenizer"))
                 for x in (spec[part] or {}).get(key, [])]
        patterns = [x["pattern"]["Regex"] for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if "pattern" in x]
        # words are only remembered for tokenizers of this make; others take all texts whole
        self._by_word = steps == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] and patterns == [_UNITS]
        # the same model for words that are normalised and cut already
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = None
        self._plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> list[bytes]:
        got = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in got]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only: each is one unit of the tokenizer, so they can share a text."""
        got = self._plain.encode(" ".join(words), add_special_tokens=False)
        ids = np.asarray(got.ids, dtype="<u4").tobytes()
        cuts = (np.searchsorted(np.asarray(got.word_ids), np.arange(len(words) + 1)) * 4).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, unknown: set[str]) -> None:
        known, before = self._known, self._before
        letters, other, joined = set(), [], []
        for w in unknown:
            if w in before:
                known[w] = before[w]
            elif w.isalpha():
                letters.add(w)
            elif (head := w.rstrip(_MARKS)).isalpha():
                # a letter run before a run of marks: the ids of both parts
                joined.append((w, head))
                if head not in known:
                    letters.add(head)
            else:
                other.append(w)
        letters = list(letters)
        for at in range(0, len(letters), 1000):
            part = letters[at:at + 1000]
            known.update(zip(part, self._encode_letters(part)))
        known.update(zip(other, self._encode(other)))
        if joined:
            tails = list({w[len(head):] for w, head in joined})
            marks = dict(zip(tails, self._encode(tails)))
            known.update((w, known[head] + marks[w[len(head):]]) for w, head in joined)

    def batch(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > CACHE_WORDS:
            self._before, self._known = self._known, {}
        known = self._known
        cut = [unicodedata.normalize("NFC", t).lower().split() if self._by_word and _PLAIN.fullmatch(t) else None
               for t in texts]
        unknown = set().union(*(words for words in cut if words is not None)).difference(known)
        if unknown:
            self._learn(unknown)
        out = [b"" if words is None else b"".join(map(known.__getitem__, words)) for words in cut]
        whole = [i for i, words in enumerate(cut) if words is None]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids
        return out


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32): token pieces of every row.

    Null texts are empty and give one piece that holds the end id only. Only documents longer than
    ``capacity`` are cut.
    """
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def cut(batches):
        # of the task alone: a worker that serves other operators later keeps nothing
        ids_of = TokenIds(tokenizer_path).batch
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows: list[tuple] = []
                for n, ids in enumerate(ids_of(part.column("text").to_pylist())):
                    ids += end
                    for p, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start:start + 4 * capacity]
                        rows.append((n, p, start // 4, len(piece) // 4, zlib.crc32(piece)))
                n, p, start, length, crc = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(n)), part.column("key").take(pa.array(n)),
                     pa.array(p, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "key", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), row_key(docs, id_col, text_col).alias("key"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(cut, "doc_id long, key long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Largest bound that the dual feasible functions give on the number of sequences of ``lengths``.

    Used are the identity; for each threshold t up to half the capacity, the function that rounds
    lengths over capacity - t up to a whole sequence and drops lengths under t; and, for k up to 20, the
    rounding functions u(k) that keep multiples of capacity / (k + 1) and round the others down to
    multiples of 1 / k.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * x).sum()) // capacity)
    n_from = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    sum_from = np.concatenate([np.cumsum((counts * x)[::-1])[::-1], [0]])
    t = np.arange(1, capacity // 2 + 1)
    big = n_from[capacity - t + 1]
    middle = sum_from[t] - sum_from[capacity - t + 1]
    best = max(best, int((big + -(-middle // capacity)).max()))
    for k in range(1, 21):
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, offset in it). Open bins are kept by free space; a bit set of the free spaces
    in use finds the tightest one in constant time."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, n_bins = 0, 0
    for i in order.tolist():
        size = int(lengths[i])
        fit = in_use >> size
        if fit:
            free = size + (fit & -fit).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                in_use ^= 1 << free
        else:
            free, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - size
        if left:
            by_free[left].append(b)
            in_use |= 1 << left
    return bins, offsets


def fullest_fit(lengths: np.ndarray, capacity: int, rng: np.random.Generator | None = None) -> np.ndarray:
    """Bin of each item. Each bin takes the longest item left and, of the others, those that fill it best
    (sums that can be reached are bits of one number); of equal fills the one of longer items, or with
    ``rng`` one of any lengths."""
    bins = np.empty(len(lengths), dtype=np.int64)
    left: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable")[::-1].tolist():
        left.setdefault(int(lengths[i]), []).append(i)
    sizes = sorted(left, reverse=True)
    n_bins = 0

    def take(size: int) -> int:
        at = left[size].pop()
        if not left[size]:
            del sizes[bisect_left(sizes, -size, key=neg)]
        return at

    while sizes:
        first = sizes[0]
        bins[take(first)] = n_bins
        room = capacity - first
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        # the lengths that fit, one by one: a bin is mostly full after a few of them
        begin = bisect_left(sizes, -room, key=neg)
        tried = range(begin, len(sizes)) if rng is None else begin + rng.permutation(len(sizes) - begin)
        for i in tried:
            size = sizes[i]
            copies, chunk = min(len(left[size]), room // size), 1
            while copies:
                chunk = min(chunk, copies)
                steps.append((size, chunk, reach))
                reach |= (reach << (size * chunk)) & mask
                copies -= chunk
                chunk *= 2
            if reach >> room:
                break
        target = reach.bit_length() - 1
        for size, chunk, before in reversed(steps):
            if not before >> target & 1:
                target -= size * chunk
                for _ in range(chunk):
                    bins[take(size)] = n_bins
        n_bins += 1
    return bins


def exact_fit(lengths: np.ndarray, capacity: int, n_bins: int) -> np.ndarray | None:
    """Bin of each item in ``n_bins`` bins, or None if there is no such packing; for a few items."""
    order = np.argsort(-lengths, kind="stable").tolist()
    free, bins = [capacity] * n_bins, np.empty(len(lengths), dtype=np.int64)

    def place(at: int) -> bool:
        if at == len(order):
            return True
        size, tried = int(lengths[order[at]]), set()
        for b in range(n_bins):
            if free[b] >= size and free[b] not in tried:
                tried.add(free[b])
                free[b] -= size
                bins[order[at]] = b
                if place(at + 1):
                    return True
                free[b] += size
        return False

    return bins if place(0) else None


def offsets_of(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Gapless places of items in their bins."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    first = np.searchsorted(bins[order], bins[order])
    out = np.empty(len(lengths), dtype=np.int64)
    out[order] = starts - starts[first]
    return out


def rerun(lengths: np.ndarray, bins: np.ndarray, capacity: int, bound: int) -> np.ndarray:
    """Bins of a packing that needs more than ``bound``, with fewer of them where that is found.

    The emptiest bins, enough of them to hold the space to be saved, give up their items, which are packed
    again in ``TRIES`` orders, and by exact search if they are few; without a gain more bins join them, at
    last all. It ends when the count is certified or a rerun of all bins gains nothing.
    """
    rng = np.random.default_rng(7)
    bins = bins.copy()
    n_bins = int(bins.max()) + 1
    widened = 0
    while n_bins > bound:
        fill = np.bincount(bins, weights=lengths, minlength=n_bins)
        emptiest = np.argsort(fill, kind="stable")
        space = np.cumsum(capacity - fill[emptiest])
        n_open = min(n_bins, (int(np.searchsorted(space, capacity)) + 3) << (2 * widened))
        items = np.flatnonzero(np.isin(bins, emptiest[:n_open]))
        for attempt in range(TRIES + 1):
            if attempt < TRIES:
                again = fullest_fit(lengths[items], capacity, rng if attempt else None)
            else:
                again = exact_fit(lengths[items], capacity, n_open - 1) if len(items) <= EXACT_ITEMS else None
            if again is not None and again.max() + 1 < n_open:
                bins[items] = n_bins + again
                bins = np.unique(bins, return_inverse=True)[1]
                n_bins, widened = int(bins.max()) + 1, 0
                break
        else:
            if n_open == n_bins:
                break
            widened += 1
    return bins


def _pack_groups(capacity: int, last: bool):
    """Packs each group of a sorted partition; marks the pieces of loose sequences of open groups."""
    def run(batches):
        held: list = []

        def pack(parts, group):
            t = pa.Table.from_batches(parts)
            # the result does not depend on the order in which rows arrived
            t = t.sort_by([("length", "descending"), ("key", "ascending"), ("piece", "ascending"), ("copy", "ascending")])
            lengths = t.column("length").to_numpy()
            bins, offsets = best_fit_decreasing(lengths, capacity)
            n_bins, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
            loose = np.zeros(len(bins), dtype=bool)
            if n_bins > bound and last:
                # no other group to meet
                bins = rerun(lengths, bins, capacity, bound)
                n_bins, offsets = int(bins.max()) + 1, offsets_of(lengths, bins)
            elif n_bins > bound:
                # give up the emptiest sequences: enough of them to hold the space that is to be saved
                fill = np.bincount(bins, weights=lengths, minlength=n_bins)
                emptiest = np.argsort(fill, kind="stable")
                space = np.cumsum(capacity - fill[emptiest])
                n_loose = int(np.searchsorted(space, (n_bins - bound + 1) * capacity)) + 1
                loose = np.isin(bins, emptiest[:n_loose])
            t = t.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))
            t = t.append_column("loose", pa.array(loose)).append_column("certified", pa.array(np.full(len(bins), n_bins == bound)))
            return t.to_batches()

        current = None
        for b in batches:
            groups = b.column("grp").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and groups[lo] != current:
                    yield from pack(held, current)
                    held = []
                current = groups[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from pack(held, current)
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION) -> DataFrame:
    """Adds (sequence_id, offset, certified) to the rows of ``pieces``.

    Sequences are gapless from offset 0 and hold at most ``capacity`` tokens. A group never holds much
    more than ``per_partition`` pieces, whatever the sizes of documents: it is a count of rows, and a
    row is a few numbers. ``certified`` says that the group it was packed in needs that many sequences.
    Sequences are numbered by round, group and bin, full ones by negative numbers.
    """
    columns = ["doc_id", "key", "piece", "start", "length", "ids_crc32"]
    out_cols = [*columns, "sequence_id", "offset", "certified"]
    full = parts.where(F.col("length") == capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    rest = parts.where(F.col("length") < capacity)
    n = rest.count()
    n_groups = max(1, -(-n // per_partition))
    # a number per repeated piece makes every row distinct and the packing repeatable
    open_rows = rest.withColumn("copy", F.monotonically_increasing_id()).withColumn(
        "grp", F.pmod(F.xxhash64("key", "piece", "copy"), F.lit(n_groups)).cast("long"))
    done, level = [], 0
    schema = ("doc_id long, key long, piece int, start long, length long, ids_crc32 long, copy long, grp long, "
              "bin long, offset long, loose boolean, certified boolean")
    while True:
        last = n_groups == 1
        packed = staged(open_rows.select(*columns, "copy", "grp").repartition(n_groups, "grp").sortWithinPartitions("grp")
                        .mapInArrow(_pack_groups(capacity, last), schema), "packed")
        done.append(packed.where("not loose").select(
            *columns, (F.lit(level << 57) + F.shiftleft("grp", 32) + F.col("bin")).alias("sequence_id"), "offset", "certified"))
        if last:
            break
        loose = packed.where("loose")
        n_loose = loose.count()
        if not n_loose:
            break
        level += 1
        n_groups = max(1, min(-(-n_groups // FAN_IN), -(-n_loose // max(1, per_partition // FAN_IN))))
        open_rows = loose.withColumn("grp", F.pmod(F.xxhash64("grp", F.lit(level)), F.lit(n_groups)).cast("long"))
    every = full
    for d in done:
        every = every.unionByName(d)
    return every.select(*out_cols)


def op7_rows(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(staged(pieces(docs, tokenizer_path), "pieces")).drop("key")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_rows(table(spark, sf_dir, "documents"), default_tokenizer())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of every document."""
    return op7_rows(docs, default_tokenizer())
