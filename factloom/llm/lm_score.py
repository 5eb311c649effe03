"""Operator 9: language-model scores by online logistic context mixing.

Tokens are lower-cased words and one end per document. A token is coded by binary decisions: a walk down a
Huffman tree over the training vocabulary (frequent words take few decisions). A word outside it is an
escape, then one of two spellings, each with probability ``LISTED`` or the rest: its entry in the list of
all other training words, by count, or its bytes, each a walk down a Huffman tree over bytes. Three
predictors give the odds of each decision from counts of the training texts in hashed contexts:

    words: the node alone; the node and the last very frequent word (which tells the language); the node and
    the previous token
    bytes: the node and the previous one, two or three bytes

Their log odds are mixed by weights chosen by a gate (kind of decision, and how much the longest context has
seen) and corrected by an adaptive probability map. The weights that documents start with are fitted to a
tenth of the training texts, predicted by a model (trees and counts) of three other tenths. Weights and map
start alike for every document and learn online from its own decisions, block by block, always after a block
was scored. The sum of the decisions' log probabilities is the text's score.
"""

from __future__ import annotations

import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import register, staged, table

# Bounds of the model: words with a code (the most frequent of those seen twice or more), slots of each
# hashed context table, very frequent words that serve as context.
VOCABULARY = 1 << 18
SLOT_BITS = 21
TOPICS = 256
LISTED = 0.5
# Tokens and spelled words of a block; learning rates.
BLOCK, SPELLED_BLOCK = 64, 8
RATE, MAP_RATE = 0.02, 0.03
# Steps of evidence of the longest context.
_EVIDENCE = np.array([1, 4, 16, 128])
_GATES = len(_EVIDENCE) + 1
_KINDS = ("words", "bytes")
_PREDICTORS = 3
_BUCKETS = 25
# Steps that log odds are counted in to fit the start weights, from -_REACH to _REACH; they are even on the root
# of the log odds, as the plain counts of a Huffman tree are near 0.
_STEPS, _REACH = 41, 12.0
# All 16-bit floats, by their bits.
_HALVES = np.arange(1 << 16, dtype=np.uint16).view(np.float16).astype(np.float32)
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id falls into fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5, F.lit(0))


def huffman(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, bit) of each node of a Huffman tree: leaves first, the root last."""
    n = len(weights)
    order = np.argsort(weights, kind="stable")
    leaves = weights[order].tolist()
    order = order.tolist()
    parent, bit = np.zeros(2 * n - 1, dtype=np.int32), np.zeros(2 * n - 1, dtype=np.uint8)
    made: list = []
    a = b = 0
    for node in range(n, 2 * n - 1):
        total = 0
        for side in (0, 1):
            if b >= len(made) or a < n and leaves[a] <= made[b]:
                child, w = order[a], leaves[a]
                a += 1
            else:
                child, w = n + b, made[b]
                b += 1
            parent[child], bit[child] = node, side
            total += w
        made.append(total)
    return parent, bit


class Code:
    """Paths of all symbols of a Huffman tree, from leaf to root."""

    def __init__(self, parent: np.ndarray, bit: np.ndarray):
        n = (len(parent) + 1) // 2
        root = 2 * n - 2
        levels, at = [], np.arange(n)
        live = np.arange(n) if n > 1 else np.zeros(0, dtype=np.int64)
        size = np.zeros(n, dtype=np.int32)
        while len(live):
            up = parent[at[live]]
            levels.append((live, up - n, bit[at[live]]))
            size[live] += 1
            at[live] = up
            live = live[up != root]
        self.size = size
        self.start = np.cumsum(size, dtype=np.int64) - size
        # node and bit of each decision as one number
        self.steps = np.zeros(size.sum(), dtype=np.uint32)
        for depth, (who, node, b) in enumerate(levels):
            self.steps[self.start[who] + depth] = node * 2 + b

    def walk(self, symbols: np.ndarray):
        """(decisions of each symbol, node and bit of every decision)."""
        size = self.size[symbols]
        first = np.cumsum(size, dtype=np.int64) - size
        at = np.repeat(self.start[symbols] - first, size)
        at += np.arange(len(at))
        steps = self.steps.take(at)
        return size, steps >> np.uint32(1), (steps & np.uint32(1)).astype(np.uint8)


def first_table(n_words: int) -> int:
    """Slots of the unhashed table: nodes of the word tree, then nodes of the byte tree by the byte before."""
    return n_words + 1 + 256 * 256


def slots_of(node: np.ndarray, context: np.ndarray) -> np.ndarray:
    h = node * _K[0]
    h += context
    h ^= h >> np.uint32(15)
    h *= _K[1]
    h >>= np.uint32(32 - SLOT_BITS)
    return h


class Coder:
    """Turns documents into symbols with contexts. ``words`` are the coded words, most frequent first."""

    def __init__(self, words: list[bytes], word_tree, byte_tree):
        self.number = {w: i for i, w in enumerate(words)}
        self.n_words = len(words)
        self.end, self.escape = self.n_words, self.n_words + 1
        self.word_code, self.byte_code = Code(*word_tree), Code(*byte_tree)

    def read(self, tokens: pa.ListArray) -> list[tuple[np.ndarray, list[bytes]]]:
        """Of each document, the numbers of its words and those words that are not coded. Each distinct word of
        ``tokens`` is looked up once."""
        flat = tokens.flatten().dictionary_encode()
        words, word = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), flat.indices.to_numpy()
        numbers = np.fromiter(map(self.number.get, words, repeat(self.escape)), dtype=np.int64, count=len(words))
        ids = numbers.take(word)
        at = np.flatnonzero(ids == self.escape)
        other = [words[i] for i in word[at].tolist()]
        ends = np.cumsum(pc.list_value_length(tokens).to_numpy(), dtype=np.int64)
        cuts, rare = [0, *ends.tolist()], [0, *np.searchsorted(at, ends).tolist()]
        return [(ids[cuts[i]:cuts[i + 1]], other[rare[i]:rare[i + 1]]) for i in range(len(ends))]

    def symbols(self, docs: list[tuple[np.ndarray, list[bytes]]]):
        """(symbols, document, place in it, words that are not coded, their symbol's index) of ``docs`` as read."""
        ids = np.concatenate([numbers for numbers, _ in docs])
        lengths = np.fromiter((len(numbers) for numbers, _ in docs), dtype=np.int64, count=len(docs)) + 1
        ends = np.cumsum(lengths) - 1
        doc = np.repeat(np.arange(len(docs), dtype=np.int32), lengths)
        symbols = np.full(len(doc), self.end, dtype=np.int64)
        inside = np.ones(len(doc), dtype=bool)
        inside[ends] = False
        symbols[inside] = ids
        place = np.arange(len(doc)) - np.repeat(ends + 1 - lengths, lengths)
        return symbols, doc, place, list(chain.from_iterable(other for _, other in docs)), np.flatnonzero(symbols == self.escape)

    def word_contexts(self, symbols: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Hashes of the last very frequent word and of the previous token, within the document."""
        before = np.empty(len(symbols), dtype=np.int64)
        before[1:] = symbols[:-1]
        before[place == 0] = self.end
        known = (before < TOPICS) | (place == 0)
        topic = before[np.maximum.accumulate(np.where(known, np.arange(len(symbols)), 0))]
        return [topic.astype(np.uint32) * _K[2], before.astype(np.uint32) * _K[3] + np.uint32(1)]

    @staticmethod
    def byte_contexts(words: list[bytes]):
        """(bytes, byte before, hashes of the two and of the three bytes before and these three as a number,
        number of the word of each byte)."""
        raw = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        back = []
        for j in (1, 2, 3):
            x = np.full(len(raw), 32, dtype=np.uint32)
            x[j:] = raw[:-j]
            x[inner < j] = 32
            back.append(x)
        two = back[0] + back[1] * np.uint32(256)
        three = two + back[2] * np.uint32(65536)
        return raw, back[0], [*Coder.hashed(two, three), three], owner

    @staticmethod
    def hashed(two: np.ndarray, three: np.ndarray) -> list[np.ndarray]:
        return [two * _K[2] + np.uint32(2), three * _K[3] + np.uint32(3)]

    @staticmethod
    def unpacked(four: np.ndarray):
        """(byte before, hashed contexts, byte) of three bytes and the byte after them."""
        three = four >> np.uint32(8)
        return three & np.uint32(255), Coder.hashed(three & np.uint32(65535), three), (four & np.uint32(255)).astype(np.int64)

    def byte_nodes(self, node: np.ndarray, before: np.ndarray) -> np.ndarray:
        """A byte decision's node is told apart by the byte before it."""
        return node + (np.uint32(self.n_words + 1) + np.uint32(256) * before)


def tokens_of(raw: pa.Array) -> pa.ListArray:
    """Runs of bytes other than ASCII white space, A-Z lower-cased, of each text."""
    text = pc.cast(raw, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))
    # white space at either end would make empty tokens there
    text = pc.ascii_trim_whitespace(pc.ascii_lower(text))
    tokens = pc.ascii_split_whitespace(text)
    empty = pc.equal(pc.binary_length(text), 0)
    return pc.if_else(empty, pa.scalar([], tokens.type), tokens).cast(pa.list_(pa.binary()))


def tenth(id_col: Column) -> Column:
    """Which tenth of its fold an id is in, for the start weights; a null id is in the last."""
    return F.coalesce(F.floor(F.crc32(id_col.cast("string").cast("binary")) / 5) % 10, F.lit(9))


def count_tokens(train: DataFrame) -> DataFrame:
    """(token, n) of the training texts (column raw); the end is the token of no bytes."""
    def counted(parts, ends):
        got = pa.chunked_array(parts).value_counts()
        token, n = got.flatten()
        return pa.RecordBatch.from_arrays([pa.concat_arrays([token, pa.array([b""], pa.binary())]), pa.concat_arrays([n, pa.array([ends], pa.int64())])],
                                          names=["token", "n"])

    def run(batches):
        parts, ends, tokens = [], 0, 0
        for b in batches:
            for at in range(0, b.num_rows, _READ):
                part = b.slice(at, _READ)
                parts.append(tokens_of(part.column("raw")).flatten())
                ends += part.num_rows
                tokens += len(parts[-1])
                if tokens >= _COUNTED_TOKENS:
                    yield counted(parts, ends)
                    parts, ends, tokens = [], 0, 0
        if parts:
            yield counted(parts, ends)

    return staged(train.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "token-counts")


def count_bytes(counts: DataFrame) -> np.ndarray:
    """How often each byte occurs in the training tokens, each followed by a space."""
    def run(batches):
        hist = np.zeros(256, dtype=np.int64)
        for b in batches:
            tokens, n = b.column("token").to_pylist(), b.column("n").to_numpy()
            sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1
            # a token's float64 weights are whole numbers and exact
            raw = np.frombuffer(b" ".join(tokens) + b" ", dtype=np.uint8)
            hist += np.bincount(raw, weights=np.repeat(n, sizes), minlength=256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256), pa.int32()), pa.array(hist, pa.int64())], names=["byte", "n"])

    hist = np.zeros(256, dtype=np.int64)
    tokens = counts.where(F.col("token") != F.lit(b""))
    for r in tokens.mapInArrow(run, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        hist[r["byte"]] = r["n"]
    return hist


class Trees:
    """What coding needs: the coded words and both trees; small enough to send to every worker."""

    def __init__(self, words, word_tree, byte_tree, counts):
        self.words, self.word_tree, self.byte_tree, self.counts = words, word_tree, byte_tree, counts

    def sent(self, spark: SparkSession):
        """A broadcast of lists and arrays only: an instance would be looked up by its class's name in a
        worker, which need not have this package."""
        return spark.sparkContext.broadcast((self.words, self.word_tree, self.byte_tree, self.counts))


def learn_trees(counts: DataFrame, n_train: int, ends: int) -> Trees:
    top = (counts.where((F.col("n") >= 2) & (F.col("token") != F.lit(b""))).orderBy(F.desc("n"), "token").limit(VOCABULARY).toArrow())
    words, n = top.column("token").to_pylist(), top.column("n").to_numpy().astype(np.int64)
    rest = n_train - int(n.sum()) - ends
    word_tree = huffman(np.concatenate([n, [ends + 1, rest + 1]]))
    # every byte has a code
    return Trees(words, word_tree, huffman(count_bytes(counts) + 1), n)


_coders: dict = {}


def _coder(trees_broadcast) -> tuple[np.ndarray, Coder]:
    """The counts of the coded words and one coder per task and model."""
    trees = trees_broadcast.value
    if _coders.get("trees") is not trees:
        _coders["trees"], _coders["coder"] = trees, Coder(*trees[:3])
    return trees[3], _coders["coder"]


_PART = 1 << 16
# Texts read at a time, symbols walked at a time, tokens counted and their decisions counted at a time, documents
# fitted to and tokens scored at a time.
_READ = 1000
_WALKS = 1 << 14
_COUNTED_TOKENS, _DECIDED_TOKENS = 1 << 20, 1 << 19
_FITTED = 100
_SCORED_TOKENS = 1 << 14


def add_counts(sums: list[np.ndarray], coder: Coder, docs: list[tuple[np.ndarray, list[bytes]]]) -> None:
    """Adds the decisions of ``docs`` to the counts of both outcomes of every slot (outcome 1 in odd places).
    A symbol in a context is walked once, however often it occurs."""
    symbols, _, place, other, _ = coder.symbols(docs)

    def pairs(context, what):
        got, n = np.unique((context.astype(np.uint64) << np.uint64(32)) | what.astype(np.uint64), return_counts=True)
        return (got >> np.uint64(32)).astype(np.uint32), (got & np.uint64(0xFFFFFFFF)).astype(np.int64), n

    def count(total, code, what, times, slot_of):
        """Adds the walks of the symbols, some at a time; ``slot_of`` maps nodes and symbol range to slots."""
        for lo in range(0, len(what), _WALKS):
            hi = lo + _WALKS
            size, node, bit = code.walk(what[lo:hi])
            slot = slot_of(node, lo, hi, size).astype(np.int64)
            slot *= 2
            slot += bit
            np.add.at(total, slot, np.repeat(times[lo:hi].astype(np.uint32), size))

    what, n = np.unique(symbols, return_counts=True)
    count(sums[0], coder.word_code, what, n, lambda node, lo, hi, size: node)
    for total, context in zip(sums[1:], coder.word_contexts(symbols, place)):
        context, what, n = pairs(context, symbols)
        count(total, coder.word_code, what, n, lambda node, lo, hi, size: slots_of(node, np.repeat(context[lo:hi], size)))
    if not other:
        return
    raw, before, contexts, _ = coder.byte_contexts(other)
    first, what, n = pairs(before, raw)
    count(sums[0], coder.byte_code, what, n, lambda node, lo, hi, size: coder.byte_nodes(node, np.repeat(first[lo:hi], size)))
    # the three bytes before and the byte itself, as one number, tell all longer contexts
    four, n = np.unique(contexts[2] << np.uint32(8) | raw, return_counts=True)
    before, contexts, what = coder.unpacked(four)
    for total, context in zip(sums[1:], contexts):
        count(total, coder.byte_code, what, n, lambda node, lo, hi, size: slots_of(
            coder.byte_nodes(node, np.repeat(before[lo:hi], size)), np.repeat(context[lo:hi], size)))


def count_decisions(train: DataFrame, trees) -> DataFrame:
    """(piece, odds, evidence): the trained tables, cut into pieces; each task sums its own texts first, and
    pieces of all tasks are then summed one by one."""
    def gather(batches):
        _, coder = _coder(trees)
        sums = [np.zeros(2 * n, dtype=np.uint32) for n in (first_table(coder.n_words), 1 << SLOT_BITS, 1 << SLOT_BITS)]
        any_row, docs, tokens = False, [], 0
        for b in batches:
            for at in range(0, b.num_rows, _READ):
                any_row = True
                more = coder.read(tokens_of(b.column("raw").slice(at, _READ)))
                docs += more
                tokens += sum(len(numbers) + 1 for numbers, _ in more)
                if tokens >= _DECIDED_TOKENS:
                    add_counts(sums, coder, docs)
                    docs, tokens = [], 0
        if docs:
            add_counts(sums, coder, docs)
        if any_row:
            whole = np.concatenate(sums)
            for n, lo in enumerate(range(0, len(whole), _PART)):
                piece = whole[lo:lo + _PART]
                if piece.any():
                    # in the least whole numbers that hold the counts
                    piece = piece.astype(np.min_scalar_type(piece.max()))
                    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([piece.itemsize], pa.int32()),
                                                      pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())], names=["piece", "width", "data"])

    def add(batches):
        current, total = None, None
        for b in batches:
            for n, width, data in zip(*(b.column(c).to_pylist() for c in ("piece", "width", "data"))):
                counts = np.frombuffer(zlib.decompress(data), dtype=f"u{width}").astype(np.int64)
                if n == current:
                    total += counts
                    continue
                if current is not None:
                    yield _odds(current, total)
                current, total = n, counts
        if current is not None:
            yield _odds(current, total)

    parts = train.mapInArrow(gather, "piece int, width int, data binary")
    n_parts = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n_parts, "piece").sortWithinPartitions("piece").mapInArrow(
        add, "piece int, odds binary, evidence binary")


def _odds(piece: int, counts: np.ndarray) -> pa.RecordBatch:
    """Log odds as 16-bit floats, and how much was seen, of each slot."""
    n0, n1 = counts[::2].astype(np.float64), counts[1::2].astype(np.float64)
    odds = np.log((n1 + 0.4) / (n0 + 0.4)).astype(np.float16)
    seen = np.searchsorted(_EVIDENCE, n0 + n1, side="right").astype(np.uint8)
    return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([odds.tobytes()], pa.binary()),
                                       pa.array([seen.tobytes()], pa.binary())], names=["piece", "odds", "evidence"])


def learn_tables(train: DataFrame, trees, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(odds, evidence) of all slots."""
    odds = np.zeros(first_table(n_words) + 2 * (1 << SLOT_BITS), dtype=np.float16)
    evidence = np.zeros(len(odds), dtype=np.uint8)
    for r in count_decisions(train, trees).toArrow().to_pylist():
        lo = r["piece"] * (_PART // 2)
        got = np.frombuffer(r["odds"], dtype=np.float16)
        odds[lo:lo + len(got)] = got
        evidence[lo:lo + len(got)] = np.frombuffer(r["evidence"], dtype=np.uint8)
    return odds, evidence


def totals(counts: DataFrame):
    """(tokens, distinct tokens, ends) as n, v, ends."""
    end = F.col("token") == F.lit(b"")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                      F.coalesce(F.sum(F.when(end, F.col("n"))), F.lit(0)).alias("ends")).first()


def learn_start(train: DataFrame) -> dict[str, np.ndarray]:
    """The start weights of each kind and gate, from ``train`` (raw, tenth): those that predict tenth 0 best from
    a model of tenths 1 to 3, which has not seen it, not even for its trees. Decisions are counted by gate, steps
    of the predictors' log odds and outcome, and logistic regressions are fitted to these counts."""
    spark, known = train.sparkSession, train.where("tenth between 1 and 3").select("raw")
    counts = count_tokens(known)
    size = totals(counts)
    learned = learn_trees(counts, int(size["n"]), int(size["ends"]))
    trees = learned.sent(spark)
    tables = spark.sparkContext.broadcast(learn_tables(known, trees, len(learned.words)))

    def run(batches):
        _, coder = _coder(trees)
        mixer = Mixer(coder, *tables.value, None)
        total = np.zeros(len(_KINDS) * _GATES * _STEPS ** _PREDICTORS * 2, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, _READ):
                docs = coder.read(tokens_of(b.column("raw").slice(at, _READ)))
                for lo in range(0, len(docs), _FITTED):
                    for cells in mixer.cells(docs[lo:lo + _FITTED]):
                        np.add.at(total, cells.astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["cell", "n"])

    got = train.where("tenth = 0").select("raw").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    tables.unpersist()
    trees.unpersist()
    cell, n = (got.column(c).to_numpy().astype(np.int64) for c in ("cell", "n"))
    outcome, cell = cell & 1, cell >> 1
    x = np.empty((len(cell), _PREDICTORS))
    for i in reversed(range(_PREDICTORS)):
        root = (cell % _STEPS) * (2 / (_STEPS - 1)) - 1
        x[:, i] = root * np.abs(root) * _REACH
        cell = cell // _STEPS
    return {kind: np.stack([fit_weights(*(v[cell == k * _GATES + g] for v in (x, outcome, n))) for g in range(_GATES)]).astype(np.float32)
            for k, kind in enumerate(_KINDS)}


def fit_weights(x: np.ndarray, outcome: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logistic regression without a constant by Newton's method; one decision's worth of prior for equal weights."""
    def loss(w):
        z = x @ w
        return float((n * np.logaddexp(0, np.where(outcome, -z, z))).sum() + ((w - equal) ** 2).sum() / 2)

    equal = np.full(_PREDICTORS, 1 / _PREDICTORS)
    w = equal.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - outcome)) + w - equal
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(_PREDICTORS), slope)
        before, size = loss(w), 1.0
        while size > 1e-6 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def log_chances(against: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol, of the odds against its decisions, which begin at ``first``: one
    logarithm of the product of all chances."""
    if not len(first):
        return np.zeros(0)
    inverse = against + 1
    with np.errstate(over="ignore"):
        product = np.multiply.reduceat(inverse, first)
    if np.isinf(product).any():
        # only beyond 50 decisions, all of them missed
        return -np.add.reduceat(np.log(inverse), first)
    return -np.log(product)


class Mixer:
    """Scores documents with a trained model. ``start`` are the weights of each kind, by gate and predictor."""

    def __init__(self, coder: Coder, odds: np.ndarray, evidence: np.ndarray, start):
        first, size = first_table(coder.n_words), 1 << SLOT_BITS
        # 16-bit floats as their bits
        odds = odds.view(np.uint16)
        self.odds = [odds[:first], odds[first:first + size], odds[first + size:]]
        self.evidence = evidence[first + size:]
        self.coder = coder
        self.start = start

    def cells(self, docs: list[tuple[np.ndarray, list[bytes]]]):
        """For words and then bytes, the cell of each decision of ``docs``: kind, gate, steps of odds, outcome."""
        coder = self.coder
        symbols, _, place, other, _ = coder.symbols(docs)
        decided, node, bit = coder.word_code.walk(symbols)
        yield self._cells(0, decided, node, bit, coder.word_contexts(symbols, place))
        if other:
            raw, before, contexts, _ = coder.byte_contexts(other)
            decided, node, bit = coder.byte_code.walk(raw.astype(np.int64))
            yield self._cells(1, decided, coder.byte_nodes(node, np.repeat(before, decided)), bit, contexts[:2])

    @staticmethod
    def slots(decided, node, contexts) -> list[np.ndarray]:
        """Places of each decision in the tables, as the integers that numpy looks up by without a copy."""
        return [node.astype(np.int64), *(slots_of(node, np.repeat(c, decided)).astype(np.int64) for c in contexts)]

    def _cells(self, kind: int, decided, node, bit, contexts) -> np.ndarray:
        slots = self.slots(decided, node, contexts)
        cell = self.evidence.take(slots[2]).astype(np.int32) + np.int32(kind * _GATES)
        for t, s in zip(self.odds, slots):
            cell *= np.int32(_STEPS)
            x = _HALVES.take(t.take(s))
            root = np.copysign(np.sqrt(np.minimum(np.abs(x), np.float32(_REACH)) / np.float32(_REACH)), x)
            cell += np.rint((root + 1) * np.float32((_STEPS - 1) / 2)).astype(np.int32)
        return cell * np.int32(2) + bit

    def _online(self, kind: str, n: int, doc, block, decided, node, bit, contexts) -> np.ndarray:
        """Natural log probability of each symbol; symbols come in the order of their blocks. ``decided`` is
        the number of decisions of each, ``doc`` and ``block`` are theirs."""
        slots = self.slots(decided, node, contexts)
        x = [_HALVES.take(t.take(s)) for t, s in zip(self.odds, slots)]
        who = np.repeat(doc.astype(np.int64), decided)
        own_gate = who * _GATES
        own_gate += self.evidence.take(slots[2])
        first_bucket = who * _BUCKETS
        ends = np.cumsum(decided)
        cuts = ends[np.flatnonzero(np.concatenate([np.diff(block) != 0, [True]]))].tolist()
        weights = [np.tile(self.start[kind][:, i], n) for i in range(_PREDICTORS)]
        shift = np.zeros(n * _BUCKETS, dtype=np.float32)
        against = np.empty(len(node))
        sign = np.float32(1) - np.float32(2) * bit
        lo = 0
        for hi in cuts:
            own, part = own_gate[lo:hi], [v[lo:hi] for v in x]
            z = weights[0].take(own) * part[0]
            z += weights[1].take(own) * part[1]
            z += weights[2].take(own) * part[2]
            np.clip(z, -11.9, 11.9, out=z)
            # the map holds corrections of the log odds, none at first
            bucket = first_bucket[lo:hi] + np.rint((z + np.float32(12)) * np.float32((_BUCKETS - 1) / 24)).astype(np.int32)
            z += shift.take(bucket)
            np.clip(z, -14, 14, out=z)
            s = sign[lo:hi]
            # chance of the other outcome: what was missed
            odds_against = np.exp(z * s)
            against[lo:hi] = odds_against
            miss = -s * odds_against / (1 + odds_against)
            seen = np.maximum(np.bincount(own, minlength=n * _GATES), 1)
            rate = (RATE / np.sqrt(seen)).astype(np.float32)
            for w, v in zip(weights, part):
                w += rate * np.bincount(own, weights=miss * v, minlength=n * _GATES).astype(np.float32)
            seen = np.maximum(np.bincount(bucket, minlength=n * _BUCKETS), 1)
            shift += (MAP_RATE * np.bincount(bucket, weights=miss, minlength=n * _BUCKETS) / np.sqrt(seen)).astype(np.float32)
            lo = hi
        return log_chances(against, ends - decided)

    def score_all(self, docs: list[tuple[np.ndarray, list[bytes]]], base_logs: np.ndarray):
        """Like ``score``, for any number of documents as the coder reads them: those of like length are scored
        together, so that the arrays stay small and long documents do not hold up short ones."""
        total, base, of, other, spelled = np.zeros(len(docs)), np.zeros(len(docs)), [], [], []
        part, tokens = [], 0
        order = sorted(range(len(docs)), key=lambda i: len(docs[i][0]))
        for rank, i in enumerate(order):
            part.append(i)
            tokens += len(docs[i][0]) + 1
            if tokens >= _SCORED_TOKENS or rank == len(order) - 1:
                total[part], base[part], where, words, spellings = self._score([docs[j] for j in part], base_logs)
                of.append(np.array(part, dtype=np.int32)[where])
                other.extend(words)
                spelled.append(spellings)
                part, tokens = [], 0
        return total, base, np.concatenate(of), other, np.concatenate(spelled)

    def score(self, docs: list[list[bytes]], base_logs: np.ndarray):
        """(log10 probability of each document's word decisions, sum of the ``base_logs`` of its symbols, documents of the words without a code, these
        words, log10 probability of the spelling of each)."""
        return self._score(self.coder.read(pa.array(docs, pa.list_(pa.binary()))), base_logs)

    def _score(self, docs: list[tuple[np.ndarray, list[bytes]]], base_logs: np.ndarray):
        coder, n = self.coder, len(docs)
        symbols, doc, place, other, other_at = coder.symbols(docs)
        order = np.argsort((place // BLOCK).astype(np.uint16 if place.max(initial=0) < BLOCK << 16 else np.int64), kind="stable")
        decided, node, bit = coder.word_code.walk(symbols[order])
        contexts = [c[order] for c in coder.word_contexts(symbols, place)]
        logs = self._online("words", n, doc[order], (place // BLOCK)[order], decided, node, bit, contexts)
        words = np.bincount(doc[order], weights=logs, minlength=n) / np.log(10)
        base = np.bincount(doc, weights=base_logs[symbols], minlength=n)
        if not other:
            return words, base, np.zeros(0, dtype=np.int32), [], np.zeros(0)
        of = doc[other_at]
        nth = np.arange(len(of)) - np.searchsorted(of, of)
        order = np.argsort(nth // SPELLED_BLOCK, kind="stable")
        of, other = of[order], [other[i] for i in order.tolist()]
        raw, before, contexts, owner = coder.byte_contexts(other)
        decided, node, bit = coder.byte_code.walk(raw.astype(np.int64))
        node = coder.byte_nodes(node, np.repeat(before, decided))
        logs = self._online("bytes", n, of[owner], (nth[order] // SPELLED_BLOCK)[owner], decided, node, bit, contexts[:2])
        return words, base, of, other, np.bincount(owner, weights=logs, minlength=len(other)) / np.log(10)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte): one row per input row.

    Learns from the rows outside fold 1. Null texts count as empty and have one token, the end; a null id
    is training data. Repeated rows are rows of their own, also in training; extra columns are ignored.
    Without training rows all counts are 0. ``bits_per_byte`` is null for texts without bytes.
    """
    spark = docs.sparkSession
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("raw"),
                       (fold(docs[id_col]) == 1).alias("held_out"), tenth(docs[id_col]).alias("tenth"))
    train = slim.where(~F.col("held_out")).select("raw", "tenth")
    counts = count_tokens(train)
    end = F.col("token") == F.lit(b"")
    size = totals(counts)
    n_train, denominator = int(size["n"]), float(size["n"] + 0.5 * (size["v"] + 1))
    learned = learn_trees(counts, n_train, int(size["ends"]))
    listed = n_train - int(size["ends"]) - int(learned.counts.sum())
    trees = learned.sent(spark)
    n_words = len(learned.words)
    start = learn_start(train)
    tables = spark.sparkContext.broadcast((*learn_tables(train, trees, n_words), start))
    end_log, end_known = float(np.log10((size["ends"] + 0.5) / denominator)), int(size["ends"] > 0)

    def run(batches):
        word_counts, coder = _coder(trees)
        mixer = Mixer(coder, *tables.value)
        logs = np.log10((word_counts + 0.5) / denominator)
        logs = np.concatenate([logs, [end_log, 0.0]])
        for b in batches:
            for at in range(0, b.num_rows, _READ):
                part = b.slice(at, _READ)
                docs_here = coder.read(tokens_of(part.column("raw")))
                score, base, of, other, spelled = mixer.score_all(docs_here, logs)
                n = len(docs_here)
                rare_n = np.bincount(of, minlength=n)
                n_tokens = np.fromiter((len(numbers) for numbers, _ in docs_here), dtype=np.int64, count=n) + 1
                order = np.argsort(of, kind="stable")
                rare = pa.StructArray.from_arrays([pa.array([other[i] for i in order.tolist()], pa.binary()), pa.array(spelled[order], pa.float64())],
                                                  names=["token", "spelled"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(rare_n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(n_tokens, pa.int64()),
                     pc.binary_length(part.column("raw")).cast(pa.int64()), pa.array(n_tokens - rare_n - (1 - end_known), pa.int64()),
                     pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.ListArray.from_arrays(offsets, rare)],
                    names=["doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "mixed", "rare"])

    scored = staged(slim.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_bytes long, known long, base double, "
                                         "mixed double, rare array<struct<token: binary, spelled: double>>")
                    .withColumn("row", F.monotonically_increasing_id()), "scored")
    looked_up = (scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.spelled")
                 .join(counts.where(~end), "token", "left"))
    c = F.coalesce("n", F.lit(0))
    by_list = F.when(c > 0, F.lit(LISTED) * c / F.lit(float(max(1, listed)))).otherwise(0.0)
    # far below the smallest double, the spelling alone tells the sum
    spelled = F.col("spelled") + float(np.log10(1 - LISTED))
    chosen = F.when(c > 0, F.log10(by_list + F.pow(F.lit(10.0), spelled))).otherwise(spelled)
    rest = looked_up.groupBy("row").agg(F.sum(F.log10((c + 0.5) / F.lit(denominator))).alias("rest"), F.sum(chosen).alias("chosen"),
                                        F.sum((c > 0).cast("long")).alias("also_known"))
    total = F.col("mixed") + F.coalesce("chosen", F.lit(0.0))
    return scored.drop("rare").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        total.alias("score"), F.when(F.col("n_bytes") > 0, -total * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))


@register("op9_lm_score")
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
