"""Language-model scores from a hashed maximum-entropy model.

A word's probability is that of its class times that within the class, given the
two words before it. Both are softmaxes over hashed features: the last word, the
last two, and the one before last (a skip). The most frequent words share a few
classes; all others fall by their last two bytes into tail classes. A tail class
is divided in two, and its parts again, down to single words; each division is a
softmax of its own, shifted by what the words on either side were counted (a
Huffman tree, so that frequent words take few divisions). One share of a class is
kept for words never seen. So the probabilities of all words add up to 1.

Counts are made over all training rows, combined per batch and before the
shuffle. Weights are a vector of fixed size: in each round every task follows
the gradient over its own rows from the round's common weights, and the weights
are averaged by the number of tokens (iterated parameter mixing). Rounds take
disjoint parts of the training rows, so each row is used once. Scoring takes
batches of tokens in numpy.

Only the ``KNOWN`` most frequent words are sent to tasks, each a leaf of its own.
All other counted words fall by hash into further leaves, whose number grows with
these words to ``REST_LEAVES``; inside a leaf a word has its add-one share of the
leaf's counts, which it meets in a join by word, so the vocabulary has no bound.

Defined cases: a null or empty text is one end token; a null id is not held out;
with no training rows all counts are zero; repeated rows count each time; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from posloom.llm.common import KEY, Scratch, read_table, row_keyed, top_rows

END = b"\n"  # no word has white space
KNOWN = 100_000
HEAD_CLASSES = 8
CLASS_WORDS = 8
TAIL_CLASSES = 8
CLASSES = HEAD_CLASSES + TAIL_CLASSES
FEATURE_ROWS = 1 << 14  # of hashed features; a power of two
WIDTH = FEATURE_ROWS * (CLASSES + CLASS_WORDS) + CLASSES + HEAD_CLASSES * CLASS_WORDS
BLOCK = 4096
ROUNDS = 2
BATCH = 8192
STEP = 0.15
TREE_ROWS = 1 << 18  # of hashed features at the divisions of tail classes; a power of two
TREE_STEP = 0.15
REST_LEAVES = 1 << 16  # of words that are not sent, over all tail classes
FLUSH_WORDS = 500_000
COUNT_BYTES = 2_000_000  # text counted at a time
MIX_SALTS = 16

_U = np.uint32
_PLAIN = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]  # bytes: A-Z only, ASCII white space only


def coded(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """All tokens as numbers of different words, ``END`` one of them; these words; text sizes."""
    pieces = pc.split_pattern(pa.array([t.translate(_PLAIN) for t in texts], pa.large_binary()), " ")
    found = pieces.flatten().dictionary_encode()
    units = found.indices.to_numpy().astype(np.int64)
    told = pc.binary_length(found.dictionary).to_numpy()[units] > 0
    sizes = np.add.reduceat(told, pieces.offsets.to_numpy()[:-1], dtype=np.int64)  # each text has a piece
    out = np.full(int(sizes.sum()) + len(texts), len(found.dictionary), np.int64)
    out[np.arange(len(out) - len(texts)) + np.repeat(np.arange(len(texts)), sizes)] = units[told]
    return out, pa.concat_arrays([found.dictionary, pa.array([END], pa.large_binary())]), sizes + 1


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def counted(training: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def combined() -> pa.Table:
            once = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return once.select(["word", "n_sum"]).rename_columns(["word", "n"])

        def given(table: pa.Table) -> Iterator[pa.RecordBatch]:
            return table.set_column(0, "word", table["word"].cast(pa.binary())).to_batches(100_000)

        for texts in _batches((x.as_py() for b in batches for x in b.column(0)), COUNT_BYTES):
            units, words, _ = coded(texts)
            times = np.bincount(units, minlength=len(words))
            told = times.nonzero()[0]
            told = told[pc.binary_length(words).to_numpy()[told] > 0]
            held.append(pa.table({"word": words.take(pa.array(told)), "n": times[told]}))
            if sum(map(len, held)) > 2 * FLUSH_WORDS:
                held[:] = [combined()]
                if len(held[0]) > FLUSH_WORDS:
                    yield from given(held.pop())
        if held:
            yield from given(combined())

    return training.select("data").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def divided(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and side of each node of a Huffman tree; leaves come first, the root is last and has parent -1."""
    n = len(weights)
    order = np.argsort(weights, kind="stable")
    total = np.concatenate([weights, np.zeros(max(n - 1, 0))]).tolist()
    parent, side = np.full(len(total), -1), np.zeros(len(total), np.int64)
    leaves, leaf, inner = order.tolist(), 0, n
    for node in range(n, len(total)):
        for k in (0, 1):
            if inner == node or (leaf < n and total[leaves[leaf]] <= total[inner]):
                low, leaf = leaves[leaf], leaf + 1
            else:
                low, inner = inner, inner + 1
            parent[low], side[low] = node, k
            total[node] += total[low]
    return parent, side


class Tree:
    """Divisions of the tail classes, and the way through them to each leaf.

    ``leaf`` is the leaf of each sent word (-1: a word of the head), ``rest`` that of
    each class and hash of the other words (-1: none of them was counted).
    """

    def __init__(self, group: np.ndarray, place: np.ndarray, counts: np.ndarray, rest: np.ndarray):
        self.leaf, self.rest = np.full(len(group), -1), np.full(rest.shape, -1)
        self.rest_total = rest
        starts, steps, prior = [np.zeros(1, np.int64)], [], []
        nodes = leaves = reached = 0
        for c in range(TAIL_CLASSES):
            own = np.flatnonzero((place < 0) & (group == HEAD_CLASSES + c))
            buckets = np.flatnonzero(rest[c] > 0)
            n = len(own) + len(buckets)
            self.leaf[own] = leaves + np.arange(len(own))
            self.rest[c, buckets] = leaves + len(own) + np.arange(len(buckets))
            weights = np.concatenate([counts[own] + 1.0, rest[c, buckets]])
            parent, side = divided(weights)
            ways, at = [], np.arange(n)
            while n and (parent[at] >= 0).any():
                up = parent[at]
                ways.append(np.where(up >= 0, (nodes + up - n) * 2 + side[at], -1))
                at = np.where(up >= 0, up, at)
            ways = np.stack(ways, axis=1) if ways else np.zeros((n, 0), np.int64)
            taken = ways >= 0
            starts.append(reached + np.cumsum(taken.sum(axis=1)))
            reached += int(taken.sum())
            steps.append(ways[taken])
            sums = np.zeros((max(n - 1, 0), 2))
            mass = np.repeat(weights, taken.sum(axis=1))
            np.add.at(sums, ((ways[taken] >> 1) - nodes, ways[taken] & 1), mass)
            prior.append(np.log(sums[:, 1] / sums[:, 0]))
            nodes, leaves = nodes + max(n - 1, 0), leaves + n
        self.start = np.concatenate(starts)
        self.steps = np.concatenate(steps).astype(np.int32)
        self.prior = np.concatenate(prior).astype(np.float32)
        self.mark = _tree_row(_spread(np.arange(nodes).astype(_U) + _U(17)))

    def leaves(self, ids: np.ndarray, code: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The leaf of each token, by its word if that is sent, else by its hash; -1 for none."""
        out = self.leaf[ids] if len(self.leaf) else np.full(len(ids), -1)
        strange = np.flatnonzero(ids < 0)
        out[strange] = self.rest[group[strange] - HEAD_CLASSES, code[strange] & _U(self.rest.shape[1] - 1)]
        return out

    def ways(self, weights: np.ndarray, leaf: np.ndarray, found: np.ndarray):
        """For each division on the tokens' ways: side taken, log odds of side 1, rows of weights added up; where tokens start."""
        first = self.start[leaf]
        length = self.start[leaf + 1] - first
        ends = np.cumsum(length)
        token = np.repeat(np.arange(len(leaf)), length)
        at = np.arange(len(token))
        at += np.take(first - (ends - length), token)
        step = np.take(self.steps, at)
        node = step >> 1
        odds, mark = np.take(self.prior, node), np.take(self.mark, node)
        rows = np.empty((found.shape[1], len(token)), np.intp)
        for k, column in enumerate(_tree_row(found.T)):
            np.bitwise_xor(np.take(column, token), mark, out=rows[k])
            odds += np.take(weights, rows[k])
        return (step & 1).astype(np.float32), odds, rows, ends - length

    def logs(self, weights: np.ndarray, leaf: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Log probability of each token's leaf within its class."""
        side, odds, _, starts = self.ways(weights, leaf, found)
        side *= -2
        side += 1
        odds *= side  # for the side not taken
        total = np.zeros(len(leaf))
        told = np.flatnonzero(np.diff(starts, append=len(odds)))
        if len(told):
            lost = np.maximum(odds, 0) + np.log(1 + np.exp(-np.abs(odds)))
            total[told] = -np.add.reduceat(lost, starts[told], dtype=np.float64)
        return total

    def descend(self, weights: np.ndarray, squares: np.ndarray, leaf: np.ndarray, found: np.ndarray) -> None:
        """One step down the gradient of a batch, scaled by its running squares, in place."""
        side, odds, rows, _ = self.ways(weights, leaf, found)
        slope = (1 / (1 + np.exp(-odds)) - side).astype(np.float64)
        change = np.bincount(rows.ravel(), np.tile(slope, len(rows)), TREE_ROWS).astype(np.float32)
        squares += change * change
        change *= TREE_STEP
        change /= np.sqrt(squares + 1)
        weights -= change


def _tree_row(code: np.ndarray) -> np.ndarray:
    """Hashes as numbers below ``TREE_ROWS``; that of a feature at a division is the two numbers' exclusive or."""
    return np.ascontiguousarray(code & _U(TREE_ROWS - 1)).astype(np.intp)


def rest_buckets(words: int) -> int:
    """Leaves of a tail class for words that are not sent; a power of two, as many as the words need."""
    return 1 << max(0, min(words, REST_LEAVES) // TAIL_CLASSES - 1).bit_length()


class Vocabulary:
    """Known words as arrays by id: hash, class, place in the class, log count; and the tree of tail classes.

    ``rest`` is the sum of counts and words that are not known, by tail class and hash.
    """

    def __init__(
        self, words: list[bytes], counts: list[int], head: int = HEAD_CLASSES * CLASS_WORDS, rest: np.ndarray | None = None
    ):
        self.ids = {w: i for i, w in enumerate(words)}
        rank = np.arange(len(words))
        self.code = np.fromiter((zlib.crc32(w) for w in words), _U, len(words))
        tail = np.fromiter((HEAD_CLASSES + tail_class(w) for w in words), np.int64, len(words))
        self.group = np.where(rank < head, rank // CLASS_WORDS, tail)
        self.place = np.where(rank < head, rank % CLASS_WORDS, -1)
        self.log_count = np.log10(np.asarray(counts, float) + 1) if words else np.zeros(0)
        self.seen = np.asarray(counts, np.int64) > 0
        filled = np.zeros((HEAD_CLASSES, CLASS_WORDS), bool)
        filled.ravel()[: min(head, len(words))] = True
        self.filled = filled
        self.tree = Tree(self.group, self.place, np.asarray(counts, float), np.zeros((TAIL_CLASSES, 1)) if rest is None else rest)

    def read(self, texts: list[bytes]):
        """Arrays over the tokens of texts: id (-1 if unknown), hash, class, place; text sizes; unknown words."""
        *out, strange, units, found = self.numbered(texts)
        return *out, strange, found.take(pa.array(units[strange])).to_pylist()

    def numbered(self, texts: list[bytes]):
        """As ``read``, with unknown words as the numbers of all tokens' words, and these words."""
        units, found, sizes = coded(texts)
        words = found.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(number < 0)
        if len(self.code):
            code, group, place = self.code[number], self.group[number], self.place[number]
        else:
            code, group, place = np.zeros(len(words), _U), np.zeros(len(words), np.int64), np.full(len(words), -1)
        unknown = [words[k] for k in new.tolist()]
        code[new] = np.fromiter(map(zlib.crc32, unknown), _U, len(new))
        group[new] = HEAD_CLASSES + np.fromiter(map(tail_class, unknown), np.int64, len(new))
        place[new] = -1
        ids = number[units]
        return ids, code[units], group[units], place[units], sizes, np.flatnonzero(ids < 0), units, found


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(16))) * _U(0x7FEB352D)
    x = (x ^ (x >> _U(15))) * _U(0x846CA68B)
    return x ^ (x >> _U(16))


def features(code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the last word, the last two, and the one before last; texts have no past."""
    nth = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    last, before = np.zeros(len(code), _U), np.zeros(len(code), _U)
    last[1:], before[2:] = code[:-1], code[:-2]
    last[nth < 1] = _U(1)
    before[nth < 2] = _U(2)
    return np.stack([_spread(last + _U(11)), _spread(last * _U(31) ^ _spread(before + _U(7))), _spread(before + _U(13))], axis=1)


def _below_top(z: np.ndarray) -> np.ndarray:
    """Outputs less the largest of their token, a column per token: numpy reduces long rows faster than short ones."""
    z = np.array(z.T, order="C")
    z -= z.max(axis=0)
    return z


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = _below_top(z)
    z -= np.log(np.exp(z).sum(axis=0))
    return z.T


def _softmax(z: np.ndarray) -> np.ndarray:
    z = _below_top(z)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z.T


def split(vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Views of the weight vector: a row of class weights per hashed feature, a row of
    word weights per hashed feature and class, and the outputs' biases."""
    middle = FEATURE_ROWS * CLASSES
    end = middle + FEATURE_ROWS * CLASS_WORDS
    return vector[:middle].reshape(-1, CLASSES), vector[middle:end].reshape(-1, CLASS_WORDS), vector[end:WIDTH]


def _class_rows(found: np.ndarray) -> np.ndarray:
    return (found & _U(FEATURE_ROWS - 1)).astype(np.intp)


def _word_rows(found: np.ndarray, group: np.ndarray) -> np.ndarray:
    mixed = _spread(found ^ ((group[:, None] + 1).astype(_U) * _U(0x9E3779B1)))
    return (mixed & _U(FEATURE_ROWS - 1)).astype(np.intp)


def _summed(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.take(table, rows[:, 0], axis=0)
    out += np.take(table, rows[:, 1], axis=0)
    out += np.take(table, rows[:, 2], axis=0)
    return out


def _class_outputs(vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
    table, _, bias = split(vector)
    return _summed(table, rows) + bias[:CLASSES]


def _word_outputs(vector: np.ndarray, rows: np.ndarray, group: np.ndarray, filled: np.ndarray) -> np.ndarray:
    _, table, bias = split(vector)
    z = _summed(table, rows) + bias[CLASSES:].reshape(HEAD_CLASSES, CLASS_WORDS)[group]
    return np.where(filled[group], z, -1e9)


def _classes(vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log probability of each class, a row per token."""
    return _log_softmax(_class_outputs(vector, rows))


def _words(vector: np.ndarray, rows: np.ndarray, group: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Log probability of each word of a token's class, a row per token."""
    return _log_softmax(_word_outputs(vector, rows, group, filled))


def _move(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """Take the step in the rows of a table that were added up; no other row has a slope."""
    used = np.zeros(FEATURE_ROWS, bool)
    used[rows] = True
    hit = np.flatnonzero(used)
    nth = np.take(np.cumsum(used) - 1, rows.ravel())
    change = np.empty((len(hit), slope.shape[1]))
    for k in range(slope.shape[1]):
        change[:, k] = np.bincount(nth, np.repeat(slope[:, k], rows.shape[1]), len(hit))
    total = np.take(squares, hit, axis=0)
    total += change * change
    squares[hit] = total
    total += 1e-8
    np.sqrt(total, out=total)
    change *= STEP
    change /= total
    table[hit] -= change


def descend(vector, squares, found, group, place, filled) -> None:
    """One step down the gradient of a batch, scaled by its running squares, in place."""
    (classes, words, bias), (class_squares, word_squares, bias_squares) = split(vector), split(squares)
    rows = _class_rows(found)
    slope = _softmax(_class_outputs(vector, rows))
    slope[np.arange(len(rows)), group] -= 1
    slope /= len(found)
    inner = np.flatnonzero(place >= 0)
    mine = group[inner]
    word_rows = _word_rows(found[inner], mine)
    word_slope = _softmax(_word_outputs(vector, word_rows, mine, filled))
    word_slope[np.arange(len(inner)), place[inner]] -= 1
    word_slope /= len(found)
    word_push = [np.bincount(mine, word_slope[:, k], HEAD_CLASSES) for k in range(CLASS_WORDS)]
    push = np.concatenate([slope.sum(axis=0), np.stack(word_push, axis=1).ravel()])
    _move(classes, class_squares, rows, slope)
    _move(words, word_squares, word_rows, word_slope)
    bias_squares += push * push
    bias -= STEP * push / np.sqrt(bias_squares + 1e-8)


def _batches(texts: Iterator[bytes], size: int) -> Iterator[list[bytes]]:
    """Lists of texts of about ``size`` bytes."""
    now, total = [], 0
    for text in texts:
        now.append(text)
        total += len(text)
        if total >= size:
            yield now
            now, total = [], 0
    if now:
        yield now


def train(
    training: DataFrame,
    words: list[bytes],
    counts: list[int],
    scratch: Scratch,
    rounds: int = ROUNDS,
    rest: np.ndarray | None = None,
) -> np.ndarray:
    """Weights and the outputs' biases, then the weights of the tail classes' divisions.

    The latter are averaged by their running squares: a feature that few tasks met
    keeps what these learned.
    """
    spark = training.sparkSession
    common = np.zeros(WIDTH + TREE_ROWS)
    vocabulary = Vocabulary(words, counts, rest=rest)
    bias = split(common)[2]
    bias[:CLASSES] = np.log(np.bincount(vocabulary.group, np.asarray(counts, float), CLASSES) + 1) if words else 0.0
    head = np.ones(HEAD_CLASSES * CLASS_WORDS)
    head[: min(len(head), len(counts))] += np.asarray(counts[: len(head)], float)
    bias[CLASSES:] = np.log(head)
    padded = -(-WIDTH // BLOCK) * BLOCK  # blocks to be averaged; those of sums follow
    sent_words = spark.sparkContext.broadcast(vocabulary)  # a worker reads it once, for all its tasks
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(common.astype(np.float32))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent_words.value
            vector, branches = sent.value[:WIDTH].astype(np.float64), sent.value[WIDTH:].copy()
            squares, branch_squares = np.full(WIDTH, 1e-4), np.zeros(TREE_ROWS, np.float32)
            total = 0
            for texts in _batches((x.as_py() for b in batches for x in b.column(0)), 500_000):
                ids, code, group, place, sizes, *_ = known.numbered(texts)
                found = features(code, sizes)
                total += len(code)
                leaf = known.tree.leaves(ids, code, group)
                inside = np.flatnonzero(leaf >= 0)
                for at in range(0, len(code), BATCH):
                    part = slice(at, at + BATCH)
                    descend(vector, squares, found[part], group[part], place[part], known.filled)
                for at in range(0, len(inside), BATCH):
                    mine = inside[at : at + BATCH]
                    known.tree.descend(branches, branch_squares, leaf[mine], found[mine])
            if total:
                flat = np.zeros(padded + 2 * TREE_ROWS, np.float32)
                flat[:WIDTH] = vector
                flat[padded : padded + TREE_ROWS] = branches * branch_squares
                flat[padded + TREE_ROWS :] = branch_squares
                blocks = [b.tobytes() for b in flat.reshape(-1, BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(blocks)), pa.int32()), pa.array([total] * len(blocks), pa.float64()), pa.array(blocks, pa.binary())],
                    names=["block", "share", "part"],
                )

        def mix(pdf: pd.DataFrame) -> pd.DataFrame:
            parts = np.stack([np.frombuffer(p, np.float32) for p in pdf["part"]]).astype(np.float64)
            share, block = pdf["share"].to_numpy(), pdf["block"].iloc[0]
            mean = parts.sum(axis=0) if block * BLOCK >= padded else (parts * share[:, None]).sum(axis=0) / share.sum()
            return pd.DataFrame({"block": [block], "share": [share.sum()], "part": [mean.astype(np.float32).tobytes()]})

        columns = "block int, share double, part binary"
        mine = training.filter(F.pmod(F.xxhash64("id", *KEY), F.lit(rounds)) == turn).select("data")
        local = mine.mapInArrow(run, columns).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MIX_SALTS)))
        local = local.groupBy("block", "salt").applyInPandas(lambda pdf: mix(pdf), columns)
        parts = local.groupBy("block").applyInPandas(lambda pdf: mix(pdf), columns).collect()  # the vector, of fixed size
        if parts:
            flat = np.zeros(padded + 2 * TREE_ROWS)
            for row in parts:
                low = row["block"] * BLOCK
                flat[low : low + BLOCK] = np.frombuffer(row["part"], np.float32)
            common[:WIDTH] = flat[:WIDTH]
            learned, weight = flat[padded : padded + TREE_ROWS], flat[padded + TREE_ROWS :]
            common[WIDTH:] = np.where(weight > 0, learned / np.maximum(weight, 1e-30), common[WIDTH:])
    return common


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known_words: int = KNOWN) -> DataFrame:
    """A row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = row_keyed(docs.select(id_col, text_col), scratch).select(F.col(id_col).alias("id"), *KEY, data.alias("data"))
    training = keyed.filter(~held_out())
    counts = scratch.stage(counted(training))
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = whole["n"], whole["v"]
    top = top_rows(counts, "n", known_words, "word")  # the documented bound of what is sent
    words, sizes = [bytes(r["word"]) for r in top], [r["n"] for r in top]
    width = rest_buckets(distinct - len(words))
    tail_words = counts.groupBy(
        (F.crc32(F.substring("word", -2, 2)) % TAIL_CLASSES).alias("class"), (F.crc32("word") % width).alias("bucket")
    )
    rest = np.zeros((TAIL_CLASSES, width))
    for row in tail_words.agg((F.sum("n") + F.count("*")).alias("m")).collect():  # a row per leaf, REST_LEAVES at most
        rest[row["class"], row["bucket"]] = row["m"]
    tail = rest.sum(axis=1) + 1
    for rank, (word, n) in enumerate(zip(words, sizes)):
        rest[tail_class(word), zlib.crc32(word) % width] -= n + 1
        if rank < HEAD_CLASSES * CLASS_WORDS:
            tail[tail_class(word)] -= n + 1
    weights = train(training, words, sizes, scratch, rest=rest)
    vocabulary = Vocabulary(words, sizes, rest=rest)
    sent = spark.sparkContext.broadcast((vocabulary, weights.astype(np.float32), tail))
    base_size = float(np.log10(total + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat, tail = sent.value
        tree, branches = known.tree, flat[WIDTH:]
        unseen = -np.log10(tail)
        counted_part = np.log10(np.maximum(tail - 1, 1) / tail)
        for batch in batches:
            at = 0
            for texts in _batches((x.as_py() for x in batch.column(3)), 400_000):
                part = batch.slice(at, len(texts)).select([0, 1, 2])
                at += len(texts)
                ids, code, group, place, lengths, strange, units, words = known.numbered(texts)
                found = features(code, lengths)
                log_count = known.log_count[ids] if len(known.code) else np.zeros(len(ids))
                log_count[strange] = 0.0
                seen = ids >= 0
                logs = np.empty(len(code))
                leaf = tree.leaves(ids, code, group)
                inside = np.flatnonzero(leaf >= 0)
                way = np.zeros(len(code))
                for low in range(0, len(inside), BATCH):
                    mine = inside[low : low + BATCH]
                    way[mine] = tree.logs(branches, leaf[mine], found[mine])
                way /= np.log(10)
                for low in range(0, len(code), BATCH):
                    rows = slice(low, min(low + BATCH, len(code)))
                    logs[rows] = _classes(flat, _class_rows(found[rows]))[np.arange(rows.stop - low), group[rows]]
                    inner = low + np.flatnonzero(place[rows] >= 0)
                    chosen = _words(flat, _word_rows(found[inner], group[inner]), group[inner], known.filled)
                    logs[inner] += chosen[np.arange(len(inner)), place[inner]]
                logs /= np.log(10)
                outer = place < 0
                own = group - HEAD_CLASSES
                logs[outer] += np.where(seen[outer], way[outer] + counted_part[own[outer]], unseen[own[outer]])
                # What a word that is not sent gains if it was counted, its own count apart.
                bucket = (code[strange] & _U(tree.rest.shape[1] - 1), own[strange])[::-1]
                gains = way[strange] + counted_part[own[strange]] - np.log10(np.maximum(tree.rest_total[bucket], 1)) - unseen[own[strange]]
                text = np.repeat(np.arange(len(texts)), lengths)
                totals = [np.bincount(text, v, len(texts)) for v in (seen, log_count - base_size, logs)]
                # A row per text and word that is not sent.
                named, nth = np.unique(text[strange] * len(words) + units[strange], return_inverse=True)
                entries = [
                    words.take(pa.array(named % len(words))).cast(pa.binary()),
                    pa.array(np.bincount(nth, minlength=len(named)), pa.int64()),
                    pa.array(np.bincount(nth, gains, len(named)), pa.float64()),
                ]
                ends = np.searchsorted(named, np.arange(len(texts) + 1) * len(words)).astype(np.int32)
                strangers = pa.StructArray.from_arrays(entries, fields=list(rare_type.value_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(lengths),
                        pa.array(totals[0].astype(np.int64)),
                        pa.array(totals[1]),
                        pa.array(totals[2]),
                        pa.ListArray.from_arrays(pa.array(ends), strangers, type=rare_type),
                    ],
                    schema=schema,
                )

    types = StructType(keyed.drop("data").schema.fields).add("n_tokens", LongType()).add("known", LongType())
    types = types.add("base", DoubleType()).add("model", DoubleType())
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64()), ("gain", pa.float64())]))
    schema = to_arrow_schema(types).append(pa.field("rare", rare_type))
    rare_words = ArrayType(StructType().add("word", BinaryType()).add("times", LongType()).add("gain", DoubleType()))
    partial = scratch.stage(keyed.mapInArrow(run, types.add("rare", rare_words)))
    rare = partial.select(*KEY, F.explode("rare").alias("r")).select(*KEY, "r.word", "r.times", "r.gain")
    met = rare.join(counts, "word").groupBy(*KEY).agg(
        F.sum("times").alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"),
        F.sum("gain").alias("gain"),
    )
    out = partial.drop("rare").join(met, KEY, "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + F.coalesce("gain", F.lit(0.0)) + more).alias("score"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"))
