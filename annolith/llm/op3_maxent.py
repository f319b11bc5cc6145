"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class, history) P(spelling | word). Words stand in one line, ordered by classes
learnt from the words beside them; halving the line by its mass gives classes first (CLASS_SPLITS halvings), then the words
within a class, so each factor is a softmax that is itself a product of softmaxes over two halves. Every split has a bias, the
log-odds of its masses, and weights for hashed features of the history: the last word, the last two, and the skips to the
words before them. Words too rare for a place of their own share one by their ending; among these, and past the last split
that has features, counts decide. Weights are trained by distributed gradient updates: tasks take Adagrad steps over their
own documents, and their weights are averaged by the information each gathered. Documents are scored in numpy batches that
touch only the weights of their own features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm.textkit import LOWER, Words, fold, mix, pieces
from annolith.session import kept

FOLDS, HELD_OUT = 5, 1
END = np.uint64(0x51ED270B35AF1C4D)
#: Words at most that have a place of their own (a bound on what every task holds), and the least count for one.
FREQUENT, LEAST = 1 << 18, 8
#: Endings, by hash, of which each is the place of its rarer words; hashed neighbours that are counted on either side of it.
ENDINGS, BESIDE = 1 << 13, 16
#: Splits of the line that have features, and how many of them are between classes.
SPLITS, CLASS_SPLITS = 12, 6
#: Weights of the word splits: a power of two, EACH for a training token within these bounds (4 bytes each); a quarter of it for classes.
EACH, LEAST_BITS, MOST_BITS = 8, 16, 22
#: Features of the splits between classes, and of those within: 0 the last word, 1 the last two, 2 and 3 the words before the last.
FEATURES = ((0, 2, 3),) * 4 + ((0, 1),) * 2 + ((0,),) * (SPLITS - CLASS_SPLITS)
STEP, BLOCKS = 1 << 14, 64
#: Training tokens that one task sees in a round.
TRAINER = 1 << 23
U32 = np.uint32


class Tokens:
    """Tokens of a column, each text's words and one end: ``hash``, ``ending`` (END: 0), ``first`` (n + 1 bounds)."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        n = len(words.offsets) - 1
        self.first = words.first + np.arange(n + 1)
        self.hash = np.full(self.first[-1], END, np.uint64)
        self.ending = np.zeros(self.first[-1], np.int32)
        at = np.arange(len(words.start)) + words.owner()
        self.hash[at] = words.hashes()
        # The last three bytes, and whether there are more.
        size = words.end - words.start
        low = np.zeros(len(words.data) + 4, np.uint8)
        low[4:] = LOWER[words.data]
        loads = np.ndarray((len(words.data) + 1,), "<u4", buffer=low.data, strides=(1,))
        tail = loads[words.end] >> (8 * (4 - np.minimum(size, 3))).astype(U32)
        self.ending[at] = (mix(tail.astype(np.uint64) * np.uint64(2) + (size > 3) + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int32)
        self.counts = np.diff(self.first)


def context(items: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The four hashed features of each token's history, within its text."""
    place = np.arange(len(items)) - np.repeat(first[:-1], np.diff(first))
    m = (items.astype(U32) + U32(2)) * U32(0x9E3779B1)
    m ^= m >> U32(16)
    m *= U32(0x7FEB352D)
    m ^= m >> U32(15)
    before = []
    for k in (1, 2, 3):
        x = np.full(len(items), 7, U32)
        x[k:] = m[:-k]
        x[place < k] = 7
        before.append(x)
    one, two, three = before
    out = []
    for x in (one + U32(1), one * U32(3) + two * U32(5) + U32(2), two + U32(3), three + U32(4)):
        x = x * U32(0x846CA68B)
        x ^= x >> U32(16)
        out.append(x)
    return out


@dataclass
class MaxentModel:
    tokens: int
    vocabulary: int
    known: np.ndarray  # hashes of the words with a place of their own, sorted
    count: np.ndarray
    below: np.ndarray  # log10 of the denominator of P(spelling | ending), for each ending
    path: np.ndarray  # of each place, the splits on its way, as 2 split + side
    length: np.ndarray
    rest: np.ndarray  # log10 P(place | where its path ends)
    bias: np.ndarray
    mixed: np.ndarray  # hash of each split
    weights: tuple[np.ndarray, np.ndarray]  # of the splits between classes, and within

    def places(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token in the model, and whether it is its own."""
        if not len(self.known):
            return tokens.ending.copy(), np.zeros(len(tokens.hash), bool)
        # Hashes are even, so their first bits lead close to the place; a few steps go the rest.
        bits = len(self.known).bit_length() + 2
        shift = np.uint64(64 - bits)
        starts = np.searchsorted(self.known, np.arange((1 << bits) + 1, dtype=np.uint64)[:-1] << shift)
        steps = int(np.bincount((self.known >> shift).astype(np.int64)).max())
        at = starts.take((tokens.hash >> shift).astype(np.int64))
        last = len(self.known) - 1
        for _ in range(steps):
            at += self.known.take(np.minimum(at, last)) < tokens.hash
        at = np.minimum(at, last)
        own = self.known.take(at) == tokens.hash
        return np.where(own, at, len(self.known) + tokens.ending).astype(np.int32), own

    def walk(self, items: np.ndarray, features: list[np.ndarray], seen: tuple[np.ndarray, np.ndarray] | None = None, rate: float = 0.0) -> np.ndarray:
        """log10 of the product of the splits on each token's way; with ``seen`` (summed squared gradients), Adagrad steps too."""
        out = np.zeros(len(items))
        shift = [U32(32 - (len(w).bit_length() - 1)) for w in self.weights]
        for k in range(0, len(items), STEP):
            own = items[k : k + STEP]
            length = self.length.take(own)
            order = np.argsort(length, kind="stable")[::-1]  # tokens still on their way are always the first
            rows, line = self.path.take(own.take(order), axis=0), [f[k : k + STEP].take(order) for f in features]
            live = len(own) - np.concatenate([[0], np.cumsum(np.bincount(length))])
            total = np.ones(len(own))
            for d in range(int(length.max(initial=0))):
                n = int(live[d + 1])
                step = rows[:n, d]
                split, side = (step >> 1).astype(np.int64), step.astype(U32) << U32(31)
                kind = int(d >= CLASS_SPLITS)
                w, z, salt, slots = self.weights[kind], self.bias.take(split), self.mixed.take(split), []
                for f in FEATURES[d]:
                    x = line[f][:n] ^ salt
                    x *= U32(0xC2B2AE35)
                    x >>= shift[kind]
                    slots.append(x.astype(np.int64))
                    z += w.take(slots[-1])
                z.view(U32)[:] ^= side  # the sign of the side that was not taken
                p = 1 / (1 + np.exp(z))
                total[:n] *= p
                if seen is not None:
                    g = 1 - p
                    square = g * g
                    g *= -rate
                    g.view(U32)[:] ^= side
                    for slot in slots:
                        np.add.at(seen[kind], slot, square)
                        np.add.at(w, slot, g / np.sqrt(seen[kind].take(slot)))
            out[k : k + STEP][order] = np.log10(np.maximum(total, 1e-300))
        return out


def learnt_order(beside: np.ndarray) -> np.ndarray:
    """A rank for each ending such that endings with like neighbours stand together: halved again and again along the main axis of what is left.

    ``beside[e]`` counts the hashed neighbours of the words with that ending.
    """
    n = beside.sum(1)
    share = np.sqrt(beside / np.maximum(n, 1)[:, None])
    weight = n + 1e-9
    x = (share - (share * weight[:, None]).sum(0) / weight.sum()) * (n / (n + 40))[:, None]
    rank = np.zeros(len(beside), np.int64)

    def halve(rows: np.ndarray, left: int, code: int) -> None:
        if not left or len(rows) < 2:
            rank[rows] = code << left
            return
        own, w = x[rows], weight[rows]
        own = own - (own * w[:, None]).sum(0) / w.sum()
        line = own @ np.linalg.eigh((own * w[:, None]).T @ own)[1][:, -1]
        cut = 0.0
        for _ in range(20):
            high = line > cut
            if high.all() or not high.any():
                break
            cut = (np.average(line[high], weights=w[high]) + np.average(line[~high], weights=w[~high])) / 2
        high = line > cut
        halve(rows[~high], left - 1, code << 1)
        halve(rows[high], left - 1, code << 1 | 1)

    halve(np.arange(len(beside)), 8, 0)
    return rank


def line_up(mass: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places on a line by rank, then mass, halved by mass: (path, length, rest, bias) of :class:`MaxentModel`."""
    bits = 48
    order = np.lexsort((-mass, rank))
    middle = np.empty(len(mass))
    middle[order] = np.cumsum(mass[order]) - mass[order] / 2
    code = (middle / mass.sum() * 2.0**bits).astype(np.int64)
    line = np.argsort(code, kind="stable")
    codes, sums = code[line], np.concatenate([[0.0], np.cumsum(mass[line])])
    length, path, bias = np.zeros(len(mass), np.uint8), np.zeros((len(mass), SPLITS), np.int32), []
    holds = np.full(len(mass), mass.sum())  # mass of the part in which each place still stands
    live, splits = np.arange(len(mass)), 0
    for d in range(bits):
        if not len(live):
            break
        low = code[live] >> (bits - d) << (bits - d)
        half = 1 << (bits - d - 1)
        a, b, c = (np.searchsorted(codes, low + k * half) for k in range(3))
        left, right = sums[b] - sums[a], sums[c] - sums[b]
        real = (b > a) & (c > b)
        own, upper = live[real], (code[live[real]] & half > 0).astype(np.int32)
        part, at = np.unique(low[real], return_inverse=True)
        path[own, length[own]] = 2 * (splits + at) + upper
        length[own] += 1
        odds = np.zeros(len(part))
        odds[at] = np.log(right[real] / left[real])
        bias.append(odds)
        splits += len(part)
        holds[own] = np.where(upper > 0, right[real], left[real])
        live = live[(c - a > 1) & (length[live] < SPLITS)]
    return path, length, np.log10(np.minimum(mass / holds, 1.0)), np.concatenate([*bias, np.zeros(0)]).astype(np.float32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: counts of words; kind 1: of (ending, hashed neighbour, side), summed over the task."""
    beside = np.zeros(ENDINGS * 2 * BESIDE, np.int64)

    def rows(kind: int, word, ending, n) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(word), 200_000):
            own = slice(k, k + 200_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word[own]), kind, np.int32)), *(pa.array(x[own]) for x in (word, ending, n))], names=["kind", "word", "ending", "n"])

    for batch in pieces(batches, most=4 << 20):
        tokens = Tokens(batch.column("text"))
        word, first, n = np.unique(tokens.hash, return_index=True, return_counts=True)
        yield from rows(0, word.view(np.int64), tokens.ending[first], n)
        e = tokens.ending.astype(np.int64)
        near = e * 0x9E3779B1 % 0xFFFFFFFB % BESIDE
        beside += np.bincount(e[1:] * 2 * BESIDE + near[:-1], minlength=len(beside))
        beside += np.bincount(e[:-1] * 2 * BESIDE + BESIDE + near[1:], minlength=len(beside))
    cells = np.flatnonzero(beside)
    yield from rows(1, cells, np.zeros(len(cells), np.int32), beside[cells])


def _train(shared, rate: float):
    """Adagrad steps over a task's texts; of each block of both tables (weights x information, information)."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        # Copied to numpy's own float32: an array that was unpickled has a dtype object of its own, with which add.at is many times slower.
        model.weights = tuple(w.astype(np.float32) for w in model.weights)
        seen = tuple(np.ones(len(w), np.float32) for w in model.weights)
        for batch in batches:
            items, first = _blob(batch.column("items"))
            model.walk(items, context(items, first), seen, rate)
        for kind, (w, g) in enumerate(zip(model.weights, seen)):
            g -= 1
            for block, (x, y) in enumerate(zip(np.split(w, BLOCKS), np.split(g, BLOCKS))):
                if y.any():
                    yield pa.RecordBatch.from_arrays([pa.array([kind * BLOCKS + block], pa.int32()), pa.array([(x * y).tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["block", "sums", "seen"])

    return train


def _blob(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of all texts end to end, and the n + 1 bounds of the texts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(column.buffers()[2], np.int32)[offsets[0] // 4 : offsets[-1] // 4], (offsets - offsets[0]) // 4


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each block, held block by block, however many rows come."""
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, *raw in zip(*(batch.column(c).to_pylist() for c in ("block", "sums", "seen"))):
            parts = [np.frombuffer(x, np.float32) for x in raw]
            if block in total:
                for held, x in zip(total[block], parts):
                    held += x
            else:
                total[block] = [x.copy() for x in parts]
    for block, (sums, seen) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sums.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary())], names=["block", "sums", "seen"])


def start_model(texts: DataFrame) -> tuple[MaxentModel, DataFrame]:
    """The model of ``texts(text)`` before training, and the table (word, n) of all words' counts.

    The driver holds at most FREQUENT words and the neighbour counts of the ENDINGS.
    """
    counted = texts.select("text").mapInArrow(_count, "kind int, word long, ending int, n long").groupBy("kind", "word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))
    counted = kept(counted, "counts")
    counts = counted.where("kind = 0").select("word", "ending", "n")
    beside = np.zeros(ENDINGS * 2 * BESIDE)
    cells = counted.where("kind = 1").select("word", "n").toPandas()
    beside[cells.word.to_numpy(np.int64)] = cells.n
    vocabulary, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    steps = {r.step: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).alias("step")).count().collect()}
    least, held = LEAST.bit_length() - 1, 0
    for step in sorted(steps, reverse=True):
        held += steps[step]
        if held >= FREQUENT:
            least = max(least, step + 1)
            break
    frequent = (F.col("n") >= F.lit(2.0) ** least) | (F.col("word") == int(END.astype(np.int64)))
    table = counts.where(frequent).toPandas()
    order = np.argsort(table.word.to_numpy(np.int64).view(np.uint64))
    known, count = table.word.to_numpy(np.int64).view(np.uint64)[order], table.n.to_numpy(np.int64)[order]
    n_in, v_in = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for row in counts.where(~frequent).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        n_in[row.ending], v_in[row.ending] = row.n, row.v
    # The half is for the slot of unseen words.
    mass = np.concatenate([count.astype(float), n_in + 0.5])
    rank = learnt_order(beside.reshape(ENDINGS, -1))
    path, length, rest, bias = line_up(mass, rank[np.concatenate([table.ending.to_numpy(np.int64)[order], np.arange(ENDINGS)])])
    bits = int(np.clip(np.ceil(np.log2(max(total, 1) * EACH)), LEAST_BITS, MOST_BITS))
    mixed = (np.arange(len(bias), dtype=U32) + U32(1)) * U32(0x9E3779B1)
    mixed ^= mixed >> U32(15)
    mixed *= U32(0x85EBCA6B)
    weights = np.zeros(1 << (bits - 2), np.float32), np.zeros(1 << bits, np.float32)
    return MaxentModel(int(total), int(vocabulary), known, count, np.log10(n_in + 0.5 * (v_in + 1)), path, length, rest, bias, mixed, weights), counts


def train_model(model: MaxentModel, encoded: DataFrame, *, rounds: int = 2, rate: float = 0.3) -> None:
    """Train in place on ``encoded(row, items)``; each text is used in the round that its hashed row falls to.

    A task sees TRAINER tokens whatever the input's size; averages are summed by blocks in the executors, so the driver gets one model a round.
    """
    spark = encoded.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        own = encoded.where(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(rounds)) == turn).select("items")
        trainers = max(1, round(model.tokens / rounds / TRAINER))
        parts = own.coalesce(trainers).mapInArrow(_train(shared, rate), "block int, sums binary, seen binary")
        parts = parts.repartition("block").mapInArrow(_add, "block int, sums binary, seen binary")
        weights = tuple(w.copy() for w in model.weights)
        for row in parts.collect():  # the weights of one model, and their information
            w = np.split(weights[row.block // BLOCKS], BLOCKS)[row.block % BLOCKS]
            sums, seen = np.frombuffer(row.sums, np.float32), np.frombuffer(row.seen, np.float32)
            np.divide(sums, seen, out=w, where=seen > 0)
        shared.unpersist()
        model.weights = weights


def score_maxent(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are words and one end for each text; null and empty texts have the end alone. Learns from rows whose
    crc32(id as text) mod 5 is not 1 (a null id counts as empty text). ``base_score`` is the smoothed unigram log10
    probability, ``score`` the model's. Repeated rows are scored each; without training rows every word is unseen. An empty
    table gives no rows; other columns are not read. Words are told apart by 64 bits of hash.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)[id_col]
    texts = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))
    held_out = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    model, counts = start_model(texts.where(~held_out))
    shared = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, most=4 << 20):
            tokens = Tokens(batch.column("text"))
            items, own = model.places(tokens)
            base, inner = np.zeros(len(items)), model.rest[items]
            base[own] = np.log10(model.count[items[own]] + 0.5)
            inner[~own] -= model.below[tokens.ending[~own]]
            cut = tokens.first[:-1]
            raw = items.tobytes()
            bounds = np.concatenate([[0], np.cumsum(~own)])[tokens.first].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(fold(batch.column("id").to_pylist()) == HELD_OUT),
                    pa.array(tokens.counts.astype(np.int64)),
                    pa.array(np.add.reduceat(own.astype(np.int64), cut)),
                    pa.array(np.add.reduceat(base, cut)),
                    pa.array(np.add.reduceat(inner, cut)),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(tokens.first[:-1].tolist(), tokens.first[1:].tolist())], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(tokens.hash[~own].view(np.int64))),
                ],
                names=["id", "held_out", "n_tokens", "n_known", "base", "inner", "items", "words"],
            )

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, inner double, items binary, words array<long>"
    encoded = kept(texts.mapInArrow(encode, schema).withColumn("row", F.monotonically_increasing_id()), "encoded")
    train_model(model, encoded.where("not held_out").select("row", "items"), rounds=rounds)
    trained = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trained.value
        for batch in batches:
            items, first = _blob(batch.column("items"))
            if len(first) > 1:
                logs = np.add.reduceat(model.walk(items, context(items, first)), first[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(logs)], names=["row", "logs"])

    scored = encoded.select("row", "items").mapInArrow(score, "row long, logs double")
    words = encoded.select("row", F.explode("words").alias("word")).groupBy("word", "row").agg(F.count("*").alias("times"))
    found = words.join(counts.select("word", "n"), "word", "left")
    found = found.select("row", (F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log"), F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("hit"))
    logs = found.groupBy("row").agg(F.sum("log").alias("log"), F.sum("hit").alias("hit"))
    log = F.coalesce("log", F.lit(0.0))
    below = float(np.log10(model.tokens + 0.5 * (model.vocabulary + 1)))
    rows = encoded.drop("items", "words").join(scored, "row").join(logs, "row", "left")
    return rows.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("hit", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("logs") + F.col("inner") + log).alias("score"),
    )


def op3_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_maxent(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_maxent_scoring": op3_maxent_scoring}
SQL: dict[str, str] = {}
