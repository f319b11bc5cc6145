"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017) over hashed words and word beginnings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm.textkit import NO_LETTER, Words, fold, pieces
from annolith.session import discard, kept

BUCKETS = 1 << 20
#: Lengths in bytes of the word beginnings that count as features beside whole words (0).
BEGINNINGS = (0, 5, 6, 7)
FOLDS, HELD_OUT = 5, 0
#: Bytes of text taken apart at once; a task holds about 25 times as much.
PIECE = 2 << 20


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all features of all texts, sorted, without repeats."""
    words = Words(column, NO_LETTER)
    owner, size = words.owner(), words.end - words.start
    found = []
    for most in BEGINNINGS:
        own = slice(None) if not most else size >= most
        h = words.hashes(most or None)[own] + np.uint64(most)
        found.append(owner[own] * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return keys // BUCKETS, keys % BUCKETS


def chosen_features(column: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, number) of the features with a ``place`` (the number of each bucket, -1: none), sorted, without repeats."""
    words = Words(column, NO_LETTER)
    owner, size = words.owner(), words.end - words.start
    found = []
    for most in BEGINNINGS:
        at = place.take(((words.hashes(most or None) + np.uint64(most)) % np.uint64(BUCKETS)).astype(np.int64))
        own = np.flatnonzero((at >= 0) & (size >= most))
        found.append(owner[own] * BUCKETS + at[own])
    keys = np.unique(np.concatenate(found))
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class ToxicityModel:
    """Log-odds of a text: ``bias`` and the weights of its distinct buckets."""

    bias: float
    weights: np.ndarray

    def __post_init__(self):
        hit = np.flatnonzero(self.weights)
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[hit] = np.arange(len(hit))
        self.own = self.weights[hit]

    def log_odds(self, column: pa.Array) -> np.ndarray:
        text, number = chosen_features(column, self.place)
        return self.bias + np.bincount(text, self.own[number], len(column))


def nnpu(
    p: tuple[np.ndarray, np.ndarray, np.ndarray],
    u: list[tuple[np.ndarray, np.ndarray]],
    prior: float,
    theta: np.ndarray,
    *,
    steps: int,
    rate: float,
    decay: float = 3e-4,
) -> np.ndarray:
    """``theta`` (weights, bias) after steps of Adam on max(0, R_u(-) - prior R_p(-)) + prior R_p(+) of a logistic regression.

    ``p`` is (starts of rows, columns, times) of confirmed texts, ``u`` (starts, columns) of each batch of unlabelled ones, which
    take turns. Where the corrected risk of negatives falls below nought, the step goes up that part's gradient only, as Kiryo
    et al. prescribe; elsewhere the confirmed texts' two gradients add up to a constant.
    """
    width = len(theta) - 1

    def margins(x, w, b):
        sums = np.concatenate([[0.0], np.cumsum(w[x[1]])])
        return b + np.diff(sums[x[0]])

    def gradient(x, per_row):
        return np.append(np.bincount(x[1], np.repeat(per_row, np.diff(x[0])), width), per_row.sum())

    share_p = p[2] / p[2].sum()
    upwards = -gradient(p, prior * share_p)
    theta = theta.copy()
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        own = u[step % len(u)]
        n_u = len(own[0]) - 1
        sp = 1 / (1 + np.exp(-np.clip(margins(p, w, b), -500, 500)))
        su = 1 / (1 + np.exp(-np.clip(margins(own, w, b), -500, 500)))
        negative = -np.log1p(-su * (1 - 1e-12)).mean() + prior * (share_p * np.log1p(-sp * (1 - 1e-12))).sum()
        g = gradient(own, su / n_u)
        g = g + upwards if negative >= 0 else gradient(p, prior * share_p * sp) - g
        g[:-1] += decay * w
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def _rows(sizes: list[bytes], columns: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes_ = np.frombuffer(b"".join(sizes), np.int32)
    return np.concatenate([[0], np.cumsum(sizes_)]), np.frombuffer(b"".join(columns), np.int32)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_positive: int = 10_000,
    least_gain: float = 10.0,
    rounds: int = 4,
    steps: int = 75,
    part_rows: int = 50_000,
    batch_rows: int = 8_192,
) -> ToxicityModel:
    """Learn from labels and texts whose fold is not the held-out one.

    The confirmed side is at most about ``max_positive`` texts, picked by a hash (a bounded sample of labelled rows); equal
    rows of an id are one of as many times' weight. The unlabelled side is every text: their features are kept as a table,
    and in each of ``rounds`` every task takes ``steps`` steps over all confirmed texts and its own unlabelled ones (``part_rows`` at
    least), dealt to batches of about ``batch_rows`` or more that take turns; then the tasks' weights are averaged by their rows. The prior is counted over all labels. Features are
    all buckets whose log-likelihood gain for confirmed texts, from document frequencies over all texts, reaches
    ``least_gain``; the number of buckets bounds what the driver holds. Null labels and ids are passed over; of repeated
    labels of an id the largest counts. Without a confirmed toxic text, or without any other, every text scores the prior
    (nought, as far as a logistic goes, without labels).
    """
    spark = documents.sparkSession
    known = (
        labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y"))
        .where("id is not null and y is not null")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    n, positive = known.agg(F.count("*"), F.sum((F.col("y") == 1).cast("long"))).first()
    if not n or not positive or n == positive:
        rate = (positive or 0) / n if n else 0.0
        return ToxicityModel(float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))), np.zeros(BUCKETS))
    prior = positive / n
    flat = ToxicityModel(float(np.log(prior / (1 - prior))), np.zeros(BUCKETS))
    ids = [r.id for r in known.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(max_positive).select("id").collect()]
    confirmed = spark.sparkContext.broadcast(np.sort(np.array(ids)))
    texts = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in pieces(batches, most=PIECE):
            is_p = np.isin(np.asarray(batch.column("id")), confirmed.value)
            owner, bucket = features(batch.column("text"))
            np.add.at(total[0], bucket[is_p[owner]], 1)
            np.add.at(total[1], bucket, 1)
            rows += [is_p.sum(), len(is_p)]
        # Only buckets that a confirmed text may choose need the counts of all texts; one row for each bucket at most.
        seen = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(total[0][seen], rows[0])), pa.array(np.append(total[1][seen], rows[1]))],
            names=["bucket", "p", "u"],
        )

    counts = kept(texts.mapInArrow(count, "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")), "counts")
    whole = counts.where("bucket = -1").first()
    if whole is None or not whole.p:
        return flat
    ratio = F.log(((F.col("p") + 0.5) / (whole.p + 1)) / ((F.col("u") + 0.5) / (whole.u + 1)))
    chosen = np.sort(np.array([r.bucket for r in counts.where("bucket >= 0").where(F.col("p") * ratio >= least_gain).select("bucket").collect()], np.int64))
    discard(counts)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    places = spark.sparkContext.broadcast(place)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=PIECE):
            is_p = np.isin(np.asarray(batch.column("id")), confirmed.value)
            owner, number = chosen_features(batch.column("text"), places.value)
            sizes = np.bincount(owner, minlength=batch.num_rows).astype(np.int32)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            number = number.astype(np.int32)
            sure = np.flatnonzero(is_p)
            # One row for the unlabelled texts of a piece, confirmed ones among them, and one for each confirmed text.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.nulls(1, batch.schema.field("id").type), batch.column("id").take(pa.array(sure))]),
                    pa.array([sizes.tobytes(), *[sizes[i : i + 1].tobytes() for i in sure]], pa.binary()),
                    pa.array([number.tobytes(), *[number[bounds[i] : bounds[i + 1]].tobytes() for i in sure]], pa.binary()),
                    pa.array([batch.num_rows] + [1] * len(sure), pa.int64()),
                ],
                names=["id", "sizes", "columns", "n"],
            )

    table = kept(texts.mapInArrow(pick, f"id {dict(documents.dtypes)[id_col]}, sizes binary, columns binary, n long"), "features")
    own = table.where("id is not null").groupBy("id", "sizes", "columns").agg(F.sum("n").alias("n"))
    own = own.orderBy(F.xxhash64("id", "columns")).limit(max_positive).collect()
    p = (*_rows([bytes(r.sizes) for r in own], [bytes(r["columns"]) for r in own]), np.array([r.n for r in own], float))
    loose = table.where("id is null").select("sizes", "columns", "n")
    n_u = loose.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not len(own) or not n_u:
        discard(table)
        return flat
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = flat.bias
    sure = spark.sparkContext.broadcast(p)
    for turn in range(rounds):
        start = spark.sparkContext.broadcast(theta)

        def descend(batches: Iterator[pa.RecordBatch], turn=turn, start=start) -> Iterator[pa.RecordBatch]:
            held: list[tuple[bytes, bytes]] = []
            rows = 0

            def step() -> pa.RecordBatch:
                n_batches = max(1, min(rows // batch_rows, steps, len(held)))
                u = [_rows(*map(list, zip(*held[k::n_batches]))) for k in range(n_batches)]
                out = nnpu(sure.value, u, prior, start.value, steps=steps, rate=0.05 / 2**turn)
                return pa.RecordBatch.from_arrays([pa.array([(out * rows).tobytes()], pa.binary()), pa.array([rows], pa.int64())], names=["theta", "n"])

            for batch in batches:
                for sizes, columns, k in zip(*(batch.column(c).to_pylist() for c in ("sizes", "columns", "n"))):
                    held.append((sizes, columns))
                    rows += k
                    if rows >= 2 * part_rows:
                        yield step()
                        held, rows = [], 0
            if rows:
                yield step()

        parts = loose.coalesce(max(1, n_u // part_rows)).mapInArrow(descend, "theta binary, n long")
        # Summed in the executors: the driver gets one vector of weights from each of a few sums.
        sums = parts.repartition(8).mapInArrow(_sum, "theta binary, n long").collect()
        theta = sum(np.frombuffer(r.theta) for r in sums) / sum(r.n for r in sums)
    discard(table)
    weights = np.zeros(BUCKETS)
    weights[chosen] = theta[:-1]
    return ToxicityModel(float(theta[-1]), weights)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    theta, n = None, 0
    for batch in batches:
        for raw, k in zip(batch.column("theta").to_pylist(), batch.column("n").to_pylist()):
            own = np.frombuffer(raw)
            theta, n = (own.copy() if theta is None else theta + own), n + k
    if theta is not None:
        yield pa.RecordBatch.from_arrays([pa.array([theta.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["theta", "n"])


def _judge(batch: pa.RecordBatch, model: ToxicityModel, text: str) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.log_odds(batch.column(text)), -500, 500)))


def score_toxicity(documents: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``, in one scan.

    Whole texts are scored; null and empty texts get the score of a text without features. Repeated rows are scored each;
    other columns are not read; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    source = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=PIECE):
            score = _judge(batch, shared.value, "text")
            own = [pa.array(fold(batch.column("id").to_pylist()) == HELD_OUT), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *own], names=["id", "held_out", "score", "predicted"])

    out = source.mapInArrow(judge, f"id {dict(documents.dtypes)[id_col]}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def without_toxic(documents: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """The rows that score below 0.5, with all their columns unchanged, in one scan; each row is judged by its own text, ids are not read."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col, most=PIECE):
            yield batch.filter(pa.array(_judge(batch, shared.value, text_col) < 0.5))

    return documents.mapInArrow(clean, documents.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(documents, fit_toxicity(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, with all their columns unchanged.

    Rows without an id, repeated rows and empty texts are judged like all others, by their text alone; an empty table stays empty.
    """
    return without_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op5_toxicity": op5_toxicity}
SQL: dict[str, str] = {}
