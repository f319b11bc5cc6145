"""Approximate nearest neighbours: inverted lists, scanned with adaptive dimension sampling (Gao and Long, 2023).

Vectors are scaled to unit length and rotated at random. In each probed list the columns are read in blocks; after each block
a test on the partial distance drops the candidates that are, with high confidence, farther than the nearest found. What is
found tightens the test as the scan of a list goes on, and what the nearest list gave is where the scans of the others begin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolith.session import discard, kept

#: Rows of a list, and queries to it, that one task scans at once; longer ones are dealt in parts.
PART, ASKED = 4096, 1024


@dataclass
class ScanIndex:
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def rank(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest centres of each rotated unit vector, nearest first."""
        far = -2 * (x @ self.centres.T) + (self.centres**2).sum(1)
        if n == 1:
            return far.argmin(1)[:, None]
        n = min(n, far.shape[1])
        near = np.argpartition(far, n - 1, axis=1)[:, :n]
        return np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(1), 1)


def fit_index(sample: np.ndarray, lists: int, *, k: int, reach: float, seed: int = 11, turns: int = 8) -> ScanIndex:
    """Rotation, k-means centres, and the probes with which ``reach`` of the sample's own k nearest lie in probed lists."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))[0]
    x = sample @ rotation
    lists = max(1, min(lists, len(x)))
    index = ScanIndex(rotation, x[rng.choice(len(x), lists, replace=False)].copy(), 1)
    for _ in range(turns):
        own = index.rank(x, 1)[:, 0]
        n = np.bincount(own, minlength=lists)
        sums = np.zeros_like(index.centres)
        np.add.at(sums, own, x)
        index.centres[n > 0] = sums[n > 0] / n[n > 0, None]
    own = index.rank(x, 1)[:, 0]
    asked = np.arange(0, len(x), max(1, len(x) // 256))
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(x) - 1)
    if k > 0:
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.argsort(index.rank(x[asked], lists), axis=1)
        index.probes = int(np.quantile(np.take_along_axis(order, own[best], 1), reach)) + 1
    return index


def scan(data: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, bound: float, *, columns: int = 16, strict: float = 2.1) -> np.ndarray:
    """The places in ``data`` of candidates that survive, a few more than k where ties are near.

    Rows are taken in runs of doubling length. After d of D rotated columns the partial squared distance, scaled by D / d, is
    tested against (1 + strict / sqrt(d))^2 times the kth distance found so far (``bound`` to begin with; inf: none).
    Rows that repeat an id make k as much larger, so that k different ids are kept.
    """
    width = data.shape[1]
    k += len(ids) - len(np.unique(ids))
    places, fars, best = [], [], np.full(k, np.inf)
    begin, size = 0, max(4 * k, 64)
    while begin < len(data):
        live = np.arange(begin, min(begin + size, len(data)))
        live = live[ids[live] != own]
        part = np.zeros(len(live))
        for a in range(0, width, columns):
            b = min(width, a + columns)
            part += ((data[live, a:b] - query[a:b]) ** 2).sum(1)
            if bound < np.inf:
                ok = part * (width / b) <= bound * (1 + strict / np.sqrt(b)) ** 2 + 1e-9 if b < width else part <= bound + 1e-9
                live, part = live[ok], part[ok]
        places.append(live)
        fars.append(part)
        best = np.partition(np.concatenate([best, part]), k - 1)[:k]
        bound = min(bound, best.max())
        begin, size = begin + size, 2 * size
    place, far = np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0), *fars])
    return place[far <= bound + 1e-9]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two so that their largest component is near 1: no sum of squares overflows or vanishes, no digit is lost."""
    x = np.ascontiguousarray(x, np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same sum in the same order wherever a row stands."""
    x, y = scaled(x), scaled(y)
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def search(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    max_sample: int = 8192,
    reach: float = 0.97,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found by cosine of each row whose id is divisible by ``every``.

    Ties go to the smaller id. Null ids and vectors, vectors of zero length or with null or non-finite components take no
    part. Vectors are compared with those of their own length: each length has its own index. A neighbour is an id: of rows
    that repeat it, the nearest to the query counts, and the query's own id is none; of rows that repeat a query's id, the
    smallest by its bytes asks. Fewer than k candidates are all returned: where probed lists hold fewer, more are probed. An
    empty table gives no rows. The index is fitted on at most about ``max_sample`` vectors, picked by a hash of the id, and holds every row.
    """
    spark = embeddings.sparkSession
    v = F.col("v")
    rows = embeddings.select(embeddings[id_col].cast("long").alias("id"), embeddings[vector_col].cast("array<double>").alias("v")).where("id is not null and v is not null")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists(v, lambda x: x != 0))
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("asks")).orderBy("w").collect()  # one row for each length
    pairs = [_pairs(rows.where(F.size("v") == w.w), w.w, w.n, every, k, max_sample, reach) for w in widths if w.asks and w.n > 1]
    if not pairs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = pairs[0]
    for more in pairs[1:]:
        found = found.union(more)
    # Of each query k rows for each probed part; ranked in groups of that size.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pairs(rows: DataFrame, width: int, n: int, every: int, k: int, max_sample: int, reach: float) -> DataFrame:
    """(query_id, vec_id, score) of what the scans of one vector length leave."""
    spark = rows.sparkSession
    share = min(1.0, max_sample / n)
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) <= int(share * (1 << 30))).select("v").toPandas()
    x = np.stack(sample.v.to_numpy()) if len(sample) else np.eye(1, width)
    lists = int(min(4096, max(4, round(n**0.5 / 4))))
    index = fit_index(unit(x), lists, k=k, reach=reach)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("v").flatten()).reshape(-1, width)
                turned = unit(x) @ shared.value.rotation
                blobs = pa.array([row.tobytes() for row in np.concatenate([turned, x], 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.rank(turned, 1)[:, 0].astype(np.int32)), batch.column("id"), blobs], names=["list", "id", "blob"])

    dealt = kept(rows.mapInArrow(assign, "list int, id long, blob binary"), "dealt")
    sizes = dealt.groupBy("list").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).collect()  # one row for each of at most 4096 lists
    held = np.zeros(len(index.centres), np.int64)
    for r in sizes:
        held[r["list"]] = r.ids

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = np.frombuffer(b"".join(batch.column("blob").to_pylist()), np.float64).reshape(-1, 2 * width)[:, :width]
            near = shared.value.rank(turned, len(held))
            # The fitted number of lists, and as many more as hold k other ids.
            probes = np.maximum(shared.value.probes, 1 + (np.cumsum(held[near], axis=1) < k + 1).sum(1))
            probes = np.minimum(probes, len(held))
            owner = np.repeat(np.arange(len(turned)), probes)
            turn = np.arange(len(owner)) - np.repeat(np.cumsum(probes) - probes, probes)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owner)), pa.array(near[owner, turn].astype(np.int32)), pa.array(turn.astype(np.int32))], names=["q_id", "list", "turn"])

    asks_table = kept(dealt.where(F.col("id") % every == 0).groupBy("id").agg(F.min("blob").alias("blob")), "asks")
    probed = kept(asks_table.mapInArrow(probe, "q_id long, list int, turn int"), "probed")
    asks = asks_table.select(F.col("id").alias("q_id"), F.col("blob").alias("q_blob"))

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            left = left.drop_duplicates(["id", "blob"])
            x = np.frombuffer(b"".join(left.blob), np.float64).reshape(-1, 2 * width)
            q = np.frombuffer(b"".join(right.q_blob), np.float64).reshape(-1, 2 * width)
            ids = left.id.to_numpy()
            for i, (own, bound) in enumerate(zip(right.q_id.to_numpy(), right.bound.to_numpy())):
                place = scan(x[:, :width], ids, q[i, :width], own, k, bound)
                score = cosine(x[place, width:], np.broadcast_to(q[i, width:], (len(place), width)))
                best = np.lexsort((ids[place], -score))
                best = best[np.sort(np.unique(ids[place][best], return_index=True)[1])][:k]  # of each id the nearest row
                found.append((np.full(len(best), own), ids[place][best], score[best]))
        table = {c: np.concatenate([f[j] for f in found]) if found else [] for j, c in enumerate(("query_id", "vec_id", "score"))}
        return pd.DataFrame(table).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def scans(questions: DataFrame) -> DataFrame:
        """Answers to (q_id, list, bound): lists and their questions are dealt in blocks of bounded size."""
        blocks = dealt.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
        blocks = blocks.join(questions.groupBy("list").agg(F.ceil(F.count("*") / ASKED).cast("long").alias("sets")), "list")
        blocks = F.broadcast(blocks)  # one row for each of at most 4096 lists
        every_one = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        data = dealt.join(blocks, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn("set", every_one("sets"))
        asked = questions.join(blocks, "list").withColumn("set", F.pmod(F.xxhash64("q_id"), F.col("sets"))).withColumn("part", every_one("parts"))
        asked = asked.join(asks, "q_id").select(F.col("list").alias("q_list"), F.col("part").alias("q_part"), F.col("set").alias("q_set"), "q_id", "q_blob", "bound")
        data = data.select("list", "part", "set", "id", "blob")
        return data.groupBy("list", "part", "set").cogroup(asked.groupBy("q_list", "q_part", "q_set")).applyInPandas(answer, "query_id long, vec_id long, score double")

    first = kept(scans(probed.where("turn = 0").select("q_id", "list", F.lit(float("inf")).alias("bound"))), "nearest")
    # The kth distance of unit vectors that the nearest list gave, over different ids.
    best = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False).alias("s"))
    bounds = best.select(F.col("query_id").alias("q_id"), (2 - 2 * F.try_element_at("s", F.lit(k))).alias("kth"))
    rest = probed.where("turn > 0").join(bounds, "q_id", "left").select("q_id", "list", (F.coalesce("kth", F.lit(float("inf"))) + 1e-9).alias("bound"))
    out = kept(first.union(scans(rest)), "pairs")
    discard(dealt, asks_table, probed, first)
    return out


def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op2_adaptive_scan": op2_adaptive_scan}
SQL: dict[str, str] = {}
