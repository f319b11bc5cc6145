"""Exact n-gram Jaccard join by set-relation skipping (after Wang et al., 2017), to connected components.

Equal sets are one node. A node's prefix (the tokens of which a set with Jaccard 0.8 must share one) goes to lists by token;
frequent tokens come last in the token order, so passages that many texts share are seldom in a prefix. Lists are sorted by
set size and cut in blocks, of which those too far in size or position for the bound are skipped as a whole. Answers
are derived from those of similar sets: each list first asks only its lead node against the others. Whoever is linked to the
same component needs no further test, and a measured distance to the lead bounds the distances among the rest (Jaccard
distance is a metric). What remains goes on with new leads, first the most central node of each list and then any other,
and in the end pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm.components import components
from annolith.llm.textkit import mix, pieces, shingle_sets
from annolith.session import discard, kept, sweep

#: Frequent tokens that are ordered by frequency; a bound on what is broadcast (16 bytes each), without effect on results.
FREQUENT = 1 << 18
#: Entries of a frequent token's list that go to one part; later rounds let the parts of a list meet one by one.
PART = 4_000
#: Bytes of text taken apart at once; tokens among which a task looks for repeated ones.
PIECE, WINDOW = 2 << 20, 2_500_000
ENTRY = ("token", "part", "node", "size", "place")
SALT_A, SALT_B = np.uint64(0x1B873593CC9E2D51), np.uint64(0x5851F42D4C957F2D)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever the order of its tokens; 0 for empty sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((2, len(sets)), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        tokens = np.concatenate(sets)
        starts = (np.cumsum(sizes) - sizes)[full]
        for k, salt in enumerate((SALT_A, SALT_B)):
            out[k][full] = mix(np.add.reduceat(mix(tokens ^ salt), starts) + sizes[full].astype(np.uint64))
    return out[0].view(np.int64), out[1].view(np.int64)


def prefix_length(size: int, percent: int) -> int:
    """Two sets that reach the bound share one of the first so many tokens of each, in any common token order."""
    return size - -(-size * percent // 100) + 1


def _scan(width: int):
    """Rows of documents (id, n, a, b), and of tokens that several distinct sets of a task's WINDOW hold (token, hits)."""

    def rows(id_, n, a, b, token, hits) -> pa.RecordBatch:
        line = [pa.array(x, pa.int64()) if x is not None else None for x in (id_, n, a, b, token, hits)]
        size = max(len(x) for x in line if x is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()) if x is None else x for x in line], names=["id", "n", "a", "b", "token", "hits"])

    def frequent(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        tokens, hits = (np.concatenate([h[k] for h in held]) for k in range(2))
        order = np.argsort(tokens, kind="stable")
        tokens, hits = tokens[order], hits[order]
        starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
        hits = np.add.reduceat(hits, starts) if len(starts) else hits
        return rows(None, None, None, None, tokens[starts][hits > 1].view(np.int64), hits[hits > 1])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, seen = [], 0, set()
        for batch in pieces(batches, most=PIECE):
            sets = shingle_sets(batch.column("text"), width)
            a, b = signatures(sets)
            yield rows(batch.column("id").cast(pa.int64()), np.array([len(s) for s in sets], np.int64), a, b, None, None)
            fresh = [s for s, x in zip(sets, a.tolist()) if x not in seen and not seen.add(x)]
            held.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *fresh]), return_counts=True))
            total += len(held[-1][0])
            if total > WINDOW:
                yield frequent(held)
                held, total, seen = [], 0, set()
        if held:
            yield frequent(held)

    return scan


def _prefixes(width: int, percent: int, frequent):
    """Prefix entries (token, part, node, size, place) of the distinct sets of each task.

    A list of one part has part 0, a split one parts from 1 on: whoever sees a part only knows that more entries are elsewhere.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order = frequent.value
        parts_of = 1 + order // PART
        seen: set[int] = set()
        for batch in pieces(batches, most=PIECE):
            parts = []
            sets = shingle_sets(batch.column("text"), width)
            for node, tokens in zip(signatures(sets)[0].tolist(), sets):
                if not len(tokens) or node in seen:
                    continue
                seen.add(node)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    rank = np.where(known[at] == tokens, order[at], 0)
                    line = np.argsort(rank, kind="stable")[: prefix_length(len(tokens), percent)]
                    own = parts_of[at[line]]
                    part = np.where((rank[line] > 0) & (own > 1), 1 + node % own, 0)
                else:
                    line = slice(prefix_length(len(tokens), percent))
                    part = np.zeros(line.stop, np.int64)
                parts.append((tokens[line].view(np.int64), node, len(tokens), part))
            if len(seen) > 1_000_000:
                seen.clear()  # more repeats go to the lists, which drop them
            if not parts:
                continue
            sizes = np.array([len(p[0]) for p in parts])
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([p[0] for p in parts])),
                    pa.array(np.concatenate([p[3] for p in parts]).astype(np.int32)),
                    pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), sizes)),
                    pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), sizes)),
                    pa.array(place.astype(np.int32)),
                ],
                names=["token", "part", "node", "size", "place"],
            )

    return emit


def _near(size_x, place_x, size_y, place_y, percent: int):
    """Whether size and position leave room for the bound: 100 overlap >= percent (|x| + |y| - overlap)."""
    most = 1 + np.minimum(size_x - place_x - 1, size_y - place_y - 1)
    return (100 + percent) * most >= percent * (size_x + size_y)


def _lists(percent: int, block: int):
    """Over whole lists, in order: questions of each list's lead (kind 0: a asks b), and entries of lists with more to ask (1)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append({c: np.asarray(batch.column(c)) for c in ENTRY})
            n += batch.num_rows
            if n < 200_000:
                continue
            rows = {c: np.concatenate([h[c] for h in held]) for c in ENTRY}
            last = (rows["token"] == rows["token"][-1]) & (rows["part"] == rows["part"][-1])
            cut = n if last.all() else int(np.argmax(last))  # a list may go on in the next batch
            yield from ask({c: v[:cut] for c, v in rows.items()})
            held, n = [{c: v[cut:] for c, v in rows.items()}], n - cut
        if n:
            yield from ask({c: np.concatenate([h[c] for h in held]) for c in ENTRY})

    def ask(rows) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((rows["node"], rows["part"], rows["token"]))
        rows = {c: v[order] for c, v in rows.items()}
        new_list = np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (rows["part"][1:] != rows["part"][:-1]))
        fresh = new_list | np.append(True, rows["node"][1:] != rows["node"][:-1])
        rows, new_list = {c: v[fresh] for c, v in rows.items()}, new_list[fresh]
        starts = np.flatnonzero(new_list)
        sizes = np.diff(np.append(starts, len(new_list)))
        # The lead is the smallest node: mostly the same one in all lists of a group, so its questions repeat and merge.
        lead = {c: np.repeat(rows[c][starts], sizes) for c in ("node", "size", "place")}
        split = rows["part"] > 0
        wanted = np.repeat(sizes > 1, sizes) | split
        # Each list by position, in blocks; a block is skipped where its largest rest and smallest size break the bound.
        owner = np.repeat(np.arange(len(sizes)), sizes)
        line = np.lexsort((rows["place"], owner))
        line = line[wanted[line]]
        if not len(line):
            return
        rows = {c: v[line] for c, v in rows.items()}
        lead = {c: v[line] for c, v in lead.items()}
        owner, split = owner[line], split[line]
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        length = np.diff(np.append(begin, len(owner)))
        inside = np.arange(len(owner)) - np.repeat(begin, length)
        blocks = np.flatnonzero(inside % block == 0)
        rest = np.maximum.reduceat(rows["size"] - rows["place"], blocks)
        small = np.minimum.reduceat(rows["size"], blocks)
        most = np.minimum(lead["size"][blocks] - lead["place"][blocks], rest)
        open_ = (100 + percent) * most >= percent * (lead["size"][blocks] + small)
        ok = np.repeat(open_, np.diff(np.append(blocks, len(owner)))) & (rows["node"] != lead["node"])
        ok = np.flatnonzero(ok)
        ok = ok[_near(lead["size"][ok], lead["place"][ok], rows["size"][ok], rows["place"][ok], percent)]
        pairs = np.unique(np.stack([lead["node"][ok], rows["node"][ok]], 1), axis=0)
        more = np.repeat(length > 2, length) | split
        for kind, *columns in (
            (0, pairs[:, 0], pairs[:, 1], *[np.zeros(len(pairs), t) for t in (np.int64, np.int32, np.int32, np.int32)]),
            (1, lead["node"][more], *[rows[c][more] for c in ("node", "token", "part", "size", "place")]),
        ):
            for k in range(0, len(columns[0]), 100_000):
                own = [x[k : k + 100_000] for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[0]), kind, np.int32)), *map(pa.array, own)], names=["kind", "a", "b", "token", "part", "size", "place"])

    return walk


def _verify(width: int, percent: int):
    """Exact overlap of the pairs' sets."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = np.empty(batch.num_rows, np.int64)
            sizes = np.empty((2, batch.num_rows), np.int64)
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common[k] = len(np.intersect1d(x, y, assume_unique=True))
                sizes[:, k] = len(x), len(y)
            union = sizes.sum(0) - common
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(1 - common / union), pa.array(100 * common >= percent * union)],
                names=["a", "b", "far", "linked"],
            )

    return test


def _answers(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, far, linked) of pairs of nodes. Only texts of nodes in question travel, once for each question at most."""
    asked = pairs.select("a").union(pairs.select("b")).distinct().join(nodes, F.col("a") == F.col("node")).select("node", "id")
    sets = texts.join(asked, "id").select("node", "text").mapInArrow(_sets(width), "node long, tokens binary")
    sets = kept(sets, "sets")
    del asked
    sweep(sets.sparkSession)  # the shuffled texts go before the sets are shuffled
    joined = pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    joined = joined.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").select("a", "b", "x", "y")
    out = kept(joined.mapInArrow(_verify(width, percent), "a long, b long, far double, linked boolean"), "answers")
    discard(sets)
    del sets, joined
    sweep(out.sparkSession)
    return out


def _sets(width: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=PIECE):
            sets = shingle_sets(batch.column("text"), width)
            # Where rows repeat an id, only the text that the node stands for counts.
            own = [(n, s.tobytes()) for n, m, s in zip(batch.column("node").to_pylist(), signatures(sets)[0].tolist(), sets) if n == m]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in own], pa.int64()), pa.array([s for _, s in own], pa.binary())], names=["node", "tokens"])

    return build


def jaccard_join(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    block: int = 64,
    lead_rounds: int = 2,
) -> DataFrame:
    """``id_col, n_shingles, component_id, n_same`` of every row.

    Sets are distinct runs of ``width`` words (``[^\\x20\\x09-\\x0D]+``, A-Z lowered); with fewer words the whole
    sequence. Documents link when 100 |x & y| >= ``percent`` |x | y|; the component is the smallest id reachable.
    ``n_same`` counts the other documents with the same set. Null, empty and blank texts have no shingles and their own id
    as component. Null ids take no part and are their own component (null). Rows that repeat an id are each given
    with their own ``n_shingles``; the id joins the components of all its texts. An empty table gives no rows, other columns are not read.
    Words and sets are told apart by 64 and 128 bits of hash; an overlap is counted on 64-bit shingle hashes.
    """
    spark = documents.sparkSession
    texts = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    scanned = kept(texts.mapInArrow(_scan(width), "id long, n long, a long, b long, token long, hits long"), "scan")
    docs = scanned.where("n is not null").select("id", "n", "a", "b")
    # Of each distinct set, the smallest id and the number of documents.
    nodes = docs.where("n > 0 and id is not null").groupBy("a", "b").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    nodes = kept(nodes.select(F.col("a").alias("node"), "b", "id", "copies"), "nodes")
    frequent = spark.sparkContext.broadcast(_frequent(scanned))
    entries = texts.where("id is not null").mapInArrow(_prefixes(width, percent, frequent), "token long, part int, node long, size int, place int")
    lists = entries.repartition("token", "part").sortWithinPartitions("token", "part")
    walked = kept(lists.mapInArrow(_lists(percent, block), "kind int, a long, b long, token long, part int, size int, place int"), "lists")
    sweep(spark)
    questions = walked.where("kind = 0").select("a", "b").distinct()
    answers = [_answers(questions, nodes, texts, width, percent)]
    entries = walked.where("kind = 1").select("token", "part", F.col("a").alias("lead"), F.col("b").alias("node"), "size", "place")
    linked = answers[0].where("linked").select("a", "b")
    labels = components(linked)
    for turn in [*range(lead_rounds), None]:
        if entries.isEmpty():
            break
        open_, parts = _open(entries, labels)
        rest = kept(_rest(open_, parts, answers, percent, turn), "rest")
        if rest.isEmpty():
            # New leads may bring nothing untold though lists are open: only the round of all pairs settles these.
            discard(rest)
            if parts.isEmpty():
                break
            continue
        answers.append(_answers(rest, nodes, texts, width, percent))
        discard(rest)
        linked = linked.union(answers[-1].where("linked").select("a", "b"))
        discard(labels)
        labels = components(linked)
    discard(walked, *answers)
    by_node = nodes.join(labels.select(F.col("v").alias("node"), "label"), "node", "left")
    by_node = by_node.select("node", "b", "id", "copies", F.coalesce("label", "node").alias("label"))
    smallest = by_node.groupBy("label").agg(F.min("id").alias("component"))
    by_set = by_node.join(smallest, "label").select(F.col("node").alias("a"), "b", "component", "copies")
    own = docs.join(by_set, ["a", "b"], "left")
    return own.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"), F.when(F.col("id").isNotNull(), F.coalesce("copies", F.lit(1)) - 1).alias("n_same")
    )


def _frequent(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT tokens with their counts: those above the smallest power of two that leaves no more."""
    counts = kept(scanned.where("token is not null").groupBy("token").agg(F.sum("hits").alias("hits")).where("hits >= 4"), "frequent")
    steps = {r.step: r["count"] for r in counts.groupBy(F.floor(F.log2("hits")).alias("step")).count().collect()}
    least, total = 64, 0
    for step in sorted(steps, reverse=True):
        total += steps[step]
        if total > FREQUENT:
            break
        least = step
    rows = counts.where(F.col("hits") >= F.lit(2.0) ** least).toPandas()
    discard(counts)
    order = np.argsort(rows.token.to_numpy(np.int64).view(np.uint64))
    return rows.token.to_numpy(np.int64).view(np.uint64)[order], rows.hits.to_numpy(np.int64)[order]


def _open(entries: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of lists that still hold more than one component, with their component, and the parts (token, part) of these lists."""
    named = entries.join(labels.select(F.col("v").alias("node"), "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = named.groupBy("token", "part").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = own.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("token")
    parts = own.select("token", "part").join(mixed, "token")
    return named.join(parts, ["token", "part"]), parts


def _rest(open_: DataFrame, parts: DataFrame, answers: list[DataFrame], percent: int, turn: int | None) -> DataFrame:
    """The next questions: of a new lead in each open list, or (turn None) of all pairs of different components left.

    A lead goes to each part of its list, and of pairs each part meets each other part: no join holds a split list whole.
    """
    told = answers[0]
    for more in answers[1:]:
        told = told.union(more)
    distance = told.select(F.col("a").alias("lead"), F.col("b").alias("node"), "far")
    known = open_.join(distance, ["lead", "node"], "left").withColumn("far", F.when(F.col("lead") == F.col("node"), 0.0).otherwise(F.col("far")))
    x = known.select("token", "part", "label", "lead", "node", "size", "place", "far")
    names = ("label", "lead", "node", "size", "place", "far")
    if turn is not None:
        # First the most central set: what is its own comes first in the token order, so it meets the list earliest.
        key = F.struct(F.lit(0.0) if turn else F.col("place") / F.col("size"), F.xxhash64("node", F.lit(turn)))
        first = x.groupBy("token").agg(F.min(F.struct(key.alias("k"), *names)).alias("f"))
        left = first.select("token", *[F.col(f"f.{c}").alias(f"{c}_l") for c in names]).join(parts, "token")
        met = left.join(x, ["token", "part"])
    else:
        both = parts.withColumnRenamed("part", "part_l").join(parts, "token").where("part_l <= part")
        left = x.select("token", F.col("part").alias("part_l"), *[F.col(c).alias(f"{c}_l") for c in names]).join(both, ["token", "part_l"])
        met = left.join(x.join(both, ["token", "part"]), ["token", "part_l", "part"]).where("part_l < part or node_l < node")
    most = F.least(F.col("size_l") - F.col("place_l"), F.col("size") - F.col("place"))
    room = (100 + percent) * most >= percent * (F.col("size_l") + F.col("size"))
    apart = (F.col("lead_l") == F.col("lead")) & F.coalesce(F.abs(F.col("far_l") - F.col("far")) > (100 - percent) / 100 + 1e-9, F.lit(False))
    pairs = met.where(F.col("label_l") != F.col("label")).where(room & ~apart)
    pairs = pairs.select(F.least("node_l", "node").alias("a"), F.greatest("node_l", "node").alias("b")).distinct()
    return pairs.join(told.select("a", "b"), ["a", "b"], "left_anti")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row, unchanged: that with the smallest id, null ids last.

    Rows are told apart by a key of their own, so rows without an id are documents like all others, and of rows that repeat
    an id those of the same component are one. Rows without words are no one's duplicate and stay, each.
    """
    # Written once: a key made anew by each reader need not be the same.
    keyed = kept(docs.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    joined = jaccard_join(keyed.select("row_key", "text"), id_col="row_key").select("row_key", "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = joined.join(keyed.select("row_key", "doc_id"), "row_key").groupBy("component_id").agg(F.min(order)["row_key"].alias("row_key"))
    return keyed.join(first, "row_key", "left_semi").select(docs.columns)


QUERIES = {"op6_jaccard_join": op6_jaccard_join}
SQL = {
    "op6_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), item AS (SELECT doc_id, unnest(s) AS t, len(s) AS n FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c
  FROM item x JOIN item y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
reach(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a),
same AS (SELECT list_sort(s) AS s, count(*) AS copies FROM sets WHERE len(s) > 0 GROUP BY list_sort(s))
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, m.component_id, CAST(coalesce(same.copies, 1) - 1 AS BIGINT) AS n_same
FROM sets JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) m ON m.v = sets.doc_id
LEFT JOIN same ON len(sets.s) > 0 AND same.s = list_sort(sets.s)
"""
}
