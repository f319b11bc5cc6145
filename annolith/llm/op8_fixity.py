"""Merkle fixity audit of WARC replicas, with DataFrame operations alone.

A leaf hashes a record's digest and length; a node hashes its children in order, each with its key and its byte range within
the node. So a lost or added record changes the nodes above it and no others, whatever it does to later offsets. Replicas
compare roots, then only the children of nodes that differ, down to the records; places in the archive are summed on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolith.session import discard, kept

#: Children of a node by id; ids of an archive.
FANOUT, ARCHIVE = 16, 4096
#: Levels between an archive and an id.
LEVELS = 3


def warc_record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC resource record as text."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``page_id, length, digest, copies`` of a replica's distinct records; equal ones are counted before the shuffle.

    Null urls and bodies count as empty; null ids are kept; other columns are not read; an empty table gives no rows.
    """
    record = warc_record(pages[id_col], pages[url_col], pages[body_col])
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))
    return rows.groupBy("page_id", "length", "digest").agg(F.count("*").alias("copies"))


def _spread(sides: DataFrame) -> int:
    """Levels of digest prefixes below an id, so that about FANOUT records of an id share one; 0 where no id has more."""
    most = sides.where("page_id is not null").groupBy("side", "page_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    levels = 0
    while FANOUT ** (levels + 1) < most:
        levels += 1
    return levels


def _key(level: int, spread: int) -> list[Column]:
    """Keys of the node at ``level`` (0: archive) over a record: archive, part of the archive, prefix of the digest."""
    # Null ids go to archives below nought by their digest, so that they do not gather in one.
    by_digest = -1 - F.conv(F.substring("digest", 1, 7), 16, 10).cast("long")
    archive = F.coalesce(F.floor(F.col("page_id") / ARCHIVE).cast("long"), by_digest)
    inside = F.coalesce(F.col("page_id") - archive * ARCHIVE, F.lit(0))
    part = F.floor(inside / FANOUT ** max(0, LEVELS - level)).cast("long") if level else F.lit(0).cast("long")
    return [archive.alias("archive"), part.alias("part"), F.substring("digest", 1, max(0, level - LEVELS)).alias("prefix")]


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level`` from those of the level below."""
    part = F.floor(F.col("part") / FANOUT).cast("long") if level < LEVELS else F.col("part")
    up = nodes.groupBy("side", "archive", part.alias("up_part"), F.substring("prefix", 1, max(0, level - LEVELS)).alias("up_prefix"))
    return _hashed(up, "part", "prefix").withColumnsRenamed({"up_part": "part", "up_prefix": "prefix"})


def _hashed(grouped, *keys: str) -> DataFrame:
    """Nodes of at most FANOUT children (give or take the evenness of digests): hash of all in order with their byte ranges, bytes and records."""
    children = F.array_sort(F.collect_list(F.struct(*keys, "bytes", "records", "hash")))
    ranged = F.aggregate(
        children,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
        lambda acc, c: F.struct((acc["at"] + c["bytes"]).alias("at"), F.concat_ws("|", acc["text"], *[c[k].cast("string") for k in keys], acc["at"].cast("string"), c["bytes"].cast("string"), c["hash"]).alias("text")),
    )
    return grouped.agg(F.sha2(ranged["text"], 256).alias("hash"), F.sum("bytes").alias("bytes"), F.sum("records").alias("records"))


def _differing(nodes: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks."""
    both = nodes.groupBy("archive", "part", "prefix").agg(*[F.max(F.when(F.col("side") == s, F.col("hash"))).alias(f"hash_{s}") for s in (0, 1)])
    return both.where(~F.col("hash_0").eqNullSafe(F.col("hash_1"))).drop("hash_0", "hash_1")


def _placed(nodes: DataFrame, open_: DataFrame, order: list[str]) -> DataFrame:
    """Children of the nodes that differ, with ``start`` and ``seq`` on their own side; windows hold the children of one node."""
    up = open_.withColumnsRenamed({"part": "up_part", "prefix": "up_prefix"})
    line = Window.partitionBy("side", "archive", "up_part", "up_prefix").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = lambda c: F.when(F.col("side") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1"))
    joined = nodes.join(up, ["archive", "up_part", "up_prefix"])
    joined = joined.withColumns({"start": own("start") + F.sum("bytes").over(line) - F.col("bytes"), "seq": own("seq") + F.sum("records").over(line) - F.col("records")})
    return joined.drop("start_0", "start_1", "seq_0", "seq_1")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """``archive, seq, page_id, start, length, status`` of each record in which two replicas' :func:`records` differ.

    ``status``: ``corrupt`` (an id's record stands on both sides with another digest), ``missing`` (only left) or ``extra``
    (only right); of repeated ids the differing records are paired in order of their digests, the rest is missing or extra.
    ``seq`` and ``start`` are the record's number and byte offset in its archive on its own side (of corrupt ones, left),
    where records stand in order of id and digest. Equal replicas and empty tables give no rows; a record that is repeated
    counts as often as it occurs. Both replicas' trees are one table for each level, each written once, and so are the
    nodes that differ, so that no plan is read twice.
    """
    sides = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    sides = kept(sides, "records")
    spread = _spread(sides)
    depth = LEVELS + spread
    rows = sides.select("side", *_key(depth, spread), "page_id", "length", "digest", "copies", (F.col("length") * F.col("copies")).alias("bytes"), F.col("copies").alias("records"))
    rows = rows.withColumn("hash", F.sha2(F.concat_ws(":", "digest", "length", "copies"), 256))
    levels = {depth: kept(_hashed(rows.groupBy("side", "archive", "part", "prefix"), "digest", "length"), "level")}
    for level in range(depth - 1, -1, -1):
        levels[level] = kept(_above(levels[level + 1], level), "level")
    # Of each node that differs its start and number on either side; at the top, where archives begin, both are 0.
    place = [F.lit(0).cast("long").alias(c) for c in ("start_0", "start_1", "seq_0", "seq_1")]
    open_ = kept(_differing(levels[0]).select("archive", "part", "prefix", *place), "differ")
    written = [open_]
    for level in range(1, depth + 1):
        up_part = F.floor(F.col("part") / FANOUT).cast("long") if level <= LEVELS else F.col("part")
        nodes = levels[level].withColumns({"up_part": up_part, "up_prefix": F.substring("prefix", 1, max(0, level - 1 - LEVELS))})
        placed = _placed(nodes, open_, ["part", "prefix"])
        differ = placed.groupBy("archive", "part", "prefix").agg(
            *[F.max(F.when(F.col("side") == s, F.col("hash"))).alias(f"hash_{s}") for s in (0, 1)],
            *[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for c in ("start", "seq") for s in (0, 1)],
        )
        open_ = kept(differ.where(~F.col("hash_0").eqNullSafe(F.col("hash_1"))).drop("hash_0", "hash_1"), "differ")
        written.append(open_)
    own = rows.withColumns({"up_part": F.col("part"), "up_prefix": F.col("prefix")})
    found = _placed(own, open_, ["digest", "length"])
    key = ["archive", "page_id", "digest", "length"]
    found = found.groupBy(key).agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for c in ("copies", "start", "seq") for s in (0, 1)])
    n = F.coalesce("copies_0", F.lit(0)) - F.coalesce("copies_1", F.lit(0))
    found = found.withColumn("n", n).where("n <> 0").withColumn("side", (F.col("n") < 0).cast("int"))
    # The last of the copies are those that the other side lacks.
    shared = F.least(F.coalesce("copies_0", F.lit(0)), F.coalesce("copies_1", F.lit(0)))
    start, seq = (F.when(F.col("side") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1")) for c in ("start", "seq"))
    found = found.withColumn("copy", F.explode(F.sequence(shared, shared + F.abs("n") - 1)))
    found = found.select("side", "archive", "page_id", "digest", "length", "copy", (seq + F.col("copy")).alias("seq"), (start + F.col("copy") * F.col("length")).alias("start"))
    nth = F.row_number().over(Window.partitionBy("side", "archive", "page_id").orderBy("digest", "length", "copy"))
    found = kept(found.withColumn("nth", F.when(F.col("page_id").isNotNull(), nth)), "found")
    one, two = (found.where(F.col("side") == s).drop("side") for s in (0, 1))
    two = two.select(*[F.col(c).alias(f"{c}_r") for c in ("archive", "nth", "page_id", "seq", "start", "length")])
    # Null ids meet nothing: such a record has no other name than its digest.
    both = one.join(two, (F.col("archive") == F.col("archive_r")) & (F.col("page_id") == F.col("page_id_r")) & (F.col("nth") == F.col("nth_r")), "full")
    status = F.when(F.col("archive_r").isNull(), "missing").when(F.col("archive").isNull(), "extra").otherwise("corrupt")
    pick = lambda c: F.when(F.col("archive").isNotNull(), F.col(c)).otherwise(F.col(f"{c}_r")).alias(c)
    out = both.select(*[pick(c) for c in ("archive", "seq", "page_id", "start", "length")], status.alias("status"))
    discard(sides, *levels.values(), *written)
    return out


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with planted damage, for want of a second one: every 97th id, from 3, has its body's tenth character changed."""
    hit = (F.col("page_id") % 97 == 3) & (F.length("html") >= 10)
    return pages.withColumn("html", F.when(hit, F.concat(F.substring("html", 1, 9), F.lit("~"), F.expr("substring(html, 11)"))).otherwise(F.col("html")))


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return audit(records(pages), records(damaged(pages)))


_LEAVES = r"""
SELECT page_id, CAST(strlen(rec) AS BIGINT) AS length, rec FROM (SELECT page_id,
  'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(body, '')) || chr(13) || chr(10) || chr(13) || chr(10)
  || coalesce(body, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM {0})
"""
SQL = {
    "op8_warc_fixity": f"""
WITH one AS (SELECT page_id, url, html AS body FROM pages),
two AS (SELECT page_id, url, CASE WHEN page_id % 97 = 3 AND length(html) >= 10 THEN html[1:9] || '~' || html[11:] ELSE html END AS body FROM pages),
a AS ({_LEAVES.format("one")}), b AS ({_LEAVES.format("two")}),
placed AS (
  SELECT page_id // {ARCHIVE} AS archive, row_number() OVER w - 1 AS seq, page_id, CAST(sum(length) OVER w - length AS BIGINT) AS start, length, rec
  FROM a WINDOW w AS (PARTITION BY page_id // {ARCHIVE} ORDER BY page_id ROWS UNBOUNDED PRECEDING)
), other AS (
  SELECT page_id, CAST(sum(length) OVER w - length AS BIGINT) AS start, length, rec
  FROM b WINDOW w AS (PARTITION BY page_id // {ARCHIVE} ORDER BY page_id ROWS UNBOUNDED PRECEDING)
)
SELECT archive, seq, page_id, p.start, p.length, 'corrupt' AS status FROM placed p JOIN other o USING (page_id)
WHERE p.rec <> o.rec
"""
}
QUERIES = {"op8_warc_fixity": op8_warc_fixity}
