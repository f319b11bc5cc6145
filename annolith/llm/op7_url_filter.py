"""URL filter: a trie over reversed host labels and path segments, longest match between allow and block rules."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LOWERED = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_END_OF_HOST, _END_OF_PATH = re.compile(r"[/?#]"), re.compile(r"[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path; both empty for null and where ``://`` is missing."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = _END_OF_HOST.split(rest, maxsplit=1)[0]
    path = rest[len(host) :]
    return host.translate(LOWERED), _END_OF_PATH.split(path, maxsplit=1)[0] if path.startswith("/") else ""


@dataclass
class Node:
    """``next``: by host label or whole path segment. ``tails``: rules by the beginning of the segment that comes next."""

    next: dict[str, Node] = field(default_factory=dict)
    paths: Node | None = None
    tails: dict[str, tuple[str, str]] = field(default_factory=dict)


class UrlTrie:
    """Rules (verdict, host, path). A rule fits its host and subdomains where the path starts with the rule's.

    The rule with the longest host wins, among these the one with the longest path; of equal rules the last given.
    """

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.root = Node()
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.translate(LOWERED).split(".")):
                node = node.next.setdefault(label, Node())
            node.paths = node.paths or Node()
            *whole, tail = path.split("/")
            node = node.paths
            for segment in whole:
                node = node.next.setdefault(segment, Node())
            node.tails[tail] = (verdict, f"{host}{path}")

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.next.get(label)
            if node is None:
                break
            if node.paths:
                best = self._path(node.paths, segments) or best
        return best

    @staticmethod
    def _path(node: Node, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if node.tails:
                fits = [t for t in node.tails if segment.startswith(t)]
                best = node.tails[max(fits, key=len)] if fits else best
            node = node.next.get(segment)
            if node is None:
                break
        return best


def url_filter(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    *,
    otherwise: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    block_rules: int = 200_000,
) -> DataFrame:
    """Judge each row's URL: ``id_col, host, path, rule, verdict``; one row out per row in, in one scan without a shuffle.

    Null, malformed and empty URLs have empty host and path, no rule and the verdict ``otherwise``, as has every URL that no
    rule fits. Repeated rows are judged one by one; other columns are not read; an empty table gives no rows. Tries of
    ``block_rules`` rules are broadcast, a bound on each one that is sent; a longer list makes several tries, of which a row takes the
    longest match, and a worker that has read them holds them all, so the list as a whole must fit into a worker.
    """
    sc = pages.sparkSession.sparkContext
    rules = list(dict(((h.translate(LOWERED), p), (v, h, p)) for v, h, p in rules).values())
    tries = [sc.broadcast(UrlTrie(rules[k : k + block_rules])) for k in range(0, len(rules), block_rules)]
    kind = dict(pages.dtypes)[id_col]
    source = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            best: list[tuple[str, str] | None] = [None] * len(split)
            for trie in tries:
                held = trie.value
                for k, (host, path) in enumerate(split):
                    hit = held.match(host, path) if host else None
                    if hit and (best[k] is None or _rank(hit[1]) > _rank(best[k][1])):
                        best[k] = hit
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([b and b[1] for b in best], pa.string()),
                    pa.array([b[0] if b else otherwise for b in best], pa.string()),
                ],
                names=["id", "host", "path", "rule", "verdict"],
            )

    out = source.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


def _rank(rule: str) -> tuple[int, int]:
    host, _, path = rule.partition("/")
    return len(host), len(path)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = {
    "op7_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM cut
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS n
  FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE n = 1
"""
}
QUERIES = {"op7_url_filter": op7_url_filter}
