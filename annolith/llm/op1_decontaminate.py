"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is cut into k + 1 pieces; a passage within k edits of it holds one piece unchanged.
One automaton finds all pieces in a text; each hit's window is verified by Myers' bit-parallel edit distance. Items too short for
an edit must stand between word ends; items of fewer than LEAST_WORDS words prove nothing within a longer text and must be all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from annolith.llm.textkit import pieces
from annolith.session import discard, kept

#: Words from which on an item may match a part of a text.
LEAST_WORDS = 5
_BREAKS = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower case; every run of other than letters and digits is one blank."""
    return _BREAKS.sub(" ", (text or "").lower()).strip()


def split_even(item: str, n: int) -> list[tuple[int, str]]:
    """``n`` pieces with their places, as even as can be."""
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class Pattern:
    """An item for Myers' algorithm: a bit for each character, so one step for each character of text."""

    def __init__(self, item: str):
        self.size = len(item)
        self.mask = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.at: dict[str, int] = {}
        for k, c in enumerate(item):
            self.at[c] = self.at.get(c, 0) | 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """The least edit distance between the item and any passage of ``text``, and the end of the first that has it."""
        up, down, score = self.mask, 0, self.size
        least, end = score, 0
        mask, top, at = self.mask, self.top, self.at
        for k, c in enumerate(text):
            eq = at.get(c, 0)
            vertical = eq | down
            level = (((eq & up) + up) ^ up) | eq
            rise = down | (~(level | up) & mask)
            fall = up & level
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            rise, fall = rise << 1, fall << 1
            up = (fall | ~(vertical | rise)) & mask
            down = rise & vertical & mask
            if score < least:
                least, end = score, k + 1
        return least, end


class Matcher:
    """Automaton of the pieces of a block of items ``(id, text)``.

    Texts are searched with a blank on either side, which the items without an edit to spare have too.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float, least_words: int = LEAST_WORDS):
        self.items: list[tuple[int, str, int]] = []
        self.whole: dict[str, list[int]] = {}
        for i, t in items:
            n = normal(t)
            budget = int(len(n) * error_rate)
            if n and n.count(" ") + 1 < least_words:
                self.whole.setdefault(n, []).append(i)
            elif n:
                self.items.append((i, n if budget else f" {n} ", budget))
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, budget) in enumerate(self.items):
            for place, piece in split_even(item, budget + 1):
                places.setdefault(piece, []).append((k, place))
        self.places = places
        self.patterns = [Pattern(item) for _, item, _ in self.items]
        self.automaton = None

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end of the passage in the normalised text) of each item within its budget."""
        import ahocorasick

        found = [(i, 0, len(text)) for i in self.whole.get(text, ())] if text else []
        if not self.places or not text:
            return found
        size_, text = len(text), f" {text} "
        if self.automaton is None:  # built once in each worker
            self.automaton = ahocorasick.Automaton()
            for piece, where in self.places.items():
                self.automaton.add_word(piece, (len(piece), where))
            self.automaton.make_automaton()
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for k, place in where:
                starts.setdefault(k, set()).add(end + 1 - size - place)
        for k, own in starts.items():
            name, item, budget = self.items[k]
            exact = text.find(item) if any(text.startswith(item, s) for s in own if s >= 0) else -1
            if exact >= 0:
                found.append((name, 0, min(size_, exact + len(item) - (1 if budget else 2))))
                continue
            best = None
            for a, b in _merge(sorted(own), 2 * budget + 1):
                low = max(0, a - budget)
                least, end = self.patterns[k].best(text[low : b + len(item) + budget])
                if least <= budget and (best is None or least < best[0]):
                    best = (least, low + end)
            if best:
                found.append((name, best[0], min(size_, max(best[1] - 1, 0))))
        return found


def _merge(starts: list[int], near: int) -> Iterator[tuple[int, int]]:
    """Runs of starts of which neighbours are at most ``near`` apart: their windows overlap and are verified as one."""
    a = b = starts[0]
    for s in starts[1:]:
        if s - b > near:
            yield a, b
            a = s
        b = s
    yield a, b


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of ``block_chars`` characters, one block at least."""
    held, n, blocks = [], 0, 0
    for row in benchmark.select(benchmark[item_col].alias("i"), benchmark[item_text_col].alias("t")).toLocalIterator():
        held.append((row.i, row.t))
        n += len(row.t or "")
        if n >= block_chars:
            yield held
            held, n, blocks = [], 0, blocks + 1
    if held or not blocks:
        yield held


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    error_rate: float = 0.08,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = 4_000_000,
) -> DataFrame:
    """``id_col, item_col, distance, end_at`` of each document and item it holds, within ``error_rate`` edits a character.

    Both sides are normalised (:func:`normal`). ``distance`` is the least, ``end_at`` the end of its first passage in the
    normalised text. Items that may have no edit (shorter than 1 / ``error_rate`` characters) match whole words only, items of
    fewer than ``least_words`` words only texts that are nothing else. Null, empty and blank texts and items match nothing; null ids are kept as they are; repeated documents
    are answered each, repeated items each; an empty table gives no rows; other columns are not read. Items go out in
    blocks of ``block_chars`` characters, one pass over the documents for each block, without a shuffle; with several blocks
    each one's answers are written before the next is read, so the driver and a task hold one block.
    """
    spark = documents.sparkSession
    kinds = dict(documents.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    source = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))
    schema = f"id {kinds[0]}, item {kinds[1]}, distance int, end_at long"

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    def one_pass(shared) -> DataFrame:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = shared.value
            for batch in pieces(batches):
                rows = [(i, *hit) for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()) for hit in matcher.matches(normal(t))]
                columns = list(zip(*rows)) or [[], [], [], []]
                types = (batch.schema.field("id").type, item_type, pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "item", "distance", "end_at"])

        return source.mapInArrow(match, schema)

    result = written = last = None
    for items in _blocks(benchmark, item_col, item_text_col, block_chars):
        if last is not None:
            part = kept(one_pass(last), "matches")
            last.destroy()
            written = part if written is None else written.union(part)
        last = spark.sparkContext.broadcast(Matcher(items, error_rate, least_words))
    result = one_pass(last) if written is None else written.union(one_pass(last))
    return result.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_items(documents: DataFrame, benchmark: DataFrame, *, error_rate: float = 0.08, least_words: int = LEAST_WORDS, block_chars: int = 4_000_000) -> DataFrame:
    """The rows that hold no benchmark item, unchanged, each judged by its own text: ids may be null or repeat.

    One pass over the rows left for each block of items; between blocks they are written to the shared folder, so that the
    driver and a task hold one automaton.
    """

    def one_pass(rows: DataFrame, shared) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = shared.value
            for batch in pieces(batches):
                yield batch.filter(pa.array([not matcher.matches(normal(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        return rows.mapInArrow(clean, rows.schema)

    last, written = None, []
    for items in _blocks(benchmark, "item_id", "text", block_chars):
        if last is not None:
            documents = kept(one_pass(documents, last), "clean")
            last.destroy()
            discard(*written)
            written = [documents]
        last = documents.sparkSession.sparkContext.broadcast(Matcher(items, error_rate, least_words))
    return one_pass(documents, last)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, unchanged; rows without an id or with a repeated one are judged each."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op1_decontamination": op1_decontamination}
SQL: dict[str, str] = {}
