"""Best-two-fit packing of token pieces into sequences of at most 2048 tokens.

A packing depends on lengths alone, so it is planned on the histogram of lengths: bins of equal content are one pattern with
a count. A pattern is filled greedily from the longest length down; then its smallest piece gives way to two unpacked ones
that fit the widened gap more tightly. Pieces get their places by their rank among pieces of equal length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm.textkit import Words, pieces
from annolith.session import kept

CAPACITY = 2048
END_ID = 0
#: Distinct words whose ids a worker remembers.
REMEMBERED = 400_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- token ids


def _letters() -> np.ndarray:
    """1 ASCII letter, 2 other ASCII that may be cut off a letter, 0 neither. An apostrophe may open a contraction, a bar a special token."""
    kind = np.zeros(256, np.int8)
    kind[33:127] = 2
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[[ord("'"), ord("|")]] = 0
    return kind


def _byte_letters() -> dict[int, str]:
    """For the letters from U+00C0 to U+00FF the characters that stand for their two bytes: a printable byte for itself, the others in order from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {c: "".join(chr(b if b in printable else 256 + others.index(b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


LETTERS = _letters()
#: Letters that lower-case and compose by themselves alone, and how the byte-level step writes their bytes.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Ids of whole texts, each distinct word part encoded once.

    The tokenizer drops blanks and never joins across them, nor across a step between an ASCII letter and other ASCII
    (apostrophes and bars aside, see :data:`LETTERS`). Words with a byte from 0xCC up are left whole: there, composition
    and the final sigma look at neighbours. So the ids of a text are those of its parts, end to end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, part: str) -> list[int]:
        """A part of plain letters is one word to the model, which is asked directly; all else goes the whole way."""
        if PLAIN.fullmatch(part):
            return [t.id for t in self.model.tokenize(part.lower().translate(BYTE_LETTERS))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _parts(self, column) -> Words:
        words = Words(column)
        data = words.data
        high = np.concatenate([[0], np.cumsum(data >= 0xCC)])
        plain = high[words.end] == high[words.start]
        kind = LETTERS[data].copy()
        # The two bytes of U+00C0 to U+00FF (0xC3 ..), multiplication and division signs aside, are letters too.
        lead = np.flatnonzero(data == 0xC3)
        lead = lead[lead + 1 < len(data)]
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead], kind[lead + 1] = 1, 1
        step = np.flatnonzero((kind[1:] + kind[:-1] == 3) & (kind[1:] * kind[:-1] == 2)) + 1
        at = np.searchsorted(words.start, step, side="right") - 1
        ok = at >= 0
        ok[ok] = (step[ok] > words.start[at[ok]]) & (step[ok] < words.end[at[ok]]) & plain[at[ok]]
        step = step[ok]
        words.start = np.sort(np.concatenate([words.start, step]))
        words.end = np.sort(np.concatenate([words.end, step]))
        words.first = np.searchsorted(words.start, words.offsets)
        return words

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``END_ID``, and the n + 1 bounds of the texts."""
        words = self._parts(column)
        hashes = words.hashes()
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            data = words.data.tobytes()
            strings = [data[words.start[k] : words.end[k]].decode() for k in first[new]]
            found = [self._ids(s) for s in strings]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
            where = at[new]
            self.starts = np.insert(self.starts, where, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, where, sizes)
            self.known = np.insert(self.known, where, distinct[new])
            self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.known, distinct)[inverse]
        sizes, starts = self.sizes[at], self.starts[at]
        reach = np.concatenate([[0], np.cumsum(sizes)])
        bounds = reach[words.first] + np.arange(len(words.first))
        out = np.full(bounds[-1], END_ID, np.uint32)
        source = np.repeat(starts - reach[:-1], sizes) + np.arange(reach[-1])
        target = np.arange(reach[-1]) + np.repeat(words.owner(), sizes)
        out[target] = self.ids[source]
        if len(self.known) > REMEMBERED:
            self._forget()
        return out, bounds


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- plan


@dataclass
class Plan:
    """For each length a run of slots: ``first[l]:first[l + 1]`` index ``upto`` (slots up to and with a run), ``base`` (first
    sequence), ``each`` (slots of a sequence) and ``place`` (offset of the run's first slot in its sequence)."""

    first: np.ndarray
    upto: np.ndarray
    base: np.ndarray
    each: np.ndarray
    place: np.ndarray
    sequences: int

    def slots(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces that are the ``rank``-th of their ``length``."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length):
            own = np.flatnonzero(length == size)
            a, b = self.first[size], self.first[size + 1]
            run = a + np.searchsorted(self.upto[a:b], rank[own], side="right")
            inside = rank[own] - np.where(run > a, self.upto[run - 1], 0)
            sequence[own] = self.base[run] + inside // self.each[run]
            offset[own] = self.place[run] + inside % self.each[run] * size
        return sequence, offset


def best_two_fit(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Plan for ``counts[l]`` pieces of each length l (1 to capacity); every pattern uses up one length at least.

    Of equal choices the longer first piece is taken; no pieces give a plan without sequences.
    """
    left = np.array(counts, np.int64)
    runs: list[tuple[int, int, int, int, int]] = []  # length, sequences, first sequence, slots of each, offset
    sequences = 0

    def largest(most: int) -> int:
        """The largest length up to ``most`` of which a piece is left, else 0."""
        hit = np.flatnonzero(left[1 : most + 1])
        return int(hit[-1]) + 1 if len(hit) else 0

    while (size := largest(capacity)) > 0:
        content: dict[int, int] = {}
        gap = capacity
        while size:
            n = min(int(left[size]), gap // size)
            content[size] = content.get(size, 0) + n
            left[size] -= n
            gap -= n * size
            size = largest(gap)
        while gap and len(content) + max(content.values()) > 2:
            smallest = min(content)
            widened = gap + smallest
            # The two lengths a <= b, both left, with the largest sum that is above the smallest and fits.
            have = np.flatnonzero(left[1 : widened + 1]) + 1
            if not len(have):
                break
            below = np.searchsorted(have, widened - have, side="right") - 1
            ok = below >= 0
            b = have[np.maximum(below, 0)]
            twice = ok & (b == have) & (left[b] < 2)
            b = np.where(twice, np.where(below > 0, have[np.maximum(below - 1, 0)], 0), b)
            total = np.where(ok & (b > 0), have + b, 0)
            k = int(np.argmax(total))
            if total[k] <= smallest:
                break
            content[smallest] -= 1
            left[smallest] += 1
            if not content[smallest]:
                del content[smallest]
            for x in (int(have[k]), int(b[k])):
                content[x] = content.get(x, 0) + 1
                left[x] -= 1
            gap = widened - int(total[k])
        times = 1 + min(int(left[x]) // n for x, n in content.items())
        place = 0
        for x, n in sorted(content.items(), reverse=True):
            left[x] -= (times - 1) * n
            runs.append((x, times, sequences, n, place))
            place += n * x
        sequences += times
    runs.sort(key=lambda r: (r[0], r[2]))
    table = np.array(runs, np.int64).reshape(-1, 5)
    slots = table[:, 1] * table[:, 3]
    upto = np.empty(len(table), np.int64)
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    for a, b in zip(first[:-1], first[1:]):
        upto[a:b] = np.cumsum(slots[a:b])
    return Plan(first, upto, table[:, 2], table[:, 3], table[:, 4], sequences)


# ---------------------------------------------------------------- distributed


def pack(documents: DataFrame, *, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A text is its ids and one end id; only longer ones are cut, at every ``capacity`` ids. Null and empty texts are one piece
    of length 1. Null ids and repeated rows are packed like all others, each row for itself. An empty table gives no rows;
    other columns are not read. The driver holds the histogram (``capacity`` numbers) and the plan, which has a pattern for
    each length at most, give or take the remainders; the pieces' ids stay in the executors.
    """
    spark = documents.sparkSession
    path = tokenizer or default_tokenizer()
    kind = dict(documents.dtypes)[id_col]
    source = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=4 << 20):
            ids, bounds = encoder(path).encode(batch.column("text"))
            raw = ids.astype("<u4").tobytes()
            sizes = np.diff(bounds)
            n = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            at = bounds[owner] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + size)]) for a, size in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    # The part of a piece is fixed here and kept with it, so that later reads, however dealt, see the same parts.
    cut_ = source.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")
    kept_ = kept(cut_.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "pieces")
    counts = kept(kept_.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    total = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        total[row["length"]] = row.n
    plan = spark.sparkContext.broadcast(best_two_fit(total, capacity))
    before = _before(counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.value.slots(np.asarray(batch.column("length")), np.asarray(batch.column("rank")))
            columns = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = _ranked(kept_, before)
    out = ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def _before(counts: DataFrame) -> DataFrame:
    """(length, part, before): pieces of the length in smaller parts; one row for each length and part, not for each piece."""
    from pyspark.sql import Window

    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))


def _ranked(kept_: DataFrame, before: DataFrame) -> DataFrame:
    """Each piece's rank among those of its length: those in earlier parts and those before it in its own part."""
    from pyspark.sql import Window

    inside = F.row_number().over(Window.partitionBy("part", "length").orderBy("nth")) - 1
    # A merge join: the counts follow the number of parts, and pieces stand by (part, length) already.
    return kept_.withColumn("inside", inside).join(before.hint("merge"), ["part", "length"]).withColumn("rank", F.col("inside") + F.col("before"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places; rows with a null or repeated id are packed like all others, null and empty texts as one end id."""
    return pack(docs)


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
SQL: dict[str, str] = {}
