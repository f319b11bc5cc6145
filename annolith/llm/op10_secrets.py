"""Secret scan: pattern candidates, then a random forest that removes false positives.

The forest looks at the candidate's length, its character transitions, how much of it dictionary words cover, the path, and
neighbouring words; it is trained from labelled findings.
"""

from __future__ import annotations

import json
import random
import re
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm.textkit import pieces

#: A run that could be a key, with a digit; and whatever an assignment to a telling name holds.
RUN = re.compile(r"[A-Za-z0-9_/+\-]{12,}={0,2}")
ASSIGNED = re.compile(r"""(?i)\b[\w-]{0,40}(?:passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key)["']?\s{0,3}[:=]\s{0,3}["']?([^\s"',;|]{6,})""")
TELLING = re.compile(r"(?i)passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private")
HARMLESS = re.compile(r"(?i)\b(?:sha\d*|md5|commit|digest|checksum|hash|uuid|guid|card|iban|phone|tel|isbn|order|invoice|id|version|example|sample|placeholder|revision|etag|mailto)\b")
EXAMPLE_PATH = re.compile(r"(?i)test|example|sample|fixture|mock|doc|lock|vendor|dist")
#: Words of settings and of made examples (:func:`labelled_findings`).
COMMON = (
    "password", "secret", "token", "example", "sample", "test", "user", "admin", "config", "default", "change", "your", "here", "value", "data", "file",
    "name", "path", "image", "index", "module", "component", "service", "request", "response", "handler", "manager", "version", "release", "build", "local",
    "host", "server", "client", "public", "private", "access", "account", "number", "string", "object", "class", "function", "table", "query", "script",
    "style", "content", "button", "header", "footer", "page", "article", "chapter", "section", "january", "february", "march", "april", "june", "july",
    "august", "september", "october", "november", "december", "north", "south", "east", "west", "street", "house", "water", "world", "people", "insert", "dummy",
)


class Dictionary:
    """Words for the coverage feature; its automaton is built once in each worker."""

    def __init__(self, words: Iterable[str], least: int = 4):
        self.words = sorted({w.lower() for w in words if len(w) >= least})
        self._automaton = None

    def __getstate__(self):
        return self.words

    def __setstate__(self, words):
        self.words, self._automaton = words, None

    def covered(self, text: str) -> int:
        """Characters of ``text`` in words, taken from the left, the longest word first, none over another."""
        import ahocorasick

        if not self.words:
            return 0
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for w in self.words:
                self._automaton.add_word(w, len(w))
            self._automaton.make_automaton()
        return sum(size for _, size in self._automaton.iter_long(text.lower()))


def tokenizer_words(path: str | None = None) -> list[str]:
    """The whole words of plain letters in a public tokenizer's vocabulary (a file with word ends)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return [w[:-4] for w in vocabulary if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha()]


@lru_cache(1)
def default_dictionary() -> Dictionary:
    return Dictionary([*COMMON, *tokenizer_words()])


@dataclass
class Finding:
    """A labelled candidate: its text, its place there, and 1 for a secret, 0 for a false positive."""

    text: str
    start: int
    end: int
    path: str
    label: int


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of candidates, in order, none within another."""
    spans = [m.span(1) for m in ASSIGNED.finditer(text)]
    taken = sorted(spans)
    for m in RUN.finditer(text):
        a, b = m.span()
        if any(c.isdigit() for c in m[0]) and not any(x < b and a < y for x, y in _near(taken, a, b)):
            spans.append((a, b))
    return sorted(set(spans))


def _near(spans: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    from bisect import bisect_left

    k = bisect_left(spans, (a, a))
    return spans[max(0, k - 1) : bisect_left(spans, (b, b)) + 1]


_KIND = {**dict.fromkeys(string.ascii_lowercase, 0), **dict.fromkeys(string.ascii_uppercase, 1), **dict.fromkeys(string.digits, 2)}
_VOWELS = set("aeiouyAEIOUY")
FEATURES = 20


def describe(text: str, start: int, end: int, path: str | None, dictionary: Dictionary | None = None) -> list[float]:
    """Features of a candidate, from all of it."""
    own = text[start:end]
    size = len(own)
    kinds = [_KIND.get(c, 3) for c in own]
    n = len(kinds)
    share = [kinds.count(k) / n for k in range(4)]
    steps = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    into_digit = sum(a != 2 and b == 2 for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    vowel_steps = sum((a in _VOWELS) != (b in _VOWELS) for a, b in zip(own, own[1:]) if a.isalpha() and b.isalpha()) / max(1, n - 1)
    counts = np.unique(list(own), return_counts=True)[1] / n
    entropy = float(-(counts * np.log2(counts)).sum())
    covered = (dictionary or default_dictionary()).covered(own) / n
    before, after = text[max(0, start - 60) : start], text[end : end + 24]
    near = " ".join(before.split()[-3:])
    return [
        size, *share, steps, into_digit, vowel_steps, entropy, covered,
        float(all(c in "0123456789abcdefABCDEF" for c in own)), float(own.isdigit()), float(re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox|eyJ|AIza", own) is not None),
        float(size in (32, 40, 64)), float(before.rstrip(" \"'").endswith(("=", ":"))), float(bool(TELLING.search(near))), float(bool(HARMLESS.search(near))),
        float(before.endswith(("/", "\\", ".", "@")) or after.startswith(("/", ".", "@"))), float(own.count("-") + own.count("/")), float(bool(EXAMPLE_PATH.search(path or ""))),
    ]


# ---------------------------------------------------------------- forest


@dataclass
class Forest:
    """Trees as arrays: ``feature`` (-1: a leaf), ``cut``, ``left``, ``right``, ``share`` of secrets."""

    trees: list[tuple[np.ndarray, ...]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, share in self.trees:
            at = np.zeros(len(x), int)
            while (live := np.flatnonzero(feature[at] >= 0)).size:
                node = at[live]
                at[live] = np.where(x[live, feature[node]] <= cut[node], left[node], right[node])
            total += share[at]
        return total / len(self.trees)


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 10, least: int = 3, seed: int = 5) -> Forest:
    """Bootstrap samples, a random subset of features at each node, the cut with the least Gini impurity."""
    rng = np.random.default_rng(seed)
    tried = max(1, int(x.shape[1] ** 0.5))
    out = []
    for _ in range(trees):
        nodes: list[list[float]] = []

        def split(rows: np.ndarray, level: int) -> int:
            me = len(nodes)
            share = y[rows].mean()
            nodes.append([-1, 0.0, 0, 0, share])
            if level == depth or len(rows) < 2 * least or share in (0, 1):
                return me
            best = (share * (1 - share) * len(rows) - 1e-9, -1, 0.0)
            for f in rng.choice(x.shape[1], tried, replace=False):
                order = rows[np.argsort(x[rows, f], kind="stable")]
                v, hit = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(rows))
                ok = (v[1:] > v[:-1]) & (n >= least) & (len(rows) - n >= least)
                if not ok.any():
                    continue
                a, b = hit[:-1] / n, (hit[-1] - hit[:-1]) / (len(rows) - n)
                cost = np.where(ok, a * (1 - a) * n + b * (1 - b) * (len(rows) - n), np.inf)
                k = int(cost.argmin())
                if cost[k] < best[0]:
                    best = (cost[k], int(f), (v[k] + v[k + 1]) / 2)
            if best[1] >= 0:
                low = x[rows, best[1]] <= best[2]
                nodes[me][:4] = [best[1], best[2], split(rows[low], level + 1), split(rows[~low], level + 1)]
            return me

        split(rng.integers(0, len(x), len(x)), 0)
        table = np.array(nodes)
        out.append((table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]))
    return Forest(out)


def findings_of(table: DataFrame, *, most: int = 20_000, text_col: str = "text", start_col: str = "start", end_col: str = "end", path_col: str = "path", label_col: str = "label") -> list[Finding]:
    """Labelled findings from a table, at most ``most`` of them, picked by a hash.

    Rows with a null text, place or label, or a place outside the text, are passed over; of equal rows one is taken.
    """
    names = ((text_col, "text", "string"), (start_col, "start", "int"), (end_col, "end", "int"), (path_col, "path", "string"), (label_col, "label", "int"))
    rows = table.select(*[table[c].cast(kind).alias(name) for c, name, kind in names]).where("label is not null and start >= 0 and start < end and end <= length(text)")
    picked = rows.distinct().orderBy(F.xxhash64("text", "start", "end"), "text", "start", "end", "path", "label").limit(most)
    return [Finding(r.text, r.start, r.end, r.path, int(r.label != 0)) for r in picked.collect()]


def train(findings: Iterable[Finding], dictionary: Dictionary | None = None, **options) -> Forest:
    """A forest from labelled findings; at least one of them is needed."""
    found = list(findings)
    x = np.array([describe(f.text, f.start, f.end, f.path, dictionary) for f in found], float)
    return grow(x, np.array([f.label for f in found], float), **options)


def labelled_findings(n: int = 4000, seed: int = 17) -> list[Finding]:
    """Findings with labels, made by rule, for want of a labelled table: common shapes of secrets and of harmless strings in prose and settings."""
    rng = random.Random(seed)
    some = lambda chars, a, b=None: "".join(rng.choices(chars, k=rng.randint(a, b or a)))
    low, up, digits, hexes = string.ascii_lowercase, string.ascii_uppercase, string.digits, "0123456789abcdef"
    word = lambda: "".join(rng.choices(("the", "re", "an", "on", "er", "in", "ti", "de", "que", "ou", "sch", "la"), k=rng.randint(1, 4)))
    key = lambda: rng.choice(("token", "api_key", "secret", "password", "passwd", "access_key", "auth_token", "API_KEY", "SECRET_KEY", "apiKey"))
    mixed = low + up + digits
    secrets = (
        lambda: ("", "AKIA" + some(up + digits, 16), ""),
        lambda: (rng.choice((f'{key()} = "', f"{key()}: ", f"{key()}=")), some(hexes, rng.choice((16, 18, 20, 24, 32, 40, 64))), ""),
        lambda: (f'{key()} = "', some(mixed + "+/", 24, 64), '"'),
        lambda: ("", "ghp_" + some(mixed, 36), ""),
        lambda: ("", "sk-" + some(mixed, 40, 48), ""),
        lambda: ("xoxb ", "xoxb-" + some(digits, 11) + "-" + some(mixed, 24), ""),
        lambda: ("Authorization: Bearer ", "eyJ" + some(mixed, 60, 120), ""),
        lambda: (rng.choice((f"{key()}=", f"{key()}: ")), some(mixed + "!#$%&*", 8, 20), ""),
        lambda: ("", some(mixed + "+/", 36, 48), ""),
    )
    harmless = (
        lambda: ("", some(digits, 12, 19), ""),
        lambda: (rng.choice(("commit ", "sha256:", "md5 ", "checksum = ", "digest: ", "revision ")), some(hexes, rng.choice((32, 40, 64))), ""),
        lambda: (rng.choice(("", "id ", "uuid ")), "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), ""),
        lambda: (f"{key()} = ", rng.choice(("your_token_here1", "CHANGE_ME_123456", "example-password-1", "xxxxxxxxxxxx1234", "YOUR_API_KEY_HERE_2", "dummy_secret_value1", "<your-token>", "changeme", "test-token-123456")), ""),
        lambda: ("", "/".join(rng.choice(COMMON) for _ in range(3)) + f"/{rng.choice(COMMON)}{rng.randint(1, 99)}", ".py"),
        lambda: ("", rng.choice(COMMON) + rng.choice(COMMON).title() + rng.choice(COMMON).title() + str(rng.randint(1, 999)), "("),
        lambda: ("", f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(10, 23)}", ":30"),
        lambda: ("", f"{word()}_{word()}_{rng.randint(1, 9999)}_{word()}", ""),
        lambda: ("", word() + word() + word() + str(rng.randint(1, 99)), rng.choice(("@mail.example.com", " "))),
        lambda: (rng.choice(("password: ", "token: ", "secret=")), rng.choice(("required", "optional", "string", "None", "hidden", "${TOKEN}", "{{secret}}", "process.env.TOKEN", word() + "ing", word() + word())), ""),
        lambda: ("", "-" * rng.randint(10, 40) + str(rng.randint(1, 9)), ""),
        lambda: ("+1 ", f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}", ""),
        lambda: ("", rng.choice("ab01") * rng.randint(12, 60) + "0", ""),
    )
    out = []
    for k in range(n):
        label = k % 2
        head, own, tail = rng.choice(secrets if label else harmless)()
        before, after = (" ".join(word() for _ in range(rng.randint(0, 8))) for _ in range(2))
        text = f"{before} {head}{own}{tail} {after}"
        start = len(before) + 1 + len(head)
        path = rng.choice(("src/app.py", "config/settings.yml", "notes.md", "src3", "src7", "web", ""))
        out.append(Finding(text, start, start + len(own), path, label))
    return out


# ---------------------------------------------------------------- distributed


def _findings(forest: Forest, text: str | None, path: str | None, dictionary: Dictionary) -> list[tuple[int, int, float]]:
    spans = candidates(text or "")
    if not spans:
        return []
    x = np.array([describe(text, a, b, path, dictionary) for a, b in spans], float)
    return [(a, b, s) for (a, b), s in zip(spans, forest.score(x).tolist()) if s >= 0.5]


def scan_secrets(
    documents: DataFrame, forest: Forest, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", dictionary: Dictionary | None = None
) -> DataFrame:
    """``id_col, start, length, score`` of each finding that the forest keeps (score 0.5 or more), in characters of the text.

    Null and empty texts have no findings; a null path and none are the same; null ids are kept as they are; repeated rows are scanned each; an empty
    table gives no rows. One scan, no shuffle; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast((forest, dictionary or default_dictionary()))
    path = documents[path_col].cast("string") if path_col else F.lit(None).cast("string")
    source = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"), path.alias("path"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [
                (i, a, b - a, s)
                for i, text, path in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "path")))
                for a, b, s in _findings(shared.value[0], text, path, shared.value[1])
            ]
            columns = list(zip(*rows)) or [[]] * 4
            types = (batch.schema.field("id").type, pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "start", "length", "score"])

    return source.mapInArrow(scan, f"id {dict(documents.dtypes)[id_col]}, start long, length long, score double").withColumnRenamed("id", id_col)


def redact(documents: DataFrame, forest: Forest, *, text_col: str = "text", path_col: str | None = "source", size_col: str | None = "n_chars", mark: str = "[SECRET]", dictionary: Dictionary | None = None) -> DataFrame:
    """All rows and columns, each kept finding in ``text_col`` replaced by ``mark``; ``size_col`` is counted anew in changed rows.

    Null and empty texts stay as they are; rows with a null or repeated id are rewritten each; an empty table stays empty.
    """
    shared = documents.sparkSession.sparkContext.broadcast((forest, dictionary or default_dictionary()))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            paths = batch.column(path_col).to_pylist() if path_col else [None] * len(texts)
            sizes = batch.column(size_col).to_pylist() if size_col else None
            for k, (text, path) in enumerate(zip(texts, paths)):
                found = _findings(shared.value[0], text, path, shared.value[1])
                for a, b, _ in reversed(found):
                    texts[k] = texts[k][:a] + mark + texts[k][b:]
                if found and sizes:
                    sizes[k] = len(texts[k])
            new = {text_col: texts, **({size_col: sizes} if sizes else {})}
            yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in batch.schema], schema=batch.schema)

    return documents.mapInArrow(rewrite, documents.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"), train(labelled_findings()))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with all their columns, secrets in their texts replaced by a mark; ids are not read, null texts stay null."""
    return redact(docs, train(labelled_findings()))


QUERIES = {"op10_secret_scan": op10_secret_scan}
SQL: dict[str, str] = {}
