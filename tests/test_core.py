"""Operators against inline expectations, plain Python and, at the smallest size, the SQL of each query."""

import json
import os
import random
import tarfile
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from annolith import queries as core
from annolith.functions import text as T
from annolith.operators import chunks as C
from annolith.operators import ingest as G
from annolith.operators import intervals as I
from annolith.plans import config
from annolith.plans import stages as S
from annolith.sources import export, readers
from annolith.sources.tar import TarShards

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def rows_of(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(None if x != x else (float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x) for x in r)) for r in frame.where(frame.notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_its_sql(spark, duck, name):
    got, want = core.QUERIES[name](spark, SF).toPandas(), duck.sql(core.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_every_query_has_sql():
    assert set(core.QUERIES) == set(core.SQL)


def ranges(df):
    return sorted((r.lo, r.hi) for r in df.collect())


def plain_runs(indices):
    return [(own[0], own[-1]) for _, g in groupby(enumerate(sorted(set(indices))), lambda p: p[1] - p[0]) if (own := [i for _, i in g])]


def test_runs_of_indices(spark):
    rng = random.Random(3)
    sets = [[rng.randrange(400) for _ in range(n)] for n in (0, 1, 50, 300, 900)]
    df = spark.createDataFrame([(k, i) for k, own in enumerate(sets) for i in own] + [(1, None)], "k long, i long")
    got = I.runs(df, ["k"], "i").collect()
    for k, own in enumerate(sets):
        assert sorted((r.lo, r.hi) for r in got if r.k == k) == plain_runs(own)


def test_subtract(spark):
    rng = random.Random(4)
    windows = [(k, lo, lo + rng.randrange(300)) for k in range(12) for lo in [rng.randrange(100)]] + [(99, 5, 4)]
    done = {k: {rng.randrange(500) for _ in range(rng.choice((0, 3, 80, 400)))} for k in range(12)}
    done[3] = set(range(500))
    frame = lambda rows: spark.createDataFrame(rows, "k long, lo long, hi long")
    got = I.subtract(frame(windows), frame([(k, *r) for k, own in done.items() for r in plain_runs(own)]), ["k"]).collect()
    for k, lo, hi in windows:
        assert sorted((r.lo, r.hi) for r in got if r.k == k) == plain_runs(set(range(lo, hi + 1)) - done.get(k, set()))


def test_merge_takes_adjacent_ranges(spark):
    df = spark.createDataFrame([(1, 10, 20), (1, 15, 25), (1, 26, 30), (1, 40, 39)], "k long, lo long, hi long")
    assert ranges(I.merge(df, ["k"])) == [(10, 30)]


def test_clamp_drops_inverted(spark):
    df = spark.createDataFrame([(1, 7, 3), (1, -4, 2), (1, 0, 9), (1, 30, 31), (1, 18, 44)], "k long, lo long, hi long")
    assert ranges(I.clamp(df, F.lit(1), F.lit(20))) == [(1, 2), (1, 9), (18, 20)]


def test_chunks_of_any_total(spark):
    total = lambda n: spark.createDataFrame([(n,)], "total long")
    assert [(r.chunk_id, r.lo, r.hi) for r in I.chunks(total(25), 10).orderBy("chunk_id").collect()] == [(0, 0, 9), (1, 10, 19), (2, 20, 24)]
    assert I.chunks(total(0), 10).count() == 0 == I.chunks(total(None), 10).count()
    assert I.chunks(total(300_000_000_000), 100).where("chunk_id = 2999999999").first().hi == 299_999_999_999


def test_split_units_at_wide_gaps(spark):
    gaps = spark.createDataFrame([(1, 0, 49), (1, 500, 549), (2, 0, 49), (2, 60, 70)], "chunk_id long, lo long, hi long")
    units = I.split_units(gaps, ["chunk_id"]).collect()
    assert sorted((u.chunk_id, u.unit_ord, u.lo, u.hi, u.n_ranges) for u in units) == [(1, 0, 0, 49, 1), (1, 1, 500, 549, 1), (2, 0, 0, 70, 2)]


CLEANED = [
    ("We can see lanterns over water", "Lanterns over water."), ("THERE IS no moon tonight!", "No moon tonight!"), ("the picture shows\tone kite", "the picture shows one kite."), ("a  boat", "Boat."), ("An Irish harp", "An Irish harp."),
    ("this is an image of   ", "."), ("  two \n mills  ", "two mills."), ("why not?", "why not?"), ("ant hill", "ant hill."), ("", ""), (None, ""),
]


def test_clean_caption(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "i int, t string")
    got = [r.c for r in df.select("i", T.clean_caption(F.col("t")).alias("c")).orderBy("i").collect()]
    assert [g for (t, _), g in zip(CLEANED, got) if t != "this is an image of   "] == [w for t, w in CLEANED if t != "this is an image of   "]


def test_caption_clean_equals_its_sql_on_odd_letters(spark, tmp_path):
    letters = ("\u00df", "\u1f80", "\u1f88", "\u1fb3", "\u1ff2", "\ufb01", "\u0149", "\u01c6", "\u00e4", "e\u0301", "\U00010428", "7")
    texts = [before + letter + "x y" for letter in letters for before in ("", "a ", "An  ", "There is ", "We can see a ")] + ["thi\u017f image shows a mill", "", None]
    rows = [(4 * i + kind, t) for i, t in enumerate(texts) for kind in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/conversations.parquet").limit(3).write.parquet(f"{tmp_path}/conversations.parquet")
    own = duckdb.connect()
    for name in ("documents", "conversations"):
        own.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = core.QUERIES["caption_clean"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(own.sql(core.SQL["caption_clean"]).fetchall())
    assert len(got) == len(rows) + 3


def test_validate_and_output_end(spark):
    df = spark.createDataFrame([("nine herons wade through the flooded rice field",), ("Sorry, but I am Unable To say what this is",), ("a photo",), (None,)], "t string")
    assert [r.v for r in df.select(T.validate_caption(F.col("t")).alias("v")).collect()] == [True, False, False, False]
    ends = spark.createDataFrame([("one kept line <|im_end|> and more<|end|>",), ("I cannot tell",), ("\t spaced \n",), (None,)], "t string")
    assert [r.v for r in ends.select(T.clean_output(F.col("t")).alias("v")).collect()] == ["one kept line", "", "spaced", ""]


def test_combine(spark):
    long = "seven wooden ferries crossing a misty harbour before dawn while gulls circle above"
    rows = [
        (0, None, ""), (1, [], ""), (2, ["tiny"], "tiny."), (3, [None, "", "ab"], "ab."), (4, [long, "a drawing of ferries"], long.capitalize() + "."),
        (5, [long, "sketch with charcoal texture, heavy shadows, torn paper", "happy crowd waving banners from crowded balconies"], "\n".join([long.capitalize() + ".", "happy crowd waving banners from crowded balconies.", "sketch with charcoal texture, heavy shadows, torn paper."])),
        (6, [long, "misty harbour ferries crossing dawn"], long.capitalize() + "."),
    ]
    rows = [(i, t, w.replace("Seven", "seven", 1) if w.startswith("Seven") else w) for i, t, w in rows]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "i int, t array<string>")
    assert [r.c for r in df.select("i", T.combine(F.col("t")).alias("c")).orderBy("i").collect()] == [w for _, _, w in rows]


def test_values(spark):
    df = spark.createDataFrame([("2024-05-06T07:08:09Z",), ("2024-05-06 07:08:09.25+02:00",), ("2024-05-06",), ("soon",), ("2024-13-45",), (None,)], "t string")
    assert [r.v for r in df.select(F.unix_millis(T.iso_time(F.col("t"))).alias("v")).collect()] == [1714979289000, 1714972089250, 1714953600000, None, None, None]
    df = spark.createDataFrame([("['x', ' ', 'y']",), ("plain",), ("[not a list",), ("",), (None,)], "t string")
    assert [r.v for r in df.select(T.caption_values(F.col("t"), "string").alias("v")).collect()] == [["x", "y"], ["plain"], ["[not a list"], [], []]
    df = spark.createDataFrame([([["p", None], None, ["q"]],)], "t array<array<string>>")
    assert df.select(T.caption_values(F.col("t"), "array<array<string>>").alias("v")).first().v == ["p", "q"]
    size = lambda tokens: spark.range(1).select(T.retry_size(F.lit(101), F.lit(60), F.lit(tokens), F.lit(1000), 1050).alias("s")).first().s
    assert tuple(size(0)) == (1.0, 101, 60) and tuple(size(500)) == (0.7, 70, 42) and tuple(size(700)) == (0.5, 50, 30) and size(990) is None


def test_configurations():
    base = {"model": "m", "sampling": {"top_p": 0.5, "n": 1}, "x": None}
    assert config.merged(base, {"sampling": {"n": 2}, "model": None, "x": 0}) == {"model": "m", "sampling": {"top_p": 0.5, "n": 2}, "x": 0}
    assert config.differing({"a": 1, "b": 2}, {"b": 3, "c": None}) == ["a", "b", "c"]
    assert [config.reaction(*p) for p in ((None, {}), ({"a": 1}, {"a": 1}), ({"a": 1}, {"a": 2}), ({"dtype": "x"}, {}))] == ["reload", "none", "runtime", "reload"]
    assert config.sampling({"top_p": 0.1}, {"max_tokens": 9})["max_tokens"] == 9 and config.sampling()["temperature"] == 0.7
    assert config.accepted(lambda a, *, b=1: 0, {"a": 1, "b": 2, "c": 3}) == {"a": 1, "b": 2} and config.accepted(lambda **k: 0, {"z": 1}) == {"z": 1}


def test_fetch_with_retries(spark):
    def make():
        seen = {}

        def fetch(url):
            seen[url] = seen.get(url, 0) + 1
            if url == "gone":
                return 404, {}, None
            if url == "broken":
                raise OSError("no route")
            return (503 if seen[url] < 2 else 200), {"Retry-After": "0"}, url.encode()

        return fetch

    rows = spark.createDataFrame([("late",), ("gone",), ("broken",), (None,)], "url string").coalesce(1)
    got = {r.url: (r.data and bytes(r.data), r.status, r.error) for r in readers.fetched(rows, make, wait=0.0).collect()}
    assert got == {"late": (b"late", 200, None), "gone": (None, 404, "status 404"), "broken": (None, None, "no route"), None: (None, None, "no url")}


def test_chunk_log(spark):
    log = [(1, 0, "add", None), (1, 1, "assign", "a"), (2, 0, "add", None), (2, 3, "complete", "a"), (2, 2, "assign", "a"), (3, 5, "assign", "a"), (4, 0, "add", None), (4, 1, "dance", "b")]
    states = C.chunk_states(spark.createDataFrame(log, "chunk_id long, seq long, event string, worker string"))
    assert sorted((r.chunk_id, r.status, r.worker) for r in states.collect()) == [(1, "assigned", "a"), (2, "completed", "a"), (4, "pending", None)]
    assert sorted((r.chunk_id, r.status) for r in C.released(states, "a").collect()) == [(1, "pending"), (2, "completed"), (4, "pending")]
    assert C.chunk_states(spark.createDataFrame([], "chunk_id long, seq long, event string, worker string")).count() == 0


def test_a_failed_batch_is_written_again(spark, tmp_path):
    from annolith.streaming.ingest import Store

    schema = "job_id string, seq long, flush_id long, outputs array<string>, caption_count long"
    first = spark.createDataFrame([("a", 1, 0, ["x"], 1), ("a", 2, 0, ["y"], 1), ("a", 3, 1, ["z"], 1), ("b", 4, 1, ["u"], 1)], schema)
    store = Store(spark, str(tmp_path / "store"), first.schema)
    store.append(first, 0)
    store.append(first, 0)  # the same batch after a failure
    store.append(spark.createDataFrame([("b", 5, 2, ["v"], 1), ("c", 6, 2, None, 0)], schema), 1)
    assert sorted((r.job_id, r.outputs, r.caption_count) for r in store.read().where("outputs is not null").collect()) == [("a", ["x", "y"], 2), ("b", ["u"], 1)]
    assert store.read().count() == 3


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("j2", ["a"], None), ("j1", [], "k"), ("j3", None, "k")], "job_id string, captions array<string>, key string")
    done = export.export_all(df, str(tmp_path / "all"), content="captions", name=F.col("job_id"), outputs=["captions"])
    assert done == {"jsonl": 3, "csv": 3, "parquet": 3, "json": 3, "txt": 2}
    assert export.export_all(df.select("captions"), str(tmp_path / "bad"), forms=("csv", "parquet")) == {"csv": 0, "parquet": 3}
    assert [r.job_id for r in export.selected(df, ["job_id"], limit=2).collect()] == ["j1", "j2"] and export.selected(df, filled="captions").count() == 1
    with pytest.raises(ValueError):
        export.selected(df, ["nothing"])
    assert [tuple(r) for r in export.stem_collisions(df, F.col("key")).collect()] == [("k", 2)]
    for rows, name in ((df, "store"), (df.limit(1), "new")):
        rows.write.parquet(str(tmp_path / name))
    export.swap_in(spark, str(tmp_path / "new"), str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1 and not (tmp_path / "store.old").exists()


def test_manifest_and_row_numbers(spark, tmp_path):
    for k, n in enumerate((7, 0, 5)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / f"d{k}"))
    (tmp_path / "one.png").write_bytes(b"x")
    paths = [str(f) for k in (0, 2) for f in (tmp_path / f"d{k}").glob("*.parquet")] + [str(tmp_path / "one.png")]
    cached = str(tmp_path / "cache")
    sizes = [(r.size, r.end_offset - r.start_offset) for r in readers.shard_manifest(spark, paths, cache=cached).collect()]
    assert sorted(sizes) == [(1, 0), (5, 4), (7, 6)] and readers.shard_manifest(spark, [], cache=cached).count() == 3
    rows = readers.numbered(spark.read.parquet(str(tmp_path / "d0"), str(tmp_path / "d2")).where("id >= 0"), "nth")
    assert sorted(r.nth for r in rows.collect()) == list(range(12))


def test_job_ids(spark):
    bad = ["", "a:chunk:1", "a:b:1:idx:2", ":chunk:1:idx:2", "a:chunk:x:idx:2", "a:chunk:1:idx:", "a:chunk:1_0:idx:2", None]
    df = spark.createDataFrame([(b,) for b in [*bad, "s:chunk:3:idx:4"]], "j string").select(T.parse_job_id(F.col("j")).alias("p")).select("p.*")
    got = df.collect()
    assert not any(r.valid for r in got[:-1]) and tuple(got[-1]) == ("s", 3, 4, True)


def test_template(spark):
    df = spark.createDataFrame([("{col:b}", ["x", None, "", "y"], None)], "a string, b array<string>, c string")
    out = df.select(T.render("{column:a} {col:b}{col:c}{col:none}!", dict(df.dtypes)).alias("r")).first().r
    assert out == "{col:b} x, y!" and T.missing_columns(["{col:q}"], df.columns) == {"{col:q}": ["q"]}


def test_ingest_merges_then_skips(spark):
    rows = spark.createDataFrame([("j", 1, 0, ["a"], 1), ("j", 2, 0, ["b"], 1), ("j", 3, 1, ["c"], 1)], "job_id string, seq long, flush_id long, outputs array<string>, caption_count long")
    (got,) = G.first_flush(rows).collect()
    assert (got.outputs, got.caption_count, got.skipped) == (["a", "b"], 2, 1)


def test_stage_order():
    chain = [S.Stage("third", (), "x", ("second",)), S.Stage("second", (), "x", ("first",)), S.Stage("first", (), "x"), S.Stage("fourth", (), "x", ("first", "third"))]
    assert [s.name for s in S.in_order(chain)] == ["first", "second", "third", "fourth"]
    for broken in ([S.Stage("a", (), "x", ("b",)), S.Stage("b", (), "x", ("a",))], [S.Stage("a", (), "x", ("z",))]):
        with pytest.raises(ValueError):
            S.in_order(broken)


def test_run_stages_with_an_adapter(spark):
    items = spark.createDataFrame([("k1",), ("k2",)], "item_key string")
    chain = [S.Stage("one", ("see {col:item_key}",), "captions"), S.Stage("two", ("and {col:one_output_1}", "gone<|end|>"), "captions", ("one",))]
    out = S.run_stages(items, chain, lambda model: lambda prompts, batch: ["" if p.startswith("gone") else p.upper() for p in prompts])
    assert out.orderBy("item_key").first().captions == ["SEE K1", "AND SEE K1"]


def test_sources_and_sinks(spark, tmp_path):
    for name in ("b.jpg", "a.PNG", "notes.txt", "sub/c.gif", ".hid/d.jpg"):
        (tmp_path / "img" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "img" / name).write_bytes(b"x")
    assert [os.path.basename(r.path) for r in readers.images(spark, str(tmp_path / "img")).orderBy("index").collect()] == ["a.PNG", "b.jpg", "c.gif"]
    (tmp_path / "s.jsonl").write_text('{"id":"q","url":"u"}\nnot json\n{"image_url":"v"}\n')
    assert [(r.id, r.url) for r in readers.open_source(spark, str(tmp_path / "s.jsonl")).orderBy("id").collect()] == [("q", "u"), ("sample_2", "v")]
    (tmp_path / "s.csv").write_text("id,photo_link\n7,w\n")
    assert [(r.id, r.url) for r in readers.open_source(spark, str(tmp_path / "s.csv")).collect()] == [("7", "w")]
    with tarfile.open(tmp_path / "t0.tar", "w") as tar:
        for name, raw in (("a.jpg", b"1"), ("a.json", b'{"width": 3, "tag": "z", "_p": 1}'), ("b.jpg", b"2")):
            (tmp_path / name).write_bytes(raw)
            tar.add(tmp_path / name, name)
    spark.dataSource.register(TarShards)
    got = spark.read.format("tar_shards").option("paths", str(tmp_path / "t0.tar")).load().orderBy("item_index").collect()
    assert [(r.shard, r.key, bytes(r.data), r.metadata) for r in got] == [("t0", "a", b"1", {"tag": "z"}), ("t0", "b", b"2", {})]
    rows = spark.createDataFrame([("image1.jpg", ["A\nx", "B"]), ("image2.png", None), (None, ["C"])], "filename string, captions array<string>")
    stem = T.stem(F.col("filename"))
    assert export.write(rows, str(tmp_path / "o.jsonl"), "jsonl") == 3 and export.write(rows, str(tmp_path / "o.csv"), "csv", outputs=["captions"]) == 3
    assert export.write(rows, str(tmp_path / "txt"), "txt", content="captions", name=stem) == 1 and (tmp_path / "txt/image1.txt").read_text() == "A x\nB"
    assert export.write(rows, str(tmp_path / "json"), "json", name=stem) == 2 and json.loads((tmp_path / "json/image2.json").read_text())["captions"] is None
    assert export.shard_path("d/x.csv", "default", "csv") == "d/x_default.csv" and "1K" in export.dataset_card("n", 5, "n<1K", {"captions": 2})


def test_replay_is_the_same_for_any_split(spark):
    rows = core._results(spark, SF).withColumn("flush_id", F.lit(0))
    from annolith.streaming.ingest import replay

    one = replay(rows.limit(200), "flush_id").count()
    assert one == rows.limit(200).select("job_id").distinct().count()


def test_the_rest_does_not_need_the_subpackage():
    for folder, _, files in os.walk(os.path.dirname(core.__file__)):
        if "llm" not in folder:
            assert not any("annolith.llm" in open(os.path.join(folder, f)).read() for f in files if f.endswith(".py"))
