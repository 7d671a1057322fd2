"""Sources and sinks (S1-S9), stats helpers."""
import os

import pytest

from pyspark.sql import functions as F

from wordmill.operators import stats as G
from wordmill.sources import cache as CA
from wordmill.sources import readers as R


def test_read_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lines.txt")
    with open(p, "wb") as f:
        f.write(b"  first \r\nsecond\rthird\n\n last\n")
    got = [r.text for r in R.read_lines(spark, p).orderBy("ordinal").collect()]
    assert got == ["first", "second", "third", "", "last"]


def test_split_lines_in_table(spark):
    df = spark.createDataFrame([(1, "a\r\nb\n"), (2, "")], "doc_id long, text string")
    got = [(r.doc_id, r.line_no, r.line) for r in R.lines_of(df).orderBy("doc_id", "line_no").collect()]
    assert got == [(1, 0, "a"), (1, 1, "b")]


def test_missing_source_is_empty(spark, tmp_dir):
    assert R.read_lines(spark, os.path.join(tmp_dir, "nope.txt")).count() == 0
    assert R.read_parquet_shards(spark, tmp_dir).count() == 0


def test_read_files_routes_bad_utf8(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "b.txt"), "wb") as f:
        f.write("ok\r\ntext é".encode())
    with open(os.path.join(tmp_dir, "a.txt"), "wb") as f:
        f.write(b"\xff\xfe bad")
    with open(os.path.join(tmp_dir, "c.md"), "wb") as f:
        f.write(b"ignored")
    docs, bad = R.read_files(spark, tmp_dir)
    assert [r.text for r in docs.collect()] == ["ok\ntext é"]
    assert [os.path.basename(r.path) for r in bad.collect()] == ["a.txt"]


def test_parquet_defaults(spark):
    df = spark.createDataFrame([(None, "x"), ("t", None)], "Article string, Source string")
    got = [(r.text, r.source) for r in R.parquet_corpus(df).collect()]
    assert got == [("None", "x"), ("t", "None")]
    only = spark.createDataFrame([("t",)], "Article string")
    assert R.parquet_corpus(only).first().source == "iriisnepal"


def test_jsonl_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("नेपाल", "s", "h")], "text string, source string, hash string")
    out = os.path.join(tmp_dir, "out")
    R.write_jsonl(df, out)
    raw = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                  for f in os.listdir(out) if f.endswith(".json"))
    assert "नेपाल" in raw and raw.index('"text"') < raw.index('"source"') < raw.index('"hash"')
    back = R.read_jsonl(spark, out).select("text", "source", "hash").collect()
    assert [tuple(r) for r in back] == [("नेपाल", "s", "h")]


def test_cache_build_or_load(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return {"train": spark.range(3), "val": spark.range(1)}
    key = CA.cache_key("m", "base", 512, 3, 1)
    a = CA.build_or_load(spark, tmp_dir, key, build)
    b = CA.build_or_load(spark, tmp_dir, key, build)
    assert len(calls) == 1 and a["train"].count() == 3 and b["val"].count() == 1
    assert CA.latest_complete(spark, tmp_dir).endswith(key)


def test_median_upper(spark):
    for lens, want in (([1, 2, 3, 4], 3), ([1, 2, 3], 2), ([], None)):
        df = spark.createDataFrame([(" ".join(["w"] * n),) for n in lens], "text string")
        assert G.median_words(df).first()["median_words"] == want


def test_docs_by_source_ties(spark):
    rows = [("b", 0), ("a", 1), ("a", 2), ("b", 3), ("c", 4)]
    df = spark.createDataFrame(rows, "source string, ordinal long")
    got = [r.source for r in G.docs_by_source(df).orderBy("position").collect()]
    assert got == ["b", "a", "c"]


def test_parquet_shards_skip_corrupt(spark, tmp_dir):
    good = spark.createDataFrame([("a", "s1"), ("b", None)], "Article string, Source string")
    good.coalesce(1).write.parquet(os.path.join(tmp_dir, "tmp_good"))
    src = [f for f in os.listdir(os.path.join(tmp_dir, "tmp_good")) if f.endswith(".parquet")][0]
    shards = os.path.join(tmp_dir, "shards")
    os.makedirs(shards)
    os.rename(os.path.join(tmp_dir, "tmp_good", src), os.path.join(shards, "a.parquet"))
    with open(os.path.join(shards, "b.parquet"), "wb") as f:
        f.write(b"not a parquet file at all")
    got = sorted((r.text, r.source) for r in R.read_parquet_shards(spark, shards).collect())
    assert got == [("a", "s1"), ("b", "None")]


def test_parquet_defaults_hold_per_shard(spark, tmp_dir):
    shards = os.path.join(tmp_dir, "shards")
    os.makedirs(shards)
    frames = {"a": spark.createDataFrame([("x", "s1"), (None, None)], "Article string, Source string"),
              "b": spark.createDataFrame([("y",)], "Article string"),
              "c": spark.createDataFrame([("s3", 1)], "Source string, other int")}
    for name, df in frames.items():
        df.coalesce(1).write.parquet(os.path.join(tmp_dir, name))
        part = [f for f in os.listdir(os.path.join(tmp_dir, name)) if f.endswith(".parquet")][0]
        os.link(os.path.join(tmp_dir, name, part), os.path.join(shards, f"{name}.parquet"))
    with open(os.path.join(shards, "d.parquet"), "wb") as f:
        f.write(b"PAR1 cut off")
    with pytest.warns(UserWarning, match="d.parquet"):
        got = sorted((r.text, r.source) for r in R.read_parquet_shards(spark, shards).collect())
    assert got == [("", "s3"), ("None", "None"), ("x", "s1"), ("y", "iriisnepal")]
    report = {os.path.basename(r.path): r.status for r in R.shard_report(spark, shards).collect()}
    assert report == {"a.parquet": "read", "b.parquet": "read", "c.parquet": "read", "d.parquet": "corrupt"}
    missing = R.shard_report(spark, os.path.join(tmp_dir, "nowhere")).collect()
    assert [r.status for r in missing] == ["missing"]


def test_stage_is_written_once_per_input_state(spark, tmp_dir):
    src, calls = os.path.join(tmp_dir, "src"), []

    def build():
        calls.append(1)
        return spark.read.parquet(src)
    spark.range(3).write.parquet(src)
    assert [CA.stage(spark, "t", [src], build).count() for _ in range(2)] == [3, 3] and len(calls) == 1
    spark.range(5).write.mode("append").parquet(src)
    assert CA.stage(spark, "t", [src], build).count() == 8 and len(calls) == 2


def test_big_scans_are_not_spread(spark, monkeypatch):
    monkeypatch.setattr(R, "SPREAD_BYTES", 10)
    one = spark.range(100).coalesce(1)
    assert R.ensure_parallelism(one, "id").rdd.getNumPartitions() == 1


def test_cache_ignores_half_built_sets(spark, tmp_dir):
    spark.range(3).write.parquet(os.path.join(tmp_dir, "key", "train"))    # a builder that died in between
    assert CA.latest_complete(spark, tmp_dir) is None
    got = CA.build_or_load(spark, tmp_dir, "key", lambda: {"train": spark.range(7), "val": spark.range(2)})
    assert (got["train"].count(), got["val"].count()) == (7, 2)
    assert CA.latest_complete(spark, tmp_dir).endswith("/key")
    spark.range(5).write.mode("append").parquet(os.path.join(tmp_dir, "key", "val"))    # more files than were built
    assert CA.latest_complete(spark, tmp_dir) is None
    got = CA.build_or_load(spark, tmp_dir, "key", lambda: {"train": spark.range(8), "val": spark.range(1)})
    assert (got["train"].count(), got["val"].count()) == (8, 1)


def test_two_builders_give_one_complete_set(spark, tmp_dir):
    """A second session builds the key while the first one does, and finishes first."""
    other = spark.newSession()
    seen = []

    def slow():
        if not seen:
            seen.append(1)
            CA.build_or_load(other, tmp_dir, "key", lambda: {"train": other.range(20), "val": other.range(4)})
        return {"train": spark.range(10), "val": spark.range(2)}
    got = CA.build_or_load(spark, tmp_dir, "key", slow)
    assert (got["train"].count(), got["val"].count()) == (20, 4)
    assert sorted(f for f in os.listdir(tmp_dir) if not f.startswith(".")) == ["key"]
    assert sorted(f for f in os.listdir(os.path.join(tmp_dir, "key")) if not f.startswith(".")) == ["_MANIFEST", "train", "val"]


def test_salvage_keeps_rows_before_a_broken_page(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    shards = os.path.join(tmp_dir, "my shards")
    os.makedirs(shards)
    rows = pa.table({"Article": [f"text {k} " + "lorem ipsum " * 20 for k in range(300)], "Source": [f"s{k % 3}" for k in range(300)]})
    for name in ("a", "b"):
        pq.write_table(rows, os.path.join(shards, f"{name}.parquet"), row_group_size=100, use_dictionary=False,
                       compression="snappy", write_page_checksum=True)
    column = pq.ParquetFile(os.path.join(shards, "b.parquet")).metadata.row_group(1).column(0)
    with open(os.path.join(shards, "b.parquet"), "r+b") as f:
        f.seek(column.data_page_offset + column.total_compressed_size // 2)
        f.write(b"\xff" * 64)
    with open(os.path.join(shards, "c.parquet"), "wb") as f:
        f.write(b"no parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "4k"):    # as one split, and as one a row group
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            docs, report = R.salvage_parquet_shards(spark, shards)
            got = {os.path.basename(r.path): (r.status, r.rows, r.kept) for r in report.collect()}
            assert got == {"a.parquet": ("read", 300, 300), "b.parquet": ("partial", 300, 100), "c.parquet": ("corrupt", None, 0)}
            per = {os.path.basename(r.file): (r.n, r.last) for r in docs.groupBy("ordinal.file").agg(
                F.count("*").alias("n"), F.max("ordinal.row").alias("last")).collect()}
            assert per == {"a.parquet": (300, 299), "b.parquet": (100, 99)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    docs, report = R.salvage_parquet_shards(spark, os.path.join(tmp_dir, "nowhere"))
    assert docs.count() == 0 and [r.status for r in report.collect()] == ["missing"]


def test_row_numbers_over_files_and_splits(spark, tmp_dir):
    want = []
    for name in ("b.txt", "a.txt", "c.txt"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.writelines(f"{name} line {k} {'x' * (k % 50)}\n" for k in range(400))
    for name in ("a.txt", "b.txt", "c.txt"):
        want += [f"{name} line {k} {'x' * (k % 50)}".strip() for k in range(400)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
        rows = R.with_row_numbers(R.read_lines(spark, tmp_dir)).select("row_no", "text").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.text for r in sorted(rows, key=lambda r: r.row_no)] == want
    assert sorted(r.row_no for r in rows) == list(range(1200))


def test_file_table(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "x.txt"), "wb") as f:
        f.write(b"12345")
    assert [(os.path.basename(r.path), r.bytes) for r in R.file_table(spark, tmp_dir).collect()] == [("x.txt", 5)]
    assert R.file_table(spark, os.path.join(tmp_dir, "none")).count() == 0


def _page_files(spark, monkeypatch, tmp_path, rows, schema="page_id long, html string"):
    """The rows of src_files over these pages, and the files it made."""
    from wordmill.plans import registry as REG
    table = f"{tmp_path}/{len(os.listdir(tmp_path))}"
    spark.createDataFrame(rows, schema).write.parquet(f"{table}/pages.parquet")
    monkeypatch.setattr(REG, "scratch", lambda *_: f"{table}/files")
    got = sorted((tuple(r) for r in REG.q_src_files(spark, table).collect()), key=lambda r: (r[0] is None, r[0]))
    return got, [os.path.join(d, f) for d, _, names in os.walk(f"{table}/files") for f in names]


def test_page_files_share_folders(spark, monkeypatch, tmp_path):
    import duckdb
    from wordmill.plans import registry as REG
    got, files = _page_files(spark, monkeypatch, tmp_path, [(k, f"<p>{k}\r\né</p>") for k in range(400)])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/0/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(REG.REGISTRY["src_files"].sql).fetchall())
    # a file a page and nothing beside it; the number of folders does not follow the number of pages
    assert sorted(os.path.basename(f) for f in files) == sorted(f"page_id={k}.txt" for k in range(400))
    assert 32 < len({os.path.dirname(f) for f in files}) <= R.FILE_FOLDERS


def test_page_files_of_odd_rows(spark, monkeypatch, tmp_path):
    import hashlib
    rows = [(7, "a"), (7, "a"), (3, None), (53, "b"), (-2, ""), (None, "c"), (8, None), (9, "x\ny")]
    text = {7: "a\na\n", 3: "\n", -2: "\n", None: "c\n", 8: "\n", 9: "x\ny\n"}
    want = {k: (k, "read", len(t), hashlib.md5(t.encode()).hexdigest()) for k, t in text.items()} | {53: (53, "invalid", 3, None)}
    got, files = _page_files(spark, monkeypatch, tmp_path, rows)
    assert {r[0]: r for r in got} == want and len(got) == len(want) == len(files)
    # Spark's writer, which other stores than mounted ones get, makes the same
    monkeypatch.setattr(R, "_mounted", lambda *_: None)
    assert _page_files(spark, monkeypatch, tmp_path, rows)[0] == got


def test_page_files_of_no_rows(spark, monkeypatch, tmp_path):
    assert _page_files(spark, monkeypatch, tmp_path, []) == ([], [])


def test_files_are_listed_once(spark, monkeypatch, tmp_path):
    made = []
    listed = R.binary_files
    monkeypatch.setattr(R, "binary_files", lambda *a, **k: made.append(a) or listed(*a, **k))
    _page_files(spark, monkeypatch, tmp_path, [(1, "a"), (2, "b")])
    assert len(made) == 1
