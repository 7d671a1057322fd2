"""Exact dedup (D1), near-dedup greedy (D2-D6) and incremental near-dedup."""
import random

import pytest
from pyspark.sql import functions as F

from wordmill.operators import clean as C
from wordmill.operators import neardup as N


def test_exact_dedup_scope_and_order(spark):
    rows = [("c1", 1, "same", "h"), ("c2", 2, "same", "h"), ("c1", 3, "same", "h"),
            ("c1", 0, "other", "g")]
    df = spark.createDataFrame(rows, "corpus string, ordinal long, text string, hash string")
    out = {(r.corpus, r.ordinal) for r in C.exact_dedup(df).collect()}
    assert out == {("c1", 1), ("c2", 2), ("c1", 0)}


def sequential_greedy(docs):
    """Reference model: docs = [(rank, [bucket keys])] visited in rank order."""
    index, kept = set(), []
    for rank, keys in sorted(docs):
        if index.isdisjoint(keys):
            kept.append(rank)
            index.update(keys)
    return set(kept)


def _bands_df(spark, docs):
    rows = [(r, b, k) for r, keys in docs for b, k in keys]
    return spark.createDataFrame(rows, "rank long, band int, key string")


def test_chain_keeps_a_and_c(spark):
    docs = [(1, [(0, "x")]), (2, [(0, "x"), (1, "y")]), (3, [(1, "y")])]
    got = {r["rank"] for r in N.greedy_keep(_bands_df(spark, docs)).collect()}
    assert got == {1, 3}


def test_greedy_equals_sequential_random(spark):
    rnd = random.Random(7)
    for trial in range(6):
        n = 60
        docs = []
        for r in rnd.sample(range(1000), n):
            keys = [(b, f"k{rnd.randrange(12)}") for b in range(3)]
            docs.append((r, keys))
        want = sequential_greedy([(r, set(ks)) for r, ks in docs])
        df = _bands_df(spark, docs).repartition(3)
        got = {x["rank"] for x in N.greedy_keep(df).collect()}
        assert got == want, trial


def _corpus(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select(F.col("doc_id").alias("rank"), "text")


def test_near_dedup_matches_sequential_on_documents(spark):
    from conftest import SF
    d = _corpus(spark, SF)
    bands = N.band_keys(N.signatures(d, "rank"), "rank").collect()
    per = {}
    for r in bands:
        per.setdefault(r["rank"], set()).add((r["band"], r["key"]))
    want = sequential_greedy(list(per.items()))
    got = {r["rank"] for r in N.near_dedup(d, "rank").select("rank").collect()}
    assert got == want


def test_short_docs_are_dropped(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, "a b c d e f")],
                               "rank long, text string")
    assert [r["rank"] for r in N.near_dedup(df, "rank").collect()] == [2]


def test_incremental_equals_one_pass(spark, tmp_dir):
    from conftest import SF
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    d = _corpus(spark, SF)
    one_pass = {r["rank"] for r in N.near_dedup(d, "rank").select("rank").collect()}
    job = IncrementalNearDedup(spark, tmp_dir)
    got = set()
    for lo, hi in ((0, 70), (70, 140), (140, 10**9)):
        part = d.where((F.col("rank") >= lo) & (F.col("rank") < hi))
        got |= {r["rank"] for r in job.process(part).select("rank").collect()}
    assert got == one_pass


def test_greedy_with_salted_hot_buckets(spark, monkeypatch):
    from wordmill.operators import skew
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rnd = random.Random(11)
    docs = []
    for r in rnd.sample(range(1000), 80):
        keys = [(0, "hot" if rnd.random() < 0.4 else f"a{rnd.randrange(30)}"),
                (1, f"b{rnd.randrange(15)}"), (2, f"c{rnd.randrange(40)}")]
        docs.append((r, keys))
    want = sequential_greedy([(r, set(ks)) for r, ks in docs])
    got = {x["rank"] for x in N.greedy_keep(_bands_df(spark, docs)).collect()}
    assert got == want


def test_structured_stream_equals_one_pass(spark, tmp_dir):
    import os
    from conftest import SF
    from wordmill.streaming.incremental_neardup import start_stream
    d = _corpus(spark, SF)
    one_pass = {r["rank"] for r in N.near_dedup(d, "rank").select("rank").collect()}
    src = os.path.join(tmp_dir, "in")
    for i, (lo, hi) in enumerate(((0, 70), (70, 140), (140, 10**9))):
        part = d.where((F.col("rank") >= lo) & (F.col("rank") < hi)).coalesce(1)
        part.write.mode("append").parquet(src)
    q = start_stream(spark, src, "rank long, text string", os.path.join(tmp_dir, "state"),
                     os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "chk"),
                     files_per_batch=1)
    q.awaitTermination(600)
    got = {r["rank"] for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect()}
    assert got == one_pass


def test_exact_dedup_strategies_agree(spark):
    rnd = random.Random(5)
    rows = [(f"c{rnd.randrange(3)}", i, f"t{i}", f"h{rnd.randrange(8)}") for i in range(200)]
    df = spark.createDataFrame(rows, "corpus string, ordinal long, text string, hash string")
    a = sorted(tuple(r) for r in C.exact_dedup(df).collect())
    b = sorted(tuple(r) for r in C.exact_dedup(df, strategy="winners").collect())
    assert a == b and len(a) == len({(r[0], r[3]) for r in rows})


def test_near_dedup_xxhash_family(spark):
    from conftest import SF
    d = _corpus(spark, SF)
    bands = N.band_keys(N.signatures(d, "rank", hash_family="xxhash64"), "rank").collect()
    per = {}
    for r in bands:
        per.setdefault(r["rank"], set()).add((r["band"], r["key"]))
    want = sequential_greedy(list(per.items()))
    got = {r["rank"] for r in N.near_dedup(d, "rank", hash_family="xxhash64")
           .select("rank").collect()}
    assert got == want


def test_replayed_batch_gives_the_same_sink(spark, tmp_dir):
    from conftest import SF
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    d = _corpus(spark, SF)
    job = IncrementalNearDedup(spark, f"{tmp_dir}/state")
    write = job.foreach_batch(f"{tmp_dir}/sink")
    parts = [d.where("rank < 80"), d.where("rank >= 80")]
    got = []
    for replay in ((0, 1), (1,), (0, 1)):  # at-least-once delivery
        for k in replay:
            write(parts[k], k)
        got.append(sorted(r["rank"] for r in spark.read.parquet(f"{tmp_dir}/sink").collect()))
    assert got[0] == got[1] == got[2] and got[0]


def test_wide_ordinals_do_not_collide(spark):
    text = ["one two three four five six", "seven eight nine ten eleven twelve"]
    df = spark.createDataFrame([("a", (1 << 40) + 5, text[0]), ("b", 5, text[1]), ("a", (1 << 62), text[1]),
                                ("a", -1, text[0])], "source string, doc_id long, text string")
    kept = N.near_dedup(N.global_rank(df, "source", "doc_id"), "rank")
    assert sorted((r.source, r.doc_id) for r in kept.collect()) == [("a", -1), ("a", 1 << 62)]


def test_shingle_hash_is_wide(spark):
    n = 400_000
    got = spark.range(n).select(N.shingle_hash(F.concat(F.lit("w x y z "), F.col("id").cast("string"))).alias("h"))
    assert got.distinct().count() == n


def test_equal_signatures_collapse_before_the_rounds(spark):
    docs = [(r, [(b, "same") for b in range(5)]) for r in range(500)] + [(1000, [(0, "other")])]
    assert {x["rank"] for x in N.greedy_keep(_bands_df(spark, docs)).collect()} == {0, 1000}


def test_winners_with_null_scope(spark):
    df = spark.createDataFrame([(None, 1, "t", "h"), (None, 2, "t", "h"), ("c", 3, "t", "h")],
                               "corpus string, ordinal long, text string, hash string")
    got = {(r.corpus, r.ordinal) for r in C.exact_dedup(df, strategy="winners").collect()}
    assert got == {(None, 1), ("c", 3)}


def test_incremental_goes_on_from_stored_state(spark, tmp_dir):
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    text = "one two three four five six seven"
    first = spark.createDataFrame([(1, text)], "rank long, text string")
    second = spark.createDataFrame([(2, text), (3, "another text of more than five words")], "rank long, text string")
    assert IncrementalNearDedup(spark, tmp_dir).process(first).count() == 1
    again = IncrementalNearDedup(spark, tmp_dir)  # a new object over the same state
    assert [r["rank"] for r in again.process(second).collect()] == [3]


def _chain(n):
    """Document r shares a bucket with r - 1 and with r + 1 only."""
    return [(r, [(0, f"e{r}"), (0, f"e{r + 1}")]) for r in range(n)]


def test_chain_of_ten_thousand_takes_few_jobs(spark, one_partition):
    docs = _chain(10_000)
    df = _bands_df(spark, docs).repartition(4)
    spark.sparkContext.setJobGroup("chain", "chain")
    got = {x["rank"] for x in N.greedy_keep(df).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == set(range(0, 10_000, 2))
    assert jobs < 400    # a round a link would be 5,000 rounds of several jobs


def test_components_are_the_sequential_greedy(spark, one_partition):
    """Chains and random graphs, finished inside groups or, where components count as large, in rounds."""
    rnd = random.Random(3)
    docs = _chain(40) + [(100 + r, [(1, f"x{rnd.randrange(25)}"), (2, f"y{rnd.randrange(25)}")]) for r in range(60)]
    rnd.shuffle(docs)
    want = sequential_greedy([(r, set(ks)) for r, ks in docs])
    B = N.buckets(_bands_df(spark, docs))
    for first_rounds, rows in ((0, 500_000), (1, 10)):
        assert {x["rank"] for x in N.greedy_keep_buckets(B, first_rounds, rows).collect()} == want


def test_components_of_struct_ranks(spark):
    from wordmill.operators.components import components
    edges = [((None, 1), ("a", 1)), (("a", 1), ("a", 2)), (("b", 1), ("b", 1)), (("c", 5), ("b", 9))]
    df = spark.createDataFrame(edges, "a struct<s:string,i:long>, b struct<s:string,i:long>")
    got = {tuple(r["node"]): tuple(r["component"]) for r in components(df).collect()}
    assert got == {(None, 1): (None, 1), ("a", 1): (None, 1), ("a", 2): (None, 1), ("b", 9): ("b", 9), ("c", 5): ("b", 9)}


@pytest.fixture()
def one_partition(spark):
    """Many small jobs: a task a stage is enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _bucket_rows(spark, docs):
    """(rank, band, k1, k2) of documents given as (rank, bucket numbers)."""
    return spark.createDataFrame([(r, 0, k * 7919, k) for r, keys in docs for k in keys], "rank long, band int, k1 long, k2 long")


def test_fifty_batches_read_a_bounded_part_of_the_state(spark, tmp_dir, one_partition):
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    job = IncrementalNearDedup(spark, tmp_dir, part_rows=10, fan=4)
    stored = set()
    for k in range(50):
        # five buckets of its own; every fifth batch asks for three old ones as well
        own, old = set(range(5 * k, 5 * k + 5)), set(range(3)) if k % 5 == 4 else set()
        prior = job._known(_bucket_rows(spark, [(k, own | old)]), k)
        assert ({r["k2"] for r in prior.collect()} if prior is not None else set()) == old & stored
        # its eight buckets at most ask each run; only parts with a real hit (or a rare false one) are read
        assert job.last_probe["filters"] <= 8 * len(job.runs())
        assert job.last_probe["read"] <= len(old) + 2
        job._store(_bucket_rows(spark, [(k, own)]).select("band", "k1", "k2", F.lit(k).cast("long").alias("batch")), {k}, k, k)
        job._compact(k)
        stored |= own
    assert len(job.runs()) <= 3 * 4 and job.last_probe["parts"] >= 25
    assert [r.low for r in job.runs()] == sorted(r.low for r in job.runs()) and job._free_id() == 50


def test_compacted_batches_equal_one_pass_and_replay(spark, tmp_dir, one_partition):
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    words = [" ".join(f"w{k}x{j}" for j in range(8)) for k in range(30)]
    texts = [(r, words[1] if r % 7 == 6 else words[r]) for r in range(30)]
    df = spark.createDataFrame(texts, "rank long, text string")
    one_pass = {r["rank"] for r in N.near_dedup(df, "rank").collect()}
    batch = lambda k: df.where((F.col("rank") >= 6 * k) & (F.col("rank") < 6 * k + 6))
    job = IncrementalNearDedup(spark, tmp_dir, part_rows=10, fan=2)
    got = [{r["rank"] for r in job.process(batch(k), k).collect()} for k in range(5)]
    assert set().union(*got) == one_pass and len(one_pass) == 26
    assert [(r.low, r.high) for r in job.runs()] == [(0, 3), (4, 4)]
    again = IncrementalNearDedup(spark, tmp_dir, part_rows=10, fan=2)
    for k in (1, 4):    # one of a compacted run, and the last one
        assert {r["rank"] for r in again.process(batch(k), k).collect()} == got[k]
    with pytest.raises(ValueError, match="compacted run 0 to 3"):
        job._check_id(2, job.runs()[0], {0, 1, 3})


@pytest.mark.parametrize("few, join", [(100_000, "BroadcastHashJoin"), (0, "ShuffledHashJoin")])
def test_winners_never_sort_the_text(spark, monkeypatch, few, join):
    rows = [(f"c{i % 3}", i, f"text {i % 40}", f"h{i % 40}") for i in range(200)]
    df = spark.createDataFrame(rows, "corpus string, ordinal long, text string, hash string")
    want = sorted(tuple(r) for r in C.exact_dedup(df).collect())
    monkeypatch.setattr(C, "BROADCAST_LOSERS", few, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = C.exact_dedup(df, strategy="winners")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in out.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert join in plan and "SortMergeJoin" not in plan


def test_candidates_compute_signatures_once(spark, monkeypatch):
    from conftest import SF
    from wordmill.plans import registry as R
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows, bands = R._band_rows(spark, SF)
    monkeypatch.setattr(R, "_band_rows", lambda *_: (rows, bands.mapInArrow(run, bands.schema)))
    assert R.q_neardup_candidates(spark, SF).count() > 0
    assert made.value == bands.count()


def test_incremental_query_writes_no_text(spark, monkeypatch):
    from conftest import SF
    from wordmill.plans import registry as R
    frame, columns = type(spark.range(1)), []
    checkpoint = frame.checkpoint

    def seen(df, *a, **k):
        columns.extend(df.columns)
        return checkpoint(df, *a, **k)

    monkeypatch.setattr(frame, "checkpoint", seen)
    R.q_incremental_neardup(spark, SF)
    assert columns and "text" not in columns


def test_signature_has_a_value_for_every_permutation(spark):
    import hashlib
    text = "one two three four five six seven"
    df = spark.createDataFrame([(1, text), (2, "of four words only"), (3, None)], "rank long, text string")
    words = text.split()
    hashes = [int(hashlib.md5(" ".join(words[i:i + 5]).encode()).hexdigest()[:15], 16) for i in range(3)]
    want = [min((a1 * (h >> 30) + a2 * (h & (1 << 30) - 1) + b) % N.MERSENNE_P for h in hashes) for a1, a2, b in N.permutations(64)]
    assert [tuple(r) for r in N.signatures(df, "rank").collect()] == [(1, *want)]


def test_signature_query_has_all_values(spark, tmp_path):
    import duckdb
    from wordmill.plans import registry as R
    rows = [(k, "s", "en", f"document number {k} says something long enough to be kept by the filters") for k in range(3)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.sig for r in R.q_minhash_sig(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == dict(con.execute(R.REGISTRY["minhash_sig"].sql).fetchall())
    assert len(got) == 3 and all(len(s.split(",")) == 64 for s in got.values())


def test_bands_pay_for_their_own_values_only(spark):
    df = spark.createDataFrame([(1, "one two three four five six")], "rank long, text string")
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = N.band_keys(N.signatures(df, "rank"), "rank")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert "AS m54#" in plan and "AS m55#" not in plan
