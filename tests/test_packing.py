"""Split (P1), head limits (W3/W4), dense positions and packing."""
import hashlib

from pyspark.sql import functions as F

from wordmill.operators import packing as PK


def _ids(spark, n):
    return spark.createDataFrame([(i,) for i in range(n)], "doc_id long")


def test_split_sizes(spark):
    for n, k in ((1000, 10), (101, 2)):
        train, test = PK.seeded_split(_ids(spark, n), "doc_id")
        assert test.count() == k and train.count() == n - k


def test_split_order_matches_md5(spark):
    n = 300
    train, test = PK.seeded_split(_ids(spark, n), "doc_id")
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    assert {r.doc_id for r in test.collect()} == set(order[:3])


def test_k_smallest_refines(spark, monkeypatch):
    monkeypatch.setattr(PK, "BOUNDARY_LIMIT", 5)
    df = _ids(spark, 2000).withColumn("h", F.md5(F.col("doc_id").cast("string")))
    got = {r.doc_id for r in PK.k_smallest(df, "h", "doc_id", 777).collect()}
    want = {r.doc_id for r in df.orderBy("h", "doc_id").limit(777).collect()}
    assert got == want


def test_dense_positions(spark):
    df = _ids(spark, 500).withColumn("k", (F.col("doc_id") * 7919) % 500)
    pos = PK.dense_positions(df, ["k"], partitions=5).collect()
    assert sorted(r.position for r in pos) == list(range(500))
    assert all(r.position == r.k for r in pos)


def test_pack_blocks_toy(spark):
    rows = [(0, 0, 0, [1, 2, 3]), (0, 0, 1, [4, 5]), (0, 0, 2, [6, 7, 8]), (0, 1, 3, [9])]
    df = spark.createDataFrame(rows, "shard long, batch long, position long, input_ids array<int>")
    out = sorted((r.batch, r.block, r.input_ids, r.attention_mask, r.labels)
                 for r in PK.pack_blocks(df, block_len=3).collect())
    assert out == [(0, 0, [1, 2, 3], [1, 1, 1], [1, 2, 3]),
                   (0, 1, [4, 5, 6], [1, 1, 1], [4, 5, 6])]


def test_pack_blocks_long_doc(spark):
    rows = [(0, 0, 0, list(range(10))), (0, 0, 1, [10, 11])]
    df = spark.createDataFrame(rows, "shard long, batch long, position long, input_ids array<int>")
    out = sorted((r.block, r.input_ids) for r in PK.pack_blocks(df, block_len=4).collect())
    assert out == [(0, [0, 1, 2, 3]), (1, [4, 5, 6, 7]), (2, [8, 9, 10, 11])]


def test_worker_batches(spark):
    n, shards = 10, 3   # shards of 4, 3, 3 rows
    df = spark.createDataFrame([(i,) for i in range(n)], "position long")
    got = [(r.shard, r.batch) for r in PK.worker_batches(df, n, batch_size=2, num_shards=shards)
           .orderBy("position").collect()]
    assert got == [(0, 0), (0, 0), (0, 1), (0, 1), (1, 0), (1, 0), (1, 1), (2, 0), (2, 0), (2, 1)]


def test_first_n_and_head_limit(spark):
    df = _ids(spark, 50)
    assert [r.doc_id for r in PK.first_n(df, ["doc_id"], 5).collect()] == [0, 1, 2, 3, 4]
    keyed = df.withColumn("_shuffle", PK.shuffle_key("doc_id"))
    assert PK.head_limit(keyed, 7).count() == 7
    assert PK.head_limit(keyed, 0).count() == 50


def test_split_is_a_filter(spark, tmp_dir):
    _ids(spark, 400).withColumn("text", F.lit("t")).write.parquet(f"{tmp_dir}/d")
    train, test = PK.seeded_split(spark.read.parquet(f"{tmp_dir}/d"), "doc_id")
    for part in (train, test, PK.head_limit(train, 50)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert train.count() == 396 and test.count() == 4 and PK.head_limit(train, 50).count() == 50


def test_first_k_ties_and_edges(spark):
    df = spark.createDataFrame([("aa", i) for i in range(10)] + [("ab", 3), (None, 4)], "h string, doc_id long")
    for k in (0, 1, 7, 10, 11, 12, 100):
        got = sorted(((r.h or ""), r.doc_id) for r in PK.k_smallest(df.where("h is not null"), "h", "doc_id", k).collect())
        assert got == [("aa", i) for i in range(min(k, 10))] + [("ab", 3)] * (k > 10)


def test_ids_to_pack_are_made_once(spark):
    from wordmill.plans import registry as R
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([(i, list(range(i % 7))) for i in range(400)], "doc_id long, input_ids array<int>")
    docs = docs.repartition(4, "doc_id").mapInArrow(run, docs.schema)
    blocks = R._packed(docs, 100, 8).collect()
    assert sum(len(b["input_ids"]) for b in blocks) > 0
    assert made.value == 400
