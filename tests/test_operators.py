"""Salted joins, the filter funnel and input spreading."""
import random

import pytest

from pyspark.sql import functions as F

from wordmill.operators import clean as C
from wordmill.operators import skew as S
from wordmill.sources.readers import ensure_parallelism


def test_salted_join_equals_plain_join(spark):
    rnd = random.Random(3)
    big = spark.createDataFrame(
        [(i, "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}") for i in range(400)],
        "rank long, key string")
    small = spark.createDataFrame([(f"k{i}", i) for i in range(0, 20, 2)] + [("hot", 99)],
                                  "key string, v long")
    sizes = big.groupBy("key").agg(F.count("*").alias("n"))
    hot = S.hot_keys(sizes, ["key"], threshold=50)
    assert [r.key for r in hot.collect()] == ["hot"]
    assert hot.first()["_salts"] > 1
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(tuple(r) for r in big.join(small, ["key"], how).collect())
        got = sorted(tuple(r) for r in S.salted_join(big, small, ["key"], how, hot, "rank").collect())
        assert got == want, how


def test_funnel_counts_and_reason_order(spark):
    long_ok = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."
    rows = [("c", "x"),                      # too short
            ("c", "12345 " * 20),            # no letters -> script
            ("c", long_ok), ("c", long_ok),  # kept + duplicate
            ("c", " ".join(["w"] * 30))]     # repetitive
    df = spark.createDataFrame(rows, "corpus string, text string")
    from wordmill.functions import patterns as P
    r = C.clean_funnel(df, block=P.LATIN).first()
    assert (r.n_input, r.n_script, r.n_too_short, r.n_repetitive, r.n_kept, r.n_duplicate) == \
        (5, 1, 1, 1, 1, 1)
    assert r.n_skipped == 4


def test_ensure_parallelism(spark):
    one = spark.range(100).coalesce(1)
    assert ensure_parallelism(one, "id").rdd.getNumPartitions() >= 2
    many = spark.range(0, 100, 1, 64)
    assert ensure_parallelism(many, "id").rdd.getNumPartitions() == 64


@pytest.mark.parametrize("most", [5_000, 1])
def test_funnel_as_a_by_product_of_the_write(spark, tmp_dir, monkeypatch, most):
    """Counted on the write, or with more labels than that takes by a second pass: the rows are the same."""
    from wordmill.functions import patterns as P
    from wordmill.operators import clean as C
    from wordmill.operators import metrics as M
    monkeypatch.setattr(M, "MOST_LABELS", most)
    good = "A text of well over fifty letters, long enough to pass all of the filters"
    rows = [(None, 1, good), (None, 2, good), ("a", 3, good), ("a", 4, "short"), ("b", 5, None), ("a", 6, good + " twice")]
    df = spark.createDataFrame(rows, "corpus string, ordinal long, text string")
    path = f"{tmp_dir}/out"
    got = C.write_clean_corpus(df, path, block=P.LATIN)
    want = C.clean_funnel(df, block=P.LATIN)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    kept = spark.read.parquet(path)
    assert sorted((r.corpus or "", r.ordinal) for r in kept.collect()) == [("", 1), ("a", 3), ("a", 6)]
    empty = C.write_clean_corpus(df.limit(0), f"{tmp_dir}/none", block=P.LATIN)
    assert empty.count() == 0 and spark.read.parquet(f"{tmp_dir}/none").count() == 0
