"""Near-duplicate removal: 5-word shingles, MinHash, LSH banding, greedy keep.

Semantics kept from the source pass: documents are visited in global order; a
document with fewer than 5 words counts as a duplicate; a document is kept iff it
shares no LSH bucket with an *earlier kept* document (no Jaccard verification).
Dropped documents are not indexed, so a chain A~B, B~C, A!~C keeps A and C —
this is not connected components.

Distributed form of that greedy (no pairs are ever materialised):
  round: per bucket, the min rank among undecided docs; a doc that is the min of
  all its buckets is kept; undecided docs sharing a bucket with a newly kept doc
  are dropped. The earliest undecided doc is always kept, so every round makes
  progress, and each decision equals the sequential one.
A chain of near copies would take a round a link, so after ``FIRST_ROUNDS`` rounds the
undecided documents are split into connected components (a logarithmic number of
rounds), and every component of at most ``COMPONENT_ROWS`` bucket rows is finished by the sequential
greedy in one group; only larger ones go on in rounds and are split again.
Every step is an aggregate or an equi-join on (bucket) / (rank); a bucket that
holds a third of all docs is absorbed by partial aggregation, and the joins on the
bucket key spread hot buckets over salted tasks (``skew.salted_join``). Each
round's state is checkpointed to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import text as T
from wordmill.operators import components as C
from wordmill.operators import metrics as M
from wordmill.operators import skew as S
from wordmill.session import checkpoint_dir

# --- fixed values -----------------------------------------------------------------
SHINGLE_WORDS = 5            # words per shingle
MIN_WORDS = SHINGLE_WORDS    # shorter documents are counted as duplicates
NUM_PERM = 64                # permutations of the signature
THRESHOLD = 0.8              # Jaccard threshold
BANDS, ROWS = 5, 11          # b x r chosen for (0.8, 64) by the FP/FN-area optimum
MERSENNE_P = (1 << 31) - 1   # modulus of the universal hash family
HASH_HEX = 15                # shingle hash: first 15 hex digits of md5 (60 bits)
LANE_BITS = 30               # it enters the hash family as two 30-bit lanes
PERM_SEED = 0x5EED
# --- tuning values (results do not depend on them) ----------------------------------
FIRST_ROUNDS = 3             # rounds before undecided documents are split into components
COMPONENT_ROWS = 500_000     # bucket rows of a component that one group finishes
# ----------------------------------------------------------------------------------


def _splitmix64(seed: int):
    x = seed & 0xFFFFFFFFFFFFFFFF
    while True:
        x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        yield z ^ (z >> 31)


def permutations(n: int = NUM_PERM, seed: int = PERM_SEED) -> list[tuple[int, int, int]]:
    """(a1, a2, b) with 1 <= a1, a2 < p and 0 <= b < p.

    ``a1*hi + a2*lo + b`` of two lanes below 2^30 stays below 2^62: a signed bigint.
    """
    g = _splitmix64(seed)
    return [(1 + next(g) % (MERSENNE_P - 1), 1 + next(g) % (MERSENNE_P - 1), next(g) % MERSENNE_P)
            for _ in range(n)]


PERMS = permutations()
USED = BANDS * ROWS          # only the first b*r permutations take part in banding


def shingle_hash(s, family: str = "md5"):
    """60-bit shingle hash.

    ``md5`` (default): first 15 hex digits of MD5, reproducible in SQL engines, so
    the oracle can check signatures. ``xxhash64``: Spark's native 64-bit hash
    masked to 60 bits — faster, but no SQL engine reproduces it.
    """
    if family == "xxhash64":
        return F.xxhash64(s).bitwiseAND(F.lit((1 << (4 * HASH_HEX)) - 1))
    return F.conv(F.substring(F.md5(s), 1, HASH_HEX), 16, 10).cast("bigint")


def shingle_array(words_col) -> F.Column:
    """The n-4 shingles of a word list (words joined by one space).

    The word list is bound once (``let``) so an expression argument is not
    re-evaluated for every shingle.
    """
    return T.let(words_col, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS),
        lambda i: F.array_join(F.slice(w, i + 1, SHINGLE_WORDS), " ")))


def _shingle_rows(df: DataFrame, rank_col: str, text_col: str) -> DataFrame:
    """(rank, pos, shingle) rows without a higher-order lambda.

    ``posexplode`` of the word list yields one row per word; each row builds its
    shingle with ``slice``/``array_join`` in an ordinary projection, which stays
    inside whole-stage codegen (lambdas are interpreted). Rows whose window would
    run past the end are dropped, so documents under 5 words yield nothing.
    """
    w = df.select(rank_col, T.words(text_col).alias("_w"))
    e = w.select(rank_col, "_w", F.posexplode("_w").alias("pos", "_word"))
    e = e.where(F.col("pos") <= F.size("_w") - SHINGLE_WORDS)
    return e.select(rank_col, "pos", F.array_join(
        F.slice("_w", F.col("pos") + 1, SHINGLE_WORDS), " ").alias("shingle"))


def shingles(df: DataFrame, rank_col: str, text_col: str = "text") -> DataFrame:
    """D2 exploded: (rank, pos, shingle) for documents with >= 5 words."""
    return _shingle_rows(df, rank_col, text_col)


def signatures(df: DataFrame, rank_col: str, text_col: str = "text",
               hash_family: str = "md5") -> DataFrame:
    """D3: (rank, m0..m63) — min over shingles of (a1*hi + a2*lo + b) mod p.

    Shingle hashes are exploded and re-aggregated per document; the partial
    HashAggregate (fixed-width bigint buffers, codegen) runs before the shuffle,
    so only one 64-long row per document crosses the network. Banding reads
    ``USED`` of the values; Spark prunes the others there.
    """
    h = _shingle_rows(df, rank_col, text_col).select(
        rank_col, shingle_hash(F.col("shingle"), hash_family).alias("h"))
    h = h.select(rank_col, F.shiftright("h", LANE_BITS).alias("hi"),
                 F.col("h").bitwiseAND(F.lit((1 << LANE_BITS) - 1)).alias("lo"))
    aggs = [F.min((F.col("hi") * F.lit(a1) + F.col("lo") * F.lit(a2) + F.lit(b)) % F.lit(MERSENNE_P))
            .alias(f"m{i}") for i, (a1, a2, b) in enumerate(PERMS)]
    return h.groupBy(rank_col).agg(*aggs)


def band_keys(sig: DataFrame, rank_col: str) -> DataFrame:
    """(rank, band, key) with key = the band's 11 values joined (exact equality)."""
    bands = F.array(*[F.struct(F.lit(j).alias("band"), F.concat_ws(
        ",", *[F.col(f"m{j * ROWS + k}").cast("string") for k in range(ROWS)]).alias("key"))
        for j in range(BANDS)])
    return sig.select(rank_col, F.inline(bands))


def _bucket_id(df: DataFrame) -> DataFrame:
    """Compact fixed-width bucket id: band + xxhash64 + murmur3 (32-bit) of the key.

    96 hash bits keep accidental bucket collisions negligible at 10^11 bucket rows;
    the exact 11-value key is still what defines a bucket in ``band_keys``.
    """
    return df.select("rank", "band", F.xxhash64("band", "key").alias("k1"),
                     F.hash("key", "band").cast("bigint").alias("k2"))


BUCKET = ("band", "k1", "k2")


def bucket_stats(bands: DataFrame, rank_col: str = "rank") -> DataFrame:
    """D5 helper: per bucket, size and earliest rank."""
    return bands.groupBy("band", "key").agg(F.count("*").alias("n_docs"),
                                            F.min(rank_col).alias("first_rank"))


def buckets(bands: DataFrame) -> DataFrame:
    """The narrow bucket table (rank, band, k1, k2), materialised once."""
    checkpoint_dir(bands.sparkSession)
    return _bucket_id(bands).checkpoint(eager=True)


def greedy_keep(bands: DataFrame) -> DataFrame:
    """Ranks kept by the sequential greedy, computed in bucket-min rounds.

    ``bands`` has (rank, band, key), the rank of any orderable type. Returns (rank) of
    kept documents, including documents whose buckets are all singletons.
    """
    return greedy_keep_buckets(buckets(bands))


def _first_of_equals(B: DataFrame) -> DataFrame:
    """Of documents with the same buckets only the first can be kept: drop the others."""
    per = B.groupBy("rank").agg(
        F.bit_xor(F.xxhash64(F.lit(1), *BUCKET)).alias("s1"),
        F.bit_xor(F.xxhash64(F.lit(2), *BUCKET)).alias("s2"), F.count(F.lit(1)).alias("s3"))
    first = per.groupBy("s1", "s2", "s3").agg(F.min("rank").alias("rank")).select("rank")
    return B.join(first, "rank", "left_semi")


def _in_order(rank) -> tuple:
    """A sort key of a rank as Spark orders it: structs field by field, nulls first."""
    fields = rank.values() if isinstance(rank, dict) else (rank,)
    return tuple((v is not None, v) for v in fields)


def _sequential(table: pa.Table) -> pa.Table:
    """The kept ranks of one component, visited in order."""
    docs: dict = {}
    for rank, *bucket in zip(*(table[c].to_pylist() for c in ("rank", *BUCKET))):
        docs.setdefault(_in_order(rank), (rank, []))[1].append(tuple(bucket))
    held, kept = set(), []
    for order in sorted(docs):
        rank, mine = docs[order]
        if held.isdisjoint(mine):
            held.update(mine)
            kept.append(rank)
    return pa.table({"rank": pa.array(kept, table.schema.field("rank").type)})


def _finish_components(state: DataFrame, hot: DataFrame, component_rows: int) -> tuple[DataFrame, DataFrame]:
    """(kept ranks of the small components, state of the larger ones)."""
    key = list(BUCKET)
    first = state.groupBy(*key).agg(F.min("rank").alias("mr"))
    linked = S.salted_join(state, first, key, "inner", hot, "rank")
    label = C.written(C.components(linked.select(F.col("rank").alias("a"), F.col("mr").alias("b"))), "neardup-components")
    # an undecided document that shares no bucket any more is a component of its own
    labelled = state.join(label.withColumnRenamed("node", "rank"), "rank", "left").withColumn(
        "component", F.coalesce("component", "rank"))
    labelled = C.written(labelled, "neardup-labelled")
    large = labelled.groupBy("component").count().where(F.col("count") > component_rows).select("component")
    large = C.written(large, "neardup-large")
    small = labelled.join(large, "component", "left_anti").select("component", "rank", *key)
    rank_type = state.schema["rank"].dataType.simpleString()
    kept = small.groupBy("component").applyInArrow(_sequential, f"rank {rank_type}")
    return kept, labelled.join(large, "component", "left_semi").select("rank", *key)


def greedy_keep_buckets(B: DataFrame, first_rounds: int | None = None, component_rows: int | None = None) -> DataFrame:
    """``greedy_keep`` on a materialised bucket table; joins on hot buckets are salted."""
    rounds = FIRST_ROUNDS if first_rounds is None else first_rounds
    most = COMPONENT_ROWS if component_rows is None else component_rows
    key = list(BUCKET)
    B = _first_of_equals(B).checkpoint(eager=True)
    sizes = B.groupBy(*key).agg(F.count("*").alias("n")).checkpoint(eager=True)
    hot = S.hot_keys(sizes, key).checkpoint(eager=True)
    # docs with at least one shared bucket take part in the rounds, the others are kept
    sized = S.salted_join(B, sizes, key, "inner", hot, "rank").withColumn("shared", F.col("n") >= 2)
    contested = sized.groupBy("rank").agg(F.max("shared").alias("contested")).checkpoint(eager=True)
    path = f"{checkpoint_dir(B.sparkSession).rstrip('/')}/neardup-kept-{uuid.uuid4().hex}"
    part = 0

    def keep(ranks: DataFrame) -> DataFrame:
        """One more part of the table of kept documents."""
        nonlocal part
        ranks.write.parquet(f"{path}/part={part}")
        part += 1
        return B.sparkSession.read.schema(ranks.schema).parquet(f"{path}/part={part - 1}")

    keep(contested.where(~F.col("contested")).select("rank"))
    state = sized.where("shared").drop("n", "shared").checkpoint(eager=True)
    done = 0
    while not state.isEmpty():
        if done >= rounds:
            finished, state = _finish_components(state, hot, most)
            keep(finished)
            state = state.checkpoint(eager=True)
            # what is left is large: go on in rounds, more of them before each new split
            rounds, done = max(2 * rounds, 1), 0
            continue
        done += 1
        bmin = state.groupBy(*key).agg(F.min("rank").alias("mr"))
        J = S.salted_join(state, bmin, key, "inner", hot, "rank")
        verdict = J.groupBy("rank").agg(F.min((F.col("rank") == F.col("mr")).cast("int"))
                                        .alias("is_min"))
        newly = keep(verdict.where(F.col("is_min") == 1).select("rank"))
        # one newly kept doc per bucket at most: (bucket) rows are unique per key
        kept_buckets = state.join(newly, "rank", "left_semi").select(*key)
        dropped = S.salted_join(state, kept_buckets, key, "left_semi", hot, "rank").select("rank")
        decided = newly.unionByName(dropped)
        state = state.join(decided, "rank", "left_anti").checkpoint(eager=True)
    return B.sparkSession.read.schema(B.select("rank").schema).parquet(path).select("rank")


def global_rank(df: DataFrame, corpus_col: str, ordinal_col: str) -> DataFrame:
    """The visiting order as a struct: corpora in name order, then the ordinal.

    A struct compares field by field, so any 64-bit ordinal and any number of corpora
    fit, and no corpus index has to be joined.
    """
    return df.withColumn("rank", F.struct(F.col(corpus_col), F.col(ordinal_col).cast("bigint").alias("ordinal")))


def near_dedup(df: DataFrame, rank_col: str = "rank", text_col: str = "text",
               hash_family: str = "md5") -> DataFrame:
    """Rows of ``df`` kept by the near-duplicate pass (schema unchanged)."""
    sig = signatures(df, rank_col, text_col, hash_family)
    bands = band_keys(sig, rank_col)
    if rank_col != "rank":
        bands = bands.withColumnRenamed(rank_col, "rank")
    return df.join(_kept_ranks(bands, rank_col), rank_col, "left_semi")


def _kept_ranks(bands: DataFrame, rank_col: str) -> DataFrame:
    kept = greedy_keep(bands)
    return kept.withColumnRenamed("rank", rank_col) if rank_col != "rank" else kept


def write_near_dedup(df: DataFrame, path: str, corpus_col: str, rank_col: str = "rank",
                     text_col: str = "text", hash_family: str = "md5") -> DataFrame:
    """Write the kept rows, return the report of :func:`near_dedup_report`.

    The counters are observed on the write itself; input and kept rows are not read again.
    """
    labels = M.labels_of(df, (corpus_col,))
    bands = band_keys(signatures(df, rank_col, text_col, hash_family), rank_col)
    if rank_col != "rank":
        bands = bands.withColumnRenamed(rank_col, "rank")
    kept = _kept_ranks(bands, rank_col)
    flagged = df.join(kept.withColumn("_kept", F.lit(1)), rank_col, "left")
    if labels is None:    # too many corpora to count on the write
        flagged.where("_kept is not null").drop("_kept").write.mode("overwrite").parquet(path)
        return near_dedup_report(df, kept, corpus_col, rank_col)
    flagged, read = M.observe_counts(flagged, (corpus_col,), labels, {"n_input": F.lit(1), "n_kept": F.col("_kept")})
    flagged.where("_kept is not null").drop("_kept").write.mode("overwrite").parquet(path)
    rows = read()
    total = (None, sum(r[1] for r in rows), sum(r[2] for r in rows))
    kind = df.schema[corpus_col].dataType.simpleString()
    report = df.sparkSession.createDataFrame([*rows, total], f"`{corpus_col}` {kind}, n_input bigint, n_kept bigint")
    return report.withColumn("n_removed", F.col("n_input") - F.col("n_kept"))


def near_dedup_report(df: DataFrame, kept: DataFrame, corpus_col: str,
                      rank_col: str = "rank") -> DataFrame:
    """Per corpus and overall (corpus null): input, kept, removed."""
    flagged = df.select(corpus_col, rank_col).join(
        kept.select(rank_col, F.lit(1).alias("_k")), rank_col, "left")
    g = flagged.rollup(corpus_col).agg(F.count("*").alias("n_input"),
                                       F.count("_k").alias("n_kept"))
    return g.withColumn("n_removed", F.col("n_input") - F.col("n_kept"))
