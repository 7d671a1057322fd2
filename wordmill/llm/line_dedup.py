"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared by their text with runs of white space collapsed and the ends trimmed.
A line is dropped when an equal line, or one within one edit (an inserted, deleted or
substituted character), comes earlier; documents are ordered by id, lines by place. Being
near an earlier line is enough, whether or not that one is dropped itself. Lines of fewer
than ``MIN_EDIT`` characters are only compared for equality; blank lines stay.

1. Equal lines become classes with the rank of their first occurrence.
2. Each class emits a hash of either half, for its own length and for that of a partner one
   character shorter. One edit leaves a half alone, so classes that share no half with
   another class have no partner and emit nothing more.
3. The rest emit the deletion neighbourhood. Deleting single characters of a long line would
   cost the square of its length, so deletions narrow down: a line is cut in ``PIECES``
   pieces and emits each variant without one piece as a hashed key; variants that some
   other line shares go on with the piece that was cut out, until at most ``SHORT``
   characters are left, of which every variant without one character is emitted. At every
   step one edit lies in one piece, so no pair is lost.
4. Equal variants are joined. Variants without the same place of equally long rests differ
   by a substitution; a variant equal to an undeleted rest by an insertion. All members of
   such a bucket are within one edit of its earliest, so each is paired with that one only:
   results stay linear whatever the size of a bucket. The edit distance of the pairs is
   verified on the full lines.

Defined results: null text counts as empty (one blank line); texts and lines of any length are
compared whole; a null id comes first; rows that repeat an id are compared by (id, line place), so of equal rows both keep what one
keeps; an empty table gives an empty result; other columns are carried by
:func:`drop_duplicate_lines`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.scratch import free_name, stored

MIN_EDIT = 16
PIECES = 16
SHORT = 48
WHITE_RUN = r"[\x09-\x0D\x20]+"
HALVES = ("half1", "half2", "half3", "half4")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, row, place, line (its comparison form) of every line."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("doc"),
                        F.xxhash64(text).alias("row"), F.posexplode(F.split(text, "\n", -1)).alias("place", "line"))
            .withColumn("line", F.trim(F.regexp_replace("line", WHITE_RUN, " "))))


def _hashed(lines: DataFrame) -> DataFrame:
    """The lines by two hashes, with their rank and the hashes of their halves."""
    n = "length(line)"

    def half(shorter: int, second: bool) -> F.Column:
        m = f"({n} - {shorter})"
        part = f"substring(line, {n} - ({m} - {m} div 2) + 1)" if second else f"substring(line, 1, {m} div 2)"
        return F.expr(f"CASE WHEN {m} >= {MIN_EDIT} THEN xxhash64({m}, {str(second).lower()}, {part}) END")

    return lines.select(
        "doc", "row", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        (F.col("line") == "").alias("blank"),
        (F.col("doc").cast("decimal(19,0)") * F.lit(1 << 40).cast("decimal(13,0)") + F.col("place"))
        .cast("decimal(38,0)").alias("rank"),
        *(half(k, second).alias(name) for name, (k, second) in zip(HALVES, ((0, False), (0, True), (1, False), (1, True)))))


def _shared(rows: DataFrame, *key: str) -> DataFrame:
    """The rows whose key occurs with two ranks at least."""
    several = rows.groupBy(*key).agg(F.min("rank").alias("a"), F.max("rank").alias("b")).where("a < b").select(*key)
    return rows.join(several, list(key), "left_semi")


def _narrowed(rests: DataFrame) -> DataFrame:
    """Variants of the rests without one piece that two lines share, and the piece cut out as the new rest."""
    cut = (rests.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
           .withColumn("p0", F.expr(f"cast(q * m div {PIECES} AS int)"))
           .withColumn("p1", F.expr(f"cast((q + 1) * m div {PIECES} AS int)")))
    return _shared(cut.select(
        "rank", F.expr("xxhash64(context, m, q, substring(rest, 1, p0), substring(rest, length(rest) - (m - p1) + 1))")
        .alias("context"), F.expr("p1 - p0").alias("m"),
        F.expr("substring(rest, p0 + 1, length(rest) - p0 - (m - p1))").alias("rest")), "context")


def near_earlier(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(rank, earlier) for every class with a class within one edit before it: its earliest in some bucket.

    ``classes``: rank and the four half hashes; ``texts``: rank and line of the classes that share a half.
    """
    rests = texts.select("rank", F.col("line").alias("rest"), F.explode(F.expr("array(length(line), length(line) - 1)"))
                         .alias("m")).where(f"m >= {MIN_EDIT}").withColumn("context", F.xxhash64("m"))
    ready = []
    longest = texts.agg(F.max(F.length("line"))).first()[0] or 0
    while longest > SHORT:
        ready.append(rests.where(f"m <= {SHORT}"))
        rests = stored(_narrowed(rests.where(f"m > {SHORT}")), "line-rests")
        longest = longest // PIECES + 1
    ready.append(rests)
    short = ready[0]
    for r in ready[1:]:
        short = short.unionByName(r.select(*short.columns))
    whole = short.where("length(rest) = m").select(
        "rank", F.lit(0).alias("kind"), F.expr("xxhash64(context, rest)").alias("key"), F.lit(0).alias("at"))
    cut = (short.where("length(rest) > 0").withColumn("at", F.explode(F.expr("sequence(1, length(rest))")))
           .withColumn("key", F.expr("xxhash64(context, concat(substring(rest, 1, at - 1), substring(rest, at + 1)))")))
    substituted = cut.where("length(rest) = m").select("rank", F.lit(2).alias("kind"), "key", "at")
    longer = cut.where("length(rest) > m").select("rank", F.lit(1).alias("kind"), "key", F.lit(0).alias("at"))
    variants = stored(_shared(whole.unionByName(substituted).unionByName(longer)
                              .withColumn("same", F.col("kind") == 2), "same", "key", "at"), "line-variants")
    earliest = variants.groupBy("same", "key", "at").agg(
        *(F.min(F.when(F.col("kind") == k, F.col("rank"))).alias(f"first{k}") for k in range(3)))
    other = F.expr("CASE kind WHEN 0 THEN first1 WHEN 1 THEN first0 ELSE first2 END")
    return (variants.join(earliest, ["same", "key", "at"]).select("rank", other.alias("earlier"))
            .where("earlier < rank").distinct())


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, row, place, dropped of every line; (doc, row) names a document by id and text hash."""
    lines = stored(_hashed(_lines(docs, id_col, text_col)), "lines")
    classes = stored(lines.where("not blank").groupBy("h1", "h2")
                     .agg(F.min("rank").alias("rank"), *(F.min(h).alias(h) for h in HALVES)), "line-classes")
    halves = classes.select("rank", F.explode(F.array(*HALVES)).alias("half")).where("half is not null")
    partners = stored(_shared(halves, "half").select("rank").distinct(), "line-partners")
    where = partners.select("rank", F.expr("cast(floor(rank / 1099511627776) AS long)").alias("doc"))
    name = free_name(docs, "_doc")
    found = (docs.join(where.select(F.col("doc").alias(name)).distinct(),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))) == F.col(name), "left_semi"))
    texts = stored(_lines(found, id_col, text_col).withColumn(
        "rank", (F.col("doc").cast("decimal(19,0)") * F.lit(1 << 40).cast("decimal(13,0)") + F.col("place"))
        .cast("decimal(38,0)")).where(f"length(line) >= {MIN_EDIT}").join(partners, "rank", "left_semi")
        .select("rank", "line").distinct(), "line-texts")
    pairs = near_earlier(classes, texts)
    near = (pairs.join(texts, "rank").join(texts.select(F.col("rank").alias("earlier"), F.col("line").alias("before")),
                                           "earlier")
            .where(F.levenshtein("line", "before", 1).between(0, 1)).select("rank", F.lit(True).alias("near")).distinct())
    decided = classes.select("h1", "h2", F.col("rank").alias("first")).join(
        near.withColumnRenamed("rank", "first"), "first", "left")
    return (lines.select("doc", "row", "place", "h1", "h2", "rank", "blank").join(decided, ["h1", "h2"], "left")
            .select("doc", "row", "place", "blank",
                    F.expr("not blank and (rank > first or coalesce(near, false))").alias("dropped")))


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the dropped lines cut out of the text; all other columns unchanged.

    Documents all of whose lines are dropped have nothing new and go, unless ``counts`` names two
    columns for the numbers of lines and dropped lines: then every document is returned.
    """
    doc, row, cut, some = (free_name(docs, n) for n in ("_doc", "_row", "_cut", "_some"))
    flags = (line_decisions(docs, id_col, text_col).groupBy("doc", "row")
             .agg(F.sort_array(F.collect_set(F.struct("place", "dropped", "blank"))).alias("flags"))
             .select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("flags.dropped").alias(cut),
                     F.expr("exists(flags, f -> not f.blank and not f.dropped) or forall(flags, f -> f.blank)")
                     .alias(some)))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.split(text, "\n", -1)
    kept = F.concat_ws("\n", F.filter(lines, lambda x, i: ~F.get(F.col(cut), i)))
    names = docs.columns
    joined = docs.join(flags, (F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))) == F.col(doc))
                       & (F.xxhash64(text) == F.col(row)))
    clean = F.when(F.exists(cut, lambda d: d), kept).otherwise(F.col(f"`{text_col}`"))
    columns = [clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if counts:
        return joined.select(*columns, F.size(cut).cast("long").alias(counts[0]),
                             F.size(F.filter(cut, lambda d: d)).cast("long").alias(counts[1]))
    return joined.where(F.col(some)).select(*columns)
