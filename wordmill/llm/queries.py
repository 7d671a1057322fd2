"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP1_SQL = f"""
WITH i AS (SELECT item_id, coalesce(regexp_extract_all({LOWER}, '{WORD}'), []) AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS key
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{WORD}'), []) AS w FROM documents),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS key
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN sizes ON len(w) >= n)),
hit AS (SELECT doc_id, item_id, k, win.n AS n FROM dw JOIN win ON dw.n = win.n AND dw.key = win.key),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontamination", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.decontaminate import contamination
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = """
WITH RECURSIVE l AS (
  SELECT doc_id, place, parts[place + 1] AS raw,
         trim(regexp_replace(parts[place + 1], '[\\x09-\\x0D\\x20]+', ' ', 'g'), ' ') AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents)),
k AS (SELECT line, min(doc_id::HUGEINT * 1099511627776 + place) AS rank, length(line) AS n
      FROM l WHERE line <> '' GROUP BY line),
v AS (SELECT rank, n, spot, hash(substr(line, 1, spot - 1) || substr(line, spot + 1)) AS h
      FROM (SELECT rank, line, n, unnest(range(1, n + 1)) AS spot FROM k WHERE n >= 16)),
w AS (SELECT rank, n, hash(line) AS h FROM k WHERE n >= 16),
near AS (
  SELECT v.rank FROM v JOIN (SELECT n, spot, h, min(rank) AS first FROM v GROUP BY ALL) b USING (n, spot, h) WHERE b.first < v.rank
  UNION SELECT v.rank FROM v JOIN w ON w.n = v.n - 1 AND w.h = v.h WHERE w.rank < v.rank
  UNION SELECT w.rank FROM v JOIN w ON w.n = v.n - 1 AND w.h = v.h WHERE v.rank < w.rank),
d AS (SELECT l.doc_id, l.place, l.raw,
             l.line <> '' AND (l.doc_id::HUGEINT * 1099511627776 + l.place > k.rank OR near.rank IS NOT NULL) AS dropped
      FROM l LEFT JOIN k ON k.line = l.line LEFT JOIN near ON near.rank = k.rank)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT coalesce(dropped, false)), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


@query("op2_line_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.line_dedup import drop_duplicate_lines
    docs = drop_duplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                counts=("n_lines", "n_dropped"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from wordmill.llm import language_id as L
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = L.train(docs.where(~L.held_out()), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return (L.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", L.held_out().alias("held_out"), "lang_pred", "score"))


OP4_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, kind, rank, unnest(range(1, len(found) + 1)) AS k, gaps, found, vals FROM (
    SELECT doc_id, 'assign' AS kind, 0 AS rank, string_split_regex(text, '{assign}') AS gaps,
           regexp_extract_all(text, '{assign}', 0) AS found, regexp_extract_all(text, '{assign}', 2) AS vals FROM t
    UNION ALL SELECT doc_id, 'access', 1, string_split_regex(text, '{access}'), regexp_extract_all(text, '{access}', 0),
           regexp_extract_all(text, '{access}', 0) FROM t
    UNION ALL SELECT doc_id, 'hex', 2, string_split_regex(text, '{hex}'), regexp_extract_all(text, '{hex}', 0),
           regexp_extract_all(text, '{hex}', 0) FROM t
    UNION ALL SELECT doc_id, 'random', 3, string_split_regex(text, '{candidate}'),
           regexp_extract_all(text, '{candidate}', 0), regexp_extract_all(text, '{candidate}', 0) FROM t)),
s AS (SELECT * FROM (
        SELECT doc_id, kind, rank, vals[k] AS val, ends - length(found[k]) AS start, ends AS stop
        FROM (SELECT *, sum(length(gaps[k]) + length(found[k])) OVER (PARTITION BY doc_id, kind ORDER BY k) AS ends FROM m))
      WHERE kind <> 'assign' OR length(val) >= 8),
known AS (SELECT DISTINCT val FROM s WHERE rank < 3 AND length(val) >= 2),
size AS (SELECT count(*) AS n FROM t),
words AS (SELECT DISTINCT val FROM (
            SELECT unnest(regexp_extract_all(text, '{identifier}', 0)) AS val FROM t, size
            WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT
                  < CASE WHEN n <= 2000 THEN 268435456 ELSE (2000 * 268435456) // n END)
          WHERE length(val) < 20 AND val NOT IN (SELECT val FROM known)),
pairs AS (
  SELECT label, pair, count(*) AS n FROM (
    SELECT label, substr(val, i, 2) AS pair FROM (
      SELECT 1 AS label, val, unnest(range(1, length(val))) AS i FROM known
      UNION ALL SELECT 0, val, unnest(range(1, length(val))) FROM words))
  WHERE regexp_full_match(pair, '[A-Za-z0-9+/_-][A-Za-z0-9+/_-]') GROUP BY ALL),
letter AS (SELECT unnest(string_split('{alphabet}', '')) AS c),
cell AS (
  SELECT a.c || b.c AS pair, side.label AS label, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY a.c, side.label) AS total,
         sum(coalesce(n, 0)) OVER (PARTITION BY b.c, side.label) AS often, sum(coalesce(n, 0)) OVER (PARTITION BY side.label) AS every
  FROM letter a JOIN letter b ON true JOIN (SELECT unnest([0, 1]) AS label) side ON true LEFT JOIN pairs
       ON pairs.pair = a.c || b.c AND pairs.label = side.label),
ratio AS (SELECT pair, round(1000 * (max(ln((n + 10 * (often + 1) / (every + 66)) / (total + 10))) FILTER (label = 1)
                                     - max(ln((n + 10 * (often + 1) / (every + 66)) / (total + 10))) FILTER (label = 0)))::BIGINT AS w
          FROM cell GROUP BY pair),
scored AS (
  SELECT val FROM (SELECT val, substr(val, i, 2) AS pair FROM (
      SELECT val, unnest(range(1, length(val))) AS i FROM (SELECT DISTINCT val FROM s WHERE rank = 3)))
  LEFT JOIN ratio USING (pair) GROUP BY val HAVING sum(coalesce(w, 0)) >= 500 * (length(val) - 1)),
spans AS (
  SELECT * FROM s WHERE rank < 3
  UNION ALL SELECT * FROM s WHERE rank = 3 AND val IN (SELECT val FROM scored)
    AND NOT EXISTS (SELECT 1 FROM s b WHERE b.rank < 3 AND b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop))
SELECT t.doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
       count(*) FILTER (rank = 2) AS n_hex, count(*) FILTER (rank = 3) AS n_random,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3), ''))
         AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank IS NOT NULL), '') AS spans
FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id
"""


def _op4_sql() -> str:
    from wordmill.llm import secret_scan as S
    sql = OP4_SQL
    for name, value in (("assign", S.ASSIGN), ("access", S.ACCESS), ("hex", S.HEX), ("candidate", S.CANDIDATE),
                        ("identifier", S.IDENTIFIER), ("alphabet", S.ALPHABET)):
        sql = sql.replace("{" + name + "}", value.replace("'", "''"))
    return sql


@query("op4_secret_scan", _op4_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.secret_scan import scan_documents
    return scan_documents(table(spark, sf_dir, "documents")).withColumn("base_sha256", F.sha2("base", 256)).drop("base")


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
           FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
           GROUP BY ALL),
link AS (SELECT x, y, c.n = p.n AND c.n = q.n AS equal FROM common c JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
         WHERE 10 * c.n >= 8 * (p.n + q.n - c.n)),
reach(node, low) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT l.y, r.low FROM reach r JOIN link l ON l.x = r.node WHERE r.low < l.y),
least_ AS (SELECT node, min(low) AS class_id FROM reach GROUP BY node),
many AS (SELECT x, count(*) AS n_links, count(*) FILTER (equal) AS same FROM link GROUP BY x)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, (coalesce(same, 0) + 1)::BIGINT AS n_copies,
       doc_id = class_id AS kept
FROM d JOIN least_ ON node = doc_id LEFT JOIN many ON x = doc_id
"""


@query("op5_ngram_join", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.ngram_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.html_text import extract
    return extract(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.exact_dedup import duplicate_groups
    return duplicate_groups(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from wordmill.llm.bpe_duckdb import round_trip
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN)


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from wordmill.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                        public_tokenizers.PATTERN)


#: The digests of the turns and of the assistant texts; the formatted length follows from the template.
OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
             replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS name FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>') + length(name) + 1 + length(body) + length('<|end|>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op10_chat_formatting", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from wordmill.llm.chat_format import format_conversations, read_back
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return (read_back(format_conversations(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                           public_tokenizers.PATTERN))
            .drop("n_tokens", "n_loss_tokens"))


#: CRC-32 of texts (the table of the reflected polynomial, then byte by byte).
CRC_SQL = """
crc_table AS (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(list_prepend(n, list_transform(range(8), lambda x: 0::BIGINT)),
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
crc AS (
  SELECT s, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                  regexp_extract_all(hex(encode(s)), '..'), lambda h: ('0x' || h)::BIGINT)),
                lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT {text} AS s FROM documents), crc_table)"""

#: Holds where no group exceeds a shard's share and all are packed one by one, as at small sizes.
OP11_SQL = """
WITH RECURSIVE""" + CRC_SQL.replace("{text}", "coalesce(text, '')") + r""",
d AS (SELECT doc_id, coalesce(text, '') AS s, sha256(coalesce(text, '')) AS sha, octet_length(encode(coalesce(text, ''))) + 16 AS size,
             len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\p{L}\p{N}\x00-\x20]')) AS tokens FROM documents),
total AS (SELECT sum(size)::DOUBLE AS b, sum(tokens)::DOUBLE AS t, count(*)::DOUBLE AS r FROM d),
g AS (SELECT sha, sum(size)::DOUBLE * 40 / max(b) AS b, sum(tokens)::DOUBLE * 40 / greatest(max(t), 1.0) AS t, count(*) * 40 / max(r) AS r
      FROM d, total GROUP BY sha),
item AS (SELECT *, row_number() OVER (ORDER BY greatest(b, t, r) DESC, sha) AS k FROM (SELECT sha, g.b, g.t, g.r FROM g)),
run(k, shard, rb, rt, rr) AS (
  SELECT 0::BIGINT, 0::BIGINT, list_transform(range(40), lambda x: 1.0::DOUBLE), list_transform(range(40), lambda x: 1.0::DOUBLE),
         list_transform(range(40), lambda x: 1.0::DOUBLE)
  UNION ALL
  SELECT k, place, list_transform(rb, lambda x, i: CASE WHEN i = place THEN x - b ELSE x END),
         list_transform(rt, lambda x, i: CASE WHEN i = place THEN x - t ELSE x END),
         list_transform(rr, lambda x, i: CASE WHEN i = place THEN x - r ELSE x END)
  FROM (SELECT next_k AS k, b, t, r, rb, rt, rr, list_position(score, list_max(score)) AS place
        FROM (SELECT *, list_transform(range(1, 41), lambda i: b * 4.0 * rb[i] + t * rt[i] + r * rr[i]) AS score
              FROM run JOIN (SELECT k - 1 AS before, k AS next_k, b, t, r FROM item) ON before = run.k))),
put AS (SELECT sha, shard - 1 AS shard FROM run JOIN item USING (k))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM d JOIN put USING (sha) JOIN crc USING (s)
"""


@query("op11_sharding", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm.shards import assign
    return assign(table(spark, sf_dir, "documents"), n_shards=40)


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from wordmill.llm.align import aligned_documents
    return aligned_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


_FIELD = "CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}) || ':' || {x} END"
_LEAF = "sha256(" + " || ".join(_FIELD.replace("{x}", x) for x in (
    "doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "{text}")) + ")"
OP13_SQL = "WITH RECURSIVE" + CRC_SQL.replace("{text}", "doc_id::VARCHAR") + f""",
d AS (SELECT doc_id, source, {_LEAF.replace("{text}", "text")} AS leaf,
             CASE WHEN crc % 5 = 0 THEN {_LEAF.replace("{text}", LOWER)} ELSE {_LEAF.replace("{text}", "text")} END AS version
      FROM documents JOIN crc ON s = doc_id::VARCHAR),
place AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
          FROM d),
low(source, level, pos, n, digest) AS (
  SELECT source, 0, pos, n, leaf FROM place
  UNION ALL
  SELECT source, any_value(level) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY source, pos // 16),
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
             FROM low WHERE n = 1),
high(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY pos // 16),
depth AS (SELECT source, max(level) AS depth FROM low GROUP BY source),
node AS (SELECT source, level, pos, n, digest FROM low WHERE n > 1
         UNION ALL SELECT s.source, depth + level, h.pos, h.n, h.digest
         FROM high h, subroots s JOIN depth ON depth.source IS NOT DISTINCT FROM s.source WHERE h.n > 1),
start AS (SELECT doc_id, p.source, p.pos AS low_pos, s.pos AS high_pos, depth, version FROM place p
          JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN depth ON depth.source IS NOT DISTINCT FROM p.source),
side AS (
  SELECT doc_id, x.source, level, CASE WHEN level < depth THEN low_pos >> (4 * level) ELSE high_pos >> (4 * (level - depth)) END AS spot
  FROM start x JOIN (SELECT DISTINCT source, level FROM node) l ON l.source IS NOT DISTINCT FROM x.source),
kin AS (
  SELECT doc_id, side.level, string_agg(digest, '' ORDER BY pos) FILTER (pos < spot) AS before,
         string_agg(digest, '' ORDER BY pos) FILTER (pos > spot) AS after
  FROM side JOIN node ON node.source IS NOT DISTINCT FROM side.source AND node.level = side.level AND pos // 16 = spot // 16
  GROUP BY doc_id, side.level),
proof AS (SELECT doc_id, sha256(string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY level)) AS proof_sha256
          FROM kin GROUP BY doc_id),
fold(doc_id, level, digest) AS (
  SELECT doc_id, 0, version FROM start
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(coalesce(before, '') || digest || coalesce(after, ''))
  FROM fold f JOIN kin ON kin.doc_id = f.doc_id AND kin.level = f.level),
folded AS (SELECT doc_id, arg_max(digest, level) AS folded_root FROM fold GROUP BY doc_id),
root AS (SELECT digest AS root FROM high WHERE n = 1)
SELECT place.doc_id, leaf, subroots.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM place JOIN folded USING (doc_id) LEFT JOIN proof USING (doc_id)
JOIN subroots ON subroots.source IS NOT DISTINCT FROM place.source, root
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.llm import merkle as M
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return M.audit(M.build(docs, versions={"text": F.when(tampered, lower).otherwise(F.col("text"))}))
