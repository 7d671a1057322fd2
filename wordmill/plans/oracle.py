"""DuckDB SQL for the registered queries (the independent correctness oracle).

RE2 (DuckDB) has no look-around, so Python's Unicode ``\\b`` is emulated with
consumed neighbour characters that are written back by the replacement; this is
exact for matches that are not directly adjacent to each other.
"""

from __future__ import annotations

from wordmill.functions import patterns as P
from wordmill.operators import filters as FL

WS = "[" + P.PY_WS_CLASS + "]"
W = r"\p{L}\p{N}_"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def nl2() -> str:
    return "chr(10) || chr(10)"


def normalize_sql(x: str, apply_nfc: bool = True) -> str:
    t = f"nfc_normalize({x})" if apply_nfc else x
    t = f"regexp_replace({t}, {q(P.TAG)}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(P.ENTITY)}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(P.NEWLINE_RUN)}, {nl2()}, 'g')"
    t = f"regexp_replace({t}, {q(P.SPACE_TAB_RUN)}, ' ', 'g')"
    return strip_sql(t)


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q(P.STRIP_EDGES)}, '', 'g')"


def count_sql(x: str, cls: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, {q(cls)}, '', 'g')))"


def letters_sql(x: str) -> str:
    return count_sql(x, r"\p{L}")


def script_sql(x: str, block: str) -> str:
    return count_sql(x, "[" + block + "]")


def words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda w: w <> '')"


# Phone: \b(?:\+977|977|0)?[- ]?(?:98|97|96|01|061|021)\d{6,8}\b, split by the
# kind of its first character so the start boundary can be tested.
_NUM = r"(?:98|97|96|01|061|021)\p{Nd}{6,8}"
RE2_PHONE = (r"(?:(\A|[^" + W + r"])(?:(?:977|0)[- ]?)?" + _NUM
             + r"|([" + W + r"])(?:\+977[- ]?|[- ])" + _NUM + r")(\z|[^" + W + r"])")
RE2_EMAIL = (r"(?:(\A|[^" + W + r"])[A-Za-z0-9]|([" + W + r"])[._%+-])"
             r"[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Z|a-z]+"
             r"(?:[A-Za-z](\z|[^" + W + r"])|\|([" + W + r"]))")


def scrub_phone_sql(x: str) -> str:
    once = f"regexp_replace({x}, {q(RE2_PHONE)}, '\\1\\2[PHONE]\\3', 'g')"
    return f"regexp_replace({once}, {q(RE2_PHONE)}, '\\1\\2[PHONE]\\3', 'g')"


def scrub_email_sql(x: str) -> str:
    once = f"regexp_replace({x}, {q(RE2_EMAIL)}, '\\1\\2[EMAIL]\\3\\4', 'g')"
    return f"regexp_replace({once}, {q(RE2_EMAIL)}, '\\1\\2[EMAIL]\\3\\4', 'g')"


def reject_reason_sql(t: str, block: str, threshold: float = FL.SCRIPT_THRESHOLD) -> str:
    n = f"length({t})"
    letters = letters_sql(t)
    w = words_sql(t)
    r = FL.REASONS
    return (f"CASE WHEN {n} = 0 OR {letters} = 0 OR {script_sql(t, block)} / {letters} < {threshold} "
            f"THEN {q(r[0])} "
            f"WHEN {n} < {FL.MIN_CHARS} THEN {q(r[1])} "
            f"WHEN len({w}) > {FL.REPETITION_MIN_WORDS} AND "
            f"len(list_distinct({w})) / len({w}) < {FL.MIN_UNIQUE_RATIO} THEN {q(r[2])} "
            f"WHEN {letters} / greatest({n}, 1) < {FL.MIN_LETTER_DENSITY} THEN {q(r[3])} "
            f"END")


def cleaned_cte(src: str, keep: str, block: str, name: str = "cleaned") -> str:
    """CTEs ``{name}_norm``, ``{name}_ann`` and ``{name}`` (keep cols + text + hash)."""
    return (f"{name}_norm AS (SELECT {keep}, {normalize_sql('text')} AS t FROM {src}),\n"
            f"{name}_ann AS (SELECT {keep}, t, {reject_reason_sql('t', block)} AS reject_reason "
            f"FROM {name}_norm),\n"
            f"{name}_scrub AS (SELECT {keep}, {scrub_email_sql(scrub_phone_sql('t'))} AS text "
            f"FROM {name}_ann WHERE reject_reason IS NULL),\n"
            f"{name} AS (SELECT {keep}, text, md5(text) AS hash FROM {name}_scrub)")


def dedup_cte(src: str, scope: str, order: str, name: str = "deduped") -> str:
    return (f"{name} AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {scope}, hash ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1)")


# ------------------------------------------------------------------ near-dedup
def neardup_ctes(src: str, key_cols: str, order_cols: str, perms: int | None = None) -> str:
    """CTEs over ``src`` (key_cols + text): nd_w, nd_sh, nd_sig, nd_bands, nd_ranked, nd_walk.

    nd_sig has the first ``perms`` values of the signature, by default those that banding reads.
    """
    from wordmill.operators import neardup as N
    w = words_sql("text")
    lane = 1 << N.LANE_BITS
    mins = ", ".join(f"min(((h // {lane}) * {a1} + (h % {lane}) * {a2} + {b}) % {N.MERSENNE_P}) AS m{i}"
                     for i, (a1, a2, b) in enumerate(N.PERMS[:N.USED if perms is None else perms]))
    keys = ", ".join(
        "concat_ws(',', " + ", ".join(f"CAST(m{j * N.ROWS + k} AS VARCHAR)" for k in range(N.ROWS))
        + f") AS k{j}" for j in range(N.BANDS))
    keylist = "[" + ", ".join(f"'{j}:' || k{j}" for j in range(N.BANDS)) + "]"
    return (
        f"nd_w AS (SELECT {key_cols}, {w} AS w FROM {src}),\n"
        f"nd_sh AS (SELECT {key_cols}, i - 1 AS pos, array_to_string(w[i:i + {N.SHINGLE_WORDS - 1}], ' ') "
        f"AS shingle FROM (SELECT {key_cols}, w, unnest(generate_series(1, len(w) - "
        f"{N.SHINGLE_WORDS - 1})) AS i FROM nd_w WHERE len(w) >= {N.MIN_WORDS})),\n"
        f"nd_h AS (SELECT {key_cols}, ('0x' || substr(md5(shingle), 1, {N.HASH_HEX}))::BIGINT "
        f"AS h FROM nd_sh),\n"
        f"nd_sig AS (SELECT {key_cols}, {mins} FROM nd_h GROUP BY {key_cols}),\n"
        f"nd_bands AS (SELECT {key_cols}, {keys} FROM nd_sig),\n"
        f"nd_ranked AS (SELECT row_number() OVER (ORDER BY {order_cols}) AS r, {key_cols}, "
        f"{keylist} AS keys FROM nd_bands),\n"
        f"nd_walk AS (SELECT 0::BIGINT AS r, []::VARCHAR[] AS kept_keys, false AS kept "
        f"UNION ALL SELECT n.r, CASE WHEN list_has_any(p.kept_keys, n.keys) THEN p.kept_keys "
        f"ELSE list_concat(p.kept_keys, n.keys) END, NOT list_has_any(p.kept_keys, n.keys) "
        f"FROM nd_walk p JOIN nd_ranked n ON n.r = p.r + 1)")


# ------------------------------------------------------------------ tokenizer (K1-K4)
def pretokens_sql(x: str) -> str:
    return f"regexp_extract_all({x}, {q(P.RE2_PRETOKEN)})"


def chars_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


# ------------------------------------------------------------------ trained tokenizer
def bpe_ctes(train: str, others: tuple[str, ...], vocab_size: int, min_frequency: int, specials: int) -> str:
    """CTEs that learn the merges of ``train`` one at a time and encode all words on the way.

    ``others`` name tables whose words are encoded too, but not counted. A word is a string
    of symbols; a learned symbol is a private-use character, numbered by creation, so the
    smallest of equally frequent pairs is the smallest string. Each step merges the best
    pair in all words; the last state of a word is its encoding. Afterwards: ``merged``
    (rank, l, r), ``token`` (sym, str, id) and ``coded`` (word, freq, ids, n).
    """
    words = " UNION ALL ".join(f"SELECT unnest({pretokens_sql('text')}) AS word, {int(k == 0)} AS f FROM {t}"
                               for k, t in enumerate((train, *others)))

    def expand(c: str) -> str:
        return f"coalesce((SELECT max(str) FROM known WHERE sym = {c}), {c})"
    return f"""bwf AS (SELECT word, sum(f)::BIGINT AS freq FROM ({words}) GROUP BY word),
balpha AS (SELECT ch, {specials} - 1 + row_number() OVER (ORDER BY ch) AS id
           FROM (SELECT DISTINCT unnest({chars_sql('word')}) AS ch FROM bwf WHERE freq > 0)),
bpe(id, s, freq, sym, str, n) USING KEY (id) AS (
  SELECT row_number() OVER (ORDER BY word), word, freq, NULL::VARCHAR, word, {specials} + (SELECT count(*) FROM balpha)
  FROM bwf
  UNION
  (WITH best AS MATERIALIZED (
     SELECT p, sum(freq) AS c, any_value(n) AS n FROM (
       SELECT substr(s, i, 2) AS p, freq, n FROM (
         SELECT s, freq, n, unnest(range(1, length(s))) AS i FROM bpe WHERE id > 0 AND freq > 0 AND n < {vocab_size}))
     GROUP BY p HAVING sum(freq) >= {min_frequency} ORDER BY c DESC, p LIMIT 1),
   known AS MATERIALIZED (SELECT sym, str FROM recurring.bpe WHERE id < 0),
   made AS MATERIALIZED (
     SELECT p, n, (SELECT count(*) FROM known) AS m, (SELECT count(DISTINCT sym) FROM known) AS k,
            {expand('substr(p, 1, 1)')} || {expand('substr(p, 2, 1)')} AS str FROM best),
   step AS MATERIALIZED (
     SELECT p, m, str, coalesce((SELECT max(sym) FROM known WHERE known.str = made.str), chr((983040 + k)::INT)) AS sym,
            n + CASE WHEN made.str IN (SELECT str FROM known) THEN 0 ELSE 1 END AS n FROM made)
   SELECT b.id, replace(b.s, x.p, x.sym), b.freq, NULL, b.str, x.n FROM bpe b, step x WHERE b.id > 0
   UNION ALL SELECT -(m + 1), p, 0, sym, str, n FROM step)),
token AS (SELECT ch AS sym, ch AS str, id FROM balpha
          UNION ALL SELECT sym, any_value(str), min(n) - 1 FROM bpe WHERE id < 0 GROUP BY sym),
merged AS (SELECT (-b.id - 1)::INTEGER AS rank, l.str AS "left", r.str AS "right" FROM bpe b
           JOIN token l ON l.sym = substr(b.s, 1, 1) JOIN token r ON r.sym = substr(b.s, 2, 1) WHERE b.id < 0),
coded AS (SELECT any_value(word) AS word, any_value(freq) AS freq, list(coalesce(t.id, 0)::INTEGER ORDER BY i) AS ids
          FROM (SELECT id AS k, str AS word, freq, s, unnest(range(1, length(s) + 1)) AS i FROM bpe WHERE id > 0) w
          LEFT JOIN token t ON t.sym = substr(s, i, 1) GROUP BY k)"""


def bpe_docs_sql(src: str, key: str) -> str:
    """(key, input_ids) of the texts of ``src`` from ``coded``."""
    return (f"SELECT d.{key}, coalesce(flatten(list(c.ids ORDER BY d.i) FILTER (c.ids IS NOT NULL)), []::INTEGER[]) AS input_ids FROM ("
            f"SELECT {key}, unnest(CASE WHEN len(w) > 0 THEN w ELSE [NULL] END) AS word, "
            f"unnest(range(1, greatest(len(w), 1) + 1)) AS i FROM (SELECT {key}, {pretokens_sql('text')} AS w FROM {src})) d "
            f"LEFT JOIN coded c ON c.word = d.word GROUP BY d.{key}")
