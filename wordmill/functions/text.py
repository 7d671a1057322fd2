"""Per-document text scalars (T1-T14) as Spark Column expressions.

All of them are JVM-side built-ins. Regular expressions, ``split`` and ``md5`` fuse
into whole-stage codegen; higher-order array functions (``transform``, ``let``) and
``reflect`` are interpreted. Unicode NFC has no SQL builtin; it calls ICU4J (shipped with Spark) through
``reflect`` — still JVM-side, no Python worker.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions import patterns as P


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- T1 -----------------------------------------------------------------------
def nfc(col) -> Column:
    """Unicode NFC (T1). ICU's ``Normalizer.compose(s, compat=false)`` is NFC.

    Pure ASCII text is its own NFC and never reaches the reflective call; null stays
    null. ``reflect`` is interpreted and non-deterministic to Catalyst, which keeps
    later filters from being pushed below it, so the text is normalised once.
    """
    c = _c(col)
    composed = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"),
                               F.lit("compose"), c, F.lit(False))
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


# --- T2..T5 -----------------------------------------------------------------
def strip_tags(col) -> Column:
    """Every ``<...>`` (no '>' inside, may span lines) becomes one space."""
    return F.regexp_replace(_c(col), P.TAG, " ")


def strip_entities(col) -> Column:
    """Named entities ``&name;`` become one space (not decoded)."""
    return F.regexp_replace(_c(col), P.ENTITY, " ")


def py_strip(col) -> Column:
    """T5: Python ``str.strip()`` (29 whitespace code points), a linear ``btrim``."""
    return F.call_function("btrim", _c(col), F.lit(P.PY_WS_CHARS))


def collapse_ws(col) -> Column:
    """T4 + T5: ``\\n{3,}`` -> ``\\n\\n``, runs of space/tab -> one space, strip."""
    c = F.regexp_replace(_c(col), P.NEWLINE_RUN, "\n\n")
    c = F.regexp_replace(c, P.SPACE_TAB_CHANGE, " ")
    return py_strip(c)


def normalize_text(col, apply_nfc: bool = True) -> Column:
    """T1 -> T2 -> T3 -> T4 -> T5 in the fixed order.

    Patterns run only on texts that hold what they need: T2 and T3 a ``<`` or ``&``, T4 a tab, two
    spaces or three newlines (or a space that T2 or T3 put in). NFC makes none of these characters,
    so the text is looked at as it came, by byte searches; one branch is evaluated per text.
    """
    t = _c(col)
    c = nfc(t) if apply_nfc else t

    def holds(*parts):
        return functools.reduce(operator.or_, [F.contains(t, F.lit(p)) for p in parts])

    return (F.when(holds("<", "&"), collapse_ws(strip_entities(strip_tags(c))))
            .when(holds("\t", "  ", "\n\n\n"), collapse_ws(c)).otherwise(py_strip(c)))


# --- T6..T8 -----------------------------------------------------------------
def scrub_phone(col) -> Column:
    """Phone numbers -> [PHONE] (Python \\b and \\d semantics).

    The look-around pattern runs only on texts holding six consecutive digits.
    """
    c = _c(col)
    return F.when(c.rlike(P.PHONE_HINT), F.regexp_replace(c, P.JAVA_PHONE, P.PHONE_TOKEN)
                  ).otherwise(c)


def scrub_email(col) -> Column:
    """E-mail addresses -> [EMAIL]; runs after T6, only on texts with an '@'."""
    c = _c(col)
    return F.when(F.instr(c, "@") > 0, F.regexp_replace(c, P.JAVA_EMAIL, P.EMAIL_TOKEN)
                  ).otherwise(c)


def scrub_pii(col) -> Column:
    return scrub_email(scrub_phone(col))


def content_hash(col) -> Column:
    """MD5 hex of the UTF-8 text."""
    return F.md5(_c(col))


# --- T9..T14 ----------------------------------------------------------------
def script_count(col, block: str = P.DEVANAGARI) -> Column:
    """Characters inside a Unicode block (default Devanagari U+0900-U+097F).

    Length minus the length after deleting runs *inside* the block: one match
    per run instead of one string per character (``regexp_count`` is rewritten to
    ``size(regexp_extract_all(...))``), and a positive class is matched much
    faster by java.util.regex than a negated range class.
    """
    c = _c(col)
    return F.length(c) - F.length(F.regexp_replace(c, "[" + block + "]+", ""))


def letter_count(col) -> Column:
    """Characters with ``str.isalpha()`` true (Unicode category L*)."""
    return F.length(F.regexp_replace(_c(col), P.JAVA_NON_LETTER_RUN, ""))


def char_length(col) -> Column:
    """Length in code points."""
    return F.length(_c(col))


def words(col) -> Column:
    """``str.split()`` — whitespace split, no empty items.

    Only the first and last item of the split can be empty; ``array_remove``
    drops them without a lambda.
    """
    return F.array_remove(F.split(_c(col), P.JAVA_WS_RUN), "")


def word_count(col) -> Column:
    return F.size(words(col))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (a lambda).

    Catalyst substitutes aliases when it pushes a filter through a projection, and
    filters get no common-subexpression elimination; binding the value to a
    lambda variable keeps it computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def unique_word_ratio(words_col) -> Column:
    """Distinct words / words (null for an empty list)."""
    w = _c(words_col)
    return F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w))


def preview(col, n: int = 70, ellipsis: bool = True) -> Column:
    """First ``n`` characters, with ``...`` appended only if cut."""
    c = _c(col)
    cut = F.substring(c, 1, n)
    if not ellipsis:
        return cut
    return F.when(F.length(c) > n, F.concat(cut, F.lit("..."))).otherwise(c)


def pretokens(col) -> Column:
    """K1: whitespace + punctuation pre-tokenizer, ``\\w+|[^\\w\\s]+``."""
    return F.regexp_extract_all(_c(col), F.lit(P.JAVA_PRETOKEN), F.lit(0))
