"""Document filters F1-F4 and the first-reject-reason column used by F5/F7.

Every filter is a Column predicate, so a chain of them becomes one Filter
node in the plan. ``reject_reason`` binds its measures in a lambda, which is interpreted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions import patterns as P
from wordmill.functions import text as T

# --- fixed values (thresholds of the source filters) -------------------------
SCRIPT_THRESHOLD = 0.3      # F1: script chars / letters must be >= this
MIN_CHARS = 50              # F2: shorter texts are rejected
REPETITION_MIN_WORDS = 10   # F3: only texts with more words are checked
MIN_UNIQUE_RATIO = 0.2      # F3: distinct/total words below this is rejected
MIN_LETTER_DENSITY = 0.3    # F4: letters/length below this is rejected
# Reject reasons, in the order the source evaluates the filters.
REASONS = ("script", "too_short", "repetitive", "low_letter_density")
# -----------------------------------------------------------------------------


def passes_script(t: Column, block: str = P.DEVANAGARI,
                  threshold: float = SCRIPT_THRESHOLD) -> Column:
    """non-blank, has letters, and script chars / letters >= threshold."""
    letters = T.letter_count(t)
    return ((T.char_length(T.py_strip(t)) > 0) & (letters > 0)
            & (T.script_count(t, block) / letters >= threshold))


def passes_min_length(t: Column, min_chars: int = MIN_CHARS) -> Column:
    """at least ``min_chars`` code points after stripping."""
    return T.char_length(T.py_strip(t)) >= min_chars


def passes_repetition(t: Column) -> Column:
    """texts with more than 10 words need distinct/total >= 0.2."""
    w = T.words(t)
    return ~((F.size(w) > REPETITION_MIN_WORDS)
             & (F.size(F.array_distinct(w)) / F.size(w) < MIN_UNIQUE_RATIO))


def passes_letter_density(t: Column) -> Column:
    """letters / max(length, 1) >= 0.3."""
    return T.letter_count(t) / F.greatest(T.char_length(t), F.lit(1)) >= MIN_LETTER_DENSITY


def measures(t: Column, block: str = P.DEVANAGARI) -> Column:
    """One struct with every measure the filters need, each computed once."""
    return T.let(T.words(t), lambda w: F.struct(
        T.char_length(t).alias("n"), T.letter_count(t).alias("letters"), T.script_count(t, block).alias("script"),
        F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct")))


def reject_reason(t: Column, block: str = P.DEVANAGARI,
                  threshold: float = SCRIPT_THRESHOLD) -> Column:
    """The first failing filter in source order, or null when the text passes.

    Input ``t`` must already be normalised (T1-T5), so it is stripped. The
    measures are bound once (``let``) and the CASE tests them in source order.
    """
    def verdict(m):
        n, letters = m["n"], m["letters"]
        return (F.when((n == 0) | (letters == 0) | (m["script"] / letters < threshold),
                       F.lit(REASONS[0]))
                 .when(n < MIN_CHARS, F.lit(REASONS[1]))
                 .when((m["n_words"] > REPETITION_MIN_WORDS)
                       & (m["n_distinct"] / m["n_words"] < MIN_UNIQUE_RATIO), F.lit(REASONS[2]))
                 .when(letters / F.greatest(n, F.lit(1)) < MIN_LETTER_DENSITY, F.lit(REASONS[3])))
    return T.let(measures(t, block), verdict)
