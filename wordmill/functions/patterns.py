"""Fixed regular-expression values.

Spark evaluates these with java.util.regex; the DuckDB oracle uses RE2, so the
oracle forms are kept next to the Spark forms. Character classes are spelled with
``\\x{...}`` escapes, which both engines accept.
"""

# --- fixed values (must equal the source behaviour) -------------------------
# Python str.split()/str.strip() whitespace: 29 code points.
PY_WS_CODEPOINTS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
                    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
                    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
PY_WS_CLASS = (r"\x{09}-\x{0D}\x{1C}-\x{1F}\x{20}\x{85}\x{A0}\x{1680}"
               r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Unicode White_Space property (no U+001C..U+001F): the pre-tokenizer's \s.
UNI_WS_CLASS = (r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}"
                r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Devanagari block, the default script of the language filter.
DEVANAGARI = r"\x{0900}-\x{097F}"
# Latin letters (ASCII + Latin-1 Supplement .. Latin Extended-B).
LATIN = r"A-Za-z\x{C0}-\x{24F}"
# Phone and e-mail patterns as written for Python's `re` (documentation only;
# the engine forms below are derived by hand).
PY_PHONE = r"\b(?:\+977|977|0)?[- ]?(?:98|97|96|01|061|021)\d{6,8}\b"
PY_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_TOKEN = "[PHONE]"
EMAIL_TOKEN = "[EMAIL]"
# -----------------------------------------------------------------------------

PY_WS_CHARS = "".join(chr(c) for c in PY_WS_CODEPOINTS)
WS = "[" + PY_WS_CLASS + "]"
WS_RUN = WS + "+"


def _singles(codes) -> str:
    """Characters one by one: those of a class below U+0100 become one bit set in Java, unlike ranges."""
    return "".join(rf"\x{{{c:X}}}" for c in codes)


# The same class for Java alone, whose test of a character is short: the ranges are looked at only behind U+1680.
JAVA_WS = ("[" + _singles(c for c in PY_WS_CODEPOINTS if c < 0x100) + r"[\x{1680}-\x{3000}&&["
           + _singles(c for c in PY_WS_CODEPOINTS if c >= 0x100) + "]]]")
JAVA_WS_RUN = JAVA_WS + "+"

# Python's \w on str is exactly [\p{L}\p{N}_]; \d is \p{Nd} (so it matches
# Devanagari digits, which Java's plain \d does not).
PY_WORD = r"[\p{L}\p{N}_]"
PY_NONWORD = r"[^\p{L}\p{N}_]"
# Python \b written with lookarounds (Java's own \b changed meaning across JDKs).
PY_BOUNDARY = (r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])"
               r"|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))")

JAVA_PHONE = (PY_BOUNDARY + r"(?:\+977|977|0)?[- ]?(?:98|97|96|01|061|021)\p{Nd}{6,8}"
              + PY_BOUNDARY)
JAVA_EMAIL = (PY_BOUNDARY + r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
              + PY_BOUNDARY)

TAG = r"<[^>]+>"
ENTITY = r"&[a-zA-Z]+;"
NEWLINE_RUN = r"\n{3,}"
SPACE_TAB_RUN = r"[ \t]+"
# Same replacement result as SPACE_TAB_RUN -> " ", but single spaces (the common
# case) are not matches, so most texts are returned untouched.
SPACE_TAB_CHANGE = r"(?: [ \t]|\t)[ \t]*"
STRIP_EDGES = r"\A" + WS_RUN + r"|" + WS_RUN + r"\z"
LETTER = r"\p{L}"
NON_LETTER_RUN = r"\P{L}+"
# The same for Java alone, ASCII by one bit set.
JAVA_NON_LETTER_RUN = ("[" + _singles(c for c in range(0x80) if not chr(c).isalpha()) + r"[\x{80}-\x{10FFFF}&&[\P{L}]]]+")
PHONE_HINT = r"\p{Nd}{6}"      # a phone match needs six consecutive digits

# Pre-tokenizer (whitespace + punctuation split): \w+ | [^\w\s]+ with the
# Unicode \w of the UTS#18 definition (alphabetic, marks, decimal digits,
# connector punctuation, joiners).
TOK_WORD_CLASS = r"\p{IsAlphabetic}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}"
PRETOKEN = "[" + TOK_WORD_CLASS + "]+|[^" + TOK_WORD_CLASS + UNI_WS_CLASS + "]+"
# The same for Java alone: an ASCII character is decided by one bit set, properties are asked of others.
_ASCII_WORD = [c for c in range(0x80) if chr(c).isalnum() or c == 0x5F]
_ASCII_OTHER = [c for c in range(0x80) if c not in _ASCII_WORD and not (0x09 <= c <= 0x0D or c == 0x20)]
_BEYOND = r"[\x{80}-\x{10FFFF}&&["
JAVA_PRETOKEN = ("[" + _singles(_ASCII_WORD) + _BEYOND + TOK_WORD_CLASS + "]]]+|["
                 + _singles(_ASCII_OTHER) + _BEYOND + "^" + TOK_WORD_CLASS + UNI_WS_CLASS + "]]]+")
# RE2 has no Alphabetic property; letters + marks agree on the fixtures.
RE2_TOK_WORD_CLASS = r"\p{L}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}"
RE2_PRETOKEN = ("[" + RE2_TOK_WORD_CLASS + "]+|[^" + RE2_TOK_WORD_CLASS
                + UNI_WS_CLASS + "]+")


def block_class(block: str) -> str:
    """A character class from a range body such as DEVANAGARI or LATIN."""
    return "[" + block + "]"
