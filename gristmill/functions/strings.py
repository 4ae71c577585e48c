"""String functions (T1-T17) as built-in Column expressions.

Regular expressions are written so that Java (Spark) and RE2 (the SQL oracle)
agree with Python's Unicode-aware ``re``: white space is ``[\\s\\p{Z}]`` and
digits ``\\p{Nd}``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..core import col_of

WS = r"[\s\p{Z}]"


def split_part(c, delim: str, index: int) -> Column:
    """0-based part of ``c`` split on a literal delimiter; NULL when missing."""
    arr = F.split(col_of(c), re.escape(delim))
    return F.try_element_at(arr, F.lit(index + 1))


def slice_fixed(c, start: int, length: int | None = None) -> Column:
    """Python-style ``s[start:start+length]`` (0-based)."""
    c = col_of(c)
    if length is None:
        return F.substring(c, start + 1, 1 << 30)
    return F.substring(c, start + 1, length)


def extract_first(c, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (group ``group``), NULL when none."""
    return F.nullif(F.regexp_extract(col_of(c), pattern, group), F.lit(""))


def tokens(c) -> Column:
    """White-space tokens of a string (``str.split()``): no empty tokens."""
    return F.filter(F.split(col_of(c), WS + "+"), lambda t: t != "")


def word_count(c) -> Column:
    """``len(text.split())``; NULL text counts 0."""
    return F.coalesce(F.size(tokens(c)), F.lit(0))


def first_token_or(c, default: str = "No") -> Column:
    """First token when there are at least two tokens, else ``default`` (T5)."""
    t = tokens(c)
    return F.when(F.coalesce(F.size(t), F.lit(0)) > 1, F.element_at(t, 1)).otherwise(F.lit(default))


def last_token_or(c, default: str = "0") -> Column:
    """Last token, or ``default`` for NULL / blank text (T5)."""
    t = tokens(c)
    return F.when(F.coalesce(F.size(t), F.lit(0)) > 0, F.element_at(t, -1)).otherwise(F.lit(default))


def code_list_letter_number(c, missing: str = "No") -> tuple[Column, Column]:
    """Multi-token code parse.

    One token: (first char, int of the rest or 0); ``missing`` -> ("N", -1).
    Several tokens: ("F", 0) if any token starts with F, else (letter of the last
    token, integer mean of the numbers, each empty number counting 0).
    """
    s = F.coalesce(col_of(c), F.lit(missing))
    t = tokens(s)
    n = F.size(t)
    nums = F.transform(t, lambda x: F.coalesce(F.substring(x, 2, 1 << 30).try_cast("long"), F.lit(0)))
    total = F.aggregate(nums, F.lit(0).cast("long"), lambda a, x: a + x)
    any_f = F.exists(t, lambda x: F.substring(x, 1, 1) == "F")
    last = F.element_at(t, -1)
    single_missing = (n < 2) & (F.lower(last) == F.lit(missing.lower()))
    letter = (F.when(single_missing, F.lit("N"))
               .when(n < 2, F.substring(last, 1, 1))
               .when(any_f, F.lit("F"))
               .otherwise(F.substring(last, 1, 1)))
    number = (F.when(single_missing, F.lit(-1).cast("long"))
               .when(n < 2, F.element_at(nums, -1))
               .when(any_f, F.lit(0).cast("long"))
               .otherwise((total / n).cast("long")))
    return letter, number


def phrase_to_number(c) -> Column:
    """Duration phrase: ``< 1 year`` -> 0.5, ``10+ years`` -> 10.5, NULL -> NULL,
    ``n years`` -> n (T7)."""
    tok = F.element_at(tokens(col_of(c)), 1)
    return (F.when(tok == "<", F.lit(0.5))
             .when(tok == "10+", F.lit(10.5))
             .otherwise(tok.try_cast("double")))


def normalise(c) -> Column:
    """Lower-case and trim."""
    return F.lower(F.trim(col_of(c)))


def concat_keys(*cols, sep: str = "_", null: str = "nan") -> Column:
    """Interaction key of several columns (T9); a NULL part shows as ``null``, so
    it keeps its place.  With an empty ``sep`` parts must have fixed widths."""
    return F.concat_ws(sep, *[F.coalesce(col_of(x).cast("string"), F.lit(null)) for x in cols])


def has_repeated_chars(c) -> Column:
    """1 if some character occurs twice."""
    s = col_of(c).cast("string")
    return (F.size(F.array_distinct(F.split(s, ""))) < F.length(s)).cast("int")


def is_palindrome(c) -> Column:
    """1 if the text reads the same backwards."""
    s = col_of(c).cast("string")
    return (s == F.reverse(s)).cast("int")


# Three-digit ascending and descending runs.
DIGIT_RUNS = ["123", "234", "345", "456", "567", "678", "789",
              "987", "876", "765", "654", "543", "432", "321"]


def has_digit_run(c) -> Column:
    """1 if the zero-padded (to 3) number text holds a 3-digit run."""
    s = col_of(c).cast("string")
    padded = F.when(F.length(s) < 3, F.lpad(s, 3, "0")).otherwise(s)
    return padded.rlike("|".join(DIGIT_RUNS)).cast("int")


def is_round_or_patterned(n) -> Column:
    """A number of up to three digits that stands out: one digit, a round ten or
    hundred, a three-digit run, or a last digit equal to the first (P12)."""
    n = col_of(n)
    hundreds, last = F.floor(n / 100), n % 10
    one = (n >= 1) & (n <= 9)
    round_ten = (n >= 10) & (n <= 90) & (last == 0)
    round_hundred = (n >= 100) & (n <= 900) & (n % 100 == 0)
    mirrored = (n >= 100) & (n <= 999) & (hundreds == last)
    run = (n >= 100) & (n <= 999) & (has_digit_run(n) == 1)
    return one | round_ten | round_hundred | mirrored | run


def is_mirrored_letters(c, alphabet: str) -> Column:
    """Three letters of ``alphabet``, the first equal to the third."""
    c = col_of(c)
    return c.rlike(f"^[{alphabet}]{{3}}$") & (F.substring(c, 1, 1) == F.substring(c, 3, 1))


# Symbol -> word replacements of the math-text cleaner, in order.
MATH_SYMBOLS = [
    ("$", " dollar_expr "), ("=", " equals "), ("<", " less than "), (">", " greater than "),
    ("+", " plus "), ("-", " minus "), ("*", " times "), ("/", " divided by "),
    ("^", " to the power of "), ("√", " square root "), ("π", " pi_expr "),
    ("∑", " sum_expr "), ("∫", " integral_expr "), ("∞", " infinity_expr "),
]

# Fixed values: (pattern, replacement) steps after the symbol words; Java replacement syntax.
MATH_CLEAN_STEPS = [
    (r"\\[a-zA-Z]+", " "),
    (r"\{([^}]*)\}", " $1 "),
    (r"[^a-zA-Z0-9\s\p{Z}.?!]", " "),
    (r"([0-9]+)([a-zA-Z])", "$1 $2"),
    (r"([a-zA-Z])([0-9]+)", "$1 $2"),
    (WS + "+", " "),
]


def clean_math_text(c) -> Column:
    """Ordered replacement chain of the math-problem cleaner (T13); NULL -> ''."""
    s = F.coalesce(col_of(c), F.lit(""))
    for sym, word in MATH_SYMBOLS:
        s = F.replace(s, F.lit(sym), F.lit(word))
    for pat, rep in MATH_CLEAN_STEPS:
        s = F.regexp_replace(s, pat, rep)
    return F.lower(F.trim(s))


def regex_count(c, pattern: str) -> Column:
    """Number of non-overlapping matches."""
    return F.coalesce(F.regexp_count(col_of(c), F.lit(pattern)), F.lit(0)).cast("long")


def contains_any(c, words: Sequence[str]) -> Column:
    """1 if any of the words occurs."""
    c = F.coalesce(col_of(c), F.lit(""))
    cond = None
    for w in words:
        cond = c.contains(w) if cond is None else (cond | c.contains(w))
    return cond.cast("int")


def text_length(c) -> Column:
    return F.coalesce(F.char_length(col_of(c)), F.lit(0)).cast("long")
