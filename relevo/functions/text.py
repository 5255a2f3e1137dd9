"""Text column expressions (all JVM-side, inside whole-stage codegen).

Every function takes and returns ``Column``s, so Catalyst sees the whole
expression and can prune, fold and push around it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() treats as whitespace,
# written as one Java regex character class (the reference splits with
# str.split(), so a bare \s -- ASCII only in Java -- would be narrower).
WHITESPACE_CLASS = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A"
                    "\\u2028\\u2029\\u202F\\u205F\\u3000]")
WHITESPACE_RUN = WHITESPACE_CLASS + "+"

# Alphabetic tokens: letters, letter-numbers, other numbers and '_'; decimal
# digits split tokens and are dropped (the reference's corpus tokenizer).
ALPHA_TOKEN = "[\\p{L}\\p{Nl}\\p{No}_]+"
# Word tokens with punctuation kept as single-character tokens (word-vector texts).
WORD_OR_PUNCT = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]"
# Sentence boundary: whitespace after ., ! or ?  (marked, then split on the mark)
SENTENCE_END = "([.!?])\\s+"
_MARK = "\u0001"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """``str.split()``: whitespace runs separate words, no empty words (array)."""
    return F.filter(F.split(_c(c), WHITESPACE_RUN), lambda w: w != F.lit(""))


def normalise(c) -> Column:
    """lower -> split on whitespace -> join by one blank."""
    return F.array_join(words(F.lower(_c(c))), " ")


def first_words(c, n: int) -> Column:
    """The first ``n`` whitespace words joined by one blank.

    Splits at most ``n`` times (``limit = n + 1``), so a long text is not cut
    into all of its words just to keep the first few; the ``n+1``-th piece is
    the unsplit remainder and is dropped.
    """
    head = F.regexp_replace(_c(c), "^" + WHITESPACE_RUN, "")
    parts = F.split(head, WHITESPACE_RUN, n + 1)
    return F.array_join(F.slice(F.filter(parts, lambda w: w != F.lit("")), 1, n), " ")


def word_count(c) -> Column:
    """``len(x.split())`` as bigint."""
    return F.size(words(c)).cast("long")


def contains_text(haystack, needle) -> Column:
    """substring test ``haystack.find(needle) >= 0``."""
    return F.instr(_c(haystack), _c(needle)) > 0


def overlap_count(words_of, found_in) -> Column:
    """Number of whitespace words of ``words_of`` that occur as a substring of
    ``found_in``; duplicate words count each time.

    F4a is ``overlap_count(product_field, search_term)``;
    F4b is ``overlap_count(search_term, product_field)`` (opposite order).
    """
    target = _c(found_in)
    return F.size(F.filter(words(words_of), lambda w: F.instr(target, w) > 0)).cast("long")


def alpha_tokens(c) -> Column:
    """alphabetic tokens, case kept (array<string>)."""
    return F.regexp_extract_all(_c(c), F.lit(ALPHA_TOKEN), F.lit(0))


def word_tokens(c) -> Column:
    """word tokens with single punctuation tokens (array<string>)."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_OR_PUNCT), F.lit(0))


def sentences(c) -> Column:
    """F8: split a text into sentences after ., ! or ? (array<string>)."""
    marked = F.regexp_replace(_c(c), SENTENCE_END, "$1" + _MARK)
    return F.filter(F.transform(F.split(marked, _MARK), lambda s: F.trim(s)),
                    lambda s: s != F.lit(""))


def concat_cols(*parts) -> Column:
    """P3 with explicit parts: ``Column`` objects stay, plain ``str`` are literals."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def fill_text(c, value: str = " ") -> Column:
    """``fillna(value)``."""
    return F.coalesce(_c(c), F.lit(value))


def nan_text(c) -> Column:
    """P5: ``str(x)`` where a missing value prints as ``'nan'``."""
    return F.coalesce(_c(c).cast("string"), F.lit("nan"))


def pack(*cols) -> Column:
    """P10: join fields with TAB."""
    out = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit("\t"))
        out.append(_c(c))
    return F.concat(*out)


def unpack(c, i: int) -> Column:
    """P10: ``x.split('\\t')[i]`` (0-based)."""
    return F.element_at(F.split(_c(c), "\t"), i + 1)
