"""Column expressions for text: cleaning, word splitting, gluing and hit counts.

Everything here is a built-in Spark expression (JVM side, whole-stage codegen, null safe); no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must stay as they are for matching results:
# - the special-character class of the cleaning step. It keeps ASCII letters, the digits 1-9 and
#   whitespace; the digit 0 is deliberately NOT kept ("10 ft" becomes "1 ft");
# - the weights of the title and description hits in the weighted term-frequency score.
CLEAN_PATTERN = r"[^a-zA-Z1-9\s]"
TITLE_WEIGHT, DESCRIPTION_WEIGHT = 4.0, 1.0

# Derived from the fixed values above.
# Variant of the class that keeps the digit 0 as well.
CLEAN_PATTERN_KEEP_ZERO = r"[^a-zA-Z0-9\s]"
# The runs of characters the cleaning step keeps (the complement of the classes above).
KEEP_RUNS = r"[a-zA-Z1-9\s]+"
KEEP_RUNS_KEEP_ZERO = r"[a-zA-Z0-9\s]+"
# Java's \s: the white-space characters that survive cleaning.
JAVA_WHITESPACE = " \t\n\x0b\f\r"
# Whitespace run used to split words (same set as a plain str.split() on cleaned text).
WHITESPACE_RUN = r"\s+"
# The ML Tokenizer splits on one whitespace character at a time.
SINGLE_WHITESPACE = r"\s"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean(col: str | Column, keep_zero: bool = False) -> Column:
    """Remove special characters (matches are deleted, not replaced by a space).

    Same result as ``regexp_replace(col, CLEAN_PATTERN, '')``, computed by extracting the runs of
    kept characters and joining them: on the JVM a negated character class scans many times
    slower when several tasks run it at once, a positive class does not.
    """
    kept = KEEP_RUNS_KEEP_ZERO if keep_zero else KEEP_RUNS
    return F.array_join(F.regexp_extract_all(_c(col), F.lit(kept), 0), "")


def words(col: str | Column) -> Column:
    """Lower-case and split on whitespace runs, without empty tokens (``s.lower().split()``)."""
    return F.array_remove(F.split(F.lower(_c(col)), WHITESPACE_RUN), "")


def glue(col: str | Column) -> Column:
    """The words of a text joined with no separator: ``''.join(s.lower().split())``.

    Computed as one regex pass over the string; no token array is built.
    """
    return F.regexp_replace(F.lower(_c(col)), WHITESPACE_RUN, "")


def glue_clean(col: str | Column, keep_zero: bool = False) -> Column:
    """``glue(clean(col))`` in one regex pass: cleaning keeps letters, digits and white space and
    gluing then drops the white space, so only letters and digits remain, lower-cased."""
    return F.lower(F.translate(clean(col, keep_zero), JAVA_WHITESPACE, ""))


def term_len(terms: str | Column) -> Column:
    """Number of search-term tokens."""
    return F.size(_c(terms))


def substring_hits(terms: str | Column, blob: str | Column) -> Column:
    """How many query terms occur as a substring of the glued words.

    Not a term frequency: a match may straddle two words, duplicate query terms count twice and
    the maximum is the number of terms. ``blob`` should be an already computed column so the glue
    step is not repeated for every term.
    """
    blob = _c(blob)
    return F.size(F.filter(_c(terms), lambda t: F.contains(blob, t)))


def whole_word_hits(terms: str | Column, word_list: str | Column) -> Column:
    """Sum over query terms of the number of exactly equal words (``words.count(term)``)."""
    wl = _c(word_list)
    # Only the hits are put in a new array, the words are compared in place.
    return F.aggregate(_c(terms), F.lit(0), lambda acc, t: acc + F.size(F.filter(wl, lambda w: w == t)))


def counted_hits(terms: str | Column, counts: str | Column) -> Column:
    """``whole_word_hits`` from a text's (word -> count) map: one lookup per term; a NULL map has none."""
    held = F.coalesce(_c(counts), F.create_map().cast("map<string,int>"))
    return F.aggregate(_c(terms), F.lit(0), lambda acc, t: acc + F.coalesce(F.try_element_at(held, t), F.lit(0)))


def weighted_hits(terms: str | Column, title_hits: Column, desc_hits: Column,
                  title_weight: float = TITLE_WEIGHT, desc_weight: float = DESCRIPTION_WEIGHT) -> Column:
    """``title_weight * title_hits/n + desc_weight * desc_hits/n`` for n terms, NULL when n = 0."""
    n = F.nullif(F.size(_c(terms)), F.lit(0)).cast("double")
    return title_hits.cast("double") / n * F.lit(title_weight) + desc_hits.cast("double") / n * F.lit(desc_weight)


def weighted_tf(terms: str | Column, title_words: str | Column, desc_words: str | Column,
                title_weight: float = TITLE_WEIGHT, desc_weight: float = DESCRIPTION_WEIGHT) -> Column:
    """``title_weight * hits(title)/n + desc_weight * hits(description)/n``, NULL when n = 0."""
    return weighted_hits(terms, whole_word_hits(terms, title_words), whole_word_hits(terms, desc_words), title_weight, desc_weight)


def ml_tokens(col: str | Column) -> Column:
    """Same tokens as ``pyspark.ml.feature.Tokenizer`` as a plain expression.

    Lower-case, split on single whitespace characters; leading and inner empty tokens stay,
    trailing empty tokens are dropped; an all-whitespace text gives no tokens, '' gives [''].
    """
    low = F.lower(_c(col))
    trimmed = F.regexp_replace(low, r"\s+$", "")
    return (F.when(low == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, SINGLE_WHITESPACE)))


def info(title: str | Column, attrs: str | Column, description: str | Column,
         term: str | Column) -> Column:
    """All product text plus the search term in one string; a NULL part is empty."""
    parts = [F.coalesce(_c(p), F.lit("")) for p in (title, attrs, description, term)]
    return F.concat(*[x for p in parts for x in (F.lit(" "), p)][1:])
