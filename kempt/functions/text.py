"""Column builders for text inspection and repair.

Every function takes and returns a ``Column`` built from Spark SQL expressions,
so it stays an expression of built-in functions and can be used in ``select``,
``where``, ``groupBy`` or ``agg`` alike.  Nothing here collects data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------

# Any character outside printable ASCII U+0020..U+007E is an encoding suspect.
NON_PRINTABLE_ASCII = "[^ -~]"

# Mojibake repairs, applied in this order.  The combined NBSP-around-plus
# sequence must run before the lone NBSP remnant, and the apostrophe sequence
# starts with U+00E2, so it runs first of all.
#   U+00E2 U+20AC U+2122  ->  U+2019   (garbled right single quote)
#   U+00C2 '+' U+00C2     ->  ' + '    (NBSP around a plus sign)
#   U+00C2                ->  ' '      (lone NBSP remnant)
#   U+00C3 U+00B6         ->  U+00F6   (garbled o-umlaut)
#   U+00CE U+00B2         ->  U+03B2   (garbled Greek beta)
MOJIBAKE_REPAIRS: tuple[tuple[str, str], ...] = (
    ("â€™", "’"),
    ("Â+Â", " + "),
    ("Â", " "),
    ("Ã¶", "ö"),
    ("Î²", "β"),
)

# Wrong-letter repair: sharp s written where Greek beta was meant.
SHARP_S_TO_BETA: tuple[str, str] = ("ß", "β")

# Lower-case connector words allowed inside proper names.
NAME_CONNECTORS: tuple[str, ...] = ("and", "of", "in", "for", "en")

# Company-suffix variants, checked case-sensitively in this order.
SUFFIX_VARIANTS: tuple[tuple[str, str], ...] = (
    ("ltd.", "lowercase ltd."),
    ("Ltd.", "Ltd."),
    ("Ltd", "Ltd"),
    ("Limited", "Limited"),
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------

def has_non_ascii(c: str | Column) -> Column:
    """True when the value holds a character outside U+0020..U+007E (tab and newline included)."""
    return _col(c).rlike(NON_PRINTABLE_ASCII)


def is_blank(c: str | Column) -> Column:
    """True for '' or spaces only; NULL stays NULL (counted separately)."""
    return F.trim(_col(c)) == F.lit("")


def has_edge_whitespace(c: str | Column) -> Column:
    """Leading or trailing spaces on either side (``x <> trim(x)``)."""
    c = _col(c)
    return c != F.trim(c)


def has_extra_spaces(c: str | Column) -> Column:
    """Double space anywhere, or a leading / trailing space."""
    c = _col(c)
    return c.contains("  ") | c.startswith(" ") | c.endswith(" ")


def contains_any(c: str | Column, needles: Iterable[str]) -> Column:
    """OR of literal ``contains`` tests; each stays a pushable string predicate."""
    c = _col(c)
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def has_lowercase_word(c: str | Column, exclusions: Sequence[str] = NAME_CONNECTORS, *,
                       case_insensitive: bool = False) -> Column:
    """A word after the first one starts with a lower-case letter, unless the
    name contains one of the allowed connector words.

    Case-sensitive by default (the stated intent).  ``case_insensitive=True``
    reproduces a check run under a case-insensitive collation, where any letter
    after a space matches and the exclusions match in any case.
    """
    c = _col(c)
    if case_insensitive:
        pred = c.rlike("(?i) [a-z]")
        low = F.lower(c)
        for word in exclusions:
            pred = pred & ~low.contains(f" {word.lower()} ")
        return pred
    pred = c.rlike(" [a-z]")
    for word in exclusions:
        pred = pred & ~c.contains(f" {word} ")
    return pred


def has_connector_word(c: str | Column, words: Sequence[str] = ("for", "or")) -> Column:
    """Names holding a connector word, for a capitalisation review."""
    return contains_any(c, [f" {w} " for w in words])


def delimiter_issue(c: str | Column, delim: str = ",") -> Column:
    """Classify a delimiter defect: lone / leading / trailing / both_parts, NULL if clean.

    The four classes are mutually exclusive, in that order of precedence.
    """
    c = _col(c)
    return (F.when(c == F.lit(delim), F.lit("lone"))
            .when(c.startswith(delim), F.lit("leading"))
            .when(c.endswith(delim), F.lit("trailing"))
            .when(c.contains(delim), F.lit("both_parts")))


def suffix_variant(c: str | Column, variants: Sequence[tuple[str, str]] = SUFFIX_VARIANTS) -> Column:
    """Label of the first suffix the value ends with (case-sensitive); NULL if none."""
    c = _col(c)
    out = None
    for suffix, label in variants:
        out = (F.when(c.endswith(suffix), F.lit(label)) if out is None
               else out.when(c.endswith(suffix), F.lit(label)))
    return out


# ---------------------------------------------------------------------------
# Code points
# ---------------------------------------------------------------------------

def first_non_ascii_pos(c: str | Column) -> Column:
    """1-based position of the first non-printable-ASCII character; 0 when none."""
    return F.regexp_instr(_col(c), F.lit(NON_PRINTABLE_ASCII))


def code_point_at(c: str | Column, pos: Column) -> Column:
    """Code point of the character at ``pos`` (1-based).

    NULL when ``pos`` is 0 / negative (no match) or past the end, matching
    ``UNICODE(SUBSTRING(...))`` on an empty string.
    """
    c = _col(c)
    return F.when(pos > 0, F.nullif(F.ascii(c.substr(pos, F.lit(1))), F.lit(0))).cast("int")


def non_ascii_runs(c: str | Column) -> Column:
    """Array of every maximal run of non-printable-ASCII characters (all occurrences)."""
    return F.regexp_extract_all(_col(c), F.lit(NON_PRINTABLE_ASCII + "+"), F.lit(0))


# ---------------------------------------------------------------------------
# Repairs (pure expressions; see operators.rules for ordered application)
# ---------------------------------------------------------------------------

def replace_all(c: str | Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Ordered chain of literal, single-pass, non-overlapping replacements."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, _col(c))


def repair_mojibake(c: str | Column, extra: Iterable[tuple[str, str]] = ()) -> Column:
    """The fixed mojibake chain, optionally followed by user-supplied pairs."""
    return replace_all(c, tuple(MOJIBAKE_REPAIRS) + tuple(extra))


def strip_chars(c: str | Column, chars: str) -> Column:
    """Remove the given characters from both ends (``TRIM(chars FROM c)``)."""
    return F.btrim(_col(c), F.lit(chars))


def text_before(c: str | Column, delim: str) -> Column:
    """Text before the first ``delim``; NULL when the delimiter is absent."""
    c = _col(c)
    pos = F.instr(c, delim)
    return F.when(pos > 0, c.substr(F.lit(1), pos - 1))


def collapse_spaces(c: str | Column, single_pass: bool = True) -> Column:
    """Replace double spaces.  ``single_pass`` turns each pair into one space in one
    non-overlapping pass (three spaces become two); otherwise any run becomes one."""
    c = _col(c)
    if single_pass:
        return F.replace(c, F.lit("  "), F.lit(" "))
    return F.regexp_replace(c, " {2,}", " ")


def _quoted(literal: str) -> str:
    """A literal as a regular expression."""
    return "".join(ch if ch.isalnum() or ch == " " else f"\\{ch}" for ch in literal)


def _replacement(literal: str) -> str:
    """A literal as a replacement string."""
    return literal.replace("\\", "\\\\").replace("$", "\\$")


def append_if_endswith(c: str | Column, suffix: str, addition: str) -> Column:
    """``c || addition`` when ``c`` ends with ``suffix`` (case-sensitive), else ``c``.

    One evaluation of ``c``, so chains stay linear and inside generated code."""
    return F.regexp_replace(_col(c), f"(?<={_quoted(suffix)})\\z", _replacement(addition))


def replace_when_endswith(c: str | Column, suffix: str, search: str, replacement: str) -> Column:
    """``replace(c, search, replacement)`` for values ending with ``suffix``, in one evaluation of ``c``."""
    return F.regexp_replace(_col(c), f"(?=(?s:.*)(?<={_quoted(suffix)})\\z){_quoted(search)}", _replacement(replacement))
