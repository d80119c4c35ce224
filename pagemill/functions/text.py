"""Whitespace expressions. All are Column -> Column and stay inside the JVM."""

from functools import reduce

from pyspark.sql import Column, functions as F

from pagemill.fixed import HTML_WHITESPACE, LINE_TRIM, MARK_ESCAPE, MARKS


def char_class(chars: str) -> str:
    """A regex class that rejects most characters after one bit test and one range test."""
    low = "".join(f"\\x{ord(c):02x}" for c in chars if ord(c) < 256)
    high = "".join(c for c in chars if ord(c) >= 256)
    return f"[{low}[{min(high)}-{max(high)}&&[{high}]]]" if high else f"[{low}]"


WS = char_class(HTML_WHITESPACE)
WS_INLINE = char_class(HTML_WHITESPACE.replace("\n", ""))
TRIM = char_class(LINE_TRIM)
TRIM_ANY = char_class(LINE_TRIM + "\n")
NOT_TRIM_ANY = f"[^{TRIM_ANY[1:]}"


def run_of(chars: str) -> str:
    """A whole run: entered at its first character only, so a pass stays linear in the text."""
    return f"{chars}(?<!{chars}{chars}){chars}*+"


_LINE_ENDS = (
    rf"{TRIM}(?<!{TRIM}{TRIM})"
    rf"(?:{TRIM}*+(?=\n|\z)|(?:(?<=\n{TRIM})|(?<=\A{TRIM})){TRIM}*+)")


def let(value: Column, body) -> Column:
    """body(value) with `value` computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


#: One of MARKS, which are neighbours: a range is one test a character, a list of them ten.
_ANY_MARK = f"[{min(MARKS)}-{max(MARKS)}]"


def escape_marks(text: Column) -> Column:
    """The text with the marks that it holds itself as MARK_ESCAPE and a digit; most texts hold none."""

    def escaped(plain):
        held = reduce(lambda t, k: F.replace(t, F.lit(MARKS[k]), F.lit(f"{MARK_ESCAPE}{k}")), range(len(MARKS)), plain)
        return F.when(plain.rlike(_ANY_MARK), held).otherwise(plain)

    return let(text, escaped)


def unescape_marks(text: Column) -> Column:
    """The way back from escape_marks; marks of the plan must be gone."""

    def plain(held):
        shown = reduce(lambda t, k: F.replace(t, F.lit(f"{MARK_ESCAPE}{k}"), F.lit(MARKS[k])), reversed(range(len(MARKS))), held)
        return F.when(F.contains(held, F.lit(MARK_ESCAPE)), shown).otherwise(held)

    return let(text, plain)


def collapse_whitespace(text: Column) -> Column:
    """Each run of HTML whitespace becomes one space; the ends are not trimmed."""
    return F.regexp_replace(text, WS + "+", " ")


def collapse_inline(text: Column) -> Column:
    """Per line: collapse whitespace runs and trim both ends."""
    return F.regexp_replace(F.regexp_replace(text, WS_INLINE + "+", " "), _LINE_ENDS, "")


def fold_blank_lines(text: Column) -> Column:
    """Runs of empty lines become one empty line; none is left at the ends."""
    return let(F.btrim(text, F.lit("\n")), lambda t: F.when(
        F.contains(t, F.lit("\n\n\n")), F.regexp_replace(t, r"\n{3,}", "\n\n")).otherwise(t))


def collapse_lines(text: Column) -> Column:
    """Collapse whitespace but keep the line structure."""
    return fold_blank_lines(collapse_inline(text))


def whitespace_count(text: Column) -> Column:
    """Number of HTML whitespace characters."""
    return F.length(text) - F.length(F.translate(text, HTML_WHITESPACE, ""))


def trim_any(text: Column) -> Column:
    """Trim whitespace, line ends included, from both ends."""
    return F.regexp_replace(text, rf"\A{TRIM_ANY}++|{run_of(TRIM_ANY)}\z", "")
