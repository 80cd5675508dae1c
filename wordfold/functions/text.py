"""Column expressions for the text rules (lines and words).

All of these are built-in Catalyst expressions, so they run inside
whole-stage codegen on the executors; there is no Python on the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules).
# Line terminators of the text-line reader: CRLF, CR, LF (in this order, so
# that CRLF is one terminator).
LINE_BREAK = r"\r\n|\r|\n"
CR = "\r"
LF = "\n"
CRLF = "\r\n"
# The word separator: exactly one U+0020 space.
WORD_SEPARATOR = " "


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """Array of the lines of a text held in a column.

    Same result as reading the text as a file: break on CRLF, CR or LF; a
    final terminator adds no line; an empty text has no lines. NULL stays NULL.

    Cost: one final terminator is cut with ``endswith`` + ``substr`` (no regex
    scan of the text), and a text without CR is split on the single LF
    character, which takes Java's non-regex ``String.split`` fast path; only
    texts that contain a CR pay for the regex split.
    """
    t = _col(text)
    n = F.length(t)
    body = (
        F.when(t.endswith(CRLF), t.substr(F.lit(1), n - 2))
        .when(t.endswith(LF) | t.endswith(CR), t.substr(F.lit(1), n - 1))
        .otherwise(t)
    )
    return (
        F.when(t == "", _no_strings())
        .when(F.instr(t, CR) > 0, F.split(body, LINE_BREAK))
        .otherwise(F.split(body, LF))
    )


def split_words(line: Column | str) -> Column:
    """Array of words of one line, with the rules of a Java ``split(" ")``.

    The separator is one space; tabs, NBSP and punctuation stay inside words;
    leading and interior empty words are kept, trailing ones are dropped; an
    empty line is one empty word and a line of spaces has none.

    Spark's ``split`` keeps trailing empty strings, so trailing spaces are
    removed first (``rtrim`` trims U+0020 only).
    """
    s = _col(line)
    body = F.rtrim(s)
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(body == "", _no_strings())
        .otherwise(F.split(body, WORD_SEPARATOR))
    )


def report_line(n: Column | str, word: Column | str) -> Column:
    """``"<count> <word>"``: one line of the ranked report."""
    return F.concat(_col(n).cast("string"), F.lit(" "), _col(word))
