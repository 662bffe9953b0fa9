"""Column expressions for the text rules of the jobs (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def space_tokens(line) -> Column:
    """Tokens of ``line`` split on single spaces with the rule of Java's
    ``String.split(" ")``: leading and inner empty tokens are kept, trailing
    empty tokens are dropped, an empty line gives one empty token and a line
    of spaces gives none.  ``rtrim`` removes only U+0020, like the split."""
    line = _c(line)
    trimmed = F.rtrim(line)
    return (F.when(line == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def text_lines(text) -> Column:
    """Lines of a text value as a text-file scan gives them: every ``\\r\\n``,
    ``\\r`` or ``\\n`` ends a line, so a final one starts no further line and
    an empty text has no line."""
    body = F.regexp_replace(_c(text), r"(\r\n|\r|\n)\z", "")
    return F.when(_c(text) != "", F.split(body, "\r\n|\r|\n", -1)) \
        .otherwise(F.array().cast("array<string>"))


def comma_fields(line) -> Column:
    """All comma-separated fields, trailing blanks kept (``split(",", -1)``);
    no quoting."""
    return F.split(_c(line), ",", -1)


def first_field(line) -> Column:
    """The text before the first comma (the whole line without one): the
    title of a matrix line, read without splitting the rest."""
    return F.substring_index(_c(line), ",", 1)


def strict_int(cell, what: str = "cell") -> Column:
    """Parse a decimal integer the way ``Integer.parseInt`` does: optional
    sign and digits only (no blanks, no decimal point); anything else fails
    the job.  Out-of-range values fail through the ANSI cast; null stays null."""
    cell = _c(cell)
    ok = cell.rlike(r"^[+-]?[0-9]+$")
    return F.when(cell.isNull(), F.lit(None).cast("int")).when(ok, cell.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"not an integer {what}: '"), cell, F.lit("'"))))


def truncate2(x) -> Column:
    """Truncate a non-negative double to two decimals (report formatting)."""
    return F.floor(_c(x) * F.lit(100)) / F.lit(100.0)
