"""Text expressions with Python's notion of white space, digits and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgloom.schemas import MISSING

# The patterns below can only start where a run of their characters starts, so a long
# run without a match takes linear time.

# Python's str.isspace and \s also accept the four separators \x1c-\x1f.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Cut white space at both ends (Spark's trim cuts blanks only)."""
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|(?<!{SPACE}){SPACE}+\z", "")


def is_space(text: Column) -> Column:
    return text.rlike(rf"(?U)\A{SPACE}+\z")


def digits_only(text: Column) -> Column:
    """Keep the digits; NULL when none is left."""
    return F.nullif(F.regexp_replace(text, r"(?U)[^\d]", ""), F.lit(""))


def size_clean(text: Column) -> Column:
    """Keep digits and hyphens and mark the value as text with a leading quote."""
    kept = F.regexp_replace(F.coalesce(text, F.lit(MISSING)), r"(?U)[^\d\-]", "")
    return F.when(kept == MISSING, kept).otherwise(F.concat(F.lit("'"), kept))


def size_extract(text: Column) -> Column:
    """The text before "employees", quoted; NULL when the word does not occur."""
    pattern = rf"(?iUdm)^.*(?={SPACE}*employees)"
    before = strip(F.regexp_extract(text, pattern, 0))
    return F.when(text.rlike(pattern), F.concat(F.lit("'"), before))


def members_extract(text: Column) -> Column:
    """The number before "associated member(s)", commas kept; NULL without one."""
    pattern = rf"(?iUd)(?<![\d,])[\d,]++(?={SPACE}*associated member[s]?)"
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))
