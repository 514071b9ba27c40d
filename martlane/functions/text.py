"""String cleaning expressions (all JVM-side, no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` treats as white space
# (``str.strip()`` removes exactly these from both ends).  Spark's default
# ``trim`` removes plain spaces only, so the cleaning rules trim this set.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NBSP = "\u00a0"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading/trailing white space the way Python's ``str.strip`` does
    (a character-set trim: no regex on the hot path)."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def normalize_space(c: Column | str) -> Column:
    """NBSP -> space, then strip all Unicode white space from both ends."""
    return strip_ws(F.replace(_col(c), F.lit(NBSP), F.lit(" ")))


def normalize_flag(c: Column | str, yes: str = "Yes", no: str = "No") -> Column:
    """Text flag -> 'Yes'/'No'.

    Value is trimmed and capitalised; anything other than Yes/No, NULL
    included, becomes 'No'.  Capitalising a single word equals 'Yes' exactly
    when its lower-case form is 'yes', so no word-by-word initcap is needed.
    """
    v = F.lower(strip_ws(_col(c).cast("string")))
    return F.when(v == F.lit(yes.lower()), F.lit(yes)).otherwise(F.lit(no))


def fill_postal(c: Column | str, unknown: str = "Unknown") -> Column:
    """Postal code kept as text (leading zeros survive); NULL/blank -> 'Unknown'."""
    s = _col(c).cast("string")
    return F.when(s.isNull() | (strip_ws(s) == ""), F.lit(unknown)).otherwise(s)


def normalize_column_name(name: str) -> str:
    """Header rule: trimmed, in lower case, words joined by underscores."""
    return re.sub("[ -]", "_", name.strip()).lower()
