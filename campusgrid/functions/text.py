"""Text expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from campusgrid.schema import NULL_TOKENS, STATE_NULL_TOKENS

# Fixed value: every character Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_CAMEL_EDGE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SEPARATORS = re.compile(r"[\s\-_]+")


def snake_case(name: str) -> str:
    """`School Name`, `schoolName` and `SCHOOL-NAME` all become `school_name`."""
    return _SEPARATORS.sub("_", _CAMEL_EDGE.sub("_", name)).lower().strip("_")


def field_column_name(field: str, known: dict[str, str]) -> str:
    """The column name of a record field: the mapped one, else dots and hyphens to `_`."""
    return known.get(field) or re.sub(r"[.\-]", "_", field).lower()


def without_prefixes(name: str, prefixes: Sequence[str] = ("latest.", "school.")) -> str:
    """Drop each prefix in turn, then turn dots into underscores."""
    for prefix in prefixes:
        name = name.removeprefix(prefix)
    return name.replace(".", "_")


def repeated(names: Iterable[str]) -> list[str]:
    """Names that occur more than once."""
    seen: set[str] = set()
    twice: set[str] = set()
    for name in names:
        (twice if name in seen else seen).add(name)
    return sorted(twice)


def strip(col: Column) -> Column:
    """Remove outer blanks, also tabs, line ends and Unicode blanks (`trim` keeps those).

    Only text that begins or ends with a blank is trimmed: the look at the two
    ends is many times cheaper, and few values need more.
    """
    ends = F.substring(col, 1, 1).isin(*BLANKS) | F.substring(col, -1, 1).isin(*BLANKS)
    return F.when(ends, F.btrim(col, F.lit(BLANKS))).otherwise(col)


def null_tokens(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the text is one of the tokens, compared exactly."""
    return F.when(~col.isin(*tokens), col)


def clean_text(col: Column) -> Column:
    return null_tokens(strip(col))


def state_code(col: Column) -> Column:
    """Upper-case state code without blanks; spelled-out nulls become null."""
    return null_tokens(F.upper(strip(col)), STATE_NULL_TOKENS)


def quoted(name: str) -> Column:
    """A column whose name may hold dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")
