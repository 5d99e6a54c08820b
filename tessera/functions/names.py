"""Name and identifier column expressions for package-style records.

All are native Spark expressions (no Python UDF): they stay in whole-stage
codegen and run on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the record format.
SEPARATORS = "[-_.]+"  # runs of these collapse to one "-"
DEFAULT_SOURCE = "osv"  # source used when a record names none


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(c) -> Column:
    """Runs of ``-``, ``_``, ``.`` -> ``-``, then lower case, then strip
    surrounding whitespace (Unicode whitespace, as Python's ``str.strip``)."""
    collapsed = F.regexp_replace(_c(c), SEPARATORS, "-")
    return F.regexp_replace(F.lower(collapsed), r"(?U)^\s+|\s+$", "")


def first_present(*cols) -> Column:
    """First value that is neither NULL nor the empty string.  A
    whitespace-only string counts as present (it is truthy)."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def composite_id(source, name) -> Column:
    """``source:normalised-name`` with a missing/empty source -> ``osv``."""
    src = F.coalesce(F.nullif(_c(source).cast("string"), F.lit("")), F.lit(DEFAULT_SOURCE))
    return F.concat_ws(":", src, normalise_name(name))


def to_text(c) -> Column:
    """Non-string scalar to its string form; NULL stays NULL."""
    return _c(c).cast("string")


def is_blank(c) -> Column:
    """NULL, empty, or whitespace only (Unicode)."""
    return _c(c).isNull() | (F.regexp_replace(_c(c), r"(?U)\s+", "") == "")
