"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space, as a regex class body (fixed values).
WHITE_SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_WHITE_CHARS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_space(value: Column | str) -> Column:
    """Trim Unicode white space on both sides (Spark's ``trim`` only drops U+0020)."""
    return F.btrim(as_col(value), F.lit(_WHITE_CHARS))


def percent_escape(value: Column | str, allowed: str) -> Column:
    """Percent-encode the UTF-8 bytes of every character outside ``[allowed]``."""
    text = as_col(value)
    escaped = F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c: F.when(c.rlike(f"^[{allowed}]$"), c).otherwise(
                F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
            ),
        ),
        "",
    )
    return F.when(text.rlike(f"[^{allowed}]"), escaped).otherwise(text)


def bind(value: Column, build) -> Column:
    """``build(value)`` with ``value`` evaluated once per row.

    A one-element ``transform`` is the only local binding the DataFrame API has;
    without it a column used in several branches of a CASE is computed in each.
    """
    return F.get(F.transform(F.array(value), lambda bound: build(bound)), F.lit(0))
