"""Value expressions: hex log numbers, strict and lenient casts, CSV nulls, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a change file writes for NULL, the boolean words in any case, the width of a log number.
NULL_WORDS = ("NULL", "null")
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
LSN_HEX_DIGITS = 24

_HALF = LSN_HEX_DIGITS // 2
_HALF_RANGE = 16**_HALF


def hex_number(digits: Column) -> Column:
    """Up to 24 hex digits (96 bits) as decimal(38,0); NULL for anything else.

    ``conv`` ends at 64 bits, so the number is put together from two halves.
    """
    padded = F.lpad(digits, LSN_HEX_DIGITS, "0")

    def half(start: int) -> Column:
        return F.conv(F.substring(padded, start, _HALF), 16, 10).cast("decimal(15,0)")

    scale = F.lit(_HALF_RANGE).cast("decimal(15,0)")
    number = (half(1) * scale + half(_HALF + 1)).cast("decimal(38,0)")
    return F.when(digits.rlike(f"^[0-9A-Fa-f]{{1,{LSN_HEX_DIGITS}}}$"), number)


def lsn_number(text: Column) -> Column:
    """A log sequence number such as ``0x0000A1``; the two leading characters are skipped."""
    return hex_number(F.substr(text, F.lit(3)))


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


# The per-field rules below take and give SQL text: a table has up to a hundred
# fields, and one parsed expression is far cheaper to build than ten Column calls.


def to_boolean(text: str) -> str:
    """Boolean words; unlike Spark's cast this knows ``on`` and ``off``."""
    word = f"lower(trim({text}))"
    return f"CASE WHEN {word} IN ({_words(TRUE_WORDS)}) THEN true WHEN {word} IN ({_words(FALSE_WORDS)}) THEN false END"


def soft_cast(value: str, source_type: str, target_type: str) -> str:
    """Cast that gives NULL for a bad value, so the caller can tell a reject from a NULL."""
    if target_type == source_type:
        return value
    if target_type == "boolean" and source_type == "string":
        return to_boolean(value)
    numeric = source_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or source_type.startswith(
        "decimal"
    )
    if numeric and target_type == "timestamp_ntz":
        # No direct cast exists; as text a bare number is not a timestamp and so a reject.
        value = f"CAST({value} AS string)"
    return f"try_cast({value} AS {target_type})"


def csv_field(raw: str, beyond_row_end: str | None = None) -> str:
    """Null rule of the change files: only the words are NULL, an empty field is ''.

    The reader cannot tell an unquoted empty field from a missing one and gives
    NULL for both; ``beyond_row_end`` marks the fields a short row lacks.
    """
    empty = "''" if beyond_row_end is None else f"CASE WHEN {beyond_row_end} THEN NULL ELSE '' END"
    return f"CASE WHEN {raw} IS NULL THEN {empty} WHEN {raw} NOT IN ({_words(NULL_WORDS)}) THEN {raw} END"


def list_items(text: Column, upper: bool = False) -> Column:
    """A comma list as an array of trimmed, non-empty items."""
    items = F.filter(F.transform(F.split(text, ","), lambda item: F.trim(item)), lambda item: item != "")
    return F.transform(items, lambda item: F.upper(item)) if upper else items


def scope_items(scope: str | list[str] | None, upper: bool = False) -> list[str] | None:
    """A run argument (comma text or list) as items; None when it names nothing."""
    parts = scope.split(",") if isinstance(scope, str) else (scope or [])
    items = [part.strip() for part in parts if part.strip()]
    if upper:
        items = [item.upper() for item in items]
    return items or None


def computed_once(frame: DataFrame) -> DataFrame:
    """The same rows, with the columns so far computed exactly once.

    Catalyst moves a filter below the columns it uses and copies their
    expressions into it. For a filter on a parse result that means parsing
    every row twice, and once more per further filter. It does not move filters
    below a generator, so the rows pass through one that yields each as it is.
    """
    return frame.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in frame.columns]))))
