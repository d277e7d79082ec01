"""Column helpers with PostgreSQL semantics (F1-F23), built only from ``pyspark.sql.functions``.

Every helper returns a ``Column`` so it stays inside whole-stage codegen. Where Spark and
PostgreSQL differ (null handling in CONCAT, first-match regex replace, null ordering, regex
anchors, failing casts) the helper follows PostgreSQL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# Weekday numbers as stored by the legacy schema (0 = sunday).
WEEKDAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")


def concat(*cols: Any) -> Column:
    """PostgreSQL CONCAT: null arguments count as empty; the result is never null."""
    return F.concat_ws("", *[_lit(c).cast("string") for c in cols])


def concat_strict(*cols: Any) -> Column:
    """The ``||`` operator: any null argument makes the result null."""
    return F.concat(*[_lit(c).cast("string") for c in cols])


def substring(c: ColumnOrName, start: Any, length: Any = None) -> Column:
    """SUBSTRING(c FROM start [FOR length]), 1-based; a null start or length gives null."""
    c = col(c)
    start = _lit(start)
    if length is None:
        # 2^31-1 stands for "to the end"; positions before 1 behave as in PostgreSQL.
        return F.when(start.isNull(), F.lit(None).cast("string")).otherwise(
            F.substring(c, F.greatest(start, F.lit(1)), F.lit(2147483647))
        )
    length = _lit(length)
    end = start + length  # exclusive
    return F.when(start.isNull() | length.isNull(), F.lit(None).cast("string")).otherwise(
        F.substring(c, F.greatest(start, F.lit(1)), F.greatest(end - F.greatest(start, F.lit(1)), F.lit(0)))
    )


def left(c: ColumnOrName, n: int) -> Column:
    """LEFT(c, n) for n >= 0 (F8)."""
    return F.substring(col(c), 1, n)


def _sql_name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _sql_literal(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_map(c: ColumnOrName, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Searched CASE over equality tests: ``mapping[c]`` else ``default``."""
    plain = (int, str, bool, type(None))
    if isinstance(c, str) and isinstance(default, plain) and all(isinstance(x, plain) for kv in mapping.items() for x in kv):
        # One SQL expression (one call to the JVM) instead of a Column per branch.
        whens = " ".join(f"WHEN {_sql_literal(k)} THEN {_sql_literal(v)}" for k, v in mapping.items())
        return F.expr(f"CASE {_sql_name(c)} {whens} ELSE {_sql_literal(default)} END")
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), _lit(v))) if out is None else out.when(c == F.lit(k), _lit(v))
    if out is None:
        return _lit(default)
    return out.otherwise(_lit(default))


def weekday_name(c: ColumnOrName, default: Any) -> Column:
    """0 -> sunday ... 6 -> saturday; any other value or null -> ``default``."""
    return value_map(c, dict(enumerate(WEEKDAYS)), default)


def flag(c: ColumnOrName) -> Column:
    """``CASE WHEN c IS NOT NULL THEN TRUE ELSE FALSE END``."""
    return col(c).isNotNull()


def regexp_replace_all(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """REGEXP_REPLACE(c, p, r, 'g')."""
    return F.regexp_replace(col(c), pattern, replacement)


def regexp_replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """REGEXP_REPLACE(c, p, r) without 'g': only the leftmost match is replaced.

    Spark's regexp_replace replaces every match, so the prefix before the first match and
    the rest after it are captured and put back. ``pattern`` must not contain groups that
    the replacement refers to; ``(?s)`` lets ``.`` cross newlines as in PostgreSQL.
    """
    return F.regexp_replace(col(c), f"(?s)^(.*?)(?:{pattern})(.*)$", f"$1{_escape_repl(replacement)}$2")


def _escape_repl(r: str) -> str:
    return r.replace("\\", "\\\\").replace("$", "\\$")


def is_digits(c: ColumnOrName) -> Column:
    """``c ~ '^[0-9]+$'`` with PostgreSQL anchors (Java's ``$`` would accept a final newline)."""
    return col(c).rlike(r"^[0-9]+\z")


def digits_or_null(c: ColumnOrName, to: str = "int") -> Column:
    """``CASE WHEN c ~ '^[0-9]+$' THEN CAST(c AS to) END``; values out of range become null
    instead of failing the whole job (F18)."""
    return F.when(is_digits(c), col(c).try_cast(to))


def digits_or(c: ColumnOrName, default: int, to: str = "bigint") -> Column:
    """Digits cast to ``to``, anything else (or out of range) ``default``."""
    return F.coalesce(digits_or_null(c, to), F.lit(default).cast(to))


def only_digits_or_null(c: ColumnOrName, to: str = "bigint") -> Column:
    """``NULLIF(REGEXP_REPLACE(c, '[^0-9]', '', 'g'), '')::to``."""
    return F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit("")).try_cast(to)


def like(c: ColumnOrName, pattern: Column) -> Column:
    """``c LIKE pattern`` where the pattern is itself an expression."""
    return F.like(col(c), pattern)


def normalize_phone(phone: ColumnOrName, code: ColumnOrName, width: int = 16) -> Column:
    """The mobile-number rule of the user extracts.

    Strip a leading ``'+' || code`` or ``code`` from ``phone``, keep it as is otherwise, null
    becomes '' and the result is cut to ``width``. PostgreSQL builds the LIKE patterns with
    CONCAT, which ignores a null code: the pattern becomes ``'+%'`` or ``'%'``, which matches,
    and SUBSTRING(phone, NULL) is null, so a null code always yields ''.
    """
    phone, code = col(phone), col(code)
    code_len = F.char_length(code)
    body = (
        F.when(code.isNull(), F.lit(""))
        .when(like(phone, concat("+", code, "%")), substring(phone, code_len + 2))
        .when(like(phone, concat(code, "%")), substring(phone, code_len + 1))
        .otherwise(F.coalesce(phone, F.lit("")))
    )
    return left(F.coalesce(body, F.lit("")), width)


def country_code(code: ColumnOrName) -> Column:
    """``COALESCE(CONCAT('+', code), '')``: '+' for a null code, never '' (trap 1)."""
    return concat("+", col(code))


def slug(name: ColumnOrName) -> Column:
    """UPPER(REGEXP_REPLACE(TRANSLATE(name, ' ', '_'), '[^a-zA-Z0-9_]', '', 'g'))."""
    return F.upper(F.regexp_replace(F.translate(col(name), " ", "_"), "[^a-zA-Z0-9_]", ""))


def brand_code(name: ColumnOrName, ident: ColumnOrName) -> Column:
    """Short code of a brand (D28): ``slug(name) || '_' || id`` for names shorter than 5
    characters, otherwise two letters then ``'_' || id``; null name gives null.

    Letter one: first character of the name with everything but letters and digits removed.
    Letter two: drop spaces, turn every other non-alphanumeric into a space, skip the first
    character, delete the first remaining space, take the first character.
    """
    name, ident = col(name), col(ident).cast("string")
    no_space = F.translate(name, " ", "")
    first = F.upper(substring(F.regexp_replace(no_space, "[^a-zA-Z0-9]", ""), 1, 1))
    spaced = F.regexp_replace(no_space, "[^a-zA-Z0-9]", " ")
    second = F.upper(substring(regexp_replace_first(substring(spaced, 2), " ", ""), 1, 1))
    short = concat_strict(slug(name), "_", ident)
    long_ = concat_strict(first, second, "_", ident)
    return F.when(F.char_length(name) < 5, short).otherwise(long_)


def strip_trailing_number(c: ColumnOrName) -> Column:
    """REGEXP_REPLACE(c, '-[0-9]+$', ''): one end-anchored match (PostgreSQL ``$`` = end)."""
    return F.regexp_replace(col(c), r"-[0-9]+\z", "")


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def divide(a: ColumnOrName, b: ColumnOrName, a_type: str, b_type: str) -> Column:
    """``a / b`` as PostgreSQL computes it for the given operand types (F20, trap 5):
    integer by integer truncates toward zero; anything else is an ordinary division.
    The types come from the DataFrame schema (``dict(df.dtypes)``), so the same extract
    is right whether the legacy columns are integers or numerics."""
    a, b = col(a), col(b)
    if a_type in _INTEGRAL and b_type in _INTEGRAL:
        q = a / b
        return F.when(q >= 0, F.floor(q)).otherwise(F.ceil(q)).cast("bigint")
    return a / b


def desc(c: ColumnOrName) -> Column:
    """ORDER BY c DESC as PostgreSQL sorts it: nulls first."""
    return col(c).desc_nulls_first()


def asc(c: ColumnOrName) -> Column:
    """ORDER BY c [ASC] as PostgreSQL sorts it: nulls last."""
    return col(c).asc_nulls_last()


def typed_null(t: str) -> Column:
    """``NULL AS x`` with a declared type."""
    return F.lit(None).cast(t)


def in_list(c: ColumnOrName, values: Iterable[Any]) -> Column:
    """``c IN (...)``."""
    return col(c).isin(list(values))
