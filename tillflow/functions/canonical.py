"""Canonical text of a value, as the hashed ids need it.

Ids hash the text of each column concatenated with no separator. The text
rules follow what Python prints for the value, but never depend on other rows:

* missing value -> ``nan`` (timestamps: ``NaT``);
* timestamp -> ``yyyy-MM-dd HH:mm:ss``, plus ``.ffffff`` only when the second has
  a fraction (also when every value of a batch is midnight);
* double -> Python ``repr`` (``3.0``, ``12345678.9``, ``1e+16``), not Java's
  ``1.23456789E7`` that a bare cast gives from 1e7 on.

All expressions are zone-free: ``cast(timestamp_ntz as string)`` is used, never
``date_format``, which goes through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NA_TEXT = "nan"
NAT_TEXT = "NaT"

# The rules are written as SQL text over a column reference: each becomes one
# ``F.expr`` (one call into the JVM) instead of a tree built call by call.


def ref(name: str) -> str:
    """SQL reference to a column name."""
    return "`" + name.replace("`", "``") + "`"


def string_text_sql(x: str) -> str:
    return f"coalesce({x}, '{NA_TEXT}')"


def timestamp_text_sql(x: str) -> str:
    s = f"cast({x} AS STRING)"
    micros = f"concat(substring_index({s}, '.', 1), '.', rpad(substring_index({s}, '.', -1), 6, '0'))"
    return f"CASE WHEN {x} IS NULL THEN '{NAT_TEXT}' WHEN instr({s}, '.') > 0 THEN {micros} ELSE {s} END"


def _python_float_layout(sci: str, e_sep: str) -> str:
    """Scientific text ``d.ddd<e>±n`` of the right digits -> Python's layout:
    positional for -4 <= n < 16 (exact decimal of those digits, trailing zeros
    cut, at least one decimal), else ``d.ddde±nn``."""
    exp = f"cast(substring_index({sci}, '{e_sep}', -1) AS INT)"
    positional = f"regexp_replace(regexp_replace(cast(cast({sci} AS DECIMAL(38,22)) AS STRING), '0+$', ''), '[.]$', '.0')"
    mantissa = f"regexp_replace(regexp_replace(substring_index({sci}, '{e_sep}', 1), '0+$', ''), '[.]$', '')"
    scientific = f"concat({mantissa}, format_string('e%+03d', {exp}))"
    return f"CASE WHEN {exp} >= 16 OR {exp} < -4 THEN {scientific} ELSE {positional} END"


def double_text_sql(x: str) -> str:
    """Python ``repr`` of a double: the shortest digits that read back as the
    same double, laid out as Python does.

    A short positional Java text (1e-3 <= |x| < 1e7, at most 12 characters:
    every money value) already is Python's text. Otherwise Java's digits may be
    one or two more than the shortest (JDK 17's digit generation, e.g.
    ``4.9E-324`` for ``5e-324``), so with k = Java's significant digits the
    roundings to k-2, k-1 and k digits are tried and the first that reads back
    equal is kept, then laid out.
    """
    j = f"cast({x} AS STRING)"
    k = f"length(regexp_replace(regexp_replace(substring_index({j}, 'E', 1), '[-.]', ''), '^0+', ''))"

    def rounded(drop: int) -> str:
        return f"format_string(concat('%.', cast(greatest({k} - {drop + 1}, 0) AS STRING), 'e'), {x})"

    a, b, c = rounded(2), rounded(1), rounded(0)
    best = f"CASE WHEN cast({a} AS DOUBLE) = {x} THEN {a} WHEN cast({b} AS DOUBLE) = {x} THEN {b} ELSE {c} END"
    return (
        f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '{NA_TEXT}' "
        f"WHEN {x} = CAST('Infinity' AS DOUBLE) THEN 'inf' "
        f"WHEN {x} = CAST('-Infinity' AS DOUBLE) THEN '-inf' "
        f"WHEN {x} = 0 THEN {j} "
        f"WHEN instr({j}, 'E') = 0 AND length({j}) <= 12 THEN {j} "
        f"ELSE {_python_float_layout(best, 'e')} END"
    )


def card_text_sql(x: str, style: str = "string") -> str:
    """Card number text. ``string`` keeps the digits; ``float`` appends ``.0`` to
    an all-digit value, which is what a file that also has cash rows prints."""
    if style == "float":
        x = f"CASE WHEN {x} RLIKE '^[0-9]+$' THEN concat({x}, '.0') ELSE {x} END"
    return string_text_sql(x)


def string_text(name: str) -> Column:
    return F.expr(string_text_sql(ref(name)))


def timestamp_text(name: str) -> Column:
    return F.expr(timestamp_text_sql(ref(name)))


def double_text(name: str) -> Column:
    return F.expr(double_text_sql(ref(name)))


def card_text(name: str, style: str = "string") -> Column:
    return F.expr(card_text_sql(ref(name), style))
