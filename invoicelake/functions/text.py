"""Text and number reading with built-in functions only (no Python workers).

The functions take and return SQL expression text. Documents have dozens of fields, and one
expression per document is built in a fraction of the time that a Column per operation takes.
"""

from __future__ import annotations

import unicodedata

# Every character Python's str.strip removes; Spark's own trim removes only the plain space.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())

# No pattern repeats a group: Java's matcher calls itself once per turn, and long texts would end it.
_NUMBER = r"^[+-]?(?:[0-9_]++(?:\.[0-9_]*+)?|\.[0-9_]++)(?:[eE][+-]?[0-9_]++)?$"
_NON_FINITE = r"^[+-]?(inf|infinity|nan)$"
_INTEGER = r"^[+-]?[0-9_]++$"
_STRAY_UNDERSCORE = r"(?:^|[^0-9])_|_(?:[^0-9]|$)"  # one that does not stand between digits

# Decimal digits of all scripts but ASCII, and the ASCII digits that they stand for.
_OTHER_DIGITS = "".join(c for c in map(chr, range(0x80, 0x110000)) if c.isdecimal())
_AS_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_ascii(c: str) -> str:
    return f"octet_length({c}) = char_length({c})"


def strip(c: str, ascii: str | None = None) -> str:
    """Text without surrounding whitespace; plain ASCII text takes a cheaper way.

    `ascii` tells such text, where that is known without looking at it.
    """
    return (
        f"if({ascii or _is_ascii(c)}, btrim({c}, {literal(_ASCII_WHITESPACE)}), "
        f"btrim({c}, {literal(WHITESPACE)}))"
    )


def number_text(c: str, ascii: str | None = None) -> str:
    """Stripped text with the digits of all scripts in ASCII, as Python's float() and int() read them."""
    return (
        f"if({ascii or _is_ascii(c)}, btrim({c}, {literal(_ASCII_WHITESPACE)}), "
        f"translate(btrim({c}, {literal(WHITESPACE)}), {literal(_OTHER_DIGITS)}, {literal(_AS_DIGITS)}))"
    )


def blank_to_null(stripped: str) -> str:
    return f"if({stripped} = '', NULL, {stripped})"


def _underscores_fit(stripped: str) -> str:
    return f"NOT (contains({stripped}, '_') AND {stripped} RLIKE {literal(_STRAY_UNDERSCORE)})"


def read_float(stripped: str) -> str:
    """Number in stripped text as Python's float() reads it, null where float() would fail.

    The pattern keeps out what a Spark cast accepts beyond that (`1d`, `0x1p3`).
    """
    return f"""CASE
        WHEN {stripped} RLIKE {literal(_NUMBER)} AND {_underscores_fit(stripped)}
            THEN try_cast(replace({stripped}, '_', '') AS DOUBLE)
        WHEN lower({stripped}) RLIKE {literal(_NON_FINITE)} THEN
            CASE WHEN endswith(lower({stripped}), 'nan') THEN double('NaN')
                 WHEN startswith({stripped}, '-') THEN double('-Infinity')
                 ELSE double('Infinity') END
        END"""


def is_integer(stripped: str) -> str:
    return f"({stripped} RLIKE {literal(_INTEGER)} AND {_underscores_fit(stripped)})"


def read_int(stripped: str) -> str:
    """Integer, null where the text is not one or does not fit 32 bits."""
    return f"if({is_integer(stripped)}, try_cast(replace({stripped}, '_', '') AS INT), NULL)"


def basename(path: str) -> str:
    return f"substring_index({path}, '/', -1)"


def remove_first(c: str, part: str) -> str:
    """`c` without the first occurrence of `part`."""
    at = f"instr({c}, {literal(part)})"
    return f"if({at} > 0, overlay({c} PLACING '' FROM {at} FOR {len(part)}), {c})"


def utc_seconds(ts: str) -> str:
    """A timestamp as ISO-8601 UTC text in whole seconds, whatever the session's time zone."""
    pattern = literal("yyyy-MM-dd'T'HH:mm:ss'Z'")
    return f"date_format(to_utc_timestamp({ts}, current_timezone()), {pattern})"
