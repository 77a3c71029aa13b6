"""Order-independent sums of DOUBLE money and quantities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Below this many units a double holds every multiple of a unit apart from its neighbours.
_UNITS_MAX = 2**52


def _kinds(column: str, places: int) -> tuple[str, str, str]:
    """A value as whole units, else as a decimal (null where it is not that), and whether it is neither."""
    units = f"try_cast(rint({column} * {10**places}) AS BIGINT)"
    fits = f"abs({units}) < {_UNITS_MAX} AND {units} / {10**places}D = {column}"
    whole = f"CASE WHEN {fits} THEN {units} END"
    decimal = f"try_cast({column} AS DECIMAL(38,18))"
    rest = f"CASE WHEN {fits} THEN NULL WHEN CAST({decimal} AS DOUBLE) = {column} THEN {decimal} END"
    return whole, rest, f"{column} IS NOT NULL AND {whole} IS NULL AND {rest} IS NULL"


def exact_sum(column: str, places: int = 2) -> Column:
    """Sum of a double column that does not depend on the order of the rows.

    Adding doubles gives other last digits for every other partitioning or task retry. Values
    with at most `places` decimal places, which is nearly all, are therefore added as whole
    units in a BIGINT, others that a decimal of 18 places holds unchanged as such decimals, and
    only the totals become doubles. A group with a value that fits neither (NaN, infinities, 1e20,
    1e-20) or with a total beyond either type keeps the plain double sum.
    """
    whole, rest, neither = _kinds(column, places)
    one_unit = f"CAST('{10**-places:.{places}f}' AS DECIMAL({places + 1},{places}))"
    units_total = f"try_sum({whole}) * {one_unit}"
    both = f"try_add(try_cast({units_total} AS DECIMAL(38,18)), try_sum({rest}))"
    total = f"""CASE
        WHEN max({whole}) IS NULL THEN CAST(try_sum({rest}) AS DOUBLE)
        WHEN max({rest}) IS NULL THEN CAST({units_total} AS DOUBLE)
        ELSE coalesce(CAST({both} AS DOUBLE), sum({column})) END"""
    exact = (
        f"NOT max({neither}) AND (try_sum({whole}) IS NOT NULL OR max({whole}) IS NULL) "
        f"AND (try_sum({rest}) IS NOT NULL OR max({rest}) IS NULL) AND count({column}) > 0"
    )
    return F.expr(f"if({exact}, {total}, sum({column}))")


def partial_sum(column: str, places: int = 2) -> Column:
    """What `exact_sum` needs to know of some rows, to be merged with the same of other rows.

    The whole units and the decimals are kept apart, each exact, beside the plain double sum. `inexact`
    says that some value, or a total, fits neither type.
    """
    whole, rest, neither = _kinds(column, places)
    return F.expr(f"""named_struct(
        'units', try_sum({whole}), 'rest', try_sum({rest}), 'plain', sum({column}),
        'inexact', coalesce(max({neither}), false)
            OR (count({whole}) > 0 AND try_sum({whole}) IS NULL)
            OR (count({rest}) > 0 AND try_sum({rest}) IS NULL))""")


def merged_sum(state: str) -> Column:
    """The aggregate of `partial_sum` states: the state of all their rows together."""
    return F.expr(f"""named_struct(
        'units', try_sum({state}.units), 'rest', try_sum({state}.rest), 'plain', sum({state}.plain),
        'inexact', coalesce(max({state}.inexact), false)
            OR (count({state}.units) > 0 AND try_sum({state}.units) IS NULL)
            OR (count({state}.rest) > 0 AND try_sum({state}.rest) IS NULL))""")


def sum_of(state: str, places: int = 2) -> Column:
    """The sum that a state stands for: that of `exact_sum` over all its rows."""
    one_unit = f"CAST('{10**-places:.{places}f}' AS DECIMAL({places + 1},{places}))"
    units = f"{state}.units * {one_unit}"
    both = f"try_add(try_cast({units} AS DECIMAL(38,18)), {state}.rest)"
    return F.expr(f"""CASE
        WHEN {state}.inexact OR {state}.plain IS NULL THEN {state}.plain
        WHEN {state}.units IS NULL THEN CAST({state}.rest AS DOUBLE)
        WHEN {state}.rest IS NULL THEN CAST({units} AS DOUBLE)
        ELSE coalesce(CAST({both} AS DOUBLE), {state}.plain) END""")
