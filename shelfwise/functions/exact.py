"""Order-independent sums, averages and shares.

A sum of doubles depends on the order in which partitions arrive, so a rounded
report could change from run to run. Here a double stands for its shortest
decimal notation, the one it is printed with; whole parts and fractions of these
are summed apart, as wide decimals, and the result is rounded once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import Window

_COUNT = "decimal(20,0)"
#: Fractions are kept to 25 digits: all that doubles of 1e-9 and more have. 38 digits
#: then hold the fractions of 10^13 rows.
_FINE, _FRACTION = "decimal(36,25)", "decimal(28,25)"
#: From 1e10 on, a double has at most 7 digits after the point.
_COARSE = "decimal(36,7)"
_COARSE_FROM = 1e10
#: Decimal sums hold 10^10 doubles of this size; larger ones, infinities and NaN are
#: left to double arithmetic.
_LARGEST = 1e28
_WHOLE = "decimal(38,0)"
#: A sum is divided in two limbs, the lower one of so many.
_LIMB = 10**12

# Written as SQL text: a report has dozens of these sums, and a call to the JVM for
# each part of each would take longer than the report.


def _sums(value: str) -> tuple[str, str, str]:
    """Sum of the whole parts (rounded down), sum of what they leave, and whether
    every value took part."""
    number = f"CAST({value} AS DOUBLE)"
    size = f"abs({number})"
    fine = f"try_cast(CASE WHEN {size} < {_COARSE_FROM:e}D THEN {number} END AS {_FINE})"
    coarse = f"try_cast(CASE WHEN {size} >= {_COARSE_FROM:e}D AND {size} < {_LARGEST:e}D THEN {number} END AS {_COARSE})"
    whole = [f"CAST(floor({part}) AS decimal(28,0))" for part in (fine, coarse)]
    left = [f"CAST({part} - floor({part}) AS {_FRACTION})" for part in (fine, coarse)]
    return (
        f"sum(coalesce({', '.join(whole)}))",
        f"sum(coalesce({', '.join(left)}))",
        f"count_if(NOT ({size} < {_LARGEST:e}D)) = 0",
    )


def _over(a: str, b: str) -> str:
    """Quotient of whole numbers that are not negative, rounded down; it has up to 32 digits."""
    return f"CAST(CAST({a} - {a} % {b} AS {_WHOLE}) / {b} AS {_WHOLE})"


def divided(whole: str, left: str, n: str, digits: int) -> str:
    """(whole + left) / n as a double, rounded half away from zero to some digits.

    Long division of a sum's whole part and fraction by up to 10^13: with q the
    quotient in units of the last digit, q = floor((2 * sum + n) / 2n) in these units.
    Each step is bound by a one-element transform, as the next one uses it several
    times; the last is a decimal notation, which the cast to a double rounds once.
    """
    unit, limb = f"{10**digits}BD", f"{_LIMB}BD"
    borrowed = "(s.total < 0 AND s.rest > 0)"  # the size of a negative sum is -total - rest
    steps = [
        f"named_struct('n', s.n, 'total', CAST(s.whole + floor(s.rest) AS {_WHOLE}), "
        "'rest', CAST(s.rest - floor(s.rest) AS decimal(26,25)))",
        f"named_struct('below', s.total < 0, 'n', s.n, 'size', CAST(abs(s.total) - if({borrowed}, 1, 0) AS {_WHOLE}), "
        f"'part', CAST(if({borrowed}, 1 - s.rest, s.rest) AS decimal(26,25)))",
        f"named_struct('below', s.below, 'twice', CAST(2 * s.n AS {_WHOLE}), 'high', CAST(2 * {_over('s.size', limb)} AS {_WHOLE}), "
        f"'low', CAST(s.size % {limb} * 2 * {unit} + floor(s.part * 2 * {unit}) + s.n AS {_WHOLE}))",
        f"named_struct('below', s.below, 'twice', s.twice, 'high', {_over('s.high', 's.twice')}, "
        f"'low', CAST(CAST(s.high % s.twice * {limb} * {unit} AS {_WHOLE}) + s.low AS {_WHOLE}))",
        f"named_struct('below', s.below, 'high', s.high, 'units', {_over('s.low', 's.twice')})",
        f"CAST(concat(if(s.below, '-', ''), CAST(CAST(s.high * {limb} + {_over('s.units', unit)} AS {_WHOLE}) AS string), '.', "
        f"lpad(CAST(s.units % {unit} AS string), {digits}, '0')) AS double) + 0D",  # no negative zero
    ]
    bound = (
        f"array(named_struct('whole', CAST({whole} AS {_WHOLE}), 'rest', CAST({left} AS decimal(38,25)), 'n', CAST({n} AS {_WHOLE})))"
    )
    for step in steps:
        bound = f"transform({bound}, s -> {step})"
    return f"get({bound}, 0)"


def exact_avg(name: str, digits: int) -> Column:
    whole, left, fits = _sums(f"`{name}`")
    n = f"count(`{name}`)"
    other = f"round(avg(CAST(`{name}` AS double)), {digits})"
    return F.expr(f"CASE WHEN NOT {fits} THEN {other} WHEN {n} > 0 THEN {divided(whole, left, n, digits)} END")


def exact_sum(name: str, digits: int) -> Column:
    whole, left, fits = _sums(f"`{name}`")
    other = f"round(sum(CAST(`{name}` AS double)), {digits})"
    return F.expr(f"CASE WHEN {fits} THEN {divided(whole, left, '1', digits)} ELSE {other} END")


def exact_total(value: str) -> Column:
    """The sum of an expression as a double, the same bits for rows in any order."""
    whole, left, fits = _sums(value)
    return F.expr(f"CASE WHEN {fits} THEN CAST({whole} AS double) + CAST({left} AS double) ELSE sum({value}) END")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole over counts; NULL when whole is 0."""
    ratio = (part * 100).cast(_COUNT) / F.nullif(whole, F.lit(0)).cast(_COUNT)
    return F.round(ratio, digits).cast("double")


def share_of_total(count: str, digits: int = 1) -> Column:
    """Percent of a count in the total of the result rows.

    For aggregated frames with one row per label only: the total is taken over
    the whole frame in one task.
    """
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()), digits)
