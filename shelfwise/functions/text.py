"""Text to values: missing-value tokens, numbers, prices, slugs, words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import NA_TOKENS

# Plain decimal notation with optional exponent. Spark's own cast would also
# take `1d`, `1f` and hexadecimal floats.
_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_INFINITY = r"^[+-]?(?i:inf(?:inity)?)$"
_NUMBER_OR_INFINITY = f"{_NUMBER}|{_INFINITY}"
_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
# Sign, digits before and after the point, exponent.
_PARTS = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"


def na_to_null(text: Column) -> Column:
    """NULL for a missing-value token, else the text unchanged."""
    return F.when(~text.isin(NA_TOKENS), text)


def to_number(text: Column) -> Column:
    """Text as DOUBLE; NULL where it is not a plain number or too large for one."""
    number = text.try_cast("double")
    return F.when(text.rlike(_NUMBER_OR_INFINITY) & ((F.abs(number) < F.lit(float("inf"))) | text.rlike(_INFINITY)), number)


# A number's key is made in steps, each of which uses the one before several times.
# They are bound as variables of one-element transforms, so that none is spelled out
# again wherever it is used, and nothing but whole numbers is part of generated code.


def whole_number(text: Column) -> Column:
    """Text as BIGINT where it is a whole number of up to 18 digits, as nearly all
    identifiers are; else NULL."""
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def _parts(text: Column) -> Column:
    """Sign, digits before and after the point, and exponent of a number; NULL for
    any other text."""
    return F.when(text.rlike(_NUMBER), F.split(F.regexp_replace(text, _PARTS, "$1,$2,$3,$4"), ","))


def _significant(parts: Column) -> Column:
    """All digits of a number from its first one that is not 0 on."""
    return F.ltrim(F.concat(parts[1], parts[2]), F.lit("0"))


def _scaled(parts: Column, digits: Column) -> Column:
    """The digits without zeros at the end, the power of ten they are multiplied by,
    and the exponent as it is written; the power is NULL if that has over 17 digits."""
    short = F.rtrim(digits, F.lit("0"))
    shift = F.length(digits) - F.length(short) - F.length(parts[2])
    size = F.regexp_replace(parts[3], "^[+-]?0*", "")
    exponent = F.concat(F.when(parts[3].startswith("-"), "-").otherwise(""), size)
    power = F.when(size == "", F.lit(0).cast("bigint")).when(F.length(size) <= 17, exponent.try_cast("bigint")) + shift
    return F.struct(short.alias("short"), power.alias("power"), shift.alias("shift"), exponent.alias("exponent"))


def _scaled_key(text: Column, parts: Column, number: Column) -> Column:
    """The key of a number from its parts, of an infinity from its text."""
    sign = F.when(parts[0] == "-", "-").otherwise("")
    short, power = number["short"], number["power"]
    key = (
        F.when(short == "", "0")
        .when(power.isNull(), F.concat(sign, short, F.lit("e"), number["exponent"], F.lit("e"), number["shift"].cast("string")))
        .when(power.between(0, 30), F.concat(sign, short, F.repeat(F.lit("0"), power.cast("int"))))
        .otherwise(F.concat(sign, short, F.lit("e"), power.cast("string")))
    )
    infinite = F.concat(F.when(text.startswith("-"), "-").otherwise(""), F.lit("inf"))
    return F.when(parts.isNotNull(), key).when(text.rlike(_INFINITY), infinite)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def other_key(text: Column, whole: Column) -> Column:
    """The `number_key` of a text that is no `whole_number`, else NULL."""
    key = _bound(
        _parts(text),
        lambda parts: _bound(
            _significant(parts),
            lambda digits: _bound(_scaled(parts, digits), lambda number: _scaled_key(text, parts, number)),
        ),
    )
    return F.when(whole.isNull(), key)


def number_key(text: Column) -> Column:
    """One text for each number, however it is written: `12`, `12.0` and `1.2e1`
    are `12`, `1.50` is `15e-1`. No digit is lost, so different numbers stay
    apart; text that is no number is NULL. Numbers with an exponent of over 17
    digits have the same key only if they are written with the same exponent.

    See `operators.keys` for whole columns of a frame."""
    return _bound(whole_number(text), lambda whole: F.coalesce(whole.cast("string"), other_key(text, whole)))


def key_to_identifier(key: Column) -> Column:
    """The BIGINT that a `number_key` names, NULL if it names none."""
    return key.try_cast("bigint")


def to_identifier(text: Column) -> Column:
    """Text as BIGINT; `12`, `12.0` and `1.2e1` agree, fractions give NULL."""
    return F.coalesce(whole_number(text), key_to_identifier(number_key(text)))


def parse_price(text: Column) -> Column:
    """Digits and dots of a price text as DOUBLE; sign and symbols are dropped.

    `₹3,995.00` is 3995.0, `Rs. 500` is 0.5, `1.2.3` and `.` are NULL.
    """
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("double")


def slug(text: Column) -> Column:
    """Lower case, outer blanks off, inner runs of blanks to one hyphen."""
    trimmed = F.regexp_replace(F.lower(text), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(trimmed, r"(?U)\s+", "-")


def word_count(text: Column) -> Column:
    """Number of blank-separated words; NULL for NULL, 0 for empty text."""
    return F.regexp_count(text, F.lit(r"(?U)\S+"))
