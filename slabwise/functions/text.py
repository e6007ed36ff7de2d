"""Text forms used by the dumps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sanitize_name(path: Column) -> Column:
    """Array name of a dataset path: leading character dropped, ``/ : .`` to ``_``."""
    return F.translate(path.substr(F.lit(2), F.length(path)), "/:.", "___")


def c_number(value: Column) -> Column:
    """A number in six significant digits, as a C++ output stream prints it."""
    return _layout(_six_digits(value))


def c_numbers(values: Column) -> Column:
    """The same for each element of an array; each is formatted once."""
    return F.transform(F.transform(values, _six_digits), _layout)


def _six_digits(value: Column) -> Column:
    """Scientific text, rounded on the exact binary value (half to even), as C does."""
    return F.call_function("format_number", value.cast("double"), F.lit("0.#####E00"))


def _layout(scientific: Column) -> Column:
    """Fixed or exponent notation for the digits of a scientific text."""
    # Sign and body both always read the text, so generated code makes it once.
    sign = F.when(F.startswith(scientific, F.lit("-")), F.lit("-")).otherwise("")
    exponent = F.substring_index(scientific, "E", -1).try_cast("int")  # null for nan and inf
    digits = F.translate(F.substring_index(scientific, "E", 1), "-.", "")
    whole = F.rpad(digits, exponent + 1, "0")  # cuts or fills to the digits before the point
    fraction = F.concat(F.lit("."), digits.substr(exponent + 2, F.lit(6)))
    fixed = F.concat(whole, F.when(F.length(digits) > exponent + 1, fraction).otherwise(""))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    marked = F.replace(F.replace(scientific, F.lit("E-"), F.lit("e-")), F.lit("E"), F.lit("e+"))
    body = (
        F.when(exponent.between(0, 5), fixed)
        .when(exponent.between(-4, -1), small)
        .when(exponent.isNotNull(), F.ltrim(marked, F.lit("-")))
        .when(scientific == "NaN", F.lit("nan"))
        .when(scientific.isNotNull(), F.lit("inf"))
    )
    return F.concat(sign, body)
