"""String columns: lenient parsing, identifiers, telephone numbers. None of these fails on dirty values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import LICENSE_CLASSES, STATE_OF_CODE


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def lenient_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(F.trim(c.cast("string")))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def filled(c: Column) -> Column:
    """Not null and, as text, not empty."""
    return c.isNotNull() & (c.cast("string") != "")


def _check_digit(numbers: Column, n: int) -> Column:
    """Modulo-11 digit over the first ``n`` numbers, weighted n + 1 down to 2; ten counts as zero."""
    products = F.zip_with(F.slice(numbers, 1, n), F.sequence(F.lit(n + 1), F.lit(2), F.lit(-1)), lambda d, w: d * w)
    return F.aggregate(products, F.lit(0), lambda a, x: a + x) * 10 % 11 % 10


def tax_id_ok(c: Column) -> Column:
    """Eleven digits, not all the same, whose last two are the check digits of those before. False for null."""
    plain = digits(c)
    numbers = F.transform(F.split(plain, ""), lambda d: d.try_cast("int"))
    right = (F.get(numbers, F.lit(9)) == _check_digit(numbers, 9)) & (F.get(numbers, F.lit(10)) == _check_digit(numbers, 10))
    shaped = plain.rlike("^[0-9]{11}$") & ~plain.rlike(r"^(.)\1{10}$")
    return F.coalesce(F.when(shaped, right), F.lit(False))


def license_ok(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]{11}$"), F.lit(False))


def license_class_ok(c: Column) -> Column:
    return F.coalesce(c.isin(LICENSE_CLASSES), F.lit(False))


def plate_ok(c: Column) -> Column:
    """Old and new plates: three letters, a digit, a letter or digit, two digits."""
    return F.coalesce(c.rlike("^[A-Z]{3}[0-9][A-Z0-9][0-9]{2}$"), F.lit(False))


def national_phone(c: Column) -> Column:
    """Area code and number: digits without the country code (55, where 12 digits or more) and leading zeros."""
    return F.regexp_replace(F.regexp_replace(digits(c), "^55(?=[0-9]{10})", ""), "^0+", "")


def area_code(c: Column) -> Column:
    return F.substring(national_phone(c), 1, 2)


def state_of(code: Column) -> Column:
    """State of an area code; null for one that does not exist."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in STATE_OF_CODE.items() for x in kv)), code)


def phone_ok(c: Column) -> Column:
    """A known area code, then eight digits from 2 up or nine that start with 9. False for null."""
    number = national_phone(c)
    return F.coalesce(number.rlike("^[0-9]{2}([2-9][0-9]{7}|9[0-9]{8})$") & state_of(F.substring(number, 1, 2)).isNotNull(), F.lit(False))
