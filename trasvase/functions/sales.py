"""Column expressions for raw sales lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday number to its Spanish name.
WEEKDAY_NAMES = {
    1: "Lunes", 2: "Martes", 3: "Miércoles", 4: "Jueves", 5: "Viernes", 6: "Sábado", 7: "Domingo",
}

UNKNOWN_STORE = "OTROS CENTROS"


def whole_number(value: Column) -> Column:
    """Text or number to int; '905.0' is 905, anything unreadable is null."""
    return value.try_cast("double").try_cast("int")


def hour_of(hhmm: Column) -> Column:
    return F.floor(whole_number(hhmm) / 100).cast("int")


def minute_of(hhmm: Column) -> Column:
    return F.pmod(whole_number(hhmm), F.lit(100)).cast("int")


def sale_date(text: Column) -> Column:
    """``dd/mm/yyyy`` to a date, null where it is not one."""
    return F.try_to_date(F.trim(text), "d/M/yyyy")


def sale_moment(day: Column, hour: Column, minute: Column) -> Column:
    """Date, hour and minute to a timestamp; null when any is missing or the time does not exist."""
    return F.try_make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0))


def moment_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a cast, as formatting would go through the session's time zone and its clock changes."""
    return moment.cast("string")


def iso_weekday(moment: Column) -> Column:
    return (F.weekday(moment) + 1).cast("int")


def weekday_name(number: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in WEEKDAY_NAMES.items() for x in pair])
    return F.try_element_at(names, number)


def weekend_flag(number: Column) -> Column:
    """A missing date counts as not weekend."""
    return F.when(F.coalesce(number.isin(6, 7), F.lit(False)), "SI").otherwise("NO")


def store_code(label: Column) -> Column:
    """Last three to five digits of a store label without leading zeros; null when it ends in no digits."""
    digits = F.regexp_extract(label, r"(\d{3,5})\s*$", 1)
    return F.nullif(digits, F.lit("")).cast("int").cast("string")


def country_of_file(name: Column) -> Column:
    return F.when(name.endswith("1.csv"), "ES").when(name.endswith("2.csv"), "PT")


def cents_to_currency(cents: Column) -> Column:
    return F.round(cents.try_cast("double") / 100, 2)


def in_file_scope(name: Column, after: str, until: str) -> Column:
    """File names made of digits only whose leading yyyymmdd lies in ``(after, until]``."""
    stamp = F.regexp_extract(name, r"^([0-9]{1,8})[0-9]*\.csv$", 1)
    return (stamp != "") & (stamp > after.replace("-", "")) & (stamp <= until.replace("-", ""))
