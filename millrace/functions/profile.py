"""Birthday arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sign and its last day as month * 100 + day; later days fall back to the first sign.
ZODIAC = [
    ("摩羯座", 119),
    ("水瓶座", 218),
    ("双鱼座", 320),
    ("白羊座", 419),
    ("金牛座", 520),
    ("双子座", 621),
    ("巨蟹座", 722),
    ("狮子座", 822),
    ("处女座", 922),
    ("天秤座", 1023),
    ("天蝎座", 1122),
    ("射手座", 1221),
]


def zodiac_sign(birthday: Column) -> Column:
    day = F.month(birthday) * 100 + F.dayofmonth(birthday)
    sign = None
    for name, last in ZODIAC:
        sign = F.when(day <= last, name) if sign is None else sign.when(day <= last, name)
    return F.when(birthday.isNotNull(), sign.otherwise(ZODIAC[0][0]))


def whole_years(birthday: Column, as_of: Column) -> Column:
    """Completed years between two dates, counted on the calendar."""
    before_birthday = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (
        F.month(birthday) * 100 + F.dayofmonth(birthday)
    )
    return F.year(as_of) - F.year(birthday) - before_birthday.cast("int")


def birth_decade(birthday: Column) -> Column:
    return (F.floor(F.year(birthday) / 10) * 10).cast("int")
