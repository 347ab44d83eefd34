"""Calendar rules as column expressions (no lookup table to broadcast).

Easter Sunday uses the anonymous Gregorian computus (Meeus/Jones/Butcher), in
integer arithmetic, so it runs per row inside codegen and the same formula can
be written in any SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brazilian national holidays on fixed dates (month-day), by law.
BR_FIXED_HOLIDAYS = ["01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]
# Fixed value: 20 November became a national holiday from 2024 on.
BR_BLACK_CONSCIOUSNESS_DAY = ("11-20", 2024)
# Fixed value: Good Friday, the one national holiday that moves with Easter (days from Easter Sunday).
BR_EASTER_OFFSETS = [-2]
# Optional points (not national holidays by law): Carnival Monday and Tuesday, Corpus Christi.
BR_OPTIONAL_EASTER_OFFSETS = [-48, -47, 60]


def easter_sunday(year: Column) -> Column:
    y = year.cast("int")
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100).cast("int")
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4).cast("int")
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = F.pmod(a * 19 + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4).cast("int")
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(e * 2 + i * 2 - h - k + 32, F.lit(7))
    m = F.floor((a + h * 11 + l_ * 22) / 451).cast("int")
    n = h + l_ - m * 7 + 114
    month = F.floor(n / 31).cast("int")
    day = F.pmod(n, F.lit(31)) + 1
    return F.make_date(y, month, day)


def is_br_national_holiday(date_col: Column, include_optional: bool = False) -> Column:
    md = F.date_format(date_col, "MM-dd")
    fixed = md.isin(BR_FIXED_HOLIDAYS)
    md_bc, since = BR_BLACK_CONSCIOUSNESS_DAY
    black_consciousness = (md == md_bc) & (F.year(date_col) >= since)
    easter = easter_sunday(F.year(date_col))
    offsets = BR_EASTER_OFFSETS + (BR_OPTIONAL_EASTER_OFFSETS if include_optional else [])
    movable = F.lit(False)
    for off in offsets:
        movable = movable | (date_col == F.date_add(easter, off))
    return fixed | black_consciousness | movable
