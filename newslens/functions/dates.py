"""Dates found in text and in URLs, and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newslens.functions.text import let


def _date(text: Column, pattern: str, groups: tuple[int, int, int]) -> Column:
    """The date of the first match, NULL unless it is a calendar date of year 1 or later.

    Checked by arithmetic: parsing bad dates costs an exception for each row.
    """
    def check(ymd: Column) -> Column:
        year, month, day = ymd["y"], ymd["m"], ymd["d"]
        days = F.when(month.between(1, 12) & (year >= 1),
                      F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1)))))
        return F.when((day >= 1) & (day <= days), F.make_date(year, month, day))

    def parts(match: Column) -> Column:
        return F.when(match != "", let(F.struct(*[
            F.regexp_extract(match, pattern, group).cast("int").alias(name)
            for name, group in zip("ymd", groups)]), check))

    return let(F.regexp_extract(text, pattern, 0), parts)


def date_from_text(text: Column, documented: bool = False) -> Column:
    """First valid date by ordered patterns (T4).

    Only the first match of each pattern is tried. Strictly, ``M/D/Y`` and
    ``Y.M.D`` never yield a date; ``documented=True`` reads them as well.
    """
    patterns = [
        (r"([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日", (1, 2, 3)),
        (r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", (1, 2, 3)),
    ]
    if documented:
        patterns += [
            (r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", (3, 1, 2)),
            (r"([0-9]{4})\.([0-9]{1,2})\.([0-9]{1,2})", (1, 2, 3)),
        ]
    return F.coalesce(*[_date(text, pattern, groups) for pattern, groups in patterns])


def date_from_url(url: Column, extended: bool = True) -> Column:
    """Date in ``/2017-02/17/`` and, when ``extended``, in ``/a/201702/17/`` (T5)."""
    old = r"([0-9]{4})-([0-9]{2})/([0-9]{2})"
    new = r"/a/([0-9]{4})([0-9]{2})/([0-9]{2})/"
    return F.coalesce(*[_date(url, p, (1, 2, 3)) for p in ((old, new) if extended else (old,))])


def month_of(date: Column) -> Column:
    """``yyyy-MM`` cut from the date's own text, which needs no formatter per row."""
    return F.substring(date.cast("string"), 1, 7)


def month_end(month: Column) -> Column:
    return F.last_day(F.to_date(F.concat(month, F.lit("-01"))))


def in_month(date: Column, month: str) -> Column:
    """Month test as a date range, which Parquet readers can push down."""
    first = F.to_date(F.lit(f"{month}-01"))
    return (date >= first) & (date < F.add_months(first, 1))
