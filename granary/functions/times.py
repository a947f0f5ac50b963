"""Source clocks and effective intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"
ZONE = r"[T ].*(Z|[+-][0-9]{2}:?[0-9]{2})$"


def parse(x: Column) -> Column:
    """struct<aware, micros> of an ISO time in extended form with a full date, else null. Naive times float: they are ordered
    among themselves only."""
    aware = x.rlike(ZONE)
    zoned = F.when(aware, x).when(F.length(x) == 10, F.concat(x, F.lit("T00:00:00Z"))).otherwise(F.concat(x, F.lit("Z")))
    micros = F.unix_micros(F.try_to_timestamp(zoned))
    return F.when(x.rlike(STAMP) & micros.isNotNull(), F.struct(aware.alias("aware"), micros.alias("micros")))


def clock(times: Column) -> Column:
    """struct<kind, lo, hi, values> of a set of times: kind is aware, naive, mixed, unparsed or none."""
    parsed = F.transform(times, parse)
    kinds = F.array_distinct(F.transform(parsed, lambda p: p["aware"]))
    kind = F.when(F.coalesce(F.size(times), F.lit(0)) <= 0, "none").when(F.exists(parsed, lambda p: p.isNull()), "unparsed").when(F.size(kinds) > 1, "mixed").when(F.element_at(kinds, 1), "aware").otherwise("naive")
    values = F.array_sort(F.array_distinct(F.transform(parsed, lambda p: p["micros"])))
    return F.struct(kind.alias("kind"), F.array_min(values).alias("lo"), F.array_max(values).alias("hi"), values.alias("values"))


def chronology(a: Column, b: Column) -> Column:
    """before, after, same or unknown of two clocks."""
    known = a["kind"].isin("aware", "naive") & (a["kind"] == b["kind"])
    return F.when(~known, "unknown").when(a["hi"] < b["lo"], "before").when(a["lo"] > b["hi"], "after").when(a["values"] == b["values"], "same").otherwise("unknown")


def bound(x: Column, upper: bool) -> Column:
    """First or last day that a year, month, day or time stands for; local date of a time; null if invalid."""
    n = F.length(x)
    day = F.try_to_date(F.concat(F.substring(x, 1, 10), F.when(n == 4, "-01-01").when(n == 7, "-01").otherwise("")))
    clock_ok = (n <= 10) | F.try_to_timestamp(F.regexp_replace(x, "(Z|[+-][0-9]{2}:?[0-9]{2})$", "")).isNotNull()
    valid = x.rlike(f"(?:^[0-9]{{4}}(?:-[0-9]{{2}})?$)|(?:{STAMP})") & clock_ok
    if not upper:
        return F.when(valid, day)
    return F.when(valid, F.when(n > 7, day).otherwise(F.last_day(F.add_months(day, F.when(n == 4, 11).otherwise(0)))))


def until(start: Column, end: Column, precision: Column) -> Column:
    """The date whose last day ends an anchor: its end, or the year, month or day of its start."""
    return F.when(end.isNotNull(), end).when(precision == "year", F.substring(start, 1, 4)).when(precision == "month", F.substring(start, 1, 7)).otherwise(start)
