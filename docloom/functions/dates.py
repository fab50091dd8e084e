"""Date parsing; everything ends up in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "dd MMM yyyy HH:mm:ss Z", "yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy")


def pdf_date(text: Column) -> Column:
    """D:yyyyMMddHHmmss with an optional zone such as -05'00', or D:yyyyMMdd; the zone's sign counts."""
    at = r"^D:(\d{8})(\d{6})?(?:([+-])(\d{2})'?(\d{2})?'?|Z)?.*$"
    digits = F.concat(F.regexp_extract(text, at, 1), F.rpad(F.regexp_extract(text, at, 2), 6, "0"))
    sign = F.when(F.regexp_extract(text, at, 3) == "-", F.lit(1)).otherwise(F.lit(-1))
    minutes = F.coalesce(F.regexp_extract(text, at, 4).try_cast("int"), F.lit(0)) * 60 + F.coalesce(F.regexp_extract(text, at, 5).try_cast("int"), F.lit(0))
    base = F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))
    return F.when(F.rlike(text, F.lit(at)), F.timestamp_seconds(F.unix_timestamp(base) + sign * minutes * 60))


def flexible_date(text: Column) -> Column:
    """Seconds since 1970, a PDF date, or one of FORMATS (a weekday before it is skipped); null if none fits."""
    epoch = F.when(F.rlike(text, F.lit(r"^\d{9,10}(\.\d+)?$")), F.timestamp_seconds(text.try_cast("double")))
    plain = F.regexp_replace(text, "^[A-Za-z]{3}, ", "")
    return F.coalesce(epoch, pdf_date(text), *[F.try_to_timestamp(F.nullif(plain, F.lit("")), F.lit(f)) for f in FORMATS])


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
