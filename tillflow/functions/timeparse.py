"""Zone-free timestamp parsing and epoch conversion.

``try_to_timestamp`` reads text in the session zone, so a wall time that falls
in a daylight-saving gap moves. Here the text is anchored to UTC, parsed to an
instant, and the instant's micros are laid onto ``TIMESTAMP_NTZ`` epoch: the
wall time is kept as written, whatever the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp patterns offered for receipt files.
ISO_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)
DAY_FIRST_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy")
MONTH_FIRST_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")


def ntz_epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def parse_ntz(c: Column, formats=ISO_FORMATS) -> Column:
    """First format that parses wins; none gives null (a counted reject)."""
    anchored = F.concat(c, F.lit(" UTC"))
    parsed = [
        F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(anchored, F.lit(f + " VV"))), ntz_epoch())
        for f in formats
    ]
    return F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a zone-free timestamp (floor)."""
    iv = ts - ntz_epoch()
    return (
        F.extract(F.lit("DAY"), iv).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), iv).cast("bigint") * 3600
        + F.extract(F.lit("MINUTE"), iv).cast("bigint") * 60
        + F.floor(F.extract(F.lit("SECOND"), iv)).cast("bigint")
    )


def from_epoch_seconds(secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ntz_epoch())
