"""Calendar dates of UTC instants.

Sources deliver instants as ``timestamp_ntz`` in UTC (see ``sources.vault``), so the
results do not depend on the zone of the session.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BILLING_ZONE = "Europe/Berlin"
NO_END = "9999-12-31"
FIRST_DAY_EXCLUDED = "2019-07-30"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def local_date(instant: Column | str, zone: str = BILLING_ZONE) -> Column:
    """Calendar day of a UTC instant in the billing zone.

    In a UTC session, as recommended, the shift with a constant zone is many times
    cheaper than the general conversion; other sessions get the general one.
    """
    if _session_is_utc():
        return F.to_date(F.from_utc_timestamp(_col(instant), zone))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(instant)))


def _session_is_utc() -> bool:
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z")


def utc_date(instant: Column | str) -> Column:
    return F.to_date(_col(instant))


def day(text: str) -> Column:
    """A date constant."""
    return F.lit(text).cast("date")


def after_day(instant: str, text: str, zone: str = BILLING_ZONE) -> Column:
    """Instants on a later calendar day than ``text``.

    The bare column is compared with the instant at which the next day begins, so the test
    reaches the scan, where files and row groups without such rows are skipped.
    """
    next_day = dt.datetime.fromisoformat(text) + dt.timedelta(days=1)
    begin = next_day.replace(tzinfo=ZoneInfo(zone)).astimezone(dt.UTC).replace(tzinfo=None)
    return F.col(instant) >= F.lit(begin.isoformat(sep=" ")).cast("timestamp_ntz")


def german_date(text: Column | str) -> Column:
    """Parse ``31.12.2023``; anything unparsable becomes null."""
    return F.to_date(F.try_to_timestamp(_col(text), F.lit("dd.MM.yyyy")))


def hour_of(instant: Column | str) -> Column:
    """Start of the hour; an equal-hours test becomes an equi-join on this key."""
    return F.date_trunc("hour", _col(instant))
