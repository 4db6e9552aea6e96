"""Clock helpers. The clock is always an argument, never read inside a plan."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zone_shift(server_time: Column, zone: str, server_zone: str = "Europe/London") -> Column:
    """Server wall time as wall time in ``zone``, by the offset valid at that time."""
    return F.convert_timezone(F.lit(server_zone), F.lit(zone), server_time)


def cache_ttl(now: Column, item_id: Column) -> Column:
    """Now plus 4 to 8 hours, spread by item id and the current second."""
    hours = F.pmod(item_id + F.second(now), F.lit(5)) + 4
    return now + F.make_dt_interval(hours=hours.cast("int"))
