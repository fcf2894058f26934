"""Sources: monthly raw files, saved tables, literal rows, test-table adaptor."""

from farecast.sources.files import monthly_path, read_format, read_months, read_table, read_trips, trips_from_rows
from farecast.sources.fixtures import events_table, land_monthly, raw_trips_from_events

__all__ = [
    "events_table",
    "land_monthly",
    "monthly_path",
    "raw_trips_from_events",
    "read_format",
    "read_months",
    "read_table",
    "read_trips",
    "trips_from_rows",
]
