from sessionlab.sources.tables import read_table  # noqa: F401
from sessionlab.sources.events import (  # noqa: F401
    RAW_EVENT_SCHEMA, read_events_csv, scan_periods_csv, shop_events, shop_events_base,
    sessionize, wide_events, write_events_csv,
)
