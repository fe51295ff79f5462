"""Sources and sinks: delimited loads with strict/lenient typing, snapshots, CSV export."""

from kempt.sources import delimited, snapshot

__all__ = ["delimited", "snapshot"]
