"""Sources and sinks: landing documents, lake zones, JDBC tables."""

from citylake.sources.jdbc import read_jdbc, write_jdbc
from citylake.sources.landing import LISTING_LOOKUP_FILE, explode_lookup, read_landing, read_lookup
from citylake.sources.zone import Zone

__all__ = ["LISTING_LOOKUP_FILE", "Zone", "explode_lookup", "read_jdbc", "read_landing", "read_lookup",
           "write_jdbc"]
