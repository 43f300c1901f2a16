"""Sinks: mode writes, date-partitioned archive, versioned keyed table store, digests."""

from courtline.sinks.files import (  # noqa: F401
    WriteResult,
    read_archive,
    write_archive,
    write_mode,
)
from courtline.sinks.store import TableStore, bucket_of  # noqa: F401
