from headway.sources.feed import decode_feed, feed_message_class, require_feed  # noqa: F401
from headway.sources.snapshots import (  # noqa: F401
    archive_snapshots,
    latest_snapshot,
    read_archive,
    read_snapshots,
)
from headway.sources.tables import Catalog, FolderCatalog  # noqa: F401
from headway.sources.timetable import read_timetable  # noqa: F401
