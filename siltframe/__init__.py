"""Curate and query archives of dated sediment-core records with Spark."""

from .operators.harmonise import get_entity, get_links
from .operators.changes import rm_links
from .plans.snapshot import NoRecords, Snapshot, snapshot, snapshot_stats
from .plans.summary import db_summary, db_summary_totals
from .session import configure
from .sources.files import write_csvs
from .sources.tables import Archive, create_archive, load_archive, load_archive_jdbc, write_archive

__all__ = [
    "Archive",
    "NoRecords",
    "Snapshot",
    "configure",
    "create_archive",
    "db_summary",
    "db_summary_totals",
    "get_entity",
    "get_links",
    "load_archive",
    "load_archive_jdbc",
    "rm_links",
    "snapshot",
    "snapshot_stats",
    "write_archive",
    "write_csvs",
]
