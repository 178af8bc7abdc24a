"""Reading and writing tables and report documents."""

from ebbtide.sources.publishing import Publication, published
from ebbtide.sources.reports import (
    REPORT_SCHEMA,
    build_report,
    read_report,
    report_importances,
    report_metrics,
    write_report,
)
from ebbtide.sources.staging import shared_dir, staged, staging_path
from ebbtide.sources.subscribers import SUBSCRIBER_SCHEMA
from ebbtide.sources.tables import (
    collect_small,
    input_counts,
    read_cells,
    read_table,
    rescued_cells,
    small_table,
    table_format,
    typed,
    write_csv,
)

__all__ = [
    "Publication",
    "REPORT_SCHEMA",
    "SUBSCRIBER_SCHEMA",
    "build_report",
    "collect_small",
    "input_counts",
    "published",
    "read_cells",
    "read_report",
    "read_table",
    "report_importances",
    "report_metrics",
    "rescued_cells",
    "shared_dir",
    "small_table",
    "staged",
    "staging_path",
    "table_format",
    "typed",
    "write_csv",
    "write_report",
]
