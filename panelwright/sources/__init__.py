from panelwright.sources.files import (
    FILE_ORDER,
    clean_headers,
    keep_existing,
    melt_delimited,
    read_delimited,
    read_sheet_export,
    read_with_preamble,
    year_columns,
)
from panelwright.sources.seeds import (
    POWER_SOURCES,
    SOURCE_LABELS,
    literal_rows,
    power_source_seed,
    source_labels,
)
from panelwright.sources.views import as_views, pick
from panelwright.sources.workbook import WorkbookSource, read_workbook, write_workbooks

__all__ = [
    "FILE_ORDER",
    "POWER_SOURCES",
    "SOURCE_LABELS",
    "WorkbookSource",
    "as_views",
    "clean_headers",
    "keep_existing",
    "literal_rows",
    "melt_delimited",
    "pick",
    "power_source_seed",
    "read_delimited",
    "read_sheet_export",
    "read_with_preamble",
    "read_workbook",
    "source_labels",
    "write_workbooks",
    "year_columns",
]
