"""Sources and sinks."""

from stayledger.sources.tables import (
    coerce_dates,
    Landed,
    export_predictions,
    land_csv,
    load_split,
    load_splits,
    load_table,
    read_csv,
    read_source,
    register_view,
    require_paths,
    roundtrip_check,
    select_split,
    write_metadata,
    write_splits,
    write_table,
)

__all__ = [
    "coerce_dates",
    "Landed",
    "export_predictions",
    "land_csv",
    "load_split",
    "load_splits",
    "load_table",
    "read_csv",
    "read_source",
    "register_view",
    "require_paths",
    "roundtrip_check",
    "select_split",
    "write_metadata",
    "write_splits",
    "write_table",
]
