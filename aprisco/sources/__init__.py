from aprisco.sources.raw import RawZone, replicate
from aprisco.sources.schemas import RAW_TABLES, RawTable, raw_table
from aprisco.sources.sinks import (
    append_failures,
    append_rows,
    read_fact,
    read_history,
    register_view,
    run_snapshot,
    write_fact,
    write_table,
)

__all__ = [
    "RAW_TABLES",
    "RawTable",
    "RawZone",
    "append_failures",
    "append_rows",
    "raw_table",
    "read_fact",
    "read_history",
    "register_view",
    "replicate",
    "run_snapshot",
    "write_fact",
    "write_table",
]
