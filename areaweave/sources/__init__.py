from areaweave.sources.catalog import append_table, find_table, open_table, publish, replace_table
from areaweave.sources.files import (
    CROSSWALK_SCHEMA, SCORE_SCHEMA, export_csv, read_crosswalk, read_csv, write_crosswalk,
)

__all__ = [
    "CROSSWALK_SCHEMA", "SCORE_SCHEMA", "append_table", "export_csv", "find_table", "open_table",
    "publish", "read_crosswalk", "read_csv", "replace_table", "write_crosswalk",
]
