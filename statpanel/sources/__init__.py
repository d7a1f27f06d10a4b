"""Sources and sinks."""

from statpanel.sources.catalog import (
    create_missing_views,
    create_or_replace_views,
    create_table,
    describe_columns,
    view_names,
)
from statpanel.sources.columnar_json import name_document, read_columnar_json, write_columnar_json
from statpanel.sources.csv_tables import (
    export_database,
    import_csv,
    read_dictionary,
    run_script,
    write_csv,
)
from statpanel.sources.memory import Memo, cached, from_arrow, to_arrow
from statpanel.sources.requests import open_requests
from statpanel.sources.responses import fetch_requests, read_responses, write_responses
from statpanel.sources.scratch import scratch_path

__all__ = [
    "Memo",
    "cached",
    "create_missing_views",
    "create_or_replace_views",
    "create_table",
    "describe_columns",
    "export_database",
    "fetch_requests",
    "from_arrow",
    "import_csv",
    "name_document",
    "open_requests",
    "read_columnar_json",
    "read_dictionary",
    "read_responses",
    "run_script",
    "scratch_path",
    "to_arrow",
    "view_names",
    "write_columnar_json",
    "write_csv",
    "write_responses",
]
