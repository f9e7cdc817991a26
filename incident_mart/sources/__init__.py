"""Readers and writers."""

from .files import (
    append_csv,
    append_rows,
    exists,
    preview,
    read_csv,
    read_parquet_as,
    remove,
    replace_rows,
    save_table,
    store,
    store_counted,
)
from .pages import (
    explode_bodies,
    read_json_pages,
    read_json_stream,
    read_sent_fields,
    sent_fields,
    write_json_pages,
)
from .tables import (
    as_view,
    compact_table,
    create_table_if_absent,
    insert_only_merge,
    live_loads,
    read_table,
    refresh_views,
    remove_replaced,
)

__all__ = [
    "append_csv",
    "append_rows",
    "as_view",
    "compact_table",
    "create_table_if_absent",
    "exists",
    "explode_bodies",
    "insert_only_merge",
    "live_loads",
    "preview",
    "read_csv",
    "read_json_pages",
    "read_json_stream",
    "read_parquet_as",
    "read_sent_fields",
    "read_table",
    "refresh_views",
    "remove",
    "remove_replaced",
    "replace_rows",
    "save_table",
    "sent_fields",
    "store",
    "store_counted",
    "write_json_pages",
]
