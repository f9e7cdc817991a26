"""DataFrame operators. Column names are parameters; nothing here starts a job."""

from .cleaning import drop_incomplete
from .contract import contract_report, required, schema_contract
from .keys import with_surrogate_key
from .latest import join_on_key, latest_per_group
from .merge import (
    counted_keys,
    key_status,
    merged,
    rows_of_new_keys,
    status_of,
    unmatched_rows,
)
from .paging import (
    drop_later_pages,
    first_page_wins,
    first_unusable,
    page_ledger,
    page_prefix,
    repeated_keys,
    rows_kept,
)
from .projection import assert_columns, keep_columns, replace_columns, with_computed
from .sampling import sample_rows

__all__ = [
    "assert_columns",
    "contract_report",
    "counted_keys",
    "drop_incomplete",
    "drop_later_pages",
    "first_page_wins",
    "first_unusable",
    "join_on_key",
    "keep_columns",
    "key_status",
    "latest_per_group",
    "merged",
    "page_ledger",
    "page_prefix",
    "repeated_keys",
    "replace_columns",
    "required",
    "rows_kept",
    "rows_of_new_keys",
    "sample_rows",
    "schema_contract",
    "status_of",
    "unmatched_rows",
    "with_computed",
    "with_surrogate_key",
]
