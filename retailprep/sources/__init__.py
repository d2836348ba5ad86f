from .manifest import file_manifest, write_manifest
from .read import (
    MissingNames,
    column_or_null,
    find_column,
    first_column,
    latest_path,
    normalise_headers,
    optional,
    read_dictionary,
    read_feed,
    read_latest,
    schema_groups,
    with_columns_or_null,
)
from .stored import extend_history, publish_version, read_history, store_bucketed, write_history
from .write import publish, write_feed

__all__ = [
    "MissingNames",
    "column_or_null",
    "extend_history",
    "file_manifest",
    "find_column",
    "first_column",
    "latest_path",
    "normalise_headers",
    "optional",
    "publish",
    "publish_version",
    "read_dictionary",
    "read_feed",
    "read_history",
    "read_latest",
    "schema_groups",
    "store_bucketed",
    "with_columns_or_null",
    "write_feed",
    "write_history",
    "write_manifest",
]
