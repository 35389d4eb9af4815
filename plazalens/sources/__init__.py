"""Reading posts."""

from .inference import infer_schema, line_schema, path_profile, undeclared_fields
from .posts import (
    FLAT_FIELDS,
    POST_FIELDS,
    POST_SCHEMA,
    PostFields,
    dedup_report,
    deduplicate,
    distinct_flat,
    flatten,
    parse_posts,
    read_posts,
    row_digest,
)

__all__ = [
    "FLAT_FIELDS",
    "POST_FIELDS",
    "POST_SCHEMA",
    "PostFields",
    "dedup_report",
    "deduplicate",
    "distinct_flat",
    "flatten",
    "infer_schema",
    "line_schema",
    "parse_posts",
    "path_profile",
    "read_posts",
    "row_digest",
    "undeclared_fields",
]
