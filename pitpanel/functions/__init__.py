"""Column-level helpers: canonical JSON, content hash, time parts, casts."""

from pitpanel.functions.canonical import canonical_json, content_hash, json_text
from pitpanel.functions.timeparts import floor_to, partition_parts, run_stamp, parse_iso
from pitpanel.functions.scalars import to_double, flatten_nested, profile_text

__all__ = [
    "canonical_json", "content_hash", "json_text", "floor_to", "partition_parts",
    "run_stamp", "parse_iso", "to_double", "flatten_nested", "profile_text",
]
