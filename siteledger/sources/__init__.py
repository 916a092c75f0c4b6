"""Landing, layering, layout and fingerprinting of tables."""

from .digests import changed, partition_digests, tree_digest, verify_partitions
from .fingerprint import fingerprint, manifest, verify
from .landing import land, land_all, pin, publish, sample_extract, write_fact
from .layout import analyze_columns, column_statistics, write_clustered
from .raw import RAW_FEEDS, read_raw, text_schema
from .versions import AuditError, current_version, publish_all, read_current, replace_all

__all__ = ["AuditError", "RAW_FEEDS", "analyze_columns", "changed", "column_statistics", "current_version", "fingerprint",
           "land", "land_all", "manifest", "partition_digests", "pin", "publish", "publish_all", "read_current", "read_raw",
           "replace_all", "sample_extract", "text_schema", "tree_digest", "verify", "verify_partitions", "write_clustered",
           "write_fact"]
