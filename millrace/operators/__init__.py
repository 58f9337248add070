from .intervals import Buckets, interval_join, with_validity
from .pick import first_per_key, latest_value
from .quality import flags, reject_reason, split_rejects
from .scd2 import scd2_build
from .upsert import (
    changed_only,
    insert_if_absent,
    upsert_guarded,
    upsert_latest,
    upsert_partial,
    upserted_keys,
)

__all__ = [
    "Buckets",
    "changed_only",
    "first_per_key",
    "flags",
    "insert_if_absent",
    "interval_join",
    "latest_value",
    "reject_reason",
    "scd2_build",
    "split_rejects",
    "upsert_guarded",
    "upsert_latest",
    "upsert_partial",
    "upserted_keys",
    "with_validity",
]
