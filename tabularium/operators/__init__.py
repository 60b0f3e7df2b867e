"""DataFrame -> DataFrame steps."""

from tabularium.operators.balanced import balanced_join, hot_keys
from tabularium.operators.clean import active_only, drop_missing, fill_code, fill_text
from tabularium.operators.consolidate import consolidate, consolidation_profile
from tabularium.operators.dedup import dedup_count, dedup_first, last_wins
from tabularium.operators.lookups import join_lookup, join_lookups, keep_known, lookup_misses, measured_bytes
from tabularium.operators.profile import (
    count_sketches,
    distinct_values,
    estimated_counts,
    merge_sketches,
    null_audit,
    preview,
    row_counts,
    schema_profile,
)
