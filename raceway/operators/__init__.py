from raceway.operators.combine import lookup_left, request_manifest, union_batches
from raceway.operators.curve import cluster_on_curve, place_on_curve
from raceway.operators.history import asof_left, intervals
from raceway.operators.keyed import (
    day_key,
    dedupe_by,
    dedupe_rows,
    distinct_keys,
    latest_narrow,
    latest_per_key,
    surrogate_key,
    surrogate_key_append,
)
from raceway.operators.partials import (
    add_partials,
    compact_partials,
    means_of,
    merge_partials,
    partial_sums,
    read_partials,
)
from raceway.operators.quality import (
    ContractError,
    align_to_contract,
    check_unique,
    contract_violations,
    enforce_contract,
    guard_contract,
    require_rows,
)
from raceway.operators.shape import (
    daily_mean,
    fill_sentinel,
    fill_text,
    map_lookup,
    reshape,
    stringify,
    strip_attributes,
)

__all__ = [
    "ContractError",
    "add_partials",
    "align_to_contract",
    "asof_left",
    "check_unique",
    "cluster_on_curve",
    "compact_partials",
    "contract_violations",
    "daily_mean",
    "day_key",
    "dedupe_by",
    "dedupe_rows",
    "distinct_keys",
    "enforce_contract",
    "fill_sentinel",
    "fill_text",
    "guard_contract",
    "intervals",
    "latest_narrow",
    "latest_per_key",
    "lookup_left",
    "map_lookup",
    "means_of",
    "merge_partials",
    "partial_sums",
    "place_on_curve",
    "read_partials",
    "request_manifest",
    "require_rows",
    "reshape",
    "stringify",
    "strip_attributes",
    "surrogate_key",
    "surrogate_key_append",
    "union_batches",
]
