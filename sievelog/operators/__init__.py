from sievelog.operators.analytics import (
    detect_anomalies,
    error_baseline,
    error_windows,
    row_count,
    template_counts,
    time_extent,
    top_k_errors,
)
from sievelog.operators.lifecycle import (
    add_tombstones,
    append_logs,
    compact,
    delete_by_id,
    found_ids,
    live_rows,
    open_tombstones,
)
from sievelog.operators.search import (
    compound,
    compound_text,
    filter_level,
    filter_service,
    first_per_id,
    in_time_order,
    match_count,
    matching,
    merge_by_time,
    preview,
    search_exact,
    search_prefix,
    search_substring,
    search_time_exact,
    search_time_range,
    search_time_text,
    search_wildcard,
)
from sievelog.operators.sharding import scatter_gather, shard_load, with_shard, write_sharded
