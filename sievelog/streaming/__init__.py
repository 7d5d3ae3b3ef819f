from sievelog.streaming.error_alerts import (
    MOVING_SCHEMA,
    moving_alerts,
    start_alerts,
    start_counts,
    start_moving_alerts,
    stream_error_counts,
    stream_moving_alerts,
    use_rocksdb,
)
from sievelog.streaming.ingest import start_ingest, stream_logs_csv
