from sievelog.sources.csv_logs import ingest_csv, read_logs_csv, write_batch
from sievelog.sources.sample import sample_logs, sample_rows
from sievelog.sources.tables import (
    append_clustered,
    compact_clustered,
    open_clustered,
    open_logs,
    open_rejects,
    with_log_date,
    write_clustered,
    write_csv,
)
from sievelog.sources.views import logs_from_documents, logs_from_events
