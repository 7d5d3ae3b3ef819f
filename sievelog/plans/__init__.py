from sievelog.plans.batch_search import batch_search
from sievelog.plans.postings import (
    append_dictionary,
    append_postings,
    build_postings,
    compact_postings,
    open_dictionary,
    open_posting_batches,
    open_postings,
    posting_hits,
    search_indexed,
    token_dictionary,
    write_postings,
)
from sievelog.plans.store import Store, create_store, open_store
