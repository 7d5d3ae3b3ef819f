from sievelog.functions.keys import row_key, shard_id
from sievelog.functions.text import (
    contains_text,
    has_any_token,
    has_glob,
    has_prefix,
    has_token,
    log_tokens,
    same_text,
    signature,
    template,
)
from sievelog.functions.timestamps import (
    format_epoch,
    log_date,
    parse_epoch,
    parse_timestamp,
    resolve_bounds,
)
