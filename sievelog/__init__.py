"""Search and analysis of application logs as Spark DataFrame jobs."""

from sievelog.functions import *  # noqa: F401,F403
from sievelog.operators import *  # noqa: F401,F403
from sievelog.plans import *  # noqa: F401,F403
from sievelog.schema import LOG_SCHEMA, QUERY_SCHEMA
from sievelog.session import materialise, scratch_path, scratch_scope, shared_dir, use_utc
from sievelog.sources import *  # noqa: F401,F403
