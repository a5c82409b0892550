"""All query bindings: importing this module fills :data:`QUERIES` and :data:`ORACLE`."""

from commitlens.plans import commit_queries, seq_queries, stream_queries, text_queries  # noqa: F401
from commitlens.plans.registry import ORACLE, QUERIES  # noqa: F401
