"""All registered queries with their SQL."""

from __future__ import annotations

from newslens.plans import (
    article_queries, keyword_queries, lifecycle_queries, page_queries, rollup_queries,
    sentiment_queries, stream_queries, table_queries, term_queries,
)

_GROUPS = (term_queries, article_queries, sentiment_queries, rollup_queries, keyword_queries,
           lifecycle_queries, page_queries, stream_queries, table_queries)

ALL = {name: pair for group in _GROUPS for name, pair in group.QUERIES.items()}
QUERIES = {name: fn for name, (fn, _) in ALL.items()}
ORACLES = {name: sql for name, (_, sql) in ALL.items() if sql is not None}
