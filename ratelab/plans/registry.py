"""All registered queries, by name, with their SQL."""

from ratelab.plans import file_queries, graph_queries, model_queries, rating_queries

_PARTS = (graph_queries, rating_queries, file_queries, model_queries)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
