"""All queries of the domain and the SQL they are held against."""

from . import chart_queries, kernel_queries, load_queries, model_queries, portfolio_queries, series_queries, training_queries

_MODULES = [series_queries, load_queries, portfolio_queries, chart_queries, kernel_queries, model_queries, training_queries]


def queries():
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
