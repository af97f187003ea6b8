"""The library's operators as named queries over the driver's tables, with their SQL equivalents."""

from driver_queries import catalog_queries, data_queries, model_queries, score_queries, trained_queries

REGISTRY = {
    **data_queries.QUERIES,
    **catalog_queries.QUERIES,
    **score_queries.QUERIES,
    **model_queries.QUERIES,
    **trained_queries.QUERIES,
}
