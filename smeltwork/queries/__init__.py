"""Runnable queries over the given tables, each with the SQL that states its result."""

from smeltwork.queries import bronze, dimensions, feeds, reruns, runs, silver
from smeltwork.queries.registry import Query

ALL: dict[str, Query] = {
    **bronze.QUERIES, **silver.QUERIES, **dimensions.QUERIES, **runs.QUERIES, **reruns.QUERIES, **feeds.QUERIES
}
