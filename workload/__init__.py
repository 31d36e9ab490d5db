"""The library's operators run over the TPC-H-like test tables, each with an SQL twin."""

from workload import (  # noqa: F401  (importing a module registers its queries)
    basics,
    history,
    loading,
    marts,
    paging,
    star,
    titles,
)
from workload.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
