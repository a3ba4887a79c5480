"""Every query of the engine over the given tables, with its SQL counterpart where there is one."""

from foliolens.catalog import headings, layout, learning, relevance, reports  # noqa: F401
from foliolens.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
