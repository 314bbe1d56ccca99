"""All registered queries. Importing a query module registers what it defines."""

from goldleaf.queries import fare_model, fare_monitoring, sales_layers, sales_marts, storage  # noqa: F401
from goldleaf.queries.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
