"""Bronze: the sources as they come, plus audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldleaf import schemas
from goldleaf.operators.audit import with_audit
from goldleaf.schemas import require_columns


def bronze_transactions(source: DataFrame, source_name: str = "sales_transactions") -> DataFrame:
    return with_audit(require_columns(source, schemas.TRANSACTIONS), source_name)


def bronze_customers(source: DataFrame, source_name: str = "sales_customers") -> DataFrame:
    return with_audit(require_columns(source, schemas.CUSTOMERS), source_name)


def bronze_franchises(source: DataFrame, source_name: str = "sales_franchises") -> DataFrame:
    return with_audit(require_columns(source, schemas.FRANCHISES), source_name)


def bronze_suppliers(source: DataFrame, source_name: str = "sales_suppliers") -> DataFrame:
    return with_audit(require_columns(source, schemas.SUPPLIERS), source_name)
