"""Tables that the registered queries publish."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tablewright import TableStore
from tablewright.sources.store import shared_folder

SCHEMA = "tablewright_registry"


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, location=f"{shared_folder(spark)}/{SCHEMA}-{uuid.uuid4().hex}")


def fresh(store: TableStore, table: str) -> str:
    """A table name of the registry that no table has yet."""
    name = f"{SCHEMA}.{table}"
    if store.state(name) is not None:
        store.drop(name)
    return name
