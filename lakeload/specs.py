"""Table specifications: what a configured table looks like and how it loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

FULL = "FULL"
CDC = "CDC"
DELETE_FLAG = "IsDeleted"
# Column of the incremental layouts: the execution that wrote a row.
EXECUTION = "_execution"


def spark_type(type_name: str):
    return _parse_datatype_string(type_name.lower())


@dataclass(frozen=True)
class TableSpec:
    """A silver table fed from raw parquet batches.

    ``fields`` maps column name to a Spark SQL type name in output order; columns
    of the raw data that are not listed are dropped by the cast projection.
    """

    name: str
    fields: Mapping[str, str]
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    load_type: str = FULL
    path: str = ""
    path_cdc: str = ""
    namespace: str = ""

    def schema(self) -> StructType:
        return StructType([StructField(n, spark_type(t), True) for n, t in self.fields.items()])

    @property
    def qualified_name(self) -> str:
        return f"{self.namespace}.{self.name}" if self.namespace else self.name


@dataclass(frozen=True)
class GoldSpec:
    """A gold table derived from silver tables.

    ``build`` receives the silver tables by name and returns the derived frame; the
    same builder serves the full load (replace) and the CDC load (merge on ``keys``).
    """

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    load_type: str = CDC
    inputs: tuple[str, ...] = field(default_factory=tuple)
