"""Tables of the catalogue and of the content site, from Parquet or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from portalmeter import schemas


@dataclass(frozen=True)
class ParquetTables:
    """A folder with one Parquet table per name."""

    root: str
    suffix: str = ""
    schemas: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class JdbcTables:
    """A database; ``split`` names, per table, the numeric column and bounds its read is divided by.

    ``predicates`` divides a table by conditions instead, for tables with text keys. Tables named in ``small`` are
    read in one task; a table in none of the three is refused.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, tuple[str, int, int, int]] = field(default_factory=dict)
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    small: Sequence[str] = ()
    fetch_size: int = 10_000


def table_source(spark: SparkSession, name: str, cfg: ParquetTables | JdbcTables) -> DataFrame:
    if isinstance(cfg, ParquetTables):
        reader = spark.read.schema(cfg.schemas[name]) if name in cfg.schemas else spark.read
        return reader.parquet(f"{cfg.root}/{name}{cfg.suffix}")
    properties = {"fetchsize": str(cfg.fetch_size), **cfg.properties}
    if name in cfg.predicates:
        return spark.read.jdbc(cfg.url, name, predicates=list(cfg.predicates[name]), properties=properties)
    if name in cfg.split:
        column, lower, upper, parts = cfg.split[name]
        return spark.read.jdbc(
            cfg.url, name, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties
        )
    if name not in cfg.small:
        raise ValueError(f"{name}: give a split or predicates, or name it as small to read it in one task")
    return spark.read.jdbc(cfg.url, name, properties=properties)


def portal_tables(root: str) -> ParquetTables:
    """A folder of the portal's own tables, read with their declared schemas."""
    return ParquetTables(root, schemas=schemas.TABLES)
