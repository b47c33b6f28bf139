"""Raw rows to declared tables: mapping, coercion, ids, de-duplication, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.scalars import epoch_to_timestamp, hash_id, labelled, rounded, second, whole_number


BUCKETS = 64


@dataclass(frozen=True)
class Contract:
    """A table: its schema and how raw rows become rows of it."""

    name: str
    schema: T.StructType
    paths: Mapping[str, Sequence[str]] = field(default_factory=dict)  # column: source paths, the first that exists wins
    volatile: tuple[str, ...] = ()  # no part of a row's identity; empty: rows have no record_id
    entity: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    labels: Mapping[str, Mapping[int, str]] = field(default_factory=dict)
    digits: Mapping[str, int] = field(default_factory=dict)
    partition: str | None = None
    cluster: tuple[str, ...] = ()


def record_id(*columns: str) -> Column:
    return hash_id(*columns)


def has_path(schema: T.StructType, path: str) -> bool:
    """Whether a dotted path of structs exists."""
    here: T.DataType = schema
    for part in path.split("."):
        if not isinstance(here, T.StructType) or part not in here.fieldNames():
            return False
        here = here[part].dataType
    return True


def map_paths(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns by the first of their paths that df's schema has; without paths df as it is."""
    if not contract.paths:
        return df
    kept = [c for c in ("created_at", "updated_at") if c in df.columns]
    found = []
    for column, paths in contract.paths.items():
        path = next((p for p in paths if has_path(df.schema, p)), None)
        if path:
            found.append(F.col(".".join(f"`{p}`" for p in path.split("."))).alias(column))
    return df.select(*[c for c in kept if c not in contract.paths], *found)


def _coerced(f: T.StructField, contract: Contract, df: DataFrame) -> Column:
    """The column's value in its type; null where it can't be."""
    source = f"{f.name}_s"
    if isinstance(f.dataType, T.TimestampType):
        if source in df.columns:
            return second(epoch_to_timestamp(source))
        return second(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)
    if f.name not in df.columns:
        return F.lit(None).cast(f.dataType)
    if f.name in contract.labels:
        return labelled(f.name, contract.labels[f.name])
    if isinstance(f.dataType, T.LongType):
        return whole_number(f.name)
    if f.name in contract.digits:
        return rounded(f.name, contract.digits[f.name])
    return F.col(f.name).try_cast(f.dataType)


def deduplicated(df: DataFrame, key: str = "record_id") -> DataFrame:
    """One row for each key: of every column the first value that is not null by updated_at, null last, which becomes
    the last; of values at one time the smallest."""
    others = [c for c in df.columns if c not in (key, "created_at", "updated_at")]
    first = [F.expr(f"min_by(`{c}`, struct(updated_at is null, updated_at, `{c}`)) filter (where `{c}` is not null)").alias(c) for c in others]
    out = df.groupBy(key).agg(F.min("updated_at").alias("created_at"), F.max("updated_at").alias("updated_at"), *first)
    return out.select(*df.columns)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows of the contract's schema, in its order, each record once, without rows that lack a required value."""
    mapped = map_paths(df, contract)
    typed = mapped.select(*[_coerced(f, contract, mapped).alias(f.name) for f in contract.schema])
    names = contract.schema.fieldNames()
    if contract.volatile and "record_id" in names:
        own = [c for c in names if c not in (*contract.volatile, "record_id", "entity_id")]
        typed = typed.withColumn("record_id", hash_id(*own))
    if contract.entity and "entity_id" in names:
        typed = typed.withColumn("entity_id", hash_id(*contract.entity))
    once = deduplicated(typed) if contract.volatile and "record_id" in names else typed
    return (once.dropna(subset=list(contract.not_null)) if contract.not_null else once).select(*names)


def rejects(df: DataFrame, contract: Contract) -> DataFrame:
    """How many rows lack each required value: one row, read in one pass."""
    required = [f.name for f in contract.schema if not f.nullable or f.name in contract.not_null]
    return df.agg(F.count("*").alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def validated(df: DataFrame, contract: Contract) -> DataFrame:
    """df, failing at run time on a null in a column that the schema requires."""
    checks = []
    for f in contract.schema:
        bad = F.raise_error(F.lit(f"{contract.name}.{f.name} is null")).cast(f.dataType)
        checks.append((F.col(f.name) if f.nullable else F.coalesce(F.col(f.name), bad)).alias(f.name))
    return df.select(*checks)


def ddl(contract: Contract) -> str:
    """A CREATE TABLE statement of the contract.

    A table partitioned by an instant gets a column of its date, as the writers make it, and is partitioned by that.
    Cluster columns are the buckets' and their order.
    """
    columns = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in contract.schema)
    by = contract.partition
    if by and isinstance(contract.schema[by].dataType, T.TimestampType):
        columns, by = f"{columns},\n  `dt` date", "dt"
    keys = ", ".join(contract.cluster)
    day = f"\nPARTITIONED BY ({by})" if by else ""
    buckets = f"\nCLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {BUCKETS} BUCKETS" if keys else ""
    return f"CREATE TABLE `{contract.name}` (\n  {columns}\n) USING parquet{day}{buckets}"
