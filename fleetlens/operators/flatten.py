"""Nested documents as flat rows, by their schema alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _columns(df: DataFrame, separator: str) -> DataFrame:
    """Fields of structs as columns named by their paths, until no column is a struct."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema):
        out = []
        for f in df.schema:
            if isinstance(f.dataType, T.StructType):
                out += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{separator}{g.name}") for g in f.dataType]
            else:
                out.append(F.col(f"`{f.name}`"))
        df = df.select(*out)
    return df


def flatten(df: DataFrame, separator: str = ".", keep: tuple[str, ...] = ()) -> DataFrame:
    """df with every struct unfolded and every array of any depth exploded; columns are named by their paths.

    A row without elements stays, with nulls; arrays beside each other give all combinations, as nested documents are
    read. Columns of keep stay arrays. The schema decides alone, so equal schemas always give equal columns; maps and
    plain values stay as they are. Two fields of one path raise.
    """
    df = _columns(df, separator)
    while lists := [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType) and f.name not in keep]:
        # one generator for each projection
        df = df.select(*[F.explode_outer(f"`{c}`").alias(c) if c == lists[0] else F.col(f"`{c}`") for c in df.columns])
        df = _columns(df, separator)
    if len(set(df.columns)) < len(df.columns):
        raise ValueError(f"fields with one path: {sorted(c for c in set(df.columns) if df.columns.count(c) > 1)}")
    return df
