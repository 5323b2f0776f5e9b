"""Filters, cleaning, casts and defaults over customer frames and scoring requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.columns import blank_to_null_value, string_columns
from churnspark.operators.features import FeatureSpec


def known_labels(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def blank_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Text cells of exactly one whitespace character become null; other texts stay."""
    cols = string_columns(df) if cols is None else list(cols)
    return df.withColumns({c: blank_to_null_value(c) for c in cols}) if cols else df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep rows in which every column is set, id and label included."""
    return df.dropna("any")


def select_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return df.select(*spec.features)


def recode(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace the values that ``mapping`` names; others stay."""
    return df.replace(dict(mapping), subset=[col])


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a text that is not a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_request(df: DataFrame, schema: T.StructType, keep=(), rejected: str | None = None) -> DataFrame:
    """Cast each request field to the type its feature was trained with; an unknown field is an error.

    A value that cannot be read as its type is an error too: only absent fields take defaults later. With
    ``rejected`` the row gets that column instead, the names of its unreadable fields (null if there are none).
    """
    known = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in known and c not in keep]
    if unknown:
        raise ValueError(f"unknown request fields: {unknown}")
    cast = {c: F.col(c).try_cast(known[c]) for c in df.columns if c not in keep}
    bad = {c: F.col(c).isNotNull() & v.isNull() for c, v in cast.items()}
    if rejected:
        names = F.concat_ws(",", *[F.when(b, F.lit(c)) for c, b in bad.items()])
        return df.select(*[cast.get(c, F.col(c)).alias(c) for c in df.columns], F.nullif(names, F.lit("")).alias(rejected))
    told = {c: F.raise_error(F.concat(F.lit(f"unreadable {c}: "), F.col(c).cast("string"))) for c in cast}
    checked = {c: F.when(bad[c], told[c].cast(known[c])).otherwise(v) for c, v in cast.items()}
    return df.select(*[checked.get(c, F.col(c)).alias(c) for c in df.columns])


def fill_defaults(df: DataFrame, defaults: DataFrame) -> DataFrame:
    """Fill null or absent fields from a one-row frame of per-feature defaults.

    The defaults come in as a scalar subquery, so the request rows are neither joined nor moved.
    """
    row = defaults.select(F.struct(*defaults.columns)).scalar()
    filled = {
        c: F.coalesce(F.col(c), row[c]) if c in df.columns else row[c] for c in defaults.columns
    }
    return df.withColumns(filled)


def melt(df: DataFrame, id_col: str) -> DataFrame:
    """Rows (id, field, value as text) for showing a few rows one below the other."""
    fields = [c for c in df.columns if c != id_col]
    return df.select(id_col, *[F.col(c).cast("string").alias(c) for c in fields]).unpivot(
        [id_col], fields, "field", "value"
    )


def by_id(df: DataFrame, key: str, value) -> DataFrame:
    """The row with this id; an error when there is none."""
    row = df.filter(F.col(key) == F.lit(value))
    if row.isEmpty():
        raise KeyError(f"no row with {key} = {value}")
    return row
