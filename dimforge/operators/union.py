"""Aligning origins to one declared schema, union and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimforge.config import DEFAULT, Settings
from dimforge.functions.casts import cast_to
from dimforge.operators.joins import is_unique
from dimforge.operators.origin import attach_origin, is_literal


def align(df: DataFrame, schema: StructType, allow_missing: bool = False, strict: bool = False) -> DataFrame:
    """Rename and cast ``df``'s columns *by position* to ``schema``.

    Positional like SQL ``UNION``: the second system may name a column
    differently, the schema's name wins.  With ``allow_missing`` a side with
    fewer columns gets typed NULLs for the trailing ones.  As in staging, a
    value that is none of the published type becomes NULL unless ``strict``.
    """
    cols, kinds = df.columns, [f.dataType for f in df.schema.fields]
    if len(cols) > len(schema.fields) or (len(cols) < len(schema.fields) and not allow_missing):
        raise ValueError(f"{len(cols)} columns for a {len(schema.fields)}-column schema")
    out = []
    for i, field in enumerate(schema.fields):
        if i < len(cols):
            value = F.col(f"`{cols[i]}`")
            if kinds[i] != field.dataType:
                value = cast_to(value, field.dataType, strict)
            out.append(value.alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def union_all(parts: Sequence[DataFrame], schema: StructType, allow_missing: bool = False, strict: bool = False) -> DataFrame:
    """``UNION ALL`` of the aligned parts."""
    aligned = [align(p, schema, allow_missing, strict) for p in parts]
    out = aligned[0]
    for p in aligned[1:]:
        out = out.unionByName(p)
    return out


def conform_union(parts: Sequence[DataFrame], schema: StructType, allow_missing: bool = False, strict: bool = False) -> DataFrame:
    """SQL ``UNION``: aligned union, then one DISTINCT."""
    return union_all(parts, schema, allow_missing, strict).distinct()


def conform_origins(parts: Sequence[DataFrame], schema: StructType, registry: DataFrame,
                    label_col: str = "ORIGEM_DB", origin_col: str = "ID_ORIGEM_DB",
                    allow_missing: bool = False, settings: Settings = DEFAULT, disjoint: bool = False) -> DataFrame:
    """Union the per-origin outputs and label each row with its origin.

    Each part holds every column of ``schema`` except ``label_col``, in
    schema order.  The parts are aligned and unioned, the registry is joined
    once on the origin id (adding ``label_col``), the columns are put in
    schema order and duplicates are removed by one DISTINCT: a partial
    aggregate before the shuffle, so many copies of one row never reach a
    single task.

    ``disjoint``: no two parts share an origin, as when each is built with a
    constant one.  Their rows can't be equal then, so each part has its own
    DISTINCT, of the same rows in all; the parts don't wait for each other,
    and a written file holds rows of one origin.  A part noted as unique, of
    the published types, needs none.
    """
    body = StructType([f for f in schema.fields if f.name != label_col])
    if disjoint:
        aligned = [align(p, body, allow_missing, settings.strict_casts) for p in parts]
        aligned = [a if is_unique(p) and [f.dataType for f in p.schema] == [f.dataType for f in body] else a.distinct()
                   for p, a in zip(parts, aligned)]
        labels = registry if is_literal(registry) else registry.select("ID_DOMAIN", "DESC_BANCO_DADOS").distinct()
        labelled = attach_origin(reduce(DataFrame.unionByName, aligned), labels, origin_col, label_col, settings)
        return labelled.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
    unioned = union_all(parts, body, allow_missing, settings.strict_casts)
    labelled = attach_origin(unioned, registry, origin_col, label_col, settings)
    return labelled.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields)).distinct()
