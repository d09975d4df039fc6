"""Origin registry: which source system a row came from."""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dimforge import schemas
from dimforge.config import DEFAULT, Settings
from dimforge.operators.joins import lookup_join

# The two registered source systems.
DEFAULT_ORIGINS = ((schemas.LEGACY, "LEGACY"), (schemas.CURRENT, "CURRENT"))

# Registries made from a literal list here: their size is known, no check needed.
_LITERAL = weakref.WeakSet()


def origin_registry(spark: SparkSession, origins: Sequence[tuple[int, str]] = DEFAULT_ORIGINS) -> DataFrame:
    """The registry as a literal table (``ID_DOMAIN``, ``DESC_BANCO_DADOS``)."""
    registry = spark.createDataFrame(list(origins), schemas.REGISTRY)
    if len({o for o, _ in origins}) == len(origins):
        _LITERAL.add(registry)
    return registry


def is_literal(registry: DataFrame) -> bool:
    """Whether the registry is a literal list made here: of known size, one row an origin."""
    return registry in _LITERAL


def attach_origin(df: DataFrame, registry: DataFrame, origin_col: str = "ID_ORIGEM_DB",
                  label_col: str = "ORIGEM_DB", settings: Settings = DEFAULT) -> DataFrame:
    """Inner-join the registry on the origin id and add its description.

    Joined once, after the origins are unioned, so the key is a real column
    (hash join) and not a folded literal (nested-loop join per origin).
    Rows of an unregistered origin are dropped, as with the per-origin join.
    """
    reg = registry.select(registry["ID_DOMAIN"].alias("__origin_id"),
                          registry["DESC_BANCO_DADOS"].alias(label_col))
    bounded = True if is_literal(registry) else "auto"
    joined = lookup_join(df, reg, df[origin_col] == reg["__origin_id"], "inner", bounded, settings)
    return joined.drop("__origin_id")
