from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[Column, str]


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c
