import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from dimforge.config import session_conf, use_scratch

    builder = SparkSession.builder.master("local[4]").appName("dimforge-tests")
    for k, v in session_conf(4).items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "4")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    use_scratch(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Result rows as sorted tuples (NULLs first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
