"""Session settings and the shared folder used to cut lineage.

Everything here is plain Spark configuration; nothing is tuned per query.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from dimforge.audit import Audit


@dataclass(frozen=True)
class Settings:
    """Knobs shared by the operators.

    ``broadcast_max_rows`` and ``broadcast_max_bytes`` bound the lookup sides
    that are broadcast: each side is counted (rows, and the bytes of its
    values) before the join is planned, so a lookup that grows with the
    data falls back to a shuffle join (sort-merge, with AQE skew splitting)
    instead of an oversized broadcast.  ``broadcast_budget_bytes`` caps the
    sum over one join chain (its broadcasts are held together by the tasks
    of one stage): beyond it the largest lookups are shuffle-joined instead.
    ``strict_casts`` turns the staging
    ``try_cast`` into ``cast`` so malformed raw values raise instead of
    becoming NULL.  ``redact_tax_ids`` hides the middle digits of the tax ids
    a site build publishes.  ``audit`` counts what staging and joins lose.
    """

    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 128 * 1024 * 1024
    broadcast_budget_bytes: int = 512 * 1024 * 1024
    strict_casts: bool = False
    redact_tax_ids: bool = False
    audit: Audit | None = field(default=None, compare=False, repr=False)

    @classmethod
    def from_conf(cls, spark: SparkSession) -> "Settings":
        """Settings from the session: ``spark.dimforge.broadcastMaxRows``,
        ``broadcastMaxBytes``, ``broadcastBudgetBytes``, ``strictCasts`` and
        ``redactTaxIds`` (all under ``spark.dimforge.``; defaults when unset)."""
        rows = spark.conf.get("spark.dimforge.broadcastMaxRows", None)
        size = spark.conf.get("spark.dimforge.broadcastMaxBytes", None)
        budget = spark.conf.get("spark.dimforge.broadcastBudgetBytes", None)
        strict = spark.conf.get("spark.dimforge.strictCasts", None)
        redact = spark.conf.get("spark.dimforge.redactTaxIds", None)
        return cls(broadcast_max_rows=int(rows) if rows else cls.broadcast_max_rows,
                   broadcast_max_bytes=int(size) if size else cls.broadcast_max_bytes,
                   broadcast_budget_bytes=int(budget) if budget else cls.broadcast_budget_bytes,
                   strict_casts=(strict or "false").lower() == "true",
                   redact_tax_ids=(redact or "false").lower() == "true")


DEFAULT = Settings()


def session_conf(cpus: int) -> dict[str, str]:
    """Spark settings for a load: AQE on (coalescing, skew-join splitting),
    UTC clock, no UI server.

    Broadcasts happen only on a proven size: the static planner's estimate
    based threshold is off, so a join is broadcast either because the
    package counted the side (``lookup_join``) or because AQE measured its
    materialised shuffle output below the adaptive threshold at run time.
    """
    return runtime_filter_conf() | {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
        "spark.sql.shuffle.partitions": str(max(8, cpus)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }


def runtime_filter_conf(least_scan: str = "10g", most_lookup: str = "4g") -> dict[str, str]:
    """Spark settings for facts joined to lookups that are too large to broadcast.

    Spark then makes a Bloom filter of the lookup's keys (up to ``most_lookup``
    bytes of it, where a filter such as the origin's narrows it) and drops the
    fact rows that have no match before their first shuffle, also below the
    grain sum.  It costs a pass over the lookup, so it is done for facts of at
    least ``least_scan`` bytes.  The filter is made for 4 million keys
    and 4 MB; more keys let more rows through, and no row with a match is lost.
    """
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    return {
        f"{prefix}enabled": "true",
        f"{prefix}applicationSideScanSizeThreshold": least_scan,
        f"{prefix}creationSideThreshold": most_lookup,
        f"{prefix}expectedNumItems": "4000000",
        f"{prefix}numBits": str(32 << 20),
        "spark.sql.optimizer.runtimeFilter.number.threshold": "16",
    }


def local_session(cpus: int = 8, app: str = "dimforge", memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.driver.memory", memory)
    for k, v in session_conf(cpus).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir`` (or has set as
    its checkpoint folder).

    Snapshots and checkpoints go there so that any executor (and a restarted
    driver) can read them.  There is no fallback: a folder of one machine
    would not survive the loss of an executor.
    """
    named, set_here = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if not (named or set_here):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
    if not set_here:
        spark.sparkContext.setCheckpointDir(named)
    return (named or set_here).rstrip("/")


def use_scratch(spark: SparkSession) -> None:
    """Names a scratch folder as the shared folder of a local session that has
    none (tests, the bench, a laptop); a cluster session is left alone."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dimforge-"))
