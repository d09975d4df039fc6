"""Parquet snapshots and publishing of conformed tables."""

from __future__ import annotations

import decimal
import json
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from dimforge.config import shared_dir
from dimforge.sources import stored
from dimforge.sources.catalog import ensure_database, quote


def is_complete(spark, path: str) -> bool:
    """True when ``path`` holds a finished write (its ``_SUCCESS`` marker).

    A job that died half way leaves no marker, so it is redone.  Only a
    missing path counts as that: any other failure to look (no permission, a
    store that does not answer) is raised, so no snapshot is overwritten for it.
    """
    try:
        spark.read.text(path.rstrip("/") + "/_SUCCESS")
        return True
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _kinds(schema: StructType) -> list[list[str]]:
    """Names and types of columns; whether they may be NULL is not kept in files."""
    return [[f.name, f.dataType.simpleString()] for f in schema.fields]


def input_token(*frames: DataFrame) -> str:
    """Identity of the files that frames read: their paths, lengths and times.

    A frame that reads no files has no such identity; name a token yourself.
    """
    facts = []
    for df in frames:
        paths = df.inputFiles()
        if not paths:
            raise ValueError("a frame that reads no files has no input token")
        for path in paths:
            system, at = stored.file_system(df.sparkSession, path)
            status = system.getFileStatus(at)
            facts.append([path, status.getLen(), status.getModificationTime()])
    return uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(sorted(facts))).hex


def snapshot_once(df: DataFrame, path: str, token: str | None = None, partition_by: str | None = None) -> DataFrame:
    """Read the Parquet snapshot at ``path``; compute and write it first when
    it is missing, incomplete or stale.

    A snapshot is stale if its columns or their types differ from ``df``'s, or
    if ``token``, which names what the rows are made from (see
    :func:`input_token`), is not the one it was written with.  Without a token
    any snapshot of the same columns is read, whatever it was made from.

    The frame returned is read from the files, so its lineage starts at the
    snapshot: a lost executor re-reads a file instead of recomputing the plan.
    ``path`` must be shared storage (see :func:`dimforge.config.shared_dir`).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if not _is_fresh(df, path, token):
        # the key goes first and comes last: a write that dies in between is stale
        stored.remove(spark, f"{path}/{stored.SNAPSHOT}")
        stored.write(df, path, partition_by=partition_by)
        stored.put_text(spark, f"{path}/{stored.SNAPSHOT}", json.dumps({"columns": _kinds(df.schema), "token": token}))
    return read_stored(spark, path, df.schema)


def _is_fresh(df: DataFrame, path: str, token: str | None) -> bool:
    spark = df.sparkSession
    if not (stored.exists(spark, f"{path}/_SUCCESS") and is_complete(spark, path)):
        return False
    text = stored.get_text(spark, f"{path}/{stored.SNAPSHOT}")
    if text is None:
        # written by other means: its files tell the columns, nothing tells the input
        return token is None and _kinds(spark.read.parquet(path).schema) == _kinds(df.schema)
    held = json.loads(text)
    return held["columns"] == _kinds(df.schema) and (token is None or held["token"] == token)


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written folder with the columns of ``schema``; its recorded sizes are noted."""
    df = spark.read.schema(schema).parquet(path)
    if df.columns != schema.names:  # the column that names the folders comes last
        df = df.select(*(F.col(f"`{c}`") for c in schema.names))
    return stored.with_sizes(df, path)


def snapshot_path(spark, *parts: str) -> str:
    """A folder under the session's shared folder."""
    return "/".join([shared_dir(spark), "dimforge", *parts])


def is_io_failure(err: BaseException) -> bool:
    """Whether a failed write may succeed when tried again: an I/O error in
    Python, or anywhere in the chain of causes of an error from the JVM.
    Errors of the plan or of the data are not."""
    if isinstance(err, OSError):
        return True
    if isinstance(err, AnalysisException):
        return False
    cause = getattr(err, "_origin", None) or getattr(err, "java_exception", None)
    if isinstance(err, PySparkException) and cause is None:
        return False
    for _ in range(20):
        if cause is None:
            return False
        kind = cause.getClass()
        while kind is not None:
            if kind.getName() in ("java.io.IOException", "java.io.UncheckedIOException"):
                return True
            kind = kind.getSuperclass()
        cause = cause.getCause()
    return False


def _wait(seconds: float) -> None:
    time.sleep(seconds)


def _stamp() -> str:
    return time.strftime("%Y%m%d%H%M%S", time.gmtime())


class PublishConflict(RuntimeError):
    """Someone else published the table while this version was written."""


class PublishUnknown(RuntimeError):
    """The catalog failed and can't tell which version it names; the version written is kept."""


@dataclass(frozen=True)
class Part:
    """Rows that a table's view reads: those of a version folder, or of some origins in it."""

    path: str
    values: tuple[str, ...] | None = None


_PART = re.compile(r"FROM \w+\.`((?:[^`]|``)+)`(?: WHERE `(?:[^`]|``)+` IN \(([^()]*)\))?")


def published_parts(spark: SparkSession, owner: str, table: str) -> list[Part]:
    """The version folders that the published table names now; none if it isn't published."""
    if not spark.catalog.tableExists(f"{owner}.{table}"):
        return []
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(owner)}.{quote(table)}").collect()
    text = next((r.data_type for r in rows if r.col_name == "View Text"), "")
    return [Part(path.replace("``", "`"), tuple(v.strip() for v in values.split(",")) if values else None)
            for path, values in _PART.findall(text)]


def published_sizes(df: DataFrame, owner: str, table: str) -> DataFrame:
    """Notes on a frame that reads a published table whole the sizes recorded with it."""
    spark = df.sparkSession
    return stored.with_sizes(df, *dict.fromkeys(p.path for p in published_parts(spark, owner, table)))


def _view(columns: list[list[str]], parts: list[Part], fmt: str, partition_by: str | None) -> str:
    """SQL that reads the parts, columns in their order (a file read puts the one that names folders last)."""
    def named(name: str, kind: str) -> str:
        held = f"`{name.replace('`', '``')}`"
        return f"CAST({held} AS {kind}) AS {held}" if name == partition_by else held

    picked = ", ".join(named(*c) for c in columns)
    selects = []
    for part in parts:
        where = f" WHERE `{partition_by}` IN ({', '.join(part.values)})" if part.values else ""
        selects.append(f"SELECT {picked} FROM {fmt}.`{part.path.replace('`', '``')}`{where}")
    return " UNION ALL ".join(selects)


def _folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the column that names the folders of a version."""
    return sorted(n.partition("=")[2] for n, _ in stored.children(spark, path) if n.startswith(f"{column}="))


class _Publisher:
    """Writes versions of one table and points its view at them.

    A version is written to a folder of its own and named by the view in one
    catalog update, so publishers do not disturb each other and the last
    update wins whole.  After a failed update the view tells what it names: a
    version that it names was published.  A folder is removed only if it was
    named once (``_PUBLISHED``) and is no longer, or if it certainly never was.
    """

    def __init__(self, spark: SparkSession, owner: str, table: str, base_path: str | None, retries: int, fmt: str, pause: float):
        base = (base_path or shared_dir(spark)).rstrip("/")
        ensure_database(spark, owner, f"{base}/{owner}.db")
        self.spark, self.owner, self.table, self.fmt = spark, owner, table, fmt
        self.name, self.folder = f"{quote(owner)}.{quote(table)}", f"{base}/{owner}/{table}"
        self.left, self.pause, self.last_error = max(1, retries), pause, None
        self.seen = published_parts(spark, owner, table)

    def _failed(self, err: Exception) -> None:
        """Waits before the next try; raises when no more are left."""
        self.last_error, self.left = err, self.left - 1
        if not self.left:
            raise RuntimeError(f"publish of {self.name} failed, no tries left") from err
        _wait(self.pause)
        self.pause = min(2 * self.pause, 30.0)

    def write(self, df: DataFrame, partition_by: str | None, only=None) -> tuple[str, stored.Written]:
        while True:
            version = f"{self.folder}/v{_stamp()}-{time.time_ns() % 1_000_000_000:09d}-{uuid.uuid4().hex[:8]}"
            try:
                return version, stored.write(df, version, self.fmt, partition_by, only)
            except Exception as err:  # noqa: BLE001 - told apart below
                stored.remove(self.spark, version)
                if not is_io_failure(err):
                    raise
                self._failed(err)

    def point(self, version: str, query: str, if_unchanged: bool, replace_table: bool) -> None:
        """The view names ``version``, by ``query``; else an error, and the folder is gone or of unknown use."""
        while True:
            now = published_parts(self.spark, self.owner, self.table) if if_unchanged else self.seen
            if now != self.seen and version not in [p.path for p in now]:
                stored.remove(self.spark, version)
                raise PublishConflict(f"{self.name} was published by another while this version was written")
            try:
                _point(self.spark, self.owner, self.table, query, replace_table)
                return
            except Exception as err:  # noqa: BLE001 - told apart below
                try:
                    named = [p.path for p in published_parts(self.spark, self.owner, self.table)]
                except Exception:  # noqa: BLE001 - the catalog does not answer
                    named = None
                if named and version in named:
                    return
                if not is_io_failure(err):
                    if named is None:
                        raise PublishUnknown(f"{self.name} may name {version}, which is kept") from err
                    stored.remove(self.spark, version)
                    raise
                # the update may still arrive: the folder stays, and the same version is tried again
                self._failed(err)

    def settle(self, version: str, keep_versions: int | None) -> None:
        """Marks the version as published and removes old ones that no view names."""
        stored.put_text(self.spark, f"{version}/{stored.PUBLISHED}", "")
        if keep_versions is not None:
            _remove_old(self.spark, self.owner, self.table, self.folder, keep_versions)


def _remove_old(spark: SparkSession, owner: str, table: str, folder: str, keep: int) -> None:
    """Removes published versions but for the newest ``keep`` and those that the view names."""
    marked = []
    for name, _ in stored.children(spark, folder):
        changed = dict(stored.children(spark, f"{folder}/{name}")) if name.startswith("v") else {}
        if stored.PUBLISHED in changed:
            marked.append((changed[stored.PUBLISHED], name))
    named = {p.path.rpartition("/")[2] for p in published_parts(spark, owner, table)}
    newest = {name for _, name in sorted(marked)[-keep:]} | named
    if named:
        for _, name in marked:
            if name not in newest:
                stored.remove(spark, f"{folder}/{name}")


def remove_orphans(spark: SparkSession, owner: str, table: str, base_path: str | None = None, older_than_hours: float = 24.0) -> list[str]:
    """Removes folders of versions that were never published, begun that long
    ago (a publisher died, or the outcome stayed unknown); returns their names."""
    folder = f"{(base_path or shared_dir(spark)).rstrip('/')}/{owner}/{table}"
    named = {p.path.rpartition("/")[2] for p in published_parts(spark, owner, table)}
    gone = []
    for name, changed in stored.children(spark, folder):
        old = changed < (time.time() - 3600 * older_than_hours) * 1000
        if name.startswith("v") and name not in named and old and not stored.exists(spark, f"{folder}/{name}/{stored.PUBLISHED}"):
            stored.remove(spark, f"{folder}/{name}")
            gone.append(name)
    return gone


def publish(df: DataFrame, owner: str, table: str, base_path: str | None = None,
            retries: int = 10, fmt: str = "parquet", require_rows: bool = True,
            keep_versions: int | None = None, partition_by: str | None = None, if_unchanged: bool = False,
            replace_table: bool = False, pause: float = 0.5) -> bool:
    """Publish ``df`` as ``owner.table``; True when it was published.

    The rows are written to a new version folder ``base/owner/table/v…``, and
    ``owner.table``, a view of one version, is then replaced in one catalog
    step.  Readers see the old version or the new one, also when the columns
    change, and a version is never overwritten while a plan reads it.  Of
    publishers at the same time the last to update the catalog wins;
    with ``if_unchanged`` a publisher that finds another's version instead of
    the one it saw at its start gives up (:class:`PublishConflict`).

    I/O failures are tried again, up to ``retries`` times in all and with
    pauses that double from ``pause`` seconds; an error of the plan or the data
    is raised at once.  A catalog update that fails after it took effect counts
    as published.  The folder of a failed or refused version is removed, unless
    the catalog may still come to name it (see :func:`remove_orphans`).

    With ``require_rows`` an empty result is not published (returns False) and
    the old version stays.  ``keep_versions`` removes all but that many newest
    published versions (None: keeps all), never one that the view names; plans
    that still read a removed version fail, so keep more than one.

    ``partition_by`` writes a folder for each value of a column (a number),
    so a filter on it reads only those folders, and :func:`publish_part` can
    renew one value's rows.  A real table of that name (made by hand) is an
    error; with ``replace_table`` it is renamed, not dropped.
    """
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep_versions must be at least 1")
    at = _Publisher(df.sparkSession, owner, table, base_path, retries, fmt, pause)
    version, written = at.write(df, partition_by)
    if not written.sizes.rows:
        if require_rows:
            stored.remove(at.spark, version)
            return False
        if partition_by:  # no rows make no folder that could tell the columns
            stored.remove(at.spark, version)
            partition_by = None
            version, _ = at.write(df, None)
    at.point(version, _view(_kinds(df.schema), [Part(version)], fmt, partition_by), if_unchanged, replace_table)
    at.settle(version, keep_versions)
    return True


def publish_part(df: DataFrame, owner: str, table: str, column: str, value: int, base_path: str | None = None,
                 retries: int = 10, require_rows: bool = True, keep_versions: int | None = None, pause: float = 0.5) -> bool:
    """Publish ``df`` as the rows of a published table whose ``column`` is
    ``value``; the other rows stay as they are, in the files they are in.

    The table was published with ``partition_by=column``.  The view then reads
    the new version for this value and the old versions for the others, again
    after one catalog update; if another publisher is faster, this one gives
    up (:class:`PublishConflict`), as its view would bring back old rows.
    Rows of another value are an error, as are other columns than the table's.
    """
    spark = df.sparkSession
    at = _Publisher(spark, owner, table, base_path, retries, "parquet", pause)
    if not at.seen:
        raise ValueError(f"{at.name} is not published")
    now = spark.table(at.name)
    if _kinds(now.schema) != _kinds(df.schema):
        raise ValueError(f"the columns differ from those of {at.name}: {_kinds(df.schema)}")
    places = {v: p.path for p in at.seen for v in p.values or _folder_values(spark, p.path, column)}
    if not places:
        raise ValueError(f"{at.name} was not published with partition_by={column!r}")
    version, written = at.write(df, column, F.col(column).eqNullSafe(F.lit(value)))
    if written.strays or (require_rows and not written.sizes.rows):
        stored.remove(spark, version)
        if written.strays:
            raise ValueError(f"{written.strays} rows are not of {column} = {value}")
        return False
    places.pop(str(value), None)
    if written.sizes.rows:
        places[str(value)] = version
    parts = [Part(path, tuple(v for v in places if places[v] == path)) for path in dict.fromkeys(places.values())]
    if not parts:
        raise ValueError(f"no rows would be left in {at.name}; publish it whole")
    at.point(version, _view(_kinds(df.schema), parts, "parquet", column), True, False)
    at.settle(version, keep_versions)
    return True


def _point(spark: SparkSession, owner: str, table: str, query: str, replace_table: bool = False) -> None:
    """``owner.table`` becomes a view of ``query`` in one catalog update."""
    name = f"{quote(owner)}.{quote(table)}"
    if not spark.catalog.tableExists(f"{owner}.{table}"):
        try:
            spark.sql(f"CREATE VIEW {name} AS {query}")
            return
        except AnalysisException as err:
            if err.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":  # another publisher was first
                raise
    if spark.catalog.getTable(f"{owner}.{table}").tableType == "VIEW":
        # one update of the catalog entry; CREATE OR REPLACE would drop it first
        spark.sql(f"ALTER VIEW {name} AS {query}")
        return
    if not replace_table:
        raise ValueError(f"{name} is a real table, not a published view; pass replace_table=True to rename it first")
    aside = f"{quote(owner)}.{quote(f'{table}_replaced_{uuid.uuid4().hex[:8]}')}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"CREATE VIEW {name} AS {query}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise


def preview(df: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values (a point look at a result).

    A number looked up in a text column is compared as a number, as SQL does:
    429 finds ``'429'`` and ``'0429'``; text that is no number matches none.
    """
    types, cond = dict(df.dtypes), F.lit(True)
    for name, value in equals.items():
        column = F.col(name)
        if types.get(name) == "string" and isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
            column, value = column.try_cast("decimal(38,10)"), F.lit(decimal.Decimal(value)).cast("decimal(38,10)")
        elif types.get(name) == "string" and isinstance(value, float):
            column = column.try_cast("double")
        cond = cond & (column == F.lit(value) if value is not None else column.isNull())
    return df.where(cond)
