"""Lake tables that a failed write leaves as they were: staged replacement, and versions.

A plain table is a folder of Parquet files. Its replacement is written to a
folder beside it, which takes the table's place by two renames once it is
complete; between them the old table is ``<path>.replaced``, and readers and the
next writer look there.

A versioned table's folder holds

* ``_data/_write=<version>-<token>/``: the Parquet files of one write;
* ``_versions/<version>.json``: the manifest of a committed version, which lists the
  data folders that make it up, their rows and when it was committed.

A write goes to a data folder of its own first, and becomes a version when its
manifest is moved into place, which fails if another writer has just taken that
number. So a job that is killed at any moment leaves the last version as it was,
readers never see half a write, and older versions stay readable until they are
expired. Appending commits the old folders and the new one: nothing is copied.
The driver handles one manifest; rows are only touched by the write itself and
counted from the Parquet footers.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_DATA, _VERSIONS, _WRITE = "_data", "_versions", "_write"


def delete_folder(spark: SparkSession, path: str) -> None:
    there = _jpath(spark, path)
    there.getFileSystem(_conf(spark)).delete(there, True)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    file = _jpath(spark, path)
    fs = file.getFileSystem(_conf(spark))
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file, whole or not at all; False if the path is taken already, which is left as it is."""
    folder, _, name = path.rpartition("/")
    temp, conf = _jpath(spark, f"{folder}/.{name}-{uuid.uuid4().hex}"), _conf(spark)
    fs = temp.getFileSystem(conf)
    out = fs.create(temp, False)
    out.write(bytearray(text.encode()))
    out.close()
    renames = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(renames, 0)  # no overwriting
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(temp, _jpath(spark, path), none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
            raise
        fs.delete(temp, False)
        return False


def staged_path(path: str) -> str:
    return f"{path}.staged-{uuid.uuid4().hex[:12]}"


def _replaced(path: str) -> str:
    return f"{path}.replaced"


def last_complete(spark: SparkSession, path: str) -> str:
    """``path``, or where its last complete content is if a replacement was cut short between its two renames."""
    here, before = _jpath(spark, path), _jpath(spark, _replaced(path))
    fs = here.getFileSystem(_conf(spark))
    return _replaced(path) if not fs.exists(here) and fs.exists(before) else path


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Let the complete folder ``staged`` replace the one at ``path``."""
    here, new, old = _jpath(spark, path), _jpath(spark, staged), _jpath(spark, _replaced(path))
    fs = here.getFileSystem(_conf(spark))
    if fs.exists(here):
        fs.delete(old, True)
        if not fs.rename(here, old):
            raise OSError(f"{path} can't be moved away")
    if not fs.rename(new, here):
        raise OSError(f"{staged} can't be moved to {path}")
    fs.delete(old, True)


class VersionConflict(RuntimeError):
    """The table has another version than the writer expected."""


@dataclass(frozen=True)
class TableVersion:
    version: int
    folders: tuple[str, ...]
    rows: int
    mode: str
    committed_at: float


def _jpath(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, ascending; none if it doesn't exist."""
    path = _jpath(spark, folder)
    fs = path.getFileSystem(_conf(spark))
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of the table at ``path``, ascending; empty for a plain folder of files."""
    return [int(n[:-5]) for n in file_names(spark, f"{path}/{_VERSIONS}") if n.endswith(".json") and n[:-5].isdigit()]


def describe_version(spark: SparkSession, path: str, version: int | None = None) -> TableVersion:
    """The manifest of ``version`` (the latest one by default)."""
    known = version_numbers(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{path} has versions {known}" + (f", not {version}" if version is not None else ""))
    m = json.loads(get_text(spark, f"{path}/{_VERSIONS}/{known[-1] if version is None else version:020d}.json"))
    return TableVersion(m["version"], tuple(m["folders"]), m["rows"], m["mode"], m["committed_at"])


def write_version(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                  expected: int | None = None, written: Callable[[str], None] | None = None) -> TableVersion:
    """Write ``df`` and commit it as the next version: alone (``overwrite``) or with what the last one holds (``append``).

    With ``expected`` (0: no version yet) the write is committed only onto that
    version, else :class:`VersionConflict` is raised and nothing has changed.
    Without it, a writer that another one has overtaken commits onto that one's version.
    ``written`` is called with the data folder before it is committed.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    spark = df.sparkSession
    first = (version_numbers(spark, path) or [0])[-1]
    if expected is not None and expected != first:
        raise VersionConflict(f"{path} is at version {first}, not {expected}")
    folder = f"{_DATA}/{_WRITE}={first + 1:020d}-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{folder}")
    if written:
        written(f"{path}/{folder}")
    rows = spark.read.parquet(f"{path}/{folder}").count()  # from the footers
    while True:
        last = (version_numbers(spark, path) or [0])[-1]
        if expected is not None and last != expected:
            raise VersionConflict(f"{path} is at version {last}, not {expected}")
        old = describe_version(spark, path, last) if last and mode == "append" else None
        made = TableVersion(last + 1, (*(old.folders if old else ()), folder), rows + (old.rows if old else 0), mode, time.time())
        if put_text(spark, f"{path}/{_VERSIONS}/{made.version:020d}.json", json.dumps(vars(made))):
            return made


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A committed version (the latest by default); filters and columns reach the Parquet scan."""
    folders = [f"{path}/{f}" for f in describe_version(spark, path, version).folders]
    # the writes are like partitions of the table, which may be partitioned further
    return spark.read.option("basePath", f"{path}/{_DATA}").parquet(*folders).drop(_WRITE)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions, and data folders that none of those lists; returns the folders deleted.

    Folders of writes that started after the oldest kept version stay, as they may still be committed.
    """
    known = version_numbers(spark, path)
    kept, gone = known[-keep:], known[:-keep]
    used = {f for v in kept for f in describe_version(spark, path, v).folders}
    fs = _jpath(spark, path).getFileSystem(_conf(spark))
    for v in gone:
        fs.delete(_jpath(spark, f"{path}/{_VERSIONS}/{v:020d}.json"), False)
    folders = [f"{_DATA}/{n}" for n in file_names(spark, f"{path}/{_DATA}")]
    dropped = [f for f in folders if f not in used and kept and int(f.rpartition("=")[2].split("-")[0]) <= kept[0]]
    for f in dropped:
        fs.delete(_jpath(spark, f"{path}/{f}"), True)
    return dropped
