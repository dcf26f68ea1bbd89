"""A star stored in versions: readers see whole ones only.

Every write of a table goes to a new folder. A version is a small manifest under
``_versions`` that names, for each table, the folders it consists of, the next free
id and the choices the star was built with. Writing the manifest is the last step and the only one
that makes anything visible: a run that dies earlier leaves folders that nothing
refers to, and the version before stays as it was. Replacing a star is a manifest with new
folders, appending one with the old folders and a new one each. Two writers
can't both make the next version: its manifest is created without overwriting.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starmart.schema import STAR_SCHEMAS, conform
from starmart.sinks.writers import save

_FOLDER = "_versions"


class VersionConflict(RuntimeError):
    """Another writer has made the version meanwhile: read it and try again."""


@dataclass
class Version:
    number: int
    variant: str
    options: dict = field(default_factory=dict)
    folders: dict[str, list[str]] = field(default_factory=dict)
    next_id: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def _fs(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _text(spark: SparkSession, fs, path) -> str:
    with_close = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_close, "UTF-8")
    finally:
        with_close.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions there are, ascending."""
    fs, path = _fs(spark, f"{root}/{_FOLDER}")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The newest version (or the one asked for); None if there is none. A manifest
    that its writer has not finished counts as not there."""
    for n in reversed(versions(spark, root)):
        if number in (None, n):
            fs, path = _fs(spark, f"{root}/{_FOLDER}/{n:08d}.json")
            text = _text(spark, fs, path)
            if text.endswith("}\n"):
                return Version(**json.loads(text))
    return None


def commit(spark: SparkSession, root: str, new: Version) -> Version:
    """Make ``new`` visible; ``VersionConflict`` if its number is taken."""
    fs, path = _fs(spark, f"{root}/{_FOLDER}/{new.number:08d}.json")
    if fs.exists(path):
        raise VersionConflict(f"version {new.number} of {root} exists")
    try:
        out = fs.create(path, False)
    except Exception as e:
        if fs.exists(path):
            raise VersionConflict(f"version {new.number} of {root} exists") from e
        raise
    try:
        out.write(bytearray((json.dumps(asdict(new)) + "\n").encode()))
    finally:
        out.close()
    return new


def write_table(df: DataFrame, root: str, name: str, variant: str) -> str:
    """Write rows of a table to a new folder, with its declared schema; where that is
    below ``root``. Nothing refers to it until a manifest does."""
    folder = f"{name}/{uuid.uuid4().hex}"
    save(conform(df, STAR_SCHEMAS[variant][name]), f"{root}/{folder}", mode="error")
    return folder


def read_table(spark: SparkSession, root: str, name: str, at: Version) -> DataFrame:
    """A table of a version: one scan over its folders."""
    schema = STAR_SCHEMAS[at.variant][name]
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in at.folders[name]])
