"""A warehouse in folders of Parquet files that changes as a whole or not at all.

Every load writes its rows into folders of its own and then publishes a manifest: a numbered
JSON file that names, for each table, the folders that make it up, its next free key, and
folders of retired keys. Publishing is one rename of a finished file to a number that no
other load has taken. Readers resolve the manifest with the highest number. So a load that is
killed leaves files that nobody reads, and the warehouse as it was; of two loads that started
from the same manifest, one is refused. (A local disk renames over an existing file, so there
two loads must not publish in the same moment.)

Further loads number only what is new (``plans.increment``). Layout below the root:
``_manifests/00000001.json``, ``<table>/<load>/*.parquet``, ``<table>/<load>-retired/*.parquet``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators.matching import lookup

DIGITS = 8


class Files:
    """The few file operations a driver needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return [f.getPath().getName() for f in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def text(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def claim(self, draft: str, path: str) -> bool:
        """Rename, unless the target is there already."""
        if self.fs.exists(self.path(path)):
            return False
        return bool(self.fs.rename(self.path(draft), self.path(path)))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass(frozen=True)
class Part:
    """What a manifest says of one table."""

    folders: tuple[str, ...] = ()
    retired: tuple[str, ...] = ()
    rows: int = 0
    next_key: int = 1


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    wide_keys: bool = False
    options: Mapping[str, Any] = field(default_factory=dict)
    tables: Mapping[str, Part] = field(default_factory=dict)

    def part(self, table: str) -> Part:
        return self.tables.get(table, Part())

    def json(self) -> str:
        tables = {t: vars(p) for t, p in self.tables.items()}
        return json.dumps(vars(self) | {"tables": tables}, indent=1)

    @classmethod
    def parsed(cls, text: str) -> Manifest:
        told = json.loads(text)
        tables = {
            t: Part(**p | {"folders": tuple(p["folders"]), "retired": tuple(p["retired"])})
            for t, p in told["tables"].items()
        }
        return cls(**told | {"tables": tables})


class Conflict(RuntimeError):
    """Another load has published since this one began."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    # --- manifests ----------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        names = self.files.names(f"{self.root}/_manifests")
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_manifests/{number:0{DIGITS}}.json"

    def manifest(self, number: int | None = None) -> Manifest:
        """The manifest of that number, or the latest; an empty one before the first load."""
        numbers = self._numbers()
        if number is None and not numbers:
            return Manifest()
        return Manifest.parsed(self.files.text(self._manifest(numbers[-1] if number is None else number)))

    def publish(self, manifest: Manifest) -> None:
        """Make ``manifest`` the latest, unless its number is taken."""
        draft = f"{self.root}/_manifests/draft-{uuid.uuid4().hex}"
        self.files.put(draft, manifest.json())
        if not self.files.claim(draft, self._manifest(manifest.number)):
            self.files.delete(draft)
            raise Conflict(f"manifest {manifest.number} of {self.root} exists already")

    # --- tables -------------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, load: str, suffix: str = "") -> tuple[tuple[str, ...], int]:
        """Write the rows of one load; its folders (none if there are no rows) and row count."""
        folder = f"{table}/{load}{suffix}"
        path = f"{self.root}/{folder}"
        df.write.parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path).count()
        if not rows:
            self.files.delete(path)
        return ((folder,) if rows else ()), rows

    def read(self, table: str, manifest: Manifest | None = None) -> DataFrame:
        """A table as of a manifest (default: the latest), without retired rows."""
        manifest = manifest or self.manifest()
        part = manifest.part(table)
        schema = schemas.table_schema(table, manifest.wide_keys)
        if not part.folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*(f"{self.root}/{f}" for f in part.folders))
        if part.retired:
            key = schemas.PRIMARY_KEY[table]
            retired = self.spark.read.parquet(*(f"{self.root}/{f}" for f in part.retired))
            rows = lookup(rows, key, retired.select(F.col(key).cast(schema[key].dataType)), how="left_anti")
        return rows.select(*schema.names)

    def tables(self, manifest: Manifest | None = None) -> dict[str, DataFrame]:
        manifest = manifest or self.manifest()
        return {t: self.read(t, manifest) for t in schemas.TABLES}

    def clean_up(self, keep: int = 2, names: Iterable[str] = schemas.TABLES) -> list[str]:
        """Delete folders that none of the last ``keep`` manifests names, and older manifests.

        Run it while no load is under way: the folders of one that has not published yet are
        not named either.
        """
        numbers = self._numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        used = {f for m in kept for p in m.tables.values() for f in (*p.folders, *p.retired)}
        gone = [f"{t}/{n}" for t in names for n in self.files.names(f"{self.root}/{t}")]
        gone = [f for f in gone if f not in used]
        for folder in gone:
            self.files.delete(f"{self.root}/{folder}")
        for number in numbers[:-keep]:
            self.files.delete(self._manifest(number))
        return gone
