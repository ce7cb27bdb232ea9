"""Tables that are replaced without loss: every version has its own folder, a manifest names the current one.

A new version is written beside the old one, and only when all its files are there
does a manifest with the next number appear. Readers take the manifest with the
highest number, so a write that fails at any point leaves the old table as it was,
and a reader never sees a mixture. Two writers of one table cannot both take a
number: the later one fails and may try again. All folder work goes through the
file system of the path, so any store that Spark reaches will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from casebook.session import Folder


class Conflict(RuntimeError):
    """Another writer has committed this version number."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    schema: T.StructType


class VersionedTable:
    """A table below ``path``: ``data/<number>-<id>`` holds versions, ``manifest/<number>.json`` makes them current.

    ``keep`` versions stay, the current one included, for readers that began before a replacement.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        if keep < 1:
            raise ValueError("the current version must be kept")
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self.data, self.manifests = Folder(spark, f"{self.path}/data"), Folder(spark, f"{self.path}/manifest")

    def versions(self) -> list[Version]:
        """Committed versions that are still there, the current one last."""
        numbers = sorted(int(name.removesuffix(".json")) for name in self.manifests.names() if name.endswith(".json"))
        found = []
        for number in numbers:
            entry = json.loads(self.manifests.read(f"{number:010d}.json"))
            found.append(Version(number, f"{self.path}/data/{entry['folder']}", T.StructType.fromJson(entry["schema"])))
        return found

    def current(self) -> Version | None:
        found = self.versions()
        return found[-1] if found else None

    def read(self, number: int | None = None) -> DataFrame:
        """The current version, or an older one that is kept."""
        found = [v for v in self.versions() if number in (None, v.number)]
        if not found:
            raise FileNotFoundError(f"{self.path}: no version {'' if number is None else number}".rstrip())
        return self.spark.read.schema(found[-1].schema).parquet(found[-1].path)

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Version:
        """Write ``df`` as the next version and make it current; ``df`` may read the version it replaces.

        Rebalancing keeps files even when one partition value holds most rows.
        """
        before = self.current()
        number = before.number + 1 if before else 1
        folder = f"{number:010d}-{uuid.uuid4().hex}"
        out = df.hint("rebalance", *partition_by) if partition_by else df
        writer = out.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/data/{folder}")
        entry = {"folder": folder, "schema": json.loads(df.schema.json())}
        if not self.manifests.create(f"{number:010d}.json", json.dumps(entry)):
            self.data.remove(folder)
            raise Conflict(f"{self.path}: version {number} exists")
        self.tidy()
        return self.current()

    def tidy(self) -> None:
        """Remove versions beyond those kept, manifest first, and what failed writes of committed numbers left."""
        found = self.versions()
        for old in found[: -self.keep]:
            self.manifests.remove(f"{old.number:010d}.json")
        kept = {v.path.rsplit("/", 1)[-1] for v in found[-self.keep :]}
        last = found[-1].number if found else 0
        for name in self.data.names():
            # A folder with a higher number may be a write in progress.
            if name not in kept and int(name.split("-")[0]) <= last:
                self.data.remove(name)

