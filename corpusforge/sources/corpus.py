"""The corpus as a table of versions (S6, S12, L3-L5): immutable folders, a
manifest written last, files in shuffled order.

A run writes ``<root>/version=<n>/data`` and, when the data is complete, its
manifest; readers take the newest version that has one.  A run that is
interrupted leaves a folder without a manifest, which nobody reads and the next
run numbers past.  So a job extends its own last output, and readers of an older
version are never disturbed.

A version written in shuffled order is ranged by the shuffle key: its files,
read by name, give that order, and a row's number follows from its place in its
file, without any sort in one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.session import local_rows, path_exists

ORDER = ("shuffle_key",)


class NoVersionError(LookupError):
    """There is no complete version under the root."""


class VersionTakenError(RuntimeError):
    """Another run has written this version meanwhile."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    schema: str
    counts: Mapping[str, int]  # label -> rows
    order: Sequence[str]  # columns by which the files are ranged and sorted

    @property
    def rows(self) -> int:
        return sum(self.counts.values())


class CorpusStore:
    """Versions of one corpus under ``root`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, root: str, label_col: str = "label"):
        self.spark, self.root, self.label_col = spark, root.rstrip("/"), label_col

    def _folders(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = (re.fullmatch(r"version=(\d+)", s.getPath().getName()) for s in fs.listStatus(path))
        return sorted(int(m[1]) for m in found if m)

    def _path(self, number: int) -> str:
        return f"{self.root}/version={number:06d}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return [n for n in self._folders() if path_exists(self.spark, f"{self._path(n)}/manifest/_SUCCESS")]

    def manifest(self, number: int | None = None) -> Version:
        """What is known of a version (default: the newest complete one)."""
        known = self.versions()
        if not known or number is not None and number not in known:
            raise NoVersionError(f"{self.root} holds {'no complete version' if number is None else f'no version {number}'}")
        number = known[-1] if number is None else number
        m = json.loads(self.spark.read.text(f"{self._path(number)}/manifest").first()[0])
        return Version(number, f"{self._path(number)}/data", m["schema"], {k: n for k, n in m["counts"]}, m["order"])

    def read(self, number: int | None = None) -> DataFrame:
        v = self.manifest(number)
        return self.spark.read.schema(v.schema).parquet(v.path)

    def read_numbered(self, number: int | None = None, name: str = "row_no") -> DataFrame:
        """Rows of a version with their 0-based place in its order: the rows
        of earlier files (from the files' own counts) plus the place in the file."""
        v = self.manifest(number)
        rows = self.spark.read.schema(v.schema).parquet(v.path)
        file = F.element_at(F.split("_metadata.file_path", "/"), -1)
        sizes = rows.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per file
        begun, at = [], 0
        for r in sorted(sizes, key=lambda r: (int(re.match(r"part-(\d+)", r["file"])[1]), r["file"])):
            begun.append((r["file"], at))
            at += r["n"]
        offsets = local_rows(self.spark, begun, "_file string, _before long")
        placed = rows.withColumn("_file", file).withColumn("_place", F.col("_metadata.row_index"))
        return placed.join(F.broadcast(offsets), "_file").withColumn(name, F.col("_before") + F.col("_place")).drop("_file", "_place", "_before")

    def write(self, df: DataFrame, order: Sequence[str] = (), files: int | None = None) -> Version:
        """Add ``df`` as the next version.  With ``order`` (L3: the shuffle key,
        then columns that break its ties) the files are ranges of it, sorted
        inside; ``files`` is their number (default: the session's partitions)."""
        if order:
            ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
            df = ranged.sortWithinPartitions(*order)
        number = max(self._folders(), default=0) + 1
        path = self._path(number)
        df.write.mode("errorifexists").parquet(f"{path}/data")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        back = self.spark.read.schema(ddl).parquet(f"{path}/data")
        counts = [(r[0], r[1]) for r in back.groupBy(self.label_col).count().collect()]  # a row per label
        text = json.dumps({"schema": ddl, "counts": counts, "order": list(order)})
        if path_exists(self.spark, f"{path}/manifest"):
            raise VersionTakenError(path)
        local_rows(self.spark, [(text,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/manifest")
        return self.manifest(number)

    def needs(self, labels: Sequence[str], target: int) -> dict[str, int]:
        """A9 of the newest version, from its manifest: no scan."""
        have = self.manifest().counts
        return {l: max(0, target - have.get(l, 0)) for l in labels}


def write_in_order_csv(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> str:
    """CSV files that, read by name, give the rows in ``order``."""
    from corpusforge.sources.csv import write_corpus_csv

    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return write_corpus_csv(ranged.sortWithinPartitions(*order), path)
