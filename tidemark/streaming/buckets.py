"""Keyed tables that are changed a few keys at a time: hash buckets and a manifest.

A table lies in a fixed number of buckets by the hash of its key. A change reads the buckets of
the keys it touches and writes new versions of those; the other buckets stay where they are. The
manifest of a version names the current files of every bucket, and their fingerprint. It is
written last, by one task, so readers see a version in full or not at all, and writing a version
again after a crash gives the same tables.

    <root>/<table>/version=<n>/_bucket=<b>      the rows of a bucket as of version n
    <root>/manifest/version=<n>                 for each table and bucket: version, rows, hashes

The driver holds one manifest: a row for each table and bucket.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import remove_folder
from tidemark.sources.readers import read_or_empty
from tidemark.sources.sinks import fingerprint

_MANIFEST = "table STRING, bucket INT, at LONG, rows LONG, high STRING, low STRING, note STRING"
_NOTE = -1  # the bucket of a row that holds a note and no files


@dataclass(frozen=True)
class Version:
    """The current files of all tables, and notes such as their schemas."""

    number: int
    files: dict[tuple[str, int], tuple[int, int, int, int]]
    notes: dict[str, str]


class BucketedTables:
    """``keys`` gives the key column of each table. ``keep`` versions can be read; older files
    are removed, so a reader must be done before that many more versions are written."""

    def __init__(self, spark: SparkSession, root: str, keys: Mapping[str, str], buckets: int = 64, keep: int = 2):
        self.spark, self.root, self.keys, self.buckets, self.keep = spark, root, dict(keys), buckets, keep

    def bucket(self, table: str, key: str | None = None) -> Column:
        """The bucket of a row of ``table``, from a column that holds its key."""
        value = F.col(key or self.keys[table]).cast("string")
        return F.pmod(F.xxhash64(F.coalesce(value, F.lit(""))), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/manifest", f"{_MANIFEST}, version LONG")

    def current(self) -> Version | None:
        """The last version; None before the first."""
        rows = self._manifests().collect()
        if not rows:
            return None
        last = max(r.version for r in rows)
        rows = [r for r in rows if r.version == last]
        return Version(
            last,
            {(r.table, r.bucket): (r.at, r.rows, int(r.high), int(r.low)) for r in rows if r.bucket != _NOTE},
            {r.table: r.note for r in rows if r.bucket == _NOTE},
        )

    def schema(self, version: Version, table: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(version.notes[f"schema of {table}"]))

    def read(self, version: Version, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a table, or those of some buckets."""
        wanted = range(self.buckets) if buckets is None else sorted(set(buckets))
        files = [(b, version.files[table, b]) for b in wanted if (table, b) in version.files]
        paths = [f"{self.root}/{table}/version={at}/_bucket={b}" for b, (at, rows, _, _) in files if rows]
        schema = self.schema(version, table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def fingerprint(self, version: Version, table: str) -> tuple[int, str, str]:
        """That of the whole table, from the manifest alone."""
        parts = [print_ for (name, _), (_, *print_) in version.files.items() if name == table]
        rows, high, low = (sum(column) for column in zip(*parts)) if parts else (0, 0, 0)
        return rows, str(high % 2**64), str(low % 2**64)

    def write(
        self,
        number: int,
        changes: Mapping[str, tuple[DataFrame, Sequence[int]]],
        before: Version | None = None,
        notes: Mapping[str, str] | None = None,
    ) -> Version:
        """Make version ``number`` of the one ``before``. ``changes`` gives for a table all rows
        of the buckets that change, and the numbers of these buckets."""
        files = dict(before.files) if before else {}
        notes = {**(before.notes if before else {}), **(notes or {})}
        for table, (rows, _) in changes.items():
            if before is None:
                notes[f"schema of {table}"] = rows.schema.json()

        def store(table: str, rows: DataFrame, touched: Sequence[int]) -> dict:
            folder = f"{self.root}/{table}/version={number}"
            # a large bucket is written by several tasks
            dealt = rows.withColumn("_bucket", self.bucket(table)).hint("rebalance", F.col("_bucket"))
            dealt.write.mode("overwrite").partitionBy("_bucket").parquet(folder)
            stored = T.StructType([*rows.schema.fields, T.StructField("_bucket", T.IntegerType())])
            written = fingerprint(self.spark.read.schema(stored).parquet(folder), "_bucket").collect()
            full = {(table, r._bucket): (number, r.rows, int(r.high), int(r.low)) for r in written}
            return {(table, b): (number, 0, 0, 0) for b in touched} | full

        # the tables do not depend on each other, and a small batch does not fill the cluster
        work = [(table, rows, touched) for table, (rows, touched) in changes.items() if touched]
        if work:
            with ThreadPoolExecutor(len(work)) as pool:
                for done in pool.map(lambda w: store(*w), work):
                    files.update(done)
        version = Version(number, files, notes)
        self._publish(version)
        return version

    def _publish(self, version: Version) -> None:
        rows = [(t, b, at, rows, str(high), str(low), None) for (t, b), (at, rows, high, low) in version.files.items()]
        rows += [(name, _NOTE, None, None, None, None, note) for name, note in version.notes.items()]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)  # one file: all or nothing
        manifest.write.mode("overwrite").parquet(f"{self.root}/manifest/version={version.number}")
        self._clean()

    def _clean(self) -> None:
        """Remove the versions beyond ``keep``, and the files that only they name."""
        files = self._manifests().select("version", "table", "bucket", "at").collect()
        versions = sorted({r.version for r in files})
        old = set(versions[: -self.keep])
        needed = {(r.table, r.bucket, r.at) for r in files if r.version not in old}
        for r in {(r.table, r.bucket, r.at) for r in files if r.version in old and r.bucket != _NOTE} - needed:
            remove_folder(self.spark, f"{self.root}/{r[0]}/version={r[2]}/_bucket={r[1]}")
        for v in old:
            remove_folder(self.spark, f"{self.root}/manifest/version={v}")
