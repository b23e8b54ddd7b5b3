"""Keyed tables that a stream changes batch by batch: sorted parquet in hash buckets, merged as they grow.

Each batch adds one part, a folder with a sub-folder per bucket it has rows for. Parts of a bucket are
merged once there are ``merge_after`` of one size class into one of the next, so a row is rewritten a
logarithmic number of times and a bucket has few parts however many batches came. A batch reads only
the buckets of its own keys.

Which parts are live, and notes such as the last id given, stand in one small version file per batch,
written last. A batch that is repeated after a failure starts from the version before it and replaces
its own parts, so it changes nothing. The two newest versions are kept; what only older ones name is
deleted.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from pagewright.operators.tables import held, latest_by_key

BATCH = "_batch"


class KeyStore:
    """One keyed table under ``folder``.

    ``keys`` name its key columns. Rows of an ``upsert`` store, which has one key column, replace earlier
    ones of their key; others are only ever added once per key by their writer.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: StructType,
        keys: list[str],
        upsert: bool = False,
        buckets: int = 16,
        merge_after: int = 8,
    ):
        self.spark, self.folder, self.keys, self.upsert = spark, folder.rstrip("/"), keys, upsert
        self.schema = StructType([*schema.fields]).add(BATCH, LongType())
        self.columns = [field.name for field in schema.fields]
        self.buckets, self.merge_after = buckets, merge_after

    # --- version files

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, prefix: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        found = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(name for name in found if name.startswith(prefix))

    def _load(self, name: str) -> dict[str, Any]:
        stream = self._fs().open(self._path(f"versions/{name}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def version(self, before: int | None = None) -> dict[str, Any]:
        """The newest version, or the newest of a batch before ``before``: its notes and live parts."""
        names = self._names("versions", "v")
        if before is not None:
            names = [name for name in names if name < f"v{before:09d}"]
        return self._load(names[-1]) if names else {"notes": {}, "parts": {}, "made": []}

    def _commit(self, version: dict[str, Any], batch: int) -> None:
        fs, name = self._fs(), f"v{batch:09d}"
        made, final = self._path(f"versions/.{name}"), self._path(f"versions/{name}")
        stream = fs.create(made, True)
        stream.write(bytearray(json.dumps(version).encode()))
        stream.close()
        fs.delete(final, False)
        fs.rename(made, final)
        names = [n for n in self._names("versions", "v") if n <= name]
        live = {place for n in names[-2:] for place in _places(self._load(n))}
        used = {place.split("/")[0] for place in live}
        for old in names[:-2]:
            dropped = self._load(old)
            gone = {part for part in dropped["made"] if part not in used}
            for place in _places(dropped) - live:
                part = place.split("/")[0]
                gone.add(place if part in used else part)
            for place in gone:
                fs.delete(self._path(place), True)
            fs.delete(self._path(f"versions/{old}"), False)

    # --- rows

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{place}" for place in sorted(places)])

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, self.keys[0], BATCH) if self.upsert else rows

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, one per key."""
        return self._newest(self._rows(list(_places(self.version(before))))).select(*self.columns)

    def held(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """The store's rows whose key is among those of ``rows``; only their buckets are read.

        ``rows`` is small beside the store and persisted by the caller. As many numbers as there are
        buckets may come to the driver.
        """
        wanted = {str(row[0]) for row in rows.select(self.bucket()).distinct().collect()}
        found = self._rows([place for place in _places(self.version(before)) if place.rsplit("=", 1)[1] in wanted])
        return self._newest(held(found, rows, self.keys)).select(*self.columns)

    def _write(self, rows: DataFrame, part: str) -> list[str]:
        writer = (
            rows.withColumn("bucket", self.bucket())
            .repartition("bucket")
            .sortWithinPartitions("bucket", *self.keys)
            .write.mode("overwrite")
            .partitionBy("bucket")
        )
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.folder}/{part}")
        return [name.split("=")[1] for name in self._names(part, "bucket=")]

    def write(self, rows: DataFrame, batch: int, **notes: Any) -> DataFrame:
        """Add ``rows``, one per key, as this batch; returns them as stored. ``notes`` replace those of before."""
        version = self.version(before=batch)
        part = f"part={batch:09d}"
        touched = self._write(rows.select(*self.columns).withColumn(BATCH, F.lit(batch).cast("long")), part)
        for bucket in touched:
            version["parts"].setdefault(bucket, []).append([part, 0])
        version["made"] = [part, *self._merge(version, batch)]
        version["notes"].update(notes)
        self._commit(version, batch)
        return self._rows([f"{part}/bucket={bucket}" for bucket in touched]).drop(BATCH)

    def note(self, name: str, default: Any, before: int | None = None) -> Any:
        return self.version(before)["notes"].get(name, default)

    def _merge(self, version: dict[str, Any], batch: int) -> list[str]:
        """Merge the smallest size class that is full, in every bucket where one is; the parts it made."""
        made = []
        full: dict[int, dict[str, list[str]]] = {}
        for bucket, parts in version["parts"].items():
            for size in sorted({size for _, size in parts}):
                same = [part for part, of in parts if of == size]
                if len(same) >= self.merge_after:
                    full.setdefault(size, {})[bucket] = same
                    break
        for size, by_bucket in full.items():
            places = [f"{part}/bucket={bucket}" for bucket, parts in by_bucket.items() for part in parts]
            merged = f"merged={batch:09d}-{size}"
            self._write(self._newest(self._rows(places)), merged)
            for bucket, parts in by_bucket.items():
                kept = [entry for entry in version["parts"][bucket] if entry[0] not in parts]
                version["parts"][bucket] = [[merged, size + 1], *kept]
            made.append(merged)
        return made


def _places(version: dict[str, Any]) -> set[str]:
    return {f"{part}/bucket={bucket}" for bucket, parts in version["parts"].items() for part, _ in parts}
