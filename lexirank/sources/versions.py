"""Tables in ranges of their key, with a manifest for each version.

A folder holds `data/`, whose files never change, and `manifests/`, one JSON document for each version: the ranges of the
key in order, and the files of each. A merge rewrites the ranges that its rows touch and publishes the next manifest, whose
name no other writer can take; readers pin a version and never meet a half-written one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

#: Rows of a range; one that would hold twice as many is cut.
RANGE_ROWS = 1_000_000


class Conflict(RuntimeError):
    """Another writer published a version that changes what this one has read."""


@dataclass(frozen=True)
class Range:
    """Keys from `low` (None: from the least, null keys among them) up to the next range's low."""

    low: int | None
    files: tuple[str, ...] = ()
    rows: int = 0


@dataclass(frozen=True)
class Manifest:
    version: int
    key: str
    schema: str
    ranges: tuple[Range, ...]
    #: The last batch of each source that is in the table, for writers that may come twice.
    applied: dict[str, int] = field(default_factory=dict)

    @property
    def lows(self) -> list[int]:
        """Where the second range begins, the third, and so on."""
        return [r.low for r in self.ranges[1:]]

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Manifest:
        found = json.loads(text)
        ranges = tuple(Range(r["low"], tuple(r["files"]), r["rows"]) for r in found.pop("ranges"))
        return cls(ranges=ranges, **found)


def range_number(key: Column, lows: list[int]) -> Column:
    """The number of a key's range; null keys are in the first."""
    bounds = np.array(lows, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, keys.fillna(np.iinfo(np.int64).min).to_numpy(np.int64), side="right")
        return pd.Series(found.astype(np.int32))

    return place(key.cast("long")) if lows else F.lit(0)


class VersionedTable:
    """A table at a path that the driver and all executors share, keyed by a column of whole numbers."""

    def __init__(self, spark: SparkSession, path: str, range_rows: int = RANGE_ROWS) -> None:
        self.spark, self.path, self.range_rows = spark, path.rstrip("/"), range_rows

    def _place(self, *parts: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        place, fs = self._place("manifests")
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """That of a version, or the newest; None if there is none."""
        if version is None:
            there = self.versions()
            if not there:
                return None
            version = there[-1]
        place, fs = self._place("manifests", f"{version:012d}.json")
        if not fs.exists(place):
            raise ValueError(f"{self.path}: no version {version}")
        stream = fs.open(place)
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> bool:
        """Put the manifest where there is none of its version; False if there is one.

        The document is written aside and takes its name in one step that fails if the name is taken: a link on a local
        disk, elsewhere a rename that does not overwrite, which is as safe as the store makes it.
        """
        place, fs = self._place("manifests", f"{manifest.version:012d}.json")
        aside, _ = self._place("manifests", f".{uuid.uuid4().hex}")
        fs.mkdirs(place.getParent())
        out = fs.create(aside, True)
        out.write(bytearray(manifest.text().encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                import os

                try:
                    os.link(aside.toUri().getPath(), place.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            if fs.exists(place):
                return False
            return bool(fs.rename(aside, place))
        finally:
            fs.delete(aside, False)

    def read(self, version: int | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
        """The rows of a version, pinned; of keys from low to high only the ranges that may hold them are read."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"{self.path}: no table")
        return self._rows(manifest, self._between(manifest, low, high), low, high)

    @staticmethod
    def _between(manifest: Manifest, low: int | None, high: int | None) -> list[Range]:
        nexts = [*manifest.lows, None]
        return [r for r, end in zip(manifest.ranges, nexts) if (low is None or end is None or end > low) and (high is None or r.low is None or r.low <= high)]

    def _rows(self, manifest: Manifest, ranges: list[Range], low: int | None = None, high: int | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest.schema))
        files = [f"{self.path}/data/{f}" for r in ranges for f in r.files]
        rows = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        key = F.col(manifest.key)
        if low is not None:
            rows = rows.filter(key >= low)
        return rows.filter(key <= high) if high is not None else rows

    def _cuts(self, rows: DataFrame, key: str, crowded: list[int], counts: dict[int, int]) -> dict[int, list[int]]:
        """Where ranges that hold too much are cut, by quantiles of their keys."""
        most = max(-(-counts[n] // self.range_rows) for n in crowded)
        parts = F.percentile_approx(key, [i / most for i in range(1, most)] or [0.5], 10_000).alias("at")
        found = rows.filter(F.col("_range").isin(crowded)).groupBy("_range").agg(parts, F.min(key).alias("least")).collect()
        cuts = {}
        for r in found:
            wanted = -(-counts[r["_range"]] // self.range_rows)
            picked = [r["at"][min(len(r["at"]) - 1, round(i * most / wanted) - 1)] for i in range(1, wanted)] if r["at"] else []
            cuts[r["_range"]] = sorted({p for p in picked if p is not None and p > r["least"]})
        return cuts

    def merge(self, rows: DataFrame, key: str = "word_id", seq: str = "seq", *, source: str = "", batch: int | None = None) -> Manifest:
        """The table with these rows: of each key the row with the greatest seq, so rows that come twice change nothing.

        Only ranges that the rows touch are read and written. With a batch, a source's batches up to the last that is in
        the table are passed over. If another writer was first, the merge stands if that one changed other ranges; else
        it is a Conflict, and what was written is left to vacuum(). Rows without a key are one row. A table is made by
        its first merge; the key's type is a whole number, and rows have the table's columns.
        """
        base = self.manifest()
        if base and batch is not None and batch <= base.applied.get(source, -1):
            return base
        kind = rows.schema[key].dataType.simpleString()
        if kind not in ("tinyint", "smallint", "int", "bigint"):
            raise ValueError(f"a key is a whole number, {key} is {kind}")
        if base is None:
            base = Manifest(-1, key, rows.schema.json(), (Range(None),))
        schema = StructType.fromJson(json.loads(base.schema))
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        placed = rows.withColumn("_range", range_number(F.col(key), base.lows)).persist()
        try:
            counts = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
            if not counts and base.version >= 0:
                return base if batch is None else self._commit(base, base, {}, source, batch)
            old = self._rows(base, [base.ranges[n] for n in counts]).withColumn("_range", range_number(F.col(key), base.lows))
            both = old.unionByName(placed)
            sizes = {n: counts[n] + base.ranges[n].rows for n in counts}
            crowded = [n for n in counts if sizes[n] >= 2 * self.range_rows]
            cuts = self._cuts(both, key, crowded, sizes) if crowded else {}
            return self._commit(base, base, self._write(both, schema, key, seq, base, sorted(counts), cuts), source, batch)
        finally:
            placed.unpersist()

    def _write(self, both: DataFrame, schema: StructType, key: str, seq: str, base: Manifest, touched: list[int], cuts: dict[int, list[int]]) -> dict[int, list[Range]]:
        """Files of the touched ranges, one after the other by key; the new ranges in the place of each."""
        folder = uuid.uuid4().hex
        lows = sorted({*base.lows, *(c for own in cuts.values() for c in own)})
        last = both.drop("_range").groupBy(key).agg(F.max_by(F.struct(*schema.names), F.col(seq)).alias("_row")).select("_row.*")
        parts = last.withColumn("_part", range_number(F.col(key), lows))
        many = len(touched) + sum(map(len, cuts.values()))
        parts = parts.repartition(max(1, many), "_part").sortWithinPartitions("_part", key)
        path = f"{self.path}/data/{folder}"
        parts.write.partitionBy("_part").parquet(path)
        written = self.spark.read.schema(StructType([*schema.fields]).add("_part", LongType())).parquet(path)
        rows = {r["_part"]: r["n"] for r in written.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
        place, fs = self._place("data", folder)
        files: dict[int, list[str]] = {}
        for s in fs.listStatus(place):
            name = s.getPath().getName()
            if name.startswith("_part="):
                inner = [f.getPath().getName() for f in fs.listStatus(s.getPath())]
                files[int(name.split("=")[1])] = sorted(f"{folder}/{name}/{f}" for f in inner if f.endswith(".parquet"))
        out = {}
        for n in touched:
            own = [base.ranges[n].low, *cuts.get(n, [])]
            numbers = [0 if low is None else lows.index(low) + 1 for low in own]
            out[n] = [Range(low, tuple(files.get(p, ())), rows.get(p, 0)) for low, p in zip(own, numbers)]
        return out

    def _commit(self, base: Manifest, read: Manifest, changed: dict[int, list[Range]], source: str, batch: int | None) -> Manifest:
        """Publish, after `base`; after a newer one if that has, where it matters, what was read."""
        while True:
            if base.version != read.version:
                if batch is not None and batch <= base.applied.get(source, -1):
                    return base
                if base.key != read.key or base.schema != read.schema:
                    raise Conflict(f"{self.path}: version {base.version} has other columns")
            by_low = {(r.low, r.files): n for n, r in enumerate(base.ranges)}
            new = list(map(lambda r: [r], base.ranges))
            for n, ranges in changed.items():
                own = read.ranges[n]
                end = (read.lows + [None])[n]
                at = by_low.get((own.low, own.files))
                if at is None or (base.lows + [None])[at] != end:
                    raise Conflict(f"{self.path}: version {base.version} changed keys from {own.low} on")
                new[at] = ranges
            applied = base.applied | ({source: batch} if batch is not None else {})
            done = replace(base, version=base.version + 1, ranges=tuple(r for own in new for r in own), applied=applied)
            if self._publish(done):
                return done
            base = self.manifest()

    def vacuum(self, keep: int = 10) -> int:
        """Delete all versions but the last `keep`, and files that none of these has; the number of files deleted.

        Not while a merge runs, whose files no version has yet; readers of older versions must have ended.
        """
        there = self.versions()
        kept = {f for v in there[-keep:] for r in self.manifest(v).ranges for f in r.files}
        for v in there[:-keep]:
            place, fs = self._place("manifests", f"{v:012d}.json")
            fs.delete(place, False)
        top, fs = self._place("data")
        gone = 0
        for folder in fs.listStatus(top) if fs.exists(top) else []:
            name, used = folder.getPath().getName(), False
            for part in fs.listStatus(folder.getPath()):
                if not part.isDirectory():
                    continue
                for f in fs.listStatus(part.getPath()):
                    path = f"{name}/{part.getPath().getName()}/{f.getPath().getName()}"
                    used |= path in kept
                    if path.endswith(".parquet") and path not in kept:
                        fs.delete(f.getPath(), False)
                        gone += 1
            if not used:
                fs.delete(folder.getPath(), True)
        return gone
