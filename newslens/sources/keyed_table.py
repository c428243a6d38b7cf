"""Stored tables that change by key: replace, delete, add up, and read at any moment.

Rows lie in folders by generation and bucket, a bucket being a hash of the key. A change writes a new generation that
holds only the buckets it touches; all others keep their files. Deleted keys are stored by themselves, sorted, and hide
older rows when the table is read, until a compaction rewrites the buckets that hold them. What counts is the last
snapshot: one row that says which generations of each bucket, and which deletions, are valid. It is written last, in
one file, so that readers see a change as a whole or not at all, and a change that broke down is made again over its
own leftovers. One job at a time may change a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from newslens.session import written
from newslens.sources.sinks import remove_folder

_SNAPSHOT = "live map<int,array<long>>, gone map<long,array<int>>, upto long"
_PLACE = [StructField("gen", LongType()), StructField("bucket", IntegerType())]


@dataclass(frozen=True)
class Snapshot:
    """``live``: generations of each bucket. ``gone``: buckets of each deletion. ``upto``: last batch taken in."""

    gen: int = 0
    live: dict[int, list[int]] = field(default_factory=dict)
    gone: dict[int, list[int]] = field(default_factory=dict)
    upto: int = -1


@dataclass(frozen=True)
class KeyedTable:
    """A table below ``path``; a key may have several rows, which are replaced and deleted together.

    The number of buckets is fixed for a table; it bounds what the driver sees of it. Hot keys may fill a bucket:
    its rows are then written by up to ``parts`` tasks.
    """

    spark: SparkSession
    path: str
    schema: StructType
    keys: list[str]
    buckets: int = 64
    parts: int = 8

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _stored(self, folder: str, schema: StructType) -> DataFrame:
        where = f"{self.path}/{folder}"
        place = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where)

    def snapshot(self) -> Snapshot:
        shape = StructType([*self.spark.createDataFrame([], _SNAPSHOT).schema, _PLACE[0]])
        last = self._stored("snapshots", shape).orderBy(F.desc("gen")).first()
        return Snapshot(last["gen"], last["live"], last["gone"], last["upto"]) if last else Snapshot()

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows as they are now; of some ``buckets`` only, if given, which then are all that is scanned."""
        return self._rows(self.snapshot(), buckets).select(*self.schema.names)

    def _rows(self, snap: Snapshot, buckets: list[int] | None) -> DataFrame:
        chosen = {b: gens for b, gens in snap.live.items() if buckets is None or b in buckets}
        by_gen: dict[int, list[int]] = {}
        for bucket, gens in chosen.items():
            for gen in gens:
                by_gen.setdefault(gen, []).append(bucket)
        valid = F.lit(False)
        for gen, those in sorted(by_gen.items()):
            valid = valid | ((F.col("gen") == gen) & F.col("bucket").isin(those))
        rows = self._stored("rows", StructType([*self.schema, *_PLACE])).where(valid)
        hidden = [gen for gen, those in snap.gone.items() if set(those) & set(chosen)]
        if not hidden:
            return rows
        keys = StructType([f for f in self.schema if f.name in self.keys])
        gone = self._stored("gone", StructType([*keys, *_PLACE])).where(F.col("gen").isin(hidden)).select(
            *[F.col(k).alias(f"_{k}") for k in self.keys], F.col("gen").alias("_gen"), F.col("bucket").alias("_bucket"))
        match = (rows["bucket"] == gone["_bucket"]) & (rows["gen"] < gone["_gen"])
        for k in self.keys:
            match = match & rows[k].eqNullSafe(gone[f"_{k}"])
        return rows.join(gone, match, "left_anti")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys of ``keys``, at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())

    def _write(self, rows: DataFrame, folder: str, gen: int) -> None:
        placed = rows.withColumn("bucket", self._bucket())
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(self.parts))
        placed.repartition("bucket", part).sortWithinPartitions("bucket", *self.keys).write.mode("overwrite").partitionBy(
            "bucket").parquet(f"{self.path}/{folder}/gen={gen}")

    def _commit(self, old: Snapshot, live: dict, gone: dict, upto: int | None) -> None:
        """Make a generation valid, then drop files that neither this snapshot nor the one before needs."""
        gone = {gen: those for gen, those in gone.items() if any(min(live.get(b, [gen])) < gen for b in those)}
        new = Snapshot(old.gen + 1, live, gone, old.upto if upto is None else upto)
        row = self.spark.createDataFrame([(new.live, new.gone, new.upto)], _SNAPSHOT)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/gen={new.gen}")
        needed = {g for snap in (old, new) for gens in snap.live.values() for g in gens} | set(old.gone) | set(new.gone)
        for gen in self._generations() - needed - {new.gen, old.gen}:
            for folder in ("rows", "gone", "snapshots"):
                remove_folder(self.spark, f"{self.path}/{folder}/gen={gen}")

    def _generations(self) -> set[int]:
        found = set()
        for folder in ("rows", "gone", "snapshots"):
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            store = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if store.exists(place):
                names = [s.getPath().getName() for s in store.listStatus(place)]
                found |= {int(n.removeprefix("gen=")) for n in names if n.startswith("gen=")}
        return found

    def rewrite(self, buckets: list[int], change: Callable[[DataFrame], DataFrame], upto: int | None = None) -> None:
        """Replace the rows of ``buckets`` by what ``change`` makes of them."""
        old = self.snapshot()
        if buckets:
            now = self._rows(old, buckets).select(*self.schema.names)
            self._write(change(now).select(*[F.col(f.name).cast(f.dataType) for f in self.schema]), "rows", old.gen + 1)
        live = {**old.live, **{b: [old.gen + 1] for b in buckets}}
        self._commit(old, live, old.gone, upto)

    def upsert(self, batch: DataFrame, upto: int | None = None) -> None:
        """Rows of ``batch`` take the place of all rows with their keys."""
        batch = written(batch.select(*self.schema.names), "upsert")
        keys = batch.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()

        def change(rows: DataFrame) -> DataFrame:
            match = F.lit(True)
            for k in self.keys:
                match = match & rows[k].eqNullSafe(keys[f"_{k}"])
            return rows.join(keys, match, "left_anti").unionByName(batch)

        self.rewrite(self.touched(batch), change, upto)

    def add_up(self, changes: DataFrame, upto: int | None = None, alive: Column | None = None) -> None:
        """Add the numbers of ``changes`` (negative ones take away) to the rows with their keys.

        All columns but the keys are numbers. A row for which ``alive`` is no longer true is dropped.
        """
        changes = written(changes.select(*self.schema.names), "changes")
        numbers = [c for c in self.schema.names if c not in self.keys]

        def change(rows: DataFrame) -> DataFrame:
            summed = rows.unionByName(changes).groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in numbers])
            return summed if alive is None else summed.where(alive)

        self.rewrite(self.touched(changes), change, upto)

    def append(self, rows: DataFrame) -> None:
        """Add rows without looking at those that are there."""
        old = self.snapshot()
        rows = written(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]), "append")
        self._write(rows, "rows", old.gen + 1)
        live = {**old.live, **{b: [*old.live.get(b, []), old.gen + 1] for b in self.touched(rows)}}
        self._commit(old, live, old.gone, None)

    def delete(self, keys: DataFrame) -> None:
        """Hide all present rows of ``keys``; no file with rows is written."""
        old = self.snapshot()
        keys = written(keys.select(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]).distinct(), "gone")
        touched = [b for b in self.touched(keys) if b in old.live]
        self._write(keys, "gone", old.gen + 1)
        self._commit(old, old.live, {**old.gone, old.gen + 1: touched} if touched else old.gone, None)

    def compact(self, most: int = 4) -> None:
        """Rewrite buckets with deletions, and those of more than ``most`` generations."""
        snap = self.snapshot()
        hidden = {b for gen, those in snap.gone.items() for b in those if min(snap.live[b]) < gen}
        many = {b for b, gens in snap.live.items() if len(gens) > most}
        if hidden | many:
            self.rewrite(sorted(hidden | many), lambda rows: rows)
