"""Layer tables in the session catalog, with versions.

Each table is an external Parquet table. A change writes new folders from the executors, records them in a
manifest (the table's version: which folder holds which part), and then points the catalog at them, so a
table can be rebuilt from itself and readers never see a folder half written.

Tables that are merged by key are cut into buckets by a hash of the key, one catalog
partition and one folder a bucket. A delivery names its buckets; only those are read, merged and
switched, so the cost follows the delivery and not the table. Bronze tables have one part per load. The column
that names the part is hidden from readers.

After each switch the versions before the last ``keep_versions`` go, but for leased ones: a reader
that needs a version for longer takes a lease. A part that several versions share stays as long as one of them does.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType, TimestampType

from orderloom.functions.scalar import any_null, nan_to_null
from orderloom.operators.merge import upsert
from orderloom.schemas import LAYERS, LOADED_TABLES, MERGE_KEYS, TABLES
from orderloom.sources.folders import child_names, delete_folder, read_json, write_json
from orderloom.sources.staging import discard, stage

BUCKETS = 16
KEYLESS = -1
BUCKET, LOAD = "_bucket", "_load"
WHOLE = ""  # the only part of a table that isn't cut


def _at_boundary(df: DataFrame, name: str) -> Column:
    """NaN becomes NULL and timestamps lose their zone when a frame is stored."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return nan_to_null(F.col(name))
    if isinstance(kind, TimestampType):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; columns the frame lacks are NULL."""
    return df.select(
        *[
            (_at_boundary(df, f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Part of a row by its key; rows whose key contains NULL, which match nothing, have one of their own."""
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return F.when(any_null(list(keys)), F.lit(KEYLESS)).otherwise(number)


class LayerTables:
    """Tables named ``layer.table`` under ``root``; ``prefix`` keeps several sets apart.

    ``buckets`` is for tables that are created now; a table keeps the number it was created with.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = BUCKETS, keep_versions: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.buckets = buckets
        self.keep_versions = keep_versions

    # --- names and places ---

    def qualified(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _fresh_location(self, name: str) -> str:
        return f"{self._folder(name)}/v-{uuid.uuid4().hex}"

    @staticmethod
    def part_column(name: str) -> str | None:
        """The hidden column that names a row's part."""
        return BUCKET if name in MERGE_KEYS else LOAD if name in LOADED_TABLES else None

    # --- versions ---

    def versions(self, name: str) -> list[int]:
        return [int(n.removesuffix(".json")) for n in child_names(self.spark, f"{self._folder(name)}/manifest")]

    def manifest(self, name: str, version: int | None = None) -> dict:
        """``{"buckets": n, "parts": {part: folder}}`` of a version, the newest by default."""
        known = self.versions(name)
        if not known:
            return {"buckets": self.buckets, "parts": {}}
        return read_json(self.spark, f"{self._folder(name)}/manifest/{known[-1] if version is None else version:010d}.json")

    def _record(self, name: str, parts: dict[str, str], buckets: int) -> int:
        number = (self.versions(name) or [0])[-1] + 1
        write_json(self.spark, f"{self._folder(name)}/manifest/{number:010d}.json", {"buckets": buckets, "parts": parts})
        return number

    def _switch(self, name: str, changed: dict[str, str], whole: bool) -> None:
        """Make ``changed`` parts (all parts, if ``whole``) the newest version, and drop versions out of use."""
        before = self.manifest(name)
        parts = dict(changed) if whole else {**before["parts"], **changed}
        self._record(name, parts, before["buckets"])
        self._point(name, changed, [p for p in before["parts"] if p not in parts])
        self.sweep(name)

    def _point(self, name: str, changed: dict[str, str], gone: Sequence[str] = ()) -> None:
        table, column = self.qualified(name), self.part_column(name)
        if column is None:
            for folder in changed.values():
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        else:
            known = {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
            new = [p for p in changed if p not in known]
            if new:
                added = " ".join(f"PARTITION ({column}='{p}') LOCATION '{changed[p]}'" for p in new)
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
            for p in changed:
                if p in known:
                    self.spark.sql(f"ALTER TABLE {table} PARTITION ({column}='{p}') SET LOCATION '{changed[p]}'")
            for p in gone:
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column}='{p}')")
        self.spark.catalog.refreshTable(table)

    def sweep(self, name: str, keep: int | None = None) -> None:
        """Delete versions that are neither among the newest ``keep`` nor leased, and the folders that only they use."""
        folder, known = self._folder(name), self.versions(name)
        kept = set(known[-(keep or self.keep_versions) :]) | self._leased(name)
        if set(known) <= kept:
            return
        used = {place for v in kept & set(known) for place in self.manifest(name, v)["parts"].values()}
        stale = {place for v in set(known) - kept for place in self.manifest(name, v)["parts"].values()} - used
        for place in stale:
            delete_folder(self.spark, place)
        for v in set(known) - kept:
            delete_folder(self.spark, f"{folder}/manifest/{v:010d}.json")
        # A written folder with no part left in use.
        roots = {place.split("/v-")[1].split("/")[0] for place in used}
        for n in {place.split("/v-")[1].split("/")[0] for place in stale} - roots:
            delete_folder(self.spark, f"{folder}/v-{n}")

    def drop_old_versions(self, name: str) -> None:
        """Delete every unleased version but the newest."""
        self.sweep(name, keep=1)

    def _leased(self, name: str) -> set[int]:
        folder, found = f"{self._folder(name)}/lease", set()
        for n in child_names(self.spark, folder):
            lease = read_json(self.spark, f"{folder}/{n}")
            if lease["until"] < time.time():
                delete_folder(self.spark, f"{folder}/{n}")
            else:
                found.add(lease["version"])
        return found

    @contextmanager
    def leased(self, name: str, hours: float = 24.0) -> Iterator[DataFrame]:
        """The newest version as it is now, readable until the block ends (or the hours are over) whatever is written meanwhile."""
        version = (self.versions(name) or [0])[-1]
        lease = f"{self._folder(name)}/lease/{uuid.uuid4().hex}.json"
        write_json(self.spark, lease, {"version": version, "until": time.time() + 3600 * hours})
        try:
            places, schema = list(self.manifest(name)["parts"].values()), self.read(name).schema
            yield self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)
        finally:
            delete_folder(self.spark, lease)

    # --- tables ---

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'")

    def create_table(self, name: str, schema: StructType | None = None) -> None:
        """Create the table if it is missing and add the columns it lacks. A new session finds
        the newest version of a table that is there already."""
        schema = schema or TABLES[name]
        if self.spark.catalog.tableExists(self.qualified(name)):
            self.evolve(name, schema)
            return
        columns, part = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields), self.part_column(name)
        hidden = {BUCKET: f", {BUCKET} int", LOAD: f", {LOAD} string", None: ""}[part]
        partitioned = f"PARTITIONED BY ({part})" if part else ""
        location = self._fresh_location(name)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.qualified(name)} ({columns}{hidden}) USING parquet {partitioned} LOCATION '{location}'"
        )
        stored = self.manifest(name)["parts"]
        if stored:
            self._point(name, stored)
        elif part is None:
            self._record(name, {WHOLE: location}, self.buckets)

    def create_all(self) -> None:
        self.create_layers()
        for name in TABLES:
            self.create_table(name)

    def evolve(self, name: str, schema: StructType) -> None:
        """Add missing columns; existing rows read them as NULL."""
        known = {f.name.lower() for f in self.read(name).schema.fields}
        missing = [f for f in schema.fields if f.name.lower() not in known]
        if missing:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.qualified(name)} ADD COLUMNS ({columns})")

    def _ensure(self, name: str, df: DataFrame) -> None:
        if not self.spark.catalog.tableExists(self.qualified(name)):
            self.create_table(name, TABLES.get(name, df.schema))

    def read(self, name: str) -> DataFrame:
        part = self.part_column(name)
        table = self.spark.table(self.qualified(name))
        return table.drop(part) if part else table

    def _bucketed(self, name: str, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(MERGE_KEYS[name], self.manifest(name)["buckets"]))

    def _write(self, name: str, df: DataFrame, load: str | None = None) -> dict[str, str]:
        """Write a frame into fresh folders; gives the folder of each part."""
        location, part = self._fresh_location(name), self.part_column(name)
        rows = conform(df, self.read(name).schema)
        if part == BUCKET:
            # Rebalancing keeps a bucket's files few and splits large ones over several tasks.
            self._bucketed(name, rows).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(location)
            return {n.split("=")[1]: f"{location}/{n}" for n in child_names(self.spark, location) if n.startswith(f"{BUCKET}=")}
        rows.write.parquet(location)
        return {load or uuid.uuid4().hex: location} if part == LOAD else {WHOLE: location}

    def replace(self, name: str, df: DataFrame) -> None:
        """Full refresh. ``df`` may read the table it replaces."""
        self._ensure(name, df)
        self._switch(name, self._write(name, df), whole=True)

    def add_load(self, name: str, df: DataFrame, load: str, replace: bool = False) -> None:
        """Add a load's rows as a part named ``load``, or make it the only one."""
        self._ensure(name, df)
        self._switch(name, self._write(name, df, load), whole=replace)

    def loads(self, name: str) -> list[str]:
        """The loads that a bronze table consists of."""
        return list(self.manifest(name)["parts"])

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows; an empty frame adds nothing."""
        self._ensure(name, df)
        part = self.part_column(name)
        if part == LOAD:
            if not df.isEmpty():
                self.add_load(name, df, uuid.uuid4().hex)
        elif part == BUCKET:
            self._rewrite(name, df, lambda known, rows: known.unionByName(rows))
        else:
            conform(df, self.read(name).schema).write.insertInto(self.qualified(name))

    def upsert(self, name: str, source: DataFrame, keys: list[str], **options) -> None:
        """Merge ``source`` by key. Of a table that is merged by these keys, only the delivery's buckets are read and written."""
        self._ensure(name, source)
        if MERGE_KEYS.get(name) != list(keys):
            self.replace(name, upsert(self.read(name), source, keys, **options))
            return
        self._rewrite(name, source, lambda known, rows: upsert(known, rows, keys, **options))

    def _rewrite(self, name: str, source: DataFrame, merged) -> None:
        """Replace the buckets that ``source`` has rows for by what ``merged`` makes of them and those rows."""
        schema = self.read(name).schema
        known_types = {f.name: f.dataType for f in schema.fields}
        rows = source.select(*[_at_boundary(source, c).cast(known_types[c]).alias(c) if c in known_types else F.col(c) for c in source.columns])
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in source.columns})
        # Written once: the buckets, the check for repeated keys and the merge all read it.
        staged = stage(self._bucketed(name, rows), "delivery")
        touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # at most buckets + 1 numbers
        if touched:
            known = self.spark.table(self.qualified(name)).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
            rows = staged.drop(BUCKET)
            self._switch(name, self._write(name, merged(known, rows)), whole=False)
        discard(staged)

    def replace_view(self, name: str, query: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(name)} AS {query}")
