"""A table that batches are appended to, and the snapshots that say what belongs to it.

A batch is written into a directory of its own. It becomes part of the table with the next
snapshot, a small file that lists all parts and the last batch of each stream; the file gets
its number by a rename that fails if the number is taken. So a reader sees all of a batch or
nothing of it, a batch that is run again after its commit does nothing, and what a killed batch
has left is never read. Data columns may have any names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Snapshots:
    """Numbered JSON files in a folder, of which the last one holds."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def last(self) -> dict:
        """The last snapshot, with its `version`; an empty one before the first."""
        if not self.exists(self.folder):
            return {"version": 0}
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return {"version": 0}
        text = self.spark.read.text(f"{self.folder}/{max(numbers):012d}.json", wholetext=True).first().value
        return json.loads(text)

    def put(self, snapshot: dict) -> bool:
        """Make `snapshot` the next one; false if another writer was first."""
        final = self._path(f"{self.folder}/{snapshot['version']:012d}.json")
        if self._fs.exists(final):
            return False
        draft = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(snapshot).encode()))
        out.close()
        return bool(self._fs.rename(draft, final))


class AppendTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.snapshots = Snapshots(spark, f"{path}/snapshots")

    def parts(self) -> list[dict]:
        """Path, stream, batch, rows, schema and facts of each committed part."""
        return self.snapshots.last().get("parts", [])

    def holds(self, stream: str, batch: int) -> bool:
        return batch <= self.snapshots.last().get("last", {}).get(stream, -1)

    def append(
        self,
        frame: DataFrame,
        stream: str = "load",
        batch: int | None = None,
        facts: Mapping[str, Column] | None = None,
        known: Mapping[str, object] | None = None,
    ) -> bool:
        """Write `frame` as a part and commit it; false if the batch of the stream is there already.

        The rows and `facts`, aggregates of the frame, are counted while it is written and
        kept with the part, beside what is `known` of it.
        """
        if batch is not None and self.holds(stream, batch):
            return False
        part = f"{self.path}/data/{uuid.uuid4().hex}"
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (facts or {}).items()]]
        frame.observe(seen, *measures).write.parquet(part)
        found = {n: int(x or 0) for n, x in seen.get.items()}
        entry = {
            "path": part,
            "stream": stream,
            "batch": batch,
            "rows": found.pop("rows"),
            "schema": frame.schema.json(),
            "facts": found,
            **(known or {}),
        }
        return self._commit(entry)

    def _commit(self, entry: dict) -> bool:
        stream, batch = entry["stream"], entry["batch"]
        while True:
            old = self.snapshots.last()
            last = dict(old.get("last", {}))
            if batch is not None:
                if batch <= last.get(stream, -1):
                    return False
                last[stream] = batch
            new = {"version": old["version"] + 1, "last": last, "parts": [*old.get("parts", []), entry]}
            if self.snapshots.put(new):
                return True

    def schema(self) -> T.StructType:
        """The columns of all parts, in the order in which they came."""
        fields: dict[str, T.StructField] = {}
        for part in self.parts():
            for f in T.StructType.fromJson(json.loads(part["schema"])).fields:
                fields.setdefault(f.name, T.StructField(f.name, f.dataType))
        return T.StructType(list(fields.values()))

    def read(self) -> DataFrame:
        """The rows of all committed parts; a column that a part lacks is NULL there."""
        paths = [p["path"] for p in self.parts()]
        schema = self.schema()
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def register(self, table: str) -> DataFrame:
        """The committed parts as the partitions of an external table of the catalog."""
        schema = self.schema()
        key = "_part"
        while key in schema.names:
            key = f"_{key}"
        self.spark.sql(f"drop table if exists {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"create table {table} ({columns}, `{key}` int) using parquet partitioned by (`{key}`) location '{self.path}/data'"
        )
        for i, part in enumerate(self.parts()):
            self.spark.sql(f"alter table {table} add partition (`{key}` = {i}) location '{part['path']}'")
        return self.spark.table(table).drop(key)

    def audit(self) -> DataFrame:
        """One row per part: stream, batch, the rows counted when it was written (`processed`),
        those its files hold (`stored`) and whether they agree (`matches`)."""
        parts = self.parts()
        rows = [(p["path"], p["stream"], p["batch"], p["rows"]) for p in parts]
        written = self.spark.createDataFrame(rows, "path string, stream string, batch bigint, processed bigint")
        paths = [p["path"] for p in parts if self.snapshots.exists(p["path"])]
        none = self.spark.createDataFrame([], "folder string, stored bigint")
        stored = none
        if paths:
            folder = F.regexp_extract(F.input_file_name(), r"/data/([0-9a-f]+)/[^/]*$", 1)
            files = self.spark.read.schema(self.schema()).parquet(*paths)
            stored = files.select(folder.alias("folder")).groupBy("folder").agg(F.count("*").alias("stored"))
        count = F.coalesce("stored", F.lit(0)).alias("stored")
        return written.join(stored, F.element_at(F.split("path", "/"), -1) == F.col("folder"), "left").select(
            "stream", "batch", "processed", count, (F.col("processed") == F.coalesce("stored", F.lit(0))).alias("matches")
        )

    def facts(self) -> dict[str, int]:
        """The facts counted with the parts, added up."""
        out: dict[str, int] = {}
        for part in self.parts():
            for name, n in part["facts"].items():
                out[name] = out.get(name, 0) + n
        return out

    def compact(self) -> None:
        """Rewrite all parts as one; streams go on where they were."""
        old = self.snapshots.last()
        parts: Sequence[dict] = old.get("parts", [])
        if len(parts) < 2:
            return
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        schema = self.schema()
        self.read().write.parquet(path)
        kept = [p["quarantine"] for p in parts if p.get("quarantine")]
        kept += [q for p in parts for q in p.get("quarantines", [])]
        one = {
            "path": path,
            "stream": "compacted",
            "batch": None,
            "rows": sum(p["rows"] for p in parts),
            "schema": schema.json(),
            "facts": self.facts(),
            "quarantines": kept,
        }
        if not self.snapshots.put({"version": old["version"] + 1, "last": old.get("last", {}), "parts": [one]}):
            self.snapshots.delete(path)  # something was appended meanwhile: nothing is lost, nothing gained
