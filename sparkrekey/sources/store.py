"""Named tables as generations of parquet behind pointers: what MERGE, clone, swap and rollback need without a table format."""

from __future__ import annotations

import contextlib
import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KINDS = ("prod", "wip", "source", "staging", "keymap", "config", "view")
#: How often and how long (seconds) a writer waits for another one's lock.
TRIES, WAIT = 100, 0.1


class TableStore:
    """root/kind/table.json points at a generation: a list of folders. Writers make a new folder, then move the pointer under a lock, so that none is lost; readers never see half a write.

    Files and pointers go through Hadoop's file system, so the root may be in any store that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self, kind: str, table: str) -> str:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}: {kind}")
        return f"{self.root}/{kind}/{table.lower()}.json"

    def _state(self, kind: str, table: str) -> dict | None:
        path = self._path(self._pointer(kind, table))
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _move(self, kind: str, table: str, state: dict) -> None:
        to = self._path(self._pointer(kind, table))
        new = self._path(f"{to.toString()}.{uuid.uuid4().hex}")
        stream = self._fs.create(new)
        stream.write(json.dumps(state).encode())
        stream.close()
        options = getattr(self.spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename")
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        array = self.spark.sparkContext._gateway.new_array(options, 1)
        array[0] = options.OVERWRITE
        context.rename(self._fs.makeQualified(new), self._fs.makeQualified(to), array)

    @contextlib.contextmanager
    def _locked(self, kind: str, table: str):
        """Holds the pointer's lock file, which only one writer can create."""
        lock = self._path(self._pointer(kind, table) + ".lock")
        for _ in range(TRIES):
            if self._fs.createNewFile(lock):
                break
            time.sleep(WAIT)
        else:
            raise TimeoutError(f"another writer holds {lock.toString()}; delete it if that one has died")
        try:
            yield
        finally:
            self._fs.delete(lock, False)

    def exists(self, kind: str, table: str) -> bool:
        return self._state(kind, table) is not None

    def read(self, kind: str, table: str, back: int = 0) -> DataFrame:
        """The table, or the generation `back` writes before; a view reads the table that it points at now."""
        state = self._state(kind, table)
        if state is None:
            raise FileNotFoundError(f"{kind}.{table}")
        if "alias" in state:
            return self.read(*state["alias"], back)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(state["schemas"][-1 - back]))).parquet(*state["generations"][-1 - back])

    def _written(self, table: str, df: DataFrame) -> str:
        folder = f"{self.root}/data/{table.lower()}-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def write(self, kind: str, table: str, df: DataFrame, properties: dict | None = None) -> DataFrame:
        """A new generation, even of a table that df reads."""
        folder = self._written(table, df)
        with self._locked(kind, table):
            state = self._state(kind, table) or {"generations": [], "schemas": [], "properties": {}}
            state["generations"].append([folder])
            state["schemas"].append(df.schema.json())
            state["properties"] |= properties or {}
            self._move(kind, table, state)
        return self.read(kind, table)

    def append(self, kind: str, table: str, rows: DataFrame) -> DataFrame:
        """A new generation with the rows' folder beside those of the one before, which aren't rewritten; new columns are null in older rows. Without rows nothing changes, unless the table is new."""
        if self.exists(kind, table) and rows.isEmpty():
            return self.read(kind, table)
        folder = self._written(table, rows)
        with self._locked(kind, table):
            state = self._state(kind, table) or {"generations": [], "schemas": [], "properties": {}}
            old = T.StructType.fromJson(json.loads(state["schemas"][-1])) if state["schemas"] else T.StructType()
            schema = T.StructType([*old.fields, *(f for f in rows.schema.fields if f.name.lower() not in {x.lower() for x in old.names})])
            state["generations"].append([*(state["generations"][-1] if state["generations"] else []), folder])
            state["schemas"].append(schema.json())
            self._move(kind, table, state)
        return self.read(kind, table)

    def properties(self, kind: str, table: str) -> dict:
        return (self._state(kind, table) or {"properties": {}})["properties"]

    def clone(self, kind: str, table: str, to_kind: str, to_table: str) -> None:
        """The same generation under another name; no data is copied, and writes to either leave the other alone."""
        state = self._state(kind, table)
        if state is None:
            raise FileNotFoundError(f"{kind}.{table}")
        self._move(to_kind, to_table, {"generations": state["generations"][-1:], "schemas": state["schemas"][-1:], "properties": dict(state["properties"])})

    def swap(self, kind: str, table: str, from_kind: str, from_table: str) -> None:
        """The table points at the other's generation; its own stays as the one before, for rollback."""
        old, new = self._state(kind, table) or {"generations": [], "schemas": [], "properties": {}}, self._state(from_kind, from_table)
        if new is None:
            raise FileNotFoundError(f"{from_kind}.{from_table}")
        self._move(kind, table, {"generations": [*old["generations"], new["generations"][-1]], "schemas": [*old["schemas"], new["schemas"][-1]], "properties": {**old["properties"], **new["properties"]}})

    def rollback(self, kind: str, table: str) -> None:
        state = self._state(kind, table)
        if state is None or len(state["generations"]) < 2:
            raise ValueError(f"{kind}.{table} has no earlier generation")
        self._move(kind, table, {**state, "generations": state["generations"][:-1], "schemas": state["schemas"][:-1]})

    def view(self, kind: str, table: str, name: str) -> None:
        """A view that points at the table, for read("view", name) in any session, and a temporary view of this session's on its present generation."""
        self.read(kind, table).createOrReplaceTempView(name)
        with self._locked("view", name):
            self._move("view", name, {"alias": [kind, table]})

    def columns(self) -> DataFrame:
        """table_name, column_name of the production tables: the catalogue that discovery reads."""
        folder = self._path(f"{self.root}/prod")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        rows = [(t, c) for t in sorted(n[:-5] for n in names if n.endswith(".json")) for c in self.read("prod", t).columns]
        return self.spark.createDataFrame(rows, "table_name string, column_name string")


def wip_name(table: str, run_id: str) -> str:
    return f"{table}__" + re.sub(r"\W", "_", run_id)
