"""Several tables that change together: staged files and a manifest that names what counts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Committed:
    """Tables under one folder whose rows become visible together or not at all.

    A commit first writes each table's rows to folders of their own, which nobody reads, and then publishes the next version of the
    manifest, a small file that lists the folders. The file comes by a rename that fails if the version exists, so of two
    writers one starts over on the other's version. Readers take the latest manifest. A batch that it already names is ignored, which
    makes a replayed ``foreachBatch`` harmless. A folder that no manifest names is left from a writer that died; ``swept`` removes it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        where = self._path(self.root)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = where.getFileSystem(conf)
        self._files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _versions(self) -> list[int]:
        where = self._path(f"{self.root}/_manifest")
        names = [f.getPath().getName() for f in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict:
        """version, batches (names of those committed) and tables (name: schema and folders) of the latest version."""
        found = self._versions()
        if not found:
            return {"version": 0, "batches": [], "tables": {}}
        stream = self._fs.open(self._path(f"{self.root}/_manifest/{found[-1]:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _published(self, manifest: dict) -> bool:
        """Whether this version could be made: false if another writer has made it."""
        staged, final = (self._path(f"{self.root}/_manifest/{n}") for n in (f"_{uuid.uuid4().hex}", f"{manifest['version']:012d}.json"))
        out = self._fs.create(staged, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        never = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._files.rename(staged, final, never)
            return True
        except Exception as e:
            self._fs.delete(staged, False)
            if "already exists" not in str(e):
                raise
            return False

    def staged(self, table: str, rows: DataFrame) -> str:
        """Write rows where no reader looks yet; the folder."""
        folder = f"{self.root}/{table}/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def publish(self, batch: str, folders: dict[str, tuple[str, StructType]], replace: tuple[str, ...] = ()) -> bool:
        """Make staged folders visible under the name of their batch; false if it has been committed before. Tables in ``replace`` lose their earlier folders."""
        while True:
            now = self.manifest()
            if batch in now["batches"]:
                return False
            tables = dict(now["tables"])
            for name, (folder, schema) in folders.items():
                old = [] if name in replace else tables.get(name, {}).get("folders", [])
                tables[name] = {"schema": schema.json(), "folders": [*old, folder.removeprefix(f"{self.root}/")]}
            if self._published({"version": now["version"] + 1, "batches": [*now["batches"], batch], "tables": tables}):
                return True

    def commit(self, batch: str, tables: dict[str, DataFrame], replace: tuple[str, ...] = ()) -> bool:
        """Stage and publish; nothing is written for a batch that the manifest names already."""
        if batch in self.manifest()["batches"]:
            return False
        return self.publish(batch, {n: (self.staged(n, rows), rows.schema) for n, rows in tables.items()}, replace)

    def read(self, table: str, schema: StructType | str | None = None) -> DataFrame:
        """A table as of the latest manifest; without a commit of it, no rows of ``schema``."""
        found = self.manifest()["tables"].get(table)
        if found is None:
            return self.spark.createDataFrame([], schema)
        kind = StructType.fromJson(json.loads(found["schema"]))
        # one scan of all folders
        return self.spark.read.schema(kind).parquet(*[f"{self.root}/{f}" for f in found["folders"]]).select(kind.names)

    def compacted(self, table: str, folders: int = 16) -> bool:
        """Rewrite a table of more than ``folders`` folders as one; false if it has no more. Its rows stay the same, and what others commit meanwhile stays.

        Spark reads small files several to a task, so the new folder has fewer and larger ones without a shuffle. The old folders are left to ``swept``.
        """
        while True:
            found = self.manifest()["tables"].get(table)
            if found is None or len(found["folders"]) <= folders:
                return False
            kind, old = StructType.fromJson(json.loads(found["schema"])), found["folders"]
            new = self.staged(table, self.spark.read.schema(kind).parquet(*[f"{self.root}/{f}" for f in old]).select(kind.names))
            while True:
                now = self.manifest()
                here = now["tables"][table]["folders"]
                if not set(old) <= set(here):  # another writer has replaced them
                    break
                held = {**now["tables"][table], "folders": [new.removeprefix(f"{self.root}/"), *[f for f in here if f not in old]]}
                if self._published({**now, "version": now["version"] + 1, "tables": {**now["tables"], table: held}}):
                    return True

    def swept(self) -> int:
        """Remove folders that the latest manifest doesn't name, and all but the two latest manifests; how many folders. Nothing may be in the making or being read from earlier versions."""
        for version in self._versions()[:-2]:
            self._fs.delete(self._path(f"{self.root}/_manifest/{version:012d}.json"), False)
        known = {f for t in self.manifest()["tables"].values() for f in t["folders"]}
        lost = []
        for t in self._fs.listStatus(self._path(self.root)):
            if not t.getPath().getName().startswith("_"):
                lost += [f.getPath() for f in self._fs.listStatus(t.getPath()) if f"{t.getPath().getName()}/{f.getPath().getName()}" not in known]
        for path in lost:
            self._fs.delete(path, True)
        return len(lost)
