"""Tables of snapshots: a version is visible when its manifest is, and not before.

Rows are written to a folder of their own first. The manifest, a small file that names the folders of a version,
is put in place last, by one rename that fails if another load has taken that version. So readers see the old
version or the new one, a load that fails leaves the old one, and a version once read stays readable until it is expired.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from starledger.session import discard


class PublishConflict(RuntimeError):
    """Another load published the version that this one wanted to."""


@dataclass
class Manifest:
    """Folders that hold the rows of a version, the batches in it, and the schema."""

    version: int
    parts: list[str]
    batches: list[str]
    schema: dict


class Published:
    """The table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        folder = self._at("_manifests")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """That of a version, by default the last one; None if nothing was published."""
        found = self.versions()
        if not found:
            return None
        if version is not None and version not in found:
            raise ValueError(f"{self.path} has no version {version}")
        stream = self._files.open(self._at(f"_manifests/{found[-1] if version is None else version:08d}.json"))
        try:
            io = self._spark.sparkContext._jvm.java.io
            return Manifest(**json.loads(io.BufferedReader(io.InputStreamReader(stream, "UTF-8")).readLine()))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        held = self.manifest(version)
        if held is None:
            raise ValueError(f"nothing was published at {self.path}")
        schema = T.StructType.fromJson(held.schema)
        if not held.parts:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in held.parts])

    def publish(self, df: DataFrame, condition: str = "replace", batch: str | None = None) -> DataFrame:
        """Publish the rows as the next version, alone or behind those of the last one, and read it back.

        ``batch`` names the rows: a batch that the table holds already is not appended again. Appended rows must have the
        columns of the table; they may come in another order.
        """
        if condition not in ("replace", "append"):
            raise ValueError(f"unknown load condition: {condition}")
        last = self.manifest()
        version = last.version + 1 if last else 1
        behind = last if condition == "append" else None
        if behind and batch is not None and batch in behind.batches:
            return self.read(last.version)
        if behind:
            df = _aligned(df, T.StructType.fromJson(behind.schema))
        part = f"data/{uuid.uuid4().hex}"
        try:
            df.write.parquet(f"{self.path}/{part}")
            self._put(Manifest(
                version, [*(behind.parts if behind else []), part],
                [*(behind.batches if behind else []), *([] if batch is None else [batch])], df.schema.jsonValue(),
            ))
        except Exception:
            discard(self._spark, f"{self.path}/{part}")
            raise
        return self.read(version)

    def _put(self, manifest: Manifest) -> None:
        staged = self._at(f"_manifests/.{uuid.uuid4().hex}")
        self._files.mkdirs(staged.getParent())
        out = self._files.create(staged, False)
        try:
            out.writeBytes(json.dumps(asdict(manifest)) + "\n")
        finally:
            out.close()
        final = self._at(f"_manifests/{manifest.version:08d}.json")
        if self._files.exists(final) or not self._files.rename(staged, final):
            self._files.delete(staged, False)
            raise PublishConflict(f"{self.path} has a version {manifest.version} already")

    def expire(self, keep: int = 2) -> None:
        """Forget all but the last ``keep`` versions, and delete the folders that no version left names."""
        found = self.versions()
        gone, left = found[:-keep], found[-keep:]
        named = {p for v in left for p in self.manifest(v).parts}
        dropped = {p for v in gone for p in self.manifest(v).parts} - named
        for version in gone:
            self._files.delete(self._at(f"_manifests/{version:08d}.json"), False)
        for part in dropped:
            discard(self._spark, f"{self.path}/{part}")


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with its columns in the order of ``schema``; other names or types are an error."""
    given, wanted = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    if given != wanted:
        raise ValueError(f"columns {df.schema.simpleString()} do not fit the table's {schema.simpleString()}")
    return df.select(*[f"`{name}`" for name in schema.names])
