"""Stored tables that change by slots: only the files of a changed level and id range are written anew.

A table lies in folders ``change=<name>/<slot>``, a slot being one value of the ``exact`` columns and one range of ids of
the ``ranged`` ones. ``_versions/N.json`` lists the folders of every slot that version N consists of, and the pointer
file ``_current`` holds the number readers follow. A change writes its slots to a new folder, lists them beside the
untouched ones and moves the pointer, so a reader sees the whole change or nothing of it, and files of untouched slots
stay the same files. A version number can be taken once: of two changes made side by side, the second raises.

The driver handles one entry per slot, never rows; the width of a range bounds what a slot can hold.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from ..operators.changes import KeyViolation, append_unseen, replace_slice, upsert
from ..session import remove


class ConcurrentChange(RuntimeError):
    """Another change took the version number first; nothing of this one is visible."""


class VersionedTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, exact: Sequence[str] = (), ranged: Mapping[str, int] | None = None
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.exact, self.ranged = list(exact), dict(ranged or {})
        for column in (*self.exact, *self.ranged):
            if not isinstance(schema[column].dataType, IntegralType):
                raise ValueError(f"slots are cut by whole numbers, {column} is not one")

    @property
    def slot_columns(self) -> list[str]:
        return [*self.exact, *[f"{c}_range" for c in self.ranged]]

    # ---- files ------------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _text(self, name: str) -> str:
        stream = self._system().open(self._hadoop(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, name: str, text: str) -> None:
        stream = self._system().create(self._hadoop(f"{self.path}/{name}"), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def _point(self, version: int) -> None:
        """Move the pointer in one step."""
        waiting = f"_current-{uuid.uuid4().hex}"
        self._put(waiting, str(version))
        fs, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        how = gateway.new_array(fs.Options.Rename, 1)
        how[0] = fs.Options.Rename.OVERWRITE
        context = fs.FileContext.getFileContext(self._system().getUri(), self.spark._jsc.hadoopConfiguration())
        qualified = lambda name: self._system().makeQualified(self._hadoop(f"{self.path}/{name}"))
        context.rename(qualified(waiting), qualified("_current"), how)

    # ---- versions ---------------------------------------------------------------------------------

    def version(self) -> int:
        """The version readers follow; 0 before the first."""
        return int(self._text("_current")) if self._system().exists(self._hadoop(f"{self.path}/_current")) else 0

    def slots(self, version: int | None = None) -> dict[str, list[str]]:
        """The slots of a version and the folders each of them is made of."""
        version = self.version() if version is None else version
        return json.loads(self._text(f"_versions/{version}.json")) if version else {}

    def read(self, version: int | None = None, only: Iterable[str] | None = None) -> DataFrame:
        """The table as of a version, or some of its slots."""
        listed = self.slots(version)
        wanted = listed if only is None else [s for s in only if s in listed]
        paths = [f"{self.path}/change={folder}/{slot}" for slot in wanted for folder in listed[slot]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths).select(*self.schema.names)

    def _cut(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_range": F.floor(F.col(c) / width) for c, width in self.ranged.items()})

    def slots_of(self, keys: DataFrame) -> list[str]:
        """The slots that hold the given keys."""
        rows = self._cut(keys.select(*self.exact, *self.ranged).distinct()).select(*self.slot_columns).distinct().collect()
        named = lambda value: "__HIVE_DEFAULT_PARTITION__" if value is None else value
        return sorted("/".join(f"{c}={named(row[c])}" for c in self.slot_columns) for row in rows)

    @contextmanager
    def _folder(self, base: int) -> Iterator[str]:
        """A new folder for the files of a change; removed if the change fails."""
        folder = f"{base + 1:06d}-{uuid.uuid4().hex[:12]}"
        try:
            yield folder
        except BaseException:
            remove(self.spark, f"{self.path}/change={folder}")
            raise

    def _write(self, df: DataFrame, folder: str) -> list[str]:
        path = f"{self.path}/change={folder}"
        cut = self._cut(df.select(*self.schema.names)).repartition(*self.slot_columns)
        ordered = cut.sortWithinPartitions(*self.slot_columns, *self.ranged)
        ordered.write.mode("errorifexists").option("compression", "zstd").partitionBy(*self.slot_columns).parquet(path)
        found = self._system().globStatus(self._hadoop(path + "/*=*" * len(self.slot_columns)))
        return sorted("/".join(status.getPath().toString().split("/")[-len(self.slot_columns) :]) for status in found or [])

    def _commit(self, base: int, slots: dict[str, list[str]]) -> int:
        version = base + 1
        try:
            self._put(f"_versions/{version}.json", json.dumps(slots, sort_keys=True))
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error.java_exception):
                raise
            raise ConcurrentChange(f"version {version} of {self.path} was made by another change") from error
        self._point(version)
        return version

    # ---- changes ----------------------------------------------------------------------------------

    def create(self, df: DataFrame) -> int:
        """Write the first version."""
        if self.version():
            raise ConcurrentChange(f"{self.path} exists")
        with self._folder(0) as folder:
            return self._commit(0, {slot: [folder] for slot in self._write(df, folder)})

    def append(self, new: DataFrame) -> int:
        """Add rows; nothing that is stored is read or written."""
        base = self.version()
        slots = self.slots(base)
        with self._folder(base) as folder:
            for slot in self._write(new, folder):
                slots[slot] = [*slots.get(slot, []), folder]
            return self._commit(base, slots)

    def change(self, keys: DataFrame, apply: Callable[[DataFrame], DataFrame]) -> int:
        """Write ``apply`` of the slots that hold ``keys`` in their place.

        ``apply`` gets the rows of these slots only. If it returns a row of any other slot nothing changes.
        """
        base = self.version()
        slots, touched = self.slots(base), self.slots_of(keys)
        with self._folder(base) as folder:
            written = self._write(apply(self.read(base, touched)), folder)
            strange = sorted(set(written) - set(touched))
            if strange:
                raise KeyViolation(f"rows outside of the changed slots: {', '.join(strange[:5])}")
            kept = {slot: folders for slot, folders in slots.items() if slot not in set(touched)}
            return self._commit(base, kept | {slot: [folder] for slot in written})

    def _keys(self, *frames: DataFrame) -> DataFrame:
        picked = [f.select(*self.exact, *self.ranged) for f in frames]
        keys = picked[0]
        for other in picked[1:]:
            keys = keys.unionByName(other)
        return keys

    def replace_slice(self, slice_keys: DataFrame, new: DataFrame, key: Sequence[str]) -> int:
        """Remove every row at the listed keys, then add the new rows."""
        return self.change(self._keys(slice_keys, new), lambda old: replace_slice(old, slice_keys, new, key))

    def upsert(self, updates: DataFrame, key: Sequence[str]) -> int:
        return self.change(self._keys(updates), lambda old: upsert(old, updates, key))

    def append_unseen(self, new: DataFrame, key: Sequence[str]) -> int:
        """Add the new rows whose key is not stored yet."""
        return self.change(self._keys(new), lambda old: append_unseen(old, new, key))
