"""What tasks have been answered so far: a file for each batch, so that nothing is asked for twice."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.places import file_system

_BREAKER = "_breaker"


@dataclass(frozen=True)
class Journal:
    """A folder that the driver and all executors share. Files appear whole, under names that say what they answer."""

    folder: str

    def _at(self, name: str):
        fs, root = file_system(self.folder)
        part = hashlib.sha256(name.encode()).hexdigest()[:2]  # so that no folder lists all files
        return fs, f"{root}/{part}", f"{root}/{part}/{name}.json"

    def get(self, name: str) -> list[dict] | None:
        """The rows put under a name, if any were."""
        fs, _, path = self._at(name)
        if not fs.get_file_info(path).is_file:
            return None
        with fs.open_input_stream(path) as f:
            return [json.loads(line) for line in f.read().decode().splitlines()]

    def put(self, name: str, rows: list[dict]) -> None:
        fs, folder, path = self._at(name)
        fs.create_dir(folder, recursive=True)
        staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(staged) as f:
            f.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode())
        fs.move(staged, path)

    def trip(self, error: str) -> None:
        """Tell all tasks that what they ask can't be reached. The file's name keeps it out of table()."""
        self.put(_BREAKER, [{"error": error}])

    def tripped(self) -> str | None:
        """Why no task is to ask any more, if that is so."""
        found = self.get(_BREAKER)
        return found[0]["error"] if found else None

    def mend(self) -> None:
        """Tasks may ask again."""
        fs, _, path = self._at(_BREAKER)
        if fs.get_file_info(path).is_file:
            fs.delete_file(path)

    def table(self, spark: SparkSession, schema: str) -> DataFrame:
        """All rows so far."""
        from pyarrow.fs import FileSelector

        fs, root = file_system(self.folder)
        names = (f.base_name for f in fs.get_file_info(FileSelector(root, allow_not_found=True, recursive=True)))
        if not any(n.endswith(".json") and n[0] not in "._" for n in names):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", True).json(self.folder)

    def clear(self) -> None:
        fs, root = file_system(self.folder)
        if fs.get_file_info(root).type.name == "Directory":
            fs.delete_dir(root)
