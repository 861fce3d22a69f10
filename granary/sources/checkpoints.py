"""One JSON checkpoint a table, in any file system that Hadoop writes.

A checkpoint is a file of its own number in the table's folder. A new one is
written under another name and then renamed to the next number, which nothing
holds, so at every moment the highest number is a whole checkpoint: a crash
leaves the old or the new one. Older ones are deleted afterwards.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from granary.sources.csv import Identity, _fs, joined


class CheckpointError(ValueError):
    pass


@dataclass(frozen=True)
class Checkpoint:
    table: str
    source: Identity
    watermark: str | None
    run_id: str
    committed_at: str


class CheckpointStore:
    """Reads and replaces checkpoints; a replacement appears whole or not at all."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _folder(self, table: str) -> str:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", table):
            raise CheckpointError(f"bad table name: {table!r}")
        return joined(self.root, table)

    def _numbers(self, table: str) -> list[int]:
        """Numbers of the table's checkpoints, highest first."""
        fs, p = _fs(self.spark, self._folder(table))
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted((int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n))), reverse=True)

    def _path(self, table: str, number: int) -> str:
        return joined(self._folder(table), f"{number:012d}.json")

    def load(self, table: str) -> Checkpoint | None:
        if not (numbers := self._numbers(table)):
            return None
        fs, p = _fs(self.spark, self._path(table, numbers[0]))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream := fs.open(p), "UTF-8")
        stream.close()
        try:
            found = json.loads(text)
            found = Checkpoint(**found | {"source": Identity(**found["source"])})
        except (ValueError, TypeError, KeyError) as e:
            raise CheckpointError(f"the checkpoint of {table} can't be read: {e}") from e
        if found.table != table:
            raise CheckpointError(f"the checkpoint of {table} is one of {found.table}")
        return found

    def save(self, checkpoint: Checkpoint) -> None:
        old = self._numbers(checkpoint.table)
        fs, p = _fs(self.spark, self._path(checkpoint.table, old[0] + 1 if old else 1))
        _, staged = _fs(self.spark, joined(self._folder(checkpoint.table), f"{checkpoint.run_id}.tmp"))
        out = fs.create(staged, True)
        out.write(bytearray(json.dumps(asdict(checkpoint), sort_keys=True).encode()))
        out.close()
        self._place(fs, staged, p, checkpoint.table)
        for number in old:
            fs.delete(_fs(self.spark, self._path(checkpoint.table, number))[1], False)

    def _place(self, fs, staged, target, table: str) -> None:
        if fs.exists(target) or not fs.rename(staged, target):
            raise CheckpointError(f"the checkpoint of {table} couldn't be put in place")
