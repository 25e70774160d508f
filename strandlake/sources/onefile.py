"""A writer of one ordered text file: tasks write its parts, and the commit joins them in their order.

Lines are dealt to partitions by range and sorted there, so that no task sorts all. Each task writes one part beside the
file; when all are done the driver copies them one behind the other, a piece at a time, and gives the file its name. So
readers see all of it or nothing. Compressed files are gzip members one behind the other, each of the lines of one
block; as a block is told by columns of the lines, not by partitions, the bytes are the same for any number of these.

Lines that already lie in the order of what they were read from need not be dealt: in_place() writes a part for each
stretch of them, and the commit orders these.

The path must be one that executors and driver share.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Bytes that the commit copies at a time.
PIECE = 1 << 22


@dataclass
class Parts(WriterCommitMessage):
    """What a task has written: an order and a path of each part."""

    found: list[tuple[tuple, str]]


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.packed, self.overwrite, self.placed = options["path"], options.get("compression", "none") == "gzip", overwrite, options.get("placed") == "true"
        self.folder = f"{self.path}.parts-{uuid.uuid4().hex[:12]}"
        system, name = _system(self.path)
        if not overwrite and system.get_file_info(name).type != fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        task = TaskContext.get()
        system, folder = _system(self.folder)
        system.create_dir(folder)
        parts, out, held, block, stretch = [], None, [], None, None
        for batch in batches:
            values, blocks = batch.column("value").to_pylist(), batch.column("block").to_pylist()
            stretches = batch.column("stretch").to_pylist() if self.placed else [None] * len(values)
            at = 0
            for k in [k for k in range(len(values)) if k == 0 or blocks[k] != blocks[k - 1] or stretches[k] != stretches[k - 1]]:
                if out is None or stretches[k] != stretch or (self.packed and blocks[k] != block):
                    self._put(out, held + values[at:k])
                    held, at, block = [], k, blocks[k]
                if out is None or stretches[k] != stretch:
                    if out:
                        out.close()
                    stretch, path = stretches[k], f"{folder}/{task.partitionId()}-{task.taskAttemptId()}-{len(parts)}"
                    parts.append(((stretch["path"], stretch["part"]) if self.placed else (task.partitionId(),), path))
                    out = system.open_output_stream(path, compression=None)
            if self.packed:
                held += values[at:]
            else:
                self._put(out, held + values[at:])
                held = []
        self._put(out, held)
        if out:
            out.close()
        return Parts(parts)

    def _put(self, out, lines: list[str]) -> None:
        if lines:
            data = ("\n".join(lines) + "\n").encode()
            out.write(gzip.compress(data, mtime=0) if self.packed else data)

    def commit(self, messages: list[Parts | None]) -> None:
        system, name = _system(self.path)
        whole = f"{_system(self.folder)[1]}/whole"
        system.create_dir(_system(self.folder)[1])
        with system.open_output_stream(whole, compression=None) as out:
            for _, part in sorted(p for m in messages if m is not None for p in m.found):
                with system.open_input_stream(part, compression=None) as data:
                    while piece := data.read(PIECE):
                        out.write(piece)
        if self.overwrite and system.get_file_info(name).type == fs.FileType.Directory:
            system.delete_dir(name)
        system.move(whole, name)
        self._cleared()

    def abort(self, messages: list[Parts | None]) -> None:
        self._cleared()

    def _cleared(self) -> None:
        system, name = _system(self.folder)
        if system.get_file_info(name).type != fs.FileType.NotFound:
            system.delete_dir(name)


class OneFile(DataSource):
    """Lines (value, and block where compressed) to one file. Options: path, compression (none or gzip)."""

    @classmethod
    def name(cls) -> str:
        return "onefile"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def written(lines: DataFrame, path: str, blocks: list[str], within: list[str], compression: str | None = None, force: bool = False, partitions: int | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """`value` of the lines to one file, in the order of `blocks`, then `within`; blocks are what a gzip member holds.

    watch: what is to be done with the lines where they are dealt and sorted, as observing them, so that they are seen once.

    A block should have some ten thousand lines: it is what a task holds of a compressed file.
    """
    lines.sparkSession.dataSource.register(OneFile)
    dealt = lines.repartitionByRange(partitions, *blocks) if partitions else lines.repartitionByRange(*blocks)
    ordered = dealt.sortWithinPartitions(*blocks, *within)
    rows = (watch(ordered) if watch else ordered).select(F.to_json(F.struct(*blocks)).alias("block"), "value")
    rows.write.format("onefile").option("compression", compression or "none").mode("overwrite" if force else "append").save(path)


def in_place(lines: DataFrame, path: str, compression: str | None = None, force: bool = False) -> None:
    """`value` of lines that lie as they were read, to one file, in the order of their stretches (path, part) and in each as they come.

    block: what a gzip member holds, of one stretch. Nothing is shuffled or sorted but the names of parts.
    """
    lines.sparkSession.dataSource.register(OneFile)
    rows = lines.select(F.col("block").cast("string").alias("block"), F.struct("path", "part").alias("stretch"), "value")
    rows.write.format("onefile").option("compression", compression or "none").option("placed", "true").mode("overwrite" if force else "append").save(path)
