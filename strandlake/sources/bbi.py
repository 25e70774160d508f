"""Indexed binary tracks, bigWig and bigBed, as Spark data sources that read only the blocks a query needs.

A file's index is a tree over its data blocks by contig and range. The driver reads its upper nodes, as many as there
shall be partitions, and leaves out those that the pushed filters rule out; a task goes down its nodes and reads and
inflates only the blocks that may hold rows. Files are opened through pyarrow's file systems, in the tasks too.

    track(spark, path, chroms=["chr2"], low=1000, high=5000)

Contigs and a range are given as options, or, with the option push, as filters that Spark pushes, which needs
spark.sql.python.filterPushdown.enabled. Spark 4.1 keeps pushed filters with the relation: a DataFrame that was read once
with a filter and then without any one gives the filtered rows again. So track() uses options, and whoever sets push
loads anew for each query.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

# fixed values of the formats
BIGWIG, BIGBED, CONTIGS, INDEX = 0x888FFC26, 0x8789F2EB, 0x78CA8C91, 0x2468ACE0
BEDGRAPH, VARIABLE, FIXED = 1, 2, 3

#: Partitions of a file that the driver aims at.
PARTITIONS = 64
#: No end.
FAR = 1 << 62


@dataclass
class Wanted:
    """What rows must fulfil: contigs (None: any), a first base and an end that they must reach into."""

    chroms: frozenset[str] | None = None
    low: int = 0
    high: int = FAR

    def narrowed(self, filters: list[Filter]) -> Wanted:
        chroms, low, high = self.chroms, self.low, self.high
        for f in filters:
            name = getattr(f, "attribute", ("",))[-1]
            if name == "chrom" and isinstance(f, (EqualTo, In)):
                own = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                chroms = own if chroms is None else chroms & own
            elif name in ("start", "end") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                # a row that starts at or after x, or ends after x, reaches past x; one that starts before x, or ends at or before it, begins below x
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    low = max(low, f.value - (name == "end" and not isinstance(f, GreaterThan)))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    high = min(high, f.value + (name == "start" and not isinstance(f, LessThan)))
        return Wanted(chroms, low, high)


class Track:
    """An open file: its contigs by number, and its blocks."""

    def __init__(self, path: str) -> None:
        system, name = fs.FileSystem.from_uri(path)
        self.file, self.blocks_read = system.open_input_file(name), 0
        head = self._bytes(0, 64)
        self.order = next((o for o in "<>" if struct.unpack(o + "I", head[:4])[0] in (BIGWIG, BIGBED)), None)
        if self.order is None:
            raise ValueError(f"{path} is neither a bigWig nor a bigBed file")
        self.scored = struct.unpack(self.order + "I", head[:4])[0] == BIGWIG
        contigs, _, self.index, *_ = struct.unpack(self.order + "QQQHHQQIQ", head[8:64])
        self.packed = struct.unpack(self.order + "I", head[52:56])[0] > 0
        self.names, self.sizes = self._contigs(contigs)
        if struct.unpack(self.order + "I", self._bytes(self.index, 4))[0] != INDEX:
            raise ValueError(f"{path} has no index where its head says so")

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        found = self.file.read(size)
        if len(found) != size:
            raise ValueError("a track file ends too early")
        return found

    def _node(self, at: int) -> tuple[bool, int]:
        leaf, _, count = struct.unpack(self.order + "BBH", self._bytes(at, 4))
        return bool(leaf), count

    def _contigs(self, at: int) -> tuple[dict[int, str], dict[int, int]]:
        magic, _, width, _, _, _ = struct.unpack(self.order + "IIIIQQ", self._bytes(at, 32))
        if magic != CONTIGS:
            raise ValueError("a track file without contigs")
        names, sizes, waiting = {}, {}, [at + 32]
        while waiting:
            node = waiting.pop()
            leaf, count = self._node(node)
            data = self._bytes(node + 4, count * (width + 8))
            for k in range(count):
                key, rest = data[k * (width + 8) :][:width], data[k * (width + 8) + width :][:8]
                if leaf:
                    number, size = struct.unpack(self.order + "II", rest)
                    names[number], sizes[number] = key.rstrip(b"\0").decode(), size
                else:
                    waiting.append(struct.unpack(self.order + "Q", rest)[0])
        return names, sizes

    def _numbers(self, wanted: Wanted) -> list[int]:
        return sorted(k for k, n in self.names.items() if wanted.chroms is None or n in wanted.chroms)

    def _children(self, node: int, wanted: Wanted, numbers: list[int]) -> tuple[bool, list[tuple[int, int]]]:
        """Whether a node of the index is a leaf, and place and size (0 for nodes) of its children that wanted rows may be in."""
        leaf, count = self._node(node)
        width = 32 if leaf else 24
        data = self._bytes(node + 4, count * width)
        found = []
        for k in range(count):
            c0, b0, c1, b1, at, *size = struct.unpack(self.order + ("IIIIQQ" if leaf else "IIIIQ"), data[k * width : (k + 1) * width])
            if any(c0 <= n <= c1 and (n > c0 or b0 < wanted.high) and (n < c1 or b1 > wanted.low) for n in numbers):
                found.append((at, size[0] if size else 0))
        return leaf, found

    def nodes(self, wanted: Wanted, most: int) -> list[int]:
        """Nodes of the index that hold all wanted blocks: of the first level that has `most` of them, or of the leaves."""
        numbers, level = self._numbers(wanted), [self.index + 48]
        while level and len(level) < most:
            below = [self._children(n, wanted, numbers) for n in level]
            if any(leaf for leaf, _ in below):
                return [n for n, (_, found) in zip(level, below, strict=True) if found]
            level = [at for _, found in below for at, _ in found]
        return level

    def blocks(self, node: int, wanted: Wanted) -> Iterator[tuple[int, int]]:
        """Place and size of the wanted blocks below a node, in their order."""
        numbers, waiting = self._numbers(wanted), [node]
        while waiting:
            leaf, found = self._children(waiting.pop(), wanted, numbers)
            if leaf:
                yield from found
            else:
                waiting += [at for at, _ in reversed(found)]

    def block(self, at: int, size: int) -> bytes:
        self.blocks_read += 1
        data = self._bytes(at, size)
        return zlib.decompress(data) if self.packed else data

    def scores(self, data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Contig, starts, ends and scores of a bigWig block; what is no number counts as 0, ends are cut to the contig."""
        number, start, _, step, span, kind, _, count = struct.unpack(self.order + "IIIIIBBH", data[:24])
        o = self.order
        if kind == BEDGRAPH:
            items = np.frombuffer(data, [("s", o + "u4"), ("e", o + "u4"), ("v", o + "f4")], count, 24)
            starts, ends, values = items["s"].astype(np.int64), items["e"].astype(np.int64), items["v"]
        elif kind == VARIABLE:
            items = np.frombuffer(data, [("s", o + "u4"), ("v", o + "f4")], count, 24)
            starts, values = items["s"].astype(np.int64), items["v"]
            ends = starts + span
        elif kind == FIXED:
            values = np.frombuffer(data, o + "f4", count, 24)
            starts = start + np.arange(count, dtype=np.int64) * step
            ends = starts + span
        else:
            raise ValueError("a block of an unknown kind")
        return number, starts, np.minimum(ends, self.sizes[number]), np.nan_to_num(values.astype(np.float32), nan=0.0)

    def entries(self, data: bytes) -> Iterator[tuple[int, int, int, str]]:
        """Contig, start, end and what follows of each row of a bigBed block."""
        at = 0
        while at < len(data):
            number, start, end = struct.unpack(self.order + "III", data[at : at + 12])
            stop = data.index(b"\0", at + 12)
            yield number, start, min(end, self.sizes[number]), data[at + 12 : stop].decode()
            at = stop + 1


@dataclass
class Nodes(InputPartition):
    path: str
    nodes: list[int]


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], wanted: Wanted, partitions: int, scored: bool) -> None:
        self.paths, self.wanted, self.most, self.scored = paths, wanted, partitions, scored

    def partitions(self) -> list[Nodes]:
        out = []
        for path in self.paths:
            nodes = Track(path).nodes(self.wanted, self.most)
            step = -(-len(nodes) // self.most) if nodes else 1
            out += [Nodes(path, nodes[k : k + step]) for k in range(0, len(nodes), step)]
        return out or [Nodes("", [])]

    def read(self, partition: Nodes) -> Iterator[pa.RecordBatch]:
        if partition.nodes:
            track = Track(partition.path)
            if track.scored != self.scored:
                raise ValueError(f"{partition.path} is a file of the other kind")
            yield from rows(track, partition.nodes, self.wanted)


class _Pushed(_Reader):
    """A reader that takes Spark's filters; Spark refuses it where its setting is off."""

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        self.wanted = self.wanted.narrowed(filters)
        return filters  # blocks hold other rows too, so that Spark looks at each


def rows(track: Track, nodes: list[int], wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """The rows of the wanted blocks below these nodes: chrom, start, end, and score or rest."""
    for node in nodes:
        for at, size in track.blocks(node, wanted):
            data = track.block(at, size)
            if track.scored:
                number, starts, ends, values = track.scores(data)
                keep = starts < ends
                n = int(keep.sum())
                yield pa.RecordBatch.from_arrays([pa.array([track.names[number]] * n, pa.string()), pa.array(starts[keep]), pa.array(ends[keep]), pa.array(values[keep])], names=["chrom", "start", "end", "score"])
            else:
                found = list(track.entries(data))
                yield pa.RecordBatch.from_arrays([pa.array([track.names[r[0]] for r in found], pa.string()), *(pa.array([r[k] for r in found], pa.int64()) for k in (1, 2)), pa.array([r[3] for r in found], pa.string())], names=["chrom", "start", "end", "rest"])


class BigWig(DataSource):
    """Runs of a score track: chrom, start, end, score. Options: path (several separated by commas), chroms (by tabs), low, high, partitions, push."""

    scored = True

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return "chrom string, start long, end long, score float"

    def reader(self, schema) -> _Reader:
        o = self.options
        wanted = Wanted(frozenset(o["chroms"].split("\t")) if "chroms" in o else None, int(o.get("low", 0)), int(o.get("high", FAR)))
        kind = _Pushed if o.get("push", "false") == "true" else _Reader
        return kind(o["path"].split(","), wanted, int(o.get("partitions", PARTITIONS)), self.scored)


class BigBed(BigWig):
    """Rows of an indexed BED: chrom, start, end, rest (what follows, by tabs)."""

    scored = False

    @classmethod
    def name(cls) -> str:
        return "bigbed"

    def schema(self) -> str:
        return "chrom string, start long, end long, rest string"


def track(spark: SparkSession, path: str, kind: type[BigWig] = BigWig, chroms: list[str] | None = None, low: int = 0, high: int | None = None) -> DataFrame:
    """The rows of a binary track: of these contigs, or all, and of those only what reaches into [low, high). Only blocks with such rows are read."""
    spark.dataSource.register(kind)
    reader = spark.read.format(kind.name()).option("low", low)
    reader = reader if chroms is None else reader.option("chroms", "\t".join(chroms))
    found = (reader if high is None else reader.option("high", high)).load(path).where(F.col("end") > low)
    found = found if chroms is None else found.where(F.col("chrom").isin(chroms))
    return found if high is None else found.where(F.col("start") < high)
