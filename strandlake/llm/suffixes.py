"""Suffix-array dedup: bytes of repeated strings of a given length go, but for the first occurrence.

Windows of `length` bytes are sent to where equal ones meet without sending each: the k-gram of least hash in a
window, its anchor, depends on the window only, so equal windows have equal anchors, and the consecutive windows of
one anchor are one cell, a stretch of text known by its hash. Cells of equal content collapse at once: all but the
first are repeated as a whole. Only cells that share an anchor but differ need their bytes; one text of each is
sorted with the others of its anchor in a suffix array. An anchor with more cells than an array holds is dealt out
again by longer grams: their windows have anchors of twice the bytes, and so on; equal windows stay together, and a
gram as long as a window leaves nothing that differs.

A suffix array is built by two-stage sorting: the suffixes smaller than their successors are sorted directly, to the
depth that matters; the others are induced by one scan over the buckets of first bytes; then adjacent common
prefixes tell the classes of equal windows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import written

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: In a window the k-gram with the least upper half of its hash is the anchor, the first one of equals; the lower half has its place.
_PLACE = _U((1 << 32) - 1)
#: Bytes of text hashed at once, and of text in one suffix array.
CHUNK, ARRAY_BYTES = 2_000_000, 4_000_000
#: A null doc_id counts as this one, the least.
NO_ID = -(1 << 63)


def _random_bytes() -> np.ndarray:
    """A 64-bit number for each byte value, by the splitmix64 rule."""
    z = (np.arange(1, 257, dtype=_U)) * _U(_BASE)
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


_BYTES = _random_bytes()
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            powers = np.full(n, _U(base))
            powers[0] = 1
            _POWERS[k] = np.cumprod(powers)
    return _POWERS


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def grams(length: int) -> list[int]:
    """Bytes of an anchor at each level, up to a whole window."""
    out = [max(1, min(16, length // 4))]
    while out[-1] < length:
        out.append(min(length, 2 * out[-1]))
    return out


def cut_cells(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, start, bytes, anchor, hash) of each cell of some texts, by anchors of k bytes. No cell holds windows of two texts."""
    w = length - k + 1
    sizes = np.array([len(t) for t in texts])
    t = np.frombuffer(b"".join(texts), np.uint8)
    n = len(t)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return tuple(np.zeros(0, d) for d in (np.int64, np.int64, np.int64, np.int64, np.int64))
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_BYTES[t] * power[:n], out=sums[1:])
    grams = _mix((sums[k:] - sums[:-k]) * inverse[: n - k + 1])
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=_U)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if w > span:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    which = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[which]
    anchors = (least[at] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (which[1:] != which[:-1]))))
    last = np.concatenate((first[1:], [total])) - 1
    start, size = at[first], at[last] - at[first] + length
    place = anchors[first]
    content = _mix((sums[start + size] - sums[start]) * inverse[start] + (place - start).astype(_U) * _U(0xD6E8FEB86659FD93) + size.astype(_U))
    return which[first], start - offsets[which[first]], size, grams[place].view(np.int64), content.view(np.int64)


_CELL = pa.schema([("anchor", pa.int64()), ("cell", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])
_CELL_DDL = "anchor long, cell long, doc long, at long"
#: In place of a cell's hash: the row is repeated as a whole, by what was seen where it was read.
SEEN = 0
#: The longest strings whose cells' sizes fit 16 bits of `at`, next to 15 bits of a text's hash and 32 of its start.
MOST_LENGTH = 30_000


def _tag(text: bytes) -> int:
    return zlib.crc32(text) & 0x7FFF


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in columns], schema=_CELL)


def _cells(length: int, k: int, pieces: bool = False):
    """A function of batches from rows of doc and text, or of doc, place (tag and start) and piece, to cells.

    Texts longer than CHUNK are cut into stretches that overlap by less than a window, so that each window is in one.
    """

    def some(held: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        ids, places, texts = zip(*held, strict=True)
        which, start, size, anchor, cell = cut_cells(list(texts), length, k)
        if not len(which):
            return
        doc = np.array(ids, np.int64)[which]
        at = ((np.array(places, np.int64)[which] + start) << 16) + size
        cell[cell == SEEN] = 1
        order = np.lexsort((at, doc, cell, anchor))
        doc, at, anchor, cell = doc[order], at[order], anchor[order], cell[order]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])))
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = ~new & ((doc != doc[first]) | (at != at[first]))  # later than an equal one here: need not be compared again
        kept = new | again
        yield _rows(np.where(again, doc * -7046029254386353131, anchor)[kept], np.where(again, SEEN, cell)[kept], doc[kept], at[kept])

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
        if pieces:
            yield from zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            return
        for row in range(len(batch)):  # one text at a time, as texts may be long
            raw = batch.column(1)[row].as_py().encode("utf-8", "surrogatepass")
            place = _tag(raw) << 32
            for start in range(0, max(1, len(raw) - length + 1), CHUNK):
                yield batch.column(0)[row].as_py(), place + start, raw[start : start + CHUNK + length - 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in rows(batch):
                if held and size + len(row[2]) > CHUNK:
                    yield from some(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
            if held:
                yield from some(held)

    return run


_COMPARED = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted cells to those that repeat another as a whole (anchor null), and the firsts of the different cells of an anchor.

    A cell alone under its anchor doesn't come. What is kept from batch to batch is one row.
    """

    def found(anchor, doc, at) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()) if anchor is None else pa.array(anchor), pa.array(doc), pa.array(at)], schema=_COMPARED)

    state = None  # anchor, cell, doc and at of the first of this cell, whether the anchor has several, the waiting row
    for batch in batches:
        anchor, cell, doc, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        seen = cell == SEEN
        if seen.any():
            yield found(None, doc[seen], at[seen])
            anchor, cell, doc, at = (x[~seen] for x in (anchor, cell, doc, at))
        if not len(doc):
            continue
        lead = state[:4] if state else (None,) * 4
        same_anchor = np.concatenate(([anchor[0] == lead[0]], anchor[1:] == anchor[:-1])).astype(bool)
        same = same_anchor & np.concatenate(([cell[0] == lead[1]], cell[1:] == cell[:-1])).astype(bool)
        first = np.maximum.accumulate(np.where(~same, np.arange(len(doc)), -1))
        first_doc = np.where(first >= 0, doc[first], lead[2] if state else 0)
        first_at = np.where(first >= 0, at[first], lead[3] if state else 0)
        again = same & ((doc != first_doc) | (at != first_at))
        if again.any():
            yield found(None, doc[again], at[again])
        new = np.flatnonzero(~same)
        several, waiting = (state[4], state[5]) if state else (False, None)
        if len(new):
            group = np.concatenate(([0], np.cumsum(~same_anchor[new[1:]])))
            goes_on = bool(same_anchor[new[0]])  # another cell of the anchor that the last batch ended with
            many = np.bincount(group) >= 2
            many[0] |= goes_on
            if goes_on and not several and waiting is not None:
                yield found(*(np.array([x]) for x in waiting))
            k = new[many[group]]
            if len(k):
                yield found(anchor[k], doc[k], at[k])
            j = new[-1]
            several = bool(many[-1])
            waiting = None if several else (anchor[j], doc[j], at[j])
        state = (anchor[-1], cell[-1], first_doc[-1], first_at[-1], several, waiting)


def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    a = np.concatenate((t, np.zeros(8, np.uint8))).astype(_U)
    for k in (1, 2, 4):
        a = (a[:-k] << _U(8 * k)) | a[k:]
    return a[: len(t)]


def suffix_array(t: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Places of t sorted by the suffixes from there on; suffixes equal to the depth may stand in any order."""
    n = len(t)
    words = _words(t) if words is None else words
    step = np.sign(np.concatenate((t[1:].astype(np.int16), [-1])) - t.astype(np.int16))
    nearest = np.minimum.accumulate(np.where(step != 0, np.arange(n), n)[::-1])[::-1]
    smaller = step[np.minimum(nearest, n - 1)] > 0  # than its successor
    # first stage: sort these by eight bytes more in each round, while there are ties
    order = np.flatnonzero(smaller)
    group = np.zeros(len(order), np.int64)
    tied = np.ones(len(order), bool)
    for d in range(0, depth, 8):
        if not tied.any():
            break
        at = np.flatnonzero(tied)
        places = order[at]
        key = np.where(places + d < n, words[np.minimum(places + d, n - 1)], _U(0))
        by = np.lexsort((key, group[at]))
        order[at], key, old = places[by], key[by], group[at][by]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])))
        group[at] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        edge = np.concatenate((new, [True]))
        tied[at] = ~(edge[:-1] & edge[1:])
    # second stage: buckets of first bytes from the least on; of one bucket the induced suffixes stand first
    rank = np.full(n + 1, -1, np.int64)
    sa = np.empty(n, np.int64)
    rest = np.flatnonzero(~smaller)
    rest = rest[np.argsort(t[rest], kind="stable")]
    ends = np.cumsum(np.bincount(t[rest], minlength=256))
    small_ends = np.cumsum(np.bincount(t[order], minlength=256))
    following = np.concatenate((t[1:].astype(np.int16), [-1]))
    filled = 0
    for c in range(256):
        mine = rest[ends[c - 1] if c else 0 : ends[c]]
        front = mine[following[mine] < c]
        front = front[np.argsort(rank[front + 1], kind="stable")]
        while len(front):
            sa[filled : filled + len(front)] = front
            rank[front] = np.arange(filled, filled + len(front))
            filled += len(front)
            front = front[front > 0] - 1
            front = front[t[front] == c]
        direct = order[small_ends[c - 1] if c else 0 : small_ends[c]]
        sa[filled : filled + len(direct)] = direct
        rank[direct] = np.arange(filled, filled + len(direct))
        filled += len(direct)
    return sa


def repeated_windows(pieces: list[bytes], doc: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the windows that also start at an earlier (doc, place) in these pieces."""
    sizes = np.array([len(p) for p in pieces])
    t = np.frombuffer(b"".join(pieces), np.uint8)
    words = _words(t)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    offset = np.arange(len(t)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sa = suffix_array(t, length, words)
    sa = sa[offset[sa] <= sizes[owner[sa]] - length]
    if len(sa) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    equal = np.ones(len(sa) - 1, bool)  # adjacent suffixes have a common prefix of `length` bytes
    steps = [*range(0, length - 7, 8), length - 8] if length >= 8 else []
    for d in steps:
        equal &= words[sa[1:] + d] == words[sa[:-1] + d]
    if length < 8:
        shift = _U(64 - 8 * length)
        equal &= (words[sa[1:]] >> shift) == (words[sa[:-1]] >> shift)
    label = np.concatenate(([0], np.cumsum(~equal)))
    docs, places = doc[owner[sa]], at[owner[sa]] + offset[sa]
    order = np.lexsort((places, docs, label))
    sa, label, docs, places = sa[order], label[order], docs[order], places[order]
    new = np.concatenate(([True], label[1:] != label[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    late = (docs != docs[first]) | (places != places[first])
    return owner[sa[late]], offset[sa[late]]


_SPAN = pa.schema([("doc", pa.int64()), ("place", pa.int64()), ("size", pa.int32())])


def _solve(length: int):
    """Rows of anchor, doc, place, bytes, sorted by anchor, to spans (doc, place, size) of repeated windows in a row."""

    def solve(pieces: list[bytes], docs: list[int], ats: list[int]) -> Iterator[pa.RecordBatch]:
        doc, at = np.array(docs, np.int64), np.array(ats, np.int64)
        owner, offset = repeated_windows(pieces, doc, at, length)
        if not len(owner):
            return
        order = np.lexsort((offset, owner))
        owner, offset = owner[order], offset[order]
        first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))))
        last = np.concatenate((first[1:], [len(owner)])) - 1
        yield pa.RecordBatch.from_arrays([pa.array(doc[owner[first]]), pa.array(at[owner[first]] + offset[first]), pa.array((offset[last] - offset[first] + length).astype(np.int32))], schema=_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, docs, ats, held, current = [], [], [], 0, None
        for batch in batches:
            for anchor, doc, at, piece in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if anchor != current and held >= ARRAY_BYTES:
                    yield from solve(pieces, docs, ats)
                    pieces, docs, ats, held = [], [], [], 0
                current = anchor
                pieces.append(piece)
                docs.append(doc)
                ats.append(at)
                held += len(piece)
        if pieces:
            yield from solve(pieces, docs, ats)

    return run


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc (never null), tag, text (never null)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.crc32(t.cast("binary")).bitwiseAND(F.lit(0x7FFF)).alias("tag"), t.alias("text"))


def repeats(docs: DataFrame, length: int = 100, crowd: int = 20_000) -> DataFrame:
    """doc, tag, spans: the byte ranges [start, end) of each document that repeat an earlier string of `length` bytes.

    Documents without any don't come. Strings are told equal by 64-bit hashes of anchor and cell (together 128 bits)
    and by their bytes. An anchor with more than `crowd` different cells is dealt out again by longer grams.
    """
    if not 0 < length <= MOST_LENGTH:
        raise ValueError(f"a length from 1 to {MOST_LENGTH}")
    texts = _keyed(docs)
    rows = texts.where(F.octet_length("text") >= length).select("doc", "text")
    place, size = F.expr("at >> 16").alias("place"), F.expr("cast(at & 65535 AS int)").alias("size")  # a place is a tag and a start
    tag, start = F.expr("place >> 32").alias("tag"), F.expr("cast(place & 4294967295L AS int)")
    spans = []
    for level, k in enumerate(grams(length)):
        cells = rows.mapInArrow(_cells(length, k, level > 0), _CELL_DDL)
        ordered = cells.repartition("anchor").sortWithinPartitions("anchor", "cell", "doc", "at")
        compared = written(ordered.mapInArrow(_compare, "anchor long, doc long, at long"), "repeats")
        spans.append(compared.where("anchor IS NULL").select("doc", place, size))
        mixed = compared.where("anchor IS NOT NULL").select("anchor", "doc", place, size)
        crowded = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > (crowd if k < length else 1 << 62)).select(F.bitwise_not("anchor").alias("key"), F.lit(True).alias("crowded"))
        wanted = (
            mixed.withColumn("key", F.bitwise_not("anchor"))
            .join(crowded, "key", "left")
            .select("doc", tag, F.struct("anchor", "place", start.alias("start"), "size", F.coalesce("crowded", F.lit(False)).alias("crowded")).alias("w"))
            .groupBy("doc", "tag")
            .agg(F.collect_list("w").alias("wanted"))
        )
        pieces = texts.join(wanted.hint("shuffle_hash"), ["doc", "tag"])
        pieces = pieces.select("doc", F.explode(F.expr("transform(wanted, w -> struct(w.anchor AS anchor, w.place AS place, w.crowded AS crowded, substring(cast(text AS binary), w.start + 1, w.size) AS piece))")).alias("p"))
        pieces = pieces.select("p.anchor", "doc", "p.place", "p.piece", "p.crowded")
        spans.append(pieces.where("NOT crowded").select("anchor", "doc", "place", "piece").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_solve(length), "doc long, place long, size int"))
        if crowded.isEmpty():
            break
        rows = pieces.where("crowded").select("doc", "place", "piece")
    ranged = reduce(DataFrame.unionByName, spans).select("doc", tag, F.struct(start.alias("s"), (start + F.col("size")).alias("e")).alias("span"))
    return ranged.groupBy("doc", "tag").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def _cut(raw: bytes, spans) -> tuple[bytes, int, int]:
    """What remains of a text, the bytes removed, and the number of maximal runs of them; spans are sorted."""
    kept, end, runs, removed = [], 0, 0, 0
    at = 0  # end of what is done
    for span in spans:
        s, e = span["s"], span["e"]
        if s > end or not runs:
            kept.append(raw[at:s])
            removed += e - s
            runs, end = runs + 1, e
        elif e > end:
            removed += e - end
            end = e
        at = end
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def _removed(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, spans in parts:
        rows = []
        for text, found in zip(texts, spans, strict=True):
            kept, removed, runs = _cut(text.encode("utf-8", "surrogatepass"), found if found is not None else [])
            rows.append((removed, runs, kept))
        yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])


def _digested(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in parts:
        yield pd.DataFrame({"n_removed": batch["n_removed"], "n_spans": batch["n_spans"], "kept_sha256": [hashlib.sha256(x).hexdigest() for x in batch["kept"]]})


def removed(text: Column, spans: Column) -> Column:
    """A struct of n_removed, n_spans and the bytes kept."""
    return F.pandas_udf(_removed, "n_removed long, n_spans long, kept binary")(text, spans)


def digests(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row.

    A null or empty text has no bytes. Identical rows are one document; rows that share a doc_id but not a text are
    told apart, and ordered, by a 15-bit hash of their texts; a null doc_id is the least. An empty table gives no
    rows; further columns play no part.
    """
    spans = repeats(docs, length).hint("shuffle_hash")
    joined = _keyed(docs).join(spans, ["doc", "tag"], "left")
    cut = F.pandas_udf(_digested, "n_removed long, n_spans long, kept_sha256 string")(removed(F.col("text"), F.col("spans")))
    return joined.select(F.nullif(F.col("doc"), F.lit(NO_ID)).alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), cut.alias("c")).select("doc_id", "n_bytes", "c.*")
