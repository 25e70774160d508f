"""Alignment of the tokens of two tokenizers over the bytes of the same text, and how often their ids meet in a corpus.

Two tokens overlap if one of them covers the byte at which the other starts. So two joins by pandas.merge_asof for each
batch, keyed by document, find all overlaps: the start of each token of A looks for B's covering token, and the start
of each token of B for A's. Overlaps whose ends are equal end a group: a stretch of bytes in which A's and B's tokens
meet only at its ends. Each token of A in a group is linked with each of B there.

Tokenizers aren't asked for the same word again and again. A single space between two characters that are no white
space is where both start a token, whatever comes before it: A's pattern has a space only ahead of a word, and no
piece of B has one elsewhere than at its start. Texts are cut there into units, a worker remembers the tokens of the
units that it has met, and those that it lacks go to the tokenizers many at a time. A very long text is cut there into
parts, whose groups and links add up.

The corpus-wide counts of linked id pairs may be as many as both vocabularies multiplied, so they are not broadcast.
Only those from a count on that at most HOT pairs have are, with the highest count of each A id, one number for each
entry of the vocabulary. These are looked up in arrays; the rare pairs of all documents are joined with theirs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import released, settled, written

#: Units that a worker remembers, with so many ids at most; characters of texts that are aligned at a time, and of a part of a text.
REMEMBERED, REMEMBERED_IDS, BATCH, PART = 500_000, 4_000_000, 1 << 19, 1 << 20
#: Id pairs whose counts are broadcast (12 bytes each); bytes of a tokenizer's file, which is broadcast too.
HOT, MOST_BYTES = 1 << 18, 64 << 20
#: An id has so many bits, so that a pair and a place in a batch fit 64.
BITS = 20
#: Links of a group from which its equal ids are counted before they are paired.
LARGE = 1 << 12

_SAFE = re.compile(r"(?<=\S) (?=\S)")


def _edged(unit: str) -> bool:
    """Whether it is empty or has white space at an end."""
    return not unit or unit[0].isspace() or unit[-1].isspace()


def parts(text: str, most: int) -> Iterator[str]:
    """The text in parts of not much more than `most` characters, cut at such spaces; where there is none, longer."""
    at = 0
    while len(text) - at > most:
        found = _SAFE.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Sides:
    """Both tokenizers and the bytes of their ids."""

    def __init__(self, model_a: bytes, model_b: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(model_a.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model_b)
        byte = letters()
        spelled = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes = (
            [spelled.get(i, b"") for i in range(max(spelled) + 1)],
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)],
        )
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in self.bytes)
        if max(map(len, self.bytes)) >= 1 << BITS:
            raise ValueError(f"a vocabulary of more than {1 << BITS} entries")
        most = max(map(len, self.bytes))
        #: an id's name with what follows it: in a group, at the end of its A side, at its end
        self.names, self.most = [f"{i}{c}" for c in ",|;" for i in range(most)], most

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a space and the text under both; None if the bytes of either differ from that."""
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text, num_threads=1)
        want = (" " + text).encode()
        return (a, b) if all(b"".join(map(t.__getitem__, x)) == want for t, x in zip(self.bytes, (a, b), strict=True)) else None


class _Slots(dict):
    """A number for each unit that is asked for, in the order in which they are first met."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, unit) -> int:
        self[unit] = slot = len(self)
        self.new.append(unit)
        return slot


#: What a slot may be: a unit with tokens; one whose tokens' bytes differ; a piece of a text that is no unit, as white space touches its ends.
FINE, BAD, ODD = 0, 1, 2


class _Table:
    """The units that a worker has met, and the ids of each side, one after the other.

    The key of a unit that has white space at its ends, at the ends of a text, is the unit in a tuple.
    """

    def __init__(self, sides: _Sides) -> None:
        self.sides = sides
        self.clear()

    def clear(self) -> None:
        self.slots = _Slots()
        self.ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # where a slot's ids begin, at 0, and end
        self.state = np.zeros(0, np.int64)

    def _alone(self, group: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """As _joined(), one unit at a time."""
        found = [self.sides.encode(u) for u in group]
        ids = [np.array([i for x in found if x for i in x[k]], np.int64) for k in range(2)]
        return ids, [np.array([len(x[k]) if x else 0 for x in found], np.int64) for k in range(2)], np.array([FINE if x else BAD for x in found])

    def _joined(self, group: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of units without white space at their ends, encoded as one text, how many each has, and states."""
        text = " ".join(group)
        found = self.sides.encode(text)
        if not found:
            return self._alone(group)
        ends = np.cumsum(np.fromiter(map(len, group if text.isascii() else map(str.encode, group)), np.int64, len(group)) + 1)
        ids = [np.fromiter(x, np.int64, len(x)) for x in found]
        at = [np.cumsum(z[x]) for z, x in zip(self.sides.sizes, ids, strict=True)]
        last = [np.searchsorted(x, ends) for x in at]
        if any((x[y] != ends).any() for x, y in zip(at, last, strict=True)):
            return self._alone(group)
        return ids, [np.diff(x, prepend=-1) for x in last], np.zeros(len(group), np.int64)

    def look_up(self, texts: list[str]) -> list[np.ndarray]:
        """The slots of the units of each text."""
        out = [self._slots(text.split(" ")) for text in texts]
        self._learn()
        for k, text in enumerate(texts):
            if (self.state[out[k]] == ODD).any():
                out[k] = self._slots([(u,) if _edged(u) else u for u in _SAFE.split(text)])
        self._learn()
        return out

    def _slots(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))

    def _learn(self, step: int = 4096) -> None:
        """Has the tokens of the units that were met since the last time, whose slots are the next ones."""
        new, self.slots.new = self.slots.new, []
        odd = [k for k, u in enumerate(new) if isinstance(u, str) and _edged(u)]
        alone = [k for k, u in enumerate(new) if not isinstance(u, str)]
        plain = sorted({*range(len(new))} - {*odd, *alone}) if odd or alone else [*range(len(new))]
        units = [new[k] for k in plain]
        found = [(self._joined(units[k : k + step]), plain[k : k + step]) for k in range(0, len(units), step)]
        found += [(self._alone([new[k][0]]), [k]) for k in alone]
        sizes, state = np.zeros((2, len(new)), np.int64), np.full(len(new), ODD)
        at = np.concatenate([np.zeros(0, np.int64), *(np.repeat(np.array(rows), n[0]) for (_, n, _), rows in found)]), np.concatenate([np.zeros(0, np.int64), *(np.repeat(np.array(rows), n[1]) for (_, n, _), rows in found)])
        for (_, n, states), rows in found:
            sizes[:, rows], state[rows] = n, states
        for k in range(2):
            ids = np.concatenate([np.zeros(0, np.int64), *(x[k] for (x, _, _), _ in found)])
            self.ids[k] = np.concatenate([self.ids[k], ids[np.argsort(at[k], kind="stable")] if odd or alone else ids])
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(sizes[k])])
        self.state = np.concatenate([self.state, state])

    def tokens(self, slots: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many units, one after the other, and how many each has."""
        ends, ids = self.ends[side], self.ids[side]
        n = ends[slots + 1] - ends[slots]
        return ids[_ranges(ends[slots], n)], n

    def settle(self) -> None:
        """Forgets all when it holds too much."""
        if len(self.slots) > REMEMBERED or max(map(len, self.ids)) > REMEMBERED_IDS:
            self.clear()


def _ranges(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, n of them, one after the other."""
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of tokens of A and B of the same document that share a byte; some come twice.

    Starts ascend, and each side covers its document without gaps, so that the last token that starts at or before a
    byte covers it.
    """
    a = pd.DataFrame({"doc": doc_a, "at": start_a, "a": np.arange(len(doc_a))})
    b = pd.DataFrame({"doc": doc_b, "at": start_b, "b": np.arange(len(doc_b))})
    of_a, of_b = pd.merge_asof(a, b, on="at", by="doc"), pd.merge_asof(b, a, on="at", by="doc")
    return np.concatenate([of_a["a"], of_b["a"]]).astype(np.int64), np.concatenate([of_a["b"], of_b["b"]]).astype(np.int64)


def _weighted(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the sum of their weights."""
    if not len(key):
        return key, weight
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(weight, first)


class Batch:
    """Documents' ids of both sides, aligned. ids: of A and B, one after the other; n: how many each document has."""

    def __init__(self, sides: _Sides, ids: list[np.ndarray], n: list[np.ndarray]) -> None:
        self.n, self.docs = n, len(n[0])
        doc = [np.repeat(np.arange(self.docs), x) for x in n]
        ends = [np.cumsum(s[x]) for s, x in zip(sides.sizes, ids, strict=True)]
        starts = [e - s[x] for e, s, x in zip(ends, sides.sizes, ids, strict=True)]
        i, j = overlaps(doc[0], starts[0], doc[1], starts[1])
        same = ends[0][i] == ends[1][j]
        last = [np.zeros(len(x), bool) for x in ids]
        last[0][i[same]] = last[1][j[same]] = True
        group = [np.cumsum(x) - x for x in last]
        groups = int(last[0].sum())
        size = [np.bincount(g, minlength=groups) for g in group]
        first = [np.cumsum(x) - x for x in size]
        owner = doc[0][first[0]] if groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(owner, minlength=self.docs)
        self.n_links = np.zeros(self.docs, np.int64)
        np.add.at(self.n_links, owner, size[0] * size[1])
        self.text = self._text(sides, ids, group, last, first, size)
        self.pairs = self._pairs(ids, group, first, size, owner)

    def _text(self, sides, ids, group, last, first, size) -> list[str]:
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        codes[np.arange(len(ids[0])) + first[1][group[0]]] = ids[0] + sides.most * last[0]
        codes[np.arange(len(ids[1])) + (first[0] + size[0])[group[1]]] = ids[1] + 2 * sides.most * last[1]
        ends = np.cumsum(self.n[0] + self.n[1])
        names = list(map(sides.names.__getitem__, codes.tolist()))
        return ["".join(names[e - k : e])[:-1] for e, k in zip(ends.tolist(), (self.n[0] + self.n[1]).tolist(), strict=True)]

    def _pairs(self, ids, group, first, size, owner) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each document its linked id pairs (A's id before B's in BITS bits each), ascending, and their links."""
        large = size[0] * size[1] > LARGE
        rows = np.flatnonzero(~large[group[0]])
        reps = size[1][group[0][rows]]
        left = np.repeat(rows, reps)
        right = _ranges(first[1][group[0][rows]], reps)
        key = owner[group[0][left]] << 2 * BITS | ids[0][left] << BITS | ids[1][right]
        keys, weights = np.unique(key, return_counts=True)
        found = [(keys, weights.astype(np.int64))]
        for g in np.flatnonzero(large):
            (a, p), (b, q) = (np.unique(x[f[g] : f[g] + s[g]], return_counts=True) for x, f, s in zip(ids, first, size, strict=True))
            step = max(1, (1 << 20) // len(b))
            for k in range(0, len(a), step):
                found.append(((owner[g] << 2 * BITS | a[k : k + step, None] << BITS | b).ravel(), (p[k : k + step, None] * q).ravel()))
        if len(found) > 1:
            keys, weights = _weighted(*(np.concatenate(x) for x in zip(*found, strict=True)))
        cuts = np.searchsorted(keys, np.arange(self.docs + 1) << 2 * BITS)
        mask = (1 << 2 * BITS) - 1
        return [(keys[x:y] & mask, weights[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def packed(keys: np.ndarray, links: np.ndarray) -> bytes:
    """Ascending keys as differences, and links, by planes of their bytes, compressed."""
    planes = [np.diff(keys, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T, links.astype("<i8").view(np.uint8).reshape(-1, 8).T]
    return zstandard.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in planes), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """keys and links of packed()."""
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    steps, links = (np.ascontiguousarray(x.T).view("<i8").ravel() for x in raw.reshape(2, 8, -1))
    return np.cumsum(steps), links


class _Row:
    """What the parts of a text add up to."""

    def __init__(self) -> None:
        self.fine, self.counts, self.hash, self.begun = True, [0, 0, 0, 0], hashlib.sha256(), False
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None

    def add(self, counts: list[int], text: str, pairs: tuple[np.ndarray, np.ndarray]) -> None:
        self.counts = [x + y for x, y in zip(self.counts, counts, strict=True)]
        self.hash.update((";" if self.begun else "").encode() + text.encode())
        self.begun = True
        self.pairs = pairs if self.pairs is None else _weighted(*(np.concatenate(x) for x in zip(self.pairs, pairs, strict=True)))

    def values(self) -> tuple:
        if not self.fine or self.pairs is None:
            return 0, 0, 0, 0, "", packed(np.zeros(0, np.int64), np.zeros(0, np.int64))
        return *self.counts, self.hash.hexdigest(), packed(*self.pairs)


def _aligned(sides: _Sides, table: _Table, texts: list[str | None]) -> Iterator[_Row]:
    """A row for each text, in their order."""
    rows = [_Row() for _ in texts]
    waiting: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        slots = table.look_up([x for _, x in waiting])
        for (row, _), x in zip(waiting, slots, strict=True):
            rows[row].fine &= not table.state[x].any()
        good = [k for k, (row, _) in enumerate(waiting) if rows[row].fine]
        if good:
            n = np.array([len(slots[k]) for k in good])
            flat = np.concatenate([slots[k] for k in good])
            found = [table.tokens(flat, side) for side in range(2)]
            first = np.cumsum(n) - n
            batch = Batch(sides, [x for x, _ in found], [np.add.reduceat(c, first) for _, c in found])
            for at, k in enumerate(good):
                counts = [int(x[at]) for x in (*batch.n, batch.n_groups, batch.n_links)]
                rows[waiting[k][0]].add(counts, batch.text[at], batch.pairs[at])
        waiting.clear()
        table.settle()

    for row, text in enumerate(texts):
        for part in parts(text, PART) if text else ():
            waiting.append((row, part))
            size += len(part)
            if size >= BATCH:
                flush()
                size = 0
    if waiting:
        flush()
    yield from rows


_WORKER: dict[tuple[int, int], tuple[_Sides, _Table, tuple[bytes, bytes]]] = {}


def _worker(model_a, model_b) -> tuple[_Sides, _Table]:
    """One for each Python worker, not for each task; it holds both files, so that their ids name them."""
    files = model_a.value, model_b.value
    key = (id(files[0]), id(files[1]))
    if key not in _WORKER:
        _WORKER.clear()
        sides = _Sides(*files)
        _WORKER[key] = (sides, _Table(sides), files)
    return _WORKER[key][:2]


_STORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("pairs", pa.binary())])
_STORED_SQL = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def tokens_met(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """row (a number of its own), doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and pairs (packed()) of each row, written once.

    path_a: a byte-level BPE of the tokenizers library, as JSON; path_b: a BPE of sentencepiece with byte fallback that
    adds a space ahead of a text. Both files are read by the driver and broadcast.
    """
    models = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            data = f.read(MOST_BYTES + 1)
        if len(data) > MOST_BYTES:
            raise ValueError(f"a tokenizer of more than {MOST_BYTES} bytes")
        models.append(data)
    splits = (json.loads(models[0]).get("pre_tokenizer") or {}).get("type")
    if splits != "ByteLevel":
        raise ValueError("side A must split texts as byte-level vocabularies do")
    shared = [docs.sparkSession.sparkContext.broadcast(x) for x in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, table = _worker(*shared)
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for k in range(0, len(batch), 256):
                ids, texts = (batch.column(c).slice(k, 256).to_pylist() for c in range(2))
                rows = [(at + j, i, *r.values()) for j, (i, r) in enumerate(zip(ids, _aligned(sides, table, texts), strict=True))]
                at += len(rows)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(_STORED)], schema=_STORED)
        released()

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _STORED_SQL), "alignment")


def pair_counts(met: DataFrame) -> DataFrame:
    """key (of an id pair) and n, the documents that hold it linked, summed in each task before they are shuffled."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = counts = np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def fold() -> None:
            nonlocal keys, counts, size
            new = np.concatenate([keys, *waiting])
            keys, counts = _weighted(new, np.concatenate([counts, np.ones(len(new) - len(keys), np.int64)]))
            waiting.clear()
            size = 0

        for batch in batches:
            for x in batch.column(0):
                waiting.append(unpacked(x.as_py())[0])
                size += len(waiting[-1])
                if size > 2_000_000:
                    fold()
                    if len(keys) > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=schema)
                        keys = counts = np.zeros(0, np.int64)
        fold()
        for k in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[k : k + 100_000]), pa.array(counts[k : k + 100_000])], schema=schema)
        released()

    return met.where("n_links > 0").select("pairs").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least count that at most `most` pairs have or exceed, of those with four significant bits; told from one row for each such count."""
    step = "greatest(cast(floor(log2(n)) AS int) - 3, 0)"
    sizes = counts.groupBy(F.expr(f"shiftleft(shiftright(n, {step}), {step})").alias("low")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("low")).collect()  # at most 16 rows for each bit
    total, least = 0, (1 << 63) - 1
    for r in sizes:
        total += r["m"]
        if total > most:
            break
        least = r["low"]
    return least


def aligned(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row.

    n_best: links whose pair's count is the highest that their A id has corpus-wide, ties included; count_sum: the sum
    of pairs' counts over links. A null or empty text has no tokens, nor has one whose tokens' bytes differ from a
    space and the text: zeros, and an empty string. Each row counts as a document, repeated rows and those with a null
    doc_id too; an empty table gives no rows; columns other than doc_id and text play no part.
    """
    met = tokens_met(docs, path_a, path_b)
    counts = settled(pair_counts(met))
    best = counts.groupBy(F.shiftright("key", BITS).alias("a")).agg(F.max("n").alias("best"))
    least = _hot_from(counts, hot)
    often = counts.where(F.col("n") >= least).select("key", "n").toPandas().sort_values("key")  # at most `hot` rows
    highest = best.toPandas()  # a row for each entry of the vocabulary at most
    table = np.zeros(1 << BITS, np.int64)
    table[highest["a"].to_numpy(np.int64)] = highest["best"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((often["key"].to_numpy(np.int64), often["n"].to_numpy(np.int64), table[: int(highest["a"].max() if len(highest) else 0) + 1]))
    columns = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = pa.schema([*((_STORED.field(c)) for c in columns), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, top = shared.value
        for batch in batches:
            sums = []
            for x in batch.column(len(columns)):
                k, links = unpacked(x.as_py())
                at, there = _found(keys, k)
                at, k, links = at[there], k[there], links[there]
                sums.append((int(links[n[at] == top[k >> BITS]].sum()), int((n[at] * links).sum())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(columns))), *(pa.array([s[c] for s in sums], pa.int64()) for c in range(2))], schema=schema)
        released()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value[0]
        for batch in batches:
            for row, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                k, links = unpacked(x.as_py())
                there = _found(keys, k)[1]
                if not there.all():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full((~there).sum(), row)), pa.array(k[~there]), pa.array(links[~there])], names=["row", "key", "links"])
        released()

    sums = met.select(*columns, "pairs").mapInArrow(known, _STORED_SQL.replace(", pairs binary", "") + ", n_best long, count_sum long")
    left = met.where("n_links > 0").select("row", "pairs").mapInArrow(rare, "row long, key long, links long")
    others = counts.where(F.col("n") < least).join(best, F.shiftright("key", BITS) == F.col("a")).select("key", "n", (F.col("n") == F.col("best")).alias("top"))
    more = left.join(others, "key").groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("links")).otherwise(F.lit(0))).alias("more_best"), F.sum(F.col("n") * F.col("links")).alias("more_sum"))
    out = sums.join(more, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.expr("n_best + coalesce(more_best, 0)").alias("n_best"), F.expr("count_sum + coalesce(more_sum, 0)").alias("count_sum"), "groups_sha256")


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted key among ascending keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
