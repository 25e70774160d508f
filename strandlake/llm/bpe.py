"""Byte-level BPE encoding and decoding with a queue of merge ranks kept in hierarchical bitmaps.

A pre-token of n bytes is a doubly linked list of pieces. For each rank there is a bucket with the positions of
the pieces whose union with their successor has this rank; two levels of bitmaps tell which buckets are in
use, so that the next rank is found with two find-first-set steps however many ranks there are. Entries are not
taken out when a neighbour merges: a popped entry whose pair no longer has this rank is skipped. Time is
O(n log n) for a pre-token of n bytes, so that one of a million letters is no trouble.

Short pre-tokens that a worker has not met before share one queue, thousands at a time: their pieces are arrays, the
upper bitmap tells which words of 64 ranks are in use, and of the bucket of a word each pre-token merges its least rank,
all of them in one step. Pre-tokens don't touch each other, so that each merges in its own order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pre-tokens remembered by each Python worker in each of two halves of its memory, of at most so many characters. When
#: one half is full it becomes the older one; what is met again there moves on, and the rest is forgotten with it.
REMEMBERED, REMEMBERED_CHARS = 250_000, 40
#: Ranks are sent to the executors in one broadcast variable; a larger vocabulary is refused.
MOST_RANKS = 1 << 18
#: Characters of texts that are split before their new pre-tokens are merged; new pre-tokens that share a queue, at least and at most.
SPLIT_CHARS, FEWEST, MOST = 3_000_000, 2_000, 60_000


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one pre-token.

    The queue is kept in local names, as calls would cost more than the merges of a short pre-token: buckets holds
    the positions of each rank, low the bits of the ranks in use by word of 64, top a bit for each word in use.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    after = list(range(1, n + 1))  # where the piece that starts here ends
    before = list(range(-1, n))  # where the piece before it starts
    now = [-1] * n  # the rank of the piece that starts here with its successor
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            now[i] = rank
            if rank in buckets:
                buckets[rank].append(i)  # ascending, so a heap
            else:
                buckets[rank] = [i]
                word = rank >> 6
                low[word] = low.get(word, 0) | 1 << (rank & 63)
                top |= 1 << word
    while top:
        word = (top & -top).bit_length() - 1
        bits = low[word]
        bit = bits & -bits
        rank = word << 6 | bit.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            low[word] = bits ^ bit
            if bits == bit:
                top ^= 1 << word
        if now[i] != rank:
            continue  # stale
        j = after[i]
        k = after[i] = after[j]
        now[j] = now[i] = -1
        pairs = []
        if k < n:
            before[k] = i
            pairs.append((i, get(piece[i : after[k]])))
        if i:
            h = before[i]
            now[h] = -1
            pairs.append((h, get(piece[h:k])))
        for i, rank in pairs:
            if rank is not None:
                now[i] = rank
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    word = rank >> 6
                    low[word] = low.get(word, 0) | 1 << (rank & 63)
                    top |= 1 << word
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(ids)


class Merges:
    """The ids of many short pre-tokens at once. A token is named by its place among all ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        ordered = sorted(ranks, key=ranks.__getitem__)
        places = {b: k for k, b in enumerate(ordered)}
        self.ids = np.array([ranks[b] for b in ordered], np.int64)
        self.single = np.array([places[bytes([i])] for i in range(256)], np.int32)
        self.end = len(ordered)  # stands between pre-tokens, and makes no pair
        keys, unions = [1 << 62], [-1]
        for k, b in enumerate(ordered):
            for j in range(1, len(b)):
                x, y = places.get(b[:j]), places.get(b[j:])
                if x is not None and y is not None:
                    keys.append(x << 20 | y)
                    unions.append(k)
        order = np.argsort(keys)
        self.keys, self.unions = np.array(keys, np.int64)[order], np.array(unions, np.int32)[order]

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Places of the unions of tokens x and y, -1 for those that are no token."""
        key = x.astype(np.int64) << 20 | y
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.unions[at], -1)

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        token = self.single[np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)]
        ends = np.concatenate(([0], np.cumsum(lengths + 1)))
        token[ends] = self.end
        n = len(token)
        owner = np.concatenate(([0], np.repeat(np.arange(len(pieces)), lengths + 1)))
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        alive[ends] = False
        now = np.full(n, -1, np.int32)
        now[:-1] = self.rank(token[:-1], token[1:])
        buckets: dict[int, list[np.ndarray]] = {}
        top, new = 0, np.flatnonzero(now >= 0)
        while True:
            if len(new):
                words = now[new] >> 6
                order = np.argsort(words, kind="stable")
                new, words = new[order], words[order]
                starts = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
                cuts = [*starts.tolist(), len(new)]
                for word, x, y in zip(words[starts].tolist(), cuts, cuts[1:], strict=False):
                    buckets.setdefault(word, []).append(new[x:y])
                    top |= 1 << word
            if not top:
                break
            word = (top & -top).bit_length() - 1
            at = np.concatenate(buckets.pop(word))
            at = at[now[at] >> 6 == word]  # others are stale
            key = np.sort(owner[at] << 38 | (now[at].astype(np.int64) & 63) << 32 | at)
            first = np.ones(len(key), bool)
            first[1:] = key[1:] >> 38 != key[:-1] >> 38
            i, rest = key[first] & 0xFFFFFFFF, key[~first] & 0xFFFFFFFF
            if len(rest):
                buckets[word] = [rest]
            else:
                top ^= 1 << word
            j, h = after[i], before[i]
            k = after[j]
            token[i], after[i], before[k], alive[j], now[j] = now[i], k, i, False, -1
            now[i], now[h] = self.rank(token[i], token[k]), self.rank(token[h], token[i])
            new = np.concatenate((i[now[i] >= 0], h[now[h] >= 0]))
        ids = self.ids[token[alive]].tolist()
        cuts = np.concatenate(([0], np.cumsum(np.bincount(owner[alive], minlength=len(pieces))))).tolist()
        return [tuple(ids[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


class Encoder(dict):
    """Ids of pre-tokens, remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        super().__init__()
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.merges = Merges(ranks)
        self.older: dict[str, tuple[int, ...]] = {}
        self.bytes = {i: b for b, i in ranks.items()}
        self.names = {i: str(i) for i in self.bytes}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode("utf-8", "surrogatepass")
            ids = merge(raw, self.ranks)
        if len(piece) <= REMEMBERED_CHARS:
            self[piece] = ids
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Merges new pre-tokens together, if they are many; else, and if they are long, each is merged where it is met."""
        fresh = [x for x in pieces if x not in self and x not in self.older and len(x) <= REMEMBERED_CHARS]
        if len(fresh) < FEWEST:
            return
        for at in range(0, len(fresh), MOST):
            parted = []
            for piece in fresh[at : at + MOST]:
                raw = piece.encode("utf-8", "surrogatepass")
                if (whole := self.ranks.get(raw)) is not None:
                    self[piece] = (whole,)
                else:
                    parted.append((piece, raw))
            if parted:
                self.update(zip((x for x, _ in parted), self.merges.merged([raw for _, raw in parted]), strict=True))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty ones have none."""
        coded: list[list[int]] = []
        waiting: list[list[str]] = []
        chars = 0

        def flush() -> None:
            if len(self) > REMEMBERED:
                self.older = dict(self)
                self.clear()
            self.learn(set().union(*waiting))
            coded.extend(list(chain.from_iterable(map(self.__getitem__, x))) for x in waiting)
            waiting.clear()

        for text in texts:
            waiting.append(self.split(text) if text else [])
            chars += len(text or "")
            if chars >= SPLIT_CHARS:
                flush()
                chars = 0
        flush()
        return coded

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One for each Python worker, not for each task; it holds the ranks, so that their id names them."""
    key = (id(shared.value), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    if not set(ranks) >= {bytes([i]) for i in range(256)}:
        raise ValueError("the ranks lack single bytes, so that not all texts can be encoded")
    if len(ranks) > MOST_RANKS:
        raise ValueError(f"more than {MOST_RANKS} ranks")
    return ranks


class Codec:
    """Columns of ids from texts, and of bytes from ids."""

    def __init__(self, spark, ranks_path: str, pattern: str) -> None:
        shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

        @F.pandas_udf("array<int>")
        def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            coder = _encoder(shared, pattern)
            for batch in texts:
                yield pd.Series(coder.encode_all(batch), dtype=object)

        @F.pandas_udf("binary")
        def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
            coder = _encoder(shared, pattern)
            for batch in ids:
                yield pd.Series([coder.decode(x) if x is not None else None for x in batch], dtype=object)

        @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def digest(ids: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            coder = _encoder(shared, pattern)
            for batch in ids:
                rows = []
                for x in batch:
                    listed = " ".join(map(coder.names.__getitem__, x))
                    rows.append((len(x), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(coder.decode(x)).hexdigest()))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        @F.pandas_udf("token_ids array<int>, n_tokens long, decoded_sha256 string")
        def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            coder = _encoder(shared, pattern)
            for batch in texts:
                rows = [(x, len(x), hashlib.sha256(coder.decode(x)).hexdigest()) for x in coder.encode_all(batch)]
                yield pd.DataFrame(rows, columns=["token_ids", "n_tokens", "decoded_sha256"])

        self._encode, self._decode, self._digest, self._both = encode, decode, digest, both

    def encode(self, text: Column) -> Column:
        """Ids of a text; an empty text and a null have none."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        return self._decode(ids)

    def digest(self, ids: Column) -> Column:
        """Their number, the SHA-256 of their list, and the SHA-256 of what they decode to.

        On the ids that encode() returns, this runs in the same Python task: the lists need not return to the JVM.
        """
        return self._digest(ids)


    def both(self, text: Column) -> Column:
        """A struct of the ids, their number, and the SHA-256 of what they decode to."""
        return self._both(text)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Rows with the ids of their whole texts in a further column.

    A null text and an empty one have no ids; repeated rows stay; other columns stay as they are, but for one that
    bears the name of the new one, which is replaced.
    """
    return docs.withColumn(out, Codec(docs.sparkSession, ranks_path, pattern).encode(F.col(text)))


def tokenised(docs: DataFrame, ranks_path: str, pattern: str, further: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, token_ids, n_tokens and decoded_sha256 of each row, then further columns of docs; nulls, empty texts and tables as in digests()."""
    codec = Codec(docs.sparkSession, ranks_path, pattern)
    return docs.select("doc_id", "source", codec.both(F.col("text")).alias("t"), *further).select("doc_id", "source", "t.*", *further)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, in the ids' and the decoded bytes' own order.

    Every row has a result: an empty or null text has no tokens and the digests of nothing; ties and repeated rows
    are rows like others; an empty table gives none. Only doc_id and text are read.
    """
    codec = Codec(docs.sparkSession, ranks_path, pattern)
    coded = docs.select("doc_id", codec.digest(codec.encode(F.col("text"))).alias("d"))
    return coded.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
