"""Jaccard join of documents on word shingles, by prefixes under several global orders of the shingles.

If two sets have a Jaccard similarity of t or more, then under any one order of all shingles they share one of the
first n - ceil(t n) + 1 shingles of either, its prefix. The orders here put rare shingles first, by how many distinct
sets hold them, and differ in how they break ties and how finely they tell counts apart. A pair is verified on its
whole sets only if it shares prefix shingles under every one of the orders.

To count is to shuffle, so of large sets only the shingles of the least hashes, somewhat more than a prefix needs,
are counted and stand at the head of every order; they are a fixed part of all shingles, and the others follow by
hash. The part is larger for smaller sets, and all of the smallest: sets are dealt to bands of size with orders of
their own, which overlap so far that any two sets that can link have one band in common. Equal sets are one class
from the start. Shingles in one set only can't link and stay behind.

Candidates meet at the prefix shingles of the first order, in tiles of bounded size. There a pair must also fit by
its sizes, by the places of the shingle in both prefixes, by bitmaps of the prefixes under the other orders, and by
the parity of its shingles in 256 bits: sets whose parities differ in more bits than sets that link may differ in
shingles don't link. What is left is verified on the texts. Near copies share most of their prefixes, so that a pair
would be found many times: of shingles that the same classes hold only the first is kept, and of crowded shingles a
pair is taken where no common one is seen before. Of a crowded tile only candidates enough to tie it together as
likely links would come first; classes that true links connect need not meet again, so that a large group of near
copies costs some pairs for each member, not their square. Further rounds take what is still apart, until a round
leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import carried, marked, released, restored, settled
from strandlake.llm.graph import components

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(32)
#: What shingles are multiplied by in each band; their last two bits then name the band.
_SALTS = (1, 0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: Words whose hashes each Python worker remembers.
REMEMBERED = 100_000
#: Orders of shingles: fields of (count, log2 of the count, shingle, two other hashes) that sort them.
ORDERS = (("df", "tok"), ("df", "h1"), ("lg", "h2"))
#: A null doc_id counts as this one, the largest.
NO_ID = (1 << 63) - 1
#: Texts whose sets a Python task holds at a time, and pairs of tiles.
SETS, PAIRS = 1000, 100_000
#: Bits of a set's parity; rows of a side of a tile; holders of a shingle of which all pairs are looked at at once; pairs for
#: each row of a tile in the first of the later rounds, and by how much more the next one takes: few rounds end it;
#: crowded shingles before one that a row carries.
PARITY, TILE, FEW, CROWD, WIDER, BEFORE = 256, 1024, 8, 4, 16, 8


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; of fewer words, the whole sequence as one."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII blanks only
    if not found:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        s = (s ^ (s >> _S)) * _K + h[k : len(h) - n + 1 + k]
    s = (s ^ (s >> _S)) * _M
    return np.unique((s ^ (s >> _S)).view(np.int64))


def prefix(n: int, percent: int) -> int:
    """Shingles of a set of n in its prefix."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


#: Bands: sets of up to so many shingles, and their counted part as a multiple of the part that a prefix takes.
BANDS = ((64, 3.0), (256, 1.5), (1 << 62, 1.05))


def bands(n: int, percent: int) -> list[int]:
    """The bands of a set of n shingles: two sets of which the smaller is in a band by its limits have it in common."""
    lows = (0, *(limit for limit, _ in BANDS))
    return [k for k, (limit, _) in enumerate(BANDS) if lows[k] < n <= 100 * limit // percent]


def _cut(band: int, percent: int) -> int:
    share = min(1.0, BANDS[band][1] * (1 - percent / 100) + 0.01)
    return min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))


def class_name(s: np.ndarray) -> bytes:
    """The 128-bit name of a set, which stands for it."""
    return xxhash.xxh3_128_digest(s.tobytes())


def short_name(name: bytes) -> int:
    """64 bits of it, by which candidates are looked for; classes that share them only meet more often."""
    return int.from_bytes(name[:8], "big", signed=True)


def parity(s: np.ndarray) -> bytes:
    """For each of 256 values of a hash whether an odd number of shingles have it."""
    return np.packbits((np.bincount(s & (PARITY - 1), minlength=PARITY) & 1).astype(bool)).tobytes()


_SETS = "id long, version long, name binary, cid long, n long, main boolean, parity binary, band long, counted long, heads array<long>"


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, version (of the text), name, cid, n, and for each band a row: counted (shingles below the cut) and heads (these, and more up to a prefix).

    A document's first row is its main one, and has the parity; one without shingles has band -1.
    """
    cuts = [_cut(k, percent) for k in range(len(BANDS))]
    types = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in _SETS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SETS):
                out = []
                for i, v, text in zip(*(batch.column(k).slice(at, SETS).to_pylist() for k in range(3)), strict=True):
                    s = shingles(text, words)
                    name, n = class_name(s), len(s)
                    for j, k in enumerate(bands(n, percent) or [-1]):
                        tokens = np.unique((s * np.int64(_SALTS[k])) & ~np.int64(3) | np.int64(k))
                        counted = int(np.searchsorted(tokens, cuts[k]))
                        out.append((i, v, name, short_name(name), n, j == 0, None if j else parity(s), k, counted, tokens[: max(counted, prefix(n, percent))].copy()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], schema.field(k).type) for k in range(len(schema))], schema=schema)
        released()

    return _keyed(docs).mapInArrow(run, _SETS)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """For each class that may link: cid, n, parity, prefix0 (tok, pos), prefix1, prefix2, and bitmaps of the last two in 64 bits.

    Prefixes hold shingles that another row holds too, prefix0 by its order in each band; pos is the place in the whole set's order, from 1, or less.
    """
    small = sets.where("main AND n > 0").select("id", "name")
    copies = small.join(small.groupBy("name").agg(F.min("id").alias("rep")), "name").where("id <> rep").select("id", "name")
    # one row of each class goes on; only rows that may be copies are shuffled to find out
    rows = marked(sets.where("n > 0").select("id", "name", "cid", "band", "heads"), "id", copies.select("id"))
    ones = rows.where("NOT maybe").select("cid", "heads").unionByName(rows.where("maybe").join(copies, ["id", "name"], "left_anti").select("cid", "heads"))
    tokens = ones.select("cid", F.explode("heads").alias("tok"))
    # the key is another than the one counted by, so that both sides are dealt anew and a very common shingle is split as a skewed join
    counts = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select(F.bitwise_not("tok").alias("key"), "df")
    shared = tokens.select("cid", F.bitwise_not("tok").alias("key")).join(counts, "key").select("cid", F.bitwise_not("key").alias("tok"), "df")
    lists = shared.groupBy("cid", F.col("tok").bitwiseAND(F.lit(3)).alias("band")).agg(F.collect_set(F.struct("tok", "df")).alias("shared"))
    sized = lists.join(sets.where("n > 0").select("cid", "band", "n", "counted").distinct(), ["cid", "band"])
    cut = F.element_at(F.array(*[F.lit(_cut(k, percent)) for k in range(len(BANDS))]), (F.col("band") + 1).cast("int"))
    sized = sized.withColumn("cut", cut).withColumn("low", F.expr("filter(shared, x -> x.tok < cut)")).withColumn("p", F.expr(f"n - ({percent} * n + 99) div 100 + 1"))
    sized = sized.withColumn("alone", F.expr("counted - size(low)")).withColumn("take", F.expr("cast(p - alone AS int)"))
    fields = {"tok": "x.tok", "df": "x.df", "lg": "cast(floor(log2(x.df)) AS long)", "h1": "xxhash64(x.tok, 1)", "h2": "xxhash64(x.tok, 2)"}
    for k, order in enumerate(ORDERS):
        ranked = f"transform(array_sort(transform(low, x -> struct({', '.join(f'{fields[f]} AS f{j}' for j, f in enumerate(order))}, x.tok AS tok))), x -> x.tok)"
        every = "array_sort(transform(shared, x -> struct(x.df AS df, x.tok AS tok)))" if k == 0 else "shared"
        sized = sized.withColumn(f"prefix{k}", F.expr(f"if(counted >= p, if(take > 0, slice({ranked}, 1, take), cast(array() AS array<bigint>)), transform({every}, x -> x.tok))"))
    kept = sized.where(" AND ".join(f"size(prefix{k}) > 0" for k in range(len(ORDERS))))
    kept = kept.withColumn("prefix0", F.expr("transform(prefix0, (x, i) -> struct(x AS tok, if(counted >= p, alone + i + 1, 1L) AS pos))"))
    whole = kept.groupBy("cid").agg(*(F.flatten(F.collect_list(f"prefix{k}")).alias(f"prefix{k}") for k in range(len(ORDERS))))
    bits = "aggregate({0}, 0L, (m, x) -> m | shiftleft(1L, cast(pmod(xxhash64(x, 3), 64) AS int)))"
    return whole.join(sets.where("main AND n > 0").select("cid", "n", "parity").distinct(), "cid").select("cid", "n", "parity", "prefix0", "prefix1", "prefix2", F.expr(bits.format("prefix1")).alias("bits1"), F.expr(bits.format("prefix2")).alias("bits2"))


_HOLDER = ("cid", "n", "pos", "parity", "bits1", "bits2")


def _holders(prefixes: DataFrame, percent: int) -> DataFrame:
    """A row for each class and prefix shingle of the first order that other classes have there too: tok, df (how many), _HOLDER, before.

    Of shingles of a band that the same classes have only the first in the order stays: the first that any two sets
    share is never another, and only there must they fit by their places. Shingles of two classes whose sizes don't fit
    go. before: of the crowded shingles that a class has in a band, the last ones before a crowded one.
    """
    places = prefixes.select("cid", "n", F.posexplode("prefix0").alias("rank", "x")).select("cid", "n", "rank", "x.tok", "x.pos")
    who = [F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"who{k}") for k in range(2)]  # 128 bits name the set of classes
    counts = places.groupBy("tok").agg(F.count(F.lit(1)).alias("df"), F.sum("pos").alias("place"), F.min("n").alias("least"), F.max("n").alias("most"), *who)
    counts = counts.where(f"df > 2 OR (df = 2 AND 100 * least >= {percent} * most)")
    firsts = counts.groupBy(F.col("tok").bitwiseAND(F.lit(3)), "df", "who0", "who1").agg(F.min(F.struct("place", "tok")).alias("first")).select(F.bitwise_not("first.tok").alias("key"), "df")
    rows = places.select("cid", "rank", "pos", F.bitwise_not("tok").alias("key")).join(firsts, "key").select("cid", "rank", "pos", F.bitwise_not("key").alias("tok"), "df")
    rows = rows.join(prefixes.select("cid", "n", "parity", "bits1", "bits2"), "cid").withColumn("crowded", F.col("df") > min(FEW, TILE))
    own = Window.partitionBy("cid", F.col("tok").bitwiseAND(F.lit(3)), "crowded").orderBy("rank").rowsBetween(-BEFORE, -1)
    return settled(rows.select("tok", "df", *_HOLDER, F.when(F.col("crowded"), F.collect_list("tok").over(own)).alias("before")))


class _Side:
    """Rows of a tile as arrays."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.cid, self.n, self.pos = (rows[c].to_numpy() for c in ("cid", "n", "pos"))
        self.bits = [rows[c].to_numpy() for c in ("bits1", "bits2")]
        self.parity = np.frombuffer(b"".join(rows["parity"]), np.uint64).reshape(len(rows), PARITY // 64)
        self.label = rows["code"].to_numpy()
        self.apart = rows["apart"].to_numpy()
        self.before = [frozenset(x) for x in rows["before"]] if rows["before"].notna().all() else None


def _fits(a: _Side, x, b: _Side, y, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of rows x of a and y of b may link, and in how many bits their parities differ."""
    small, large = np.minimum(a.n[x], b.n[y]), np.maximum(a.n[x], b.n[y])
    need = (percent * (small + large) + 99 + percent) // (100 + percent)  # least size of the intersection
    ok = (100 * small >= percent * large) & (1 + np.minimum(a.n[x] - a.pos[x], b.n[y] - b.pos[y]) >= need) & (a.cid[x] != b.cid[y])
    for p, q in zip(a.bits, b.bits, strict=True):
        ok &= (p[x] & q[y]) != 0
    away = np.zeros(len(ok), np.int64)
    at = np.flatnonzero(ok)
    if len(at):
        left = a.parity[x] if np.ndim(x) == 0 else a.parity[x[at]]
        away[at] = np.bitwise_count(left ^ b.parity[y[at]]).sum(axis=1)
        ok[at] = away[at] <= (small + large - 2 * need)[at]
    return ok, away


class _Forest(dict):
    def root(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(up, up)
        return x

    def tie(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)
        return x != y


def _candidates(tiles: DataFrame, percent: int, crowd: int) -> DataFrame:
    """a, b: pairs of classes that may link, a < b, of rows that meet in a tile and have different labels; and a null pair if that is not all.

    tiles: tok, i, j, side, label, apart, before, _HOLDER. In tiles of one side (0) each pair of rows is one; else those
    of side 0 with those of side 1, and of two rows that are apart the one of side 0 must be less. Two rows with a
    shingle before in common are no pair here: they meet there as well. Of a tile where more than `crowd` pairs for each
    row may link come only those that tie labels together as all of them would.
    """

    def few(rows: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
        side, key = _Side(rows), rows["group"].to_numpy()
        lefts, rights = [], []
        for d in range(1, FEW):
            x = np.flatnonzero(key[d:] == key[:-d])
            if not len(x):
                break
            x = x[side.label[x] != side.label[x + d]]
            ok = _fits(side, x, side, x + d, percent)[0]
            lefts.append(side.cid[x[ok]])
            rights.append(side.cid[x[ok] + d])
        return lefts, rights

    def many(rows: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], bool]:
        zero = rows["side"].to_numpy() == 0
        one = zero.all()
        a = _Side(rows if one else rows[zero])
        b = a if one else _Side(rows[~zero])
        forest, found, tree = _Forest(), [], []
        room = crowd * len(rows)
        for x in range(len(a.cid)):
            y = np.arange(x + 1, len(b.cid)) if one else np.arange(len(b.cid))
            y = y[b.label[y] != a.label[x]]
            if not one and a.apart[x]:
                y = y[~b.apart[y] | (b.cid[y] > a.cid[x])]
            if not len(y):
                continue
            ok, away = _fits(a, x, b, y, percent)
            y, away = y[ok], away[ok]
            if len(y) and a.before is not None and b.before is not None:
                fresh = [a.before[x].isdisjoint(b.before[k]) for k in y.tolist()]
                y, away = y[fresh], away[fresh]
            room -= len(y)
            if room >= 0:
                found.append((x, y))
            else:
                found.clear()
            y = y[np.argsort(away, kind="stable")]
            tree += [(x, k) for k in y.tolist() if forest.tie(int(a.label[x]), int(b.label[k]))]
        if room < 0:
            return [a.cid[[x for x, _ in tree]]], [b.cid[[k for _, k in tree]]], False
        return [np.full(len(y), a.cid[x]) for x, y in found], [b.cid[y] for _, y in found], True

    def paired(lefts: list[np.ndarray], rights: list[np.ndarray]) -> pd.DataFrame:
        x, y = np.concatenate(lefts), np.concatenate(rights)
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()

    def solve(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.reset_index(drop=True)
        rows["code"] = pd.factorize(rows["label"])[0]
        group = (rows[["tok", "i", "j"]] != rows[["tok", "i", "j"]].shift()).any(axis=1).cumsum().to_numpy()
        rows["group"] = group
        sizes = np.bincount(group)[group]
        small = (sizes <= FEW) & (rows.groupby("group")["side"].transform("max").to_numpy() == 0)
        lefts, rights = few(rows[small].reset_index(drop=True)) if small.any() else ([], [])
        whole = True
        for _, part in rows[~small].groupby("group", sort=False):
            x, y, fully = many(part)
            whole &= fully
            lefts += x
            rights += y
            if sum(map(len, lefts)) > PAIRS:  # a crowded tile's pairs are handed on before the next one's are found
                yield paired(lefts, rights)
                lefts, rights = [], []
        if lefts:
            yield paired(lefts, rights)
        if not whole:
            yield pd.DataFrame({"a": [None], "b": [None]}, dtype="Int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = tuple(batch[["tok", "i", "j"]].iloc[-1])
            if held and tuple(held[-1][["tok", "i", "j"]].iloc[-1]) == last == tuple(batch[["tok", "i", "j"]].iloc[0]):
                held.append(batch)
                continue
            ends = (batch[["tok", "i", "j"]] == last).all(axis=1).to_numpy()
            yield from solve(pd.concat([*held, batch[~ends]]))
            held = [batch[ends]]
        if held:
            yield from solve(pd.concat(held))
        released()

    dealt = tiles.repartition("tok", "i", "j").sortWithinPartitions("tok", "i", "j", "side", "cid")
    return dealt.mapInPandas(run, "a long, b long").distinct()


def _first_tiles(holders: DataFrame) -> DataFrame:
    """The holders of each shingle, in tiles of one side."""
    i = F.expr(f"pmod(xxhash64(cid, tok), (df + {TILE - 1}L) div {TILE}L)").alias("i")  # other classes meet at each shingle
    return holders.select("tok", i, F.lit(0).cast("long").alias("j"), F.lit(0).alias("side"), F.col("cid").alias("label"), F.lit(False).alias("apart"), F.lit(None).cast("array<long>").alias("before"), *_HOLDER)


def _later_tiles(holders: DataFrame, labels: DataFrame) -> DataFrame:
    """Tiles of the shingles whose holders have different labels: those without the most frequent label (apart) by all of them.

    holders: of shingles with more than FEW; of others all pairs have been seen. labels: cid, label; a class that is not
    there is its own. Shingles are counted first and both sides come from one scan, so that plans stay small: planning
    again after each stage takes the driver's memory.
    """
    named = holders.join(labels, "cid", "left").withColumn("label", F.coalesce("label", F.col("cid").cast("string").cast("binary")))
    counts = named.groupBy("tok", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("tok").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    counts = settled(counts.where("kinds > 1").select(F.bitwise_not("tok").alias("key"), F.col("top.label").alias("top"), F.expr(f"(all + {TILE - 1}L) div {TILE}L").alias("js"), F.expr(f"(all - top.n + {TILE - 1}L) div {TILE}L").alias("is")))
    rows = named.withColumn("key", F.bitwise_not("tok")).join(counts, "key").withColumn("apart", F.col("label") != F.col("top"))
    left = "transform(filter(sequence(0L, js - 1), x -> apart), x -> named_struct('i', pmod(xxhash64(cid, 7), is), 'j', x, 'side', 0))"
    right = "transform(sequence(0L, is - 1), x -> named_struct('i', x, 'j', pmod(xxhash64(cid, 5), js), 'side', 1))"
    dealt = rows.withColumn("place", F.explode(F.expr(f"concat({left}, {right})")))
    return dealt.select("tok", "place.i", "place.j", "place.side", "label", "apart", "before", *_HOLDER)


def _verified(pairs: DataFrame, prefixes: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b (names) of the pairs (a, b) that share prefix shingles under the other orders and link by their whole sets.

    A class a and those that it is paired with meet, a first, and the others' sets pass by; as pairs come from tiles,
    a class is not paired with many times the rows of a tile.
    """
    roles = pairs.select(F.col("b").alias("cid"), F.col("a").alias("hub"), F.lit(1).alias("side")).unionByName(pairs.select(F.col("a").alias("cid"), F.col("a").alias("hub"), F.lit(0).alias("side")).distinct())
    cast = settled(roles.join(classes.select("cid", "rep"), "cid").join(prefixes.select("cid", "prefix1", "prefix2"), "cid"))
    texts = marked(_keyed(docs).select(F.col("id").alias("rep"), "text"), "rep", cast.select("rep")).where("maybe").select("rep", "text")
    rows = texts.join(cast, "rep").select("hub", "side", "cid", "prefix1", "prefix2", "text")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, firsts, orders = None, {}, []
        for batch in batches:
            found = []
            hubs, sides, cids = (batch.column(k).to_numpy() for k in range(3))
            for k in range(len(batch)):
                s = shingles(batch.column(5)[k].as_py(), words)
                name = class_name(s)
                if short_name(name) != cids[k]:
                    continue  # another text with the same id
                both = [batch.column(c)[k].as_py() for c in (3, 4)]
                if not sides[k]:
                    if hub != hubs[k]:
                        hub, firsts, orders = hubs[k], {}, [set(x) for x in both]
                    firsts[name] = s
                elif hub == hubs[k] and not any(x.isdisjoint(y) for x, y in zip(orders, both, strict=True)):
                    for other, t in firsts.items():
                        common = len(np.intersect1d(s, t, assume_unique=True))
                        if 100 * common >= percent * (len(s) + len(t) - common) and other != name:
                            found.append((other, name))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in range(2)], schema=schema)
        released()

    met = rows.repartition("hub").sortWithinPartitions("hub", "side")
    return met.mapInArrow(run, "a binary, b binary")


def _labels(links: DataFrame) -> DataFrame:
    """name, label: of classes that links connect, the least name that they reach."""
    return components(links).select(F.col("node").alias("name"), "label")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """name, label after further links (a, b): only labels and names that these tie together go through rounds of components."""
    known = lambda side: labels.select(F.col("name").alias(side), F.col("label").alias(f"label_{side}"))
    ends = links.join(known("a"), "a", "left").join(known("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    lower = components(ends.where("a <> b").distinct()).select(F.col("node").alias("old"), F.col("label").alias("least"))
    fresh = links.select(F.explode(F.array("a", "b")).alias("name")).distinct().join(labels, "name", "left_anti").select("name", F.col("name").alias("label"))
    return settled(labels.unionByName(fresh).join(lower, F.col("label") == F.col("old"), "left").select("name", F.coalesce("least", "label").alias("label")))


def _tied(docs: DataFrame, sets: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """name, label of the classes with links to others: what links connect has one label."""
    prefixes = settled(_prefixes(sets, percent))
    holders = _holders(prefixes, percent)
    found = settled(_candidates(_first_tiles(holders), percent, 0))
    seen = found.where("a IS NOT NULL")
    labels = _labels(settled(_verified(seen, prefixes, classes, docs, words, percent)))
    crowded = settled(holders.where(F.col("df") > min(FEW, TILE)))
    crowd = CROWD
    while True:
        by_cid = settled(labels.join(classes.select("name", "cid"), "name").select("cid", "label").distinct())
        found = settled(_candidates(_later_tiles(crowded, by_cid), percent, crowd).join(seen, ["a", "b"], "left_anti"))
        pairs = found.where("a IS NOT NULL")
        more = settled(_verified(pairs, prefixes, classes, docs, words, percent)) if not pairs.isEmpty() else None
        tied = more is not None and not more.isEmpty()
        if tied:
            labels, seen = _relabelled(labels, more), seen.unionByName(pairs)
        if found.where("a IS NULL").isEmpty():
            return labels
        crowd = crowd * WIDER if tied else 1 << 40  # nothing more to tie: all that is left


def joined(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included).

    Documents link when 100 * intersection >= percent * union of their sets of shingles. A null or empty text and
    one without words have no shingles and no links; equal sets link. Rows with the same doc_id but other texts
    count as documents of their own; a null doc_id counts as the largest, so that its component is null only if no
    other id is in it; ties cannot matter; an empty table gives no rows; further columns play no part. Only as many
    pairs are verified as tell the components; linked() finds all links.
    """
    return _rows(*_joined(docs, words, percent))


def linked(docs: DataFrame, words: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """As joined(), with n_links: the other rows that a row links to, exact copies among them.

    Links lie within components: all pairs of the different sets of a component are verified, in tiles of bounded
    size, each pair in one; equal sets are counted, not paired.
    """
    sets, known = _joined(docs, words, percent)
    near = _linked(docs, known, words, percent, tile)
    return _rows(sets, known.join(near, "name", "left").withColumn("n_links", F.expr("copies - 1 + coalesce(near, 0)")))


def _joined(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets, and for each class name, cid, rep (least id), copies (rows), label (null without links to others), component (least id)."""
    sets = settled(_sets(docs, words, percent))
    classes = settled(sets.where("main AND n > 0").groupBy("name").agg(F.first("cid").alias("cid"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    tied = classes.select("name", "rep").join(_tied(docs, sets, classes, words, percent), "name")
    least = tied.groupBy("label").agg(F.min("rep").alias("least"))
    known = classes.join(tied.join(least, "label").select("name", "label", "least"), "name", "left")
    return sets, known.select("name", "cid", "rep", "copies", "label", F.coalesce("least", "rep").alias("component"))


def _rows(sets: DataFrame, known: DataFrame) -> DataFrame:
    columns = [c for c in ("component", "n_links") if c in known.columns]
    rows = sets.where("main").select("id", F.col("n").alias("n_shingles"), "name")
    rows = rows.join(known.select(F.col("name").alias("_name"), *columns), (F.col("n_shingles") > 0) & (F.col("name") == F.col("_name")), "left")
    out = rows.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(F.coalesce("component", "id"), F.lit(NO_ID)).alias("component_id"), *columns[1:])
    return out.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")) if "n_links" in columns else out


def _linked(docs: DataFrame, known: DataFrame, words: int, percent: int, tile: int) -> DataFrame:
    """name, near: for the classes of components of several, the rows of other classes that each links to."""
    members = settled(known.where("label IS NOT NULL").select("name", "rep", "copies", "label"))
    sizes = members.groupBy("label").agg(F.expr(f"(count(1) + {tile - 1}L) div {tile}L").alias("tiles"))
    tiled = members.join(sizes, "label").withColumn("own", F.expr("pmod(xxhash64(name, 3), tiles)")).withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
    tiled = tiled.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("side"), "name", "rep", "copies")
    texts = marked(_keyed(docs).select(F.col("id").alias("rep"), "text"), "rep", members.select("rep")).where("maybe")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(s=[shingles(t, words) for t in rows["text"]]).drop(columns="text")
        rows = rows[[name == class_name(s) for name, s in zip(rows["name"], rows["s"], strict=True)]].drop_duplicates("name")
        if len(rows) < 2:
            return pd.DataFrame({"name": pd.Series([], dtype=object), "near": pd.Series([], dtype="int64")})
        n, side, copies = rows["s"].map(len).to_numpy(), rows["side"].to_numpy(), rows["copies"].to_numpy()
        flat, starts = np.unique(np.concatenate(list(rows["s"])), return_inverse=True)[1], np.concatenate(([0], np.cumsum(n)[:-1]))
        flags, near, across = np.zeros(flat.max() + 1, bool), np.zeros(len(rows), np.int64), (rows["i"] != rows["j"]).to_numpy()[0]
        for x in range(len(rows)):
            own = flat[starts[x] : starts[x] + n[x]]
            flags[own] = True
            both = np.add.reduceat(flags[flat], starts)
            flags[own] = False
            near[x] = copies[(100 * both >= percent * (n + n[x] - both)) & (np.arange(len(rows)) != x) & ((side != side[x]) | (not across))].sum()
        return pd.DataFrame({"name": rows["name"].to_numpy()[near > 0], "near": near[near > 0]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        current = None
        for batch in batches:
            for key, rows in batch.groupby(["label", "i", "j"], sort=False):
                if key != current and waiting:
                    yield solve(pd.concat(waiting))
                    waiting = []
                current = key
                waiting.append(rows)
        if waiting:
            yield solve(pd.concat(waiting))

    met = tiled.join(texts, "rep").select("label", "i", "j", "side", "name", "copies", "text").repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "name")
    return met.mapInPandas(run, "name binary, near long").groupBy("name").agg(F.sum("near").alias("near"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows and columns of docs, of each component only its row with the least (doc_id, hash of the text).

    Rows with the same doc_id and another text are judged apart; a null doc_id is the largest; of rows with the same
    id and text one stays. Rows without a shingle all stay.
    """
    sets, known = _joined(docs, words, percent)
    rows = sets.where("main AND n > 0").select("id", "version", "name")
    named = rows.join(known.select("name", F.coalesce("label", "name").alias("label")), "name").select("id", "version", "label")
    ones = named.groupBy("label").agg(F.min(F.struct("id", "version")).alias("one"), F.count(F.lit(1)).alias("n")).where("n > 1").select("label", "one")
    judged = named.join(ones, "label").groupBy("id", "version").agg(F.bool_or((F.col("id") == F.col("one.id")) & (F.col("version") == F.col("one.version"))).alias("stays"), F.count(F.lit(1)).alias("n"))
    several = settled(judged.where("NOT stays OR n > 1").select("id", "version", "stays"))  # a row that stays alone needs no look
    own = ["_row"]
    keyed = carried(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"))
    checked = marked(keyed, "_id", several.select(F.col("id").alias("_id")), "_maybe")
    unsure = checked.where("_maybe").withColumn("_version", F.xxhash64(F.coalesce(F.col("_row.text"), F.lit(""))))
    stays = several.select(F.col("id").alias("_id"), F.col("version").alias("_version"), "stays").hint("shuffle_hash")
    judged = unsure.join(stays, ["_id", "_version"], "left").where("coalesce(stays, true)")
    left = judged.where("stays IS NULL").select(*own).unionByName(judged.where("stays").dropDuplicates(["_id", "_version"]).select(*own))
    return restored(checked.where("NOT _maybe").select(*own).unionByName(left), docs.columns)


def oracle_links(words: int, percent: int) -> str:
    """oracle() with the number of links of each document."""
    head, tail = oracle(words, percent).rsplit(" AS component_id FROM documents d", 1)
    return f"{head} AS component_id, (SELECT count(*) FROM z WHERE z.a = d.doc_id)::BIGINT AS n_links FROM documents d{tail}"


def oracle(words: int, percent: int) -> str:
    """The same in DuckDB by brute force: all pairs that share a shingle, then the least id reachable, step by step."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < {words} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {words - 1}], ' ') END AS g FROM w, range(1, greatest(len(w) - {words - 1}, least(len(w), 1)) + 1) t(i)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
z AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT a, b FROM z UNION SELECT r.a, z.b FROM r JOIN z ON r.b = z.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, coalesce(least(min(r.b), d.doc_id), d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id"""
