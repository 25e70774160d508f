"""Operators on whole corpora, against brute force on small ones."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandlake.llm import linededup, mixing, ngramjoin, sharding, suffixes

BLANKS = " \t\n\x0b\x0c\r"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "src0" if k % 3 else None, "clash") for k, r in enumerate(rows)], "doc_id long, text string, source string, words string")


def _lines(rows):
    where = {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(BLANKS).translate(lower)
            if len(key) >= 40:
                where.setdefault(key, set()).add(i)
    out = []
    for i, t in rows:
        kept, n = [], (t or "").split("\n")
        for line in n:
            key = line.strip(BLANKS).translate(lower)
            if len(where.get(key, ())) < 5 or i == max(where[key]):
                kept.append(line)
        out.append((i, len(n), len(n) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_lines_by_brute_force(spark):
    r = random.Random(2)
    common = [f"This LINE number {k} is shared by many of the documents" for k in range(4)] + ["short"]
    rows = [(i, "\n".join(r.choice([r.choice(common), "  " + r.choice(common).lower() + "\t", "", f"own {i} {r.random()}"]) for _ in range(r.randint(0, 150)))) for i in range(40)]
    rows += [(100, None), (101, ""), rows[3], (50, "\n" * 200)]
    assert sorted(map(tuple, linededup.digests(_frame(spark, rows)).collect())) == _lines(rows)
    assert linededup.digests(_frame(spark, rows).limit(0)).count() == 0


def test_same_id_other_text(spark):
    line = "a line that is long enough to be looked at by the operator"
    rows = [(i, f"{line}\nx{i}") for i in range(5)] + [(2, f"y\ny\n{line}")]
    out = linededup.applied(_frame(spark, rows), linededup.keep_bitmaps(_frame(spark, rows)))
    assert sorted(r["text"] for r in out.where("doc_id = 2").collect()) == ["x2", "y\ny"]
    assert out.columns == ["doc_id", "text", "source", "words", "n_lines", "n_dropped"]


def _components(rows, words, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append((i, {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * len(sets[a][1] | sets[b][1]):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(i, least.get(root(k), i))
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize(("words", "percent", "tile"), [(3, 90, 1024), (3, 90, 3), (2, 60, 2), (5, 80, 1024)])
def test_components_by_brute_force(spark, words, percent, tile, monkeypatch):
    monkeypatch.setattr(ngramjoin, "TILE", tile)
    r = random.Random(words * percent)
    vocabulary = [f"w{k}" for k in range(40)]
    rows = []
    for family in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 30, 90, 400]))]
        for _ in range(r.randint(1, 7)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((len(rows) * 7 % 1000, "  ".join(x.upper() if r.random() < 0.1 else x for x in copy)))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "w1"), (2004, "W1")]
    got = ngramjoin.joined(_frame(spark, rows), words, percent)
    assert sorted(map(tuple, got.collect())) == _components(rows, words, percent)


def test_one_of_each(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = _frame(spark, [(5, text), (3, text + " more"), (9, "other words here that nobody else has at all"), (10, None), (11, "")])
    assert sorted(r["doc_id"] for r in ngramjoin.one_of_each(docs).collect()) == [3, 9, 10, 11]
    assert ngramjoin.joined(docs.limit(0)).count() == 0


def _spans(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                cover[k : k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[i] = (len(b), sum(cover), sum(1 for j in range(len(b)) if cover[j] and (j == 0 or not cover[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "crowd"), [(8, 20_000), (8, 1), (20, 2), (100, 20_000), (3, 20_000)])
def test_repeats_by_brute_force(spark, length, crowd, monkeypatch):
    r = random.Random(length)
    pool = ["".join(r.choice("abé") for _ in range(r.randint(1, 4 * length))) for _ in range(6)]
    rows = [(i * 3, "".join(r.choice([*pool, "".join(r.choice("abcdefgh") for _ in range(length))]) for _ in range(r.randint(0, 9)))) for i in range(30)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 5 * length), (1003, "ab" * 4 * length), (1004, rows[2][1])]
    plain = suffixes.repeats
    monkeypatch.setattr(suffixes, "repeats", lambda d, n: plain(d, n, crowd))
    got = {r[0]: tuple(r[1:]) for r in suffixes.digests(_frame(spark, rows), length).collect()}
    assert got == _spans(rows, length)


def test_long_texts_are_cut(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    r = random.Random(12)
    shared = "".join(r.choice("abcé") for _ in range(900))
    rows = [(k, "".join(r.choice("xyz") for _ in range(r.randint(0, 500))) + shared[r.randint(0, 200) :] + "q" * k) for k in range(6)]
    got = {x[0]: tuple(x[1:]) for x in suffixes.digests(_frame(spark, rows), 40).collect()}
    assert got == _spans(rows, 40)


def test_memory_of_a_very_long_text():
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(3)
    text = r.integers(97, 123, 20_000_000, np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc", "text"])
    tracemalloc.start()
    assert sum(len(b) for b in suffixes._cells(100, 16)(iter([batch]))) > 1000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 500_000_000


def test_repeated_rows_and_ids(spark):
    rows = [(1, "abcdefghij" * 30), (1, "abcdefghij" * 30), (None, "0123456789" * 30), (2, "0123456789" * 30)]
    out = suffixes.digests(_frame(spark, rows), 100).collect()
    assert len(out) == 4 and {r["n_removed"] for r in out if r["doc_id"] == 1} == {290} and [r["n_removed"] for r in out if r["doc_id"] == 2] == [300]
    assert suffixes.digests(_frame(spark, rows).limit(0), 100).count() == 0


def test_suffix_arrays():
    for seed in range(200):
        r = random.Random(seed)
        t = bytes(r.choice(b"ab" if seed % 3 else b"abc\x00\xff") for _ in range(r.randint(1, 90))) if seed % 5 else b"aab" * r.randint(1, 30)
        assert suffixes.suffix_array(np.frombuffer(t, np.uint8), len(t) + 8).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_mixture(spark):
    r = random.Random(8)
    rows = [(i, r.choice(["a"] * 6 + ["b", "c", None, "d"])) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumnRenamed("doc_id", "doc_id")
    weights, others, size = {"a": 5, "b": 3}, 4, 4
    out = mixing.scheduled(docs, weights, others, size).collect()
    assert sorted(x["doc_id"] for x in out) == list(range(700))
    blocks = {}
    for x in out:
        blocks.setdefault(x["slot"], set()).add((x["component"], x["block"]))
        assert x["release"] <= x["slot"] < x["deadline"]
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())
    order = [next(iter(blocks[t]))[0] for t in range(len(blocks))]
    total, left, counts = sum(weights.values()) + others, Counter(order), Counter()
    for t, c in enumerate(order, 1):
        counts[c] += 1
        if all(counts[k] + a <= left[k] for k, a in {**weights, "*": others}.items()):  # while each has a whole frame left
            assert all(abs(counts[k] - t * a / total) < 1 for k, a in {**weights, "*": others}.items())
    assert mixing.scheduled(docs.limit(0), weights, others).count() == 0
    again = mixing.mixed(docs, weights, others, block_rows=size)
    assert again.columns == ["doc_id", "source"] and again.count() == 700


def test_shards(spark):
    r = random.Random(9)
    rows = [(i, r.choice(["x", "", None]), r.choice(["a"] * 5 + ["b", None]), 0) for i in range(333)] + [(5, "x", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    out = sharding.sharded(docs, 8, bucket_bits=3).collect()
    sizes = Counter(x["shard"] for x in out)
    assert len(out) == 334 and max(sizes.values()) - min(sizes.values()) <= 1
    for k in range(8):
        assert sorted(x["slot"] for x in out if x["shard"] == k) == list(range(sizes[k]))
    share = Counter(s for _, _, s, _ in rows)
    at = {i: s for i, _, s, _ in rows}
    for k in range(8):
        for s in share:
            here = sum(at[x["doc_id"]] == s for x in out if x["shard"] == k)
            assert abs(here - share[s] / 8) <= 2
    assert sharding.sharded(docs.limit(0)).count() == 0


def test_pipeline_by_stages(spark):
    import os

    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        after[name] = docs.collect()
    ids = lambda name: {r["doc_id"] for r in after[name]}
    before = [(r["doc_id"], r["text"]) for r in after["quality"]]
    lines = {i: s for i, _, _, s in _lines(before)}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in after["line_dedup"]} == lines
    assert ids("near_duplicates") == {i for i, _, c in _components([(r["doc_id"], r["text"]) for r in after["line_dedup"]], 5, 80) if i == c}
    assert ids("mixture") == ids("near_duplicates") == ids("tokens")
    import public_tokenizers
    import tiktoken

    from strandlake.llm import bpe

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in after["mixture"]}
    assert all(list(r["token_ids"]) == coder.encode_ordinary(texts[r["doc_id"]]) for r in after["tokens"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = [labels[i] for i in ids("quality") if i in labels]
    assert sum(kept) == sum(labels.values()) and len(kept) - sum(kept) <= 0.1 * len(labels)


def test_tokens_carry_the_mixture(spark):
    from pyspark.sql import functions as F

    import corpus_pipeline as pipeline

    r = random.Random(4)
    docs = spark.createDataFrame([(i, f"text {i}", r.choice(["src0", "src0", "src1", "src2", "x", None])) for i in [*range(300), None]], "doc_id long, text string, source string")
    want = mixing.scheduled(docs.select("doc_id", "source"), pipeline.WEIGHTS, pipeline.OTHERS, pipeline.MIX_BLOCK, pipeline.MIX_SEED)
    mixed = pipeline.mixture(spark, docs, "").repartition(7, F.hash("text"))  # read back in any order
    got = pipeline.tokens(spark, mixed, "").collect()
    assert {(x["doc_id"], x["slot"], x["seq"]) for x in got} == {(x["doc_id"], x["slot"], x["seq"]) for x in want.collect()} and len(got) == 301
    order = [x["doc_id"] for x in sorted(got, key=lambda x: (x["slot"], x["seq"]))]
    assert order == [x["doc_id"] for x in pipeline.mixture(spark, docs, "").collect()]


def test_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as pipeline

    line = "a line that is long enough to be looked at, and many hold it"
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    schema = "doc_id long, text string, lang string, source string, n_chars long, slot string, copies int, n_lines int"
    rows = [(k, f"{line}\nown {k} " + " ".join(f"x{k}y{j}" for j in range(40)), "en", "src0", 0, "clash", 1, 2) for k in range(8)]
    rows += [(20, None, None, None, None, None, None, None), (21, "", "en", "src1", 0, "", 0, 0), (None, "some text of no id", "en", "src2", 0, "", 0, 0), (22, long, "de", "x", 0, "", 0, 0), (23, long, "de", "x", 0, "", 0, 0)]
    rows += [rows[3], (4, "another text of a taken id", "en", "src0", 0, "", 0, 0)]
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if name != "tokens":
            assert out.columns == docs.columns
        got = [r.asDict() for r in out.collect()]
        ids = [r["doc_id"] for r in got]
        if name == "quality":
            assert len(got) == len(rows)
        elif name == "line_dedup":
            assert len(got) == len(rows) and {r["doc_id"] for r in got if line in (r["text"] or "")} == {7} and [r["text"] for r in got if r["doc_id"] == 20] == [None]
        elif name == "near_duplicates":
            assert sorted(ids, key=str) == sorted([*range(8), 4, 20, 21, 22, None], key=str)  # 23 is a copy of 22; of the two rows 3 one stays
        else:
            assert len(got) == len(rows)
            if name == "tokens":
                assert {r["doc_id"] for r in got if not r["token_ids"]} == {20, 21} and all(r["slot"] is not None for r in got)


#: Names that operators and stages give to columns of their own.
INNER = ["_row", "_id", "_text", "_bucket", "_key", "_n", "_at", "_ahead", "_word", "_slot", "_bits", "_maybe", "_version", "_v", "_words", "_lines", "_kept", "_cs", "_a", "_firsts", "_frame", "_i", "_first", "_start", "_c", "_f", "_release",
         "_deadline", "_source", "_piece", "_all", "_pos", "_label", "_s", "id", "version", "name", "cid", "n", "main", "parity", "band", "counted", "heads", "tok", "df", "key", "label", "least", "component", "block", "seq", "release", "deadline", "rank", "group_rows", "maybe", "SLOT", "rows", "t", "d", "s", "a", "b"]


def test_columns_with_inner_names(spark, tmp_path):
    """No column of the input, whatever its name, makes a stage or operator fail or is changed by it."""
    import corpus_pipeline as pipeline

    from pyspark.sql import functions as F

    line = "a line that is long enough to be looked at, and many hold it"
    rows = [(k, f"{line}\nown {k} " + " ".join(f"x{k % 5}y{j}" for j in range(40)), "en", "src0", 0) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in INNER))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for given in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, given, str(tmp_path))
            got = out.collect()
            if name != "tokens":
                assert out.columns == docs.columns
                assert all(r[c] == f"{c}{r['doc_id']}" for r in got for c in INNER), name
        new = {"component", "block", "slot", "seq", "release", "deadline"}
        for out in (mixing.scheduled(given, {"src0": 2}, 1), linededup.applied(given, linededup.keep_bitmaps(given))):
            assert all(r[c] == f"{c}{r['doc_id']}" for r in out.collect() for c in INNER if c.lower() not in new)


def test_one_of_each_by_id_and_text(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    docs = _frame(spark, [(3, a), (7, a), (7, b), (None, a), (None, "c " * 9), (9, b), (9, b)])
    left = sorted((r["doc_id"] or -1, r["text"][:1]) for r in ngramjoin.one_of_each(docs).collect())
    assert left == [(-1, "c"), (3, "a"), (7, "b")]


def test_a_large_group_of_near_copies(spark):
    """Chains of small changes, all of one component, and as many texts that share their words but don't link."""
    r = random.Random(6)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(5000):
        copy = list(base)
        copy[r.randrange(120)] = f"u{k}"
        rows.append((k, " ".join(copy)))
    apart = []
    for k in range(1500):
        copy = list(base)
        for j in range(0, 120, 12):
            copy[j] = f"v{k}_{j}"
        apart.append((10_000 + k, " ".join(copy)))
    got = {x["doc_id"]: x["component_id"] for x in ngramjoin.joined(_frame(spark, rows + apart), 3, 90).collect()}
    assert {got[k] for k, _ in rows} == {0} and all(got[k] == k for k, _ in apart)


def test_near_copies_are_candidates_few_times(spark, monkeypatch):
    """Two texts that share most shingles are not one candidate for each: neither copies of two, nor a crowd that doesn't quite link."""
    r = random.Random(8)
    rows = []
    for family, copies, changes in [*((k, 2, 1) for k in range(20)), (20, 24, 3)]:
        places = r.sample(range(5, 295, 3), copies * changes)  # no two changes touch a shingle in common
        for k in range(copies):
            words = [f"w{family}_{j}" for j in range(300)]
            for j in places[k * changes : (k + 1) * changes]:
                words[j] = f"u{len(rows)}_{j}"
            rows.append((len(rows), " ".join(words)))
    made, tiled = [], []
    run, first = type(rows_frame := _frame(spark, rows)).mapInPandas, ngramjoin._first_tiles

    def counted(self, f, schema, *more):
        out = run(self, f, schema, *more)
        if schema == "a long, b long":
            out = ngramjoin.settled(out)
            made.append((out.count(), out.distinct().count()))
        return out

    def tiles(holders):
        tiled.append(holders.where("df = 2").count())
        return first(holders)

    monkeypatch.setattr(type(rows_frame), "mapInPandas", counted)
    monkeypatch.setattr(ngramjoin, "_first_tiles", tiles)
    got = ngramjoin.joined(rows_frame, 3, 90).collect()
    assert sorted(map(tuple, got)) == _components(rows, 3, 90)
    assert len({x["component_id"] for x in got}) == 44
    later = made[1:]
    assert sum(pairs for _, pairs in later) > 50 and all(n <= 2 * pairs for n, pairs in later)
    assert tiled[0] <= 3 * 40


def test_pairs_of_crowded_tiles_are_handed_on(spark):
    """All pairs of two crowded tiles come, in pieces, and a worker holds no more than those of a tile as numbers."""
    n, held = 700, []

    class Tiles:
        repartition = sortWithinPartitions = lambda self, *_: self
        mapInPandas = lambda self, f, _: held.append(f) or self
        distinct = lambda self: self

    ngramjoin._candidates(Tiles(), 80, 1 << 40)
    one = {"i": 0, "j": 0, "side": 0, "apart": False, "n": 300, "pos": 1, "parity": bytes(32), "bits1": 1, "bits2": 1}
    rows = pd.concat([pd.DataFrame({"tok": t, "cid": range(n), "label": range(n), "before": [[]] * n} | one) for t in (4, 8)])
    tracemalloc.start()
    try:
        sizes = [len(x) for x in held[0](iter([rows]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sizes == [n * (n - 1) // 2] * 2
    assert peak < 40e6


def test_later_rounds_are_few_and_their_plans_small(spark, monkeypatch):
    """Candidates that always leave something out and always tie something still end soon."""
    crowds, plans = [], []
    tiles = ngramjoin._later_tiles

    def later(holders, labels):
        dealt = tiles(holders, labels)
        plans.append(dealt._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        return dealt

    def candidates(dealt, percent, crowd):
        crowds.append(crowd)
        whole = crowd >= 2 * ngramjoin.TILE
        n = len(crowds)
        return spark.createDataFrame([(n, n + 1)] if whole else [(n, n + 1), (None, None)], "a long, b long")

    def verified(pairs, *_):
        return pairs.select(*(F.col(c).cast("string").cast("binary").alias(c) for c in ("a", "b")))

    for name, stub in (("_later_tiles", later), ("_candidates", candidates), ("_verified", verified)):
        monkeypatch.setattr(ngramjoin, name, stub)
    rows = [(k, " ".join(f"w{j}" for j in range(60)) + f" x{k}") for k in range(12)]
    assert ngramjoin.joined(_frame(spark, rows), 3, 90).count() == 12
    assert crowds == [0, 4, 64, 1024, 16384] and max(plans) <= 2


@pytest.mark.parametrize(("words", "percent", "tile"), [(3, 60, 1024), (2, 60, 3), (3, 90, 2)])
def test_links_by_brute_force(spark, words, percent, tile):
    r = random.Random(words * percent + tile)
    rows = []
    for _ in range(5):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([30, 90, 300]))]
        for _ in range(9):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = f"w{r.randrange(400)}"
            rows.append((len(rows) * 7, " ".join(copy)))
    rows += [(2000, None), (2001, ""), (2003, "w1"), (2004, "W1"), rows[3]]
    sets = [{tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if (w := (t or "").lower().split()) else set() for _, t in rows]
    want = [(i, len(s), sum(bool(s & z) and 100 * len(s & z) >= percent * len(s | z) for k, z in enumerate(sets) if k != j)) for j, ((i, _), s) in enumerate(zip(rows, sets))]
    got = ngramjoin.linked(_frame(spark, rows), words, percent, tile).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["n_links"]) for x in got) == sorted(want)
    assert sorted(tuple(x)[:3] for x in got) == _components(rows, words, percent)
    assert max(n for _, _, n in want) > 2
