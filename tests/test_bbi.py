"""bigWig and bigBed files that are made here, read by their index."""

import math
import random
import struct
import zlib

import pytest

from strandlake.operators import tracks as tr
from strandlake.sources import bbi


def write_track(path, contigs, blocks, magic=bbi.BIGWIG, order="<", packed=True, fan=3):
    """A file of contigs {name: size} and blocks (contig number, start, end, bytes), its index a tree of `fan` children a node."""
    out = bytearray(64)
    width, at_contigs = max(map(len, contigs)), len(out)
    out += struct.pack(order + "IIIIQQ", bbi.CONTIGS, len(contigs), width, 8, len(contigs), 0)
    out += struct.pack(order + "BBH", 1, 0, len(contigs))
    for k, (name, size) in enumerate(contigs.items()):
        out += name.encode().ljust(width, b"\0") + struct.pack(order + "II", k, size)
    at_data, items = len(out), []
    out += struct.pack(order + "Q", len(blocks))
    for number, start, end, data in blocks:
        data = zlib.compress(data) if packed else data
        items.append((number, start, number, end, len(out), len(data)))
        out += data
    at_index = len(out)
    out += struct.pack(order + "IIQIIIIQII", bbi.INDEX, fan, len(items), *(items[0][:2] if items else (0, 0)), *(items[-1][2:4] if items else (0, 0)), at_index, 1, 0)
    groups = [items[k : k + fan] for k in range(0, len(items), fan)] or [[]]
    levels = [[("leaf", g) for g in groups]]
    while len(levels[0]) > 1:
        below = levels[0]
        levels.insert(0, [("node", below[k : k + fan]) for k in range(0, len(below), fan)])

    def span(node):
        rows = [span(x) for x in node[1]] if node[0] == "node" else [x[:4] for x in node[1]]
        return (*min(r[:2] for r in rows), *max(r[2:] for r in rows))

    size = lambda node: 4 + len(node[1]) * (24 if node[0] == "node" else 32)
    at, places = len(out), {}
    for level in levels:
        for node in level:
            places[id(node)] = at
            at += size(node)
    for level in levels:
        for kind, inner in level:
            out += struct.pack(order + "BBH", kind == "leaf", 0, len(inner))
            for x in inner:
                out += struct.pack(order + "IIIIQQ", *x) if kind == "leaf" else struct.pack(order + "IIIIQ", *span(x), places[id(x)])
    out[:64] = struct.pack(order + "IHHQQQHHQQIQ", magic, 4, 0, at_contigs, at_data, at_index, 0, 0, 0, 0, 1 << 15 if packed else 0, 0)
    path.write_bytes(bytes(out))


def scored_blocks(order="<"):
    """Blocks of all three kinds, and the rows that they hold."""
    r, blocks, rows = random.Random(5), [], []
    for number, name in enumerate(("chr1", "2", "chrX")):
        at = 0
        for k in range(20):
            kind = k % 3 + 1
            values = [r.choice([0.25, 1.0, 0.5, float("nan")]) for _ in range(r.randint(1, 9))]
            step, span, start = r.randint(3, 9), r.randint(1, 3), at
            body = b""
            for v in values:
                if kind == bbi.BEDGRAPH:
                    end = at + r.randint(1, 6)
                    body += struct.pack(order + "IIf", at, end, v)
                    rows.append((name, at, end, v))
                    at = end + r.randint(0, 2)
                else:
                    body += struct.pack(order + "If", at, v) if kind == bbi.VARIABLE else struct.pack(order + "f", v)
                    rows.append((name, at, at + span, v))
                    at += step
            end = rows[-1][2]
            blocks.append((number, start, end, struct.pack(order + "IIIIIBBH", number, start, end, step if kind == bbi.FIXED else 0, span if kind != bbi.BEDGRAPH else 0, kind, 0, len(values)) + body))
    return blocks, rows


@pytest.mark.parametrize(("order", "packed", "fan"), [("<", True, 3), (">", False, 2), ("<", False, 256)])
def test_scores(spark, tmp_path, order, packed, fan):
    blocks, rows = scored_blocks(order)
    size = {"chr1": 2000, "2": 2000, "chrX": max(e for c, _, e, _ in rows if c == "chrX") - 1}  # its last run reaches past its end
    write_track(tmp_path / "t.bw", size, blocks, order=order, packed=packed, fan=fan)
    want = sorted((c, s, min(e, size[c]), 0.0 if math.isnan(v) else v) for c, s, e, v in rows if s < min(e, size[c]))
    df = bbi.track(spark, str(tmp_path / "t.bw"))
    assert sorted(map(tuple, df.collect())) == want
    part = bbi.track(spark, str(tmp_path / "t.bw"), chroms=["2"], low=60, high=120)
    assert sorted(map(tuple, part.collect())) == [x for x in want if x[0] == "2" and x[1] < 120 and x[2] > 60]
    assert bbi.track(spark, str(tmp_path / "t.bw"), chroms=["none"]).count() == 0
    assert {(r["chrom"], r["start"]) for r in tr.passing(df, 0.5).collect()} == {x[:2] for x in want if x[3] >= 0.5}


def test_only_the_blocks_of_a_range_are_read(tmp_path):
    blocks, rows = scored_blocks()
    write_track(tmp_path / "t.bw", {"chr1": 9999, "2": 9999, "chrX": 9999}, blocks)
    reader = bbi._Pushed([str(tmp_path / "t.bw")], bbi.Wanted(), 4, True)
    filters = [bbi.EqualTo(("chrom",), "2"), bbi.LessThan(("start",), 120), bbi.GreaterThan(("end",), 60)]
    assert reader.pushFilters(filters) == filters and reader.wanted == bbi.Wanted(frozenset("2"), 60, 120)
    track = bbi.Track(str(tmp_path / "t.bw"))
    found = [x for p in reader.partitions() for b in bbi.rows(track, p.nodes, reader.wanted) for x in zip(*(c.to_pylist() for c in b.columns))]
    needed = [b for b in blocks if b[0] == 1 and b[1] < 120 and b[2] > 60]
    assert track.blocks_read == len(needed) < len(blocks) / 4
    assert {x[:3] for x in found} >= {x[:3] for x in rows if x[0] == "2" and x[1] < 120 and x[2] > 60}
    for name, op, x, want in (("end", bbi.GreaterThanOrEqual, 60, (59, bbi.FAR)), ("start", bbi.GreaterThan, 60, (60, bbi.FAR)), ("start", bbi.LessThanOrEqual, 60, (0, 61)), ("end", bbi.LessThanOrEqual, 60, (0, 60)), ("start", bbi.EqualTo, 60, (60, 61))):
        got = bbi.Wanted().narrowed([op((name,), x)])
        assert (got.low, got.high) == want
    assert len(bbi._Reader([str(tmp_path / "t.bw")], bbi.Wanted(), 4, True).partitions()) == 4
    whole = bbi._Reader([str(tmp_path / "t.bw")], bbi.Wanted(), 1000, True)
    assert sum(1 for p in whole.partitions() for _ in track.blocks(p.nodes[0], whole.wanted)) == len(blocks)


def test_filters_that_spark_pushes(spark, tmp_path):
    blocks, rows = scored_blocks()
    write_track(tmp_path / "t.bw", {"chr1": 9999, "2": 9999, "chrX": 9999}, blocks)
    spark.dataSource.register(bbi.BigWig)
    key = "spark.sql.python.filterPushdown.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        for condition, test in (("chrom IN ('chrX', 'none') AND start >= 100", lambda x: x[0] == "chrX" and x[1] >= 100), ("chrom = '2' AND start < 120 AND end > 60", lambda x: x[0] == "2" and x[1] < 120 and x[2] > 60), ("chrom = 'none'", lambda x: False)):
            assert spark.read.format("bigwig").option("push", "true").load(str(tmp_path / "t.bw")).where(condition).count() == sum(map(test, rows))
    finally:
        spark.conf.set(key, old)


def test_entries(spark, tmp_path):
    r, blocks, rows = random.Random(2), [], []
    for number, name in enumerate(("a", "bb")):
        for k in range(15):
            own = [(number, 40 * k + j, 40 * k + j + r.randint(1, 50), f"n{j}\t{k}" if j else "") for j in range(4)]
            rows += [(name, s, min(e, 600), t) for _, s, e, t in own]
            blocks.append((number, own[0][1], max(x[2] for x in own), b"".join(struct.pack("<III", *x[:3]) + x[3].encode() + b"\0" for x in own)))
    write_track(tmp_path / "t.bb", {"a": 600, "bb": 600}, blocks, bbi.BIGBED)
    df = bbi.track(spark, str(tmp_path / "t.bb"), bbi.BigBed)
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    assert df.where("chrom = 'bb' AND end > 300").count() == sum(x[0] == "bb" and x[2] > 300 for x in rows)
    with pytest.raises(Exception, match="other kind"):
        bbi.track(spark, str(tmp_path / "t.bb")).collect()


def test_what_is_no_track(tmp_path):
    (tmp_path / "x").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="neither"):
        bbi.Track(str(tmp_path / "x"))
    blocks, _ = scored_blocks()
    write_track(tmp_path / "t.bw", {"chr1": 9999, "2": 9999, "chrX": 9999}, blocks)
    (tmp_path / "cut").write_bytes((tmp_path / "t.bw").read_bytes()[:150])
    with pytest.raises(ValueError, match="early"):
        bbi.Track(str(tmp_path / "cut"))
