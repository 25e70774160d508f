"""Listing and digests of release folders, and ordered single files."""

import gzip
import hashlib
import os
import random

import pytest

from strandlake.sources import onefile, release, sinks


def test_digests_of_packed_streams():
    r = random.Random(4)
    text = bytes(r.choice(b"ACGT\n") for _ in range(300_000))
    md5 = hashlib.md5(text).hexdigest()
    big = b"\0" * 5_000_000
    cases = {
        text: md5, b"": hashlib.md5(b"").hexdigest(), gzip.compress(text): md5, gzip.compress(text[:7]) + gzip.compress(b"") + gzip.compress(text[7:]): md5, gzip.compress(text) + b"\0" * 600: md5,
        gzip.compress(text)[:-9]: None, gzip.compress(text)[:3000] + b"xx" + gzip.compress(text)[3002:]: None, b"\x1f\x8b": None, gzip.compress(big): hashlib.md5(big).hexdigest(),
    }
    for data, want in cases.items():
        for size in (1, 1000, 1 << 20):
            at = [0]

            def read(n, data=data, size=size, at=at):
                at[0] += min(n, size)
                return data[at[0] - min(n, size) : at[0]]

            if size > 1 or len(data) < 20_000:
                assert release.digests(read) == (len(data), hashlib.md5(data).hexdigest(), hashlib.sha256(data).hexdigest(), want)


def test_a_release_folder(spark, tmp_path):
    data = os.urandom(5000)
    for name in ("refs/a b.fa", "refs/é#%20?.fa", "map/x.genmap_index/big.bin", "map/sub/y.gtf.gz", "map/y.fa.fai", "map/run.log", "refs/A.metadata.json", "x.genmap_index.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    huge = tmp_path / "map" / "huge.bw"
    with huge.open("wb") as f:
        f.truncate((2 << 30) + 11)  # sparse; more than a cell can hold
    rows = {r["filename"]: r for r in release.files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a b.fa", "é#%20?.fa", "y.gtf.gz", "A.metadata.json", "x.genmap_index.txt", "huge.bw"}
    md5 = hashlib.md5(data).hexdigest()
    assert {rows[n]["content_md5"] for n in ("a b.fa", "é#%20?.fa", "y.gtf.gz")} == {md5} != {rows["y.gtf.gz"]["md5"]}
    assert rows["huge.bw"]["bytes"] == (2 << 30) + 11 and rows["huge.bw"]["md5"] == rows["huge.bw"]["content_md5"]
    assert [n for n, r in rows.items() if r["content"] is not None] == ["A.metadata.json"] and bytes(rows["A.metadata.json"]["content"]) == data
    sinks.checksums(spark.createDataFrame([(r["filename"], r["md5"]) for r in rows.values() if r["filename"] != "huge.bw"], "filename string, md5 string"), str(tmp_path / "sums"))
    assert (tmp_path / "sums").read_text().splitlines()[0] == f"{md5}  A.metadata.json"


def test_skipped_folders_are_not_read(spark, tmp_path):
    (tmp_path / "k.genmap_index").mkdir()
    (tmp_path / "k.genmap_index" / "big").write_bytes(b"x" * 5000)
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "f").write_bytes(b"y" * 5000)
    key = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(key, "1000")
    try:
        assert [r["filename"] for r in release.files(spark, str(tmp_path)).collect()] == ["f"]
        assert release.listed(spark, str(tmp_path), ("own", "x*")).count() == 1
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_one_file_for_any_partitions(spark, tmp_path, compression):
    r = random.Random(7)
    lines = [(k // 100, k, "".join(r.choice("äbc ") for _ in range(r.randint(0, 30)))) for k in range(5000)]
    r.shuffle(lines)
    df = spark.createDataFrame(lines, "block long, at long, value string")
    found = set()
    for n in (1, 7, 50):
        path = tmp_path / f"out{n}"
        onefile.written(df.repartition(3), str(path), ["block"], ["at"], compression, partitions=n)
        found.add(path.read_bytes())
        with (gzip.open(path, "rt") if compression else path.open()) as f:
            assert f.read() == "".join(f"{v}\n" for _, _, v in sorted(lines, key=lambda x: x[1]))
    assert len(found) == 1
    assert sorted(os.listdir(tmp_path)) == ["out1", "out50", "out7"]  # no parts stay
    with pytest.raises(Exception, match="exists"):
        onefile.written(df, str(tmp_path / "out1"), ["block"], ["at"], compression)
    onefile.written(df.limit(0), str(tmp_path / "out1"), ["block"], ["at"], compression, force=True)
    assert (tmp_path / "out1").read_bytes() == b""


def test_nothing_is_left_of_a_write_that_fails(spark, tmp_path):
    from pyspark.sql import functions as F

    bad = spark.range(100).select(F.col("id").alias("block"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="broken"):
        onefile.written(bad, str(tmp_path / "out"), ["block"], [], partitions=5)
    assert os.listdir(tmp_path) == []
