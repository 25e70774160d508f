"""Whole runs: masked genomes and their annotations, published together or not at all."""

import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from test_annotation import EXTRA, LINES, PAR, SIZES, Y

from strandlake.jobs import releases
from strandlake.operators import annotation as an
from strandlake.operators import masking as ma
from strandlake.operators import sequences as sq
from strandlake.operators import validate as va
from strandlake.sources import formats

BED = "chrom string, start long, end long, name string"


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "1024")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _inputs(spark, tmp_path):
    lines = [f"{s}\tsrc\t{f}\t{a}\t{b}\t.\t{st}\t.\t{at}" for s, f, a, b, st, at in LINES]
    (tmp_path / "in.gtf").write_text("#!build 1\n" + "\n".join(lines) + "\n")
    return lines, spark.createDataFrame(SIZES, "chrom string, raw_bp long"), spark.createDataFrame(PAR, BED), spark.createDataFrame(EXTRA, BED)


def test_annotation_run(spark, tmp_path):
    lines, genome, par, extra = _inputs(spark, tmp_path)
    out = tmp_path / "out"
    out.mkdir()
    rules = releases.Rules(y_key=Y, facts={"assembly": "A1"})
    said = releases.annotation(spark, str(tmp_path / "in.gtf"), genome, par, extra, str(out), "A1", rules=rules)
    assert sorted(os.listdir(out)) == sorted(f"A1.{v}.{x}" for v in said for x in ("gtf.gz", "t2g.tsv", "dropped_genes.tsv", "metadata.json", "gtf.gz.md5"))
    features = formats.gtf(spark, str(tmp_path / "in.gtf"))
    for variant, facts in said.items():
        masks = ma.variant_mask(variant, par, extra, genome, Y)
        f = an.parsed(features)
        kept = sorted(r["line_no"] for r in an.kept_by_gene(an.judged(f, an.classify(f, masks, genome, "drop"), masks, "any", Y)).collect())
        text = gzip.open(out / f"A1.{variant}.gtf.gz", "rt").read().splitlines()
        assert [x for x in text if not x.startswith("#")] == [lines[k - 2] for k in kept] and text[0] == "#!build 1"
        meta = json.loads((out / f"A1.{variant}.metadata.json").read_text())
        assert meta["features_out"] == len(kept) == facts["features_out"] == meta["features_predicted"] and meta["assembly"] == "A1" and meta["features_in"] == len(LINES)
        md5 = hashlib.md5((out / f"A1.{variant}.gtf.gz").read_bytes()).hexdigest()
        assert (out / f"A1.{variant}.gtf.gz.md5").read_text() == f"{md5}  A1.{variant}.gtf.gz\n" and meta["output_md5"] == md5
        gone = (out / f"A1.{variant}.dropped_genes.tsv").read_text().splitlines()
        assert len(gone) - 1 == facts["genes_dropped_by_mask"] + facts["genes_dropped_off_genome"]
    assert said["XX"]["y_out"] == 0 < said["XY"]["y_out"]
    with pytest.raises(FileExistsError):
        releases.annotation(spark, str(tmp_path / "in.gtf"), genome, par, extra, str(out), "A1", ("XY",), rules)


def test_a_run_that_disagrees_leaves_nothing(spark, tmp_path, monkeypatch):
    _, genome, par, extra = _inputs(spark, tmp_path)
    out = tmp_path / "out"
    out.mkdir()
    plain = an.predicted
    monkeypatch.setattr(an, "predicted", lambda j, unit: plain(j, unit).withColumn("n_predicted", F.col("n_predicted") - 1))
    with pytest.raises(releases.Disagrees, match="written"):
        releases.annotation(spark, str(tmp_path / "in.gtf"), genome, par, extra, str(out), "A1", ("XX",), releases.Rules(y_key=Y))
    assert os.listdir(out) == []
    monkeypatch.setattr(an, "predicted", plain)
    monkeypatch.setitem(an.UNITS, "gene", lambda j: j.where("NOT coalesce(contig_key = 'X', false)"))  # a unit that loses X and keeps the mask
    with pytest.raises(releases.Disagrees, match="of X before"):
        releases.annotation(spark, str(tmp_path / "in.gtf"), genome, par, extra, str(out), "A1", ("XX",), releases.Rules(y_key=Y))
    assert os.listdir(out) == []


@pytest.mark.parametrize("rules", [{"partial": "fail"}, {"unknown": "fail"}, {"par_status": "approximate"}])
def test_policies_refuse_a_run(spark, tmp_path, rules):
    _, genome, par, extra = _inputs(spark, tmp_path)
    out = tmp_path / "out"
    out.mkdir()
    with pytest.raises(ValueError):
        releases.annotation(spark, str(tmp_path / "in.gtf"), genome, par, extra, str(out), "A1", ("XY-noYPAR",), releases.Rules(y_key=Y, **rules))
    assert os.listdir(out) == []


CONTIGS = {"chr9": 4000, "chrY": 2500, "scaffold": 303}


def _fasta(path, contigs=CONTIGS):
    path.write_text("".join(f">{c} some note\n" + "".join("ACGTNCGTAC"[: min(10, n - k)] + "\n" for k in range(0, n, 10)) for c, n in contigs.items()))


def test_lines_keep_their_place(spark, tmp_path, small_splits):
    text = "ACG\n\n>a one\nACGT  \n\nAC\n>\nGG\n>b\tx\n" + "ACGTACGTAC\n" * 700 + ">c\n>d\nA"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.fa").write_text(text)
    _fasta(tmp_path / "in" / "y.fa")
    placed = formats.placed_fasta(spark, str(tmp_path / "in"))
    assert placed.select("path", "part").distinct().count() > 8
    want, contig, offset = [], None, 0
    for name in ("x.fa", "y.fa"):
        contig, offset = None, 0
        for k, line in enumerate((tmp_path / "in" / name).read_text().splitlines(), 1):
            line = line.rstrip()
            if line.startswith(">"):
                contig, offset = (line[1:].split() or [""])[0], 0
                want.append((name, k, contig, 0, None))
            elif line:
                want.append((name, k, contig, offset, line))
                offset += len(line)
    got = [(r["path"].rsplit("/", 1)[1], r["line_no"], r["contig"], r["offset"], r["seq"]) for r in placed.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()


def test_masks_by_lookup_and_by_shuffle(spark, tmp_path):
    _fasta(tmp_path / "a.fa")
    lines = formats.placed_fasta(spark, str(tmp_path / "a.fa")).where("seq IS NOT NULL").select("contig", "line_no", "offset", "seq")
    masks = spark.createDataFrame([("chr9", 0, 3), ("chr9", 5, 12), ("chr9", 11, 30), ("chr9", 3995, 9999), ("chrY", 2000, -1), ("none", 0, 5), ("scaffold", 7, 7)], "contig string, start long, end long")
    one, two = (sorted(map(tuple, sq.masked_in_place(lines, masks, most).select("contig", "line_no", "seq").collect())) for most in (100, 0))
    assert one == two and one[0] == ("chr9", 2, "NNNTNNNNNN") and sum(x[2].count("N") for x in one if x[0] == "chrY") == 500 + 200


@pytest.mark.parametrize("complement", ["XX", "XY"])
def test_genome_run(spark, tmp_path, small_splits, complement):
    _fasta(tmp_path / "in.fa")
    out = tmp_path / "out"
    out.mkdir()
    par, extra = spark.createDataFrame([("y", 5, 15, "P")], BED), spark.createDataFrame([("9", 3995, 9999, "tail")], BED)
    said = releases.genome(spark, str(tmp_path / "in.fa"), complement, par, extra, str(out), "A1", only=["9", "Y"])
    masks = [("chr9", 3995, 4000)] + ([("chrY", 5, 15)] if complement == "XY" else [("chrY", 0, 2500)])
    want = []
    for c in ("chr9", "chrY"):
        bases = list("ACGTNCGTAC" * (CONTIGS[c] // 10))
        for k, s, e in masks:
            if k == c:
                bases[s:e] = "N" * (e - s)
        want += [f">{c}", *("".join(bases[k : k + 10]) for k in range(0, len(bases), 10))]
    assert gzip.open(out / f"A1.{complement}.fa.gz", "rt").read().splitlines() == want
    assert (out / f"A1.{complement}.chrom.sizes").read_text() == "chr9\t4000\nchrY\t2500\n"
    assert [x.split("\t")[:3] for x in (out / f"A1.{complement}.masked.bed").read_text().splitlines()] == [[c, str(s), str(e)] for c, s, e in masks]
    assert said["n_bases"] == sum(x.count("N") for x in want if x[0] != ">") and said["bases"] == 6500 and said["contigs"] == 2
    assert json.loads((out / f"A1.{complement}.metadata.json").read_text())["output_md5"] == hashlib.md5((out / f"A1.{complement}.fa.gz").read_bytes()).hexdigest()


def test_genome_runs_that_are_refused(spark, tmp_path, monkeypatch):
    _fasta(tmp_path / "in.fa", {"chr9": 40})
    out = tmp_path / "out"
    out.mkdir()
    none = spark.createDataFrame([], BED)
    with pytest.raises(va.Refused, match="no contig Y"):
        releases.genome(spark, str(tmp_path / "in.fa"), "XX", none, none, str(out), "A1")
    plain = sq.masked_in_place
    calls = []

    def wrong(lines, masks):
        calls.append(1)
        return lines if len(calls) == 1 else plain(lines, masks)  # what is written isn't masked

    monkeypatch.setattr(sq, "masked_in_place", wrong)
    with pytest.raises(releases.Disagrees, match="predicted"):
        releases.genome(spark, str(tmp_path / "in.fa"), "XY", none, spark.createDataFrame([("9", 0, 9, "x")], BED), str(out), "A1")
    assert os.listdir(out) == []
