"""The annotation and masking operators against a plain loop over the lines of a small invented annotation."""

import pytest

from strandlake.operators import annotation as an
from strandlake.operators import masking as ma
from strandlake.sources import formats as fm
from strandlake.sources import sinks

Y = "W"  # the contig in the role of Y, and its size and that of others
SIZES = [("chr7", 40_000), ("chrX", 90_000), ("chrW", 90_000), ("MT", 900)]
PAR = [("chrX", 1_000, 20_000, "left"), ("Y", 1_000, 20_000, "left"), ("y", 80_000, 85_000, "right")]
EXTRA = [("7", 30_000, 31_000, "hub")]
#: seqname, feature, start, end, strand, attributes
LINES = [
    ("chr7", "gene", 500, 900, "+", 'gene_id "plain"; gene_name "Plain";'),
    ("chr7", "exon", 500, 600, "+", 'gene_id "plain"; transcript_id "t1"; gene_name "Plain";'),
    ("chr7", "exon", 550, 900, "+", 'gene_id "plain"; transcript_id "t1"; gene_name "Plain";'),
    ("chr7", "gene", 30_500, 30_900, "-", 'gene_id "extra"; gene "Ex"; gene_type "kind";'),  # inside an extra mask, not on Y
    ("chr7", "exon", 39_000, 45_000, "-", 'gene_id "beyond"; transcript_id "t1";'),  # past its contig; t1 again
    ("chrX", "gene", 2_000, 3_000, "+", 'gene_id "both"; gene_name "";'),  # an id that X and Y share
    ("chrX", "exon", 2_000, 2_500, "+", 'gene_id "both"; transcript_id "b";'),
    ("chrW", "gene", 2_000, 3_000, ".", 'gene_id "both"; gene_name ""; gene "other";'),
    ("chrW", "exon", 2_000, 2_500, "+", 'gene_id "both"; transcript_id "b"; gene_name "Both";'),
    ("chrW", "gene", 19_500, 21_000, "+", 'gene_id "edge"; gene_name "Edge";'),  # straddles the end of a part
    ("chrW", "exon", 20_500, 21_000, "+", 'gene_id "edge"; transcript_id "e1";'),
    ("chrW", "exon", 19_500, 19_700, "+", 'gene_id "edge"; transcript_id "e2";'),
    ("chrW", "gene", 50_000, 51_000, "+", 'gene_id "free"; ref_gene_id "both";'),
    ("chrW", "region", 81_000, 82_000, "+", 'note "no gene";'),
    ("chrW", "region", 60_000, 61_000, "+", 'note "no gene, not on a mask";'),
    ("scaffold_9", "gene", 10, 20, "+", 'gene_id "off"; gene_name "Off";'),
    ("scaffold_9", "gene", 30, 40, "+", 'note "off, without a gene";'),
]


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(k, s, "src", f, a, b, ".", st, ".", at) for k, (s, f, a, b, st, at) in enumerate(LINES, 1)]
    features = spark.createDataFrame(rows, "line_no long, seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string")
    bed = "chrom string, start long, end long, name string"
    return an.parsed(features), spark.createDataFrame(SIZES, "chrom string, raw_bp long"), spark.createDataFrame(PAR, bed), spark.createDataFrame(EXTRA, bed)


def _mask(variant):
    """By bare name: what is masked, sorted."""
    out = {"7": [(30_000, 31_000, "extra:hub")]}
    if variant == "XX":
        out[Y] = [(0, 90_000, "whole_Y_mask")]
    if variant == "XY-noYPAR":
        out[Y] = [(1_000, 20_000, "left_masked"), (80_000, 85_000, "right_masked")]
    return out


def _value(attributes, key):
    for part in attributes.rstrip(";").split("; "):
        if part.startswith(f'{key} "'):
            return part.split('"')[1]
    return None


def _loop(variant, rule, unknown):
    """Each line's (hit, partial, reason), line by line."""
    mask, sizes, out = _mask(variant), {c.removeprefix("chr"): n for c, n in SIZES}, []
    for seqname, _, start, end, _, _ in LINES:
        bare = seqname.removeprefix("chr")
        own = mask.get(bare, [])
        if bare not in sizes:
            out.append((unknown == "drop", False, "seqname_not_in_genome" if unknown == "drop" else None))
        elif own and own[0][0] == 0 and own[0][1] >= sizes[bare]:
            out.append((True, False, "whole_contig_masked"))
        else:
            found = [m for m in own if start - 1 < m[1] and end > m[0]]
            inside = [m for m in found if start - 1 >= m[0] and end <= m[1]]
            first = found[0] if found and rule == "any" else inside[0] if inside else None
            partial = bool(found) and (first not in inside if rule == "any" else found[0] not in inside)
            reason = None if first is None else "extra_mask_overlap" if first[2].startswith("extra:") or bare != Y else "y_par_overlap_partial" if partial else "y_par_overlap"
            out.append((first is not None, partial, reason))
    return out


def _judged(frames, variant, rule="any", unknown="warn"):
    features, genome, par, extra = frames
    masks = ma.variant_mask(variant, par, extra, genome, Y)
    return an.judged(features, an.classify(features, masks, genome, unknown), masks, rule, Y), masks


def _lines(df):
    return sorted(r["line_no"] for r in df.collect())


@pytest.mark.parametrize("variant", list(ma.COMPLEMENT))
@pytest.mark.parametrize("rule", ["any", "contained"])
@pytest.mark.parametrize("unknown", ["warn", "drop"])
def test_verdicts_and_what_is_kept(frames, variant, rule, unknown):
    want = _loop(variant, rule, unknown)
    j, _ = _judged(frames, variant, rule, unknown)
    got = {r["line_no"]: (r["hit"], r["partial"], r["reason"]) for r in j.collect()}
    assert [got[k] for k in range(1, len(LINES) + 1)] == want
    ids = [(x[0], _value(x[5], "gene_id") or "") for x in LINES]
    txs = [(x[0], _value(x[5], "transcript_id")) for x in LINES]
    gone = {g for g, w in zip(ids, want) if w[0]}
    assert _lines(an.kept_by_gene(j)) == [k for k, g in enumerate(ids, 1) if g not in gone]
    lost = {t for t, w in zip(txs, want) if w[0] and t[1]}
    whole = {g for g in gone if all(t in lost for t, h in zip(txs, ids) if h == g and t[1])}
    dead = {x[0] for x, w in zip(LINES, want) if w[2] in ("whole_contig_masked", "seqname_not_in_genome")}
    assert _lines(an.kept_by_transcript(j)) == [k for k, (x, g, t) in enumerate(zip(LINES, ids, txs), 1) if x[0] not in dead and g not in whole and t not in lost]
    assert _lines(an.kept_by_feature(j)) == [k for k, w in enumerate(want, 1) if not w[0]]
    for unit in ("gene", "transcript"):
        row = an.predicted(j, unit).first()
        assert row["n_in"] == len(LINES) and row["n_predicted"] == len(LINES) - sum(g in (gone if unit == "gene" else whole) for g in ids)


def test_lines_without_a_gene_go_with_their_mask(frames):
    kept = _lines(an.kept_by_gene(_judged(frames, "XY-noYPAR", unknown="drop")[0]))
    assert 14 not in kept and 15 not in kept and 17 not in kept  # the nameless gene of a seqname goes as a whole
    assert 15 in _lines(an.kept_by_feature(_judged(frames, "XY-noYPAR")[0]))


def test_reports(frames):
    j, masks = _judged(frames, "XY-noYPAR")
    kept = an.kept_by_gene(j)
    assert an.survivors_on_mask(kept, masks).count() == 0
    report = {(g["seqname"], g["gene_id"]): g for g in an.dropped_genes(j).collect()}
    assert report["chrW", "both"]["gene_name"] == "Both" and report["chrW", "both"]["strand"] == "+" and report["chrW", "edge"]["reason"] == "y_par_overlap_partial"
    assert report["chr7", "extra"]["reason"] == "extra_mask_overlap" and report["chr7", "extra"]["gene_biotype"] == "kind" and report["chrW", "edge"]["exonic_bp"] == 501 + 201
    summary = an.summary(j, kept, masks, "X", Y).first()
    assert (summary["features_in"], summary["x_in"], summary["x_out"], summary["kept_on_mask"], summary["genes_partial"]) == (len(LINES), 2, 2, 0, 1)
    assert summary["genes_dropped_by_mask"] == len(report) and not summary["identical_to_standard"]
    assert an.summary(*_judged(frames, "XX")[:1], an.kept_by_gene(_judged(frames, "XX")[0]), masks, "X", Y).first()["y_out"] == 0
    assert {r["seqname"]: (r["n_in"], r["n_out"]) for r in an.counts(j, kept).collect()}["chrX"] == (2, 2)
    features, genome, _, _ = frames
    assert [(r["seqname"], r["n_features"]) for r in an.unknown_names(features, genome).collect()] == [("scaffold_9", 2)]
    assert [r["seqname"] for r in an.out_of_range(features, genome).collect()] == ["chr7"]
    assert [r["gene_name"] for r in an.examples(an.genes(j).where("partial"), "gene_name", "gene_id", 10).collect()] == ["Edge"]
    t2g = {r["transcript_id"]: r for r in an.t2g(features).collect()}
    assert t2g["t1"]["gene_id"] == "plain" and t2g["t1"]["collision"] and not t2g["b"]["collision"]


@pytest.mark.parametrize("rule", ["any", "contained"])
def test_a_feature_is_one_point_of_the_search(frames, monkeypatch, rule):
    seen, search = [], an.iv.first_reaching
    monkeypatch.setattr(an.iv, "first_reaching", lambda points, *a, **b: seen.append(points.count()) or search(points, *a, **b))
    assert _judged(frames, "XY-noYPAR", rule)[0].count() == len(LINES)
    assert seen == [len(LINES)]


def test_survivors_are_found_without_pairs(frames, monkeypatch):
    features, genome, par, extra = frames
    masks = ma.variant_mask("XY-noYPAR", par, extra, genome, Y)
    monkeypatch.setattr(an.iv, "overlap_pairs", None)
    spans = [(c if c in ("7", "X") else Y, a, b) for c, own in _mask("XY-noYPAR").items() for a, b, _ in own]
    want = [k for k, x in enumerate(LINES, 1) if any(x[0].removeprefix("chr") == c and x[2] - 1 < b and x[3] > a for c, a, b in spans)]
    assert _lines(an.survivors_on_mask(features, masks)) == want


@pytest.mark.parametrize("variant", list(ma.COMPLEMENT))
def test_summary_by_gene_is_that_of_kept_features(frames, variant):
    j, masks = _judged(frames, variant, "any", "drop")
    by_gene, of_kept = an.summary_by_gene(j, "X", Y).first(), an.summary(j, an.kept_by_gene(j), masks, "X", Y).first()
    assert by_gene.asDict() == of_kept.asDict()


def test_plans(spark, frames):
    _, genome, par, extra = frames
    got = {tuple(r) for r in ma.applied(ma.plan("XX", par, extra, Y), genome).collect()}
    assert got == {("chrW", 0, 90_000, "whole_Y_mask"), ("chr7", 30_000, 31_000, "extra:hub")}
    assert ma.report(ma.applied(ma.plan("XY", par, extra, Y), genome)).first()["masked_bp"] == 19_000 + 5_000 + 1_000
    assert [r["chrom"] for r in ma.allowed(genome, [" 7", "chrMT", ""]).orderBy("chrom").collect()] == ["MT", "chr7"]
    with pytest.raises(ValueError):
        ma.trusted("approximate")
    ma.trusted("approximate", allow_approximate=True)
    with pytest.raises(ValueError):
        ma.plan("YY", par, extra, Y)


def test_annotation_round_trip(spark, tmp_path):
    lines = [f"{s}\tsrc\t{f}\t{a}\t{b}\t0.5\t{st}\t2\t{at}" for s, f, a, b, st, at in LINES]
    (tmp_path / "a.gtf").write_text("#!build 1\n#made up\n" + "\n".join([lines[0], "# later", "broken", "x\ty", *lines[1:]]) + "\n")
    features = fm.gtf(spark, str(tmp_path / "a.gtf"))
    assert features.count() == len(LINES) and features.where("score = '0.5' AND frame = '2' AND source = 'src'").count() == len(LINES)
    head = [r["value"] for r in fm.gtf_header(spark, str(tmp_path / "a.gtf")).orderBy("line_no").collect()]
    assert head == ["#!build 1", "#made up"]
    assert fm.gtf_malformed(spark, str(tmp_path / "a.gtf")).first()[0] == 2
    said = an.provenance({"variant": "XX", "features-in": 17, "none": None}, ["a note"])
    sinks.annotation(an.parsed(features), str(tmp_path / "out.gtf.gz"), header=[*head, *said])
    assert spark.read.text(str(tmp_path / "out.gtf.gz")).count() == len(LINES) + 5
    written = __import__("gzip").open(tmp_path / "out.gtf.gz", "rt").read().splitlines()
    assert written == ["#!build 1", "#made up", "#!filter-variant XX", "#!filter-features-in 17", "#!filter-note a note", *lines]
