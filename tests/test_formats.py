"""Readers of text formats."""

import pytest

from strandlake.sources import formats


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("track x\n#c\nchr1\t3\t9\nchr1\t10\t12\tn\n\n")
    assert [tuple(r) for r in formats.bed(spark, str(tmp_path / "a.bed")).collect()] == [("chr1", 3, 9, "chr1:3-9"), ("chr1", 10, 12, "n")]
    (tmp_path / "b.bed").write_text("1\t2\t5 # note\n# all\n")
    assert [tuple(r) for r in formats.bed3(spark, str(tmp_path / "b.bed")).collect()] == [("1", 2, 5)]
    (tmp_path / "s").write_text("chr1 100 x\nchr2\t7\n\nchrUn 5\nchr1 90\n")
    assert sorted(tuple(r) for r in formats.sizes(spark, str(tmp_path / "s")).collect()) == [("chr1", 90, 1), ("chr2", 7, 2), ("chrUn", 5, 4)]
    assert sorted(tuple(r) for r in formats.primary_sizes(spark, str(tmp_path / "s")).collect()) == [("1", 90), ("2", 7)]
    (tmp_path / "p.bed").write_text("#x\nX 9 3 extra\n")
    assert [tuple(r) for r in formats.plain_bed(spark, str(tmp_path / "p.bed")).collect()] == [("X", 9, 3)]
    (tmp_path / "rep").write_text("# head\n1\tassembled-molecule\t1\t\t\t\tNC_1\nu\tunplaced\tna\t\t\t\tNT_2\nv\tunplaced\tna\t\t\t\tna\n")
    assert [tuple(r) for r in formats.assembly_report(spark, str(tmp_path / "rep")).orderBy("row_no").collect()] == [(2, "assembled-molecule", "1", "NC_1"), (3, "unplaced", "na", "NT_2")]
    (tmp_path / "reg").write_text("#c\nassembly\turl\nA\tu1\nB\tu2\nA\tu3\n")
    assert sorted(tuple(r) for r in formats.registry(spark, str(tmp_path / "reg"), "assembly").collect()) == [("A", "u3"), ("B", "u2")]
    assert formats.registry(spark, str(tmp_path / "reg")).count() == 3
    (tmp_path / "r").write_text("#c\nchrom\tregion\tregion_group\tstart\tend\nX\tPAR1\tPAR\t1\t10\n")
    assert [tuple(r) for r in formats.regions(spark, str(tmp_path / "r")).collect()] == [("X", "PAR1", "PAR", 0, 10)]
    (tmp_path / "f.fa").write_text(">a one\nACG\n\nTT\n>b\nN\n")
    assert [(r["contig"], r["seq"]) for r in formats.fasta(spark, str(tmp_path / "f.fa")).orderBy("line_no").collect()] == [("a", "ACG"), ("a", "TT"), ("b", "N")]
    (tmp_path / "g.gtf").write_text('#h\n1\ts\tgene\t5\t9\t.\t+\t.\tgene_id "G";\nbad line\n')
    assert [(r["seqname"], r["line_no"], r["start"]) for r in formats.gtf(spark, str(tmp_path / "g.gtf")).collect()] == [("1", 2, 5)]


def test_readers_of_tables(spark, tmp_path):
    (tmp_path / "gap").write_text("585\tchr1\t0\t10\t1\tN\t10\ttelomere\tno\n")
    assert [tuple(r) for r in formats.gaps(spark, str(tmp_path / "gap")).collect()] == [("chr1", 0, 10, "telomere")]
    (tmp_path / "band").write_text("chr1\t0\t10\tp36\tgneg\nchr1\t10\t30\tp35\tacen\n")
    from strandlake.operators import territory as te

    assert [r["name"] for r in te.structural_bands(formats.cytobands(spark, str(tmp_path / "band"))).collect()] == ["p35"]
    (tmp_path / "bg").write_text("track x\n#c\nchr1\t0\t4\t0.5\n\nchr1\t4\t6\t1\n")
    assert [tuple(r) for r in formats.bedgraph(spark, str(tmp_path / "bg")).collect()] == [("chr1", 0, 4, 0.5), ("chr1", 4, 6, 1.0)]
    (tmp_path / "idx").write_text("chr1\t100\t7\t0\n*\t0\t0\t3\n")
    assert [tuple(r) for r in formats.idxstats(spark, str(tmp_path / "idx")).collect()] == [("chr1", 100, 7, 0), ("*", 0, 0, 3)]


def test_writers_of_reports(spark, tmp_path):
    from strandlake.sources import sinks

    read = lambda name: [r["value"] for r in spark.read.text(str(tmp_path / name)).collect()]
    sinks.bed(spark.createDataFrame([("b", 5, 9, "z"), ("a", 7, 8, "y"), ("a", 1, 2, "x")], "chrom string, start long, end long, name string"), str(tmp_path / "bed"))
    assert read("bed") == ["a\t1\t2\tx", "a\t7\t8\ty", "b\t5\t9\tz"]
    sinks.transcripts(spark.createDataFrame([("t2", "g", "", 9), ("t1", "g", "n", 4)], "transcript_id string, gene_id string, gene_name string, first_line long"), str(tmp_path / "t2g"))
    assert read("t2g") == ["t1\tg\tn", "t2\tg\t"]
    dropped = spark.createDataFrame([("g2", "", "", "1", 5, 9, "+", 0, 0, 0, "r"), ("g1", "n", "b", "1", 2, 3, "-", 1, 2, 3, "r")], "gene_id string, gene_name string, gene_biotype string, seqname string, start long, end long, strand string, n_transcripts long, n_exons long, exonic_bp long, reason string")
    sinks.dropped(dropped, str(tmp_path / "dropped"))
    assert [x.split("\t")[0] for x in read("dropped")] == ["gene_id", "g1", "g2"]
    wide = spark.createDataFrame([("chr10", 5), ("chrX", 7), ("chr2", 1)], "chrom string, raw_bp long")
    sinks.territory(wide, "chrom", str(tmp_path / "wide"))
    assert read("wide") == ["chrom\traw_bp", "chr2\t1", "chr10\t5", "chrX\t7"]
    sinks.long_territory(spark.createDataFrame([("chr10", "b", 5), ("chr2", "a", 1)], "chrom string, territory_metric string, bp long"), "chrom", str(tmp_path / "long"))
    assert read("long") == ["chrom\tterritory_metric\tbp", "chr2\ta\t1", "chr10\tb\t5"]
    sinks.metadata(wide.where("chrom = 'chr2'"), str(tmp_path / "meta"))
    assert read("meta") == ['{"chrom":"chr2","raw_bp":1}']


def test_policies(spark):
    from strandlake.operators import validate as va

    rows = spark.createDataFrame([("a", 1)], "name string, n long")
    assert va.policy(rows, "odd", "warn").count() == 1 and va.policy(rows.limit(0), "odd", "fail").count() == 0
    with pytest.raises(va.Refused, match="odd: .*a"):
        va.policy(rows, "odd", "fail")
    with pytest.raises(ValueError):
        va.policy(rows, "odd", "guess")


def test_empty_interval_is_an_error(spark, tmp_path):
    (tmp_path / "a.bed").write_text("1\t9\t9\n")
    with pytest.raises(Exception, match="ends before it starts"):
        formats.bed(spark, str(tmp_path / "a.bed")).collect()


def test_writers(spark, tmp_path):
    from pyspark.sql import functions as F

    from strandlake.sources import sinks

    contigs = spark.createDataFrame([("chrX", 5), ("chr10", 7), ("chr2", 9)], "chrom string, raw_bp long")
    sinks.sizes(contigs, str(tmp_path / "sizes"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "sizes")).collect()] == ["chr2\t9", "chr10\t7", "chrX\t5"]
    sinks.sizes(contigs.withColumn("ord", F.col("raw_bp")), str(tmp_path / "in_order"))
    assert [r["value"][:4] for r in spark.read.text(str(tmp_path / "in_order")).collect()] == ["chrX", "chr1", "chr2"]
    sinks.report(spark.createDataFrame([("s1", 0.25, "XX")], "sample string, ratio double, call string"), str(tmp_path / "said"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "said")).collect()] == ["sample\ts1", "ratio\t0.25", "call\tXX"]
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.sizes(contigs, str(tmp_path / "sizes"))
    sinks.sizes(contigs, str(tmp_path / "sizes"), force=True)
    runs = spark.createDataFrame([("1", 0, 5, 0.25), ("1", 5, 9, 0.0), ("1", 9, 12, 1e-7), ("1", 12, 13, 1.0)], "chrom string, start long, end long, score double")
    sinks.bedgraph(runs, str(tmp_path / "bg.gz"))
    assert sorted(r["value"].split("\t")[3] for r in spark.read.text(str(tmp_path / "bg.gz")).collect()) == ["0.25", "1", "1e-07"]
    sinks.checksums(spark.createDataFrame([("f", bytearray(b"x"))], "filename string, content binary"), str(tmp_path / "md5"))
    assert spark.read.text(str(tmp_path / "md5")).first()["value"] == "9dd4e461268c8034f5c8564e155c67a6  f"
    assert spark.range(1).select(sinks.six_digits(F.lit(1234567.0)).alias("x")).first()["x"] == "1.23457e+06"


def test_lines_of_files_in_many_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(formats, "BLOCK_LINES", 16)
    text, want, contig = [], [], None
    for k in range(1, 3000):
        line = f">c{k} note" if k % 97 == 1 else "" if k % 13 == 0 else "ACGT" * (k % 9 + 1) + " " * (k % 2)
        contig = line[1:].split()[0] if line.startswith(">") else contig
        if line and not line.startswith(">"):
            want.append((contig, k, line.rstrip()))
        text.append(line)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fa").write_text("\n".join(text))
    (tmp_path / "in" / "b.fa").write_text(">only\nAC\n")
    (tmp_path / "a.gtf").write_text("\n".join(f"1\ts\tgene\t{k}\t{k + 5}\t.\t+\t.\tx" if k % 3 else "# c" for k in range(1, 3000)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "1024")
        assert formats._splits(spark, str(tmp_path / "in")).select("path", "part").distinct().count() > 20
        got = formats.fasta(spark, str(tmp_path / "in")).collect()
        assert sorted((r["contig"], r["line_no"], r["seq"]) for r in got) == sorted([*want, ("only", 2, "AC")])
        assert sorted((r["start"], r["line_no"]) for r in formats.gtf(spark, str(tmp_path / "a.gtf")).collect()) == [(k, k) for k in range(1, 3000) if k % 3]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_genome_round_trip_over_many_splits(spark, tmp_path, monkeypatch):
    from strandlake.operators import masking as ma
    from strandlake.operators import sequences as sq
    from strandlake.sources import sinks
    from pyspark.sql import functions as F

    monkeypatch.setattr(formats, "BLOCK_LINES", 64)
    contigs = {"chr9": 4000, "chrY": 2500, "scaffold": 300}
    text = "".join(f">{c} some note\n" + "".join("ACGTACGTAC\n" for _ in range(n // 10)) for c, n in contigs.items())
    (tmp_path / "in.fa").write_text(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "1024")
        lines = sq.with_offsets(ma.allowed(formats.fasta(spark, str(tmp_path / "in.fa")), ["9", "Y"], "contig"))
        sized = lines.groupBy("contig").agg(F.min("line_no").alias("ord"), F.sum(F.length("seq")).alias("raw_bp")).withColumnRenamed("contig", "chrom")
        bed = "chrom string, start long, end long, name string"
        par, extra = spark.createDataFrame([("y", 5, 15, "P")], bed), spark.createDataFrame([("9", 3995, 9999, "tail")], bed)
        for complement, want in (("XY", {("chr9", 3995, 4000, "extra:tail"), ("chrY", 5, 15, "P_masked")}), ("XX", {("chr9", 3995, 4000, "extra:tail"), ("chrY", 0, 2500, "whole_Y_mask")})):
            plan = ma.applied(ma.plan(complement, par, extra, "Y"), sized)
            assert {tuple(r) for r in plan.collect()} == want
            out = str(tmp_path / complement)
            sinks.fasta(sq.masked(lines, plan.withColumnRenamed("chrom", "contig")), sized.select(F.col("chrom").alias("contig"), "ord"), out)
            written = (tmp_path / complement).read_text().splitlines()
            expected, own = [], {c: sorted((s, e) for k, s, e, _ in want if k == c) for c in contigs}
            for c in ("chr9", "chrY"):
                bases = list("ACGTACGTAC" * (contigs[c] // 10))
                for s, e in own[c]:
                    bases[s:e] = "N" * (e - s)
                expected += [f">{c}"] + ["".join(bases[k : k + 10]) for k in range(0, contigs[c], 10)]
            assert written == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_manifest_of_a_folder(spark, tmp_path):
    from pyspark.sql import functions as F

    from strandlake.operators import assemblies as am
    from strandlake.sources import release, sinks

    refs = tmp_path / "refs" / "A1"
    (tmp_path / "refs" / "A1" / "A1.XX.genmap_index").mkdir(parents=True)
    (refs / "A1.XX.genmap_index" / "big.bin").write_text("x")
    (refs / "A1.XX.fa").write_text(">a\nN\n")
    (refs / "A1.XX.fa.fai").write_text("x")
    (refs / "A1.XX.metadata.json").write_text('{\n "assembly": "A1", "complement": "XX", "tool_version": "9", "par_status": "approximate"\n}')
    (refs / "A1.XY.ensembl-7.gtf.gz").write_text("g")
    (refs / "A1.XY.ensembl-7.metadata.json").write_text("{ broken")
    (refs / "A1.XX.k24.multi_read.bw").write_text("b")
    (refs / "unknown.txt").write_text("u")
    files = release.files(spark, str(tmp_path)).withColumn("path", F.replace("path", F.lit(f"file:{tmp_path}/"), F.lit("")))
    rows = {r["filename"]: r for r in am.manifest(files, ["A1"]).collect()}
    assert set(rows) == {"A1.XX.fa", "A1.XX.metadata.json", "A1.XY.ensembl-7.gtf.gz", "A1.XY.ensembl-7.metadata.json", "A1.XX.k24.multi_read.bw", "unknown.txt"}
    fa, bw, gtf = rows["A1.XX.fa"], rows["A1.XX.k24.multi_read.bw"], rows["A1.XY.ensembl-7.gtf.gz"]
    assert (fa["kind"], fa["assembly"], fa["variant"], fa["source"], fa["tool"], fa["tool_version"], fa["notes"]) == ("genome", "A1", "XX", "-", am.MASKER, "9", am.NOTES["par"] % "approximate")
    assert (bw["variant"], bw["tool"], bw["notes"]) == ("XX", am.MAPPER, f"k=24, multi_read; {am.NOTES['par'] % 'approximate'}; {am.NOTES['mapped']}")
    assert (gtf["assembly"], gtf["tool"], gtf["notes"]) == ("", "", "") and rows["unknown.txt"]["assembly"] == "-"
    sinks.manifest(am.manifest(files, ["A1"]), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()["value"].split("\t") == am.MANIFEST
