"""Queries of the annotation operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.lineage import stored
from strandlake.operators import annotation as an
from strandlake.operators import masking as ma
from strandlake.sources import derived as d


def _judged(s, p, rule="any", unknown="drop", only=None):
    """only: the columns that are needed; what is stored has no others but those that verdicts need."""
    f, m = an.parsed(d.features(s, p)), stored(d.masks(s, p))
    f = f if only is None else f.select(*dict.fromkeys([*only, "line_no", "seqname", "contig_key", "gene_id", "start", "end", "n"]))
    return an.judged(f, an.classify(f, m, d.genome(s, p), unknown), m, rule, d.Y_KEY)


def _first_hit(s, p, rule):
    tested = an.mask_test(an.parsed(d.features(s, p)), d.masks(s, p), rule, d.Y_KEY)
    return tested.groupBy("seqname").agg(F.sum(F.when(F.col("hit"), F.col("n"))).alias("n_hit"), F.sum(F.when(F.col("partial"), F.col("n"))).alias("n_partial"), F.sum(F.when(F.col("on_y"), F.col("n"))).alias("n_on_y"))


def _extra(s, p):
    return d.runs(s, p).where("h = 100").select("chrom", "start", "end", F.concat(F.lit("x"), F.col("start").cast("string")).alias("name"))


def _variants(s, p):
    """What the report of each variant states."""

    f = stored(an.parsed(d.features(s, p)).select("line_no", "seqname", "contig_key", "gene_id", "start", "end", "n"))
    par, extra, genome = stored(d.par(s, p)), stored(_extra(s, p)), d.genome(s, p)

    def one(variant):
        masks = ma.variant_mask(variant, par, extra, genome, d.Y_KEY)
        v = an.verdicts(f, an.classify(f, masks, genome, "drop"), masks, "any", d.Y_KEY)
        return an.summary_by_gene(v, d.X_KEY, d.Y_KEY).select(F.lit(variant).alias("variant"), "*")

    return reduce(DataFrame.unionByName, (one(v) for v in ma.COMPLEMENT))


def _prediction(s, p):
    j = _judged(s, p)

    def one(unit):
        written = an.UNITS[unit](j).agg(F.count(F.lit(1)).alias("n_written")).withColumn("unit", F.lit(unit))
        return an.predicted(j, unit).withColumn("unit", F.lit(unit)).join(written, "unit")

    return reduce(DataFrame.unionByName, (one(u) for u in an.UNITS))


def _mask_plan(s, p):
    """The plans of both complements, applied."""
    one = lambda c: ma.applied(ma.plan(c, d.par(s, p), _extra(s, p), d.Y_KEY), d.genome(s, p)).select(F.lit(c).alias("complement"), "*")
    return one("XX").unionByName(one("XY"))


_KEPT = ["seqname", "line_no", "feature", "start", "end", "gene_id", "transcript_id", "n"]
_LINE = ["line_no", *an.FIELDS]
QUERIES = {
    "gt_attributes": lambda s, p: an.parsed(d.features(s, p)).groupBy("gene_id", "transcript_id", "gene_name", "gene_biotype").agg(F.sum("n").alias("n")),
    "gt_classify": lambda s, p: an.classify(an.parsed(d.features(s, p)), d.masks(s, p), d.genome(s, p), "drop"),
    "gt_first_hit": lambda s, p: _first_hit(s, p, "any"),
    "gt_contained_hit": lambda s, p: _first_hit(s, p, "contained"),
    "gt_reason": lambda s, p: _judged(s, p).groupBy("seqname", "class", "reason").agg(F.sum("n").alias("n")),
    "gt_gene_agg": lambda s, p: an.genes(an.parsed(d.features(s, p))),
    "gt_exonic_bp": lambda s, p: an.exonic(an.parsed(d.features(s, p))),
    "gt_dropped_genes": lambda s, p: an.dropped_genes(_judged(s, p)),
    "gt_drop_gene": lambda s, p: an.kept_by_gene(_judged(s, p, only=_KEPT)).select(*_KEPT),
    "gt_drop_transcript": lambda s, p: an.kept_by_transcript(_judged(s, p, only=_KEPT)).select(*_KEPT),
    "gt_drop_feature": lambda s, p: an.kept_by_feature(_judged(s, p, only=_KEPT)).select(*_KEPT),
    "gt_survivors": lambda s, p: an.survivors_on_mask(an.kept_by_gene(_judged(s, p, "contained")), d.masks(s, p)).select(*_LINE, "n"),
    "gt_t2g": lambda s, p: an.t2g(an.kept_by_gene(_judged(s, p))),
    "gt_t2g_collisions": lambda s, p: an.t2g(an.kept_by_gene(_judged(s, p))).where("collision").agg(F.array_sort(F.collect_set("transcript_id")).cast("string").alias("collisions")),
    "gt_offgenome_split": lambda s, p: an.genes(_judged(s, p)).where("hit").groupBy((F.col("reason") == "seqname_not_in_genome").alias("off_genome")).agg(F.count(F.lit(1)).alias("n_genes"), F.sum("n_features").alias("n_features")),
    "gt_unknown_topk": lambda s, p: an.unknown_names(an.parsed(d.features(s, p)), d.genome(s, p)),
    "gt_range_check": lambda s, p: an.out_of_range(an.parsed(d.features(s, p)), d.genome(s, p)),
    "gt_naming": lambda s, p: an.naming_votes(d.features(s, p)),
    "gt_zero_fill": lambda s, p: an.zero_filled(an.parsed(d.features(s, p)), an.genes(an.kept_by_gene(_judged(s, p))), ["seqname", "gene_id"], "n_features"),
    "gt_variants": _variants,
    "gt_counts": lambda s, p: (lambda j: an.counts(j, an.kept_by_gene(j)))(_judged(s, p)),
    "gt_prediction": _prediction,
    "gt_lines": lambda s, p: an.kept_by_gene(_judged(s, p)).select(*_LINE),
    "gt_partial_examples": lambda s, p: an.examples(an.genes(_judged(s, p)).where("partial").select("gene_name", F.concat_ws(":", "seqname", "gene_id").alias("gene")), "gene_name", "gene", 10),
    "mk_plan": _mask_plan,
    "mk_report": lambda s, p: (lambda m: ma.report(m))(_mask_plan(s, p).where("complement = 'XY'")),
    "mk_allowlist": lambda s, p: ma.allowed(d.contigs(s, p), ["chr1", "2", " 3 ", "", "99"]),
}

_FIELDS = 'line_no, seqname, source, feature, start, "end", score, strand, frame, attributes'


def _verdicts(masks: str = "masks") -> str:
    """Features with their verdict against a relation of masks; classes by contig."""
    return f"""
sp AS (SELECT chrom, min(start) <= 0 AND max("end") >= max(raw_bp) AND bool_and(p IS NULL OR start <= p) AS closed FROM (SELECT m.*, raw_bp, lag(m."end") OVER (PARTITION BY chrom ORDER BY m.start, m."end") AS p FROM {masks} m JOIN genome USING (chrom)) GROUP BY chrom),
cl AS (SELECT seqname, CASE WHEN g.raw_bp IS NULL THEN 'DROP_ALL' WHEN sp.closed IS NULL THEN 'KEEP' WHEN sp.closed THEN 'DROP_ALL' ELSE 'INSPECT' END AS class, g.raw_bp IS NULL AS off_genome, regexp_replace(seqname, '^chr', '') AS contig_key
  FROM (SELECT DISTINCT seqname FROM features) LEFT JOIN genome g ON g.chrom = seqname LEFT JOIN sp ON sp.chrom = seqname),
ov AS MATERIALIZED (SELECT f.line_no, min({{'a': m.start, 'b': m."end", 'c': m.name}}) AS f1,
  min({{'a': m.start, 'b': m."end", 'c': m.name}}) FILTER (f.start - 1 >= m.start AND f."end" <= m."end") AS f2, min({{'a': m.start, 'b': m."end", 'c': m.name}}) FILTER (NOT (f.start - 1 >= m.start AND f."end" <= m."end")) AS f3
  FROM parsed f JOIN {masks} m ON m.chrom = f.seqname AND f.start - 1 < m."end" AND f."end" > m.start GROUP BY f.line_no),
hit AS MATERIALIZED (SELECT p.*, f1 IS NOT NULL AS a_hit, f1 IS NOT NULL AND NOT coalesce(f1 = f2, false) AS a_partial, coalesce(NOT starts_with(f1.c, 'extra:'), false) AND upper(contig_key) IN ('Y', '{d.Y_KEY}') AS a_on,
  f2 IS NOT NULL AS c_hit, f1 IS NOT NULL AND coalesce(f3 < f2, f2 IS NULL) AS c_partial, coalesce(NOT starts_with(f2.c, 'extra:'), false) AND upper(contig_key) IN ('Y', '{d.Y_KEY}') AS c_on
  FROM parsed p LEFT JOIN ov USING (line_no))"""


def _reasons(rule: str = "a") -> str:
    return f""" j AS MATERIALIZED (SELECT h.*, class, CASE class WHEN 'DROP_ALL' THEN true WHEN 'KEEP' THEN false ELSE {rule}_hit END AS hit, class = 'INSPECT' AND {rule}_partial AS partial,
  CASE WHEN class = 'DROP_ALL' THEN CASE WHEN off_genome THEN 'seqname_not_in_genome' ELSE 'whole_contig_masked' END WHEN class = 'INSPECT' AND {rule}_hit THEN CASE WHEN NOT {rule}_on THEN 'extra_mask_overlap' WHEN {rule}_partial THEN 'y_par_overlap_partial' ELSE 'y_par_overlap' END END AS reason
  FROM hit h JOIN cl USING (seqname)),
gone AS MATERIALIZED (SELECT DISTINCT seqname, gene_id FROM j WHERE hit),
kept AS MATERIALIZED (SELECT j.* FROM j ANTI JOIN gone USING (seqname, gene_id))"""


_J = f"{d.with_('contigs', 'genome', 'masks', 'parsed')},{_verdicts()}"


def _j(rule: str = "a") -> str:
    return f"{_J},{_reasons(rule)}"


def _of_variant(variant: str, masks: str) -> str:
    """One row of gt_variants."""
    return f"""(WITH mv AS ({masks}),{_verdicts('mv')},{_reasons()}, g AS ({_genes('j', True)})
SELECT '{variant}' AS variant, (SELECT count(*) FROM j) AS features_in, (SELECT count(*) FROM j WHERE contig_key = '{d.X_KEY}') AS x_in, (SELECT count(*) FROM kept) AS features_out, (SELECT count(*) FROM kept WHERE contig_key = '{d.X_KEY}') AS x_out, (SELECT count(*) FROM kept WHERE contig_key = '{d.Y_KEY}') AS y_out,
(SELECT count(*) FROM g WHERE hit AND reason <> 'seqname_not_in_genome') AS genes_dropped_by_mask, (SELECT count(*) FROM g WHERE hit AND reason = 'seqname_not_in_genome') AS genes_dropped_off_genome, (SELECT count(*) FROM g WHERE partial) AS genes_partial,
(SELECT count(*) FROM kept WHERE a_hit) AS kept_on_mask, (SELECT count(*) FROM g WHERE hit AND reason <> 'seqname_not_in_genome') = 0 AS identical_to_standard)"""


def _genes(source: str, judged: bool) -> str:
    more = """, bool_or(hit) AS hit, bool_or(partial) AS partial, coalesce((min({'a': line_no, 'b': reason}) FILTER (reason <> 'y_par_overlap')).b, max(reason)) AS reason""" if judged else ""
    return f"""SELECT seqname, gene_id, sum(n)::BIGINT AS n_features, min(start) AS start, max("end") AS "end", coalesce((min({{'a': line_no, 'b': gene_name}}) FILTER (gene_name <> '')).b, '') AS gene_name, coalesce((min({{'a': line_no, 'b': gene_biotype}}) FILTER (gene_biotype <> '')).b, '') AS gene_biotype,
coalesce((min({{'a': line_no, 'b': strand}}) FILTER (strand <> '.')).b, '.') AS strand, count(DISTINCT transcript_id) AS n_transcripts, coalesce(sum(n) FILTER (feature = 'exon'), 0)::BIGINT AS n_exons{more} FROM {source} GROUP BY seqname, gene_id"""


def _exonic(source: str) -> str:
    return f"""ex AS (SELECT seqname, gene_id, start - 1 AS start, "end" FROM {source} WHERE feature = 'exon'), {d.merged('ex', 'em', 'seqname, gene_id')}, xb AS (SELECT seqname, gene_id, sum("end" - start)::BIGINT AS exonic_bp FROM em GROUP BY seqname, gene_id)"""


_COLS = 'seqname, line_no, feature, start, "end", gene_id, transcript_id, n'
_T2G = "t AS (SELECT transcript_id, min({'a': line_no, 'b': gene_id, 'c': gene_name}) AS f, count(DISTINCT gene_id) > 1 AS collision FROM kept WHERE transcript_id IS NOT NULL GROUP BY transcript_id)"
_TX = """bt AS MATERIALIZED (SELECT seqname, gene_id, transcript_id, bool_or(hit) AS gone FROM j WHERE transcript_id IS NOT NULL GROUP BY ALL), tg AS MATERIALIZED (SELECT DISTINCT seqname, transcript_id FROM bt WHERE gone),
ga AS (SELECT seqname, gene_id, bool_and(tg.transcript_id IS NOT NULL) AS all_gone FROM bt LEFT JOIN tg USING (seqname, transcript_id) GROUP BY ALL),
gh AS MATERIALIZED (SELECT seqname, gene_id FROM j LEFT JOIN ga USING (seqname, gene_id) GROUP BY seqname, gene_id HAVING bool_or(hit) AND coalesce(bool_and(all_gone), true)),
tkept AS MATERIALIZED (SELECT j.* FROM j ANTI JOIN gh USING (seqname, gene_id) ANTI JOIN tg ON tg.seqname = j.seqname AND tg.transcript_id = j.transcript_id WHERE class <> 'DROP_ALL')"""
_PLAN = f"""pl AS (SELECT 'XX' AS complement, '{d.Y_KEY}' AS key, 0 AS start, -1 AS "end", 'whole_Y_mask' AS name UNION ALL SELECT 'XY', '{d.Y_KEY}', start, "end", name || '_masked' FROM par WHERE upper(replace(chrom, 'chr', '')) IN ('Y', '{d.Y_KEY}')
UNION ALL SELECT c, replace(chrom, 'chr', ''), start, "end", 'extra:x' || start FROM runs, (VALUES ('XX'), ('XY')) v(c) WHERE h = 100),
mp AS MATERIALIZED (SELECT complement, g.chrom, start, CASE "end" WHEN -1 THEN raw_bp ELSE least("end", raw_bp) END AS "end", name FROM pl JOIN genome g ON replace(g.chrom, 'chr', '') = key WHERE start < CASE "end" WHEN -1 THEN raw_bp ELSE least("end", raw_bp) END)"""
_VARIANTS = {"XX": "SELECT * FROM mp WHERE complement = 'XX'", "XY": "SELECT * FROM mp WHERE complement = 'XY' AND starts_with(name, 'extra:')", "XY-noYPAR": "SELECT * FROM mp WHERE complement = 'XY'"}
ORACLE = {
    "gt_attributes": f"{d.with_('parsed')} SELECT gene_id, transcript_id, gene_name, gene_biotype, sum(n)::BIGINT AS n FROM parsed GROUP BY ALL",
    "gt_classify": f"{_J} SELECT seqname, contig_key, class, off_genome FROM cl",
    "gt_first_hit": f"{_J} SELECT seqname, sum(n) FILTER (a_hit)::BIGINT AS n_hit, sum(n) FILTER (a_partial)::BIGINT AS n_partial, sum(n) FILTER (a_on)::BIGINT AS n_on_y FROM hit GROUP BY seqname",
    "gt_contained_hit": f"{_J} SELECT seqname, sum(n) FILTER (c_hit)::BIGINT AS n_hit, sum(n) FILTER (c_partial)::BIGINT AS n_partial, sum(n) FILTER (c_on)::BIGINT AS n_on_y FROM hit GROUP BY seqname",
    "gt_reason": f"{_j()} SELECT seqname, class, reason, sum(n)::BIGINT AS n FROM j GROUP BY ALL",
    "gt_gene_agg": f"{d.with_('parsed')} {_genes('parsed', False)}",
    "gt_exonic_bp": f"{d.with_('parsed')}, {_exonic('parsed')} SELECT * FROM xb",
    "gt_dropped_genes": f"{_j()}, {_exonic('j')}, g AS ({_genes('j', True)}) SELECT g.* EXCLUDE (hit, partial), coalesce(exonic_bp, 0) AS exonic_bp FROM g LEFT JOIN xb USING (seqname, gene_id) WHERE hit",
    "gt_drop_gene": f"{_j()} SELECT {_COLS} FROM kept",
    "gt_drop_transcript": f"{_j()}, {_TX} SELECT {_COLS} FROM tkept",
    "gt_drop_feature": f"{_j()} SELECT {_COLS} FROM j WHERE NOT hit",
    "gt_survivors": f"{_j('c')} SELECT {_FIELDS}, n FROM kept WHERE a_hit",
    "gt_variants": f"{d.with_('contigs', 'genome', 'par', 'parsed')}, {_PLAN} " + " UNION ALL ".join(_of_variant(v, m) for v, m in _VARIANTS.items()),
    "gt_counts": f"{_j()} SELECT seqname, count(*) AS n_in, max(\"end\") AS max_end, (SELECT count(*) FROM kept k WHERE k.seqname = j.seqname) AS n_out FROM j GROUP BY seqname",
    "gt_prediction": f"""{_j()}, {_TX} SELECT 'gene' AS unit, count(*) AS n_in, (SELECT count(*) FROM gone) AS genes_dropped, count(*) - (SELECT count(*) FROM j SEMI JOIN gone USING (seqname, gene_id)) AS n_predicted, (SELECT count(*) FROM kept) AS n_written FROM j
UNION ALL SELECT 'transcript', count(*), (SELECT count(*) FROM gh), count(*) - (SELECT count(*) FROM j SEMI JOIN gh USING (seqname, gene_id)), (SELECT count(*) FROM tkept) FROM j UNION ALL SELECT 'feature', count(*), 0, NULL, count(*) FILTER (NOT hit) FROM j""",
    "gt_lines": f"{_j()} SELECT {_FIELDS} FROM kept",
    "gt_partial_examples": f"{_j()}, g AS ({_genes('j', True)}) SELECT gene_name FROM (SELECT gene_name FROM g WHERE partial ORDER BY seqname || ':' || gene_id, gene_name LIMIT 10)",
    "mk_plan": f"{d.with_('genome', 'par')}, {_PLAN} SELECT complement, chrom, start, \"end\", name FROM mp",
    "mk_report": f"{d.with_('genome', 'par')}, {_PLAN} SELECT count(*) AS n_masked_intervals, sum(\"end\" - start)::BIGINT AS masked_bp FROM mp WHERE complement = 'XY'",
    "mk_allowlist": f"{d.with_('contigs')} SELECT * FROM contigs WHERE k IN (1, 2, 3, 99)",
    "gt_t2g": f"{_j()}, {_T2G} SELECT transcript_id, f.b AS gene_id, f.c AS gene_name, f.a AS first_line, collision FROM t",
    "gt_t2g_collisions": f"{_j()}, {_T2G} SELECT '[' || coalesce(string_agg(transcript_id, ', ' ORDER BY transcript_id), '') || ']' AS collisions FROM t WHERE collision",
    "gt_offgenome_split": f"{_j()}, g AS ({_genes('j', True)}) SELECT reason = 'seqname_not_in_genome' AS off_genome, count(*) AS n_genes, sum(n_features)::BIGINT AS n_features FROM g WHERE hit GROUP BY 1",
    "gt_unknown_topk": f"{d.with_('genome', 'parsed')} SELECT seqname, sum(n)::BIGINT AS n_features FROM parsed WHERE seqname NOT IN (SELECT chrom FROM genome) GROUP BY seqname ORDER BY n_features DESC, seqname LIMIT 20",
    "gt_range_check": f"{d.with_('genome', 'parsed')} SELECT seqname, max(\"end\") AS max_end, raw_bp AS length, sum(n)::BIGINT AS n_features FROM parsed JOIN genome ON chrom = seqname GROUP BY seqname, raw_bp HAVING max(\"end\") > raw_bp",
    "gt_naming": f"{d.with_('features')} SELECT count(*) AS n_names, count(*) FILTER (starts_with(seqname, 'chr')) AS n_prefixed, 2 * count(*) FILTER (starts_with(seqname, 'chr')) > count(*) AS prefixed FROM (SELECT DISTINCT seqname FROM features)",
    "gt_zero_fill": f"{_j()}, u AS (SELECT DISTINCT seqname, gene_id FROM parsed), g AS ({_genes('kept', False)}) SELECT seqname, gene_id, coalesce(n_features, 0) AS n_features FROM u LEFT JOIN g USING (seqname, gene_id)",
}
