"""Queries of scalars, sequences, ploidy, coverage calls, registries and inventories."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from strandlake.functions import columns as fc
from strandlake.functions.lineage import settled
from strandlake.operators import assemblies as am
from strandlake.operators import intervals as iv
from strandlake.operators import kmers as km
from strandlake.operators import masking as ma
from strandlake.operators import sequences as sq
from strandlake.operators import tracks as tr
from strandlake.sources import derived as d
from strandlake.sources import release

ASSEMBLIES = ["GRCh38", "GRCm39", "T2T-CHM13v2"]
K = 24


#: Suffixes of file names, by turns.
SUFFIXES = ("fa.gz", "chrom.sizes", "gtf.gz", "gtf.gz.md5", "bw", "masked.bed", "t2g.tsv", "dropped_genes.tsv", "metadata.json", "bigWig", "txt", "fa.fai")


def _files(s, p):
    """File names made of the keys of parts: twelve by twelve, one of each suffix, they are the products of one assembly and complement, some in folders of their own."""
    k = F.col("p_partkey")
    g = F.expr(f"p_partkey div {len(SUFFIXES)}")
    name = F.concat_ws(
        ".",
        F.element_at(F.array(*[F.lit(x) for x in [*ASSEMBLIES, "GRCh99"]]), (g % 4 + 1).cast("int")),
        F.element_at(F.array(*[F.lit(x) for x in ("XX", "XY", "XZ")]), (g % 3 + 1).cast("int")),
        F.when(g % 5 == 0, F.lit("noYPAR")),
        F.concat(F.lit("ensembl-"), g.cast("string")),
        F.when(k % 7 == 0, F.concat(F.lit("k"), (k % 100).cast("string"), F.lit(".single_read"))),
        F.element_at(F.array(*[F.lit(x) for x in SUFFIXES]), (k % len(SUFFIXES) + 1).cast("int")),
    )
    return d.table(s, p, "part").select(k.alias("k"), name.alias("filename"), F.concat(F.when(k % 6 < 4, F.concat(F.lit("refs/"), F.substring_index(name, ".", 1))).otherwise(F.lit("map")), F.lit("/"), name).alias("path"))


def _contents(s, p):
    """Files with what is in them: a document's text (of parts without one, their name), and in metadata documents JSON, some of it broken."""
    k = F.col("k")
    texts = d.table(s, p, "documents").select(F.col("doc_id").alias("k"), "text")
    number = lambda n: (k % n).cast("string")
    document = F.concat(
        F.lit('{"assembly": "A'), number(4), F.lit('", "'), F.when(k % 2 == 0, "variant").otherwise("complement"), F.lit('": "V'), number(3), F.lit('", "annotation_source": "'), F.when(k % 5 == 0, "").otherwise("ens"),
        F.lit('", "tool_version": "'), number(6), F.lit('", "par_status": "'), F.when(k % 4 == 0, "verified").otherwise("approximate"), F.lit('", "restrict_to_genome": '), F.when(k % 9 == 0, "true").otherwise("false"),
        F.lit(', "genes_dropped_off_genome": '), number(50), F.lit(', "genes_partially_overlapping": '), number(3), F.lit(', "identical_to_standard_xy": '), F.when(k % 11 == 0, "true").otherwise("false"), F.when(k % 13 == 0, "").otherwise("}"),
    )
    found = _files(s, p).join(texts, "k", "left")
    return found.select("filename", "path", F.when(F.col("filename").endswith(".metadata.json"), document).otherwise(F.coalesce("text", "filename")).cast("binary").alias("content"), "k")


def _manifest(s, p):
    return am.manifest(release.digested(_contents(s, p).drop("k")), ASSEMBLIES)


def _zipped(s, p):
    """Documents as contents of files, every second one packed, some of these in two members."""

    @F.pandas_udf("binary")
    def packed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda x: gzip.compress(x[: len(x) // 3].encode(), mtime=0) + gzip.compress(x[len(x) // 3 :].encode(), mtime=0))

    return d.table(s, p, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, packed(F.coalesce("text", F.lit("")))).otherwise(F.coalesce("text", F.lit("")).cast("binary")).alias("content"))


def _masks(s, p):
    """Three masks for each document, two of them overlapping, one open at its end."""
    docs = d.table(s, p, "documents").select(F.col("doc_id").alias("contig"), F.length("text").cast("long").alias("n"))
    spans = F.array(
        F.struct(F.expr("n div 10").alias("start"), F.expr("n div 5").alias("end")),
        F.struct(F.expr("n div 6").alias("start"), F.expr("n div 4").alias("end")),
        F.struct(F.expr("n - n div 8").alias("start"), F.lit(-1).cast("long").alias("end")),
    )
    return docs.select("contig", F.explode(spans).alias("m")).select("contig", "m.start", "m.end").where("start <> end")


def _masked(s, p):
    out = sq.masked(sq.with_offsets(d.lines(s, p)), _masks(s, p))
    return out.select("contig", F.col("line_no").cast("long").alias("line_no"), "offset", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


def _uniqueness(s, p, most=None):
    """The score of each place of the contigs that bases make, as runs; with most, of places whose k-mer occurs that often at most."""
    return km.counted(d.bases(s, p), K, most=most).withColumn("score", km.score(F.col("n")))


def _genome(s, p):
    """The contigs that bases make, masked for both complements, src4 in the role of Y."""
    lines = settled(sq.with_offsets(d.bases(s, p)))
    sizes = lines.groupBy(F.col("contig").alias("chrom")).agg(F.sum(F.length("seq")).alias("raw_bp"))
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    par = d.table(s, p, "supplier").select(F.when(k % 2 == 0, "Y").otherwise("src5").alias("chrom"), (k * 7919 % 40000).cast("long").alias("start"), (k * 7919 % 40000 + 50 + k).cast("long").alias("end"), F.concat(F.lit("P"), k.cast("string")).alias("name"))
    extra = d.table(s, p, "nation").select(F.concat(F.lit("src"), (n % 20).cast("string")).alias("chrom"), (n * 1000).cast("long").alias("start"), (n * 1000 + 500).cast("long").alias("end"), F.lit("x").alias("name"))

    def one(complement):
        plan = ma.applied(ma.plan(complement, par, extra, "src4"), sizes)
        out = sq.masked_in_place(lines, plan.withColumnRenamed("chrom", "contig"))
        return out.select(F.lit(complement).alias("complement"), "contig", "line_no", F.col("offset").cast("long").alias("offset"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))

    return one("XX").unionByName(one("XY"))


def _idx(s, p):
    """Reads by sample and contig: orders by priority and customer."""
    key = (F.col("o_custkey") % 24).cast("int")
    o = d.table(s, p, "orders").groupBy(F.col("o_orderpriority").alias("sample"), key.alias("i")).agg(F.count(F.lit(1)).alias("mapped"))
    contig = F.concat(F.lit("chr"), F.when(F.col("i") == 22, "X").when(F.col("i") == 23, "Y").otherwise((F.col("i") + 1).cast("string")))
    return o.select("sample", contig.alias("contig"), (1000 + 10 * F.col("i")).cast("long").alias("length"), "mapped")


def _rounded(calls):
    return calls.select("sample", F.round("x_ratio", 9).alias("x_ratio"), F.round("y_ratio", 9).alias("y_ratio"), "call")


def _mappable(s, p):
    """Mappable bases of some contigs, and none of one."""
    i = F.col("s_suppkey") % 24
    contig = F.concat(F.lit("chr"), F.when(i == 22, "X").when(i == 23, "Y").otherwise((i + 1).cast("string")))
    return d.table(s, p, "supplier").where("s_suppkey % 24 NOT IN (3, 4)").select(contig.alias("contig"), F.when(i == 5, 0).otherwise(500 + 20 * i).cast("long").alias("bp")).distinct()


def _without(s, p):
    """Samples that lack X, or all autosomes, or Y."""
    i = _idx(s, p)
    return i.where("NOT (sample LIKE '1%' AND contig = 'chrX') AND NOT (sample LIKE '2%' AND contig NOT IN ('chrX', 'chrY')) AND NOT (sample LIKE '3%' AND contig = 'chrY')")


def _sized(s, p):
    """Contigs of each region of suppliers by nation, in the order of suppliers, X and Y by turns."""
    k = F.col("s_suppkey")
    return d.table(s, p, "supplier").select(F.col("s_nationkey").alias("genome"), F.concat(F.when(k % 2 == 0, "chr").otherwise(""), F.when(k % 3 == 0, "X").when(k % 3 == 1, "Y").otherwise("9")).alias("chrom"), (k * 10).alias("raw_bp"), k.alias("ord"))


def _first_xy(s, p):
    both = lambda key: am.first_contig(_sized(s, p), key, ["genome"]).withColumn("key", F.lit(key))
    return both("X").unionByName(both("Y"))


def _annotations(s, p):
    """Rows of a registry of annotations, one for each supplier, with urls that several share."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("Sp.A"), (k % 4).cast("string"), F.lit("."), (k % 6 + 90).cast("string"), F.when(k % 8 == 0, ".abinitio").when(k % 10 == 0, ".chr_patch_hapl_scaff").otherwise(""), F.lit(".gtf.gz"))
    return d.table(s, p, "supplier").select(k.alias("row_no"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("source"), (k % 6 + 90).cast("string").alias("release"), F.when(k % 2 == 0, "primary").otherwise("chr").alias("flavour"), (k % 5 == 0).cast("int").cast("string").alias("restrict_to_genome"), F.concat(F.lit("https://host/"), (k % 7).cast("string"), F.lit("/"), name).alias("url"))


def _gtf_names(s, p):
    k = F.col("p_partkey")
    return d.table(s, p, "part").select(F.concat(F.lit("Sp.A"), (k % 5).cast("string"), F.lit("."), (k % 8 + 90).cast("string"), F.lit(".gtf.gz")).alias("filename")).distinct()


def _track_names(s, p):
    """For each contig's key the name that a track has: of some plain, of some with chr, of some both, of some none."""
    k = F.col("k")
    names = d.contigs(s, p).select(k.cast("string").alias("chrom"), "k")
    tracks = names.where("k % 3 <> 0").select("chrom", "k").select(F.when(k % 2 == 0, F.concat(F.lit("chr"), "chrom")).otherwise(F.col("chrom")).alias("name"))
    return am.by_either_name(names, tracks.unionByName(names.where("k % 10 = 0").select(F.concat(F.lit("chr"), "chrom").alias("name"))))


def _report(s, p):
    """An assembly report made of nations: some assembled, one of these the mitochondrion."""
    n = F.col("n_nationkey")
    return d.table(s, p, "nation").select(n.alias("row_no"), F.when(n % 3 == 0, "assembled-molecule").otherwise("unplaced-scaffold").alias("role"), F.when(n == 9, "MT").otherwise(n.cast("string")).alias("molecule"), n.cast("string").alias("accession"))


def _registry(s, p):
    """A row for each supplier as a source of an assembly."""
    k = F.col("s_suppkey")
    return d.table(s, p, "supplier").select(
        F.concat(F.lit("asm"), (F.col("s_nationkey") % 5).cast("string")).alias("assembly"), F.element_at(F.array(*[F.lit(x) for x in ("ensembl", "ucsc", "ncbi", "other")]), (k % 4 + 1).cast("int")).alias("source"),
        F.when(k % 2 == 0, "primary").otherwise("chr").alias("flavour"), (k % 3 == 0).cast("int").cast("string").alias("is_latest"), (k % 9 + 100).cast("string").alias("release"), F.concat(F.lit("url"), k.cast("string")).alias("url"), k.alias("row_no"),
    )


def _renamed(s, p):
    names = d.contigs(s, p).select("k", F.col("chrom").alias("name"))
    mapping = d.table(s, p, "nation").select(F.col("n_nationkey").cast("string").alias("old"), F.concat(F.lit("NC_"), F.col("n_regionkey").cast("string"), F.lit("_"), F.col("n_name")).alias("new"), F.col("n_nationkey").alias("row_no"))
    return am.renamed(names, mapping, "name")


def _par(s, p):
    """Intervals of flag A on two contigs as pseudo-autosomal parts, the contigs in the role of X and Y."""
    return d.kind(s, p, "A").where(fc.contig_key(F.col("chrom")).isin("1", "2"))


QUERIES = {
    "sc_strip_chr": lambda s, p: d.contigs(s, p).select("chrom", fc.contig_key(F.col("chrom")).alias("contig_key"), fc.is_y_side(F.col("chrom"), F.lit("4")).alias("y_side"), fc.chrom_rank(fc.contig_key(F.col("chrom"))).cast("int").alias("rank")),
    "sc_edges": lambda s, p: d.contigs(s, p).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(7)))).select("chrom", "i", fc.bin_edge(F.col("i"), 7, F.col("raw_bp")).alias("edge")),
    "sc_stem_kind": lambda s, p: _files(s, p).select("filename", fc.file_stem(F.col("filename"), ASSEMBLIES).alias("stem"), fc.file_kind(F.col("filename")).alias("kind"), fc.release_of(F.col("filename")).alias("release")),
    "sc_notes": lambda s, p: _files(s, p).select("filename", fc.notes(F.concat(F.lit("k="), fc.kmer_of(F.col("filename")).cast("string")), fc.track_of(F.col("filename"))).alias("notes")),
    "sc_names": lambda s, p: _files(s, p).select("path", fc.basename(F.col("path")).alias("base"), fc.product_prefix(F.col("filename"), ".fa").alias("prefix"), F.substring_index("filename", ".", 1).alias("first")),
    "sc_lists": lambda s, p: d.table(s, p, "part").select("p_partkey", F.explode(fc.parse_list(F.concat(F.lit(" a"), (F.col("p_partkey") % 5).cast("string"), F.when(F.col("p_partkey") % 2 == 0, " , ,b,").otherwise(",c ,")))).alias("item")),
    "sc_metric": lambda s, p: d.table(s, p, "lineitem").select("l_orderkey", "l_linenumber", fc.whole_metric(F.when(F.col("l_linenumber") == 3, "nan").when(F.col("l_linenumber") == 4, "12x").when(F.col("l_linenumber") == 5, F.lit(None)).otherwise((F.col("l_quantity") / 2).cast("string"))).alias("metric")),
    "sq_offsets": lambda s, p: sq.with_offsets(d.lines(s, p)).select("contig", F.col("line_no").cast("long").alias("line_no"), "offset"),
    "sq_mask": _masked,
    "sq_kmers": lambda s, p: sq.kmers(d.table(s, p, "documents"), F.col("text"), K).groupBy("n").agg(F.count(F.lit(1)).alias("kmers"), F.max("value").alias("value")),
    "mk_genome": _genome,
    "sq_uniqueness": _uniqueness,
    "tr_single_bases": lambda s, p: iv.lengths(tr.unique_indicator(_uniqueness(s, p, most=1)), "chrom", "unique_bp"),
    "sq_allowed": lambda s, p: ma.allowed(d.lines(s, p).withColumn("chrom", F.concat(F.when(F.col("contig") % 2 == 0, "chr").otherwise(""), (F.col("contig") % 30).cast("string"))), ["chr1", "2", "28"]).groupBy("chrom").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("seq")).alias("bp")),
    "pl_nonpar": lambda s, p: am.ploidy(d.contigs(s, p), _par(s, p), "1", "2"),
    "cc_call": lambda s, p: _rounded(am.coverage_call(_idx(s, p), ["sample"])),
    "cc_mappable": lambda s, p: _rounded(am.coverage_call(_idx(s, p), ["sample"], mappable=_mappable(s, p))),
    "cc_report": lambda s, p: am.call_report(am.coverage_call(_without(s, p), ["sample"]), ["sample"]),
    "cc_first_xy": _first_xy,
    "rg_refused": lambda s, p: am.refused(_annotations(s, p)).select("row_no", "url"),
    "rg_by_basename": lambda s, p: am.by_basename(_gtf_names(s, p), _annotations(s, p)),
    "rg_either_name": _track_names,
    "rg_report_rename": lambda s, p: am.renamed(d.contigs(s, p).select("k", F.col("chrom").alias("name")), am.report_names(_report(s, p)), "name"),
    "mf_manifest": _manifest,
    "rg_first_seen": lambda s, p: am.first_of_each(d.table(s, p, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], "o_orderkey"),
    "rg_preference": lambda s, p: am.preferred(_registry(s, p).select("assembly", "source", "row_no", "url"), ["assembly"], "source", ["ensembl", "ucsc", "ncbi"]),
    "rg_select": lambda s, p: am.selected(_registry(s, p), F.lit("asm1"), F.lit("ensembl"), F.lit("primary"), "latest"),
    "rg_rename": _renamed,
    "mf_content": lambda s, p: release.digested(_zipped(s, p)).select("doc_id", "content_md5"),
    "mf_digest": lambda s, p: d.table(s, p, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.md5(F.col("text").cast("binary")).alias("md5"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256")),
    "mf_inventory": lambda s, p: am.inventory(_contents(s, p), ASSEMBLIES).select("filename", "path", "bytes", "md5", "kind", "stem", "k", "track", "release"),
}

_SQL_SUFFIXES = "'fa.gz', 'chrom.sizes', 'gtf.gz', 'gtf.gz.md5', 'bw', 'masked.bed', 't2g.tsv', 'dropped_genes.tsv', 'metadata.json', 'bigWig', 'txt', 'fa.fai'"
#: Kinds by suffix, as the format has them, stated again.
_KIND = """WHEN ends_with(filename, '.gtf.gz') OR ends_with(filename, '.gtf') THEN 'annotation' WHEN ends_with(filename, '.fa.gz') OR ends_with(filename, '.fa') THEN 'genome' WHEN ends_with(filename, '.bw') OR ends_with(filename, '.bigWig') THEN 'mappability'
  WHEN ends_with(filename, '.chrom.sizes') THEN 'chrom_sizes' WHEN ends_with(filename, '.masked.bed') THEN 'mask_bed' WHEN ends_with(filename, '.t2g.tsv') THEN 't2g' WHEN ends_with(filename, '.dropped_genes.tsv') THEN 'dropped_genes'
  WHEN ends_with(filename, '.metadata.json') THEN 'provenance' WHEN ends_with(filename, '.md5') THEN 'checksum_sidecar'"""
_FILES = f"""f AS (SELECT k, concat_ws('.', ['GRCh38', 'GRCm39', 'T2T-CHM13v2', 'GRCh99'][g % 4 + 1], ['XX', 'XY', 'XZ'][g % 3 + 1], CASE WHEN g % 5 = 0 THEN 'noYPAR' END, 'ensembl-' || g,
  CASE WHEN k % 7 = 0 THEN 'k' || (k % 100) || '.single_read' END, [{_SQL_SUFFIXES}][k % 12 + 1]) AS filename FROM (SELECT p_partkey AS k, p_partkey // 12 AS g FROM part)),
g AS (SELECT *, string_split(filename, '.') AS w, CASE WHEN k % 6 < 4 THEN 'refs/' || string_split(filename, '.')[1] ELSE 'map' END || '/' || filename AS path FROM f),
h AS (SELECT *, CASE WHEN w[3] = 'noYPAR' THEN w[4] ELSE w[3] END AS src FROM g),
nm AS (SELECT k, filename, path, CASE WHEN w[1] IN ('GRCh38', 'GRCm39', 'T2T-CHM13v2') AND w[2] IN ('XX', 'XY') THEN concat_ws('.', w[1], w[2], CASE WHEN w[3] = 'noYPAR' THEN 'noYPAR' END, CASE WHEN regexp_matches(src, '-[0-9]') THEN src END) END AS stem,
  CASE {_KIND} ELSE 'other' END AS kind, coalesce(list_filter(w, lambda x: regexp_full_match(x, '[0-9]+'))[1], 'NA') AS release,
  nullif(regexp_extract(filename, '\\.k(\\d+)\\.(single_read|multi_read)\\.', 1), '')::INT AS kk, nullif(regexp_extract(filename, '\\.k(\\d+)\\.(single_read|multi_read)\\.', 2), '') AS track FROM h),
nn AS (SELECT *, coalesce(nullif(concat_ws('; ', 'k=' || kk, track), ''), '-') AS notes FROM nm),
cc AS (SELECT nn.*, CASE WHEN filename LIKE '%.metadata.json' THEN '{{"assembly": "A' || (k % 4) || '", "' || CASE WHEN k % 2 = 0 THEN 'variant' ELSE 'complement' END || '": "V' || (k % 3) || '", "annotation_source": "' || CASE WHEN k % 5 = 0 THEN '' ELSE 'ens' END
  || '", "tool_version": "' || (k % 6) || '", "par_status": "' || CASE WHEN k % 4 = 0 THEN 'verified' ELSE 'approximate' END || '", "restrict_to_genome": ' || CASE WHEN k % 9 = 0 THEN 'true' ELSE 'false' END || ', "genes_dropped_off_genome": ' || (k % 50)
  || ', "genes_partially_overlapping": ' || (k % 3) || ', "identical_to_standard_xy": ' || CASE WHEN k % 11 = 0 THEN 'true' ELSE 'false' END || CASE WHEN k % 13 = 0 THEN '' ELSE '}}' END ELSE coalesce(text, filename) END AS content FROM nn LEFT JOIN documents ON doc_id = k)"""
_MANIFEST = f"""WITH {_FILES}, fi AS (SELECT * FROM cc),
md AS (SELECT path AS mpath, json_valid(content) AS fine, CASE WHEN json_valid(content) THEN content END AS m FROM fi WHERE filename LIKE '%.metadata.json'),
jj AS (SELECT fi.*, coalesce(a.mpath, b.mpath) IS NOT NULL AS has, coalesce(a.fine, b.fine) AS fine, coalesce(CASE WHEN a.mpath IS NULL THEN b.m ELSE a.m END, NULL) AS m, kind = 'mappability' AS mapped
  FROM fi LEFT JOIN md a ON a.mpath = regexp_replace(path, '[^/]*$', '') || stem || '.metadata.json' LEFT JOIN md b ON b.mpath = 'refs/' || string_split(stem, '.')[1] || '/' || stem || '.metadata.json'),
v AS (SELECT *, nullif(m ->> '$.assembly', '') AS s_asm, coalesce(nullif(m ->> '$.variant', ''), nullif(m ->> '$.complement', '')) AS s_var, nullif(m ->> '$.annotation_source', '') AS s_src, nullif(m ->> '$.tool_version', '') AS s_ver,
  nullif(concat_ws('; ', CASE WHEN mapped AND kk IS NOT NULL THEN 'k=' || kk || ', ' || track END, CASE WHEN m ->> '$.identical_to_standard_xy' = 'true' THEN 'same as XY: no gene lies on the masked parts of Y' END, CASE WHEN m ->> '$.restrict_to_genome' = 'true' THEN replace('%d gene(s) left out that the genome has no contig for', '%d', m ->> '$.genes_dropped_off_genome') END,
  CASE WHEN m ->> '$.par_status' <> 'verified' THEN replace('pseudo-autosomal parts: %s', '%s', m ->> '$.par_status') END, CASE WHEN (m ->> '$.genes_partially_overlapping')::INT > 0 THEN replace('%d gene(s) across an edge of the mask, left out whole', '%d', m ->> '$.genes_partially_overlapping') END, CASE WHEN mapped THEN 'scores of the genome masked for this variant' END), '') AS said FROM jj),
o AS (SELECT *, CASE WHEN NOT has THEN '-' WHEN NOT fine THEN '' END AS none FROM v)
SELECT filename, strlen(content) AS bytes, md5(content) AS md5, sha256(content) AS sha256, kind, coalesce(none, s_asm, '') AS assembly, coalesce(none, s_var, '') AS variant, coalesce(none, CASE WHEN mapped THEN '-' ELSE s_src END, '-') AS source, coalesce(none, '-') AS release, coalesce(none, '-') AS flavour,
coalesce(none, CASE WHEN mapped THEN 'mappability' ELSE 'masking' END) AS tool, coalesce(none, s_ver, '-') AS tool_version, coalesce(none, '-') AS repo_revision, coalesce(none, said, '-') AS notes, path FROM o WHERE NOT regexp_matches(filename, '\\.(fai|log)$')"""
_ANNOTATIONS = """an AS (SELECT s_suppkey AS row_no, 's' || (s_suppkey % 3) AS source, (s_suppkey % 6 + 90)::VARCHAR AS release, CASE WHEN s_suppkey % 2 = 0 THEN 'primary' ELSE 'chr' END AS flavour, s_suppkey % 5 = 0 AS restricted,
  'Sp.A' || (s_suppkey % 4) || '.' || (s_suppkey % 6 + 90) || CASE WHEN s_suppkey % 8 = 0 THEN '.abinitio' WHEN s_suppkey % 10 = 0 THEN '.chr_patch_hapl_scaff' ELSE '' END || '.gtf.gz' AS name, 'https://host/' || (s_suppkey % 7) || '/' AS folder FROM supplier)"""


def _calls(idx: str) -> str:
    return f"""p AS (SELECT sample, avg(depth) FILTER (i < 22) AS a, max(depth) FILTER (i = 22) AS x, max(depth) FILTER (i = 23) AS y FROM ({idx}) GROUP BY sample), r AS (SELECT sample, CASE WHEN coalesce(a, 0) = 0 OR x IS NULL THEN 'nan'::DOUBLE ELSE x / a END AS x, CASE WHEN coalesce(a, 0) = 0 THEN 0 ELSE coalesce(y / a, 0) END AS y FROM p),
c AS (SELECT *, CASE WHEN isnan(x) THEN 'OTHER/CHECK' WHEN x >= 0.8 AND y <= 0.05 THEN 'XX' WHEN x >= 0.3 AND x <= 0.75 AND y >= 0.15 THEN 'XY' ELSE 'OTHER/CHECK' END AS call FROM r)"""


_IDX = "i AS (SELECT sample, i, count(*)::DOUBLE AS n, (1000 + 10 * i)::DOUBLE AS length FROM (SELECT o_orderpriority AS sample, o_custkey % 24 AS i FROM orders) GROUP BY sample, i)"
_OFFSETS = f"{d.with_('lines')}, o AS (SELECT contig, line_no, seq, coalesce(sum(length(seq)) OVER (PARTITION BY contig ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM lines)"
_PLACES = f"""{d.with_('bases')}, l AS MATERIALIZED (SELECT contig, string_agg(seq, '' ORDER BY line_no) AS s FROM bases GROUP BY contig),
t AS MATERIALIZED (SELECT contig, pos, substr(s, pos + 1, {1000 + K - 1}) AS t FROM (SELECT contig, s, unnest(range(0, length(s), 1000)) AS pos FROM l)),
k AS MATERIALIZED (SELECT contig AS chrom, pos + i - 1 AS start, substr(t, i, {K}) AS kmer FROM (SELECT *, unnest(range(1, length(t) - {K} + 2)) AS i FROM t)),
c AS (SELECT chrom, start, start + 1 AS "end", count(*) OVER (PARTITION BY kmer) AS n FROM k WHERE NOT contains(kmer, 'N')), {d.merged('c', 'm', 'chrom, n')}"""
ORACLE = {
    "sc_strip_chr": f"{d.with_('contigs')} SELECT chrom, replace(chrom, 'chr', '') AS contig_key, replace(chrom, 'chr', '') = '4' AS y_side, CASE WHEN k BETWEEN 1 AND 22 THEN k ELSE 25 END::INT AS rank FROM contigs",
    "sc_edges": f"{d.with_('contigs')} SELECT chrom, i::INT AS i, CASE WHEN i = 7 THEN raw_bp ELSE floor(i * (raw_bp / 7.0::DOUBLE))::BIGINT END AS edge FROM contigs, range(8) t(i)",
    "sc_stem_kind": f"WITH {_FILES} SELECT filename, stem, kind, release FROM nn",
    "sc_notes": f"WITH {_FILES} SELECT filename, notes FROM nn",
    "sc_names": f"WITH {_FILES} SELECT path, filename AS base, string_split(filename, '.fa')[1] AS prefix, w[1] AS first FROM nm JOIN (SELECT k, w FROM g) USING (k)",
    "sc_lists": "SELECT p_partkey, unnest(CASE WHEN p_partkey % 2 = 0 THEN ['a' || (p_partkey % 5), 'b'] ELSE ['a' || (p_partkey % 5), 'c'] END) AS item FROM part",
    "sc_metric": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (3, 4, 5) THEN 0 ELSE round_even(l_quantity / 2, 0) END::BIGINT AS metric FROM lineitem",
    "sq_offsets": f"{_OFFSETS} SELECT contig, line_no, \"offset\" FROM o",
    "sq_mask": f"""{_OFFSETS}, dn AS (SELECT doc_id AS contig, length(text) AS n FROM documents), mk AS (SELECT contig, n // 10 AS s, n // 5 AS e FROM dn UNION ALL SELECT contig, n // 6, n // 4 FROM dn UNION ALL SELECT contig, n - n // 8, 1000000000 FROM dn WHERE n - n // 8 <> -1),
z AS (SELECT contig, line_no, "offset", seq, list({{'s': greatest(s - "offset", 0), 'e': least(e - "offset", length(seq))}}) FILTER (s IS NOT NULL) AS ms FROM o LEFT JOIN (SELECT * FROM mk WHERE s < e) mk USING (contig) GROUP BY ALL)
SELECT contig, line_no, "offset", md5(coalesce(array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN len(list_filter(ms, lambda m: m.s < i AND i <= m.e)) > 0 THEN 'N' ELSE substr(seq, i, 1) END), ''), '')) AS seq_md5 FROM z""",
    "sq_kmers": f"WITH k AS (SELECT unnest(list_transform(range(1, length(text) - {K} + 2), lambda i: substr(text, i, {K}))) AS kmer FROM documents WHERE length(text) >= {K}), c AS (SELECT kmer, count(*) AS n FROM k WHERE NOT contains(kmer, 'N') GROUP BY kmer) SELECT n, count(*) AS kmers, 1.0::DOUBLE / n AS value FROM c GROUP BY n",
    "mk_genome": f"""{d.with_('bases')}, o AS (SELECT complement, contig, line_no, seq, coalesce(sum(length(seq)) OVER (PARTITION BY complement, contig ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM bases, (VALUES ('XX'), ('XY')) v(complement)),
pl AS (SELECT 'XX' AS complement, 'src4' AS contig, 0 AS s, 1000000000 AS e UNION ALL SELECT 'XY', 'src4', s_suppkey * 7919 % 40000, s_suppkey * 7919 % 40000 + 50 + s_suppkey FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT c, 'src' || (n_nationkey % 20), n_nationkey * 1000, n_nationkey * 1000 + 500 FROM nation, (VALUES ('XX'), ('XY')) v(c)),
z AS (SELECT o.complement, o.contig, line_no, "offset", seq, list({{'s': s - "offset", 'e': e - "offset"}}) FILTER (s IS NOT NULL) AS ms FROM o LEFT JOIN pl ON pl.complement = o.complement AND pl.contig = o.contig AND s < "offset" + length(seq) AND e > "offset" GROUP BY ALL)
SELECT complement, contig, line_no, "offset", md5(CASE WHEN ms IS NULL THEN seq ELSE array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN len(list_filter(ms, lambda m: m.s < i AND i <= m.e)) > 0 THEN 'N' ELSE substr(seq, i, 1) END), '') END) AS seq_md5 FROM z""",
    "sq_uniqueness": f'{_PLACES} SELECT chrom, start, "end", n, (1.0::DOUBLE / n)::FLOAT AS score FROM m',
    "tr_single_bases": f'{_PLACES} SELECT chrom, sum("end" - start)::BIGINT AS unique_bp FROM m WHERE n = 1 GROUP BY chrom',
    "sq_allowed": f"{d.with_('lines')} SELECT chrom, count(*) AS n_lines, sum(length(seq))::BIGINT AS bp FROM (SELECT (CASE WHEN contig % 2 = 0 THEN 'chr' ELSE '' END) || (contig % 30) AS chrom, contig % 30 AS k, seq FROM lines) WHERE k IN (1, 2, 28) GROUP BY chrom",
    "pl_nonpar": f"""{d.with_('contigs', 'ivals')}, xy AS (SELECT * FROM contigs WHERE k IN (1, 2)), par AS (SELECT chrom, start, "end" FROM ivals JOIN xy USING (chrom) WHERE kind = 'A'), {d.clipped('par', 'pc', 'xy')}, {d.merged('pc', 'pm')}, {d.complemented('pm', 'np', 'xy')}
SELECT chrom, start, "end", 'PAR' AS part, chrom AS raw_name FROM par UNION ALL SELECT chrom, start, "end", replace(chrom, 'chr', '') || '_nonPAR', NULL FROM np UNION ALL SELECT chrom, start, "end", 'haploid', NULL FROM np""",
    "cc_call": f"WITH {_IDX}, {_calls('SELECT *, n / length AS depth FROM i')} SELECT sample, round(x, 9) AS x_ratio, round(y, 9) AS y_ratio, call FROM c",
    "cc_mappable": f"WITH {_IDX}, mb AS (SELECT DISTINCT s_suppkey % 24 AS i, CASE WHEN s_suppkey % 24 = 5 THEN 0 ELSE 500 + 20 * (s_suppkey % 24) END::DOUBLE AS bp FROM supplier WHERE s_suppkey % 24 NOT IN (3, 4)), {_calls('SELECT i.*, CASE WHEN coalesce(bp, length) = 0 THEN 0 ELSE n / coalesce(bp, length) END AS depth FROM i LEFT JOIN mb USING (i)')} SELECT sample, round(x, 9) AS x_ratio, round(y, 9) AS y_ratio, call FROM c",
    "cc_report": f"""WITH {_IDX}, {_calls("SELECT *, n / length AS depth FROM i WHERE NOT (sample LIKE '1%' AND i = 22) AND NOT (sample LIKE '2%' AND i < 22) AND NOT (sample LIKE '3%' AND i = 23)")} SELECT sample, CASE WHEN isnan(x) THEN 'nan' ELSE printf('%.3f', x) END AS x_ratio, printf('%.3f', y) AS y_ratio, call FROM c""",
    "cc_first_xy": "WITH z AS (SELECT s_nationkey AS genome, (CASE WHEN s_suppkey % 2 = 0 THEN 'chr' ELSE '' END) || (CASE s_suppkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' ELSE '9' END) AS chrom, s_suppkey * 10 AS raw_bp, s_suppkey AS ord, CASE s_suppkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' END AS key FROM supplier) SELECT genome, chrom, raw_bp, key FROM z WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY genome, key ORDER BY ord) = 1",
    "rg_refused": f"WITH {_ANNOTATIONS} SELECT row_no, folder || name AS url FROM an WHERE name LIKE '%abinitio%' OR contains(name, 'chr_patch_hapl_scaff')",
    "rg_by_basename": f"WITH {_ANNOTATIONS}, n AS (SELECT DISTINCT 'Sp.A' || (p_partkey % 5) || '.' || (p_partkey % 8 + 90) || '.gtf.gz' AS filename, (p_partkey % 8 + 90)::VARCHAR AS own FROM part), f AS (SELECT * FROM an QUALIFY row_number() OVER (PARTITION BY name ORDER BY row_no) = 1) SELECT filename, coalesce(source, 'unknown') AS source, coalesce(release, own) AS release, flavour, coalesce(restricted, false) AS restricted FROM n LEFT JOIN f ON name = filename",
    "rg_either_name": f"{d.with_('contigs')} SELECT k::VARCHAR AS chrom, k, CASE WHEN k % 3 <> 0 AND k % 2 = 1 THEN k::VARCHAR WHEN k % 3 <> 0 OR k % 10 = 0 THEN 'chr' || k END AS track_name FROM contigs",
    "rg_report_rename": f"{d.with_('contigs')} SELECT k, coalesce(CASE WHEN n_nationkey = 9 THEN 'chrM' WHEN n_nationkey % 3 = 0 THEN 'chr' || n_nationkey ELSE n_nationkey::VARCHAR END, chrom) AS name FROM contigs LEFT JOIN nation ON chrom = n_nationkey::VARCHAR",
    "mf_manifest": _MANIFEST,
    "rg_first_seen": "SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderpriority) = 1",
    "rg_preference": """WITH r AS (SELECT 'asm' || (s_nationkey % 5) AS assembly, ['ensembl', 'ucsc', 'ncbi', 'other'][s_suppkey % 4 + 1] AS source, 'url' || s_suppkey AS url, s_suppkey AS row_no FROM supplier), q AS (SELECT *, list_position(['ensembl', 'ucsc', 'ncbi'], source) AS pos FROM r)
SELECT assembly, source, row_no, url FROM q WHERE pos > 0 QUALIFY row_number() OVER (PARTITION BY assembly ORDER BY pos, source, row_no) = 1""",
    "rg_select": "SELECT 'asm1' AS assembly, 'ensembl' AS source, 'primary' AS flavour, '1' AS is_latest, (s_suppkey % 9 + 100)::VARCHAR AS release, 'url' || s_suppkey AS url, s_suppkey AS row_no FROM supplier WHERE s_nationkey % 5 = 1 AND s_suppkey % 4 = 0 AND s_suppkey % 2 = 0 AND s_suppkey % 3 = 0",
    "rg_rename": f"{d.with_('contigs')} SELECT k, coalesce('NC_' || n_regionkey || '_' || n_name, chrom) AS name FROM contigs LEFT JOIN nation ON chrom = n_nationkey::VARCHAR",
    "mf_content": "SELECT doc_id, md5(coalesce(text, '')) AS content_md5 FROM documents",
    "mf_digest": "SELECT doc_id, strlen(text) AS bytes, md5(text) AS md5, sha256(text) AS sha256 FROM documents",
    "mf_inventory": f"WITH {_FILES} SELECT filename, path, strlen(content) AS bytes, md5(content) AS md5, kind, stem, kk AS k, track, release FROM cc WHERE NOT regexp_matches(filename, '\\.(fai|log)$')",
}
