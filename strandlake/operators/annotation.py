"""Order-aware filtering of an annotation against a mask, and gene and transcript aggregation.

Features are rows of line_no, which no two share, and the nine fields of the format (seqname, source, feature, start,
end, score, strand, frame, attributes), 1-based inclusive. What a sequential reader would see first is decided by
line_no. A feature without a gene_id belongs to the gene "" of its seqname.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.columns import attribute, contig_key, first_attribute, is_y_side
from strandlake.functions.lineage import stored
from strandlake.operators import intervals as iv

FIELDS = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"]
KEEP, DROP_ALL, INSPECT = "KEEP", "DROP_ALL", "INSPECT"


def parsed(features: DataFrame) -> DataFrame:
    """Features with `n` (1), contig_key and the attributes that the operators read."""
    a = F.col("attributes")
    return features.select(
        "line_no", *FIELDS, F.lit(1).cast("long").alias("n"), contig_key(F.col("seqname")).alias("contig_key"), first_attribute(a, "gene_id").alias("gene_id"), attribute(a, "transcript_id").alias("transcript_id"),
        first_attribute(a, "gene_name", "gene").alias("gene_name"), first_attribute(a, "gene_biotype", "gene_type").alias("gene_biotype"),
    )


def classify(features: DataFrame, masks: DataFrame, genome: DataFrame, unknown: str = "warn") -> DataFrame:
    """For each seqname its class: KEEP (no mask), DROP_ALL (masked from end to end), else INSPECT.

    Names that the genome lacks: DROP_ALL if `unknown` is "drop", else KEEP. masks: chrom, start, end, name; genome:
    chrom, raw_bp.
    """
    names = features.select("seqname", contig_key(F.col("seqname")).alias("contig_key")).distinct()
    sized = genome.select(contig_key(F.col("chrom")).alias("chrom"), "raw_bp")
    spans = iv.closed_span(masks.withColumn("chrom", contig_key(F.col("chrom"))), sized).select(F.col("chrom").alias("contig_key"), "closed")
    joined = names.join(sized.withColumnRenamed("chrom", "contig_key"), "contig_key", "left").join(spans, "contig_key", "left")
    kind = (
        F.when(F.col("raw_bp").isNull(), F.lit(DROP_ALL if unknown == "drop" else KEEP))
        .when(F.col("closed").isNull(), F.lit(KEEP))
        .when(F.col("closed"), F.lit(DROP_ALL))
        .otherwise(F.lit(INSPECT))
    )
    return joined.select("seqname", "contig_key", kind.alias("class"), F.col("raw_bp").isNull().alias("off_genome"))


def mask_test(features: DataFrame, masks: DataFrame, rule: str = "any", y_key: str = "Y", classes: DataFrame | None = None) -> DataFrame:
    """parsed() features with hit, partial, on_y (the deciding mask is no extra one, and the contig is on the Y side) and touched.

    Masks that overlap a feature count in the order (start, end, name). Rule any: the first one decides; partial if
    it does not contain the feature. Rule contained: the first that contains it decides; partial if another one
    overlapped before, or if some overlap but none contains it. So it is partial, by either rule, if the first that
    overlaps does not contain it. touched: a mask overlaps, by whichever rule. Features meet an index of masks by one
    search, and are shuffled once, with all their columns. With classes their features also get class and off_genome.
    """
    placed = masks.select(contig_key(F.col("chrom")).alias("chrom"), "start", "end", "name")
    # rule any: the first mask that ends behind a feature's start. Rule contained: the first that ends at or behind its
    # end, and the furthest end before; masks before that one which overlap end inside of the feature
    index = iv.reaching(placed, ["name"], before=None if rule == "any" else "before")
    known = F.col("seqname").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    at = F.when(known, F.col("start" if rule == "any" else "end")).otherwise(F.lit(0))
    verdicts = ["hit", "partial", "on_y", "touched", "class", "off_genome", "reason"]
    points = features.withColumns({"chrom": F.coalesce("contig_key", F.lit("")), "at": at.cast("long")}).drop(*verdicts, "contig_key")
    contigs = None if classes is None else classes.select(F.col("contig_key").alias("chrom"), "class", "off_genome").distinct()
    met = iv.first_reaching(points, index, "mask", contigs=contigs).withColumn("contig_key", F.when(F.col("seqname").isNotNull(), F.col("chrom")))
    mask = F.col("mask")
    begins, ahead = mask["start"] <= F.col("start") - 1, mask["start"] < F.col("end")
    if rule == "any":
        hit, touched = ahead, ahead
        partial = ahead & ~(begins & (mask["end"] >= F.col("end")))
    else:
        earlier = F.coalesce(mask["before"] > F.col("start") - 1, F.lit(False))
        hit, touched = begins, ahead | earlier
        partial = F.when(begins, earlier).otherwise(touched)
    on_y = hit & ~F.coalesce(mask["name"].startswith("extra:"), F.lit(True)) & is_y_side(F.col("contig_key"), F.lit(y_key))
    told = {"hit": hit, "partial": partial, "on_y": on_y, "touched": touched}
    return met.withColumns({n: F.coalesce(known & c, F.lit(False)) for n, c in told.items()}).drop("chrom", "at", "mask")


def verdicts(features: DataFrame, classes: DataFrame, masks: DataFrame, rule: str = "any", y_key: str = "Y") -> DataFrame:
    """Features with class, hit, partial and reason, by the class of their contig; the masks decide on INSPECT contigs only."""
    tested = mask_test(features.where("seqname IS NOT NULL"), masks, rule, y_key, classes)
    inspected, gone = F.col("class") == INSPECT, F.col("class") == DROP_ALL
    by_mask = F.when(~F.col("on_y"), F.lit("extra_mask_overlap")).when(F.col("partial"), F.lit("y_par_overlap_partial")).otherwise(F.lit("y_par_overlap"))
    why = F.when(gone, F.when(F.col("off_genome"), F.lit("seqname_not_in_genome")).otherwise(F.lit("whole_contig_masked"))).when(inspected & F.col("hit"), by_mask)
    return tested.withColumns({"hit": gone | (inspected & F.col("hit")), "partial": inspected & F.col("partial"), "on_y": inspected & F.col("on_y"), "reason": why})


def judged(features: DataFrame, classes: DataFrame, masks: DataFrame, rule: str = "any", y_key: str = "Y") -> DataFrame:
    """verdicts(), stored, as genes are told from them before features are."""
    return stored(verdicts(features, classes, masks, rule, y_key))


def _first(value: Column, when: Column) -> Column:
    return F.min(F.when(when, F.struct(F.col("line_no"), value.alias("v"))))["v"]


def _of_gene() -> list[Column]:
    """hit, partial and reason of a gene, told from its judged features."""
    strong = F.col("reason").isNotNull() & (F.col("reason") != "y_par_overlap")
    return [F.bool_or("hit").alias("hit"), F.bool_or("partial").alias("partial"), F.coalesce(_first(F.col("reason"), strong), F.max("reason")).alias("reason")]


def genes(features: DataFrame) -> DataFrame:
    """One row for each (seqname, gene_id): span, first non-empty name and biotype, first strand but ".", counts; with reasons if judged.

    A gene's reason is the first one in the order of lines that is more than a whole overlap on the Y side.
    """
    judged_ = "reason" in features.columns
    return features.groupBy("seqname", "gene_id").agg(
        F.sum("n").alias("n_features"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.coalesce(_first(F.col("gene_name"), F.col("gene_name") != ""), F.lit("")).alias("gene_name"),
        F.coalesce(_first(F.col("gene_biotype"), F.col("gene_biotype") != ""), F.lit("")).alias("gene_biotype"),
        F.coalesce(_first(F.col("strand"), F.col("strand") != "."), F.lit(".")).alias("strand"),
        F.count_distinct("transcript_id").alias("n_transcripts"),
        F.coalesce(F.sum(F.when(F.col("feature") == "exon", F.col("n"))), F.lit(0)).alias("n_exons"),
        *(_of_gene() if judged_ else []),
    )


def exonic(features: DataFrame) -> DataFrame:
    """Bases in the union of the exons of each (seqname, gene_id)."""
    exons = features.where("feature = 'exon'").select("seqname", "gene_id", (F.col("start") - 1).alias("start"), "end")
    return iv.lengths(iv.merge(exons, ["seqname", "gene_id"]), ["seqname", "gene_id"], "exonic_bp")


def dropped_genes(judged_: DataFrame) -> DataFrame:
    """The genes with a hit, as their report has them."""
    gone = genes(judged_).where("hit")
    return gone.join(exonic(judged_), ["seqname", "gene_id"], "left").select("seqname", "gene_id", "gene_name", "gene_biotype", "start", "end", "strand", "n_transcripts", "n_exons", F.coalesce("exonic_bp", F.lit(0)).cast("long").alias("exonic_bp"), "reason", "n_features")


def kept_by_gene(judged_: DataFrame) -> DataFrame:
    """Features of genes that no feature condemned; the key is (seqname, gene_id), never the id alone."""
    gone = judged_.where("hit").select("seqname", "gene_id").distinct()
    return judged_.where("NOT hit").join(gone, ["seqname", "gene_id"], "left_anti")


def _by_transcript(judged_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The genes and the transcripts that go, by seqname."""
    by_transcript = judged_.where("transcript_id IS NOT NULL").groupBy("seqname", "gene_id", "transcript_id").agg(F.bool_or("hit").alias("hit_here"))
    some = by_transcript.where("hit_here").select("seqname", "transcript_id").distinct()
    # a transcript id that another gene of the seqname shares goes for both
    lost = by_transcript.join(some.withColumn("lost", F.lit(True)), ["seqname", "transcript_id"], "left").groupBy("seqname", "gene_id").agg(F.bool_and(F.coalesce("lost", F.lit(False))).alias("all_lost"))
    condemned = judged_.groupBy("seqname", "gene_id").agg(F.bool_or("hit").alias("any_hit"))
    whole = condemned.where("any_hit").join(lost, ["seqname", "gene_id"], "left").where("coalesce(all_lost, true)").select("seqname", "gene_id")
    return whole, some


def kept_by_transcript(judged_: DataFrame) -> DataFrame:
    """Features of transcripts without a hit; rows without one go with their gene, which goes if it has none or all go."""
    whole, some = _by_transcript(judged_)
    inside = judged_.where(F.col("class") != DROP_ALL)
    return inside.join(whole, ["seqname", "gene_id"], "left_anti").join(some, ["seqname", "transcript_id"], "left_anti")


def kept_by_feature(judged_: DataFrame) -> DataFrame:
    """Features without a hit of their own."""
    return judged_.where("NOT hit")


#: How features are dropped: with their gene, with their transcript, or one by one.
UNITS = {"gene": kept_by_gene, "transcript": kept_by_transcript, "feature": kept_by_feature}


def predicted(judged_: DataFrame, unit: str = "gene") -> DataFrame:
    """One row: n_in, genes_dropped, and n_predicted, the features that ought to be left as told from whole genes (null by feature)."""
    if unit == "feature":
        return judged_.agg(F.count(F.lit(1)).alias("n_in"), F.lit(0).cast("long").alias("genes_dropped"), F.lit(None).cast("long").alias("n_predicted"))
    totals = genes(judged_).select("seqname", "gene_id", "n_features", "hit")
    if unit == "transcript":
        whole, _ = _by_transcript(judged_)
        totals = totals.drop("hit").join(whole.withColumn("hit", F.lit(True)), ["seqname", "gene_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return totals.agg(
        F.coalesce(F.sum("n_features"), F.lit(0)).alias("n_in"), F.count_if("hit").alias("genes_dropped"),
        (F.coalesce(F.sum("n_features"), F.lit(0)) - F.coalesce(F.sum(F.when(F.col("hit"), F.col("n_features"))), F.lit(0))).alias("n_predicted"),
    )


def counts(judged_: DataFrame, kept: DataFrame) -> DataFrame:
    """Features of each seqname: n_in, max_end, and n_out of those that are left."""
    before = judged_.groupBy("seqname").agg(F.sum("n").alias("n_in"), F.max("end").alias("max_end"))
    after = kept.groupBy("seqname").agg(F.sum("n").alias("n_out"))
    return before.join(after, "seqname", "left").select("seqname", "n_in", "max_end", F.coalesce("n_out", F.lit(0)).cast("long").alias("n_out"))


def survivors_on_mask(kept: DataFrame, masks: DataFrame) -> DataFrame:
    """Kept features that still overlap a mask."""
    return mask_test(kept.select("line_no", *FIELDS, "n", "contig_key"), masks).where("touched").select("line_no", *FIELDS, "n")


def summary(judged_: DataFrame, kept: DataFrame, masks: DataFrame, x_key: str = "X", y_key: str = "Y") -> DataFrame:
    """One row of what a variant's report states: features and genes dropped and why, X and Y counts, survivors on the mask.

    Genes on names that the genome lacks are counted apart: they tell nothing of the mask.
    """
    x, y = F.col("contig_key") == x_key, F.col("contig_key") == y_key
    before = judged_.agg(F.sum("n").alias("features_in"), F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)).alias("x_in"))
    after = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("features_out"), F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)).alias("x_out"), F.coalesce(F.sum(F.when(y, F.col("n"))), F.lit(0)).alias("y_out"))
    off = F.col("reason") == "seqname_not_in_genome"
    g = genes(judged_).agg(F.count_if(F.col("hit") & ~off).alias("genes_dropped_by_mask"), F.count_if(F.col("hit") & off).alias("genes_dropped_off_genome"), F.count_if("partial").alias("genes_partial"))
    on_mask = survivors_on_mask(kept, masks).agg(F.count(F.lit(1)).alias("kept_on_mask"))
    one = before.withColumn("_one", F.lit(1))
    for part in (after, g, on_mask):  # a row each
        one = one.join(part.withColumn("_one", F.lit(1)), "_one")
    return one.drop("_one").withColumn("identical_to_standard", F.col("genes_dropped_by_mask") == 0)


def summary_by_gene(verdicts_: DataFrame, x_key: str = "X", y_key: str = "Y") -> DataFrame:
    """As summary() of kept_by_gene() by the masks that judged: all is told from one row for each gene."""
    g = verdicts_.groupBy("seqname", "contig_key", "gene_id").agg(F.sum("n").alias("n"), F.count_if("touched").alias("n_touched"), *_of_gene())
    off = F.coalesce(F.col("reason") == "seqname_not_in_genome", F.lit(False))
    of = lambda n, when: F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0))
    x, y, kept = F.col("contig_key") == x_key, F.col("contig_key") == y_key, ~F.col("hit")
    one = g.agg(
        of("n", F.lit(True)).alias("features_in"), of("n", x).alias("x_in"), of("n", kept).alias("features_out"), of("n", kept & x).alias("x_out"), of("n", kept & y).alias("y_out"),
        F.count_if(F.col("hit") & ~off).alias("genes_dropped_by_mask"), F.count_if(F.col("hit") & off).alias("genes_dropped_off_genome"), F.count_if("partial").alias("genes_partial"), of("n_touched", kept).alias("kept_on_mask"),
    )
    return one.withColumn("identical_to_standard", F.col("genes_dropped_by_mask") == 0)


def t2g(kept: DataFrame) -> DataFrame:
    """For each transcript the first gene_id and gene_name, where it was first seen, and whether other genes claim it."""
    first = F.min(F.struct("line_no", "gene_id", "gene_name"))
    return kept.where("transcript_id IS NOT NULL").groupBy("transcript_id").agg(first.alias("f"), (F.count_distinct("gene_id") > 1).alias("collision")).select("transcript_id", "f.gene_id", "f.gene_name", F.col("f.line_no").alias("first_line"), "collision")


def unknown_names(features: DataFrame, genome: DataFrame, most: int = 20) -> DataFrame:
    """Features by name that the genome lacks: the `most` names with most of them."""
    known = genome.select(contig_key(F.col("chrom")).alias("contig_key"))
    missing = features.join(known, "contig_key", "left_anti").groupBy("seqname").agg(F.sum("n").alias("n_features"))
    return missing.orderBy(F.desc("n_features"), "seqname").limit(most)


def out_of_range(features: DataFrame, genome: DataFrame) -> DataFrame:
    """Names whose features end behind their contig: seqname, max_end, length."""
    ends = features.groupBy("seqname", "contig_key").agg(F.max("end").alias("max_end"), F.sum("n").alias("n_features"))
    return ends.join(genome.select(contig_key(F.col("chrom")).alias("contig_key"), F.col("raw_bp").alias("length")), "contig_key").where("max_end > length").select("seqname", "max_end", "length", "n_features")


def naming_votes(features: DataFrame) -> DataFrame:
    """Whether most names have the chr prefix."""
    names = features.select("seqname").distinct()
    return names.agg(F.count(F.lit(1)).alias("n_names"), F.count_if(F.col("seqname").startswith("chr")).alias("n_prefixed")).withColumn("prefixed", 2 * F.col("n_prefixed") > F.col("n_names"))


def zero_filled(universe: DataFrame, counts_: DataFrame, key: list[str], value: str) -> DataFrame:
    """A count for each key of the universe, 0 where there is none."""
    return universe.select(*key).distinct().join(counts_.select(*key, value), key, "left").select(*key, F.coalesce(value, F.lit(0)).alias(value))


def examples(rows: DataFrame, column: str, order: str, most: int) -> DataFrame:
    """The first `most` values of a column by an order, for a report."""
    return rows.orderBy(order, column).limit(most).select(column)


def provenance(facts: dict[str, object], notes: list[str] = (), prefix: str = "filter") -> list[str]:
    """Comment lines for the head of an annotation: `#!prefix-key value` of the facts that have a value, then the notes."""
    return [f"#!{prefix}-{k} {v}" for k, v in facts.items() if v is not None] + [f"#!{prefix}-note {n}" for n in notes]
