"""Column expressions of the domain: contig names, coordinates, attributes, file names, thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Primary chromosomes in canonical order (fixed values).
PRIMARY = [*(str(i) for i in range(1, 23)), "X", "Y"]
#: File kinds by suffix, the first match wins (fixed values of the manifest format).
KINDS = [
    (".gtf.gz", "annotation"),
    (".gtf", "annotation"),
    (".fa.gz", "genome"),
    (".fa", "genome"),
    (".bw", "mappability"),
    (".bigWig", "mappability"),
    (".chrom.sizes", "chrom_sizes"),
    (".masked.bed", "mask_bed"),
    (".t2g.tsv", "t2g"),
    (".dropped_genes.tsv", "dropped_genes"),
    (".metadata.json", "provenance"),
    (".md5", "checksum_sidecar"),
]


def contig_key(name: Column) -> Column:
    """First token of a contig name without a leading, case-sensitive `chr`."""
    return F.regexp_replace(F.element_at(F.split(F.trim(name), r"\s+"), 1), "^chr", "")


def is_y_side(name: Column, y_key: Column) -> Column:
    """True on the Y contig, by its usual name in any case or by the given key."""
    key = contig_key(name)
    return (F.upper(key) == "Y") | (key == y_key)


def chrom_rank(key: Column) -> Column:
    """Place in the canonical order; other names come after, by name."""
    at = F.array_position(F.array(*[F.lit(x) for x in PRIMARY]), key)
    return F.when(at > 0, at).otherwise(F.lit(len(PRIMARY) + 1))


def overlaps_bed(start1: Column, end1: Column, start0: Column, end0: Column) -> Column:
    """A 1-based inclusive span meets a 0-based half-open one."""
    return (start1 - 1 < end0) & (end1 > start0)


def within_bed(start1: Column, end1: Column, start0: Column, end0: Column) -> Column:
    """A 1-based inclusive span lies inside a 0-based half-open one."""
    return (start1 - 1 >= start0) & (end1 <= end0)


def _attribute(key: str) -> str:
    return f'(?:^|; ){key} "([^"]*)"'


def attribute(attributes: Column, key: str) -> Column:
    """Value of a key of a packed attribute column, at its start or right after "; "; null if missing or empty."""
    return F.nullif(F.regexp_extract(attributes, _attribute(key), 1), F.lit(""))


def first_attribute(attributes: Column, *keys: str) -> Column:
    """Value of the first of several keys that is there, be it empty; an empty string if none is."""
    return F.coalesce(*(F.when(attributes.rlike(_attribute(k)), F.regexp_extract(attributes, _attribute(k), 1)) for k in keys), F.lit(""))


def hard_mask(sequence: Column, offset: Column, masks: Column) -> Column:
    """N over the parts of a line that masks cover. offset: of the line in its contig; masks: array of struct(start, end)."""
    size = F.length(sequence)

    def over(text: Column, mask: Column) -> Column:
        low, high = F.greatest(mask["start"] - offset, F.lit(0)).cast("int"), F.least(mask["end"] - offset, size).cast("int")
        return F.when(high > low, F.concat(F.substring(text, F.lit(1), low), F.repeat(F.lit("N"), high - low), F.substring(text, high + 1, size))).otherwise(text)

    return F.aggregate(masks, sequence, over)


def parse_list(text: Column) -> Column:
    """Items of a comma list, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def file_stem(name: Column, assemblies: list[str]) -> Column:
    """Assembly, complement, and what qualifies them, from a dotted file name; null if it doesn't begin so."""
    parts = F.split(name, r"\.")
    third, fourth = F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    marked = F.coalesce(third == "noYPAR", F.lit(False))
    source = F.when(marked, fourth).otherwise(third)
    stem = F.concat_ws(".", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.when(marked, F.lit("noYPAR")), F.when(source.rlike("-[0-9]"), source))
    return F.when(F.get(parts, F.lit(0)).isin(assemblies) & F.coalesce(F.get(parts, F.lit(1)).isin("XX", "XY"), F.lit(False)), stem)


def file_kind(name: Column) -> Column:
    """What a product file holds, by suffix."""
    first, *rest = KINDS
    return reduce(lambda c, k: c.when(name.endswith(k[0]), F.lit(k[1])), rest, F.when(name.endswith(first[0]), F.lit(first[1]))).otherwise(F.lit("other"))


def kmer_of(name: Column) -> Column:
    """Read length in a track's name, or null."""
    return F.nullif(F.regexp_extract(name, r"\.k(\d+)\.(single_read|multi_read)\.", 1), F.lit("")).cast("int")


def track_of(name: Column) -> Column:
    """single_read or multi_read in a track's name, or null."""
    return F.nullif(F.regexp_extract(name, r"\.k(\d+)\.(single_read|multi_read)\.", 2), F.lit(""))


def release_of(name: Column) -> Column:
    """The first all-digit token of a dotted name, else NA."""
    return F.coalesce(F.get(F.filter(F.split(name, r"\."), lambda x: x.rlike("^[0-9]+$")), F.lit(0)), F.lit("NA"))


def notes(*parts: Column) -> Column:
    """The parts that have a value, joined by "; "; "-" if none has."""
    return F.coalesce(F.nullif(F.concat_ws("; ", *(F.nullif(p, F.lit("")) for p in parts)), F.lit("")), F.lit("-"))


def basename(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def product_prefix(name: Column, suffix: str) -> Column:
    """A file name up to the first `suffix`, such as .fa or .gtf; the name itself without one."""
    return F.substring_index(name, suffix, 1)


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def territory_of(key: Column) -> Column:
    """X and Y by themselves, all other contigs as autosomes."""
    return F.when(key == "X", F.lit("chrX")).when(key == "Y", F.lit("chrY")).otherwise(F.lit("Autosomes"))


def label_rank(label: Column, order: list[str], first_seen: Column) -> Column:
    """Place of a label in an order of its own; labels that it lacks follow as they were first seen."""
    at = F.array_position(F.array(*[F.lit(x) for x in dict.fromkeys(order)]), label)
    return F.when(at > 0, at).otherwise(F.lit(len(order)).cast("long") + 1 + first_seen)


def three_places(value: Column) -> Column:
    """A number with three decimals, as C's %.3f prints it; what is no number as nan."""
    return F.when(value.isNull() | F.isnan(value), F.lit("nan")).otherwise(F.format_string("%.3f", value))


def whole_metric(value: Column) -> Column:
    """A metric as a whole number: what is no number counts as 0, halves go to the even side."""
    return F.rint(F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))).cast("long")


def threshold_label(threshold: float) -> str:
    """Name of the column of bases with at least this score."""
    return f"t{round(100 * threshold):02d}_bp"


def bin_edge(index: Column, bins: int, length: Column) -> Column:
    """Edge of equal bins in double, cut to a whole number; the last one is the length."""
    return F.when(index == bins, length).otherwise((index * (length / F.lit(float(bins)))).cast("long"))


def safe_ratio(a: Column, b: Column, without: float = 0.0) -> Column:
    """a / b; where a is missing, or b is missing or 0, `without`."""
    return F.coalesce(F.try_divide(a, b), F.lit(without))
