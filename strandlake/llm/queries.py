"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm import alignment, bpe, divergence, gam, html, linededup, mixing, mpeg, ngramjoin, rules, sharding, suffixes, topk
from strandlake.llm.common import table

#: Target weights of the mixture: sources with a weight of their own, and one for all others.
WEIGHTS, OTHERS, MIX_BLOCK, MIX_SEED = {"src0": 5, "src1": 3, "src2": 2}, 10, 8, 23
#: Labelled documents that a fit takes at most.
FIT_ROWS = 20_000


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of a learned decision list."""
    docs = table(spark, sf_dir, "documents")
    return rules.judged(docs, rules.learned(docs, table(spark, sf_dir, "labels"), most_rows=FIT_ROWS))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of every document in a mixture of sources by weight."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.scheduled(docs, WEIGHTS, OTHERS, MIX_BLOCK, MIX_SEED)


def op4_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of nine tenths of their three-word shingles."""
    return ngramjoin.joined(table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op4_ngrams, with the number of links of every document, for which all links are verified."""
    return ngramjoin.linked(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored in an MPEG audio stream and read back."""
    return mpeg.digests(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that other documents share."""
    return linededup.digests(table(spark, sf_dir, "documents"), least_chars=40, least_docs=5)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=8, seed=11)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return gam.classified(docs, gam.trained(docs, table(spark, sf_dir, "labels"), most_rows=FIT_ROWS), 0.3)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document under the public 50k byte-level vocabulary."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without strings of 100 bytes that came before."""
    return suffixes.digests(table(spark, sf_dir, "documents"), 100)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two public vocabularies, aligned, and how often linked ids meet in the corpus."""
    import public_tokenizers

    paths = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(table(spark, sf_dir, "documents"), *paths)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of each language by how far their words are apart, and each source's own words."""
    return divergence.audited(table(spark, sf_dir, "documents"), least_docs=10, most_terms=10)


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, by exact inner product with all others."""
    return topk.searched(table(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES = {
    "op1_html": op1_html,
    "op2_rules": op2_rules,
    "op3_mixing": op3_mixing,
    "op4_ngrams": op4_ngrams,
    "op4_links": op4_links,
    "op5_mpeg": op5_mpeg,
    "op6_lines": op6_lines,
    "op7_shards": op7_shards,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_suffixes": op10_suffixes,
    "op11_alignment": op11_alignment,
    "op12_divergence": op12_divergence,
    "op13_topk": op13_topk,
}
ORACLE = {
    "op4_ngrams": ngramjoin.oracle(words=3, percent=90),
    "op4_links": ngramjoin.oracle_links(words=3, percent=90),
    "op1_html": html.ORACLE,
    "op5_mpeg": mpeg.oracle(),
    "op3_mixing": mixing.oracle(WEIGHTS, OTHERS, MIX_BLOCK, MIX_SEED),
    "op6_lines": linededup.ORACLE,
    "op7_shards": sharding.oracle(8, 11),
    "op12_divergence": divergence.oracle(10, 10),
    "op13_topk": topk.oracle(50, 5),
}
