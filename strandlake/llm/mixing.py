"""Mixing sources to target weights by Pfair scheduling.

Each source is shuffled by a seed and cut into blocks of rows. Time is counted in blocks. Sources have integer
weights a; in each frame a source has a blocks, or what is left of it, c. With L blocks in the frame, block i of a
source (from 0) is released at floor(i L / c) and due at ceil((i + 1) L / c), and at each time the released block
with the earliest deadline runs. So each source is less than one block away from its share at every time, and
exactly at it at the end of each frame. A source that has run out leaves its time to the others, in proportion to
their weights: all rows are in the order, each once. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import carried, restored
from strandlake.llm.ordering import ranked, shuffle_key

#: The component of all sources without a weight of their own.
OTHERS = "*"
#: Bounds of what is broadcast: sources with a weight of their own, and the sum of all weights.
MOST_SOURCES, MOST_WEIGHT = 64, 2048


def _component(weights: dict[str, int]):
    listed = F.col("source").isin(list(weights)) if weights else F.lit(False)
    return F.when(listed, F.col("source")).otherwise(F.lit(OTHERS))


def frames(components: DataFrame) -> DataFrame:
    """For each kind of frame the slot of each block.

    components: component, a (weight), b (blocks), a row each. Returns first (the number of the first frame of this
    kind), component, i, slot, release, deadline; at most 2 n + 1 kinds of at most the sum of weights.
    """
    all_of = components.agg(F.array_sort(F.collect_list(F.struct("component", "a", "b"))).alias("cs"))
    kinds = all_of.select("cs", F.explode(F.expr("array_sort(array_distinct(concat(array(0L), transform(cs, c -> c.b div c.a), transform(cs, c -> c.b div c.a + 1))))")).alias("first"))
    kinds = kinds.withColumn("cs", F.expr("filter(transform(cs, c -> struct(c.component AS component, least(c.a, c.b - first * c.a) AS c)), c -> c.c > 0)"))
    kinds = kinds.withColumn("l", F.expr("aggregate(cs, 0L, (s, c) -> s + c.c)")).where("l > 0")
    pick = "array_min(filter(transform(cs, (c, k) -> if(st.nxt[k] < c.c AND (st.nxt[k] * l) div c.c <= t, struct(((st.nxt[k] + 1) * l + c.c - 1) div c.c AS due, k AS k), null)), x -> x IS NOT NULL)).k"
    run = f"""aggregate(sequence(0L, l - 1),
        struct(transform(cs, c -> 0L) AS nxt, cast(array() AS array<struct<k: int, i: bigint, t: bigint>>) AS done),
        (st, t) -> transform(array({pick}), p -> struct(
            transform(st.nxt, (x, k) -> if(k = p, x + 1, x)) AS nxt,
            concat(st.done, array(struct(p AS k, st.nxt[p] AS i, t AS t))) AS done))[0],
        st -> st.done)"""
    slots = kinds.select("first", "cs", "l", F.explode(F.expr(run)).alias("d"))
    return slots.select("first", F.expr("cs[d.k].component").alias("component"), F.col("d.i").alias("i"), F.col("d.t").alias("slot"), F.expr("(d.i * l) div cs[d.k].c").alias("release"), F.expr("((d.i + 1) * l + cs[d.k].c - 1) div cs[d.k].c").alias("deadline"))


def scheduled(docs: DataFrame, weights: dict[str, int], others: int, block_rows: int = 8, seed: int = 23) -> DataFrame:
    """Rows with component, block, slot (the block's time), seq (place in the block), release and deadline.

    Sorted by slot and seq, the rows are the mixture. All columns stay, but for any of these names, which are
    replaced. A null source belongs to the others; repeated rows stay, next to each other; an empty table gives no
    rows. The last block of a source may be short.
    """
    if len(weights) > MOST_SOURCES or sum(weights.values()) + others > MOST_WEIGHT or min([others, *weights.values()]) < 1:
        raise ValueError(f"at most {MOST_SOURCES} weights from 1 on, with a sum of at most {MOST_WEIGHT}")
    new = ["component", "block", "slot", "seq", "release", "deadline"]
    ties = ["doc_id", "source", *(["_row.text"] if "text" in docs.columns else [])]
    rows = carried(docs, "doc_id", "source").withColumn("component", _component(weights)).withColumn("_key", shuffle_key(F.col("doc_id"), seed))
    weight = F.create_map(*[F.lit(x) for k, v in {**weights, OTHERS: others}.items() for x in (k, v)])
    components = rows.groupBy("component").agg(F.count(F.lit(1)).alias("n")).select("component", F.element_at(weight, F.col("component")).cast("long").alias("a"), F.expr(f"(n + {block_rows - 1}L) div {block_rows}L").alias("b"))
    known = components.agg(F.collect_list(F.struct("component", "a", "b")).alias("_cs")).select("_cs", F.explode("_cs").alias("c"))
    known = known.select("_cs", F.col("c.component").alias("component"), F.col("c.a").alias("_a"), F.expr("array_sort(array_distinct(concat(array(0L), transform(_cs, c -> c.b div c.a), transform(_cs, c -> c.b div c.a + 1))))").alias("_firsts"))
    placed = (
        ranked(rows, "component", "_key", ties)
        .withColumn("block", F.expr(f"(rank - 1) div {block_rows}L"))
        .withColumn("seq", F.expr(f"cast((rank - 1) % {block_rows}L as int)"))
        .join(F.broadcast(known), "component")  # a row for each weight
        .withColumn("_frame", F.expr("block div _a"))
        .withColumn("_i", F.expr("block % _a"))
        .withColumn("_first", F.expr("array_max(filter(_firsts, f -> f <= _frame))"))
        .withColumn("_start", F.expr("aggregate(_cs, 0L, (s, c) -> s + least(_frame * c.a, c.b))"))
    )
    slots = frames(components).select(F.col("component").alias("_c"), F.col("first").alias("_f"), F.col("i").alias("_n"), F.col("slot").alias("_slot"), F.col("release").alias("_release"), F.col("deadline").alias("_deadline"))
    # at most (2 * 65 + 1) * 2048 rows, by the bounds above
    timed = placed.join(F.broadcast(slots), (F.col("component") == F.col("_c")) & (F.col("_first") == F.col("_f")) & (F.col("_i") == F.col("_n")))
    for c in ("slot", "release", "deadline"):
        timed = timed.withColumn(c, F.col("_start") + F.col(f"_{c}"))
    return restored(timed, docs.columns, *new)


def placed(docs: DataFrame, weights: dict[str, int], others: int, **options) -> DataFrame:
    """The rows of docs with slot and seq, their place in the mixture, as further columns, which replace others of these names.

    The order is found on ids and sources alone and joined to the rows, so that it is the same for the same ids. Rows
    with the same doc_id share a place, by the least of their sources (null first).
    """
    return restored(_placed(docs, weights, others, **options), docs.columns, "slot", "seq")


def _placed(docs: DataFrame, weights: dict[str, int], others: int, **options) -> DataFrame:
    light = docs.groupBy("doc_id").agg(F.min(F.struct("source")).alias("_s")).select("doc_id", "_s.source")
    order = scheduled(light, weights, others, **options).select(F.col("doc_id").alias("_id"), "slot", "seq")
    return carried(docs, "doc_id").join(order, F.col("doc_id").eqNullSafe(F.col("_id")))


def mixed(docs: DataFrame, weights: dict[str, int], others: int, **options) -> DataFrame:
    """The rows and columns of docs, sorted into the mixture; rows with the same doc_id follow each other."""
    return restored(_placed(docs, weights, others, **options).orderBy("slot", "seq"), docs.columns)


def oracle(weights: dict[str, int], others: int, block_rows: int, seed: int) -> str:
    """The same in DuckDB: earliest deadline first, one slot after another, in a recursive query."""
    listed = ", ".join(f"('{k}', {v})" for k, v in {**weights, OTHERS: others}.items())
    names = ", ".join(f"'{k}'" for k in weights)
    return f"""
WITH RECURSIVE w(component, a) AS (VALUES {listed}),
d AS (SELECT doc_id, source, CASE WHEN source IN ({names}) THEN source ELSE '{OTHERS}' END AS component, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS k FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY k, doc_id) - 1 AS n FROM d),
p AS (SELECT r.*, n // {block_rows} AS block, (n % {block_rows})::INT AS seq, (n // {block_rows}) // a AS frame, (n // {block_rows}) % a AS i FROM r JOIN w USING (component)),
c AS (SELECT frame, component, max(i) + 1 AS c FROM p GROUP BY ALL),
j AS (SELECT component, frame, i, (i * l) // c AS release, ((i + 1) * l + c - 1) // c AS deadline, l FROM (SELECT *, sum(c) OVER (PARTITION BY frame)::BIGINT AS l FROM c) x, range(0, x.c) t(i)),
s AS (SELECT frame, 0::BIGINT AS t, []::VARCHAR[] AS done, NULL::VARCHAR AS component, NULL::BIGINT AS i, max(l) AS l FROM j GROUP BY frame
  UNION ALL
  SELECT s.frame, s.t + 1, list_append(s.done, b.component || ':' || b.i), b.component, b.i, s.l FROM s, LATERAL (
    SELECT j.component, j.i FROM j WHERE j.frame = s.frame AND j.release <= s.t AND NOT list_contains(s.done, j.component || ':' || j.i) ORDER BY j.deadline, j.component, j.i LIMIT 1) b
  WHERE s.t < s.l),
f AS (SELECT frame, coalesce(sum(l) OVER (ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM (SELECT DISTINCT frame, l FROM j))
SELECT p.doc_id, p.source, p.component, p.block, (f.start + s.t - 1)::BIGINT AS slot, p.seq, (f.start + j.release)::BIGINT AS release, (f.start + j.deadline)::BIGINT AS deadline
FROM p JOIN f USING (frame) JOIN j USING (component, frame, i) JOIN s USING (component, frame, i)"""
