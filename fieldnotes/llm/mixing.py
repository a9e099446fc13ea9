"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every document of a source, in a shuffled order that depends on its id alone,
gets a virtual finish time: the words its source has handed out up to and
including it, divided by the source's target. All sources are then merged in
the order of finish times and the merge ends at the total budget. A source
whose target exceeds its size is walked again, up to ``most`` times.

Running sums never pass through one task: a source's documents are cut into
buckets by the leading digits of the shuffle key, the buckets' totals are
summed first, and a row's running sum starts from its bucket's. The merge works
alike: finish times are cut into ``BUCKETS`` ranges whose totals locate the one
range in which the budget ends, and only that range is sorted.

Defined cases: a NULL text has size 0; NULL is a source of its own, after all
others; a NULL id shuffles as the empty text; rows of one source that agree in
id and size are taken together or not at all; a source without words has
target 0 and nothing is taken; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldnotes.llm.util import WORD, cut, fresh, table

WEIGHTS = (5, 2, 1)  # by the source's place in code point order, repeating
MOST = 3  # times a document may be taken
BUCKETS = 4096  # ranges of shuffle keys per source, and of finish times in [0, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Sources with their size -> place, weight and target words.

    ``sizes`` (source, source_size) has one row per source. The whole size is
    shared by weight; targets stop at ``most`` times the size and the excess is
    shared again, until none is above. Sources in the order of size per weight
    are capped one after the other, so one pass over that order finds the level.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    up = W.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, everything = up.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    s = sizes.withColumn("place", place).withColumn("weight", weight)
    s = (s.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("below", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("capped", F.expr(f"{most} * source_size * rest < weight * (total - {most} * below)"))
    s = (s.withColumn("held", F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(everything))
         .withColumn("shared", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)))
    target = (F.when(F.col("capped"), (most * F.col("source_size")).cast("double"))
              .otherwise((F.col("weight") * (F.col("total") - most * F.col("held"))).cast("double") / F.col("shared")))
    return s.select("source", "source_size", "place", "weight", target.alias("target"), "total")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, *, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix takes it), taken (words), one row per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rows = cut(rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "mix-sizes")
    goal = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    bucket = F.conv(F.substring("h", 1, 3), 16, 10).cast("int")
    rows = (rows.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "weight")
            .withColumn("b", bucket))
    start = (rows.groupBy("place", "b").agg(F.sum("size").alias("held"))
             .withColumn("held", F.coalesce(F.sum("held").over(W.partitionBy("place").orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    order = [F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("size")]
    rows = rows.join(start, ["place", "b"]).withColumn("cum", F.col("held") + F.sum("size").over(W.partitionBy("place", "b").orderBy(*order)))
    rows = cut(rows.drop("b", "held"), "mix-running")

    # the ranges of finish times, and the one in which the budget ends
    finish = [((F.lit(e) * F.col("source_size") + F.col("cum")).cast("double") / F.nullif(F.col("target"), F.lit(0.0))) for e in range(most)]
    copies = rows.where("target > 0").select("*", F.posexplode(F.array(*finish)).alias("epoch", "v")).withColumn("r", F.floor(F.col("v") * BUCKETS))
    ranges = copies.groupBy("r").agg(F.sum("size").alias("n"), F.first("total").alias("total"))
    upto = ranges.withColumn("upto", F.sum("n").over(W.orderBy("r")))
    edge = upto.where("upto > total").agg(F.min("r").alias("edge_r"))
    edge = edge.crossJoin(upto.where("upto <= total").agg(F.coalesce(F.max("upto"), F.lit(0)).alias("edge_before")))  # one row with one row
    key = F.struct("v", "place", "epoch", "h", "doc_id", "size")
    inside = copies.join(F.broadcast(edge), F.col("r") == F.col("edge_r"))  # edge is a single row
    run = F.sum("size").over(W.partitionBy("r").orderBy(key))
    last = inside.withColumn("run", F.col("edge_before") + run).where("run <= total").agg(F.max(key).alias("last"))
    edge = edge.crossJoin(last)  # one row with one row
    rows = rows.crossJoin(F.broadcast(edge))
    taken = sum((F.coalesce(F.when(F.col("target") > 0, F.when(F.col("edge_r").isNull() | (F.floor(v * BUCKETS) < F.col("edge_r")), 1)
                 .when((F.floor(v * BUCKETS) == F.col("edge_r"))
                       & (F.struct(v.alias("v"), F.col("place"), F.lit(e).alias("epoch"), F.col("h"), F.col("doc_id"), F.col("size")) <= F.col("last")), 1)), F.lit(0))
                 for e, v in enumerate(finish)), F.lit(0))
    return rows.withColumn("copies", taken.cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, *, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, copies and taken at the end.

    Columns of ``docs`` with one of these five names give way to the mix's.
    """
    plan = mix(docs, weights, most, id_col=id_col, text_col=text_col, source_col=source_col).where("copies > 0").distinct()
    own = {c: fresh(f"mix_{c}", docs, plan) for c in ("doc_id", "source", "size")}
    plan = plan.withColumnsRenamed(own)
    rest = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    rows = docs.select(*rest).withColumn("size", n_words(F.col(text_col)))
    same = F.col(id_col).eqNullSafe(F.col(own["doc_id"])) & F.col(source_col).eqNullSafe(F.col(own["source"])) & (F.col("size") == F.col(own["size"]))
    return rows.join(plan, same).select(*rest, "size", "source_size", "target", "copies", "taken")


def op7_weighted_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def sql(docs: str = "documents") -> str:
    """The same mix in DuckDB SQL, by one sort over all copies."""
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h FROM {docs}),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, (CASE place % {len(WEIGHTS)} {weights} END)::BIGINT AS weight FROM src),
level AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
         coalesce(sum(source_size) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
         (sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
  FROM weighed),
flagged AS (SELECT *, {MOST} * source_size * rest < weight * (total - {MOST} * below) AS capped FROM level),
summed AS (
  SELECT *, (sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ())::BIGINT AS held,
         (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::BIGINT AS shared FROM flagged),
goal AS (
  SELECT source, place, source_size, total,
         CASE WHEN capped THEN ({MOST} * source_size)::DOUBLE
              ELSE (weight * (total - {MOST} * held))::DOUBLE / shared END AS target FROM summed),
running AS (
  SELECT s.*, g.place, g.source_size, g.total, g.target,
         (sum(size) OVER (PARTITION BY g.place ORDER BY h, doc_id NULLS FIRST, size))::BIGINT AS cum
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT *, (epoch * source_size + cum)::DOUBLE / target AS v
  FROM running, (SELECT unnest(range({MOST})) AS epoch) WHERE target > 0),
merged AS (
  SELECT *, sum(size) OVER (ORDER BY v, place, epoch, h, doc_id NULLS FIRST, size) AS run FROM copies),
kept AS (
  SELECT place, h, doc_id, size, count(*) AS n, count(DISTINCT epoch) AS epochs
  FROM merged WHERE run <= total GROUP BY ALL)
SELECT r.doc_id, r.size, r.source_size, r.target, (r.size * coalesce(k.epochs, 0))::BIGINT AS taken
FROM running r LEFT JOIN kept k
  ON r.place = k.place AND r.h = k.h AND r.doc_id IS NOT DISTINCT FROM k.doc_id AND r.size = k.size"""
