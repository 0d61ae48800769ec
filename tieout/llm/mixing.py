"""Mixing sources to target weights, by repetition rates and keyed draws.

Words are summed per source, each source gets a share of the mix by its weight,
and the share over the source's words is its repetition rate. A document is
emitted floor(rate) times and once more if a draw keyed by its id falls below
the fraction of the rate. Only sums per source are shuffled; rows meet their
source's rate in a join whose strategy follows the size of the table of rates.

Defined cases: a NULL text has no words, a NULL source is a source of its own
and comes last in the order, a NULL id draws as 'null'. Rows that share an id
share their draw. A source without words has rate 0. An empty table gives an
empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import draw, one_row, scratch_of, table, with_copies
from tieout.operators.rank import global_rank
from tieout.sources.lakehouse import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sized: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    Sources, ordered by code point with NULL last, take the weights in turn.
    Together they get `share` times all words, by weight; what a source would
    get above `most` times its own words is shared again among the others.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(sums, [F.col("source").asc_nulls_last()], "_rank", scratch)
    turn = ((F.col("_rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    kept = scratch.keep(
        ranked.select("source", "source_size", weight.cast("bigint").alias("weight")), "sources"
    )
    level = share_per_weight(kept, share, most)
    return kept.withColumn(
        "target",
        F.least(F.lit(most) * F.col("source_size"), F.lit(level) * F.col("weight")),
    )


def share_per_weight(sources: DataFrame, share: float, most: float) -> float:
    """Words per unit of weight, once no source is above its limit.

    Each round is one aggregate over the sources and fixes at least one more of
    them at its limit. The level only rises, so rounds end.
    """
    limit = F.lit(most) * F.col("source_size")
    total = one_row(sources.agg(F.sum("source_size").alias("words")))["words"] or 0
    level, fixed = 0.0, -1
    while total:
        above = limit < F.lit(level) * F.col("weight")
        row = one_row(
            sources.agg(
                F.count_if(above).alias("fixed"),
                F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("words"),
                F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            )
        )
        if row["fixed"] == fixed or not row["weight"]:
            break
        fixed = row["fixed"]
        level = (share * total - most * row["words"]) / row["weight"]
    return level


def planned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Every row as `row`, with its size, its source's size and target, and `copies`."""
    scratch = scratch_of(docs.sparkSession)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(source_col).alias("source"),
        words_in(F.col(text_col)).alias("size"),
    )
    targets = source_targets(rows.select("source", "size"), scratch, weights, share, most)
    rated = targets.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0)
        .alias("rate"),
    )
    joined = rows.join(rated, F.col("source").eqNullSafe(F.col("_source")), "left")
    whole = F.floor("rate")
    once_more = draw(F.lit(seed), F.col(f"row.{id_col}")) < F.col("rate") - whole
    return joined.withColumn("copies", whole + once_more.cast("bigint")).drop("_source")


def mix(docs: DataFrame, most: float = MOST, **settings) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as planned."""
    rows = planned(docs, most=most, **settings)
    return with_copies(rows.select("row", "copies"), "copies", "_copy", int(most) + 1).select(
        "row.*"
    )


def op2_mix_sources(spark, sf_dir):
    """What the mix takes of every document."""
    return planned(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{", ".join(map(str, WEIGHTS))}][
           1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INT)
         ] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, row_number() OVER o AS place,
         sum(source_size) OVER o AS words_so_far, sum(weight) OVER o AS weight_so_far,
         sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weight
  FROM sources
  WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
               ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT place, source_size, weight,
         ({SHARE} * words - {MOST} * (words_so_far - source_size))
           / (all_weight - (weight_so_far - weight)) AS level
  FROM filled
), level AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= {MOST} * source_size
), rates AS (
  SELECT source, source_size,
         least({MOST} * source_size, coalesce((SELECT level FROM level), 0) * weight) AS target
  FROM sources
), planned AS (
  SELECT d.doc_id, d.size, r.source_size, r.target,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13)
              AS BIGINT) / CAST({1 << 52} AS DOUBLE) AS draw
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies
  FROM planned
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted
"""
