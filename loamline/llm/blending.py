"""Problem 1: mix the records of several sources to target weights.

``blend_plan`` compares what each source should give with what it has, ``blend_mix`` draws the
records by systematic sampling and ``blend_shares`` reports the shares that the mix reaches, and from the copies that
were really drawn which sources fall short of their target at the greatest number of repeats.

What a capped source can't give is left open by default: the mix is then smaller by that, and every source's share
of it is nearer to its target than if the others made up for it. With ``refill`` the others give it in proportion to
their weights, each up to its own cap, so that the mix is as large as all records together.

Systematic sampling: within a source every record is expected ``rate`` times. The expected copies
are summed up along the source, one random offset is added for the source, and the record is
emitted once for each whole number that the running sum crosses at it. A source of ``n`` records
so gives ``n * rate`` rows, give or take one, and no record comes more than ``ceil(rate)`` times.

The running sum is not one window over a source, which may hold a third of all rows: a source is
cut into blocks of bounded size, block totals are summed first, and each block then runs on from
the sum of the blocks before it. Sums are whole numbers in units of 2**-24 copies, so no rounding
depends on how the rows are spread.

Cases: records with a null or non-positive size and records outside every entry take no part.
Entries whose weight is null, zero, negative or not finite are not live. A name that occurs more
than once counts once, with the greatest (weight, path, subset). A null path agrees with nothing.
An entry without records has a rate of null, is over the cap and reaches a share of 0. Records with
a null id are kept as they come. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.llm.common import once
from loamline.registry import Registry
from loamline.session import cut
from loamline.tables import load

registry = Registry()

MAX_REPEATS = 4
UNIT = 1 << 24
BLOCK_ROWS = 100_000


def same_place(path: Column) -> Column:
    """Letter case, outer blanks and trailing slashes don't matter."""
    return F.regexp_replace(F.lower(path), r"^\s+|[\s/]+$", "")


def live_entries(blend: DataFrame) -> DataFrame:
    w = F.col("weight").cast("double")
    named = blend.where((w > 0) & ~F.isnan(w) & (w < float("inf")) & F.col("name").isNotNull()).select(
        "name", w.alias("weight"), same_place(F.col("path")).alias("place"), same_place(F.coalesce("subset", F.lit(""))).alias("part")
    )
    one = named.groupBy("name").agg(F.max(F.struct("weight", "place", "part")).alias("e"))
    return one.select("name", "e.weight", "e.place", "e.part")


def blend_records(blend: DataFrame, records: DataFrame) -> DataFrame:
    """(name, record_id, n_tokens): the records of each live entry, once each."""
    tidy = records.where(F.col("n_tokens") > 0).select(
        "record_id", "n_tokens", same_place(F.col("path")).alias("place"), same_place(F.coalesce("subset", F.lit(""))).alias("part")
    )
    # The side of the entries is small in practice; Spark broadcasts it if its size allows that.
    return once(tidy.join(live_entries(blend), ["place", "part"]).select("name", "record_id", "n_tokens"), "record_id", "name")


def blend_plan(blend: DataFrame, records: DataFrame, max_repeats: int = MAX_REPEATS, refill: bool = False) -> DataFrame:
    """A row for each live entry: what it has, what its weight asks for and how often its records come.

    (name, weight, target_share, n_records, tokens, wanted_tokens, needed_repeats, rate, over_cap)
    """
    return _plan(live_entries(blend), blend_records(blend, records), max_repeats, refill)


def _plan(entries: DataFrame, own: DataFrame, max_repeats: int, refill: bool = False) -> DataFrame:
    have = own.groupBy("name").agg(F.count("*").alias("n_records"), F.sum("n_tokens").alias("tokens"))
    everything = Window.partitionBy(F.lit(1))  # over the entries, not over their records
    share = F.col("weight") / F.sum("weight").over(everything)
    plan = (
        entries.select("name", "weight")
        .join(have, "name", "left")
        .fillna(0, ["n_records", "tokens"])
        .withColumns({"target_share": share, "wanted_tokens": share * F.sum("tokens").over(everything)})
        .withColumn("needed_repeats", F.when(F.col("tokens") > 0, F.col("wanted_tokens") / F.col("tokens")))
        .withColumn("rate", F.when(F.col("tokens") > 0, F.least("needed_repeats", F.lit(float(max_repeats)))))
        .withColumn("over_cap", F.col("wanted_tokens") > max_repeats * F.col("tokens"))
    )
    if not refill:
        return plan
    # Entries run out in the order of what they can give for their weight. Those before an entry run out first, so the weight of
    # the entries from it on shares what they leave; the level is that of the first entry which doesn't run out, and falls after it.
    most = F.col("tokens") * max_repeats
    order = Window.partitionBy(F.lit(1)).orderBy(most / F.col("target_share"), "name")  # over the entries
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("tokens").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0))
    level = left / (1 - F.coalesce(F.sum("target_share").over(before), F.lit(0.0)))
    levels = plan.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") * F.col("target_share") <= most, F.col("level"))).over(everything))
    given = F.least(F.coalesce(F.col("level") * F.col("target_share"), most.cast("double")), most)
    return levels.withColumn("rate", F.when(F.col("tokens") > 0, given / F.col("tokens"))).drop("level")


def blend_mix(blend: DataFrame, records: DataFrame, max_repeats: int = MAX_REPEATS, seed: int = 7, block_rows: int = BLOCK_ROWS, refill: bool = False) -> DataFrame:
    """(name, record_id, n_tokens, copy): a row for each copy of a record in the mix; copy counts from 1."""
    own = cut(blend_records(blend, records))
    return _mix(own, _plan(live_entries(blend), own, max_repeats, refill), seed, block_rows)


def _mix(own: DataFrame, plan: DataFrame, seed: int, block_rows: int) -> DataFrame:
    plan = plan.where("rate > 0").select(
        "name",
        F.round(F.col("rate") * UNIT).cast("bigint").alias("step"),
        F.ceil(F.col("n_records") / block_rows).alias("blocks"),
        F.pmod(F.xxhash64(F.lit(seed), "name"), F.lit(UNIT)).alias("offset"),
    )
    placed = own.join(plan, "name").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "record_id"), F.col("blocks")))
    before = Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("name", "block").agg(F.sum("step").alias("total")).select("name", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("name", "block").orderBy("n_tokens", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("start") + F.col("offset") + F.col("ran")
    return (
        placed.withColumn("ran", F.sum("step").over(within))
        .join(starts, ["name", "block"])
        .withColumn("copies", F.floor(upto / UNIT).cast("int") - F.floor((upto - F.col("step")) / UNIT).cast("int"))
        .where("copies > 0")
        .select("name", "record_id", "n_tokens", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    )


def blend_shares(blend: DataFrame, records: DataFrame, max_repeats: int = MAX_REPEATS, seed: int = 7, block_rows: int = BLOCK_ROWS, refill: bool = False) -> DataFrame:
    """What the mix really gives: (name, target_share, over_cap, emitted, tokens, most_copies, share).

    An entry is over its cap if every record of it was drawn ``max_repeats`` times and that is less than its weight asks for.
    """
    own = cut(blend_records(blend, records))  # counted, summed up and drawn from
    plan = cut(_plan(live_entries(blend), own, max_repeats, refill))
    got = _mix(own, plan, seed, block_rows).groupBy("name").agg(F.count("*").alias("emitted"), F.sum("n_tokens").alias("drawn"), F.max("copy").alias("most_copies"))
    everything = Window.partitionBy(F.lit(1))
    return (
        plan.select("name", "target_share", "wanted_tokens", "n_records")
        .join(got, "name", "left")
        .fillna(0, ["emitted", "drawn", "most_copies"])
        .withColumn("over_cap", (F.col("emitted") == max_repeats * F.col("n_records")) & (F.col("drawn") < F.col("wanted_tokens")))
        .withColumn("share", F.coalesce(F.col("drawn") / F.nullif(F.sum("drawn").over(everything), F.lit(0)), F.lit(0.0)))
        .select("name", "target_share", "over_cap", "emitted", F.col("drawn").alias("tokens"), "most_copies", "share")
    )


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return load(spark, sf_dir, "data_blend_raw_phase1"), load(spark, sf_dir, "source_records")


_PLACE = r"regexp_replace(lower({}), '^\s+|[\s/]+$', '', 'g')"
_PLAN_SQL = f"""
WITH live AS (
  SELECT name, max(row(weight, {_PLACE.format('path')}, {_PLACE.format("coalesce(subset, '')")})) AS e
  FROM data_blend_raw_phase1 WHERE weight > 0 AND name IS NOT NULL GROUP BY name),
entry AS (SELECT name, e[1] AS weight, e[2] AS place, e[3] AS part FROM live),
rec AS (
  SELECT DISTINCT record_id, n_tokens, {_PLACE.format('path')} AS place, {_PLACE.format("coalesce(subset, '')")} AS part
  FROM source_records WHERE n_tokens > 0),
have AS (SELECT name, count(*) AS n_records, sum(n_tokens) AS tokens FROM entry JOIN rec USING (place, part) GROUP BY name),
plan AS (
  SELECT name, weight, coalesce(n_records, 0) AS n_records, coalesce(tokens, 0) AS tokens,
         weight / sum(weight) OVER () AS target_share,
         weight / sum(weight) OVER () * sum(coalesce(tokens, 0)) OVER () AS wanted_tokens
  FROM entry LEFT JOIN have USING (name))
"""


@registry.add("p1_found", _PLAN_SQL + "SELECT name FROM plan WHERE wanted_tokens > 4 * tokens")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend_shares(*_tables(spark, sf_dir)).where("over_cap").select("name")


@registry.add(
    "p1_plan",
    _PLAN_SQL + """SELECT name, CAST(n_records AS BIGINT) AS n_records, CAST(tokens AS BIGINT) AS tokens, round(target_share, 9) AS target_share,
    round(CASE WHEN tokens > 0 THEN least(4.0, wanted_tokens / tokens) END, 6) AS rate FROM plan""",
)
def p1_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend_plan(*_tables(spark, sf_dir)).select("name", "n_records", "tokens", F.round("target_share", 9).alias("target_share"), F.round("rate", 6).alias("rate"))


@registry.add("p1_mix")
def p1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend_mix(*_tables(spark, sf_dir))


@registry.add("p1_shares")
def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend_shares(*_tables(spark, sf_dir))
