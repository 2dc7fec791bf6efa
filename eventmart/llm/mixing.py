"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream of words in shuffled document order, cut into equal blocks. Slot ``n`` of
the mix takes the golden-ratio point ``frac(n * phi)`` through the cumulative weights of the sources;
the k-th slot of a source takes its block ``k mod blocks``. So any prefix of the mix is close to the
weights, and a source is repeated evenly. Sources, slots and blocks are tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.session import materialize

BLOCK_WORDS = 256
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
_GRID = 1024  # cells of [0, 1) on which slots meet sources
_PERIOD = 1 << 31
_GOLDEN = 1327217885  # odd, next to 2**31 / phi: slot points repeat after 2**31 slots, evenly spread
_CHUNK = 1 << 16  # slots ranked together
_BUCKETS = 1024  # parts of a source in which offsets are summed


def words(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(units: DataFrame) -> DataFrame:
    """Per source: sid, source, source_size, weight, target.

    Weights 1, 2, 3 repeat over the sources in code-point order, null last. A target is the lesser of
    ``MAX_REPEATS`` times the source and ``level`` times its weight; the level is such that targets
    sum to all words, which is where handing on the excess ends.
    """
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = W.partitionBy()
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", (F.col("sid") - 1) % 3 + 1)
    cap = F.col("source_size") * MAX_REPEATS
    full = ranked.withColumn("cap", cap).withColumn("fills_at", F.col("cap") / F.col("weight"))
    rising = every.orderBy("fills_at", "sid")
    level = (
        F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ) / F.sum("weight").over(rising.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = full.withColumn("level", level).withColumn("at", F.row_number().over(rising))
    final = F.min_by(F.when(F.col("level") <= F.col("fills_at"), F.col("level")), F.when(F.col("level") <= F.col("fills_at"), F.col("at")))
    return level.withColumn("water", final.over(every)).select(
        "sid", "source", "source_size", "weight",
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")).alias("target"),
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot, sid, rank within the source, block; rank / blocks is the repeat.

    Slots beyond ``MAX_REPEATS`` full rounds of a source, which rounding can make, are left out.
    """
    spark = sources.sparkSession
    every = W.partitionBy()
    cut = sources.withColumn("blocks", F.greatest(F.lit(1), F.floor(F.col("source_size") / block_words))).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks")).otherwise(0.0)
    )
    share = cut.withColumn("all_slots", F.sum("slots").over(every)).withColumn(
        "upto", F.sum("slots").over(every.orderBy("sid").rowsBetween(W.unboundedPreceding, 0)) / F.col("all_slots")
    )
    span = share.where("slots > 0").select(
        "sid", "blocks", F.lag("upto", 1, 0.0).over(every.orderBy("sid")).alias("low"),
        F.when(F.lead("sid").over(every.orderBy("sid")).isNull(), 2.0).otherwise(F.col("upto")).alias("high"),
    )
    cells = span.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * _GRID), F.floor(F.least(F.col("high"), F.lit(1.0)) * _GRID)))
    )
    n = share.agg(F.ceil(F.coalesce(F.max("all_slots"), F.lit(0.0)))).first()[0]
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn(
        "u", (F.col("slot") % _PERIOD * _GOLDEN) % _PERIOD / float(_PERIOD)
    )
    hit = (
        points.withColumn("cell", F.floor(F.col("u") * _GRID))
        .join(cells, "cell")
        .where("u >= low and u < high")
        .select("slot", "sid", "blocks", F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    )
    within = W.partitionBy("sid", "chunk").orderBy("slot")
    local = hit.withColumn("local", F.row_number().over(within) - 1)
    before = (
        hit.groupBy("sid", "chunk").count()
        .withColumn("before", F.sum("count").over(W.partitionBy("sid").orderBy("chunk")) - F.col("count"))
        .drop("count")
    )
    ranked = local.join(before, ["sid", "chunk"]).withColumn("rank", F.col("before") + F.col("local"))
    return ranked.where(F.col("rank") < F.col("blocks") * MAX_REPEATS).select(
        "slot", "sid", "rank", (F.col("rank") % F.col("blocks")).alias("block")
    )


def placed(units: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``units`` (unit, doc_id, source, size) with sid and their first word ``at`` in the shuffled source."""
    known = units.join(sources.select("sid", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    order = known.withColumn("h", F.xxhash64("doc_id", F.lit(17))).withColumn("bucket", F.pmod("h", F.lit(_BUCKETS)))
    inside = W.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", "unit").rowsBetween(W.unboundedPreceding, 0)
    before = (
        order.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
        .withColumn("before", F.sum("words").over(W.partitionBy("sid").orderBy("bucket")) - F.col("words"))
        .drop("words")
    )
    return (
        order.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
        .join(before, ["sid", "bucket"])
        .withColumn("at", F.col("before") + F.col("inside"))
        .select("unit", "doc_id", "size", "sid", "at")
    )


def mix(units: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(``units`` with source_size, target and taken; the slots).

    ``units``: unit (unique), doc_id, source, size in words. ``taken`` counts the words that the
    slots take from the unit, repeats included, at most ``MAX_REPEATS`` times its size. Units without
    words take none; null ids and sources are values like others; an empty table gives empty results.
    """
    sources = materialize(targets(units), "mix-sources")
    slots = schedule(sources, block_words)
    uses = slots.groupBy("sid", "block").agg(F.count("*").alias("uses"))
    sizes = sources.select("sid", F.greatest(F.lit(1), F.floor(F.col("source_size") / block_words)).alias("blocks"))
    at = placed(units, sources, block_words).where("size > 0").join(sizes, "sid")
    block = lambda x: F.least(F.floor(x / block_words), F.col("blocks") - 1)
    parts = at.withColumn("block", F.explode(F.sequence(block(F.col("at")), block(F.col("at") + F.col("size") - 1))))
    low = F.greatest(F.col("at"), F.col("block") * block_words)
    stop = F.when(F.col("block") == F.col("blocks") - 1, F.col("at") + F.col("size")).otherwise((F.col("block") + 1) * block_words)
    taken = (
        parts.withColumn("words", F.least(F.col("at") + F.col("size"), stop) - low)
        .join(uses, ["sid", "block"])
        .groupBy("unit").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    )
    facts = sources.select(F.col("source").alias("name"), "source_size", "target")
    mixed = (
        units.join(facts, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        .join(taken, "unit", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    )
    return mixed, slots


def units_of(docs: DataFrame) -> DataFrame:
    """One stored unit per row of ``docs``, so its text is read once."""
    return materialize(
        docs.select(F.monotonically_increasing_id().alias("unit"), "doc_id", F.col("source").cast("string").alias("source"),
                    words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")),
        "mix-units",
    )


def apply(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix wants them: each row as often as the mix takes its words, to the nearest
    whole number. Rows that the mix does not take by half are out, and so are rows without words (null, empty or
    blank texts), of which a mix takes nothing. Rows that repeat an id and a text share what the mix takes of them; null ids and
    sources are values like others; other columns are kept; an empty table gives an empty result.
    """
    mixed, _ = mix(units_of(docs))
    copies = (
        mixed.groupBy(F.col("doc_id").alias("__mix_id"), F.col("text_hash").alias("__mix_hash"))
        .agg(F.round(F.try_divide(F.sum("taken"), F.sum("size"))).cast("int").alias("__mix_copies"))
        .where("__mix_copies > 0")  # null without words
    )
    joined = docs.join(
        copies, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & F.xxhash64("text").eqNullSafe(F.col("__mix_hash"))
    )
    return joined.withColumn("__mix_nth", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(
        [F.col(f"`{c}`") for c in docs.columns]
    )
