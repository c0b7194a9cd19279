"""Mix sources to target weights by systematic sampling."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.tables import stored, with_place

#: Fractions of a copy are counted in this many bits, in integers: sums cross integer boundaries exactly.
BITS = 28
UNIT = ("doc_id", "source", "text_hash")


def word_count(text: str | Column) -> Column:
    """Runs of anything but space and the characters 9 to 13; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def unit_columns() -> list[Column]:
    """What makes rows copies of one unit: doc_id, source and text."""
    return [F.col("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_hash")]


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes dealt by weight, none above ``most`` times its source's size.

    ``sizes`` has a row per source (source, source_size). Weights go round the sources in the order of their code points,
    null last. What a full source can't take is dealt to the others by weight, until none is above: every target is the
    smaller of its limit and weight times a common level. Sources fill up in the order of limit by weight, which gives
    the level from two running sums. Ranks and running sums go by ranges (``with_place``): there may be a source per site.
    """
    name = F.col("source").asc_nulls_last()
    ranked = with_place(sizes.select("source", F.col("source_size").cast("long").alias("source_size")), [], [name], "turn")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod("turn", F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    limits = stored(ranked.select("source", "source_size", weight.alias("weight"), limit.alias("limit")), "limits")
    all_size, all_weight = limits.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    order = [F.col("limit") / F.col("weight"), name]
    placed = with_place(with_place(limits, [], order, "sizes_before", "source_size"), [], order, "weights_before", "weight")
    # The level, if all sources before this one are full and this one is not.
    rest = F.lit(float(all_size)) * F.lit(float(share)) - F.col("sizes_before") * F.lit(float(most))
    levels = stored(placed.withColumn("own", rest / (F.lit(all_weight) - F.col("weights_before"))), "levels")
    is_open = F.col("own") * F.col("weight") < F.col("limit")
    # Weights before are a place in the order, as every weight is above none.
    level = levels.where(is_open).agg(F.min_by("own", "weights_before")).first()[0]
    target = F.col("limit") if level is None else F.least(F.col("limit"), F.lit(level) * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def mixing_plan(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7
) -> DataFrame:
    """doc_id, source, text_hash, rows, size, source_size, target, copies: how often each document is emitted.

    Within a source every document expects target / source_size copies. The expected copies are summed in the order of
    size, largest first, a random offset per source is added, and a document is emitted once per integer that its part of
    the sum crosses. So it gets its expected number rounded down or up, and what a source emits stays near its target,
    because neighbours in the order have like sizes. Order and offset come from hashes with ``seed``: reruns agree.

    ``docs`` has doc_id, text and source; other columns are not read. Null and blank texts have size 0; a source of size
    0 has target 0 and emits nothing. Null is a source of its own, last in order. Rows alike in doc_id, source and text
    are one unit (``rows`` of them, of ``size`` words each), of which each row is emitted ``copies`` times. An empty
    table gives an empty plan. Only ids, sources, hashes and sizes are ordered, by ranges: a source with most of the rows
    spreads over many tasks.
    """
    measured = docs.select(*unit_columns(), word_count("text").alias("size"))
    units = stored(measured.groupBy(*UNIT, "size").agg(F.count("*").alias("rows")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "targets").withColumnRenamed("source", "_source")
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    order = [F.desc("total"), F.col("draw"), F.col("doc_id"), F.col("text_hash")]
    ordered = units.withColumns({"total": F.col("size") * F.col("rows"), "draw": draw})
    placed = with_place(ordered, ["source"], order, "place").drop("total", "draw")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(*UNIT, "rows", "size", "source_size", "target", _copies(seed).alias("copies"))


def _copies(seed: int) -> Column:
    """Integers that the running sum of expected copies, plus the offset, crosses at ``place``."""
    one = 1 << BITS
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate).cast("long")
    part = F.floor((rate - F.floor(rate)) * F.lit(one)).cast("long")
    name = F.concat_ws(":", F.lit(str(seed)), F.lit("offset"), F.coalesce("source", F.lit("")))
    offset = F.conv(F.substring(F.md5(name.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    after = F.shiftright(part * (F.col("place") + 1) + offset, BITS)
    return whole + after - F.shiftright(part * F.col("place") + offset, BITS)


def mixed_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all of their columns, each as many times as its unit's copies in ``plan``."""
    wanted = plan.where("copies > 0").select(
        F.col("doc_id").alias("_doc_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), F.col("copies").alias("_copies")
    )
    on = docs["doc_id"].eqNullSafe(wanted["_doc_id"]) & docs["source"].cast("string").eqNullSafe(wanted["_source"])
    on = on & (F.xxhash64(docs["text"]) == wanted["_hash"])
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_time")
    return docs.join(wanted, on).select(*[docs[c] for c in docs.columns], times).select(*docs.columns)
