"""Genomic intervals: restriction, exclusion, splitting and packing.

Positions are 1-based and closed; BED regions are 0-based and half-open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.operators.ordered import row_index, running_total
from varspark.operators.skew import SALT, SALTS, add_salt, repeat_salts
from varspark.session import stored

SITE_BIN = 10_000
#: Nested bins: each level is ``FAN`` times as wide as the one before, and a span is listed at the finest level at which it touches ``FAN`` bins at most.
FAN, LEVELS = 16, 5
#: Size of one row of bitmaps, its keys included.
BITMAP_BYTES = 4200


def _bin(column: str, width: int):
    return F.floor(F.col(column) / F.lit(width)).cast("long")


def level_of(start: str, end: str, width: int) -> Column:
    """The level of bins in which a span is listed; the widest one takes all that are longer."""
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(_bin(end, width * FAN**k) - _bin(start, width * FAN**k) < FAN, F.lit(k)).otherwise(level)
    return level


def levels_in(spans: DataFrame, width: int = SITE_BIN) -> list[int]:
    """Levels that the spans are listed in: ``LEVELS`` rows at most come to the driver."""
    found = spans.select(level_of("start_pos", "end_pos", width).alias("level")).distinct().collect()
    return sorted(r.level for r in found) or [0]


def merged(spans: DataFrame) -> DataFrame:
    """The same positions in spans that do not touch. A window holds the interval list of one contig."""
    along = Window.partitionBy("contig").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.select("contig", "start_pos", "end_pos", F.coalesce(F.col("start_pos") > reach + 1, F.lit(False)).cast("int").alias("_opens"))
    numbered = opened.withColumn("_run", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("contig", "_run").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("_run")


def nested_join(points: DataFrame, spans: DataFrame, levels: Sequence[int], *, width: int = SITE_BIN, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``bin_join`` over nested bins: a point is looked up once per level in use, and a span, however long, is listed in some ``FAN`` bins.

    With more than one level only inner joins are possible.
    """
    if len(levels) == 1:
        return bin_join(points, spans, width=width * FAN ** levels[0], how=how, salts=salts)
    if how != "inner":
        raise ValueError("several levels can be joined only if a match is wanted")
    places = F.array(*[F.struct(F.lit(k).alias("level"), _bin("pos", width * FAN**k).alias("bin")) for k in levels])
    left = points.withColumn("_place", F.explode(places))
    at = level_of("start_pos", "end_pos", width)
    listed = F.lit(None)
    for k in levels:
        first, last = _bin("start_pos", width * FAN**k), _bin("end_pos", width * FAN**k)
        # The function takes the bin alone: a second parameter, even one with a default, would be given the bin's index.
        bins = F.transform(F.sequence(first, last), lambda b: F.struct(F.lit(k).alias("level"), b.alias("bin")))  # noqa: B023
        listed = F.when(at == k, bins).otherwise(listed)
    right = spans.withColumn("_place", F.explode(listed)).withColumnsRenamed({"start_pos": "_start", "end_pos": "_end", "contig": "_contig"})
    left = left.withColumns({"_level": F.col("_place.level"), "_bin": F.col("_place.bin")}).drop("_place")
    right = right.withColumns({"_rlevel": F.col("_place.level"), "_rbin": F.col("_place.bin")}).drop("_place")
    if salts > 1:
        left, right = add_salt(left, salts), repeat_salts(right, salts).withColumnRenamed(SALT, f"_r{SALT}")
    on = (F.col("contig") == F.col("_contig")) & (F.col("_level") == F.col("_rlevel")) & (F.col("_bin") == F.col("_rbin"))
    if salts > 1:
        on = on & (F.col(SALT) == F.col(f"_r{SALT}"))
    met = left.join(right, on & F.col("pos").between(F.col("_start"), F.col("_end")))
    return met.drop("_contig", "_level", "_rlevel", "_bin", "_rbin", "_start", "_end", SALT, f"_r{SALT}")


def bin_bitmaps(points: DataFrame, width: int = SITE_BIN) -> DataFrame:
    """contig, bucket, bits: one bit per bin that holds a point, 32,768 bins to a row."""
    at = _bin("pos", width)
    bits = points.select("contig", F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    return bits.groupBy("contig", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def occupied_bins(points: DataFrame, width: int = SITE_BIN) -> DataFrame | None:
    """``bin_bitmaps`` if they may be broadcast by the session's own limit, else None.

    A row is 4 kB and stands for 32,768 bins, so they grow with the genome and not with the points: 3 billion bases in bins of
    1,024 give some 90 rows. They are stored and counted before that is decided; only the count comes to the driver.
    """
    spark = points.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = -1 if threshold.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold)
    if limit < BITMAP_BYTES:
        return None
    bitmaps = stored(bin_bitmaps(points, width), "bins")
    return bitmaps if bitmaps.count() * BITMAP_BYTES <= limit else None


def _in_occupied(spans: DataFrame, occupied: DataFrame) -> DataFrame:
    """Rows whose ``_bin`` holds a point."""
    bit = F.bitmap_bit_position("_bin")
    octet = F.conv(F.hex(F.substring(F.col("_bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    named = F.broadcast(occupied.toDF("_on", "_bucket", "_bits"))
    met = spans.join(named, (F.col("contig") == F.col("_on")) & (F.bitmap_bucket_number("_bin") == F.col("_bucket")))
    return met.filter(F.getbit(octet, (bit % 8).cast("int")) == 1).drop("_on", "_bucket", "_bits")


def bin_join(
    points: DataFrame,
    spans: DataFrame,
    *,
    width: int = SITE_BIN,
    how: str = "inner",
    by: Sequence[str] = ("contig",),
    heavy: str = "points",
    salts: int = SALTS,
    occupied: DataFrame | None = None,
) -> DataFrame:
    """Points (``pos``) joined to the spans (``start_pos`` to ``end_pos``) that hold them.

    A span is listed in every bin it touches and a point lies in one bin, so a
    match appears once and the join is a plain equi-join on (by, bin). Rows of
    the ``heavy`` side are salted over their bin and the other side is repeated,
    so that a crowded locus does not end in one task. Span columns other than
    its keys and bounds are kept. With ``occupied_bins`` of the points, spans are
    dropped before they are shuffled where their bin holds none.
    """
    if heavy == "spans" and how != "inner":
        raise ValueError("spans can be the salted side of an inner join only")
    keys = list(by)
    bounds = spans.withColumnsRenamed({"start_pos": "_start", "end_pos": "_end"})
    left, right = points, bounds
    on = [*keys, "_bin"]
    if salts > 1:
        if heavy == "points":
            left, right = add_salt(left, salts), repeat_salts(right, salts)
        else:
            left, right = repeat_salts(left, salts), add_salt(right, salts)
        on.append(SALT)
    left = left.withColumn("_bin", _bin("pos", width))
    right = right.withColumn("_bin", F.explode(F.sequence(_bin("_start", width), _bin("_end", width))))
    if occupied is not None:
        right = _in_occupied(right, occupied)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on, "_start", "_end")
    right = right.withColumnsRenamed({k: f"_r{k}" for k in on})
    matched = [F.col(k) == F.col(f"_r{k}") for k in on]
    inside = F.col("pos").between(F.col("_start"), F.col("_end"))
    out = left.join(right, [*matched, inside], how)
    return out.drop("_bin", SALT, "_start", "_end", *[f"_r{k}" for k in on])


def bed_to_spans(bed: DataFrame) -> DataFrame:
    """Half-open regions as closed 1-based spans; empty regions hold nothing."""
    return bed.filter(F.col("bed_start") < F.col("bed_end")).select(
        "contig", (F.col("bed_start") + 1).alias("start_pos"), F.col("bed_end").alias("end_pos")
    )


def restrict_to_intervals(sites: DataFrame, intervals: DataFrame, width: int = SITE_BIN, salts: int = SALTS) -> DataFrame:
    """Sites inside at least one interval."""
    spans = intervals.select("contig", "start_pos", "end_pos")
    levels = levels_in(spans, width)
    if len(levels) == 1:
        return nested_join(sites, spans, levels, width=width, how="left_semi", salts=salts)
    # Merged intervals hold a site once at most, at whatever level.
    whole = merged(spans)
    return nested_join(sites, whole, levels_in(whole, width), width=width, salts=salts).select(*sites.columns)


def assign_interval(sites: DataFrame, intervals: DataFrame, width: int = SITE_BIN, salts: int = SALTS) -> DataFrame:
    """Sites tagged with the id of their interval."""
    spans = intervals.select("contig", "start_pos", "end_pos", "interval_id")
    return nested_join(sites, spans, levels_in(spans, width), width=width, salts=salts)


def exclude_regions(sites: DataFrame, bed: DataFrame, width: int = SITE_BIN, salts: int = SALTS) -> DataFrame:
    """Sites outside every excluded region; the regions of each level in use are taken out in turn."""
    spans = bed_to_spans(bed)
    for level in levels_in(spans, width):
        here = spans.filter(level_of("start_pos", "end_pos", width) == level)
        sites = nested_join(sites, here, [level], width=width, how="left_anti", salts=salts)
    return sites


def exclude_contig(sites: DataFrame, contig: str) -> DataFrame:
    return sites.filter(F.col("contig") != contig)


def only_contig(sites: DataFrame, contig: str) -> DataFrame:
    return sites.filter(F.col("contig") == contig)


def split_intervals(contigs: DataFrame, n: int) -> DataFrame:
    """At most ``n`` groups of whole contigs with about equal length.

    A contig joins the group in which it starts when the genome is cut into n
    equal shares; shares in which none starts vanish and the rest are renumbered.
    """
    total = contigs.agg(F.sum("length").alias("total")).scalar()
    placed = running_total(contigs, F.col("length"), "_reach", order=["idx"]).withColumn(
        "_share", F.floor((F.col("_reach") - F.col("length")) * F.lit(n) / total).cast("long")
    )
    # at most n rows, whatever the number of contigs
    numbered = (
        placed.select("_share")
        .distinct()
        .withColumn("group_id", F.row_number().over(Window.orderBy("_share")).cast("long") - 1)
    )
    return placed.join(numbered, "_share").select("group_id", "contig", "idx", "length")


def chunk_members(intervals: DataFrame, k: int, order: str = "interval_no", cost: str = "cost") -> DataFrame:
    """Neighbouring intervals in ``k`` chunks of near-equal cost, a row each: chunk_id, place in the chunk from 0, the interval's columns.

    An interval belongs to the chunk in which it starts when the whole cost is cut into ``k`` equal shares. Costs are
    summed and places counted in blocks, so neither the list nor a chunk is one task or one text.
    """
    total = intervals.agg(F.sum(cost).alias("total")).scalar()
    placed = running_total(intervals, F.col(cost), "_reach", order=[order]).withColumn(
        "chunk_id", F.floor((F.col("_reach") - F.col(cost)) * F.lit(k) / total).cast("long")
    )
    return row_index(placed.drop("_reach"), "place", order=[order], keys=["chunk_id"])


def pack_chunks(intervals: DataFrame, k: int, order: str = "interval_no", cost: str = "cost") -> DataFrame:
    """Neighbouring intervals in ``k`` chunks of near-equal cost: ids joined by ';'.

    The ids of a chunk become one text; the scatter list bounds its length.
    """
    total = intervals.agg(F.sum(cost).alias("total")).scalar()
    placed = running_total(intervals, F.col(cost), "_reach", order=[order]).withColumn(
        "chunk_id", F.floor((F.col("_reach") - F.col(cost)) * F.lit(k) / total).cast("long")
    )
    listed = F.sort_array(F.collect_list(F.struct(order, "interval_id")))["interval_id"]
    return placed.groupBy("chunk_id").agg(
        F.concat_ws(";", listed).alias("intervals"),
        F.count("*").alias("n_intervals"),
        F.sum(cost).alias("cost"),
    )


def explode_chunks(chunks: DataFrame) -> DataFrame:
    """One row per interval of a ';' list, in list order."""
    return chunks.select(
        *[c for c in chunks.columns if c != "intervals"],
        F.posexplode(F.split("intervals", ";")).alias("place", "interval_id"),
    ).withColumn("place", F.col("place").cast("long"))


def check_gather_order(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Parts that start before a part ahead of them on the contig has ended, with the one ahead that reaches farthest.

    One group is the scatter list of one table, a few thousand parts.
    """
    ahead = Window.partitionBy(*keys, "contig").orderBy("start_pos", "interval_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn("_far", F.max(F.struct("end_pos", "interval_id")).over(ahead))
        .withColumn("previous_id", F.col("_far.interval_id"))
        .withColumn("previous_end", F.col("_far.end_pos"))
        .drop("_far")
        .filter(F.col("start_pos") <= F.col("previous_end"))
    )
