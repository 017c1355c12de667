"""Reference sequence in packed rows, and indels written alike with its help."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.schemas import SITE
from varspark.session import stored

#: Reference bases per row.
CHUNK = 8192
#: Stands for a position that the reference does not hold.
BLANK = " "


def chunk_of(pos: Column, width: int = CHUNK) -> Column:
    return F.floor(pos / F.lit(width)).cast("long")


def reference_chunks(ref_bases: DataFrame, width: int = CHUNK) -> DataFrame:
    """contig, chunk, bases: the bases of ``width`` positions in one text, blank where (contig, pos, base) lacks one.

    Position p is character p % width of chunk p // width, from 0; blanks after the last base are left off.
    """
    at = (F.col("pos") % width).cast("int")
    held = ref_bases.groupBy("contig", chunk_of(F.col("pos"), width).alias("chunk")).agg(F.sort_array(F.collect_set(F.struct(at.alias("at"), "base"))).alias("held"))
    gap = lambda x, i: x["at"] - F.coalesce(F.get("held", i - 1)["at"], F.lit(-1)) - 1
    letters = F.transform("held", lambda x, i: F.concat(F.repeat(F.lit(BLANK), gap(x, i)), x["base"]))
    return held.select("contig", "chunk", F.array_join(letters, "").alias("bases"))


def agreeing(left: Column, right: Column, most: Column) -> Column:
    """How many first characters two texts share, up to ``most``.

    Found by halving steps, each a comparison of two stretches, as a text is walked from its begin to reach one character.
    """
    steps = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(most + 1)).cast("int"), F.lit(0))), lambda i: F.pow(F.lit(2), i).cast("int"))

    def longer(held: Column, step: Column) -> Column:
        same = F.substring(left, held + 1, step) == F.substring(right, held + 1, step)
        return F.when((held + step <= most) & same, held + step).otherwise(held)

    return F.when(most < 1, F.lit(0)).otherwise(F.aggregate(F.reverse(steps), F.lit(0), longer))


def trimmed(variants: DataFrame) -> DataFrame:
    """Alleles without the last and then the first bases that ref and alt share; a base of each stays."""
    short = F.least(F.length("ref"), F.length("alt")) - 1
    cut = variants.withColumn("_cut", agreeing(F.reverse("ref"), F.reverse("alt"), short))
    cut = cut.withColumns({c: F.substring(F.col(c), F.lit(1), F.length(c) - F.col("_cut")) for c in ("ref", "alt")})
    cut = cut.withColumn("_cut", agreeing(F.col("ref"), F.col("alt"), F.least(F.length("ref"), F.length("alt")) - 1))
    rest = {c: F.substring(F.col(c), F.col("_cut") + 1, F.length(c)) for c in ("ref", "alt")}
    return cut.withColumns({**rest, "pos": F.col("pos") + F.col("_cut")}).drop("_cut")


def _shifted(pending: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """Move indels left within their chunk; ``more`` where the chunk's first base was passed.

    An indel of ``unit`` after position ``at`` is also one base further left if the base at ``at`` is the unit's last.
    """
    met = pending.join(chunks, ["contig", "chunk"], "left")
    left = F.reverse(F.substring(F.coalesce("bases", F.lit("")), F.lit(1), (F.col("at") - F.col("chunk") * width + 1).cast("int")))
    met = met.withColumn("_left", left).withColumn("_most", F.least(F.length("_left"), (F.col("at") - 1).cast("int")))
    k = F.length("unit")
    cycle = F.repeat(F.reverse("unit"), (F.col("_most") / k).cast("int") + 1)
    met = met.withColumn("_m", agreeing(F.col("_left"), cycle, F.col("_most")))
    turn = F.col("_m") % k
    moved = F.concat(F.substring(F.col("unit"), k - turn + 1, turn), F.substring(F.col("unit"), F.lit(1), k - turn))
    # A chunk whose bases all agree is left behind, with its first base still to be compared by the chunk before.
    passed = (F.col("_m") == F.length("_left")) & (F.col("_m") > 0) & (F.col("at") - F.col("_m") >= 1)
    anchor = F.substring(F.col("_left"), F.col("_m") + 1, F.lit(1))
    return met.withColumns(
        {
            "at": F.col("at") - F.col("_m"),
            "unit": moved,
            "steps": F.col("steps") + F.col("_m"),
            "anchor": F.when(~passed & (F.length(anchor) > 0) & (anchor != BLANK), anchor),
            "more": passed,
        }
    ).withColumn("chunk", chunk_of(F.col("at"), width)).drop("bases", "_left", "_most", "_m")


def normalise_indels(variants: DataFrame, chunks: DataFrame, width: int = CHUNK) -> DataFrame:
    """The variants with pos, ref and alt of insertions and deletions trimmed and as far left as the packed reference allows.

    Different spellings of one indel in a repeat become one. Substitutions and what is neither insertion nor deletion are
    trimmed only. An indel stops before a position that the reference lacks, and before the contig's first base; where its own place
    is not held it stays as trimmed. Each distinct allele is moved once, chunk by chunk: only those that
    passed a chunk's first base meet the chunk before, and only whether any did comes to the driver.
    """
    given = [f"_given_{c}" for c in SITE]
    alleles = variants.select(*SITE).distinct().select(*[F.col(c).alias(g) for c, g in zip(SITE, given, strict=True)], *SITE)
    cut = trimmed(alleles)
    ref, alt = F.col("ref"), F.col("alt")
    inserted = F.length(alt) > F.length(ref)
    long, short = F.when(inserted, alt).otherwise(ref), F.when(inserted, ref).otherwise(alt)
    one = (F.length(short) == 1) & (F.length(long) > 1)
    after, before = one & F.startswith(long, short), one & F.endswith(long, short)
    unit = F.when(after, F.substring(long, F.lit(2), F.length(long))).when(before, F.substring(long, F.lit(1), F.length(long) - 1))
    placed = cut.withColumns({"inserted": inserted, "unit": unit, "at": F.when(after, F.col("pos")).otherwise(F.col("pos") - 1)})
    placed = placed.withColumns({"steps": F.lit(0), "chunk": chunk_of(F.col("at"), width)})
    columns = [*given, "contig", "pos", "ref", "alt", "inserted", "unit", "at", "steps", "chunk"]
    done, pending = [], placed.filter(F.col("unit").isNotNull()).select(*columns)
    while True:
        moved = stored(_shifted(pending, chunks, width), "indels")
        done.append(moved.filter(~F.col("more")))
        pending = moved.filter("more").select(*columns)
        if not pending.take(1):
            break
    ends = done[0]
    for part in done[1:]:
        ends = ends.unionByName(part)
    # Where no base is held before the unit, it steps back: the base there is the unit's own first.
    back = F.col("anchor").isNull() & (F.col("steps") > 0)
    first, rest = F.substring(F.col("unit"), F.lit(1), F.lit(1)), F.substring(F.col("unit"), F.lit(2), F.length("unit"))
    ends = ends.withColumns(
        {"_base": F.when(back, first).otherwise(F.col("anchor")), "_at": F.col("at") + back.cast("int"), "_unit": F.when(back, F.concat(rest, first)).otherwise(F.col("unit"))}
    )
    held, grown = F.col("_base").isNotNull(), F.concat("_base", "_unit")
    ends = ends.select(
        *given,
        F.when(held, F.col("_at")).otherwise(F.col("pos")).alias("pos"),
        F.when(held, F.when(F.col("inserted"), F.col("_base")).otherwise(grown)).otherwise(F.col("ref")).alias("ref"),
        F.when(held, F.when(F.col("inserted"), grown).otherwise(F.col("_base"))).otherwise(F.col("alt")).alias("alt"),
    )
    others = placed.filter(F.col("unit").isNull()).select(*given, "pos", "ref", "alt")
    spelled = ends.unionByName(others).withColumnsRenamed({"pos": "_pos", "ref": "_ref", "alt": "_alt"})
    names = dict(zip(given, SITE, strict=True))
    both = variants.join(spelled.withColumnsRenamed(names), SITE)
    new = {"pos": F.col("_pos"), "ref": F.col("_ref"), "alt": F.col("_alt")}
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in variants.columns])
