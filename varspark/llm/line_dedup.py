"""Line dedup: winnowing over line hashes finds repeated runs of lines, whose later copies go.

The fingerprint of a window of lines is its line with the least hash, the last
of equals. Equal windows choose the same line, so runs repeated over a
window's length or more share a fingerprint for certain. Only chosen lines are posted,
each once, with the lines that its windows reach before and after it. Postings whose
fingerprint occurs once are dropped. The others are extended both ways, line by line as far as a window that chose the line goes;
what agrees with an earlier place is a match, and overlapping matches join to runs.

A run shorter than a window is matched whole: lines and groups of lines that hold
enough words, and whole texts. Such a run is its own fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.llm.columns import SPACED_WORD, spare, wide_hash
from varspark.llm.stages import Stages
from varspark.session import stored

#: Lines per window: the shortest repeated run that is deleted whatever it holds.
WINDOW = 3
#: Words from which a shorter run is deleted too.
LEAST_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _chosen(hashes: Column, start: Column, window: int) -> Column:
    """The line that the window at ``start`` chooses."""
    own = F.slice(hashes, start + 1, window)
    return start + window - F.array_position(F.reverse(own), F.array_min(own)).cast("int")


def winnow(docs: DataFrame, window: int = WINDOW, least_words: int | None = LEAST_WORDS) -> DataFrame:
    """A row per posted line: doc_id, doc (text hash), line, its fingerprint (fa, fb), and low, near_a, near_b: the first line in reach and the hashes from there.

    The windows that chose the line are the runs of ``window`` lines within its reach. Unless ``least_words`` is
    None, runs of fewer lines that hold as many words, and whole texts of fewer lines that hold any word, are posted as well; they are
    their own fingerprint and reach no further (``size`` lines, 0 for a whole text; null for a window's line).
    """
    hashed = docs.select("doc_id", wide_hash("text").alias("doc"), _lines(F.col("text")).alias("lines")).select(
        "doc_id",
        "doc",
        F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("a"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(2), x)).alias("b"),
        *([] if least_words is None else [F.transform("lines", lambda x: F.regexp_count(x, F.lit(SPACED_WORD))).alias("words")]),
    )
    n = F.size("a")
    starts = lambda size: F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
    hashed = hashed.withColumn("chosen", F.transform(starts(window), lambda s: _chosen(F.col("a"), s, window)))

    def posting(line: Column) -> Column:
        own = F.filter(F.sequence(F.greatest(line - (window - 1), F.lit(0)), F.least(line, n - window)), lambda s: F.get("chosen", s) == line)
        low, reach = F.array_min(own), F.size(own) + (window - 1)
        return F.struct(
            line.alias("line"), F.get("a", line).alias("fa"), F.get("b", line).alias("fb"), F.lit(None).cast("int").alias("size"),
            low.alias("low"), F.slice("a", low + 1, reach).alias("near_a"), F.slice("b", low + 1, reach).alias("near_b"),
        )

    def short(start: Column, size: Column | int, kind: int) -> Column:
        lines = F.slice("a", start + 1, size), F.slice("b", start + 1, size)
        return F.struct(
            start.alias("line"), F.xxhash64(F.lit(1), F.lit(kind), *lines).alias("fa"), F.xxhash64(F.lit(2), F.lit(kind), *lines).alias("fb"), F.lit(kind).alias("size"),
            start.alias("low"), lines[0].alias("near_a"), lines[1].alias("near_b"),
        )

    parts = [F.transform(F.array_distinct("chosen"), posting)]
    if least_words is not None:
        held = lambda start, size: F.aggregate(F.slice("words", start + 1, size), F.lit(0), lambda x, y: x + y)
        enough = lambda size: F.filter(starts(size), lambda s: held(s, size) >= least_words)
        parts += [F.transform(enough(size), lambda s: short(s, size, size)) for size in range(1, window)]
        # A whole text of few words is compared with whole texts only.
        whole = F.filter(F.array(F.lit(0)), lambda s: (n < window) & held(s, n).between(1, least_words - 1))
        parts.append(F.transform(whole, lambda s: short(s, n, 0)))
    return hashed.select("doc_id", "doc", F.explode(F.concat(*parts)).alias("p")).select("doc_id", "doc", "p.*")


def extended(postings: DataFrame, window: int) -> DataFrame:
    """Runs of lines around postings: doc_id, doc, start, size, and the hash (wa, wb) of all their lines."""
    place = lambda k: F.struct(
        (F.col("low") + k).alias("start"),
        F.lit(window).alias("size"),
        F.xxhash64(F.lit(1), F.slice("near_a", k + 1, window), F.slice("near_b", k + 1, window)).alias("wa"),
        F.xxhash64(F.lit(2), F.slice("near_a", k + 1, window), F.slice("near_b", k + 1, window)).alias("wb"),
    )
    whole = F.array(F.struct(F.col("low").alias("start"), F.size("near_a").alias("size"), F.col("fa").alias("wa"), F.col("fb").alias("wb")))
    runs = F.when(F.col("size").isNull(), F.transform(F.sequence(F.lit(0), F.size("near_a") - window), place)).otherwise(whole)
    return postings.select("doc_id", "doc", F.explode(runs).alias("w")).select("doc_id", "doc", "w.*")


def later_runs(docs: DataFrame, window: int = WINDOW, least_words: int | None = LEAST_WORDS) -> DataFrame:
    """Runs of lines that repeat an earlier one: doc_id, doc, start, size.

    Earlier is by doc_id (null first), text hash, then line. Rows that repeat
    doc_id and text hold the same positions, so neither is earlier.
    """
    stages = Stages(docs.sparkSession)
    postings = stages.stored(winnow(docs, window, least_words), "line-postings")
    place = lambda at: F.struct("doc_id", "doc", F.col(at).alias("at"))
    repeated = postings.groupBy("fa", "fb").agg(F.min(place("line")).alias("from"), F.max(place("line")).alias("to"))
    repeated = repeated.where("`from` != `to`").select("fa", "fb")
    matched = extended(postings.join(repeated, ["fa", "fb"]), window)
    first = matched.groupBy("wa", "wb").agg(F.min(place("start")).alias("first"))
    later = matched.join(first, ["wa", "wb"]).where(place("start") > F.col("first")).select("doc_id", "doc", "start", "size")
    later = stored(later, "line-runs")
    stages.drop()
    return later


def dedup_lines(docs: DataFrame, window: int = WINDOW, least_words: int | None = LEAST_WORDS) -> DataFrame:
    """The rows with later repeated runs of lines deleted; adds n_lines and n_removed, replacing columns of these names.

    Lines end at line feeds and are compared whole. A line goes if it lies in a run
    of ``window`` lines or more that also starts at an earlier place, or in a shorter one that
    holds ``least_words`` words (between ASCII white space) or more, or if the whole text is shorter than a window and
    an earlier text is equal; ``least_words`` None leaves runs shorter than a window alone. Null texts
    stay null and have no lines; an empty text is one empty line. Each input row gives one row.
    """
    id_, doc, starts, kept = spare(docs, "id", "doc", "starts", "kept")
    runs = later_runs(docs, window, least_words).groupBy(F.col("doc_id").alias(id_), F.col("doc").alias(doc))
    runs = runs.agg(F.collect_set(F.struct("start", "size")).alias(starts))
    plain = docs.drop("n_lines", "n_removed")
    both = plain.join(runs, F.col("doc_id").eqNullSafe(F.col(id_)) & (wide_hash("text") == F.col(doc)), "left")
    gone = F.flatten(F.transform(starts, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    lines = _lines(F.col("text"))
    both = both.withColumn(kept, F.when(F.col(starts).isNotNull(), F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return both.select(
        *[F.when(F.col(kept).isNotNull(), text).otherwise(F.col("text")).alias("text") if c == "text" else f"`{c}`" for c in plain.columns],
        n_lines.alias("n_lines"),
        F.when(F.col(kept).isNotNull(), n_lines - F.size(kept)).otherwise(0).cast("long").alias("n_removed"),
    )
