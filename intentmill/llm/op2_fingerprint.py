"""Document fingerprints: closed syncmers over words.

Of every k words in a row, those are kept whose smallest word hash stands first or last.
Whether k words are kept depends on them alone, so equal passages keep equal ones wherever
they stand: anchors free of context. The text's beginning is marked by k - 1 small hashes,
so the first words always give anchors and no text with words is without one. The
fingerprint lists the anchors' hashes in order of first place; two are as alike as twice
their common hashes are to all.

Only DataFrame functions are used. A text is hashed once to words; the rest works on
arrays of numbers. The next document is found in one shuffle: rows go to ranges of ids
cut at quantiles, and the first row of each range is also sent to the range before.

A NULL text is empty, and an empty text has an empty fingerprint, like to another empty
one. Rows are ordered by id, NULL first, then by text; repeated rows follow each other.
With one row, the next document is the row itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentmill.llm.common import texts


def word_hashes(text: Column, k: int) -> Column:
    """Hashes of the words, after k - 1 marks smaller than any."""
    cut = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.when(F.length(F.trim(text)) == 0, F.array().cast("array<bigint>")).otherwise(
        F.concat(F.array(*[F.lit(-(2**63) + d).cast("bigint") for d in range(k - 1)]), F.transform(cut, lambda w: F.xxhash64(w)))
    )


def anchors(hashes: Column, k: int) -> Column:
    """Hashes of the closed syncmers, each once, in order of first place.

    `hashes` must be a column, not an expression, as it is read once per word.
    """
    count = F.size(hashes) - (k - 1)
    at = lambda i, d: F.get(hashes, i + d)
    kept = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.when(
            F.least(at(i, 0), at(i, k - 1)) <= F.least(*[at(i, d) for d in range(1, k - 1)]),
            F.hash(*[at(i, d) for d in range(k)]),
        ),
    )
    return F.array_distinct(F.array_compact(kept))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common anchors over all; 1 for two empty fingerprints."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def with_next(docs: DataFrame, ranges: int) -> tuple[DataFrame, Window]:
    """Adds next_text, the text of the row after; `ghost` marks rows sent along to be dropped.

    Ranges are cut at quantiles of the id; as many numbers as ranges reach the driver. A
    row with the first id of a range is also sent, as a ghost, to the end of the range
    before; the first range's to the last one.
    """
    points = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", points, 10 * ranges)).first()[0] if points else None
    cuts = sorted(set(cuts or []))

    def halve(low: int, high: int) -> Column:
        """Cuts not above the id, by halving."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") >= cuts[middle], halve(middle + 1, high)).otherwise(halve(low, middle))

    number = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(halve(0, len(cuts)))
    placed = docs.withColumns({"tie": F.xxhash64("text"), "range": number})
    firsts = [
        (r["range"], None if r["none"] else r["least"])
        for r in placed.groupBy("range")
        .agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none")).collect()
    ]
    firsts.sort()
    links = docs.sparkSession.createDataFrame(
        [(r, first, firsts[i - 1][0]) for i, (r, first) in enumerate(firsts)],
        "range int, first_id long, range_before int",
    )
    sent = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("to"), F.lit(0).alias("ghost")),
            F.when(
                F.col("doc_id").eqNullSafe(F.col("first_id")),
                F.struct(F.col("range_before").alias("to"), F.lit(1).alias("ghost")),
            ),
        )
    )
    spread = placed.join(F.broadcast(links), "range").select(  # a row for each range
        "doc_id", "text", "tie", F.explode(sent).alias("x")
    ).select("doc_id", "text", "tie", "x.*")
    window = Window.partitionBy("to").orderBy("ghost", F.asc_nulls_first("doc_id"), "tie")
    return spread.withColumn("next_text", F.coalesce(F.lead("text").over(window), F.lit(""))), window


def fingerprint(docs: DataFrame, k: int = 5, ranges: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half, in code points, replaced by the first as many of
    the next document's.
    """
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paired, window = with_next(texts(docs), ranges)
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", 1, length - half), F.substring("next_text", 1, half))
    hashed = paired.withColumn("edited", edited).select(
        "doc_id", "tie", "to", "ghost", length.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        word_hashes(F.col("text"), k).alias("h"), word_hashes(F.col("edited"), k).alias("edited_h"),
    )
    kept = hashed.select(
        "doc_id", "tie", "to", "ghost", "n_chars", "edited_sha256",
        anchors(F.col("h"), k).alias("own"), anchors(F.col("edited_h"), k).alias("changed"),
    )
    following = kept.withColumn("next", F.lead("own").over(window)).where("ghost = 0")
    return following.select(
        "doc_id", "n_chars", "edited_sha256",
        F.array_join(F.col("own").cast("array<string>"), " ").alias("fingerprint"),
        F.array_join(F.col("changed").cast("array<string>"), " ").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
