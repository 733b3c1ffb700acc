"""Benchmark decontamination: winnowed fingerprints, joined, extended to whole windows.

Words are hashed, every k of them in a row give a gram, and of every w grams in a row the
smallest is the fingerprint (k + w - 1 = the window of 13 words). Two texts that share a
window choose the same gram in it, so every shared window has a joint fingerprint. A
document's windows whose fingerprint the benchmark has are candidates: a bitmap of fixed
size removes nearly all others before anything is shuffled. Candidates are joined with
the benchmark's on fingerprint and on the window's own words, so a hit is a true
occurrence. Items shorter than a window are one window each and are found in the same
way by their first gram, or first word.

Only DataFrame functions are used. The bitmap has a fixed number of bits; should the
benchmark fill it, more candidates are joined, with the same result. The join is left to
the optimizer, which splits frequent windows. Hits are gathered per document, so an
array is never longer than its document.

A NULL text has no words. The windows of an item without an id are hits like others; only its
id is left out of the items. Rows with equal id and text are counted each and get the same
result. An empty benchmark or table of documents gives no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.llm.common import fresh, stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; only A-Z change case. All-ASCII texts take the faster way."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _BETWEEN), "")


def _positions(count: Column) -> Column:
    """0 to count - 1, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _grams(words_: DataFrame, k: int) -> DataFrame:
    """Adds h, the words' hashes, and g, the hashes of k words in a row."""
    hashed = words_.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn(
        "g",
        F.transform(
            _positions(F.size("h") - (k - 1)), lambda i: F.xxhash64(*[F.get(F.col("h"), i + d) for d in range(k)])
        ),
    )


def _winnowed(grams: DataFrame, w: int) -> DataFrame:
    """Adds m, the smallest of every w grams in a row: the fingerprint of each window."""
    return grams.withColumn(
        "m",
        F.transform(
            _positions(F.size("g") - (w - 1)), lambda i: F.least(*[F.get(F.col("g"), i + d) for d in range(w)])
        ),
    )


def _bitmap(keys: DataFrame, bits: int) -> Column:
    """A constant array of 2^bits bits with those of the keys set; of the same size for any input."""
    slots = (
        keys.select(F.expr(f"key & {(1 << bits) - 1}").alias("slot"))
        .groupBy(F.expr("slot >> 6").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("set"))
    )
    found = {r["at"]: r["set"] for r in slots.toLocalIterator()}  # 2^bits / 64 rows at most
    text = ",".join(str(found.get(i, 0)) for i in range(1 << (bits - 6)))
    return F.split(F.lit(text), ",").cast("array<bigint>")


def _in_bitmap(bitmap: Column, bits: int) -> Callable[[Column], Column]:
    def known(key: Column) -> Column:
        slot = key.bitwiseAND(F.lit((1 << bits) - 1))
        long_ = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
        return F.call_function("getbit", long_, slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    return known


def _after(first: Callable[[Column], Column], then: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: then(first(x))


def _key(n: int, window: int, k: int) -> Callable[[Column], Column]:
    """What finds n words from a place: a window's fingerprint, else its first gram or word."""
    source = "m" if n == window else "g" if n >= k else "h"
    return lambda i: F.get(F.col(source), i)


def _spans(n: int, where: Column, key: Callable[[Column], Column]) -> Column:
    """Windows of n words from the given positions, with what finds them."""
    return F.transform(
        where,
        lambda i: F.struct(
            i.alias("at"), F.lit(n).alias("n"), key(i).alias("key"),
            F.array_join(F.slice(F.col("words"), i + 1, F.lit(n)), " ").alias("span"),
        ),
    )


def item_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """n, key, span and the ids of the items that hold the window."""
    cut = _winnowed(
        _grams(items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words")), k),
        window - k + 1,
    ).where(F.size("words") > 0)
    whole = _spans(window, _positions(F.size("words") - (window - 1)), _key(window, window, k))
    short = F.when(F.size("words") >= window, F.array().cast("array<struct<at:int,n:int,key:bigint,span:string>>"))
    for n in range(1, window):
        short = short.when(F.size("words") == n, _spans(n, F.array(F.lit(0)), _key(n, window, k)))
    return (
        cut.select("item", F.explode(F.concat(whole, short)).alias("x"))
        .groupBy("x.n", "x.key", "x.span").agg(F.collect_set("item").alias("items"))
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 13, k: int = 5, bits: int = 20, share: int = 20
) -> DataFrame:
    """Per row: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if hit words are at least one `share`-th of its words.
    """
    bench = item_windows(items, window, k)
    lengths = sorted(r[0] for r in bench.select("n").distinct().toLocalIterator())  # at most `window`
    base = _grams(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
            words(docs["text"]).alias("words"),
        ),
        k,
    )
    base = _winnowed(base, window - k + 1)
    count = F.size("words")
    candidates = [F.array().cast("array<struct<at:int,n:int,key:bigint,span:string>>")]
    for n in lengths:
        key = _key(n, window, k)
        known = _in_bitmap(_bitmap(bench.where(F.col("n") == n).select("key"), bits), bits)
        there = F.filter(_positions(count - (n - 1)), _after(key, known))
        candidates.append(_spans(n, there, key))
    # Every document sends one row of its own besides its candidates; it finds no partner.
    own = F.array(
        F.struct(
            F.lit(-1).alias("at"), F.lit(0).alias("n"), F.xxhash64("doc_id", "text_hash").alias("key"),
            F.lit("").alias("span"),
        )
    )
    sent = base.select("doc_id", "text_hash", count.alias("n_words"), F.explode(F.concat(own, *candidates)).alias("x"))
    joined = (
        sent.select("doc_id", "text_hash", "n_words", "x.*")
        .join(bench, ["n", "key", "span"], "left")
        .where("n = 0 or items is not null")
    )
    hit = F.when(F.col("n") > 0, F.struct("at", "n"))
    by_doc = joined.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("n") == 0, 1)).cast("int").alias("copies"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["to"], x["at"] + x["n"]).alias("to"),
            (s["n"] + F.greatest(F.lit(0), x["at"] + x["n"] - F.greatest(s["to"], x["at"]))).alias("n"),
        ),
        lambda s: s["n"].cast("long"),
    )
    return (
        by_doc.withColumn("n_hit", covered)
        .select(
            "doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )


def clean_only(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns and as often as they come."""
    found = decontaminate(docs, items, **how).where("contaminated").select("doc_id", "text_hash").distinct()
    key, found_id, found_hash = (fresh(docs, x) for x in ("text_hash", "found_id", "found_hash"))
    # Stored, so that its true size is known before the texts are read: few ids need no shuffle of texts.
    found = stored(found, "contaminated").toDF(found_id, found_hash)
    return (
        docs.withColumn(key, F.xxhash64("text"))
        .join(found, F.col("doc_id").eqNullSafe(F.col(found_id)) & F.col(key).eqNullSafe(F.col(found_hash)), "left_anti")
        .drop(key)
    )
