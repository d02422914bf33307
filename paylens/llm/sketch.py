"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (A-Z lower-cased, words between ASCII white space); a shorter text is one shingle, and a
text without words has none. The sketch is the ``k`` smallest distinct 64-bit hashes of the shingles, in order. Of any two sketches
the k smallest of both together are the sketch of the union, so sketches merge across parts of a text, documents or sources, and

* resemblance is the share of the union's k smallest that both have,
* containment is the share of those of the first that the second has as well,
* the number of distinct shingles is (k - 1) / u, with u the k-th hash as a fraction of the range; below k hashes it is exact.

Equal texts have equal sketches. Null counts as empty. Two empty sketches resemble and contain each other wholly, an empty and another one not
at all. Only functions of Spark SQL are used. One text is one row; rows meet in ``merge`` and ``in_circle`` only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.blocks import columns, shards

#: Words of a shingle.
WORDS = 5
#: Hashes of a sketch; the standard error of a resemblance of a half is 0.044.
SIZE = 128

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_sketch(df: DataFrame, text: str, output: str, n: int = WORDS, k: int = SIZE) -> DataFrame:
    """``df`` with the sketch of a text column as an array of longs."""
    words = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x20\x09-\x0D]+"), "")
    # xxhash64 passes over the nulls behind the end of a short text
    places = F.sequence(F.lit(0), F.greatest(F.size("_words") - n, F.lit(0)))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(n)]))
    lowest = F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)
    none = F.array().cast("array<bigint>")
    return df.withColumn("_words", words).withColumn(output, F.when(F.size("_words") > 0, lowest).otherwise(none)).drop("_words")


def union(a: Column, b: Column, k: int = SIZE) -> Column:
    """The sketch of two texts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _share(a: Column, b: Column, of: Column) -> Column:
    """Share of the hashes ``of`` the union that both have."""
    n = F.size(of)
    return F.when(n > 0, F.size(F.array_intersect(F.array_intersect(a, b), of)) / n).otherwise((F.size(a) == F.size(b)).cast("double"))


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimate of the shingles in common divided by those of either; exact for sketches that hold all shingles."""
    return _share(a, b, union(a, b, k))


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimate of the share of the first one's shingles that the second has."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(_share(a, b, F.array_intersect(a, union(a, b, k))))


def distinct_shingles(a: Column, k: int = SIZE) -> Column:
    """Estimate of the number of distinct shingles."""
    fraction = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / fraction)


def fingerprint(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def parsed(text: Column) -> Column:
    """The sketch of a fingerprint: inverse of ``fingerprint``."""
    signed = lambda d: F.conv(d, 16, -10).cast("bigint")
    places = F.sequence(F.lit(1), F.length(text), F.lit(16))
    whole = F.transform(places, lambda i: signed(F.substring(text, i, F.lit(16))))
    return F.when(F.length(text) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def merge(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", k: int = SIZE) -> DataFrame:
    """One sketch per value of ``keys``: that of all its texts together.

    Equal hashes are reduced before the shuffle, and each task sends at most k hashes of a key on, however many rows it has.
    """
    rows = sketches.select(*keys, F.explode_outer(sketch).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_hash")))
    lowest = rows.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return lowest.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def _bucket(key: Column, edges: Column, bits: int) -> Column:
    """Number of edges up to the key, by binary search in ``2**bits - 1`` ascending edges."""
    steps = F.array(*[F.lit(2**b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(edges, at + s - 1) <= key, at + s).otherwise(at))


def in_circle(docs: DataFrame) -> tuple[DataFrame, Window]:
    """(doc_id, text, bucket, ghost) rows, and the window in which ``lead`` finds each row's next document.

    The next one has the next smaller doc_id; after the smallest comes the largest again. Null ids come after all others. Rows that
    share an id are ordered by hashes of their texts. Rows go to buckets by quantiles of (doc_id, hash), so an id that many
    rows share is parted as well. Each bucket has a ghost at its end, a copy of the first row of the next bucket: texts are
    shuffled once, and no task sees more than a bucket. Ghosts are to be left out when ``lead`` has been applied.
    """
    bits = max(1, math.ceil(math.log2(2 * shards(docs.sparkSession))))
    id_key = F.coalesce("doc_id", F.lit(-(2**63)))
    rows = columns(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), id_key.alias("id_key")).withColumn("text_key", F.xxhash64("text"))
    # rounding of large ids keeps the order
    rows = rows.withColumn("place", F.col("id_key").cast("double") * 65536 + F.shiftrightunsigned("text_key", 48))
    quantiles = F.percentile_approx("place", [i / 2**bits for i in range(1, 2**bits)], max(10_000, 16 * 2**bits))
    edges = rows.agg(quantiles).scalar()
    rows = rows.withColumn("edges", edges).withColumn("bucket", _bucket(F.col("place"), F.col("edges"), bits)).drop("edges")
    order = [F.desc("id_key"), F.desc(F.shiftrightunsigned("text_key", 48)), F.desc("text_key"), F.desc("text")]

    # first rows: the largest place of each bucket, then the first row of that place; at most one row a bucket is broadcast
    tops = rows.groupBy("bucket").agg(F.max("place").alias("place"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*order))
    first = rows.join(F.broadcast(tops), ["bucket", "place"], "left_semi").withColumn("rank", rank).where("rank = 1").drop("rank")
    # the first row of a bucket ends the next bucket above as a ghost, that of the highest one ends the lowest
    above, all_buckets = Window.orderBy("bucket"), Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = tops.select("bucket", F.coalesce(F.lead("bucket").over(above), F.min("bucket").over(all_buckets)).alias("ends"))
    ghosts = first.join(F.broadcast(ends), "bucket").drop("bucket").withColumnRenamed("ends", "bucket").withColumn("ghost", F.lit(1))
    circle = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts)
    return circle, Window.partitionBy("bucket").orderBy("ghost", *order)


def edited(text: Column, following: Column) -> Column:
    """The text with the last third of its characters replaced by as many first ones of the following text, or all of that."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def digests(docs: DataFrame, n: int = WORDS, k: int = SIZE) -> DataFrame:
    """Every document's fingerprint beside that of its edited text, and their resemblance; see ``edited`` and ``in_circle``."""
    circle, window = in_circle(docs)
    both = circle.withColumn("edited", edited(F.col("text"), F.coalesce(F.lead("text").over(window), F.lit(""))))
    both = with_sketch(with_sketch(both, "text", "sketch", n, k), "edited", "edited_sketch", n, k)
    both = both.withColumns({"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    a, b, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.withColumn("next_sketch", F.lead("sketch").over(window)).where("ghost = 0").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(a).alias("fingerprint"), fingerprint(b).alias("edited_fingerprint"),
        resemblance(a, b, k).alias("near_edited"), resemblance(a, following, k).alias("near_next"),
        containment(a, b, k).alias("edited_contains"), distinct_shingles(a, k).alias("distinct_shingles"))
