"""Merkle fixity audit: replicas of archives are compared by trees of hashes, and only where these differ.

A record has an archive (a WARC file) and an offset in it. The leaf of an offset is a digest of the records there, the
nodes above are ordered offset ranges of ``fanout`` children each. Roots of the same archive are compared
first; below, a level is joined only under nodes that differ, down to offsets and then records.

A leaf sums its records' SHA-256 digests, in four parts, so repeated records at one offset are reduced on the map side
however many there are; it does not depend on their order. Nodes hash their children in order.

Nulls are values of their own: null archives, null offsets and null contents compare equal to each other only. An archive's
records without offset are a tree of their own. Names of archives in a tree are as ``_key`` forms them.
Records that one replica lacks are found as well as altered ones. An empty replica lacks all. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.session import stage_table

FANOUT = 16


def record_hash(names: list[str]) -> Column:
    """SHA-256 of the columns, each with its length, null apart from empty."""
    parts = []
    for c in names:
        text = F.col(c).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.sha2(F.concat(*parts), 256)


def _key(archive: Column, offset: Column) -> Column:
    """An archive's name; a null one, and one for records without offset, start with a null character, as no other name is left to."""
    name = F.when(archive.isNull(), "\0n").when(archive.startswith("\0"), F.concat(F.lit("\0e"), archive)).otherwise(archive)
    return F.when(offset.isNull(), F.concat(F.lit("\0o"), name)).otherwise(name)


def _place(archive: str, offset: str) -> tuple[Column, Column]:
    node = F.col(offset).cast("long")
    return _key(F.col(archive).cast("string"), node).alias("archive"), F.coalesce(node, F.lit(0)).alias("node")


def _named(key: Column, node: Column) -> tuple[Column, Column]:
    """(archive, offset) of a key: inverse of ``_place``."""
    no_offset = key.startswith("\0o")
    name = F.when(no_offset, F.substring(key, 3, 2**30)).otherwise(key)
    archive = F.when(name == "\0n", None).when(name.startswith("\0e"), F.substring(name, 3, 2**30)).otherwise(name)
    return archive.alias("archive"), F.when(~no_offset, node).alias("offset")


def leaves(records: DataFrame, archive: str, offset: str, contents: list[str]) -> DataFrame:
    """(archive, node, digest, n): one leaf per offset."""
    hashed = records.select(*_place(archive, offset), record_hash(contents).alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"s{k}") for k in range(4)]
    sums = hashed.groupBy("archive", "node").agg(F.count("*").alias("n"), *parts)
    return sums.select("archive", "node", F.sha2(F.concat_ws(",", "n", "s0", "s1", "s2", "s3"), 256).alias("digest"), "n")


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """The level above: a node hashes its children's places and digests in order."""
    children = F.array_sort(F.collect_list(F.struct("node", "digest")))
    up = level.groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(children.alias("c"), F.sum("n").alias("n"))
    text = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"], x["digest"])), ",")
    return up.select("archive", F.col("up").alias("node"), F.sha2(text, 256).alias("digest"), "n")


def levels_for(fanout: int, *leaves_: DataFrame) -> int:
    """Levels above the leaves until an archive has one node left, so that no root has more than ``fanout`` children."""
    largest = max([x for t in leaves_ for x in t.agg(F.max("node"), -F.min("node")).first() if x is not None], default=0)
    levels = 1
    while fanout**levels <= largest:
        levels += 1
    return levels


def tree(records: DataFrame, archive: str, offset: str, contents: list[str], fanout: int = FANOUT, levels: int | None = None) -> list[DataFrame]:
    """Levels from the leaves to the roots of the archives, each written to the shared folder; as many as the largest offset needs."""
    first = stage_table(leaves(records, archive, offset, contents), "leaves")
    return grown(first, fanout, levels_for(fanout, first) if levels is None else levels)


def grown(first: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """All levels above the leaves."""
    out = [first]
    for k in range(levels):
        out.append(stage_table(parents(out[-1], fanout), f"level{k + 1}"))
    top = out[-1].groupBy("archive").agg(F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("c"), F.sum("n").alias("n"))
    text = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"], x["digest"])), ",")
    return [*out, top.select("archive", F.lit(0).cast("long").alias("node"), F.sha2(text, 256).alias("digest"), "n")]


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes (archive, node) of either side that the other lacks or has with another digest."""
    other = b.select("archive", "node", F.col("digest").alias("d"), F.col("n").alias("m"))
    return a.join(other, ["archive", "node"], "full").where("NOT digest <=> d").select(
        "archive", "node", F.coalesce("n", F.lit(0)).alias("n_primary"), F.coalesce("m", F.lit(0)).alias("n_replica"))


def audit(primary: list[DataFrame], replica: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(archive, node, n_primary, n_replica): the offsets at which the replicas differ."""
    found = differing(primary[-1], replica[-1]).select("archive")
    under = lambda level: level.join(found, "archive", "left_semi")
    found = differing(under(primary[-2]), under(replica[-2]))
    for a, b in zip(primary[-3::-1], replica[-3::-1]):
        up = found.select("archive", F.col("node").alias("_up"))
        below = lambda level: level.join(
            up, (level["archive"] == up["archive"]) & (F.floor(level["node"] / fanout) == up["_up"]), "left_semi")  # noqa: B023
        found = differing(below(a), below(b))
    return found


def damage(primary: DataFrame, replica: DataFrame, archive: str, offset: str, contents: list[str], **shape) -> DataFrame:
    """(archive, offset, record_sha256, n_primary, n_replica): records whose number differs, at the damaged offsets.

    An altered record is one that only the primary has and one that only the replica has, at the same offset.
    """
    fanout = shape.get("fanout", FANOUT)
    both = [stage_table(leaves(r, archive, offset, contents), "leaves") for r in (primary, replica)]
    levels = shape.get("levels") or levels_for(fanout, *both)
    bad = stage_table(audit(*[grown(t, fanout, levels) for t in both], fanout=fanout), "damage").select("archive", "node")
    key = ["archive", "node", "record_sha256"]

    def counted(records: DataFrame, name: str) -> DataFrame:
        keyed = records.select(*_place(archive, offset), record_hash(contents).alias("record_sha256"))
        return keyed.join(bad, ["archive", "node"], "left_semi").groupBy(*key).agg(F.count("*").alias(name))

    both = counted(primary, "n_primary").join(counted(replica, "n_replica"), key, "full").na.fill(0, ["n_primary", "n_replica"])
    return both.where("n_primary != n_replica").select(
        *_named(F.col("archive"), F.col("node")), "record_sha256", "n_primary", "n_replica")
