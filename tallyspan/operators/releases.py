"""Releases of a table as trees of digests: only what differs is compared, written and read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.session import materialize

BUCKETS = 256
#: Children of a node.
FAN = 16


def _row_digest(columns: list[str]) -> Column:
    field = lambda c: F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(field, sorted(columns))), 256)


def bucketed(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with ``bucket``, by a hash of the key."""
    return rows.withColumn("bucket", F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(buckets)).cast("int"))


def digest_tree(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``(level, node, digest, n_rows)``: level 0 has a node for each bucket, the last level one for all.

    A bucket's digest adds up its rows' digests in four parts, so it is the
    same in any order and partial sums meet in the shuffle; nodes above hash
    their children in order.
    """
    parts = [F.sum(F.conv(F.substring("__h", 1 + 16 * i, 12), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)]
    each = bucketed(rows, key, buckets).select("bucket", _row_digest(rows.columns).alias("__h"))
    level = each.groupBy(F.col("bucket").alias("node")).agg(F.sha2(F.concat_ws("-", *parts), 256).alias("digest"), F.count(F.lit(1)).alias("n_rows"))
    level = materialize(level, "release-digests")
    out, at, width = level.select(F.lit(0).alias("level"), "node", "digest", "n_rows"), 0, buckets
    while width > 1:
        kids = F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))), lambda s: F.concat(s["node"].cast("string"), F.lit("="), s["digest"]))  # FAN children
        level = level.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("node")).agg(F.sha2(F.array_join(kids, ","), 256).alias("digest"), F.sum("n_rows").alias("n_rows"))
        at, width = at + 1, -(-width // FAN)
        out = out.unionByName(level.select(F.lit(at).alias("level"), "node", "digest", "n_rows"))
    return out


def differing(old: DataFrame, new: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The buckets in which two trees differ, from the root down: below equal nodes nothing is looked at.

    At most ``buckets`` numbers come to the driver.
    """
    top = 0
    while FAN**top < buckets:
        top += 1
    nodes = [0]
    for level in range(top, -1, -1):
        own = lambda t: t.filter((F.col("level") == level) & F.col("node").isin(nodes)).select("node", F.col("digest"))  # noqa: B023, E731
        unlike = own(old).withColumnRenamed("digest", "a").join(own(new).withColumnRenamed("digest", "b"), "node", "full_outer").filter("not a <=> b")
        nodes = sorted(r.node for r in unlike.select("node").collect())
        if not nodes or level == 0:
            return nodes
        nodes = [c for n in nodes for c in range(n * FAN, (n + 1) * FAN)]
    return nodes


class Releases:
    """Releases of one table in a folder. Files are never changed: each release writes the buckets that differ and says where all of them lie."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def publish(self, rows: DataFrame, before: str | None = None) -> tuple[str, list[int]]:
        """(name of the release, buckets written); ``before`` is the release that unchanged buckets are taken over from."""
        name = uuid.uuid4().hex
        tree = materialize(digest_tree(rows, self.key, self.buckets), "release-tree")
        if before is None:
            changed = sorted(r.node for r in tree.filter("level = 0").select("node").collect())
            kept = self.spark.createDataFrame([], "bucket int, release string")
        else:
            changed = differing(self.tree(before), tree, self.buckets)
            kept = self._places(before).filter(~F.col("bucket").isin(changed))
        if changed:
            own = bucketed(rows, self.key, self.buckets).filter(F.col("bucket").isin(changed))
            own.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/release={name}")
        there = tree.filter("level = 0").select(F.col("node").alias("bucket"))
        places = kept.join(there, "bucket", "left_semi").unionByName(there.filter(F.col("bucket").isin(changed)).withColumn("release", F.lit(name)))
        rows.limit(0).write.parquet(f"{self.path}/schemas/{name}")
        places.coalesce(1).write.parquet(f"{self.path}/places/{name}")
        tree.coalesce(1).write.parquet(f"{self.path}/trees/{name}")  # last: a release without its tree was never finished
        return name, changed

    def tree(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/trees/{name}")

    def _places(self, name: str) -> DataFrame:
        return self.spark.read.schema("bucket int, release string").parquet(f"{self.path}/places/{name}")

    def rows(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a release, or of some of its buckets; only their files are read."""
        at = self._places(name)
        at = at if buckets is None else at.filter(F.col("bucket").isin(buckets))
        places: dict[str, list[int]] = {}
        for r in at.collect():  # a row for each bucket
            places.setdefault(r.release, []).append(r.bucket)
        out = None
        for release, own in sorted(places.items()):
            part = self.spark.read.parquet(f"{self.path}/data/release={release}").filter(F.col("bucket").isin(own)).drop("bucket")
            out = part if out is None else out.unionByName(part)
        if out is None:
            out = self.spark.read.parquet(f"{self.path}/schemas/{name}")
        return out

    def changelog(self, before: str, after: str) -> DataFrame:
        """``(key, change)``: added, removed and changed rows; only buckets that differ are read."""
        buckets = differing(self.tree(before), self.tree(after), self.buckets)
        a, b = self.rows(before, buckets), self.rows(after, buckets)
        of = lambda t, name: t.groupBy(self.key).agg(F.sort_array(F.collect_list(_row_digest(t.columns))).alias(name))
        both = of(a, "__a").join(of(b, "__b"), self.key, "full_outer")
        change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed")
        return both.select(self.key, change.alias("change")).filter("change is not null")
