"""Entity resolution in passes: strong ids, presented names, unique bucket partners, attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.graph import connected_components


def identity_key(*ranked: tuple[str, str]):
    """The first id present as ``prefix:id``."""
    return F.coalesce(*[F.concat(F.lit(p + ":"), F.col(c).cast("string")) for p, c in ranked])


def shared_key_edges(records: DataFrame, rec: str, keys: list[str]) -> DataFrame:
    """Every record tied to the smallest record of each strong key it has: a star for each key, not all pairs."""
    each = records.select(rec, F.explode(F.array(*[F.concat(F.lit(k + ":"), F.col(k).cast("string")) for k in keys])).alias("k")).filter("k is not null")
    low = each.groupBy("k").agg(F.min(rec).alias("dst"))
    return each.join(low, "k").select(F.col(rec).alias("src"), "dst")


def resolve(records: DataFrame, rec: str, edges: DataFrame) -> DataFrame:
    """``records`` with ``entity``: the smallest record of their component, themselves if alone."""
    comp = connected_components(edges)
    return records.join(comp.select(F.col("node").alias(rec), F.col("component").alias("entity")), rec, "left").withColumn("entity", F.coalesce("entity", rec))


def conflicting(entities: DataFrame, ids: list[str]) -> DataFrame:
    """Entities that hold two values of an id that a person has only once."""
    agg = [F.count_distinct(i).alias(i) for i in ids]
    bad = F.lit(False)
    for i in ids:
        bad = bad | (F.col(i) > 1)
    return entities.groupBy("entity").agg(*agg).filter(bad).select("entity")


def bucket_partners(entities: DataFrame, bucket: str, kind: str, kinds: tuple[str, str], ids: list[str]) -> DataFrame:
    """``(src, dst)`` of buckets with exactly one entity of each kind, unless their ids contradict, and only if both have no other partner."""
    per = entities.groupBy(bucket, kind).agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("entity"), *[F.max(i).alias(i) for i in ids]).filter("n = 1")
    a = per.filter(F.col(kind) == kinds[0]).select(bucket, F.col("entity").alias("src"), *[F.col(i).alias(f"a_{i}") for i in ids])
    b = per.filter(F.col(kind) == kinds[1]).select(bucket, F.col("entity").alias("dst"), *[F.col(i).alias(f"b_{i}") for i in ids])
    pair = a.join(b, bucket).filter("src <> dst")
    for i in ids:
        pair = pair.filter(F.coalesce(F.col(f"a_{i}") == F.col(f"b_{i}"), F.lit(True)))
    pair = pair.select("src", "dst").distinct()
    once_a = pair.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("src")
    once_b = pair.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("dst")
    return pair.join(once_a, "src", "left_semi").join(once_b, "dst", "left_semi")


def attach(loose: DataFrame, anchors: DataFrame, bucket: str, event: str) -> DataFrame:
    """``(src, dst)``: loose records to the only anchor of their bucket, unless both took part in the same event."""
    one = anchors.groupBy(bucket).agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("dst")).filter("n = 1").drop("n")
    pair = loose.select(F.col("entity").alias("src"), bucket).distinct().join(one, bucket).filter("src <> dst").select("src", "dst").distinct()
    a = loose.select(F.col("entity").alias("src"), event).distinct()
    b = anchors.select(F.col("entity").alias("dst"), event).distinct()
    clash = pair.join(a, "src").join(b, ["dst", event]).select("src", "dst").distinct()
    return pair.join(clash, ["src", "dst"], "left_anti")


def survivors(entities: DataFrame, ordinal: str, person: str) -> DataFrame:
    """``(person, survivor)``: merged persons point to the one with the lowest ordinal of their entity."""
    best = entities.groupBy("entity").agg(F.min_by(person, F.struct(ordinal, person)).alias("survivor"))
    return entities.join(best, "entity").select(person, "survivor").distinct()


def ambiguous_ids(records: DataFrame, ident: str, words: str) -> DataFrame:
    """Ids whose records have names that share no word.

    An id is told apart by one pass against its least name where that suffices,
    and is cleared where one word stands in all its names; only the different
    names of the ids that remain are compared with each other.
    """
    one = records.filter(F.col(ident).isNotNull() & F.col(words).isNotNull()).select(ident, F.array_sort(F.array_distinct(words)).alias("w")).distinct()
    sizes = one.groupBy(ident).agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("least")).filter("n > 1")
    told = one.join(sizes, ident).filter(~F.arrays_overlap("w", "least")).select(ident).distinct()
    shared = one.withColumn("word", F.explode("w")).groupBy(ident, "word").agg(F.count(F.lit(1)).alias("k"))
    cleared = shared.join(sizes, ident).filter("k = n").select(ident).distinct()
    open_ids = sizes.select(ident).join(told, ident, "left_anti").join(cleared, ident, "left_anti")
    rest = one.join(open_ids, ident)
    a, b = rest.select(ident, F.col("w").alias("a")), rest.select(ident, F.col("w").alias("b"))
    return told.unionByName(a.join(b, ident).filter("a < b").filter(~F.arrays_overlap("a", "b")).select(ident).distinct())


def close_aliases(aliases: DataFrame, src: str, dst: str) -> DataFrame:
    """``(src, target)``: chains of aliases followed to their end; a chain's end is its only name that is no alias."""
    comp = connected_components(aliases, src, dst)
    ends = aliases.select(F.col(dst).alias("node")).join(aliases.select(F.col(src).alias("node")), "node", "left_anti").distinct()
    target = comp.join(ends, "node").groupBy("component").agg(F.min("node").alias("target"))
    return comp.join(target, "component").join(aliases.select(F.col(src).alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias(src), "target")


def fold_evidence(rows: DataFrame, key: str, sets: list[str], flags: list[str], ranked: list[str], order: list[str]) -> DataFrame:
    """One row per key whatever the input order: sets united, flags ORed, the other values from the least row."""
    least = F.struct(*order, *[c for c in ranked if c not in order])
    return rows.groupBy(key).agg(
        *[F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(c) for c in sets],
        *[F.bool_or(c).alias(c) for c in flags],
        *[F.min_by(c, least).alias(c) for c in ranked],
    )


def unique_pairs(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """``(l, r)``: records whose key stands exactly once on either side."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(left_id).alias("l")).filter("n = 1").drop("n")
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(right_id).alias("r")).filter("n = 1").drop("n")
    return a.join(b, key).select("l", "r")


def name_key(name, noise: list[str]):
    """The distinct words of a name in lower case and sorted, titles and particles left out."""
    words = F.filter(F.split(F.lower(name), r"[\s#,.]+"), lambda w: (w != "") & ~w.isin(noise))
    return F.array_join(F.array_sort(F.array_distinct(words)), " ")


def overlay(rows: DataFrame, canonical: DataFrame, corrections: DataFrame, rec: str, person: str) -> DataFrame:
    """``rows`` with the person of their record; a reviewed correction wins over the computed one."""
    fixed = corrections.select(rec, F.col(person).alias("__fixed"))
    out = rows.join(canonical.select(rec, F.col(person).alias("__own")), rec).join(fixed, rec, "left")
    return out.withColumn(person, F.coalesce("__fixed", "__own")).drop("__fixed", "__own")


def bind_occurrences(occurrences: DataFrame, previous: DataFrame, occ: str, now: str, before: str, pinned: str) -> DataFrame:
    """``(occ, bound, rule)``: new ones bind as computed, pinned ones keep their person, others stay or move."""
    both = occurrences.join(previous, occ, "left")
    rule = F.when(F.col(before).isNull(), "new").when(F.col(before) == F.col(now), "stays").when(F.col(pinned), "kept").otherwise("moves")
    out = both.withColumn("rule", rule)
    return out.select(occ, F.when(F.col("rule").isin("stays", "kept"), F.col(before)).otherwise(F.col(now)).alias("bound"), "rule")


def presented_edges(records: DataFrame, rec: str, presented: str, ids: list[str]) -> DataFrame:
    """``(src, dst)``: records of the same presented identity tied to their smallest, unless an id has two values among them."""
    g = records.groupBy(presented).agg(F.min(rec).alias("dst"), *[F.count_distinct(i).alias(f"__{i}") for i in ids])
    for i in ids:
        g = g.filter(F.col(f"__{i}") <= 1)
    return records.join(g.select(presented, "dst"), presented).select(F.col(rec).alias("src"), "dst").filter("src <> dst")


def corroborated_edges(records: DataFrame, rec: str, weak: str, corroboration: str) -> DataFrame:
    """``(src, dst)``: records that share a weak id and also the corroborating value."""
    known = records.filter(F.col(weak).isNotNull() & F.col(corroboration).isNotNull())
    low = known.groupBy(weak, corroboration).agg(F.min(rec).alias("dst"))
    return known.join(low, [weak, corroboration]).select(F.col(rec).alias("src"), "dst").filter("src <> dst")
