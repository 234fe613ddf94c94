"""Choices by precedence and closures: which evidence counts, which features run, which pages differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.texts import strip_boilerplate
from tallyspan.session import materialize


def preferred_evidence(evidence: DataFrame, unit: str, source: str, value: str, precedence: list[str]) -> DataFrame:
    """``(unit, value, source, state)``: what the best source that says anything says.

    Sources stand in ``precedence``; others don't count. A source that says two
    things is a ``conflict``, and no lesser source may settle it.
    """
    place = F.array_position(F.array(*map(F.lit, precedence)), F.col(source))
    said = evidence.filter(F.col(value).isNotNull() & (place > 0)).withColumn("__p", place)
    g = said.groupBy(unit, "__p", source).agg(F.min(value).alias("__a"), F.max(value).alias("__z"))
    best = g.groupBy(unit).agg(F.min(F.struct("__p", source, "__a", "__z")).alias("b"))
    same = F.col("b.__a") == F.col("b.__z")
    return best.select(unit, F.when(same, F.col("b.__a")).alias(value), F.col(f"b.{source}").alias(source), F.when(same, "settled").otherwise("conflict").alias("state"))


def feature_states(features: DataFrame, needs: DataFrame, vetoed: DataFrame, key: str, needed: str, max_rounds: int = 200) -> DataFrame:
    """``(key, state, round)``: runs, vetoed, or blocked by something it needs, directly or not, that is vetoed or unknown.

    Each round blocks what needs the features blocked in the round before, so
    rounds are as many as the longest chain, and a circle ends as all of it is
    known. The tables stay in Spark.
    """
    known = features.select(key).distinct()
    links = materialize(needs.select(key, F.col(needed).alias("__n")).filter("__n is not null").distinct().join(known, key, "left_semi"), "needs")
    off = vetoed.select(key).distinct().join(known, key, "left_semi").withColumn("state", F.lit("vetoed"))
    lost = links.join(known.withColumnRenamed(key, "__n"), "__n", "left_anti").select(key).distinct().join(off, key, "left_anti").withColumn("state", F.lit("blocked"))
    front = materialize(off.unionByName(lost).withColumn("round", F.lit(0)), "blocked")
    rounds = [front]
    for n in range(1, max_rounds + 1):
        settled = rounds[0]
        for r in rounds[1:]:
            settled = settled.unionByName(r)
        reached = links.join(front.select(F.col(key).alias("__n")), "__n").select(key).distinct().join(settled, key, "left_anti")
        front = materialize(reached.select(key, F.lit("blocked").alias("state"), F.lit(n).alias("round")), "blocked")
        if front.isEmpty():
            break
        rounds.append(front)
        if len(rounds) > 8:  # few tables, whatever the number of rounds
            rounds = [materialize(settled.unionByName(front), "blocked")]
    else:
        raise RuntimeError(f"needs did not settle in {max_rounds} rounds")
    settled = rounds[0]
    for r in rounds[1:]:
        settled = settled.unionByName(r)
    return known.join(settled, key, "left").select(key, F.coalesce("state", F.lit("runs")).alias("state"), "round")


def group_digests(rows: DataFrame, by: list[str]) -> DataFrame:
    """``(by, n, digest)`` of the rows of each group, in any order: sums of row hashes, which combine before the shuffle."""
    h = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.sum(F.conv(F.substring("__h", i, 12), 16, 10).cast("decimal(38,0)")).cast("string")
    return rows.select(*by, h.alias("__h")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.concat_ws("-", part(1), part(13), part(25)).alias("digest"))


def differing_groups(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """``(by, old_n, new_n)`` of the groups whose rows differ."""
    a = group_digests(old, [by]).select(by, F.col("n").alias("old_n"), F.col("digest").alias("__a"))
    b = group_digests(new, [by]).select(by, F.col("n").alias("new_n"), F.col("digest").alias("__b"))
    both = a.join(b, by, "full_outer").filter(~F.col("__a").eqNullSafe(F.col("__b")))
    return both.select(by, F.coalesce("old_n", F.lit(0)).alias("old_n"), F.coalesce("new_n", F.lit(0)).alias("new_n"))


def page_changes(old: DataFrame, new: DataFrame, key: str, item: str, fields: list[str]) -> DataFrame:
    """``(key, item, change, fields)``: what pages of one key lost, gained, or show otherwise, and in which fields.

    Pages that are there on one side only lose or gain all their items.
    """
    a = old.select(key, item, F.lit(1).alias("__a"), *[F.col(f).alias(f"__a_{f}") for f in fields])
    b = new.select(key, item, F.lit(1).alias("__b"), *[F.col(f).alias(f"__b_{f}") for f in fields])
    both = a.join(b, [key, item], "full_outer")
    unlike = F.array_compact(F.array(*[F.when(~F.col(f"__a_{f}").eqNullSafe(F.col(f"__b_{f}")), F.lit(f)) for f in fields]))
    change = F.when(F.col("__b").isNull(), "lost").when(F.col("__a").isNull(), "gained").when(F.size(unlike) > 0, "changed")
    got = both.withColumns({"change": change, "fields": F.when(change == "changed", F.array_join(unlike, ","))})
    return got.filter("change is not null").select(key, item, "change", "fields")


def topic_choice(heading: Column, titles: Column, patterns: list[str], least: int = 2) -> Column:
    """A struct ``(topic, origin)``: the heading without boilerplate if ``least`` long words are left, else the first such title, else what there is."""
    clean = strip_boilerplate(heading, patterns)
    telling = lambda x: F.size(F.regexp_extract_all(x, F.lit(r"(\p{L}{5,})"), F.lit(1))) >= least
    known = F.filter(titles, lambda t: F.trim(F.coalesce(t, F.lit(""))) != "")
    first = F.get(F.filter(known, telling), 0)
    pair = lambda topic, origin: F.struct(topic.alias("topic"), F.lit(origin).alias("origin"))
    return (
        F.when(telling(clean), pair(clean, "heading")).when(first.isNotNull(), pair(first, "title")).when(clean.isNotNull(), pair(clean, "short_heading"))
        .when(F.size(known) > 0, pair(F.get(known, 0), "short_title")).otherwise(pair(F.lit(None).cast("string"), "none"))
    )


def announced_asker(announcement: Column) -> Column:
    """A struct ``(name, grp)`` of who a chair announces a question of: the last one named, without titles and forms of address."""
    pattern = r"(?s).*\bFrage \d+ (?:des|der) (?:Abgeordneten|Kollegen|Kollegin|Herrn|Frau)\s+(?:(?:Dr|Prof)\.\s+)*([^(,:]+?)\s*(?:\(([^)]+)\)|,\s*([^:]+?))?\s*:"
    part = lambda n: F.nullif(F.trim(F.regexp_extract(announcement, pattern, n)), F.lit(""))
    return F.struct(part(1).alias("name"), F.coalesce(part(2), part(3)).alias("grp"))


def ordered_output(rows: DataFrame, scope: list[str], keys: list[Column]) -> DataFrame:
    """``rows`` with ``position`` within their scope under an order of several keys, which must tell all rows apart."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*scope).orderBy(*keys)))
