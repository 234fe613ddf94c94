"""Units of an ordered record: nested speakers split off, headings and formats of items, each row in exactly one part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_nested(rows: DataFrame, unit: str, order: list[str], marker: Column, chair: Column, speaker: str, name: str, text: str, owner: str, question: Column, salutation: str) -> DataFrame:
    """``rows`` with ``part``, ``part_owner`` and, for markers, ``ruling``: where another speaker's words begin a part of their own.

    A marker names who speaks next. It splits its unit if the chair has named
    that speaker since the marker before (the floor is granted), it is no
    question, the next text opens with a salutation, and the speaker does not
    hold the floor already; all rows from it on go to the new part. Other
    markers are ruled ``same_speaker``, ``not_granted``, ``question`` or
    ``no_salutation`` and stay where they are.

    Who holds the floor is the speaker of the last marker that fulfils the
    other conditions (the unit's owner before the first), so one ordered pass
    of windows over a unit is enough and nothing is folded row by row.
    """
    w = Window.partitionBy(unit).orderBy(*order)
    upto, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    flagged = rows.withColumn("__m", F.coalesce(marker, F.lit(False))).withColumn("__c", F.coalesce(chair, F.lit(False)) & ~F.col("__m"))
    # stretches between markers: a marker closes its own
    flagged = flagged.withColumn("__s", F.coalesce(F.sum(F.col("__m").cast("int")).over(upto), F.lit(0)))
    # what the chair said in a stretch, once for each stretch; only markers need it
    said = flagged.filter("__c").groupBy(F.col(unit).alias("__u"), F.col("__s").alias("__t")).agg(F.collect_list(text).alias("__said"))
    flagged = flagged.join(said, F.col("__m") & F.col(unit).eqNullSafe(F.col("__u")) & (F.col("__s") == F.col("__t")), "left")
    granted = F.coalesce(F.exists("__said", lambda x: F.contains(x, F.col(name))), F.lit(False))
    spoken = ~F.col("__m") & ~F.col("__c")
    following = F.first(F.when(spoken, F.col(text)), ignorenulls=True).over(after)
    flagged = flagged.withColumn("__granted", granted).drop("__said", "__u", "__t").withColumn("__greets", F.coalesce(following.rlike(salutation), F.lit(False))).withColumn("__q", F.coalesce(question, F.lit(False)))
    fit = F.col("__m") & F.col("__granted") & ~F.col("__q") & F.col("__greets") & F.col(speaker).isNotNull()
    flagged = flagged.withColumn("__fit", fit)
    before = F.coalesce(F.last(F.when(F.col("__fit"), F.col(speaker)), ignorenulls=True).over(upto), F.col(owner))
    flagged = flagged.withColumn("__new", F.col("__fit") & ~before.eqNullSafe(F.col(speaker)))
    through = w.rowsBetween(Window.unboundedPreceding, 0)
    no = F.sum(F.col("__new").cast("int")).over(through)
    holder = F.coalesce(F.last(F.when(F.col("__new"), F.col(speaker)), ignorenulls=True).over(through), F.col(owner))
    ruling = (
        F.when(~F.col("__m"), None).when(F.col("__new"), "split").when(F.col("__fit"), "same_speaker").when(~F.col("__granted"), "not_granted").when(F.col("__q"), "question").otherwise("no_salutation")
    )
    part = F.when(no == 0, F.col(unit).cast("string")).otherwise(F.concat_ws(":", F.col(unit).cast("string"), no.cast("string")))
    out = flagged.withColumn("ruling", ruling).withColumn("part", part).withColumn("part_owner", holder)
    return out.drop("__m", "__c", "__s", "__granted", "__greets", "__q", "__fit", "__new")


def item_headings(lines: DataFrame, item: list[str], order: list[str], kind: str, text: str, first: str, second: str) -> DataFrame:
    """``(item, heading)``: the lines of kind ``first`` joined in order; without any, those of kind ``second``."""
    of = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == k, F.struct(*order, F.trim(text).alias("__x"))))), lambda x: x["__x"]), " ")
    known = lines.filter(F.trim(F.coalesce(text, F.lit(""))) != "")
    g = known.groupBy(*item).agg(of(first).alias("__a"), of(second).alias("__b"))
    return g.select(*item, F.coalesce(F.nullif("__a", F.lit("")), F.nullif("__b", F.lit(""))).alias("heading"))


def inherited_format(items: DataFrame, scope: str, label: str, order: list[str], heading: str, fmt: str) -> DataFrame:
    """``items`` with ``inherited``: an item without a heading takes the format of the first earlier item of its label that has one."""
    w = Window.partitionBy(scope, label).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.first(F.when(F.col(heading).isNotNull(), F.col(fmt)), ignorenulls=True).over(w)
    return items.withColumn("inherited", F.when(F.col(heading).isNull(), F.coalesce(first, F.col(fmt))).otherwise(F.col(fmt)))


def attached(rows: DataFrame, scope: str, order: list[str], back: Column, ahead: Column) -> DataFrame:
    """``rows`` with ``root`` (a struct of ``order``), ``side`` and ``state``: rows that become a prefix or suffix of a neighbour.

    A row may claim the row before it (``back``) or behind it (``ahead``);
    rows that claim neither stand for themselves. Chains end at the first row
    in their direction that goes on no further, so a chain of any length is
    settled by one look along the order. A row that claims both neighbours, has
    none on its side, or whose chain meets one that points back at it is
    ``refused`` and stands for itself.
    """
    w = Window.partitionBy(scope).orderBy(*order)
    yes = lambda c: F.coalesce(c, F.lit(False))
    both = yes(back) & yes(ahead)
    way = F.when(both, "both").when(yes(back), "back").when(yes(ahead), "ahead").otherwise("own")
    out = rows.withColumn("__way", way)
    at = F.struct(*[F.col(c).alias(c) for c in order], F.col("__way").alias("__way"))
    before = F.last(F.when(F.col("__way") != "back", at), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.first(F.when(F.col("__way") != "ahead", at), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    out = out.withColumn("__to", F.when(F.col("__way") == "back", before).when(F.col("__way") == "ahead", behind))
    ok = F.col("__to.__way") == "own"
    state = F.when(F.col("__way") == "own", "own").when(yes(ok), "attached").otherwise("refused")
    root = F.struct(*[F.when(yes(ok), F.col(f"__to.{c}")).otherwise(F.col(c)).alias(c) for c in order])
    side = F.when(yes(ok), F.when(F.col("__way") == "back", "suffix").otherwise("prefix"))
    return out.withColumns({"root": root, "side": side, "state": state}).drop("__way", "__to")
