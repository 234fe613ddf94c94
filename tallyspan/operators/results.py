"""Official results: the tally of a page that is a vote's own, and the outcome that the page states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tallies(pages: DataFrame, page: str, text: str, tally: str, doc: str) -> DataFrame:
    """``(page, tally_no, yes, no, announced, docs, outcome)``: every tally of a page with what is said of it.

    Blank lines end a block. Within a block the words before a tally announce
    it, those behind it, up to the next tally, tell its outcome. ``tally`` is a
    pattern with the groups yes and no, ``doc`` one of document numbers.
    """
    blocks = pages.select(page, F.posexplode(F.split(text, r"\n[ \t]*\n")).alias("__b", "__t"))
    cut = blocks.select(page, "__b", F.posexplode(F.split("__t", f"(?={tally})")).alias("__k", "__x"), "__t")
    head = F.when(F.col("__k") == F.when(F.regexp_count("__t", F.lit(f"^(?:{tally})")) > 0, 0).otherwise(1), F.regexp_extract("__t", rf"(?s)^(.*?)(?:{tally})", 1)).otherwise("")
    told = cut.filter(F.col("__x").rlike(f"^(?:{tally})")).withColumn("__head", head).withColumn("outcome", F.regexp_replace("__x", f"^(?:{tally})", ""))
    numbers = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(f"({doc})"), F.lit(1)))
    value = lambda g: F.regexp_extract("__x", f"^{tally}", g).cast("long")
    return told.select(
        page, F.struct("__b", "__k").alias("tally_no"), value(1).alias("yes"), value(2).alias("no"), numbers(F.col("__head")).alias("announced"),
        F.array_union(numbers(F.col("__head")), numbers(F.col("outcome"))).alias("docs"), "outcome",
    )


def _said(outcome: Column, words: dict[str, str], negation: str) -> Column:
    """The only outcome whose word is there and isn't negated."""
    found = F.array_compact(F.array(*[F.when(outcome.rlike(rf"(?i)\b{w}\b"), F.lit(label)) for w, label in words.items()]))
    return F.when(outcome.rlike(negation), "negated").when(F.size(found) > 1, "contradictory").when(F.size(found) == 1, found[0]).otherwise("unstated")


def official(votes: DataFrame, vote: str, page: str, yes: str, no: str, docs: str, found: DataFrame, words: dict[str, str], negation: str, tolerance: int = 3) -> DataFrame:
    """``(vote, state, outcome)`` by the tallies of the vote's page.

    A tally that was announced for other documents only is never the vote's. If
    the documents of just one tally are all the vote's, it is the vote's as long
    as both counts are within ``tolerance`` of the vote's own (a provisional
    count). Otherwise the counts must be equal, and of one tally only, among
    those identified if several are. ``state``: found, ambiguous or absent.

    Counts meet by equality of buckets as wide as the tolerance allows: a
    tally stands in its own bucket, a vote looks into the neighbours on every
    side too.
    """
    width = tolerance + 1
    bucket = lambda c: F.floor(F.col(c) / width)
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("__d")
    v = votes.select(F.col(vote).alias("__v"), F.col(page).alias("__p"), F.col(yes).alias("__yes"), F.col(no).alias("__no"), F.coalesce(docs, F.array().cast("array<string>")).alias("__docs"))
    t = found.select(F.col(page).alias("__p"), "tally_no", F.col("yes"), F.col("no"), "announced", F.col("docs").alias("__named"), "outcome")
    # identified: as many of the tally's documents as it has are the vote's
    pairs = v.select("__v", "__p", F.explode(F.array_distinct("__docs")).alias("__doc")).join(t.select("__p", "tally_no", F.size("__named").alias("__size"), F.explode("__named").alias("__doc")), ["__p", "__doc"])
    own = pairs.groupBy("__v", "__p", "tally_no", "__size").agg(F.count(F.lit(1)).alias("__hits")).filter(F.col("__hits") == F.col("__size"))
    n_own = own.groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    spread = v.select("*", around).select("__v", "__p", "__yes", "__no", "__docs", (F.floor(F.col("__yes") / width) + F.col("__d.a")).alias("__by"), (F.floor(F.col("__no") / width) + F.col("__d.b")).alias("__bn"))
    near = spread.join(t.withColumns({"__by": bucket("yes"), "__bn": bucket("no")}), ["__p", "__by", "__bn"])
    near = near.filter((F.abs(F.col("yes") - F.col("__yes")) <= tolerance) & (F.abs(F.col("no") - F.col("__no")) <= tolerance))
    near = near.filter((F.size("announced") == 0) | F.arrays_overlap("announced", "__docs"))
    near = near.join(own.select("__v", "__p", "tally_no", F.lit(True).alias("__own")), ["__v", "__p", "tally_no"], "left").join(n_own, "__v", "left")
    equal = (F.col("yes") == F.col("__yes")) & (F.col("no") == F.col("__no"))
    is_own, n = F.coalesce("__own", F.lit(False)), F.coalesce("__n", F.lit(0))
    sure, exact = is_own & (n == 1), equal & (is_own | (n <= 1))
    known = F.struct("outcome", "__named", "__docs")
    g = near.groupBy("__v").agg(F.max(F.when(sure, known)).alias("__sure"), F.count_if(exact).alias("__hits"), F.max(F.when(exact, known)).alias("__exact"))
    g = g.withColumn("__k", F.coalesce("__sure", F.when(F.col("__hits") == 1, F.col("__exact"))))
    named = F.col("__k.__named")
    foreign = (F.size(named) > 0) & (F.size(F.col("__k.__docs")) > 0) & ~F.arrays_overlap(named, F.col("__k.__docs"))
    said = F.when(F.col("__k").isNotNull(), F.when(foreign, "foreign").otherwise(_said(F.col("__k.outcome"), words, negation)))
    state = F.when(F.col("__k").isNotNull(), "found").when(F.col("__hits") > 1, "ambiguous").otherwise("absent")
    out = v.select("__v").join(g, "__v", "left")
    return out.select(F.col("__v").alias(vote), state.alias("state"), said.alias("outcome"))
