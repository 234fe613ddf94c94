"""Evidence-ranked linking of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.scalars import long_words, normal_title, titles_match


def ranked_links(items: DataFrame, votes: DataFrame, item_id: str, vote_id: str, scope: str, evidence: list[tuple[str, str, str]], title: tuple[str, str] | None = None) -> DataFrame:
    """``(scope, vote, item, basis)``: the strongest shared evidence of each pair in a scope.

    ``evidence`` lists (basis, item array column, vote array column), strongest
    first; pairs sharing an element are linked. Votes left without a link take
    the only item of their scope whose title matches, if ``title`` names the
    two title columns.
    """
    found = None
    for rank, (basis, a, b) in enumerate(evidence):
        x = items.select(scope, item_id, F.explode(F.array_distinct(a)).alias("n"))
        y = votes.select(scope, vote_id, F.explode(F.array_distinct(b)).alias("n"))
        hit = x.join(y, [scope, "n"]).select(scope, vote_id, item_id, F.lit(rank).alias("rank"), F.lit(basis).alias("basis")).distinct()
        found = hit if found is None else found.unionByName(hit)
    best = found.groupBy(scope, vote_id, item_id).agg(F.min_by("basis", "rank").alias("basis"))
    if title:
        rest = votes.join(best, [scope, vote_id], "left_anti").select(scope, vote_id, normal_title(title[1]).alias("t"))
        # items of one heading count together, and titles are matched once each
        heads = items.groupBy(scope, normal_title(title[0]).alias("h")).agg(F.count_distinct(item_id).alias("n"), F.min(item_id).alias(item_id))
        pairs = matching_titles(heads.select(scope, "h"), rest.select(scope, "t").distinct(), scope)
        near = rest.join(pairs, [scope, "t"]).join(heads, [scope, "h"])
        one = near.groupBy(scope, vote_id).agg(F.sum("n").alias("n"), F.min(item_id).alias(item_id)).filter("n = 1")
        best = best.unionByName(one.select(scope, vote_id, item_id, F.lit("title").alias("basis")))
    return best


def _grams(x: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The different pieces of a text of each size."""
    of = lambda n: F.when(F.length(x) >= n, F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substring(x, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*map(of, sizes)))


def _held(long: DataFrame, short: DataFrame, scope: str, a: str, b: str) -> DataFrame:
    """Pairs that may hold: long texts of a scope that have the rarest piece of a short one."""
    pieces = long.select(scope, a, F.explode(_grams(F.col(a))).alias("g"))
    count = pieces.groupBy(scope, "g").agg(F.count(F.lit(1)).alias("n"))
    whole = F.when(F.length(b) >= 3, _grams(F.col(b), (3,))).otherwise(F.array(F.col(b)))
    need = short.select(scope, b, F.explode(whole).alias("g")).join(count, [scope, "g"], "left")
    # a piece that no long text has rules the short one out
    rarest = need.groupBy(scope, b).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("m")).filter("m.n > 0")
    return rarest.select(scope, b, F.col("m.g").alias("g")).join(pieces, [scope, "g"]).select(scope, a, b)


def matching_titles(heads: DataFrame, titles: DataFrame, scope: str, share: float = 0.65) -> DataFrame:
    """``(scope, h, t)``: the pairs of different normalised headings and titles of a scope that ``titles_match``.

    A text within another shows the rarest of its pieces there. A heading with
    the share of a title's long words has one of the title's rarest, as many as
    may be missing and one more. So only pairs that share something rare are
    compared, and no matching pair is left out.
    """
    heads, titles = heads.filter("h <> ''").distinct(), titles.filter("t <> ''").distinct()
    words = heads.select(scope, "h", F.explode(long_words(F.col("h"))).alias("w"))
    count = words.groupBy(scope, "w").agg(F.count(F.lit(1)).alias("n"))
    own = titles.select(scope, "t", F.size(long_words(F.col("t"))).alias("k"), F.explode(long_words(F.col("t"))).alias("w")).join(count, [scope, "w"], "left")
    rare = Window.partitionBy(scope, "t").orderBy(F.coalesce("n", F.lit(0)), "w")
    own = own.withColumn("r", F.row_number().over(rare)).filter(F.col("r") <= F.col("k") - F.ceil(share * F.col("k") - 1e-9) + 1)
    shared = own.select(scope, "t", "w").join(words, [scope, "w"]).select(scope, "h", "t")
    maybe = _held(heads, titles, scope, "h", "t").unionByName(_held(titles, heads, scope, "t", "h")).unionByName(shared).distinct()
    return maybe.filter(titles_match(F.col("h"), F.col("t"), share))


def lead_positions(positions: DataFrame, item: str, title: str, order: list[str]) -> DataFrame:
    """``(item, title)``: the title of each item's first position that has one; blank titles are none."""
    named = positions.filter(F.trim(F.coalesce(title, F.lit(""))) != "")
    return named.groupBy(item).agg(F.min_by(title, F.struct(*order)).alias(title))


def single_subject(positions: DataFrame, item: str, subject: str, minor: str) -> DataFrame:
    """``(item, subject)`` of the items that are about one subject only; minor positions count only where an item has no other."""
    main = F.coalesce(~F.col(minor), F.lit(True))
    each = positions.filter(F.col(subject).isNotNull()).groupBy(item).agg(
        F.count_distinct(F.when(main, F.col(subject))).alias("__main"), F.count_distinct(subject).alias("__all"), F.min(F.when(main, F.col(subject))).alias("__m"), F.min(subject).alias("__s")
    )
    return each.filter("__main = 1 or (__main = 0 and __all = 1)").select(item, F.coalesce("__m", "__s").alias(subject))


def subset_links(left: DataFrame, right: DataFrame, left_id: str, right_id: str, scope: str, tokens: str) -> DataFrame:
    """Pairs of a scope where the left set lies within the right one and within no rival: the only container links.

    A container must hold the left set's rarest token of the scope, so only
    the right sets with that token are compared.
    """
    x = left.select(scope, F.col(left_id).alias("l"), F.array_distinct(tokens).alias("a")).filter(F.size("a") > 0)
    held = right.select(scope, F.col(right_id).alias("r"), F.array_distinct(tokens).alias("b")).withColumn("token", F.explode("b"))
    often = held.groupBy(scope, "token").agg(F.count(F.lit(1)).alias("often"))
    each = x.withColumn("token", F.explode("a")).join(often, [scope, "token"], "left")
    rare = each.groupBy(scope, "l", "a").agg(F.min_by("token", F.struct(F.coalesce("often", F.lit(0)), "token")).alias("token"))
    hit = rare.join(held, [scope, "token"]).filter(F.size(F.array_except("a", "b")) == 0)
    return hit.groupBy(scope, "l").agg(F.count_distinct("r").alias("n"), F.min("r").alias("r")).filter("n = 1").select(scope, "l", "r")


def tally_links(left: DataFrame, right: DataFrame, left_id: str, right_id: str, scope: str, measures: list[str], tolerance: int = 0) -> DataFrame:
    """The only right row of a scope whose counts are within ``tolerance``; a null count matches any.

    Which counts are null is a pattern of one bit for each. Rows of two
    patterns meet by equality on the counts that both have (on buckets of
    ``tolerance`` + 1 and their neighbours if it is not 0), so a large scope is
    no large group; the right rows of a key with equal counts are one row of
    their least and greatest id first.
    """
    width, patterns = tolerance + 1, range(1 << len(measures))
    pattern = sum(F.when(F.col(m).isNull(), 1 << i).otherwise(0) for i, m in enumerate(measures))
    bucket = lambda m: F.floor(F.col(m) / width)
    steps = (-1, 0, 1) if tolerance else (0,)

    def keyed(rows: DataFrame, own: str, other: str, spread: tuple[int, ...]) -> DataFrame:
        out = rows.withColumn(own, pattern).withColumn(other, F.explode(F.array(*[F.lit(p) for p in patterns])))
        for i, m in enumerate(measures):
            free = (F.col(own).bitwiseOR(F.col(other)).bitwiseAND(1 << i)) != 0
            near = F.array(*[bucket(m) + s for s in spread])
            out = out.withColumn(f"__k{i}", F.explode(F.when(free, F.array(F.lit(-1).cast("bigint"))).otherwise(near)))
        return out

    keys = [scope, "__p", "__q", *[f"__k{i}" for i in range(len(measures))]]
    x = keyed(left.select(scope, F.col(left_id).alias("l"), *measures), "__p", "__q", steps)
    x = x.select(*keys, "l", *[F.col(m).alias(f"l_{m}") for m in measures])
    y = keyed(right.select(scope, F.col(right_id).alias("r"), *measures), "__q", "__p", (0,))
    y = y.groupBy(*keys, *[F.col(m).alias(f"r_{m}") for m in measures]).agg(F.min("r").alias("low"), F.max("r").alias("high"))
    near = F.lit(True)
    for m in measures:
        near = near & (F.col(f"l_{m}").isNull() | F.col(f"r_{m}").isNull() | (F.abs(F.col(f"l_{m}") - F.col(f"r_{m}")) <= tolerance))
    hit = x.join(y, keys).filter(near).groupBy(scope, "l").agg(F.min("low").alias("r"), F.max("high").alias("high"))
    return hit.filter("r = high").select(scope, "l", "r")


def unique_match(left: DataFrame, right: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    """``left`` with the value of the right rows of the same key if they agree on one; null where they differ or are missing."""
    one = right.groupBy(*keys).agg(F.count_distinct(value).alias("__n"), F.min(value).alias("__v"))
    joined = left.join(one, keys, "left")
    return joined.withColumn(alias or value, F.when(F.col("__n") == 1, F.col("__v"))).drop("__n", "__v")


def first_owner(links: DataFrame, item: str, owner: str, order: list[Column]) -> DataFrame:
    """The first owner of each item in a total order."""
    return links.groupBy(item).agg(F.min_by(owner, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias(owner))


def extremes(rows: DataFrame, keys: list, value: str) -> DataFrame:
    """``(keys, value)``: the least and the greatest value of each key, one row if they are the same.

    Enough to tell whether a key has one value or several, so that a join on
    keys with many values makes at most two rows for each row of the other side.
    """
    g = rows.groupBy(*keys).agg(F.min(value).alias("__least"), F.max(value).alias("__most"))
    return g.withColumn(value, F.explode(F.array_distinct(F.array("__least", "__most")))).drop("__least", "__most")


def cascade(rows: DataFrame, key: str, candidates: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """The value of the first source that gives exactly one, and which source it was."""
    out = rows
    picks, names = [], []
    for name, df in candidates:
        one = df.groupBy(key).agg(F.min(value).alias(f"__{name}"), F.max(value).alias("__most")).filter(F.col(f"__{name}") == F.col("__most")).drop("__most")
        out = out.join(one, key, "left")
        picks.append(F.col(f"__{name}"))
        names.append(F.when(F.col(f"__{name}").isNotNull(), F.lit(name)))
    return out.withColumn(value, F.coalesce(*picks)).withColumn("source", F.coalesce(*names)).drop(*[f"__{n}" for n, _ in candidates])


def rare_token_rivals(items: DataFrame, ident: str, tokens: str, least: int, most: int) -> DataFrame:
    """``(ident, rival, rivals)``: items that share a token which ``least`` to ``most`` items have; ``rival`` is the lowest."""
    each = items.select(ident, F.explode(tokens).alias("token"))
    few = each.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(least, most)).select("token")
    hit = each.join(few, "token")
    pair = hit.join(hit.select("token", F.col(ident).alias("rival")), "token").filter(F.col(ident) != F.col("rival"))
    return pair.groupBy(ident).agg(F.min("rival").alias("rival"), F.count_distinct("rival").alias("rivals"))
