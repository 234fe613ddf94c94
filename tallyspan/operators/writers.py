"""From parsed units to rows of the store: documents with their place, speakers with their key, roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def document_links(refs: DataFrame, item: str, doc: str, source: str, order: list[str], url: str, last_url: tuple[str, ...]) -> DataFrame:
    """``(item, doc, source, url, rank)``: one row for each document of an item and source.

    The rank counts the first occurrences in the source's own order. A document
    listed again keeps its place; its address is the last known one for the
    sources in ``last_url`` and the first known one for the others.
    """
    known = F.when(F.col(url).isNotNull(), F.struct(*order, F.col(url).alias("__u")))
    g = refs.filter(F.col(doc).isNotNull()).groupBy(item, doc, source).agg(F.min(F.struct(*order)).alias("__first"), F.min(known).alias("__a"), F.max(known).alias("__z"))
    place = F.row_number().over(Window.partitionBy(item, source).orderBy("__first", doc))
    return g.select(item, doc, source, F.when(F.col(source).isin(*last_url), F.col("__z.__u")).otherwise(F.col("__a.__u")).alias(url), place.alias("rank"))


def resolve_speakers(units: DataFrame, corrections: DataFrame, unit: str, fields: list[str], group: Column, keys: list[tuple[str, Column]]) -> DataFrame:
    """``units`` with corrected ``fields``, ``speaker_group`` and ``speaker_key``.

    A reviewed correction of a unit overrides the fields that it names; the
    group is then read from the corrected fields, and the key is the first of
    ``keys`` (prefix, value) that is known.
    """
    fixed = corrections.select(unit, *[F.col(f).alias(f"__{f}") for f in fields])
    out = units.join(fixed, unit, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"__{f}", f)).drop(f"__{f}")
    named = [F.concat(F.lit(f"{prefix}:"), value.cast("string")) for prefix, value in keys]
    return out.withColumn("speaker_group", group).withColumn("speaker_key", F.coalesce(*named))


def effective_roles(rows: DataFrame, long: str, short: str, printed: str, group: str, side: dict[str, str]) -> DataFrame:
    """``rows`` with ``role``, ``speaker_class`` and ``role_conflict``.

    A printed role counts only if it has a side; where it and the structured
    role have different sides, the row is a conflict without a role. Whoever has
    a role is an official, with a group and no role a member, else unplaced.
    """
    table = F.create_map(*[F.lit(x) for kv in side.items() for x in kv])
    of = lambda c: F.element_at(table, F.lower(c))
    structured = F.coalesce(F.nullif(F.trim(long), F.lit("")), F.nullif(F.trim(short), F.lit("")))
    seen = F.when(of(F.trim(printed)).isNotNull(), F.trim(printed))
    conflict = F.coalesce(of(structured) != of(seen), F.lit(False))
    out = rows.withColumn("role_conflict", conflict).withColumn("role", F.when(~conflict, F.coalesce(structured, seen)))
    placed = F.when(F.coalesce(structured, seen).isNotNull(), "official").when(F.trim(F.coalesce(group, F.lit(""))) != "", "member")
    return out.withColumn("speaker_class", placed)


def settled(rows: DataFrame, key: str, order: list[str], first: tuple[str, ...] = (), last: tuple[str, ...] = (), newest: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key from all its sightings in order.

    Columns in ``first`` keep the first known value, those in ``last`` take the
    last known one, and those in ``newest`` are the last sighting's, null or
    not. Rows without a key are none. Sums of this kind combine before the
    shuffle, so a key that is seen everywhere is no hot one.
    """
    place = F.struct(*order)
    known = lambda c: F.when(F.col(c).isNotNull(), place)
    values = [F.min_by(c, known(c)).alias(c) for c in first] + [F.max_by(c, known(c)).alias(c) for c in last]
    got = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*values, F.max(F.struct(*order, *[F.col(c).alias(f"__{c}") for c in newest])).alias("__z"))
    return got.select(key, *first, *last, *[F.col(f"__z.__{c}").alias(c) for c in newest])


def spoken_units(reports: DataFrame, sitting: str, items: str, units: str, sequence: str, given: str) -> DataFrame:
    """``(sitting, item_no, sequence, unit_id, <fields of the unit>)``: the units in the items of nested reports.

    A unit's place is the number that its report gives it (which neighbours that
    were left out don't shift), else its position in the item. Its id is the one
    given, else made from item and place; ids hold within their sitting.
    """
    each = reports.select(sitting, F.posexplode(items).alias("__i", "__item"))
    flat = each.select(sitting, (F.col("__i") + 1).alias("item_no"), F.posexplode(F.col(f"__item.{units}")).alias("__p", "__u"))
    fields = [f for f in flat.schema["__u"].dataType.names if f not in (sequence, given)]
    place = F.coalesce(F.col(f"__u.{sequence}").cast("int"), F.col("__p") + 1)
    made = F.concat(F.lit("item-"), F.col("item_no").cast("string"), F.lit("-"), place.cast("string"))
    ident = F.concat(F.col(sitting).cast("string"), F.lit("#"), F.coalesce(F.nullif(F.trim(F.col(f"__u.{given}")), F.lit("")), made))
    return flat.select(sitting, "item_no", place.alias("sequence"), ident.alias("unit_id"), *[F.col(f"__u.{f}").alias(f) for f in fields])


def contribution_speakers(units: DataFrame, kind: str, kinds: tuple[str, ...], number: str, name: str, group: str, sideless: tuple[str, ...]) -> DataFrame:
    """``units`` with ``speaker_key``, ``speaker_name``, ``speaker_group`` and ``refused``.

    Only who has a number is keyed; others keep the name that was announced,
    and neither key nor group. Kinds in ``sideless`` have no group. A kind that
    isn't known is ``refused``.
    """
    known = F.col(number).isNotNull()
    clean = F.nullif(F.trim(name), F.lit(""))
    return units.withColumns(
        {
            "refused": ~F.coalesce(F.col(kind).isin(*kinds), F.lit(False)),
            "speaker_key": F.when(known, F.concat(F.lit("no:"), F.col(number).cast("string"))),
            "speaker_name": clean,
            "speaker_group": F.when(known & ~F.coalesce(F.col(kind).isin(*sideless), F.lit(False)), F.col(group)),
        }
    )


def ranked_answers(owners: DataFrame, answers: DataFrame, owner: str, value: str, order: list[str], asked: Column) -> tuple[DataFrame, DataFrame]:
    """``((owner, value, rank), (owner, state, n))``: what is written for tags, contexts and passages.

    Each owner's different values are ranked by their first place. Every owner
    has a state: ``answered``, ``none`` if it was asked without a value, or
    ``not_asked``; so an owner without rows is never a gap.
    """
    first = answers.filter(F.col(value).isNotNull()).groupBy(owner, value).agg(F.min(F.struct(*order)).alias("__at"))
    first = first.join(owners.select(owner).distinct(), owner, "left_semi")
    ranked = first.select(owner, value, F.row_number().over(Window.partitionBy(owner).orderBy("__at", value)).alias("rank"))
    count = ranked.groupBy(owner).agg(F.count(F.lit(1)).alias("n"))
    state = F.when(F.col("n").isNotNull(), "answered").when(F.coalesce(asked, F.lit(False)), "none").otherwise("not_asked")
    return ranked, owners.join(count, owner, "left").select(owner, state.alias("state"), F.coalesce("n", F.lit(0)).alias("n"))
