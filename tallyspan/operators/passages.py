"""Passages of wrapped texts: line breaks inside words undone by the evidence of a corpus, lists checked for their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.session import materialize

_WORD = r"[\p{L}\p{N}]+"
#: A hyphen at a line's end, between letters or digits.
_BREAK = rf"(?<=[\p{{L}}\p{{N}}])-[ \t]*\n[ \t]*(?=[\p{{L}}\p{{N}}])"


def evidence(texts: DataFrame, text: str) -> DataFrame:
    """``(kind, token, n)``: how often the texts have a word within their lines (``word``), and a word behind a hanging hyphen (``after``).

    What stands at a broken line's end or right behind it is no evidence.
    """
    clean = F.regexp_replace(text, rf"(?:{_WORD}-)*{_WORD}-[ \t]*\n[ \t]*{_WORD}(?:-{_WORD})*", "\n")
    word = F.transform(F.regexp_extract_all(clean, F.lit(rf"({_WORD}(?:-{_WORD})*)"), F.lit(1)), lambda t: F.struct(F.lit("word").alias("kind"), t.alias("token")))
    after = F.transform(F.regexp_extract_all(clean, F.lit(rf"[\p{{L}}\p{{N}}]- ({_WORD})"), F.lit(1)), lambda t: F.struct(F.lit("after").alias("kind"), t.alias("token")))
    return texts.select(F.explode(F.concat(word, after)).alias("e")).groupBy("e.kind", "e.token").agg(F.count(F.lit(1)).alias("n"))


def rejoined(texts: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """``(key, text, n_open)``: wrapped texts as running text; null while a break stays open.

    Each break could be one word (glued), a compound that keeps its hyphen, or a
    hanging hyphen before a word of its own. Whichever of the three the evidence
    has most often wins; without evidence, or with equal evidence, the break is
    open. Other line ends become spaces.
    """
    cut = materialize(texts.select(F.col(key).alias("__key"), F.split(text, _BREAK).alias("__parts")), "passage-parts")
    last, first = (lambda c: F.regexp_extract(c, rf"({_WORD}(?:-{_WORD})*)$", 1)), (lambda c: F.regexp_extract(c, rf"^({_WORD}(?:-{_WORD})*)", 1))
    pairs = F.transform(F.slice("__parts", 1, F.greatest(F.size("__parts") - 1, F.lit(0))), lambda x, i: F.struct(last(x).alias("a"), first(F.get("__parts", i + 1)).alias("b")))
    breaks = cut.filter("__parts is not null").select("__key", F.posexplode(pairs).alias("__at", "p"))
    choice = lambda joiner, kind, token: F.struct(F.lit(joiner).alias("joiner"), F.lit(kind).alias("kind"), token.alias("token"))
    ways = F.explode(F.array(choice("", "word", F.concat("p.a", "p.b")), choice("-", "word", F.concat_ws("-", "p.a", "p.b")), choice("- ", "after", F.regexp_extract("p.b", f"^({_WORD})", 1))))
    seen = breaks.select("__key", "__at", ways.alias("w")).select("__key", "__at", "w.*").join(known, ["kind", "token"], "left")
    best = seen.groupBy("__key", "__at").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "joiner")), asc=False).alias("r"))  # three rows each
    sure = F.when(F.col("r")[0]["n"] > F.coalesce(F.get("r", 1)["n"], F.lit(0)), F.col("r")[0]["joiner"])
    chosen = best.select("__key", "__at", sure.alias("joiner"))
    joins = chosen.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("__at", "joiner"))).alias("__j"), F.count_if(F.col("joiner").isNull()).alias("n_open"))
    got = cut.join(joins, "__key", "left").withColumn("n_open", F.coalesce("n_open", F.lit(0)))
    glue = F.transform("__parts", lambda x, i: F.concat(x, F.coalesce(F.get("__j", i)["joiner"], F.lit(""))))
    flat = F.trim(F.regexp_replace(F.array_join(glue, ""), r"\s*\n\s*", " "))
    return got.select(F.col("__key").alias(key), F.when(F.col("n_open") == 0, flat).alias("text"), "n_open")


def list_order(lines: Column) -> Column:
    """``kept`` or ``lost``: whether the labels at line starts, read as nested lists, follow each other.

    Labels are "1." and "a)" or "aa)". A stack holds the open lists. A label
    goes on with the innermost list of its kind, closing those within, or opens
    a list with its first value; "aa)" goes on after "z)", else it is the first
    of a list of double letters. A label that does neither is only a wrapped
    line's beginning if the line before it ends no clause; otherwise the order
    is lost.
    """
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("int").alias("value"))
    start = F.struct(F.array().cast("array<struct<kind:string,value:int>>").alias("stack"), F.lit(False).alias("lost"))
    # a variable of a lambda is computed once, a column that is used twice is computed twice
    let = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    marks = F.transform(
        lines,
        lambda line, i: F.struct(
            F.regexp_extract(line, r"^\s*(\d{1,3})\.\s", 1).alias("digits"),
            F.regexp_extract(line, r"^\s*([a-z]|([a-z])\2)\)\s", 1).alias("letters"),
            ((i == 0) | F.get(lines, i - 1).rlike(r"[.;:,!?]\s*$")).alias("closed"),
        ),
    )

    def label(stack: Column, mark: Column) -> Column:
        rank, two = F.ascii(F.substring(mark["letters"], 1, 1)) - 96, F.length(mark["letters"]) == 2
        at_z = F.exists(stack, lambda s: (s["kind"] == "letter") & (s["value"] >= 26))
        return F.when(mark["digits"] != "", entry("number", mark["digits"])).when(two & ~at_z, entry("double", rank)).otherwise(entry("letter", rank + F.when(two, 26).otherwise(0)))

    def placed(stack: Column, own: Column, lost: Column, closed: Column, place: Column) -> Column:
        follows = own["value"] == F.when(place > 0, F.get(stack, place - 1)["value"] + 1).otherwise(1)
        kept = F.slice(stack, 1, F.when(place > 0, place - 1).otherwise(F.size(stack)))
        return F.struct(F.when(follows, F.concat(kept, F.array(own))).otherwise(stack).alias("stack"), (lost | (~follows & closed)).alias("lost"))

    def step(acc: Column, mark: Column) -> Column:
        place = lambda own: F.array_position(F.transform(acc["stack"], lambda s: s["kind"]), own["kind"]).cast("int")
        return let(label(acc["stack"], mark), lambda own: let(place(own), lambda p: placed(acc["stack"], own, acc["lost"], mark["closed"], p)))

    labelled = F.filter(marks, lambda m: (m["digits"] != "") | (m["letters"] != ""))
    return F.aggregate(labelled, start, step, lambda acc: F.when(acc["lost"], "lost").otherwise("kept"))


def passages(texts: DataFrame, key: str, text: str, anchor: str, end: str, known: DataFrame | None = None) -> DataFrame:
    """``(key, state, passage)``: the operative part of each text, from its anchor to the line that ends it.

    ``not_fetched`` without a text, ``no_passage`` without the anchor,
    ``uncertain`` if the order of a list is lost, a line break stays open or the
    part doesn't end with a clause; only ``extracted`` parts are quoted.
    ``known`` is the evidence for line breaks, by default that of the texts.
    """
    known = evidence(texts, text) if known is None else known
    part = F.regexp_extract(text, rf"(?s){anchor}(.*?)(?:\n(?:{end})|\z)", 1)
    cut = texts.select(F.col(key).alias(key), F.col(text).alias("__text"), F.when(F.col(text).rlike(f"(?s){anchor}"), F.regexp_replace(part, r"^\s+|\s+$", "")).alias("__part"))
    cut = materialize(cut.withColumn("__order", list_order(F.split("__part", "\n"))), "passages")
    whole = rejoined(cut.filter(F.col("__part").isNotNull()).select(key, F.col("__part").alias("__p")), key, "__p", known)
    got = cut.join(whole, key, "left")
    certain = (F.col("__order") == "kept") & F.col("text").isNotNull() & F.col("text").rlike(r"[.;]$")
    state = F.when(F.col("__text").isNull(), "not_fetched").when(F.coalesce(F.col("__part"), F.lit("")) == "", "no_passage").when(certain, "extracted").otherwise("uncertain")
    return got.select(key, state.alias("state"), F.when(state == "extracted", F.col("text")).alias("passage"))
