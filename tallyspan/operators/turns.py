"""What a turn of an ordered record is: speech, question, answer, intervention or reply, and what it belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.scan import Machine, scan

#: A heading opens a debate or a question format; the chair may announce an intervention. A question format begins with reports.
FORMATS = Machine(
    "debate",
    {
        **{(p, "questions_open"): ("reports", ()) for p in ("debate", "asked", "announced", "intervened", "reports")},
        **{(p, "debate_open"): ("debate", ()) for p in ("debate", "asked", "announced", "intervened", "reports")},
        **{(p, "announce"): ("announced", ()) for p in ("debate", "intervened")},
        ("reports", "member"): ("asked", ()),
        ("announced", "member"): ("intervened", ()),
        ("announced", "official"): ("debate", ()),
        ("intervened", "member"): ("debate", ()),
        ("intervened", "official"): ("debate", ()),
    },
)
#: What a turn is, by the phase that it meets and who takes it; a reply is one only if the main speaker gives it.
KINDS = {
    ("reports", "official"): "report", ("reports", "member"): "question", ("asked", "member"): "question", ("asked", "official"): "answer", ("announced", "member"): "intervention",
    ("intervened", "member"): "reply?", ("intervened", "official"): "reply?", ("debate", "member"): "speech", ("debate", "official"): "speech", ("announced", "official"): "speech",
}


def classified(rows: DataFrame, unit: str, order: list[str], event: str, speaker: str, ident: str, **options: int) -> DataFrame:
    """``(unit, ident, kind, parent)`` of each turn (rows whose event is member or official).

    The parent of an intervention or reply is the last speech before it, that
    of an answer the last question. Whoever takes a turn behind an intervention
    replies if that speech was theirs; else it is a speech of its own.
    """
    got = scan(rows, unit, order, {"__phase": (event, FORMATS)}, **options)
    table = F.create_map(*[F.lit(x) for (p, e), k in KINDS.items() for x in (f"{p} {e}", k)])
    turns = got.filter(F.col(event).isin("member", "official")).withColumn("__k", F.element_at(table, F.concat_ws(" ", "__phase", event)))
    w = Window.partitionBy(unit).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # after a turn that may be a reply its speaker is the main one either way
    main = F.last(F.when(F.col("__k").isin("speech", "reply?"), F.struct(F.col(speaker).alias("s"))), ignorenulls=True).over(before)
    turns = turns.withColumn("__main", main)
    turns = turns.withColumn("kind", F.when(F.col("__k") != "reply?", F.col("__k")).when(F.col("__main.s") == F.col(speaker), "reply").otherwise("speech"))
    last = lambda kind: F.last(F.when(F.col("kind") == kind, F.col(ident)), ignorenulls=True).over(before)
    parent = F.when(F.col("kind").isin("intervention", "reply"), last("speech")).when(F.col("kind") == "answer", last("question"))
    return turns.select(unit, ident, "kind", parent.alias("parent"))


def announces(text: Column, word: str, grant: str, invite: str, refused: str, withdrawn: str, name: Column | None = None) -> Column:
    """Whether a chair's text grants what ``word`` stands for, to the one named.

    A sentence grants it if it has the word and nothing of ``refused``, and
    itself has ``grant`` or is followed by one that begins with ``invite``.
    Where a name is given it must stand, as a whole word, in the sentence or in
    the next one. A text with ``withdrawn`` grants nothing.
    """
    sentences = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+")
    near = lambda s, i: F.concat_ws(" ", s, F.get(sentences, i + 1))
    named = lambda s, i: F.lit(True) if name is None else name.isNull() | F.array_contains(F.regexp_extract_all(near(s, i), F.lit(r"([\p{L}-]+)"), F.lit(1)), name)
    ok = F.transform(sentences, lambda s, i: s.rlike(word) & ~s.rlike(refused) & (s.rlike(grant) | F.coalesce(F.get(sentences, i + 1).rlike(rf"^\W*(?:{invite})"), F.lit(False))) & named(s, i))
    return F.exists(ok, lambda x: x) & ~F.coalesce(text.rlike(withdrawn), F.lit(False))
