"""Who has the floor: a unit of ordered rows segmented by speaker, each nested turn with the ruling that it was allowed under.

Rows carry an event. The chair may ask for a question (``offer``, with or
without names), give the floor (``invite``) or say something else (``chair``);
the holder may agree (``consent``), decline (``refusal``), allow after all
(``renewal``) or speak on (``own``); a marker opens another speaker's turn
(``turn``), the holder's (``resume``) or one that names nobody (``lost``);
``text`` belongs to the last marker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.scan import Machine, scan

#: What the events do to the floor. An offer while one is open adds to it; one after a refusal needs consent of its own.
FLOOR = Machine(
    "idle",
    {
        ("idle", "offer"): ("offered", ("exchange",)),
        ("invited", "offer"): ("offered", ("exchange",)),
        ("granted", "offer"): ("offered", ("exchange",)),
        ("refused", "offer"): ("reoffered", ("exchange",)),
        ("idle", "invite"): ("invited", ()),
        ("offered", "consent"): ("granted", ()),
        ("reoffered", "consent"): ("granted", ()),
        ("offered", "renewal"): ("granted", ()),
        ("reoffered", "renewal"): ("granted", ()),
        ("refused", "renewal"): ("granted", ()),
        ("offered", "refusal"): ("refused", ("epoch",)),
        ("reoffered", "refusal"): ("refused", ("epoch",)),
        ("granted", "refusal"): ("refused", ("epoch",)),
        ("invited", "turn"): ("idle", ()),
        ("invited", "resume"): ("idle", ()),
    },
)
#: Whose words ``text`` rows are, and the ordinal of the marker above them.
WHO = Machine("holder", {(a, e): (to, ("marker",)) for a in ("holder", "other", "unknown") for e, to in (("turn", "other"), ("resume", "holder"), ("lost", "unknown"))})
RULINGS = {"idle": "unasked", "invited": "chair_floor", "offered": "unanswered", "refused": "refused", "reoffered": "refused"}
CHAIR, HOLDER, MARKERS = ("offer", "invite", "chair"), ("own", "consent", "refusal", "renewal"), ("turn", "resume", "lost")


def followed(rows: DataFrame, unit: str, order: list[str], event: str, **options: int) -> DataFrame:
    """``rows`` with ``floor`` (before the row), ``who``, ``exchange``, ``epoch`` and ``marker``."""
    return scan(rows, unit, order, {"floor": (event, FLOOR), "who": (event, WHO)}, **options)


def turn_rulings(rows: DataFrame, unit: str, order: list[str], event: str, speaker: str, names: str) -> DataFrame:
    """``(unit, marker, speaker, exchange, epoch, ruling)`` of each nested turn of ``followed`` rows.

    A granted turn is ``authorized`` if its exchange named nobody and it is the
    first, or if it is the first of a named speaker; ``continued`` if that
    speaker's turn was authorized before in the exchange; a
    ``recipient_mismatch`` while a named speaker has not spoken yet, and
    ``spent`` when all have (or, without names, when someone has).
    """
    asked = rows.filter(F.col(event) == "offer").groupBy(unit, "exchange").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce(names, F.array().cast("array<string>"))))).alias("__names"))
    turns = rows.filter(F.col(event) == "turn")
    g = asked.select(F.col(unit).alias("__u"), F.col("exchange").alias("__x"), "__names")
    turns = turns.join(g, F.col(unit).eqNullSafe(F.col("__u")) & (F.col("exchange") == F.col("__x")), "left").drop("__u", "__x")
    granted = F.col("floor") == "granted"
    w = Window.partitionBy(unit, "exchange", "epoch", F.col("floor")).orderBy("marker")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.size("__names") == 0
    named = F.array_contains("__names", F.col(speaker))
    taken = F.array_distinct(F.collect_list(F.when(named, F.col(speaker))).over(before))
    first = F.first(speaker).over(w.rowsBetween(Window.unboundedPreceding, 0))
    turns = turns.withColumns({"__open": open_, "__named": named, "__taken": taken, "__first": first, "__no": F.row_number().over(w)})
    ruling = (
        F.when(~granted, F.element_at(F.create_map(*[F.lit(x) for kv in RULINGS.items() for x in kv]), F.col("floor")))
        .when(F.col("__open") & (F.col("__no") == 1), "authorized")
        .when(F.col("__open"), F.when(F.col(speaker).eqNullSafe(F.col("__first")), "continued").otherwise("spent"))
        .when(F.col("__named") & ~F.array_contains("__taken", F.col(speaker)), "authorized")
        .when(F.col("__named"), "continued")
        .when(F.size("__taken") == F.size("__names"), "spent")
        .otherwise("recipient_mismatch")
    )
    return turns.select(unit, "marker", speaker, "exchange", "epoch", ruling.alias("ruling"))


def segments(rows: DataFrame, unit: str, event: str, speaker: str, text: str, rulings: DataFrame) -> DataFrame:
    """``(unit, marker, voice, speaker, ruling, n_rows, n_chars)``: the words of each voice under each marker.

    Voices are holder, chair, other and unattributed; rows that are markers
    hold no words. Characters are conserved: they add up to those of the unit.
    """
    voice = (
        F.when(F.col(event).isin(*CHAIR), "chair")
        .when(F.col(event).isin(*HOLDER), "holder")
        .when(F.col(event) == "text", F.when(F.col("who") == "unknown", "unattributed").otherwise(F.col("who")))
    )
    spoken = rows.withColumn("voice", voice).filter("voice is not null")
    got = spoken.groupBy(unit, "marker", "voice").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.coalesce(F.length(text), F.lit(0))).cast("long").alias("n_chars"))
    r = rulings.select(F.col(unit).alias("__u"), F.col("marker").alias("__m"), F.col(speaker).alias("speaker"), "ruling")
    own = F.col(unit).eqNullSafe(F.col("__u")) & (F.col("marker") == F.col("__m")) & (F.col("voice") == "other")
    return got.join(r, own, "left").select(unit, "marker", "voice", "speaker", "ruling", "n_rows", "n_chars")
