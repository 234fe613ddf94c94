"""Text expressions: names, headings, markup, operative parts, outcomes; all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.scalars import C, col

#: Elements that end a block, and the entities that are decoded.
BLOCKS = "p|div|h1|h2|h3|h4|h5|h6|li|ul|ol|nav|article|section|aside|header|footer|title|head|body|html|table|tr|td|th|br"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def canonical_group(x: C, known: list[str]) -> Column:
    """A known name; one written twice in a row is that name; two different ones in a row are nobody's."""
    t = col(x)
    half = F.substring(t, F.lit(1), (F.length(t) / 2).cast("int"))
    twice = (F.length(t) % 2 == 0) & (t == F.concat(half, half)) & half.isin(known)
    two = F.exists(F.array(*map(F.lit, known)), lambda a: t.startswith(a) & F.substring(t, F.length(a) + 1, F.length(t)).isin(known))
    return F.when(t.isin(known), t).when(twice, half).when(~two, t)


def strip_boilerplate(x: C, patterns: list[str]) -> Column:
    """Each pattern is removed in turn; what is left is collapsed, empty gives null."""
    out = col(x)
    for p in patterns:
        out = F.regexp_replace(out, p, "")
    return F.nullif(F.trim(F.regexp_replace(out, r"\s+", " ")), F.lit(""))


def paragraphs(html: C) -> Column:
    """The plain texts of a fragment's blocks, scripts and styles left out."""
    t = F.regexp_replace(F.regexp_replace(col(html), r"(?is)<script\b.*?</script>", ""), r"(?is)<style\b.*?</style>", "")
    t = F.regexp_replace(F.regexp_replace(t, f"(?i)</?(?:{BLOCKS})(?:[ /][^>]*)?>", "\n"), "<[^>]*>", "")
    for entity, char in ENTITIES.items():
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(t, "\n"), lambda p: F.trim(F.regexp_replace(p, r"[ \t\r]+", " "))), lambda p: p != "")


def operative_part(x: C, anchor: str, end: str) -> Column:
    """The text between the only anchor and the first end behind it (or the text's end), hyphens at line ends joined; null without exactly one anchor."""
    body = F.regexp_extract(col(x), f"(?s)(?:{anchor})(.*)$", 1)
    body = F.split(body, end, 2)[0]
    joined = F.trim(F.regexp_replace(F.regexp_replace(body, "([a-zäöüß])-\n([a-zäöüß])", "$1$2"), r"\s+", " "))
    return F.when(F.regexp_count(col(x), F.lit(anchor)) == 1, joined)


def located(x: C, pattern: str) -> Column:
    """How often a pattern stands in a text: none, unique or several."""
    n = F.regexp_count(col(x), F.lit(pattern))
    return F.when(n == 0, "none").when(n == 1, "unique").otherwise("several")


def effective_stance(stance: C, recommendation: C) -> Column:
    """What a stance means for the matter itself: a yes to a recommended rejection is a no, and the reverse."""
    flip = F.when(col(stance) == "yes", "no").when(col(stance) == "no", "yes").otherwise(col(stance))
    return F.when(col(recommendation) == "reject", flip).when(col(recommendation) == "accept", col(stance))


def genitive(x: C) -> Column:
    """A name with its genitive s; an apostrophe after s, ß, x and z."""
    return F.when(col(x).rlike("[sßxz]$"), F.concat(col(x), F.lit("’"))).otherwise(F.concat(col(x), F.lit("s")))


def ranked_fallback(*candidates: tuple[str, Column], otherwise: str = "untagged") -> tuple[Column, Column]:
    """``(value, source)`` of the first candidate that is there."""
    value = F.coalesce(*[c for _, c in candidates])
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in candidates], F.lit(otherwise))
    return value, source


def chunks(rows: DataFrame, key: str, text: str, limit: int = 900) -> DataFrame:
    """``(key, chunk, n_lines, n_chars)``: consecutive lines in chunks of about ``limit`` characters."""
    lines = rows.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    before = F.coalesce(F.sum(F.length("line")).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.withColumn("chunk", F.floor(before / limit).cast("bigint"))
    return marked.groupBy(key, "chunk").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def only_outcome(x: C, outcomes: dict[str, str], negation: str) -> Column:
    """The outcome whose word stands in the text, if it is the only one and nothing negates; else null."""
    found = F.array_distinct(F.filter(F.array(*[F.when(col(x).rlike(p), F.lit(name)) for name, p in outcomes.items()]), lambda v: v.isNotNull()))
    return F.when((F.size(found) == 1) & ~col(x).rlike(negation), found[0])
