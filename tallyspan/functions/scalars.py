"""Scalar expressions: normalisation, keys, predicates and formats, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse(x: C) -> Column:
    """White space and no-break spaces to single spaces, trimmed; empty gives null."""
    return F.nullif(F.trim(F.regexp_replace(col(x), r"[\s ]+", " ")), F.lit(""))


def number_sort_key(x: C) -> Column:
    """Total order of ``term/number`` texts: numeric if well formed, others behind by text."""
    t = F.trim(F.coalesce(col(x), F.lit("")))
    ok = t.rlike("^[0-9]+/[0-9]+$")
    part = lambda i: F.when(ok, F.split_part(t, F.lit("/"), F.lit(i)).try_cast("bigint")).otherwise(0)
    return F.struct(F.when(ok, 0).otherwise(1).alias("bad"), part(1).alias("term"), part(2).alias("number"), t.alias("text"))


def malformed_number(x: C) -> Column:
    """0 for ``term/number``, 1 otherwise."""
    return F.when(col(x).rlike("^[0-9]+/[0-9]+$"), 0).otherwise(1)


def id_sort_key(x: C) -> Column:
    """Digits numerically before other texts."""
    t = col(x).cast("string")
    ok = t.rlike("^[0-9]+$")
    return F.struct(F.when(ok, 0).otherwise(1).alias("kind"), F.when(ok, t.try_cast("decimal(38,0)")).alias("n"), t.alias("t"))


def group_attribution(role: C, label: C, fallback: C) -> Column:
    """The group a speech counts for: none for a role, else its label, else the fallback."""
    return F.when(col(role).isNotNull(), F.lit(None)).otherwise(F.coalesce(F.nullif(col(label), F.lit("")), col(fallback)))


def margin(yes: C, no: C) -> Column:
    """|yes - no| / (yes + no); null where a count is null or nothing was cast."""
    return F.when(col(yes) + col(no) > 0, F.abs(col(yes) - col(no)) / (col(yes) + col(no)))


def clock_minutes(start: C, end: C) -> Column:
    """Minutes from one H:MM clock time to another, past midnight if needed; null unless both are clock times."""

    def minutes(x: C) -> Column:
        h, m = F.split_part(col(x), F.lit(":"), F.lit(1)).try_cast("int"), F.split_part(col(x), F.lit(":"), F.lit(2)).try_cast("int")
        return F.when(col(x).rlike(r"^.+:..$"), h * 60 + m)

    return F.pmod(minutes(end) - minutes(start) + 1440, F.lit(1440))


def plausible_number(number: C, term: C) -> Column:
    """Whether a document number's prefix is the term or the one before; an unknown term filters nothing."""
    prefix = F.split_part(col(number), F.lit("/"), F.lit(1)).try_cast("int")
    return F.coalesce((prefix == col(term)) | (prefix == col(term) - 1), col(term).isNull())


def allowed_host(url: C, hosts: list[str]) -> Column:
    """https and a host of the list, without user, port, query or fragment; a null address passes."""
    plain = col(url).rlike(r"^https://[^/@:?#]+(/[^?#]*)?$")
    return F.coalesce(plain & F.lower(F.regexp_extract(col(url), "^https://([^/?#:]+)", 1)).isin(hosts), col(url).isNull())


def canonical_document(number: C, issuer: C) -> Column:
    """White space collapsed; federal numbers without leading zeros; blank gives null."""
    t = collapse(number)
    bare = F.regexp_replace(t, r"^0*([0-9]+)/0*([0-9]+)$", "$1/$2")
    return F.when((col(issuer) == "BT") & t.rlike("^[0-9]+/[0-9]+$"), bare).otherwise(t)


def document_issuer(publisher: C, url: C) -> Column:
    """BT or BR: the publisher decides, else the path of the address, else BT."""
    p = F.upper(F.trim(F.coalesce(col(publisher), F.lit(""))))
    return F.when(p.isin("BT", "BR"), p).when(F.coalesce(F.regexp_extract(col(url), "^[a-z]+://[^/]+(/brd/)", 1), F.lit("")) != "", "BR").otherwise("BT")


def normal_title(x: C) -> Column:
    """Lower case, everything but letters a-z, German umlauts and digits to single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(x), F.lit(""))), "[^a-zäöüß0-9]+", " "))


def long_words(title: C, least: int = 5) -> Column:
    """Distinct words of a normalised title with at least ``least`` letters."""
    return F.array_distinct(F.filter(F.split(col(title), " "), lambda w: F.length(w) >= least))


def titles_match(heading: Column, title: Column, share: float = 0.65) -> Column:
    """Containment either way, or at least ``share`` of the title's long words in the heading."""
    h, t = normal_title(heading), normal_title(title)
    words = long_words(t)
    enough = (F.size(words) > 0) & (F.size(F.array_intersect(words, long_words(h))) >= share * F.size(words) - 1e-9)
    return (h != "") & (t != "") & (F.contains(h, t) | F.contains(t, h) | enough)


def word_key(x: C) -> Column:
    """Order-insensitive name key: distinct lower-case words, sorted."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.lower(col(x)), r"[\s ,]+"), lambda w: w != ""))), " ")


def undouble(x: C) -> Column:
    """Words written twice in one ('abab' -> 'ab')."""

    def half(w: Column) -> Column:
        n = F.length(w)
        left, right = F.substring(w, F.lit(1), (n / 2).cast("int")), F.substring(w, (n / 2).cast("int") + 1, n)
        return F.when((n > 1) & (n % 2 == 0) & (left == right), left).otherwise(w)

    return F.array_join(F.transform(F.split(col(x), " "), half), " ")


def content_key(namespace: str, *parts: C, version: int = 1) -> Column:
    """``ns-v1-<sha256>`` over the JSON array [version, ns, [parts]]: the same for equal content everywhere."""

    def quoted(x: C) -> Column:
        t = F.regexp_replace(F.regexp_replace(col(x).cast("string"), r"\\", r"\\\\\\\\"), '"', r'\\\\"')
        return F.coalesce(F.concat(F.lit('"'), F.replace(t, F.lit("\n"), F.lit("\\n")), F.lit('"')), F.lit("null"))

    body = F.concat(F.lit(f'[{version},"{namespace}",['), F.concat_ws(",", *map(quoted, parts)), F.lit("]]"))
    return F.concat(F.lit(f"{namespace}-v{version}-"), F.sha2(body, 256))


def iso_week(x: C) -> Column:
    """``YYYY-Www`` of the ISO week."""
    return F.format_string("%04d-W%02d", F.year(F.date_add(F.date_trunc("week", col(x)).cast("date"), 3)), F.weekofyear(col(x)))


def floor_percent(x: C) -> Column:
    """Whole percent, never rounded up."""
    return F.floor(col(x) * 100 + 1e-9).cast("int")


def fold(x: C) -> Column:
    """Lower case without accents, sharp s as ss: what search words are compared in."""
    return F.replace(F.translate(F.lower(col(x)), "àáâäãåçèéêëìíîïñòóôöõùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"), F.lit("ß"), F.lit("ss"))


def search_match(query: C, *fields: C) -> Column:
    """Every word of the query occurs in one of the fields, folded."""
    words = F.filter(F.split(fold(query), r"\s+"), lambda w: w != "")
    text = F.concat_ws("\n", *map(fold, fields))
    return F.forall(words, lambda w: F.contains(text, w))


def counts_or_null(*measures: C) -> list[Column]:
    """Measures with four zeros read as 'none given': all null then."""
    cols = [col(m) for m in measures]
    zero = cols[0] == 0
    for c in cols[1:]:
        zero = zero & (c == 0)
    return [F.when(~zero | zero.isNull(), c) for c in cols]


def first_match(x: C, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first rule whose pattern is found."""
    (pattern, value), *rest = rules
    out = F.when(col(x).rlike(pattern), value)
    for pattern, value in rest:
        out = out.when(col(x).rlike(pattern), value)
    return out.otherwise(F.lit(default))


def teaser(x: C, limit: int = 300) -> Column:
    """Up to the last sentence end within ``limit`` characters (single letters and digits before the point don't end one); all of a shorter text, else cut at a word with an ellipsis."""
    t = F.trim(col(x))
    head = F.regexp_extract(F.substring(t, 1, limit), r"(?s)^(.*[^\s.0-9A-ZÄÖÜ][.!?])(?=\s|$)", 1)
    words = F.concat(F.regexp_replace(F.substring(t, 1, limit - 1), r"\s+\S*$", ""), F.lit("…"))
    return F.when(F.length(t) <= limit, t).when(head != "", head).otherwise(words)


def join_list(items: C, last: str = " und ") -> Column:
    """'a, b und c'."""
    a = col(items)
    n = F.size(a)
    return F.when(n <= 1, F.array_join(a, "")).otherwise(F.concat(F.array_join(F.slice(a, F.lit(1), n - 1), ", "), F.lit(last), F.element_at(a, -1)))


def german_number(x: C) -> Column:
    """Thousands with a dot."""
    return F.translate(F.format_number(col(x), 0), ",", ".")


def signed(x: C) -> Column:
    """A difference with its sign, +-0 as 0."""
    return F.when(col(x) > 0, F.concat(F.lit("+"), col(x).cast("string"))).otherwise(col(x).cast("string"))


def version_key(x: C) -> Column:
    """major.minor.patch as numbers."""
    part = lambda i: F.coalesce(F.split_part(col(x), F.lit("."), F.lit(i)).try_cast("int"), F.lit(0))
    return F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch"))


def word_count(x: C) -> Column:
    return F.size(F.regexp_extract_all(col(x), F.lit(r"\S+"), F.lit(0)))
