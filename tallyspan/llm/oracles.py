"""The parts of the corpus operators that SQL determines, as queries with their DuckDB SQL.

``op8_embedding_near_dedup`` is determined whole. Of PII detection, language
models and license scans the base columns are: their queries here take them
from the same operators as the full queries do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import license as license_scan
from tallyspan.llm import lm, pii
from tallyspan.llm.common import fold
from tallyspan.tables import table


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans of every text: counts and digest."""
    found = pii.found(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[n(k) for k in pii.KINDS], F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"))


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact unigram scores, to four decimals."""
    found = lm.score(table(spark, sf_dir, "documents"), fold() != 1, base_only=True)
    return found.select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def license_base_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and the places of the base phrases."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"))


_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(try_cast(nullif(ltrim(p, '0'), '') as int), 0) > 255)) = 0",
    "card": (
        "length(regexp_replace(m, '[^0-9]', '', 'g')) <= 19 and length(regexp_replace(m, '[^0-9]', '', 'g')) >= 16 and "
        "list_sum(list_transform(range(1, length(regexp_replace(m, '[^0-9]', '', 'g')) + 1), lambda i: "
        "case when i % 2 = 1 then cast(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) as int) "
        "else cast(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) as int) * 2 "
        "- case when cast(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) as int) > 4 then 9 else 0 end end)) % 10 = 0"
    ),
    "phone": "length(regexp_replace(m, '[^0-9]', '', 'g')) between 8 and 15",
}
_REGEX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}


def _pii_sql() -> str:
    """Matches of each kind with the gaps before them; a start is all gaps and matches up to it."""
    parts = []
    for n, (kind, pattern) in enumerate(_REGEX.items()):
        parts.append(
            f"select doc_id, {n} as kind_no, '{kind}' as kind, i, ms[i] as m, "
            "coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as s "
            f"from (select doc_id, regexp_extract_all(t, '{pattern}') as ms, regexp_split_to_array(t, '{pattern}') as gs from d), "
            f"range(1, 100000) r(i) where i <= len(ms)"
        )
    good = " or ".join(f"(kind = '{k}' and {v})" for k, v in _VALID.items())
    counts = ", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in _REGEX)
    return (
        "with d as (select doc_id, coalesce(text, '') as t from documents), "
        f"every as ({' union all '.join(parts)}), "
        f"kept as (select * from every where {good}), "
        f"per as (select doc_id, {counts}, string_agg(kind || ':' || cast(cast(s as bigint) as varchar) || ':' || cast(cast(s as bigint) + length(m) as varchar), ',' order by kind_no, s) as spans from kept group by doc_id) "
        "select d.doc_id, " + ", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _REGEX) + ", sha256(coalesce(spans, '')) as base_sha256 from d left join per using (doc_id)"
    )


LM_SQL = r"""
with recursive crc(n, k, c) as (select n, 0, n from range(256) r(n) union all select n, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from crc where k < 8),
entry as (select list(c order by n) as e from crc where k = 8),
ids as (select distinct doc_id, cast(doc_id as varchar) as s from documents),
steps(doc_id, s, i, c) as (
    select doc_id, s, 1, 4294967295::bigint from ids
    union all
    select doc_id, s, i + 1, xor((select e from entry)[(xor(c, ascii(substr(s, i, 1))) & 255) + 1], c >> 8) from steps where i <= length(s)),
held as (select doc_id, xor(c, 4294967295) % 5 as f from steps where i = length(s) + 1),
d as (select doc_id, f, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') as w from documents join held using (doc_id)),
tokens as (select doc_id, f, unnest(w) as t from d union all select doc_id, f, ' ' from d),
c as (select t, count(*) as c from tokens where f <> 1 group by t),
n as (select sum(c) as n, count(*) as v from c)
select doc_id, count(*) as n_tokens, count(c.c) as n_known, cast((select n from n) as bigint) as train_tokens,
    round(sum(log10((coalesce(c.c, 0) + 0.5) / ((select n from n) + 0.5 * ((select v from n) + 1)))), 4) as base_score
from tokens left join c using (t) group by doc_id
"""

LICENSE_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
p as (select doc_id, len(w) as n_words,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' and w[i + 1] = 'license') as mit,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' and w[i + 1] = 'license') as apache,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license') as gpl from d)
select doc_id, n_words, len(mit) + len(apache) + len(gpl) as n_base,
    list_min(mit || apache || gpl) - 1 as first_word, list_max(mit || apache || gpl) - 1 as last_word,
    concat_ws(',', case when len(apache) > 0 then 'apache' end, case when len(gpl) > 0 then 'gpl' end, case when len(mit) > 0 then 'mit' end) as base_labels
from p
"""

EMBED_SQL = """
with recursive v as (
    select vec_id, label, cast(embedding as double[]) as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(cast(embedding as double[]), lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(cast(embedding as double[]), lambda x: x <> 0)) > 0),
near as (select a.vec_id as s, b.vec_id as t from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(s, t) as (select vec_id, vec_id from embeddings union select r.s, n.t from reach r join near n on r.t = n.s),
low as (select s, min(t) as component_id from reach group by s),
links as (select s, count(*) as n_links from near group by s)
select e.vec_id, coalesce(n_links, 0) as n_links, low.component_id, e.vec_id = low.component_id as kept
from embeddings e join low on low.s = e.vec_id left join links on links.s = e.vec_id
"""

_CRC_SQL = r"""
crc(n, k, c) as (select n, 0, n from range(256) r(n) union all select n, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from crc where k < 8),
entry as (select list(c order by n) as e from crc where k = 8),
ids as (select distinct doc_id, cast(doc_id as varchar) as s from documents where doc_id is not null),
steps(doc_id, s, i, c) as (
    select doc_id, s, 1, 4294967295::bigint from ids
    union all
    select doc_id, s, i + 1, xor((select e from entry)[(xor(c, ascii(substr(s, i, 1))) & 255) + 1], c >> 8) from steps where i <= length(s)),
crcs as (select doc_id, xor(c, 4294967295) as crc from steps where i = length(s) + 1)"""


def _leaf_sql(*values: str) -> str:
    texts = [f"cast({v} as varchar)" for v in values]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + "))"


MERKLE_SQL = f"""
with recursive {_CRC_SQL},
f as (select doc_id, lang, {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} as leaf, {_leaf_sql("doc_id", "source", "lang", "n_chars + 1", "text")} as forged from documents),
d as (
    select f.*, coalesce(crc % 7 = 0, false) as tampered, row_number() over (partition by lang order by f.doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n
    from f left join crcs on crcs.doc_id = f.doc_id),
tree(lang, level, pos, n, h) as (
    select lang, 0, pos, n, leaf from d
    union all
    select lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from tree where n > 1 group by lang, level, n, pos // 2),
sub as (select lang, level as top, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from tree where n = 1),
crown(level, pos, n, h) as (
    select 0, pos, n, h from sub
    union all
    select level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from crown where n > 1 group by level, n, pos // 2),
root as (select h, level from crown where n = 1),
beside as (
    select d.lang, d.pos, t.level, t.h, t.pos % 2 = 1 as later
    from d join tree t on t.lang is not distinct from d.lang and t.n > 1 and t.pos = xor(d.pos >> t.level, 1)
    union all
    select d.lang, d.pos, s.top + c.level, c.h, c.pos % 2 = 1
    from d join sub s on s.lang is not distinct from d.lang join crown c on c.n > 1 and c.pos = xor(s.pos >> c.level, 1)),
proof as (select lang, pos, string_agg(h, '' order by level) as p from beside group by lang, pos),
fold(lang, pos, level, last, h) as (
    select d.lang, d.pos, 0, s.top + root.level, case when tampered then forged else leaf end
    from d join sub s on s.lang is not distinct from d.lang, root
    union all
    select f.lang, f.pos, f.level + 1, f.last, sha256(case when b.later then f.h || b.h when not b.later then b.h || f.h else f.h end)
    from fold f left join beside b on b.lang is not distinct from f.lang and b.pos = f.pos and b.level = f.level where f.level < f.last)
select d.doc_id, d.leaf, s.h as subroot, root.h as root, sha256(coalesce(p.p, '')) as proof_sha256, f.h as folded_root, f.h = root.h as verified
from d join sub s on s.lang is not distinct from d.lang join fold f on f.lang is not distinct from d.lang and f.pos = d.pos and f.level = f.last
    left join proof p on p.lang is not distinct from d.lang and p.pos = d.pos, root
"""

QUERIES = {f.__name__: f for f in (pii_base_spans, lm_base_scores, license_base_labels)}

ORACLES = {"op8_embedding_near_dedup": EMBED_SQL, "pii_base_spans": _pii_sql(), "lm_base_scores": LM_SQL, "license_base_labels": LICENSE_SQL, "op13_merkle_manifest": MERKLE_SQL}
