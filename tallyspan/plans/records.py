"""Records with state: the floor, question time, official results, logs of requests."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspan.operators import floor, lookups, questions, results
from tallyspan.plans.registry import query
from tallyspan.session import run_dir
from tallyspan.tables import table

#: A user's events as a record: views are the chair, clicks the holder, purchases another speaker's marker, errors words, sign-ups the holder's marker.
_EVENTS = """ev as (select coalesce(user_id, -1) as unit, row_number() over (partition by coalesce(user_id, -1) order by ts, event_id) as rn, event_id, length(props) as len, 'S' || (event_id % 5) as s,
 case event_type when 'view' then ['offer', 'offer', 'invite', 'chair'][event_id % 4 + 1] when 'click' then case event_id % 8 when 7 then 'renewal' else ['consent', 'consent', 'refusal', 'own'][event_id % 4 + 1] end
  when 'purchase' then if(event_id % 7 = 0, 'lost', 'turn') when 'error' then 'text' else if(event_id % 3 = 0, 'resume', 'text') end as e,
 case event_id % 3 when 0 then ['S' || (event_id % 5)] when 1 then ['S' || (event_id % 5), 'S' || (event_id % 2)] else [] end as names from events),
st(unit, rn, before, phase, exchange, epoch) as (
 select unit, 0::bigint, 'idle', 'idle', 0::bigint, 0::bigint from (select distinct unit from ev)
 union all
 select ev.unit, ev.rn, phase, case when e = 'offer' then if(phase in ('refused', 'reoffered'), 'reoffered', 'offered') when e = 'invite' and phase = 'idle' then 'invited' when e = 'consent' and phase in ('offered', 'reoffered') then 'granted'
   when e = 'renewal' and phase in ('offered', 'reoffered', 'refused') then 'granted' when e = 'refusal' and phase in ('offered', 'reoffered', 'granted') then 'refused' when e in ('turn', 'resume') and phase = 'invited' then 'idle' else phase end,
  exchange + (e = 'offer' and phase not in ('offered', 'reoffered'))::bigint, epoch + (e = 'refusal' and phase in ('offered', 'reoffered', 'granted'))::bigint
 from st join ev on ev.unit = st.unit and ev.rn = st.rn + 1),
ma as (select ev.*, st.before, st.exchange, st.epoch, sum((e in ('turn', 'resume', 'lost'))::bigint) over (partition by unit order by rn) as marker,
  last_value(case when e in ('turn', 'resume', 'lost') then e end ignore nulls) over (partition by unit order by rn) as above from ev join st using (unit, rn)),
nm as (select unit, exchange, list_distinct(flatten(list(names))) as names from ma where e = 'offer' group by 1, 2),
tu as (select ma.unit, ma.rn, marker, s, ma.exchange, epoch, before, coalesce(nm.names, []) as nm, list_contains(coalesce(nm.names, []), s) as named from ma left join nm on nm.unit = ma.unit and nm.exchange = ma.exchange where e = 'turn'),
tk as (select *, coalesce(list_distinct(list(case when named then s end) over (partition by unit, exchange, epoch, before order by rn rows between unbounded preceding and 1 preceding)), []) as taken,
  first_value(s) over (partition by unit, exchange, epoch, before order by rn) as first_, row_number() over (partition by unit, exchange, epoch, before order by rn) as no from tu),
ru as (select unit, marker, s as speaker, exchange, epoch, case before when 'idle' then 'unasked' when 'invited' then 'chair_floor' when 'offered' then 'unanswered' when 'granted' then
   case when len(nm) = 0 then case when no = 1 then 'authorized' when s = first_ then 'continued' else 'spent' end when named then if(list_contains(taken, s), 'continued', 'authorized') when len(taken) = len(nm) then 'spent' else 'recipient_mismatch' end
  else 'refused' end as ruling from tk)"""


def _record(spark, d):
    i, kind = F.col("event_id"), F.col("event_type")
    of = lambda m, *names: F.element_at(F.array(*map(F.lit, names)), (i % m + 1).cast("int"))
    event = (
        F.when(kind == "view", of(4, "offer", "offer", "invite", "chair")).when((kind == "click") & (i % 8 == 7), "renewal").when(kind == "click", of(4, "consent", "consent", "refusal", "own"))
        .when(kind == "purchase", F.when(i % 7 == 0, "lost").otherwise("turn")).when(kind == "error", "text").otherwise(F.when(i % 3 == 0, "resume").otherwise("text"))
    )
    s = lambda c: F.concat(F.lit("S"), c.cast("string"))
    names = F.when(i % 3 == 0, F.array(s(i % 5))).when(i % 3 == 1, F.array(s(i % 5), s(i % 2))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, d, "events").select(F.coalesce("user_id", F.lit(-1)).alias("unit"), "ts", "event_id", "props", event.alias("event"), s(i % 5).alias("name"), names.alias("names"))
    return floor.followed(rows, "unit", ["ts", "event_id"], "event")


def _rulings(rows):
    return floor.turn_rulings(rows, "unit", ["ts", "event_id"], "event", "name", "names")


@query(f"with recursive {_EVENTS} select unit, marker, speaker, exchange, epoch, ruling from ru")
def q3_turn_rulings(spark, d):
    return _rulings(_record(spark, d)).withColumnRenamed("name", "speaker")


@query(f"""with recursive {_EVENTS}, vo as (select *, case when e in ('offer', 'invite', 'chair') then 'chair' when e in ('own', 'consent', 'refusal', 'renewal') then 'holder'
  when e = 'text' then case above when 'lost' then 'unattributed' when 'turn' then 'other' else 'holder' end end as voice from ma),
 se as (select unit, marker, voice, count(*) as n_rows, cast(sum(len) as bigint) as n_chars from vo where voice is not null group by all)
select se.*, speaker, ruling from se left join ru on ru.unit = se.unit and ru.marker = se.marker and voice = 'other'""")
def q3_voice_segments(spark, d):
    rows = _record(spark, d)
    return floor.segments(rows, "unit", "event", "name", "props", _rulings(rows))


@query(f"""with recursive {_EVENTS} select unit, cast(sum(len) as bigint) as n_source, cast(sum(case when e = 'text' and above = 'lost' then len else 0 end) as bigint) as n_unattributed from ma where e not in ('turn', 'resume', 'lost') group by 1""")
def q3_characters_conserved(spark, d):
    """All characters of a unit's words, from its segments, and those that belong to nobody."""
    rows = _record(spark, d)
    got = floor.segments(rows, "unit", "event", "name", "props", _rulings(rows))
    return got.groupBy("unit").agg(F.sum("n_chars").alias("n_source"), F.sum(F.when(F.col("voice") == "unattributed", F.col("n_chars")).otherwise(0)).alias("n_unattributed"))


@query("""with recursive o as (select o_custkey as unit, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn, case when o_orderkey % 5 < 3 then 'failed' when o_orderstatus = 'F' then 'miss' else 'hit' end as outcome from orders),
r(unit, rn, o_orderkey, state, run, n_asked) as (
 select unit, rn, o_orderkey, outcome, (outcome = 'failed')::int, 1::bigint from o where rn = 1
 union all
 select o.unit, o.rn, o.o_orderkey, if(run = 3, 'not_asked', outcome), case when run = 3 then 3 when outcome = 'failed' then run + 1 else 0 end, n_asked + (run < 3)::bigint from r join o on o.unit = r.unit and o.rn = r.rn + 1)
select unit, o_orderkey, state, n_asked from r""")
def s18_stop_after_failures(spark, d):
    o = table(spark, d, "orders")
    log = o.select(F.col("o_custkey").alias("unit"), "o_orderdate", "o_orderkey", F.when(F.col("o_orderkey") % 5 < 3, "failed").when(F.col("o_orderstatus") == "F", "miss").otherwise("hit").alias("outcome"))
    return lookups.stop_after(log, "unit", ["o_orderdate", "o_orderkey"], "outcome").select("unit", "o_orderkey", "state", "n_asked")


@query("""with o as (select c_nationkey as scope, o_orderkey, (row_number() over (partition by c_nationkey order by o_orderkey) - 1) // 20 as page from orders join customer on o_custkey = c_custkey),
p as (select scope, page, list(case when scope % 5 = 4 and page = 2 then -1 else o_orderkey end) as items, max(page) over (partition by scope) as last_ from o group by scope, page),
n as (select scope, count(*) + (scope % 5 = 3)::bigint - (scope % 5 = 0)::bigint * 25 as announced from o group by scope),
q as (select p.scope, page, items, announced, case when page > 0 then 'c' || page end as used, case when scope % 5 = 1 and page = 3 then 'c3' when page < last_ then 'c' || (page + 1) end as following from p join n using (scope) where not (scope % 5 = 2 and page = 4)),
f as (select scope, min(page) as page, i from (select scope, page, unnest(items) as i from q) group by scope, i),
h as (select q.*, (select count(*) from f where f.scope = q.scope and f.page <= q.page) as held, used is distinct from lag(following) over (partition by scope order by page) as broken from q),
e as (select *, case when following is null then 'no_cursor' when following = used then 'repeated_cursor' when held >= announced then 'all_held' end as ends from h),
s as (select scope, min(page) filter (ends is not null) as stop, min(page) filter (broken) as gap from e group by 1),
r as (select e.* from e join s using (scope) where page <= coalesce(stop, page) and page < coalesce(gap, page + 1))
select r.scope, count(*) as n_pages, max(held) as n_items, max(announced) as announced, coalesce(max(ends), if(bool_or(gap <= coalesce(stop, gap)), 'missing_page', 'open')) as ended,
 case when max(held) = max(announced) then 'complete' when max(held) < max(announced) then 'short' else 'over' end as state from r join s using (scope) group by 1""")
def s2_cursor_pages(spark, d):
    """Lists landed as JSON pages: a repeated cursor, a page that is missing, totals that are wrong, items that come twice."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("scope"), "o_orderkey")
    placed = o.withColumn("page", F.floor((F.row_number().over(Window.partitionBy("scope").orderBy("o_orderkey")) - 1) / 20))
    scope, page = F.col("scope"), F.col("page")
    total = placed.groupBy("scope").agg(F.count(F.lit(1)).alias("n"), F.max("page").alias("last"))
    made = placed.groupBy("scope", "page").agg(F.collect_list(F.when((scope % 5 == 4) & (page == 2), F.lit(-1).cast("long")).otherwise(F.col("o_orderkey"))).alias("documents")).join(total, "scope")
    cursor = lambda n: F.concat(F.lit("c"), n.cast("string"))
    made = made.select(
        "scope", "page", "documents", (F.col("n") + F.when(scope % 5 == 3, 1).when(scope % 5 == 0, -25).otherwise(0)).alias("numFound"), F.when(page > 0, cursor(page)).alias("used"),
        F.when((scope % 5 == 1) & (page == 3), "c3").when(page < F.col("last"), cursor(page + 1)).alias("cursor"),
    ).filter(~((scope % 5 == 2) & (page == 4)))
    at = f"{run_dir(spark)}/pages-{uuid.uuid4().hex}"
    made.write.json(at)
    landed = spark.read.schema("scope int, page long, documents array<long>, numFound long, used string, cursor string").json(at)
    return lookups.paged_lists(landed, "scope", "page", "used", "cursor", "numFound", "documents")


_QUESTIONS = """ev as (select coalesce(user_id, -1) as unit, event_id % 6 as asker, event_id, event_type = 'click' as q, row_number() over (partition by coalesce(user_id, -1), event_id % 6 order by ts, event_id) as rn from events where event_type in ('click', 'purchase')),
st(unit, asker, rn, waiting, served, event_id) as (
 select unit, asker, 0::bigint, []::bigint[], null::bigint, null::bigint from (select distinct unit, asker from ev)
 union all
 select ev.unit, ev.asker, ev.rn, case when q then list_append(waiting, ev.event_id) else waiting[2:] end, case when not q then waiting[1] end, ev.event_id from st join ev on ev.unit = st.unit and ev.asker = st.asker and ev.rn = st.rn + 1),
put as (select ev.event_id, t.event_id as turn, ev.asker from ev left join st t on t.served = ev.event_id where q)"""


def _questions(spark, d):
    e = table(spark, d, "events").filter(F.col("event_type").isin("click", "purchase"))
    rows = e.select(F.coalesce("user_id", F.lit(-1)).alias("unit"), (F.col("event_id") % 6).alias("asker"), "ts", "event_id", (F.col("event_type") == "click").alias("q"))
    return rows, questions.put_questions(rows, "unit", ["ts", "event_id"], "asker", "q", "event_id")


@query(f"""with recursive {_QUESTIONS}, pe as (select case when n_nationkey < 2 then n_nationkey else n_nationkey % 3 + 2 end as name, n_nationkey as person from nation),
un as (select name, min(person) as person from pe group by 1 having count(distinct person) = 1)
select event_id, turn, case when turn is null then person end as person, case when turn is not null then 'turn' when person is not null then 'candidate' else 'name' end as source from put left join un on un.name = put.asker""")
def q7_put_questions(spark, d):
    _, put = _questions(spark, d)
    n = F.col("n_nationkey")
    people = table(spark, d, "nation").select(F.when(n < 2, n).otherwise(n % 3 + 2).cast("long").alias("name"), F.col("n_nationkey").alias("person"))
    return questions.named_askers(put, "event_id", "turn", "asker", people, "name", "person")


@query(f"""with recursive {_QUESTIONS} select unit, count(*) filter (not q) as n_turns, count(*) filter (not q and event_id in (select turn from put)) as n_serving, (select count(*) - count(distinct turn) from put where turn is not null) as n_twice from ev group by 1""")
def q7_turns_reconciled(spark, d):
    """Every turn serves one question or none."""
    rows, put = _questions(spark, d)
    used = put.filter("turn is not null").groupBy("unit", "turn").agg(F.count(F.lit(1)).alias("n"))
    g = used.groupBy("unit").agg(F.count(F.lit(1)).alias("n_serving"), F.sum(F.col("n") - 1).alias("n_twice"))
    turns = rows.groupBy("unit").agg(F.count_if(~F.col("q")).alias("n_turns"))
    return turns.join(g, "unit", "left").select("unit", "n_turns", F.coalesce("n_serving", F.lit(0)).alias("n_serving"), F.coalesce("n_twice", F.lit(0)).cast("long").alias("n_twice"))


_WORDS = {"angenommen": "accepted", "abgelehnt": "rejected"}


@query("""with v as (select o_orderkey as k, o_custkey as c, o_orderkey % 7 + 100 as y, o_orderkey % 3 + 50 as n, case when o_orderkey % 8 = 2 then ['1/' || o_orderkey, '1/' || (o_orderkey + 1)] else ['1/' || o_orderkey] end as docs from orders),
b as (select k as bk, c, y + k % 9 - 4 as by_, n as bn, case k % 4 when 0 then ['1/' || k] when 1 then [] when 2 then ['1/' || k, '1/' || (k + 1)] else ['9/' || k] end as bd, ['accepted', 'rejected', 'negated', 'contradictory', 'unstated'][k % 5 + 1] as said from v),
p as (select k, bk, said, len(bd) > 0 and list_has_all(docs, bd) as own, by_ = y and bn = n as eq, abs(by_ - y) <= 3 and abs(bn - n) <= 3 as near from v join b using (c) where len(bd) = 0 or list_has_any(bd, docs)),
m as (select k, count(*) filter (own) as n_own, max(said) filter (own and near) as sure_said, count(*) filter (own and near) as n_sure, count(*) filter (eq and own) as n_eq_own, max(said) filter (eq and own) as said_own, count(*) filter (eq) as n_eq, max(said) filter (eq) as said_eq from p group by 1),
w as (select v.k, case when n_own = 1 and n_sure = 1 then 1 when n_own > 1 then n_eq_own else n_eq end as hits, case when n_own = 1 and n_sure = 1 then sure_said when n_own > 1 then said_own else said_eq end as said from v left join m using (k))
select k as o_orderkey, case when hits = 1 then 'found' when hits > 1 then 'ambiguous' else 'absent' end as state, case when hits = 1 then said end as outcome from w""")
def x12_official_results(spark, d):
    """Pages of running text written from orders, and the results read from them again."""
    k, text = F.col("o_orderkey"), lambda c: c.cast("string")
    one, two = F.concat(F.lit("1/"), text(k)), F.concat(F.lit("1/"), text(k + 1))
    votes = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("page"), (k % 7 + 100).alias("yes"), (k % 3 + 50).alias("no"), F.when(k % 8 == 2, F.array(one, two)).otherwise(F.array(one)).alias("docs"))
    named = F.when(k % 4 == 0, one).when(k % 4 == 1, F.lit("dies")).when(k % 4 == 2, F.concat(one, F.lit(" und "), two)).otherwise(F.concat(F.lit("9/"), text(k)))
    said = F.element_at(F.array(*map(F.lit, ["Antrag angenommen", "Der Antrag ist abgelehnt", "Antrag ist nicht\nangenommen", "teils angenommen, teils abgelehnt", "Vielen Dank"])), (k % 5 + 1).cast("int"))
    block = F.concat(F.lit("Abstimmung über "), named, F.lit("\nGesamt: 200 Ja: "), text(F.col("yes") + k % 9 - 4), F.lit(" Nein: "), text(F.col("no")), F.lit(" Enthaltungen: 2\n"), said)
    pages = votes.withColumn("block", block).groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("block")), "\n\n").alias("text"))
    found = results.tallies(pages, "page", "text", r"Gesamt: \d+ Ja: (\d+) Nein: (\d+)", r"\d+/\d+")
    return results.official(votes, "o_orderkey", "page", "yes", "no", "docs", found, _WORDS, r"\bnicht\s+(?:angenommen|abgelehnt)")
