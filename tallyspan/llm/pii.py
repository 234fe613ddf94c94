"""Personal data and secrets by candidate gradient boosting, in DataFrame functions only.

Base kinds (email, ip, card, phone) are regular expressions with a check each.
Beside them, generators propose wide, overlapping candidates, always whole
tokens: anything around an at sign, longer runs of digits and separators,
unbroken runs of 13 to 19 digits, account numbers in the international form,
and unbroken runs of 16 or more letters and digits (keys, tokens, hashes). Each
candidate gets yes/no features of its format and of the words before it.

Boosted depth-two trees learn which candidates look like personal data. Their
labels are weak: a validated base span that the candidate touches, check digits
(Luhn, modulo 97), or a cue right before it (`token =`, `tel.`, `mail:`). For
secrets the cue is the label and no feature, so that format and quotes decide,
and a secret without a cue is found as well. The features are few, so the
candidates of all rows fold into a table of feature patterns with counts, and
the driver boosts over that table. The trees become one SQL expression.

Calibration is held out: the trees fit four fifths of the texts by a hash; on
the other fifth, and only among the candidates that no base span explains, each
generator's threshold is the lowest score down to which every step of
``STEP`` candidates has a precision of ``PRECISION``. Candidates from it on are
added as kinds of their own, unless they touch a base span (a secret or an
account number: unless it lies within one). Names are not looked for: nothing
in the texts labels them, even weakly.

Patterns are possessive, so that matching is linear and never deep on long
runs, however long a text is. Offsets are code points, ends exclusive. Null and
empty texts have no spans; an empty table gives an empty result and a model
that adds nothing. Ties: spans are ordered by kind and start, patterns of equal
score pass or fail together. Rows are independent: repeated rows give equal
results. Only the key and the text are read (``redact`` carries all columns
along), so other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ADDED = ("email_like", "number_like", "card_like", "iban_like", "secret_like")
#: Kinds that may hold a base span as a part of theirs.
LARGER = ("iban_like", "secret_like")
PRECISION = 0.9
#: Held-out candidates that one step of the calibration takes together at least.
STEP = 10
FOLDS = 5
ROUNDS, RATE = 20, 0.5

#: Equal to the contract's patterns: possessive runs lose no match, and a start inside a run can't succeed where its first character failed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9]){15,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "email_like": r"(?:(?<![^\s<>,;])|\G)[^\s<>,;@]++@[^\s<>,;]++",
    "number_like": r"(?<![\p{L}0-9_])[0-9](?:[ ().-]{0,2}[0-9]){6,}+(?![\p{L}0-9_])",
    "card_like": r"(?<![\p{L}0-9_])[0-9]{13,19}+(?![\p{L}0-9_])",
    "iban_like": r"(?<![\p{L}0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9_])",
    "secret_like": r"(?<![\p{L}0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{16,}+(?![\p{L}])",
}
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9 -]{14}", "phone": r"\+[0-9]", "email_like": "@", "number_like": r"[0-9][0-9 ().-]{5}", "card_like": r"[0-9]{13}", "iban_like": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "secret_like": r"[A-Za-z0-9_+/=-]{16}"}
_SPAN = "array<struct<start:int,end:int,m:string>>"


def places(text: Column, kind: str) -> Column:
    """All leftmost non-overlapping matches of a pattern with their offsets; the text between them is what ``split`` leaves."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(0))), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
    start = F.struct(F.array().cast(_SPAN).alias("out"), F.lit(0).alias("pos"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["pos"] + x["g"]
        end = at + F.length(x["m"])
        return F.struct(F.concat(acc["out"], F.array(F.struct(at.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"), end.alias("pos"))

    return F.when(text.rlike(GUARDS[kind]), F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    back = F.reverse(digits)
    one = lambda i: F.substring(back, i, 1).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, one(i)).otherwise(F.when(one(i) > 4, one(i) * 2 - 9).otherwise(one(i) * 2)),
    )
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return (F.length(_digits(m)) <= 19) & luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def mod97(m: Column) -> Column:
    """Whether an account number's check digits are right: the first four characters behind the others, letters as 10 to 35, leave 1."""
    plain = F.regexp_replace(m, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(value > 9, acc * 100 + value).otherwise(acc * 10 + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


_CUE = r"(?:mail|tel|phone|call|fax|card|visa|konto|iban|address|\bip\b|contact)[^a-z]{0,12}$"
_KEY_CUE = r"(?:key|token|secret|passw(?:or)?d|pwd|credential|auth|bearer)[a-z_]*[\"']?\s{0,3}(?:[=:]|is)?\s{0,3}[\"']?$"

#: Feature name -> expression over the candidate text ``m``, its generator ``g`` and the 32 characters before it ``b``.
FEATURES = {
    "at_sign": lambda g, m, b: F.contains(m, F.lit("@")),
    "dot_after_at": lambda g, m, b: m.rlike(r"@[^@]*[A-Za-z0-9]\.[A-Za-z0-9]"),
    "plain_local": lambda g, m, b: m.rlike(r"^[A-Za-z0-9._%+-]+@"),
    "two_at": lambda g, m, b: m.rlike("@.*@"),
    "plus_before": lambda g, m, b: b.rlike(r"\+$"),
    "digits_8_15": lambda g, m, b: F.length(_digits(m)).between(8, 15),
    "digits_16_19": lambda g, m, b: F.length(_digits(m)).between(16, 19),
    "digits_more": lambda g, m, b: F.length(_digits(m)) > 19,
    "brackets": lambda g, m, b: m.rlike(r"\("),
    "three_dots": lambda g, m, b: m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"),
    "dashes": lambda g, m, b: m.rlike("-"),
    "blocks_of_four": lambda g, m, b: m.rlike(r"^(?:[0-9]{4}[ -]?){3,4}[0-9]{1,4}$"),
    "cue_before": lambda g, m, b: (g != "secret_like") & F.lower(b).rlike(_CUE),
    "luhn": lambda g, m, b: F.when(~g.isin(*LARGER) & F.length(_digits(m)).between(13, 19), luhn(_digits(m))),
    "mod97": lambda g, m, b: F.when(g == "iban_like", mod97(m)),
    "unbroken": lambda g, m, b: m.rlike(r"^[0-9]+$"),
    "hexadecimal": lambda g, m, b: m.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"),
    "long": lambda g, m, b: F.length(m) >= 32,
    "both_cases": lambda g, m, b: m.rlike("[a-z].*[A-Z]|[A-Z].*[a-z]"),
    "mixed_up": lambda g, m, b: m.rlike(r"(?:[0-9]++[A-Za-z]++){3}"),
    "slashes": lambda g, m, b: m.rlike("/"),
    "quote_before": lambda g, m, b: b.rlike(r"[\"']$"),
    "sign_before": lambda g, m, b: b.rlike(r"[=:]\s{0,3}[\"']?$"),
}


def _weak_label(g: Column, m: Column, b: Column) -> Column:
    """Whether check digits or a cue before it speak for a candidate."""
    n = F.length(_digits(m))
    cue = F.lower(b).rlike(_CUE)
    return (
        F.when(g == "secret_like", F.lower(b).rlike(_KEY_CUE))
        .when(g == "iban_like", mod97(m))
        .when(g == "email_like", cue)
        .when(g == "card_like", luhn(_digits(m)))
        .otherwise((n.between(13, 19) & luhn(_digits(m))) | (n.between(8, 15) & cue))
    )


def _pattern_code(g: Column, m: Column, b: Column) -> Column:
    code = F.lit(0)
    for i, f in enumerate(FEATURES.values()):
        code = code + F.when(F.coalesce(f(g, m, b), F.lit(False)), 1 << i).otherwise(0)
    return code.cast("int")


def _overlaps(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))


def found(docs: DataFrame, key: str = "doc_id", text: str = "text", labels: bool = False) -> DataFrame:
    """``(key, text, base, wide)``: validated base spans, and candidates with their feature patterns, if asked for with weak labels."""
    src = docs.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__t"))
    t = F.col("__t")
    raw = src.select(key, "__t", *[places(t, k).alias(k) for k in (*KINDS, *ADDED)])
    named = lambda k, keep: F.transform(F.filter(k, lambda x: keep(x["m"])), lambda x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    base = F.concat(*[named(k, lambda m, k=k: _valid(k, m)) for k in KINDS])

    def candidates(k: str) -> Column:
        def one(x: Column) -> Column:
            before = F.substring(t, F.greatest(x["start"] - 31, F.lit(1)), F.least(x["start"], F.lit(32)))
            code = _pattern_code(F.lit(k), x["m"], before)
            weak = [F.coalesce(_weak_label(F.lit(k), x["m"], before), F.lit(False)).alias("weak")] if labels else []
            return F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), code.alias("code"), *weak)

        return F.transform(k, one)

    wide = F.concat(*map(candidates, ADDED))
    return raw.select(key, F.col("__t").alias("text"), base.alias("base"), wide.alias("wide"))


@dataclass
class Boosted:
    """Trees over feature bits: (first bit, second bit, four leaf values), and a threshold for each generator."""

    start: float
    trees: list[tuple[int, int, tuple[float, float, float, float]]]
    thresholds: dict[str, float]

    def margin(self, code: int) -> float:
        return self.start + sum(v[2 * (code >> i & 1) + (code >> j & 1)] for i, j, v in self.trees)

    def expression(self, code: Column) -> Column:
        """The margin of a feature pattern as one SQL expression."""
        bit = lambda i: code.bitwiseAND(1 << i) > 0
        out = F.lit(self.start)
        for i, j, v in self.trees:
            out = out + F.when(bit(i), F.when(bit(j), v[3]).otherwise(v[2])).otherwise(F.when(bit(j), v[1]).otherwise(v[0]))
        return out


def boost(rows: list[tuple[str, int, int, int]], rounds: int = ROUNDS, rate: float = RATE) -> Boosted:
    """Gradient boosting with Newton leaves over ``(generator, pattern, positives, negatives)``; thresholds are still infinite."""
    pos, neg = sum(r[2] for r in rows), sum(r[3] for r in rows)
    model = Boosted(math.log((pos + 1) / (neg + 1)), [], {k: math.inf for k in ADDED})
    n = len(FEATURES)
    code = np.array([r[1] for r in rows], np.int64)
    p, q = (np.array([r[k] for r in rows], float) for k in (2, 3))
    margin = np.full(len(rows), model.start)
    for _ in range(rounds if pos and neg else 0):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = p * (1 - prob) - q * prob, (p + q) * prob * (1 - prob)
        best = (-1.0, 0, 0, (0.0,) * 4)
        for i in range(n):
            for j in range(i + 1, n):
                leaf = 2 * (code >> i & 1) + (code >> j & 1)
                g, h = np.bincount(leaf, grad, 4), np.bincount(leaf, hess, 4)
                gain = float((g * g / (h + 1)).sum())
                if gain > best[0] + 1e-9:
                    best = (gain, i, j, tuple(float(v) for v in rate * g / (h + 1)))
        model.trees.append(best[1:])
        margin = np.array([model.margin(r[1]) for r in rows])
    return model


def calibrate(model: Boosted, rows: list[tuple[str, int, int, int]], precision: float = PRECISION, step: int = STEP) -> None:
    """Set each generator's threshold by held-out ``(generator, pattern, positives, negatives)``.

    Patterns are taken by falling score, those of equal score together, until
    ``step`` candidates are reached; the threshold is the lowest score before
    the first such group whose own precision is too low.
    """
    for kind in ADDED:
        by_score: dict[float, list[int]] = {}
        for r in rows:
            if r[0] == kind:
                held = by_score.setdefault(round(model.margin(r[1]), 9), [0, 0])
                held[0] += r[2]
                held[1] += r[3]
        hits = total = 0
        for score, (p, n) in sorted(by_score.items(), reverse=True):
            hits, total = hits + p, total + p + n
            if total >= step:
                if hits / total < precision:
                    break
                model.thresholds[kind] = score - 1e-6
                hits = total = 0


def train(docs: DataFrame, text: str = "text") -> Boosted:
    """Trees from the feature patterns of the candidates of all rows; the driver gets their counts only."""
    fold = F.pmod(F.xxhash64(F.lit("pii"), text), F.lit(FOLDS))
    seen = found(docs.select(fold.alias("k"), text), "k", text, labels=True)
    each = seen.select("k", "base", F.explode("wide").alias("x")).select("k", "x.kind", "x.code", "x.weak", _overlaps(F.col("base"), F.col("x")).alias("based"))
    own = (F.col("weak") | F.col("based")) & ((F.col("kind") != "secret_like") | F.col("weak"))
    rows = each.groupBy("kind", "code", "based", (F.col("k") == 0).alias("held")).agg(F.count_if(own).alias("p"), F.count_if(~own).alias("n")).collect()
    fit: dict[tuple[str, int], list[int]] = {}
    for r in rows:
        if not r["held"]:
            both = fit.setdefault((r["kind"], r["code"]), [0, 0])
            both[0] += r["p"]
            both[1] += r["n"]
    model = boost([(*k, *v) for k, v in sorted(fit.items())])
    calibrate(model, [(r["kind"], r["code"], r["p"], r["n"]) for r in rows if r["held"] and not (r["based"] and r["kind"] not in LARGER)])
    return model


def detect(docs: DataFrame, model: Boosted, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text, base, added)``: spans as arrays of (kind, start, end), ordered by kind and start."""
    seen = found(docs, key, text)

    def limit(x: Column) -> Column:
        out = F.lit(math.inf)
        for kind in ADDED:
            out = F.when(x["kind"] == kind, model.thresholds[kind]).otherwise(out)
        return out

    def explained(x: Column) -> Column:
        within = F.exists("base", lambda s: (s["start"] <= x["start"]) & (x["end"] <= s["end"]))
        return F.when(x["kind"].isin(*LARGER), within).otherwise(_overlaps(F.col("base"), x))

    chosen = F.filter("wide", lambda x: (model.expression(x["code"]) >= limit(x)) & ~explained(x))
    return seen.select(key, "text", "base", F.transform(chosen, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Boosted, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one. Null texts stay null."""
    names = docs.columns
    held = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in names]))
    seen = detect(held, model, "__row", text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0)))
        mark = F.when(s["start"] < acc["pos"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.concat(acc["out"], between, mark).alias("out"), F.greatest(acc["pos"], s["end"]).alias("pos"))

    order = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    clean = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["pos"] + 1, F.length("text"))))
    new = F.when(F.col("__row")[text].isNotNull(), F.when(F.size(order) > 0, clean).otherwise(F.col("text")))
    return seen.select(*[new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in names])
