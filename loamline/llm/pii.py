"""Personal data by weak-supervision aggregation (DataFrame functions only).

Base spans (email, ip, card, phone) follow fixed patterns and checks and are
always reported. Candidates of two further kinds (``account``: other long
numbers; ``secret``: long mixed tokens) are reported if a classifier accepts
them. Six labelers vote on every candidate, base spans included: a shape
pattern, a gazetteer of telling words before it, three context labelers
(delimiters around it, assignment or quotes before it, path or tag signs next
to it) and a gazetteer of placeholder values. Expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability and each
candidate's probability; the span classifier, a logistic model over votes,
kind and length, is trained on those probabilities.

The corpus is counted by vote pattern in Spark; the driver sees one row per
(kind, votes, length class), at most KINDS * 3 ** LABELERS * 4 rows, however
large the corpus is.

Patterns are written so that Java's matcher runs in linear time without
recursion: possessive groups, and a run of letters or digits is entered at its
start or where the last match ended (later starts of a failed run fail, too).
Positions are code points; they come from the lengths of matches and of the
gaps between them.

A null or empty text has no spans. Repeated rows get equal results; extra
columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import texts, written

EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
NUMBER = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
BASE = ("email", "ip", "card", "phone")
EXTRA = ("account", "secret")
LABELERS = 6
BEFORE = 24
# fixed values: words that announce each kind (English, German, French, Spanish)
TELLING = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|karte|carte|tarjeta|credit",
    "phone": "phone|tel|call|mobile|fax",
    "account": "account|iban|konto|compte|cuenta|card|phone|tel|number|nummer",
    "secret": "token|key|secret|passw|auth|bearer|credential",
}
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, start: Column) -> Column:
    zero = F.struct(start.cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(values, zero, lambda a, v: F.struct(
        (a["sum"] + v).alias("sum"), F.array_append(a["all"], a["sum"] + v).alias("all")), lambda a: a["all"])


def cumulated(values: Column) -> Column:
    """Running sums of a non-empty array, block by block (appending to one long array is quadratic)."""
    def whole(v):
        blocks = F.sequence(F.lit(0), F.ceil(F.size(v) / BLOCK).cast("int") - 1)
        part = lambda b: F.slice(v, b * BLOCK + 1, BLOCK)
        sums = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda a, x: a + x))
        return let(running(sums, F.lit(0)), lambda ends: F.flatten(F.transform(
            blocks, lambda b: running(part(b), F.coalesce(F.get(ends, b - 1), F.lit(0))))))

    return let(values, whole)


def located(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping: array of (start, end, value)."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def placed(matches):
        size = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), matches,
                          lambda gap, m: (F.char_length(gap) + F.char_length(m)).cast("long"))
        return F.when(F.size(matches) > 0, F.zip_with(cumulated(size), matches, lambda end, m: F.struct(
            (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("value")))).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Is the digit string valid by Luhn's check?"""
    def total(d):
        n = F.size(d)
        weighted = F.transform(d, lambda x, i: F.when((n - i) % 2 == 0, F.when(
            x.cast("int") > 4, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)).otherwise(x.cast("int")))
        return F.aggregate(weighted, F.lit(0), lambda a, x: a + x)

    return let(F.filter(F.split(value, ""), lambda x: x != ""), total) % 10 == 0


def between(value: Column, low: int, high: int) -> Column:
    return (F.char_length(value) >= low) & (F.char_length(value) <= high)


def is_card(value: Column) -> Column:
    return F.when(between(digits(value), 13, 19), luhn(digits(value))).otherwise(F.lit(False))


def is_ip(value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.char_length(part(p)) < 3) | (
        (F.char_length(part(p)) == 3) & (part(p) <= "255")))


def is_token(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, "+")
    return (out if no is None else out.when(no, "-")).otherwise("0")


def candidate(text: Column, kind: str, x: Column) -> Column:
    """(kind, start, end, votes, length class) of one match."""
    before = F.lower(F.substring(text, F.greatest(F.lit(1), (x["start"] - BEFORE + 1)).cast("int"),
                                 F.least(F.lit(BEFORE), x["start"]).cast("int")))
    after = F.substring(text, (x["end"] + 1).cast("int"), F.lit(1))
    value, n = x["value"], F.char_length(x["value"])
    shape = {"secret": vote(value.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$")),
             "account": vote(F.lit(False), F.char_length(digits(value)) < 12)}.get(kind, F.lit("+"))
    votes = F.concat(
        shape,
        vote(before.rlike(TELLING[kind])),
        vote(before.rlike(r"(?:^|[\s\"'(\[{<:=,;])$") & after.rlike(r"^(?:$|[\s\"')\]}>,;.!?])"), F.lit(True)),
        vote(before.rlike(r"[=:]\s*[\"']?$")),
        vote(F.lit(False), before.rlike(r"[/\\_@#&?]$") | after.rlike(r"^[/\\_@#&]")),
        vote(F.lit(False), F.size(F.array_distinct(F.split(value, ""))) <= 4))
    length = F.when(n < 12, 0).when(n < 20, 1).when(n < 40, 2).otherwise(3)
    return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                    votes.alias("votes"), length.alias("length"))


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and, for each row, ``base`` and ``extra`` spans with votes."""
    text = F.col("text")
    rows = docs.select(
        *keep, text, F.when(F.contains(text, F.lit("@")), located(text, EMAIL)).alias("email"),
        F.filter(located(text, IP), lambda x: is_ip(x["value"])).alias("ip"),
        located(text, NUMBER).alias("number"),
        F.when(F.contains(text, F.lit("+")), F.filter(
            located(text, PHONE), lambda x: between(digits(x["value"]), 9, 15))).alias("phone"),
        F.filter(located(text, TOKEN), lambda x: is_token(x["value"])).alias("secret"))
    rows = rows.select(
        *keep, text, "email", "ip", "phone", "secret",
        F.filter("number", lambda x: is_card(x["value"])).alias("card"),
        F.filter("number", lambda x: between(digits(x["value"]), 9, 19) & ~is_card(x["value"])).alias("account"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,votes:string,length:int>>")
    voted = lambda k: F.coalesce(F.transform(k, lambda x: candidate(text, k, x)), none).alias(k)
    rows = rows.select(*keep, text, *(voted(k) for k in (*BASE, *EXTRA)))
    rows = rows.select(*keep, text, F.concat(*BASE).alias("base"), F.concat(*EXTRA).alias("extra"))
    clear = F.filter("extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    return rows.select(*keep, text, "base", clear.alias("extra"))


def expectation_maximisation(counts: list[tuple], steps: int = 40) -> list[float]:
    """Probability of each pattern (kind, votes, length, n) to be personal data.
    Votes are independent given the truth; each labeler has its own rates."""
    p = []
    for kind, votes, _, _ in counts:
        score = sum({"+": 1, "-": -1, "0": 0}[v] for v in votes)
        p.append(0.95 if kind in BASE else 1 / (1 + math.exp(-score)))
    for _ in range(steps):
        prior: dict = {}
        rate = [{(v, y): 1.0 for v in "+-0" for y in (0, 1)} for _ in range(LABELERS)]
        for (kind, votes, _, n), q in zip(counts, p):
            yes, all_ = prior.get(kind, (1.0, 2.0))
            prior[kind] = (yes + n * q, all_ + n)
            for r, v in zip(rate, votes):
                r[v, 1] += n * q
                r[v, 0] += n * (1 - q)
        total = [{y: sum(r[v, y] for v in "+-0") for y in (0, 1)} for r in rate]
        p = []
        for kind, votes, _, _ in counts:
            share = prior[kind][0] / prior[kind][1]
            log_odds = math.log(share / (1 - share)) if kind not in BASE else 6.0
            for r, t, v in zip(rate, total, votes):
                log_odds += math.log(r[v, 1] / t[1]) - math.log(r[v, 0] / t[0])
            p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, log_odds)))))
    return p


def feature_names(kind: str, votes: str, length: int) -> list[str]:
    return ["bias", f"kind {kind}", f"length {length}", *(f"vote {i} {v}" for i, v in enumerate(votes) if v != "0")]


def fit_classifier(counts: list[tuple], p: list[float], steps: int = 300, rate: float = 0.5) -> dict[str, float]:
    """Weights of a logistic model trained on the estimated probabilities."""
    total = sum(math.sqrt(c[3]) for c in counts) or 1.0
    rows = [(feature_names(*c[:3]), math.sqrt(c[3]) / total, q) for c, q in zip(counts, p)]
    weights = {f: 0.0 for names, _, _ in rows for f in names}
    for _ in range(steps):
        grad = {f: 1e-4 * w for f, w in weights.items()}
        for names, n, q in rows:
            z = sum(weights[f] for f in names)
            error = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - q)
            for f in names:
                grad[f] += error
        for f, g in grad.items():
            weights[f] -= rate * 4 * g
    return weights


def train(found: DataFrame) -> dict[str, float]:
    """The span classifier, from the vote patterns of all candidates."""
    spans = found.select(F.explode(F.concat("base", "extra")).alias("s"))
    rows = spans.groupBy("s.kind", "s.votes", "s.length").agg(F.count("*").alias("n")).orderBy("kind", "votes", "length")
    counts = [tuple(r) for r in rows.collect()]  # bounded by the number of patterns
    return fit_classifier(counts, expectation_maximisation(counts))


def accepted(span: Column, weights: dict[str, float]) -> Column:
    w = lambda f: float(weights.get(f, 0.0))
    z = F.lit(w("bias"))
    for kind in EXTRA:
        z = z + F.when(span["kind"] == kind, w(f"kind {kind}")).otherwise(0.0)
    for n in range(4):
        z = z + F.when(span["length"] == n, w(f"length {n}")).otherwise(0.0)
    for i in range(LABELERS):
        for v in "+-":
            z = z + F.when(F.substring(span["votes"], i + 1, 1) == v, w(f"vote {i} {v}")).otherwise(0.0)
    return z >= 0.0


def spelled(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of each row."""
    found = written(candidates(texts(docs), "doc_id").drop("text"), "spans")
    weights = train(found)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    extra = F.filter("extra", lambda s: accepted(s, weights))
    return found.select("doc_id", *(count(k) for k in BASE),
                        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                        spelled(F.concat("base", extra)).alias("spans"))


def redacted(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``text`` with every span replaced by its kind in
    brackets (of overlapping spans, the one that starts first and ends last)."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    weights = train(written(candidates(rows).drop("text"), "spans"))
    found = candidates(rows, *keep)
    spans = F.array_sort(F.transform(
        F.concat("base", F.filter("extra", lambda s: accepted(s, weights))),
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    return found.withColumn("spans", spans).select(*keep, F.when(F.size("spans") == 0, F.col("text")).otherwise(
        cut_out(F.col("text"), F.col("spans"))).alias("text"))


def cut_out(text: Column, spans: Column) -> Column:
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a, s):
        piece = F.concat(F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                         F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], -s["end"]).alias("at"), a["parts"].alias("parts"))).otherwise(
            F.struct((-s["end"]).alias("at"), F.array_append(a["parts"], piece).alias("parts")))

    return F.aggregate(spans, zero, step, lambda a: F.concat(
        F.concat_ws("", a["parts"]), F.substring(text, (a["at"] + 1).cast("int"), F.char_length(text))))
