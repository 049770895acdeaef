"""Personal data by weak supervision, in DataFrame expressions only.

1. Spans. Regular expressions find e-mail addresses, IP addresses, card and phone
   numbers (the base, always kept) and candidates of further kinds. Positions
   follow from the lengths of matches and of what lies between them.
2. Labelers vote on every candidate (1, -1 or 0 for abstaining): its form (regular
   expressions, check digits), word lists (gazetteers) and what stands around it
   (context). Each can vote both ways. Base spans are certain and don't vote, so
   that their number says nothing about candidates.
3. Expectation-maximisation estimates each labeler's reliability from the counts
   of vote patterns over all documents, and so a probability for each pattern.
   Only these counts (at most 3 ** 6 rows) reach the driver.
4. A logistic span classifier is trained on the probabilities, with the votes,
   kind and length as features, again from counts of patterns. Candidates
   it finds likely are added to the base, unless they overlap it; others,
   such as placeholders, checksums and part numbers, are rejected.

A null or empty text has no spans; each row is searched by itself, so repeated
rows and null doc_ids don't matter; an empty table gives no rows and the
classifier then adds nothing.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.session import store

# Java spellings of the contract's patterns. Possessive loops (what follows can't be part of them) need no stack, and a
# look-behind that lets a match start only where its run of characters starts keeps long runs linear.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for the search to be worth it.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
MORE = {
    "secret": r"(?<![A-Za-z])(?i:passwords?|passwd|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key)"
              r"[\"']? ?[=:] ?[\"']?[A-Za-z0-9+/_.~!@#$%^&*-]{6,}+",
    "spelled_email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ ?[\[({{] ?(?i:at) ?[\])}}] ?[A-Za-z0-9-]++"
                     r"(?: ?(?:\.|[\[({] ?(?i:dot) ?[\])}]) ?[A-Za-z0-9-]++)++",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+.(-])(?<![0-9)] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,128}+)(?![A-Za-z0-9])",
}
KINDS = [*BASE, *MORE]
#: Gazetteers: words that announce personal data, and words of examples.
_ANNOUNCING = r"(?i)(?<!\p{L})(?:e-?mail|mail|contact|phone|tel|telefono|téléphone|telefon|call|fax|mobile|ssn|social security|iban|account|konto|cuenta|compte|password|passwd|pwd|secret|token|key|card|carte|tarjeta|karte|address)(?!\p{L})"
#: Words that announce numbers and codes of other kinds.
_OTHER = r"(?i)(?<!\p{L})(?:checksum|sha-?[0-9]*|md5|hash|digest|commit|revision|etag|build|part|item|order|invoice|isbn|version|serial|model|sample|example|ratio|score|range|lot|sku)(?!\p{L})"
_EXAMPLES = r"(?i)(?:xxx|000-00-0000|123-45-6789|changeme|placeholder|your[_-]|<|\.\.\.|foobar|lorem)"
_CONTEXT = 24  # characters looked at before a span
LABELERS = 6
PRIOR = 3.0


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, start, end, found) of all matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(found, F.transform(F.slice(gaps, 1, F.size(found)), F.length), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["m"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.aggregate(both, start, add, lambda state: state["out"])


def _luhn(digits: Column) -> Column:
    def value(ch: Column, at: Column) -> Column:
        d = ch.cast("int")
        return F.when(at % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), value)
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(found, r"\."), lambda part: part.cast("double") <= 255),
        "card": F.when(n.between(12, 19), _luhn(digits)).otherwise(False),
        "phone": n.between(9, 15),
    }[kind]


def _check(kind: str):
    return lambda span: _valid(kind, span["found"])


def number_of(spans: str, kind: str) -> Column:
    """Spans of a kind in the column."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _mod_97(iban: Column) -> Column:
    """The number's remainder by 97, which is 1 in valid ones: the first four characters go to the end, letters are 10 to 35."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(state: Column, ch: Column) -> Column:
        return F.when(ch.rlike("[0-9]"), state * 10 + F.ascii(ch) - 48).otherwise(state * 100 + F.ascii(ch) - 55) % 97

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), add)


def _votes(span: Column, text: Column) -> list[Column]:
    """The labelers' votes on a candidate."""
    found, kind = span["found"], span["kind"]
    before = F.substring(text, F.greatest(F.lit(1), span["start"] - (_CONTEXT - 1)), F.least(F.lit(_CONTEXT), span["start"]))
    value = F.regexp_replace(found, r"^[A-Za-z _-]+[\"']? ?[=:] ?[\"']?", "")  # of a secret, without its name
    variety = F.size(F.array_distinct(F.split(F.lower(F.substring(value, 1, 256)), "(?<=.)(?=.)")))
    announced, other = before.rlike(_ANNOUNCING), before.rlike(_OTHER)
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    either = lambda yes: F.when(yes, 1).otherwise(-1)
    form = (
        F.when(kind == "secret", either(value.rlike("[0-9]") & value.rlike(r"[A-Za-z!@#$%^&*]")))
        .when(kind == "spelled_email", either(found.rlike(r"[A-Za-z]{2,}[A-Za-z0-9._%+-]* ?[\[({].*[^A-Za-z0-9][A-Za-z]{2,6}$")))
        .when(kind == "national_id", either(found.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")))
        .when(kind == "local_phone", either(found.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]")))
        .when(kind == "iban", either(_mod_97(found) == 1))
        .otherwise(either(found.rlike("^AKIA") | (announced & ~other)))
    )
    mixed = (
        F.when(kind == "secret", either(value.rlike("[A-Za-z][0-9]|[0-9][A-Za-z]|[0-9][^A-Za-z0-9]|[^A-Za-z0-9][0-9]")))
        .when(kind == "spelled_email", vote(found.rlike(r"[\[({] ?(?i:dot)"), ~found.rlike(r"[A-Za-z]$")))
        .otherwise(0)
    )
    return [
        form,
        mixed,
        vote((announced | (kind == "secret")) & ~other, other & ~announced),
        either(~found.rlike(_EXAMPLES)),
        F.when(kind == "secret", either(found.rlike("=|[\"']") | value.rlike("[0-9]"))).otherwise(vote(before.rlike(r"[:=(\"'+] ?$"), before.rlike(r"[A-Za-z0-9]$"))),
        vote(variety >= 6, variety < 5),
    ]


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `base` and `more`: arrays of spans; those of `more` overlap none of `base` and have votes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs
    for kind, pattern in {**BASE, **MORE}.items():
        hint = _HINT.get(kind)
        if kind == "email":
            hit = F.contains(whole, F.lit(hint))
        else:
            hit = whole.rlike(hint or pattern)
        rows = rows.withColumn(f"_{kind}", F.when(hit, _spans(whole, kind, pattern)))
    kept = []
    for kind in KINDS:
        spans = F.coalesce(F.col(f"_{kind}"), F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>"))
        kept.append(F.filter(spans, _check(kind)) if kind in BASE else spans)
    n = len(BASE)
    rows = rows.withColumn("_base", F.concat(*kept[:n])).withColumn("_more", F.concat(*kept[n:]))
    clear = F.filter("_more", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def judged(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                    F.array(*_votes(s, whole)).alias("votes")))

    certain = F.transform("_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.withColumn("base", certain).withColumn("more", judged(clear)).drop("_base", "_more", *(f"_{k}" for k in KINDS))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 40) -> dict[tuple[int, ...], float]:
    """Expectation-maximisation over vote patterns and their counts: the probability of each pattern.

    Labelers are taken as independent given the truth; each has its own chance of every vote for either truth, and
    PRIOR votes seen beforehand on which it is right, so that few candidates don't turn its meaning round.
    """
    share = {votes: min(0.95, max(0.05, 0.5 + sum(votes) / (2 * LABELERS))) for votes, _ in patterns}
    for _ in range(rounds):
        weight = [sum((share[v] if y else 1 - share[v]) * n for v, n in patterns) + 1.0 for y in (0, 1)]
        chance = {(k, vote, y): (sum((share[v] if y else 1 - share[v]) * n for v, n in patterns if v[k] == vote) + (PRIOR if vote == 2 * y - 1 else 0.5)) / (weight[y] + PRIOR)
                  for k in range(LABELERS) for vote in (-1, 0, 1) for y in (0, 1)}
        for v, _ in patterns:
            log = [math.log(weight[y] / sum(weight)) + sum(math.log(chance[k, v[k], y]) for k in range(LABELERS)) for y in (0, 1)]
            share[v] = 1 / (1 + math.exp(max(-50.0, min(50.0, log[0] - log[1]))))
    return share


def _features(votes, kind, size) -> list:
    """Of a span, for plain values and for columns alike: votes for and against, kind, and length up to 64."""
    ask = (lambda x: x.cast("double")) if isinstance(kind, Column) else float
    return [*(ask(votes[k] == sign) for k in range(LABELERS) for sign in (1, -1)), *(ask(kind == k) for k in MORE), size / 64]


def train(found: DataFrame, steps: int = 300, rate: float = 2.0) -> list[float]:
    """Weights of the span classifier (the last is the constant), from counts over all candidates of all documents."""
    spans = found.select(F.explode("more").alias("s")).select("s.votes", "s.kind", (F.least(F.col("s.end") - F.col("s.start"), F.lit(64)) / 8).cast("int").alias("size"))
    counts = [(tuple(r.votes), r.kind, r.size * 8, r.n) for r in spans.groupBy("votes", "kind", "size").agg(F.count("*").alias("n")).collect()]
    by_votes: dict[tuple[int, ...], int] = {}
    for votes, _, _, n in counts:
        by_votes[votes] = by_votes.get(votes, 0) + n
    likely = reliabilities(list(by_votes.items()))
    rows = [([*_features(votes, kind, size), 1.0], likely[votes], math.sqrt(n)) for votes, kind, size, n in counts]
    total = sum(n for *_, n in rows) or 1.0
    weights = [0.0] * (2 * LABELERS + len(MORE) + 2)
    for _ in range(steps):
        slope = [1e-3 * w for w in weights]
        for x, y, n in rows:
            miss = n / total * (1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x, strict=True)))) - y)
            slope = [s + miss * v for s, v in zip(slope, x, strict=True)]
        weights = [w - rate * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _place(span: Column) -> Column:
    order = F.array_position(F.array(*map(F.lit, KINDS)), span["kind"])
    return F.struct(span["start"].alias("start"), order.alias("order"), span["end"].alias("end"), span["kind"].alias("kind"))


def detect(found: DataFrame, weights: list[float]) -> DataFrame:
    """`base` and `spans` (base and accepted candidates) in order: arrays of (start, order, end, kind)."""
    def accepted(span: Column) -> Column:
        size = F.floor(F.least(span["end"] - span["start"], F.lit(64)) / 8) * 8
        terms = [F.lit(w) * x for w, x in zip(weights, _features(span["votes"], span["kind"], size), strict=False)]
        return reduce(lambda a, b: a + b, terms) + F.lit(weights[-1]) > 0

    added = F.filter("more", accepted)
    return (found.withColumn("spans", F.array_sort(F.concat(F.transform("base", _place), F.transform(added, _place))))
            .withColumn("base", F.array_sort(F.transform("base", _place))).drop("more"))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) of every row with its `base` and `spans`, which replace columns of those names."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "spans")]
    whole = docs.select(F.struct(*names).alias("row"), F.col(text).alias("text"))
    rows = store(docs.sparkSession, candidates(whole).drop("text"), "spans")
    return detect(rows, train(rows)).select(*(F.col(f"row.`{c}`").alias(c) for c in names), "base", "spans")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap make one replacement. A null text stays."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state: Column, s: Column) -> Column:
        piece = F.array(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        fresh = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"))

    whole = F.aggregate(spans, start, add, lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
