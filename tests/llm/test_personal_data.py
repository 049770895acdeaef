import re

from cases import awkward, documents, prose

from pyspark.sql import functions as F

from zonetally.llm import personal_data as pd_

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def by_hand(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


ODD = ["a@b.c@d.e f@g.h_i@j.k é\U0001f600 x@y.zz", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 9999999999.1.1.1", "4111 1111-1111 1111 4111111111111112 1234 +1 (415) 555-2671 5",
       "+1+2 (3)4.5-6 7890 +49 30 123456 +1", "9" * 6000, "a" * 20000, "1 " * 3000, "@@ a@b .@.", "x@a" + ".b" * 3000, "+" + "1" * 4000, "1." * 4000,
       "\U0001f600 me@x.org, 10.0.0.1; +441632960961"]


def test_base_against_brute_force(spark):
    rows = awkward() + [(100 + k, t) for k, t in enumerate(ODD)]
    found = pd_.find(documents(spark, rows).drop("base"), keep=["doc_id", "text"]).withColumn("listed", pd_.listed(F.col("base"))).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.listed == by_hand(r.text), r.text[:80]
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}


def test_candidates_are_added_and_masked(spark):
    rows = [(k, f"{prose(k, 10)} mail{k}@x.org {prose(k, 5)} password=a8b7c6d5e4{k} then") for k in range(60)]
    rows += [(100, "write to me (at) mail (dot) org"), (101, None), (102, ""), (103, "ssn: 123-98-6789, call (415) 555-2671"), (104, "word@one.two and +1 (415) 555-2671")]
    found = pd_.find(documents(spark, rows)).withColumn("masked", pd_.masked(F.col("text"), F.col("spans"))).collect()
    by = {r.doc_id: r for r in found}
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "rank", "base", "spans"} <= set(by[0].asDict())
    assert all("[EMAIL]" in by[k].masked and "[SECRET]" in by[k].masked and "a8b7" not in by[k].masked for k in range(60))
    assert by[101].masked is None and by[102].masked == ""
    assert by[104].masked == "[EMAIL] and [PHONE]"
    assert pd_.find(documents(spark, [])).count() == 0


def iban(country, account):
    digits = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{country}{98 - int(digits) % 97:02d}{account}"


def planted(draw):
    """(kind, true?, text before, candidate) of every kind."""
    hexed = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    word = lambda: "".join(draw.choice("abcdefghiklmnoprstu") for _ in range(9))
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    good = iban("DE", number(18))
    bad = good[:2] + f"{(int(good[2:4]) + 7) % 97:02d}" + good[4:]
    return [
        ("secret", True, "", f"password={word()[:4]}{number(3)}{word()[:3]}{number(2)}"), ("secret", True, "the ", f"api_key: {word()[:5]}{number(4)}x{number(2)}"),
        ("secret", False, "", "token: placeholder"), ("secret", False, "then ", f"password = changeme{word()}"), ("secret", False, "a ", f"secret: {word()}"),
        ("spelled_email", True, "write to ", f"{word()} (at) {word()} (dot) org"), ("spelled_email", False, "meet ", f"{word()} (at) {word()}.{number(2)}"),
        ("national_id", True, "ssn: ", f"{draw.randint(100, 665)}-{draw.randint(10, 99)}-{draw.randint(1000, 9999)}"),
        ("national_id", False, "part ", f"9{number(2)}-00-{number(4)}"),
        ("local_phone", True, "call ", f"({draw.randint(200, 999)}) {draw.randint(200, 999)}-{number(4)}"), ("local_phone", False, "order ", f"1{number(2)}-0{number(2)}-{number(4)}"),
        ("iban", True, "account: ", good), ("iban", False, "serial ", bad),
        ("key", True, "api key: ", hexed(40)), ("key", True, "", "AKIA" + "".join(draw.choice("ABCDEFGHIJKL0123456789") for _ in range(16))),
        ("key", False, "checksum ", hexed(32)), ("key", False, "commit ", hexed(40)),
    ]


def test_classifier_tells_true_from_false_candidates(spark):
    import random

    draw, rows, want = random.Random(7), [], []
    for k in range(40):
        for n, (kind, true, before, candidate) in enumerate(planted(draw)):
            lead = f"{prose(100 * k + n, 6)} {before}"
            rows.append((1000 * k + n, f"{lead}{candidate} , {prose(k, 4)}"))
            want.append((1000 * k + n, kind, true, len(lead)))
    rows += [(10**6 + k, f"{prose(k, 8)} user{k}@mail.org and 10.0.0.{k % 250} {prose(k, 3)}") for k in range(2000)]  # many base spans
    found = {r.doc_id: {(s.kind, s.start) for s in r.spans} for r in pd_.find(documents(spark, rows), keep=["doc_id"]).collect()}
    candidates = {r.doc_id: {s.kind for s in r.more} for r in pd_.candidates(documents(spark, rows)).select("doc_id", "more").collect()}
    for kind in pd_.MORE:
        hits = [((kind, start) in found[doc], true) for doc, k, true, start in want if k == kind]
        right = sum(hit and true for hit, true in hits)
        assert right >= 0.9 * sum(true for _, true in hits), kind
        assert right >= 0.9 * sum(hit for hit, _ in hits), kind
    false = [(doc, k) for doc, k, true, _ in want if not true]
    assert sum(k in candidates[doc] for doc, k in false) > 0.9 * len(false)  # they were candidates


def test_reliabilities_recover_the_truth():
    import itertools
    import random

    draw, counts, truth = random.Random(1), {}, {}
    for _ in range(20_000):
        y = draw.random() < 0.4
        right = [0.95, 0.9, 0.85, 0.8, 0.6, 0.5]
        votes = tuple((1 if (draw.random() < p) == y else -1) for p in right)
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    got = pd_.reliabilities(list(counts.items()))
    miss = sum(counts[v] * abs(got[v] - sum(truth[v]) / len(truth[v])) for v in counts) / 20_000
    assert miss < 0.05 and set(got) <= set(itertools.product((-1, 1), repeat=6))


def test_no_python_in_the_plan(spark):
    plan = pd_.find(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
