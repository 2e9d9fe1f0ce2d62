"""Base spans against Python patterns; selection and redaction."""

import re

from pyspark.sql import functions as F

from tripstar.llm import pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text or "") if valid(k, m.group())]


TEXTS = [
    None, "", "no data here", "mail a.b@c.de or x@y", "a@b.c_d@e.f", "é😀 me@host.org, 10.0.0.1 and 1.2.3.4.5",
    "256.1.1.1 then 000255.1.1.1", "4111 1111 1111 1111 or 4111-1111-1111-1112", "4111111111111111 4111111111111111",
    "+1 (555) 123-4567 and +49 30 1234567", "+1 2", "+1 (555) 123-4567 89 01 23 45", "a@b.c-x@y.z", "..@-.-", "%@a.b@c.d",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "9" * 40_000, "a" * 60_000, "1." * 20_000, "x@" * 20_000, "+1" * 5_000,
    "mail me@x.org\nme@x.org", "me@x.org4111111111111111", "1.2.3.4@5.6.7.8",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id int, text string, spans string")


def names(found):
    return [(pii.KINDS[x["kind"]], x["start"], x["stop"]) for x in found]


def test_base_spans(spark):
    rows = pii.find_personal_data(frame(spark, TEXTS + TEXTS[:4]), pii.TreeScorer([], [], float("inf"))).orderBy("doc_id").collect()
    assert [names(r["base"]) for r in rows] == [brute(t) for t in TEXTS + TEXTS[:4]]


def test_listing(spark):
    row = pii.find_personal_data(frame(spark, [TEXTS[5]]), pii.TreeScorer([], [], float("inf"))).select(pii.listing(F.col("base")).alias("s")).first()
    assert row["s"] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute(TEXTS[5]))


def test_trees_add_spans_and_keep_the_base(spark):
    good = [f"call +1 (555) {200 + i}-{4000 + i} or write u{i}@mail.org, host 10.0.{i % 200}.7" for i in range(120)]
    bad = [f"order 99{i} of 2024-01-{i % 28 + 1:02d}, build 3{i}45{i}12 part 300.{i}.400.9" for i in range(120)]
    scorer = pii.fit_trees(spark, frame(spark, good + bad), precision=0.9)
    assert scorer.trees and scorer.threshold < float("inf")
    rows = pii.find_personal_data(frame(spark, good + bad), scorer).collect()
    for r in rows:
        assert set(names(r["base"])) <= set(names(r["spans"]))
        extra = [x for x in r["spans"] if x not in r["base"]]
        inside = sorted((x["start"], x["stop"]) for x in extra)
        assert all(a[1] <= b[0] for a, b in zip(inside, inside[1:], strict=False))
    assert scorer.threshold > -5
    again = pii.fit_trees(spark, frame(spark, good + bad), precision=0.9)
    assert (again.trees, again.threshold) == (scorer.trees, scorer.threshold)


def test_nothing_to_learn_from(spark):
    empty = frame(spark, [])
    scorer = pii.fit_trees(spark, empty)
    assert scorer.trees == [] and pii.find_personal_data(empty, scorer).count() == 0


def test_redact(spark):
    df = pii.find_personal_data(frame(spark, ["x me@a.org 10.0.0.1 y"]), pii.TreeScorer([], [], float("inf")))
    assert df.select(pii.redact(F.col("text"), F.col("spans")).alias("t")).first()["t"] == "x [email] [ip] y"


def test_forms_beyond_the_base_are_found(spark):
    common = [f"call +1 (555) {200 + i}-{4000 + i} or write u{i}@mail.org, host 10.0.{i % 200}.7" for i in range(60)]
    common += [f"order 99{i} of 2024-01-{i % 28 + 1:02d}, build 3{i}45{i}12 part 300.{i}.400.9" for i in range(60)]
    # such forms are as common as the base
    common += [f"write u{i} [at] mail [dot] org or call 1 (555) {300 + i}-{5000 + i}, ip 10,0,{i % 200},9" for i in range(60)]
    named = {
        "please mail Jane.Doe [AT] Example [DOT] org today": ("email", "Jane.Doe [AT] Example [DOT] org"),
        "mail joe(at)host(dot)net soon": ("email", "joe(at)host(dot)net"),
        "call 1 (555) 777-4321 now": ("phone", "1 (555) 777-4321"),
        "host 10,0,77,9 replied": ("ip", "10,0,77,9"),
        "card 4111.1111.1111.1111 was used": ("card", "4111.1111.1111.1111"),
    }
    other = ["done on 2024-01-15 at noon", "card 4111.1111.1111.1112 was used", "host 300,0,77,9 replied", "rows 10, 20, 30, 40, 50, 60"]
    docs = frame(spark, common + list(named) + other)
    rows = pii.find_personal_data(docs, pii.fit_trees(spark, docs)).orderBy("doc_id").collect()[len(common):]
    for r in rows:
        assert r["base"] == []
        found = [(pii.KINDS[x["kind"]], r["text"][x["start"]:x["stop"]]) for x in r["spans"]]
        assert found == ([named[r["text"]]] if r["text"] in named else [])


def test_choice_among_overlapping_spans_is_greedy(spark):
    """Best margin first; a candidate that touches a chosen or a base span is left out."""
    common = [f"call +1 (555) {200 + i}-{4000 + i} or write u{i}@mail.org, host 10.0.{i % 200}.7" for i in range(60)]
    common += [f"order 99{i} of 2024-01-{i % 28 + 1:02d}, build 3{i}45{i}12 part 300.{i}.400.9" for i in range(60)]
    common += [f"write u{i} [at] mail [dot] org or call 1 (555) {300 + i}-{5000 + i}, ip 10,0,{i % 200},9" for i in range(60)]
    crowded = [
        "4111.1111.1111.1111.10,0,77,9 (555) 777-4321 1 (555) 777-4321 u1 [at] a [dot] b [dot] c",
        "u [at] v [at] w [dot] x 10.0.0.1 10,0,0,1,2,3 +1 (555) 010-4477 555 010 4477 4111 1111 1111 1111",
        "12345678 12345678 1 (555) 300-5000 1 (555) 300-5001, 10,1,2,3",
    ]
    docs = frame(spark, common + crowded)
    scorer = pii.fit_trees(spark, docs)
    scored = F.transform(pii.candidates(F.col("text")), lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"),
        F.when(~pii._invalid(c), F.round(scorer.margin(c), 3)).alias("margin")))
    seen = {r["doc_id"]: r["ok"] for r in docs.select("doc_id", scored.alias("s")).select("doc_id", F.filter("s", scorer.accepts).alias("ok")).collect()}

    def overlap(a, b):
        return a[1] < b[2] and b[1] < a[2]

    several = 0
    for r in pii.find_personal_data(docs, scorer).collect():
        taken = [tuple(b) for b in r["base"]]
        own = sorted(seen[r["doc_id"]], key=lambda c: (-c["margin"], c["start"], c["stop"], c["kind"]))
        several += any(overlap(tuple(a)[:3], tuple(b)[:3]) for i, a in enumerate(own) for b in own[:i])
        for c in own:
            if not any(overlap(tuple(c)[:3], t) for t in taken):
                taken.append(tuple(c)[:3])
        assert [tuple(x) for x in r["spans"]] == sorted(taken)
    assert several  # overlapping candidates did compete


def test_every_document_counts_in_trees_and_thresholds(spark):
    """Candidates of all documents are learnt from, also beyond 20,000 documents; about a third is held back."""
    many = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(
        F.expr("repeat('x', cast(id % 40 as int))"), F.lit(" part 300.4.400."), (F.col("id") % 3).cast("string")).alias("text"))
    fitted = []
    for n in (1, 3):
        base = frame(spark, [f"host 10.0.0.{i} replied, call +1 (555) 200-400{i}" for i in range(n)]).select(F.col("doc_id").cast("long"), "text")
        seen = []
        original = pii.GBTClassifier.fit

        def fit(self, rows, seen=seen, original=original):
            seen.append(rows.agg(F.sum("weight")).first()[0])
            return original(self, rows)

        pii.GBTClassifier.fit = fit
        try:
            pii.fit_trees(spark, many.unionByName(base))
        finally:
            pii.GBTClassifier.fit = original
        fitted += seen
    assert fitted[0] > 15_000 and fitted[1] > fitted[0]
