"""Personal data: fixed base spans and candidates chosen by boosted trees.

Base spans (email, ip, card, phone) follow fixed patterns, leftmost and
non-overlapping per kind, filtered by value (parts of an address, Luhn digits,
number of digits).  They always stay.

Method for further spans: high-recall generators propose overlapping spans
(spelled-out addresses, digit groups with any separators, dotted quads);
gradient-boosted trees score them from format features (digits, groups,
separators, Luhn, parts) and context features (neighbouring characters, words
before the span); spans at or above a calibrated threshold are selected, the
best of overlapping ones first, never one that breaks the rule of its kind.  The
trees are fitted with Spark ML on
the candidates of all documents and the few ``EXAMPLES``; equal feature rows are
counted and weigh as often as they occur.  Positives cover
a base span, or are base spans rewritten in their place with other separators and
without '+' or '@'.  Negatives are values that break the rule of their kind (Luhn
digits, address parts, number of digits), also made by breaking a base span, and
dates and lists of numbers.  Any other candidate outside the base could be real
and is not learnt from.  Each kind has its threshold, the lowest score at which
at least ``PRECISION`` of a held-back third are positive, both classes weighing the
same.

The fitted trees become nested conditionals, so scoring is one projection in the
JVM: no shuffle, no Python, the text stays in its row.

Patterns are written without backtracking over long runs: possessive loops, and
a run is entered at its start only (or where the last match ended).

Positions are code points, end exclusive.  Defined cases: a null text is an empty
one; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import cut_lineage, let

# The base patterns, entered at the start of a run
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Generators, wider than the base
SPELLED = (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]{1,63}+"
           r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,5}+")
DIGITS = r"(?<![0-9])\+?\(?[0-9](?:[\x20().,/-]{0,3}+[0-9]){6,27}+"
QUAD = r"(?<![0-9])[0-9]{1,3}+(?:[.,]\x20?[0-9]{1,3}+){3}"

CONTEXT = r"(?i)(mail|contact|phone|tel|call|mobile|fax|card|visa|account|credit|ip|address|host|server)"
FEATURES = ("length", "n_digits", "n_groups", "n_seps", "n_dots", "luhn", "parts_ok", "at", "plus", "paren",
            "left_word", "right_word", "context", "distinct_digits", "dated", "listed")
DATED = (r"^\(?(?:(?:19|20)[0-9]{2}[-/. ]{1,3}[0-9]{1,2}[-/. ]{1,3}[0-9]{1,2}(?![0-9])|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}(?![0-9])"
         r"|(?:19|20)[0-9]{2}[-/ ,]{1,3}(?:19|20)[0-9]{2}(?![0-9]))")
LISTED = r",\x20|^[0-9]{1,3}(?:,[0-9]{3}){2,}"
# Base spans of each kind, so that a corpus without one can be learnt from
EXAMPLES = (
    "write to jane.doe@example.org today", "contact: bob_7@mail.example.com.", "address ops@host-1.net, or later",
    "server 10.0.0.1 is up", "ip 192.168.17.254, port", "from 172.16.31.9 to", "host 8.8.4.4 replied",
    "card 4111 1111 1111 1111 was", "visa 4012888888881881 and", "paid with 5500-0055-5555-5559.", "credit 6011111111111117 ok",
    "call +1 (555) 010-4477 now", "phone +49 30 1234567 or", "mobile +44 7700 900123.", "tel +33-1-23-45-67-89, fax",
)
TREES, DEPTH = 12, 3
PRECISION = 0.98

_SPANS = "array<struct<start:int,match:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with their starts, from the texts between them."""

    def place(parts: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            here = F.array(F.struct(start.alias("start"), x["match"].alias("match")))
            return F.struct((start + F.length(x["match"])).alias("at"), F.concat(acc["out"], here).cast(_SPANS).alias("out"))

        return F.aggregate(parts, empty, step, lambda acc: acc["out"])

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = let(matches, lambda m: F.when(F.size(m) > 0, F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m, lambda g, x: F.struct(g.alias("gap"), x.alias("match")))))
    return F.coalesce(place(pairs), F.array().cast(_SPANS))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(F.lit(False))


def parts_ok(s: Column) -> Column:
    """All dot-separated numbers are at most 255."""
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+(?=.)", "")
        return F.when(F.length(bare) <= 3, bare.try_cast("int") <= 255).otherwise(F.lit(False))

    return F.forall(F.split(s, r"\."), lambda p: F.coalesce(small(p), F.lit(False)))


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array of (start, match) of the fixed patterns."""
    nothing = F.array().cast(_SPANS)
    digits = text.rlike("[0-9]")

    def count(x: Column) -> Column:
        return F.length(digits_of(x["match"]))

    return {
        "email": F.when(F.contains(text, F.lit("@")), spans(text, EMAIL)).otherwise(nothing),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(spans(text, IP), lambda x: parts_ok(x["match"]))).otherwise(nothing),
        "card": F.when(digits, F.filter(spans(text, CARD), lambda x: F.when(
            count(x).between(16, 19), luhn_ok(digits_of(x["match"]))).otherwise(F.lit(False)))).otherwise(nothing),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(spans(text, PHONE), lambda x: count(x).between(8, 15))).otherwise(nothing),
    }


def located(kind: str, found: Column) -> Column:
    """(kind, start, stop) of spans."""
    return F.transform(found, lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("stop")))


def candidates(text: Column) -> Column:
    """Generated spans with kind and features; overlaps are allowed."""

    def described(found: Column) -> Column:
        return F.transform(found, lambda x: _features(text, x["start"], x["match"]))

    digits = text.rlike("[0-9]")
    nothing = F.array().cast(_SPANS)
    return F.concat(
        described(F.when(text.rlike(r"(?i)@|[\[(]at[\])]"), spans(text, SPELLED)).otherwise(nothing)),
        described(F.when(digits, spans(text, DIGITS)).otherwise(nothing)),
        described(F.when(digits, spans(text, QUAD)).otherwise(nothing)),
    )


def _features(text: Column, start: Column, match: Column) -> Column:
    digits = digits_of(match)
    at = match.rlike(r"(?i)@|[\[(]at[\])]")
    quad = match.rlike(r"^[0-9]{1,3}([.,] ?[0-9]{1,3}){3}$")
    kind = F.when(at, 0).when(quad, 1).when(F.length(digits) >= 16, 2).otherwise(3)
    before = F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24)))
    after = F.substring(text, start + F.length(match) + 1, F.lit(1))
    seps = F.regexp_replace(match, "[A-Za-z0-9]", "")

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")

    values = {
        "length": F.length(match).cast("double"),
        "n_digits": F.length(digits).cast("double"),
        "n_groups": F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))).cast("double"),
        "n_seps": F.length(seps).cast("double"),
        "n_dots": (F.length(match) - F.length(F.replace(match, F.lit("."), F.lit("")))).cast("double"),
        "luhn": flag(luhn_ok(digits)),
        "parts_ok": flag(quad & parts_ok(F.regexp_replace(match, "[, ]+", "."))),
        "at": flag(at),
        "plus": flag(match.startswith("+")),
        "paren": flag(F.contains(match, F.lit("("))),
        "left_word": flag(before.rlike("[A-Za-z0-9]$")),
        "right_word": flag(after.rlike("^[A-Za-z0-9]")),
        "context": flag(before.rlike(CONTEXT)),
        "distinct_digits": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "dated": flag(match.rlike(DATED)),
        "listed": flag(match.rlike(LISTED)),
    }
    return F.struct(kind.alias("kind"), start.alias("start"), (start + F.length(match)).alias("stop"),
                    *[values[f].alias(f) for f in FEATURES])


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


class TreeScorer:
    """Boosted trees as conditionals, with the calibrated threshold of each kind."""

    def __init__(self, trees: list, weights: list[float], threshold: float, by_kind: list[float] | None = None):
        self.trees, self.weights, self.threshold = trees, weights, threshold
        self.by_kind = by_kind or [threshold] * len(KINDS)

    def accepts(self, span: Column) -> Column:
        """The margin is there and reaches the threshold of the span's kind."""
        return span["margin"] >= F.get(F.array(*[F.lit(float(t)) for t in self.by_kind]), span["kind"])

    def margin(self, span: Column) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, split, left, right = node
            return F.when(span[FEATURES[feature]] <= split, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + F.lit(float(weight)) * value(tree)
        return total


def _export(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _export(node.leftChild()), _export(node.rightChild())


def _invalid(c: Column) -> Column:
    """The candidate breaks the rule of its kind, or is a date or a list of numbers."""
    quad = (c["parts_ok"] == 0) | (c["listed"] > 0)
    card = (c["luhn"] == 0) | (c["n_digits"] > 19) | (c["listed"] > 0)
    phone = ~c["n_digits"].between(8, 15) | (c["dated"] > 0) | (c["listed"] > 0)
    return F.when(c["kind"] == 1, quad).when(c["kind"] == 2, card).when(c["kind"] == 3, phone).otherwise(F.lit(False))


def _rewritten(kind: Column, match: Column) -> Column:
    """Array of (form, label): a base span in other writing (1), or with its value broken (0)."""
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    digits, bare = digits_of(match), F.substring(match, 2, 1 << 20)
    last = (F.right(digits, F.lit(1)).cast("int") + 1) % 10
    broken = F.concat(F.left(digits, F.length(digits) - 1), last.cast("string"))
    high = F.regexp_replace(match, "^[0-9]+", "999")

    def dealt(d: Column, sep: str) -> Column:
        return F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{sep}")

    def forms(good: list[Column], bad: list[Column]) -> Column:
        return F.array(*[F.struct(x.alias("form"), F.lit(float(y)).alias("label")) for y, xs in ((1, good), (0, bad)) for x in xs])

    def dots(by: str) -> Column:
        return F.replace(domain, F.lit("."), F.lit(by))

    return F.when(kind == 0, forms([
        F.concat(local, F.lit(" [at] "), domain), F.concat(local, F.lit("(at)"), dots("(dot)")), F.concat(local, F.lit(" [AT] "), dots(" [DOT] "))], [])
    ).when(kind == 1, forms(
        [F.replace(match, F.lit("."), F.lit(x)) for x in (",", ". ")], [high, F.replace(high, F.lit("."), F.lit(","))])
    ).when(kind == 2, forms(
        [dealt(digits, x) for x in (".", "/", "  ")], [broken, *[dealt(broken, x) for x in (".", " ", "-")]])
    ).otherwise(forms(
        [bare, *[F.regexp_replace(bare, "[^0-9]+", x) for x in (".", "-", "/")]],
        [F.concat_ws("-", F.left(digits, F.lit(3)), F.substring(digits, 4, 4)), F.concat(F.left(digits, F.lit(8)), F.lit("-"), broken, F.lit("0"))]))


def fit_trees(spark: SparkSession, docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> TreeScorer:
    """Trees and thresholds from the candidates of all documents.

    Two passes over the texts (their own candidates, and base spans in other writing);
    only counts of equal feature rows are kept.
    """
    if docs.isEmpty():
        return TreeScorer([], [], float("inf"))
    picked = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).where(F.col("t").rlike("[0-9@]"))
    picked = picked.unionByName(spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in EXAMPLES])).alias("t")))
    base = F.concat(*[located(k, v) for k, v in base_spans(F.col("t")).items()])
    picked = picked.select("t", base.alias("base"))
    rows = picked.select("base", F.explode(candidates(F.col("t"))).alias("c"))
    covers = F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & (b["start"] >= F.col("c.start")) & (b["stop"] <= F.col("c.stop")))
    apart = ~F.exists("base", lambda b: _overlaps(b, F.col("c")))
    rows = rows.select(F.when(covers, 1.0).when(apart & _invalid(F.col("c")), 0.0).alias("label"), "c")
    left = F.substring("t", F.greatest(F.col("b.start") - 23, F.lit(1)), F.least(F.col("b.start"), F.lit(24)))
    forms = picked.select("t", F.explode("base").alias("b")).select(
        F.col("b.kind").alias("kind"), left.alias("left"), F.substring("t", F.col("b.stop") + 1, F.lit(8)).alias("right"),
        F.explode(_rewritten(F.col("b.kind"), F.substring("t", F.col("b.start") + 1, F.col("b.stop") - F.col("b.start")))).alias("f"))
    forms = forms.select("kind", "f.label", F.length("left").alias("start"), F.length("f.form").alias("n"), F.concat("left", "f.form", "right").alias("t"))
    forms = forms.select("kind", "label", "start", "n", F.explode(candidates(F.col("t"))).alias("c")).where(
        (F.col("c.start") == F.col("start")) & (F.col("c.stop") == F.col("start") + F.col("n")))
    forms = forms.where((F.col("label") == 0) | ((F.col("c.kind") == F.col("kind")) & ~_invalid(F.col("c")))).select("label", "c")
    rows = rows.unionByName(forms).where("label is not null")
    rows = rows.select("label", "c.kind", *[F.col(f"c.{f}").alias(f) for f in FEATURES], F.pmod(F.xxhash64("c"), F.lit(3)).alias("fold"))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    rows = cut_lineage(spark, rows.sortWithinPartitions(*rows.columns))
    classes = rows.where("fold > 0").select("label").distinct().count()
    if classes < 2:
        return TreeScorer([], [], float("inf"))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, weightCol="weight").fit(assemble.transform(rows.where("fold > 0")))
    trees = [_export(t._call_java("rootNode")) for t in model.trees]
    scorer = TreeScorer(trees, list(model.treeWeights), float("inf"))
    row = F.struct(*[F.col(f).alias(f) for f in FEATURES])
    scored = rows.where("fold = 0").select("kind", F.round(scorer.margin(row), 3).alias("s"), "label", "weight")
    # scores take few values (sums of leaves); precision at every value
    levels = scored.groupBy("kind", "s").agg(
        F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("all")).orderBy("kind", F.desc("s")).collect()
    for kind in range(len(KINDS)):
        own = [(r["s"], r["good"], r["all"] - r["good"]) for r in levels if r["kind"] == kind]
        positives, negatives = sum(g for _, g, _ in own) or 1.0, sum(b for _, _, b in own) or 1.0
        good = bad = 0.0
        for s, g, b in own:
            good, bad = good + g / positives, bad + b / negatives
            if good and good >= precision * (good + bad):
                scorer.by_kind[kind] = float(s)
    scorer.threshold = min(scorer.by_kind)
    return scorer


def _ordered(found: Column) -> Column:
    """Best first, then as they stand in the text, so that ties are settled."""
    return F.sort_array(F.transform(found, lambda x: F.struct(
        (-x["margin"]).alias("cost"), x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))


_CHOSEN = "array<struct<kind:int,start:int,stop:int>>"


def find_personal_data(docs: DataFrame, scorer: TreeScorer, text_col: str = "text") -> DataFrame:
    """Input plus ``base`` and ``spans``: sorted arrays of (kind, start, stop)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*[located(k, v) for k, v in base_spans(text).items()])
    df = docs.withColumn("base", F.sort_array(base))
    if not scorer.trees:
        return df.withColumn("spans", F.col("base"))

    def select(scored: Column) -> Column:
        good = F.filter(scored, lambda c: scorer.accepts(c) & ~F.exists("base", lambda b: _overlaps(b, c)))

        def take(acc: Column, c: Column) -> Column:
            new = F.array(F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"))).cast(_CHOSEN)
            return F.when(F.exists(acc, lambda a: _overlaps(a, c)), acc).otherwise(F.concat(acc, new))

        return F.aggregate(_ordered(good), F.array().cast(_CHOSEN), take)

    scored = F.transform(candidates(text), lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"), F.when(~_invalid(c), F.round(scorer.margin(c), 3)).alias("margin")))
    return df.withColumn("spans", F.sort_array(F.concat(F.col("base"), select(scored))))


def listing(found: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(text: Column, found: Column) -> Column:
    """Text with every span replaced by its kind in brackets; overlaps merge."""
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    ordered = F.sort_array(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        mark = F.when(x["start"] < acc["at"], F.lit("")).otherwise(F.get(kinds, x["kind"]))
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    return F.aggregate(ordered, empty, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
