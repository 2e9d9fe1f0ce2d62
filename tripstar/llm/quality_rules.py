"""Line-first cleaning with quality rules, on DataFrame functions only.

Method: every line is judged by three rules, failing lines are removed, and a
document is rejected when it loses more than ``max_loss`` of its characters:

* punctuation: at least ``MIN_SYMBOLS`` symbol characters that make up more
  than ``SYMBOL_SHARE`` of the line;
* navigation: at least three menu separators, and one for every five words;
* boilerplate: a short line with one of the known phrases.

The fixed base signals of the contract are computed beside them; a document
that fails the base is not kept either.

Everything happens inside one row, in array functions: no shuffle.  Repeated
8-word windows are found by sorting 64-bit window hashes within the document
(n log n); two different windows of one document sharing a hash is possible in
principle (about n^2 / 2^65).

Defined cases: a null text has no words and no lines (base_failed is true); an
empty line is kept and costs nothing; repeated rows are judged alike; other
columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import count_chars, let, words

# Fixed values
BASE_SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = "#*$%&<>!=_~^@{}[]\\"
MENU_SEPARATORS = "|>»•·"
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "subscribe to our", "sign up for", "click here", "read more", "share this",
    "skip to content", "back to top", "copyright ©", "(c) copyright", "powered by",
)
WHITE_SPACE = " \t\n\x0b\x0c\r"

MIN_SYMBOLS = 3
SYMBOL_SHARE = 0.08
MIN_SEPARATORS = 3
WORDS_PER_SEPARATOR = 5
BOILERPLATE_CHARS = 200
MAX_LOSS = 0.5
WINDOW = 8


def line_fails(line: Column) -> Column:
    symbols = count_chars(line, LINE_SYMBOLS)
    separators = count_chars(line, MENU_SEPARATORS)
    spaces = count_chars(line, " ")
    phrase = F.lower(line).rlike("|".join(p.replace("(", r"\(").replace(")", r"\)") for p in BOILERPLATE))
    return (
        ((symbols >= MIN_SYMBOLS) & (symbols > F.length(line) * SYMBOL_SHARE))
        | ((separators >= MIN_SEPARATORS) & (separators * WORDS_PER_SEPARATOR >= spaces + 1))
        | ((F.length(line) <= BOILERPLATE_CHARS) & phrase)
    )


def clean_lines(text: Column) -> Column:
    """Text without its failing lines; null stays null."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line_fails(line)), "\n")


def repeated_window_words(tokens: Column, width: int = WINDOW) -> Column:
    """Words covered by a window of ``width`` words that occurs twice or more."""

    def covered(w: Column) -> Column:
        n = F.size(w)
        starts = F.when(n > width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return let(hashes, from_hashes)

    def from_hashes(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, from_sorted))

    def from_sorted(s: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            same = (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return same

        at = F.array_sort(F.transform(F.filter(s, again), lambda x: x["i"]))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
            F.lit(0), lambda a, b: a + b))

    return let(tokens, covered).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the same text."""
    full = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.translate(x, WHITE_SPACE, "")) > 0)
    return let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def quality_rules(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """Input plus the base signals, lost characters, ``clean_text`` and ``kept``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    clean = F.col("clean_text")
    lost = F.length(text) - F.length(F.coalesce(clean, F.lit("")))
    df = docs.withColumns({
        "clean_text": clean_lines(F.col(text_col)),
        "word_chars": F.length(F.translate(text, WHITE_SPACE, "")).cast("long"),
        "n_symbols": count_chars(text, BASE_SYMBOLS).cast("long"),
        "n_dup_lines": repeated_lines(text),
        "_counts": let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), repeated_window_words(w).alias("r"))),
    })
    df = df.withColumns({
        "n_words": F.col("_counts")["n"],
        "n_repeat_words": F.col("_counts")["r"],
        "n_lost_chars": lost.cast("long"),
    }).drop("_counts")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return df.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("n_lost_chars") <= F.length(text) * max_loss))
