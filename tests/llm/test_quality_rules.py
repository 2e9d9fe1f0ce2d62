"""Base signals against plain Python, and the line rules on examples."""

import random
import re

from tripstar.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    full = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered), failed)


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id int, text string, kept string, n_words int")
    rows = Q.quality_rules(docs).orderBy("doc_id").collect()
    return [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows], rows


def test_base_signals(spark):
    rng = random.Random(5)
    words = ["a", "bé", "c#", "d|", "e f", "g", "😀"]
    texts = [None, "", " \n\t", "one"]
    for _ in range(60):
        n = rng.choice([3, 8, 9, 25, 80])
        texts.append("".join(rng.choice(words[: rng.choice([2, 7])]) + rng.choice([" ", "\n", "\t", " \x0b", "\n\n"]) for _ in range(n)))
    phrase = "the quick brown fox jumps over the lazy dog again "
    texts += [phrase * 2 + "x", phrase + "y " + phrase, "w " * 40, "long" * 30_000, " ".join(map(str, range(20_000)))]
    got, _ = run(spark, texts + texts[:3])
    assert got == [brute(t) for t in texts + texts[:3]]


def test_line_rules(spark):
    prose = "Plain sentences follow one another here, and nothing is wrong with any of them at all (really).\n"
    clean = prose + "A different second line that is equally harmless and long enough to count.\n" + "Wow! Short end."
    junk = "en%%% the&&& of*** " * 30
    menu = "Home | About | Products | Contact | Help | Login " * 8
    licence = "Licensed under the Apache License, Version 2.0."
    cases = [clean, junk, menu, clean + "\n" + licence, clean + "\n" + menu * 3]
    _, rows = run(spark, cases)
    assert [r["kept"] for r in rows] == [True, False, False, True, False]
    assert rows[0]["clean_text"] == clean and rows[0]["n_lost_chars"] == 0
    assert rows[3]["clean_text"] == clean


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.quality_rules(docs).count() == 0
