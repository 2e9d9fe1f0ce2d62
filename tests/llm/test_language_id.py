"""Language identification against a direct compression loop, and what training reads."""

import random

import zstandard
from pyspark.sql import functions as F

from tripstar.llm import langid


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_predictions_equal_a_plain_loop(spark):
    rng = random.Random(2)
    letters = {"aa": "abcde", "bb": "efghij", "éé": "éàùçabc"}
    known = {k: words(rng, v, 4000).encode() for k, v in letters.items()}
    texts = [None, "", "123 ...", "x"] + [words(rng, rng.choice(list(letters.values())), rng.choice([1, 5, 60, 4000])) for _ in range(40)]
    texts += [words(rng, letters["aa"], 900) + words(rng, letters["bb"], 1000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in langid.identify(spark, docs, known).collect()}
    for i, text in enumerate(texts):
        if not text or not any(c.isalpha() for c in text):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        data = text.lower().encode()
        sizes = {}
        for lang, content in known.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=langid.LEVEL)
            c = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(c.compress(data[a:a + langid.PIECE])) for a in range(0, len(data), langid.PIECE))
        best, second = sorted(sizes.values())[:2]
        assert got[i]["lang_pred"] == min(known, key=lambda k: (sizes[k], k.encode()))
        assert got[i]["margin"] == (second - best) / second
        assert got[i]["rejected"] == ((second - best) / second < langid.MIN_MARGIN)


def test_training_reads_beyond_a_shared_header_and_equal_texts_once(spark):
    rng = random.Random(5)
    header = words(rng, "xyz", 400)  # longer than a stretch
    rows = [("aa", header + " " + words(rng, "abcde", 3000)) for _ in range(60)]
    rows += [("bb", "efgh " * 2000)] * 500 + [("cc", "a b"), ("dd", None), (None, "abc")]
    train = spark.createDataFrame(rows, "lang string, text string")
    known = langid.train_dictionaries(train, dict_bytes=20_000)
    assert sorted(known) == ["aa", "bb"]  # too little text of cc to compress with
    assert len(known["aa"]) > 10_000
    of_header = sum(known["aa"].count(c) for c in b"xyz")
    assert of_header < 0.4 * len(known["aa"])
    assert len(known["bb"]) <= langid.SNIPPET_CHARS
    assert langid.train_dictionaries(train.where(F.lit(False))) == {}
