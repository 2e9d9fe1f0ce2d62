"""Language identification by compression.

Method: every language gets a raw-content zstandard dictionary made of training
texts; a text is encoded with each dictionary and the language whose encoding is
smallest wins.  Texts and dictionaries are lower-cased.  Long texts are encoded in pieces of ``PIECE`` bytes, all of
them, so the dictionary and not the text's own beginning explains each piece.
The margin is the relative gap between the two smallest encodings; margins under
``min_margin`` are rejected (column ``rejected``; the smallest encoding is still
reported).

Training reads a bounded sample: about ``DICT_BYTES`` of text per language, in
stretches of ``SNIPPET_CHARS`` from documents chosen by a hash of their text.  A
stretch begins where another hash of the text says, anywhere in it, so a header that
many texts share does not fill the dictionary; equal texts count once.  The driver
gets 1.5 times that bound per language, and the dictionaries (the bound times the
number of languages, which is taken to be that of a label set) are broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties
go to the language first in code-point order; a language whose sample holds fewer than
8 bytes has no dictionary and is never predicted; without any training row everything
is ``und``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import received, share

DICT_BYTES = 128 * 1024
SNIPPET_CHARS = 1500
LEVEL = 6
PIECE = 8192
MIN_MARGIN = 0.02
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def train_dictionaries(train: DataFrame, lang_col: str = "lang", text_col: str = "text",
                       dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw dictionary content per language from a bounded sample of ``train``."""
    train = train.where(F.col(lang_col).isNotNull() & (F.length(F.trim(text_col)) > 0))
    # equal texts count once here too, or a language of many copies would hardly be picked
    distinct = train.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col), F.least(F.length(text_col), F.lit(SNIPPET_CHARS)).alias("n")).distinct()
    have = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row per language
    if not have:
        return {}
    shares = F.create_map(*[F.lit(x) for lang, n in have.items() for x in (lang, min(1.0, 1.5 * dict_bytes / max(1, n)))])
    u = F.pmod(F.xxhash64(F.lit(17), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)
    places = F.greatest(F.length(text_col) - SNIPPET_CHARS + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64(F.lit(23), F.col(text_col)), places.cast("long")) + 1).cast("int")
    picked = train.where(u < shares[F.col(lang_col)]).select(
        F.col(lang_col).alias("lang"), F.substr(F.col(text_col), begin, F.lit(SNIPPET_CHARS)).alias("text"),
        F.xxhash64(text_col).alias("h")).distinct().collect()
    out = {}
    for lang in sorted(have, key=lambda x: x.encode()):
        texts = [r["text"].lower().encode("utf-8", "surrogatepass") for r in sorted(picked, key=lambda r: (r["h"], r["text"])) if r["lang"] == lang]
        content = b"\n".join(dict.fromkeys(texts))[:dict_bytes]
        if len(content) >= 8:
            out[lang] = content
    return out


class Compressors:
    """One compressor per language, built once per Python worker."""

    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        self.langs = list(content)
        self._by_lang = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self._by_lang.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False,
                                                          write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "surrogatepass")
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self._by_lang]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score in 0..1 and relative margin."""
        if text is None or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        return self.langs[order[0]], 1.0 - 0.5 * math.exp(-margin / MIN_MARGIN), margin



def identify(spark: SparkSession, docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """Input plus ``lang_pred``, ``score``, ``margin`` and ``rejected``."""
    shared = share(spark, dictionaries)

    @F.pandas_udf("lang_pred string, score double, margin double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Compressors(received(shared))
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "margin"])

    df = docs.withColumn("_lang", run(F.col(text_col)))
    df = df.withColumns({c: F.col("_lang")[c] for c in ("lang_pred", "score", "margin")}).drop("_lang")
    return df.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("margin") < min_margin))
