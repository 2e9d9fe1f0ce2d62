"""Best paths against exhaustive search and the library, and exact round trips."""

import functools
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstar.llm import sentencepiece_codec as S

needs_model = pytest.mark.skipif(not os.path.exists(S.DEFAULT_MODEL), reason="no vocabulary file")


def small(byte_fallback=True, extra=()):
    pieces = [("<unk>", 0.0, S.UNKNOWN), ("<s>", 0.0, S.CONTROL)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, S.BYTE) for b in range(256)]
    pieces += [("▁", -3.0, S.NORMAL), ("a", -2.0, S.NORMAL), ("b", -2.5, S.NORMAL), ("ab", -3.5, S.NORMAL), ("▁a", -4.0, S.NORMAL),
               ("aba", -4.5, S.NORMAL), ("▁▁", -5.0, S.NORMAL), ("é", -6.0, S.NORMAL), *extra]
    return S.Vocabulary(pieces)


def best_score(codec, unit):
    """Highest score over all segmentations, by plain recursion."""
    pieces = {t: codec.scores[i] for i, (t, _, k) in enumerate(codec.vocabulary.pieces) if k in (S.NORMAL, S.USER_DEFINED)}

    @functools.lru_cache(None)
    def go(at):
        if at == len(unit):
            return 0.0
        found = [pieces[unit[at:e]] + go(e) for e in range(at + 1, len(unit) + 1) if unit[at:e] in pieces]
        if unit[at] not in pieces:
            found.append(codec.unknown_score + go(at + 1))
        return max(found)

    return go(0)


def path_score(codec, unit, ids):
    """Score of a path; characters encoded by bytes cost the unknown score each."""
    total, spelled = 0.0, b""
    for i in ids:
        text, _, kind = codec.vocabulary.pieces[i]
        if kind == S.BYTE:
            byte = int(text[3:5], 16)
            total += codec.unknown_score if byte < 0x80 or byte >= 0xC0 else 0.0
            spelled += bytes([byte])
        else:
            total += codec.scores[i]
            spelled += text.encode()
    assert spelled == unit.encode()
    return total


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab▁éx😀", max_size=12))
def test_best_path_is_optimal(unit):
    codec = S.Codec(small())
    assert path_score(codec, unit, codec.best_path(unit.encode())) == pytest.approx(best_score(codec, unit))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet=" ab▁é\n<0x41>", max_size=40))
def test_round_trip(text):
    codec = S.Codec(small())
    assert codec.decode(codec.encode(text)) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=" abé", max_size=30))
def test_cutting_at_markers_changes_nothing(text):
    codec = S.Codec(small())
    if text:
        whole = codec.best_path(("▁" + text.replace(" ", "▁")).encode())
        assert path_score(codec, "▁" + text.replace(" ", "▁"), codec.encode(text)) == pytest.approx(
            path_score(codec, "▁" + text.replace(" ", "▁"), whole))


def test_pieces_across_markers_and_without_bytes():
    across = S.Codec(small(extra=[("a▁b", -1.0, S.NORMAL)]))
    assert across.decode(across.encode("a b a b")) == "a b a b"
    assert len(across.encode("a b")) == 2
    no_bytes = S.Codec(small(byte_fallback=False))
    assert no_bytes.encode("x") == [no_bytes.vocabulary.pieces.index(("▁", -3.0, S.NORMAL)), 0]


def test_trie_finds_exactly_its_keys():
    keys = {bytes([a, b][:n]): a * 1000 + b * 10 + n for a in range(0, 256, 7) for b in range(0, 256, 31) for n in (1, 2)}
    trie = S.DoubleArrayTrie(keys)

    def find(key):
        state = 0
        for byte in key:
            child = trie.base[state] + byte + 1
            if child >= len(trie.check) or trie.check[child] != state:
                return -1
            state = child
        return trie.value[state]

    assert all(find(k) == v for k, v in keys.items())
    assert find(b"\x01") == find(b"\x07\x01") == find(b"\x00\x00\x00") == -1


@needs_model
def test_library_lattice_agrees():
    import sentencepiece

    data = open(S.DEFAULT_MODEL, "rb").read()
    codec = S.Codec(S.Vocabulary.parse(data))
    # the same file with the model type of the trainer settings set to unigram
    library = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(data))
    for word in ["the", "these", "hello", "Straße", "informationen", "l'été", "über", "x1y2", "日本"]:
        best = library.nbest_encode_as_ids(word, 8)[0]  # by the lattice
        assert codec.encode(word) == best


def as_unigram(data):
    def varint(n):
        out = b""
        while n >= 128:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in S._fields(data):
        if number == 2:
            value = value + b"\x18\x01"  # the last value of a field counts
        out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


@needs_model
def test_documents(spark):
    texts = [None, "", " ", "Hello  world", "▁ \n é😀", "x" * 50_000, "word " * 20_000, "Hello  world"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    coded = S.encode_documents(spark, docs)
    rows = {r["doc_id"]: r for r in S.decode_documents(spark, coded).collect()}
    assert [rows[i]["decoded"] for i in range(len(texts))] == texts
    assert rows[0]["ids"] is None and rows[1]["ids"] == [] and all(rows[i]["round_trip"] for i in range(1, len(texts)))
    assert rows[4]["n_byte_ids"] >= 3
    assert S.encode_documents(spark, docs.where("false")).count() == 0
