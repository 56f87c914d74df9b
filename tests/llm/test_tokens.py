"""Token operators against the plain libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tether.llm import packing, token_counts, token_output
from tether.llm.tokenize import BareBpe, PieceCounts, SpacedBpe

ODD = [" ", "  ", "\n", "\n\n", "\t", "a", "Le", "'s", "don't", "é", "ß", "Σ", "İ", "́", "<|endoftext|>", "<|", "12", "!!", "x.", "\r\n", "\xa0", "\x85", "\x1c", "▁", "ﬁ", "\x00", "\x01", "你好", "👍🏽", "Ǆ", "　", "word"]
TEXTS = st.lists(st.sampled_from(ODD), max_size=12).map("".join)
BPE = {SpacedBpe: "byte_bpe_50k.json", BareBpe: "word_bpe_49k.json"}


@pytest.mark.parametrize("kind", BPE)
def test_ids_are_the_librarys(kind):
    path = public_tokenizers.path(BPE[kind])
    library, ours = Tokenizer.from_file(path), kind(path)
    assert ours.fast is not None  # the vocabulary can be compiled

    @settings(max_examples=600, deadline=None)
    @given(st.one_of(TEXTS, st.text(max_size=20)))
    def same(text):
        assert list(np.frombuffer(next(ours.each([text])), "<u4")) == library.encode(text, add_special_tokens=False).ids

    same()


def test_piece_counts_are_the_librarys():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, ours = sentencepiece.SentencePieceProcessor(model_file=path), PieceCounts(path)

    @settings(max_examples=600, deadline=None)
    @given(st.one_of(TEXTS, st.text(max_size=20)))
    def same(text):
        assert next(ours.each([text])) == len(library.encode(text))

    same()


def test_cache_starts_anew(monkeypatch):
    import tether.llm.tokenize as module

    monkeypatch.setattr(module, "MAX_WORDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"w{i * 7 + k}" for k in range(30)) for i in range(40)]
    ours, library = BareBpe(path), Tokenizer.from_file(path)
    assert [len(x) // 4 for x in ours.each(texts)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@given(st.integers(1, 32), st.integers(0, 300), st.data())
def test_bit_packing_round_trip(bits, n, data):
    ids = np.random.default_rng(n).integers(0, 2**bits, n).astype("<u4")
    packed = token_output.pack(ids, bits)
    assert len(packed) == -(-n * bits // 8)
    a = data.draw(st.integers(0, n))
    b = data.draw(st.integers(a, n))
    assert (token_output.unpack(packed, bits, a, b) == ids[a:b]).all()


def test_id_bits():
    assert [token_output.id_bits(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_uses_every_piece_once(counts):
    left = {}
    for combination, times in packing.plan(counts, 40):
        assert sum(n * c for n, c in combination.items()) <= 40 and times > 0
        for n, c in combination.items():
            left[n] = left.get(n, 0) + c * times
    assert left == counts


@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=4), st.integers(0, 30))
def test_fullest_is_fullest(left, room):
    sums = {0}
    for n, c in left.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    found = packing.fullest(left, room)
    assert all(found[n] <= left[n] for n in found)
    assert sum(n * c for n, c in found.items()) == max(s for s in sums if s <= room)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé.") for _ in range(rng.randint(1, 8)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 400)))) for i in range(120)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "no id"), (200, None), (201, ""), (202, " \n"), (203, "long " * 30000), (-3, "before")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS n_tokens", "'x' AS size", "2 AS part", "0 AS length")


def test_token_counts(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 4096) for r in docs.collect())
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, path, share=0.001).collect())
    assert got == want
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


def test_token_files(spark, docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = {(r.doc_id, r.text): [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    token_output.write_tokens(docs, str(tmp_path / "t"), path, block_ids=5000)
    rows = sorted(token_output.read_documents(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x))
    at = 0
    for r in rows:
        assert r.start == at
        own = [v for (i, _), v in ids.items() if i == r.doc_id]
        assert (r.n_tokens, r.ids_crc32) in [(len(v), zlib.crc32(np.array(v, "<u4"))) for v in own]
        at += r.n_tokens
    last = rows[40]
    assert list(token_output.fetch(spark, str(tmp_path / "t"), last.start, last.n_tokens)) == next(v for (i, _), v in ids.items() if i == last.doc_id)
    token_output.write_tokens(docs.limit(0), str(tmp_path / "e"), path)
    assert token_output.read_documents(spark, str(tmp_path / "e")).count() == 0


def test_packing(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"))
    rows = packing.pack(docs, path).collect()
    whole, places = {}, {}
    for r in rows:
        ids = texts[r.doc_id][0]
        assert zlib.crc32(ids[r.start : r.start + r.length]) == r.ids_crc32 and 0 < r.length <= 2048
        whole.setdefault(r.doc_id, []).append(r.length)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, own in texts.items():
        assert sum(whole[doc]) == sum(map(len, own))
        assert len(own[0]) > 2048 or whole[doc] == [len(own[0])] * len(own)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(i) for own in texts.values() for i in own)
    assert len(places) <= 1.05 * -(-total // 2048)
    assert packing.pack(docs.limit(0), path).count() == 0
