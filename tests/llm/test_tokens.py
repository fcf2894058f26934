"""Byte BPE (9), token-id files (5) and packing (4) against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from farecast.llm.bytebpe import decode_ids, encode_documents, encode_ids, encoder, read_ranks
from farecast.llm.idfiles import DocIds, EliasFano, Shard, read_spans, write_ids, write_shard
from farecast.llm.packing import Packer, best_fill, pack, sequences
from farecast.llm.wordids import word_ids
from tests.llm.conftest import EDGE, make_docs

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
ALPHABET = "abcdeXYZéÉßẞİıΣσς 中文\n\t'sldt0123  .,!?🙂́\x01\xa0 <|>"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def word_reference(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_byte_bpe_equals_library_on_random_text(library):
    bpe, r = encoder(RANKS, P.PATTERN), random.Random(1)
    keys = list(bpe.ranks)
    for i in range(3000):
        t = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40)))
        if i % 2:
            t = b"".join(r.choice(keys) for _ in range(6)).decode("utf8", "ignore")
        ids = bpe.encode(t)
        assert ids == library.encode_ordinary(t), repr(t)
        assert bpe.decode_bytes(np.array(ids, np.int64)).decode() == t


def test_byte_bpe_is_linear_on_one_long_word(library):
    text = "a" * 200_000 + "ab" * 50_000
    assert encoder(RANKS, P.PATTERN).encode(text) == library.encode_ordinary(text)


def test_byte_bpe_edge_rows(spark, edge, empty, library):
    rows = encode_documents(edge, RANKS, P.PATTERN).collect()
    want = []
    for doc_id, text, _ in EDGE:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert encode_documents(empty, RANKS, P.PATTERN).count() == 0
    back = decode_ids(encode_ids(edge, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), t or "") for i, t, _ in EDGE)


def test_word_ids_equal_library_on_random_text(tokenizer):
    w, r = word_ids(WORDS), random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30)))
        assert np.frombuffer(w.encode_many([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_word_ids_keep_what_only_python_calls_white_space(tokenizer):
    w, r = word_ids(WORDS), random.Random(3)
    texts = ["foo\x1cbar", "\x1c", "a \x1d\x1d b", "é\x1e!\x1f", "word\x1c! \x01"]
    texts += ["".join(r.choice(ALPHABET + 4 * "\x1c\x1d\x1e\x1f\x85\u2028\u3000\x0b") for _ in range(r.randint(0, 30))) for _ in range(4000)]
    for t, ids in zip(texts, w.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_letters_that_are_several_words_to_the_library(tokenizer):
    """Runs of letters that change when they are lowered or composed, among plain ones."""
    w = word_ids(WORDS)
    texts = ["ŉa İb plain ǰc ﬁd ⅷ ªº ʼn ẞß DŽ ǅ ΐ ﬃ ᾳ", "İİİ a İ", "İ", "kﬁ İstanbul x", "ＡＢ ａｂ Ⅷ", "à̀ é̂́ a", "中文字 한국어 कखग ไทย"]
    for t, ids in zip(texts, w.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_word_ids_compose_before_they_lower(tokenizer):
    """Letters before combining marks, whose small and large forms do not compose alike."""
    w, r = word_ids(WORDS), random.Random(8)
    parts = ["H\u0331", "T\u0308", "W\u030a", "I\u0307", "J\u030c", "E\u0301", "K\u0338", "ΑΣ", "Σ", "ß", "É", "ab", "AB", " ", "\u0345", "x.", "'S"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 8))) for _ in range(4000)]
    for t, ids in zip(texts, w.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_caches_are_bounded_in_bytes(monkeypatch, tokenizer, library):
    """Many chunks without spaces, as in Chinese or base64 texts, and many distinct words."""
    from farecast.llm import bytebpe, wordids

    r = random.Random(9)
    spaceless = ["".join(r.choice("的一是不了人我在有他这中大来上") for _ in range(120)) for _ in range(20_000)]
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 60))) for _ in range(20_000)]
    monkeypatch.setattr(wordids, "MEMO_BYTES", 1 << 20)
    w, bpe = wordids.WordIds(WORDS), bytebpe.ByteBPE(read_ranks(RANKS), P.PATTERN)
    bpe.memo, bpe.known = bytebpe.Memo(1 << 20), bytebpe.Memo(1 << 20)
    kept = lambda d: sum(len(k) + len(v) for k, v in d.items())
    for at in range(0, 20_000, 200):
        texts = [f"{a} {b} the" for a, b in zip(spaceless[at : at + 200], words[at : at + 200])]
        got = w.encode_many(texts)
        for t, ids in list(zip(texts, got))[:3]:
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
            assert bpe.encode(t) == library.encode_ordinary(t)
        for t in texts[3:]:
            bpe.encode_bytes(t)
        slice_bytes = 200 * (wordids.ENTRY_BYTES + 64 * 5)
        assert w.size <= (1 << 19) + slice_bytes and kept(w.young) + kept(w.old) <= (1 << 20) + 2 * slice_bytes
        assert max(map(len, w.young), default=0) <= wordids.LONGEST
        for memo in (bpe.memo, bpe.known):
            assert kept(memo.young) + kept(memo.old) <= 1 << 20 and max(map(len, memo.young), default=0) <= bytebpe.LONGEST


def test_special_literals_are_what_the_untouched_library_makes_of_them():
    library, w, r = Tokenizer.from_file(WORDS), word_ids(WORDS), random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext", "|>", "<|", "É", "it's", " ", "\x1c", "!", "\x01", "\n", "word"]
    texts = ["x <|endoftext|> y", "".join(parts)]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 8))) for _ in range(3000)]
    for t, ids in zip(texts, w.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_elias_fano_round_trip_and_select():
    r = np.random.default_rng(0)
    for n, top in ((0, 0), (1, 0), (1, 9), (7, 3), (1000, 40), (5000, 10**7), (700, 1 << 40)):
        values = np.sort(r.integers(0, top + 1, n))
        ef, size = EliasFano.from_bytes(EliasFano.build(values).to_bytes() + b"tail")
        assert size == len(EliasFano.build(values).to_bytes())
        assert ef.all().tolist() == values.tolist()
        for i in range(0, n, max(1, n // 50)):
            assert ef[i] == values[i]


def test_document_ids_round_trip_through_select():
    r = random.Random(6)
    for ids in ([], [None], [None, None, -(1 << 63), 0, 0, (1 << 63) - 1], [5], sorted(r.randrange(10**9) for _ in range(3000))):
        got = DocIds(DocIds.build(ids))
        assert len(got) == len(ids) and [got[i] for i in range(len(ids))] == ids
    ids = sorted(r.sample(range(10**6), 20_000))
    assert 8 * len(DocIds.build(ids)) / len(ids) < 2 + np.log2(10**6 / len(ids)) + 1


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1000, 20_000))
    bits = 8 * len(EliasFano.build(values).to_bytes()) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


def test_shard_holds_wide_ids():
    docs = [np.array([1, 70_000], "<u4").tobytes(), b"", np.array([5], "<u4").tobytes()]
    shard = Shard(write_shard(docs))
    assert [shard[i].tolist() for i in range(3)] == [[1, 70_000], [], [5]]
    assert shard.spans() == [shard.span(i) for i in range(3)] == [(0, 2), (2, 2), (2, 3)]
    with pytest.raises(ValueError):
        Shard(b"nope")


def test_id_files_edge_rows(spark, edge, empty, scratch, tokenizer):
    path = scratch("ids")
    write_ids(edge, path, WORDS, shard_ids=500)
    got = sorted(map(tuple, read_spans(spark, path).collect()), key=lambda r: r[1])
    ids = [r[0] for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = [(i, word_reference(tokenizer, t)) for i, t, _ in EDGE]
    assert sorted((str(i), n, c) for i, _, n, c in got) == sorted((str(i), len(x), zlib.crc32(x.tobytes())) for i, x in want)
    path = scratch("ids")
    write_ids(empty, path, WORDS)
    assert read_spans(spark, path).count() == 0


def test_packing_edge_rows(spark, edge, empty, tokenizer):
    rows = [tuple(r) for r in pack(edge, WORDS, with_ids=True).where("doc_id IS NOT NULL AND doc_id <> 1").collect()]
    everything = [tuple(r) for r in pack(edge, WORDS, with_ids=True).collect()]
    reference = {i: word_reference(tokenizer, t).tolist() for i, t, _ in EDGE}
    assert {r[0] for r in rows} == {i for i, _, _ in EDGE if i not in (None, 1)}
    for doc_id in {r[0] for r in rows}:
        pieces = sorted((r[1], r[7]) for r in rows if r[0] == doc_id)
        assert [i for _, ids in pieces for i in ids] == reference[doc_id]
    assert sum(r[2] for r in everything) == sum(len(word_reference(tokenizer, t)) for _, t, _ in EDGE)
    assert all(zlib.crc32(np.array(r[7], "<u4").tobytes()) == r[3] for r in everything)
    whole = sequences(pack(edge, WORDS, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r[2] for r in everything)
    assert all(len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in whole)
    assert pack(empty, WORDS).count() == 0


def test_packer_cuts_nothing_twice():
    r = random.Random(4)
    packer, reference = Packer(64, 20), {}
    for i in range(500):
        ids = [r.randrange(1000) for _ in range(r.choice([1, 2, 5, 30, 63, 64, 65, 130]))]
        reference[i] = ids
        packer.add(i, np.array(ids, "<u4").tobytes())
    packer.finish()
    rows, size = packer.rows(), {}
    for _, _, ids, _, s, offset in rows:
        size.setdefault(s, []).append((offset, len(ids) // 4))
    for pieces in size.values():
        total = sum(n for _, n in pieces)
        assert total == 64 or total & (total - 1) == 0
    for i, ids in reference.items():
        assert [x for _, raw in sorted((r[1], r[2]) for r in rows if r[0] == i) for x in np.frombuffer(raw, "<u4")] == ids


def test_best_fill_is_the_closest_sum():
    r = random.Random(5)
    for _ in range(200):
        counts = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(0, 5))}
        room = r.randint(0, 60)
        reach = {0}
        for v, c in counts.items():
            reach = {a + k * v for a in reach for k in range(c + 1)}
        used = best_fill(counts, sorted(counts), room)
        assert all(used[v] <= counts[v] for v in used)
        assert sum(v * k for v, k in used.items()) == max(x for x in reach if x <= room)


def test_ids_survive_a_hot_id(spark, scratch, tokenizer):
    docs = make_docs(spark, [(7 if i % 3 else i, f"text {i} of many words") for i in range(300)])
    path = scratch("ids")
    write_ids(docs, path, WORDS, shard_ids=300)
    got = sorted(map(tuple, read_spans(spark, path).collect()), key=lambda r: r[1])
    assert len(got) == 300 and [r[0] for r in got] == sorted(r[0] for r in got)
