"""Operators 6, 7 and 1 against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from errlens.llm import bpe, packing, token_counts
from errlens.llm import pretokens as PT
from tests.llm.conftest import CASES, documents, prose

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "  ", "a  b", "it's we'll they're 'so' 's", " 's", "!'s x''s 's's", "a\n\n b \n", "\t\tx", "x y　 z",
       "<|endoftext|>hi <|endoftext|><|endoftext|>", "<|startoftext|> <|STARTOFTEXT|>", "123 4567 ½²", "a" * 3000, "日本語 テスト 🙂🙂 é é",
       "\x1c\x1d\x85 q", "don't I'd I'LL 'Twas 're", "ab\x00cd", " \n \n", "'", "x' ", "ΟΔΟΣ ΣΑΣ. İstanbul ǅ", "abc" * 700]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip(np.r_[0, ends[:-1]], ends)]


def test_odd_texts_match_the_library(libraries):
    byte, word = libraries
    assert split(*bpe.encode_texts(ODD, BYTE)) == [x.ids for x in byte.encode_batch(ODD, add_special_tokens=False)]
    assert token_counts.count_texts(ODD, WORD).tolist() == [len(x.ids) for x in word.encode_batch(ODD, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab's!d tmvrel\n\t1٣é日 🙂Σİ")), max_size=30), min_size=1, max_size=8))
def test_random_texts_match_the_library(texts):
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    assert split(*bpe.encode_texts(texts, BYTE)) == [x.ids for x in byte.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(texts, WORD).tolist() == [len(x.ids) for x in word.encode_batch(texts, add_special_tokens=False)]


def thue_morse(n, a="a", b="b"):
    """Two words of n letters that every linear hash modulo 2**64 with an odd step confuses for n of 1024 and more."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
@pytest.mark.parametrize("letters", ["ab", "qz", "et"])
def test_words_with_one_hash_are_told_apart(libraries, n, letters):
    byte, word = libraries
    u, v = thue_morse(n, *letters)
    cps = PT.code_points([u, v])
    a, b = PT.hashes(cps, np.array([0, n + 1]), np.array([n, 2 * n + 1])).tolist()
    assert a == b                                             # the case is real
    for batches in ([[u, v, u + " " + v, v + "x"]], [[u], [v], [u], [v, u]]):
        bpe._encoded.cache_clear()
        token_counts._counted.cache_clear()
        for texts in batches:
            assert split(*bpe.encode_texts(texts, BYTE)) == [x.ids for x in byte.encode_batch(texts, add_special_tokens=False)]
            assert token_counts.count_texts(texts, WORD).tolist() == [len(x.ids) for x in word.encode_batch(texts, add_special_tokens=False)]


def test_words_with_one_hash_in_all_three_operators(spark, libraries):
    rows = [(k, t) for k, t in enumerate(x for n in (1024, 2048) for x in thue_morse(n))]
    docs = documents(spark, rows)
    byte, word = libraries
    want = {k: byte.encode(t, add_special_tokens=False).ids for k, t in rows}
    assert {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in bpe.encode(docs, BYTE).collect()} == want
    assert {r["id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, WORD).collect()} == {
        k: len(word.encode(t, add_special_tokens=False).ids) for k, t in rows}
    pieces = packing.pieces(docs, BYTE, 2).orderBy("id", "piece").collect()
    assert {k: [i for r in pieces if r["id"] == k for i in np.frombuffer(r["ids"], "<u4").tolist()] for k, _ in rows} == {k: [*x, 2] for k, x in want.items()}


@pytest.mark.parametrize("mask", [0, 1, 7])
def test_any_hash_gives_the_same_tokens(libraries, monkeypatch, mask):
    """With a hash of few values nearly all words share one."""
    whole = PT.hashes
    monkeypatch.setattr(PT, "hashes", lambda *a: whole(*a) & np.uint64(mask))
    bpe._encoded.cache_clear()
    texts = [*ODD, prose(3, 60)]
    assert split(*bpe.encode_texts(texts, BYTE)) == [x.ids for x in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(texts, WORD).tolist() == [len(x.ids) for x in libraries[1].encode_batch(texts, add_special_tokens=False)]


def test_long_words_are_forgotten(libraries, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_CHARS", 100)
    monkeypatch.setattr(token_counts, "KEEP_CHARS", 100)
    bpe._encoded.cache_clear()
    token_counts._counted.cache_clear()
    for k in range(4):
        texts = [chr(97 + k) * 90, prose(k, 10)]
        assert split(*bpe.encode_texts(texts, BYTE)) == [x.ids for x in libraries[0].encode_batch(texts, add_special_tokens=False)]
        assert token_counts.count_texts(texts, WORD).tolist() == [len(x.ids) for x in libraries[1].encode_batch(texts, add_special_tokens=False)]
    assert len(bpe._encoded(BYTE).known) < 40


def test_forgetting_words_changes_nothing(libraries, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 3)
    monkeypatch.setattr(token_counts, "KEEP", 3)
    bpe._encoded.cache_clear()
    for k in range(4):
        texts = [prose(k, 40), prose(k + 1, 10)]
        assert split(*bpe.encode_texts(texts, BYTE)) == [x.ids for x in libraries[0].encode_batch(texts, add_special_tokens=False)]
        assert token_counts.count_texts(texts, WORD).tolist() == [len(x.ids) for x in libraries[1].encode_batch(texts, add_special_tokens=False)]


def test_encode_and_decode_frames(spark, libraries):
    byte, word = libraries
    docs = documents(spark, CASES)
    rows = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    want = sorted((repr(i), byte.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in CASES)
    assert sorted((repr(r["id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in rows) == want
    counts = token_counts.over(token_counts.count_tokens(docs, WORD), 100).collect()
    assert sorted((repr(r["id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counts) == sorted(
        (repr(i), len((t or "").encode()), n, n > 100) for i, t in CASES
        for n in [len(word.encode(t or "", add_special_tokens=False).ids)])


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert bpe.decode(bpe.encode(docs, BYTE), BYTE).count() == 0
    assert token_counts.count_tokens(docs, WORD).count() == 0
    assert packing.pack(packing.pieces(docs, BYTE, 2)).count() == 0


def test_packing_keeps_all_tokens_in_gapless_sequences(spark, libraries):
    cases = [c for c in CASES if c[0] is not None] + [(100 + k, prose(k, 30 + 37 * k % 900)) for k in range(60)]
    placed = packing.pack(packing.pieces(documents(spark, cases), BYTE, 2, capacity=256), capacity=256, per_packer=40)
    rows = placed.collect()
    ids = {i: libraries[0].encode(t or "", add_special_tokens=False).ids + [2] for i, t in cases if i not in (5, 6)}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, want in ids.items():
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts]).tolist() == want
        assert [r["start"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts])[:-1].tolist()
        assert all(r["length"] == 256 for r in parts[1:]) and len(parts) == -(-len(want) // 256)
    for own in by_seq.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) <= 256
    whole = {r["sequence_id"]: r for r in packing.sequences(placed).collect()}
    for k, own in by_seq.items():
        assert bytes(whole[k]["ids"]) == b"".join(bytes(r["ids"]) for r in own) and whole[k]["length"] * 4 == len(whole[k]["ids"])


def test_packer_is_best_fit_and_closes_the_fullest():
    p = packing.Packer(10, 2)
    assert p.place(6) == (0, 0)         # free 4
    assert p.place(7) == (1, 0)         # free 3
    assert p.place(3) == (1, 7)         # best fit fills bin 1, which closes
    assert p.place(5) == (2, 0)         # free 5
    assert p.place(8) == (3, 0)         # both places taken: bin 0 (free 4) closes
    assert p.place(4) == (2, 5)


def test_packer_needs_few_bins():
    r = np.random.default_rng(0)
    sizes = r.integers(1, 1025, 5000).tolist()
    p = packing.Packer(1024, packing.OPEN_BINS)
    for s in sizes:
        p.place(s)
    assert p.made <= 1.05 * sum(sizes) / 1024


def test_query_digests(spark, sf_small):
    from errlens.llm.queries import QUERIES
    rows = QUERIES["op6_bpe"](spark, sf_small).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    lib = Tokenizer.from_file(BYTE)
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    packed = QUERIES["op1_packing"](spark, sf_small).collect()
    for r in packed:
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="another way"):
        bpe.encode_texts(["a"], WORD)
    with pytest.raises(ValueError, match="another way"):
        token_counts.count_texts(["a"], BYTE)


def test_rows_of_one_id_go_to_all_packers(spark):
    rows = [(None, 0, 100 + k % 300) for k in range(2000)] + [(7, 0, 50 + k % 300) for k in range(2000)] + [(k, 0, 60) for k in range(2000)]
    items = spark.createDataFrame(rows, "id long, piece int, length long").withColumn("start", F.lit(0).cast("long"))
    placed = packing.pack(items, per_packer=750).withColumn("packer", F.shiftright("sequence_id", 40)).collect()
    sizes = np.bincount([r["packer"] for r in placed])
    assert len(sizes) == 8 and sizes.max() < 2 * np.median(sizes) and len(placed) == 6000
