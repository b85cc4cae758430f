"""Packing and token records against the tokenizers library on whole texts."""

import zlib
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelcast.llm.encode import Encoder
from panelcast.llm.packing import best_fit_decreasing, bin_bound, pack, sequences, token_pieces
from panelcast.llm.queries import tokenizer_path
from panelcast.llm.records import frame, frame_at, ids_of, read_records, token_starts, write_index, write_records
from panelcast.session import new_path
from tests.llm.rows import documents, odd_rows, prose

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


@lru_cache
def library(name):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


def whole(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = [t for _, t, *_ in odd_rows() if t is not None]
    texts += ["a  b", " a", "a ", "a\n\nb", "a \n b", "don't, we'll. it's!! 3.14 A-B", "x.y;z", "\0a b", "ǅ Σς", "a\tb\x1cc", "1,000.50%", "é.à,b"]
    encoder = Encoder(tokenizer_path(name))
    for _ in range(2):  # unseen, then remembered
        assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode(texts)] == [whole(name, t) for t in texts]


def test_a_long_text_is_cut_at_spaces(monkeypatch):
    monkeypatch.setattr("panelcast.llm.encode.SEGMENT", 50)
    text = prose(3, 300)
    assert np.frombuffer(Encoder(tokenizer_path(BYTES)).encode([text])[0], "<u4").tolist() == whole(BYTES, text)


def opposite_words(n=12):
    """Two different words of 2**n letters that every polynomial hash modulo 2**64 confuses."""
    bits = [0]
    for _ in range(n):
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_different_words_have_their_own_ids(name):
    a, b = opposite_words()
    encoder = Encoder(tokenizer_path(name))
    assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode([a, b, f"{b} {a}"])] == [whole(name, t) for t in (a, b, f"{b} {a}")]


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_pieces_of_one_hash_are_told_apart(name, monkeypatch):
    monkeypatch.setattr("panelcast.llm.encode.range_hashes", lambda data, starts, ends: np.full(len(starts), 12, np.uint64))
    texts = ["green trees, and rivers", "trees of green", " early", "early early", "x" * 300 + " y"]
    encoder = Encoder(tokenizer_path(name))
    for _ in range(2):
        assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode(texts)] == [whole(name, t) for t in texts]


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_a_full_memory_keeps_frequent_pieces(name, monkeypatch):
    monkeypatch.setattr("panelcast.llm.encode.MEMO_BITS", 8)
    encoder = Encoder(tokenizer_path(name))
    for k in range(30):
        texts = [prose(k, 40), " ".join(f"new{k}x{j}" for j in range(20)), "again " * 3 + "again"]
        assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode(texts)] == [whole(name, t) for t in texts]
    assert encoder.places.size < 256


def test_pieces_of_opposite_words(spark):
    a, b = opposite_words()
    rows = [(1, a), (2, b)]
    got = {r["doc_id"]: r["ids_crc32"] for r in token_pieces(documents(spark, rows), tokenizer_path(BYTES), 1 << 20).collect()}
    assert got == {d: zlib.crc32(np.array([*whole(BYTES, t), 0], "<u4").tobytes()) for d, t in rows}


def pieces_of(rows, capacity):
    out = []
    for doc, text, *_ in rows:
        ids = np.array([*whole(BYTES, text), 0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        out += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


@pytest.mark.parametrize("group", [1 << 16, 3])
def test_every_piece_has_its_place(spark, group):
    rows = [*odd_rows(), *((k, prose(k, 5 + k % 60)) for k in range(20, 80))]
    packed = pack(token_pieces(documents(spark, rows), tokenizer_path(BYTES), 64), 64, group).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in packed), key=key) == sorted(pieces_of(rows, 64), key=key)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 64
    bound = bin_bound(np.array([r["length"] for r in packed]), 64)
    alone = best_fit_decreasing(np.array([r["length"] for r in packed]), 64)[2]
    assert bound <= len(bins) <= (len(alone) if group > 100 else 1.15 * len(alone))


def test_groups_with_a_gap_exchange_pieces(spark):
    """Groups that alone need a bin more than their bound give sequences back when they exchange pieces."""
    rng = np.random.default_rng(8)
    sizes = rng.choice([33, 34, 21, 22, 11, 12, 40, 24], 600).tolist()
    pieces = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "doc_id long, length long")
    number = lambda rounds: pack(pieces, 64, 20, rounds).select("sequence_id").distinct().count()
    once, again, whole = number(1), number(4), pack(pieces, 64).select("sequence_id").distinct().count()
    assert bin_bound(np.array(sizes), 64) <= whole <= again < once


def test_sequences_hold_the_ids(spark):
    rows = [(k, prose(k, 4 + k)) for k in range(12)]
    packed = pack(token_pieces(documents(spark, rows), tokenizer_path(BYTES), 64, keep_ids=True), 64)
    total = sum(len(whole(BYTES, t)) + 1 for _, t in rows)
    made = sequences(packed).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * total
    assert all(sum(r["lengths"]) * 4 == len(r["ids"]) <= 256 for r in made)


def test_no_documents(spark):
    empty = documents(spark, [])
    assert pack(token_pieces(empty, tokenizer_path(BYTES))).collect() == []
    files = new_path(spark, "r")
    write_records(empty, files, tokenizer_path(WORDS))
    assert token_starts(write_index(spark, files, new_path(spark, "i"))).collect() == []


def test_taken_names_raise(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 2)], "length long, offset long"))


def test_bound_and_packing_agree_where_the_best_is_known():
    assert bin_bound(np.array([6, 6, 4, 4]), 10) == 2 == len(best_fit_decreasing(np.array([6, 6, 4, 4]), 10)[2])
    assert bin_bound(np.array([6, 6, 6]), 10) == 3  # the sum alone says 2
    assert bin_bound(np.array([4, 4, 4, 4, 4]), 10) == 3  # two fours a bin
    rng = np.random.default_rng(5)
    for _ in range(50):
        sizes = rng.integers(1, 40, rng.integers(1, 60))
        bins, offsets, left = best_fit_decreasing(sizes, 40)
        assert bin_bound(sizes, 40) <= len(left)
        assert np.bincount(bins, sizes).tolist() == (40 - left).tolist() and (left >= 0).all()


def test_records_round_trip(spark):
    rows = odd_rows()
    files, index_path = new_path(spark, "r"), new_path(spark, "i")
    write_records(documents(spark, rows), files, tokenizer_path(WORDS), shard_bytes=20_000)
    index = write_index(spark, files, index_path)
    found = sorted(token_starts(index).collect(), key=lambda r: r["start"])
    assert index.select("file").distinct().count() > 1
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    expected = sorted((-1 if d is None else d, zlib.crc32(np.array([*whole(WORDS, t), 1], "<u4").tobytes())) for d, t, *_ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids_crc32"]) for r in found) == expected
    a, b = opposite_words()
    other = new_path(spark, "r")
    write_records(documents(spark, [(1, a), (2, b)]), other, tokenizer_path(WORDS))
    assert [r["ids_crc32"] for r in token_starts(write_index(spark, other, new_path(spark, "i"))).orderBy("doc_id").collect()] == [zlib.crc32(np.array([*whole(WORDS, t), 1], "<u4").tobytes()) for t in (a, b)]
    drawn = index.where("doc_id IN (4, 8)").orderBy("ids_crc32")
    crcs = sorted(r["ids_crc32"] for r in drawn.collect())
    assert sorted(zlib.crc32(r["ids"]) for r in read_records(spark, files, drawn).collect()) == crcs


def test_damage_is_found():
    record = frame(5, np.arange(9, dtype="<u4").tobytes())
    assert ids_of(frame_at(record, 0)[0])[1].tolist() == list(range(9))
    assert ids_of(frame_at(frame(None, np.array([70_000], "<u4").tobytes()), 0)[0])[0] is None
    for at in range(len(record)):
        with pytest.raises(ValueError):
            frame_at(record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :], 0)
