"""Collocations against a plain count of all runs, on cases and on the given documents."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import collocations as C
from panelcast.llm.collocations import chunks, frequent_phrases, lowered, mine_collocations, word_ids
from panelcast.llm.queries import op12_collocations
from tests.llm.rows import documents, odd_rows, prose

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, max_words=5, min_count=100, top=2000):
    """lang, rank, phrase, a, l, r, n, score with every run in a dictionary; rows are (text, lang)."""
    runs, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            runs.update((lang, tuple(words[i : i + n])) for n in range(1, max_words + 1) for i in range(len(words) - n + 1))
    often = {run: a for run, a in runs.items() if a >= min_count}
    inside = {}
    for (lang, words), a in often.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                key = lang, words[i : i + m]
                inside[key] = max(inside.get(key, 0), a)
    found = {}
    for (lang, words), a in often.items():
        if len(words) > 1 and 100 * inside.get((lang, words), 0) < 100 * a:
            n = totals[lang]
            cuts = [(1000 * a * n // (runs[lang, words[:k]] * runs[lang, words[k:]]), k, runs[lang, words[:k]], runs[lang, words[k:]]) for k in range(1, len(words))]
            score, _, l, r = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, n))
    out = []
    for lang, held in found.items():
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r, n) in enumerate(sorted(held)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def rows():
    """Repeated phrases among prose, in two languages and none, with marks, runs of blanks and overlaps."""
    out = [(k, f"{prose(k, 30)} New  York\tCity is, New york city; a a a a a b. {prose(500 + k, 10)}", ("en", "fr", None)[k % 3], "s") for k in range(60)]
    out += [(100 + k, "Ça va: ça va! ÇA VA ça va new\x0byork", "fr", "s") for k in range(20)]
    return out + [(200, "a " * 3000 + "end", "en", "s"), (201, "word", "", "s")]


@pytest.mark.parametrize("max_words", [2, 3, 5])
def test_cases(spark, max_words):
    given = rows() + [(r[0], r[1], *(r[2:4] or ("en", "a"))) for r in odd_rows()]
    got = mine_collocations(documents(spark, given), max_words, 12)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(got) == plain([(t, lang) for _, t, lang, _ in given], max_words, 12)


def test_ties_are_ranked_by_phrase_and_the_rest_is_cut(spark):
    given = [(k, " ".join(f"x{k}w{j} y{k}w{j}." for j in range(9)) + f" é{k} z. a{k} B{k}.", "en", "s") for k in range(40)] * 3
    got = found(mine_collocations(documents(spark, given), 3, 3, 50))
    assert got == plain([(t, "en") for _, t, *_ in given], 3, 3, 50) and len(got) == 50


def test_ranking_in_shares(spark, monkeypatch):
    monkeypatch.setattr(C, "RANKED", 40)
    given = [(k, f"p{k} q{k}. {prose(k % 7, 12)}", "en", "s") for k in range(120)] * 3
    assert found(mine_collocations(documents(spark, given), 4, 3, 20)) == plain([(t, "en") for _, t, *_ in given], 4, 3, 20)


def test_no_documents_and_no_frequent_phrase(spark):
    assert mine_collocations(documents(spark, [])).collect() == []
    assert mine_collocations(documents(spark, odd_rows()[:4])).collect() == []
    blank = documents(spark, [(1, None), (2, ""), (3, " ,\n.\t")])
    assert mine_collocations(blank).collect() == [] and frequent_phrases(blank)[1].collect() == []
    with pytest.raises(ValueError):
        frequent_phrases(documents(spark, []), 1)


def test_pointers_lead_to_the_phrase(spark):
    given = rows()
    phrases, totals = frequent_phrases(documents(spark, given), 3, 12)
    texts = {d: t for d, t, *_ in given}
    for r in phrases.collect():
        words = re.findall("[^ \t.,;:!?\n-\r]+", texts[r["pointer"]["doc_id"]].translate(UPPER))
        assert " ".join(words[r["pointer"]["word"] : r["pointer"]["word"] + r["n_words"]]) == r["phrase"]
    assert {r["lang"] for r in totals.collect()} == {"en", "fr", "und", ""}


class Open:
    """A gate that lets everything through."""

    bits = 1

    def passes(self, fps):
        return np.ones(len(fps), bool)


def words_of(texts, languages=None):
    data, edges = lowered(pa.array(texts, pa.string()))
    return C.Words.of(data, edges, np.array(languages or [0] * len(texts), np.uint64))


def plain_runs(texts, languages, n):
    runs = Counter()
    for text, language in zip(texts, languages, strict=True):
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = re.findall("[^ \t]+", piece)
            runs.update((language, " ".join(w[i : i + n])) for i in range(len(w) - n + 1))
    return runs


@pytest.mark.parametrize("collide", [False, True])
def test_colliding_fingerprints_are_told_apart_by_the_text(monkeypatch, collide):
    texts = ["The cat, the dog the  cat", None, "", "dog\tthe cat. the", "cat", " ", "THE dog the dog!"]
    languages = [1, 1, 1, 2, 2, 2, 1]
    if collide:
        monkeypatch.setattr(C, "range_polynomials", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(2))
        monkeypatch.setattr(C.Words, "fingerprints", lambda self, at, n: np.full(len(at), n, np.uint64))
    words = words_of(texts, languages)
    ids = word_ids(words)
    for n in (1, 2, 3):
        fps, model, counts = C.occurrences(words, ids, n, [Open()] * 3)
        assert len(fps) == len(model)
        got = Counter()
        for k, c in zip(model.tolist(), counts.tolist(), strict=True):
            got[int(words.language[k]), words.data[words.start[k] : words.end[k + n - 1]].tobytes().decode()] += c
        assert got == plain_runs(texts, languages, n)


@pytest.mark.parametrize("collide", [False, True])
def test_entries_are_merged_by_their_texts(monkeypatch, collide):
    texts, langs = ["The cat, the dog the  cat", None, "dog\tthe cat. the", "THE dog the dog!"], ["en", "en", "", "é"]
    if collide:
        monkeypatch.setattr(C.Words, "fingerprints", lambda self, at, n: np.full(len(at), n % 2, np.uint64))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8, None, 9], pa.int64()), pa.array(langs)], names=["doc_id", "lang"])
    parts = [C._entries(batch, 0, words_of(texts, [1, 1, 2, 3]), range(1, 4), [Open()] * 3) for _ in range(2)]
    whole = C.merged([C.Entries.load(C.merged([p]).dump()) for p in parts])
    got = {}
    for k in range(len(whole.fp)):
        lang, _, phrase = whole.data[whole.start[k] : whole.start[k] + whole.size[k]].tobytes().partition(b"\xff")
        assert (lang, phrase) not in got
        got[lang, phrase] = int(whole.count[k])
        assert not phrase or bool(whole.known[k]) == (lang != b"")
    want = Counter()
    for n in (1, 2, 3):
        for (k, run), c in plain_runs(texts, range(4), n).items():
            want[langs[k].encode(), run.encode()] += 2 * c
            if n == 1:
                want[langs[k].encode(), b""] += 2 * c
    assert got == want


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 64)
    texts = [prose(1, 100), "short", None, "x" * 300, "y" * 50 + ". z", "", prose(2, 60).replace(".", " ").replace(",", " ")]
    data, edges = lowered(pa.array(texts, pa.string()))
    runs, at_text = Counter(), {}
    for at, part, part_edges in chunks(data, edges):
        w = C.Words.of(part, part_edges, np.zeros(len(part_edges) - 1, np.uint64))
        at_text[at] = at_text.get(at, b"") + part.tobytes()
        starts, _ = w.candidates(2, [Open()] * 2)
        runs.update(w.data[w.start[k] : w.end[k + 1]].tobytes().decode() for k in starts.tolist())
    assert b"".join(at_text[k] for k in sorted(at_text)) == data.tobytes()
    assert runs == Counter({run: c for (_, run), c in plain_runs(texts, [0] * len(texts), 2).items()})


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    given = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(op12_collocations(spark, sf)) == plain(given)
