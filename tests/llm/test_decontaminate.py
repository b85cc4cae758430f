"""Benchmark windows against a dictionary of all windows."""

import hashlib
import random
import re

import pytest
from pyspark import SparkContext

from panelcast.llm.decontaminate import SuffixAutomaton, find_windows, folded, remove_windows, without_windows
from panelcast.llm.queries import op10_decontamination
from tests.llm.rows import documents, odd_rows, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(items, size):
    out = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if w else ():
            out.setdefault(tuple(w[k : k + n]), set()).update([] if item is None else [item])
    return out


def plain(text, known):
    w, hit, items = words(text), set(), set()
    for n in {len(k) for k in known}:
        for k in range(len(w) - n + 1):
            if (which := known.get(tuple(w[k : k + n]))) is not None:
                hit.update(range(k, k + n))
                items |= which
    return len(w), hit, items


ITEMS = [
    (1, prose(7, 14)), (2, prose(7, 14) + " and more " + prose(8, 6)), (3, "Tiny item"), (4, None), (5, ""), (None, prose(9, 12)),
    (6, "again again again again again again again again again again again again"), (6, prose(11, 11)), (7, "river"), (8, "é ß ü 漢字 9"),
]


def texts():
    quote = prose(7, 14)
    out = [t for _, t, *_ in odd_rows()]
    out += [quote, prose(1, 9) + " " + quote.upper() + "!! " + prose(2, 9), quote[: len(quote) // 2], "again " * 30, "TINY, item; tiny item", "é ß ü 漢字 9 x", prose(9, 12)]
    return out + [" ".join(words(quote)[:9]) + " " + prose(5, 20), "-".join(words(prose(8, 6) + prose(11, 11))) * 2]


@pytest.mark.parametrize("share", [1 << 20, 4])
def test_cases(spark, share):
    docs = documents(spark, list(enumerate(texts())))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    known = windows(ITEMS, 10)
    found = find_windows(docs, items, shard_words=share).collect()
    assert len(found) == len(texts())
    for r in found:
        n, hit, which = plain(texts()[r["doc_id"]], known)
        assert (r["n_words"], sorted(r["item_ids"])) == (n, sorted(which))
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert {k for a, b in spans for k in range(a, b)} == hit
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_large_item_ids_next_to_null(spark):
    big = (1 << 53) + 1
    items = spark.createDataFrame([(big, prose(7, 14)), (None, prose(9, 12)), (-big, prose(8, 14))], "item_id long, text string")
    docs = documents(spark, [(1, prose(7, 14)), (2, prose(9, 12)), (3, prose(8, 14) + ". " + prose(7, 14))])
    found = {r["doc_id"]: r["item_ids"] for r in find_windows(docs, items).collect()}
    assert found == {1: [big], 2: [], 3: [-big, big]}


def test_automaton_against_all_windows():
    rng = random.Random(5)
    for trial in range(60):
        size, letters = rng.randint(2, 6), "abcd"[: rng.randint(1, 4)]
        items = [(rng.choice([None, k]), " ".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))) for k in range(rng.randint(0, 6))]
        automaton, known = SuffixAutomaton([(i, folded(t).split()) for i, t in items], size), windows(items, size)
        texts = [" ".join(rng.choice("abcdz") for _ in range(rng.randint(0, 40))) for _ in range(8)]
        for text, (spans, which) in zip(texts, automaton.find_all([folded(t).split() for t in texts]), strict=True):
            _, hit, want = plain(text, known)
            assert {k for a, b in spans for k in range(a, b)} == hit and which == want
            assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_a_large_share_takes_little_memory():
    """About 110 bytes a word, as a worker holds them, beside the vocabulary."""
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(5000)]
    items = [(k, [rng.choice(vocabulary).encode() for _ in range(100)]) for k in range(500)]
    made = SuffixAutomaton(items, 10)
    words = sum(len(w) for _, w in items)
    made.find([b"w1"] * 12)
    held = sum(x.nbytes for x in (made.link, made.length, made.top, made.short, made.keys, made.targets, made.pairs, made._places.keys, made._target))
    assert held < 125 * words and not made.ends


def test_nothing_known(spark):
    docs, none = documents(spark, odd_rows()), spark.createDataFrame([], "item_id long, text string")
    assert all(r["spans"] == [] and r["item_ids"] == [] for r in find_windows(docs, none).collect())
    assert sorted(remove_windows(docs, none).collect(), key=repr) == sorted(docs.collect(), key=repr)
    assert find_windows(docs.limit(0), none).collect() == []


def test_removal_leaves_no_window_and_clean_texts_alone(spark):
    rows = list(enumerate(texts()))
    docs, items = documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")
    known = windows(ITEMS, 10)
    kept = {r["doc_id"]: r for r in remove_windows(docs, items).collect()}
    for doc, text in rows:
        n, hit, _ = plain(text, known)
        if len(hit) > 0.8 * n and text:
            assert doc not in kept
        elif not hit:
            assert kept[doc]["text"] == text and kept[doc]["salt"] == "x"
        else:
            assert not plain(kept[doc]["text"], known)[1]
            rest = words(text)
            for w in words(kept[doc]["text"]):
                rest.remove(w)


def split_items():
    """Two items of different words whose ends overlap, and documents that need both to be judged and cut."""
    a, b = [f"a{k}" for k in range(12)], [f"b{k}" for k in range(12)]
    both = [*a, *b]
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(both[7:19])), (4, " ".join(f"c{k}" for k in range(10)))]
    c = [f"c{k}" for k in range(10)]
    bodies = [both, ["x", "y", "z", "u", "v", "w", *both[:19], "and", "then", "some", "more"], [*(f"own{k}" for k in range(9)), *c[:5], *a, *c[5:], "the", "end"]]
    return items, [(k, " ".join(words)) for k, words in enumerate(bodies)]


def test_removal_is_the_same_with_any_number_of_shards(spark):
    for items, rows in ((ITEMS, list(enumerate(texts()))), split_items()):
        docs, known = documents(spark, rows).unionByName(documents(spark, rows[-1:])), spark.createDataFrame(items, "item_id long, text string")
        one = remove_windows(docs, known)
        many = remove_windows(docs, known, shard_words=4)
        assert many.columns == one.columns
        assert sorted(many.collect(), key=repr) == sorted(one.collect(), key=repr)
    assert {r["doc_id"]: r["text"].split() for r in many.collect()} == {1: [*"xyzuvw", "and", "then", "some", "more"], 2: [*(f"own{k}" for k in range(9)), "the", "end"]}


def test_the_driver_holds_one_automaton_at_a_time(spark, monkeypatch):
    live, most, fetched = set(), [], SparkContext.broadcast

    def broadcast(self, value):
        sent = fetched(self, value)
        if isinstance(value, bytes):
            live.add(id(sent))
            most.append(len(live))
            release = sent.destroy
            sent.destroy = lambda *a, **b: (live.discard(id(sent)), release(*a, **b))
        return sent

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    items, rows = split_items()
    found = find_windows(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), shard_words=4)
    assert [len(r["item_ids"]) for r in found.orderBy("doc_id").collect()] == [3, 2, 1]
    assert len(most) > 1 and max(most) == 1


def test_ends_that_cutting_joins_are_cut_too():
    inner = [f"w{k}" for k in range(10)]
    automaton = SuffixAutomaton([(1, folded(" ".join(inner)).split())], 10)
    nested = " ".join(["before it all stays here", *inner[:5], *inner, *inner[5:], "and so does this after it"])
    assert without_windows(automaton, nested, 0.9).split() == "before it all stays here and so does this after it".split()


def test_given_documents(spark, sf):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    known = windows(items, 10)
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op10_decontamination(spark, sf).collect()
    assert len(found) == len(rows)
    for r in found:
        n, hit, which = plain(rows[r["doc_id"]], known)
        digest = hashlib.sha256(",".join(sorted(map(str, which))).encode()).hexdigest()
        assert tuple(r)[1:] == (n, len(hit), len(which), digest, bool(hit))
