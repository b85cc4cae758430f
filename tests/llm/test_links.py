"""Near-duplicate components, fingerprints and connected components against plain versions."""

import hashlib

import numpy as np
import pytest

from panelcast.llm import hashing, jaccard
from panelcast.llm.hashing import Places, range_hashes
from panelcast.llm.order_minhash import K, PICKS, TUPLES, fingerprint, fingerprints, likeness, numbered_kmers
from panelcast.llm.queries import op7_jaccard_join, op9_order_minhash
from panelcast.llm.shared import connected
from tests.llm.rows import documents, odd_rows, prose
from tests.llm.test_tokens import opposite_words


class Forest(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        self[self.root(a)] = self.root(b)


def plain(rows):
    """Every pair of rows with a common shingle is compared."""
    sets, inverted, forest = [], {}, Forest()
    for k, (_, text, *_) in enumerate(rows):
        w = (text or "").encode().lower().split()
        s = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        common = {}
        for shingle in s:
            for j in inverted.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            inverted[shingle].append(k)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                forest.join(k, j)
        sets.append(s)
    ids = {}
    for k, (doc, *_) in enumerate(rows):
        ids.setdefault(forest.root(k), []).append(doc)
    least = {r: min((d for d in found if d is not None), default=None) for r, found in ids.items()}
    return sorted(((doc, len(s), least[forest.root(k)]) for k, ((doc, *_), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def edited(text, seed, changes):
    rng, w = np.random.default_rng(seed), text.split()
    for at in rng.choice(len(w), changes, replace=False):
        w[at] = f"edit{seed}x{at}"
    return " ".join(w)


def family_rows():
    base, other, passage = prose(1, 150), prose(2, 80), prose(3, 60)
    rows = list(odd_rows())
    rows += [(100 + k, edited(base, k, 1 + k % 6)) for k in range(40)]  # near and not so near
    rows += [(200 + k, base) for k in range(20)]
    rows += [(300 + k, " ".join(base.split()[k * 5 :])) for k in range(12)]  # a chain of ever shorter texts
    rows += [(400 + k, f"{prose(600 + k, 20 + 9 * k)} {passage}") for k in range(30)]  # a passage alone is no link
    rows += [(500 + k, other[: 20 + 6 * k]) for k in range(40)]
    rows += [(600 + k, "one two three four".upper() if k % 2 else "One  two\tthree\nfour") for k in range(4)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_components(spark, monkeypatch, small):
    if small:  # several blocks to a cluster, small groups, stars
        for name, value in (("BLOCK", 8), ("GROUP_MEMBERS", 4), ("PAIRED_GROUPS", 3), ("BEGUN", 2)):
            monkeypatch.setattr(jaccard, name, value)
    rows = family_rows()
    assert found(jaccard.link_documents(documents(spark, rows))) == plain(rows)


def test_one_frequent_token_orders_all_alike(spark):
    common = prose(4, 40)
    rows = [(k, f"{common} {prose(700 + k, 4)}" if k % 3 else f"{prose(700 + k, 30)} {common}") for k in range(150)]
    assert found(jaccard.link_documents(documents(spark, rows))) == plain(rows)


def test_no_documents(spark):
    assert found(jaccard.link_documents(documents(spark, []))) == []
    assert fingerprints(documents(spark, [])).collect() == []


def test_given_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op7_jaccard_join(spark, sf)) == plain(rows)


def test_components_of_one_block_are_exact():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        base = rng.integers(0, 1 << 60, 60, np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(30, 60), replace=False), rng.integers(0, 1 << 60, rng.integers(0, 9), np.uint64)])) for _ in range(30)]
        forest = Forest()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                n = len(np.intersect1d(a, b))
                if 100 * n >= 75 * (len(a) + len(b) - n):
                    forest.join(i, j)
        got = jaccard.components(sets)[0]
        assert len({(forest.root(k), got[k]) for k in range(30)}) == len({forest.root(k) for k in range(30)}) == len(set(got))


def test_connected(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    forest = Forest()
    for a, b in edges:
        forest.join(a, b)
    labels = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(labels) == {x for a, b in edges if a != b for x in (a, b)}
    assert len({(forest.root(n), l) for n, l in labels.items()}) == len({forest.root(n) for n in labels}) == len(set(labels.values()))


def test_hash_table_and_range_hashes():
    data = np.frombuffer(b"the cat the dog the cat", np.uint8)
    h = range_hashes(data, np.array([0, 4, 5, 5, 8, 12, 16, 20]), np.array([3, 7, 5, 7, 11, 15, 19, 23]))
    assert h[0] == h[4] == h[6] and h[1] == h[7] and len(set(h.tolist())) == 5
    table, keys = Places(6), np.random.default_rng(1).integers(1, 1 << 63, 40, np.uint64) >> np.uint64(50) << np.uint64(50) | np.arange(1, 41, dtype=np.uint64)
    slots = dict(zip(keys[:30].tolist(), [*table.add(keys[:25]), *table.add(keys[25:30])], strict=True))  # many begin at one slot
    assert table.find(keys).tolist() == [slots.get(int(k), -1) for k in keys]


def test_range_polynomials_are_those_of_the_ranges(monkeypatch):
    def plain(part):
        return sum((int(b) + 1) * pow(hashing.BASE, j, int(hashing.P)) for j, b in enumerate(part)) % int(hashing.P)

    data = np.random.default_rng(2).integers(0, 256, 900).astype(np.uint8)
    starts = np.sort(np.random.default_rng(3).integers(0, 700, 120))
    ends = starts + np.arange(120) % 190
    for block in (1 << 19, 40):  # in one block; in several, with ranges longer than a block
        monkeypatch.setattr(hashing, "BLOCK", block)
        assert hashing.range_polynomials(data, starts, ends).tolist() == [plain(data[a:b]) for a, b in zip(starts, ends, strict=True)]


def test_opposite_words_are_no_copies(spark):
    a, b = opposite_words()
    rows = [(1, a), (2, b), (3, f"{a} {a} {a} {a} {a}"), (4, f"{b} {b} {b} {b} {b}")]
    assert found(jaccard.link_documents(documents(spark, rows))) == plain(rows)


def plain_fingerprint(text, k, tuples, picks):
    """Order MinHash by its definition, with strings: numbered k-mers, the least of each part, in text order."""
    size = min(k, len(text))
    seen, kmers = {}, []
    for i in range(len(text) - size + 1 if text else 0):
        own = text[i : i + size]
        seen[own] = seen.get(own, -1) + 1
        kmers.append((own, seen[own]))
    hashes = dict(zip(kmers, numbered_kmers(text, k).tolist(), strict=True))  # any hash will do; this one names the parts
    out = []
    for part in range(tuples):
        least = sorted(kmers, key=hashes.get)
        least = [m for m in least if hashes[m] * tuples >> 64 == part][:picks]
        out.append(tuple(m for m in kmers if m in least))
    return out


def test_order_minhash_by_its_definition():
    """Equal tuples of k-mers in equal order, and only these, have equal numbers."""
    base = prose(5, 60)
    texts = [base, base[:200] + "x" + base[200:], base[::-1], "ab" * 50, "ba" * 50, "abc", "", "a" * 40, prose(6, 30), prose(6, 30) + " end"]
    prints = [fingerprint(t) for t in texts]
    plain = [plain_fingerprint(t, K, TUPLES, PICKS) for t in texts]
    for numbers, tuples in zip(prints, plain, strict=True):
        assert [n == 0 for n in numbers] == [not t for t in tuples]
    both = {}
    for numbers, tuples in zip(prints, plain, strict=True):
        for part, (n, t) in enumerate(zip(numbers.tolist(), tuples, strict=True)):
            if t:
                both.setdefault((part, t), set()).add(n)
    assert all(len(ns) == 1 for ns in both.values())  # one tuple, one number
    for a in range(len(texts)):
        for b in range(len(texts)):
            equal = [x == y for x, y in zip(plain[a], plain[b], strict=True) if x or y]
            share = sum(equal) / len(equal) if equal else 1.0
            assert likeness(prints[a], prints[b]) == pytest.approx(share, abs=0.02)  # 16 bits may meet by chance


def test_fingerprints(spark):
    rows = [*odd_rows(), *((k, prose(k, k)) for k in range(20, 60)), (60, prose(5, 200)), (61, edited(prose(5, 200), 1, 4))]
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = fingerprints(documents(spark, rows).repartition(3)).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == [(r[0] is not None, r[0] or 0) for r in expected]
    by_id, texts = {r["doc_id"]: r for r in got}, {r[0]: r[1] for r in rows}
    ids = list(range(20, 62))
    for doc, following in zip(ids, ids[1:], strict=False):
        text, half = texts[doc], len(texts[doc]) // 2
        changed = text[: len(text) - half] + texts[following][:half]
        r, own, second = by_id[doc], fingerprint(text), fingerprint(changed)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r["near_edited"] == likeness(own, second) and r["near_next"] == likeness(own, fingerprint(texts[following]))
        assert r["fingerprint"] == own.astype(">u2").tobytes().hex() and r["edited_fingerprint"] == second.astype(">u2").tobytes().hex()
    last = by_id[61]
    first = min((t or "" for d, t, *_ in rows if d is None), key=len)  # either row without an id comes first
    half = len(texts[61]) // 2
    ends = {texts[61][: len(texts[61]) - half] + (t or "")[:half] for d, t, *_ in rows if d is None}
    assert first == "" and last["edited_sha256"] in {hashlib.sha256(e.encode()).hexdigest() for e in ends}
    assert by_id[60]["near_next"] > 0.3 and by_id[59]["near_next"] < 0.2


def test_order_and_repeats_count():
    a, b = prose(1, 80), prose(2, 80)
    assert (fingerprint(a + b) == fingerprint(a + b)).all()
    assert likeness(fingerprint(a + " " + b), fingerprint(b + " " + a)) < 0.9  # a set of k-mers would hardly differ
    assert likeness(fingerprint("abcdefgh" * 20), fingerprint("abcdefgh" * 60)) < 0.7
    near = [likeness(fingerprint(a), fingerprint(edited(a, 3, n))) for n in (1, 6, 30)]
    assert near == sorted(near, reverse=True)
    assert likeness(fingerprint(""), fingerprint("")) == 1 and likeness(fingerprint(""), fingerprint("x")) == 0


def test_given_texts_have_fingerprints(spark, sf):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(rows)
    got = {r["doc_id"]: r for r in op9_order_minhash(spark, sf).collect()}
    prints = {}
    for doc, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, half = rows[doc], len(rows[doc]) // 2
        changed = text[: len(text) - half] + rows[following][:half]
        assert (got[doc]["n_chars"], got[doc]["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert prints.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]
        assert 0 <= got[doc]["near_edited"] <= 1 and 0 <= got[doc]["near_next"] <= 1
