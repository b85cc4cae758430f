"""Vector packing: every id once, all limits kept, no padding, and the heuristic against a plain version."""

import zlib

import numpy as np
import pytest

from panelcast.llm.packing import sequences
from panelcast.llm.queries import op13_vector_packing, tokenizer_path
from panelcast.llm.vector_packing import Example, Limits, Pool, dialogues, fill, pack_examples
from tests.llm.rows import documents, odd_rows, prose
from tests.llm.test_tokens import BYTES, whole


def examples(sizes, loss=None):
    """Examples of the given sizes, of which every loss-th token bears loss."""
    out = []
    for k, n in enumerate(sizes):
        bearing = None if loss is None else np.concatenate([[0], np.cumsum(np.arange(n) % loss == 0)])
        out.append(Example(k, np.arange(n, dtype="<u4"), bearing, 0, n))
    return out


def by_sequence(rows):
    out = {}
    for r in rows:
        out.setdefault(r["sequence_id"], []).append(r)
    return out


def check_places(rows, limits, padded=False):
    for pieces in by_sequence(rows).values():
        pieces.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in pieces)
        assert [r["offset"] for r in pieces] == [sum(r["length"] for r in pieces[:k]) for k in range(len(pieces))]
        assert total <= limits.tokens and len(pieces) <= limits.segments and sum(r["loss"] for r in pieces) <= limits.loss
        assert padded or total == limits.tokens or total & (total - 1) == 0


def check_ids(rows, expected):
    """``expected``: the ids of each document, keyed as the rows are."""
    docs = {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
    assert docs.keys() == expected.keys()
    for key, ids in expected.items():
        at = 0
        for r in sorted(docs[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def ids_of(text):
    return np.array([*whole(BYTES, text), 1], "<u4")


@pytest.mark.parametrize("limits", [Limits(64, 4, 64), Limits(64, 64, 64), Limits(64, 1, 64), Limits(64, 5, 40)])
def test_every_id_once_and_no_padding(spark, limits):
    rows = [(k, prose(k, 1 + k % 60)) for k in range(200)] + [(500 + k, "x") for k in range(100)] + [(900, prose(9, 3000)), (901, None), (902, "")]
    got = pack_examples(documents(spark, rows), tokenizer_path(BYTES), limits).collect()
    check_places(got, limits)
    check_ids(got, {d: ids_of(t) for d, t in rows})


def test_odd_documents(spark):
    df = documents(spark, odd_rows())
    got = pack_examples(df, tokenizer_path(BYTES), Limits(128, 8, 128)).collect()
    check_places(got, Limits(128, 8, 128))
    tokens = lambda d: sum(len(ids_of(t)) for k, t, *_ in odd_rows() if k == d)
    for doc in {r[0] for r in odd_rows()}:
        assert sum(r["length"] for r in got if r["doc_id"] == doc) == tokens(doc)
    assert pack_examples(df.limit(0), tokenizer_path(BYTES)).collect() == []
    with pytest.raises(ValueError):
        pack_examples(df, tokenizer_path(BYTES), Limits(segments=0))


def test_whole_documents_mostly_stay_whole(spark):
    rows = [(k, prose(k, 3 + k % 50)) for k in range(600)]
    got = pack_examples(documents(spark, rows).coalesce(1), tokenizer_path(BYTES), Limits(512, 64, 512)).collect()
    assert len(got) <= len(rows) + len(by_sequence(got)) + 12  # a cut a sequence, and the last powers of two


def test_limits_on_loss_and_segments(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", prose(100 * c + t, 5 + (7 * t + c) % 30)) for c in range(30) for t in range(6)]
    turns += [(0, 1, "assistant", turns[1][3]), (77, None, None, None), (None, 0, "assistant", "no id"), (5, 200, "assistant", "far on")]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    made = dialogues(table, turns=4)
    texts = {(r["doc_id"]["conv_id"], r["doc_id"]["block"]): [(p["text"], p["loss"]) for p in r["parts"]] for r in made.collect()}
    assert texts[0, 0] == [(t[3], t[2] == "assistant") for t in turns[:4]] and texts[5, 50] == [("far on", True)] and texts[77, 0] == [("", False)]
    limits = Limits(96, 6, 30)
    got = [r.asDict(recursive=True) for r in pack_examples(made, tokenizer_path(BYTES), limits, keep_ids=True).collect()]
    check_places(got, limits)
    for key, parts in texts.items():
        ids = [whole(BYTES, t) for t, _ in parts]
        flat, bears = [*sum(ids, []), 1], [b for i, (_, b) in zip(ids, parts, strict=True) for _ in i] + [parts[-1][1]]
        own = sorted((r for r in got if (r["doc_id"]["conv_id"], r["doc_id"]["block"]) == key), key=lambda r: r["start"])
        assert np.frombuffer(b"".join(r["ids"] for r in own), "<u4").tolist() == flat
        assert all(r["loss"] == sum(bears[r["start"] : r["start"] + r["length"]]) for r in own)


def test_sequences_hold_the_ids(spark):
    rows = [(k, prose(k, 4 + k)) for k in range(40)]
    packed = pack_examples(documents(spark, rows), tokenizer_path(BYTES), Limits(64, 8, 64), keep_ids=True)
    assert all(len(r["ids"]) == 4 * sum(r["lengths"]) for r in sequences(packed).collect())


def plain_choice(held, left, limits):
    """The example that fits whole with the largest dot product of demand and what is left, weighted by the pool's demand."""
    limit = (limits.tokens, limits.segments, limits.loss)
    demand = [(e.tokens, 1, e.loss) for e in held]
    weight = [sum(d[j] for d in demand) / limit[j] for j in range(3)]
    fitting = [k for k, d in enumerate(demand) if all(d[j] <= left[j] for j in range(3))]
    return max(fitting, key=lambda k: sum(weight[j] * demand[k][j] / limit[j] * left[j] / limit[j] for j in range(3)), default=None)


def test_choice_is_the_largest_dot_product():
    rng, limits = np.random.default_rng(3), Limits(100, 10, 60)
    for trial in range(60):
        held = examples(rng.integers(1, 90, 20).tolist(), 2 + trial % 3)
        pool = Pool(limits)
        for e in held:
            pool.add(e)
        left = np.array([rng.integers(1, 101), rng.integers(2, 11), rng.integers(1, 61)], float)
        at, fits = pool.best(left)
        wanted = plain_choice(held, left, limits)
        if wanted is None:
            assert not fits
        else:
            score = lambda k: held[k].tokens  # noqa: E731  equal products can differ in the last bit
            assert fits and (at == wanted or score(at) == score(wanted))


def test_a_pool_is_emptied_into_powers_of_two():
    limits = Limits(64, 3, 64)
    pool = Pool(limits)
    for e in examples([50, 7, 3, 1, 1, 30]):
        pool.add(e)
    made = []
    while len(pool):
        made.append(fill(pool, limits))
    totals = [sum(p.tokens for p in s) for s in made]
    assert sum(totals) == 92 and all(t == 64 or t & (t - 1) == 0 for t in totals)
    assert all(len(s) <= 3 for s in made)


def test_given_documents(spark, sf):
    given = {r["doc_id"]: ids_of(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_vector_packing(spark, sf).collect()
    check_places(got, Limits())
    check_ids(got, given)
