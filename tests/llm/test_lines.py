"""Line dedup against a plain version, on cases and on the given documents."""

from collections import Counter
from functools import lru_cache

import pytest

from panelcast.llm.line_dedup import remove_spread_lines
from panelcast.llm.queries import op1_line_dedup
from tests.llm.rows import documents, odd_rows, prose


@lru_cache(maxsize=None)
def xxhash(text):
    """Any order of texts will do where rows of one id differ, if it is the same one."""
    import xxhash as x

    return x.xxh64_intdigest((text or "").encode(), 42) - (1 << 64) * (x.xxh64_intdigest((text or "").encode(), 42) >> 63)


def plain(rows, min_sites=3):
    """Lines with their sites in a dictionary; rows of one id and text are alike, a document and its copies have one site."""
    sites, first, size, chars, site_of = {}, {}, {}, {}, {}
    lines = lambda t: [] if t is None else t.split("\n")
    key = lambda d, p: (d is not None, d or 0, p)
    place = lambda d, t: (key(d, 0)[:2], xxhash(t))
    for doc, text, _, site in rows:
        full = [x.strip(" ") for x in lines(text) if x.strip(" ")]
        size[place(doc, text)] = set(full)
        chars[place(doc, text)] = sum(map(len, full))
        if site is not None:
            site_of.setdefault(place(doc, text), []).append(site)
        for pos, line in enumerate(lines(text)):
            if line.strip(" "):
                own = (*place(doc, text), pos)
                first[line.strip(" ")] = min(first.get(line.strip(" "), own), own)
    body = {}
    for own, held in size.items():
        shared, lines_of = Counter(), Counter()
        for line in held:
            shared[first[line][:2]] += len(line)
            lines_of[first[line][:2]] += 1
        much = lambda f: 2 * lines_of[f] > max(len(held), len(size[f])) or lines_of[f] > 1 and 2 * shared[f] > max(chars[own], chars[f])  # noqa: B023, E731
        body[own] = max(((n, f) for f, n in shared.items() if f != own and much(f)), default=(0, own))[1]
    group = {}  # of each line and body
    for own, held in size.items():
        for line in held:
            group.setdefault((line, body[own]), []).extend(site_of.get(own, []))
    for (line, _), found_on in group.items():
        sites.setdefault(line, set()).update([min(found_on)] if found_on else [])
    first = {line: (f[0], f[1], f[2]) for line, f in first.items()}
    spread = {line for line, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc, text, _, _ in rows:
        parts = lines(text)
        drop = [k for k, x in enumerate(parts) if x.strip(" ") in spread and first[x.strip(" ")] != (*place(doc, text), k)]
        kept = None if text is None else "\n".join(x for k, x in enumerate(parts) if k not in drop)
        out.append((doc, kept, sum(bool(x.strip(" ")) for x in parts), len(drop)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in df.collect()), key=repr)


def test_cases(spark):
    menu, note = "Home About Contact", "All rights reserved."
    rows = [(r[0], r[1], "en", "a") for r in odd_rows()]
    rows += [(20 + k, f"{prose(k, 12)}\n {menu} \n{prose(50 + k, 9)}\n\n{note}\n{note}", "en", f"s{k % 4}") for k in range(8)]
    rows += [(40 + k, f"{prose(k, 12)}\n{prose(99, 8)}", "en", "one site") for k in range(6)]  # many times on one site
    rows += [(60 + k, menu, "en", f"s{k}") for k in range(4)]  # nothing but a spread line
    rows += [(80 + k, f"{prose(77, 60)}\n{prose(800 + k, 9)}", "en", f"s{k}") for k in range(5)]  # mostly a passage, but one line of two
    rows += [(90 + k, f"{prose(78, 30)}\n{menu}\n{prose(79, 30)}", "en", f"s{k}") for k in range(5)]  # copies: their own lines stay, boilerplate goes
    rows += [(96, f"{prose(79, 30)}\n\n {prose(78, 30)}\n{menu}", "en", "s9")]  # the same lines in another order
    rows += [(100 + k, "\n".join(f"edit {k}" if j == k % 7 else prose(700 + j, 8) for j in range(7)), "en", f"s{k}") for k in range(30)]  # near copies: a line of seven differs
    rows += [(140 + k, f"{prose(900 + k, 5)}\n" + "\n".join(prose(950 + j, 6) for j in range(5)), "en", f"s{k}") for k in range(4)]  # one template, little text
    rows += [(150 + k, "\n".join([*(prose(1000 + 10 * k + j, 7) for j in range(9)), *(prose(950 + j, 6) for j in range(5))]), "en", f"s{k}") for k in range(4)]  # and much
    rows += [(70, f"{prose(3, 9)}\n{menu}", "en", None)]
    got = found(remove_spread_lines(documents(spark, rows)))
    assert got == plain(rows)
    assert sum(prose(77, 60) in (r[1] or "") for r in got) == 1
    assert any(r[3] for r in got) and {r[1] for r in got if r[0] in range(60, 64)} == {""}
    assert {r[1] for r in got if r[0] in range(90, 95)} == {f"{prose(78, 30)}\n{prose(79, 30)}"}
    assert sum(menu in (r[1] or "") for r in got) == 1  # only its first place is left
    assert all(r[3] == 0 for r in got if r[0] in range(100, 130))
    assert sum(prose(952, 6) in (r[1] or "") for r in got) == 1 and {r[1] for r in got if r[0] in range(141, 144)} == {prose(900 + k, 5) for k in range(1, 4)}


def test_estimates_far_from_the_threshold_decide_and_near_ones_are_counted(spark):
    rows = [(k, f"{prose(k, 20)}\nclose line\n{'far line' if k < 40 else prose(500 + k, 5)}", "en", f"s{k % 20 if k >= 20 else k}") for k in range(60)]
    assert found(remove_spread_lines(documents(spark, rows), min_sites=19)) == plain(rows, 19)


def test_columns_stay_and_taken_names_raise(spark):
    df = documents(spark, odd_rows())
    assert remove_spread_lines(df).columns == [*df.columns, "n_lines", "n_removed"]
    assert remove_spread_lines(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        remove_spread_lines(df.withColumnRenamed("uid", "n_lines"))


def test_given_documents(spark, sf):
    rows = [(r["doc_id"], r["text"], "", r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(op1_line_dedup(spark, sf)) == plain(rows)
