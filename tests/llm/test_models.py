"""Language codes, URL verdicts and quality: plain versions, held-out accuracy and odd inputs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import quality
from panelcast.llm.langid import AMBIGUOUS, Decoder, codewords, grams, identify, train
from panelcast.llm.queries import URL_RULES, op5_quality_classifier, op6_url_filter, op8_language_id
from panelcast.llm.urls import host_of, judge, path_of, segmented_labels, viterbi, word_counts
from tests.llm.rows import documents, odd_rows, prose

FRENCH = "le la les une dans avec pour être était maison rivière forêt élève château garçon où déjà même jamais toujours".split()
GERMAN = "der die das und ist nicht auch über schön größe straße mädchen häuser wälder flüsse immer wieder vielleicht zwischen".split()


def sentence(words, seed, n=25):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words, n))


def test_codewords_differ():
    for n in range(2, 20):
        code = codewords(n)
        same = (code[:, None] == code[None]).all(axis=2)
        assert same.sum() == n and all(len(set(c)) == 2 for c in code.T)
    assert codewords(1).shape[0] == 1 and codewords(0).shape == (0, 1)


def language_rows():
    rows = [(k, prose(k, 25), "en", "a") for k in range(40)]
    rows += [(100 + k, sentence(FRENCH, k), "fr", "a") for k in range(40)]
    return rows + [(200 + k, sentence(GERMAN, k), "de", "a") for k in range(40)] + [(300, "no label here", None, "a")]


def test_languages(spark):
    decoder = train(documents(spark, language_rows()))
    assert decoder.languages == ["de", "en", "fr"]
    tests = [(1, prose(999, 9), "x", ""), (2, sentence(FRENCH, 999), "x", ""), (3, sentence(GERMAN, 999).upper(), None, ""), *odd_rows(), (50, "12 34 !?", "en", "")]
    df = documents(spark, tests)
    got = identify(df, decoder)
    assert got.columns == [*df.columns, "lang_pred", "score", "ambiguous"] and got.count() == len(tests)
    first = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert [first[t[:2]]["lang_pred"] for t in tests[:3]] == ["en", "fr", "de"]
    for (_, text), r in first.items():
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", text or ""))
    mixed = " ".join([sentence(FRENCH, 5, 200), sentence(GERMAN, 6, 200)])
    assert decoder.predict([mixed])[0][2] or decoder.predict([mixed])[0][1] < 0.99
    with pytest.raises(ValueError):
        identify(df.withColumnRenamed("uid", "score"), decoder)


def test_counts_and_weights_by_hand(spark):
    rows = language_rows()
    decoder = train(documents(spark, rows))
    counts = np.stack([np.bincount(grams([t for _, t, l, _ in rows if l == lang])[0], minlength=1 << 16) for lang in ("de", "en", "fr")])
    assert np.allclose(decoder.weights, Decoder(["de", "en", "fr"], counts).weights)


def plain_prediction(rows, text):
    """Language and losses by the definition: trigrams in dictionaries, a naive classifier a bit, losses weighted by trust."""
    def trigrams(t):
        data = b" " + bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in t.lower().encode()) + b" "
        return Counter(((data[i] | data[i + 1] << 8 | data[i + 2] << 16) * 0x9E3779B1 % 2**32 >> 16) if i + 2 < len(data) else 0 for i in range(len(data)))

    langs = sorted({r[2] for r in rows if r[2]})
    counts = {lang: sum((trigrams(t) for _, t, own, *_ in rows if own == lang), Counter()) for lang in langs}
    total = {lang: sum(c.values()) + 0.5 * 65536 for lang, c in counts.items()}
    share = lambda lang, g: (counts[lang][g] + 0.5) / total[lang]
    code = [[1 if i == 0 or not (s >> (i - 1)) & 1 else -1 for s in range(1, 2 ** (len(langs) - 1))] for i in range(len(langs))]
    bits = range(len(code[0]))

    def weight(j, g):
        side = lambda v: np.mean([share(lang, g) for lang, c in zip(langs, code, strict=True) if c[j] == v])
        return math.log(side(1)) - math.log(side(-1))

    every = {g for c in counts.values() for g in c}
    rest = 65536 - len(every)  # trigrams that no language has weigh alike
    unseen = next(g for g in range(65536) if g not in every)
    usual = [[sum(share(lang, g) * weight(j, g) for g in every) + rest * share(lang, unseen) * weight(j, unseen) for j in bits] for lang in langs]
    scale = [np.mean([abs(u[j]) for u in usual]) for j in bits]
    trust = [[max(c[j] * u[j] / scale[j], 1e-3) for j in bits] for c, u in zip(code, usual, strict=True)]
    seen = trigrams(text)
    margin = [sum(n * weight(j, g) for g, n in seen.items()) / sum(seen.values()) / scale[j] for j in bits]
    losses = [sum(t[j] / sum(t) * float(np.logaddexp(0, -4 * margin[j] * c[j])) for j in bits) for c, t in zip(code, trust, strict=True)]
    return langs[int(np.argmin(losses))], 1 / sum(math.exp(-5 * (x - min(losses))) for x in losses), losses


def test_decoding_by_its_definition(spark):
    rows = [(k, sentence(w, k, 6), lang, "a") for lang, w in (("de", GERMAN), ("fr", FRENCH), ("en", "the of and to in water house".split())) for k in range(3)]
    decoder = train(documents(spark, rows))
    for text in (sentence(FRENCH, 70, 4), sentence(GERMAN, 71, 4), "the water of house", "le der the und les", "zzz qqq"):
        lang, score, losses = plain_prediction(rows, text)
        got = decoder.predict([text])[0]
        assert got[:2] == (lang, pytest.approx(score, abs=1e-4))
        near = sorted(losses)
        if abs(near[1] - near[0] - AMBIGUOUS) > 1e-3:
            assert got[2] == (near[1] - near[0] < AMBIGUOUS)


def test_half_and_half_is_ambiguous_and_whole_texts_are_not(spark, sf):
    """The flag is set for texts of two languages in equal parts, and for hardly any text of one."""
    given = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r["text"] and len(r["text"]) > 300 and r["lang"]]
    decoder = train(spark.createDataFrame(given, "text string, lang string"))
    by_lang = {}
    for text, lang in given:
        by_lang.setdefault(lang, []).append(text[:2000])
    first, second = sorted(by_lang, key=lambda k: -len(by_lang[k]))[:2]
    mixed = [f"{a[:300]} {b[:300]}" for a, b in zip(by_lang[first], by_lang[second], strict=False)]
    assert np.mean([p[2] for p in decoder.predict(mixed)]) > 0.5
    assert np.mean([p[2] for p in decoder.predict([t for t, _ in given])]) < 0.02


def test_too_many_languages_raise(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        train(rows)


def test_one_language_or_none(spark):
    one = train(documents(spark, [(1, "just words", "en", "a")]))
    assert one.predict(["anything", ""]) == [("en", 1.0, False), ("und", 0.0, False)]
    assert train(documents(spark, [])).predict(["anything"]) == [("und", 0.0, False)]


def test_held_out_languages(spark, sf):
    given = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_language_id(spark, sf).collect()
    assert len(got) == len(given) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    right = [r["lang_pred"] == given[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert np.mean(right) > 0.95


URLS = [
    ("http://www.Example.ORG/es/1?x=/en", "www.example.org", "/es/1"), ("https://a.com", "a.com", ""), ("https://a.com?q=http://b.org/", "a.com", ""), ("no scheme", "", ""),
    (None, "", ""), ("x://h://y/z#f", "h:", "//y/z"), ("http://É.org/É", "É.org", "/É"), ("http:///path", "", "/path"), ("a\nb://c/d\ne", "c", "/d\ne"), ("http://example.org/en/12", "example.org", "/en/12"),
    ("http://com/fr/", "com", "/fr/"), ("http://notexample.org/es/", "notexample.org", "/es/"), ("http://x.com/de/", "x.com", "/de/"), ("http://x.com/DE/", "x.com", "/DE/"), ("http://org", "org", ""),
]


def ruled(host, path):
    best = None
    for verdict, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(k, u, "<p>some words here</p>", 1, "t") for k, (u, _, _) in enumerate(URLS)], "page_id long, url string, html string, uid long, token string")
    assert [tuple(r) for r in df.select(host_of(F.col("url")), path_of(F.col("url"))).collect()] == [u[1:] for u in URLS]
    got = judge(df.unionByName(df.limit(1)).unionByName(df.limit(1).withColumn("page_id", F.lit(None).cast("long"))), URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        rule, verdict = ruled(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] == (verdict or ("allow" if r["score"] >= 0 else "block"))
    assert judge(df.limit(0), URL_RULES).collect() == []


def matches(label, counts):
    parts = [(a, b) for b in range(1, len(label) + 1) for a in range(b)]
    return [(a, b, counts[label[a:b]]) for a, b in parts if label[a:b] in counts]


def test_segmentation(spark):
    counts = {"green": 50, "house": 40, "greenhouse": 1, "tea": 30, "the": 100, "a": 90, "pneumonoultramicroscopicsilicovolcanoconiosis": 2}
    split = lambda label: viterbi(label, matches(label, counts), 1000)
    assert split("greenhousetea") == ["green", "house", "tea"]
    assert split("qzx") == ["qzx"] and split("") == []
    long_word, unseen = max(counts, key=len), "zqj" * 40
    assert split(f"the{long_word}tea") == ["the", long_word, "tea"] and split(f"the{unseen}green") == ["the", unseen, "green"]
    for label in ("theateahouse", "agreenx", "houseteathe", "xyztheqq"):  # all splits
        cost = lambda w: math.log(counts[w] / 1000) if w in counts else math.log(0.0001) - len(w) * math.log(10)
        best = max(sum(map(cost, s)) for s in _splits(label))
        assert sum(map(cost, split(label))) == pytest.approx(best)
    words = spark.createDataFrame([*counts.items(), ("z", 687)], "word string, n long")
    labels = ["greenhousetea", "theatea", f"the{long_word}tea", "é漢green", "x" * 30, "greenhouse" * 80, "tea" + "x" * 253 + "green" + "y" * 600 + "house"]
    table = spark.createDataFrame([(x,) for x in [*labels, labels[0], ""]], "label string")
    assert {r["label"]: r["words"] for r in segmented_labels(table, words).collect()} == {w: viterbi(w, matches(w, counts), 1000) for w in labels}


def test_a_very_long_host_is_judged(spark):
    long_label = "greenhouse" * 10_000
    df = spark.createDataFrame([(1, f"http://{long_label}.net/a", "green house tea"), (2, "http://tea.org/", "tea")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in judge(df, URL_RULES).collect()}
    assert got[1]["words"] == sorted(["host:green", "host:house"] * 10_000 + ["host:net", "path:a"])


def _splits(text):
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        for rest in _splits(text[k:]):
            yield [text[:k], *rest]


def test_word_counts(spark):
    df = spark.createDataFrame([("<b class='x'>The the</b> Tree9tree",), (None,), ("",)], "html string")
    assert {r["word"]: r["n"] for r in word_counts(df, "html").collect()} == {"the": 2, "tree": 2}


def plain_tokens(url, counts, total):
    """Tokens of a raw URL, each as often as it occurs."""
    _, found, rest = (url or "").partition("://")
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups() if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    words = [w for label in re.split("[.:@_-]", host) if label for w in viterbi(label, matches(label, counts), total)]
    pieces = [p for p in re.split(r"[\W_]+", path.lower()) if p]
    return [f"host:{w}" for w in words] + ["path:0" if p.isnumeric() else f"path:{p}" for p in pieces]


def plain_scores(pages):
    """Multinomial naive Bayes from (page_id, url, html), learned from the URLs that a rule decides."""
    counts = Counter(w for _, _, html in pages for w in re.findall("[a-z\x80-\U0010ffff]+", re.sub("<[^>]*>", " ", html or "").translate({c: c + 32 for c in range(65, 91)})))
    total = sum(counts.values())
    tokens = {page: plain_tokens(url, counts, total) for page, url, _ in pages}
    seen, number = {"allow": Counter(), "block": Counter()}, Counter()
    for page, url, _ in pages:
        _, found, rest = (url or "").partition("://")
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups() if found else ("", "")
        verdict = ruled(host.lower(), path)[1]
        if verdict:
            seen[verdict].update(tokens[page])
            number[verdict] += 1
    size = max(1, len({*seen["allow"], *seen["block"]}))
    weight = lambda v, t: math.log((seen[v][t] + 1) / (sum(seen[v].values()) + size))
    prior = math.log((number["allow"] + 1) / (number["block"] + 1))
    known = {*seen["allow"], *seen["block"]}
    return {page: (prior + sum(weight("allow", t) - weight("block", t) for t in held if t in known), sorted(held)) for page, held in tokens.items()}


def test_verdicts_of_the_rest_are_naive_bayes(spark, sf):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    want = plain_scores(pages)
    for r in op6_url_filter(spark, sf).collect():
        assert (r["score"], r["words"]) == (pytest.approx(want[r["page_id"]][0], abs=1e-9), want[r["page_id"]][1])


def test_repeated_words_count_each_time(spark):
    html = "<p>tea house green green tree</p>"
    urls = ["http://tea.org/tea/tea/1/22", "http://teatea.org/x", "http://green.com/de/tree/tree/tree", "http://tea-tea-green.net/tree/tea/tea/7", "http://tree.net/", None]
    pages = [(k, u, html) for k, u in enumerate(urls)]
    want = plain_scores(pages)
    got = judge(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()
    assert len(got) == 6
    for r in got:
        assert (r["score"], r["words"]) == (pytest.approx(want[r["page_id"]][0], abs=1e-9), want[r["page_id"]][1])


def labelled(n=240):
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        text = prose(k, 40 + k % 30)
        rows.append((k, " ".join(f"{w}!!" for w in text.upper().split()) if bad else text, "en", f"s{k % 5}"))
        labels.append((k, 0 if bad else 1, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_quality_rejects_bad_and_keeps_all_columns(spark):
    rows, labels = labelled()
    labels += [(1, 1, None), (5, None, None), (None, 1, 0), (9, 1, 0)]
    docs = documents(spark, [*rows, *odd_rows()])
    kept = quality.keep_good(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.where("source <> 'a'").collect()]
    good = {r[0] for r in rows if r[0] % 4}
    assert len(good - set(ids)) <= 2 and len(set(ids) - good) <= 2
    scored = quality.score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(scored) == len(rows) + len(odd_rows()) and all(0 < r["score"] < 1 for r in scored)
    assert sum(r["keep"] for r in scored) == kept.count()


def test_without_labels_all_stay(spark):
    docs = documents(spark, odd_rows())
    for labels in ([], [(4, 1, 0)]):
        assert quality.keep_good(docs, spark.createDataFrame(labels, LABELS)).count() == len(odd_rows())
    assert quality.keep_good(docs.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_toxic_and_disputed_labels_are_bad(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 0, 0), (3, 1, None), (4, 1, 0)], LABELS)
    assert {r["doc_id"]: r["good"] for r in quality.good_labels(labels).collect()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_site_posteriors_shrink(spark):
    rows = [(h, p, e) for h, p, e, n in [("big", "x", 2.0, 60), ("big", "y", -2.0, 30), ("bad", "x", -3.0, 50), ("one", "x", -3.0, 1)] for _ in range(n)]
    evidence = spark.createDataFrame(rows, "_host string, _path string, _evidence double")
    table, strength, rate = quality.site_posteriors(evidence)
    sites = {(r["_host"], r["_path"]): r for r in table.collect()}
    chance = lambda e: 1 / (1 + math.exp(-e))
    assert rate == pytest.approx(sum(chance(e) for _, _, e in rows) / len(rows))
    assert sites["bad", "x"]["host_rate"] < sites["one", "x"]["host_rate"] < rate  # one document says little
    judged = {(r["_host"], r["_path"]): r["_odds"] for r in quality.posteriors(evidence.withColumn("_id", F.lit(1)), (table, strength, rate)).collect()}
    for (host, path), r in sites.items():
        own = {k[:2]: k[2] for k in rows}[host, path]
        site = (r["good"] - chance(own) + strength * r["host_rate"]) / (r["n"] - 1 + strength)
        assert judged[host, path] == pytest.approx(own + math.log(site / (1 - site)) - math.log(rate / (1 - rate)))


def plain_odds(rows, evidence):
    """Every document's log odds from its evidence and its site, by the definition; rows are (host, path)."""
    chance = [1 / (1 + math.exp(-e)) for e in evidence]
    hosts, paths = {}, {}
    for (h, p), c in zip(rows, chance, strict=True):
        hosts.setdefault(h, []).append(c)
        paths.setdefault((h, p), []).append(c)
    rate = np.mean(chance)
    within = rate * (1 - rate)

    def strength(groups, toward):
        n = np.array([len(v) for v in groups.values()], float)
        beyond = [(np.mean(v) - toward(k)) ** 2 - within / len(v) for k, v in groups.items()]
        return min(1e6, max(1.0, within / max(float(np.average(beyond, weights=n)), 1e-9) - 1))

    a = strength(hosts, lambda k: rate)
    host_rate = {h: (sum(v) + a * rate) / (len(v) + a) for h, v in hosts.items()}
    b = strength(paths, lambda k: host_rate[k[0]])
    out = []
    for (h, p), c, e in zip(rows, chance, evidence, strict=True):
        held = paths[h, p]
        site = (sum(held) - c + b * host_rate[h]) / (len(held) - 1 + b)
        out.append(e + math.log(site / (1 - site)) - math.log(rate / (1 - rate)))
    return out


def test_scores_by_their_definition(spark):
    """The whole score: the classifier's evidence of each text, features by hand, then the sites."""
    rows, labels = labelled(160)
    docs, labels = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    classifier = quality.fit(docs, labels)
    evidence = []
    for _, text, *_ in rows:
        values = plain_features(text, classifier.lexicon)
        evidence.append(max(-8, min(8, classifier.bias + sum(w * v for w, v in zip(classifier.weights, values, strict=True)))))
    want = plain_odds([(r[3], r[2]) for r in rows], evidence)
    got = {r["doc_id"]: r for r in quality.score_documents(docs, labels).collect()}
    for (doc, *_), e, odds in zip(rows, evidence, want, strict=True):
        assert got[doc]["evidence"] == pytest.approx(e, abs=1e-6) and got[doc]["score"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6)
        assert got[doc]["keep"] == (odds >= 0)


def plain_features(text, lexicon):
    words = re.findall("[a-z]+", text.lower())  # ASCII texts
    letters, size = max(1, sum(c.isalpha() for c in text)), len(text)
    share = lambda test: sum(map(test, text)) / size
    terms = set(words) | {w[:5] + "-" for w in words if len(w) > 6}
    found = sorted((lexicon[t] for t in terms if t in lexicon), reverse=True)
    lines = [x for x in text.split("\n") if x]
    marks = ".,;:'"
    return [
        math.log1p(len(words)), len(set(words)) / len(words), len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1), letters / len(words),
        sum(c.isupper() for c in text) / letters, share(str.isdigit), share(lambda c: c in marks), share(lambda c: not (c.isalnum() or c in marks or c in " \t\r\n")), share(lambda c: c in " \t\r\n"),
        1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(found)), len(found) / math.sqrt(len(set(words))), found[0] if found else 0.0, sum(found[:3]),
    ]


def test_given_labels(spark):
    found = {r["doc_id"]: r["keep"] for r in op5_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    clean = [found[r["doc_id"]] for r in labels if r["quality"] == 1 and not r["toxic"]]
    bad = [found[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert np.mean(clean) > 0.97 and np.mean(bad) < 0.15
