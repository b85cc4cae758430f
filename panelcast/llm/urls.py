"""Verdicts on URLs: host and path rules, and for the rest words segmented from hosts scored by naive Bayes."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.encode import portions
from panelcast.llm.shared import stored, tidy

SMOOTHING = 1.0
#: Letters of a label that are looked at together.
STRETCH = 256
SALTS = 8

_TAG = re.compile(rb"<[^>]*>")
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, with A-Z lower-cased; empty without it or for null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of the rules (verdict, host/path) that fits, as a struct (rule, verdict); null without one.

    ``rules`` is a policy list; it becomes part of the plan.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """word, n: words of letters in the markup's text, folded; each task adds up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()
        for batch in portions(batches):
            for text in batch[column]:
                sums.update(_TAG.sub(b" ", (text.as_py() or "").encode()).translate(_LETTERS).split())
            if len(sums) > 500_000:
                yield send(sums)
                sums = Counter()
        yield send(sums)

    def send(sums: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode() for w in sums], pa.string()), "n": pa.array(list(sums.values()), pa.int64())})

    return texts.select(column).mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(label: str, matches: list[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest split into words by unigram probability; an unseen word costs ten times as much for each letter more.

    ``matches``: start, end and count of every part of the label that is a
    known word, by end. Unseen words may have any length: their cost goes on
    letter by letter, so a label takes as many steps as it has letters and
    matches. Of equal costs the longer last word wins.
    """
    letter, unseen = math.log(10), math.log(0.1 / max(total, 1))
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    going, begun, at = -math.inf, 0, 0  # an unseen word that reaches to here
    for end in range(1, len(label) + 1):
        if best[end - 1] + unseen > going:
            going, begun = best[end - 1] + unseen, end - 1
        going -= letter
        best[end], back[end] = going, begun
        while at < len(matches) and matches[at][1] == end:
            start, _, n = matches[at]
            cost = best[start] + math.log(n / total)
            if cost > best[end] or (cost == best[end] and start < back[end]):
                best[end], back[end] = cost, start
            at += 1
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented_labels(labels: DataFrame, words: DataFrame) -> DataFrame:
    """label, words: each distinct label split into words with the counts of ``words`` (word, n).

    The labels' parts, none longer than the longest word, are joined to the
    counts, so the vocabulary may have any size. Rows of parts have a number
    in the label's place; those that are words come back to it, many labels to
    a task.
    """
    sizes = words.agg(F.sum("n"), F.max(F.length("word"))).first()
    total, longest = sizes[0] or 0, sizes[1] or 0
    known = stored(labels.where("label <> ''").select("label").distinct().withColumn("id", F.monotonically_increasing_id()), "distinct-labels")
    # in stretches first: to find a place in a long text takes as many steps as the place is far
    stretches = known.select("id", "label", F.explode(F.sequence(F.lit(1), F.length("label"), F.lit(STRETCH))).alias("base"))
    stretches = stretches.select("id", "base", F.expr(f"substring(label, base, {STRETCH + longest})").alias("stretch"))
    starts = stretches.select("id", "base", "stretch", F.explode(F.sequence(F.lit(1), F.least(F.lit(STRETCH), F.length("stretch")))).alias("place"))
    starts = starts.select("id", (F.col("base") + F.col("place") - 1).alias("start"), F.expr(f"substring(stretch, place, {longest})").alias("rest"))
    parts = starts.where("rest <> ''").select("id", "start", "rest", F.explode(F.sequence(F.lit(1), F.length("rest"))).alias("size"))
    parts = parts.select("id", (F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("size")).alias("end"), F.expr("substring(rest, 1, size)").alias("word"))
    matches = parts.join(words, "word").select("id", "start", "end", "n", F.lit(None).cast("string").alias("label"))
    rows = known.select("id", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"), "label").unionByName(matches)
    ordered = rows.repartition("id").sortWithinPartitions("id", "end", "start")  # the label itself ends at 0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, label, found = None, None, []
        for batch in batches:
            out: list[tuple[str, list[str]]] = []
            for number, start, end, n, text in zip(*(batch[c].to_pylist() for c in ("id", "start", "end", "n", "label")), strict=True):
                if number != held:
                    if label is not None:
                        out.append((label, viterbi(label, found, total)))
                    held, label, found = number, text, []
                else:
                    found.append((start, end, n))
            yield send(out)
        if label is not None:
            yield send([(label, viterbi(label, found, total))])

    def send(out: list[tuple[str, list[str]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"label": pa.array([r[0] for r in out], pa.string()), "words": pa.array([r[1] for r in out], pa.list_(pa.string()))})

    return ordered.mapInArrow(tidy(split), "label string, words array<string>")


def url_tokens(urls: DataFrame, words: DataFrame) -> DataFrame:
    """uid, token, n: words of the host's labels, and the path's parts, numbers being one token, with how often they occur.

    ``urls`` has uid, host and path. Tokens of hosts and paths are kept apart.
    """
    labels = urls.select("host").distinct().select("host", F.explode(F.split("host", "[.:@_-]")).alias("label"))
    labels = stored(labels.where("label <> ''"), "labels")
    split = segmented_labels(labels.select("label"), words)
    by_host = labels.join(split, "label").select("host", F.explode("words").alias("word")).groupBy("host", "word").agg(F.count(F.lit(1)).alias("n"))
    salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = urls.withColumn("salt", F.pmod("uid", F.lit(SALTS)).cast("int"))
    hosts = dealt.join(salted, ["host", "salt"]).select("uid", F.concat(F.lit("host:"), "word").alias("token"), "n")
    pieces = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    paths = urls.select("uid", F.explode(F.transform(pieces, lambda w: F.concat(F.lit("path:"), F.when(w.rlike(r"^\p{N}+$"), "0").otherwise(w)))).alias("token"))
    return hosts.unionByName(paths.groupBy("uid", "token").agg(F.count(F.lit(1)).alias("n")))


def bayes_weights(tokens: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """token, weight: log odds of allow over block from URLs with a rule's verdict (uid, verdict), and the prior's log odds.

    ``tokens`` are uid, token and n; an occurrence counts each time.

    Every token has a weight; with no labelled URL all are 0, and so is the
    prior.
    """
    seen = labels.groupBy("verdict").count()
    n = {r["verdict"]: r["count"] for r in seen.collect()}
    allow, block = n.get("allow", 0), n.get("block", 0)
    prior = math.log((allow + SMOOTHING) / (block + SMOOTHING))
    both = tokens.join(labels, "uid")
    count = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0))
    by_token = both.groupBy("token").agg(count("allow").alias("a"), count("block").alias("b"))
    totals = by_token.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("v")).first()
    each = lambda c, total: F.log((F.col(c) + SMOOTHING) / (total + SMOOTHING * max(1, totals["v"])))
    return by_token.select("token", (each("a", totals["a"]) - each("b", totals["b"])).alias("weight")), prior


def judge(pages: DataFrame, rules: list[tuple[str, str]], text: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, score and words for every row of ``pages`` (page_id, url, html).

    The longest fitting rule decides. Other URLs are judged by multinomial
    naive Bayes over the words of their host, segmented with the unigram
    counts of all pages' text, and the parts of their path; it learns from the
    URLs that rules decide. score is its log odds, allow from 0; ``words`` are
    the tokens, each as often as it occurs. A null url,
    or one without ://, has no tokens, so the prior decides. Each row counts,
    also repeated ones; other columns are not read.
    """
    url = F.col("url")
    parsed = pages.select(F.monotonically_increasing_id().alias("uid"), "page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    parsed = stored(parsed.select("uid", "page_id", "host", "path", "fit.rule", F.col("fit.verdict").alias("ruled")), "urls")
    words = stored(word_counts(pages, text), "words")
    tokens = stored(url_tokens(parsed.select("uid", "host", "path"), words), "tokens")
    weights, prior = bayes_weights(tokens, parsed.where("ruled IS NOT NULL").select("uid", F.col("ruled").alias("verdict")))
    salted = stored(weights, "weights").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = tokens.withColumn("salt", F.pmod("uid", F.lit(SALTS)).cast("int")).join(salted, ["token", "salt"], "left")
    scored = dealt.groupBy("uid").agg(F.sum(F.coalesce(F.col("weight") * F.col("n"), F.lit(0.0))).alias("sum"), F.sort_array(F.flatten(F.collect_list(F.array_repeat("token", F.col("n").cast("int"))))).alias("words"))
    score = F.coalesce("sum", F.lit(0.0)) + F.lit(prior)
    return parsed.join(scored, "uid", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(score >= 0, "allow").otherwise("block")).alias("verdict"),
        score.alias("score"), F.coalesce("words", F.array().cast("array<string>")).alias("words"),
    )
