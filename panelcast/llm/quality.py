"""Quality of documents: a classifier's evidence and hierarchical empirical Bayes over their sites."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelcast.llm.encode import portions
from panelcast.llm.shared import stored, tidy

#: Labelled documents that the classifier is fitted on, at most; half give the word list, half the weights.
SAMPLE = 20_000
CLIP = 8.0
SALTS = 8

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_KINDS = np.array([0 if 97 <= b <= 122 or b >= 128 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b in b" \t\r\n" else 4 if b in b".,;:'" else 5 for b in range(256)], np.uint8)
N_FEATURES = 14


def terms(words: list[str]) -> set[str]:
    """The distinct words, and the beginnings of longer ones."""
    distinct = set(words)
    return distinct | {f"{w[:5]}-" for w in distinct if len(w) > 6}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """What the classifier sees of a whole text; all 0 without words."""
    data = text.encode()
    words = data.translate(_FOLD).decode().split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    kinds = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=6).tolist()
    letters, size = max(1, kinds[0] + kinds[1]), len(data)
    distinct = set(words)
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
    lines = [x for x in text.split("\n") if x]
    found = sorted((lexicon[w] for w in terms(words) & lexicon.keys()), reverse=True)
    return [
        math.log1p(n), len(distinct) / n, pairs, letters / n, kinds[1] / letters, kinds[2] / size, kinds[4] / size, kinds[5] / size, kinds[3] / size,
        1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(found)), len(found) / math.sqrt(len(distinct)), found[0] if found else 0.0, sum(found[:3]),
    ]


@dataclass(frozen=True)
class Classifier:
    lexicon: dict[str, float]
    weights: list[float]
    bias: float

    def evidence(self, text: str | None) -> float:
        """Log odds of good over bad, against the prior; 0 for a text without words."""
        values = features(text or "", self.lexicon)
        if not values[0]:
            return 0.0
        return max(-CLIP, min(CLIP, self.bias + sum(w * v for w, v in zip(self.weights, values, strict=True))))


def good_labels(labels: DataFrame) -> DataFrame:
    """doc_id, good: 1 if every label of the document has quality 1 and none is toxic (null: not toxic)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg((F.min("quality").cast("int") * (F.coalesce(F.max("toxic"), F.lit(0)) == 0).cast("int")).alias("good"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """A logistic regression on at most ``sample`` labelled documents, drawn by a hash of the doc_id.

    Without labels of both kinds all evidence is 0. Of several documents with
    one doc_id one counts.
    """
    drawn = good_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded by the parameter, so it can be sent to all
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    texts = stored(texts.where("text IS NOT NULL").select("text", "good", (F.xxhash64("doc_id") % 2 == 0).alias("for_words")), "labelled")
    if texts.where("NOT for_words").agg(F.count_distinct("good")).first()[0] < 2:
        return Classifier({}, [0.0] * N_FEATURES, 0.0)
    lexicon = _lexicon(texts.where("for_words"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            values = [features(t, lexicon) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["good"], pa.array(values, pa.list_(pa.float64()))], names=["good", "values"])

    seen = texts.where("NOT for_words").select("text", "good").mapInArrow(tidy(rows), "good int, values array<double>")
    frame = stored(seen, "features").select(F.col("good").alias("label"), array_to_vector("values").alias("features"))
    model = LogisticRegression(regParam=1e-3, maxIter=60).fit(frame)
    return Classifier(lexicon, [float(w) for w in model.coefficients], float(model.intercept))


def _lexicon(texts: DataFrame, least: int = 4, weight: float = 1.5) -> dict[str, float]:
    """Words that bad documents hold far more often than good ones, with their log odds: as many as the labelled sample has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[tuple[str, int]] = Counter()
        for batch in portions(batches):
            for text, good in zip(batch["text"].to_pylist(), batch["good"].to_pylist(), strict=True):
                sums.update((w, good) for w in terms(text.encode().translate(_FOLD).decode().split()))
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in sums], pa.string()), "good": pa.array([g for _, g in sums], pa.int32()), "n": pa.array(list(sums.values()), pa.int64())})

    totals = {r["good"]: r["count"] for r in texts.groupBy("good").count().collect()}
    counted = texts.select("text", "good").mapInArrow(tidy(count), "word string, good int, n long")
    side = lambda g: F.sum(F.when(F.col("good") == g, F.col("n")).otherwise(0))
    counted = counted.groupBy("word").agg(side(0).alias("bad"), side(1).alias("fine"))
    odds = F.log((F.col("bad") + 0.5) / (totals.get(0, 0) + 1)) - F.log((F.col("fine") + 0.5) / (totals.get(1, 0) + 1))
    kept = counted.withColumn("odds", odds).where((F.col("bad") >= least) & (F.col("odds") >= weight))
    return {r["word"]: r["odds"] for r in kept.collect()}


def with_evidence(docs: DataFrame, classifier: Classifier, keep: list[str], host: str, path: str) -> DataFrame:
    """_row (a struct of the columns ``keep``, but not the text), _id, _host and _path (null: empty), _evidence, and _text if it is kept."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct(*(c for c in keep if c != "text")) if set(keep) - {"text"} else F.struct(F.lit(0).alias("none"))
    own = docs.select(row.alias("_row"), F.xxhash64("doc_id").alias("_id"), site(host).alias("_host"), site(path).alias("_path"), F.col("text").alias("_text"))
    kept = own.schema.names if "text" in keep else own.schema.names[:-1]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = pa.array([sent.value.evidence(t) for t in batch["_text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), found], names=[*kept, "_evidence"])

    return own.mapInArrow(tidy(judge), T.StructType([*(own.schema[c] for c in kept), T.StructField("_evidence", T.DoubleType())]))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float]:
    """_host, _path, n, good and host_rate of every site path, the strength of a path's prior, and the global rate.

    Each level's rate of good documents is shrunk toward the one above: hosts
    toward the global rate, paths toward their host, the fewer documents the
    more. How much follows from the variance between the groups beyond what
    their sizes explain (method of moments).
    """
    chance = F.lit(1.0) / (1 + F.exp(-F.col("_evidence")))
    paths = stored(evidence.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum(chance).alias("good")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    rate = min(1 - 1e-6, max(1e-6, total[1] / total[0])) if total[0] else 0.5
    within = rate * (1 - rate)

    def strength(groups: DataFrame, n: str, good: str, toward: Column) -> float:
        beyond = F.pow(F.col(good) / F.col(n) - toward, 2) - within / F.col(n)
        between = groups.agg(F.sum(F.col(n) * beyond) / F.sum(n)).first()[0] or 0.0
        return min(1e6, max(1.0, within / max(between, 1e-9) - 1))

    host_strength = strength(hosts, "host_n", "host_good", F.lit(rate))
    hosts = hosts.select("_host", ((F.col("host_good") + host_strength * rate) / (F.col("host_n") + host_strength)).alias("host_rate"))
    # as many rows as site paths, and a host with most of them is split
    spread = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sites = paths.withColumn("salt", F.pmod(F.xxhash64("_path"), F.lit(SALTS)).cast("int")).join(spread, ["_host", "salt"]).drop("salt")
    sites = stored(sites, "sites")
    return sites, strength(sites, "n", "good", F.col("host_rate")), rate


def posteriors(evidence: DataFrame, sites: tuple[DataFrame, float, float]) -> DataFrame:
    """Adds _odds: a document's evidence and what its site's other documents add to the prior's log odds."""
    table, strength, rate = sites
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = evidence.withColumn("_salt", F.pmod("_id", F.lit(SALTS)).cast("int")).join(salted, ["_host", "_path", "_salt"])
    own = 1 / (1 + F.exp(-F.col("_evidence")))
    site = (F.col("good") - own + strength * F.col("host_rate")) / (F.col("n") - 1 + strength)
    site = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), site))
    return joined.withColumn("_odds", F.col("_evidence") + F.log(site / (1 - site)) - math.log(rate / (1 - rate)))


def score_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, score (posterior chance to be good) and keep for every row of ``docs``.

    ``host`` and ``path`` name the columns of the two site levels; null is a
    level of its own. A text without words has evidence 0, so its site
    decides. Repeated rows count each; other columns are not read.
    """
    own = stored(with_evidence(docs, fit(docs, labels, sample), ["doc_id"], host, path), "evidence")
    judged = posteriors(own, site_posteriors(own))
    score = 1 / (1 + F.exp(-F.col("_odds")))
    return judged.select("_row.doc_id", F.col("_evidence").alias("evidence"), score.alias("score"), (score >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``docs``, all columns, without the rows that ``score_documents`` rejects; each text is scored once."""
    own = stored(with_evidence(docs, fit(docs, labels, sample), docs.columns, host, path), "evidence")
    judged = posteriors(own, site_posteriors(own.drop("_row", "_text")))
    kept = judged.where(1 / (1 + F.exp(-F.col("_odds"))) >= threshold)
    return kept.select(*(F.col("_text").alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns))
