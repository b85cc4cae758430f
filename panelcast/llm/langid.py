"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from panelcast.llm.encode import portions, slices
from panelcast.llm.shared import tidy

BITS = 16
SLICES = 64
SMOOTHING = 0.5
#: Languages that can be learned; a column with more holds something else.
LANGUAGES = 256
#: Losses closer than this, of about 1 for a language's usual text, flag a prediction as ambiguous.
AMBIGUOUS = 0.2

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of folded texts, what is no letter being a space, and where each text's begin."""
    parts = [b" " + t.lower().encode("utf-8", "replace").translate(_LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts) + b"  ", np.uint8).astype(np.uint32)
    codes = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    ends = np.cumsum([len(p) for p in parts])
    starts = np.concatenate([[0], ends])[:-1]
    codes[ends - 1] = codes[ends - 2] = 0  # these would reach into the next text
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), starts


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all splits of up to five languages, else seeded random ones with the rows far apart."""
    if not languages:
        return np.ones((0, 1), np.int8)
    if languages <= 5:
        splits = range(1, max(2, 1 << max(0, languages - 1)))
        return np.array([[1 - 2 * (s >> (i - 1) & 1) if i else 1 for s in splits] for i in range(languages)], np.int8)
    width, rng = max(15, int(10 * np.log2(languages))), np.random.default_rng(7)
    tried = [rng.choice(np.array([-1, 1], np.int8), (languages, width)) for _ in range(50)]

    def apart(code: np.ndarray) -> int:
        same = code.astype(int) @ code.T
        np.fill_diagonal(same, -width)
        return int(width - same.max())

    return max(tried, key=apart)


class Decoder:
    """Weights of one binary classifier for each bit, and the decoding of their margins."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages, self.code = languages, codewords(len(languages))
        if not languages:
            return
        smooth = counts + SMOOTHING
        share = smooth / smooth.sum(axis=1, keepdims=True)
        sides = [[share[self.code[:, j] == side].mean(axis=0) if (self.code[:, j] == side).any() else share.mean(axis=0) for j in range(self.code.shape[1])] for side in (1, -1)]
        weights = np.log(np.array(sides[0])) - np.log(np.array(sides[1]))  # bits x buckets
        margins = share @ weights.T  # what each language's texts give each bit in the mean
        self.scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
        self.weights = np.ascontiguousarray((weights / self.scale[:, None]).T.astype(np.float32))
        trust = np.maximum(self.code * margins / self.scale, 1e-3)
        self.trust = trust / trust.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, score and whether it is ambiguous; und, 0 and false for a text without a letter."""
        some = [k for k, t in enumerate(texts) if t and _LETTER.search(t)]
        out = [("und", 0.0, False)] * len(texts)
        if not some or not self.languages:
            return out
        hashed, starts = grams([texts[k] for k in some])
        lengths = np.diff(np.append(starts, len(hashed)))
        margins = np.add.reduceat(self.weights.take(hashed, axis=0), starts, axis=0) / lengths[:, None]
        # loss-weighted decoding: the logistic loss of each bit counts as far as the bit tells the language
        losses = np.stack([np.logaddexp(0, -4 * margins * code) @ trust for code, trust in zip(self.code, self.trust, strict=True)], axis=1)
        best = losses.argmin(axis=1)
        chance = np.exp(-5 * (losses - losses.min(axis=1, keepdims=True)))
        score = 1 / chance.sum(axis=1)
        ordered = np.sort(losses, axis=1)
        close = ordered[:, 1] - ordered[:, 0] < AMBIGUOUS if losses.shape[1] > 1 else np.zeros(len(losses), bool)
        for k, b, s, c in zip(some, best.tolist(), score.tolist(), close.tolist(), strict=True):
            out[k] = (self.languages[b], s, c)
        return out


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, slice, counts: the trigram counts of each language over all rows, in slices of the buckets.

    Each task sends sums, added up in two steps, so that a language with most
    of the rows costs no more than another.
    """
    width = (1 << BITS) // SLICES
    schema = "lang string, slice int, share int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        share = 0
        for batch in portions(batches):
            share = batch["share"][0].as_py() if batch.num_rows else share
            rows = sorted(zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True), key=lambda r: r[0])
            for run in slices(rows, lambda r: len(r[1])):
                for lang in {r[0] for r in run}:
                    found = np.bincount(grams([t for name, t in run if name == lang])[0], minlength=1 << BITS)
                    sums[lang] = sums.get(lang, 0) + found
            if len(sums) > 100:
                yield send(sums, share)
                sums = {}
        if sums:
            yield send(sums, share)

    def send(sums: dict[str, np.ndarray], share: int) -> pa.RecordBatch:
        rows = [(lang, s, share, found[s * width : (s + 1) * width].astype(np.int64).tobytes()) for lang, found in sums.items() for s in range(SLICES)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["lang", "slice", "share", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
        return rows.head(1).assign(counts=[total.tobytes()])

    sent = labelled.select("lang", "text", F.pmod(F.spark_partition_id(), F.lit(256)).alias("share")).mapInArrow(tidy(count), schema)
    partial = sent.groupBy("lang", "slice", "share").applyInPandas(add, schema)
    return partial.groupBy("lang", "slice").applyInPandas(add, schema).drop("share")


def train(labelled: DataFrame) -> Decoder:
    """A decoder from all rows with a text and a lang.

    The driver gets 512 KB for each language; more than LANGUAGES raise.
    """
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    if labelled.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different values of lang")
    rows = gram_counts(labelled).collect()
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), SLICES, (1 << BITS) // SLICES))
    for r in rows:
        counts[languages.index(r["lang"]), r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return Decoder(languages, counts.reshape(len(languages), 1 << BITS))


def identify(docs: DataFrame, decoder: Decoder, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with lang_pred, score (0 to 1) and ambiguous for every whole text.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if no language was learned. Names already taken raise.
    """
    added, keep = ["lang_pred", "score", "ambiguous"], docs.columns if keep is None else keep
    if set(added) & set(keep):
        raise ValueError("the documents already have lang_pred, score or ambiguous")
    sent = docs.sparkSession.sparkContext.broadcast(decoder)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts = [t or "" for t in batch.columns[-1].to_pylist()]
            rows = [r for run in slices(texts, len) for r in sent.value.predict(run)]
            found = zip(*rows, strict=True) if rows else [[]] * 3
            arrays = [pa.array(c, k) for c, k in zip(found, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*keep, *added])

    found = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    schema = T.StructType([*(docs.schema[c] for c in keep), *found])
    return docs.select(*keep, docs["text"].alias("_text")).mapInArrow(tidy(predict), schema)
