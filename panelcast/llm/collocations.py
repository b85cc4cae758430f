"""Phrase collocations: Rabin-Karp fingerprints of word runs, frequent ones verified against the text and scored.

A run of words can only be frequent if every shorter run in it is. So the
words are counted first, then pairs of frequent words, then longer runs of
frequent pairs, each by fingerprint; a last pass reads the text of the runs
left and counts by text, so a collision of fingerprints changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from panelcast.llm.hashing import mixed, range_hashes, range_polynomials
from panelcast.llm.shared import released, tidy
from panelcast.session import discard, stored

#: Bytes of text that a worker looks at together.
CHUNK = 3 << 20
#: Distinct fingerprints that a worker adds up before they are sent.
HELD = 1 << 20
#: Fingerprints that meet in one task, about.
BUCKET = 1 << 18
#: Bits of a gate: 32 for each frequent fingerprint, up to 128 MB; a fuller gate lets more through, and no result changes.
GATE_BITS = 30
SLICE_BITS = 23
SALTS = 8
#: Rows that a ranking task gets, about.
RANKED = 1 << 16

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_WORD = ~_BREAK & ~np.isin(np.arange(256), list(b" \t"))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with A-Z lower-cased, and where each starts (and the last ends); null is empty."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    edges = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data else np.empty(0, np.uint8)
    return _LOWER[data], edges - edges[0]


def chunks(data: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, its bytes, edges) of runs of texts of about CHUNK bytes.

    A longer text is cut behind a mark that ends a piece, so no run of words is.
    """
    at = 0
    while at < len(edges) - 1:
        after = max(at + 1, int(np.searchsorted(edges, edges[at] + CHUNK, "right")) - 1)
        start, end = int(edges[at]), int(edges[after])
        while after == at + 1 and end - start > CHUNK:
            marks = np.flatnonzero(_BREAK[data[start + CHUNK // 2 : start + CHUNK]])
            cut = start + CHUNK // 2 + int(marks[-1]) + 1 if len(marks) else _next_mark(data, start + CHUNK, end)
            yield at, data[start:cut], np.array([0, cut - start])
            start = cut
        if end > start or after > at + 1:
            yield at, data[start:end], np.maximum(edges[at : after + 1] - start, 0)
        at = after


def _next_mark(data: np.ndarray, at: int, end: int) -> int:
    for start in range(at, end, CHUNK):
        marks = np.flatnonzero(_BREAK[data[start : min(end, start + CHUNK)]])
        if len(marks):
            return start + int(marks[0]) + 1
    return end


@dataclass
class Words:
    """The words of a chunk, joined by single spaces in ``data``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # the text's number in the chunk
    joined: np.ndarray  # whether the next word is in the same piece
    language: np.ndarray  # hash of each word's language
    runs: dict[int, np.ndarray] = field(default_factory=dict)
    own: np.ndarray | None = None

    @classmethod
    def of(cls, data: np.ndarray, edges: np.ndarray, languages: np.ndarray) -> Words:
        inside = _WORD[data]
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        before[edges[:-1][edges[:-1] < len(data)]] = False
        start = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        after[edges[1:][edges[1:] > 0] - 1] = False
        size = np.flatnonzero(inside & ~after) + 1 - start
        piece = np.cumsum(_BREAK[data], dtype=np.int32)[start]
        text = np.searchsorted(edges, start, "right") - 1
        joined = np.zeros(len(start), bool)
        joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        place = np.cumsum(size + 1) - (size + 1)
        compact = np.full(int((size + 1).sum()), 32, np.uint8)
        taken = np.repeat(start - place, size + 1) + np.arange(len(compact))
        compact[:] = data[np.minimum(taken, max(len(data) - 1, 0))]
        compact[place + size] = 32
        return cls(compact, place, place + size, text, joined, languages[text])

    def __len__(self) -> int:
        return len(self.start)

    def polynomials(self) -> np.ndarray:
        """Fingerprints of the words alone; found once."""
        if self.own is None:
            self.own = range_polynomials(self.data, self.start, self.end)
        return self.own

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        """64-bit fingerprints of the runs of n words that start at the given words, apart by language."""
        found = self.polynomials()[at] if n == 1 else range_polynomials(self.data, self.start[at], self.end[at + n - 1])
        return mixed(found * _ODD + self.language[at])

    def candidates(self, n: int, gates: list[Gate]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and fingerprints of the runs of n words whose shorter runs all pass their gates.

        ``gates`` holds those of one word, two words and longer runs, as far as they are known.
        """
        if n == 1:
            at = np.arange(len(self))
        elif n == 2:
            good = self.passing(1, gates)
            at = np.flatnonzero(good[:-1] & good[1:] & self.joined[:-1]) if len(self) else np.empty(0, np.int64)
        else:
            pairs, width = self.passing(2, gates), len(self) - n + 1
            at = np.flatnonzero(reduce(np.logical_and, (pairs[j : j + width] for j in range(n - 1)))) if width > 0 else np.empty(0, np.int64)
        return at, self.fingerprints(at, n)

    def passing(self, n: int, gates: list[Gate]) -> np.ndarray:
        """For each word whether a run of n words starts there that passes the gate; found once."""
        if n not in self.runs:
            at, found = self.candidates(n, gates)
            self.runs[n] = np.zeros(len(self), bool)
            self.runs[n][at[gates[min(n, len(gates)) - 1].passes(found)]] = True
        return self.runs[n]


@dataclass(frozen=True)
class Gate:
    """Bits at the first places of fingerprints: what is not set is not frequent."""

    bits: int
    slices: list[Broadcast]

    def passes(self, found: np.ndarray) -> np.ndarray:
        place = found >> np.uint64(64 - self.bits)
        out = np.zeros(len(found), bool)
        own = (place >> np.uint64(SLICE_BITS)).astype(np.int64)
        inside = (place & np.uint64((1 << SLICE_BITS) - 1)).astype(np.int64)
        for k, sent in enumerate(self.slices):
            chosen = slice(None) if len(self.slices) == 1 else own == k
            held = np.frombuffer(sent.value, np.uint8)
            out[chosen] = held[inside[chosen] >> 3] >> (inside[chosen] & 7).astype(np.uint8) & 1
        return out


def gate(frequent: DataFrame) -> Gate:
    """The gate of the fingerprints (fp), a stored table: made slice by slice in tasks, its size checked and bounded."""
    bits = min(GATE_BITS, max(SLICE_BITS, ceil(log2(32 * max(1, frequent.count())))))
    place = F.shiftrightunsigned("fp", 64 - bits)

    def setting(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1 << (SLICE_BITS - 3), np.uint8)
        inside = rows["place"].to_numpy() & ((1 << SLICE_BITS) - 1)
        np.bitwise_or.at(held, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        return pd.DataFrame({"slice": [key[0]], "bits": [held.tobytes()]})

    made = frequent.select(place.alias("place")).withColumn("slice", F.shiftright("place", SLICE_BITS))
    found = {r["slice"]: r["bits"] for r in made.groupBy("slice").applyInPandas(setting, "slice long, bits binary").collect()}
    discard(frequent)
    empty, send = bytes(1 << (SLICE_BITS - 3)), frequent.sparkSession.sparkContext.broadcast
    return Gate(bits, [send(bytes(found.get(k, empty))) for k in range(1 << (bits - SLICE_BITS))])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Words]]:
    """The words of each chunk, with the batch and the row of the chunk's first text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch["lang"].to_pylist()
        data = "".join(names).encode()
        ends = np.cumsum([len(n.encode()) for n in names])
        languages = range_hashes(np.frombuffer(data, np.uint8), np.concatenate([[0], ends[:-1]]), ends)
        for at, text, edges in chunks(*lowered(batch["text"])):
            yield batch, at, Words.of(text, edges, languages[at : at + len(edges) - 1])


def _frequent(docs: DataFrame, orders: list[int], gates: list[Gate], min_count: int, words: int) -> DataFrame:
    """fp of every run with one of the ``orders``, whose fingerprint occurs ``min_count`` times.

    Workers add up what they see and send it dealt by the fingerprint's first
    bits, so each task gets about BUCKET of them, from everywhere.
    """
    bits = max(0, ceil(log2(max(1, words / BUCKET))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, _, found in _chunked(batches):
            fps = np.concatenate([found.candidates(n, gates)[1] for n in orders])
            held.append(np.unique(fps, return_counts=True))
            if sum(len(f) for f, _ in held) > HELD:
                held = [_added(held)]
                if len(held[0][0]) > HELD // 2:
                    yield send(*held[0])
                    held = []
        if held:
            yield send(*_added(held))

    def send(fps: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bucket = (fps >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(fps), np.int64)
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(fps)), bool), bucket[1:] != bucket[:-1]]))
        after = np.append(first[1:], len(fps))[: len(first)]
        cut = lambda x, form: pa.array([_packed(form(x[a:b])) for a, b in zip(first, after, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), cut(fps, _steps), cut(counts, lambda c: c.astype(np.uint32))], names=["bucket", "fps", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        fps, counts = _added([(np.cumsum(_unpacked(f, np.uint64), dtype=np.uint64), _unpacked(c, np.uint32)) for f, c in zip(rows["fps"], rows["counts"], strict=True)])
        made = pd.DataFrame({"fp": fps[counts >= min_count].view(np.int64)})
        released()
        return made

    sent = docs.mapInArrow(tidy(count), "bucket long, fps binary, counts binary")
    return stored(sent.groupBy("bucket").applyInPandas(add, "fp long"), "frequent")


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values))


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences, which are smaller than the numbers; a sum from the left undoes it."""
    return np.diff(ascending, prepend=np.uint64(0))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints, in order, and their sums."""
    fps, counts = np.concatenate([f for f, _ in parts]), np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(fps, kind="stable")
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(fps)), bool), fps[1:] != fps[:-1]]))
    return fps[first], np.add.reduceat(counts, first) if len(first) else counts


def word_ids(words: Words) -> np.ndarray:
    """A number for each word: equal for equal bytes, by fingerprint and then by the bytes themselves."""
    _, first, ids = np.unique(words.polynomials(), return_index=True, return_inverse=True)
    size, model = words.end - words.start, first[ids]
    other = size != size[model]
    place = np.cumsum(size) - size
    for a in range(0, len(words), 1 << 17):  # a part of the bytes at a time
        b = min(len(words), a + (1 << 17))
        inside = np.arange(int(size[a:b].sum())) - np.repeat(place[a:b] - place[a], size[a:b])
        mine = words.data[np.repeat(words.start[a:b], size[a:b]) + inside]
        theirs = words.data[np.minimum(np.repeat(words.start[model[a:b]], size[a:b]) + inside, len(words.data) - 1)]
        other[a:b] |= np.logical_or.reduceat(mine != theirs, place[a:b] - place[a])
    extra: dict[bytes, int] = {}
    for k in np.flatnonzero(other).tolist():  # another word has the same fingerprint
        ids[k] = extra.setdefault(words.data[words.start[k] : words.end[k]].tobytes(), len(first) + len(extra))
    return ids


def occurrences(words: Words, ids: np.ndarray, n: int, gates: list[Gate]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, a first word, and the count, of each different run of n words that passes the gates.

    Every occurrence of a fingerprint is compared with the first one, by the
    numbers of its words; those that differ are counted by themselves.
    """
    starts, fps = words.candidates(n, gates)
    good = gates[min(n, len(gates)) - 1].passes(fps)
    starts, fps = starts[good], fps[good]
    kinds, model, group, counts = np.unique(fps, return_index=True, return_inverse=True, return_counts=True)
    other = reduce(np.logical_or, (ids[starts + j] != ids[starts[model][group] + j] for j in range(n)))
    other |= words.language[starts] != words.language[starts[model][group]]
    np.subtract.at(counts, group[other], 1)
    apart: dict[tuple, list[int]] = {}
    for k in np.flatnonzero(other).tolist():
        apart.setdefault((int(words.language[starts[k]]), *ids[starts[k] : starts[k] + n].tolist()), []).append(int(starts[k]))
    first = np.array([k[0] for k in apart.values()], np.int64)
    again = words.fingerprints(first, n) if len(first) else kinds[:0]
    return np.concatenate([kinds, again]), np.concatenate([starts[model], first]), np.concatenate([counts, [len(k) for k in apart.values()]]).astype(np.int64)


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


@dataclass
class Entries:
    """Runs with their texts (language, SPLIT, words), counts, and an occurrence of each."""

    fp: np.ndarray
    count: np.ndarray
    start: np.ndarray
    size: np.ndarray
    data: np.ndarray
    doc: np.ndarray
    known: np.ndarray  # whether the occurrence's document has an id
    word: np.ndarray

    def take(self, at: np.ndarray) -> Entries:
        size = self.size[at]
        return Entries(self.fp[at], self.count[at], np.cumsum(size) - size, size, self.data[_places(self.start[at], size)], self.doc[at], self.known[at], self.word[at])

    def dump(self) -> dict[str, bytes]:
        """The columns, packed; the entries are in the order of their fingerprints."""
        columns = {"fp": _steps(self.fp), "count": self.count.astype(np.int64), "size": self.size.astype(np.uint32), "data": self.data, "doc": self.doc, "known": self.known, "word": self.word.astype(np.uint32)}
        return {name: _packed(c) for name, c in columns.items()}

    @classmethod
    def load(cls, row: dict[str, bytes]) -> Entries:
        kinds = {"fp": np.uint64, "count": np.int64, "size": np.uint32, "data": np.uint8, "doc": np.int64, "known": bool, "word": np.uint32}
        held = {name: _unpacked(row[name], kind) for name, kind in kinds.items()}
        size = held["size"].astype(np.int64)
        return cls(**(held | {"fp": np.cumsum(held["fp"], dtype=np.uint64), "size": size, "start": np.cumsum(size) - size}))


#: Ends the language in an entry's text; no UTF-8 text has this byte.
SPLIT = 0xFF
BLOB = "bucket long, fp binary, count binary, size binary, data binary, doc binary, known binary, word binary"


def merged(parts: list[Entries]) -> Entries:
    """The entries of all parts by fingerprint, counts of equal texts added up.

    Each text is compared, byte by byte, with the first one of its fingerprint.
    """
    shift = np.cumsum([0, *(len(p.data) for p in parts)])
    column = lambda name: np.concatenate([getattr(p, name) for p in parts])
    starts = np.concatenate([p.start + s for p, s in zip(parts, shift[:-1], strict=True)])
    whole = Entries(column("fp"), column("count"), starts, column("size"), column("data"), column("doc"), column("known"), column("word"))
    whole = whole.take(np.argsort(whole.fp, kind="stable"))
    n = len(whole.fp)
    if not n:
        return whole
    first = np.concatenate([[True], whole.fp[1:] != whole.fp[:-1]])
    model = np.flatnonzero(first)[np.cumsum(first) - 1]
    again = np.flatnonzero(~first & (whole.size == whole.size[model]))
    other = ~first & (whole.size != whole.size[model])
    if len(again):
        size = whole.size[again]
        apart = whole.data[_places(whole.start[again], size)] != whole.data[_places(whole.start[model[again]], size)]
        other[again] = np.logical_or.reduceat(apart, np.cumsum(size) - size)
    seen: dict[tuple[int, bytes], int] = {}
    for k in np.flatnonzero(other).tolist():
        text = whole.data[whole.start[k] : whole.start[k] + whole.size[k]].tobytes()
        model[k] = seen.setdefault((int(whole.fp[k]), text), k)
    kept, group = np.unique(model, return_inverse=True)
    total = np.zeros(len(kept), np.int64)
    np.add.at(total, group, whole.count)
    out = whole.take(kept)
    out.count = total
    return out


def _entries(batch: pa.RecordBatch, at: int, words: Words, orders: range, gates: list[Gate]) -> Entries:
    """Every run of the chunk that passes the gates, and the number of words of each language."""
    ids = word_ids(words)
    found = [occurrences(words, ids, n, gates) for n in orders]
    fps, model, count = (np.concatenate([f[k] for f in found]) for k in range(3))
    end = np.concatenate([words.end[f[1] + n - 1] for n, f in zip(orders, found, strict=True)])
    totals = np.bincount(words.text, minlength=1) if len(words) else np.zeros(1, np.int64)
    some = np.flatnonzero(totals)
    text = np.concatenate([words.text[model], some])
    names = [n.encode() + bytes([SPLIT]) for n in batch["lang"].slice(at, int(words.text[-1]) + 1 if len(words) else 0).to_pylist()]
    name_size = np.array([len(n) for n in names], np.int64)
    name_start, name_data = np.cumsum(name_size) - name_size, np.frombuffer(b"".join(names), np.uint8)
    head, tail = name_size[text], np.concatenate([end - words.start[model], np.zeros(len(some), np.int64)])
    size = head + tail
    start = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    data[_places(start, head)] = name_data[_places(name_start[text], head)]
    data[_places(start + head, tail)] = words.data[_places(np.concatenate([words.start[model], np.zeros(len(some), np.int64)]), tail)]
    docs = batch["doc_id"].slice(at).take(pa.array(text))
    first = np.searchsorted(words.text, text)
    word = np.concatenate([model, first[len(model) :]]) - first
    hashes = np.concatenate([fps, mixed(words.language[first[len(model) :]] + np.uint64(1))])
    return Entries(hashes, np.concatenate([count, totals[some]]), start, size, data, docs.fill_null(0).to_numpy(), ~docs.is_null().to_numpy(zero_copy_only=False), word)


def _phrases(docs: DataFrame, orders: range, gates: list[Gate], min_count: int, words: float) -> tuple[DataFrame, DataFrame]:
    """Frequent runs by their text (lang, phrase, n_words, a, pointer), and the words of each language (lang, n).

    In each chunk the occurrences of a fingerprint are compared, word by word,
    with the first of them, whose place is the pointer to read the text from;
    those that differ are runs of their own. Entries of several chunks, and at
    the end of all tasks, are compared by their texts. ``pointer`` is an
    occurrence: doc_id and the number of its first word in its part of the text.
    """
    bits = max(0, ceil(log2(max(1, words / 16 / BUCKET))))
    names = [f.split()[0] for f in BLOB.split(", ")]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        for batch, at, chunk in _chunked(batches):
            held.append(_entries(batch, at, chunk, orders, gates))
            if sum(len(e.fp) for e in held) > HELD // 2:
                held = [merged(held)]
                if len(held[0].fp) > HELD // 3:
                    yield send(held[0])
                    held = []
        if held:
            yield send(merged(held))

    def send(entries: Entries) -> pa.RecordBatch:
        bucket = (entries.fp >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries.fp), np.int64)
        numbers, first = np.unique(bucket, return_index=True)
        rows = [entries.take(np.arange(a, b)).dump() for a, b in zip(first, [*first[1:], len(bucket)][: len(first)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(numbers), *(pa.array([r[c] for r in rows], pa.binary()) for c in names[1:])], names=names)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        whole = merged([Entries.load(r) for r in rows.to_dict("records")])
        out = []
        for k in range(len(whole.fp)):
            text = whole.data[whole.start[k] : whole.start[k] + whole.size[k]].tobytes()
            lang, _, phrase = text.partition(bytes([SPLIT]))
            if whole.count[k] >= min_count or not phrase:
                out.append((lang.decode(), phrase.decode(), phrase.count(b" ") + 1 if phrase else 0, int(whole.count[k]), int(whole.doc[k]) if whole.known[k] else None, int(whole.word[k])))
        made = pd.DataFrame(out, columns=["lang", "phrase", "n_words", "a", "doc_id", "word"])
        released()
        return made.astype({"doc_id": "Int64"})

    sent = docs.mapInArrow(tidy(found), BLOB)
    counted = stored(sent.groupBy("bucket").applyInPandas(add, "lang string, phrase string, n_words int, a long, doc_id long, word long"), "phrases")
    phrases = counted.where("n_words > 0").select("lang", "phrase", "n_words", "a", F.struct("doc_id", "word").alias("pointer"))
    return phrases, counted.where("n_words = 0").select("lang", F.col("a").alias("n"))


def frequent_phrases(docs: DataFrame, max_words: int = 5, min_count: int = 100) -> tuple[DataFrame, DataFrame]:
    """Runs of 1 to ``max_words`` words that occur ``min_count`` times or more, and the words of each language.

    (lang, phrase, n_words, a, pointer) and (lang, n), exact. A-Z are
    lower-cased; marks of ``.,;:!?`` and line ends cut a text into pieces,
    spaces and tabs a piece into words; runs stay inside pieces, occurrences
    may overlap. A null text is empty, a null lang ``und``; repeated rows and
    null ids count like others; other columns are not read.
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    words = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    gates = [gate(_frequent(rows, [1], [], min_count, words / 4))]
    gates.append(gate(_frequent(rows, [2], gates, min_count, words)))
    if max_words > 2:
        gates.append(gate(_frequent(rows, list(range(3, max_words + 1)), gates, min_count, words / 4)))
    return _phrases(rows, range(1, max_words + 1), gates, min_count, words)


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, n_words, a, l, r, n, score of every run of two words or more, by its lowest-scoring cut.

    A cut after k words scores floor(1000 a n / (l r)), l and r the counts of
    its parts; the least k wins ties. Whole numbers of 38 digits throughout.
    """
    several = phrases.where("n_words > 1").join(totals, "lang").select("lang", "phrase", "n_words", "a", "n", F.split("phrase", " ").alias("words"))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "n_words", "a", "n", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("left"), F.expr("array_join(slice(words, k + 1, n_words - k), ' ')").alias("right"))
    # a word can be a part of very many phrases
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    known = phrases.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = lambda name, count: known.select("lang", "salt", F.col("phrase").alias(name), F.col("a").alias(count))
    cuts = cuts.join(part("left", "l"), ["lang", "salt", "left"]).join(part("right", "r"), ["lang", "salt", "right"])
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"({wide('a')} * {wide('n')} * 1000BD) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("lang", "phrase", "n_words", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "n_words", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(candidates: DataFrame, percent: int = 100) -> DataFrame:
    """Candidates that do not lie inside a longer one with ``percent`` of their count, be it kept or not."""
    inside = F.expr("flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")
    longer = candidates.where("n_words > 2").select("lang", "a", F.explode(F.array_distinct(inside)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return candidates.join(longer, ["lang", "phrase"], "left").where(f"most IS NULL OR 100 * most < {percent} * a").drop("most")


def top_ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language by score, count and phrase, with their rank.

    Ranked in shares of about RANKED rows first, until one share is left, so
    no task sorts all candidates of a language.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = stored(rows, "scored")
    shares = -(-rows.count() // RANKED)
    while shares > 1:
        within = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top).drop("rank")
        shares = min(shares - 1, -(-shares * top // RANKED))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine_collocations(docs: DataFrame, max_words: int = 5, min_count: int = 100, top: int = 2000, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases; see ``frequent_phrases``, ``scored``, ``maximal``."""
    phrases, totals = frequent_phrases(docs, max_words, min_count)
    best = top_ranked(maximal(scored(phrases, totals), percent), top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(max_words: int = 5, min_count: int = 100, top: int = 2000) -> str:
    """The same phrases in SQL."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {letters}), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    runs AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT unnest(range(1, {max_words + 1})) AS size) WHERE len(w) >= size),
    counted AS (
        SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, count(*) AS a
        FROM runs GROUP BY ALL HAVING count(*) >= {min_count}),
    cuts AS (
        SELECT lang, phrase, size, a, k, array_to_string(list_slice(w, 1, k), ' ') AS lhs, array_to_string(list_slice(w, k + 1, size), ' ') AS rhs
        FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counted WHERE size > 1)),
    judged AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
        FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = lhs JOIN counted y ON y.lang = c.lang AND y.phrase = rhs JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_runs AS (
        SELECT lang, a, array_to_string(list_slice(w, s, s + m - 1), ' ') AS phrase
        FROM (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS s
              FROM (SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS m FROM counted WHERE size > 2))),
    covered AS (SELECT lang, phrase, max(a) AS most FROM inner_runs GROUP BY lang, phrase),
    kept AS (SELECT b.* FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase WHERE most IS NULL OR 100 * most < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= {top}
    """
