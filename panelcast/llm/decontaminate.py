"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from panelcast.llm.encode import portions
from panelcast.llm.hashing import Places, mixed
from panelcast.llm.shared import released, stored, tidy
from panelcast.session import new_path

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Upper case folded, and all that is in no word turned into spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def folded(text: str | None) -> bytes:
    return (text or "").encode().translate(_FOLD)


class SuffixAutomaton:
    """All runs of words of the items, with the items of each window, as arrays.

    A window is ``window`` consecutive words of an item; an item of fewer
    words, but not none, is one window. States have a link, the length of
    their longest run, ``top`` (the state of their last ``window`` words, -1
    if they are shorter) and ``short`` (the nearest state on their links, or
    themselves, where an item shorter than a window ends; -1). Transitions
    are in one hash table by state and word.
    """

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int) -> None:
        self.window, self.words = window, {}
        sequences = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in items if words]
        self.least = min([window, *(len(s) for _, s in sequences)])
        self._link, self._length = array("i", [-1]), array("i", [0])
        self._head, self._edge_word, self._edge_next, self._edge = array("i", [-1]), array("i"), array("i"), {}
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.link, self.length = np.array(self._link, np.int32), np.array(self._length, np.int32)
        self._mark(sequences)
        self.keys = np.fromiter(self._edge, np.uint64, len(self._edge))
        self.targets = np.fromiter(self._edge.values(), np.int32, len(self._edge))
        del self._link, self._length, self._head, self._edge_word, self._edge_next, self._edge

    def _set(self, state: int, word: int, target: int) -> None:
        key = state << 32 | word
        if key not in self._edge:
            self._edge_word.append(word)
            self._edge_next.append(self._head[state])
            self._head[state] = len(self._edge_word) - 1
        self._edge[key] = target

    def _extend(self, last: int, word: int) -> int:
        target = self._edge.get(last << 32 | word)
        if target is not None:
            return target if self._length[target] == self._length[last] + 1 else self._clone(last, word, target)
        state, at = self._state(self._length[last] + 1), last
        while at >= 0 and at << 32 | word not in self._edge:
            self._set(at, word, state)
            at = self._link[at]
        if at < 0:
            self._link[state] = 0
        else:
            target = self._edge[at << 32 | word]
            self._link[state] = target if self._length[target] == self._length[at] + 1 else self._clone(at, word, target)
        return state

    def _state(self, length: int) -> int:
        self._head.append(-1)
        self._link.append(0)
        self._length.append(length)
        return len(self._length) - 1

    def _clone(self, at: int, word: int, target: int) -> int:
        twin, edge = self._state(self._length[at] + 1), self._head[target]
        while edge >= 0:
            follows = self._edge_word[edge]
            self._set(twin, follows, self._edge[target << 32 | follows])
            edge = self._edge_next[edge]
        self._link[twin], self._link[target] = self._link[target], twin
        while at >= 0 and self._edge.get(at << 32 | word) == target:
            self._edge[at << 32 | word] = twin
            at = self._link[at]
        return twin

    def _mark(self, sequences: list[tuple[int | None, list[int]]]) -> None:
        """The items of each state that stands for a window, and the short items that end at each state."""
        states = len(self.length)
        self.top, self.short = np.full(states, -1, np.int32), np.full(states, -1, np.int32)
        self.ids = sorted({item for item, _ in sequences if item is not None})
        number, pairs = {item: k for k, item in enumerate(self.ids)}, array("q")
        self.ends: dict[int, dict[int, set]] = {}
        order = np.argsort(self.length, kind="stable").tolist()
        for state in order:
            if self.length[state] >= self.window:
                above = int(self.link[state])
                self.top[state] = state if self.length[above] < self.window else self.top[above]
        for item, sequence in sequences:
            at = 0
            for word in sequence:
                at = self._edge[at << 32 | word]
                if self.top[at] >= 0 and item is not None:
                    pairs.append(int(self.top[at]) << 32 | number[item])
            if len(sequence) < self.window:
                while at and self.length[self.link[at]] >= len(sequence):
                    at = int(self.link[at])
                self.ends.setdefault(at, {}).setdefault(len(sequence), set()).update([] if item is None else [item])
        self.pairs = np.unique(np.array(pairs, np.int64))  # state and item
        for state in order[1:]:
            self.short[state] = state if state in self.ends else self.short[self.link[state]]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_places"}

    def _next(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The state after each word, -1 without a transition."""
        if not hasattr(self, "_places"):
            self._places = Places(max(4, int(np.ceil(np.log2(1.3 * len(self.keys) + 1)))))
            slots = self._places.add(mixed(self.keys + np.uint64(1)))
            self._target = np.zeros(len(self._places.keys), np.int32)
            self._target[slots] = self.targets
        slots = self._places.find(mixed((states.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64)) + np.uint64(1)))
        return np.where(slots < 0, -1, self._target[slots])

    def _items(self, state: int) -> set:
        """The items of a window."""
        first, after = np.searchsorted(self.pairs, [state << 32, (state + 1) << 32])
        return {self.ids[k] for k in (self.pairs[first:after] & 0xFFFFFFFF).tolist()}

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans [start, end) of words in any occurrence of a window, merged, and the items found."""
        return self.find_all([words])[0]

    def find_all(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """``find`` for many texts; all runs of known words in them are followed side by side."""
        out: list[tuple[list[tuple[int, int]], set]] = [([], set()) for _ in texts]
        edges = np.cumsum([0, *map(len, texts)])
        ids = np.fromiter(map(self.words.get, chain.from_iterable(texts), repeat(-1)), np.int64, int(edges[-1]))
        known = np.concatenate([[False], ids >= 0, [False]])
        begins, ends = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(known[:-1] & ~known[1:])
        cuts = np.unique(np.concatenate([begins, edges[:-1]]))  # a run ends with its text
        begins = cuts[(cuts < len(ids)) & known[1:][np.minimum(cuts, len(ids))]]
        ends = np.minimum(ends[np.searchsorted(ends, begins, "right")], edges[np.searchsorted(edges, begins, "right")]) if len(begins) else begins
        some = ends - begins >= self.least
        begins, ends = begins[some], ends[some]
        state, length = self._followed(ids, begins, ends)
        hits = np.flatnonzero((length >= self.window) | ((self.short[state] >= 0) & (length > 0)))
        owner = np.searchsorted(edges, hits, "right") - 1
        for at, text, s, n in zip(hits.tolist(), owner.tolist(), state[hits].tolist(), length[hits].tolist(), strict=True):
            spans, items = out[text]
            reach = n if n >= self.window else 0
            if reach:
                items |= self._items(int(self.top[s]))
            end = int(self.short[s])
            while end >= 0:
                for size, found in self.ends[end].items():
                    if size <= n:
                        reach = max(reach, size)
                        items |= found
                end = int(self.short[self.link[end]])
            if reach:
                after = at + 1 - int(edges[text])
                first = after - reach
                while spans and spans[-1][1] >= first:  # overlapping or touching
                    first = min(first, spans.pop()[0])
                spans.append((first, after))
        return out

    def _followed(self, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State, and longest matching length, after each word of the runs; 0 elsewhere."""
        state, length = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int32)
        order = np.argsort(begins - ends, kind="stable")  # longest first, so that those still going come first
        at, last = begins[order], ends[order]
        s, n = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        while len(at):
            words = ids[at]
            then = self._next(s, words)
            while (lost := np.flatnonzero((then < 0) & (s > 0))).size:
                s[lost] = self.link[s[lost]]
                n[lost] = self.length[s[lost]]
                then[lost] = self._next(s[lost], words[lost])
            n = np.where(then < 0, 0, n + 1)
            s = np.maximum(then, 0).astype(np.int64)
            state[at], length[at] = s, n
            going = int(np.searchsorted(-(last - at), -1, "right"))  # descending numbers of words left
            at, last, s, n = at[:going] + 1, last[:going], s[:going], n[:going]
            left = int(np.searchsorted(-(last - at), 0))
            at, last, s, n = at[:left], last[:left], s[:left], n[:left]
        return state, length


def automata(items: DataFrame, window: int = 10, shard_words: int = 1 << 19) -> DataFrame:
    """automaton, share: serialised automata of all items, one for each share of about ``shard_words`` words.

    Each is built in a task and written to a file of its own; its size, and so
    what each scan sends to the workers, is bounded by the share.
    """
    rows = items.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shares = max(1, -(-size // (6 * shard_words)))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        made = SuffixAutomaton([(i, folded(t).split()) for i, t in zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True)], window)
        found = pa.table({"automaton": pa.array([pickle.dumps(made)], pa.binary()), "share": pa.array([key[0].as_py()], pa.int64())})
        released()
        return found

    dealt = rows.groupBy(F.pmod(F.xxhash64("text", "item_id"), F.lit(shares)).alias("share"))
    schema, path = "automaton binary, share long", new_path(items.sparkSession, "automata")
    dealt.applyInArrow(build, schema).write.partitionBy("share").parquet(path)
    return items.sparkSession.read.schema(schema).parquet(path)


def _shares(made: DataFrame) -> list[int]:
    return sorted(r["share"] for r in made.select("share").distinct().collect())


def _sent(made: DataFrame, share: int) -> Broadcast:
    """The automaton of one share, fetched and broadcast."""
    return made.sparkSession.sparkContext.broadcast(made.where(F.col("share") == share).first()["automaton"])


@lru_cache(maxsize=1)
def _loaded(data: bytes) -> SuffixAutomaton:
    return pickle.loads(data)


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, shard_words: int = 1 << 19) -> DataFrame:
    """What each document shares with the items.

    Columns: doc_id, n_words, spans (array of word positions [start, end)) and
    item_ids (distinct, of any occurring window; a null item_id marks words but
    is not listed). A row for each row of ``docs``: null and empty texts have
    no words; repeated rows give repeated results; other columns are not read.
    Without items nothing is found. The item_id is an integer.
    """
    made = automata(items, window, shard_words)
    shares = _shares(made)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    if len(shares) < 2:
        return _scanned(rows, _sent(made, shares[0]) if shares else None, window).drop("uid")
    return _scanned_by_all(stored(rows, "documents"), made, shares, window).drop("uid")


def _scanned(rows: DataFrame, data: Broadcast | None, window: int) -> DataFrame:
    """``rows`` with n_words, spans and item_ids by one automaton in the place of text."""
    keys = [f for f in rows.schema if f.name != "text"]
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*keys, T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("item_ids", T.ArrayType(T.LongType()))])
    names, own = schema.names, [f.name for f in keys]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _loaded(data.value) if data else SuffixAutomaton([], window)
        for batch in portions(batches, 500):
            texts = [folded(t).split() for t in batch["text"].to_pylist()]
            n_words, spans, ids = list(map(len, texts)), [], []
            for where, which in automaton.find_all(texts):
                spans.append([{"start": a, "end": b} for a, b in where])
                ids.append(sorted(which))
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in own), *(pa.array(c, k) for c, k in zip((n_words, spans, ids), kinds, strict=True))], names=names)

    return rows.mapInArrow(tidy(found), schema)


def _scanned_by_all(rows: DataFrame, made: DataFrame, shares: list[int], window: int) -> DataFrame:
    """``_scanned`` by the automata of several shares; ``rows`` are written and have a uid.

    Each share's scan is written before the next automaton is fetched, so the
    driver holds one at a time.
    """
    parts = None
    for share in shares:
        data = _sent(made, share)
        part = stored(_scanned(rows, data, window), "scanned")
        data.destroy()
        parts = part if parts is None else parts.unionByName(part)
    others = [c for c in parts.columns if c not in ("uid", "spans", "item_ids")]
    merged = parts.groupBy("uid").agg(*(F.first(c).alias(c) for c in others), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"))
    return merged.select("uid", *others, _merged_spans(F.array_sort("spans")).alias("spans"), "item_ids")


def _merged_spans(spans):
    """Sorted spans with those that overlap or touch made one."""

    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.slice(spans, 1, 0), add)


def remove_windows(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.8, shard_words: int = 1 << 19) -> DataFrame:
    """``docs`` without spans of words that occur in an item.

    A document of whose words more than ``max_coverage`` are hit goes; in the
    others each span of hit words is replaced by a line break, again until none
    is left (cutting can bring a window's ends together). Texts without a hit,
    null ones included, stay as they are, and so do all other columns.
    """
    made = automata(items, window, shard_words)
    shares = _shares(made)
    if len(shares) > 1:
        return _removed_by_all(docs, made, shares, window, max_coverage)
    schema, columns = docs.schema, docs.columns

    def cut(data):
        def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _loaded(data.value)
            for batch in portions(batches, 500):
                place, given = columns.index("text"), batch["text"].to_pylist()
                texts = all_without_windows(automaton, given, max_coverage)
                keep = [kept is not None or text is None for kept, text in zip(texts, given, strict=True)]
                arrays = [pa.array(texts, batch.schema.field("text").type) if i == place else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep, pa.bool_()))

        return cleaned

    return docs.mapInArrow(tidy(cut(_sent(made, shares[0]))), schema) if shares else docs


def _removed_by_all(docs: DataFrame, made: DataFrame, shares: list[int], window: int, max_coverage: float) -> DataFrame:
    """``remove_windows`` by the automata of several shares.

    The spans of all shares are found in the same text and merged before it is
    judged and cut; the cut texts go through all shares again, until none has
    a hit.
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*(docs[c] for c in docs.columns)).alias("row")), "documents")
    texts, cuts, turn = rows.select("uid", F.col("row.text").alias("text")).where("text IS NOT NULL"), None, 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            for text, n_words, spans in zip(*(batch[c].to_pylist() for c in ("text", "n_words", "spans")), strict=True):
                where = [(s["start"], s["end"]) for s in spans]
                out.append(None if batch["turn"][0].as_py() == 0 and _covered(where) > max_coverage * n_words else _cut(text, where))
            yield pa.RecordBatch.from_arrays([batch["uid"], batch["turn"], pa.array(out, pa.string())], names=["uid", "turn", "text"])

    while True:
        hits = _scanned_by_all(texts, made, shares, window).where(F.size("spans") > 0).select("uid", "n_words", "spans", F.lit(turn).alias("turn"))
        done = stored(texts.join(hits, "uid").mapInArrow(tidy(cut), "uid long, turn int, text string"), "cut")
        if done.isEmpty():
            break
        cuts = done if cuts is None else cuts.unionByName(done)
        texts, turn = done.where("text IS NOT NULL").select("uid", "text"), turn + 1
    text = F.col("row").getField("text")
    if cuts is not None:
        last = cuts.groupBy("uid").agg(F.max(F.struct("turn", "text")).alias("cut"))  # one row a turn
        rows = rows.join(last, "uid", "left").where("cut IS NULL OR cut.text IS NOT NULL")
        text = F.when(F.col("cut").isNull(), text).otherwise(F.col("cut.text"))
    return rows.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def without_windows(automaton: SuffixAutomaton, text: str | None, max_coverage: float) -> str | None:
    """The text without hit spans; None if too much of it is hit, or for None."""
    return all_without_windows(automaton, [text], max_coverage)[0]


def all_without_windows(automaton: SuffixAutomaton, texts: list[str | None], max_coverage: float) -> list[str | None]:
    """``without_windows`` of many texts; those that were cut are looked at again, until none has a hit."""
    out, left, first = list(texts), [k for k, t in enumerate(texts) if t], True
    while left:
        words = [folded(out[k]).split() for k in left]
        again = []
        for k, own, (spans, _) in zip(left, words, automaton.find_all(words), strict=True):
            if not spans:
                continue
            if first and _covered(spans) > max_coverage * len(own):
                out[k] = None
            else:
                out[k] = _cut(out[k], spans)
                again.append(k)
        left, first = [k for k in again if out[k]], False
    return out


def _covered(spans: list[tuple[int, int]]) -> int:
    return sum(b - a for a, b in spans)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with a line break for each span of words."""
    data = text.encode()
    places = [m.span() for m in WORD.finditer(data.translate(_FOLD))]
    out, at = [], 0
    for start, end in spans:
        out += [data[at : places[start][0]], b"\n"]
        at = places[end - 1][1]
    return b"".join([*out, data[at:]]).decode()


def oracle(window: int = 10) -> str:
    """The digest of ``find_windows`` over documents and benchmark in SQL."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    words = f"regexp_extract_all(translate(coalesce(text, ''), {letters}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = "unnest(range(1, len(w) - size + 2)) AS k0, size"
    return f"""
    WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, size, list_slice(w, k0, k0 + size - 1) AS words
        FROM (SELECT item_id, w, {runs} FROM (SELECT *, least(len(w), {window}) AS size FROM items WHERE len(w) > 0))),
    docs AS (SELECT doc_id, {words} AS w FROM documents),
    found AS (
        SELECT DISTINCT doc_id, item_id, k0, size
        FROM (SELECT doc_id, k0, size, list_slice(w, k0, k0 + size - 1) AS words
              FROM (SELECT doc_id, w, {runs} FROM docs, (SELECT DISTINCT size FROM item_windows)))
        JOIN item_windows USING (size, words)),
    hits AS (
        SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(k0, k0 + size)) AS k FROM found) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
    """
