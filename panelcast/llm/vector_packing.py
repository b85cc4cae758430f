"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from panelcast.llm.encode import encoder, portions, slices
from panelcast.llm.shared import tidy

#: Examples that a task holds to choose from.
POOL = 1024
#: A task's sequences are numbered below this many.
PER_TASK = 1 << 40


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass(frozen=True)
class Example:
    """The tokens [start, end) of a document and where loss-bearing ones are."""

    key: object
    ids: np.ndarray
    bearing: np.ndarray | None  # loss-bearing tokens before each place; None: all tokens bear loss
    start: int
    end: int

    @property
    def tokens(self) -> int:
        return self.end - self.start

    @property
    def loss(self) -> int:
        return self.tokens if self.bearing is None else int(self.bearing[self.end] - self.bearing[self.start])

    def split(self, length: int) -> tuple[Example, Example]:
        at = self.start + length
        return Example(self.key, self.ids, self.bearing, self.start, at), Example(self.key, self.ids, self.bearing, at, self.end)

    def longest(self, tokens: int, loss: int) -> int:
        """The most tokens from the start on within both limits."""
        tokens = min(tokens, self.tokens)
        if self.bearing is None:
            return min(tokens, loss)
        return min(tokens, int(np.searchsorted(self.bearing, self.bearing[self.start] + loss, "right")) - 1 - self.start)


class Pool:
    """Examples to choose from, with their demands as arrays."""

    def __init__(self, limits: Limits) -> None:
        self.limits = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.examples: list[Example | None] = []
        self.free: list[int] = []
        self.demand = np.zeros((3, 64))  # tokens (0: no example), segments, loss

    def __len__(self) -> int:
        return len(self.examples) - len(self.free)

    def add(self, example: Example) -> None:
        if self.free:
            at = self.free.pop()
            self.examples[at] = example
        else:
            at = len(self.examples)
            self.examples.append(example)
            if at == self.demand.shape[1]:
                self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)], axis=1)
        self.demand[:, at] = example.tokens, 1, example.loss

    def take(self, at: int) -> Example:
        example, self.examples[at] = self.examples[at], None
        self.demand[:, at] = 0
        self.free.append(at)
        return example

    def best(self, left: np.ndarray) -> tuple[int, bool]:
        """The example with the largest dot product of its demand and what is left, and whether it fits whole.

        Both are shares of the limits, and each dimension counts by how much
        the pool demands of it. Examples that fit whole come first; if none
        does, demands count as far as there is room. -1 if nothing has room.
        """
        held = self.demand[:, : len(self.examples)]
        weight = left / self.limits**2 * held.sum(axis=1) / self.limits
        fits = (held[0] > 0) & (held <= left[:, None]).all(axis=0)
        if fits.any() and (left[1] > 1 or (held[0] >= left[0])[fits].any() or not (held[0] > left[0]).any()):
            return int(np.where(fits, weight @ held, -1.0).argmax()), True
        part = np.minimum(held, left[:, None])
        score = np.where(part[0] > 0, weight @ part, -1.0)
        for at in np.argsort(-score, kind="stable").tolist():
            if score[at] < 0:
                break
            if self.examples[at].longest(int(left[0]), int(left[2])):
                return at, False
        return -1, False


def fill(pool: Pool, limits: Limits, whole_powers: bool = True) -> list[Example]:
    """The pieces of one sequence, taken from the pool; the last one may be cut.

    A sequence that cannot be filled is trimmed to a power of two tokens, if
    such lengths need no padding; what is cut off goes back to the pool.
    """
    left, pieces = np.array([limits.tokens, limits.segments, limits.loss], float), []
    while left[0] and left[1] and len(pool):
        at, fits = pool.best(left)
        if at < 0:
            break
        piece = pool.take(at)
        if not fits:
            piece, rest = piece.split(piece.longest(int(left[0]), int(left[2])))
            if rest.tokens:
                pool.add(rest)
        pieces.append(piece)
        left -= piece.tokens, 1, piece.loss
    total = limits.tokens - int(left[0])
    excess = total - (1 << (total.bit_length() - 1)) if whole_powers and total and left[0] else 0
    while excess:
        last = pieces.pop()
        kept, rest = last.split(max(0, last.tokens - excess))
        excess -= rest.tokens
        pool.add(rest)
        if kept.tokens:
            pieces.append(kept)
    return pieces


def _sequences(examples: Iterator[Example], limits: Limits, whole_powers: bool, size: int) -> Iterator[list[Example]]:
    """Sequences from a stream of examples; the pool is kept at least half full until the stream ends."""
    pool = Pool(limits)
    for example in examples:
        while example.tokens > limits.tokens and example.longest(limits.tokens, limits.loss) == limits.tokens:
            full, example = example.split(limits.tokens)
            yield [full]
        pool.add(example)
        while len(pool) >= size:
            yield fill(pool, limits, whole_powers)
    while len(pool):
        yield fill(pool, limits, whole_powers)


def pack_examples(examples: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = 1, whole_powers: bool = True, keep_ids: bool = False) -> DataFrame:
    """Pieces of every example, placed in sequences within all three limits.

    ``examples`` has doc_id, and text or ``parts``, an array of (text, loss):
    the parts' ids follow each other, those of parts with ``loss`` bear loss,
    as the ``end_id`` after the last part does if that part does. A lone text
    bears loss everywhere; null texts and null parts are empty, a null loss is
    false. Examples are cut where that fills a sequence. Each task packs its
    own rows from a pool of POOL examples, so nothing is shuffled and one hot
    document is no more work than its tokens. With ``whole_powers`` each
    sequence is full or a power of two long, so none needs padding; else the
    last ones stay short.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss (loss-bearing tokens of the piece) and, if ``keep_ids``, ids
    (little-endian unsigned 32-bit). Rows with equal or null doc_id are
    examples like others; other columns are not read.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be at least 1")
    has_parts = "parts" in examples.columns
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss"]
    schema = T.StructType([T.StructField("doc_id", examples.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in names[1:]), *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])
    end = array("I", [end_id]).tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kinds, number = encoder(tokenizer).encode, [], TaskContext.get().partitionId() * PER_TASK

        def stream() -> Iterator[Example]:
            for batch in portions(batches):
                kinds[:] = [batch.schema.field("doc_id").type]
                for run in slices(list(zip(*(batch[c].to_pylist() for c in ("doc_id", "parts" if has_parts else "text")), strict=True)), _size):
                    yield from _encoded(run)

        def _encoded(run: list[tuple]) -> Iterator[Example]:
            if not has_parts:
                for (doc, _), ids in zip(run, encode([text or "" for _, text in run]), strict=True):
                    ids = np.frombuffer(ids + end, "<u4")
                    yield Example(doc, ids, None, 0, len(ids))
                return
            parts = [[p for p in held or [] if p] for _, held in run]
            flat = iter(encode([p["text"] or "" for held in parts for p in held]))
            for (doc, _), held in zip(run, parts, strict=True):
                found = [np.frombuffer(next(flat), "<u4") for _ in held]
                bears = [bool(p["loss"]) for p in held] or [False]
                ids = np.concatenate([*found, np.frombuffer(end, "<u4")])
                marks = np.concatenate([np.full(len(i), b) for i, b in zip([*found, end[:1]], [*bears[: len(found)], bears[-1]], strict=True)])
                yield Example(doc, ids, np.concatenate([[0], np.cumsum(marks)]), 0, len(ids))

        out: list[tuple] = []
        for pieces in _sequences(stream(), limits, whole_powers, POOL):
            offset = 0
            for p in pieces:
                part = p.ids[p.start : p.end].tobytes()
                out.append((p.key, p.start, p.tokens, zlib.crc32(part), len(p.ids), number, offset, p.loss, *([part] if keep_ids else [])))
                offset += p.tokens
            number += 1
            if len(out) >= 2000:
                yield send(out, kinds[0])
                out = []
        if out:
            yield send(out, kinds[0])

    def send(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, *[pa.int64()] * 7, *([pa.binary()] if keep_ids else [])]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=schema.names)

    return examples.select("doc_id", "parts" if has_parts else "text").mapInArrow(tidy(packed), schema)


def _size(row: tuple) -> int:
    return len(row[1] or "") if not isinstance(row[1], list) else sum(len((p or {}).get("text") or "") for p in row[1])


def dialogues(conversations: DataFrame, bearing: tuple[str, ...] = ("assistant",), turns: int = 64) -> DataFrame:
    """Examples (doc_id, parts) of ``turns`` consecutive turns at most; the turns of ``bearing`` roles bear loss.

    ``doc_id`` is a struct of conv_id and block. A conversation's turns are
    gathered by their number divided by ``turns``, so a long one is many rows;
    repeated rows count once, a null turn is turn 0.
    """
    turn = F.coalesce(F.col("turn"), F.lit(0)).cast("long")
    part = F.struct(turn.alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id", F.floor(turn / turns).alias("block")).agg(F.array_sort(F.collect_set(part)).alias("held"))
    return grouped.select(F.struct("conv_id", "block").alias("doc_id"), F.transform("held", lambda p: F.struct(p["text"].alias("text"), p["role"].isin(*bearing).alias("loss"))).alias("parts"))
