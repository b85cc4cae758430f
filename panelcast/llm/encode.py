"""Token ids of whole texts with a tokenizer file, remembered by piece.

A piece starts at a space, a line feed, or a mark after a letter or digit.
Pre-tokens of both supported kinds never run across such a place, so the ids
of a text are those of its pieces one after the other. A piece's ids come from
the tokenizer once and are then found by the hash of its bytes, for millions
of pieces at a time; the bytes found are compared with the piece's, so a
collision costs time only. Texts with runs of white space, where that does not
hold, and other kinds of tokenizer go through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np

from panelcast.llm.hashing import Places, range_hashes

#: Bits of the slots for remembered pieces in one worker (28 MB and the pieces); half full, only frequent ones are kept.
MEMO_BITS = 20
#: Ids and bytes remembered, at most, before rare pieces are dropped.
POOL = 1 << 24
#: Longer texts are encoded in segments of about so many characters.
SEGMENT = 1_000_000

#: White space of one byte in Latin-1 other than the space and the line feed.
_OTHER_SPACE = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_OTHER = re.compile(r"[^\S \n]")
#: After an ASCII letter or digit these start a pre-token of their own.
_MARK, _ALNUM = (np.array([chr(b) in s for b in range(256)]) for s in (".,;:!?%&$#*|", string.ascii_letters + string.digits))


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, one bytes object per text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        pre, model, normalizer = spec["pre_tokenizer"] or {}, spec["model"], spec["normalizer"]
        plain = not spec.get("post_processor") and model["type"] == "BPE"
        keeps_space = not normalizer and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        drops_space = model.get("end_of_word_suffix") and pre.get("type") == "Sequence"
        self.by_piece, self.keeps_space = plain and bool(keeps_space or drops_space), bool(keeps_space)
        self.lower = not keeps_space and any(n["type"] == "Lowercase" for n in (normalizer or {}).get("normalizers", []))
        self._start()

    def _start(self) -> None:
        self.places = Places(MEMO_BITS)
        self.start, self.count, self.byte_start, self.byte_count, self.hits = (np.zeros(1 << MEMO_BITS, np.int32) for _ in range(5))
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.bytes, self.bytes_used = np.zeros(1 << 20, np.uint8), 0

    def _forget(self) -> None:
        """Keeps the pieces seen most often, an eighth of the slots at most, and drops the others."""
        held = np.flatnonzero(self.places.keys)
        held = held[np.argsort(-self.hits[held], kind="stable")][: len(self.places.keys) // 8]
        held = held[(self.hits[held] > 1) & (self.count[held] + self.byte_count[held] < 256)]
        keys, count, byte_count = self.places.keys[held], self.count[held], self.byte_count[held]
        at, byte_at = np.cumsum(count) - count, np.cumsum(byte_count) - byte_count
        ids = self.pool[np.repeat(self.start[held] - at, count) + np.arange(count.sum())]
        data = self.bytes[np.repeat(self.byte_start[held] - byte_at, byte_count) + np.arange(byte_count.sum())]
        self._start()
        slots = self.places.add(keys)
        self.start[slots], self.count[slots], self.byte_start[slots], self.byte_count[slots] = at, count, byte_at, byte_count
        self.pool, self.used = _grown(self.pool, len(ids)), len(ids)
        self.bytes, self.bytes_used = _grown(self.bytes, len(data)), len(data)
        self.pool[: len(ids)], self.bytes[: len(data)] = ids, data

    def _in_pieces(self, text: str) -> bool:
        """Whether the ids are those of the pieces: white space is spaces and line feeds, without runs if it is kept."""
        if not self.by_piece:
            return False
        if self.keeps_space and ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1:].isspace()):
            return False
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return not _OTHER.search(text)
        return len(data.translate(None, _OTHER_SPACE)) == len(data)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        batch: list[tuple[int, bytes]] = []
        size = 0
        for k, text in enumerate(texts):
            if not self._in_pieces(text):
                out[k].append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            for segment in _segments(text):
                data = segment.encode()
                batch.append((k, data.lower() if self.lower else data))
                size += len(data)
                if size >= SEGMENT:
                    self._pieces(batch, out)
                    batch, size = [], 0
        self._pieces(batch, out)
        return [b"".join(parts) for parts in out]

    def _pieces(self, batch: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        """Adds the ids of each segment, looked up piece by piece."""
        data = b"".join(d for _, d in batch)
        if not data:
            return
        if self.places.size > 1 << (MEMO_BITS - 1) or self.used + self.bytes_used > POOL:
            self._forget()
        chars = np.frombuffer(data, np.uint8)
        edges = np.concatenate([[0], np.cumsum([len(d) for _, d in batch])])
        begins = (chars == 32) | (chars == 10)
        begins[1:] |= _MARK[chars[1:]] & _ALNUM[chars[:-1]]
        begins[edges[:-1][edges[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        keys = range_hashes(chars, starts, ends) | np.uint64(1)
        slots = self.places.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            at = missing[first]
            self._remember(new, [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            slots[missing] = self.places.find(keys[missing])
        self.hits += np.bincount(slots, minlength=len(self.hits)).astype(np.int32)
        begin, counts = self.start[slots].astype(np.int64), self.count[slots].astype(np.int64)
        for at in np.flatnonzero(self._differ(chars, starts, ends, slots)).tolist():  # another piece has the same hash
            found, size = self._add_ids([data[starts[at] : ends[at]]])
            begin[at], counts[at] = found[0], size[0]
        after = np.concatenate([[0], np.cumsum(counts)])
        ids = self.pool[np.repeat(begin - after[:-1], counts) + np.arange(after[-1])]
        bounds = after[np.searchsorted(starts, edges)].tolist()
        for (k, _), a, b in zip(batch, bounds[:-1], bounds[1:], strict=True):
            out[k].append(ids[a:b].tobytes())

    def _differ(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether each piece (together they are ``chars``) has other bytes than the remembered one."""
        lengths, begin = ends - starts, self.byte_start[slots].astype(np.int64)
        other = self.byte_count[slots] != lengths
        begin[other] = 0
        place = np.repeat(begin - starts, lengths) + np.arange(len(chars))
        if other.any():
            place = np.minimum(place, len(self.bytes) - 1)
        return other | np.logical_or.reduceat(self.bytes[place] != chars, starts)

    def _add_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids are put, and how many."""
        encode = self.tokenizer.encode
        ids = [encode(p.decode(), add_special_tokens=False).ids for p in pieces]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        after = self.used + np.cumsum(count)
        self.pool = _grown(self.pool, int(after[-1]))
        self.pool[self.used : after[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))
        self.used = int(after[-1])
        return after - count, count

    def _remember(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        slots = self.places.add(keys)
        self.start[slots], self.count[slots] = self._add_ids(pieces)
        count = np.fromiter(map(len, pieces), np.int64, len(pieces))
        after = self.bytes_used + np.cumsum(count)
        self.bytes = _grown(self.bytes, int(after[-1]))
        self.bytes[self.bytes_used : after[-1]] = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_start[slots], self.byte_count[slots] = after - count, count
        self.bytes_used = int(after[-1])


def _grown(pool: np.ndarray, size: int) -> np.ndarray:
    """The array, or a longer one with its values, that holds ``size`` values."""
    return pool if size <= len(pool) else np.concatenate([pool, np.zeros(max(len(pool), size - len(pool)), pool.dtype)])


def _segments(text: str) -> Iterator[str]:
    """The text in parts that start with a space, so that no pre-token is cut."""
    while len(text) > 2 * SEGMENT and (at := text.find(" ", SEGMENT)) > 0:
        yield text[:at]
        text = text[at:]
    yield text


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def slices(rows: list, size, limit: int = 2_000_000):
    """Consecutive runs of rows whose sizes add up to about the limit, one at least."""
    run, total = [], 0
    for row in rows:
        run.append(row)
        total += size(row)
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run


def portions(batches: Iterator, rows: int = 1000) -> Iterator:
    """The batches in parts of a few rows, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
