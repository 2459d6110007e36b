"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding.

The vocabulary file is a parameter and is read on each executor, once a worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from postboard.llm.common import rows_of

#: Fixed value: how byte-level BPE cuts a text into pieces that are encoded apart.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cut for texts in which Python's own classes agree with the Unicode ones; it is faster.
PLAIN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_PLAIN = r"[\x1c-\x1f\x85²³¹¼-¾ɐ-\U0010ffff]"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary's strings."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: Bits of a queue entry that tell the place: between the result's 16 bits and the rank. Ids must stay below 65,536.
PLACES = (1 << 32) - 1
STEADY = ~(PLACES << 16)


class Seen(dict):
    """Ids of pieces met before. Two generations of bounded size: what is used moves to the young one, the old one goes."""

    def __init__(self, merge: Callable[[bytes], list[int]], size: int) -> None:
        super().__init__()
        self.merge, self.size, self.old = merge, size, {}

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        found = self[piece] = self.old.get(piece) or self.merge(piece.encode())
        return found


class Bpe:
    """One vocabulary. `special` strings are cut out of a text first and have ids of their own."""

    def __init__(self, path: str, cache_size: int = 300_000) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.single = {letters[s]: i for s, i in vocab.items() if len(s) == 1}
        self.ranks = {vocab[a] << 16 | vocab[b]: (rank + 1) << 48 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        if size > 1 << 16:
            raise ValueError(f"ids up to {size - 1}: a queue entry has room for 65,535")
        self.strings = [b""] * size
        for s, i in vocab.items():
            self.strings[i] = as_bytes(s)
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.decimals = [str(i) for i in range(size)]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces, self.plain, self.not_plain = regex.compile(PIECES), re.compile(PLAIN_PIECES), re.compile(NOT_PLAIN)
        self.cache = Seen(self.merge, cache_size)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece. The queue holds rank, place and result as one number; an entry is stale, and skipped, when
        the pair that now stands at its place is another one."""
        ids, get = [*map(self.single.__getitem__, piece)], self.ranks.get
        n = len(ids)
        now = [get(a << 16 | b, 0) for a, b in zip(ids, ids[1:], strict=False)]
        queue = [found | at << 16 for at, found in enumerate(now) if found]
        if len(queue) < 2 and n == 2:
            return [queue[0] & 0xFFFF] if queue else ids
        heapify(queue)
        now.append(0)
        before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        while queue:
            entry = heappop(queue)
            left = entry >> 16 & PLACES
            if now[left] != entry & STEADY:
                continue
            new, gone = entry & 0xFFFF, after[left]
            right = after[left] = after[gone]
            ids[left], ids[gone], now[gone] = new, -1, 0
            if right < n:
                before[right] = left
                now[left] = found = get(new << 16 | ids[right], 0)
                if found:
                    heappush(queue, found | left << 16)
            else:
                now[left] = 0
            if (at := before[left]) >= 0:
                now[at] = found = get(ids[at] << 16 | new, 0)
                if found:
                    heappush(queue, found | at << 16)
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> list[int]:
        if not (self.cut and any(s in text for s in self.special)):
            return self.encode_part(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self.encode_part(part)
        return out

    def encode_part(self, text: str) -> list[int]:
        pieces = (self.pieces if self.not_plain.search(text) else self.plain).findall(text)
        return [*chain.from_iterable(map(self.cache.__getitem__, pieces))]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings put together; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    return Bpe(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of each row. Null counts as the empty text, which has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for doc_ids, texts in rows_of(batches, "doc_id", "text"):
            for at in range(0, len(texts), 200):
                ids = [bpe.encode(t or "") for t in texts[at : at + 200]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[at : at + 200], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, and SHA-256 of its decimal ids joined by commas and of the decoded text.

    The digests are taken where the ids are made, so that the ids need not travel. Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for doc_ids, texts in rows_of(batches, "doc_id", "text"):
            n, of_ids, of_text = [], [], []
            for t in texts:
                ids = bpe.encode(t or "")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(bpe.decimals.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
