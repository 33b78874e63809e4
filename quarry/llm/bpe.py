"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte runs.  Every adjacent pair that the
vocabulary can merge sits in the bucket of its merge rank; a bitmap over the
ranks, with a bitmap over its words above it, gives the lowest
non-empty rank by one find-first-set on each level.  A bucket is a position, or a heap of
positions, so equal ranks merge from the left.  Entries whose pair has changed
since are skipped when they come up.  A merge costs a constant number of bucket
operations, so a pre-token of n bytes costs O(n log n) even where it is
megabytes long.  Every pre-token that is no token itself goes through the queue, short ones too;
a worker remembers the results of short ones.

Results: null and empty texts have no tokens (hashes of the empty string);
repeated rows give repeated results; very long texts are cut into chunks only
between a non-space and a white space character, where every match of the
pattern ends anyway.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame

from quarry.llm.common import map_texts

CHUNK = 1 << 18  # characters that are split at a time
CACHED = 300_000  # pre-tokens whose result a worker remembers, in each of two generations
CACHED_CHARS = 48  # longer pre-tokens are always merged anew


class RankQueue:
    """Priority queue of (rank, position): a bitmap over the ranks by words of 64, a bitmap over those words, buckets of positions."""

    def __init__(self, bound: int):
        self.words = [0] * ((bound + 63) >> 6)
        self.top = 0  # bit w: words[w] is not zero
        self.buckets: dict[int, int | list[int]] = {}  # a position, or a heap of several

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = position
            word = rank >> 6
            if not self.words[word]:
                self.top |= 1 << word
            self.words[word] |= 1 << (rank & 63)
        elif type(bucket) is int:
            self.buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
        else:
            heapq.heappush(bucket, position)

    def take(self) -> tuple[int, int]:
        """The lowest rank that has entries, and the leftmost position in its bucket; (-1, -1) if there is none."""
        top = self.top
        if not top:
            return -1, -1
        at = (top & -top).bit_length() - 1
        word = self.words[at]
        rank = at << 6 | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if type(bucket) is int:
            position = bucket
        else:
            position = heapq.heappop(bucket)
            if bucket:
                return rank, position
        del self.buckets[rank]
        word &= word - 1
        self.words[at] = word
        if not word:
            self.top = top & (top - 1)
        return rank, position


class BytePairCoder:
    """Encoder and decoder over a rank table (token bytes -> rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile(r"\S(?=\s)").search
        self.young: dict[str, tuple[str, int, bytes]] = {}
        self.old: dict[str, tuple[str, int, bytes]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked adjacent pair merges first, the leftmost of equals."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        rank_of, n, longest, queue = self.ranks.get, len(piece), self.longest, self.queue
        push, take = queue.push, queue.take
        after = range(1, n + 1)
        before = range(-1, n - 1)
        # 4-byte arrays where lists of int objects would take much more memory
        after, before = (array("i", after), array("i", before)) if n > 4096 else (list(after), list(before))
        pair = array("i", [-1]) * n if n > 4096 else [-1] * n  # rank of the pair that starts at a node
        for i in range(n - 1):
            r = rank_of(piece[i : i + 2])
            if r is not None:
                pair[i] = r
                push(r, i)
        while True:
            r, i = take()
            if r < 0:
                break
            if pair[i] != r:
                continue  # stale: the pair was merged or has grown
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = pair[i] = -1
            if end < n:
                before[end] = i
                stop = after[end]
                if stop - i <= longest and (new := rank_of(piece[i:stop])) is not None:
                    pair[i] = new
                    push(new, i)
            left = before[i]
            if left >= 0:
                if end - left <= longest and (new := rank_of(piece[left:end])) is not None:
                    pair[left] = new
                    push(new, left)
                else:
                    pair[left] = -1
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def chunks(self, text: str) -> Iterator[str]:
        """Whole pre-tokens, about CHUNK characters at a time."""
        start, n = 0, len(text)
        while n - start > CHUNK:
            cut = self.cut(text, start + CHUNK)
            end = cut.end() if cut else n
            yield text[start:end]
            start = end
        yield text[start:]

    def encode(self, text: str) -> Iterator[int]:
        for chunk in self.chunks(text):
            for piece in self.find(chunk):
                yield from self.merge(piece.encode())

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])

    def _fresh(self, piece: str) -> tuple[str, int, bytes]:
        found = self.old.get(piece)
        if found is None:
            ids = self.merge(piece.encode())
            found = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        if len(piece) <= CACHED_CHARS:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def digest(self, text: str) -> tuple[int, str, str]:
        """Token count, sha256 of the decimal ids joined by a space, sha256 of the decoded bytes."""
        count, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
        for chunk in self.chunks(text):
            get, fresh = self.young.get, self._fresh
            coded = [get(p) or fresh(p) for p in self.find(chunk)]
            if not coded:
                continue
            ids_hash.update(((" " if count else "") + " ".join([c[0] for c in coded])).encode())
            bytes_hash.update(b"".join([c[2] for c in coded]))
            count += sum([c[1] for c in coded])
        return count, ids_hash.hexdigest(), bytes_hash.hexdigest()


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


_CODERS: dict[tuple[str, str], BytePairCoder] = {}


def coder(path: str, pattern: str) -> BytePairCoder:
    """The worker's coder for a rank file, read once in a worker."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = BytePairCoder(read_ranks(path), pattern)
    return _CODERS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text."""

    def make():
        own = coder(path, pattern)
        return lambda text: (list(own.encode(text)),)

    return map_texts(docs, make, "ids array<int>", ["doc_id"])


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ids (null: empty); bytes that are no UTF-8 become U+FFFD."""
    import pyarrow as pa

    def run(batches):
        own = coder(path, pattern)
        for b in batches:
            texts = [own.decode(x or ()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every whole text, decode the ids, and return counts and digests of both."""

    def make():
        return coder(path, pattern).digest

    return map_texts(docs, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", ["doc_id"])
