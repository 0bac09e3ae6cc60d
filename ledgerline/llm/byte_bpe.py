"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: it resolves the pre-tokens that are tokens
themselves. Tier two merges the rest on a heap over linked bytes. A worker remembers what it has
resolved, up to a bound.

Defined cases: a null text encodes as an empty one (no identifiers); repeated rows each give a row;
the length of a text is not limited; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import Memo, map_batches, utf8


class PerfectHash:
    """Minimal perfect hash by displacement: a key's slot is its hash, mixed with its bucket's displacement.

    Buckets of several keys search a displacement that puts all of them on free slots, largest bucket
    first; a bucket of one key stores its slot itself, as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.keys, self.n, self.buckets = keys, len(keys), max(1, len(keys) * 2 // 5)
        h = self.hashes(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if keys else []
        free = np.ones(self.n, bool)
        self.displacement = [0] * self.buckets
        self.key_at = [0] * self.n
        single = []
        for group in sorted(groups, key=len, reverse=True):
            if len(group) == 1:
                single.append(int(group[0]))
                continue
            d, tries = 0, 4
            while True:
                slots = self.slots(h[group], np.arange(d, d + tries)[:, None])
                good = [k for k in np.flatnonzero(free[slots].all(axis=1)).tolist() if len(set(slots[k].tolist())) == len(group)]
                if good:
                    d, slots = d + good[0], slots[good[0]]
                    break
                d, tries = d + tries, min(4 * tries, 1024)
            free[slots] = False
            for slot, key in zip(slots.tolist(), group.tolist(), strict=True):
                self.key_at[slot] = key
            self.displacement[bucket[group[0]]] = d
        for key, slot in zip(single, np.flatnonzero(free).tolist(), strict=True):
            self.displacement[bucket[key]] = -1 - slot
            self.key_at[slot] = key

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)

    def slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        mixed = (h ^ (np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B1))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((mixed >> np.uint64(24)) % np.uint64(self.n)).astype(np.int64)

    def find(self, key: bytes) -> int:
        """The index of a key, -1 if it is not in the set."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        slot = -1 - d if d < 0 else ((((h ^ d * 0x9E3779B1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF) >> 24) % self.n)
        found = self.key_at[slot]
        return found if self.keys[found] == key else -1


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        keys = list(self.ranks)
        self.index, self.rank_of = PerfectHash(keys), [self.ranks[k] for k in keys]
        # white space as Unicode's property, which is what the library's engine means by it
        self.split = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.doubled = regex.compile(r"\p{White_Space}{2}").search
        self.first, self.later = Memo(self.piece), Memo(lambda piece: self.piece(" " + piece))

    def merge(self, word: bytes) -> list[int]:
        """Identifiers of a word that is no token: merges on a heap over linked bytes."""
        n, rank_of = len(word), self.ranks.get
        parts = [word[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        # an entry is rank * n + position
        heap = [r * n + i for i in range(n - 1) if (r := rank_of(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j, first = right[i], parts[i]
            if not first or j >= n or rank_of(joined := first + parts[j]) != rank:
                continue
            parts[i], parts[j] = joined, b""
            after = right[i] = right[j]
            if after < n:
                left[after] = i
                if (r := rank_of(joined + parts[after])) is not None:
                    heapq.heappush(heap, r * n + i)
            if (before := left[i]) >= 0 and (r := rank_of(parts[before] + joined)) is not None:
                heapq.heappush(heap, r * n + before)
        return [self.ranks[p] for p in parts if p]

    def word(self, word: str) -> list[int]:
        key = utf8(word)
        found = self.index.find(key)
        return [self.rank_of[found]] if found >= 0 else self.merge(key)

    def piece(self, text: str) -> bytes:
        """Identifiers of a text, as little-endian 32-bit numbers."""
        return array("I", [i for w in self.split(text) for i in self.word(w)]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Identifiers of each text. Where no two white-space characters meet, a blank belongs to the piece
        that follows it and a line feed stands alone, so that pieces can be looked up one by one."""
        out, first, later = [], self.first, self.later.__getitem__
        for text in texts:
            if not text or self.doubled(text):
                out.append(self.piece(text or ""))
                continue
            lines = []
            for line in text.split("\n"):
                pieces = line.split(" ")
                lines.append(first[pieces[0]] + b"".join(map(later, pieces[1:])))
            out.append(first["\n"].join(lines))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and ids array<int> of every text."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        ids = codec(vocabulary, pattern).encode(columns["text"])
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "ids": pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))}

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, content binary and error of every row of identifiers.

    Null identifiers give empty content; a row with one that is null or outside the vocabulary has null content and an error.
    """

    def one(use: Codec, ids: list | None) -> tuple[bytes | None, str | None]:
        strange = [i for i in ids or () if i is None or i not in use.tokens]
        return (None, f"no token {strange[0]}") if strange else (b"".join(map(use.tokens.__getitem__, ids or ())), None)

    def batch(columns: dict[str, list]) -> dict[str, object]:
        use = codec(vocabulary, pattern)
        content, error = zip(*(one(use, x) for x in columns["ids"]), strict=True)
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "content": pa.array(content, pa.binary()), "error": pa.array(error, pa.string())}

    return map_batches(encoded.select("doc_id", "ids"), batch, "doc_id long, content binary, error string")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digest of what encoding and then decoding give."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        use = codec(vocabulary, pattern)
        ids = use.encode(columns["text"])
        return {
            "doc_id": pa.array(columns["doc_id"], pa.int64()),
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(use.decode(x)).hexdigest() for x in ids],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, schema)
