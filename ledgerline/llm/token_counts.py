"""Token counts by byte-pair merging on a heap and a linked list.

The heap yields the lowest-ranked adjacent pair, the linked list gives its neighbours, and the count is
the initial symbols less the merges made. No identifiers are produced. No pre-token spans white space,
so a worker remembers counts by the pieces between white space, up to a bound.

Defined cases: a null text counts as an empty one (0 tokens); repeated rows each give a row; the length
of a text is not limited; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, map_batches, utf8


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols that are left when the lowest-ranked adjacent pair has been merged as long as there is one."""
    n, rank_of = len(symbols), ranks.get
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    # an entry is rank * n + position
    heap = [rank * n + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := rank_of(pair)) is not None]
    heapq.heapify(heap)
    symbols, merges = list(symbols), 0
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        j, first = right[i], symbols[i]
        # an entry is stale if either symbol has changed since; ranks are unique to a pair
        if not first or j >= n or rank_of((first, symbols[j])) != rank:
            continue
        joined = symbols[i] = first + symbols[j]
        symbols[j] = ""
        merges += 1
        after = right[i] = right[j]
        if after < n:
            left[after] = i
            if (rank := rank_of((joined, symbols[after]))) is not None:
                heapq.heappush(heap, rank * n + i)
        if (before := left[i]) >= 0 and (rank := rank_of((symbols[before], joined))) is not None:
            heapq.heappush(heap, rank * n + before)
    return n - merges


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Counter:
    """Token counts as the library gives them for a BPE file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.alphabet = byte_symbols()
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.spaces = regex.compile(r"\P{White_Space}+").findall
        self.controls = regex.compile(r"[\x1c-\x1f]").search
        self.memo = Memo(self.piece)

    def word(self, word: str) -> int:
        symbols = [self.alphabet[b] for b in utf8(word)]
        symbols[-1] += self.suffix
        return merged_count(symbols, self.ranks)

    def normal(self, text: str) -> str:
        """NFC and lower case letter by letter, without the rule for a sigma at a word's end."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def piece(self, text: str) -> int:
        return sum(map(self.word, self.words(self.normal(text))))

    def count(self, text: str | None) -> int:
        text, total = text or "", 0
        parts = [text] if "<|" not in text else self.special.split(text)
        for part in parts:
            # str.split() also splits at four control characters that are no white space to the tokenizer
            pieces = self.spaces(part) if self.controls(part) else part.split()
            total += sum(map(self.memo.__getitem__, pieces))
        return total + len(parts) - 1


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text, by the merges of the file `vocabulary`."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        count = counter(vocabulary).count
        tokens = [count(t) for t in columns["text"]]
        return {
            "doc_id": pa.array(columns["doc_id"], pa.int64()),
            "n_bytes": pa.array([len(utf8(t)) for t in columns["text"]], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        }

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, schema)
