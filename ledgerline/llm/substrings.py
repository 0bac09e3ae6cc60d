"""Substring deduplication by recompression: words that lie in a window of words that also starts elsewhere go.

A text is a sequence of symbols, words at first. One round names runs of equal words; each further round gives every symbol a side by
its name and names each pair of a left and a right neighbour. Names are hashes of what they stand for, so that all tasks give
equal pairs the same name, and equal passages get the same symbols but near their ends. A symbol carries the span of words that its
presence depends on: its own, and where it stayed unpaired its neighbour's. Whatever equals that span holds the symbol too.

1. Symbols whose span fits a window are counted over all texts, a whole text being a symbol as well. A window that covers the span of
   a symbol that occurs once can't occur twice: what is left, windows of shared symbols only, are candidates.
2. Candidates are counted by a hash of their words (96 bits); those that occur once are taken back. Of copies of a whole text one gives
   its windows, counted twice.
3. Words in the windows that remain are removed.

Only occurrences of what is unique go back to their texts, by plain aggregates that add up equal names before the shuffle, so that neither a
frequent passage nor a large group of copies meets in one task, and no pairs are made.

Defined cases: a null text has no words; a text shorter than the window keeps all. Repeated rows are texts like any other (each is elsewhere for the
other); rows with a null or repeated doc_id are kept apart. An empty table gives an empty result. Other columns aren't read.
A text must fit the memory of a task, as must some 150 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES
from .hashed_words import FIRST, SECOND, chunks, letters, mixed, offsets_of, rolling, slices, words_of

#: Rounds of pairs: some six words a symbol, whose span is 17 words on average.
ROUNDS = 6
#: Marks in place of a span: the text occurs once; the text is the one of its copies that gives its windows.
ALONE, CHOSEN = -1, -2
#: A span is its first word times this, plus its length.
WIDTHS = 1024
WORDS = letters(bytes(set(range(128)) - set(SPACES.encode())))


class Symbols(NamedTuple):
    """Symbols in order: name, first word, the span [lo, hi) they depend on, whether a text begins or ends with them."""

    name: np.ndarray
    start: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    opens: np.ndarray
    closes: np.ndarray


def runs(words: np.ndarray, opens: np.ndarray) -> Symbols:
    """One symbol for each run of equal words of a text, by word and length. It depends on the words before and after it."""
    head = np.flatnonzero(np.r_[True, words[1:] != words[:-1]][: len(words)] | opens)
    length = np.diff(np.r_[head, len(words)])
    name = np.where(length > 1, mixed(words[head] + mixed(length.astype(np.uint64))), words[head])
    return Symbols(name, head, head - 1, head + length + 1, opens[head], np.r_[opens[head][1:], True])


def paired(s: Symbols, number: int) -> Symbols:
    """The next symbols: a left one (by its name and the round's number) and a right one after it become one.

    One that stays depends on the neighbour that it could have been paired with; where the text ends instead, on the word beyond.
    """
    left = mixed(s.name + np.uint64(number)) >> np.uint64(63) == 1
    joins = np.r_[left[:-1] & ~left[1:] & ~s.closes[:-1], False]
    second = np.r_[False, joins[:-1]]
    before = np.where(s.opens, s.start - 1, np.r_[0, s.lo[:-1]])
    after = np.where(s.closes, np.r_[s.start[1:], s.hi[-1] - 1] + 1, np.r_[s.hi[1:], 0])
    lo = np.where(~left & ~second, np.minimum(s.lo, before), s.lo)
    hi = np.where(left & ~joins, np.maximum(s.hi, after), s.hi)
    at = np.flatnonzero(joins)
    name, closes = s.name.copy(), s.closes.copy()
    name[at] = mixed(name[at] * np.uint64(FIRST) + mixed(name[at + 1]))
    lo[at], hi[at], closes[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1]), closes[at + 1]
    kept = ~second
    return Symbols(name[kept], s.start[kept], lo[kept], hi[kept], s.opens[kept], closes[kept])


def whole_texts(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's words; the second is never 0."""
    return slices(rolling(words, FIRST), first, end), slices(rolling(words, SECOND), first, end) | np.uint64(1)


def symbols(base: DataFrame, window: int) -> DataFrame:
    """name, check (0 but for whole texts), row and span of the symbols of texts that have a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, texts = batch["row"].to_numpy(), batch["text"]
            for a, b in chunks(texts):
                found = words_of(texts.slice(a, b - a), WORDS)
                long = np.flatnonzero(found.count >= window)
                if not len(long):
                    continue
                first, count = found.first[long], found.count[long]
                text = np.repeat(np.arange(len(long)), count)
                words = found.hashes[np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
                end = np.cumsum(count)
                first = end - count
                opens = np.zeros(len(words), bool)
                opens[first] = True
                s = runs(words, opens)
                for number in range(1, ROUNDS + 1):
                    s = paired(s, number)
                of = text[s.start]
                fits = (s.hi - s.lo <= window) & (s.lo >= first[of]) & (s.hi <= end[of])
                of, lo, width = of[fits], s.lo[fits], (s.hi - s.lo)[fits]
                name, check = whole_texts(words, first, end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[s.name[fits], name].view(np.int64)),
                        pa.array(np.r_[np.zeros(len(of), np.uint64), check].view(np.int64)),
                        pa.array(row[a + long][np.r_[of, np.arange(len(long))]]),
                        pa.array(np.r_[(lo - first[of]) * WIDTHS + width, np.full(len(long), ALONE)]),
                    ],
                    ["name", "check", "row", "span"],
                )

    return base.mapInArrow(run, "name long, check long, row long, span long")


def candidates(count: np.ndarray, spans: pa.ListArray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of `count` words laid end to end: whether the window from each word on is one of shared symbols only,
    and for each text whether it is the chosen one of its copies, and whether it has copies."""
    size, end = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.cumsum(count)
    first, text, span = end - count, np.repeat(np.arange(len(count)), size), spans.flatten().to_numpy()
    chosen, alone = np.zeros(len(count), bool), np.zeros(len(count), bool)
    chosen[text[span == CHOSEN]] = alone[text[span == ALONE]] = True
    text, span = text[span >= 0], span[span >= 0]
    lo, width = span // WIDTHS, span % WIDTHS
    change = np.zeros(int(count.sum()) + 1, np.int32)
    np.add.at(change, first[text] + np.maximum(lo + width - window, 0), 1)
    np.add.at(change, first[text] + lo + 1, -1)
    place = np.arange(len(change) - 1) - np.repeat(first, count)
    return (np.cumsum(change[:-1]) == 0) & (place + window <= np.repeat(count, count)), chosen, ~alone & (count >= window)


def windows(marked: DataFrame, window: int) -> DataFrame:
    """hash, check, row, place and weight of candidates; the windows of a chosen text weigh 2, its copies give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, texts = batch["row"].to_numpy(), batch["text"]
            for a, b in chunks(texts):
                found = words_of(texts.slice(a, b - a), WORDS)
                is_candidate, chosen, copied = candidates(found.count, batch["spans"].slice(a, b - a), window)
                text = np.repeat(np.arange(b - a), found.count)
                at = np.flatnonzero(is_candidate & ~(copied & ~chosen)[text])
                if len(at):
                    keys = [slices(rolling(found.hashes, base), at, at + window) for base in (FIRST, SECOND)]
                    of = text[at]
                    columns = [keys[0].view(np.int64), (keys[1] >> np.uint64(32)).astype(np.uint32).view(np.int32), row[a + of], (at - found.first[of]).astype(np.int32), np.where(chosen[of], 2, 1).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["hash", "check", "row", "place", "weight"])

    return marked.mapInArrow(run, "hash long, check int, row long, place int, weight int")


def removal(marked: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words that stay, joined by blanks) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch["text"].fill_null("")):
                part = batch.slice(a, b - a)
                texts = [t.split() for t in part["text"].fill_null("").cast(pa.binary()).to_pylist()]
                count = np.array([len(t) for t in texts], np.int64)
                repeated, chosen, copied = candidates(count, part["spans"], window)
                first = np.cumsum(count) - count
                single = part["singles"]
                repeated[np.repeat(first, single.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) + single.flatten().to_numpy()] = False
                at = np.flatnonzero(repeated)
                change = np.zeros(len(repeated) + 1, np.int32)
                change[at] = 1
                np.add.at(change, at + window, -1)
                stays = np.cumsum(change[:-1]) == 0
                kept = [b" ".join(compress(t, stays[f : f + n].tolist()) if not c else ()) for t, f, n, c in zip(texts, first, count, copied, strict=True)]
                removed = np.where(copied, count, np.add.reduceat(np.r_[~stays, False], first) * (count > 0)) if len(count) else count
                columns = [part["doc_id"], pa.array(count), pa.array(removed.astype(np.int64)), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")


def deduplicated(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept of each text, without the words of repeated windows.

    All three passes read the one exchange of the texts by row.
    """
    if not 2 <= window < WIDTHS:
        raise ValueError(f"a window has 2 to {WIDTHS - 1} words")
    base = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()).repartition("row")
    counted = symbols(base, window).groupBy("name", "check").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("at"), F.min("span").alias("span"))
    once = counted.where((F.col("n") == 1) | (F.col("span") == ALONE)).select("at", F.when(F.col("n") == 1, F.col("span")).otherwise(F.lit(CHOSEN)).alias("span"))
    spans = once.groupBy("at").agg(F.collect_list("span").alias("spans"))  # no more than a text has words
    marked = base.join(spans, base["row"] == spans["at"], "left").drop("at")
    tested = windows(marked, window).groupBy("hash", "check").agg(F.sum("weight").alias("n"), F.min("row").alias("at"), F.min("place").alias("place"))
    singles = tested.where("n = 1").groupBy("at").agg(F.collect_list("place").alias("singles"))
    return removal(marked.join(singles, marked["row"] == singles["at"], "left").drop("at"), window)
