"""Quality rules: word and repetition rules on each text, and line frequency across the documents of a host.

Lines are normalised (lower case, digits alike, white space alike) and hashed. For each host (`source`)
the distinct documents that hold a line are counted; exact copies of a text count as one document. A line
is frequent above a limit: `share` of the host's distinct documents, and at least `low`.
Frequent lines are removed, and a document is depleted if less than `least_left` of its words are left. So a
family of near copies in one host, above the limit, goes as a whole: what its members share is what the host
repeats. Removing copies first is another operator's work.

Defined cases: a null text is an empty one, which fails the base rules; documents of a null host form a
host of their own; repeated rows each give a row and count as one document; an empty table gives an empty
result; other columns are ignored; the length of a text is not limited.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_batches, stored, utf8

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    counts = Counter(grams)
    if len(counts) == len(grams):
        return 0
    covered = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter(map(counts.__getitem__, grams), np.int64, len(grams)) > 1)
    for k in range(window):
        covered[at + k] = True
    return int(covered.sum())


def line_key(line: str) -> str:
    return re.sub("[0-9]", "0", " ".join(line.lower().split()))


def measures(text: str | None) -> tuple[int, int, int, int, int, list[int], list[int]]:
    """The five base measures, and the hash and words of each distinct normalised line, in order of first place."""
    text = text or ""
    words = utf8(text).split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    raw, keys, repeats = set(), {}, 0
    for line in text.split("\n"):
        n = len(utf8(line).split()) if line else 0
        if n:
            repeats += line in raw
            raw.add(line)
            h = xxhash.xxh3_64_intdigest(utf8(line_key(line))) - (1 << 63)
            keys[h] = keys.get(h, 0) + n
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words), list(keys), list(keys.values())


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, mark and digest of the text, the base measures, lines and line_words."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        values = list(zip(*map(measures, columns["text"]), strict=True))
        return (
            {"doc_id": pa.array(columns["doc_id"], pa.int64()), "source": pa.array(columns["source"], pa.string()), "mark": pa.array(columns["mark"], pa.int64())}
            | {"digest": pa.array([xxhash.xxh3_128_digest(utf8(t)) for t in columns["text"]], pa.binary())}
            | {n: pa.array(v, pa.int64()) for n, v in zip(STATS, values[:5], strict=True)}
            | {"lines": pa.array(values[5], pa.list_(pa.int64())), "line_words": pa.array(values[6], pa.list_(pa.int64()))}
        )

    schema = "doc_id long, source string, mark long, digest binary, " + ", ".join(f"{n} long" for n in STATS) + ", lines array<long>, line_words array<long>"
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "source", "xxhash64(text) mark", "text"), batch, schema)


def frequent_lines(texts: DataFrame, share: float, low: int) -> DataFrame:
    """source and line of the lines above their host's limit; `texts` has one row for each host and digest."""
    counts = texts.select("source", F.explode("lines").alias("line")).groupBy("source", "line").agg(F.count("*").alias("held"))
    hosts = texts.groupBy("source").agg(F.count("*").alias("documents"))
    limit = F.greatest(F.lit(low), F.ceil(F.col("documents") * share))
    often = counts.where(F.col("held") >= low)
    return often.join(hosts.withColumnRenamed("source", "host"), F.col("source").eqNullSafe(F.col("host"))).where(F.col("held") > limit).select("source", "line")


def judged(docs: DataFrame, **limits: float) -> DataFrame:
    """doc_id, the base measures, n_removed_words, base_failed and kept of every document."""
    return verdicts(docs, **limits).drop("source", "mark")


def verdicts(docs: DataFrame, share: float = 0.01, low: int = 5, least_left: float = 0.3, min_words: int = 50) -> DataFrame:
    """The columns of `judged`, with source and mark, the text's hash."""
    rows = checkpointed(measured(docs))
    # equal texts have equal lines: the copies of a text meet as one small row
    texts = rows.groupBy("source", "digest").agg(F.first("lines").alias("lines"), F.first("line_words").alias("line_words"))
    texts = checkpointed(texts)
    often = frequent_lines(texts, share, low).withColumnsRenamed({"source": "host", "line": "common"})
    held = texts.select("source", "digest", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("source", "digest", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    found = held.join(often, (held["line"] == often["common"]) & held["source"].eqNullSafe(often["host"])).drop("host", "common")
    removed = found.groupBy("source", "digest").agg(F.sum("words").alias("removed")).withColumnsRenamed({"source": "host", "digest": "text_digest"})
    whole = rows.drop("lines", "line_words").join(removed, (rows["digest"] == removed["text_digest"]) & rows["source"].eqNullSafe(removed["host"]), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    gone = F.coalesce("removed", F.lit(0))
    return whole.select("doc_id", "source", "mark", *STATS, gone.alias("n_removed_words"), failed.alias("base_failed"), (~failed & (F.col("n_words") - gone >= least_left * F.col("n_words"))).alias("kept"))


def kept_documents(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of `docs` that are kept, as they are; each row is judged by its own source and text, also where doc_id is null or repeated."""
    bad = verdicts(docs, **limits).where(~F.col("kept")).select(F.col("doc_id").alias("_bad"), F.col("source").alias("_source"), F.col("mark").alias("_mark")).distinct()
    bad = stored(bad)
    same = docs["doc_id"].eqNullSafe(bad["_bad"]) & docs["source"].eqNullSafe(bad["_source"]) & F.xxhash64(docs["text"]).eqNullSafe(bad["_mark"])
    return docs.join(bad, same, "left_anti")
