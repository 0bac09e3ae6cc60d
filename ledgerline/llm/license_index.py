"""Licence scans: given phrases, and a positional rare-token index over licence texts.

The words of all licence texts are counted over all documents, which gives their inverse document frequency. Of each
licence text the `rarest` words, those in more than a share `common` of the documents left out, make the index:
word, text and position. A file's occurrences of indexed words are looked up; file and text position of each hit
give a relative position, and hits that agree on one belong to the same place. A text is found if enough of its
words agree and the file has its key phrases, whose words stand consecutively.

All of it is DataFrame operations on the main path. A file's words are filtered within its row, so that only hits
become rows. What the driver sees are the counts of the licence texts' words, some seven hundred numbers.

Defined cases: a null or wordless text has no places and null positions, no labels and score 0; repeated
rows each give a row and, having equal texts, the same values; the length of a text is not limited; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .license_texts import PHRASES, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, in texts that have not been lower-cased yet.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents that a word's share is measured on in addition, without the word: so no word of a small table is common.
PRIOR = 50


def words_in(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))


def licence_words() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in words_in(text)})


def places() -> list[tuple[str, int, int]]:
    """(word, number of the licence text, position) of every word of every licence text."""
    return [(w, k, i) for k, (_, text, _) in enumerate(TEMPLATES) for i, w in enumerate(words_in(text))]


def key_phrases() -> list[str]:
    return sorted({p for _, _, phrases in TEMPLATES for p in phrases} | {p for p, _ in PHRASES})


def pieces_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), BETWEEN)


def plain(word: Column, words: list[str]) -> Column:
    """Whether `word`, its A-Z lower-cased, is one of `words`: lower() changes more than A-Z, but is quick to leave most words out."""
    return F.lower(word).isin(words) & (F.lower(word) == F.translate(word, UPPER, LOWER))


def counted(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each word of the licence texts."""
    words = licence_words()
    held = F.array_distinct(F.transform(F.filter(pieces_of(F.col("text")), lambda w: plain(w, words)), F.lower))
    # one row more for each document counts the documents
    rows = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def indexed(total: int, held: dict[str, int], rarest: int, common: float) -> dict[int, list[str]]:
    """The words of each licence text that are looked up, rarest first."""
    out = {}
    for k, (_, text, _) in enumerate(TEMPLATES):
        rare = {w for w in words_in(text) if held.get(w, 0) <= common * (total + PRIOR)}
        out[k] = sorted(rare, key=lambda w: (held.get(w, 0), w))[:rarest]
    return out


def starts_of(phrase: str, pieces: Column, near: Column) -> Column:
    """Those of the positions `near` where the phrase's words stand."""
    words = phrase.split()

    def fits(i: Column) -> Column:
        out = F.translate(F.get(pieces, i), UPPER, LOWER) == words[0]
        for k, word in enumerate(words[1:], 1):
            out = out & (F.coalesce(F.translate(F.get(pieces, i + k), UPPER, LOWER), F.lit("")) == word)
        return out

    return F.filter(near, fits)


def looked_up(docs: DataFrame, words: list[str]) -> DataFrame:
    """row (a number), doc_id, n_words, hits (position and word of each indexed word) and the positions of each phrase, s0 and so on."""
    phrases = key_phrases()
    wanted = sorted({p.split()[0] for p in phrases} | set(words))
    first, last = F.element_at("pieces", 1), F.element_at("pieces", -1)
    lead = F.when(first == "", 1).otherwise(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), pieces_of(F.col("text")).alias("pieces"))
    near = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda i: plain(F.get("pieces", i), wanted))
    rows = rows.select("doc_id", "pieces", near.alias("near"), lead.alias("lead"), (F.size("pieces") - lead - F.when((F.size("pieces") > 1) & (last == ""), 1).otherwise(0)).cast("long").alias("n_words"))
    hits = F.filter(F.transform("near", lambda i: F.struct((i - F.col("lead")).alias("at"), F.lower(F.get("pieces", i)).alias("word"))), lambda h: h["word"].isin(words) if words else F.lit(False))
    spots = [F.transform(starts_of(p, F.col("pieces"), F.col("near")), lambda i: i - F.col("lead")).alias(f"s{k}") for k, p in enumerate(phrases)]
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", hits.alias("hits"), *spots))


def scanned(docs: DataFrame, rarest: int = 12, common: float = 0.2, agree: float = 0.6, least: int = 3) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    spark = docs.sparkSession
    index = indexed(*counted(docs), rarest, common)
    rows = looked_up(docs, sorted({w for words in index.values() for w in words}))
    at = {p: F.col(f"s{k}") for k, p in enumerate(key_phrases())}
    labels = [label for label, _, _ in TEMPLATES]

    # a few words for each of some twenty licence texts: small whatever the documents are
    table = spark.createDataFrame([(w, k, i, len(index[k])) for w, k, i in places() if w in index[k]], "word string, text int, place int, reach int")
    found = F.array(*[F.forall(F.array(*[F.size(at[p]) for p in phrases]), lambda n: n > 0) for _, _, phrases in TEMPLATES])
    pairs = rows.select("row", found.alias("found"), F.explode("hits").alias("h")).join(F.broadcast(table), F.col("h.word") == F.col("word")).where(F.get("found", F.col("text")))
    votes = pairs.groupBy("row", "text", "reach", (F.col("h.at") - F.col("place")).alias("shift")).agg(F.count_distinct("word").alias("votes"))
    sure = votes.where((F.col("votes") >= least) & (F.col("votes") >= agree * F.col("reach")))
    names = F.array(*[F.lit(x) for x in labels])
    method = sure.groupBy("row").agg(F.collect_set(F.get(names, F.col("text"))).alias("more"), F.max(F.col("votes") / F.col("reach")).alias("share"))

    starts = F.concat(*[at[p] for p, _ in PHRASES])
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(at[p]) > 0, label) for p, label in PHRASES]))))
    out = rows.join(method, "row", "left")
    both = F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size(starts) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
