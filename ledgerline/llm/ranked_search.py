"""Ranked lexical search: the highest-scoring documents of each query, by reads of impact-sorted lists without lookups.

A first pass over the texts keeps each document's length and its counts of the queries' terms, and Spark sums up
the documents, their lengths and each term's documents. A second reads these rows in blocks of documents. For each
term of a block its documents lie by falling impact. For each query the lists are read downwards in steps of growing
depth. A document's score so far is its lower bound; with what its unread lists may still give, their next impacts,
it is its upper bound. Documents whose upper bound is below the k-th lower bound are dropped, equal ones stay. Reading
ends when no unread document can reach the k-th lower bound and the bounds of all that remain agree, so that members,
ties and scores are final. Spark then takes the k best of all blocks' k best.

Defined cases: each row of the queries is one query and each row of the documents one document, repeated rows included. A null or
empty query gives no rows, a null or empty text no document. Equal scores rank by doc_id, nulls first; among equal
doc_ids any order (their rows are alike). An empty table gives an empty result. Other columns aren't read.
Words are compared by 64-bit hashes. Queries are taken in groups of at most GROUP terms, whatever their number: only one group's
terms are sent to the tasks, and each group reads the texts again. The doc_id of the hits keeps its type.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import stored
from .hashed_words import chunks, letters, words_of

#: Distinct and repeated terms of the queries that are answered together.
GROUP = 500_000
#: Documents whose lists are sorted together in a task.
BLOCK = 8192
#: Postings of each list that the first step reads; each further step reads twice as many.
STEP = 64
TERMS = letters(string.digits + string.ascii_letters, fold=True)


def counted(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (its words) and the places in the sorted `vocabulary` that it holds, with their counts."""
    known = np.zeros(1 << 16, bool)
    known[vocabulary & np.uint64(0xFFFF)] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for a, b in chunks(texts):
                words = words_of(texts.slice(a, b - a), TERMS)
                doc = np.repeat(np.arange(b - a), words.count)
                maybe = np.flatnonzero(known[words.hashes & np.uint64(0xFFFF)])
                place = np.searchsorted(vocabulary, words.hashes[maybe])
                place[place == len(vocabulary)] = 0
                hit = vocabulary[place] == words.hashes[maybe] if len(vocabulary) else np.zeros(0, bool)
                keys, tf = np.unique(doc[maybe[hit]] * np.int64(len(vocabulary) or 1) + place[hit], return_counts=True)
                starts = np.searchsorted(keys // (len(vocabulary) or 1), np.arange(b - a + 1))
                lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32())) for x in (keys % (len(vocabulary) or 1), tf)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(words.count, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


class Lists:
    """The impact-sorted lists of a block of documents: of term t, places `at[t]` to `at[t + 1]` of `doc` and `impact`."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int, documents: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(size + 1))
        self.documents = documents

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score above 0 and no less than the k-th best, and their scores, without lookups."""
        here, end = self.at[terms].copy(), self.at[terms + 1]
        lower, seen = np.zeros(self.documents, np.int64), np.zeros((self.documents, len(terms)), bool)
        live, met, step = np.ones(self.documents, bool), np.zeros(self.documents, bool), STEP
        while True:
            for j in np.flatnonzero(here < end):
                part = slice(here[j], min(here[j] + step, end[j]))
                doc, gain = self.doc[part], weights[j] * self.impact[part]
                kept = live[doc]
                doc = doc[kept]
                lower[doc] += gain[kept]
                seen[doc, j] = met[doc] = True
                here[j] = part.stop
            step *= 2
            left = here < end
            cap = np.zeros(len(terms), np.int64)
            cap[left] = weights[left] * self.impact[here[left]]
            met &= live
            found = np.flatnonzero(met)
            least = np.partition(lower[found], -k)[-k] if len(found) >= k else 0
            upper = lower[found] + cap.sum() - seen[found] @ cap
            stays = upper >= max(least, 1)
            if cap.sum() < max(least, 1):  # no document that was never met can come in or draw level
                live[:] = False
                live[found[stays]] = True
                if (upper[stays] == lower[found[stays]]).all():
                    return found[stays], lower[found[stays]]
            else:
                live[found[~stays]] = False


def best_of_blocks(counts: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], documents: int, length: int, size: int, k: int) -> DataFrame:
    """query, doc_id and score: of each block of documents the k best of each query. `queries`: number, terms, weights."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(a, BLOCK))
                rows += held[-1].num_rows
                if rows >= BLOCK:
                    yield from block(pa.Table.from_batches(held).combine_chunks())
                    held, rows = [], 0
        if rows:
            yield from block(pa.Table.from_batches(held).combine_chunks())

    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, n = table["doc_id"].combine_chunks(), table["n"].to_numpy()
        places = table["terms"].combine_chunks()
        term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (places, table["tf"].combine_chunks()))
        doc = np.repeat(np.arange(len(n)), places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        m = 25 + (75 * n * documents) // length
        lists = Lists(doc, term, (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]), size, len(n))
        place = np.empty(len(n), np.int64)
        place[pa.compute.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(n))
        for number, terms, weights in queries:
            found, score = lists.best(terms, weights, k)
            first = np.lexsort((place[found], -score))[:k]
            if len(first):
                hits = [pa.array(np.full(len(first), number)), ids.take(pa.array(found[first])), pa.array(score[first])]
                yield pa.RecordBatch.from_arrays(hits, ["query", "doc_id", "score"])

    kind = counts.schema["doc_id"].dataType.simpleString()
    return counts.mapInArrow(search, f"query long, doc_id {kind}, score long")


def answered(docs: DataFrame, asked: list[Row], k: int) -> DataFrame:
    """Hits of one group of queries, given as rows of item_id, terms (hashes) and times; item_id, rank, doc_id, score."""
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(terms for _, terms, _ in asked)]))
    counts = stored(counted(docs, vocabulary))
    documents, length = counts.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, holders in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most GROUP rows
        df[term] = holders
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    queries = [(i, np.searchsorted(vocabulary, terms), weight[np.searchsorted(vocabulary, terms)] * times) for i, (_, terms, times) in enumerate(asked)]
    hits = best_of_blocks(counts, [q for q in queries if len(q[1])], documents, length or 1, len(vocabulary), k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(i, item) for i, (item, _, _) in enumerate(asked)], "query long, item_id long")
    return best.join(names, "query").select("item_id", "rank", "doc_id", "score")


def searched(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    groups, group, size = [], [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        found, times = np.unique(words_of(pa.array([row["text"]], pa.string()), TERMS).hashes, return_counts=True)
        if size + len(found) > GROUP and group:
            groups.append(answered(docs, group, k))
            group, size = [], 0
        group.append((row["item_id"], found, times))
        size += len(found)
    groups.append(answered(docs, group, k))
    out = groups[0]
    for more in groups[1:]:
        out = out.unionByName(more)
    return out
