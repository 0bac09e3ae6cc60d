"""Best-fit packing of texts into sequences of fixed capacity, with conflicts.

A document longer than the capacity fills sequences of its own; the rest of it and all other documents
go to the bin that they leave fullest. A bin carries a bitmap of its duplicate clusters and one of its
sources, with `per_source` bits for each source; a document fits a bin that has room, has no document of
its cluster and a bit left for its source. Bins are kept in order of what is left in them, and the search
goes on from the tightest with room until one is compatible; if none is, a bin is opened.

Documents are dealt to shards by a hash of doc_id, text and the number of the copy, and each shard is packed by
falling length: tasks are of bounded size and results do not depend on partitions. Equal rows are counted before
they are dealt, so that a row that is repeated without end fills no shard of its own. By default there are as many
shards as give each about `shard` documents; `shards` fixes their number, so that it doesn't follow the table's size.

A document's cluster is its text, or what `clusters` says of its doc_id, as simhash.near_duplicates does.
Its length is its number of words, or the column `length`, as token_counts gives.

Defined cases: a null or wordless text has length 0 and gives one row without a bin; a null source is a source of
its own, a null doc_id a document of its own; repeated rows are copies of one another and never share a
bin; of lengths that tie the smaller doc_id goes first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, utf8

SCHEMA = "bin_id string, doc_id long, source string, piece int, start long, n_words long, bin_offset long"


def word_count(text: str = "text") -> Column:
    """Words between blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns."""

    @F.pandas_udf("long")
    def count(texts):  # noqa: ANN001, ANN202
        return pd.Series([len(utf8(t).split()) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return count(F.col(text))


class Bins:
    """Open bins ordered by what is left in them."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[int] = []

    def place(self, length: int, cluster: int, source: int) -> tuple[int, int]:
        """The bin for a piece and the room it had. `cluster` is a bit or 0; `source` the number of a source."""
        full = 1 << (source * self.per_source + self.per_source - 1)
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order):
            room, number = self.order[at]
            if not self.clusters[number] & cluster and not self.sources[number] & full:
                del self.order[at]
                break
            at += 1
        else:
            room, number = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append(0)
        self.clusters[number] |= cluster
        slot = source * self.per_source
        while self.sources[number] >> slot & 1:
            slot += 1
        self.sources[number] |= 1 << slot
        if room > length:
            insort(self.order, (room - length, number))
        return number, room


def pack_shard(rows: list[tuple], shard: int, capacity: int, per_source: int) -> Iterator[tuple]:
    """Rows of SCHEMA for (doc_id, source, cluster, n_words) of one shard."""
    rows = sorted(rows, key=lambda r: (-(r[3] % capacity), r[0] is None, r[0] or 0, r[1] or "", r[2]))
    copies = Counter(r[2] for r in rows)
    bit = {c: 1 << k for k, c in enumerate(c for c, n in copies.items() if n > 1)}
    number = {s: k for k, s in enumerate(dict.fromkeys(r[1] for r in rows))}
    bins, own = Bins(capacity, per_source), 0
    for doc_id, source, cluster, n in rows:
        whole, rest = divmod(n, capacity)
        for piece in range(whole):
            yield f"{shard}-w{own}", doc_id, source, piece, piece * capacity, capacity, 0
            own += 1
        if rest:
            at, room = bins.place(rest, bit.get(cluster, 0), number[source])
            yield f"{shard}-{at}", doc_id, source, whole, whole * capacity, rest, capacity - room


def clustered(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """`rows` with `cluster` from the component_id of their doc_id, where there is one."""
    known = clusters.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.xxhash64(F.lit("cluster"), F.min("component_id")).alias("_cluster"))
    # rows without a doc_id match nothing, and are dealt by their text, so that no task has them all
    rows = rows.withColumns({"_none": F.col("doc_id").isNull(), "_key": F.coalesce("doc_id", "cluster")})
    out = rows.join(known, (rows["_key"] == known["_id"]) & ~rows["_none"], "left")
    return out.withColumn("cluster", F.coalesce("_cluster", "cluster")).drop("_none", "_key", "_id", "_cluster")


def packed(docs: DataFrame, capacity: int = 2048, per_source: int = 16, shard: int = 4000, shards: int | None = None, length: str | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """One row of SCHEMA for each piece of each document."""
    many = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long") if length else word_count()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("cluster"), many.alias("n_words"))
    if clusters is not None:
        rows = clustered(rows, clusters)
    rows = stored(rows.groupBy("doc_id", "source", "cluster", "n_words").count())
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("count")).first()[0] or 0) // shard))
    rows = rows.select("doc_id", "source", "cluster", "n_words", F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("copy"))
    empty = rows.where("n_words = 0").selectExpr("cast(null as string) bin_id", "doc_id", "source", "0 piece", "0L start", "0L n_words", "0L bin_offset")
    rows = rows.where("n_words > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        given = zip((None if pd.isna(x) else int(x) for x in frame["doc_id"]), (None if pd.isna(x) else x for x in frame["source"]), frame["cluster"].tolist(), frame["n_words"].tolist(), strict=True)
        out = pd.DataFrame(list(pack_shard(list(given), key[0], capacity, per_source)), columns=["bin_id", "doc_id", "source", "piece", "start", "n_words", "bin_offset"])
        return out.astype({"doc_id": "Int64"})

    return rows.groupBy("shard").applyInPandas(pack, SCHEMA).unionByName(empty)
