"""SimHash near-duplicates over a Gray-order hierarchical index.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Fingerprints that differ
in few bits are linked, and linked documents form a component.

Only distinct fingerprints are compared, so exact copies cost nothing. Two fingerprints that differ in
at most `distance` bits agree on at least one of `distance + 1` fields, so each fingerprint is dealt
once for each field, by the field's value. A value that too many fingerprints share is dealt again by
parts of the bits that are left, three levels deep, so that no group can exceed 2^19 fingerprints. In a
task, each group is sorted by Gray rank; runs of it form nodes that hold the bits their members share,
and a search drops a node with all below it once the differences in shared bits exceed the distance.
Each task passes on the edges of a spanning forest of its links, not the links. The components then
come from rounds of contraction on tables.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; fewer words
than a shingle form one shingle; repeated rows each give a row; a null doc_id gets its component's
smallest id, null if there is none; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_batches, utf8

BITS, FANOUT, LEVELS = 64, 16, 3
#: Fingerprints that one group may hold before it is dealt again, rows that a task gathers before it
#: searches them, and pairs of query and node that a search holds at a time.
HOT, CHUNK, FRONTIER = 20_000, 100_000, 2_000_000


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    words = utf8(text).lower().split()  # of bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of very long texts
        counts += np.unpackbits(hashes[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        fps = np.array([fingerprint(t, shingle, seed) for t in columns["text"]], np.uint64)
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "fp": pa.array(fps.view(np.int64))}

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, "doc_id long, fp long")


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The position of each fingerprint in Gray order, in which neighbours differ in one bit."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def linked_pairs(fps: np.ndarray, group: np.ndarray, distance: int, frontier: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of the same group within `distance` bits; `group` is sorted, and within a group `fps` by Gray rank.

    levels[0] has a node for each fingerprint; a node above has up to FANOUT nodes of one group below it
    and holds the bits that all of them share (`mask`) with their values (`value`).
    """
    levels = [(fps, np.full(len(fps), ~np.uint64(0)), np.arange(len(fps)), np.arange(1, len(fps) + 1))]
    value, mask, owner = fps, levels[0][1], group
    while True:
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        if len(begins) == len(owner):
            break
        index = np.arange(len(owner)) - np.repeat(begins, np.diff(np.r_[begins, len(owner)]))
        starts = np.flatnonzero(index % FANOUT == 0)
        both, either = np.bitwise_and.reduceat(value, starts), np.bitwise_or.reduceat(value, starts)
        value, mask, owner = both, np.bitwise_and.reduceat(mask, starts) & ~(both ^ either), owner[starts]
        value = value & mask
        levels.append((value, mask, starts, np.r_[starts[1:], len(levels[-1][0])]))
    tops = np.searchsorted(owner, group)  # a group's only node on the highest level
    for start in range(0, len(fps), CHUNK // 10):
        query = np.arange(start, min(len(fps), start + CHUNK // 10))
        yield from descend(levels, fps, len(levels) - 1, query, tops[query], distance, frontier)


def descend(levels: list, fps: np.ndarray, level: int, query: np.ndarray, node: np.ndarray, distance: int, frontier: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    while True:
        value, mask, starts, ends = levels[level]
        near = np.bitwise_count((fps[query] ^ value[node]) & mask[node]) <= distance
        query, node = query[near], node[near]
        if level == 0:
            keep = query < node
            yield query[keep], node[keep]
            return
        if len(query) * FANOUT > frontier and len(query) > 1:
            half = len(query) // 2
            for part in (slice(None, half), slice(half, None)):
                yield from expand(levels, fps, level, query[part], node[part], distance, frontier)
            return
        query, node = children(starts, ends, query, node)
        level -= 1


def expand(levels: list, fps: np.ndarray, level: int, query: np.ndarray, node: np.ndarray, distance: int, frontier: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rest of a search whose nodes have passed at `level`, in halves until it fits."""
    if len(query) * FANOUT > frontier and len(query) > 1:
        half = len(query) // 2
        for part in (slice(None, half), slice(half, None)):
            yield from expand(levels, fps, level, query[part], node[part], distance, frontier)
    else:
        query, node = children(levels[level][2], levels[level][3], query, node)
        yield from descend(levels, fps, level - 1, query, node, distance, frontier)


def children(starts: np.ndarray, ends: np.ndarray, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = ends[node] - starts[node]
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(query, counts), np.repeat(starts[node], counts) + within


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n nodes the smallest that its links reach."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(root, up := root[root]):
                root = up
    return root


def forest(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, root) of the links within each key."""
    order = np.lexsort((gray_rank(fps), keys))
    keys, fps = keys[order], fps[order]
    _, first, sizes = np.unique(keys, return_index=True, return_counts=True)
    several = np.repeat(sizes > 1, sizes)
    keys, fps = keys[several], fps[several]
    if not len(fps):
        return fps, fps
    root = spanning(len(fps), linked_pairs(fps, np.cumsum(np.r_[0, keys[1:] != keys[:-1]]), distance))
    inner = root != np.arange(len(fps))
    return fps[inner], fps[root[inner]]


def fields(bits: tuple[int, ...], parts: int) -> list[tuple[int, ...]]:
    return [tuple(x.tolist()) for x in np.array_split(np.array(bits), parts)]


def masks(distance: int) -> list[dict[int, int]]:
    """For each level the mask of the bits fixed on each path; path p's children are p * (distance + 1) + k + 1."""
    parts, levels, current = distance + 1, [], {0: (0, tuple(range(BITS)))}
    for _ in range(LEVELS):
        following = {}
        for path, (mask, left) in current.items():
            for k, chosen in enumerate(fields(left, parts)):
                following[path * parts + k + 1] = (mask | sum(1 << b for b in chosen), tuple(b for b in left if b not in chosen))
        current = following
        levels.append({path: mask for path, (mask, _) in current.items()})
    return levels


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def dealt(df: DataFrame, level: dict[int, int], parts: int) -> DataFrame:
    """Rows of `df` (fp, path) once for each child path, with the fixed bits as `key`."""
    child = F.explode(F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda k: (F.col("path") * parts + k).cast("int"))).alias("path")
    mask = F.create_map(*[F.lit(x) for path, m in level.items() for x in (path, signed(m))])
    return df.select("fp", child).withColumn("key", F.col("fp").bitwiseAND(mask[F.col("path")]))


def forest_edges(fps: DataFrame, distance: int) -> DataFrame:
    """Distinct edges (a, b) whose components are those of all links between the distinct fingerprints `fps`."""
    levels, parts = masks(distance), distance + 1
    rest, groups = fps.select("fp", F.lit(0).alias("path")), []
    for n, level in enumerate(levels):
        rest = dealt(rest, level, parts)
        if n == len(levels) - 1:
            groups.append(rest)  # at most 2^19 fingerprints share a key here
            break
        sizes = rest.groupBy("path", "key").count()
        hot = checkpointed(sizes.where(F.col("count") > HOT).select("path", "key", F.lit(True).alias("hot")))
        if hot.isEmpty():
            groups.append(rest)
            break
        marked = rest.join(hot, ["path", "key"], "left")
        groups.append(marked.where("hot is null").select("fp", "path", "key"))
        rest = marked.where("hot").select("fp", "path")
    keyed = groups[0]
    for more in groups[1:]:
        keyed = keyed.unionByName(more)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(n).to_numpy(zero_copy_only=False) for n in ("path", "key", "fp")])
            rows += batch.num_rows
            if rows >= CHUNK:
                path, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
                # the last key may go on in the next batch
                cut = int(np.flatnonzero((path != path[-1]) | (key != key[-1])).max(initial=-1)) + 1
                if cut:
                    yield edges(path[:cut], key[:cut], fp[:cut])
                    held, rows = [[path[cut:], key[cut:], fp[cut:]]], rows - cut
        if rows:
            yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def edges(path: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        number = np.cumsum(np.r_[0, (path[1:] != path[:-1]) | (key[1:] != key[:-1])])
        a, b = forest(number, fp.view(np.uint64), distance)
        return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return keyed.repartition("path", "key").sortWithinPartitions("path", "key").mapInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root of every node that has an edge (a, b); roots are alike exactly within a component.

    In each round every node moves to the neighbour that comes first in an order drawn anew, itself
    included, then on to where that one has moved; edges between what is left go to the next round.
    """
    edges, moves, number = checkpointed(edges.where("a <> b").select("a", "b")), [], 0
    while not edges.isEmpty():
        number += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.struct(F.xxhash64(F.lit(number), "b"), "b")
        step = both.groupBy("a").agg(F.min(order).alias("first")).select("a", F.when(F.col("first") < F.struct(F.xxhash64(F.lit(number), "a"), F.col("a").alias("b")), F.col("first.b")).otherwise(F.col("a")).alias("r"))
        step = checkpointed(step)
        move = checkpointed(step.join(step.select(F.col("a").alias("r"), F.col("r").alias("r2")), "r").select("a", F.col("r2").alias("r")))
        ends = edges.join(move.select("a", F.col("r").alias("x")), "a").join(move.select(F.col("a").alias("b"), F.col("r").alias("y")), "b")
        edges = checkpointed(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        moves.append(move)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[0].select(F.col("a").alias("node"), F.col("r").alias("root"))
    for move in moves[1:]:
        later = move.select(F.col("a").alias("root"), F.col("r").alias("next"))
        roots = roots.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return roots


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id of the component."""
    marked = checkpointed(fingerprints(docs, shingle, seed))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(forest_edges(distinct, distance))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = checkpointed(placed.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component; rows without a doc_id stay.

    Rows that repeat a doc_id are the same document and stay or go together.
    """
    gone = near_duplicates(docs, distance, shingle, seed).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
