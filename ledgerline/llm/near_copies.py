"""Near copies: SimHash near-duplicates at the width that texts of similar shingle sets need, with an exact check.

Sets of five-word shingles that are 0.8 alike have fingerprints (bitwise majorities of the shingles' hashes)
some ten bits apart, and far more than two at times. At such a width no fields of a fingerprint must be equal,
so texts are dealt to groups by minima of their shingles' hashes instead: 16 keys of three minima each. Texts
of similarity 0.8 share no key with a probability of (1 - 0.8^3)^16, one in 10^5.

In a group, simhash's Gray-order hierarchical index searches for fingerprints within `distance` bits; of the pairs
it finds those are near that agree in half of the 48 minima, which one in 10^6 texts of similarity 0.8 don't. Texts
that chains of near pairs join are gathered once, with their shingles. There the index searches again, and a pair
is linked if the exact similarity of the two sets is `alike` or more. Tasks pass on a spanning forest of what they
find, never the pairs; simhash.components joins the forests.

A group of more texts than BLOCK (where shingles come along, SETS, or BYTES of them) is first compared with its middle, the text whose fingerprint is nearest
the bitwise majority of the group's. Those that pass hang together by the middle and need no comparison with one another. The others are dealt in
blocks, and each such block meets every block, so that tasks are of bounded size. A task searches whole groups, a bounded number of rows and bytes at once. A family of copies around a text, of any
size, so costs rows in proportion to it; a large group that has no such middle still costs pairs of blocks.

Defined cases: words are those of simhash.fingerprint; fewer words than a shingle form one shingle; null and
wordless texts have an empty set and equal one another; rows without a doc_id stay; repeated doc_ids stay or
go together; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored, utf8
from .simhash import BITS, components, gray_rank, linked_pairs, spanning

KEYS, MINIMA, BLOCK, SETS = 16, 3, 8000, 1000
#: Minima in which near texts agree; rows of whole groups that a task searches at once; bytes of a table of shingles and of what is looked up in it.
AGREE, CHUNK, TABLE = 24, 20_000, 16 << 20
#: Bytes of the shingles of a block, and of those searched at once; rows that are compared with middles or shingled at once, and that share a copy of their
#: middle; pairs that a search holds, and that are tested at once.
BYTES, ROWS, PAIRS = 4 << 20, 256, 100_000
_DRAWN = np.random.default_rng(20).integers(0, 1 << 64, (2, KEYS * MINIMA), np.uint64)
FACTORS, ADDENDS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def shingle_set(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The hashes of the distinct shingles, sorted."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), ">u8").astype(np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set of hashes, as a signed number."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of very long texts
        counts += np.unpackbits(hashes[start : start + (1 << 16), None].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(np.int64)[0])


def minima(hashes: np.ndarray) -> np.ndarray:
    least = np.full(KEYS * MINIMA, ~np.uint64(0))
    for start in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[start : start + 4096, None] * FACTORS + ADDENDS).min(axis=0), out=least)
    return least


def keys_of(least: np.ndarray) -> list[int]:
    return [xxhash.xxh3_64_intdigest(least[k * MINIMA : (k + 1) * MINIMA].tobytes(), k) - (1 << 63) for k in range(KEYS)]


def marked(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, key (of the text), fp, groups and sketch (a byte of each minimum) of every row."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        fps, groups, sketches = [], [], []
        for text in columns["text"]:
            hashes = shingle_set(text, shingle)
            least = minima(hashes)
            fps.append(majority(hashes))
            groups.append(keys_of(least))
            sketches.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "key": pa.array(columns["key"], pa.int64()), "fp": pa.array(fps, pa.int64()), "groups": pa.array(groups, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.binary())}

    return map_batches(keyed(docs), batch, "doc_id long, key long, fp long, groups array<long>, sketch binary", ROWS)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")


def shingled(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """key, fp and shingles of the texts whose key is `needed`."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        sets = [shingle_set(t, shingle) for t in columns["text"]]
        return {"key": pa.array(columns["key"], pa.int64()), "fp": pa.array(list(map(majority, sets)), pa.int64()), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())}

    rows = keyed(docs).select("key", "text").join(needed, "key", "left_semi")
    return map_batches(rows, batch, "key long, fp long, shingles binary", ROWS).groupBy("key").agg(F.first("fp").alias("fp"), F.first("shingles").alias("shingles"))


def large_groups(members: DataFrame, block: int) -> DataFrame:
    """value, size and middle (a key) of the groups of more than `block` of the `members` (value, key, fp), or of more than BYTES where they have `bytes`."""
    size = F.greatest(F.count("*"), F.ceil(F.sum("bytes") * block / BYTES)) if "bytes" in members.columns else F.count("*")
    sizes = stored(members.groupBy("value").agg(size.alias("size")).where(F.col("size") > block))
    if sizes.isEmpty():
        return sizes.select("value", "size", F.lit(0).cast("long").alias("middle")).limit(0)
    ones = [F.sum(F.shiftright("fp", n).bitwiseAND(1)).alias(f"ones{n}") for n in range(BITS)]
    own = members.select("value", "key", "fp").join(sizes.select("value"), "value")
    counts = own.groupBy("value").agg(F.count("*").alias("all"), *ones)
    majority_bits = F.lit(0).cast("long")
    for n in range(BITS):
        majority_bits = majority_bits.bitwiseOR(F.when(2 * F.col(f"ones{n}") > F.col("all"), F.shiftleft(F.lit(1).cast("long"), n)).otherwise(F.lit(0).cast("long")))
    told = stored(counts.select("value", majority_bits.alias("majority")))
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("majority")))
    middles = own.join(told, "value").groupBy("value").agg(F.min(F.struct(away.alias("away"), "key")).alias("first"))
    return stored(middles.join(sizes, "value").select("value", "size", F.col("first.key").alias("middle")))


def around_middles(members: DataFrame, large: DataFrame, column: str, passes: Callable[[bytes, bytes], bool]) -> DataFrame:
    """value, key, middle, bytes and passed of the members of large groups: whether `passes` holds of their `column` and their middle's.

    Members go in parts, each with its own copy of the middle in front.
    """
    parts = F.ceil(F.col("size") / ROWS)
    own = members.select("value", "key", column).join(large, "value")
    placed = own.select("value", F.pmod(F.xxhash64("key"), parts).alias("part"), F.lit(False).alias("centre"), "key", "middle", column)
    centres = own.where("key = middle").dropDuplicates(["value"]).select("value", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(True).alias("centre"), "key", "middle", column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = b""
        for batch in batches:
            found = []
            for first, key, middle, x in zip(*(batch.column(n) for n in ("centre", "key", "middle", column)), strict=True):
                if first.as_py():
                    centre = x.as_py()
                found.append(key == middle or passes(x.as_py(), centre))
            names = batch.schema.names
            lengths = pc.binary_length(batch.column(names.index(column))).cast(pa.int64())
            told = [*(batch.column(names.index(n)) for n in ("value", "key", "middle")), lengths, pa.array(found, pa.bool_())]
            yield pa.RecordBatch.from_arrays(told, ["value", "key", "middle", "bytes", "passed"]).filter(pc.invert(batch.column(names.index("centre"))))

    rows = placed.unionByName(centres).repartition("value", "part").sortWithinPartitions("value", "part", F.desc("centre"))
    return rows.mapInArrow(run, "value long, key long, middle long, bytes long, passed boolean")


def in_blocks(members: DataFrame, judged: DataFrame | None, block: int) -> DataFrame:
    """`members` with x and y: 0 in groups that aren't `judged`, else each pair of blocks that a text belongs to, one of them of texts that didn't pass."""
    if judged is None:
        return members.withColumns({"x": F.lit(0), "y": F.lit(0)})
    blocks = lambda which: F.ceil(F.greatest(F.count_if(which) / block, F.coalesce(F.sum(F.when(which, F.col("bytes"))), F.lit(0)) / BYTES)).cast("int")
    groups = stored(judged.groupBy("value").agg(blocks(F.col("passed")).alias("near"), blocks(~F.col("passed")).alias("far")))
    small = members.join(groups.select("value"), "value", "left_anti").withColumns({"x": F.lit(0), "y": F.lit(0)})
    own = F.when(F.col("passed"), F.pmod(F.xxhash64("key"), "near")).otherwise(F.col("near") + F.pmod(F.xxhash64("key"), "far")).cast("int")
    first, last = F.when(F.col("passed"), F.col("near")).otherwise(0), F.col("near") + F.col("far") - 1
    partners = F.when(F.col("far") > 0, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    dealt = members.join(judged.select("value", "key", "passed"), ["value", "key"]).join(groups, "value").withColumns({"_own": own, "_with": F.explode(partners)})
    dealt = dealt.withColumns({"x": F.least("_own", "_with"), "y": F.greatest("_own", "_with")})
    return small.unionByName(dealt.drop("passed", "near", "far", "_own", "_with"))


def with_middles(members: DataFrame, block: int, column: str, passes: Callable[[bytes, bytes], bool], search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (a, b) that `search` finds in groups in blocks, and those of large groups to their middles."""
    large = large_groups(members, block)
    if large.isEmpty():
        return search(in_blocks(members, None, block))
    judged = stored(around_middles(members, large, column, passes))
    stars = judged.where("passed and key <> middle").select(F.col("key").alias("a"), F.col("middle").alias("b"))
    return search(in_blocks(members, judged, block)).unionByName(stars)


def by_groups(df: DataFrame, columns: list[str], chunk: int, fn: Callable[..., tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Edges (a, b) that `fn` gives for the numbers of the groups (value, x, y), the keys and `columns`, the last of them binary, of whole groups:
    as many at once as have up to `chunk` rows and 2 * BYTES, one at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk:
                table = pa.Table.from_batches(held)
                new = begins(table)
                cut = int(new[-1])  # the last group may go on in the next batch
                yield from packs(table.slice(0, cut), new[:-1])
                held = table.slice(cut).to_batches()
                rows -= cut
        if rows:
            table = pa.Table.from_batches(held)
            yield from packs(table, begins(table))

    def packs(table: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        lengths = pc.binary_length(table.column(columns[-1])).to_numpy()
        rows = np.r_[new, table.num_rows]
        size, at = np.r_[0, np.cumsum(lengths)][rows], 0
        while at < len(new):
            to = max(at + 1, min(np.searchsorted(rows, rows[at] + chunk, "right"), np.searchsorted(size, size[at] + 2 * BYTES, "right")) - 1)
            yield edges(table.slice(rows[at], rows[to] - rows[at]), new[at:to] - new[at])
            at = to

    def begins(table: pa.Table) -> np.ndarray:
        names = [table.column(n).to_numpy() for n in ("value", "x", "y")]
        return np.flatnonzero(np.r_[True, np.logical_or.reduce([n[1:] != n[:-1] for n in names])])

    def edges(table: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        number = np.repeat(np.arange(len(new)), np.diff(np.r_[new, table.num_rows]))
        several = np.bincount(number)[number] > 1
        table, number = table.filter(pa.array(several)), number[several]
        if not table.num_rows:
            return pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = fn(number, table.column("key").to_numpy(), *(table.column(n) for n in columns))
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    wanted = df.select("value", "x", "y", "key", *columns)
    return wanted.repartition("value", "x", "y").sortWithinPartitions("value", "x", "y").mapInArrow(run, "a long, b long").distinct()


def joined(fps: np.ndarray, number: np.ndarray, distance: int, test: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each text the first of those that pairs of a group join, which the index finds and `test` confirms; in Gray order by group."""
    root = np.arange(len(fps))
    for a, b in linked_pairs(fps, number, distance, PAIRS):
        for at in range(0, len(a), PAIRS):
            x, y = a[at : at + PAIRS], b[at : at + PAIRS]
            differ = root[x] != root[y]  # what is joined already needs no test
            x, y = x[differ], y[differ]
            good = test(x, y)
            if good.any():
                root = spanning(len(fps), iter([(np.arange(len(fps)), root), (x[good], y[good])]))
    return root


def agree(a: bytes, b: bytes) -> bool:
    return int(np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8))) >= AGREE


def similar_sets(alike: float) -> Callable[[bytes, bytes], bool]:
    def similar(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= alike * (len(x) + len(y) - both)

    return similar


def near_pairs(members: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between texts of a group whose fingerprints and sketches are near."""

    def search(number: np.ndarray, keys: np.ndarray, fp: pa.ChunkedArray, sketch: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        fps = fp.to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(fps), number))
        table = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(fps), -1)[order]
        root = joined(fps[order], number[order], distance, lambda x, y: (table[x] == table[y]).sum(axis=1) >= AGREE)
        inner, keys = root != np.arange(len(root)), keys[order]
        return keys[inner], keys[root[inner]]

    return by_groups(members, ["fp", "sketch"], CHUNK, search)


def tables_of(sets: list[np.ndarray], number: np.ndarray) -> list[np.ndarray]:
    """The sets as rows of bits, in tables of some columns each; `number` is each set's group, sorted.

    Groups use the same columns for shingles of their own, as only sets of a group are compared; a shingle that only one of them has is in no intersection and left out.
    """
    owners, columns, width = [], [], 0
    begins = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    for start, end in zip(begins, np.r_[begins[1:], len(sets)], strict=True):
        _, place, times = np.unique(np.concatenate(sets[start:end]), return_inverse=True, return_counts=True)
        shared = times[place] > 1
        owners.append(np.repeat(np.arange(start, end, dtype=np.int32), [len(s) for s in sets[start:end]])[shared])
        columns.append((np.cumsum(times > 1, dtype=np.int32) - 1)[place[shared]])
        width = max(width, int((times > 1).sum()))
    owner, column = np.concatenate(owners), np.concatenate(columns)
    step = max(64, TABLE // len(sets) // 64 * 64)
    out = []
    for start in range(0, width, step):
        cells = np.zeros((len(sets), min(step, -(-(width - start) // 64) * 64)), bool)
        inside = (column >= start) & (column < start + step)
        cells[owner[inside], column[inside] - start] = True
        out.append(np.packbits(cells, axis=1).view(np.uint64))
    return out


def links(members: DataFrame, distance: int, alike: float) -> DataFrame:
    """Edges (a, b) of a spanning forest of the links in each group."""

    def check(number: np.ndarray, keys: np.ndarray, fp: pa.ChunkedArray, shingles: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        fps = fp.to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(fps), number))
        given = shingles.combine_chunks()
        sets = [np.frombuffer(given[i].as_buffer(), np.uint64) for i in order.tolist()]
        sizes, tables = np.array([len(s) for s in sets]), tables_of(sets, number[order])

        def similar(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            both = np.zeros(len(x), np.int64)
            for bits in tables:
                step = max(1, TABLE // (8 * bits.shape[1]))
                for at in range(0, len(x), step):
                    both[at : at + step] += np.bitwise_count(bits[x[at : at + step]] & bits[y[at : at + step]]).sum(axis=1, dtype=np.int64)
            either = sizes[x] + sizes[y] - both
            return np.where(either > 0, both / np.maximum(either, 1), 1.0) >= alike

        root = joined(fps[order], number[order], distance, similar)
        inner, keys = root != np.arange(len(root)), keys[order]
        return keys[inner], keys[root[inner]]

    return by_groups(members, ["fp", "shingles"], SETS, check)


def near_copies(docs: DataFrame, alike: float = 0.8, shingle: int = 5, distance: int = 24) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of the component, of every document."""
    rows = stored(marked(docs, shingle))
    texts = stored(rows.groupBy("key").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("fp", "groups", "sketch")]))
    members = texts.select(F.explode("groups").alias("value"), "key", "fp", "sketch")
    weak = stored(with_middles(members, BLOCK, "sketch", agree, lambda m: near_pairs(m, distance)))
    near = stored(components(weak).select(F.col("root").alias("value"), F.col("node").alias("key")))
    sets = stored(shingled(docs, near.select("key"), shingle))
    sized = near.join(sets.withColumn("bytes", F.length("shingles")), "key")  # before the join, so that sizes alone are shuffled
    linked = with_middles(sized, SETS, "shingles", similar_sets(alike), lambda m: links(m, distance, alike))
    roots = stored(components(stored(linked)))
    placed = texts.select("key", "least").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("key", "component_id")
    return rows.select("doc_id", "key").join(stored(named), "key").select("doc_id", "component_id")


def deduplicated(docs: DataFrame, alike: float = 0.8, shingle: int = 5, distance: int = 24) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component; rows without a doc_id stay."""
    gone = stored(near_copies(docs, alike, shingle, distance).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
