"""Near copies by five-word shingles against brute force."""

import random

import corpus_pipeline
import pytest
from conftest import SF
from ledgerline.llm import near_copies
from pyspark.sql import functions as F


def shingles(t):
    words = (t or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)} - {()}


def brute(texts):
    sets, root = [shingles(t) for _, t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(texts):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: least[find(k)] for k, (i, _) in enumerate(texts)}


def changed(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    fresh = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    out = [None, "", " \n", "one", "One", "two words", "", *(fresh(120) for _ in range(40))]
    for _ in range(40):  # pairs on both sides of 0.8
        base = fresh(150)
        out += [base, changed(rng, base, rng.randrange(1, 7))]
    chain = fresh(150)
    for _ in range(12):  # each like its neighbour, the ends not
        out.append(chain)
        chain = changed(rng, chain, 2)
    base = fresh(200)
    out += [changed(rng, base, k % 6) for k in range(80)]  # a family that is alike to varied degrees
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [2000, 7])
def test_components_equal_brute_force(spark, monkeypatch, texts, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "SETS", block)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df).collect()}
    assert got == brute(texts)


@pytest.mark.parametrize("strays", [0, 25])
def test_a_large_family_around_a_text_costs_rows_in_proportion(spark, monkeypatch, strays):
    """Variants of one text, alike to it though not to one another, in groups far over the block: each is compared with the middle alone."""
    monkeypatch.setattr(near_copies, "BLOCK", 40)
    monkeypatch.setattr(near_copies, "SETS", 40)
    dealt = []
    was = near_copies.in_blocks
    monkeypatch.setattr(near_copies, "in_blocks", lambda m, judged, block: dealt.append((m.count(), was(m, judged, block))) or dealt[-1][1])
    rng = random.Random(5)
    base = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(200))
    rows = [(0, base), *((k, changed(rng, base, 4)) for k in range(1, 300)), *((1000 + k, changed(rng, base, 5 + k % 10)) for k in range(strays))]
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute(rows)
    texts, blocks = dealt[1]  # where shingles come along
    assert blocks.count() <= (0 if not strays else 3 * texts)


def test_stage_removes_near_copies_that_two_bits_miss(spark, texts):
    df = spark.createDataFrame([*texts, (None, texts[0][1])], "doc_id long, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    assert sorted(got, key=str) == sorted([*set(brute(texts).values()), None], key=str)


def test_stage_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()} == want


def test_a_task_searches_a_bounded_number_of_rows_and_bytes_at_once(spark):
    """All rows of an Arrow batch went to one search, however many groups they were of: its tables grew with the square of the rows."""
    import numpy as np

    rows = spark.range(3000).selectExpr("id div 2 value", "0 x", "0 y", "id key", "cast(repeat('x', cast(if(id < 1000, 40000, 8) as int)) as binary) shingles").coalesce(1)

    def told(number, keys, shingles):
        assert number[0] == 0 and len(set(number.tolist())) == len(number) / 2  # whole groups
        return np.array([len(number)]), np.array([sum(map(len, shingles.to_pylist()))])

    found = near_copies.by_groups(rows, ["shingles"], 500, told).collect()
    assert max(r["a"] for r in found) <= 500 and max(r["b"] for r in found) <= 2 * near_copies.BYTES


def test_groups_of_few_long_texts_are_dealt_in_blocks_too(spark):
    members = spark.range(64).selectExpr("7 value", "id key", "id fp", "cast(repeat('x', 262144) as binary) shingles", "262144 bytes").withColumn("value", F.col("value").cast("long"))
    found = []
    near_copies.with_middles(members, 1000, "shingles", lambda a, b: False, lambda m: found.append(m) or m.selectExpr("key a", "key b"))
    sizes = found[0].groupBy("value", "x", "y").agg(F.sum(F.length("shingles")).alias("bytes"), F.collect_set("key").alias("keys")).collect()
    assert max(r["bytes"] for r in sizes) <= 3 * near_copies.BYTES  # 16 MB in all
    met = {(a, b) for r in sizes for a in r["keys"] for b in r["keys"] if a < b}
    assert len(met) == 64 * 63 // 2


def test_a_search_holds_few_of_the_pairs_of_a_large_group():
    import tracemalloc

    import numpy as np
    from ledgerline.llm.simhash import gray_rank

    rng = np.random.default_rng(3)
    fps = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (6, 4000), np.uint64), axis=0)  # at most 12 bits apart
    fps = fps[np.argsort(gray_rank(fps))]
    tracemalloc.start()
    root = near_copies.joined(fps, np.zeros(len(fps), np.int64), 24, lambda x, y: (x % 2 == 0) & (y % 2 == 0))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6
    assert sorted(np.unique(root, return_counts=True)[1].tolist()) == [1] * 2000 + [2000]
