"""Conversation repair, substring deduplication and ranked search against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from compare import differences, duck
from conftest import SF
from ledgerline.llm import conversations, ranked_search, substrings
from ledgerline.llm.queries import oracle_sql, queries

KEY = lambda r: tuple(map(str, r))


def in_order(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=KEY)


# conversations


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        kept += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def repaired(rows):
    """All ways through a conversation, by recursion over what is left of it; the least of cost and letters wins."""
    out = []
    for conv, kept in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in kept:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "" if marks[-1] in ".!?" else "truncated")
            seen.add((role, text))

        @cache
        def best(i, done, inserts=2, kept=kept, faults=faults):
            last = done[-1:]
            ways = [(0, "", ())] if i == len(kept) and last in ("", "a") else []
            asked = ("assistant", "a") if last == "u" else ("user", "u")
            if inserts:
                cost, letters, lines = best(i, asked[1], inserts - 1)
                ways.append((cost + 3, "I" + letters, (asked[0] + ":", *lines)))
            if i < len(kept):
                _, role, text = kept[i]
                cost, letters, lines = best(i + 1, done)
                ways.append((cost + 4, "D" + letters, lines))
                extra = 3 if faults[i] == "truncated" else 0
                for name, initial in (asked, ("system", "s")) if faults[i] not in ("blank", "duplicate") else ():
                    if initial == "s" and (done or role[:1] != "s"):
                        continue
                    cost, letters, lines = best(i + 1, initial)
                    keeps = role[:1] == initial
                    ways.append((cost + extra + 3 * (not keeps), "RK"[keeps] + letters, (f"{role if keeps else name}:{text}", *lines)))
            return min(ways, default=(10**9, "~", ()))

        for i in range(len(kept), 0, -1):  # from the end, so that the recursion stays flat
            for done in ("", "s", "u", "a"):
                best(i, done)
        cost, letters, lines = best(0, "")
        turns = [t for t, _, _ in kept if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] or not b[1] for a, b in zip(kept, kept[1:], strict=False))
        counts = (faults.count(x) for x in ("blank", "duplicate", "truncated"))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=KEY)


ROLES = ("user", "assistant", "system", "user", "assistant", "tool", "", None, "u2")
TEXTS = ("hi.", "ok", "A. b", "", None, " \n", "what?", "x!  ", "日本。", "é.")


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = [(c if c % 40 else None, rng.choice([t, t, t, None, t + 2]), rng.choice(ROLES), rng.choice([*TEXTS, f"d{rng.random()}."])) for c in range(160) for t in range(rng.randrange(1, 9))]
    return rows + rows[:60] + [(900, t, "user", "same.") for t in range(40)] + [(901, 1, "assistant", "equal rows.")] * 30


@pytest.mark.parametrize("block", [conversations.BLOCK, 3])
def test_repairs_equal_all_ways(spark, monkeypatch, talks, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(6)
    long = [(7, t // 2, rng.choice(ROLES[:4]), rng.choice(["a.", f"b{t}.", f"c{t}", ""])) for t in range(400)]
    rows = [(*r, "clash", 5) for r in [*talks, *long]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, copies int").repartition(3)
    got = in_order(conversations.repaired(df))
    assert got == repaired([*talks, *long])
    for *_, letters, _ in got:
        assert not set(letters) - set("KRDI")


def test_long_texts_and_no_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "word " * 200_000 + "end."), (1, 1, "assistant", "x" * 500_000)]
    assert in_order(conversations.repaired(spark.createDataFrame(rows, schema))) == repaired(rows)
    assert conversations.repaired(spark.createDataFrame([], schema)).collect() == []


def test_checkpoints_give_the_walk_of_all_vectors():
    rng = random.Random(8)
    for _ in range(300):
        codes = [(rng.choice("sua-"), rng.random() < 0.2, rng.random() < 0.2, 1) for _ in range(rng.randrange(0, 30))]
        codes = [(i, must, t and not must, rng.randrange(1, 4) if must else 1) for i, must, t, _ in codes]
        v = vectors = [conversations.END]
        for code in reversed(codes):
            vectors = [conversations.step(code, vectors[0]), *vectors]
        edits, states, cost = conversations.walks(codes, conversations.END)
        assert cost == vectors[0][0]
        for entry in range(4):
            state, letters = entry, ""
            for i, code in enumerate(codes):
                used = False
                while not used:
                    letter, state, used = conversations.tight(code, state, vectors[i], vectors[i + 1])
                    letters += letter
            assert (letters, state) == (edits[entry], states[entry])
        m = conversations.matrix(codes)
        assert [min(m[4 * s + e] + v[0][e] for e in range(4)) for s in range(4)] == list(vectors[0])


# substrings


def without_repeats(texts, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(x[i : i + window]) for x in words for i in range(len(x) - window + 1))
    for x in words:
        gone = {i + k for i in range(len(x) - window + 1) if counts[tuple(x[i : i + window])] > 1 for k in range(window)}
        yield len(x), len(gone), hashlib.sha256(" ".join(w for i, w in enumerate(x) if i not in gone).encode()).hexdigest()


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, texts = fresh(120), [None, "", " \n\t", "one", "two words"]
    texts += [" ".join(fresh(20) + shared[rng.randrange(60) :][: rng.randrange(20, 60)] + fresh(20)) for _ in range(60)]
    texts += [" ".join(shared[:n]) for n in (33, 34, 35, 36, 35)]
    texts += [" ".join(fresh(50))] * 30 + [" ".join(shared)] * 20
    texts += ["same " * 200, "a b " * 90 + "c", "b " + "a b " * 40, "a b c " * 33 + "a b c d", "same " * 34, "same " * 36 + "other"]
    near = fresh(150)
    for _ in range(40):
        changed = list(near)
        changed[rng.randrange(150)] = "new"
        texts.append("\n".join(changed))
    twice = fresh(40)
    texts += [" ".join(twice + fresh(3) + twice), "é 日本 " * 30, "\x1c\x85 　 " * 20, "x" * 100_000, " ".join(fresh(30_000))]
    return texts


@pytest.mark.parametrize("window", [35, 3])
def test_repeats_equal_brute_force(spark, passages, window):
    rows = [(i if i % 50 else None, t, i, 1, "clash") for i, t in enumerate(passages)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, n_removed long, spans string").repartition(5)
    want = sorted(((r[0], *b) for r, b in zip(rows, without_repeats(passages, window), strict=True)), key=KEY)
    assert in_order(substrings.deduplicated(df, window), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    for r in substrings.deduplicated(df, window).collect():
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_repeats_of_no_texts(spark):
    assert substrings.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_symbols_of_equal_spans_are_equal():
    """A symbol is in every text that holds the words it depends on, at the same place."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 50, 3000).astype(np.uint64)
    words[::7] = 3

    def symbols(words):
        s = substrings.runs(words, np.arange(len(words)) == 0)
        for number in range(1, substrings.ROUNDS + 1):
            s = substrings.paired(s, number)
        return {(int(n), int(lo), int(hi)) for n, lo, hi in zip(s.name, s.lo, s.hi, strict=True)}

    for name, lo, hi in sorted(symbols(words))[::5]:
        if lo >= 0 and hi <= len(words):
            other = np.r_[rng.integers(0, 50, 100).astype(np.uint64), words[lo:hi], rng.integers(0, 50, 100).astype(np.uint64)]
            assert (name, 100, 100 + hi - lo) in symbols(other)


# search


def ranked(docs, items, k=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = lambda t: Counter(x.translate(lower) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))
    held = [(i, c, c.total()) for i, t in docs if (c := terms(t))]
    length, df = sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    for item, text in items:
        weights = {t: times * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) for t, times in terms(text).items()}
        scores = []
        for i, c, n in held:
            m = 25 + 75 * n * len(held) // length
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        yield from ((item, rank, i, -score) for rank, (score, *_, i) in enumerate(sorted(scores)[:k], 1))


@pytest.mark.parametrize(("block", "step", "group"), [(8192, 64, 500_000), (11, 2, 6)])
def test_ranks_equal_brute_force(spark, monkeypatch, block, step, group):
    for name, value in (("BLOCK", block), ("STEP", step), ("GROUP", group)):
        monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünï", "日本語", "ÀB", "x1", "K9"]
    some = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(45)], k=n))
    docs = [(None, "w1 w2"), (1, None), (2, ""), (3, "--- ..."), (4, "W1,w2;W1"), (5, "w1 w2"), (5, "w1 w2"), (6, "w1 w2"), (7, "x" * 100_000), (8, "w1 " * 50_000)]
    docs += [(10 + i, some(rng.randrange(1, 60))) for i in range(200)]
    items = [(0, None), (1, ""), (2, "w1"), (3, "W1 w1 w2!"), (4, "nowhere"), (5, "àB ÀB x1 k9 日本語"), (5, "w3"), *((10 + i, some(20)) for i in range(12))]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, terms string, score int").repartition(4)
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, rank int")
    assert in_order(ranked_search.searched(df, asked)) == sorted(ranked(docs, items), key=KEY)


def test_no_documents_or_no_items(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.searched(docs.limit(0), items).collect() == []
    assert ranked_search.searched(docs, items.limit(0)).collect() == []
    assert ranked_search.searched(docs.where("doc_id < 0"), items.where("item_id < 0")).collect() == []


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_substring_dedup", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, name):
    assert differences(queries()[name](spark, SF), duck(SF), oracle_sql()[name]) == ""
