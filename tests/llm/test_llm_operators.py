"""The ten operators against libraries, brute force and round trips, and on awkward rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from conftest import SF
from ledgerline.llm import byte_bpe, license_index, license_texts, line_quality, ogg, packing, pii, quality_crf, simhash, token_counts, url_templates
from ledgerline.llm.queries import queries
from pyspark.sql import functions as F

WORD_BPE, BYTE_BPE = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
LONG = "word " * 30_000 + "x" * 50_000
AWKWARD = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "one",
    "one two\n\none two\n",
    "Ünïcode ß İ ΑΣ ſ K 日本語 😀 é",
    "<|endoftext|> in <|startoftext|> text <|x",
    "a\x1cb\x85c　d​e  f   g \n \n h",
    "it's WE'LL 12３ don't",
    "mail a.b@c.example.org, 10.0.0.1 and 300.1.1.1, 4111 1111 1111 1111, +1 (555) 010-9999 @ x@y @",
    "This work is licensed under the GNU General Public License, version 3. Apache license; CC BY 4 cc by MIT License",
    "http://no",
    "same text twice",
    "same text twice",
    LONG,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src" if i % 3 else None, 1, "clash", 5) for i, t in enumerate(AWKWARD)] + [(None, "null id", None, None, None, None, None), (3, "one", "en", "src", 1, "clash", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, rank int").repartition(3).cache()


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_token_counts_equal_the_library(docs, sample):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    for df in (docs, sample):
        want = Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts_of(df))
        got = token_counts.token_counts(df, WORD_BPE).collect()
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


def test_byte_bpe_equals_the_library_and_comes_back(docs, sample):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs, sample):
        want = Counter()
        for i, t in texts_of(df):
            ids = library.encode_ordinary(t or "")
            want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
        assert Counter(map(tuple, byte_bpe.round_trip(df, BYTE_BPE, P.PATTERN).collect())) == want
    back = byte_bpe.decode(byte_bpe.encode(docs, BYTE_BPE, P.PATTERN), BYTE_BPE, P.PATTERN)
    assert Counter((r["doc_id"], bytes(r["content"])) for r in back.collect()) == Counter((i, (t or "").encode()) for i, t in texts_of(docs))


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = [f"k{i}".encode() for i in range(997)]
    index = byte_bpe.PerfectHash(keys)
    assert sorted(index.key_at) == list(range(997))
    assert [index.find(k) for k in keys] == list(range(997))
    assert all(index.find(f"x{i}".encode()) == -1 for i in range(500))
    assert byte_bpe.PerfectHash([]).find(b"a") == -1


def brute_quality(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines, seen, repeats = t.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), repeats, len(covered)


def test_quality_measures_equal_brute_force(docs, sample):
    for df in (docs, sample):
        want = Counter((i, *brute_quality(t)) for i, t in texts_of(df))
        got = line_quality.judged(df).collect()
        assert Counter((r["doc_id"], *(r[c] for c in line_quality.STATS)) for r in got) == want
        assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in got)


def test_depleted_documents_go_and_families_of_copies_above_the_limit_too(spark):
    rng = random.Random(3)
    fresh = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    banner = fresh(60)
    rows = [(i, f"{fresh(70)}\n{banner}", "h") for i in range(40)]
    rows += [(100 + i, f"{banner}\n{fresh(4)}", "h") for i in range(4)]
    family = [fresh(30) for _ in range(6)]
    rows += [(200 + i, "\n".join([*family[: i % 6], fresh(30), *family[i % 6 + 1 :]]), "h") for i in range(30)]
    rows += [(300 + i, "\n".join(family), "h") for i in range(30)]
    got = {r["doc_id"]: r["kept"] for r in line_quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(kept == (i < 40) for i, kept in got.items())


def test_limit_is_the_same_share_of_every_size(spark):
    for n in (2000, 200_000):  # of which 0.75 % hold line 1 and 1.25 % line 2
        lines = F.expr(f"array_compact(array(if(id < {n} * 75 div 10000, 1, null), if(id < {n} * 125 div 10000, 2, null), id + 10))")
        texts = spark.range(n).select(F.lit("h").alias("source"), lines.alias("lines"))
        assert [r["line"] for r in line_quality.frequent_lines(texts, 0.01, 5).collect()] == [2]


def test_null_and_repeated_ids_drop_no_row_that_passed(spark):
    good = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [(None, good[0], "h"), (None, "", "h"), (None, None, None), (None, good[1], None), (7, good[2], "h"), (7, "short", "h"), (8, None, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert Counter(map(tuple, line_quality.kept_documents(df).collect())) == Counter([rows[0], rows[3], rows[4]])


def brute_components(texts):
    def one(t):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [one(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(texts))


def test_components_equal_brute_force(docs, sample):
    for df in (docs.where("length(text) < 1000 or text is null"), sample):
        assert Counter(map(tuple, simhash.near_duplicates(df).collect())) == brute_components(texts_of(df))


def test_links_of_dense_groups_are_all_found(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    fps = {centre}
    for _ in range(1500):
        x = centre
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 500)}
    values = np.array(sorted(fps), np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    want = {frozenset(values[k] for k in range(len(values)) if find(k) == r) for r in set(map(find, range(len(values))))}
    monkeypatch.setattr(simhash, "HOT", 100)  # deals the dense group anew, three levels deep
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {}
    for r in simhash.components(simhash.forest_edges(table, 2)).collect():
        got.setdefault(r["root"], set()).add(r["node"])
    groups = {frozenset(np.array(sorted(g), np.int64).view(np.uint64).tolist()) for g in got.values()}
    assert groups == {frozenset(int(x) for x in g) for g in want if len(g) > 1}


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[1000] == roots[1001] != roots[0]


def test_urls(spark):
    rows = [(1, "HTTPS://WWW.Example.COM/en/a?x#y"), (2, "http://a.example.com/en/b"), (3, "ftp://x.net/es/1"), (4, "http://x.net/de/1"), (5, None), (6, "no scheme"), (7, "http://com"), (8, "http://examplexcom/en/"), (9, "http://b.com?q"), (None, "http://c.net/fr/#"), (9, "http://b.com?q")]
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_templates.filtered(spark.createDataFrame(rows, "page_id long, url string")).collect())
    assert got == Counter([
        (1, "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        (2, "a.example.com", "/en/b", "example.com/en/", "block"),
        (3, "x.net", "/es/1", "net/es/", "block"),
        (4, "x.net", "/de/1", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "com", "", None, "allow"),
        (8, "examplexcom", "/en/", None, "allow"),
        (9, "b.com", "", None, "allow"),
        (9, "b.com", "", None, "allow"),
        (None, "c.net", "/fr/", "net/fr/", "block"),
    ])


def test_templates_are_learnt_from_rules(spark):
    # numbered children of one branch: those that a rule blocks decide for the branch as a whole
    rules = (("block", "bad.org/x/1"),)
    rows = [(i, f"http://bad.org/x/{i}") for i in range(10, 20)] + [(i, f"http://bad.org/x/{i}") for i in range(2, 6)] + [(50, "http://bad.org/y/2")]
    got = {r["page_id"]: r["verdict"] for r in url_templates.filtered(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[3] == "block" and got[50] == "allow"


def brute_tree(pages, rules, max_children=16, depth=8, prior=1.0, purity=0.8, confidence=0.05):
    """{(host, path): (template, purity, judgement)} by walking each host's tree."""
    varies = re.compile(r"(?:[0-9][0-9.,_-]*|[0-9a-fA-F]{8,}|[A-Za-z_-]*[0-9]+[A-Za-z_-]+[0-9]+[0-9A-Za-z_-]*|.{41,})(\.[A-Za-z]{1,5})?")

    def says(host, path):
        fit = [(len(r), v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]) :])]
        return max(fit)[1] if fit else None

    def shaped(path):
        parts = [p for p in path.split("/") if p]
        own = [("*" + (m.group(1) or "")) if (m := varies.fullmatch(p)) else p for p in parts[:depth]]
        return (*own, "**") if len(parts) > depth else tuple(own)

    out = {}
    for host in {h for h, _ in pages}:
        paths = [p for h, p in pages if h == host]
        kids = {}
        for s in map(shaped, paths):
            for i, x in enumerate(s):
                if not x.startswith("*"):
                    kids.setdefault(s[:i], set()).add(x)
        place = {p: tuple("*" if len(kids.get(shaped(p)[:i], ())) > max_children and not x.startswith("*") else x for i, x in enumerate(shaped(p))) for p in set(paths)}
        totals, below, goes_on = {}, {}, {}
        for p in paths:
            t, v = place[p], says(host, p)
            for i in range(len(t) + 1):
                b, d = totals.get(t[:i], (0, 0))
                totals[t[:i]] = b + (v == "block"), d + (v is not None)
                if i:
                    below.setdefault(t[: i - 1], set()).add(t[:i])
                    goes_on.setdefault(t[:i], Counter())[t[i] if i < len(t) else ""] += 1

        def alike(a, b):
            (ba, da), (bb, db) = totals[a], totals[b]
            most_for = lambda m, n: (0.5 * math.log(2 / confidence)) ** 0.5 * (1 / m**0.5 + 1 / n**0.5)
            if da and db and abs(ba / da - bb / db) > most_for(da, db):
                return False
            a, b = goes_on[a], goes_on[b]
            most = most_for(a.total(), b.total())
            return most <= 1 and all(abs(a[x] / a.total() - b[x] / b.total()) <= most for x in {*a, *b})

        def name(branch):
            kin, met, todo = below[branch[:-1]], {branch}, [branch]
            while todo:
                now = todo.pop()
                new = {k for k in kin - met if alike(now, k)}
                met |= new
                todo += new
            return "+" + min(k[-1] for k in met) if len(met) > 1 else branch[-1]

        merged, told, pooled = {}, {}, {}
        for t in set(place.values()):
            way, p = [], 0.5
            for i in range(len(t)):
                kin = [totals[k] for k in below[t[:i]]]
                votes = [(kb + prior) / (kd + 2 * prior) for kb, kd in kin if kd]
                way.append(name(t[: i + 1]))
                p = (sum(votes) + 2 * prior * p) / (len(votes) + 2 * prior)
            merged[t], told[t] = tuple(way), p
        leaves = Counter()
        for p in paths:
            v = says(host, p)
            leaves[merged[place[p]], "b"] += v == "block"
            leaves[merged[place[p]], "d"] += v is not None
        for p in paths:
            t = place[p]
            clean = round((leaves[merged[t], "b"] + 2 * prior * told[t]) / (leaves[merged[t], "d"] + 2 * prior), 6)
            out[host, p] = "/" + "/".join(merged[t]), clean, "block" if clean >= purity else "allow"
    return out


def test_tree_equals_brute_force(spark):
    rng = random.Random(11)
    rules = (("block", "a.net/x/"), ("allow", "a.net/y/"), ("block", "net/z/q"), ("block", "b.net/d/x/u"), ("allow", "net/d/"))
    names = ["x", "y", "z", "q", "d", "u", "12", "deadbeef99", "7.html", "n" * 50]
    urls = [f"http://{rng.choice(['a.net', 'b.net', 'c.org'])}/" + "/".join(rng.choice(names) for _ in range(rng.randrange(5))) for _ in range(1500)]
    urls += [f"http://a.net/w/t{i}x/u" for i in range(30)] + ["http://b.net/" + "/".join("abcdefghijkl"), "http://b.net" + "/s" * 3000, "http://c.org/" + "v" * 100_000]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, template string")
    rows = url_templates.filtered(df, rules).collect()
    want = brute_tree([(r["host"], r["path"]) for r in rows], rules)
    assert len(rows) == len(urls)
    for r in rows:
        template, clean, judgement = want[r["host"], r["path"]]
        assert (r["template"], r["judgement"]) == (template, judgement) and abs(r["purity"] - clean) < 2e-6, r
    assert len({r["purity"] for r in rows if r["rule"] is None}) > 3


def test_branches_without_labels_take_over_what_their_siblings_agree_on(spark):
    rules = tuple(("block", f"h.net/{k}/") for k in "abcdef")
    rows = [(i, f"http://h.net/{k}/{i}") for i, k in enumerate("abcdef" * 20)] + [(500, "http://h.net/new/1"), (501, "http://other.net/new/1")]
    got = {r["page_id"]: r for r in url_templates.filtered(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[500]["verdict"] == "block" and got[500]["rule"] is None and got[500]["purity"] != 0.5
    assert got[501]["verdict"] == "allow" and got[501]["purity"] == 0.5


def test_alike_branches_share_their_labels(spark):
    """Sections of the same make-up: the ones that rules block decide for the one that no rule names, not for one that is made otherwise."""
    rules = (("block", "h.net/es/"), ("block", "h.net/fr/"))
    parts = {"es": "0", "fr": "0", "de": "0", "about": "team/page"}
    rows = [(k * 100 + i, f"http://h.net/{lang}/{1000 + i if below == '0' else below + str(i % 3)}") for k, (lang, below) in enumerate(parts.items()) for i in range(20)]
    rows += [(900, "http://h.net/it/1"), (901, "http://h.org/es/1")]
    got = {r["page_id"]: r for r in url_templates.filtered(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert {got[200 + i]["verdict"] for i in range(20)} == {"block"} and got[200]["rule"] is None and got[200]["template"] == "/+de/*"
    assert {got[300 + i]["verdict"] for i in range(20)} == {"allow"}
    assert got[900]["template"] == "/it/*" and got[901]["verdict"] == "allow"  # one page tells nothing


EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"


def brute_spans(t):
    t = t or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(IP, t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if pii.fits("card", m.group())]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if pii.fits("phone", m.group())]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_patterns_equal_brute_force():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("ab@.1234567890 +-()@.\n") for _ in range(rng.randrange(60)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("1" * 200_000 + "@" * 1000 + "a" * 200_000) == []


def test_personal_data(docs, sample):
    for df in (docs, sample):
        texts = texts_of(df)
        want = Counter((i, pii.span_text(brute_spans(t))) for i, t in texts if len(t or "") < 50_000)
        lookup = {hashlib.sha256(s.encode()).hexdigest(): s for _, s in want}
        rows = [r for r in pii.found(df).collect() if r["base_sha256"] in lookup]
        assert Counter((r["doc_id"], lookup[r["base_sha256"]]) for r in rows if (r["doc_id"], lookup[r["base_sha256"]]) in want) == want
        for r in rows:
            assert set(filter(None, lookup[r["base_sha256"]].split(","))) <= set(r["spans"].split(","))


def test_field_finds_other_notations_and_leaves_numbers_alone():
    field = pii.trained()
    texts = ["please call (555) 555-0199 at the office", "see 2021-03-04 and 12:30:45 or 3.14 with 1,234,567 items", "in 1999 the order 12345678 came"]
    spans = [s for _, s in pii.all_spans(texts, field)]
    assert ("phone", 12, 26) in spans[0] and not spans[1] and not spans[2]


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(4)
    field = pii.Field(rng.normal(size=(30, 5)), rng.normal(size=(5, 5)))
    sequences = [rng.integers(0, 30, (n, 3)) for n in (1, 2, 4, 4, 5)]
    for rows, got in zip(sequences, field.decode(sequences), strict=True):
        emit = field.weights[rows].sum(axis=1)
        worth = lambda p: sum(emit[k, y] for k, y in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:], strict=False))
        assert tuple(got) == max(np.ndindex(*[5] * len(rows)), key=worth)


def test_field_is_right_on_rows_that_training_did_not_see():
    field = pii.trained()
    for kind, (precision, recall) in pii.measured(field, pii.labelled_table(600, seed=8)).items():
        assert precision >= 0.93 and recall >= 0.93, kind
    for kind, (precision, recall) in pii.measured(field, pii.labelled_table(600, seed=9, unseen=True)).items():
        assert precision >= 0.9 and recall >= 0.5, kind


def test_tokens_of_any_length_are_described_whole():
    a, b = "x1" * 40, "x1" * 39 + "x2y"
    assert pii.shape(a) != pii.shape(b) and pii.described("abcdefghijklmnopq")[2] == "wabcdefghijklmnopq"
    assert pii.all_spans(["7" * 100_000 + " dot " + "z" * 100_000], pii.trained()) == [([], [])]


def test_redaction(docs):
    out = {r["doc_id"]: r for r in pii.redacted(docs).collect()}
    assert out[0]["text"] is None and "<email>" in out[9]["text"] and "<ip>" in out[9]["text"] and "300.1.1.1" in out[9]["text"]
    assert out[9]["n_chars"] == len(out[9]["text"]) and out[9]["fp"] == "clash"


def test_quality_is_learnt(spark, sample):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_crf.scored(sample, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)


def test_quality_on_awkward_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_crf.scored(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(len(AWKWARD))] + [(1, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_crf.scored(docs, some).collect()
    assert len(rows) == len(AWKWARD) + 2 and all(0 <= r["score"] <= 1 for r in rows)


def test_training_takes_bounded_stretches_and_one_text_a_document(spark):
    rng = random.Random(2)
    good = lambda n: "\n".join("A plain sentence with words, and an end." for _ in range(n))
    bad = lambda n: "\n".join("BUY ### $$$ | !!!" for _ in range(n))
    rows = [(i, good(rng.randrange(1, 9)) if i % 2 else bad(rng.randrange(1, 9)), "clash") for i in range(80)] + [(1, good(30_000), "clash")] * 3 + [(2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, 0, "clash") for i in range(80)] + [(1, 1, 0, None)], "doc_id long, quality int, toxic int, text string")
    got = quality_crf.scored(docs, labels, sample=60).collect()
    assert len(got) == len(rows) and all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] != 2)
    own = np.arange(1000)
    part = quality_crf.stretch(own, "a text", 100)
    assert len(part) == 100 and (np.diff(part) == 1).all() and len(quality_crf.stretch(own[:50], "a text", 100)) == 50
    assert not np.array_equal(part, quality_crf.stretch(own, "another", 100))


def test_line_features_are_what_they_say():
    text = "AAA bb\n\nAAA bb\nx, x, x"
    rows, sizes = quality_crf.line_features(text)
    assert sizes.tolist() == [7, 1, 7, 7] and rows.shape == (4, quality_crf.OWN)
    assert np.isclose(rows[0, 0], (3 / 7) ** 0.5) and np.isclose(rows[0, 1], (2 / 7) ** 0.5)
    repeat, blank = rows[:, quality_crf.CLASSES + 5], rows[:, quality_crf.CLASSES + 6]
    assert repeat.tolist() == [0, 0, 1, 0] and blank.tolist() == [0, 1, 0, 0]
    assert np.isclose(rows[3, quality_crf.CLASSES + 1], 1 - 2 / 3) and np.isclose(rows[3, quality_crf.CLASSES + 2], 1 / 3)
    wide = quality_crf.neighboured(rows)
    own = quality_crf.OWN
    assert np.array_equal(wide[1, own : 2 * own], rows[0]) and np.array_equal(wide[1, 2 * own : 3 * own], rows[2]) and wide[0, -2] == 1 and wide[3, -1] == 1


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    unary, moves = rng.normal(size=5), rng.normal(size=(2, 2))
    weights = {}
    for path in np.ndindex(*[2] * 5):
        weights[path] = np.exp(sum(unary[k] * y for k, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
    want = [sum(w for p, w in weights.items() if p[k]) / sum(weights.values()) for k in range(5)]
    assert np.allclose(quality_crf.marginals(np.r_[unary, unary[:2]], moves, np.array([5, 2]))[:5], want)


def test_packing(docs, sample):
    for df in (docs, sample):
        texts = {i: t for i, t in texts_of(df)}
        rows = packing.packed(df, capacity=200, per_source=3, shard=100).collect()
        want = Counter()
        for i, t in texts_of(df):
            want[i] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        got = Counter()
        for r in rows:
            got[r["doc_id"]] += r["n_words"]
        assert got == +want
        bins = {}
        for r in rows:
            bins.setdefault(r["bin_id"], []).append(r)
        for pieces in bins.values():
            pieces.sort(key=lambda r: r["bin_offset"])
            assert sum(r["n_words"] for r in pieces) <= 200
            assert all(a["bin_offset"] + a["n_words"] == b["bin_offset"] for a, b in zip(pieces, pieces[1:], strict=False))
            whole = [texts.get(r["doc_id"]) for r in pieces if r["n_words"] < 200]
            assert len(whole) == len(set(whole))
            assert max(Counter(r["source"] for r in pieces).values()) <= 3


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10, 2)
    assert bins.place(6, 1, 0) == (0, 10) and bins.place(7, 2, 0) == (1, 10)
    assert bins.place(3, 2, 1) == (0, 4)  # the tighter bin 1 holds the cluster already
    assert bins.place(1, 0, 0) == (0, 1)
    assert bins.place(3, 0, 1) == (1, 3)
    assert bins.place(1, 0, 0) == (2, 10)


def naive_packing(rows, capacity, per_source):
    """{(bin, offset): (doc_id, piece, n)} of one shard, looking through all bins for each piece."""
    out, bins = Counter(), []
    for doc_id, source, cluster, n in sorted(rows, key=lambda r: (-(r[3] % capacity), r[0] is None, r[0] or 0, r[1] or "", r[2])):
        for piece in range(n // capacity):
            out["whole", doc_id, source, piece, piece * capacity, capacity, 0] += 1
        if n % capacity:
            fit = [b for b in bins if b["room"] >= n % capacity and cluster not in b["clusters"] and b["sources"][source] < per_source]
            if fit:
                use = min(fit, key=lambda b: (b["room"], b["number"]))
            else:
                use = {"room": capacity, "number": len(bins), "clusters": set(), "sources": Counter()}
                bins.append(use)
            out[use["number"], doc_id, source, n // capacity, n // capacity * capacity, n % capacity, capacity - use["room"]] += 1
            use["room"] -= n % capacity
            use["clusters"].add(cluster)
            use["sources"][source] += 1
    return out


def numbered(rows):
    return Counter(("whole" if "-w" in r[0] else int(r[0].split("-")[1]), *r[1:]) for r in map(tuple, rows))


@pytest.mark.parametrize("seed", range(4))
def test_packing_equals_a_naive_packer(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(150)]), rng.choice([None, "a", "b"]), rng.randrange(40), rng.choice([1, 3, 5, 10, 17, 30, 64, 100, 130])) for _ in range(300)]  # ties and repeats
    assert numbered(packing.pack_shard(rows, 0, 64, 3)) == naive_packing(rows, 64, 3)
    df = spark.createDataFrame([(i, s, f"t{c}", n) for i, s, c, n in rows], "doc_id long, source string, text string, n_tokens int").repartition(3)
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    got = packing.packed(df, capacity=64, per_source=3, shards=1, length="n_tokens").collect()
    assert numbered(got) == naive_packing([(i, s, hashes[f"t{c}"], n) for i, s, c, n in rows], 64, 3)


def test_packing_of_clusters_copies_and_wordless_rows(spark):
    rows = [(1, "a b", "s"), (2, "c d", "s"), (3, "e f", "s"), (None, "g h", "s"), (4, "", "s"), (5, None, None), *[(7, "same text", "t")] * 5]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    near = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (None, 1)], "doc_id long, component_id long")
    got = packing.packed(df, capacity=8, shards=1, clusters=near).collect()
    at = {r["doc_id"]: r["bin_id"] for r in got}
    assert at[1] != at[2] and at[4] is None and at[5] is None and len(got) == len(rows)
    assert len({r["bin_id"] for r in got if r["doc_id"] == 7}) == 5
    many = packing.packed(df, capacity=8, shard=2).where("doc_id = 7").selectExpr("split(bin_id, '-')[0] shard").distinct().count()
    assert many > 1  # copies of one row are dealt to several shards


def test_ogg_round_trip_and_damage():
    for data in (b"", b"a", b"x" * 64, bytes(range(256)) * 700):
        payload = ogg.padded(data)
        assert len(payload) % 64 == 0 and len(payload) >= max(64, len(data)) and payload.startswith(data)
        media = ogg.write_ogg(payload)
        streams = ogg.read_ogg(media)
        assert ogg.stored_payload(streams) == payload and len(streams) == 2
        with pytest.raises(ValueError):
            ogg.read_ogg(media[:-1] + bytes([media[-1] ^ 1]))
        with pytest.raises(ValueError):
            ogg.read_ogg(media[:-1])
    # by the definition, bit by bit
    register = 0
    for byte in b"123456789":
        register ^= byte << 24
        for _ in range(8):
            register = (register << 1 ^ (0x04C11DB7 if register >> 31 else 0)) & 0xFFFFFFFF
    assert ogg.page_checksum(b"123456789") == register


def test_media(docs):
    want = Counter((i, len((t or "").encode()), hashlib.sha256(ogg.padded((t or "").encode())).hexdigest(), zlib.crc32(ogg.padded((t or "").encode())[-64:])) for i, t in texts_of(docs))
    rows = ogg.media_digests(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
    media = {r["doc_id"]: bytes(r["media"]) for r in ogg.write_media(docs).collect()}
    assert all(hashlib.sha256(media[r["doc_id"]]).hexdigest() == r["media_sha256"] for r in rows if r["doc_id"] not in (None, 3))


def test_ogg_pages_interleave_and_every_packet_has_its_time():
    payload = ogg.padded(bytes(range(256)) * 900)
    media, at, pages = ogg.write_ogg(payload), 0, []
    while at < len(media):
        _, _, flags, granule, serial, sequence, _, n = ogg.HEAD.unpack_from(media, at)
        lacing = media[at + ogg.HEAD.size : at + ogg.HEAD.size + n]
        pages.append((serial, sequence, flags, granule, lacing))
        at += ogg.HEAD.size + n + sum(lacing)
    serials = [p[0] for p in pages]
    assert len(set(serials)) == 2 and sum(a != b for a, b in zip(serials, serials[1:], strict=False)) >= 6
    for serial in set(serials):
        own = [p for p in pages if p[0] == serial]
        assert [p[1] for p in own] == list(range(len(own)))
        assert [bool(p[2] & ogg.FIRST) for p in own] == [True] + [False] * (len(own) - 1)
        assert [bool(p[2] & ogg.LAST) for p in own] == [False] * (len(own) - 1) + [True]
        assert [bool(p[2] & ogg.CONTINUED) for p in own] == [False] + [p[4][-1] == 255 for p in own[:-1]]
    streams = ogg.read_ogg(media)
    sound = next(s for s in streams.values() if not s.packets[0].startswith(b"pcm8head"))
    assert sound.times == [min((k + 1) * ogg.PACKET, len(payload)) / ogg.RATE for k in range(len(sound.packets))]
    codes = list(payload)
    mean, rms = sum(codes) / len(codes), (sum((c - 128) ** 2 for c in codes) / len(codes)) ** 0.5
    crossings = sum((a < 128) != (b < 128) for a, b in zip(codes, codes[1:], strict=False))
    assert ogg.features(streams, payload) == f"streams=2;pages={len(pages)};packets={len(sound.packets)};seconds={len(payload) / ogg.RATE:.4f};mean={mean:.3f};rms={rms:.3f};peak=255;crossings={crossings}"


def test_damaged_media_and_strange_tokens_spoil_only_their_row(spark):
    good = ogg.write_ogg(ogg.padded(b"text" * 9000))
    data = ogg.write_ogg(ogg.padded(b"a"))
    rows = [(1, good), (2, good[:-1]), (3, good[:100] + b"x" + good[101:]), (4, None), (5, b""), (6, b"OggS"), (7, good[: len(good) // 2]), (None, data)]
    got = {r["doc_id"]: r for r in ogg.read_media(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert bytes(got[1]["payload"]) == ogg.padded(b"text" * 9000) and got[1]["error"] is None and got[1]["seconds"] > 4
    assert bytes(got[None]["payload"]) == ogg.padded(b"a")
    assert all(got[k]["payload"] is None and got[k]["error"] for k in range(2, 8))
    ids = spark.createDataFrame([(1, [0, 1]), (2, [0, 99_999_999]), (3, None), (4, [None]), (5, [-1])], "doc_id long, ids array<int>")
    back = {r["doc_id"]: r for r in byte_bpe.decode(ids, BYTE_BPE, P.PATTERN).collect()}
    assert back[1]["error"] is None and len(back[1]["content"]) >= 2 and bytes(back[3]["content"]) == b""
    assert all(back[k]["content"] is None and back[k]["error"] for k in (2, 4, 5))


def brute_licences(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(license_index.UPPER, license_index.LOWER)))
    at, labels = [], set()
    for phrase, label in license_texts.PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licences(docs, sample):
    for df in (docs, sample):
        want = Counter((i, *brute_licences(t)) for i, t in texts_of(df))
        rows = license_index.scanned(df).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows) == want
        assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)


def test_templates_without_their_phrase_are_found_by_position(spark):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
    scattered = " x ".join(sorted(text.split()))
    got = {r["doc_id"]: r for r in license_index.scanned(spark.createDataFrame([(1, text), (2, scattered), (3, "plain")], "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and got[1]["score"] > 0.6
    assert got[2]["labels"] == "" and got[3]["labels"] == ""


def test_every_licence_of_a_file_is_found(spark):
    parts = [text for label, text, _ in license_texts.TEMPLATES if label in ("mit", "bsd", "apache")]
    rows = [(1, "\n\n".join(parts)), (2, " and ".join(t for _, t, _ in license_texts.TEMPLATES)), (3, "plain"), *((10 + k, t) for k, (_, t, _) in enumerate(license_texts.TEMPLATES))]
    got = {r["doc_id"]: r["labels"] for r in license_index.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "apache,bsd,mit" and got[3] == ""
    assert got[2] == ",".join(sorted({label for label, _, _ in license_texts.TEMPLATES}))
    for k, (label, text, phrases) in enumerate(license_texts.TEMPLATES):
        whole = all(p in " ".join(license_index.words_in(text)) for p in phrases)
        assert (label in got[10 + k].split(",")) == whole, label


def test_common_words_are_told_by_their_document_frequency(spark):
    rows = [(i, "the licensed under version of a software" if i % 2 else "x") for i in range(400)] + [(1000, "Licensed under the Apache License, Version 2.0."), (1000, "Licensed under the Apache License, Version 2.0.")]
    total, held = license_index.counted(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert total == 402 and held["the"] == 202 and held["apache"] == 2 and "mozilla" not in held
    index = license_index.indexed(total, held, 12, 0.2)
    words = {w for k, found in index.items() for w in found}
    assert "apache" in words and not {"the", "under", "licensed"} & words and all(len(x) <= 12 for x in index.values())


@pytest.mark.parametrize("name", sorted(queries()))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string"), ("benchmark", "item_id long, text string"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries()[name](spark, str(tmp_path)).count() == 0
