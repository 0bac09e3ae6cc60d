"""Personal data: fixed patterns for four kinds, and a linear-chain conditional random field that adds spans.

The patterns are matched over the whole text. The field labels the tokens around those that hold a digit
or an at sign; its features are word shapes. It is trained from a small labelled table (`labelled_table`)
and decoded by Viterbi's algorithm in numpy, for all stretches of like length of a batch at once. A run of
tokens with one label becomes a span if it has that kind's digits and does not touch a pattern's span.

Defined cases: a null or empty text has no spans; the length of a text is not limited, and each pattern
takes time in proportion to it; repeated rows each give a row; an empty table gives an empty result; other
columns are ignored. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# A run that a match starts in starts where the run does: the look-behinds only spare repeated attempts.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> list[Span]:
    """Each at sign with what may stand before it, back to the last match, and a domain after it."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append(("email", start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return spans


def fits(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by start and then by kind in the order of KINDS."""
    if not text:
        return []
    spans = emails(text)
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if fits(kind, m.group())]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the field -------------------------------------------------------------------------------------------

LABELS = ("other", *KINDS)
FEATURES, CONTEXT = 1 << 13, 4
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: What may be part of such data: digits, at signs, and both signs of an address spelled out.
TRIGGER = re.compile(r"[0-9@]+|(?i:(?<![a-z])dot(?![a-z])|[\[({<]at[\])}>])")
TRIM = ".,;:!?\"'<>[]{}|"


def shape(token: str) -> str:
    """Runs of like characters by their class, digits with their number."""
    out = []
    for s, run in groupby(token, lambda c: "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c):
        out.append(f"d{sum(1 for _ in run)}" if s == "d" else s)
    return "".join(out)


def described(token: str) -> tuple[str, ...]:
    digits = sum(map(str.isdigit, token))
    word = token.lower() if token.isalpha() else "-"
    return f"s{shape(token)}", f"n{min(digits, 20)}", f"w{word}", f"l{min(len(token), 20)}", f"@{'@' in token}", f".{min(token.count('.'), 4)}", f"-{min(token.count('-'), 4)}", f"({token[:1] == '('}"


#: What is remembered changes no result: longer tokens are described anew each time.
own_features = Memo(described, 20_000).__getitem__
hashed = Memo(lambda feature: xxhash.xxh3_64_intdigest(feature) % FEATURES, 50_000).__getitem__


def sequence_features(tokens: list[str]) -> np.ndarray:
    """(tokens, features): indexes of each token's own features and of its neighbours' shapes and digits."""
    own = [own_features(t) for t in tokens]
    none = ("s", "n", "w")
    rows = []
    for k, mine in enumerate(own):
        before, after = own[k - 1] if k else none, own[k + 1] if k + 1 < len(own) else none
        around = (f"p{before[0]}", f"q{before[1]}", f"r{before[2]}", f"a{after[0]}", f"b{after[1]}", f"e{after[2]}", f"c{mine[1]}{before[1]}", f"d{mine[1]}{after[1]}", f"f{mine[2]}{after[2]}", f"g{mine[2]}{before[2]}")
        rows.append([hashed(f) for f in (*mine, *around)])
    return np.array(rows)


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Positions of the tokens within CONTEXT tokens of one with a digit or an at sign, in runs without a gap."""
    runs: list[list[tuple[int, int]]] = []
    done = -1
    for m in TRIGGER.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        before, at = [], start
        for _ in range(CONTEXT):
            end = at
            while end and text[end - 1] in " \t\n\x0b\x0c\r":
                end -= 1
            at = end
            while at and text[at - 1] not in " \t\n\x0b\x0c\r":
                at -= 1
            if at < end:
                before.append((at, end))
        ahead = TOKEN.finditer(text, start)
        found = [t.span() for t, _ in zip(ahead, range(CONTEXT + 1), strict=False)]
        done = found[0][1]
        new = [*reversed(before), *found]
        if runs and runs[-1][-1][0] >= new[0][0]:
            runs[-1] += [t for t in new if t[0] > runs[-1][-1][0]]
        else:
            runs.append(new)
    return runs


def trimmed(text: str, span: tuple[int, int]) -> tuple[int, int]:
    start, end = span
    while start < end and text[start] in TRIM:
        start += 1
    while end > start and text[end - 1] in TRIM:
        end -= 1
    return (start, end) if start < end else span


class Field:
    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The likeliest labels of each sequence of feature rows."""
        out: list = [None] * len(sequences)
        lengths = np.array([len(s) for s in sequences])
        for size in np.unique(lengths):
            where = np.flatnonzero(lengths == size)
            for part in np.array_split(where, min(len(where), max(1, len(where) * size // 50_000))):
                # in slices, so that one very long sequence doesn't gather all its weights at once
                emit = np.stack([np.concatenate([self.weights[sequences[k][i : i + 50_000]].sum(axis=1) for i in range(0, size, 50_000)]) for k in part])
                best, came = emit[:, 0], np.zeros((len(part), size, len(LABELS)), np.int8)
                for t in range(1, size):
                    via = best[:, :, None] + self.moves
                    came[:, t] = via.argmax(axis=1)
                    best = via.max(axis=1) + emit[:, t]
                label = best.argmax(axis=1)
                path = np.empty((len(part), size), np.int8)
                for t in range(size - 1, -1, -1):
                    path[:, t] = label
                    label = came[np.arange(len(part)), t, label]
                for row, k in zip(path, part, strict=True):
                    out[k] = row
        return out


def labelled_table(rows: int = 1600, seed: int = 7, unseen: bool = False) -> list[tuple[str, list[Span]]]:
    """A small labelled table: texts with the four kinds in several notations, and texts whose numbers are no such data.

    Training takes it as it is. Another `seed` gives rows to measure the field with, `unseen` those in notations that training has not.
    """
    rng = np.random.default_rng(seed)
    words = "the of and report for value total call me at office please see table item order near line with our new est les der die que para con und sur write mail server host page dot point in on to from is was has number".split()
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    name = lambda: "".join(rng.choice(list("abcdefghiklmnoprstu"), rng.integers(3, 12)))

    def filler(least: int, most: int) -> str:
        """Common and invented words, some in capitals, with accents or signs."""
        out = []
        for word in rng.choice(words, rng.integers(least, most)):
            kind = rng.integers(6)
            made = "".join(rng.choice(list("abdeghilnorstuéèñöç"), rng.integers(2, 14))) if kind < 3 else str(word)
            made = made.upper() if rng.integers(8) == 0 else made.capitalize() if rng.integers(8) == 0 else made
            out.append(made + (str(rng.choice(["!!", ".", ",", "...", "###", ":"])) if rng.integers(8) == 0 else ""))
        return " ".join(out)

    end = lambda: str(rng.choice(["com", "org", "net", "info", "de", "fr", "es", "example.com"]))
    octets = lambda: [str(x) for x in rng.integers(0, 256, 4)]

    def card() -> str:
        body = str(rng.choice(["4", "5", "6"])) + n(14)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))

    def cut(x: str, by: str, *sizes: int) -> str:
        at = np.cumsum([0, *sizes])
        return by.join(x[i:j] for i, j in zip(at, at[1:], strict=False))

    known = {
        "email": [lambda: f"{name()}.{n(2)}@{name()}.example.com", lambda: f"{name()}@{name()}.{end()}", lambda: f"{name()} @ {name()}.{end()}", lambda: f"{name()} at {name()} dot {end()}", lambda: f"{name()} [at] {name()} [dot] {end()}", lambda: f"{name()}(at){name()}.{end()}", lambda: f"{name()} AT {name()} DOT {end()}"],
        "ip": [lambda: ".".join(octets()), lambda: "[.]".join(octets()), lambda: " . ".join(octets()), lambda: " dot ".join(octets())],
        "card": [card, lambda: cut(card(), " ", 4, 4, 4, 4), lambda: cut(card(), "-", 4, 4, 4, 4), lambda: cut(card(), ".", 4, 4, 4, 4), lambda: cut(card(), "/", 4, 4, 4, 4), lambda: cut(card(), " - ", 4, 4, 4, 4)],
        "phone": [lambda: f"+{n(2)} {n(3)} {n(7)}", lambda: f"+1-{n(3)}-555-{n(4)}", lambda: f"({n(3)}) 555-{n(4)}", lambda: f"{n(3)}-555-{n(4)}", lambda: f"{n(3)}.555.{n(4)}", lambda: f"00{n(2)} {n(3)} {n(4)} {n(3)}", lambda: f"0{n(2)} {n(4)} {n(4)}", lambda: f"1-800-{n(3)}-{n(4)}", lambda: " ".join(n(10)), lambda: f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}"],
        "": [lambda: f"20{n(2)}-0{n(1)}-1{n(1)}", lambda: n(int(rng.integers(1, 8))), lambda: f"{n(2)}:{n(2)}:{n(2)}", lambda: f"{n(3)}.{n(2)}", lambda: f"{n(1)}.{n(2)}.{n(1)}", lambda: f"{n(3)},{n(3)},{n(3)}", lambda: n(16), lambda: f"{n(2)}/{n(2)}/20{n(2)}", lambda: f"{n(4)}-{n(4)}", lambda: f"@{name()}", lambda: f"{name()}{n(3)}", lambda: f"{n(4)} {n(4)} {n(4)}", lambda: f"978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: f"{n(3)}-{n(2)}-{n(4)}", lambda: f"{n(2)} of {n(3)}", lambda: f"19{n(2)}-20{n(2)}", lambda: ", ".join(n(5)), lambda: f"{n(5)} {n(5)}", lambda: f"{n(2)} {name()} {n(3)}", lambda: f"the {name()} at the dot", lambda: f"dot {name()} at {name()}", lambda: f"{n(2)} dot {n(2)}", lambda: f"v{n(1)}.{n(1)}.{n(2)}.{n(4)}", lambda: f"{name()} @ {n(2)}", lambda: "token = \"" + "".join(rng.choice(list("0123456789abcdef"), 40)) + "\"", lambda: f"{n(2)} {name()}. {end()}"],
    }
    other = {
        "email": [lambda: f"{name()} {{at}} {name()} {{dot}} {end()}", lambda: f"{name()} (at) {name()} (dot) {end()}", lambda: f"{name()}.{name()} at {name()} dot {end()}"],
        "ip": [lambda: "(.)".join(octets())],
        "card": [lambda: cut(card(), "_", 4, 4, 4, 4), lambda: cut(card(), " ", 4, 6, 6), lambda: cut(card(), " / ", 4, 4, 4, 4)],
        "phone": [lambda: f"{n(3)}/555-{n(4)}", lambda: f"001 {n(3)} 555 {n(4)}", lambda: f"({n(3)}) 555 {n(4)}", lambda: f"0{n(3)}-{n(3)}-{n(4)}"],
        "": [lambda: f"{n(2)}.{n(2)}.20{n(2)}", lambda: f"{n(2)}h{n(2)}", lambda: f"{n(1)},{n(3)}.{n(2)}", lambda: f"#{n(6)}", lambda: f"{n(3)}/{n(3)}"],
    }
    makers, out = other if unseen else known, []
    while len(out) < rows:
        for kind, ways in makers.items():
            text, spans = filler(2, 8) + " ", []
            for _ in range(rng.integers(1, 3)):
                item = ways[rng.integers(len(ways))]()
                if kind:
                    spans.append((kind, len(text), len(text) + len(item)))
                text += item + rng.choice([" ", ", ", ". "]) + filler(3, 9) + " "
            out.append((text, spans))
    return out[:rows]


def token_labels(tokens: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    labels = np.zeros(len(tokens), np.int64)
    for kind, start, end in spans:
        for k, (a, b) in enumerate(tokens):
            if a < end and start < b:
                labels[k] = LABELS.index(kind)
    return labels


@lru_cache(maxsize=1)
def trained(rounds: int = 60) -> Field:
    """The field of greatest penalised likelihood for the labelled table, by adaptive gradient steps."""
    xs, ys = [], []
    for text, spans in labelled_table():
        for run in stretches(text):
            cut = [trimmed(text, t) for t in run]
            xs.append(sequence_features([text[a:b] for a, b in cut]))
            ys.append(token_labels(cut, spans))
    k, longest, n = len(LABELS), max(map(len, xs)), len(xs)
    lengths = np.array([len(a) for a in xs])
    valid = np.arange(longest)[None, :] < lengths[:, None]
    x, y = np.concatenate(xs), np.zeros((n, longest), np.int64)
    y[valid] = np.concatenate(ys)
    truth = np.eye(k)[y] * valid[:, :, None]
    pairs = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    theta = [np.zeros((FEATURES, k)), np.zeros((k, k))]
    mean, square = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    emit = np.zeros((n, longest, k))
    for step in range(1, rounds + 1):
        emit[valid] = theta[0][x].sum(axis=1)
        # forward and backward tables scaled at every step, so that no logarithms are needed
        way, own = np.exp(theta[1]), np.exp(emit - emit.max(axis=2, keepdims=True))
        ahead, back, scale = np.empty_like(emit), np.ones_like(emit), np.empty((n, longest, 1))
        for t in range(longest):
            ahead[:, t] = own[:, t] * (ahead[:, t - 1] @ way if t else 1)
            scale[:, t] = ahead[:, t].sum(axis=1, keepdims=True)
            ahead[:, t] /= scale[:, t]
        for t in range(longest - 2, -1, -1):
            back[:, t] = np.where((t + 1 < lengths)[:, None], (own[:, t + 1] * back[:, t + 1] / scale[:, t + 1]) @ way.T, 1)
        share = ahead * back * valid[:, :, None]
        both = np.einsum("nti,ij,ntj->ij", ahead[:, :-1] * valid[:, 1:, None], way, (own * back / scale)[:, 1:])
        gap = np.repeat((truth - share)[valid], x.shape[1], axis=0)
        slope = np.column_stack([np.bincount(x.ravel(), gap[:, c], FEATURES) for c in range(k)])
        for p, (g, old) in enumerate(zip((slope, pairs - both), theta, strict=True)):
            g = g / n - 1e-4 * old
            mean[p], square[p] = 0.9 * mean[p] + 0.1 * g, 0.99 * square[p] + 0.01 * g * g
            theta[p] = old + 0.2 * (mean[p] / (1 - 0.9**step)) / (np.sqrt(square[p] / (1 - 0.99**step)) + 1e-8)
    return Field(theta[0].astype(np.float32), theta[1].astype(np.float32))


def plausible(kind: str, text: str) -> bool:
    """Whether a labelled run has what its kind must have in any notation: the digits, or an at and a dot."""
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(fits("ip", p) for p in parts)
    if kind == "email":
        return bool(re.search(r"@|(?<![a-z])at(?![a-z])", text, re.IGNORECASE)) and bool(re.search(r"\.|(?<![a-z])dot(?![a-z])", text, re.IGNORECASE))
    return fits(kind, text)


def added_spans(texts: list[str | None], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """For each text the spans that the field finds clear of `base`."""
    owner, tokens, rows = [], [], []
    for k, text in enumerate(texts):
        for run in stretches(text) if text else ():
            cut = [trimmed(text, t) for t in run]
            owner.append(k)
            tokens.append(cut)
            rows.append(sequence_features([text[a:b] for a, b in cut]))
    out: list[list[Span]] = [[] for _ in texts]
    for k, cut, labels in zip(owner, tokens, field.decode(rows), strict=True):
        text, start = texts[k], 0
        for end in range(1, len(cut) + 1):
            if end == len(cut) or labels[end] != labels[start]:
                if labels[start]:
                    kind, a, b = LABELS[labels[start]], cut[start][0], cut[end - 1][1]
                    clear = all(b <= x or y <= a for _, x, y in base[k]) and (not out[k] or out[k][-1][2] <= a)
                    if clear and plausible(kind, text[a:b]):
                        out[k].append((kind, a, b))
                start = end
    return out


def all_spans(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """For each text the patterns' spans, and those with the field's."""
    base = [base_spans(t) for t in texts]
    more = added_spans(texts, base, field)
    return [(b, sorted(b + m, key=lambda s: (s[1], KINDS.index(s[0])))) for b, m in zip(base, more, strict=True)]


def measured(field: Field, rows: list[tuple[str, list[Span]]]) -> dict[str, tuple[float, float]]:
    """Precision and recall of all spans together by kind, on labelled rows: a span counts if kind, start and end are right."""
    told = [set(spans) for _, spans in all_spans([t for t, _ in rows], field)]
    out = {}
    for kind in KINDS:
        right = sum(len({s for s in mine if s[0] == kind} & set(spans)) for mine, (_, spans) in zip(told, rows, strict=True))
        said = sum(s[0] == kind for mine in told for s in mine)
        true = sum(s[0] == kind for _, spans in rows for s in spans)
        out[kind] = (right / said if said else 1.0, right / true if true else 1.0)
    return out


def found(docs: DataFrame) -> DataFrame:
    """doc_id, the patterns' counts, base_sha256 and spans of every text."""
    field = trained()

    def batch(columns: dict[str, list]) -> dict[str, object]:
        both = all_spans(columns["text"], field)
        counts = {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b, _ in both], pa.int64()) for k in KINDS}
        return {"doc_id": pa.array(columns["doc_id"], pa.int64())} | counts | {"base_sha256": [hashlib.sha256(span_text(b).encode()).hexdigest() for b, _ in both], "spans": [span_text(s) for _, s in both]}

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, schema)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts, with the ends of all."""
    if not spans:
        return text
    out, done = [], 0
    merged: list[list] = []
    for kind, a, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[done:a], f"<{kind}>"]
        done = b
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with every span in `text` replaced; n_chars, where there is one, follows."""
    field = trained()

    @F.pandas_udf("string")
    def clean(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        given = [t if isinstance(t, str) else None for t in texts]
        return pd.Series([redact(t, s) for t, (_, s) in zip(given, all_spans(given, field), strict=True)], dtype=object)

    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
