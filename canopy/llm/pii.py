"""Personal data: base patterns and a skip-chain conditional random field.

Base spans (email, ip, card, phone) come from fixed patterns with their checks.
A document's tokens that hold a digit or an at-sign, or repeat the mail name of a
base span, form the field: neighbours share transition potentials, and tokens
anywhere in the document that repeat each other (equal tokens, same digits, same
mail name) share a skip potential.  Loopy message passing then carries a label
from a base span to a distant mention that the pattern alone misses.  Tokens of
base spans are clamped to their kind, so base spans stay; any other token is
always outside.

Weights are learned without hand labels: on a bounded sample of documents the
base spans label the tokens, a multinomial logistic regression gives the
potentials of single tokens, and label counts give those of neighbours and of
repeats.  Tokens outside base spans that repeat one of theirs or write the
at-sign out have no known label and are not learned from.

Defined cases: null and empty texts have no spans; texts of any length are
searched whole, in time that grows with their length; a token that repeats
often is linked to its next repetition only; repeated rows give a row each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, read_table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
SAMPLE_DOCS = 20_000
SAMPLE_TOKENS = 200_000
MIN_POSTERIOR = 0.9
ROUNDS = 12
DAMPING = 0.3
CLAMP = 12.0
UNKNOWN = -1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_DIGIT = re.compile(r"[0-9]")
_NAME = re.compile(r"(?<![a-z0-9._%+-])([a-z0-9._%+-]++)(?:@|\(at\)|\[at\])")
_AT = re.compile(r"\(at\)|\[at\]", re.I)
_LEAD = re.compile(r"[^\w+(@]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            end = at + 1
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(q) <= 3 and int(q or 0) <= 255
                                                                 for q in (p.lstrip("0") for p in m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# ---------------------------------------------------------------- tokens and features

def mail_name(token: str) -> str:
    """What stands before the at-sign, however it is written; of other tokens all."""
    found = _NAME.search(token.lower())
    return (found[1] if found else token.lower()).strip("<>()[]\"'.,;:")


def tokens_of(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """(place in the token sequence, start, end) of the tokens with a digit or at-sign
    and of those that have the mail name of a base span."""
    names = {mail_name(text[a:b]) for kind, a, b in spans if kind == "email"} - {""}
    found = []
    for k, m in enumerate(_TOKEN.finditer(text)):
        if "@" in m[0] or _DIGIT.search(m[0]) or names and mail_name(m[0]) in names:
            a, b = _LEAD.match(m[0]).end(), len(m[0])
            while b > a and not (m[0][b - 1].isalnum() or m[0][b - 1] in "_)"):
                b -= 1
            if a < b:
                found.append((k, m.start() + a, m.start() + b))
    return found


def features(token: str) -> list[float]:
    """Shape of a token, a written-out at-sign read as one; the last one is the constant."""
    token = _AT.sub("@", token)
    digits = re.sub(r"[^0-9]", "", token)
    parts = token.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    letters = sum(c.isalpha() for c in token)
    n = len(digits)
    return [float("@" in token), float(bool(_DOMAIN.fullmatch(token.rpartition("@")[2])) and "@" in token),
            float(octets), float(n >= 13 and not letters), float(13 <= n <= 19 and not letters and luhn(digits)),
            float(token.startswith("+")), float(token.startswith("(") and token.endswith(")") and n == 3),
            float(bool(re.fullmatch(r"[0-9]{3}-[0-9]{4}", token))), float(letters > 0), float(letters > 3),
            float(n == 0), float(1 <= n <= 2), float(3 <= n <= 6), float(7 <= n <= 12), float(n > 19),
            float("." in token), float("-" in token), float("=" in token or '"' in token), 1.0]


N_FEATURES = len(features("0"))


def repeat_keys(token: str) -> list[str]:
    """What makes two tokens similar: their digits if there are seven or more, their
    digit groups if four, their mail name, or that they are equal."""
    digits = re.sub(r"[^0-9]", "", token)
    keys = []
    letters = sum(c.isalpha() for c in token)
    if len(digits) >= 7 and not letters:
        keys.append("d" + digits[-7:])
    groups = re.findall(r"[0-9]+", token)
    if len(groups) == 4 and not letters:
        keys.append("g" + ".".join(groups))
    keys.append("m" + mail_name(token) if letters else "e" + token)
    return keys


def skip_edges(names: list[str]) -> list[tuple[int, int]]:
    """Pairs of places whose tokens are similar, each with the next such place."""
    last: dict[str, int] = {}
    edges = set()
    for k, token in enumerate(names):
        for key in repeat_keys(token):
            if key in last:
                edges.add((last[key], k))
            last[key] = k
    return sorted(edges)


def token_labels(tokens: list[tuple[int, int, int]], spans: list[tuple[str, int, int]]) -> np.ndarray:
    """Label of each token: the kind of the base span that overlaps it (0: none)."""
    out = np.zeros(len(tokens), dtype="int64")
    ordered = sorted((a, b, LABELS.index(kind)) for kind, a, b in spans)
    at = 0
    for k, (_, a, b) in enumerate(tokens):
        while at < len(ordered) and ordered[at][1] <= a:
            at += 1
        for start, end, label in ordered[at:at + 4]:
            if start < b and a < end:
                out[k] = label
                break
    return out


# ---------------------------------------------------------------- inference

class Field:
    """Potentials of the skip-chain field, as logarithms."""

    def __init__(self, single: np.ndarray, chain: np.ndarray, skip: float):
        self.single, self.chain = single, chain
        self.skip = np.full((len(LABELS), len(LABELS)), 0.0)
        self.skip[np.arange(len(LABELS)), np.arange(len(LABELS))] = skip

    def posteriors(self, names: list[str], places: list[int], clamp: np.ndarray) -> np.ndarray:
        """Label probabilities of tokens after damped loopy message passing.

        A token without field neighbour on a side has an outside one there."""
        n = len(names)
        unary = np.array([features(t) for t in names]) @ self.single
        unary[clamp > 0] = 0.0
        unary[np.flatnonzero(clamp), clamp[clamp > 0]] = CLAMP
        near = [(k, k + 1) for k in range(n - 1) if places[k + 1] == places[k] + 1]
        left, right = {b for _, b in near}, {a for a, _ in near}
        unary += np.where([[k not in left] for k in range(n)], self.chain[0][None, :], 0.0)
        unary += np.where([[k not in right] for k in range(n)], self.chain[:, 0][None, :], 0.0)
        far = skip_edges(names)
        if not near and not far:
            return _softmax(unary)
        pair = np.concatenate([np.repeat(self.chain[None], len(near), 0), np.repeat(self.skip[None], len(far), 0)])
        a, b = (np.array(x, dtype="int64") for x in zip(*near, *far))
        source, target = np.concatenate((a, b)), np.concatenate((b, a))
        both = np.concatenate((pair, pair.transpose(0, 2, 1)))
        reverse = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[reverse]
            new = _logsum(out[:, :, None] + both)
            new -= new.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        belief = unary.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def added_spans(text: str, spans: list[tuple[str, int, int]], field: Field) -> list[tuple[str, int, int]]:
    """Spans that the field adds: tokens outside base spans with a sure label;
    neighbouring parts of a number make one span."""
    if not spans and "@" not in text and not _DIGIT.search(text):
        return []
    tokens = tokens_of(text, spans)
    if not tokens:
        return []
    names = [text[a:b] for _, a, b in tokens]
    clamp = token_labels(tokens, spans)
    if clamp.all():
        return []
    p = field.posteriors(names, [k for k, _, _ in tokens], clamp)
    best = p.argmax(axis=1)
    out: list[tuple[str, int, int]] = []
    last = -2
    for k, (place, a, b) in enumerate(tokens):
        if not clamp[k] and best[k] and p[k, best[k]] >= MIN_POSTERIOR:
            kind = LABELS[best[k]]
            if kind in ("phone", "card") and last == place - 1 and out and out[-1][0] == kind:
                out[-1] = (kind, out[-1][1], b)
            else:
                out.append((kind, a, b))
            last = place
    return out


# ---------------------------------------------------------------- learning

LEARNED = "doc long, place int, label int, x array<double>, repeat array<int>"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token of the field: its label by base spans (or ``UNKNOWN``), features, and whether
    its next similar tokens have the same label (1) or another (0)."""
    number = 0
    for batch in batches:
        out: dict[str, list] = {"doc": [], "place": [], "label": [], "x": [], "repeat": []}
        for text in batch.column(0).to_pylist():
            number += 1
            spans = base_spans(text) if text else []
            tokens = tokens_of(text, spans) if text else []
            if not tokens:
                continue
            names = [text[a:b] for _, a, b in tokens]
            labels = token_labels(tokens, spans)
            keys = [repeat_keys(t) for t in names]
            based = {key for ks, label in zip(keys, labels) if label for key in ks}
            labels[[not label and (not based.isdisjoint(ks) or bool(_AT.search(t)))
                    for t, ks, label in zip(names, keys, labels)]] = UNKNOWN
            same: list[list[int]] = [[] for _ in tokens]
            for i, j in skip_edges(names):
                if labels[i] != UNKNOWN and labels[j] != UNKNOWN:
                    same[i].append(int(labels[i] == labels[j]))
            out["doc"] += [number] * len(tokens)
            out["place"] += [k for k, _, _ in tokens]
            out["label"] += labels.tolist()
            out["x"] += [features(t) for t in names]
            out["repeat"] += same
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["doc"], pa.int64()), pa.array(out["place"], pa.int32()), pa.array(out["label"], pa.int32()),
             pa.array(out["x"], pa.list_(pa.float64())), pa.array(out["repeat"], pa.list_(pa.int32()))], list(out))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Field:
    """Potentials from a sample of about ``sample_docs`` documents and at most
    ``sample_tokens`` of their tokens, labelled by the base spans."""
    rows = docs.count()
    share = min(1.0, sample_docs / max(1, rows))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * share)).select("text")
    found = sample.mapInArrow(_examples, LEARNED).limit(sample_tokens).toPandas()
    return fit(found)


def fit(found: pd.DataFrame) -> Field:
    k = len(LABELS)
    if (found["label"] == UNKNOWN).all():
        return Field(np.zeros((N_FEATURES, k)), np.zeros((k, k)), 3.0)
    label = found["label"].to_numpy()
    sure = label != UNKNOWN
    x = np.array(found["x"].tolist())[sure]
    y = np.eye(k)[label[sure]]
    w = np.zeros((x.shape[1], k))
    for _ in range(400):
        p = _softmax(x @ w)
        w -= 1.0 * (x.T @ (p - y) / len(x) + 1e-4 * w)
    follows = (found["doc"].diff() == 0) & (found["place"].diff() == 1)
    pairs = np.full((k, k), 1.0)
    after = np.flatnonzero(follows.to_numpy() & sure & np.append(False, sure[:-1]))
    np.add.at(pairs, (label[after - 1], label[after]), 1)
    # a token at the end of a run has outside words around it
    first, last = ~follows.to_numpy() & sure, ~np.append(follows.to_numpy()[1:], False) & sure
    np.add.at(pairs, (0, label[first]), 1)
    np.add.at(pairs, (label[last], 0), 1)
    total = pairs.sum()
    chain = np.log(pairs * total / np.outer(pairs.sum(axis=1), pairs.sum(axis=0)))
    agree = [v for r in found["repeat"] for v in r]
    rate = (sum(agree) + 49.0) / (len(agree) + 50.0)
    return Field(w, 0.5 * chain, float(np.clip(np.log(rate / (1 - rate)) + np.log(k - 1), 1.0, 6.0)))


# ---------------------------------------------------------------- report

REPORT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                    ("spans", pa.string())])


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def find_spans(text: str | None, field: Field) -> tuple[list, list]:
    """(base spans, spans that the field adds)."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, added_spans(text, base, field)


def _report(shared):
    def make():
        field = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.name: [] for f in REPORT}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1).to_pylist():
                base, more = find_spans(text, field)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + more))
            return out
        return work
    return arrow_rows(make, REPORT)


def report(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, and all spans."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(learn(slim))
    return slim.mapInArrow(_report(shared), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                           "base_sha256 string, spans string")


def mask(text: str | None, field: Field) -> str | None:
    """The text with every span replaced by its kind in brackets."""
    if not text:
        return text
    base, more = find_spans(text, field)
    out, last = [], 0
    for kind, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind}]"]
            last = b
    return "".join(out) + text[last:]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return report(read_table(spark, sf_dir, "documents"))
