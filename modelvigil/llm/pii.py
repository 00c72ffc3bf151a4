"""Personal data: fixed patterns, and boosted trees that judge what wide generators propose beside them."""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import map_columns, smallest_hashes, table

#: Order of the kinds: base patterns, then what the trees add.
BASE, ADDED = ("email", "ip", "card", "phone"), ("address", "quad", "number")
KINDS = BASE + ADDED

# The base patterns and their bounds. Runs of digits are taken whole, whether an address follows or not,
# which changes no match but keeps the time linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IP_MOST, CARD_DIGITS, PHONE_DIGITS = 255, (14, 19), (10, 15)

#: Documents whose candidates the trees are fitted on, candidates of each, and candidates in all, at most.
DOCUMENTS, OF_EACH, CANDIDATES = 20_000, 20, 40_000
#: Trees, levels, step, bins of a feature, and ridge of a leaf.
TREES, DEPTH, RATE, BINS, RIDGE = 60, 3, 0.2, 32, 1.0
#: Of three documents' candidates, those of one calibrate. What is redacted is right with this calibrated probability.
CALIBRATION, PROBABILITY = 3, 0.95
#: Calibration candidates that must support a threshold, and digits of a number that may be personal.
SUPPORT, NUMBER_DIGITS = 20, (7, 24)
#: Parts between spaces that a number has at most.
PARTS = 6
#: Characters of context on each side.
CONTEXT = 32

_SPELLED_AT = re.compile(r"\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20(?=[A-Za-z0-9-]+\x20dot\x20)|\x20@\x20?|@\x20", re.I)
#: A text without one of these has no spelled sign; most texts have none.
_SIGNS = (" @", "@ ", "at)", "at]", "at}", "at )", "at ]", "at }", " dot ")
_SPELLED_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\x20\.\x20?)[A-Za-z0-9-]{1,63})+", re.I
)
_QUAD = re.compile(r"[0-9]{1,3}(?:(?:\x20?\.\x20?|[\[(]\.[\])])[0-9]{1,3}){3}(?![0-9])")
_NUMBER = re.compile(r"[0-9](?:[\x20().,/-]{0,2}[0-9])++")
_PIECE = re.compile(r"[^\x20]+")
_GROUP = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address has one sign, and what stands before it reaches back to the sign or address before."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        last = found.end() if found else at + 1
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end (exclusive) and kind, leftmost and not overlapping within a kind, in order of start, then kind."""
    found = [(start, end, "email") for start, end in _emails(text)]
    for m in _IP.finditer(text):
        if m[1] and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= IP_MOST for part in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum("0" <= c <= "9" for c in m[0]) <= PHONE_DIGITS[1]:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Spans that may be personal, proposed widely: they overlap, and most are not.

    Addresses with any or a spelled sign; four short numbers; digits with marks between, as the longest run and as
    every sequence of a few parts between spaces, if it has a number of digits that phones, cards and accounts have.
    """
    found = []
    if "@" in text:
        found += [(a, b, "address") for a, b in _emails(text)]
    lower = text.lower()
    for m in _SPELLED_AT.finditer(text) if any(sign in lower for sign in _SIGNS) else ():
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        if m[0].lower() == " at " and text[start : m.start()].isalpha():
            continue  # plain words on both sides: "look at the dot"
        domain = _SPELLED_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            found.append((start, domain.end(), "address"))
    for m in _QUAD.finditer(text):
        if not text[max(0, m.start() - 1) : m.start()].isdigit():
            found.append((m.start(), m.end(), "quad"))
    least, most = NUMBER_DIGITS
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < least:
            continue
        first = m.start() - (text[max(0, m.start() - 1) : m.start()] in ("+", "("))
        parts = [
            (first + p.start(), first + p.end(), sum(map(str.isdigit, p[0]))) for p in _PIECE.finditer(text[first : m.end()])
        ]
        for i, (start, _, _) in enumerate(parts):
            digits = 0
            for _, end, own in parts[i : i + PARTS]:
                digits += own
                if digits > most:
                    break
                if digits >= least:
                    found.append((start, end, "number"))
    return found


FEATURES = (
    "address quad number length digits letters groups longest shortest first last spaces dashes dots commas slashes "
    "opened closed plus zeros zero luhn bytes signs spelled domain_end domain_letters distinct "
    "before_space before_letter before_digit before_plus before_mark after_space after_letter after_digit after_dot after_mark "
    "word_before colon_before capital_before word_after digits_near alike_near"
).split()


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format of a candidate, and what stands around it; in the order of ``FEATURES``."""
    own, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = _GROUP.findall(own)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    letters = sum(map(str.isalpha, own))
    lower = own.lower()
    tail = re.split(r"[^a-z0-9-]+", lower)[-1]
    previous, following = before[-1:], after[:1]
    words_before, words_after = before.split(), after.split()
    last_word = words_before[-1] if words_before else ""
    near = before + after
    return [
        *(float(kind == k) for k in ADDED), len(own), len(digits), letters, len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        *(float(own.count(c)) for c in " -.,/()"), float(own[:1] == "+"), float(digits[:2] == "00"), float(digits[:1] == "0"),
        float(12 <= len(digits) <= 19 and luhn(digits)), float(all(len(g) <= 3 and int(g) <= IP_MOST for g in groups)),
        float(own.count("@")), float("at" in re.split(r"[^a-z]+", lower) or "dot" in re.split(r"[^a-z]+", lower)),
        len(tail), float(tail.isalpha()), len(set(digits)) / max(len(digits), 1),
        float(not previous or previous.isspace()), float(previous.isalpha()), float(previous.isdigit()), float(previous == "+"),
        float(bool(previous) and not previous.isalnum() and not previous.isspace()),
        float(not following or following.isspace()), float(following.isalpha()), float(following.isdigit()), float(following == "."),
        float(bool(following) and not following.isalnum() and not following.isspace()),
        float(len(last_word)), float(last_word[-1:] in ":=#"), float(last_word[:1].isupper()),
        float(len(words_after[0]) if words_after else 0), sum(map(str.isdigit, near)) / max(len(near), 1),
        float(sum(len(g) == len(digits) for g in _GROUP.findall(near))),
    ]


def rewritten(own: str, kind: str, draw: int) -> str:
    """The same datum written another way, as the patterns do not read it."""
    if kind == "email":
        sign = (" @ ", "(at)", " [at] ", " at ")[draw % 4]
        dot = " dot " if sign == " at " else (".", "(dot)", ".", "[dot]")[draw // 4 % 4]
        local, _, domain = own.partition("@")
        return local + sign + domain.replace(".", dot)
    if kind == "ip":
        return own.replace(".", (" . ", "[.]", "(.)", ". ")[draw % 4])
    digits = "".join(_GROUP.findall(own))
    if kind == "phone":
        plain = own.lstrip("+")
        return (plain, "00" + plain, plain.replace("(", "").replace(")", ""), re.sub(r"[() -]+", ".", plain).strip("."))[draw % 4]
    step, mark = (4, 4, 4, 6)[draw % 4], "./.,"[draw // 4 % 4]
    return mark.join(digits[i : i + step] for i in range(0, len(digits), step))


def examples(text: str) -> list[tuple[int, list[float]]]:
    """Candidates of a text for training: label and features.

    The base patterns label: a candidate that is a base span is personal, one that is none, or only a part of one,
    is not. Each is also shown written another way in its place, so that the trees learn format and context beyond
    the patterns.
    """
    base = base_spans(text)
    exact = {(a, b): kind for a, b, kind in base}
    out = []
    for start, end, kind in candidates(text):
        own = exact.get((start, end))
        draw = zlib.crc32(text[start:end].encode("utf-8", "surrogatepass"))
        out.append((draw, int(own is not None), features(text, start, end, kind)))
        if own is None and kind != "number":
            continue
        left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        variant = rewritten(text[start:end], own or "card", draw >> 8)
        shown = left + variant + right
        hit = (len(left), len(left) + len(variant))
        for a, b, name in candidates(shown):
            if a < hit[1] and b > hit[0]:
                out.append((draw + 1, int(own is not None and (a, b) == hit), features(shown, a, b, name)))
    out.sort(key=lambda e: e[0])
    return [(label, row) for _, label, row in out]


def bins_of(column: np.ndarray, most: int = BINS) -> np.ndarray:
    """Cut points of a feature: between its distinct values, or its quantiles if there are more."""
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1), method="lower"))
    return (values[:-1] + values[1:]) / 2


@dataclass
class Trees:
    """Complete binary trees: a feature and a cut for each inner node, a value for each leaf."""

    start: float
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total, every = np.full(len(rows), self.start), np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(rows), dtype=np.int64)
            while len(rows) and node[0] < len(feature):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees under the logistic loss, each level grown from histograms of gradients and curvatures."""
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(share / (1 - share))))
    cuts = [bins_of(column) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T)], axis=1)
    width, count = rows.shape[1], max(len(c) for c in cuts) + 1
    cell = np.arange(width) * count + binned
    score = np.full(len(rows), model.start)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = p - labels, p * (1 - p)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            nodes = 2**level
            at = ((node - (nodes - 1))[:, None] * (width * count) + cell).ravel()
            shape = (nodes, width, count)
            g, h = (
                np.bincount(at, np.repeat(w, width), nodes * width * count).reshape(shape).cumsum(axis=2) for w in (slope, bend)
            )
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - whole_g**2 / (whole_h + RIDGE)
            gain[:, :, -1] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for i, place in enumerate(best):
                f, b = divmod(int(place), count)
                if gain[i, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[nodes - 1 + i], cut[nodes - 1 + i] = f, cuts[f][b]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > cut[node])
        leaf = -rate * np.bincount(node - inner, slope, inner + 1) / (np.bincount(node - inner, bend, inner + 1) + RIDGE)
        score += leaf[node - inner]
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(leaf)
    return model


def isotonic(labels: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``labels``: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for label in labels:
        blocks.append([float(label), 1.0])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += n
    return np.concatenate([np.full(int(n), total / n) for total, n in blocks]) if blocks else np.zeros(0)


def threshold(scores: np.ndarray, labels: np.ndarray, probability: float = PROBABILITY, support: int = SUPPORT) -> float:
    """The least score whose calibrated probability is high enough; infinite if too few candidates have it."""
    order = np.lexsort((labels, scores))
    enough = np.flatnonzero(isotonic(labels[order]) >= probability)
    return float(scores[order][enough[0]]) if len(enough) >= support else float("inf")


@dataclass
class Model:
    trees: Trees
    thresholds: dict[str, float]

    def added(self, texts: list[str], bases: list[list[tuple[int, int, str]]]) -> list[list[tuple[int, int, str]]]:
        """Spans the trees add to each text: apart from base spans and from each other, likelier ones first."""
        owners, spans, rows = [], [], []
        for number, (text, base) in enumerate(zip(texts, bases)):
            begins, reach = [span[0] for span in base], list(accumulate((span[1] for span in base), max, initial=0))
            for start, end, kind in candidates(text):
                # Of the base spans that begin before the candidate ends, the furthest one ends before it begins.
                if self.thresholds[kind] < float("inf") and reach[bisect_left(begins, end)] <= start:
                    owners.append(number)
                    spans.append((start, end, kind))
                    rows.append(features(text, start, end, kind))
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if rows:
            scores = self.trees.score(np.array(rows)).tolist()
            taken: dict[int, set[int]] = {}
            for i in sorted(range(len(rows)), key=lambda i: (-scores[i], spans[i][0] - spans[i][1], spans[i][0])):
                start, end, kind = spans[i]
                places = taken.setdefault(owners[i], set())
                if scores[i] >= self.thresholds[kind] and places.isdisjoint(range(start, end)):
                    places.update(range(start, end))
                    out[owners[i]].append(spans[i])
        return out


def trained(rows: np.ndarray, labels: np.ndarray, apart: np.ndarray) -> Model:
    """Trees from the rows not set apart, thresholds from those that are; without both labels nothing is added."""
    silent = dict.fromkeys(ADDED, float("inf"))
    if len(set(labels[~apart].tolist())) < 2 or not apart.any():
        return Model(Trees(0.0), silent)
    trees = fit(rows[~apart], labels[~apart])
    scores = trees.score(rows[apart])
    for place, kind in enumerate(ADDED):
        own = rows[apart][:, place] > 0
        silent[kind] = threshold(scores[own], labels[apart][own])
    return Model(trees, silent)


def learn(docs: DataFrame, documents: int = DOCUMENTS, of_each: int = OF_EACH, most: int = CANDIDATES) -> Model:
    """Model from the candidates of the documents with the smallest hashes of their ids, each with the smallest of its
    texts; of a document those with the smallest hashes, of all candidates the first ``most`` by document hash. Rows
    without an id or a text teach nothing."""
    known = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = F.broadcast(smallest_hashes(known.select("doc_id"), documents))  # bounded by ``documents``
    out = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("row", pa.binary())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [(d, *e) for d, text in zip(batch["doc_id"], batch["text"]) for e in examples(text)[:of_each]]
            yield {
                "doc_id": [f[0] for f in found], "label": [f[1] for f in found],
                "row": [np.array(f[2], dtype="<f4").tobytes() for f in found],
            }

    once = known.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = map_columns(once, ["doc_id", "text"], "doc_id long, label int, row binary", work, out)
    hashed = F.xxhash64("doc_id")
    sample = sample.orderBy(hashed, "doc_id", "row", "label").limit(most).collect()
    rows = np.array([np.frombuffer(r.row, dtype="<f4") for r in sample], dtype=np.float64).reshape(-1, len(FEATURES))
    labels = np.array([r.label for r in sample], dtype=np.float64)
    apart = np.array([zlib.crc32(str(r.doc_id).encode()) % CALIBRATION == 0 for r in sample], dtype=bool)
    return trained(rows, labels, apart)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def personal_spans(docs: DataFrame, model: Model) -> DataFrame:
    """Spans of personal data in every row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans),
    ``n_added``, ``base_sha256`` (of the joined base spans) and ``spans`` (all as kind:start:end in code points).

    Null text counts as empty and has no span. The trees only add spans, apart from the base spans, which stay
    whatever they are. Repeated rows and null ids are returned as they come; no rows give none. Texts of any length
    are read in time linear in it. Other columns are not read.
    """
    counted = [f"n_{kind}" for kind in BASE]
    out = pa.schema([
        ("doc_id", pa.int64()), *((name, pa.int64()) for name in counted), ("n_added", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()),
    ])
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in counted) + ", n_added long, base_sha256 string, spans string"

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            bases = list(map(base_spans, texts))
            rows: dict[str, list] = {name: [] for name in out.names}
            rows["doc_id"] = batch["doc_id"]
            for base, added in zip(bases, model.added(texts, bases)):
                kinds = [span[2] for span in base]
                for kind in BASE:
                    rows[f"n_{kind}"].append(kinds.count(kind))
                rows["n_added"].append(len(added))
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))))
            yield rows

    return map_columns(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")], schema, work, out)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, overlapping ones together, replaced by the kind of its first."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op12_pii(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return personal_spans(docs, learn(docs))
