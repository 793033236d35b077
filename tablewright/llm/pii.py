"""Personal data in texts: strict patterns, and candidates judged by boosted trees.

The strict patterns (``strict``) always count. Beside them generous generators
propose spans that may overlap: anything around an at sign or a spelled-out one,
groups of numbers with points, hexadecimal groups with colons, every sequence of digit
groups of 7 to 19 digits. Boosted trees judge a candidate by its format and by its
context. They learn from the corpus itself: candidates that are a strict match against
those that touch none or cut one short. What makes a match strict by itself (the plus
of a phone number, the at sign) is kept from them, so that they know the same data
written otherwise. Their scores are calibrated on candidates they have not seen, and a
span counts where this calibration reaches the asked precision.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import importable, logistic, stage, unstage

#: Kinds, in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
#: Documents the trees may learn from; candidates of a kind and label; the least to learn from.
DOCUMENTS, CANDIDATES, LEAST = 20_000, 4_000, 20
#: Rounds, depth, bins and step of the boosting.
ROUNDS, DEPTH, BINS, RATE = 40, 3, 32, 0.2
#: Precision asked of added spans on candidates held out, and the least calibrated probability.
PRECISION, SURE = 0.95, 0.9

# -- strict patterns -------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with its domain, and the letters before it back to the match before: linear in any text."""
    done = last = 0
    for match in DOMAIN.finditer(text):
        at = match.start()
        since = max(done, text.rfind("@", last, at) + 1, last)
        before = text[since:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        last = at
        if start < at:
            yield start, match.end()
            done = match.end()


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def strict(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strict matches, sorted; per kind leftmost and apart, failing ones dropped."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in _emails(text)]
    for match in QUAD.finditer(text):
        parts = [p.lstrip("0") for p in match.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = _digits(match.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= len(_digits(match.group())) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


# -- candidates ------------------------------------------------------------

AROUND = re.compile(r"[^\s@,;:\"'<>()\[\]{}|]{1,64}+@[^\s@,;:\"'<>()\[\]{}|]{1,255}")
SPELLED = re.compile(r"(?: ?[\[({<] ?(?:at|AT|At) ?[\])}>] ?| (?:at|AT) (?=[\w-]+ ?(?:dot|DOT|[\[({<]dot)))")
NAME_BEFORE = re.compile(r"[\w.%+-]{1,64}\Z")
DOT = r"(?:\.| (?:dot|DOT) | ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?)"
HOST_AFTER = re.compile(rf"[\w-]{{1,63}}(?:{DOT}[\w-]{{1,63}}){{1,8}}")
PARTS = re.compile(rf"(?<![0-9])[0-9]{{1,4}}(?:{DOT}[0-9]{{1,4}}){{3}}(?![0-9])")
COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
HEXES = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
NUMBERS = re.compile(r"[0-9](?:[^0-9A-Za-z\n]{0,3}[0-9]){6,}+")


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """``(kind, start, end)`` of all that may be personal data; spans overlap."""
    if "@" in text:
        for match in AROUND.finditer(text):
            start, end = match.start(), match.start() + len(match.group().rstrip(".!?-_*"))
            if text[start:end].rfind("@") < end - start - 1:
                yield 0, start, end
                dot = text.rfind(".", start, end)
                if dot > text.find("@", start):
                    yield 0, start, dot  # cut short
    for match in SPELLED.finditer(text):
        before = NAME_BEFORE.search(text, max(0, match.start() - 64), match.start())
        after = HOST_AFTER.match(text, match.end())
        if before and after:
            yield 0, before.start(), after.end()
    for match in PARTS.finditer(text):
        yield 1, match.start(), match.end()
    if COLONS.search(text):
        for match in HEXES.finditer(text):
            if len(match.group()) > 6:
                yield 1, match.start(), match.end()
    for match in NUMBERS.finditer(text):
        groups = [(g.start(), g.end()) for g in DIGITS.finditer(text, match.start(), match.end())]
        for i, (start, _) in enumerate(groups):
            total = 0
            for first, end in groups[i : i + 19]:
                total += end - first
                if total > 19:
                    break
                if 7 <= total <= 15:
                    yield 3, start, end
                if 13 <= total:
                    yield 2, start, end


WORD_BEFORE = re.compile(r"([^\W\d_]{1,24})\W{0,3}\Z")
WORD_AFTER = re.compile(r"\W{0,3}([^\W\d_]{1,24})")
SPOKEN = re.compile(r" ?[\[({<] ?(?:at|AT|At) ?[\])}>] ?| (?:at|AT) ")
SPOKEN_DOT = re.compile(DOT)


def _kind_of(char: str) -> int:
    return 0 if char in "\n" else 1 if char.isspace() else 2 if char.isalpha() else 3 if char.isdigit() else 4


def described(text: str, kind: int, start: int, end: int) -> tuple[list[float], str, str]:
    """What the trees see of a candidate: its format and context, and the words around it.

    A plus before it is passed over, and spelled-out signs count as the signs.
    """
    own = text[start:end]
    outer = start - (start > 0 and text[start - 1] == "+")
    before, after = text[max(0, outer - 24) : outer], text[end : end + 24]
    groups = [len(g) for g in DIGITS.findall(own)]
    digits = _digits(own)
    plain = SPOKEN_DOT.sub(".", SPOKEN.sub("@", own, count=1)) if kind < 2 else own
    name, _, host = plain.partition("@") if kind == 0 else ("", "", "")
    labels = host.split(".") if kind == 0 else []
    parts = [int(p[:4]) for p in DIGITS.findall(plain)] if kind == 1 else []
    format = [
        len(plain), len(digits), sum(map(str.isalpha, own)), len(groups), max(groups, default=0), min(groups, default=0),
        groups[0] if groups else 0, groups[-1] if groups else 0, plain.count(" "), plain.count("."), plain.count("-"), plain.count("(") + plain.count(")"),
        plain.count(":"), len(set(digits)), kind == 2 and luhn(digits), max(parts, default=0), len(labels), len(labels[-1]) if labels else 0, len(name),
        sum(map(str.isalpha, name)) / max(1, len(name)), bool(labels) and labels[-1].isalpha(), own[:1] == "0",
    ]
    context = [
        _kind_of(before[-1:]), _kind_of(after[:1]), sum(map(str.isdigit, before[-16:])), sum(map(str.isdigit, after[:16])),
        before[-3:].rstrip(" (").endswith(tuple("0123456789")), after[:3].lstrip(" )-.").startswith(tuple("0123456789")), '"' in before[-8:] or "=" in before[-8:],
        len(before) - len(before.rstrip()) or not before,
    ]
    left, right = WORD_BEFORE.search(before), WORD_AFTER.match(after)
    return [float(v) for v in (*format, *context)], (left.group(1) if left else "").lower(), (right.group(1) if right else "").lower()


def examples(text: str) -> Iterator[tuple[int, int, list[float], str, str]]:
    """``(kind, label, features, word before, word after)`` of the candidates that teach something."""
    known = strict(text)
    exact = {(kind, start + (kind == 3), end) for start, kind, end in known}
    for kind, start, end in candidates(text):
        inside = [k for s, k, e in known if s < end and start < e]
        label = (kind, start, end) in exact
        if label or not inside or inside == [kind]:
            yield kind, int(label), *described(text, kind, start, end)


# -- boosted trees ---------------------------------------------------------


@dataclass
class Trees:
    """Trees of one depth as arrays: feature and threshold of each node, value of each leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    offset: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.offset)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting of the logistic loss; splits by sums of gradients in bins of each feature."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, x.T, strict=True)], axis=1)
    width, inner = x.shape[1], 2**DEPTH - 1
    offset = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    raw = np.full(len(y), offset)
    trees = []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold, limit = np.zeros(inner, int), np.full(inner, np.inf), np.full(inner, BINS)
        node = np.zeros(len(y), int)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            place = (((node - first)[:, None] * width + np.arange(width)) * BINS + binned).ravel()
            g, h = (np.bincount(place, np.repeat(v, width), count * width * BINS).reshape(count, width, BINS).cumsum(axis=2) for v in (slope, bend))
            gain = g**2 / (h + 1) + (g[:, :, -1:] - g) ** 2 / (h[:, :, -1:] - h + 1) - g[:, :, -1:] ** 2 / (h[:, :, -1:] + 1)
            gain[(h < 1) | (h[:, :, -1:] - h < 1)] = 0
            for k in range(count):
                best = int(gain[k].argmax())
                at, cut = divmod(best, BINS)
                if gain[k].flat[best] > 1e-6 and cut < len(cuts[at]):
                    feature[first + k], threshold[first + k], limit[first + k] = at, cuts[at][cut], cut
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > limit[node])
        node -= inner
        top, bottom = np.bincount(node, slope, inner + 1), np.bincount(node, bend, inner + 1)
        leaf = RATE * top / (bottom + 1)
        raw += leaf[node]
        trees.append((feature, threshold, leaf))
    return Trees(*(np.array(v) for v in zip(*trees, strict=True)), offset)


@dataclass
class Judge:
    """Trees of one kind with the weights of words around, the curve and the threshold of their scores."""

    trees: Trees
    before: dict[str, float]
    after: dict[str, float]
    slope: float
    offset: float
    threshold: float

    def probability(self, rows: list[tuple[list[float], str, str]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.raw(_matrix(rows, self.before, self.after)) + self.offset, -500, 500)))


@dataclass
class Model:
    """A judge for each kind that could be learnt; the other kinds have their strict matches only."""

    judges: dict[int, Judge] = field(default_factory=dict)


def _matrix(rows: list[tuple[list[float], str, str]], before: dict[str, float], after: dict[str, float]) -> np.ndarray:
    return np.array([[*x, before.get(left, 0.0), after.get(right, 0.0)] for x, left, right in rows])


def _odds(words: list[str], labels: np.ndarray) -> dict[str, float]:
    """The log-odds of words seen five times, against those of all candidates."""
    all_, ones = Counter(words), Counter(w for w, y in zip(words, labels, strict=True) if y)
    base = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    return {w: float(np.log((ones[w] + 1) / (n - ones[w] + 1)) - base) for w, n in all_.items() if n >= 5}


def train(rows: list[tuple[int, list[float], str, str, bool]]) -> Judge | None:
    """A judge from ``(label, features, word before, word after, held)``; ``None`` if a label is too rare.

    Rows that are held teach the trees nothing: they give the curve and the threshold.
    Weights of words come from one half of the others, the trees from the other half.
    """
    held = np.array([r[4] for r in rows], bool)
    labels = np.array([r[0] for r in rows], float)
    if min([Counter(zip(held, labels, strict=True))[h, y] for h in (False, True) for y in (0.0, 1.0)]) < LEAST:
        return None
    learn, rest = np.nonzero(~held)[0], np.nonzero(held)[0]
    seen = [rows[k][1:4] for k in range(len(rows))]
    words, fitted = learn[::2], learn[1::2]
    before, after = ([_odds([seen[k][side] for k in words], labels[words]) for side in (1, 2)])
    if len(np.unique(labels[fitted])) < 2:
        return None
    trees = boosted(_matrix([seen[k] for k in fitted], before, after), labels[fitted])
    raw = trees.raw(_matrix([seen[k] for k in rest], before, after))
    slope, offset = logistic(raw, labels[rest])
    p = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -500, 500)))
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(labels[rest][order])
    precision = (right + 1) / (np.arange(1, len(order) + 1) + 2)  # a few lucky ones prove little
    good = np.nonzero(precision >= PRECISION)[0]
    threshold = max(SURE, float(p[order][good[-1]])) if len(good) else np.inf
    return Judge(trees, before, after, slope, offset, threshold)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, most: int = CANDIDATES) -> Model:
    """Judges learnt from about ``documents`` documents and at most ``most`` candidates of a kind and label.

    Documents are chosen by a hash of key and text, candidates by a hash of what the
    trees see of them; equal ones count once, so copies have no more weight.
    """
    importable(docs.sparkSession)
    share = min(1.0, documents / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(key).cast("string"), text), F.lit(1_000_000)) < int(share * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found = list(examples(value or ""))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], pa.int32()), pa.array([r[2] for r in found], pa.list_(pa.float64())),
                        pa.array([r[3] for r in found], pa.string()), pa.array([r[4] for r in found], pa.string()),
                    ],
                    names=["kind", "label", "x", "before", "after"],
                )

    seen = docs.select(key, text).where(drawn).select(text).mapInArrow(run, "kind int, label int, x array<double>, before string, after string")
    hashed = F.xxhash64("kind", "label", "x", "before", "after")
    seen = stage(seen.distinct().withColumn("hash", hashed), "pii-candidates")
    each = [seen.where((F.col("kind") == kind) & (F.col("label") == label)).orderBy("hash").limit(most) for kind in range(len(KINDS)) for label in (0, 1)]
    sample = each[0]
    for more in each[1:]:
        sample = sample.unionByName(more)
    rows = sorted(sample.collect(), key=lambda r: r["hash"])
    unstage(seen)
    model = Model()
    for kind in range(len(KINDS)):
        # other bits of the hash than those that order the rows
        judge = train([(r["label"], r["x"], r["before"], r["after"], (r["hash"] >> 7) % 3 == 0) for r in rows if r["kind"] == kind])
        if judge:
            model.judges[kind] = judge
    return model


# -- spans -----------------------------------------------------------------


def added(texts: list[str], known: list[list[tuple[int, int, int]]], model: Model) -> list[list[tuple[int, int, int, float]]]:
    """``(start, kind, end, probability)`` of the spans the judges add: apart from strict ones and from each other.

    Of spans that overlap the likelier one stays, of equally likely ones the longer, then the first.
    """
    out: list[list] = [[] for _ in texts]
    proposed: dict[int, list] = {kind: [] for kind in model.judges}
    for k, text in enumerate(texts):
        taken = known[k]
        for kind, start, end in set(candidates(text)) if model.judges else ():
            if kind in proposed and not any(s < end and start < e for s, _, e in taken):
                proposed[kind].append((k, start, end, described(text, kind, start, end)))
    chosen: dict[int, list] = {}
    for kind, rows in proposed.items():
        judge = model.judges[kind]
        if rows:
            p = judge.probability([r[3] for r in rows])
            for (k, start, end, _), value in zip(rows, p, strict=True):
                if value >= judge.threshold:
                    chosen.setdefault(k, []).append((-float(value), start - end, start, kind, end))
    for k, rows in chosen.items():
        covered = np.zeros(len(texts[k]) + 1, bool)
        for less, _, start, kind, end in sorted(rows):
            if not covered[start:end].any():
                covered[start:end] = True
                out[k].append((start, kind, end, -less))
    return out


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", redacted: bool = False) -> DataFrame:
    """``(key, spans)``, or ``(key, spans, redacted)``, of each row: one row comes out for each that goes in.

    ``spans`` are sorted by start, then kind; places are code points, the end is
    exclusive; strict ones have probability 1. ``redacted`` is the text with each span,
    or spans that overlap together, replaced by ``[KIND]`` of the first. A null text is
    empty and so has no spans; a null key stays null; other columns take no part.
    """
    importable(docs.sparkSession)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    span = T.StructType()
    for name, type_ in (("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()), ("strict", T.BooleanType()), ("probability", T.DoubleType())):
        span.add(name, type_)
    schema = T.StructType([source.schema["key"]]).add("spans", T.ArrayType(span))
    if redacted:
        schema.add("redacted", T.StringType())
    kind_of_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("strict", pa.bool_()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            known = [strict(value) for value in texts]
            spans = [
                sorted([(start, kind, end, True, 1.0) for start, kind, end in own] + [(start, kind, end, False, p) for start, kind, end, p in more])
                for own, more in zip(known, added(texts, known, model), strict=True)
            ]
            columns = [
                batch.column(0),
                pa.array([[{"kind": KINDS[k], "start": s, "end": e, "strict": b, "probability": p} for s, k, e, b, p in own] for own in spans], kind_of_span),
            ]
            if redacted:
                columns.append(pa.array([_redacted(value, own) for value, own in zip(texts, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def _redacted(text: str, spans: list[tuple]) -> str:
    out, done = [], 0
    for start, kind, end, *_ in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
