"""Personal data by patterns and a skip-chain conditional random field.

Base spans are leftmost matches of four patterns (email, ip, card, phone) that
pass a check of their digits. They always stay, and they are what the model
learns from; the model adds spans that the patterns leave out, such as a
phone number without its prefix beside the whole one, or a card number next to
another number.

The field covers all tokens (runs without white space) of a document. Labels are
the four kinds and none. A token without a digit or ``@`` can only be none, so it
is observed, and takes part through the features of its neighbours; the others
are the field's variables:

* features: shape, digits, checks and the words before and after;
* chain potentials between variables next to each other;
* skip potentials between distant tokens that repeat or resemble each other (the
  same last seven digits, or the same text but for case): each is linked to the
  next one like it, so that a token that comes k times has k - 1 links.

Weights are learned by pseudo-likelihood on a bounded sample: at most
``SAMPLE_DOCS`` documents with base spans and half as many with variables only,
``SAMPLE_TOKENS`` tokens of each, once as they are and once alone: without the words
and variables beside them, and a phone number without its ``+``. Skip potentials
have a prior that favours agreement (``AGREE``). Loopy
sum-product messages in log space, damped, give each variable's marginals with
the base spans observed, so that the document's labels come to agree. A variable
with ``SURE`` of the mass on a kind, in a shape that this kind can have, is an
added span; none overlaps a base span.

Texts are read once, in Spark tasks; what is stored is the variables of each
document. Every pattern takes time linear in the text, and messages are linear in
the variables. Null text counts as empty and has no spans; bytes that are no UTF-8
count as U+FFFD. Repeated rows give repeated rows, null doc_ids stay, an empty table
gives no rows, and other columns, whatever their names, are not looked at. Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.llm.common import text_or_empty
from quillprice.session import materialize

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_TOKENS = 4000, 64
SURE = 0.75
AGREE = 1.5
#: Hashed features; variables of one run of message passing; rounds at most and the change that ends them.
WIDTH, TOGETHER, ROUNDS, SETTLED, DAMPING = 32_768, 200_000, 40, 1e-4, 0.5
_LABELS = len(KINDS) + 1          # label 0 is none, label i + 1 is KINDS[i]
_FEATURES = 12

# -- base spans ------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match that began inside a run of digits would end where the one from its start does, so runs are entered at the start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def _emails(text: str):
    """Leftmost matches, found from each ``@``: the part before it is the run of its characters."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of all base spans, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out)


# -- variables -------------------------------------------------------------------

_OPEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_BEFORE = re.compile(r"(\S{1,24})\s*\Z")
_AFTER = re.compile(r"\s*(\S{1,24})")
_EDGE = "\"'`.,;:!?*#$%&<>[]{}=|/\\~^_"
_TELEPHONE = re.compile(r"[+().0-9-]++\Z")
_DOTTED = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}\Z")
_NUMBER = re.compile(r"[0-9](?:-?[0-9])*+\Z")
_ADDRESS = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}\Z")
_RUNS = re.compile(r"[0-9]+|[a-z]+|[A-Z]+")


def _shape(core: str) -> str:
    """Letters as a or A, digits as 9 with the length of their run, the rest as it is."""
    return _RUNS.sub(lambda m: f"9{min(m.end() - m.start(), 20)}" if m.group()[0] in "0123456789" else
                     "a" if m.group()[0] >= "a" else "A", core[:40])


def _hashed(name: str, value) -> int:
    return zlib.crc32(f"{name}={value}".encode("utf-8", "surrogatepass")) % WIDTH


def _word(found) -> str:
    return found.group(1).strip(_EDGE + "()").lower() if found else ""


class Variables:
    """The variables of one document: where they are, their features, links and observed labels."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        spans, shapes = [], []
        for m in _OPEN.finditer(text):
            raw = m.group()
            core = raw.lstrip(_EDGE)
            start = m.end() - len(core)
            core = core.rstrip(_EDGE)
            if core.endswith(")") and "(" not in core:
                core = core.rstrip(")" + _EDGE)
            if core and any(c in core for c in "0123456789@"):
                spans.append((start, start + len(core), m.start(), m.end()))
                shapes.append(core)
        self.spans = np.array([s[:2] for s in spans], np.int64).reshape(-1, 2)
        n = len(spans)
        self.next_to = np.zeros(n, bool)          # to the variable before it
        self.observed = np.zeros(n, np.int8)      # the label of the base span that it is part of, 0: none
        self.allowed = np.zeros((n, _LABELS), bool)
        self.features = np.zeros((n, _FEATURES), np.int16)
        self.link = np.full(n, -1, np.int64)      # the variable before it that is like it
        digits = [_digits(c) for c in shapes]
        seen, at = {}, 0
        for i, ((start, end, lo, hi), core) in enumerate(zip(spans, shapes)):
            while at < len(base) and base[at][2] <= start:
                at += 1
            over = [k for s, k, e in base[at:at + 8] if s < end and e > start]
            self.observed[i] = min(over) + 1 if over else 0
            before = _BEFORE.search(text, max(0, lo - 40), lo)
            after = _AFTER.match(text, hi, hi + 40)
            self.next_to[i] = i > 0 and not text[spans[i - 1][3]:lo].strip() if lo - (spans[i - 1][3] if i else 0) < 4 else False
            key = digits[i][-7:] if len(digits[i]) >= 7 and len(core) < 2 * len(digits[i]) + 4 else core.lower() \
                if len(core) >= 6 else None
            if key is not None:
                self.link[i], seen[key] = seen.get(key, -1), i
            plain, number = _TELEPHONE.match(core) is not None, _NUMBER.match(core) is not None
            self.allowed[i] = (True, "@" in core, plain and "." in core, number, plain)
            sound = number and 14 <= len(digits[i]) <= 19 and luhn(digits[i])
            self.features[i] = [
                _hashed("bias", 1), _hashed("shape", _shape(core)), _hashed("digits", min(len(digits[i]), 21)),
                _hashed("plus", core.startswith("+")), _hashed("at", "@" in core), _hashed("dots", min(core.count("."), 4)),
                _hashed("dash", "-" in core), _hashed("round", "(" in core), _hashed("letters", any(map(str.isalpha, core[:40]))),
                _hashed("checks", (sound, bool(_DOTTED.match(core)) and _octets(core))),
                _hashed("before", _word(before)), _hashed("after", _word(after))]
        self.cores = shapes

    def alone(self) -> np.ndarray:
        """Features without the words around, and as if no phone number had its ``+``."""
        out = self.features.copy()
        out[:, 3] = _hashed("plus", False)
        out[:, -2:] = _hashed("before", None), _hashed("after", None)
        for i in np.flatnonzero(self.observed == KINDS.index("phone") + 1):
            out[i, 1] = _hashed("shape", _shape(self.cores[i].lstrip("+")))
        return out


def _possible(kind: int, text: str) -> bool:
    """Whether a span of this kind can have this text."""
    digits = _digits(text)
    if KINDS[kind] == "email":
        return _ADDRESS.match(text) is not None
    if KINDS[kind] == "ip":
        return _DOTTED.match(text) is not None and _octets(text)
    if KINDS[kind] == "card":
        return 14 <= len(digits) <= 19 and luhn(digits) and _CARD.fullmatch(text) is not None
    return 7 <= len(digits) <= 15 and not set(text) - set("+().0123456789- ")


# -- the field -------------------------------------------------------------------

def fit(features: np.ndarray, label: np.ndarray, allowed: np.ndarray, around: np.ndarray, rounds: int = 100,
        rate: float = 0.2, ridge: float = 1e-3) -> dict:
    """Weights by pseudo-likelihood: every variable's label given its features and the labels around it.

    ``around``: labels before, after, and of two like it (-1: no such variable).
    """
    w = {"w": np.zeros((WIDTH, _LABELS)), "chain": np.zeros((_LABELS, _LABELS)), "skip": AGREE * np.eye(_LABELS)}
    if not len(label):
        return w
    before, after, skips = around[:, 0], around[:, 1], around[:, 2:]
    share = 1 / np.bincount(label, minlength=_LABELS).clip(1)[label]        # each label counts alike, within limits
    weight = np.sqrt(share)
    weight /= weight.sum()
    prior = {k: v.copy() for k, v in w.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    rows = np.arange(len(label))
    for step in range(1, rounds + 1):
        logits = w["w"][features].sum(axis=1)
        logits[before >= 0] += w["chain"][before[before >= 0]]
        logits[after >= 0] += w["chain"].T[after[after >= 0]]
        for k in range(skips.shape[1]):
            on = skips[:, k] >= 0
            logits[on] += w["skip"][skips[on, k]]
        logits[~allowed] = -1e9
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[rows, label] -= 1
        p *= weight[:, None]
        grad = {k: ridge * (v - prior[k]) for k, v in w.items()}
        for k in range(features.shape[1]):
            np.add.at(grad["w"], features[:, k], p)
        np.add.at(grad["chain"], before[before >= 0], p[before >= 0])
        np.add.at(grad["chain"].T, after[after >= 0], p[after >= 0])
        for k in range(skips.shape[1]):
            on = skips[:, k] >= 0
            np.add.at(grad["skip"], skips[on, k], p[on])
        grad["skip"] = (grad["skip"] + grad["skip"].T) / 2
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] = w[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def _spread(x: np.ndarray) -> np.ndarray:
    """log sum exp over the middle axis."""
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def marginals(theta: np.ndarray, i: np.ndarray, j: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals by loopy sum-product messages over the edges (i, j) with log potentials ``pair``; exact on trees."""
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    pot = np.concatenate([pair, pair.transpose(0, 2, 1)])           # [edge, label of a, label of b]
    back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
    msg = np.zeros((len(a), _LABELS))
    belief = theta.copy()
    for _ in range(rounds if len(a) else 0):
        new = _spread((belief[a] - msg[back])[:, :, None] + pot)
        new -= _spread(new[:, :, None])
        new = DAMPING * msg + (1 - DAMPING) * new
        change = np.abs(new - msg).max()
        msg = new
        belief = theta.copy()
        np.add.at(belief, b, msg)
        if change < SETTLED:
            break
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def infer(documents: list[Variables], w: dict) -> list[np.ndarray]:
    """The marginals of each document's variables, all documents in one run of message passing."""
    sizes = [len(d.link) for d in documents]
    first = np.cumsum([0, *sizes])
    theta = w["w"][np.concatenate([d.features for d in documents])].sum(axis=1)
    observed = np.concatenate([d.observed for d in documents])
    allowed = np.concatenate([d.allowed for d in documents])
    allowed[observed > 0] = False
    allowed[observed > 0, observed[observed > 0]] = True
    theta[~allowed] = -1e9
    near = np.flatnonzero(np.concatenate([d.next_to for d in documents]))
    like = np.concatenate([np.where(d.link >= 0, d.link + lo, -1) for d, lo in zip(documents, first)])
    far = np.flatnonzero(like >= 0)
    i, j = np.concatenate([near - 1, like[far]]), np.concatenate([near, far])
    pair = np.concatenate([np.broadcast_to(w["chain"], (len(near), _LABELS, _LABELS)),
                           np.broadcast_to(w["skip"], (len(far), _LABELS, _LABELS))])
    p = marginals(theta, i, j, pair)
    return [p[lo:hi] for lo, hi in zip(first[:-1], first[1:])]


def added_spans(doc: Variables, p: np.ndarray, gaps: list[str], sure: float = SURE) -> list[tuple[int, int, int]]:
    """Spans of the variables that are surely of a kind: a run of neighbours if it can be one, else each alone."""
    label = np.where(p[:, 1:].max(axis=1, initial=0) >= sure, p.argmax(axis=1), 0) if len(p) else np.zeros(0, int)
    label[doc.observed > 0] = 0
    out, i = [], 0
    while i < len(label):
        end = i + 1
        while label[i] and end < len(label) and label[end] == label[i] and doc.next_to[end] and end - i < 8:
            end += 1
        if label[i]:
            whole = "".join(gaps[k] * (k > i) + doc.cores[k] for k in range(i, end))
            runs = [(i, end)] if end - i > 1 and _possible(label[i] - 1, whole) else [(k, k + 1) for k in range(i, end)]
            for lo, hi in runs:
                text = whole if hi - lo > 1 else doc.cores[lo]
                if _possible(label[i] - 1, text):
                    out.append((int(doc.spans[lo, 0]), int(label[i]) - 1, int(doc.spans[hi - 1, 1])))
        i = end
    return out


# -- Spark jobs ------------------------------------------------------------------

def variables(docs: DataFrame) -> DataFrame:
    """Stored rows (doc_id, base, found): base spans, and the packed variables of a document that has any."""
    def read(frames):
        for frame in frames:
            base, found = [], []
            for raw in frame["text"]:
                text = raw.decode("utf-8", "replace")
                spans = base_spans(text)
                one = Variables(text, spans)
                gaps = ["", *(text[one.spans[k - 1, 1]:one.spans[k, 0]] if one.next_to[k] else ""
                              for k in range(1, len(one.link)))]
                base.append([(KINDS[k], s, e) for s, k, e in spans])
                found.append(pickle.dumps((one, gaps)) if len(one.link) else None)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "base": [[{"kind": k, "start": s, "end": e} for k, s, e in b] for b in base],
                                "found": found})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return materialize(rows.mapInPandas(read, f"doc_id long, base {SPANS}, found binary"), "pii-variables")


SPANS = "array<struct<kind:string,start:long,end:long>>"


def learn(stored: DataFrame, docs: int = SAMPLE_DOCS, tokens: int = SAMPLE_TOKENS) -> dict:
    """Weights from a bounded sample of the stored documents."""
    def taken(frame: DataFrame, most: int) -> DataFrame:
        # A share by hash first, so that the ordered cut stays small however many documents there are.
        n = frame.count()
        order = F.xxhash64("doc_id", "found")
        share = min(1.0, 2 * most / max(n, 1))
        return (frame.filter(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
                     .orderBy(order).limit(most).select("found"))

    def rows(frames):
        for frame in frames:
            out = []
            for blob in frame["found"]:
                one, _ = pickle.loads(blob)
                n = len(one.link)
                label = one.observed.astype(np.int64)
                after = np.full(n, -1)
                after[:-1] = np.where(one.next_to[1:], label[1:], -1)
                before = np.where(one.next_to, np.roll(label, 1), -1)
                back = np.where(one.link >= 0, label[one.link], -1)
                on = np.full(n, -1)
                on[one.link[one.link >= 0]] = label[one.link >= 0]
                pick = np.sort(np.argsort([zlib.crc32(c.encode("utf-8", "surrogatepass")) for c in one.cores], kind="stable")[:tokens])
                none = np.full(n, -1)
                for features, near in ((one.features, (before, after, back, on)), (one.alone(), (none, none, back, on))):
                    out += [(features[i].tobytes(), int(label[i]), one.allowed[i].tobytes(),
                             np.array([x[i] for x in near], np.int8).tobytes()) for i in pick]
            yield pd.DataFrame(out, columns=["f", "y", "ok", "near"])

    some = stored.filter("found IS NOT NULL")
    sample = taken(some.filter(F.size("base") > 0), docs).union(taken(some.filter(F.size("base") == 0), docs // 2))
    got = sample.mapInPandas(rows, "f binary, y long, ok binary, near binary").toPandas()
    n = len(got)
    joined = {c: b"".join(got[c]) for c in ("f", "ok", "near")}
    return fit(np.frombuffer(joined["f"], np.int16).reshape(n, _FEATURES).astype(np.int64), got["y"].to_numpy(np.int64),
               np.frombuffer(joined["ok"], bool).reshape(n, _LABELS), np.frombuffer(joined["near"], np.int8).reshape(n, 4)
               .astype(np.int64))


def personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """doc_id, base, spans: the base spans, and all spans by start and kind, of every document."""
    stored = variables(docs)
    weights = stored.sparkSession.sparkContext.broadcast(learn(stored))

    def find(frames):
        for frame in frames:
            spans = [sorted((s["start"], KINDS.index(s["kind"]), s["end"]) for s in b) for b in frame["base"]]
            waiting, held = [], 0

            def answer():
                for (i, (one, gaps)), p in zip(waiting, infer([v[0] for _, v in waiting], weights.value) if waiting else []):
                    spans[i] = sorted(spans[i] + added_spans(one, p, gaps, sure))

            for i, blob in enumerate(frame["found"]):
                if blob is not None:
                    waiting.append((i, pickle.loads(blob)))
                    held += len(waiting[-1][1][0].link)
                    if held >= TOGETHER:
                        answer()
                        waiting, held = [], 0
            answer()
            yield pd.DataFrame({"doc_id": frame["doc_id"], "base": frame["base"],
                                "spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in spans]})

    return stored.mapInPandas(find, f"doc_id long, base {SPANS}, spans {SPANS}")
