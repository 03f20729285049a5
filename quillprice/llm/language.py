"""Language identification by error-correcting output codes.

Every learned language has a codeword. One binary classifier per codeword bit
looks at hashed letter n-grams of the whole text. Decoding compares the bits'
margins with each codeword by a logistic loss, each bit weighted by how well its
classifier does on that language (row-normalised training accuracy), and takes
the codeword of least loss. A text is flagged ambiguous when the runner-up is
nearly as close, or when more bits disagree with the chosen codeword than the
code can correct.

The classifiers are fitted on the driver from at most ``SAMPLE`` documents, chosen
by a hash of doc_id with about as many of each language.

``und`` with score 0, flagged ambiguous, if the text is null, has no letter, or
no language was learned. Documents with null lang or doc_id take no part in
training. Repeated documents count once for each language given. An empty table
gives no rows. Other columns are never inputs of a prediction.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.llm.common import crc_mod

SAMPLE = 4_000
FOLDS, HELD = 4, 2
DIM = 2048
UNKNOWN = "und"
CLOSE = 0.6        #: score below which the runner-up counts as nearly as close
STEPS, RATE, DECAY = 120, 0.3, 1e-4
TOGETHER = 256         #: vectors held at once
_PIECE = 1 << 19
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str | None) -> np.ndarray | None:
    """Unit vector of the square roots of hashed 1-, 2- and 3-gram counts; None without a letter."""
    if not text:
        return None
    counts = np.zeros(DIM)
    seen = False
    for start in range(0, len(text), _PIECE):
        piece = text[max(0, start - 2):start + _PIECE].lower()
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letter_table()[c]
        if not letter.any():
            continue
        seen = True
        c = np.where(letter, c, np.uint32(32))
        c = c[np.concatenate([[True], letter[1:] | letter[:-1]])]      # one blank between words
        h = c * np.uint32(0x9E3779B1)
        for n in (1, 2, 3):
            counts += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(DIM - 1), minlength=DIM)
            if len(c) <= n:
                break
            h = h[:-1] * np.uint32(0x85EBCA6B) + c[n:] * np.uint32(0xC2B2AE35)
    if not seen:
        return None
    v = np.sqrt(counts)
    return v / np.linalg.norm(v)


def codebook(k: int) -> np.ndarray:
    """A codeword of +1 and -1 for each of ``k`` classes: all splits of up to five, else the widest of random codes."""
    if k <= 5:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=k - 1) if -1 in rest]
        return np.array(columns, float).reshape(-1, k).T
    rng = np.random.default_rng(k)
    best, width = None, -1
    for _ in range(64):
        code = rng.choice([1.0, -1.0], (k, max(15, math.ceil(10 * math.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k]
        apart = (code.shape[1] - (code @ code.T)[~np.eye(k, dtype=bool)].max()) / 2
        if apart > width:
            best, width = code, apart
    return best


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray        # languages x bits
    weights: np.ndarray     # DIM x bits
    bias: np.ndarray
    trust: np.ndarray       # languages x bits, rows add up to 1

    def decode(self, x: np.ndarray):
        """Languages, scores and ambiguity flags of the rows of ``x``."""
        if len(self.languages) == 1:
            n = len(x)
            return np.array(self.languages * n, object), np.ones(n), np.zeros(n, bool)
        margin = x @ self.weights + self.bias
        loss = np.einsum("kb,nkb->nk", self.trust, np.logaddexp(0, -self.code[None] * margin[:, None]))
        near = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        score = 1 / near.sum(1)
        best = loss.argmin(1)
        wrong = (np.sign(margin) != self.code[best]).sum(1)
        apart = (self.code.shape[1] - (self.code @ self.code.T)[~np.eye(len(self.code), dtype=bool)].max()) / 2
        return np.array(self.languages, object)[best], score, (score < CLOSE) | (wrong > (apart - 1) // 2)


def fit(x: np.ndarray, y: list[str]) -> CodeModel | None:
    """One logistic classifier per codeword bit, by gradient descent with momentum."""
    if not len(y):
        return None
    languages = sorted(set(y))
    k = np.array([languages.index(v) for v in y])
    code = codebook(len(languages))
    target = code[k]
    each = 1 / np.bincount(k)[k]
    each = (each / each.sum())[:, None]                     # languages weigh the same
    w, b = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(STEPS):
        slope = -target * each / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30)))
        vw = 0.9 * vw - RATE * 40 * (x.T @ slope + DECAY * w)
        vb = 0.9 * vb - RATE * slope.sum(0)
        w, b = w + vw, b + vb
    right = np.sign(x @ w + b) == target
    trust = np.stack([right[k == i].mean(0) for i in range(len(languages))]) + 1e-6
    return CodeModel(languages, code, w, b, trust / trust.sum(1, keepdims=True))


def train(docs: DataFrame, sample: int = SAMPLE) -> CodeModel | None:
    """Fit on documents outside the held-out fold, ``sample`` of them at most."""
    known = (docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                         & (crc_mod("doc_id", FOLDS) != HELD))
                 .select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang")))
    counts = {r["__lang"]: r["n"] for r in known.groupBy("__lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = sample / len(counts)
    part = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, share / n))])
    hashed = F.xxhash64("__id", "__lang")
    chosen = (known.filter(F.pmod(hashed, F.lit(1_000_000)) < part[F.col("__lang")] * 1_000_000)
                   .orderBy(hashed, "__id", "__lang").limit(sample).dropDuplicates())

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        found = (ngrams(t) for t in texts)
        return pd.Series([None if v is None else v.astype(np.float32).tobytes() for v in found], dtype=object)

    # The sample is bounded by its limit, so broadcasting it moves no text.
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
                .select("__id", "__lang", vector("text").alias("x")).filter("x IS NOT NULL")
                .groupBy("__id", "__lang").agg(F.min("x").alias("x")).toPandas()
                .sort_values(["__id", "__lang"]))
    if not len(rows):
        return None
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), DIM)
    return fit(x.astype(float), rows["__lang"].tolist())


def identify(docs: DataFrame, model: CodeModel | None) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous (columns of these names are replaced).

    Only the text goes to Python.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        lang, score, unsure = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
        for first in range(0, n if shared.value is not None else 0, TOGETHER):
            found = [(i, v) for i in range(first, min(first + TOGETHER, n)) if (v := ngrams(texts.iloc[i])) is not None]
            if found:
                at = np.array([i for i, _ in found])
                lang[at], score[at], unsure[at] = shared.value.decode(np.stack([v for _, v in found]))
        return pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": unsure})

    new = ("lang_pred", "score", "ambiguous")
    rows = docs.select(F.struct("*").alias("doc"), predict("text").alias("p"))
    return rows.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in new], "p.*")


def identify_all(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous."""
    return identify(docs.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD).alias("held_out"), "text"),
                    train(docs)).drop("text")
