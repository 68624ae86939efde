"""Language identification with error-correcting output codes.

Every language has a codeword; a binary classifier on hashed byte n-grams
predicts each bit.  A text goes to the language whose codeword has the smallest
loss over the bits, weighted by how well each bit's classifier does on that
language (loss-weighted decoding).  A small distance to the runner-up flags the
prediction as ambiguous.

Training takes a bounded sample of labelled rows, the same number of each
language by hash; only their n-gram counts reach the driver.  Prediction reads
whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0 and
ambiguous; so is every text if there is no labelled row; a single language has
no bits to learn and gets score 1; ties go to the language that sorts first;
repeated rows get equal results; columns named like a result column give way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_text

#: labelled rows that the classifiers are fitted on, over all languages
SAMPLE_ROWS = 3000
BUCKETS = 4096
ORDERS = (1, 2, 3, 4)
#: a lead over the runner-up below this is ambiguous
MARGIN = 0.2
UNKNOWN = "und"

_U = np.uint32
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def code_matrix(n: int, seed: int = 11) -> np.ndarray:
    """A codeword of -1 and 1 for each of ``n`` classes.  Up to seven classes get the
    exhaustive code; more get the random code, of 64, with the largest smallest
    distance between codewords."""
    if n <= 1:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        bits = [[1 if c == 0 or (j >> (c - 1)) & 1 else -1 for c in range(n)] for j in range(2 ** (n - 1) - 1)]
        return np.array(bits, np.int8).T
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(n)))
    best, distance = None, -1
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        split = np.abs(code.sum(axis=0)) < n
        apart = (width - code.astype(np.int32) @ code.T.astype(np.int32)) // 2 + np.eye(n, dtype=np.int32) * width
        if split.all() and apart.min() > distance:
            best, distance = code, apart.min()
    return best


def n_gram_shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the root of each bucket's share of its n-grams: letters folded to lower
    case, everything else one blank; n-grams of blanks alone do not count."""
    rows = len(offsets) - 1
    out = np.zeros((rows, BUCKETS), np.float32)
    if not len(data):
        return out
    x = _FOLD[data]
    # the capital letters of the Latin-1 block
    capital = np.zeros(len(x), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    x = np.where(capital, x + 32, x).astype(_U)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    code = np.zeros(len(x), _U)
    blank = np.ones(len(x), bool)
    total = np.zeros(rows * BUCKETS, np.float64)
    for k in range(max(ORDERS)):
        n = len(x) - k
        if n <= 0:
            break
        code = code[:n] * _U(0x01000193) + x[k:]
        blank = blank[:n] & (x[k:] == 32)
        if k + 1 not in ORDERS:
            continue
        ok = ~blank & (row[:n] == row[k:])
        h = (code + _U(k * 0x9E3779B1 & 0xFFFFFFFF)) * _U(0x85EBCA6B)
        h = ((h ^ (h >> _U(15))) * _U(0xC2B2AE35)) >> _U(20)
        total += np.bincount(row[:n][ok] * BUCKETS + h[ok], minlength=rows * BUCKETS)
    out[:] = total.reshape(rows, BUCKETS)
    size = out.sum(axis=1, keepdims=True)
    np.divide(out, size, out=out, where=size > 0)
    return np.sqrt(out, out=out)


def _few_rows(fn, most: int = 512):
    """Apply ``fn`` to at most ``most`` texts at a time: its matrices have a row per text."""

    def run(data, offsets):
        parts = [
            fn(data[offsets[a] : offsets[min(a + most, len(offsets) - 1)]], offsets[a : a + most + 1] - offsets[a])
            for a in range(0, len(offsets) - 1, most)
        ]
        return [sum((list(p[i]) for p in parts), []) for i in range(len(parts[0]))]

    return run


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest language, its score, and its lead over the next."""
        n = len(margins)
        if len(self.languages) == 1:
            return np.zeros(n, np.int64), np.ones(n), np.ones(n)
        # logistic loss of every bit against every codeword
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :])
        distance = (loss * self.trust[None, :, :]).sum(axis=2) * self.code.shape[1]
        z = -distance + distance.min(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        ordered = np.sort(p, axis=1)
        return best, ordered[:, -1], ordered[:, -1] - ordered[:, -2]


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most ``rows`` labelled rows, or None if there are none."""
    known = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("label"), F.col(key).alias("key"), F.col(text).alias("text"))
    count = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    languages = sorted(count)
    if not languages:
        return None
    each = max(1, rows // len(languages))
    # a hash of the key takes about ``each`` rows of each language, in any order of rows
    most = F.lit(0.0)
    for name in languages:
        most = F.when(F.col("label") == name, F.lit(min(1.0, each / count[name]))).otherwise(most)
    draw = F.pmod(F.xxhash64("key", F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < most).select("label", "text")

    def grams(data, offsets):
        out = [[], []]
        for row in n_gram_shares(data, offsets):
            at = np.flatnonzero(row)
            out[0].append(at.astype("<i2").tobytes())
            out[1].append(row[at].astype("<f4").tobytes())
        return out

    got = map_text(sample, "text", _few_rows(grams), "at binary, share binary").select("label", "at", "share").collect()
    got.sort(key=lambda r: (r[0], bytes(r[1]), bytes(r[2])))
    x = np.zeros((len(got), BUCKETS), np.float32)
    for i, (_, at, share) in enumerate(got):
        x[i, np.frombuffer(at, "<i2")] = np.frombuffer(share, "<f4")
    y = np.array([languages.index(r[0]) for r in got], np.int64)
    del got
    return _train(languages, x, y)


def _train(languages: list[str], x: np.ndarray, y: np.ndarray, steps: int = 150, penalty: float = 1e-5) -> Model:
    """Logistic regression for all bits at once, by accelerated gradient steps."""
    code = code_matrix(len(languages)).astype(np.float32)
    bits = code.shape[1]
    w, b = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits, np.float32)
    if bits and len(x):
        target = code[y]
        share = np.bincount(y, minlength=len(languages))[y]
        weight = (1 / share / len(np.unique(y)))[:, None].astype(np.float32)
        # rows have norm 1, so with the bias the gradient changes by at most half
        rate, vw, vb = 2.0, w.copy(), b.copy()
        for step in range(steps):
            m = (x @ vw + vb) * target
            g = -target * weight / (1 + np.exp(m))
            nw = vw - rate * (x.T @ g + penalty * vw)
            nb = vb - rate * g.sum(axis=0)
            pace = step / (step + 3)
            vw, vb = nw + pace * (nw - w), nb + pace * (nb - b)
            w, b = nw, nb
    right = ((x @ w + b) * code[y] > 0) if bits else np.zeros((len(x), 0))
    trust = np.array([right[y == c].mean(axis=0) if (y == c).any() else np.ones(bits) for c in range(len(languages))]).reshape(len(languages), bits)
    trust = np.maximum(trust, 1e-3)
    trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return Model(languages, code, w, b, trust)


def predict(docs: DataFrame, model: Model | None, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``."""
    docs = docs.drop(*(c for c in ("lang_pred", "score", "ambiguous") if c != text))
    letters: Column = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))

    def run(data, offsets):
        best, score, lead = model.decode(n_gram_shares(data, offsets) @ model.weights + model.bias)
        return [[model.languages[i] for i in best], score.astype(np.float64).tolist(), (lead < margin).tolist()]

    out = map_text(docs, text, _few_rows(run), "lang_pred string, score double, ambiguous boolean")
    return out.withColumns(
        {
            "lang_pred": F.when(letters, F.col("lang_pred")).otherwise(UNKNOWN),
            "score": F.when(letters, F.col("score")).otherwise(0.0),
            "ambiguous": ~letters | F.col("ambiguous"),
        }
    )
