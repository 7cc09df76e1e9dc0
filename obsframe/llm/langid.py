"""Hierarchical language identification.

A document is first assigned a language *family*; one-versus-one linear support vector
machines then separate the languages inside that family. Features are hashed character
1- to 4-grams of the lower-cased letters of the whole text (every run of other
characters counts as one word boundary), as relative frequencies.

Fitting uses at most ``sample_rows`` labelled rows (a documented bound: equal shares
per language, rows of smallest hash of the id), whose feature vectors are computed on
the executors; fitting itself is a dual coordinate descent on a matrix of at most
``sample_rows`` x ``DIMS``. Prediction covers every row in one map-only pass.

Defined results: a null text, or one without a letter, gets ``und`` and score 0. An
empty or unlabelled training table leaves no learned language: every row gets ``und``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import ship

BITS = 12
DIMS = 1 << BITS
SAMPLE_ROWS = 1200
UNDETERMINED = "und"

# Families of well-known language codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngram_ids(text: str | None) -> np.ndarray:
    """Hashed n-gram ids (repeats included) of the letters of ``text``; empty if it has none."""
    if not text:
        return np.empty(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[c]
    if not is_letter.any():
        return np.empty(0, np.int64)
    gap = ~is_letter
    keep = is_letter | (gap & np.append(True, is_letter[:-1]))
    c = np.where(is_letter, c, 32)[keep].astype(np.uint64)
    c = np.concatenate(([np.uint64(32)] if c[0] != 32 else [], c, [np.uint64(32)] if c[-1] != 32 else [])).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, 5):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:] + np.uint64(n)
        x = h ^ (h >> np.uint64(29))
        out.append(((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out)


def _vector(text: str | None) -> np.ndarray:
    ids = ngram_ids(text)
    v = np.bincount(ids, minlength=DIMS).astype(np.float32)
    return v / max(1, len(ids))


def _sample(train: DataFrame, text: str, lang: str, key: str, rows: int) -> pd.DataFrame:
    counts = {r["lang"]: r["count"] for r in train.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).count()
              .orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not counts:
        return pd.DataFrame({"lang": [], "v": []})
    ship(train.sparkSession)
    share = max(1, rows // len(counts))
    u = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    take: Column = F.lit(False)
    for name, n in counts.items():  # a little over the share, then cut exactly by hash order
        take = take | ((F.col(lang) == name) & (u < int((1 << 30) * min(1.0, 1.3 * share / n + 20 / n))))
    picked = train.where(take).select(F.col(lang).alias("lang"), u.alias("u"), F.col(text).alias("text"))

    def vectors(batches):
        for b in batches:
            yield pd.DataFrame({"lang": b["lang"], "u": b["u"], "v": [_vector(t).tobytes() for t in b["text"]]})

    found = pd.DataFrame(picked.mapInPandas(vectors, "lang string, u long, v binary").collect(), columns=["lang", "u", "v"])
    return found.sort_values(["lang", "u"]).groupby("lang").head(share)


def _svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, epochs: int = 30) -> np.ndarray:
    """L2-loss linear support vector machine with bias, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, alpha = np.zeros(x.shape[1], np.float64), np.zeros(len(x))
    diag = np.einsum("ij,ij->i", x, x) + 0.5 / c
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / c
            new = max(0.0, alpha[i] - g / diag[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS) -> dict:
    """Fit the hierarchy on a bounded sample of ``train``.

    Returns ``families`` (names), ``langs`` (per family), and one weight vector per pair
    of families and per pair of languages of one family.
    """
    rows = _sample(train, text, lang, key, sample_rows)
    names = sorted(rows["lang"].unique())
    families = sorted({family_of(n) for n in names})
    model = {"families": families, "langs": {f: [n for n in names if family_of(n) == f] for f in families}, "w": {}}
    if not names:
        return model
    x = np.frombuffer(b"".join(rows["v"]), np.float32).reshape(-1, DIMS)
    used = x.sum(1) > 0
    x, of = np.sqrt(x[used]), rows["lang"].to_numpy()[used]
    fam = np.array([family_of(n) for n in of])

    def pairs(labels, among):
        for i, a in enumerate(among):
            for b in among[i + 1:]:
                m = (labels == a) | (labels == b)
                model["w"][a, b] = _svm(x[m], np.where(labels[m] == a, 1.0, -1.0)).astype(np.float32)

    pairs(fam, families)
    for f in families:
        pairs(of, model["langs"][f])
    return model


def _choose(model: dict, x: np.ndarray, among: list[str]) -> tuple[str, float]:
    """Most one-versus-one wins (ties: larger summed margin, then name); and the smallest probability of the winner's duels."""
    if len(among) == 1:
        return among[0], 1.0
    wins, margin = dict.fromkeys(among, 0), dict.fromkeys(among, 0.0)
    duel: dict[tuple[str, str], float] = {}
    for i, a in enumerate(among):
        for b in among[i + 1:]:
            w = model["w"][a, b]
            m = float(x @ w[:-1] + w[-1])
            wins[a if m >= 0 else b] += 1
            margin[a] += m
            margin[b] -= m
            duel[a, b], duel[b, a] = m, -m
    best = min(among, key=lambda n: (-wins[n], -margin[n], n))
    worst = min(duel[best, n] for n in among if n != best)
    return best, float(1 / (1 + np.exp(-3 * worst)))


def predict_text(model: dict, text: str | None) -> tuple[str, float]:
    ids = ngram_ids(text)
    if not len(ids) or not model["families"]:
        return UNDETERMINED, 0.0
    x = np.sqrt((np.bincount(ids, minlength=DIMS) / len(ids)).astype(np.float32))
    family, p = _choose(model, x, model["families"])
    lang, q = _choose(model, x, model["langs"][family])
    return lang, p * q


def predict(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1) added; a column of either name is replaced.

    The model has a fixed size (``DIMS`` weights per pair) and is broadcast once.
    """
    shared = ship(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([predict_text(shared.value, t) for t in texts], columns=["lang", "score"])

    return (df.withColumn("__language", identify(F.col(text)))
            .withColumns({"lang_pred": F.col("__language.lang"), "score": F.col("__language.score")}).drop("__language"))


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def identify_languages(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``; learns from the rows that are not held out."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model).withColumn("held_out", held_out())
