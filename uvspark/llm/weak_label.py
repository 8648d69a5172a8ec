"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over the
histogram of vote patterns (at most 3 ** labellers rows, of all documents) estimates how each votes
on good and on bad documents, hence a posterior per pattern. The posteriors of a bounded sample train
a linear scorer over hashed byte trigrams, which then scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_or_none, table, with_null_ids

BAD, GOOD, ABSTAIN = 0, 1, 2
#: Hashed features, and documents (of least hash of doc_id and text) that train the scorer.
DIMENSIONS, TRAINING_ROWS = 4096, 3000
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = "a and are as at be by for from in is it of on or that the this to was with au avec ce dans de des du elle en est et il la le les ou par pas pour que qui sur un une das dem den der die ein eine es im ist mit nicht sich sie und von zu al como con del el las lo los más no para se su y".split()

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_KIND = lambda chars: np.isin(np.arange(256), list(chars.encode()))
_SYMBOL, _UPPER, _BANG = _KIND("#*$%&|<>{}\\~^"), _KIND("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _KIND("!")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, dtype=np.uint64)


def _flat(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, a line feed around each, and where each begins."""
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8), 1 + np.cumsum([0, *(len(r) + 1 for r in raw)])


def _names(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit names of byte ranges, equal for equal bytes."""
    mul = np.uint64(0x9E3779B97F4A7C15)
    run = lambda x: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(codes), x, np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[codes] * run(mul)[:-1], dtype=np.uint64)])
    name = (sums[last] - sums[first]) * run(np.uint64(pow(int(mul), -1, 1 << 64)))[first]
    return (name ^ (name >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _lower_table() -> np.ndarray:
    return np.frombuffer(_LOWER, np.uint8)


def _stop_names() -> np.ndarray:
    with np.errstate(over="ignore"):
        codes, at = _flat(STOP_WORDS)
        return _names(codes, at[:-1], at[1:] - 1)


def _distinct(names: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((names, owner))
    a, o = names[order], owner[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


LABELLERS = ("symbols", "capitals", "variety", "function_words", "word_length", "exclamations", "repeated_lines", "repeated_words")


def votes(texts: list[str | None]) -> np.ndarray:
    """Votes of every labeller (columns) on every text. Few words make a labeller abstain."""
    n = len(texts)
    with np.errstate(over="ignore"):
        codes, begins = _flat(texts)
        gap = _GAP[codes]
        first = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        last = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        owner = np.searchsorted(begins, first, side="right") - 1
        words = np.bincount(owner, minlength=n)
        some = np.maximum(words, 1)
        names = _names(_lower_table()[codes], first, last)
        stops = np.bincount(owner[np.isin(names, _stop_names())], minlength=n)
        variety = _distinct(names, owner, n)
        echo = np.bincount(owner[1:][(names[1:] == names[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
        starts = np.flatnonzero(codes[:-1] == 10) + 1
        ends = np.append(starts[1:] - 1, len(codes) - 1)
        line = ends > starts
        owner_l = np.searchsorted(begins, starts[line], side="right") - 1
        lines = np.bincount(owner_l, minlength=n)
        fresh = _distinct(_names(codes, starts[line], ends[line]), owner_l, n)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[begins])
    size = total(~gap) / some
    out = np.full((n, len(LABELLERS)), ABSTAIN, np.int8)

    def vote(name: str, bad, good, enough=True) -> None:
        column = out[:, LABELLERS.index(name)]
        column[good & enough] = GOOD
        column[bad & enough] = BAD

    symbols, bangs, capitals = total(_SYMBOL[codes]) / some, total(_BANG[codes]) / some, total(_UPPER[codes]) / np.maximum(total(~gap), 1)
    vote("symbols", symbols > 0.2, symbols < 0.05, words >= 10)
    vote("capitals", capitals > 0.4, capitals < 0.15, words >= 10)
    vote("variety", variety < 0.25 * words, variety > 0.45 * words, words >= 50)
    vote("function_words", stops < 0.03 * words, stops > 0.10 * words, words >= 30)
    vote("word_length", (size > 7.5) | (size < 3), (size > 3.8) & (size < 6.8), words >= 20)
    vote("exclamations", bangs > 0.3, bangs < 0.05, words >= 10)
    vote("repeated_words", echo * 5 > words, echo * 20 < words, words >= 20)
    vote("repeated_lines", (lines - fresh) * 2 > lines, (lines - fresh) * 20 <= lines, lines >= 3)
    return out


def encode(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ 3 ** np.arange(v.shape[1])


def decode(patterns: np.ndarray, n: int = len(LABELLERS)) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n) % 3


def fit_votes(v: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents and P(vote | class, vote cast) as (class, labeller, vote), from distinct vote rows and counts.

    Starts from the majority vote; labellers are taken as independent given the class, and as better
    than chance together, which fixes which class is which.
    """
    up, down = (v == GOOD).sum(axis=1), (v == BAD).sum(axis=1)
    post = (up + 1) / (up + 2 * down + 2)
    for _ in range(rounds):
        share = (counts * post).sum() / counts.sum()
        table_ = np.zeros((2, v.shape[1], 3))
        for c, w in ((0, counts * (1 - post)), (1, counts * post)):
            for k in (BAD, GOOD):
                table_[c, :, k] = ((v == k) * w[:, None]).sum(axis=0) + 0.5
        table_ /= table_.sum(axis=2, keepdims=True)
        new = posterior(v, share, table_)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return share, table_


def posterior(v: np.ndarray, share: float, table_: np.ndarray) -> np.ndarray:
    """P(good | votes cast). Abstaining says nothing: it depends on the length, not on the class."""
    cast = v != ABSTAIN
    logs = [np.where(cast, np.log(np.where(cast, table_[c][np.arange(v.shape[1]), v], 1.0)), 0.0).sum(axis=1) for c in (0, 1)]
    prior = np.log(share / (1 - share)) if 0 < share < 1 else (60.0 if share else -60.0)
    return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + prior, -60, 60)))


def accuracies(share: float, table_: np.ndarray) -> np.ndarray:
    """Per labeller: chance that a vote, if cast, is right."""
    return share * table_[1, :, GOOD] + (1 - share) * table_[0, :, BAD]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of every byte trigram (over text ends too), where each text's begin, and their numbers."""
    codes, begins = _flat(texts)
    wide = codes.astype(np.uint32)
    h = (wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16) * np.uint32(2654435761)
    return (h >> np.uint32(20)).astype(np.int64) % DIMENSIONS, begins[:-1] - 1, np.diff(begins) - 1


def features(texts: list[str | None]) -> np.ndarray:
    """Square roots of hashed trigram shares. The votes are no features: the scorer learns from the text."""
    tri, begin, n = trigrams(texts)
    out = np.empty((len(texts), DIMENSIONS), np.float32)
    for i, (b, k) in enumerate(zip(begin, n)):
        out[i] = np.bincount(tri[b : b + k], minlength=DIMENSIONS)
        out[i] /= max(1, k)
    return np.sqrt(out, out=out)


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model for soft labels y. Accelerated gradient descent.

    Rows of x have unit norm, so with the bias the curvature is at most 1/2 and steps below 2 converge.
    """
    weight, target = np.float32(1 / len(y)), y.astype(np.float32)
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    for i in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ v, -30, 30)))
        new = v - np.float32(1.9) * (x1.T @ (weight * (p - target)) + np.float32(1e-6) * v)
        v, w = new + np.float32(i / (i + 3)) * (new - w), new
    return w[:-1], float(w[-1])


def _slices(batches: Iterator[pd.DataFrame], rows: int = 256, chars: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Small runs of rows, so that arrays over their bytes stay small."""
    for pdf in batches:
        start = size = 0
        for i, t in enumerate(pdf["text"]):
            size += len(t or "") + 1
            if i + 1 - start >= rows or size >= chars:
                yield pdf.iloc[start : i + 1]
                start, size = i + 1, 0
        if start < len(pdf):
            yield pdf.iloc[start:]


def classify(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, pattern (votes), posterior, score and kept (score of 0.5 or more).

    Null or empty text gets the scorer's verdict on an empty text, all labellers abstaining. Repeated
    rows are judged each, alike. An empty table gives no rows; other columns are ignored. A table whose
    documents all look alike trains no scorer: its scores are the posteriors. Long texts are judged whole.
    """
    rows = docs.select(id_or_none(F.col("doc_id")), "text")

    def patterns(batches):
        for pdf in _slices(batches):
            yield pd.DataFrame({"pattern": encode(votes(pdf["text"].tolist()))})

    seen = rows.select("text").mapInPandas(patterns, "pattern long").groupBy("pattern").agg(F.count("*").alias("n")).toPandas()
    if seen.empty:
        return rows.limit(0).select("doc_id", F.lit(0).cast("long").alias("pattern"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(True).alias("kept"))
    share, table_ = fit_votes(decode(seen["pattern"].to_numpy()), seen["n"].to_numpy())

    def sample(batches):
        for pdf in _slices(batches):
            texts = pdf["text"].tolist()
            yield pd.DataFrame({"p": posterior(votes(texts), share, table_), "x": [f.tobytes() for f in features(texts)]})

    # The bounded sample to fit on: the least hashes. A cut that leaves half as many again goes before the sort;
    # where many rows are alike it may leave too few, and all rows are sorted.
    total = int(seen["n"].sum())
    part = min(0.5, 1.5 * training_rows / total)
    least = F.xxhash64("doc_id", "text")
    for some in [rows.filter(least < -(1 << 63) + int(part * (1 << 64)))] * (part < 0.5) + [rows]:
        chosen = some.orderBy(least, "doc_id", "text").limit(training_rows)
        train = chosen.mapInPandas(sample, "p double, x binary").toPandas()
        if len(train) >= min(training_rows, total):
            break
    x, y = np.frombuffer(b"".join(train["x"]), np.float32).reshape(len(train), -1), train["p"].to_numpy()
    model = fit_scorer(x, y) if y.max() > 0.5 > y.min() else None

    def score(batches):
        for pdf in _slices(batches):
            texts = pdf["text"].tolist()
            v = votes(texts)
            post = posterior(v, share, table_)
            if model is None:
                result = post
            else:
                result = 1 / (1 + np.exp(-np.clip(features(texts) @ model[0] + model[1], -30, 30)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].values, "pattern": encode(v), "posterior": post, "score": result})

    return with_null_ids(rows.mapInPandas(score, "doc_id long, pattern long, posterior double, score double")).withColumn("kept", F.col("score") >= 0.5)


def op7_weak_label_quality(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"))
