"""Vector best-fit packing of token pieces into sequences.

A piece's demand is (tokens, 1 document, attention cost = tokens squared); a bin has a capacity in
each. The next piece goes to the bin that takes it under every constraint and scores best: largest
weighted dot-product of demand and residual, or least weighted norm of the residual left. Pieces go
from long to short. Demand depends on the length alone, and bins with equal residuals are alike, so
the plan is made from the histogram of lengths over classes of bins: its size depends on the token
capacity, not on the number of documents. Pieces then find their place by their rank in their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_or_none, materialize, table, with_global_rank, with_null_ids


@dataclass(frozen=True)
class Capacity:
    """Of one bin. Weights are for the score, over tokens, documents and attention cost.

    By default only the tokens bind, so that there are as few sequences as can be: a full piece takes all
    of the attention cost that a sequence may have, and a limit of documents would leave tokens unused.
    """

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.2, 0.2)
    score: str = "residual"  # or "dot"

    def limits(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.attention or self.tokens**2


@dataclass
class Bins:
    """`n` bins alike: residual capacities and the lengths they hold, in order; `first` is the first one's number."""

    n: int
    residual: tuple[int, int, int]
    holds: tuple[int, ...] = ()
    places: list = field(default_factory=list)  # per held piece: (length, first rank in that length)
    first: int = 0


def demand(length: int) -> tuple[int, int, int]:
    return length, 1, length * length


def plan(histogram: dict[int, int], capacity: Capacity = Capacity()) -> list[Bins]:
    """Bin classes for pieces by length. Raises ValueError if a piece alone breaks a constraint."""
    limits = capacity.limits()
    open_: dict[tuple[int, int, int], list[Bins]] = defaultdict(list)
    closed: list[Bins] = []
    least = min(histogram, default=1)

    def score(residual, need) -> float:
        if capacity.score == "dot":
            return -sum(w * r / c * n / c for w, r, n, c in zip(capacity.weights, residual, need, limits))
        return sum(w * ((r - n) / c) ** 2 for w, r, n, c in zip(capacity.weights, residual, need, limits))

    def put(bins: Bins) -> None:
        tight = any(r < n for r, n in zip(bins.residual, demand(least)))
        (closed if tight or not bins.n else open_[bins.residual]).append(bins)

    for length in sorted(histogram, reverse=True):
        need, left, rank = demand(length), histogram[length], 0
        if any(n > c for n, c in zip(need, limits)):
            raise ValueError(f"a piece of {length} tokens breaks a capacity")
        while left:
            fits = [r for r in open_ if all(a >= b for a, b in zip(r, need))]
            if fits:
                best = min(fits, key=lambda r: (score(r, need), r))
                bins = open_[best].pop()
                if not open_[best]:
                    del open_[best]
                each = 1
            else:
                # New bins, each filled with as many of this length as it takes before the next is opened.
                each = min(c // n for c, n in zip(limits, need))
                each = min(each, left)
                bins = Bins(max(1, left // each), limits)
            n = min(bins.n, left // each)
            if n < bins.n:
                put(Bins(bins.n - n, bins.residual, bins.holds, [(k, r + n) for k, r in bins.places]))
            places = bins.places + [(length, rank + i * n) for i in range(each)]
            put(Bins(n, tuple(r - each * d for r, d in zip(bins.residual, need)), bins.holds + (length,) * each, places))
            rank += n * each
            left -= n * each
    closed += [b for group in open_.values() for b in group]
    first = 0
    for bins in closed:
        bins.first, first = first, first + bins.n
    return closed


def segments(bins: list[Bins]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length: (first rank, number of the first sequence, offset in it), by rank."""
    out = defaultdict(list)
    for b in bins:
        at = 0
        for length, rank in b.places:
            out[length].append((rank, b.first, at))
            at += length
    return {k: sorted(v) for k, v in out.items()}


_ENCODERS: dict = {}


def encoder(model_file: str, ranks_file: str | None):
    """Function from texts to lists of ids, as the tokenizers file gives them without added specials.

    ranks_file holds the same vocabulary for a faster library; it serves texts within Latin and common
    punctuation, where both cut words alike. Others, texts that the faster library refuses, and all if it
    is None, go to tokenizers.
    """
    key = (model_file, ranks_file)
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(model_file)
        slow.no_truncation()
        slow.no_padding()
        fast = None
        if ranks_file:
            import base64
            import re

            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            specials = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)
            odd = re.compile("[^\t-\r\x20-\x7e¡-ɏ‐-‧€]")

        def encode(texts: list[str]) -> list[list[int]]:
            out: list = [None] * len(texts)
            rest = []
            for i, t in enumerate(texts):
                if fast is not None and not odd.search(t):
                    try:
                        out[i] = fast.encode(t, allowed_special="all")
                    except ValueError:  # its pattern gives up on white space of many thousand characters
                        rest.append(i)
                else:
                    rest.append(i)
            for i, e in zip(rest, slow.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
            return out

        _ENCODERS[key] = encode
    return _ENCODERS[key]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def cut_batches(batches: Iterator[pd.DataFrame], model_file: str, ranks_file: str | None, tokens: int) -> Iterator[pd.DataFrame]:
    encode = encoder(model_file, ranks_file)
    for pdf in batches:
        docs, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
        for at in range(0, len(texts), 256):
            rows = []
            for doc, ids in zip(docs[at : at + 256], encode(texts[at : at + 256])):
                ids = np.array([*ids, 0], "<u4")
                cuts = [0, *range(len(ids) % tokens or tokens, len(ids) + 1, tokens)]
                rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])


def pack_documents(docs: DataFrame, model_file: str, ranks_file: str | None = None, capacity: Capacity = Capacity()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with id 0, so null or empty text is one piece of one token. Documents longer
    than a sequence are cut into full pieces, the first taking the rest; texts of any length are tokenized
    whole. Pieces of one length are dealt in order of doc_id, piece and ids; rows equal in these are interchangeable.
    Repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = capacity.tokens
    rows = docs.select(id_or_none(F.col("doc_id")), F.coalesce("text", F.lit("")).alias("text"))
    pieces = rows.mapInPandas(lambda it: cut_batches(it, model_file, ranks_file, tokens), PIECES)
    pieces = materialize(pieces)  # the texts are read and cut once
    ranked = with_global_rank(pieces, [F.col("length"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")])
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length, at most `tokens`
    firsts, total = {}, 0
    for length in sorted(histogram):
        firsts[length], total = total, total + histogram[length]
    found = spark.sparkContext.broadcast((firsts, segments(plan(histogram, capacity))))  # grows with `tokens`, not the input

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, segs = found.value
        for pdf in batches:
            sequence, offset = [], []
            for length, rank in zip(pdf["length"].tolist(), pdf["rank"].tolist()):
                rank -= first[length]
                start, number, at = segs[length][bisect.bisect_right(segs[length], (rank, 1 << 62, 0)) - 1]
                sequence.append(number + rank - start)
                offset.append(at)
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    out = ranked.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "rank")
    return with_null_ids(out.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))


def op5_vector_best_fit(spark, sf_dir):
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
