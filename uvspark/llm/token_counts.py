"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

A merge-by-score tokenizer cuts a text so that its last token, at any place, is the one token ending
there that may follow the last token at its own start: two tokens may be neighbours if their joined
string alone is cut into just these two. Tokens have bounded length, so what later characters can ask
about the past is bounded: the suffix that may still grow into a token, and the last token (with the
relative count) at each place in it. That is a deterministic transducer; its transitions carry the
change of the emitted-token count. It is compiled as the texts ask for it.

Long texts are cut into chunks that run side by side. A chunk's map sends entry states to exit states
and counts; it is made at first for the one entry state that a short look-back gives. A prefix scan
composes the maps of each text's chunks in a logarithmic number of rounds. Where two maps don't meet,
the later is made anew for the state that comes in, and the scan is repeated.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_or_none, table, with_null_ids

SPACE = "▁"
CHUNK, LOOK_BACK = 256, 24
#: Characters stepped at once, and states kept before the tables start anew.
SLICE, MOST_STATES = 2_000_000, 250_000
START = 0


class Transducer:
    """Counts the tokens a sentencepiece BPE model with byte fallback gives, identity-normalised with a leading space."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in ids}
        self.prefixes = {p[:k] for p in self.scores for k in range(1, len(p))}
        self.inner = {p[k : k + 2] for p in self.scores for k in range(len(p) - 1)}
        self.chars = sorted({c for p in self.scores for c in p})
        if any(c not in self.scores for c in self.chars):
            raise ValueError("a character of a piece is no piece itself")
        # Classes: 0 unused, 1 to 4 unknown characters by bytes, then the known ones.
        self.cls = np.ones(0x110000, np.int32)
        for least, n in ((0x80, 2), (0x800, 3), (0x10000, 4)):
            self.cls[least:] = n
        for i, c in enumerate(self.chars):
            self.cls[ord(c)] = 5 + i
        self.cls[ord(" ")] = self.cls[ord(SPACE)]
        self.width = 5 + len(self.chars)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the compiled states."""
        self.states = [("", ((None, 0),))]
        self.index = {self.states[0]: START}
        self.bits = 16
        self.used = 0
        self.keys, self.next, self.step = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)

    def cut(self, text: str) -> list[str]:
        """Tokens of a short string without unknown characters, by merging the best-scored pair, leftmost first."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (score := self.scores.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def may_follow(self, left: str | None, right: str) -> bool:
        key = (left or "", right)
        if key not in self.pairs:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            self.pairs[key] = self.cut(key[0] + right) == ([left, right] if left else [right])
        return self.pairs[key]

    def compile(self, state: int, cls: int) -> tuple[int, int]:
        """Transition of a state on a character class: next state, change of the token count."""
        if cls < 5:
            return START, cls
        c = self.chars[cls - 5]
        suffix, past = self.states[state]
        if past[0][0] and past[0][0][-1] + c not in self.inner:
            suffix, past = "", ((None, 0),)  # no token spans this pair: what follows is cut on its own
        for d in range(len(suffix), -1, -1):
            token = suffix[len(suffix) - d :] + c
            if past[d] is not None and token in self.scores and self.may_follow(past[d][0], token):
                break
        else:
            raise AssertionError("no token may end here")
        delta = past[d][1] + 1
        grown = suffix + c
        while grown and grown not in self.prefixes:
            grown = grown[1:]
        kept: list = [(token, 0)]
        for d in range(1, len(grown) + 1):
            at = past[d - 1]
            kept.append((at[0], at[1] - delta) if at is not None and grown[len(grown) - d :] in self.prefixes else None)
        new = (grown, tuple(kept))
        if new not in self.index:
            self.index[new] = len(self.states)
            self.states.append(new)
        return self.index[new], delta

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(-7046029254386353131)) >> np.int64(20)) & np.int64((1 << self.bits) - 1)

    def _insert(self, key: int, to: int, delta: int) -> None:
        if 3 * self.used > (1 << self.bits):
            old = [(int(k), int(n), int(s)) for k, n, s in zip(self.keys, self.next, self.step) if k >= 0]
            self.bits, self.used = self.bits + 2, 0
            self.keys, self.next, self.step = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)
            for entry in old:
                self._insert(*entry)
        at = int(self._slots(np.array([key], np.int64))[0])
        while self.keys[at] >= 0:
            at = (at + 1) & ((1 << self.bits) - 1)
        self.keys[at], self.next[at], self.step[at] = key, to, delta
        self.used += 1

    def advance(self, state: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of many lanes: next states and count changes."""
        key = state.astype(np.int64) * self.width + cls
        while True:
            at = self._slots(key)
            seen = self.keys[at]
            odd = np.flatnonzero(seen != key)
            missing = []
            while odd.size:  # linear probing
                empty = self.keys[at[odd]] < 0
                missing.append(odd[empty])
                odd = odd[~empty]
                at[odd] = (at[odd] + 1) & ((1 << self.bits) - 1)
                odd = odd[self.keys[at[odd]] != key[odd]]
            new = np.unique(key[np.concatenate(missing)]) if missing else ()
            if not len(new):
                return self.next[at], self.step[at]
            for k in new.tolist():
                self._insert(k, *self.compile(*divmod(k, self.width)))

    def run(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run lanes [begin, end) of codes from entry states: exit states and counts."""
        order = np.argsort(begin - end, kind="stable")  # longest first: the active lanes are a prefix
        b, lengths = begin[order], (end - begin)[order]
        state, count = entry[order].copy(), np.zeros(len(order), np.int64)
        active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        for i, n in enumerate(active.tolist()):
            state[:n], step = self.advance(state[:n], codes[b[:n] + i])
            count[:n] += step
        exit_, total = np.empty_like(state), np.empty_like(count)
        exit_[order], total[order] = state, count
        return exit_, total

    def counts(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts."""
        if len(self.states) > MOST_STATES:
            self.reset()
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        flat = "".join(SPACE + t for t in texts if t)
        codes = self.cls[np.frombuffer(flat.encode("utf-32-le"), "<u4")]
        first = np.cumsum(lengths) - lengths
        chunks = -(-lengths // CHUNK)
        doc = np.repeat(np.arange(len(texts)), chunks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = first[doc] + nth * CHUNK
        end = np.minimum(begin + CHUNK, (first + lengths)[doc])
        look = np.maximum(begin - LOOK_BACK, first[doc])
        entry, _ = self.run(codes, look, begin, np.zeros(len(doc), np.int32))
        exit_, count = self.run(codes, begin, end, entry)
        while True:
            start, total = compose(nth, entry, exit_, count)
            wrong = np.unique(start[nth[start] > 0])
            if not wrong.size:
                break
            entry[wrong] = exit_[wrong - 1]
            exit_[wrong], count[wrong] = self.run(codes, begin[wrong], end[wrong], entry[wrong])
        out = np.zeros(len(texts), np.int64)
        last = np.flatnonzero(np.diff(doc, append=-1))
        out[doc[last]] = total[last]
        return out


def compose(nth: np.ndarray, entry: np.ndarray, exit_: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix scan over chunk maps (nth: place in the text): per chunk, the first chunk and the count of the longest composed map that ends in it.

    Two maps compose if the exit state of the first is the entry state of the second. Each round composes
    every map with the one that ends before it, so that spans double.
    """
    start, total = np.arange(len(nth)), count.copy()
    open_ = np.zeros(len(nth), bool)  # what ends before composes with it
    open_[1:] = (nth[1:] > 0) & (entry[1:] == exit_[:-1])
    while (at := np.flatnonzero(open_)).size:
        left = start[at] - 1
        total[at], start[at], open_[at] = total[at] + total[left], start[left], open_[left]
    return start, total


_COMPILED: dict[str, Transducer] = {}


def count_batches(batches: Iterator[pd.DataFrame], model_file: str) -> Iterator[pd.DataFrame]:
    if model_file not in _COMPILED:
        _COMPILED[model_file] = Transducer(model_file)
    machine = _COMPILED[model_file]
    for pdf in batches:
        texts, out, slice_, size = pdf["_text"].tolist(), [], [], 0
        for t in texts:
            slice_.append(t)
            size += len(t)
            if size >= SLICE:
                out.append(machine.counts(slice_))
                slice_, size = [], 0
        out.append(machine.counts(slice_))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"], "n_tokens": np.concatenate(out)})


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than limit tokens).

    Null text counts as empty: no bytes, no tokens. Long texts are counted whole. Repeated rows are counted each; an empty table
    gives no rows; other columns are ignored. The model file must be readable on the executors.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(id_or_none(F.col("doc_id")), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    counted = rows.mapInPandas(lambda it: count_batches(it, model_file), "doc_id long, n_bytes long, n_tokens long")
    return with_null_ids(counted).withColumn("over_limit", F.col("n_tokens") > limit)


def op9_transducer_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
