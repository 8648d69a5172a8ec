"""Near-duplicate classes by chosen-path set similarity join.

Documents become sets of word shingles; documents with equal sets stand together from the start. Each
tree branches a set by the values of chosen minwise coordinates: a node picks, by its own hash, one
coordinate and sometimes a second (1 / threshold on average), and a set goes on under its value of
each. Sets that share a leaf node are compared, and independent trees repeat this until the chance to
miss a link at the threshold is below `miss`. Links are confirmed on the full sets.

Nodes never emit all their pairs. A small node is compared exhaustively on sketches and gives a spanning
forest of its close pairs; a node that is too large is branched deeper. Connected close pairs form
regions, so every link lies in one region. A region of bounded size is settled exactly, set against
set, in one task. Larger regions go on by their nodes: in a few rounds each member proposes its closest
partner, then its second closest, links are confirmed and contracted to components, and at last every
close pair across components is confirmed: in the first node of the first tree where both meet that was not
branched deeper, and in every deeper node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, id_or_none, materialize, table, with_null_ids

COORDS = 128
#: Largest node compared exhaustively; deepest extra branching; low bits of a node's key that give its tree.
LEAF, DEEPER, TREES = 4000, 12, 63
#: Largest region settled in one task: documents and characters. Documents and characters of small regions that share a task, on average.
REGION, REGION_CHARS, TOGETHER, TOGETHER_CHARS = 5000, 32_000_000, 2000, 8_000_000
#: Most nodes of a graph that are broadcast for their many edges.
HOT = 2000
#: Most ids that are broadcast to pick texts.
BROADCAST_IDS = 2_000_000
#: Similarity of unrelated texts, and how many of them a set may expect to meet in a leaf: these set the trees' depth.
UNRELATED, CHANCE = 0.04, 0.05
#: Rounds in which every member meets one more close member of another component before all such pairs do.
ROUNDS = 3

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=_U)
_MUL = _RNG.integers(0, 1 << 64, COORDS, dtype=_U) | _U(1)
_ADD = _RNG.integers(0, 1 << 64, COORDS, dtype=_U)
_ROOT = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_ROOT), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer words than a shingle: all as one; none: empty."""
    raw = [(t or "").encode().translate(_LOWER) for t in texts]
    flat = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    begins = 1 + np.cumsum([0, *(len(r) + 1 for r in raw)])
    gap = _GAP[flat]
    first = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    last = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[flat] * _powers(_ROOT, len(flat))[:-1], dtype=_U)])
        word = mix((sums[last] - sums[first]) * _powers(_BACK, len(flat))[first])
        grams = word.copy()
        for j in range(1, words):
            grams = mix(grams[: len(word) - j] * _ROOT + word[j:]) if len(word) > j else grams[:0]
        at = np.searchsorted(first, begins)
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(grams[a : b - words + 1]))
            elif b > a:
                whole = _U(b - a)
                for w in word[a:b]:
                    whole = mix(whole * _ROOT + w)
                out.append(np.array([whole], _U))
            else:
                out.append(np.empty(0, _U))
    return out


def slices(texts: list[str | None], most: int = 1_000_000) -> Iterator[slice]:
    """Runs of texts of about `most` characters, so that arrays over their bytes stay small."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


SETS = "doc_id long, text_id long, n_shingles long, digest binary, sig binary"


def sketch_batches(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    """doc_id, a hash of the text, set size, set digest and the minwise values of COORDS coordinates."""
    for pdf in batches:
        for part in (pdf.iloc[s] for s in slices(pdf["text"].tolist())):
            sets = shingle_sets(part["text"].tolist(), words)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            sigs = np.zeros((len(sets), COORDS), np.uint16)
            if full.size:
                flat, starts = np.concatenate([sets[i] for i in full]), np.cumsum(sizes[full]) - sizes[full]
                with np.errstate(over="ignore"):
                    for k in range(COORDS):
                        sigs[full, k] = mix(np.minimum.reduceat(flat * _MUL[k] + _ADD[k], starts)).astype(np.uint16)
            yield pd.DataFrame({"doc_id": part["doc_id"].values, "text_id": part["text_id"].values, "n_shingles": sizes, "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "sig": [s.tobytes() for s in sigs]})


def choices(keys: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates that nodes branch on: the first, the second, and whether there is a second (1 / threshold - 1 of them)."""
    r = mix(keys)
    one = (r % _U(COORDS)).astype(np.int64)
    two = (one + 1 + ((r >> _U(8)) % _U(COORDS - 1)).astype(np.int64)) % COORDS
    return one, two, (r >> _U(32)).astype(np.float64) / 2.0**32 < 1 / threshold - 1


def child(keys: np.ndarray, coord: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(keys * _ROOT + (coord.astype(_U) << _U(32)) + value)


def branch(keys: np.ndarray, lanes: np.ndarray, sigs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes, one per chosen coordinate. lanes: row of sigs per key."""
    with np.errstate(over="ignore"):
        one, two, again = choices(keys, threshold)
        more = child(keys[again], two[again], sigs[lanes[again], two[again]])
        return np.concatenate([child(keys, one, sigs[lanes, one]), more]), np.concatenate([lanes, lanes[again]])


def root(tree: int) -> np.uint64:
    return mix(np.array([tree + 1], _U))[0]


def leaf_key(keys: np.ndarray, tree: int) -> np.ndarray:
    """Key of a leaf, with the tree in its low bits."""
    return ((keys & ~_U(TREES)) | _U(tree)).view(np.int64)


def leaf_batches(batches: Iterator[pd.DataFrame], trees: int, depth: int, threshold: float) -> Iterator[pd.DataFrame]:
    """(node, rep) of every leaf of every tree."""
    for pdf in batches:
        sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), COORDS)
        reps = pdf["rep"].to_numpy()
        for tree in range(trees):
            lanes = np.arange(len(pdf))
            keys = np.full(len(pdf), root(tree))
            for _ in range(depth):
                keys, lanes = branch(keys, lanes, sigs, threshold)
            yield pd.DataFrame({"node": leaf_key(keys, tree), "rep": reps[lanes]})


def first_meeting(a: np.ndarray, b: np.ndarray, trees: int, depth: int, threshold: float, gone: np.ndarray) -> np.ndarray:
    """Key of the first leaf (by tree, then key) that holds both signatures of each row of a and b and isn't in `gone` (sorted)."""
    out = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    same = a == b
    with np.errstate(over="ignore"):
        for tree in range(trees):
            lanes, keys = left, np.full(len(left), root(tree))
            for _ in range(depth):
                one, two, again = choices(keys, threshold)
                again = again & same[lanes, two]
                first = same[lanes, one]
                keys, lanes = (
                    np.concatenate([child(keys[first], one[first], a[lanes[first], one[first]]), child(keys[again], two[again], a[lanes[again], two[again]])]),
                    np.concatenate([lanes[first], lanes[again]]),
                )
            leaf = leaf_key(keys, tree)
            if len(gone):
                there = gone[np.minimum(np.searchsorted(gone, leaf), len(gone) - 1)] != leaf
                lanes, leaf = lanes[there], leaf[there]
            if len(lanes):
                low = np.full(len(a), np.iinfo(np.int64).max)
                np.minimum.at(low, lanes, leaf)
                met = np.unique(lanes)
                out[met] = low[met]
                left = np.setdiff1d(left, met, assume_unique=True)
    return out


NODES = "node long, rep long, label long, sig binary, deep boolean"


def deeper_batches(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), COORDS)
        keys, lanes = branch(pdf["node"].to_numpy().view(_U), np.arange(len(pdf)), sigs, threshold)
        yield pd.DataFrame({"node": keys.view(np.int64), **{c: pdf[c].to_numpy()[lanes] for c in ("rep", "label", "sig")}, "deep": True})


def compare_node(label: np.ndarray, rep: np.ndarray, sigs: np.ndarray, least: int, rank: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one node, in different components, with close sketches: all, or each member's partners up to a rank.

    Partners that a member met in earlier rounds are first in its order or have joined its component, so one
    more than the earlier ranks always has the first that it hasn't met. Any rank gives a pair if all pairs do.
    """
    low = np.ascontiguousarray(sigs.astype(np.uint8))
    left, right = [], []
    values, counts = np.unique(label, return_counts=True)
    rest = np.flatnonzero(label != values[counts.argmax()]) if counts.max() > 1 else np.arange(len(label))
    for i in rest:
        same = (low == low[i]).sum(axis=1)
        hits = np.flatnonzero((same >= least) & (label != label[i]))
        if rank is not None:
            hits = hits[np.lexsort((rep[hits], -same[hits]))][: rank + 1]
        left.append(np.full(len(hits), i))
        right.append(hits)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def forest(sigs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the close pairs of one node."""
    low = np.ascontiguousarray(sigs.astype(np.uint8))
    part, left, right = np.arange(len(low)), [], []
    for i in range(len(low) - 1):
        hits = i + 1 + np.flatnonzero((low[i + 1 :] == low[i]).sum(axis=1) >= least)
        hits = hits[part[hits] != part[i]]
        for k, j in zip(*np.unique(part[hits], return_index=True)):
            part[part == k] = part[i]
            left.append(i)
            right.append(hits[j])
    return np.array(left, int), np.array(right, int)


def settle(pdf: pd.DataFrame, words: int, percent: int) -> pd.DataFrame:
    """Component labels in whole regions, from their full sets."""
    pdf = pdf.sort_values(["region", "doc_id"], ignore_index=True)
    texts = pdf["text"].tolist()
    sets = [x for s in slices(texts) for x in shingle_sets(texts[s], words)]
    docs, labels = pdf["doc_id"].to_numpy(), pdf["doc_id"].to_numpy().copy()
    edge = np.flatnonzero(np.diff(pdf["region"].to_numpy(), prepend=-1, append=-1) != 0) if len(pdf) else [0]
    edge = [0, *[e for e in edge if 0 < e < len(pdf)], len(pdf)]
    for a, b in zip(edge, edge[1:]):
        sizes = np.array([len(x) for x in sets[a:b]])
        start = np.cumsum(sizes) - sizes
        _, flat = np.unique(np.concatenate(sets[a:b]), return_inverse=True)
        mark, part = np.zeros(flat.max() + 1, np.int64), np.arange(b - a)

        def meet(i: int) -> None:
            mine = flat[start[i] : start[i] + sizes[i]]
            mark[mine] = 1
            both = np.add.reduceat(mark[flat], start)
            mark[mine] = 0
            hits = (100 * both >= percent * (sizes[i] + sizes - both)) & (part != part[i])
            for k in np.unique(part[hits]):
                part[part == max(k, part[i])] = min(k, part[i])

        # Of two documents in different components one lies outside of the largest: when only members of
        # the largest haven't met all others, every pair across components has been compared.
        unmet = list(range(b - a))
        while True:
            before, left = len(unmet), []
            for i in unmet:
                if part[i] == np.bincount(part).argmax():
                    left.append(i)
                else:
                    meet(i)
            unmet = left
            if len(unmet) == before:
                break
        labels[a:b] = docs[a + part]
    return pd.DataFrame({"node": docs, "label": labels})


def compare_batches(batches: Iterator[pd.DataFrame], least: int, rank: int | str | None, trees: tuple[int, int, float, np.ndarray] | None) -> Iterator[pd.DataFrame]:
    """Close pairs (node, a, b) in different components of one node; rows come sorted by node.

    With "forest", nodes of more than 8 members give a spanning forest; with a rank, they give the closest partners per member, up to it; else every pair comes once over all nodes that were not branched deeper, and in each deeper one.
    """
    rest = None

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        node, rep, label, deep = (pdf[c].to_numpy() for c in ("node", "rep", "label", "deep"))
        sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), COORDS)
        start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff([*start, len(node)])
        found = []
        for k in np.flatnonzero(size > 8):
            s = slice(start[k], start[k] + size[k])
            a, b = forest(sigs[s], least) if rank == "forest" else compare_node(label[s], rep[s], sigs[s], least, rank)
            found.append((a + start[k], b + start[k]))
        small = np.repeat(size <= 8, size)
        for step in range(1, min(8, len(node))):
            a = np.flatnonzero((node[step:] == node[:-step]) & small[step:] & (label[step:] != label[:-step]))
            for at in range(0, len(a), 50_000):
                x = a[at : at + 50_000]
                x = x[(sigs[x] == sigs[x + step]).sum(axis=1) >= least]
                found.append((x, x + step))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int),) * 2
        a, b = np.where(rep[a] < rep[b], a, b), np.where(rep[a] < rep[b], b, a)
        if len(a):
            once = np.unique(np.stack([a, b]), axis=1)
            a, b = once
        if rank is None:
            keep = [deep[a[x]] | (first_meeting(sigs[a[x]], sigs[b[x]], *trees) == node[a[x]]) for x in (slice(i, i + 20_000) for i in range(0, len(a), 20_000))]
            keep = np.concatenate(keep) if keep else np.empty(0, bool)
            a, b = a[keep], b[keep]
        return pd.DataFrame({"node": node[a], "a": rep[a], "b": rep[b]})

    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        done = int((pdf["node"].to_numpy() != pdf["node"].iloc[-1]).sum())
        rest = pdf.iloc[done:]
        if done:
            yield pairs(pdf.iloc[:done])
    if rest is not None and len(rest):
        yield pairs(rest)


def confirm_batches(batches: Iterator[pd.DataFrame], words: int, percent: int) -> Iterator[pd.DataFrame]:
    """Pairs (a, b) whose full sets reach the similarity."""
    get = lru_cache(maxsize=64)(lambda text: shingle_sets([text], words)[0])
    for pdf in batches:
        keep = []
        for ta, tb in zip(pdf["ta"], pdf["tb"]):
            sa, sb = get(ta), get(tb)
            if 100 * min(len(sa), len(sb)) < percent * max(len(sa), len(sb)):
                keep.append(False)
                continue
            both = len(np.intersect1d(sa, sb, assume_unique=True))
            keep.append(100 * both >= percent * (len(sa) + len(sb) - both))
        yield pdf.loc[keep, ["a", "b"]]


def join_least(edges: DataFrame, low: DataFrame, rows: int) -> DataFrame:
    """edges (u, v) with m of low (u, n: edges of u, m). A node of very many edges doesn't go to one task.

    Nodes of more than a HOT-th of all `rows` edges (at least 64) are at most HOT; they are broadcast, and
    their edges stay where they are. The others are joined by key.
    """
    most = max(64, rows // HOT)
    hot = F.broadcast(low.filter(F.col("n") > most).select(F.col("u").alias("_hot"), "m"))
    marked = edges.join(hot, F.col("u") == F.col("_hot"), "left")
    cold = marked.filter("_hot IS NULL").select("u", "v").join(low.filter(F.col("n") <= most).select("u", "m"), "u")
    return marked.filter("_hot IS NOT NULL").select("u", "v", "m").unionByName(cold.select("u", "v", "m"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): label is the least node reachable. Large-star, small-star."""
    edges = checkpoint(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = seen = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_least(both.filter("v > u"), low, 2 * state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = checkpoint(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_least(large, low, state[0])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = checkpoint(small)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state


def member_digests() -> list[Column]:
    """Two 64-bit digests of the members `rep` of a group."""
    return [F.bit_xor(F.xxhash64("rep")).alias("members"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("members2")]


def _survival(depth: int, p: float, threshold: float) -> float:
    """Chance that a pair sharing each coordinate with chance p meets in a leaf of one tree."""
    lost, more = 0.0, 1 / threshold - 1
    for _ in range(depth):
        y = 1 - p + p * lost
        lost = (1 - more) * y + more * y * y
    return 1 - lost


def _equal(n: int, p: float) -> float:
    """Chance that n of COORDS coordinates are equal."""
    return math.comb(COORDS, n) * p**n * (1 - p) ** (COORDS - n)


def least_equal(threshold: float, miss: float) -> int:
    """Most equal coordinates that a pair at the threshold falls short of with a chance of at most `miss`."""
    least, tail = 0, _equal(0, threshold)
    while tail <= miss:
        least += 1
        tail += _equal(least, threshold)
    return least


def missed(trees: int, depth: int, threshold: float, least: int) -> float:
    """Chance that a pair at the threshold has too few equal coordinates, or meets in no tree by those it has: trees share them."""
    return sum(_equal(n, threshold) * (1.0 if n < least else (1 - _survival(depth, n / COORDS, threshold)) ** trees) for n in range(COORDS + 1))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose shingle sets have a Jaccard similarity of percent / 100 or more are linked;
    component_id is the least doc_id reachable, kept whether that is the document itself. Null, empty or
    blank text has an empty set and no links; long texts count whole. Repeated rows are copies of each other;
    rows of one doc_id with different texts are documents of their own. One without doc_id has no links
    (but the class of its exact copies). An empty table gives no rows; other columns are ignored.
    """
    return classes(docs, words, percent, miss).select("doc_id", "n_shingles", "component_id", "kept")


def by_texts(docs: DataFrame, sets: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """classes where a doc_id stands for several texts: the texts are joined, each once, and the classes found are named by their least doc_id."""
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").groupBy(F.xxhash64("text").alias("doc_id")).agg(F.min("text").alias("text"))
    found = classes(materialize(texts), words, percent, miss).select(F.col("doc_id").alias("text_id"), F.col("component_id").alias("class"))
    # Texts of one set are of one class, also those of rows without doc_id.
    by_set = sets.filter("doc_id IS NOT NULL").select("digest", "text_id").distinct().join(found, "text_id").groupBy("digest").agg(F.min("class").alias("class"))
    rows = materialize(sets.select("doc_id", "text_id", "n_shingles", "digest").join(by_set, "digest", "left").drop("digest"))
    least = rows.groupBy("class").agg(F.min("doc_id").alias("_least"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce("_least", "doc_id")).otherwise(F.col("doc_id"))
    rows = rows.join(least, "class", "left").withColumn("component_id", component)
    return rows.select("doc_id", "text_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"), "class")


def classes(docs: DataFrame, words: int, percent: int, miss: float = 1e-6) -> DataFrame:
    """near_duplicates with text_id (a hash of the text) and class (equal for documents of one class) beside."""
    threshold = percent / 100
    texts = docs.select(id_or_none(F.col("doc_id")), "text", F.xxhash64("text").alias("text_id"))
    sets = with_null_ids(materialize(texts.mapInPandas(lambda it: sketch_batches(it, words), SETS)))
    kinds = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("lo"), F.max(F.xxhash64("digest")).alias("hi"))
    if not kinds.filter("lo < hi").isEmpty():  # a doc_id stands for several sets
        return by_texts(docs, sets, words, percent, miss)
    reps = sets.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig"))
    reps = materialize(reps.filter("rep IS NOT NULL"))
    total = max(2, reps.count())
    depth = max(2, math.ceil(math.log(total / CHANCE) / -math.log(UNRELATED)))
    least = least_equal(threshold, miss / 2)
    trees = next((n for n in range(1, TREES + 2) if missed(n, depth, threshold, least) <= miss), 0)
    if not trees:
        raise ValueError(f"{TREES + 1} trees miss more than {miss} of the pairs at {percent} %")

    leaves = reps.select("rep", "sig").mapInPandas(lambda it: leaf_batches(it, trees, depth, threshold), "node long, rep long")
    shared = leaves.groupBy("node").agg(F.count("*").alias("size"), *member_digests()).filter("size > 1")
    # Of nodes with the same members the first stays.
    shared = shared.groupBy("size", "members", "members2").agg(F.min(F.struct(F.col("node").bitwiseAND(F.lit(TREES)).alias("tree"), "node")).alias("_n")).select("_n.node", "size")
    nodes = leaves.join(shared, "node").join(reps.select("rep", "sig"), "rep")
    open_ = nodes.select("node", "rep", F.col("rep").alias("label"), "sig", F.lit(False).alias("deep"), "size")
    flat = None
    for step in range(DEEPER + 1):
        open_ = materialize(open_)
        ready = (open_ if step == DEEPER else open_.filter(F.col("size") <= LEAF)).drop("size")
        flat = ready if flat is None else flat.union(ready)
        large = open_.filter(F.col("size") > LEAF).drop("size", "deep")
        if step == DEEPER or large.isEmpty():
            deeper = step > 0
            break
        down = materialize(large.mapInPandas(lambda it: deeper_batches(it, threshold), NODES))
        open_ = down.join(down.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "node")

    by_node = flat.repartition("node").sortWithinPartitions("node")
    near = by_node.mapInPandas(lambda it: compare_batches(it, least, "forest", None), PAIRS)
    near = materialize(near.select("a", "b").distinct())
    regions = components(near).select(F.col("node").alias("doc_id"), F.col("label").alias("region"))
    regions = materialize(regions.union(regions.select("region", "region").distinct()).distinct())
    ids = regions.count()
    # Broadcast behind a check of the size; else the texts are shuffled.
    keyed = F.broadcast(regions) if ids <= BROADCAST_IDS else regions
    needed = materialize(texts.drop("text_id").join(keyed, "doc_id").dropDuplicates(["doc_id"]))
    sizes = needed.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    small = sizes.select("region", ((F.col("n") <= REGION) & (F.col("chars") <= REGION_CHARS)).alias("small"), (F.col("chars") > TOGETHER_CHARS).alias("alone"))
    needed = needed.join(small, "region")
    chars = sizes.agg(F.sum(F.when(F.col("chars") <= TOGETHER_CHARS, F.col("chars")))).first()[0] or 0
    tasks = max(1, ids // TOGETHER, chars // TOGETHER_CHARS)
    # Regions of many characters have a task's group to themselves; the others share by hash.
    bucket = F.when(F.col("alone"), -1 - F.col("region")).otherwise(F.pmod(F.xxhash64("region"), F.lit(tasks)))
    found = needed.filter("small").withColumn("bucket", bucket).groupBy("bucket").applyInPandas(lambda pdf: settle(pdf, words, percent), "node long, label long")
    found = materialize(found)
    rest = needed.filter("NOT small").select("doc_id", "text")
    if not rest.isEmpty():
        rest = materialize(rest)
        flat = flat.join(rest.select(F.col("doc_id").alias("rep")), "rep", "left_semi")
        # Nodes branched deeper hold no pair any more, nor do those that had the same members: at most one for every LEAF rows.
        deepened = leaves.groupBy("node").agg(F.count("*").alias("size")).filter(F.col("size") > LEAF).select("node").collect() if deeper else []
        gone = np.array(sorted(r["node"] for r in deepened), np.int64)
        found = found.union(by_nodes(flat, rest, least, (trees, depth, threshold, gone), words, percent))

    rep_of = reps.select("digest", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("_label"))
    rows = sets.join(rep_of, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("_label", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), component.alias("class"))


PAIRS = "node long, a long, b long"


def by_nodes(flat: DataFrame, texts: DataFrame, least: int, trees: tuple[int, int, float, np.ndarray], words: int, percent: int) -> DataFrame:
    """(node, label) of all links between members of the nodes, in rounds."""
    tried = links = None
    for rank in [*range(ROUNDS), None]:
        by_node = flat.repartition("node").sortWithinPartitions("node")
        close = materialize(by_node.mapInPandas(lambda it, rank=rank: compare_batches(it, least, rank, trees), PAIRS))
        new = close.select("a", "b").distinct()
        new = materialize(new if tried is None else new.join(tried, ["a", "b"], "left_anti"))
        if tried is None or not new.isEmpty():
            tried = new if tried is None else tried.union(new)
            good = materialize(confirm(new, texts, words, percent))
            links = good if links is None else links.union(good)
            found = components(links)
        if rank is None:
            break
        # Nodes without a close pair are done; the others go on with the components found.
        flat = materialize(mixed(relabel(flat.drop("label").join(close.select("node").distinct(), "node"), found)))
        if flat.isEmpty():
            break
    return found


def relabel(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """nodes with the component of each `rep` as `label`."""
    return nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def mixed(nodes: DataFrame) -> DataFrame:
    """The rows of nodes that hold several components."""
    some = nodes.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("node")
    return nodes.join(some, "node", "left_semi")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of doc_ids linked on their full sets."""
    left, right = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInPandas(lambda it: confirm_batches(it, words, percent), "a long, b long")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document, the least doc_id, of each class, all columns as they are.

    Rows of a class that repeat its least doc_id become one: the least by text and then the other columns.
    Rows without doc_id all stay, as do null, empty and blank texts. An empty table stays empty.
    """
    rows = materialize(classes(docs, words, percent).select("doc_id", "text_id", "kept", "class"))
    gone = rows.filter("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text")).distinct()
    if gone.count() <= BROADCAST_IDS:  # else the documents are shuffled
        gone = F.broadcast(gone)
    out = docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__text")), "left_anti")
    known = rows.filter("kept AND doc_id IS NOT NULL")
    if known.groupBy("doc_id", "class").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return out
    row = F.struct("text", *[F.col(c) for c in docs.columns if c != "text"])
    of = known.select(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text"), F.col("class").alias("__class")).distinct()
    one = out.join(of, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__text"))).groupBy("__id", "__class").agg(F.min(row).alias("__row")).select("__row.*").select(*docs.columns)
    return one.unionByName(out.filter("doc_id IS NULL"))


def op4_chosen_path_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM pr JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""
