"""The other operators against brute force, the tokenizer libraries, and held-out labels."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from uvspark.llm import minhash_join, packing, suffix_dedup, token_counts, weak_label

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def repeats(rows, k=50):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = t.encode()
        for i in range(len(b) - k + 1):
            first.setdefault(b[i : i + k], d)
    out = []
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - k + 1):
            if first[b[i : i + k]] < d:
                gone[i : i + k] = True
        starts = gone & ~np.concatenate([[False], gone[:-1]]) if len(b) else gone
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), int(starts.sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_repeats(spark, docs, odd, empty):
    import random

    rng = random.Random(3)
    parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    made = [(i, "".join(rng.choices(parts, k=rng.randint(1, 6)))) for i in range(60)] + [(100 + i, "ab" * rng.randint(20, 60)) for i in range(6)]
    for df in (spark.createDataFrame(made, "doc_id long, text string"), docs.limit(120)):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, with_bytes=False).collect())
        assert got == repeats(rows)
    out = suffix_dedup.remove_repeats(odd).collect()
    assert len(out) == odd.count() and {r.doc_id: r.n_removed for r in out if r.doc_id is not None}[8] == 0
    assert {r.doc_id: bytes(r.kept) for r in out if r.doc_id is not None}[9] == b""
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("least,broadcast", [(4, 10**6), (4, 0), (10**9, 0)])
def test_repeats_of_a_gram_in_all_documents(spark, least, broadcast, monkeypatch):
    """One gram in every document, with surroundings that differ, or agree on one side, or on both; with hot grams and without."""
    import random

    monkeypatch.setattr(suffix_dedup, "HOT_ANCHORS", least)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_STRINGS", broadcast)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    gram, left, right = " 0000000000000000 ", [word(40) for _ in range(6)], [word(40) for _ in range(6)]
    passage = word(70)
    made = [(i, word(rng.randint(0, 60)) + rng.choice([*left, word(40)]) + gram + rng.choice([*right, word(40)]) + word(30) + passage * (i % 3 == 0) + word(50)) for i in range(400)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(6)
    if least == 4:
        rows = df.selectExpr("doc_id AS doc", "text")
        assert len(suffix_dedup.hot_grams(rows, 50, sum(len(t) for _, t in made), 1.0)) > 3
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, with_bytes=False).collect())
    assert got == repeats(made)


def test_neighbourhoods_alike_in_low_bits_differ():
    """Two neighbourhoods of one gram whose names share all but the highest bits aren't repeats; equal ones are."""
    for high, full in ((1 << 63, 0), (1 << 40, 0), (0, 1)):
        out = []
        for doc, around in ((1, 12345), (2, 12345 + high)):
            box, at = suffix_dedup.Outbox(1), np.array([7])
            box.add([(doc, doc)], np.array([0]), at, at + 3, at + 5, np.array([99], np.uint64), np.array([around], np.uint64))
            out += box.blocks()
        found = suffix_dedup.rank_bucket(pd.concat(out))
        assert (~found["open"]).sum() == full and found["open"].sum() == (0 if full else 2)
        assert found["a"].eq(7).all() and found["b"].eq(10).all() and found["p"].eq(12).all()


def classes(rows, n, percent=80):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize("words,region", [(2, 5000), (5, 5000), (2, 30)])
def test_near_duplicates(spark, docs, words, region, monkeypatch):
    """With a region of 30 documents at most, the planted groups are settled by their nodes."""
    import random

    monkeypatch.setattr(minhash_join, "REGION", region)

    rng = random.Random(words)
    base = [f"t{rng.randint(0, 400)}" for _ in range(120)]
    made = [(10_000 + i, " ".join(f"n{i}q{j}" if rng.random() < 0.03 * (i % 4) else w for j, w in enumerate(base))) for i in range(150)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + made
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df, words).collect()}
    assert got == classes(rows, words)


def pairs_at_threshold(n, words=100, shared=0):
    """2 n texts: pairs of similarity exactly 0.8 in 2-word shingles; all texts begin with `shared` common words."""
    common = [f"c{j}" for j in range(shared)]
    rows = []
    for i in range(n):
        own = [f"p{i}w{j}" for j in range(words - shared)]
        keep = words - shared - 11 * words // 100
        rows += [(2 * i, " ".join(common + own)), (2 * i + 1, " ".join(common + own[:keep] + [f"q{i}w{j}" for j in range(words - shared - keep)]))]
    return rows


@pytest.mark.parametrize("shared,leaf,recall", [(0, 4000, 1.0), (60, 4000, 1.0), (60, 40, 0.99)])
def test_recall_at_the_threshold(spark, shared, leaf, recall, monkeypatch):
    """Measured: pairs of similarity 0.8 that are linked; with leaves so small that all are branched deeper, too."""
    monkeypatch.setattr(minhash_join, "LEAF", leaf)
    rows = pairs_at_threshold(1500, shared=shared)
    out = minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2)
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert all(got[2 * i] == 2 * i and got[2 * i + 1] in (2 * i, 2 * i + 1) for i in range(1500))
    found = sum(got[2 * i + 1] == 2 * i for i in range(1500)) / 1500
    print("recall", shared, leaf, found)
    assert found >= recall


def test_components_with_hot_nodes(spark, monkeypatch):
    """A star, a chain and random trees, with nearly every node broadcast and with none."""
    import random

    rng = random.Random(1)
    edges = [(0, i) for i in range(1, 3000)] + [(5000 + i, 5001 + i) for i in range(60)] + [(7000 + rng.randrange(max(1, i)), 7000 + i) for i in range(1, 400)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    want = {n: min(0 if n < 5000 else 5000 if n < 7000 else 7000, n) for e in edges for n in e if n not in (0, 5000, 7000)}
    for hot in (10**9, 20):
        monkeypatch.setattr(minhash_join, "HOT", hot)
        got = {r.node: r.label for r in minhash_join.components(df).collect()}
        assert got == want


def test_partners_not_met_yet_come_in_later_rounds():
    """Two clusters, close only at one member each, which is not the closest of either at first."""
    rng = np.random.default_rng(6)
    c = minhash_join.COORDS
    base = rng.integers(0, 1 << 16, c).astype(np.uint16)

    def change(of, at):
        out = of.copy()
        out[at] ^= 1
        return out

    # 0..5 one cluster around a, 6..11 another around b; a and b share 90 of 128, the others fewer.
    a, b = base, change(base, slice(0, 38))
    sigs = np.stack([a, *[change(a, slice(60 + 6 * i, 66 + 6 * i)) for i in range(5)], b, *[change(b, slice(90 + 6 * i, 96 + 6 * i)) for i in range(5)]])
    rep, least = np.arange(12), 90
    first = set(zip(*(x.tolist() for x in minhash_join.compare_node(rep, rep, sigs, least, 0))))
    assert not {(0, 6), (6, 0)} & first
    label = np.repeat([0, 6], 6)
    for rank in range(1, minhash_join.ROUNDS):
        assert {(0, 6), (6, 0)} & set(zip(*(x.tolist() for x in minhash_join.compare_node(label, rep, sigs, least, rank))))


def test_pairs_of_leaves_branched_deeper():
    """A pair whose first leaf was branched deeper counts in the next leaf that holds both."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 16, minhash_join.COORDS).astype(np.uint16)
    b = np.where(rng.random(len(a)) < 0.05, a ^ 1, a)
    rows = pd.DataFrame({"rep": [1, 2], "sig": [a.tobytes(), b.tobytes()]})
    leaves = pd.concat(minhash_join.leaf_batches([rows], 8, 3, 0.8))
    both = leaves.groupby("node")["rep"].nunique()
    both = sorted(both.index[both == 2], key=lambda n: (n & minhash_join.TREES, n))
    assert len({n & minhash_join.TREES for n in both}) > 2

    def pairs(node, gone):
        nodes = rows.assign(node=node, label=rows["rep"], deep=False)
        return len(pd.concat(minhash_join.compare_batches([nodes], 86, None, (8, 3, 0.8, np.array(sorted(gone), np.int64)))))

    for k in range(len(both)):
        assert [pairs(n, both[:k]) for n in both[k:]] == [1] + [0] * (len(both) - k - 1)


def test_chance_to_miss_a_link():
    """At the threshold, sketches and trees together miss as few as promised."""
    from math import comb

    least = minhash_join.least_equal(0.8, 5e-7)
    tail = [sum(comb(128, k) * 0.8**k * 0.2 ** (128 - k) for k in range(n)) for n in (least, least + 1)]
    assert tail[0] <= 5e-7 < tail[1]
    assert minhash_join.missed(22, 6, 0.8, least) > 1e-5 and minhash_join.missed(33, 6, 0.8, least) <= 1e-6
    assert minhash_join.missed(33, 6, 0.8, 86) > 2e-4


def test_nodes_with_other_members_have_other_digests(spark):
    from pyspark.sql import functions as F

    # Pairs of ids whose hashes agree in the sum of their lower 40 bits.
    h = spark.range(8000).select((F.xxhash64("id") % (1 << 40)).alias("h")).toPandas()["h"].to_numpy()
    n = len(h) // 2
    sums = (h[:n, None] + h[None, n:]).ravel()
    order = np.argsort(sums)
    k = np.flatnonzero(np.diff(sums[order]) == 0)
    assert len(k)
    rows = [(int(g), int(i)) for g in {*order[k].tolist(), *order[k + 1].tolist()} for i in (g // n, n + g % n)]
    got = spark.createDataFrame(rows, "node long, rep long").groupBy("node").agg(*minhash_join.member_digests())
    assert got.select("members").distinct().count() == got.select("members2").distinct().count() == got.count()


def test_near_duplicates_odd(odd, empty):
    rows = minhash_join.near_duplicates(odd, 2).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert got[9] == 8 and got[10] == 8 and got[16] == 15 and got[17] == 15 and got[1] == 1 and got[5] == 5
    kept = minhash_join.keep_one(odd, 2)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 9 not in ids and 8 in ids and 11 in ids
    assert minhash_join.near_duplicates(empty).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """A doc_id that stands for many texts: each is a document of its own, copies and links across ids hold."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(3, text(i)) for i in range(300)] + [(3, text(0)), (7, text(1)), (8, text(1) + " end"), (9, text(500)), (None, text(2)), (3, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df, 2).collect())
    want = Counter({(3, 39, 3, True): 301, (7, 39, 3, False): 1, (8, 40, 3, False): 1, (9, 39, 9, True): 1, (None, 39, 3, True): 1, (3, 0, 3, True): 1, (5, 0, 5, True): 1})
    assert got == want
    kept = Counter((r.doc_id, r.text) for r in minhash_join.keep_one(df, 2).collect())
    assert kept == Counter([(3, text(i)) for i in range(300)] + [(9, text(500)), (None, text(2)), (3, None), (5, "")])


def packed(df, **capacity):
    return packing.pack_documents(df, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), packing.Capacity(**capacity)).toPandas()


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_packing(name, request):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(name)
    out = packed(df)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in df.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((r.doc_id, i, a, b - a, zlib.crc32(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    got = Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples())
    assert got == want
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 2048
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 2048) * 1.02 + 1


def test_packing_specials_and_empty(spark, empty):
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "Привет мир"), (3, "漢字 and ‘quotes’ – dash")], "doc_id long, text string")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = {int(r.doc_id): r for r in packed(df).itertuples()}
    for r in df.collect():
        ids = np.array([*t.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        assert (out[r.doc_id].length, out[r.doc_id].ids_crc32) == (len(ids), zlib.crc32(ids))
    assert packed(empty).empty


@pytest.mark.parametrize("capacity,longest", [({"tokens": 100}, 100), ({"tokens": 100, "documents": 4, "attention": 3000, "weights": (1, 0.5, 0.5)}, 54), ({"tokens": 100, "documents": 3, "weights": (1, 1, 1), "score": "dot"}, 100)])
def test_packing_plan(capacity, longest):
    rng = np.random.default_rng(5)
    counts = Counter(np.minimum(longest, 1 + rng.exponential(longest / 4, 5000).astype(int)).tolist())
    cap = packing.Capacity(**capacity)
    bins = packing.plan(counts, cap)
    limits = cap.limits()
    assert Counter({k: sum(b.n * b.holds.count(k) for b in bins) for k in counts}) == counts
    for b in bins:
        assert sum(b.holds) <= limits[0] and len(b.holds) <= limits[1] and sum(x * x for x in b.holds) <= limits[2]
    seen = defaultdict(list)
    for b in bins:
        for length, rank in b.places:
            seen[length] += range(rank, rank + b.n)
    assert all(sorted(seen[k]) == list(range(n)) for k, n in counts.items())


def plain_best_fit(lengths, cap):
    """Vector best-fit piece by piece, long ones first: how many bins."""
    limits, bins = cap.limits(), []

    def score(r, need):
        if cap.score == "dot":
            return -sum(w * a / c * n / c for w, a, n, c in zip(cap.weights, r, need, limits))
        return sum(w * ((a - n) / c) ** 2 for w, a, n, c in zip(cap.weights, r, need, limits))

    for length in sorted(lengths, reverse=True):
        need = packing.demand(length)
        fits = [i for i, r in enumerate(bins) if all(a >= n for a, n in zip(r, need))]
        if not fits:
            bins.append(limits)
            fits = [len(bins) - 1]
        best = min(fits, key=lambda i: (score(bins[i], need), bins[i]))
        bins[best] = tuple(a - n for a, n in zip(bins[best], need))
    return len(bins)


@pytest.mark.parametrize("score", ["residual", "dot"])
@pytest.mark.parametrize("capacity", [{}, {"documents": 4}, {"attention": 3500}, {"documents": 5, "attention": 4000}])
def test_packing_plan_against_plain_best_fit(capacity, score):
    """Each capacity binds in turn; the plan over classes of bins needs no more bins than piece by piece, but for a few."""
    rng = np.random.default_rng(8)
    lengths = np.minimum(59, 1 + rng.exponential(18, 1500).astype(int)).tolist()
    for weights in ((1, 0, 0), (1, 0.2, 0.2), (1, 1, 1)):
        cap = packing.Capacity(tokens=100, weights=weights, score=score, **capacity)
        got, want = sum(b.n for b in packing.plan(Counter(lengths), cap)), plain_best_fit(lengths, cap)
        least = max(-(-sum(lengths) // 100), -(-len(lengths) // cap.limits()[1]), -(-sum(x * x for x in lengths) // cap.limits()[2]))
        assert least <= got <= max(want * 1.02 + 2, least * 1.02 + 2)


def test_token_counts(odd, docs, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for df in (odd, docs):
        want = Counter((r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in df.collect())
        out = token_counts.count_tokens(df, P.path("piece_bpe_32k.model"))
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out.collect()) == want
        assert out.filter("over_limit <> (n_tokens > 4096)").isEmpty()
    assert token_counts.count_tokens(empty, P.path("piece_bpe_32k.model")).count() == 0


def test_token_counts_of_hard_texts():
    import random

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    machine = token_counts.Transducer(P.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    texts = ["", " ", "▁", "  a  ", "a" * 3000, "=-" * 999, "\n\n \t\r", "日本語ⵣ😀\x00", "".join(map(chr, range(32, 2500))), "<s></s><unk><0x0A>", "x" * 4000 + " y"]
    texts += ["".join(rng.choices("abcdehilnorst  ▁éß-=", k=rng.randint(1, 900))) for _ in range(60)]
    texts += ["".join(rng.choices("".join(list(machine.scores)[:400]), k=500)) for _ in range(20)]
    assert machine.counts(texts).tolist() == [len(x) for x in sp.encode(texts)]


def test_chunk_maps_compose():
    """Against a plain loop: maps of a random machine, some made for a wrong entry state."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        sizes = rng.integers(1, 12, 5)
        nth = np.concatenate([np.arange(n) for n in sizes])
        exit_, count = rng.integers(0, 2, len(nth)), rng.integers(0, 9, len(nth))
        entry = np.where(rng.random(len(nth)) < 0.8, np.concatenate([[0], exit_[:-1]]), 1 - np.concatenate([[0], exit_[:-1]]))
        start, total = token_counts.compose(nth, entry, exit_, count)
        first = 0
        for i in range(len(nth)):
            first = first if nth[i] and entry[i] == exit_[i - 1] else i
            assert start[i] == first and total[i] == count[first : i + 1].sum()


def test_quality_on_held_out_labels(spark, docs, sf_dir, odd, empty):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    out = weak_label.classify(docs).toPandas()
    assert len(out) == docs.count()
    both = out.merge(labels, on="doc_id")
    good, bad = both[both["quality"] == 1], both[both["quality"] == 0]
    assert good["kept"].mean() > 0.97 and (~bad["kept"]).mean() > 0.75
    assert weak_label.classify(odd).count() == odd.count() and weak_label.classify(empty).count() == 0


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20000) < 0.7
    acc = np.array([0.95, 0.85, 0.75, 0.9])
    v = np.where(rng.random((20000, 4)) < acc, truth[:, None], ~truth[:, None]).astype(np.int8)
    v[rng.random((20000, 4)) < 0.3] = weak_label.ABSTAIN
    seen, counts = np.unique(weak_label.encode(v), return_counts=True)
    share, table = weak_label.fit_votes(weak_label.decode(seen, 4), counts)
    assert abs(share - 0.7) < 0.02 and np.abs(weak_label.accuracies(share, table) - acc).max() < 0.03
