"""Operators in DataFrame functions alone: secret scan, syncmers, mixing, rule ledger, sharding."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from uvspark.llm import mixing, rule_ledger, secret_scan, sharding, syncmers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24])


def python_free(df):
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_secrets_base(name, request):
    docs = request.getfixturevalue(name)
    out = secret_scan.scan(docs)
    assert python_free(out)
    want = Counter((r.doc_id, tuple(base_spans(r.text))) for r in docs.collect())
    got = Counter((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.base)) for r in out.collect())
    assert got == want


def test_secrets_random_tokens_but_not_prose(spark):
    import random

    rng = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(chars) for _ in range(40)) for _ in range(20)]
    plain = ["internationalization2024 is a long word", "SomeVeryLongClassNameForTesting2 here", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzZ1", "thedingtheringandtheothersofthe2Th"]
    df = spark.createDataFrame([(i, f"see {k} now") for i, k in enumerate(keys)] + [(100 + i, t) for i, t in enumerate(plain)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.scan(df).collect()}
    assert sum([(s.start, s.end) for s in got[i]] == [(4, 44)] for i in range(20)) >= 19
    assert not any(got[100 + i] for i in range(4))


def test_secrets_joined_to_names(spark):
    import random

    rng = random.Random(5)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = [("AWS_SECRET_ACCESS_KEY=", alnum + "+/", ""), ("auth=", alnum, ""), ("https://host.example/a?sig=", alnum, "&v=1"), ("/path_x/", alnum, ""), ("/static/files/", alnum + "-_", " end"), ("id_user-name/", alnum, "=="), ("export MY_VALUE=", alnum + "+/", "=\n")]
    rows, want = [], {}
    for i in range(10):
        for k, (before, chars, after) in enumerate(frames):
            key = "".join(rng.choice(alnum) for _ in range(2)) + "".join(rng.choice(chars) for _ in range(46)) + "7aZ"
            rows.append((10 * i + k, f"run {before}{key}{after}"))
            want[10 * i + k] = (4 + len(before), 4 + len(before) + len(key))
    plain = ["/usr/share/Documents_of-the/Second2-Internationalization_notes", "see SOME_VERY_LONG_SETTING_NAME=another-long-value-of-words2Here", "a_b/thedingtheringandtheothersofthe2Th"]
    df = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(plain)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.scan(df).collect()}
    for k in range(len(frames)):
        assert sum(any(s.start <= want[d][0] and want[d][1] <= s.end for s in got[d]) for d in want if d % 10 == k) >= 9
    for spans in got.values():
        assert all(a.end <= b.start for a, b in zip(spans, spans[1:]))
    assert not any(got[1000 + i] for i in range(len(plain)))


def battery_of(token):
    """Brute force: (combined p-value against uniform, number of symbols, likelihood ratio to prose), or None without an encoding."""
    for _, alphabet, pattern in secret_scan.ENCODINGS:
        if re.search(pattern, token):
            break
    else:
        return None
    x = [alphabet.index(c) for c in token.rstrip("=")]
    n, size = len(x), len(alphabet)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi, df = sum(v * v for v in Counter(x).values()) * size / n - n, size - 1
    cells = tail((math.cbrt(chi / df) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = [2 * v >= size for v in x]
    n1, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    n0 = n - n1
    var = 2 * n0 * n1 * (2 * n0 * n1 - n) / (n * n * (n - 1))
    p_runs = 2 * tail(abs(runs - 2 * n0 * n1 / n - 1) / math.sqrt(var)) if var > 0 else 0.0
    c = [v - (size - 1) / 2 for v in x]
    p_serial = 2 * tail(abs(sum(a * b for a, b in zip(c, c[1:]))) / sum(a * a for a in c) * math.sqrt(n))
    prose = sum(math.log(1 / size) - secret_scan._prose_log(alphabet[v]) for v in x)
    return min(1.0, 3 * min(cells, p_runs, p_serial)), n, prose


def hochberg(ps, rate):
    """Which p-values Benjamini-Hochberg rejects."""
    order = sorted(ps)
    best = max((p for i, p in enumerate(order, 1) if p <= rate * i / len(order)), default=-1)
    return [p <= best for p in ps]


def test_secrets_battery_and_discoveries(spark):
    """P-values, classes and flags of single tokens against brute force; p-values are compared as the operator rounds them."""
    import random

    rng = random.Random(12)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = "the of and to in is that it was for on are with as his they at be this from or had by hot but some what there we can out other were all your when up use word how said an each she".split()
    prose = ["".join(rng.choice(words).capitalize() for _ in range(rng.randint(8, 16))) + str(rng.randint(0, 99)) for _ in range(120)]
    keys = ["".join(rng.choice(a) for _ in range(rng.randint(20, 80))) for a in (alnum, "0123456789abcdef", alnum + "+/") for _ in range(60)]
    odd = ["abcd1234" * 5, "0f" * 20, "A1" * 15 + "b", "aaaaaaaaaaaaaaaaaaaaaaaa1"]
    tokens = [t for t in prose + keys + odd if "/" not in t and len(t) >= secret_scan.MIN_TOKEN]  # whole runs only
    df = spark.createDataFrame(list(enumerate(f"x {t} y" for t in tokens)), "doc_id long, text string")
    found = {}
    for r in secret_scan._base_and_candidates(df).collect():
        assert len(r._found) == (battery_of(tokens[r.doc_id]) is not None)
        found[r.doc_id] = r._found[0] if r._found else None
    known = [i for i in found if found[i] is not None]
    eighths = lambda x: max(0, min(secret_scan.MOST_BINS, math.floor(8 * x)))
    rejected = {}
    for level in range(3):
        mine = [i for i in known if sum(battery_of(tokens[i])[1] >= n for n in secret_scan.LENGTHS[1:]) == level]
        for i in mine:
            p, _, ratio = battery_of(tokens[i])
            assert found[i].level == level and found[i].uniform == pytest.approx(p, abs=1e-6) and abs(found[i].prose - eighths(ratio)) <= 1
        for test in ("battery", "prose"):
            flags = hochberg([math.exp(-found[i][test] / 8) for i in mine], secret_scan.FDR)
            rejected |= {(test, i): f for i, f in zip(mine, flags)}
    for r in secret_scan.scan(df).collect():
        random_ = r.doc_id in known and not rejected["battery", r.doc_id] and rejected["prose", r.doc_id]
        assert [(s.start, s.end) for s in r.random] == [(2, 2 + len(tokens[r.doc_id]))] * random_
    share = lambda part: sum(bool(found[tokens.index(t)]) and not rejected["battery", tokens.index(t)] and rejected["prose", tokens.index(t)] for t in part if t in tokens) / len(part)
    assert share(prose) < 0.03 and share([k for k in keys if k in tokens]) > 0.95 and share(odd) == 0


def test_secrets_redacted(odd, empty):
    out = secret_scan.redact_documents(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert rows[11].text == "key [secret] and [secret] [secret]' secret=short" and rows[11].n_chars == len(rows[11].text)
    assert rows[8].text is not None and rows[0].text is None
    assert secret_scan.redact_documents(empty).count() == 0 and secret_scan.scan(empty).count() == 0


def test_secrets_by_the_thousand_in_one_text(spark):
    import random

    rng = random.Random(6)
    kinds = [lambda: "%032x" % rng.getrandbits(128), lambda: "Token = %032x" % rng.getrandbits(128), lambda: "".join(rng.choices("ABCDEFabcdefghXYZxyz0123456789+/", k=40)), lambda: "wörd", lambda: "AKIA" + "Q7" * 10]
    text = " ".join(rng.choice(kinds)() for _ in range(3000))
    df = spark.createDataFrame([(1, text), (2, text[: len(text) // 2]), (3, "plain")], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in df.collect()}
    redacted = {r.doc_id: r.text for r in secret_scan.redact_documents(df).collect()}
    for r in secret_scan.scan(df).collect():
        base = base_spans(texts[r.doc_id])
        assert [(s.start, s.kind, s.end) for s in r.base] == base
        apart = [s for s in r.random if not any(a < s.end and s.start < b for a, _, b in base)]
        assert [tuple(s) for s in r.spans] == sorted(base + [(s.start, s.kind, s.end) for s in apart]) and (r.doc_id != 1 or len(apart) > secret_scan.BLOCK)
        out, at = "", 0
        for s in r.spans:
            if s.start >= at:
                out += texts[r.doc_id][at : s.start] + "[secret]"
            at = max(at, s.end)
        assert redacted[r.doc_id] == out + texts[r.doc_id][at:]


def _hash(*values, seed=42):
    """Spark's xxhash64 of strings and longs, chained."""
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else (v % 2**64).to_bytes(8, "little"), seed)
    return seed


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def closed_anchors(text):
    """Brute force: (head, [(32-bit hash, word position)]) of a text."""
    w = [_hash(x) for x in WORD.findall(text)]
    k, s = syncmers.K, syncmers.S
    head = f"{len(w)}:{_hash(*w):016x}"
    if len(w) < k:
        return head, [(_hash(*w) % 2**32, 0)] if w else []
    out = []
    for i in range(len(w) - k + 1):
        inner = [_signed(_hash(*w[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((_hash(inner[0], inner[2], inner[3]) % 2**32, i))
    return head, out


def fingerprint_of(text):
    head, anchors = closed_anchors(text)
    gaps = [b - a for (_, a), (_, b) in zip([(0, 0), *anchors], anchors)]
    assert all(g <= syncmers.K - syncmers.S for g in gaps)
    return f"{head}:" + "".join(f"{h:08x}{g}" for (h, _), g in zip(anchors, gaps))


def likeness_of(a, b):
    """(near, aligned) from two fingerprint strings alone."""
    a, b = ([x.rpartition(":")[2][i : i + 9] for i in range(0, len(x.rpartition(":")[2]), 9)] for x in (a, b))
    jaccard = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    links = lambda x: {(p[:8], q) for p, q in zip(x, x[1:])} if len(x) > 1 else set(x)
    return jaccard({x[:8] for x in a}, {x[:8] for x in b}), jaccard(links(a), links(b))


@pytest.mark.parametrize("bytes_", [4 << 20, 3000])
def test_syncmers(spark, odd, docs, empty, bytes_, monkeypatch):
    """All columns against brute force, with one range and with many."""
    monkeypatch.setattr(syncmers, "RANGE_BYTES", bytes_)
    monkeypatch.setattr(syncmers, "RANGE_ROOT", 0)
    out = syncmers.compare_edited(docs)
    assert python_free(out)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in out.collect()}
    for i, (d, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints = [fingerprint_of(t) for t in (text, edited, nxt)]
        assert [got[d].fingerprint, got[d].edited_fingerprint] == prints[:2]
        want = [*likeness_of(prints[0], prints[1]), *likeness_of(prints[0], prints[2])]
        assert [got[d].near_edited, got[d].aligned_edited, got[d].near_next, got[d].aligned_next] == pytest.approx(want, abs=1e-12)
    assert syncmers.compare_edited(odd).count() == odd.count() and syncmers.compare_edited(empty).count() == 0


def test_syncmers_of_texts_that_differ_in_a_word(spark):
    base = [f"w{i * 7919 % 3001}" for i in range(3000)]
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join([*base[:-1], "other"])), (3, " ".join(["other", *base[1:]]))], "doc_id long, text string")
    assert syncmers.compare_edited(df).select("fingerprint").distinct().count() == 3


def test_next_of_one_repeated_id(spark, monkeypatch):
    """An id (or none) on most rows is cut by the texts' hashes; every row still gets the next one."""
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 400)
    monkeypatch.setattr(syncmers, "RANGE_ROOT", 0)
    rows = [(7 if i % 3 else None, f"text number {i} of many") for i in range(600)] + [(i, f"own {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = syncmers.with_next(df)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), _signed(_hash(r[1])), r[1]))
    want = {(a, b[1]) for a, b in zip(order, [*order[1:], order[0]])}
    assert {((r.doc_id, r.text), r._next.text) for r in out.collect()} == want
    assert out.groupBy("_range").count().agg({"count": "max"}).first()[0] < 60


def test_syncmer_anchors_need_no_context(spark):
    passage = " ".join(f"w{i * 37 % 101}" for i in range(60))
    df = spark.createDataFrame([(1, passage), (2, "other words first " + passage), (3, passage + " then more words after")], "doc_id long, text string")
    a, b, c = (set(r.anchors) for r in syncmers.fingerprint_documents(df).orderBy("doc_id").collect())
    assert a <= b and a <= c and len(a) > 10


def ledger_of(text):
    t = text or ""
    w = WORD.findall(t)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if tri[(w[i], w[i + 1], w[i + 2])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_rule_ledger(name, request):
    docs = request.getfixturevalue(name)
    out = rule_ledger.apply_policy(rule_ledger.ledger(docs))
    assert python_free(out)
    want = Counter((r.doc_id, ledger_of(r.text)) for r in docs.collect())
    rows = out.collect()
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rule_policies_and_ablation(docs, odd, empty):
    rows = rule_ledger.ledger(docs).cache()
    failed = [r.failed for r in rows.collect()]
    for r in rule_ledger.ablation(rows).collect():
        bit = rule_ledger.BIT[r.rule]
        assert (r.rejected, r.only_here) == (sum(f & bit > 0 for f in failed), sum(f == bit for f in failed))
    kept = rule_ledger.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == failed.count(0)
    assert rule_ledger.keep_documents(odd).columns == odd.columns and rule_ledger.keep_documents(empty).count() == 0


def targets_of(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        share = (total - sum(cap * sizes[s] for s in full)) / max(1, sum(w[s] for s in names if s not in full))
        more = {s for s in names if s not in full and w[s] * share > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in full else w[s] * share for s in names}
        full |= more


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_mixing(name, request):
    docs = request.getfixturevalue(name)
    out = mixing.mix_documents(docs)
    assert python_free(out)
    rows = out.collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.collect())
    size, taken, longest = Counter(), Counter(), Counter()
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    want = targets_of(size)
    for r in rows:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
    if name == "docs":
        assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 40 for s in size)
        again = mixing.mix_documents(docs).collect()
        assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


def test_mixing_with_documents_larger_than_chunks(spark):
    """Few documents that outweigh what the rest of a chunk can make up for, in sources with several targets."""
    rows = [(f"{s}{i}", s, 20 + i % 7) for s, n in (("a", 6000), ("b", 6000), ("c", 3000)) for i in range(n)]
    rows += [(f"{s}big{i}", s, 20_000 + 1000 * (i % k)) for s, n, k in (("a", 12, 1), ("b", 20, 1), ("c", 9, 4)) for i in range(n)]
    sizes = spark.createDataFrame(rows, "_id string, source string, size long")
    out = mixing.mix_sizes(sizes)
    assert python_free(out)
    rows, taken, want = out.collect(), Counter(), {}
    assert len(rows) == sizes.count() == len({r._id for r in rows})
    for r in rows:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        want[r.source] = r.target
    assert all(abs(taken[s] - want[s]) <= 0.002 * want[s] + 40 for s in want)


def test_mixing_copies(docs, odd, empty):
    out = mixing.copy_documents(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix_documents(docs).collect()}
    got = Counter(r.doc_id for r in out.collect())
    assert set(got) <= set(copies) and abs(sum(got.values()) - sum(copies.values())) < 0.05 * len(copies) + 3
    assert mixing.copy_documents(odd).columns == odd.columns and mixing.mix_documents(empty).count() == 0


def descend(key, tree):
    """Brute force: the shard of a key, level by level."""

    def draw(path, weights):
        u = [(int(hashlib.md5(f"{path}:{i}".encode()).hexdigest()[:13], 16) + 1) / 2**52 for i in range(len(weights))]
        return min((i for i, w in enumerate(weights) if w > 0), key=lambda i: -math.log(u[i]) / weights[i])

    region = draw(key, [sum(map(sum, r)) for r in tree])
    rack = draw(f"{key}:{region}", [sum(r) for r in tree[region]])
    shard = draw(f"{key}:{region}:{rack}", tree[region][rack])
    return sum(len(r) for reg in tree[:region] for r in reg) + sum(len(r) for r in tree[region][:rack]) + shard


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_sharding(name, request):
    docs = request.getfixturevalue(name)
    out = sharding.shard_documents(docs)
    assert python_free(out)
    rows = out.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    tree = sharding.built_tree([1.0] * 40)
    assert [len(r) for r in tree] == [4, 4, 2]
    for r in rows:
        slots[r.shard].append(r.slot)
        key = "null" if r.doc_id is None else r.doc_id
        assert r.shard == descend(key, tree) and r.grown_shard == descend(key, sharding.grown_tree(tree)) and r.grown_shard in (r.shard, 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_weights(spark, empty):
    """Weights are met; a change of one weight moves nothing between subtrees whose weights stay, nor inside them."""
    from pyspark.sql import functions as F

    keys = spark.range(6000).select(F.col("id").cast("string").alias("k"))
    weights = [1.0] * 33 + [0.0] + [5.0] * 6
    place = lambda tree: {r.k: r.s for r in sharding.with_shard(keys, "k", tree, "s").collect()}
    tree = sharding.built_tree(weights)
    one = place(tree)
    assert all(one[k] == descend(k, tree) for k in one)
    share = Counter(one.values())
    assert share[33] == 0 and all(abs(share[i] - 6000 * w / sum(weights)) < 6 * math.sqrt(6000 * w / sum(weights)) + 1 for i, w in enumerate(weights))
    two = place(sharding.built_tree([weights[0] + 2, *weights[1:]]))
    moved = {k for k in one if one[k] != two[k]}
    # Region 0 got heavier: rows come into it from outside; inside it they go to rack 0; inside that to shard 0.
    assert moved and all(two[k] // 16 == 0 for k in moved)
    assert all(two[k] // 4 == 0 for k in moved if one[k] // 16 == 0) and all(two[k] == 0 for k in moved if one[k] // 4 == 0)
    grown = place(sharding.grown_tree(tree, 2.0))
    assert all(grown[k] in (one[k], 40) for k in one) and 6000 * 2 / (sum(weights) + 2) * 0.7 < sum(s == 40 for s in grown.values())
    # By count: 42 shards are 41 and one more.
    counts = {n: place(sharding.built_tree([1.0] * n)) for n in (40, 41, 42)}
    assert all(counts[n + 1][k] in (counts[n][k], n) for n in (40, 41) for k in one)
    assert sharding.shard_documents(empty).count() == 0


def test_mixing_without_sources_or_ids(spark):
    """No source column: one source. Documents without doc_id spread over the chunks by their texts."""
    df = spark.range(3000).selectExpr("cast(NULL as long) AS doc_id", "concat('row ', id, repeat(' w', cast(id % 50 as int))) AS text")
    out = mixing.mix_documents(df)
    rows = out.collect()
    assert len(rows) == 3000 and {r.source for r in rows} == {None} and abs(sum(r.taken for r in rows) - rows[0].target) < 60
    assert mixing.copy_documents(df).columns == ["doc_id", "text"]
    from pyspark.sql import functions as F

    sized = mixing.document_sizes(df).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "_salt"), F.lit(12)))
    assert sized.groupBy("chunk").count().agg({"count": "max"}).first()[0] < 400


def test_shards_of_a_larger_tree(spark, docs):
    """A tree built with 100 shards keeps its rows when one more is added, but for those that move into it."""
    rows = sharding.shard_documents(docs, shards=100, built=100).collect()
    assert {r.shard for r in rows} <= set(range(100)) and len({r.shard for r in rows}) > 60
    assert all(r.grown_shard in (r.shard, 100) for r in rows)
    assert [len(region) for region in sharding.built_tree([1.0] * 100, 100)] == [4] * 6 + [1] and len(sharding.built_tree([1.0] * 100)) > 60
