"""Phrases, common lines and spelling variants against brute force, on odd and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from uvspark.llm import line_dedup, phrases, spelling
from uvspark.llm.perfect_hash import PerfectHash

LOWER = {i: i + 32 for i in range(65, 91)}


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 200_000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        slots = PerfectHash(keys, ~keys)
        assert sorted(slots.slots(keys, ~keys)) == list(range(len(keys)))
        assert (slots.slots(keys, keys) == -1).all()  # a check that differs
        others = rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
        assert (slots.slots(others, ~others) == -1).all()


def collocations(rows, least, longest, percent, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found, inside = [], Counter()
        for p, a in counts.items():
            if len(p) >= 2 and a >= least:
                score, _, l, r = min((2_000_000 * a // (counts[p[:c]] + counts[p[c:]]), c, counts[p[:c]], counts[p[c:]]) for c in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), p, l, r))
                for j in range(2, len(p)):
                    for i in range(len(p) - j + 1):
                        inside[p[i : i + j]] = max(inside[p[i : i + j]], a)
        found = sorted(x for x in found if 100 * inside[x[3]] < percent * -x[1] or x[3] not in inside)
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, _, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("least,top,room,keys", [(3, 40, 1 << 14, 1 << 21), (3, 10_000, 64, 900)])
def test_phrases(spark, docs, odd, least, top, room, keys, monkeypatch):
    """With one round, and with several and tables so small that all their bits are set."""
    for name, value in (("LEAST_PLACES", room), ("PLACES", room), ("ROUND_KEYS", keys), ("FAN", 2)):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(3)
    made = [(" ".join(rng.choice(["New", "york", "City", "a", "A", "b,", "c.\n", "de:la", "\t", "x!y", "École"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "und"])) for _ in range(120)]
    rows = made + [(r.text, r.lang) for r in docs.limit(25).collect()] + [(r.text, None) for r in odd.collect()] + [("same line of words " * 50, "en")] * 7
    df = spark.createDataFrame([(t, l, 1, "x") for t, l in rows], "text string, lang string, n long, phrase string").repartition(5)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(df, least=least, top=top).collect())
    assert got == collocations(rows, least, 4, 80, top)


def test_phrases_of_nothing(spark):
    schema = "text string, lang string"
    assert phrases.collocations(spark.createDataFrame([], schema)).columns == COLUMNS
    for rows in ([], [(None, None), ("", "en"), (" \n\t", "en")], [("one", "en")] * 40):
        assert phrases.collocations(spark.createDataFrame(rows, schema)).count() == 0


def test_phrases_told_are_not_sent_again():
    """A task sends what it wasn't told of, and nothing else."""
    rng = np.random.default_rng(5)
    words = rng.integers(1, 60, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words[::7] = 0
    some = np.full(8, 255, np.uint8)
    with np.errstate(over="ignore"):
        rows = phrases.untold(words, 2, [some], some, None)
        assert {tuple(r) for r in rows.tolist()} == {(a, b) for a, b in zip(words.tolist(), words.tolist()[1:]) if a and b}
        for part in (rows, rows[::3], rows[:0]):
            told = phrases.PerfectHash(phrases.fold(part), phrases.check(part))
            left = phrases.untold(words, 2, [some], some, told)
            assert len(left) == len(rows) - len(part)
            assert {tuple(r) for r in left.tolist()} == {tuple(r) for r in rows.tolist()} - {tuple(r) for r in part.tolist()}


def test_counts_are_sent_small():
    """Sparse counts take less than half of what plain compression takes; none changes."""
    rng = np.random.default_rng(5)
    for kind in ("u1", "u4", "i8"):
        for n, share in ((1, 1.0), (64, 0.0), (1 << 14, 0.001), (1 << 14, 0.05), (1 << 14, 0.4), (1 << 14, 1.0)):
            counts = np.where(rng.random(n) < share, rng.integers(1, min(1 << 40, np.iinfo(kind).max), n), 0).astype(kind)
            assert phrases.released(phrases.squeezed(counts)).tolist() == counts.tolist()
    counts = np.where(rng.random(1 << 14) < 0.05, np.minimum(rng.geometric(0.7, 1 << 14), 30), 0).astype("u1")
    assert 2 * len(phrases.squeezed(counts)) < len(zlib.compress(counts.tobytes(), 1))


def test_score_beyond_64_bits(spark):
    """The score's product passes 64 bits without loss."""
    row = spark.range(1).selectExpr("cast(cast(cast(5000000000000000 as bigint) as decimal(20,0)) * 2000000 div (cast(cast(9000000000000001 as bigint) as decimal(20,0)) + cast(7 as bigint)) as bigint) AS s").first()
    assert row.s == 2_000_000 * 5_000_000_000_000_000 // 9_000_000_000_000_008


def deduped(rows, min_chars, min_docs):
    blank = " \t\n\x0b\x0c\r"
    held = defaultdict(set)
    key = lambda line: line.strip(blank).translate(LOWER)
    least = -(1 << 63)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(least if d is None else d)
    out = Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < min_docs or (least if d is None else d) == max(held[key(x)])]
        out[d, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("room", [32_000_000, 0])
def test_lines(spark, docs, odd, empty, room, monkeypatch):
    """With the common lines and the drops broadcast, and without."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", room)
    rng = random.Random(5)
    pool = ["  A Common line " + "é" * 10, "a common LINE " + "é" * 10 + "\r", "short", "", "ünique word " * 4, "\x0b padded line of words \x0c", "a line without é, of ascii only"]
    made = [(i % 90 if i % 13 else None, "\n".join(rng.choice(pool + [f"line number {i} alone here"]) for _ in range(rng.randint(0, 12)))) for i in range(200)]
    rows = made + [(r.doc_id, r.text) for r in docs.limit(60).collect()] + [(r.doc_id, r.text) for r in odd.collect()] + [(7, made[7][1])] * 5
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n_lines long, drops string").repartition(4)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_lines(df, 20, 3).collect())
    assert got == deduped(rows, 20, 3)
    assert line_dedup.drop_lines(empty).count() == 0


def test_lines_of_very_many_documents_are_broadcast(spark, monkeypatch):
    """Lines over the share of rows go by broadcast, the others by key; the result is the same."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(line_dedup, "HOT", 1)
    rows = [(i, f"the line that stands in all of the documents\nline of {i % 300} that some documents share here") for i in range(3000)]
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == deduped(rows, 40, 5)


def near(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def grouped(rows, min_chars=5, min_count=3, drop_every=97):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if drop_every and h % drop_every == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    out, form = {}, {}
    by_size = defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    for w, n in counts.items():
        close = [v for k in (-1, 0, 1) for v in by_size[len(w) + k] if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
        out[w] = (n, len(close), form[w], counts.get(form[w]))
    for w in out:
        at = w
        while form[at]:
            at = form[at]
        out[w] += (at,)
    return out


def grouped_by_spark(df, **more):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df, **more).collect()}


@pytest.mark.parametrize("block,wide,room", [(48, 64, 2_000_000), (2, 6, 2_000_000), (2, 64, 0)])
def test_spelling(spark, docs, odd, empty, block, wide, room, monkeypatch):
    """With blocks as in production, with blocks of two words at most, large blocks broadcast and not, words compared by rows and one by one."""
    for name, value in (("BLOCK", block), ("WIDE", wide), ("BROADCAST_BLOCKS", room)):
        monkeypatch.setattr(spelling, name, value)
    rng = random.Random(8)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaaaaa", "aaaaaaaaa", "aaaaaaaaaa", "prefix" * 20 + "one", "prefix" * 20 + "two", "prefix" * 20 + "tw"]

    def edited(w):
        i = rng.randrange(len(w))
        return rng.choice([w, w, w[:i] + w[i + 1 :], w[:i] + rng.choice("abÿ") + w[i:], w[:i] + "c" + w[i + 1 :]])

    made = [(i if i % 7 else None, " ".join(edited(rng.choice(base)) for _ in range(50)) + "-Stop" * 3) for i in range(150)]
    rows = made + [(r.doc_id, r.text) for r in docs.limit(30).collect()] + [(r.doc_id, r.text) for r in odd.collect()] + [(5, made[5][1])] * 3
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n long").repartition(4)
    for every in (3, 97) if block == 2 and room else (97,):
        assert grouped_by_spark(df, drop_every=every) == grouped(rows, drop_every=every)
    assert spelling.variants(empty).count() == 0


def test_spelling_with_a_common_stem(spark):
    """A thousand words share more than half of their characters at either end: the blocks are subdivided."""
    words = [f"stemstemstem{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'x' * (i % 3)}endend" for i in range(1000)]
    rows = [(i, " ".join(words)) for i in range(3)] + [(9, words[5] + " " + words[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert grouped_by_spark(df, drop_every=0) == grouped(rows, drop_every=0)


def test_roots_of_a_long_chain(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)]
    assert {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()} == {w: "w040" for w, _ in forms}
