"""Secret scan: three base patterns, and a randomness test battery over token-like strings.

Candidates are maximal runs of at least MIN_TOKEN token characters, and their parts of that length
between the marks that join a value to its name or path ("=", "/", "_" and "-"). Each gets an inferred encoding
(the smallest alphabet that holds it) and a battery against "uniform over that alphabet": chi-squared
cell counts, runs above and below the middle, lag-one serial correlation, combined into one p-value by
Bonferroni. Benjamini-Hochberg over the combined p-values of all candidates of a length class (short
ones carry less evidence and are judged among their like) finds those with structure: these are no secrets, and
at most the rate FDR of them are random after all. Short prose can pass the battery, so a second
Benjamini-Hochberg over p-values against "written language" (from the likelihood ratio of the uniform
model to a prose letter model) must reject prose too. Secrets that overlap in a run are reported as one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, table

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
#: Parts of a run: what a mark may join, with the padding at the run's end.
PARTS = tuple(rf"[^{marks}]{{{MIN_TOKEN},}}(?:=+$)?" for marks in ("=", "=/", "=_-", "=/_-"))
#: Encodings from small to large: name, alphabet in order, what a token must match.
LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    ("HEX", DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    ("base32", LOWER.upper() + "234567", r"^(?=.*[2-7])[A-Z2-7]+=*$"),
    ("base36", DIGITS + LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    ("BASE36", DIGITS + LOWER.upper(), r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    ("base62", LOWER.upper() + LOWER + DIGITS, r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[0-9A-Za-z]+$"),
    ("base64", LOWER.upper() + LOWER + DIGITS + "+/", r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[0-9A-Za-z+/]+=*$"),
    ("base64url", LOWER.upper() + LOWER + DIGITS + "-_", r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[0-9A-Za-z_-]+=*$"),
)
#: Letter shares of English prose a to z, in per mille.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Shares of letters, digits and others in a token of prose.
CLASSES = (0.90, 0.08, 0.02)
#: Share of capitals among the letters of prose.
CAPITALS = 0.05
#: Length classes by least length, and the false-discovery rate.
LENGTHS = (20, 32, 64)
FDR = 0.01
#: P-values are compared as whole eighths of -ln p, up to this many.
MOST_BINS = 4096
#: Items that one fold appends.
BLOCK = 256


def _prose_log(ch: str) -> float:
    if ch.isalpha():
        return math.log(CLASSES[0] * LETTERS[ord(ch.lower()) - 97] / 1000 * (CAPITALS if ch.isupper() else 1 - CAPITALS))
    return math.log(CLASSES[1] / 10 if ch.isdigit() else CLASSES[2] / 4)


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def scan_blocks(items: Column, start: dict[str, Column], none: Column, step) -> Column:
    """One struct (start's names, out) per block of BLOCK items: a fold that carries start's values over all items and collects into `out`.

    Each append copies what it appends to, so one fold over all items would take the square of their number.
    """

    def block(done, part):
        last = F.element_at(done, F.size(done))
        first = F.struct(*[F.when(F.size(done) > 0, last[n]).otherwise(v).alias(n) for n, v in start.items()], none.alias("out"))
        return F.concat(done, F.array(F.aggregate(part, first, step)))

    kinds = F.filter(F.array(F.struct(*[v.alias(n) for n, v in start.items()], none.alias("out"))), lambda _: F.lit(False))
    return F.aggregate(blocks(items), kinds, block)


def blocks(items: Column) -> Column:
    """items in arrays of BLOCK; one empty array if there are none."""
    return let(items, lambda a: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int"))), lambda b: F.slice(a, b * BLOCK + 1, BLOCK)))


def collected(done: Column) -> Column:
    return F.flatten(F.transform(done, lambda x: x["out"]))


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array<struct<start, end, kind, token>> of leftmost non-overlapping matches, in code points, end exclusive."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
        F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["gap"])).alias("start"), (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), F.lit(kind).alias("kind"), x["hit"].alias("token"))))).alias("out"),
    )
    none = F.array().cast("array<struct<start:int,end:int,kind:int,token:string>>")
    zipped = F.zip_with(gaps, found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    out = collected(scan_blocks(zipped, {"at": F.lit(0)}, none, step))
    if keep is not None:
        out = F.filter(out, keep)
    return F.when(text.rlike(pattern), out).otherwise(none)


def with_parts(rows: DataFrame) -> DataFrame:
    """Add to the runs in `_found` their parts, each place once, in order."""

    def parts(c):
        inside = F.concat(*[spans(c["token"], pattern, 3) for pattern in PARTS])
        moved = F.transform(inside, lambda x: F.struct((c["start"] + x["start"]).alias("start"), (c["start"] + x["end"]).alias("end"), x["kind"].alias("kind"), x["token"].alias("token")))
        return F.concat(F.array(c), moved)

    rows = rows.withColumn("_found", F.sort_array(F.flatten(F.transform("_found", parts))))
    return rows.withColumn("_found", F.filter("_found", lambda c, i: (i == 0) | (c["start"] != F.get("_found", i - 1)["start"]) | (c["end"] != F.get("_found", i - 1)["end"])))


def united(found: Column) -> Column:
    """(start, kind, end) of places in order of their start; overlapping ones become one."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    place = lambda a: F.array(F.struct(a["start"].alias("start"), F.lit(3).alias("kind"), a["end"].alias("end")))
    whole = lambda a: F.when(a["start"] < 0, none).otherwise(place(a))

    def step(acc, c):
        new = c["start"] >= acc["end"]
        return F.struct(F.when(new, c["start"]).otherwise(acc["start"]).alias("start"), F.greatest(acc["end"], c["end"]).alias("end"), F.when(new, F.concat(acc["out"], whole(acc))).otherwise(acc["out"]).alias("out"))

    return let(scan_blocks(found, {"start": F.lit(-1), "end": F.lit(-1)}, none, step), lambda done: F.concat(collected(done), whole(F.element_at(done, F.size(done)))))


def touches(apart: Column, c: Column) -> Column:
    """Whether c overlaps one of the places in `apart`, which are in order and don't overlap: only the last that starts before c's end can."""
    size = F.size(apart)
    rounds = F.sequence(F.lit(0), F.ceil(F.log2((size + 1).cast("double"))).cast("int"))

    def halve(r, _):
        mid = F.shiftright(r["lo"] + r["hi"], 1)
        before = F.get(apart, mid)["start"] < c["end"]
        return F.struct(F.when((r["lo"] < r["hi"]) & before, mid + 1).otherwise(r["lo"]).alias("lo"), F.when((r["lo"] < r["hi"]) & ~before, mid).otherwise(r["hi"]).alias("hi"))

    starts_before = F.aggregate(rounds, F.struct(F.lit(0).alias("lo"), size.alias("hi")), halve, lambda r: r["lo"])
    return F.coalesce(F.get(apart, starts_before - 1)["end"] > c["start"], F.lit(False))


def upper_tail(z: Column) -> Column:
    """1 - Phi(z), to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery() -> tuple:
    """Two steps for candidates (structs start, end, kind, token): infer the encoding; score.

    Between them, those without an encoding are to be dropped. A step is applied to an array with
    transform, each in a projection of its own so that none is evaluated twice.
    """
    pick = lambda c, values: F.get(F.array(*map(F.lit, values)), c["enc"])
    keep = ("start", "end", "kind", "token")
    cols = lambda c, *names: [c[n].alias(n) for n in names]
    tables = F.array(*[F.array(*[F.lit(math.log(1 / len(a)) - _prose_log(ch)) for ch in a]) for _, a, _ in ENCODINGS])

    def encode(c):
        enc = F.lit(None).cast("int")
        for i, (_, _, pattern) in reversed(list(enumerate(ENCODINGS))):
            enc = F.when(c["token"].rlike(pattern), i).otherwise(enc)
        return F.struct(*cols(c, *keep), enc.alias("enc"))

    def codes(c):
        alphabet = pick(c, [a for _, a, _ in ENCODINGS])
        body = F.regexp_replace(c["token"], "=+$", "")
        return F.struct(*cols(c, *keep, "enc"), F.transform(F.filter(F.split(body, ""), lambda x: x != ""), lambda ch: F.instr(alphabet, ch) - 1).alias("codes"))

    def count(c):
        x, size = c["codes"], pick(c, [float(len(a)) for _, a, _ in ENCODINGS])
        zero = lambda **k: F.struct(*[F.lit(v).alias(n) for n, v in k.items()])
        squares = F.aggregate(F.sort_array(x), zero(last=-1, k=0, s=0.0), lambda a, v: F.struct(v.alias("last"), F.when(v == a["last"], a["k"] + 1).otherwise(1).alias("k"), (a["s"] + 2 * F.when(v == a["last"], a["k"] + 1).otherwise(1) - 1).alias("s")), lambda a: a["s"])
        above = lambda v: F.when(v * 2 >= size, 1).otherwise(0)
        runs = F.aggregate(x, zero(last=-1, n=0, runs=0), lambda a, v: F.struct(above(v).alias("last"), (a["n"] + above(v)).alias("n"), (a["runs"] + F.when(above(v) == a["last"], 0).otherwise(1)).alias("runs")))
        mid = (size - 1) / 2
        serial = F.aggregate(x, zero(last=0.0, xy=0.0, xx=0.0), lambda a, v: F.struct((v - mid).alias("last"), (a["xy"] + a["last"] * (v - mid)).alias("xy"), (a["xx"] + (v - mid) * (v - mid)).alias("xx")))
        ratio = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.get(F.get(tables, c["enc"]), v))
        return F.struct(*cols(c, *keep), size.alias("size"), F.size(x).cast("double").alias("n"), squares.alias("squares"), runs.alias("r"), serial.alias("s"), ratio.alias("ratio"))

    def judge(c):
        n, size = c["n"], c["size"]
        df = size - 1
        chi = c["squares"] * size / n - n
        p_cells = upper_tail((F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        n1, runs = c["r"]["n"].cast("double"), c["r"]["runs"].cast("double")
        n0 = n - n1
        mean = 2 * n0 * n1 / n + 1
        var = 2 * n0 * n1 * (2 * n0 * n1 - n) / (n * n * (n - 1))
        p_runs = F.when(var > 0, 2 * upper_tail(F.abs(runs - mean) / F.sqrt(var))).otherwise(0.0)
        p_serial = F.when(c["s"]["xx"] > 0, 2 * upper_tail(F.abs(c["s"]["xy"]) / c["s"]["xx"] * F.sqrt(n))).otherwise(0.0)
        uniform = F.least(F.lit(1.0), 3 * F.least(p_cells, p_runs, p_serial))
        level = sum((n >= least).cast("int") for least in LENGTHS[1:]) if len(LENGTHS) > 1 else F.lit(0)
        whole = lambda x: F.greatest(F.lit(0), F.least(F.lit(MOST_BINS), F.floor(x * 8).cast("int")))
        battery_bin = whole(-F.log(F.greatest(uniform, F.lit(1e-300))))
        return F.struct(*cols(c, "start", "end", "kind"), uniform.alias("uniform"), level.alias("level"), battery_bin.alias("battery"), whole(c["ratio"]).alias("prose"))

    return encode, (codes, count, judge)


def _base_and_candidates(docs: DataFrame) -> DataFrame:
    """doc_id (or a packed row), `_base` and scored `_found` of every text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    long_enough = lambda m: F.length(F.regexp_extract(m["token"], ASSIGN, 2)) >= 6
    for name, args in (("_assign", (ASSIGN, 0, long_enough)), ("_access", (ACCESS, 1)), ("_hex", (HEX, 2)), ("_found", (TOKEN, 3))):
        rows = rows.withColumn(name, spans(F.col("_text"), *args))
    place = lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))
    counts = [F.size(c).cast("long").alias(f"n{c}") for c in ("_assign", "_access", "_hex")]
    rows = rows.select("doc_id", *counts, F.sort_array(F.transform(F.concat("_assign", "_access", "_hex"), place)).alias("_base"), "_found")
    encode, steps = battery()
    rows = with_parts(rows)
    rows = rows.withColumn("_found", F.filter(F.transform("_found", encode), lambda c: c["enc"].isNotNull()))
    for step in steps:
        rows = rows.withColumn("_found", F.transform("_found", step))
    return rows


def rejects_from(counts: dict[int, int]) -> int:
    """Benjamini-Hochberg on p-values counted in whole eighths of -ln p: least bin that is rejected; MOST_BINS + 1 if none."""
    total, above, best = sum(counts.values()), 0, MOST_BINS + 1
    for at in sorted(counts, reverse=True):
        above += counts[at]
        if at >= 8 * math.log(total / (FDR * above)):
            best = at
    return best


def thresholds(rows: DataFrame) -> tuple[list[int], list[int]]:
    """Per length class, over all candidates: least bin at which the battery finds structure, and at which prose is rejected.

    What comes to the driver is one count per class, test and bin, at most 2 * len(LENGTHS) * (MOST_BINS + 1) rows.
    """
    both = lambda c: F.array(*[F.struct(c["level"].alias("level"), F.lit(t).alias("test"), c[t].alias("bin")) for t in ("battery", "prose")])
    bins = rows.select(F.explode("_found").alias("c")).select(F.explode(both(F.col("c"))).alias("b"))
    hits = bins.groupBy("b.level", "b.test", "b.bin").agg(F.count("*").alias("n")).collect()
    least = lambda test, level: rejects_from({r["bin"]: r["n"] for r in hits if r["test"] == test and r["level"] == level})
    return tuple([least(t, k) for k in range(len(LENGTHS))] for t in ("battery", "prose"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base, spans, random and n_candidates.

    base, spans and random are arrays of (start, kind, end), in order, kind an index into KINDS; random has
    the random tokens, spans all of base and the random tokens that overlap none of it. Null text counts
    as empty: no spans. Long texts are scanned whole. Repeated rows are scanned on their own; an empty
    table gives no rows; other columns are ignored.
    """
    rows = materialize(_base_and_candidates(docs))
    structure, prose = (F.array(*map(F.lit, x)) for x in thresholds(rows))
    flagged = F.filter("_found", lambda c: (c["battery"] < F.get(structure, c["level"])) & (c["prose"] >= F.get(prose, c["level"])))
    rows = rows.withColumn("_n", F.size("_found").cast("long")).withColumn("_found", flagged)
    rows = rows.withColumn("_apart", united(F.col("_base")))
    free = F.filter("_found", lambda c: ~touches(F.col("_apart"), c))
    return rows.select(
        "doc_id", F.col("n_assign"), F.col("n_access"), F.col("n_hex"), F.col("_base").alias("base"), F.sort_array(F.concat("_base", united(free))).alias("spans"),
        united(F.col("_found")).alias("random"), F.col("_n").alias("n_candidates"),
    )


def joined(places: Column) -> Column:
    """kind:start:end of each place, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(places, lambda p: F.concat_ws(":", F.get(kinds, p["kind"]), p["start"], p["end"])), ",")


def redact(text: Column, places: Column, mark: str = "[secret]") -> Column:
    """text with every place replaced by a mark; overlapping places become one.

    The text is cut at blocks of places first: to cut it at a place takes time up to that place.
    """

    def cut(block, begin):
        end = F.element_at(block, F.size(block))["end"]
        start = F.struct(F.lit("").alias("out"), begin.alias("at"))

        def replaced(part):
            piece = lambda acc, p: F.concat(acc["out"], F.substring(part, acc["at"] - begin + 1, p["start"] - acc["at"]), F.lit(mark))
            return F.aggregate(block, start, lambda acc, p: F.struct(piece(acc, p).alias("out"), p["end"].alias("at")), lambda acc: acc["out"])

        return let(F.substring(text, begin + 1, end - begin), replaced)

    def whole(parts):
        begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(F.get(parts, i - 1), F.lit(-1))["end"])
        end = F.element_at(F.get(parts, F.size(parts) - 1), F.lit(-1))["end"]
        return F.concat(F.array_join(F.transform(parts, lambda block, i: let(begin(i), lambda b: cut(block, b))), ""), F.substring(text, end + 1, F.length(text)))

    return F.when(F.size(places) > 0, let(blocks(united(places)), whole)).otherwise(text)


def redact_documents(docs: DataFrame) -> DataFrame:
    """docs with every secret in `text` replaced, all rows and columns kept; n_chars follows if there.

    Null text stays null, empty text empty; long texts are searched whole; repeated rows are changed alike. Spans that
    overlap are replaced as one. An empty table stays empty; columns of any name stay.
    """
    packed = docs.select(F.struct(*docs.columns).alias("doc_id"), "text")
    rows = scan(packed).select("doc_id.*", F.col("spans").alias("__spans"))
    has = F.size("__spans") > 0
    rows = rows.withColumn("text", F.when(has, redact(F.col("text"), F.col("__spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.when(has, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def op1_secret_randomness(spark, sf_dir):
    rows = scan(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        "n_candidates", F.size("random").cast("long").alias("n_random"), joined(F.col("random")).alias("random_spans"),
    )
