"""Iterative solvers. Sums are taken in Spark first, so that each group sent to NumPy is a few kilobytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.model import series, table, visibilities

REFERENCE_SNR = 999.0


def antenna_terms(value: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, clip: float = 4.0, iterations: int = 5, prior: float = 0.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Terms g with value ~ g[a] + g[b]: reweighted fits, then clipping; terms, errors and reduced chi-squared. Unseen antennas: NaN.

    Each round of clipping judges all baselines anew, so one that was left out can return. prior (1 /
    variance) pulls all terms to 0. Under three usable baselines nothing is solved.
    """
    usable = np.isfinite(value) & np.isfinite(weight) & (weight > 0)
    value, weight, keep = np.where(usable, value, 0.0), np.where(usable, weight, 0.0), usable.copy()
    seen = np.zeros(n, bool)

    def fit(use: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        design = np.zeros((use.sum(), n))
        rows = np.arange(len(design))
        np.add.at(design, (rows, a[use]), 1.0)
        np.add.at(design, (rows, b[use]), 1.0)
        seen[:] = design.any(axis=0)
        root = np.sqrt(w[use])[:, None]
        inverse = np.linalg.pinv((design * root).T @ (design * root) + prior * np.diag(seen.astype(float)))
        return inverse @ (design.T @ (w[use] * value[use])), np.sqrt(np.clip(np.diag(inverse), 0, None))

    if usable.sum() < 3:
        return np.full(n, np.nan), np.full(n, np.nan), np.nan
    robust = weight.copy()
    for _ in range(iterations):
        g, err = fit(usable, robust)
        robust = weight / np.maximum(np.abs((value - g[a] - g[b]) * np.sqrt(weight)), 1e-3)
    known = seen.copy()
    for _ in range(iterations):
        r = np.abs((value - g[a] - g[b]) * np.sqrt(weight))
        scale = max(1.4826 * np.median(r[usable]), 1.0) if usable.sum() > known.sum() else 1.0
        new = usable & (r <= clip * scale)
        if new.sum() <= known.sum():
            new = usable.copy()
        g, err = fit(new, weight)
        if (new == keep).all():
            break
        keep = new
    r = (value - g[a] - g[b]) * np.sqrt(weight)
    chi2 = float((r[keep] ** 2).sum() / max(1, usable.sum() - known.sum()))
    err = err * np.sqrt(max(chi2, 1.0))
    return np.where(known, g, np.nan), np.where(known, err, np.nan), chi2


def on_source_fraction(ratio: np.ndarray, usable: np.ndarray, iterations: int = 30, prior: float = 0.05) -> np.ndarray:
    """Antenna factors with ratio[i, j] ~ g[i] * g[j] by a damped fixed point from 1, within [0, 3]."""
    r = np.where(usable, np.clip(ratio, 0, 3), 0.0)
    g = np.ones(len(r))
    for _ in range(iterations):
        g = np.clip((g + (r @ g + prior) / (usable @ g**2 + prior)) / 2, 0, 3)
    return g


def connected_groups(weight: np.ndarray) -> np.ndarray:
    """Least antenna of the connected group of each one, over baselines of positive weight."""
    label = np.arange(len(weight))
    while True:
        new = np.minimum(label, np.where(weight > 0, label[None, :], len(weight)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def antenna_gains(cross: np.ndarray, weight: np.ndarray, iterations: int = 100, tolerance: float = 1e-8, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Gains with cross[i, j] / weight[i, j] ~ g[i] conj(g[j]), and which are flagged (under `least` baselines).

    cross sums weight * visibility and is Hermitian. Starts at the leading eigenvector of each connected
    group, then alternates least squares per antenna, averaging every second iterate. Each group has a
    phase origin of its own.
    """
    weight = weight.copy()
    while True:
        few = (weight > 0).sum(axis=1) < least
        drop = few & (weight > 0).any(axis=1)
        if not drop.any():
            break
        weight[drop] = 0
        weight[:, drop] = 0
    flagged = ~(weight > 0).any(axis=1)
    cross = np.where(weight > 0, cross, 0)
    mean = np.where(weight > 0, cross / np.where(weight > 0, weight, 1), 0)
    g = np.ones(len(weight), complex)
    label = connected_groups(weight)
    for k in np.unique(label[~flagged]):
        # A group without a baseline to another is a problem of its own: the leading vector of all would leave it near zero.
        own = np.flatnonzero((label == k) & ~flagged)
        values, vectors = np.linalg.eigh(mean[np.ix_(own, own)])
        links = np.maximum((weight[np.ix_(own, own)] > 0).sum(axis=1), 1)
        g[own] = vectors[:, -1] * np.sqrt(max(values[-1], 1e-12)) * np.sqrt(len(own) / links)
    for i in range(2 * iterations):
        den = weight @ np.abs(g) ** 2
        new = np.where(den > 0, cross @ g / np.where(den > 0, den, 1), 1)
        if i % 2:
            new = (g + new) / 2
        change, g = np.abs(new - g)[~flagged].max(initial=0.0), new
        if i % 2 and change < tolerance:
            break
    return np.where(flagged, np.nan, g), flagged


def reference_gains(g: np.ndarray, flagged: np.ndarray, chain: list[int]) -> np.ndarray:
    """Turn phases so that the first unflagged antenna of the chain has none."""
    for i in chain:
        if not flagged[i] and abs(g[i]) > 0:
            return g * np.conj(g[i]) / abs(g[i])
    return g


def fringe_peak(vis: np.ndarray, weight: np.ndarray, dt: float, df: float, pad: int = 4) -> tuple[float, float, float, float]:
    """Delay (s), rate (Hz), phase and signal-to-noise of a (time, channel) block: padded transform of unit phasors, refined at the peak."""
    unit = np.where(np.abs(vis) > 0, vis / np.where(np.abs(vis) > 0, np.abs(vis), 1), 0) * weight
    nt, nf = (int(2 ** np.ceil(np.log2(pad * n))) for n in vis.shape)
    at = np.unravel_index(np.abs(np.fft.fft2(unit, (nt, nf))).argmax(), (nt, nf))
    rate, delay = np.fft.fftfreq(nt, dt)[at[0]], np.fft.fftfreq(nf, df)[at[1]]
    t, f = np.arange(vis.shape[0]) * dt, np.arange(vis.shape[1]) * df
    step_r, step_d = 1 / (nt * dt), 1 / (nf * df)
    for _ in range(6):  # zoom
        rates, delays = rate + step_r * np.linspace(-1, 1, 9), delay + step_d * np.linspace(-1, 1, 9)
        z = np.exp(-2j * np.pi * np.outer(rates, t)) @ unit @ np.exp(-2j * np.pi * np.outer(f, delays))
        i, j = np.unravel_index(np.abs(z).argmax(), z.shape)
        rate, delay, step_r, step_d = rates[i], delays[j], step_r / 3, step_d / 3
    total = weight.sum()
    peak = min(abs(z[i, j]), 0.999 * total)
    snr = np.tan(np.pi / 2 * peak / total) ** 1.163 * np.sqrt(total / np.sqrt((weight**2).sum() / max(1, (weight > 0).sum())))
    return delay, rate, float(np.angle(z[i, j])), float(snr)


def fringe_global(delay: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, reference: int) -> np.ndarray:
    """Antenna parameters x with delay ~ x[a] - x[b], x[reference] = 0, weighted least squares; unseen ones NaN."""
    design = np.zeros((len(delay), n))
    design[np.arange(len(delay)), a] += 1
    design[np.arange(len(delay)), b] -= 1
    free = [i for i in range(n) if i != reference]
    root = np.sqrt(weight)
    x = np.full(n, np.nan)
    x[free] = np.linalg.lstsq(design[:, free] * root[:, None], delay * root, rcond=None)[0]
    x[[i for i in free if not design[:, i].any()]] = np.nan
    x[reference] = 0.0
    return x


def _piecewise(values: np.ndarray, good: np.ndarray, pieces: int, degree: int) -> np.ndarray:
    n = len(values)
    fit = np.ones(n)
    for part in np.array_split(np.arange(n), pieces):
        ok = part[good[part]]
        if len(ok):
            x = part / n
            fit[part] = np.polyval(np.polyfit(x[good[part]], values[ok], min(degree, len(ok) - 1)), x) if len(ok) > 1 else values[ok].mean()
    return fit


def crop_plane(amp: np.ndarray, flags: np.ndarray, freq_cutoff: float = 3.0, time_cutoff: float = 4.0, pieces: int = 7, degree: int = 4) -> np.ndarray:
    """Flags of a (time, channel) plane: a smooth fit of the mean band, then of the mean series, divided out, and lines clipped about 1 until their scatter settles."""
    flags = flags | ~np.isfinite(amp)
    for axis, cutoff, p, d in ((0, freq_cutoff, pieces, degree), (1, time_cutoff, 1, 1)):
        good = ~flags
        count = good.sum(axis=axis)
        line = np.where(count > 0, np.where(good, amp, 0).sum(axis=axis) / np.maximum(count, 1), 0)
        fit = _piecewise(line, count > 0, min(p, max(1, len(line) // 8)), d)
        base = np.expand_dims(np.where(np.abs(fit) > 0, fit, 1), axis)
        ratio = amp / base
        for i in range(ratio.shape[axis]):
            sel = (i, slice(None)) if axis == 0 else (slice(None), i)
            before = np.inf
            for _ in range(5):
                ok = ~flags[sel]
                if not ok.any():
                    break
                rms = np.sqrt(((ratio[sel][ok] - 1) ** 2).mean())
                if before - rms < 0.1 * rms and np.isfinite(before):
                    break
                flags[sel] |= np.abs(ratio[sel] - 1) > cutoff * rms
                before = rms
    return flags


def fit_jitter(r2: np.ndarray, base: np.ndarray, m2: np.ndarray) -> float:
    """Fractional jitter f at which the median of r2 / (base + f^2 m2) is ln 2, by bisection in [0, 3]."""
    lo, hi = 0.0, 3.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.median(r2 / (base + mid * mid * m2)) > np.log(2) else (lo, mid)
    return (lo + hi) / 2


def cover_plan(snr: pd.DataFrame, priority: dict[str, int], min_snr: float, independent: int = 2) -> list[dict]:
    """Greedy stages of scans that cover all (antenna, hand) pairs detected in some scan (scan, source_rank, antenna, hand, snr).

    A later stage's reference must be covered already; failing that, a stage of its own may gain
    `independent` new antennas. The best candidate has the highest source rank, new pairs, median snr.
    """
    good = snr[snr["snr"] >= min_snr]
    wanted = set(zip(good["antenna"], good["hand"]))
    done: set = set()
    stages = []
    scans = {k: g for k, g in good.groupby("scan")}
    while wanted - done:
        options = []
        for apart in (False, True):
            for scan, g in scans.items():
                pairs = set(zip(g["antenna"], g["hand"]))
                new = pairs - done
                hands = {h for _, h in new}
                refs = [a for a in g["antenna"].unique() if all((a, h) in pairs for h in hands) and (not stages or apart or all((a, h) in done for h in hands))]
                if new and refs and (not apart or not stages or len({a for a, _ in new}) >= independent):
                    options.append((g["source_rank"].iloc[0], len(new), g["snr"].median(), -scan, min(refs, key=lambda a: (priority.get(a, 1 << 30), a)), new))
            if options or not stages:
                break
        if not options:
            break
        best = max(options, key=lambda o: o[:4])
        stages.append({"scan": -best[3], "reference": best[4], "gained": sorted(best[5])})
        done |= best[5]
    return stages


TERMS = "scan int, antenna int, term double, error double"


def terms_per_scan(vis: DataFrame, antennas: int) -> DataFrame:
    """Additive antenna terms of log amplitudes per scan, from baseline means taken in Spark."""
    base = vis.filter("antenna1 <> antenna2 AND NOT flag AND amp > 0").groupBy("scan", "antenna1", "antenna2").agg(F.avg(F.log("amp")).alias("v"), F.count("*").cast("double").alias("w"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["antenna1", "antenna2"])
        g, err, _ = antenna_terms(pdf["v"].to_numpy(), pdf["w"].to_numpy(), pdf["antenna1"].to_numpy(), pdf["antenna2"].to_numpy(), antennas)
        seen = np.isfinite(g)
        return pd.DataFrame({"scan": pdf["scan"].iloc[0], "antenna": np.flatnonzero(seen), "term": g[seen], "error": err[seen]})

    return base.groupBy("scan").applyInPandas(solve, TERMS)


def fractions_per_scan(vis: DataFrame, antennas: int) -> DataFrame:
    """On-source factors per scan from each baseline's median over its median of all scans."""
    med = vis.filter("antenna1 <> antenna2 AND NOT flag").groupBy("scan", "antenna1", "antenna2").agg(F.median("amp").alias("m"))
    level = med.groupBy("antenna1", "antenna2").agg(F.median("m").alias("level"))
    ratio = med.join(F.broadcast(level), ["antenna1", "antenna2"]).select("scan", "antenna1", "antenna2", (F.col("m") / F.col("level")).alias("r"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r, use = np.zeros((antennas, antennas)), np.zeros((antennas, antennas), bool)
        a, b = pdf["antenna1"], pdf["antenna2"]
        r[a, b] = r[b, a] = pdf["r"]
        use[a, b] = use[b, a] = True
        g = on_source_fraction(r, use)
        seen = np.flatnonzero(use.any(axis=1))
        return pd.DataFrame({"scan": pdf["scan"].iloc[0], "antenna": seen, "fraction": g[seen]})

    return ratio.groupBy("scan").applyInPandas(solve, "scan int, antenna int, fraction double")


def gains_per_scan(vis: DataFrame, antennas: int) -> DataFrame:
    """Complex gains per scan; the phase of a visibility is its v coordinate as radians over ten."""
    z = vis.filter("antenna1 <> antenna2 AND NOT flag").withColumn("p", F.col("v") / 10)
    sums = z.groupBy("scan", "antenna1", "antenna2").agg(F.sum(F.col("weight") * F.col("amp") * F.cos("p")).alias("re"), F.sum(F.col("weight") * F.col("amp") * F.sin("p")).alias("im"), F.sum("weight").alias("w"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        cross, w = np.zeros((antennas, antennas), complex), np.zeros((antennas, antennas))
        a, b = pdf["antenna1"], pdf["antenna2"]
        cross[a, b] = pdf["re"] + 1j * pdf["im"]
        cross[b, a] = np.conj(cross[a, b])
        w[a, b] = w[b, a] = pdf["w"]
        g, flagged = antenna_gains(cross, w)
        g = reference_gains(g, flagged, list(range(antennas)))
        k = np.flatnonzero(~flagged)
        return pd.DataFrame({"scan": pdf["scan"].iloc[0], "antenna": k, "amplitude": np.abs(g[k]), "phase": np.angle(g[k])})

    return sums.groupBy("scan").applyInPandas(solve, "scan int, antenna int, amplitude double, phase double")


def fringes(rows: DataFrame) -> DataFrame:
    """Delay, rate, phase, snr of every vector taken as 8 times of 8 channels of a phase in turns."""

    def solve(batches):
        for pdf in batches:
            out = [fringe_peak(np.exp(2j * np.pi * np.asarray(x, float).reshape(8, 8)), np.ones((8, 8)), 1.0, 1.0) for x in pdf["embedding"]]
            yield pd.concat([pdf[["vec_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["delay", "rate", "phase", "snr"])], axis=1)

    return rows.select("vec_id", "embedding").mapInPandas(solve, "vec_id long, delay double, rate double, phase double, snr double")


def crop_rows(rows: DataFrame) -> DataFrame:
    """Flagged cells of each group of vectors taken as the time-channel plane of a subband, in chunks of 64 rows."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        plane = 1 + np.abs(np.stack([np.asarray(x, float) for x in pdf["embedding"]]))
        flags = crop_plane(plane, np.zeros(plane.shape, bool))
        return pd.DataFrame({"vec_id": pdf["vec_id"], "n_flagged": flags.sum(axis=1)})

    cells = rows.select("label", F.floor(F.col("vec_id") / 640).alias("chunk"), "vec_id", "embedding")
    return cells.groupBy("label", "chunk").applyInPandas(solve, "vec_id long, n_flagged long")


def forest_predictions(docs: DataFrame, labels: DataFrame, trees: int = 20, depth: int = 4, seed: int = 11, folds: int = 5) -> DataFrame:
    """Random-forest predictions of quality from simple text features, nulls imputed by medians of the training rows.

    A labelled document is predicted by the forest of the other folds (by hash of its id), an unlabelled one by fold 0's.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import Imputer, VectorAssembler

    text = F.coalesce("text", F.lit(""))
    names = ["n_chars", "symbols", "capitals", "words"]
    x = docs.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(F.regexp_replace(text, r"[^#*$%&|<>]", "")) / F.nullif(F.length(text), F.lit(0))).alias("symbols"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / F.nullif(F.length(text), F.lit(0))).alias("capitals"),
        F.size(F.split(text, r"\s+")).cast("double").alias("words"),
    )
    x = x.join(labels.select("doc_id", "quality"), "doc_id", "left")
    x = x.withColumn("fold", F.when(F.col("quality").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int"))).cache()
    out = None
    for k in range(folds):
        train = x.filter((F.col("fold") != k) & F.col("quality").isNotNull())
        imputer = Imputer(strategy="median", inputCols=names, outputCols=names).fit(train)
        assemble = VectorAssembler(inputCols=names, outputCol="features").transform
        model = RandomForestClassifier(labelCol="quality", numTrees=trees, maxDepth=depth, seed=seed).fit(assemble(imputer.transform(train)))
        part = model.transform(assemble(imputer.transform(x.filter(F.col("fold") == k)))).select("doc_id", F.col("prediction").cast("int").alias("predicted"))
        out = part if out is None else out.unionByName(part)
    return out


def stage_plan(snr: DataFrame, min_snr: float) -> DataFrame:
    """cover_plan over a survey table, which is small: one row per scan, antenna and hand."""
    spark = snr.sparkSession
    best = snr.groupBy("scan", "antenna", "hand").agg(F.max("source_rank").alias("source_rank"), F.max("snr").alias("snr"))
    stages = cover_plan(best.toPandas(), {}, min_snr)
    rows = [(i, int(st["scan"]), str(st["reference"]), a, h) for i, st in enumerate(stages) for a, h in st["gained"]]
    return spark.createDataFrame(rows, "stage int, scan int, reference string, antenna string, hand string")


def _survey(s, d):
    e = series(s, d)
    return e.select(F.col("day").alias("scan"), F.lit(1).alias("source_rank"), (F.col("user_id") % 10).cast("string").alias("antenna"), F.when(F.col("event_id") % 2 == 0, "r").otherwise("l").alias("hand"), (F.col("value") / 10).alias("snr"))


def _planted(s, d) -> DataFrame:
    """Visibilities that are products of known gains of their antennas, in scans of 600 days."""
    v = visibilities(s, d).withColumn("scan", F.floor(F.col("day") / 600).cast("int"))
    size = lambda k: 10 + (F.col(k) * 3 + F.col("scan") + 20) % 5
    turn = lambda k: F.when(F.col(k) == 0, 0.0).otherwise((F.col(k) * 5 + F.col("scan") + 20) % 7 / 2.0 - 1.5)
    return v.withColumns({"amp": (size("antenna1") * size("antenna2")).cast("double"), "v": 10 * (turn("antenna1") - turn("antenna2"))})


def _planted_gains(s, d):
    out = gains_per_scan(_planted(s, d), 8)
    return out.select("scan", "antenna", F.round("amplitude", 4).alias("amplitude"), (F.round(F.cos("phase"), 4) + 0.0).alias("cos"), (F.round(F.sin("phase"), 4) + 0.0).alias("sin"))


def _planted_terms(s, d):
    out = terms_per_scan(_planted(s, d), 8)
    return out.select("scan", "antenna", F.round("term", 5).alias("term"))


QUERIES = {
    "gain_als_planted": _planted_gains,
    "antenna_terms_planted": _planted_terms,
    "antenna_terms_ls": lambda s, d: terms_per_scan(visibilities(s, d), 8),
    "on_source_fraction": lambda s, d: fractions_per_scan(visibilities(s, d), 8),
    "gain_als": lambda s, d: gains_per_scan(visibilities(s, d), 8),
    "fringe_fft": lambda s, d: fringes(table(s, d, "embeddings")),
    "tfcrop_plane": lambda s, d: crop_rows(table(s, d, "embeddings")),
    "forest_predict": lambda s, d: forest_predictions(table(s, d, "documents"), table(s, d, "labels")),
    "stage_plan": lambda s, d: stage_plan(_survey(s, d), 7.0),
}
_TRUTH = """WITH v AS (SELECT CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 600.0) AS INT) AS scan, unnest([l_suppkey % 8, l_partkey % 8])::INT AS antenna FROM lineitem WHERE l_returnflag <> 'R' AND l_suppkey % 8 <> l_partkey % 8),
  e AS (SELECT DISTINCT scan, antenna, 10 + (antenna * 3 + scan + 20) % 5 AS a, CASE WHEN antenna = 0 THEN 0 ELSE (antenna * 5 + scan + 20) % 7 / 2.0::DOUBLE - 1.5 END AS p FROM v)"""
# Planted truth.
SQL = {
    "gain_als_planted": _TRUTH + " SELECT scan, antenna, round(a::DOUBLE, 4) AS amplitude, round(cos(p), 4) + 0.0 AS cos, round(sin(p), 4) + 0.0 AS sin FROM e",
    "antenna_terms_planted": _TRUTH + " SELECT scan, antenna, round(ln(a), 5) AS term FROM e",
}
