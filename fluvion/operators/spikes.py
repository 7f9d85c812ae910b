"""Implausible readings in time series, judged against each series' own behaviour.

Each series is modelled by a robust first-order autoregression of its logarithms. Wherever an innovation is large, patches
of additive outliers are tested against a level shift and against floods, by what each leaves of the residuals, with
thresholds in innovation scales; what is found is taken out, the model is fitted again, and the tests repeat. Runs of one
value are held against the series' own habit of repeating values at that level, and values beyond physical limits are
flagged as they are.

Readings travel in chunks of one series and one span of time with margins on both sides, so that the longest
series never meets in one task; within a task, all chunks of a partition are worked on together by array
operations, with no Python loop over series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What no river carries: m3/s, mg/L, t/day. Below 0 is impossible for all of them.
LIMITS = {"q": 5e5, "ssc": 1.6e6, "ssl": 5e8}
FILL = -9999.0
#: What a flood keeps of its logarithm from one reading to the next, where the model's lag says less.
RECESSION = 0.7
#: Share of a patch's mean deviation that its first and its last step must have.
EDGE = 0.68
#: Upper quantiles of the innovations that the scale has to cover, with their normal values.
QUANTILES = ((0.9, 1.645), (0.95, 1.96), (0.98, 2.326))


def _segment_quantiles(values: np.ndarray, seg: np.ndarray, n: int, qs: tuple[float, ...], default: float) -> list[np.ndarray]:
    """Quantiles (the mean of the two nearest order statistics) of the finite values in each segment 0..n-1; segments ascend."""
    ok = np.isfinite(values)
    v, s = values[ok], seg[ok]
    order = np.argsort(v, kind="stable")
    order = order[np.argsort(s[order], kind="stable")]  # small whole numbers in runs: a radix or merge sort
    v = v[order]
    counts = np.bincount(s, minlength=n)
    start = np.r_[0, np.cumsum(counts)[:-1]]
    has = counts > 0
    made = []
    for q in qs:
        out = np.full(n, default)
        at = (counts[has] - 1) * q
        out[has] = (v[start[has] + np.floor(at).astype(int)] + v[start[has] + np.ceil(at).astype(int)]) / 2
        made.append(out)
    return made


def _segment_quantile(values: np.ndarray, seg: np.ndarray, n: int, q: float, default: float) -> np.ndarray:
    return _segment_quantiles(values, seg, n, (q,), default)[0]


def _robust_ar(y: np.ndarray, seg: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment: its level, the lag coefficient (Huber weights, two rounds) and the scale of its innovations.

    The scale is the larger of the normalised median of the absolute innovations and what their upper quantiles would be
    the quantiles of: floods make innovations long-tailed, and a river that jumps often has to be allowed its jumps.
    """
    level = _segment_quantile(y, seg, n, 0.5, 0.0)
    c = y - level[seg]
    same = seg[1:] == seg[:-1]
    a, b, s = c[:-1][same], c[1:][same], seg[1:][same]
    phi = np.full(n, 0.9)
    scale = np.full(n, 0.05)
    for _ in range(2):
        e = np.abs(b - phi[s] * a)
        scale = np.maximum(_segment_quantile(e, s, n, 0.5, 0.05) * 1.4826, 0.004)
        w = 1.0 / np.maximum(1.0, e / (1.5 * scale[s]))
        top, low = np.bincount(s, w * a * b, n), np.bincount(s, w * a * a, n)
        phi = np.where(low > 1e-9, np.clip(top / np.maximum(low, 1e-9), 0.0, 0.995), 0.9)
    # of each reading the least innovation from any of the few before it: a single outlier spoils its own alone
    least = np.full(len(c), np.inf)
    for j in range(1, 4):
        ok = seg[j:] == seg[:-j]
        f = phi[seg[j:]]
        over = np.abs(c[j:] - f**j * c[:-j]) / np.sqrt((1.0 - f ** (2 * j)) / (1.0 - f**2))
        least[j:] = np.where(ok, np.minimum(least[j:], over), least[j:])
    for found, (_, z) in zip(_segment_quantiles(least, seg, n, tuple(q for q, _ in QUANTILES), 0.0), QUANTILES):
        scale = np.maximum(scale, found / z)
    return level, phi, scale


def _patch_test(c: np.ndarray, e: np.ndarray, t: np.ndarray, length: int, phi: np.ndarray, sd: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For patches of ``length`` readings from ``t``: the least standardised deviation of their readings (same sign; else 0) from
    what the readings on both sides predict, and the evidence for a patch against a shift or a flood, in variances.

    Under the model the patch's readings, given their neighbours c[t-1] and c[t+length], are normal around an interpolation.
    It must be entered and left in one step each, of at least ``EDGE`` of its mean deviation and twice the step before or
    after (where ``inner`` says that there is one); a flood rises and falls by and by.
    A patch leaves the one residual from the reading before it to the reading after it. A shift (a change that stays) or
    a flood (one that dies away by the model's lag or by ``RECESSION`` a reading) leaves what its course, of the best size, does
    not explain. The evidence is the least of these sums of squares less that of the patch.
    """
    p2 = phi * phi
    span = 1.0 - p2 ** (length + 1)
    left, right = c[t - 1], c[t + length]
    z = np.full(len(t), np.inf)
    sign = np.sign(e[t])
    height = np.zeros(len(t))
    for j in range(length):
        near, far = 1.0 - p2 ** (j + 1), 1.0 - p2 ** (length - j)
        mean = (phi ** (j + 1) * far * left + phi ** (length - j) * near * right) / span
        dev = sd * np.sqrt(near * far / ((1.0 - p2) * span))
        off = sign * (c[t + j] - mean)
        height += off / length
        z = np.minimum(z, off / dev)
    edges = np.minimum(sign * (c[t] - left), sign * (c[t + length - 1] - right))
    at = np.clip(np.stack([t - 2, t + length + 1]), 0, len(c) - 1)
    shoulder = np.maximum(sign * (left - c[at[0]]), sign * (right - c[at[1]]))
    z = np.where((edges >= EDGE * height) & ((edges >= 2.0 * shoulder) | ~inner), z, 0.0)
    across = (right - phi ** (length + 1) * left) ** 2 / (span / (1.0 - p2))
    total = sum(e[t + j] ** 2 for j in range(length + 1))
    other = np.full(len(t), np.inf)
    for stays in (np.ones(len(t)), np.maximum(phi, RECESSION), np.full(len(t), RECESSION)):
        x = [np.ones(len(t))] + [stays ** (j - 1) * (stays - phi) for j in range(1, length + 1)]
        along = sum(x[j] * e[t + j] for j in range(length + 1))
        other = np.minimum(other, total - along**2 / sum(v * v for v in x))
    return np.maximum(z, 0.0), (other - across) / sd**2


def _resolution(y: np.ndarray, seg: np.ndarray, n: int) -> np.ndarray:
    """What one step of a series' rounding is worth on the log scale at each reading; the step is a low quantile of its changes."""
    v = 10.0**y
    change = np.abs(np.diff(v))
    ok = (seg[1:] == seg[:-1]) & (change > 0)
    step = _segment_quantile(np.where(ok, change, np.nan), seg[1:], n, 0.1, 0.0)
    return np.log10(1.0 + step[seg] / v)


def _spikes(y: np.ndarray, seg: np.ndarray, day: np.ndarray, n: int, sigmas: float, longest: int, rounds: int, helped: np.ndarray | None) -> np.ndarray:
    """Patches of additive outliers among the readings of all segments: a mask.

    Each round fits the model to what is left, tests patches of one to ``longest`` readings wherever an innovation is
    large, and takes out those whose every reading is ``sigmas`` deviations off and for which a patch explains the
    residuals better than a level shift or a flood. ``helped`` readings (an input they derive from is wrong) need half of it.
    """
    out, active = np.zeros(len(y), bool), np.ones(n, bool)
    for _ in range(rounds if len(y) else 0):
        idx = np.flatnonzero(~out & active[seg])
        v, s, d = y[idx], seg[idx], day[idx]
        level, phi_of, scale_of = _robust_ar(v, s, n)
        phi = phi_of[s]
        c = v - level[s]
        # of the reading before and after a step the one with the finer resolution (a fall to zero has none)
        coarse = _resolution(v, s, n)
        sd = np.hypot(scale_of[s], np.minimum(coarse, np.r_[coarse[:1], coarse[:-1]]))
        first = np.r_[True, s[1:] != s[:-1]]
        last = np.r_[s[1:] != s[:-1], True]
        e = c - phi * np.r_[0.0, c[:-1]]
        e[first] = 0.0
        need = np.full(len(v), sigmas)
        if helped is not None:
            need = np.where(helped[idx], sigmas / 2, need)
        pace = np.maximum(_segment_quantile(np.where(s[1:] == s[:-1], np.diff(d), np.nan).astype(float), s[1:], n, 0.5, 1.0), 1.0)
        hit = np.zeros(len(v), bool)
        big = np.flatnonzero(np.abs(e) >= need * sd)
        for length in range(1, longest + 1):
            t = big[~hit[big]]
            t = t[(t + length < len(v)) & ~first[t]]
            t = t[(s[t + length] == s[t]) & (d[t + length - 1] - d[t] <= 3 * longest * pace[s[t]])]
            if not len(t):
                continue
            inner = ~first[np.maximum(t - 1, 0)] & ~last[t + length]
            z, evidence = _patch_test(c, e, t, length, phi[t], sd[t], inner)
            ok = t[(z >= need[t]) & (evidence >= 2 * need[t] + length - 1)]
            for k in range(length):
                hit[ok + k] = True
        # at the ends of a series one side has to do, for one or two readings that are farther off; the two readings on
        # the other side must agree with each other, else it may be the series that moves
        for length in (1, 2):
            for edge, step in ((first, 1), (last, -1)):
                t = np.flatnonzero(edge)
                b = t + step * length
                far = b + 2 * step
                t = t[(far >= 0) & (far < len(v))]
                b, far = t + step * length, t + step * (length + 2)
                keep = (s[far] == s[t]) & ~hit[t]
                t, b = t[keep], b[keep]
                if not len(t):
                    continue
                z = np.full(len(t), np.inf)
                sign = np.sign(c[t] - c[b])
                for k in range(length):
                    j = length - k  # steps from the patch's reading to the next good one
                    dev = sd[t] * np.sqrt((1.0 - phi[t] ** (2 * j)) / (1.0 - phi[t] ** 2))
                    z = np.minimum(z, sign * (c[t + step * k] - phi[t] ** j * c[b]) / dev)
                calm = (np.abs(c[b] - c[b + step]) < 0.5 * np.abs(c[t + step * (length - 1)] - c[b])) & (np.abs(c[b] - c[b + 2 * step]) < 0.5 * np.abs(c[t + step * (length - 1)] - c[b]))
                ok = t[(z >= 1.25 * need[t]) & calm]
                for k in range(length):
                    hit[ok + step * k] = True
        if not hit.any():
            break
        out[idx[hit]] = True
        active = np.zeros(n, bool)
        active[s[hit]] = True  # a series without a find is settled
    return out


def _stuck(x: np.ndarray, seg: np.ndarray, least: int, level: float, quiet: np.ndarray | None = None) -> np.ndarray:
    """Runs of one value that are longer than the series' own rate of repeats at that level explains: a mask. A run over
    ``quiet`` rows, on which what the value derives from repeats itself too, is explained.

    Rates come from running counts of repeats over the series in order of value, so the work is a sort, however many runs
    a series has.
    """
    out = np.zeros(len(x), bool)
    if not len(x):
        return out
    new = np.r_[True, (x[1:] != x[:-1]) | (seg[1:] != seg[:-1])]
    start = np.flatnonzero(new)
    length = np.diff(np.r_[start, len(x)])
    k = (length >= least) & (x[start] != 0)
    i, run = start[k], length[k]
    if not len(i):
        return out
    if quiet is not None:
        q = np.r_[0, np.cumsum(quiet)]
        held = (q[i + run] - q[i + 1]) / np.maximum(run - 1, 1) < 0.9
        i, run = i[held], run[held]
    v, s = x[i], seg[i]
    # readings in order of (series, value): those within 35 % of the run's value are a stretch of that order
    order = np.lexsort((x, seg))
    repeats = np.r_[0, np.cumsum(~new[order])]
    n = int(seg[-1]) + 1
    bounds = np.searchsorted(seg, np.arange(n + 1))
    wide = 0.35 * np.abs(v)
    lo, hi = _within(x[order], bounds, s, v - wide, "left"), _within(x[order], bounds, s, v + wide, "right")
    whole = bounds[s + 1] - bounds[s]
    rest, ties = whole - run, repeats[bounds[s + 1]] - repeats[bounds[s]] - (run - 1)
    near, near_ties = hi - lo - run, repeats[hi] - repeats[lo] - (run - 1)
    everywhere = ties / np.maximum(rest, 1)
    # a coarsely rounded series repeats itself everywhere, and at low values most: the larger rate counts, and
    # where there is little else to go by nothing is flagged
    p = np.maximum((near_ties + 10 * everywhere + 0.05) / (near + 10), everywhere)
    for a, m in zip(i[(rest >= 20) & (whole * p ** (run - 1) < level)], run[(rest >= 20) & (whole * p ** (run - 1) < level)]):
        out[a : a + m] = True
    return out


def _within(ordered: np.ndarray, bounds: np.ndarray, seg: np.ndarray, value: np.ndarray, side: str) -> np.ndarray:
    """Positions of ``value`` in the stretch of its segment (each in ascending order), by bisection over all at once."""
    lo, hi = bounds[seg].copy(), bounds[seg + 1].copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        at = ordered[np.minimum(mid, len(ordered) - 1)]
        right = open_ & ((at < value) if side == "left" else (at <= value))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def flag_readings(seg: np.ndarray, day: np.ndarray, values: dict[str, np.ndarray], limits: dict[str, float], sigmas: float = 6.5, longest: int = 5, rounds: int = 4, least_run: int = 5, run_level: float = 1e-5, derived: str | None = "ssl") -> dict[str, np.ndarray]:
    """0 plausible, 1 spike, 2 stuck, 3 impossible for each reading; rows in order of series and day."""
    n = int(seg[-1]) + 1 if len(seg) else 0
    flags, wrong = {}, np.zeros(len(seg), bool)
    quiet, changed = np.zeros(len(seg), bool), np.zeros(len(seg), bool)  # some input repeats itself, none changes
    product, inputs = np.zeros(len(seg)), 0  # sum of the inputs' logarithms where all are there and plausible
    for name in sorted(values, key=lambda v: v == derived):
        x = values[name]
        f = np.zeros(len(x), np.int8)
        there = np.isfinite(x) & (np.abs(x - FILL) > 1e-5)
        bad = there & ((x < 0) | (x > limits.get(name, np.inf)))
        f[bad] = 3
        k = np.flatnonzero(there & ~bad)
        s, v = seg[k], x[k]
        low = _segment_low(v, s, n)
        y = np.log10(np.maximum(v, low[s]))
        stuck = _stuck(v, s, least_run, run_level, quiet[k] if name == derived else None)
        spike = _spikes(y, s, day[k], n, sigmas, longest, rounds, wrong[k] if name == derived else None)
        if name == derived and inputs:
            spike &= ~_explained(y - product[k], s, n)
        f[k[stuck]] = 2
        f[k[spike & ~stuck]] = 1
        if name != derived:
            wrong |= (f == 1) | bad
            tie = np.r_[False, (v[1:] == v[:-1]) & (s[1:] == s[:-1])] if len(v) else np.zeros(0, bool)
            quiet[k[tie]] = True
            changed[k[~tie]] = True
            quiet &= ~changed
            own = np.full(len(x), np.nan)
            own[k] = np.where(spike | stuck | (v <= 0), np.nan, y)
            product, inputs = product + own, inputs + 1
        flags[name] = f
    return flags


def _explained(ratio: np.ndarray, seg: np.ndarray, n: int) -> np.ndarray:
    """Readings whose log ratio to the product of their plausible inputs is that of their series: a flood in the inputs is
    one in what derives from them. Only where most of a series keeps that ratio; NaN (an input missing or flagged) is no."""
    if not len(ratio):
        return np.zeros(0, bool)
    off = np.abs(ratio - _segment_quantile(ratio, seg, n, 0.5, np.nan)[seg])
    usual = _segment_quantile(off, seg, n, 0.75, np.inf)[seg]
    return np.nan_to_num(off, nan=np.inf) <= np.where(usual < 0.05, np.maximum(3 * usual, 0.02), 0.0)


def _segment_low(v: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    """Where a zero is put on the log scale of each segment: a twentieth of the 2 % quantile of its positive values, so that
    spikes downwards keep a decade of room."""
    ok = v > 0
    order = np.lexsort((v[ok], s[ok]))
    w, t = v[ok][order], s[ok][order]
    counts = np.bincount(t, minlength=n)
    start = np.r_[0, np.cumsum(counts)[:-1]]
    out = np.full(n, 1e-6)
    has = counts > 0
    out[has] = w[start[has] + (counts[has] * 2) // 100] / 2
    return np.maximum(out / 10, 1e-12)


def implausible_readings(df: DataFrame, record_id: str, series: str, date: str, variables: list[str], limits: dict[str, float] | None = None, span_days: int = 32768, margin_days: int = 400, sigmas: float = 6.5) -> DataFrame:
    """Readings that cannot be true: record_id, variable, reason ('spike', 'stuck' or 'impossible').

    A spike is a patch of up to five readings that a robust autoregression of the logarithms finds ``sigmas`` innovation
    scales off what both sides predict, and that is explained better as a patch than as a level shift or a flood. A load
    that follows from plausible inputs is none. Every reading of a stuck run is given, the first
    too. Null, NaN and -9999 are no readings. Rows of one record_id count once; rows without series or date are
    left out; other columns are not read. A series of up to ``span_days`` (ninety years) is judged whole; a longer one in spans of
    that length with ``margin_days`` of context, so a task holds at most that many days of one series at a time.
    """
    limits = LIMITS if limits is None else limits
    day = F.unix_date(F.col(date).cast("date"))
    chunk = lambda d: F.floor(d / span_days).cast("int")
    rid_type = df.schema[record_id].dataType.simpleString()
    x = df.select(F.col(record_id).alias("id"), F.col(series).alias("series"), day.alias("day"), *[F.col(v).cast("double").alias(v) for v in variables]).filter("series is not null and day is not null and id is not null")
    first, last = chunk(F.col("day") - margin_days), chunk(F.col("day") + margin_days)
    x = x.withColumn("chunk", F.explode(F.when(first == last, F.array(first)).otherwise(F.array(first, last))))
    x = x.repartition("series", "chunk").sortWithinPartitions("series", "chunk", "day", "id")
    names = np.array(["", "spike", "stuck", "impossible"], dtype=object)

    def work(table: pa.Table) -> pa.RecordBatch:
        code = table["series"].combine_chunks().dictionary_encode()
        code = (code.indices if isinstance(code, pa.DictionaryArray) else code).to_numpy(zero_copy_only=False).astype(np.int64)
        chunk_no, day_no, ids = (table[c].to_numpy() for c in ("chunk", "day", "id"))
        start = np.r_[True, (code[1:] != code[:-1]) | (chunk_no[1:] != chunk_no[:-1])]
        once = start | np.r_[True, ids[1:] != ids[:-1]] | np.r_[True, day_no[1:] != day_no[:-1]]
        seg = np.cumsum(start)[once] - 1
        d = day_no[once].astype(np.int64)
        values = {v: table[v].to_numpy()[once].astype(float) for v in variables}
        flags = flag_readings(seg, d, values, limits, sigmas)
        core = (d // span_days) == chunk_no[once]
        out_id, out_var, out_why = [], [], []
        kept = ids[once]
        for v, f in flags.items():
            k = np.flatnonzero((f > 0) & core)
            out_id.append(kept[k])
            out_var.append(np.full(len(k), v, dtype=object))
            out_why.append(names[f[k]])
        id_type = table.schema.field("id").type
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_id), id_type), pa.array(np.concatenate(out_var), pa.string()), pa.array(np.concatenate(out_why), pa.string())], names=["id", "variable", "reason"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < 150_000:
                continue
            t = pa.Table.from_batches(held)
            s, c = t["series"], t["chunk"].to_numpy()
            # the last chunk may go on in the next batch
            k = len(c) - 1
            last_series = s[k].as_py()
            back = len(c) - 1 - np.argmax(c[::-1] != c[k]) if (c != c[k]).any() else -1
            tail = s.slice(max(back + 1, 0)).combine_chunks()
            differ = pc.not_equal(tail, last_series).to_numpy(zero_copy_only=False)
            cut = max(back + 1, 0) + (np.flatnonzero(differ)[-1] + 1 if differ.any() else 0)
            if cut > 0:
                yield work(t.slice(0, cut).combine_chunks())
                held = t.slice(cut).to_batches()
                rows = len(c) - cut
        if held and rows:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return x.mapInArrow(run, f"id {rid_type}, variable string, reason string").withColumnRenamed("id", record_id)
