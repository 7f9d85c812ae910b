"""Mixing sources to target weights by iterative proportional fitting and calibrated sampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.session import drop_tables, materialize

BINS = 4096  # bins of the sampling order within a source


def rake(cells: pd.DataFrame, targets: pd.DataFrame, total: float, margins: tuple[str, ...], rounds: int = 200, tolerance: float = 1e-9) -> pd.DataFrame:
    """Weights w of the cells so that sum(w * tokens) meets the source targets exactly, and the shares of the other
    margins as nearly as the caps (w at most max_repeats of the source) allow.

    ``cells``: source, the margins, tokens. ``targets``: source, target_share, max_repeats. The other margins'
    targets are the shares that each value has in the cells as they are. A source whose tokens times max_repeats
    stay below its target has weight max_repeats throughout; the others keep their own targets.
    """
    c = cells.merge(targets, on="source").reset_index(drop=True)
    c["w"] = np.minimum(c["target_share"] * total / c.groupby("source")["tokens"].transform("sum").clip(lower=1), c["max_repeats"].astype(float))
    goal = {m: c.groupby(m)["tokens"].sum() / max(c["tokens"].sum(), 1) for m in margins}
    want = (targets.set_index("source")["target_share"] * total).to_dict()
    cap, tokens = c["max_repeats"].to_numpy(float), c["tokens"].to_numpy(float)
    sources = c.groupby("source").indices
    for _ in range(rounds):
        old = c["w"].to_numpy().copy()
        w = old.copy()
        for m in margins:
            now = pd.Series(w * tokens).groupby(c[m].to_numpy()).sum()
            factor = (goal[m] * (w * tokens).sum() / now.replace(0, np.nan)).fillna(1.0).clip(0.2, 5.0)
            w = np.minimum(w * c[m].map(factor).to_numpy(float), cap)
        for s, k in sources.items():  # source last: its shares are the ones that must hold
            free = np.ones(len(k), bool)
            for _ in range(30):
                short = want[s] - (w[k][~free] * tokens[k][~free]).sum()
                have = (w[k][free] * tokens[k][free]).sum()
                if have <= 0:
                    break
                f = short / have
                x = w[k].copy()
                x[free] = w[k][free] * f
                over = free & (x > cap[k])
                x = np.minimum(x, cap[k])
                w[k] = x
                if not over.any():
                    break
                free &= ~over
        c["w"] = w
        if np.max(np.abs(w - old), initial=0.0) < tolerance:
            break
    return c


def mix(documents: DataFrame, targets: DataFrame, doc_id: str, source: Column, tokens: str, language: Column, topic: Column, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Draw a mix and report its shares.

    ``documents`` needs ``doc_id`` and ``tokens``; ``targets`` has source, target_share, max_repeats (a small table of
    configuration, read whole). Sources are compared without case and padding. The mix is to be as large as all
    documents of listed sources together; each source gets target_share of that, no document more than
    max_repeats copies. A source that cannot fill its share gives all documents max_repeats times, and stays
    short; the report says so.

    First result: doc_id, source, n_tokens, copies (>= 1). Second, a row a value of each margin: margin (source, language, topic),
    value, target_share, max_repeats, documents, tokens_available, tokens_target, tokens_mixed, share_of_target_size, actual_share,
    filled (max_repeats and filled for sources only). Documents of unlisted or null sources and documents without tokens
    are not drawn. Empty inputs give no documents and zero shares. A language that is not a code of two or three letters counts
    as '?', and topics are few, so the cells that the driver rakes are bounded by the targets, not by the documents.

    Weights come from iterative proportional fitting over cells of source x language x topic (aggregated first).
    Each document gets the whole part of its weight; the rest is drawn in an order set by a hash over the fraction
    (order sampling with those probabilities) until the source has its tokens. The cut in that order is found
    on sums of bins of the order, so no source is ever sorted as a whole.
    """
    spark = documents.sparkSession
    want = targets.select(F.lower(F.trim("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).filter("source is not null").dropDuplicates(["source"])
    goals = want.toPandas()
    docs = documents.select(F.col(doc_id).alias("doc_id"), source.alias("source"), F.when(language.rlike("^[a-z]{2,3}$"), language).otherwise("?").alias("language"), F.coalesce(topic, F.lit("?")).alias("topic"), F.col(tokens).cast("bigint").alias("n_tokens"))
    docs = docs.filter("doc_id is not null and n_tokens > 0").join(F.broadcast(want), "source")  # bounded by the configuration
    cells = docs.groupBy("source", "language", "topic").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    local = cells.toPandas()
    total = float(local["tokens"].sum())
    raked = rake(local, goals, total, ("language", "topic"))
    weights = spark.createDataFrame(raked[["source", "language", "topic", "w"]], "source string, language string, topic string, w double")
    docs = docs.join(F.broadcast(weights), ["source", "language", "topic"])  # as many rows as cells
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**31)) + 0.5) / float(2**31)
    docs = docs.withColumn("base", F.least(F.floor(F.col("w") + 1e-9), F.col("max_repeats")).cast("int"))
    docs = docs.withColumn("part", F.when(F.col("base") < F.col("max_repeats"), F.greatest(F.lit(0.0), F.col("w") - F.col("base"))).otherwise(0.0))
    # sequential order sampling: rank = u (1-p) / (p (1-u)); monotone map to 0..1 for the bins
    ratio = u * (1 - F.col("part")) / F.greatest(F.col("part") * (1 - u), F.lit(1e-300))
    docs = docs.withColumn("rank", F.when(F.col("part") > 0, ratio / (1 + ratio)).otherwise(2.0)).withColumn("bin", F.least(F.floor(F.col("rank") * BINS), F.lit(BINS)).cast("int"))
    # what the whole parts leave open, and in which bin it runs out
    sums = docs.groupBy("source", "bin").agg(F.sum(F.col("base") * F.col("n_tokens")).alias("fixed"), F.sum(F.when(F.col("part") > 0, F.col("n_tokens")).otherwise(0)).alias("open"), F.sum("n_tokens").alias("all"), F.count("*").alias("n")).toPandas()
    cuts = []
    for g in goals.itertuples(index=False):
        s = sums[sums["source"] == g.source].sort_values("bin")
        left = g.target_share * total - float(s["fixed"].sum())
        run = s["open"].to_numpy(float).cumsum() if len(s) else np.array([])
        k = int(np.searchsorted(run, left, side="right"))
        cuts.append((g.source, int(s["bin"].iloc[k]) if k < len(s) else BINS + 1, left - (float(run[k - 1]) if 0 < k <= len(run) else 0.0)))
    cut = spark.createDataFrame(cuts, "source string, cut_bin int, still double") if cuts else spark.createDataFrame([], "source string, cut_bin int, still double")
    docs = docs.join(F.broadcast(cut), "source")
    # that bin is cut into bins once more: what is put in order is 1 / BINS ** 2 of a source
    inner = F.least(F.floor((F.col("rank") * BINS - F.col("bin")) * BINS), F.lit(BINS - 1)).cast("int")
    docs = docs.withColumn("inner", F.when((F.col("bin") == F.col("cut_bin")) & (F.col("part") > 0), inner))
    fine = docs.filter("inner is not null").groupBy("source", "inner").agg(F.sum("n_tokens").alias("open")).toPandas()
    cuts2 = []
    for name, _, still in cuts:
        f = fine[fine["source"] == name].sort_values("inner")
        run = f["open"].to_numpy(float).cumsum()
        k = int(np.searchsorted(run, still, side="right"))
        cuts2.append((name, int(f["inner"].iloc[k]) if k < len(f) else BINS, still - (float(run[k - 1]) if 0 < k <= len(run) else 0.0)))
    docs = docs.drop("still").join(F.broadcast(spark.createDataFrame(cuts2, "source string, cut_inner int, still double")), "source")
    at_edge = (F.col("inner") == F.col("cut_inner")) & F.col("inner").isNotNull()
    edge = docs.filter(at_edge)
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("run", F.sum("n_tokens").over(w)).withColumn("more", F.when(F.abs(F.col("run") - F.col("still")) <= F.abs(F.col("run") - F.col("n_tokens") - F.col("still")), 1).when(F.col("run") <= F.col("still"), 1).otherwise(0))
    taken = (F.col("part") > 0) & ((F.col("bin") < F.col("cut_bin")) | F.coalesce(F.col("inner") < F.col("cut_inner"), F.lit(False)))
    rest = docs.filter(~F.coalesce(at_edge, F.lit(False))).withColumn("more", F.when(taken, 1).otherwise(0))
    cols = ["doc_id", "source", "language", "topic", "n_tokens", (F.col("base") + F.col("more")).cast("int").alias("copies")]
    drawn = edge.select(*cols).unionByName(rest.select(*cols)).filter("copies > 0")
    # a row a value of each margin, from one pass over the drawn and the cells
    values = lambda: F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in ("source", "language", "topic")])).alias("v")
    had = cells.select(values(), "tokens", "n").groupBy("v.margin", "v.value").agg(F.sum("tokens").alias("tokens_available"), F.sum("n").alias("documents"))
    got = drawn.select(values(), (F.col("copies") * F.col("n_tokens")).alias("t")).groupBy("v.margin", "v.value").agg(F.sum("t").alias("tokens_mixed"))
    listed = want.select(F.lit("source").alias("margin"), F.col("source").alias("value"), "target_share", "max_repeats")
    report = had.join(got, ["margin", "value"], "left").join(F.broadcast(listed), ["margin", "value"], "full")
    size = drawn.agg(F.coalesce(F.sum(F.col("copies") * F.col("n_tokens")), F.lit(0)).alias("size"))
    report = report.na.fill(0, ["tokens_available", "documents", "tokens_mixed"]).withColumn("target_share", F.coalesce("target_share", F.round(F.col("tokens_available") / F.greatest(F.lit(total), F.lit(1.0)), 6)))
    report = report.join(F.broadcast(size)).select("margin", "value", "target_share", "max_repeats", "documents", "tokens_available", F.round(F.col("target_share") * total).cast("bigint").alias("tokens_target"), "tokens_mixed", F.round(F.col("tokens_mixed") / F.greatest(F.lit(total), F.lit(1.0)), 6).alias("share_of_target_size"), F.round(F.coalesce(F.col("tokens_mixed") / F.nullif("size", F.lit(0)), F.lit(0.0)), 6).alias("actual_share"), (F.col("tokens_available") * F.col("max_repeats") >= F.col("target_share") * total).alias("filled"))
    return drawn.drop("language", "topic"), report


def topics(documents: DataFrame, doc_id: str, text: str, k: int = 8, features: int = 1 << 12, seed: int = 42) -> DataFrame:
    """``documents`` with a topic, t0 to t{k-1}: clusters of hashed word counts, weighted by rarity.

    Weights and clusters are fitted on all documents, whose counts are written down once; every document is then put into
    its nearest cluster by built-in expressions. Null and blank texts have the topic '?'.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF, Normalizer

    words = documents.withColumn("_w", F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w) > 2))
    tf = HashingTF(inputCol="_w", outputCol="_tf", numFeatures=features)
    counts = materialize(tf.transform(words.filter(F.size("_w") > 0).select("_w")).select("_tf"))
    if counts.isEmpty():
        return documents.withColumn("topic", F.lit("?"))
    idf = IDF(inputCol="_tf", outputCol="_x", minDocFreq=2).fit(counts)
    unit = Normalizer(inputCol="_x", outputCol="_u")
    model = KMeans(featuresCol="_u", predictionCol="_t", k=k, seed=seed, maxIter=8, initSteps=2).fit(unit.transform(idf.transform(counts)))
    drop_tables(counts)
    out = model.transform(unit.transform(idf.transform(tf.transform(words))))
    return out.withColumn("topic", F.when(F.size("_w") == 0, "?").otherwise(F.concat(F.lit("t"), F.col("_t").cast("string")))).select(*documents.columns, "topic")
