"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key Exp(1) / weight from a hash of its id, so the smaller keys are a weighted sample without
replacement. A source takes as many complete epochs as its target holds; the rest is taken in the order of the keys,
up to the token budget. The order is never sorted as a whole: sizes are summed by INTERVALS intervals of the key, a prefix
sum over the intervals finds the one in which the budget ends, and only that interval's documents are sorted. The
intervals are quantiles of the keys of about SAMPLE rows, so they hold alike many whatever the weights. A source with a
third of all rows is thus spread over all tasks like any other.

Targets are the fixed point of sharing the total by weight with a limit for each source: min(limit, level * weight). The
sources that stop at their limit are those of the least limit for their weight, so sums over the sources in that order
give the level.

Defined cases: a null text has size 0; documents of size 0 take nothing. Sources go by code point, null last; null is
a source like any other. The key comes from a row's id and text, so rows that share an id, or have none, are spread like
others. Weights that are null, not positive or not finite count as the smallest weight. Other columns are not read, and
may have any names. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacunar.llm.scratch import materialize
from lacunar.llm.textops import Words, slices, trim

WEIGHTS, LIMIT, SHARE = (5.0, 2.0, 1.0), 3.0, 1.0
INTERVALS, SAMPLE = 4096, 1 << 16
RANGE = 100_000  # sources
BROADCAST_SOURCES = 50_000  # rows; beyond that the sources are joined by a shuffle


_good = np.zeros(256, np.int64)
_good[[*range(65, 91), *range(97, 123), 32, *range(128, 256)]] = 1
LEAST_WEIGHT = 1e-6


def _measure(weighted: bool, bounds: np.ndarray | None):
    """Each row with its words, its key and the key's interval. Exp(1) is divided by the quality weight: the given one, or
    the share of a text's bytes that are letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                words = Words(part.column("text"))
                bytes_in = np.diff(words.at[words.docs])
                fine = np.concatenate([np.zeros(1, np.int64), np.cumsum(_good[words.data])])[words.at[words.docs]]
                weight = (np.diff(fine) + 1.0) / (bytes_in + 1.0)
                if weighted:
                    weight = part.column("_mix_weight").to_numpy(zero_copy_only=False).astype(float)
                weight = np.where(np.isfinite(weight), np.maximum(weight, LEAST_WEIGHT), LEAST_WEIGHT)
                key = part.column("_mix_exp").to_numpy() / weight
                interval = np.searchsorted(bounds, key, side="right") if bounds is not None else np.zeros(len(key), np.int64)
                names = [n for n in part.schema.names if not n.startswith("_mix_")]
                new = {"_mix_size": pa.array(np.diff(words.docs)), "_mix_key": pa.array(key), "_mix_interval": pa.array(interval.astype(np.int32)), "_mix_tag": part.column("_mix_tag")}
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *new.values()], names=[*names, *new])
        trim()

    return run


def _keyed(docs: DataFrame, seed: int, weight: str | None, bounds: np.ndarray | None = None) -> DataFrame:
    """docs (doc_id, source, text, ...) with _mix_size, _mix_key, _mix_interval and _mix_tag."""
    tag = F.xxhash64("text")
    u = (F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(0)), tag, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    asked = docs.withColumns({"_mix_tag": tag, "_mix_exp": -F.log(u)} | ({"_mix_weight": F.col(weight).cast("double")} if weight else {}))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], "_mix_size long, _mix_key double, _mix_interval int, _mix_tag long"])
    return asked.mapInArrow(_measure(weight is not None, bounds), schema)


def _bounds(keys: DataFrame) -> np.ndarray:
    """Where the intervals of the keys begin: quantiles of those of about SAMPLE rows with words, chosen by their hash."""
    keys = keys.where("_mix_size > 0")
    share = min(1.0, SAMPLE / max(1, keys.count()))
    chosen = keys.where(F.pmod(F.xxhash64("doc_id", "_mix_tag", F.lit("interval")), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = np.sort(np.array([r[0] for r in chosen.select("_mix_key").limit(2 * SAMPLE).collect()], float))
    return np.unique(found[np.linspace(0, len(found) - 1, INTERVALS).astype(int)][1:]) if len(found) else np.zeros(0)


def _interval(bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(bounds, batch.column("_mix_key").to_numpy(), side="right")
            yield batch.set_column(batch.schema.get_field_index("_mix_interval"), "_mix_interval", pa.array(at.astype(np.int32)))

    return run


def _running(per: DataFrame, order, ranges: int, sums: dict) -> DataFrame:
    """per with running sums (named by `sums`, of columns) up to each row by `order`, without a sort in one task: ranges,
    their sums, then sums within a range."""
    per = materialize(per.repartitionByRange(ranges, order).withColumn("_part", F.spark_partition_id()), "mix-ranges")
    totals = {r["_part"]: r for r in per.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()}
    at = dict.fromkeys(sums, 0)
    before: dict[str, list] = {n: [] for n in sums}
    for part in sorted(totals):
        for n in sums:
            before[n] += [F.lit(part), F.lit(at[n])]
            at[n] += totals[part][n] or 0
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    first = {n: F.element_at(F.create_map(*before[n]), F.col("_part")) if before[n] else F.lit(0) for n in sums}
    return per.withColumns({n: first[n] + F.sum(c).over(within) for n, c in sums.items()}).drop("_part")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, share: float = SHARE) -> DataFrame:
    """source, source_size, target from doc rows with source and size. Every step is an aggregation over one row a source."""
    per = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    n = per.count()
    ranges = max(1, n // RANGE)
    per = _running(per.withColumn("one", F.lit(1)), F.col("source").asc_nulls_last(), ranges, {"turn": "one"})
    w = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialize(per.withColumn("w", w).withColumn("most", F.col("source_size") * limit).withColumn("ratio", F.col("most") / F.col("w")), "mix-weights")
    sums = per.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    total = float(sums["size"] or 0) * share
    # with the sources up to one stopped at their limits, the others would come up to this level
    run = _running(per, F.col("ratio").asc(), ranges, {"stopped": "most", "stopped_w": "w"}).withColumn("left", F.lit(float(sums["w"] or 0)) - F.col("stopped_w"))
    level = F.when(F.col("left") > 1e-9, (F.lit(total) - F.col("stopped")) / F.col("left"))
    # the sources stop as long as each one's limit lies below the level of those behind it and itself
    own = (F.lit(total) - F.col("stopped") + F.col("most")) / (F.col("left") + F.col("w"))
    last = run.where(F.col("ratio") <= own).agg(F.max(F.struct("stopped_w", level.alias("level"))).alias("k")).first()["k"]
    top = (total / float(sums["w"]) if sums["w"] else 0.0) if last is None else last["level"]
    share_of = F.col("most") if top is None else F.least("most", F.lit(float(top)) * F.col("w"))
    return per.select("source", "source_size", share_of.alias("target"))


def _by_source(df: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    right = sources.withColumnRenamed("source", "_mix_source")
    return df.join(F.broadcast(right) if few else right, df["source"].eqNullSafe(right["_mix_source"]), "left").drop("_mix_source")


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, share: float = SHARE, seed: int = 20, weight: str | None = None, carry: bool = False) -> DataFrame:
    """doc_id and source, with `carry` text and all other columns of docs as c0, c1, ..., and _mix_size, _mix_source_size, _mix_target, _mix_epochs
    (how often the document is taken whole) and _mix_part (its first words taken once more).

    `weight`: a column of quality weights in place of the measured ones. With `carry` the texts are measured a second
    time rather than shuffled: what decides is the table of sources, and only the interval where a budget ends is sorted.
    """
    id_, source, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")
    given = [F.col(weight).cast("double").alias("given")] if weight else []
    raw = materialize(_keyed(docs.select(id_, source, text, *given), seed, "given" if weight else None).drop("text", "given"), "mix-keys")
    bounds = _bounds(raw)
    sized = raw.mapInArrow(_interval(bounds), raw.schema)
    sources = targets(sized.select("source", F.col("_mix_size").alias("size")), weights, limit, share)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("budget", F.greatest(F.lit(0), F.round(F.col("target") - F.col("epochs") * F.col("source_size"))).cast("long"))
    sources = materialize(sources, "mix-targets")
    few = sources.count() <= BROADCAST_SOURCES
    per = sized.groupBy("source", F.col("_mix_interval").alias("interval")).agg(F.sum("_mix_size").alias("words"))
    upto = Window.partitionBy("source").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    per = _by_source(per.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))), sources.select("source", "budget"), few)
    last = per.where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("words") >= F.col("budget"))).select("source", F.col("interval").alias("last"), F.col("before").alias("below"))
    ends = materialize(_by_source(sources, last, few).select("source", *[F.col(c).alias("_mix_" + c) for c in ("source_size", "target", "epochs", "budget", "last", "below")]), "mix-ends")
    rows = sized
    if carry:  # columns of docs under names of our own, whatever they are called
        rows = docs.select(id_, source, text, *given, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
        rows = _keyed(rows, seed, "given" if weight else None, bounds)
    marked = _by_source(rows, ends, few)
    at_edge = F.coalesce(F.col("_mix_interval") == F.col("_mix_last"), F.lit(False))
    order = Window.partitionBy("source").orderBy("_mix_key", "doc_id", "_mix_size", "_mix_tag").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("_mix_below") + F.coalesce(F.sum("_mix_size").over(order), F.lit(0))
    edge = marked.where(at_edge).withColumn("_mix_part", F.greatest(F.lit(0), F.least(F.col("_mix_size"), F.col("_mix_budget") - upto)))
    inside = (F.col("_mix_budget") > 0) & (F.col("_mix_last").isNull() | (F.col("_mix_interval") < F.col("_mix_last")))
    rest = marked.where(~at_edge).withColumn("_mix_part", F.when(inside, F.col("_mix_size")).otherwise(0))
    names = ["doc_id", "source", *(["text", *[f"c{i}" for i, c in enumerate(docs.columns) if c != "text"]] if carry else []), "_mix_size", "_mix_source_size", "_mix_target", "_mix_epochs", "_mix_part"]
    return rest.select(*names).unionByName(edge.select(*names))


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    p = plan(docs, **how)
    taken = (F.col("_mix_epochs") * F.col("_mix_size") + F.col("_mix_part")).cast("long")
    return p.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), taken.alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix: a row for each time one is taken, a last part cut after its words. Columns of docs."""
    p = plan(docs, carry=True, **how)
    times = F.col("_mix_epochs") + (F.col("_mix_part") > 0).cast("long")
    p = p.where((times > 0) & (F.col("_mix_size") > 0)).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = (F.col("_mix_copy") > F.col("_mix_epochs")) & (F.col("_mix_part") < F.col("_mix_size"))
    first = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""), F.lit(1), F.col("_mix_part").cast("int")), " ")
    new = F.when(cut, first).otherwise(F.col("text"))
    return p.select(*[(new if c == "text" else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
