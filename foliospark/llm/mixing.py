"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a share of a budget by weight, at most max_repeat times its own size; what is above is shared
out again by weight. A source's target is taken as whole passes over it plus a part of one more pass. The part is
every document whose hash lies under a threshold: sizes are summed by source and hash bucket, the bucket where the
budget ends is found, and only that bucket is split again by the next hash bits, until a bucket holds one hash
value. No rows are sorted, moved by source or gathered; what reaches the driver is one row for each source.

Weights are a parameter with one entry for each source, so sources fit on the driver by definition.

Defined results: a null or empty text has size 0 and takes 0 words. A null source is a source of its own, last in
order. Rows that agree on doc_id and text have one hash; if the budget ends among such rows, as many of them are taken
as bring the source nearest to its target, dealt by a salt of the row. A single boundary document is taken if that
brings the source nearer to its target. An empty table gives no rows. Extra columns are kept by
mix_sources; columns with the name of an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.llm.common import cut, read_table, words_in

HASH_BITS = 60
LEVEL_BITS = 12
#: Sources up to which thresholds are broadcast (about 100 bytes each); beyond that they are joined by shuffle.
BROADCAST_SOURCES = 50_000

#: Fixed values of the contract.
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_RATIO = 1.5
MAX_REPEAT = 2.0


def cyclic_weights(sources, cycle=WEIGHTS) -> dict:
    """Weights for sources in code point order, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def water_fill(sizes: Mapping, weights: Mapping, budget: float, max_repeat: float) -> dict:
    """Target of each source: its share of the budget by weight, none above max_repeat times its size."""
    targets = {s: 0.0 for s in sizes}
    open_, rest = [s for s in sizes if sizes[s] > 0 and weights.get(s, 0) > 0], float(budget)
    while open_:
        level = rest / sum(weights[s] for s in open_)
        above = [s for s in open_ if weights[s] * level > max_repeat * sizes[s]]
        if not above:
            targets.update({s: weights[s] * level for s in open_})
            break
        for s in above:
            targets[s] = max_repeat * sizes[s]
            rest -= targets[s]
        open_ = [s for s in open_ if s not in set(above)]
    return targets


#: m_full: whole passes; m_part: whether a part pass follows, m_rest: its budget; m_edge: take hashes under it; m_take:
#: how many of the m_ties rows that have this hash to take too; m_salt: if only some, those whose salt is no larger.
_PLAN = "m_source string, source_size long, target double, m_full long, m_part boolean, m_rest double, m_edge long, m_ties long, m_take long, m_salt long"


def _with_plan(df: DataFrame, plan: list[list]) -> DataFrame:
    small = df.sparkSession.createDataFrame(plan, _PLAN)
    small = F.broadcast(small) if len(plan) <= BROADCAST_SOURCES else small
    return df.join(small, df["m_key"].eqNullSafe(small["m_source"]), "inner")


def sized_rows(docs: DataFrame, kept: list[str], *, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    """kept columns with size, m_hash (60 bits of id and text), m_key (the source) and m_own (a salt of the row)."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 64 - HASH_BITS)
    return docs.select(*kept, words_in(F.col(text_col)).alias("size"), h.alias("m_hash"), F.col(source_col).alias("m_key"), F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS).alias("m_own"))


def _boundaries(sums: DataFrame) -> DataFrame:
    """The bucket of each source in which its budget ends (its last one, if none), its size, its rows and the sizes before it."""
    run = sums.select("*", F.sum("n").over(Window.partitionBy("m_key").orderBy("b")).alias("upto"), F.max("b").over(Window.partitionBy("m_key")).alias("end"))
    hit = run.where((F.col("upto") >= F.col("m_rest")) | (F.col("b") == F.col("end")))
    return hit.groupBy("m_key").agg(F.min(F.struct("b", "upto", "n", "c")).alias("x")).select("m_key", "x.b", (F.col("x.upto") - F.col("x.n")).alias("before"), "x.n", "x.c")


def _refine(sized: DataFrame, rows: dict) -> dict:
    """{source: (size, rows)} of the hash at which each source's budget ends; rows of _PLAN get it and the rest of their budget."""
    shift, found = HASH_BITS, {}
    while shift > 0 and rows:
        edge = _with_plan(sized, list(rows.values())).where(F.shiftright("m_hash", shift) == F.col("m_edge"))
        shift -= LEVEL_BITS
        sums = edge.groupBy("m_key", "m_rest", F.shiftright("m_hash", shift).alias("b")).agg(F.sum("size").alias("n"), F.count("*").alias("c"))
        for r in _boundaries(sums).collect():  # one row for each source
            row = rows[r["m_key"]]
            row[5], row[6] = row[5] - r["before"], r["b"]
            found[r["m_key"]] = (r["n"], r["c"])
    return found


def plan_mix(sized: DataFrame, weights: Mapping | None, budget_ratio: float, max_repeat: float) -> list[list]:
    """One row of _PLAN for each source. sized: rows of sized_rows, best read from a checkpoint."""
    sizes = {r["m_key"]: int(r["n"]) for r in sized.groupBy("m_key").agg(F.sum("size").alias("n")).collect()}
    weights = cyclic_weights(sizes) if weights is None else weights
    targets = water_fill(sizes, weights, budget_ratio * sum(sizes.values()), max_repeat)
    rows = {}
    for s, n in sizes.items():
        full = int(targets[s] // n) if n else 0
        rows[s] = [s, n, targets[s], full, targets[s] > full * n, targets[s] - full * n, 0, 0, 0, -1]
    for s, (n, c) in _refine(sized, {s: r for s, r in rows.items() if r[4]}).items():
        rows[s][7], rows[s][8] = c, min(c, max(0, math.floor(rows[s][5] * c / n + 0.5))) if n else 0
    return list(rows.values())


def deal_ties(sized: DataFrame, plan: list[list]) -> list[list]:
    """The plan with m_salt, for sources that take only some of the rows with their boundary hash. sized must be fixed: a checkpoint."""
    some = {r[0]: [*r[:5], float(r[8]), 0, 0, 0, -1] for r in plan if 0 < r[8] < r[7]}
    if some:
        ties = _with_plan(sized, [r for r in plan if r[0] in some]).where("m_hash = m_edge")
        _refine(ties.select("m_key", F.col("m_own").alias("m_hash"), F.lit(1).alias("size")), some)
    return [[*r[:9], some[r[0]][6]] if r[0] in some else r for r in plan]


def apply_mix(sized: DataFrame, plan: list[list]) -> DataFrame:
    """The rows with size, source_size, target, copies and taken instead of the columns of sized_rows."""
    tied = (F.col("m_hash") == F.col("m_edge")) & ((F.col("m_take") == F.col("m_ties")) | (F.col("m_own") <= F.col("m_salt")))
    part = F.col("m_part") & ((F.col("m_hash") < F.col("m_edge")) | tied)
    out = _with_plan(sized, plan).withColumn("copies", F.col("m_full") + part.cast("long"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("m_hash", "m_key", "m_own", "m_source", "m_full", "m_part", "m_rest", "m_edge", "m_ties", "m_take", "m_salt")


def mix_sources(docs: DataFrame, weights: Mapping | None = None, *, budget_ratio: float = BUDGET_RATIO, max_repeat: float = MAX_REPEAT, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    """docs with size, source_size, target, copies (times the mix takes the row) and taken (words it takes)."""
    columns = dict(text_col=text_col, source_col=source_col, id_col=id_col, seed=seed)
    plan = plan_mix(cut(sized_rows(docs, [], **columns)), weights, budget_ratio, max_repeat)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    rows = sized_rows(docs, kept, **columns)
    if any(0 < r[8] < r[7] for r in plan):
        rows = cut(rows)  # equal rows are told apart by their salts, which a second reading might deal otherwise
        plan = deal_ties(rows, plan)
    return apply_mix(rows, plan)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    sized = cut(sized_rows(read_table(spark, sf_dir, "documents"), ["doc_id"]))
    plan = deal_ties(sized, plan_mix(sized, None, BUDGET_RATIO, MAX_REPEAT))
    return apply_mix(sized, plan).select("doc_id", "size", "source_size", "target", "taken")
