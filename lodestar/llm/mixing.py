"""Problem 8: sources mixed to target shares of tokens, small ones repeated up to a cap.

Method: pivotal dependent rounding. The largest total is taken at which every source can give its share within its cap; a
document of a source is then wanted a fractional number of times. The whole part is sure; fractions are rounded in pairs:
tokens move at random from one document to another until one of the two fractions is 0 or 1, so expectations hold and the
tokens of the source stay as they are. Documents are paired in blocks of bounded size; the one fraction that each block
leaves goes up a reduction tree and meets those of other blocks. The last fraction of a source is drawn by itself; the tokens
that its rounding adds or takes are made up by a few documents of the source that fit them, taken from a bounded pool.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lodestar.llm.tokens import document_sizes
from lodestar.runtime import cut_lineage, table

BLOCK_DOCUMENTS = 20_000
FAN_IN = 64
#: Documents of a source from which the last fraction's rounding is made up.
POOL = 512
_CLOSE = 1e-9


def pivot(p: float, w: float, q: float, v: float, chance: float) -> tuple[float, float]:
    """Moves weight between two fractions until one is 0 or 1; p * w + q * v stays, and so do both expectations."""
    up, down = min((1 - p) * w, q * v), min(p * w, (1 - q) * v)
    move = up if chance * (up + down) < down else -down
    p, q = p + move / w, q - move / v
    return tuple(0.0 if x < _CLOSE else 1.0 if x > 1 - _CLOSE else x for x in (p, q))


def round_fractions(fractions: np.ndarray, weights: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Rounds all but at most one of the fractions to 0 or 1 by pivoting each with the one still open."""
    out, chances, held = fractions.astype(float).tolist(), draw.random(len(fractions)).tolist(), -1
    for i, w in enumerate(weights.tolist()):
        if not _CLOSE < out[i] < 1 - _CLOSE:
            out[i] = float(round(out[i]))
            continue
        if held >= 0:
            out[held], out[i] = pivot(out[held], float(weights[held]), out[i], w, chances[i])
        if 0 < out[i] < 1:
            held = i
        elif held >= 0 and not 0 < out[held] < 1:
            held = -1
    return np.array(out)


_ROW = "mix_name string, source string, block long, doc_id long, tokens int, base int, p double"


def _round_block(level: int, seed: int):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        mark = [seed, level, int(rows["block"].iloc[0]), *f"{rows['mix_name'].iloc[0]}/{rows['source'].iloc[0]}".encode()]
        return rows.assign(p=round_fractions(rows["p"].to_numpy(), rows["tokens"].to_numpy(float), np.random.default_rng(mark)))

    return work


def _make_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents of one source's pool whose tokens together come closest from below to what is missing or too much."""
    left, chosen = abs(float(rows["missing"].iloc[0])), []
    for at, tokens in rows.sort_values(["tokens", "doc_id"], ascending=[False, True])["tokens"].items():
        if tokens <= left:
            chosen.append(at)
            left -= tokens
    return rows.loc[chosen, ["mix_name", "source", "doc_id"]]


def mix_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, max_repeats, wanted, documents): how often each document of a source is wanted.

    Sources without tokens, shares or caps that are not positive, and null names take no part; the shares of the others are
    scaled to sum to 1.
    """
    have = sizes.groupBy("source").agg(F.sum(F.col("tokens").cast("double")).alias("tokens"), F.count("*").alias("documents"))
    rows = targets.dropna().where("target_share > 0 AND max_repeats > 0").groupBy("mix_name", "source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = rows.join(have, "source")
    # Aggregates and plain joins: one row for each source of a mix.
    sums = rows.groupBy("mix_name").agg(F.sum("target_share").alias("all_shares"))
    rows = rows.join(sums, "mix_name").withColumn("share", F.col("target_share") / F.col("all_shares"))
    total = rows.groupBy("mix_name").agg(F.min(F.col("tokens") * F.col("max_repeats") / F.col("share")).alias("total"))
    wanted = F.least(F.col("share") * F.col("total") / F.col("tokens"), F.col("max_repeats").cast("double"))
    return rows.join(total, "mix_name").select("mix_name", "source", "target_share", "max_repeats", wanted.alias("wanted"), "documents")


def mix_sources(sizes: DataFrame, targets: DataFrame, seed: int = 20) -> DataFrame:
    """(mix_name, source, doc_id, tokens, uses, target_share, share_reached): the documents used in each mix.

    ``sizes`` has doc_id, source and tokens; ``targets`` mix_name, source, target_share and max_repeats (a short table).
    Null sources and documents without tokens take no part; repeated rows count once; other columns are not read. A mix
    whose sources have no documents, and empty tables, give no rows. The same seed gives the same result.
    """
    sizes = sizes.select("doc_id", "source", "tokens").where("source IS NOT NULL AND tokens > 0").distinct()
    plan = cut_lineage(mix_plan(sizes, targets.select("mix_name", "source", "target_share", "max_repeats")))
    largest = plan.agg(F.max("documents")).first()[0] or 0
    base = F.floor(F.col("wanted") + F.lit(_CLOSE)).cast("int")
    blocks = F.ceil(F.col("documents") / BLOCK_DOCUMENTS)
    rows = sizes.join(F.broadcast(plan), "source").select(  # one row for each source of a mix: as short as the targets
        "mix_name", "source", F.pmod(F.xxhash64("doc_id"), blocks).alias("block"), "doc_id", "tokens", base.alias("base"), F.greatest(F.col("wanted") - base, F.lit(0.0)).alias("p")
    )
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    done, width, level = [], max(1, math.ceil(largest / BLOCK_DOCUMENTS)), 0
    while True:
        rounded = cut_lineage(rows.groupBy("mix_name", "source", "block").applyInPandas(_round_block(level, seed), _ROW))
        done.append(rounded.where(~open_))
        rows = rounded.where(open_).withColumn("block", F.floor(F.col("block") / FAN_IN))
        if width == 1:
            break
        width, level = math.ceil(width / FAN_IN), level + 1
    # At most one fraction a source is left; it is drawn by itself, and other documents make up for it.
    chance = F.pmod(F.xxhash64("mix_name", "source", F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003)
    last = cut_lineage(rows.withColumn("drawn", F.when(chance < F.col("p"), 1.0).otherwise(0.0)))
    used = done[0]
    for part in done[1:]:
        used = used.unionByName(part)
    missing = last.select("mix_name", "source", ((F.col("p") - F.col("drawn")) * F.col("tokens")).alias("missing"))
    pool = used.join(F.broadcast(missing), ["mix_name", "source"]).where(  # one row for each source of a mix
        (F.col("tokens") <= F.abs("missing")) & (F.col("p") == F.when(F.col("missing") > 0, 0.0).otherwise(1.0))
    )
    place = F.row_number().over(W.partitionBy("mix_name", "source").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id"))
    pool = pool.withColumn("place", place).where(F.col("place") <= POOL)
    changed = pool.groupBy("mix_name", "source").applyInPandas(_make_up, "mix_name string, source string, doc_id long").withColumn("changed", F.lit(True))
    used = used.join(changed, ["mix_name", "source", "doc_id"], "left").withColumn("p", F.when(F.col("changed"), 1 - F.col("p")).otherwise(F.col("p"))).drop("changed")
    used = used.unionByName(last.withColumn("p", F.col("drawn")).drop("drawn"))
    used = used.withColumn("uses", F.col("base") + F.col("p").cast("int")).where("uses > 0")
    reached = used.groupBy("mix_name", "source").agg(F.sum(F.col("tokens").cast("long") * F.col("uses")).alias("of_source"))
    whole = reached.groupBy("mix_name").agg(F.sum("of_source").alias("of_mix"))
    shares = reached.join(whole, "mix_name").join(plan.select("mix_name", "source", "target_share"), ["mix_name", "source"])
    shares = shares.select("mix_name", "source", "target_share", F.round(F.col("of_source") / F.col("of_mix"), 6).alias("share_reached"))
    return used.join(F.broadcast(shares), ["mix_name", "source"]).select("mix_name", "source", "doc_id", "tokens", "uses", "target_share", "share_reached")


def p8_mix(spark: SparkSession, root: str) -> DataFrame:
    return mix_sources(document_sizes(spark, root), table(spark, root, "mix_targets"))


def p8_shares(spark: SparkSession, root: str) -> DataFrame:
    """Of each source of a mix: documents, most uses of one, tokens with repeats, and the share reached beside the target."""
    mix = p8_mix(spark, root)
    return mix.groupBy("mix_name", "source", "target_share", "share_reached").agg(
        F.count("*").alias("documents"), F.max("uses").alias("most_uses"), F.sum(F.col("tokens").cast("long") * F.col("uses")).alias("tokens_used")
    )


def p8_checks(spark: SparkSession, root: str) -> DataFrame:
    """Of each source of a mix: documents used too often or not of that source, and whether its tokens miss the plan by one document at most."""
    sizes = cut_lineage(document_sizes(spark, root).where("source IS NOT NULL AND tokens > 0").distinct())
    targets = table(spark, root, "mix_targets")
    plan = mix_plan(sizes, targets).join(sizes.groupBy("source").agg(F.sum(F.col("tokens").cast("double")).alias("have"), F.max("tokens").alias("largest")), "source")
    mix = mix_sources(sizes, targets).select("mix_name", "source", "doc_id", "uses").join(sizes.select("doc_id", F.col("source").alias("true_source"), "tokens"), "doc_id", "left")
    caps = plan.select("mix_name", "source", "max_repeats")
    used = mix.join(F.broadcast(caps), ["mix_name", "source"], "left").groupBy("mix_name", "source").agg(  # as short as the targets
        F.count_if(~F.coalesce(F.col("uses") <= F.col("max_repeats"), F.lit(False))).alias("over_cap"),
        F.count_if(~F.col("source").eqNullSafe(F.col("true_source"))).alias("foreign"), F.sum(F.col("uses").cast("double") * F.col("tokens")).alias("used"),
    )
    off = F.abs(F.coalesce("used", F.lit(0.0)) - F.col("wanted") * F.col("have"))
    rows = plan.join(used, ["mix_name", "source"], "left")
    return rows.select("mix_name", "source", F.coalesce("over_cap", F.lit(0)).alias("over_cap"), F.coalesce("foreign", F.lit(0)).alias("foreign"), (off <= F.col("largest") + 1e-6 * F.col("have")).alias("on_plan"))


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares, "p8_checks": p8_checks}
ORACLES = {
    "p8_checks": r"""
SELECT DISTINCT mix_name, source, CAST(0 AS BIGINT) AS over_cap, CAST(0 AS BIGINT) AS "foreign", true AS on_plan FROM mix_targets
WHERE target_share > 0 AND max_repeats > 0 AND source IN (SELECT regexp_replace(lower(trim(source)), '[\s-]+', '_', 'g') FROM documents WHERE source IS NOT NULL AND text <> '')"""
}
