"""Problem 7: documents put into packs of fixed capacity with little room unused.

Method: a grouping genetic algorithm. Its genes are whole packs: crossover puts well-filled packs of one parent into the
other, drops the packs that now hold a document twice, and puts the displaced documents back by best fit; mutation empties
a few badly filled packs. Documents are hashed into shards of bounded size; each shard has several islands with populations
of their own, which run as Spark groups and after each epoch send their best to the next island. Badly filled packs of all
shards are then opened and their documents packed once more together. A document larger than a pack is cut into full packs
and a rest; nothing else is split.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.tokens import document_sizes
from lodestar.runtime import cut_lineage, spread, table

SHARD_ITEMS = 1_200
ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITE = 2, 3, 12, 8, 3
#: Packs filled less than this are opened for the second round.
GOOD_FILL = 0.985


def best_fit(sizes: np.ndarray, capacity: int, order: np.ndarray, genes: np.ndarray, room: list[int]) -> None:
    """Puts the items of ``order`` into the fullest pack that has room, or a new one; changes ``genes`` and ``room``.

    Packs are kept sorted by room and found by bisection.
    """
    free = sorted((r, at) for at, r in enumerate(room) if r > 0)
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        place = bisect_left(free, (size, -1))
        if place < len(free):
            left, at = free.pop(place)
        else:
            left, at = capacity, len(room)
            room.append(capacity)
        left -= size
        room[at] = left
        genes[item] = at
        if left > 0:
            insort(free, (left, at))


def fills(sizes: np.ndarray, genes: np.ndarray) -> np.ndarray:
    return np.bincount(genes, weights=sizes)


def fitness(sizes: np.ndarray, genes: np.ndarray, capacity: int) -> float:
    """Mean squared fill of the packs, which favours full packs and one nearly empty over several half full."""
    full = fills(sizes, genes)
    full = full[np.bincount(genes) > 0] / capacity
    return float((full**2).mean())


def _refill(sizes: np.ndarray, capacity: int, genes: np.ndarray, loose: np.ndarray, draw: np.random.Generator, disorder: float = 0.08) -> np.ndarray:
    """Renumbers the packs that keep items and puts the loose items back, larger ones first with a little disorder."""
    held = np.ones(len(genes), bool)
    held[loose] = False
    out = np.full(len(genes), -1, np.int64)
    _, out[held] = np.unique(genes[held], return_inverse=True)
    room = (capacity - np.bincount(out[held], weights=sizes[held])).astype(np.int64).tolist() if held.any() else []
    order = loose[np.argsort(-sizes[loose] * draw.uniform(1 - disorder, 1 + disorder, len(loose)), kind="stable")]
    best_fit(sizes, capacity, order, out, room)
    return out


def crossover(sizes: np.ndarray, capacity: int, one: np.ndarray, two: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Injects packs of ``two`` into ``one``: of the better-filled half of its packs, whatever their fill, about six in ten."""
    full = fills(sizes, two)
    chosen = np.flatnonzero((full >= np.median(full)) & (draw.random(len(full)) < 0.6))
    injected = np.isin(two, chosen)
    hurt = np.isin(one, np.unique(one[injected]))
    child = np.where(injected, two + int(one.max()) + 1, one)
    return _refill(sizes, capacity, child, np.flatnonzero(hurt & ~injected), draw)


def mutate(sizes: np.ndarray, capacity: int, genes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Empties some packs, mostly badly filled ones for their population, and puts their items back."""
    full = fills(sizes, genes) / capacity
    some = draw.random(len(full)) < np.clip(0.05 + 2 * (np.quantile(full, 0.8) - full), 0.02, 0.9)
    return _refill(sizes, capacity, genes, np.flatnonzero(some[genes]), draw)


def _evolve(rows: pd.DataFrame) -> pd.DataFrame:
    """One epoch of one island: its individuals (none at the start) breed; the best of them come back."""
    first = rows.iloc[0]
    capacity, island, epoch = int(first["capacity"]), int(first["island"]), int(first["epoch"])
    sizes = np.asarray(first["sizes"], dtype=np.int64)
    draw = np.random.default_rng([int(first["shard"]), island, epoch, capacity])
    people = [np.asarray(g, dtype=np.int64) for g in rows["genes"] if g is not None]
    new = lambda disorder: _refill(sizes, capacity, np.zeros(len(sizes), np.int64), np.arange(len(sizes)), draw, disorder)
    people = people or [new(0.0)]  # best fit of the sorted items; those that follow are less and less in order
    fit = [fitness(sizes, g, capacity) for g in people]
    full = lambda: (fills(sizes, people[int(np.argmax(fit))]) < GOOD_FILL * capacity).sum() <= 1
    if not full():  # where all packs but one are full, there is nothing to breed for
        people += [new(0.1 * i) for i in range(len(people), POPULATION)]
        fit = [fitness(sizes, g, capacity) for g in people]
        for _ in range(GENERATIONS):
            parents = [max(draw.choice(len(people), 2, replace=False), key=lambda i: fit[i]) for _ in range(2)]
            for child in (crossover(sizes, capacity, people[parents[0]], people[parents[1]], draw), mutate(sizes, capacity, people[int(np.argmax(fit))], draw)):
                worst = int(np.argmin(fit))
                if (value := fitness(sizes, child, capacity)) > fit[worst]:
                    people[worst], fit[worst] = child, value
            if full():
                break
    best = np.argsort(fit)[::-1][:ELITE]
    out = [(*first[["pack_name", "capacity", "shard"]], island, epoch + 1, first["sizes"], people[i].astype(np.int32), fit[i]) for i in best]
    out.append((*first[["pack_name", "capacity", "shard"]], (island + 1) % ISLANDS, epoch + 1, first["sizes"], people[best[0]].astype(np.int32), fit[best[0]]))
    return pd.DataFrame(out, columns=["pack_name", "capacity", "shard", "island", "epoch", "sizes", "genes", "fit"])


_STATE = "pack_name string, capacity long, shard long, island int, epoch int, sizes array<int>, genes array<int>, fit double"


def _pack_round(items: DataFrame, number: int) -> DataFrame:
    """Packs items (pack_name, capacity, id, part_no, size): adds pack_no (a name) and fill."""
    counts = items.groupBy("pack_name").agg(F.ceil(F.count("*") / SHARD_ITEMS).alias("shards"))  # one row for each pack size
    sharded = items.join(F.broadcast(counts), "pack_name").withColumn("shard", F.pmod(F.xxhash64("id", "part_no", F.lit(number)), F.col("shards")))
    shards = sharded.groupBy("pack_name", "capacity", "shard").agg(F.array_sort(F.collect_list(F.struct("id", "part_no", "size"))).alias("items"))
    shards = cut_lineage(shards)
    state = shards.select(
        "pack_name", "capacity", "shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(0).alias("epoch"),
        F.col("items.size").alias("sizes"), F.lit(None).cast("array<int>").alias("genes"), F.lit(0.0).alias("fit"),
    )
    for _ in range(EPOCHS):
        state = spread(state, "pack_name", "shard", "island").groupBy("pack_name", "shard", "island").applyInPandas(_evolve, _STATE)
    best = state.groupBy("pack_name", "shard").agg(F.max_by("genes", "fit").alias("genes"))
    placed = shards.join(best, ["pack_name", "shard"]).select(
        "pack_name", "capacity", "shard", F.explode(F.arrays_zip("items", "genes")).alias("x")
    )
    placed = placed.select("pack_name", "capacity", "shard", "x.items.*", F.col("x.genes").alias("bin"))
    filled = placed.groupBy("pack_name", "shard", "bin").agg(F.collect_list(F.struct("id", "part_no", "size")).alias("items"), F.sum("size").alias("fill"), F.first("capacity").alias("capacity"))
    name = F.concat_ws("-", F.lit(f"r{number}"), F.col("shard").cast("string"), F.col("bin").cast("string"))
    return filled.select("pack_name", "capacity", name.alias("pack_no"), "fill", "items")


def pack_items(items: DataFrame, item: str, size: str, capacities: DataFrame) -> DataFrame:
    """(pack_name, capacity, pack_no, id, part_no, size): the pack of every item (or part of an item) for every capacity.

    ``capacities`` is a short table of pack_name and capacity_tokens; rows without a positive capacity have no result. An
    item larger than the capacity is split into parts of a full pack each and a rest (part_no 0, 1, ...); all others have
    the one part 0. Items of size null count as 0 and share a pack with others. Repeated rows count once; other columns are
    not read; a null id is an id like others. Empty tables give no rows. Pack numbers mean nothing but identity.
    """
    packs = capacities.select("pack_name", F.col("capacity_tokens").cast("long").alias("capacity")).where("capacity > 0").distinct()
    rows = items.select(F.col(item).alias("id"), F.coalesce(F.col(size).cast("int"), F.lit(0)).alias("size")).distinct()
    # Capacities are parameters: each item is written once for each, and nothing is joined.
    sizes = [F.struct(F.lit(p["pack_name"]).cast("string").alias("pack_name"), F.lit(p["capacity"]).alias("capacity")) for p in packs.collect()]
    each = F.array(*sizes) if sizes else F.array().cast("array<struct<pack_name:string,capacity:bigint>>")
    rows = rows.select("*", F.inline(each))
    full = F.floor(F.col("size") / F.col("capacity")).cast("int")
    rest = (F.col("size") % F.col("capacity")).cast("int")
    large = rows.where("size > capacity").select(
        "pack_name", "capacity", "id", F.explode(F.sequence(F.lit(0), F.when(rest > 0, full).otherwise(full - 1))).alias("part_no"), full.alias("full"), rest.alias("rest")
    )
    large = large.withColumn("size", F.when(F.col("part_no") < F.col("full"), F.col("capacity")).otherwise(F.col("rest")).cast("int"))
    columns = ["pack_name", "capacity", "id", "part_no", "size"]
    own = large.where("part_no < full").select(*columns, F.concat_ws("-", F.lit("own"), F.col("id").cast("string"), F.col("part_no").cast("string")).alias("pack_no"))
    loose = rows.where("size <= capacity").withColumn("part_no", F.lit(0)).select(*columns).unionByName(large.where("part_no = full").select(*columns))
    first = cut_lineage(_pack_round(loose, 1))
    good = F.col("fill") >= GOOD_FILL * F.col("capacity")
    again = _pack_round(first.where(~good).select("pack_name", "capacity", F.explode("items").alias("x")).select("pack_name", "capacity", "x.*"), 2)
    packed = first.where(good).unionByName(again).select("pack_name", "capacity", "pack_no", F.explode("items").alias("x"))
    return packed.select("pack_name", "capacity", "pack_no", "x.id", "x.part_no", "x.size").unionByName(own.select("pack_name", "capacity", "pack_no", "id", "part_no", "size"))


def _packed(spark: SparkSession, root: str) -> DataFrame:
    return pack_items(document_sizes(spark, root), "doc_id", "tokens", table(spark, root, "pack_sizes"))


def p7_packs(spark: SparkSession, root: str) -> DataFrame:
    return _packed(spark, root).select("pack_name", F.col("id").alias("doc_id"), "part_no", "pack_no", F.col("size").alias("tokens"))


def p7_fill(spark: SparkSession, root: str) -> DataFrame:
    """For each capacity: packs, the least number that could do, tokens and the share of room that is used."""
    packed = _packed(spark, root)
    found = packed.groupBy("pack_name", "capacity").agg(F.count_distinct("pack_no").alias("packs"), F.sum("size").alias("tokens"))
    room = F.col("packs") * F.col("capacity")
    return found.select("pack_name", "packs", F.ceil(F.col("tokens") / F.col("capacity")).alias("at_least"), "tokens", F.round(F.col("tokens") / room, 6).alias("used_share"))


def p7_checks(spark: SparkSession, root: str) -> DataFrame:
    """For each capacity: documents with a pack, and how many are lost or changed in size, split without need, or in too full a pack."""
    sizes = document_sizes(spark, root).select("doc_id", "tokens").distinct()
    packed = cut_lineage(pack_items(sizes, "doc_id", "tokens", table(spark, root, "pack_sizes")))
    overfull = packed.groupBy("pack_name", "capacity", "pack_no").agg(F.sum("size").alias("fill")).groupBy("pack_name").agg(F.count_if(F.col("fill") > F.col("capacity")).alias("overfull"))
    whole = packed.groupBy("pack_name", "capacity", F.col("id").alias("doc_id")).agg(F.sum("size").alias("placed"), F.count("*").alias("parts"))
    names = [r["pack_name"] for r in table(spark, root, "pack_sizes").where("capacity_tokens > 0").select("pack_name").distinct().collect()]  # parameters
    rows = sizes.select("*", F.explode(F.array(*map(F.lit, names)).cast("array<string>")).alias("pack_name")).join(whole, ["pack_name", "doc_id"], "left")
    right = F.col("placed").eqNullSafe(F.col("tokens").cast("long"))
    found = rows.groupBy("pack_name").agg(
        F.count("parts").alias("documents"), F.count_if(~right).alias("lost"), F.count_if((F.col("parts") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("split_needlessly")
    )
    return found.join(overfull, "pack_name")


QUERIES = {"p7_packs": p7_packs, "p7_fill": p7_fill, "p7_checks": p7_checks}
ORACLES = {
    "p7_checks": """
SELECT pack_name, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS split_needlessly, CAST(0 AS BIGINT) AS overfull
FROM (SELECT DISTINCT pack_name FROM pack_sizes WHERE capacity_tokens > 0)"""
}
