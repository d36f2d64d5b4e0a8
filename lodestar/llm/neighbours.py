"""Problem 4: the k most similar vectors of every vector, by an inverted multi-index.

Both halves of the (unit) vectors are quantised with codebooks of their own, fitted on a bounded sample; a pair of
centroids is a cell. Every vector is in the index. A query walks the cells in the order of summed distance, taken from a
heap, until the cells hold enough entries, and those entries are reranked by exact cosine. How many are enough is measured
on each space: a few hundred of its vectors are compared with all others, and walks are as long as TARGET of the neighbours
of these need. Cells lie in blocks of bounded
size, and a block is a file in the checkpoint folder. A task has a bounded number of queries and reads the blocks that hold
cells of their walks one after the other, so every vector is written once, however many walks meet it. Vectors
that are equal are one entry and one query with the k + 1 smallest keys of all, so masses of copies never meet each other.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lodestar.runtime import balance, cut_lineage, ensure_checkpoint_dir, let_workers_import, spread, table

#: Fitted codebooks read at most about SAMPLE vectors of a collection, chosen by hash.
SAMPLE = 20_000
#: Entries that a walk gathers at least, in a space of any size.
CANDIDATES = 1_500
#: Vectors of a space that are compared with all others, and the share of their neighbours that walks have to reach.
PROBES, TARGET = 400, 0.98
BLOCK_ENTRIES = 32_000
#: Queries of a task at most.
BLOCK_QUERIES = 8_000
#: Centroids of a half of a space with 4 x CENTROIDS^2 vectors; smaller and larger spaces have fewer and more (centroids_of).
CENTROIDS = 64
_NONE = np.iinfo(np.int64).min
#: Cells of a walk up to which it is taken from a heap.
SHORT = 150
#: More than a cosine in single precision, and one rounded to 6 places, can be off.
ROUGH = 2e-5
#: A mark is a cosine in millionths times _PLACES less the place of the key among all keys of all spaces.
_PLACES = 2**40


_VECTORS = "space string, key string, key_no long, unit binary, class_id string"


def _numbers(value: object) -> np.ndarray | None:
    """The numbers of a vector given as a list or as JSON text, or None where it is no list of numbers."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
        if not isinstance(value, list) or any(type(x) not in (int, float) for x in value):
            return None
    if value is None or any(x is None for x in value):
        return None
    try:
        return np.array(value, np.float64)
    except OverflowError:
        return None


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spaces, keys, numbers, sizes, vectors = (c.to_pylist() for c in batch.columns)
        out = []
        for space, key, no, size, value in zip(spaces, keys, numbers, sizes, vectors):
            v = None if space is None or key is None else _numbers(value)
            if v is None or len(v) != size or not size:
                continue
            with np.errstate(over="ignore"):
                length = math.sqrt(float(v @ v)) if np.isfinite(v).all() else math.inf
            if 0 < length < math.inf:
                unit = (np.round(v / length, 12) + 0.0).tobytes()
                out.append((space, key, no, unit, hashlib.md5(unit).hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["space", "key", "key_no", "unit", "class_id"])


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(space, key, key_no, unit, class_id) of the rows (space, key, key_no, size, vector) that are usable.

    ``vector`` is an array of numbers or its JSON text. ``unit`` holds the float64 numbers of the vector divided by its
    length, rounded to 12 places, so that scaled copies become equal; ``class_id`` is a hash of it. Vectors that are null,
    broken, not of ``size`` numbers, not finite or all zero have no row, nor have null spaces and keys.
    """
    let_workers_import(rows.sparkSession)
    return balance(rows.select("space", "key", "key_no", "size", "vector")).mapInArrow(_units, _VECTORS)


def _fit(k: int, steps: int = 12):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        """Lloyd's iterations for one half of one collection, seeded by squared distance."""
        x = np.stack([np.frombuffer(u) for u in rows["unit"]])
        middle = x.shape[1] // 2
        x = x[:, middle:] if rows["half"].iloc[0] else x[:, :middle]
        x = x[np.lexsort(x.T[::-1])]
        draw = np.random.default_rng(7)
        k_here = min(k, len(np.unique(x, axis=0)))
        centroids = x[draw.integers(len(x))][None]
        near = ((x - centroids[0]) ** 2).sum(1)
        while len(centroids) < k_here:
            centroids = np.vstack([centroids, x[draw.choice(len(x), p=near / near.sum())]])
            near = np.minimum(near, ((x - centroids[-1]) ** 2).sum(1))
        for _ in range(steps):
            at = ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)
            sums, counts = np.zeros_like(centroids), np.bincount(at, minlength=len(centroids))
            np.add.at(sums, at, x)
            centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
        main = np.linalg.svd(centroids - centroids.mean(0), full_matrices=False)[2][0]
        centroids = centroids[np.argsort(centroids @ main, kind="stable")]  # near ones get near numbers, hence shared blocks
        return pd.DataFrame({"space": rows["space"].iloc[0], "half": rows["half"].iloc[0], "no": np.arange(len(centroids)), "centroid": list(centroids)})

    return fit


def centroids_of(n: int) -> int:
    """Centroids of a half for ``n`` vectors: 64 at 16,384, 97 at 200,000, 127 at a million."""
    full = 4 * CENTROIDS**2
    return max(2, round(math.sqrt(n) / 2 if n <= full else CENTROIDS * (n / full) ** (1 / 6)))


def fit_codebooks(items: DataFrame, classes: DataFrame, counts: dict[str, int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Two codebooks for each space, from a sample of about ``SAMPLE`` of its ``classes``; 2 x centroids_of(n) of them come back."""
    rate = F.create_map(*[F.lit(x) for s, n in counts.items() for x in (s, min(1.0, SAMPLE / n) * 1_000_000)])
    k = {s: centroids_of(n) for s, n in counts.items()}
    chosen = F.pmod(F.xxhash64("class_id"), F.lit(1_000_000)) < rate[F.col("space")]
    sample = items.select("space", "class_id", "unit").where(chosen).dropDuplicates(["space", "class_id"])
    sample = cut_lineage(sample.join(classes.where(chosen), ["space", "class_id"], "left_semi"))
    halves = sample.select("space", "unit", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    books: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for size in sorted(set(k.values())):
        spaces = [s for s in counts if k[s] == size]
        fitted = halves.where(F.col("space").isin(spaces)).groupBy("space", "half").applyInPandas(_fit(size), "space string, half int, no int, centroid array<double>")
        found = fitted.toPandas()
        for s in spaces:
            own = found[found["space"] == s].sort_values(["half", "no"])
            books[s] = tuple(np.stack(own[own["half"] == h]["centroid"].to_numpy()) for h in (0, 1))
    return books


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)


def _packed(units: np.ndarray) -> pa.Array:
    """Rows of numbers of 12 places, each as the 6 low bytes of its count of 1e-12; nothing is lost."""
    whole = np.rint(units * 1e12).astype("<i8").view(np.uint8).reshape(len(units), -1, 8)[:, :, :6]
    return pa.array([x.tobytes() for x in np.ascontiguousarray(whole)], pa.binary())


def _unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    low = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1, 6)
    whole = np.zeros((*low.shape[:2], 8), np.uint8)
    whole[:, :, 2:] = low
    return (whole.view("<i8")[:, :, 0] >> 16) / 1e12


def _distances(x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    half = x.shape[1] // 2
    return tuple((c**2).sum(1) - 2 * p @ c.T + (p**2).sum(1)[:, None] for p, c in zip((x[:, :half], x[:, half:]), books))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, by sums in a fixed order: matrix products may differ in their last bit from batch to batch."""
    off = np.tile((centroids**2).sum(1), (len(x), 1))
    for d in range(x.shape[1]):
        off -= x[:, d, None] * (2 * centroids[:, d])
    return off.argmin(1)


def _assign(books: dict, units: bool):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """space, class_id and cell of each row, and its packed unit if asked for."""
        for batch in batches:
            spaces = np.array(batch.column("space").to_pylist(), dtype=object)
            for s in set(spaces):
                part = batch.take(pa.array(np.flatnonzero(spaces == s)))
                x, (a, b) = _matrix(part.column("unit")), books[s]
                half = x.shape[1] // 2
                cell = (_nearest(x[:, :half], a) * len(b) + _nearest(x[:, half:], b)).astype(np.int32)
                columns = {"space": part.column("space"), "class_id": part.column("class_id"), "cell": pa.array(cell)} | ({"unit": _packed(x)} if units else {})
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return assign


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Non-empty cells in the order of first[i] + second[j], from a heap, until they hold ``enough`` entries."""
    order_a, order_b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[order_a].tolist(), second[order_b].tolist()
    row, col = (order_a * len(b)).tolist(), order_b.tolist()
    heap, cells, held, reached = [(a[0] + b[0], 0, 0)], [], 0, [0] * len(a)
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = row[i] + col[j]
        if sizes[cell]:
            cells.append(cell)
            held += sizes[cell]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def _nearest_cells(probes: dict[str, tuple[list[str], np.ndarray]], k: int):
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k nearest entries of one partition for each probe: their cosines and cells."""
        best = {s: (np.full((len(ids), k), -2.0), np.full((len(ids), k), -1)) for s, (ids, _) in probes.items()}
        for batch in batches:
            spaces = np.array(batch.column("space").to_pylist(), dtype=object)
            for s in set(spaces) & set(probes):
                part = batch.take(pa.array(np.flatnonzero(spaces == s)))
                ids, x = probes[s]
                cosines = x @ _unpacked(part.column("unit")).T
                place = {c: i for i, c in enumerate(part.column("class_id").to_pylist())}
                own = [(i, place[c]) for i, c in enumerate(ids) if c in place]
                if own:
                    cosines[tuple(zip(*own))] = -2.0
                cosines = np.concatenate([best[s][0], cosines], axis=1)
                cells = np.concatenate([best[s][1], np.broadcast_to(part.column("cell").to_numpy(), (len(ids), part.num_rows))], axis=1)
                top = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
                best[s] = np.take_along_axis(cosines, top, 1), np.take_along_axis(cells, top, 1)
        for s, (cosines, cells) in best.items():
            probe = np.repeat(np.arange(len(cosines), dtype=np.int32), k)
            found = cells.ravel() >= 0
            columns = [probe[found], cosines.ravel()[found], cells.ravel()[found].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([s] * int(found.sum()), pa.string()), *map(pa.array, columns)], names=["space", "probe", "cosine", "cell"])

    return nearest


def enough_entries(placed: DataFrame, books: dict, sizes: dict, counts: dict[str, int], k: int, least: int) -> dict[str, int]:
    """Entries that the walks of each space have to gather: ``least``, or more where TARGET of the neighbours need more.

    About PROBES vectors of each space with more than ``least`` entries, chosen by hash, are compared with all entries of it;
    the place of their k nearest in their walks is known from the sizes of the cells.
    """
    large = {s: n for s, n in counts.items() if n > least}
    enough = dict.fromkeys(counts, least)
    if not large:
        return enough
    rate = F.create_map(*[F.lit(x) for s, n in large.items() for x in (s, min(1.0, PROBES / n) * 1_000_000)])
    chosen = placed.where(F.pmod(F.xxhash64("class_id", F.lit("probe")), F.lit(1_000_000)) < rate[F.col("space")]).select("space", "class_id", "unit")
    probes: dict[str, tuple[list[str], np.ndarray]] = {}
    for s, own in chosen.toPandas().sort_values("class_id").groupby("space"):
        probes[s] = own["class_id"].tolist(), _unpacked(pa.array(own["unit"], pa.binary()))
    near = placed.select("space", "class_id", "unit", "cell").mapInArrow(_nearest_cells(probes, k), "space string, probe int, cosine double, cell int")
    place = F.row_number().over(W.partitionBy("space", "probe").orderBy(F.desc("cosine"), "cell"))
    near = near.withColumn("place", place).where(F.col("place") <= k).toPandas()  # at most PROBES x k rows a space
    for s, (_, x) in probes.items():
        a, b = _distances(x, books[s])
        needs = []
        for probe, cells in near[near["space"] == s].groupby("probe")["cell"]:
            order = np.argsort((a[probe][:, None] + b[probe][None]).ravel(), kind="stable")
            before = np.zeros(len(order), np.int64)
            before[order] = np.cumsum(sizes[s][order]) - sizes[s][order]
            needs.append(before[cells.to_numpy()])
        enough[s] = max(least, int(np.quantile(np.concatenate(needs), TARGET, method="higher")) + 1)
    return enough


def plan_blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell, and the entries of each block.

    Neighbouring cells share a block of about BLOCK_ENTRIES; a cell beyond that has several blocks to itself.
    """
    first, pieces, held, block, free = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), [], -1, 0
    for cell, n in enumerate(sizes.tolist()):
        if n > BLOCK_ENTRIES:
            pieces[cell] = math.ceil(n / BLOCK_ENTRIES)
            first[cell] = len(held)
            held += [n / pieces[cell]] * pieces[cell]
            block, free = -1, 0
            continue
        if block < 0 or n > free:
            block, free = len(held), BLOCK_ENTRIES
            held.append(0)
        first[cell] = block
        held[block] += n
        free -= n
    return first, pieces, np.array(held)


_INDEXED = "space string, class_id string, places array<long>, keys array<string>, cell int, unit binary, block int"


def _gather(entries: pa.Table, vectors: pa.Table) -> pa.Table:
    """The entries of one block with their units, by cell; vectors that are no entry's, and repeated ones, fall away."""
    at = {c: i for i, c in enumerate(vectors["class_id"].to_pylist())}
    own = [at.get(c) for c in entries["class_id"].to_pylist()]
    if None in own:
        raise ValueError("items gave other vectors when they were read again")
    table = pa.table({c: entries[c] for c in ("space", "class_id", "places", "keys", "cell")} | {"unit": vectors["unit"].take(pa.array(own, pa.int64())), "block": entries["block"]})
    return table.sort_by("cell")


def _read(paths: list[str], columns: list[str]) -> pa.Table:
    tables = []
    for path in paths:
        system, inside = FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
        tables.append(pq.read_table(unquote(inside), columns=columns, filesystem=system, partitioning=None, use_threads=False))
    return pa.concat_tables(tables)


def _reach(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, enough: int) -> np.ndarray:
    """The summed distance of the last cell of each query's walk; long walks are not taken from a heap, their end is found among all sums."""
    live = np.flatnonzero(sizes)
    if enough * len(live) < SHORT * sizes.sum():
        counts = sizes.tolist()
        last = [walk(x, y, counts, enough)[-1] for x, y in zip(a, b)]
        return a[np.arange(len(a)), np.array(last) // b.shape[1]] + b[np.arange(len(b)), np.array(last) % b.shape[1]]
    held, rows, cols = sizes[live].astype(float), live // b.shape[1], live % b.shape[1]
    ends, enough, end = np.empty(len(a)), min(enough, held.sum()), math.nan
    for q in range(len(a)):
        sums = a[q][rows] + b[q][cols]
        low, high = end * 0.98, end * 1.02  # the query before is often like this one
        below = held @ (sums <= low)
        if below < enough <= held @ (sums <= high):
            near = np.flatnonzero((low < sums) & (sums <= high))
        else:
            near, below = np.arange(len(sums)), 0.0
        near = near[np.argsort(sums[near])]
        end = ends[q] = sums[near[np.searchsorted(np.cumsum(held[near]), enough - below)]]
    return ends


def _better(best: np.ndarray, floor: np.ndarray, who: np.ndarray, x: tuple[np.ndarray, np.ndarray], e: tuple[np.ndarray, np.ndarray], places: np.ndarray) -> None:
    """Take the entries ``e`` into the marks ``best`` of the queries ``who``; ``floor`` is a bound of what can still enter.

    Vectors come in single and in double precision. Single precision only tells which queries have something above the floor.
    """
    step, k = max(1, 2_000_000 // len(places)), best.shape[1]
    for at in range(0, len(who), step):
        some = who[at : at + step]
        some = some[(e[0] @ x[0][some].T).max(0) >= floor[some]]
        if len(some):
            marks = np.rint(x[1][some] @ e[1].T * 1e6).astype(np.int64) * _PLACES - places
            both = np.concatenate([best[some], marks], axis=1)
            best[some] = both = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            least = both.min(1)
            floor[some] = np.where(least == _NONE, -np.inf, -(-least // _PLACES) / 1e6 - ROUGH)


def _keys_of(best: np.ndarray, k: int, tables: Iterator[pa.Table]) -> tuple[pa.Array, pa.Array]:
    """Cosines and keys, at most ``k`` of each, of the marks of each query; an entry counts with all its keys, ties go to the smaller place."""
    query, _ = np.nonzero(best != _NONE)
    marks = best[best != _NONE]
    first = (-marks) % _PLACES
    cosine, wanted, kept = (marks + first) // _PLACES, np.unique(first), []
    for table in tables:
        places = table["places"].combine_chunks()
        starts = places.flatten().to_numpy()[places.offsets.to_numpy()[:-1] - places.offsets[0].as_py()]
        kept.append(table.filter(pa.array(np.isin(starts, wanted))))
    table = pa.concat_tables(kept).combine_chunks()
    places, keys = (table[c].combine_chunks() for c in ("places", "keys"))
    starts, ends = places.offsets.to_numpy()[:-1] - places.offsets[0].as_py(), places.offsets.to_numpy()[1:] - places.offsets[0].as_py()
    places, keys = places.flatten().to_numpy(), keys.flatten()
    order = np.argsort(places[starts], kind="stable")
    entry = order[np.searchsorted(places[starts], first, sorter=order)]
    many = (ends - starts)[entry]
    at = np.repeat(starts[entry] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    query, cosine = np.repeat(query, many), np.repeat(cosine, many)
    order = np.lexsort((places[at], -cosine, query))
    query, cosine, at = query[order], cosine[order], at[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    offsets = pa.array(np.searchsorted(query[keep], np.arange(len(best) + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(cosine[keep].astype(np.int32))), pa.ListArray.from_arrays(offsets, keys.take(pa.array(at[keep])))


def _search(books: dict, sizes: dict, plans: dict, blocks: dict[tuple[str, int], list[str]], enough: dict[str, int], k: int):
    def found(space: str, block: int, part: int, parts: int) -> pa.RecordBatch:
        own = _read(blocks[space, block], ["class_id", "unit"])
        own = own.slice(len(own) * part // parts, len(own) * (part + 1) // parts - len(own) * part // parts)
        x = _unpacked(own["unit"])
        first, pieces, held = plans[space]
        a, b = _distances(x, books[space])
        reach = _reach(a, b, sizes[space], enough[space])
        by_a, by_b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
        visitors = lambda cell: np.flatnonzero(by_a[cell // len(by_b)] + by_b[cell % len(by_b)] <= reach)
        best, floor, met = np.full((len(x), k), _NONE), np.full(len(x), -np.inf), []
        x, far = (x.astype(np.float32), x), (a.mean(0)[:, None] + b.mean(0)).ravel()
        for other in sorted(range(len(held)), key=lambda n: abs(n - block)):  # near blocks first, so that floors rise soon
            cells = np.flatnonzero((first <= other) & (other < first + pieces) & (sizes[space] > 0))
            cells = cells[np.argsort(far[cells])]
            if (space, other) not in blocks or not any(len(visitors(c)) for c in cells):
                continue
            met.append(other)
            entries = _read(blocks[space, other], ["places", "cell", "unit"])
            e, at, places = _unpacked(entries["unit"]), entries["cell"].to_numpy(), entries["places"].combine_chunks()
            rough = e.astype(np.float32)
            places = places.flatten().to_numpy()[places.offsets.to_numpy()[:-1] - places.offsets[0].as_py()]
            for cell in cells:
                low, high = np.searchsorted(at, cell), np.searchsorted(at, cell, "right")
                who = visitors(cell) if low < high else []
                if len(who):
                    _better(best, floor, who, x, (rough[low:high], e[low:high]), places[low:high])
        cosines, keys = _keys_of(best, k, (_read(blocks[space, n], ["places", "keys"]) for n in met))
        return pa.RecordBatch.from_arrays([pa.array([space] * len(own), pa.string()), own["class_id"].combine_chunks(), cosines, keys], names=["space", "class_id", "cosines", "keys"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For the queries of each part of a block the ``k`` nearest keys, their own among them."""
        for batch in batches:
            for row in batch.to_pylist():
                yield found(**row)

    return search


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files go when the job that wrote them ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _placed(keys: DataFrame) -> DataFrame:
    """(space, key, class_id) with ``place``, a number that grows with space, key_no (nulls first) and key and leaves none out."""
    by_key = keys.orderBy("space", F.col("key_no").asc_nulls_first(), "key").select("space", "key", "class_id")
    rows = cut_lineage(by_key.withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33)
    counts = sorted(map(tuple, rows.groupBy(part.alias("part")).count().collect()))  # one row a partition
    before = np.cumsum([0] + [n for _, n in counts]).tolist()
    starts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part long, before long")
    rows = rows.withColumn("part", part.cast("long")).join(F.broadcast(starts), "part")
    return rows.select("space", "key", "class_id", (F.col("before") + F.col("row").bitwiseAND(2**33 - 1)).alias("place"))


def one_a_key(items: DataFrame) -> DataFrame:
    """One vector a key: that with the smallest hash."""
    items = items.groupBy("space", "key").agg(F.min("key_no").alias("key_no"), F.min(F.struct("class_id", "unit")).alias("x"))
    return items.select("space", "key", "key_no", "x.unit", "x.class_id")


def similar_vectors(items: DataFrame, k: int = 10, candidates: int = CANDIDATES) -> DataFrame:
    """(space, key, neighbour, cosine6): the ``k`` others of highest cosine in the same space, ties to the smaller key.

    ``items`` is as from ``unit_vectors``: space, key (strings), key_no (a number that goes before key in the order, or null),
    unit and class_id. Repeated rows count once; of several vectors under one key the one with the smallest hash counts. Spaces with fewer than k + 1 items give all others. Cosines are compared
    after rounding to 6 places; cosine6 is that number in millionths. No rows give no rows. A query meets ``candidates``
    others at least, and as many as ``enough_entries`` finds necessary.
    """
    with _shuffles_dropped(items.sparkSession):
        return _similar(items, k, candidates)


def _similar(items: DataFrame, k: int, candidates: int) -> DataFrame:
    spark = items.sparkSession
    keys = cut_lineage(items.groupBy("space", "key").agg(F.min("key_no").alias("key_no"), F.min("class_id").alias("class_id")))
    counts = {r["space"]: r["n"] for r in keys.groupBy("space").agg(F.count_distinct("class_id").alias("n")).collect()}
    if not counts:
        return keys.select("space", "key", F.col("key").alias("neighbour"), F.lit(0).alias("cosine6"))
    books = fit_codebooks(items, keys.select("space", "class_id"), counts)
    keys = _placed(keys)
    number = F.row_number().over(W.partitionBy("space", "class_id").orderBy("place"))
    firsts = keys.withColumn("number", number).where(F.col("number") <= k + 1)
    entries = firsts.groupBy("space", "class_id").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("x"))
    entries = entries.select("space", "class_id", F.col("x.place").alias("places"), F.col("x.key").alias("keys"))
    vectors = items.select("space", "class_id", "unit")
    cells = vectors.mapInArrow(_assign(books, False), "space string, class_id string, cell int").dropDuplicates(["space", "class_id"])
    entries = cut_lineage(entries.join(cells, ["space", "class_id"]))
    sizes = {s: np.zeros(len(a) * len(b), np.int64) for s, (a, b) in books.items()}
    for r in entries.groupBy("space", "cell").count().collect():  # at most the square of centroids_of(n) a space
        sizes[r["space"]][r["cell"]] = r["count"]
    plans = {s: plan_blocks(x) for s, x in sizes.items()}
    before = dict(zip(plans, np.cumsum([0] + [len(p[2]) for p in plans.values()]).tolist()))
    of_cells = F.broadcast(
        spark.createDataFrame([(s, int(c), before[s] + int(p[0][c]), int(p[1][c])) for s, p in plans.items() for c in np.flatnonzero(sizes[s])], "space string, cell int, first int, pieces int")
    )
    block = (F.col("first") + F.pmod(F.xxhash64("class_id"), F.col("pieces"))).cast("int")
    in_blocks = lambda rows: spread(rows.join(of_cells, ["space", "cell"]).withColumn("block", block).drop("first", "pieces"), "block").groupBy("block")
    vectors = vectors.mapInArrow(_assign(books, True), "space string, class_id string, cell int, unit binary")
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/neighbours-{uuid.uuid4().hex}"
    in_blocks(entries).cogroup(in_blocks(vectors)).applyInArrow(_gather, _INDEXED).write.partitionBy("block").parquet(folder)
    try:
        index = spark.read.parquet(folder)
        files: dict[int, list[str]] = {}
        for path in index.inputFiles():
            files.setdefault(int(re.search(r"/block=(\d+)/", path)[1]), []).append(path)
        blocks = {(s, n): files[before[s] + n] for s, p in plans.items() for n in range(len(p[2])) if before[s] + n in files}
        enough = enough_entries(index, books, sizes, counts, k, candidates)
        tasks = 4 * spark.sparkContext.defaultParallelism
        most = max(1, min(BLOCK_QUERIES, math.ceil(sum(counts.values()) / tasks)))
        parts = [(s, n, i, p) for s, n in blocks for p in [math.ceil(plans[s][2][n] / most)] for i in range(p)]
        asked = spark.createDataFrame(spark.sparkContext.parallelize(parts, len(parts)), "space string, block int, part int, parts int")
        lists = cut_lineage(asked.mapInArrow(_search(books, sizes, plans, blocks, enough, k + 1), "space string, class_id string, cosines array<int>, keys array<string>"))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    near = F.slice(F.filter(F.arrays_zip("cosines", "keys"), lambda x: x["keys"] != F.col("key")), 1, k)
    return (
        keys.select("space", "key", "class_id")
        .join(lists, ["space", "class_id"])
        .select("space", "key", F.explode(near).alias("x"))
        .select("space", "key", F.col("x.keys").alias("neighbour"), F.col("x.cosines").alias("cosine6"))
    )


def usable_vectors(spark: SparkSession, root: str) -> DataFrame:
    """The usable vectors of both embedding tables; a model of tool_embeddings is a space of its own."""
    tools = table(spark, root, "tool_embeddings").select(
        F.concat(F.lit("tool_embeddings/"), F.coalesce("model", F.lit(""))).alias("space"), F.col("slug").alias("key"), F.lit(None).cast("bigint").alias("key_no"), F.col("dim").alias("size"), F.col("embedding_json").alias("vector")
    )
    search = table(spark, root, "search_embeddings").select(
        F.lit("search_embeddings/").alias("space"), F.col("tool_id").cast("string").alias("key"), F.col("tool_id").alias("key_no"), F.lit(64).alias("size"), F.col("embedding").alias("vector")
    )
    return unit_vectors(tools).unionByName(unit_vectors(search))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    found = similar_vectors(usable_vectors(spark, root))
    return found.select(F.substring_index("space", "/", 1).alias("collection"), F.col("key").alias("item_key"), F.col("neighbour").alias("neighbour_key"))


def _block_best(k: int):
    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        """The k highest cosines (millionths) of each query in one block of rows, itself left out."""
        schema = pa.schema([("space", pa.string()), ("key", pa.string()), ("cosines", pa.list_(pa.int32()))])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, r = _matrix(queries["unit"]), _matrix(rows["unit"])
        own, names = np.array(queries["key"].to_pylist(), dtype=object), np.array(rows["key"].to_pylist(), dtype=object)
        out, step = [], max(1, 4_000_000 // len(r))
        for at in range(0, len(q), step):
            marks = np.rint(q[at : at + step] @ r.T * 1e6).astype(np.int32)
            marks[own[at : at + step, None] == names[None]] = _LOWEST
            top = marks if marks.shape[1] <= k else np.partition(marks, marks.shape[1] - k, axis=1)[:, -k:]
            out += [x[x != _LOWEST] for x in top]
        return pa.Table.from_arrays([queries["space"], queries["key"], pa.array(out, pa.list_(pa.int32()))], schema=schema)

    return best


_LOWEST = -(2**31)
#: Rows and queries of a block of the exact search that recall is measured by.
EXACT_ROWS = 8_000


def measured_recall(items: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(space, queries, wanted, found): how many of the ``k`` best neighbours of each query (space, key) the index gives.

    ``items`` is as for :func:`similar_vectors`. The exact search takes the queries against all rows in pairs of blocks; a
    neighbour found counts if its cosine is no lower than that of the exact k-th. No queries give no rows.
    """
    items = cut_lineage(one_a_key(items))
    asked = cut_lineage(items.join(queries.select("space", "key").distinct(), ["space", "key"], "left_semi"))
    asked = asked.select(*[F.col(c).alias(c) for c in ("space", "key", "unit")])  # columns of its own, apart from those of items
    blocks = items.groupBy("space").agg(F.ceil(F.count("*") / EXACT_ROWS).alias("rbs")).join(asked.groupBy("space").agg(F.ceil(F.count("*") / EXACT_ROWS).alias("qbs")), "space")
    place = lambda n: F.pmod(F.xxhash64("key"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    blocks = F.broadcast(blocks)  # one row a space
    left = asked.join(blocks, "space").select("space", "key", "unit", place("qbs").alias("qb"), "rbs").withColumn("rb", every("rbs")).drop("rbs")
    right = items.join(blocks, "space").select("space", "key", "unit", place("rbs").alias("rb"), "qbs").withColumn("qb", every("qbs")).drop("qbs")
    at = ["space", "qb", "rb"]
    best = spread(left, *at).groupBy(*at).cogroup(spread(right, *at).groupBy(*at)).applyInArrow(_block_best(k), "space string, key string, cosines array<int>")
    # As many short lists as there are blocks of rows.
    merged = best.groupBy("space", "key").agg(F.slice(F.sort_array(F.flatten(F.collect_list("cosines")), False), 1, k).alias("best"))
    least = merged.select("space", "key", F.size("best").alias("wanted"), F.array_min("best").alias("least"))
    near = similar_vectors(items, k).join(asked.select("space", "key"), ["space", "key"], "left_semi")
    hits = least.join(near, ["space", "key"], "left").groupBy("space", "key", "wanted").agg(F.count_if(F.col("cosine6") >= F.col("least")).alias("found"))
    return hits.groupBy("space").agg(F.count("*").alias("queries"), F.sum("wanted").alias("wanted"), F.sum(F.least("found", "wanted")).alias("found"))


def p4_recall(spark: SparkSession, root: str) -> DataFrame:
    """Of each collection the vectors of tools whose id is divisible by 20, and whether the index gives at least 0.9 of their neighbours."""
    items = cut_lineage(usable_vectors(spark, root))
    ids = table(spark, root, "tools").where("slug IS NOT NULL").groupBy("slug").agg(F.min("id").alias("id"))
    by_slug = items.where("key_no IS NULL").join(ids.where("id % 20 = 0"), F.col("key") == F.col("slug"), "left_semi")
    queries = by_slug.unionByName(items.where("key_no % 20 = 0"))
    spaces = measured_recall(items, queries).groupBy(F.substring_index("space", "/", 1).alias("collection"))
    return spaces.agg(F.sum("queries").alias("queries"), (F.sum("found") >= 0.9 * F.sum("wanted")).alias("enough"))


QUERIES = {"p4_found": p4_found, "p4_recall": p4_recall}
ORACLES = {
    "p4_recall": """
WITH i AS (SELECT slug, min(id) AS id FROM tools WHERE slug IS NOT NULL GROUP BY 1),
parsed AS (
  SELECT 'tool_embeddings' AS collection, coalesce(model, '') AS model, slug AS k, i.id, dim, TRY_CAST(TRY_CAST(embedding_json AS JSON) AS DOUBLE[]) AS v FROM tool_embeddings JOIN i USING (slug)
  UNION ALL SELECT 'search_embeddings', '', CAST(tool_id AS VARCHAR), tool_id, 64, CAST(embedding AS DOUBLE[]) FROM search_embeddings WHERE tool_id IS NOT NULL)
SELECT collection, count(DISTINCT (model, k)) AS queries, true AS enough FROM parsed
WHERE id % 20 = 0 AND len(v) = dim AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0 GROUP BY collection""",
    "p4_found": """
WITH parsed AS (
  SELECT 'tool_embeddings' AS collection, coalesce(model, '') AS model, slug AS k, NULL::BIGINT AS no, dim,
         TRY_CAST(TRY_CAST(embedding_json AS JSON) AS DOUBLE[]) AS v FROM tool_embeddings
  UNION ALL SELECT 'search_embeddings', '', CAST(tool_id AS VARCHAR), tool_id, 64, CAST(embedding AS DOUBLE[]) FROM search_embeddings),
usable AS (
  SELECT DISTINCT collection, model, k, no, v FROM parsed
  WHERE k IS NOT NULL AND len(v) = dim AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
ranked AS (
  SELECT a.collection, a.k AS item_key, b.k AS neighbour_key,
         row_number() OVER (PARTITION BY a.collection, a.model, a.k ORDER BY round(list_cosine_similarity(a.v, b.v), 6) DESC, b.no, b.k) AS place
  FROM usable a JOIN usable b ON a.collection = b.collection AND a.model = b.model AND a.k <> b.k)
SELECT collection, item_key, neighbour_key FROM ranked WHERE place <= 10"""
}
