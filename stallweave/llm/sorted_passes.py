"""Embedding near-dedup by sorted projection passes.

A pass orders the vectors by the signs of random projections, read as one long binary word, and compares every vector with
its next ``window`` neighbours in that order; fresh projections order every pass anew.  The confirmed links of all passes
are united to components.  The number of passes follows the number of vectors, so that in an even table a pair at the limit
is met by one of them with the probability asked for.  Whether it is so is measured in the orders: the bits that a vector
has to share with another to lie within its window tell how likely each pass meets a pair at the limit.  Vectors for
which all passes together do not reach the probability, as in a hot cone, are compared with each other in full, by blocks.

Equal vectors are one class with a count.  Links are counted inside components, without writing pairs: vectors within half
the limiting angle of the component's mean direction are all linked with each other, so for these a count is enough; only
the rest is compared with the component, in blocks of bounded size.  The window therefore bounds no group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.llm.graph import components
from stallweave.llm.tables import drop_path, materialise, stored

#: Projections to a pass; more than any order of real tables can tell apart.
BITS = 62


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of equally long lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of the lists of each length."""
    sizes = np.asarray(pc.list_value_length(column))
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = _matrix(column)
    return x / np.linalg.norm(x, axis=1)[:, None]


def good_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, digest, v (the components as given) of every vector that can link; the digest names equal vectors."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, digests = [], []
        for i, row in enumerate(batch.column("embedding")):
            values = row.values
            if values is None or not len(values) or values.null_count:
                continue
            x = np.asarray(values, np.float64)
            if not np.isfinite(x).all() or not (size := np.linalg.norm(x)) or not np.isfinite(size):
                continue
            keep.append(i)
            digests.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest())
        kept = batch.take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays([kept.column("vec_id"), pa.array(digests, pa.binary()), kept.column("embedding")], ["vec_id", "digest", "v"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    return rows.mapInArrow(lambda batches: map(work, batches), f"vec_id {kind}, digest binary, v {rows.schema['embedding'].dataType.simpleString()}")


def pass_count(n: int, window: int, limit: float, miss: float) -> int:
    """Passes after which a pair at the limit has been neighbours but for the probability ``miss``."""
    agree = 1 - math.acos(limit) / math.pi
    per_pass = agree ** max(1.0, math.log2(max(2, n / window)))
    return max(4, math.ceil(math.log(miss) / math.log(1 - per_pass)))


def ordered(units: DataFrame, passes: int, seed: int) -> DataFrame:
    """(turn, key, id, v): each vector's place in the order of every pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for rows in _by_length(batch.column("v")):
                some = batch.take(pa.array(rows))
                x = _unit(some.column("v"))
                for turn in range(passes):
                    at = (turn, x.shape[1])
                    if at not in planes:
                        planes[at] = np.random.default_rng([seed, *at]).standard_normal((x.shape[1], BITS))
                    key = (x @ planes[at] > 0) @ weights
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), turn, np.int32)), pa.array(key), some.column("id"), some.column("v")], ["turn", "key", "id", "v"])

    kind = units.schema["id"].dataType.simpleString()
    return units.select("id", "v").mapInArrow(work, f"turn int, key long, id {kind}, v {units.schema['v'].dataType.simpleString()}")


def block_links(turn: np.ndarray, ids: pa.Array, vectors: pa.Array, window: int, limit: float, own: int) -> tuple[pa.Array, pa.Array]:
    """Links of the first ``own`` rows, in order, with the ``window`` rows after each; thinned to what keeps their components together."""
    ends_a, ends_b, place = [], [], np.arange(len(ids))
    for rows in _by_length(vectors):
        x = _unit(vectors.take(pa.array(rows)))
        linked = x @ x.T >= limit
        ahead = place[rows][None, :] - place[rows][:, None]
        linked &= (ahead > 0) & (ahead <= window) & (place[rows][:, None] < own) & (turn[rows][:, None] == turn[rows][None, :])
        linked |= linked.T
        active = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(active, active)]
        label = np.arange(len(active))
        while len(active):
            lower = np.minimum(label, np.where(linked, label[None, :], len(active)).min(axis=1))
            if (lower == label).all():
                break
            label = lower
        moved = np.flatnonzero(label != np.arange(len(active)))
        ends_a.append(rows[active[moved]])
        ends_b.append(rows[active[label[moved]]])
    take = lambda parts: ids.take(pa.array(np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)))
    return take(ends_a), take(ends_b)


def missed(turn: np.ndarray, key: np.ndarray, window: int, limit: float, begin: int, end: int) -> np.ndarray:
    """Logarithm of the probability that the pass misses a pair at the limit, for the rows from ``begin`` to ``end``.

    Rows that share more bits with a row than those ``window`` places away lie nearer.  A side that ends with the rows given
    tells nothing; without either, the pass counts for nothing.
    """
    at, depth, known = np.arange(begin, end), np.zeros(end - begin, np.int64), np.zeros(end - begin, bool)
    for other in (at + window, at - window):
        there = (other >= 0) & (other < len(key))
        near = other[there]
        unlike = np.bitwise_xor(key[at[there]], key[near])
        # Rounding moves an exponent only where 53 bits in a row differ.
        shared = BITS - np.frexp(unlike.astype(np.float64))[1]
        depth[there] = np.maximum(depth[there], np.where(turn[at[there]] == turn[near], shared + 1, 0))
        known |= there
    return np.where(known, np.log1p(-np.minimum((1 - math.acos(limit) / math.pi) ** depth, 1 - 1e-9)), 0.0)


def full_links(units: DataFrame, limit: float, block: int = 8192, chunk: int = 1024) -> DataFrame:
    """(a, b): links among all of ``units`` (id, v), each with each, thinned to what keeps their components together."""
    kind = units.schema["id"].dataType.simpleString()
    blocks = max(1, math.ceil(units.count() / block))
    placed = units.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("own"))
    left = placed.select("own", F.explode(F.sequence("own", F.lit(blocks - 1))).alias("other"), "id", "v", F.lit(True).alias("asks"))
    right = placed.select(F.explode(F.sequence(F.lit(0), "own")).alias("own"), F.col("own").alias("other"), "id", "v", F.lit(False).alias("asks"))

    def meet(group: pa.Table) -> pa.Table:
        ids, v, asks = group["id"].combine_chunks(), group["v"].combine_chunks(), np.asarray(group["asks"])
        ends_a, ends_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for rows in _by_length(v):
            x = _unit(v.take(pa.array(rows)))
            told = np.flatnonzero(~asks[rows])
            mine = np.flatnonzero(asks[rows])
            for start in range(0, len(mine), chunk):
                some = mine[start : start + chunk]
                linked = x[some] @ x[told].T >= limit
                a, b = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if not len(a):
                    continue
                linked = linked[np.ix_(a, b)]
                a, b = rows[some[a]], rows[told[b]]
                # Labels number the asking rows; each told row takes the least of those it is linked with.
                label = np.arange(len(a))
                while True:
                    down = np.where(linked, label[:, None], len(a)).min(axis=0)
                    lower = np.minimum(label, np.where(linked, down[None, :], len(a)).min(axis=1))
                    if (lower == label).all():
                        break
                    label = lower
                ends_a += [a, b]
                ends_b += [a[label], a[down]]
        one, two = ids.take(pa.array(np.concatenate(ends_a))), ids.take(pa.array(np.concatenate(ends_b)))
        return pa.table({"a": one, "b": two}).filter(pc.not_equal(one, two))

    return left.unionByName(right).groupBy("own", "other").applyInArrow(meet, f"a {kind}, b {kind}").distinct()


def neighbour_links(units: DataFrame, passes: int, window: int, limit: float, seed: int, miss: float, block: int = 256) -> DataFrame:
    """(a, b): links found between neighbours of any pass, and those among all vectors whose pairs these may miss by more than ``miss``.

    Vectors move once for each pass, to their place in its order; a task then walks through its sorted rows with a window.
    The first and last ``window`` rows of every task are written beside the links, and meet those of the next task.
    """
    spark, kind, vector = units.sparkSession, units.schema["id"].dataType.simpleString(), units.schema["v"].dataType.simpleString()
    rows = ordered(units, passes, seed).repartitionByRange("turn", "key", "id").sortWithinPartitions("turn", "key", "id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, kept, tail = TaskContext.get().partitionId(), 0, None, None
        past = np.empty((2, 0), np.int64)

        def links(table: pa.Table, own: int) -> pa.RecordBatch:
            turn, ids, v = np.asarray(table["turn"]), table["id"].combine_chunks(), table["v"].combine_chunks()
            a, b = block_links(turn, ids, v, window, limit, own)
            n = len(a)
            blank = lambda t: pa.nulls(n, t)
            return pa.RecordBatch.from_arrays([a, b, blank(pa.int64()), blank(pa.int64()), blank(pa.bool_()), blank(pa.int32()), blank(v.type), blank(pa.float64())], names)

        def measure(table: pa.Table, own: int) -> pa.RecordBatch:
            nonlocal past
            order = np.concatenate([past, np.stack([np.asarray(table["turn"], np.int64), np.asarray(table["key"])])], axis=1)
            begin = past.shape[1]
            n = min(own, table.num_rows)
            past = order[:, max(0, begin + n - window) : begin + n]
            blank = lambda t: pa.nulls(n, t)
            log = missed(order[0], order[1], window, limit, begin, begin + n)
            ids = table["id"].combine_chunks().slice(0, n)
            return pa.RecordBatch.from_arrays([ids, blank(ids.type), blank(pa.int64()), blank(pa.int64()), blank(pa.bool_()), blank(pa.int32()), blank(table["v"].type), pa.array(log)], names)

        def edge(table: pa.Table, at: int, last: bool) -> pa.RecordBatch:
            n, ids = table.num_rows, table["id"].combine_chunks()
            return pa.RecordBatch.from_arrays(
                [ids, ids, pa.array(np.full(n, part)), pa.array(np.arange(at, at + n)), pa.array(np.full(n, last)), table["turn"].combine_chunks(), table["v"].combine_chunks(), pa.nulls(n, pa.float64())], names
            )

        for batch in batches:
            table = pa.Table.from_batches([batch]).select(["turn", "key", "id", "v"])
            if seen < window and table.num_rows:
                yield edge(table.slice(0, window - seen), seen, False)
            seen += table.num_rows
            tail = table.slice(max(0, table.num_rows - window)) if tail is None or table.num_rows >= window else pa.concat_tables([tail, table]).slice(max(0, tail.num_rows + table.num_rows - window))
            kept = table if kept is None else pa.concat_tables([kept, table])
            while kept.num_rows >= block + window:
                yield links(kept.slice(0, block + window), block)
                yield measure(kept.slice(0, block + window), block)
                kept = kept.slice(block)
        if kept is not None:
            for start in range(0, kept.num_rows, block):
                yield links(kept.slice(start, block + window), block)
                yield measure(kept.slice(start, block + window), block)
            yield edge(tail, seen - tail.num_rows, True)

    names = ["a", "b", "part", "place", "last", "turn", "v", "log"]
    walked, path = stored(rows.mapInArrow(walk, f"a {kind}, b {kind}, part long, place long, last boolean, turn int, v {vector}, log double"), "walked")
    # One number for each task that had rows.
    parts = sorted(r["part"] for r in walked.where("part IS NOT NULL").select("part").distinct().collect())
    seams = spark.createDataFrame([(p, p, True) for p in parts] + [(q, p, False) for p, q in zip(parts, parts[1:])], "part long, seam long, last boolean")

    def meet(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("place", "ascending")])
        own = int(np.count_nonzero(np.asarray(group["last"])))
        a, b = block_links(np.asarray(group["turn"]), group["a"].combine_chunks(), group["v"].combine_chunks(), window, limit, own)
        return pa.table({"a": a, "b": b})

    across = walked.join(F.broadcast(seams), ["part", "last"]).groupBy("seam").applyInArrow(meet, f"a {kind}, b {kind}")
    hot = walked.where("log IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("log").alias("log")).where(F.col("log") > math.log(miss)).select("id")
    hot, hot_path = stored(units.select("id", "v").join(hot, "id"), "hot-vectors")
    met = walked.where("part IS NULL AND log IS NULL").select("a", "b")
    found, _ = stored(met.unionByName(across).unionByName(full_links(hot, limit)).distinct(), "neighbour-links")
    for used in (path, hot_path):
        drop_path(spark, used)
    return found


def counted_links(members: DataFrame, limit: float, rest_block: int = 1024, block: int = 4096) -> DataFrame:
    """(id, links): how many vectors each of ``members`` (component, id, copies, v) is linked with in its component.

    ``copies`` is the number of equal vectors that a row stands for; links with its own copies are not counted here.
    """
    kind = members.schema["id"].dataType.simpleString()
    close = math.cos(math.acos(limit) / 2) + 1e-9

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for component, v in zip(batch.column("component").to_pylist(), batch.column("v").to_pylist()):
                x = np.asarray(v, np.float64)
                x = x / np.linalg.norm(x)
                held[component] = held[component] + x if component in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), members_type), pa.array(list(held.values()), pa.list_(pa.float64()))], ["component", "v"])

    def mean(group: pa.Table) -> pa.Table:
        total = _matrix(group.column("v")).sum(axis=0)
        size = np.linalg.norm(total)
        return pa.table({"component": group.column("component")[:1], "centre": pa.array([total / size if size else total], pa.list_(pa.float64()))})

    members_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    # A task sends one sum for each component it has met; a component's sums are as many as tasks.
    centres = members.select("component", "v").mapInArrow(sums, f"component {kind}, v array<double>").groupBy("component").applyInArrow(mean, f"component {kind}, centre array<double>")
    centres, centres_path = stored(centres, "component-means")

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        inside = [bool(np.dot(v, c) >= close * np.linalg.norm(v)) for v, c in zip(batch.column("v").to_pylist(), batch.column("centre").to_pylist())]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "id", "copies", "v")), pa.array(inside, pa.bool_())], ["component", "id", "copies", "v", "inside"])

    marked = members.select("component", "id", "copies", "v").join(centres, "component").mapInArrow(lambda b: map(near, b), f"component {kind}, id {kind}, copies long, v {members.schema['v'].dataType.simpleString()}, inside boolean")
    marked, marked_path = stored(marked, "ball-members")
    sizes = marked.groupBy("component").agg(
        F.sum(F.when(F.col("inside"), F.col("copies")).otherwise(0)).alias("ball"), F.count("*").alias("n"), F.sum((~F.col("inside")).cast("long")).alias("rest")
    )
    sizes, sizes_path = stored(sizes, "ball-sizes")
    base = marked.join(sizes, "component").select("id", F.when(F.col("inside"), F.col("ball") - F.col("copies")).otherwise(0).cast("long").alias("links"))
    shape = sizes.where("rest > 0").select("component", F.ceil(F.col("rest") / rest_block).alias("rows"), F.ceil(F.col("n") / block).alias("columns"))
    wide = marked.join(shape, "component")
    row, column = F.pmod(F.xxhash64("id"), F.col("rows")), F.pmod(F.xxhash64("id"), F.col("columns"))
    left = wide.where("NOT inside").select("component", row.alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("column"), "id", "copies", "v", "inside", F.lit(True).alias("asks"))
    right = wide.select("component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("row"), column.alias("column"), "id", "copies", "v", "inside", F.lit(False).alias("asks"))

    def count(group: pa.Table) -> pa.Table:
        asks, inside = np.asarray(group.column("asks")), np.asarray(group.column("inside"))
        ids = group.column("id").combine_chunks()
        names, copies = np.asarray(ids), np.asarray(group.column("copies"))
        x = _unit(group.column("v"))
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        linked = (x[a] @ x[b].T >= limit) & (names[a][:, None] != names[b][None, :])
        # Vectors outside the ball ask themselves; those inside are told.
        told = b[inside[b]]
        links = np.concatenate([linked @ copies[b], copies[a] @ linked[:, inside[b]]])
        return pa.table({"id": ids.take(pa.array(np.concatenate([a, told]))), "links": pa.array(links.astype(np.int64))})

    met = left.unionByName(right).groupBy("component", "row", "column").applyInArrow(count, f"id {kind}, links long")
    out = materialise(base.unionByName(met).groupBy("id").agg(F.sum("links").alias("links")), "link-counts")
    for path in (centres_path, marked_path, sizes_path):
        drop_path(members.sparkSession, path)
    return out


def near_vectors(vectors: DataFrame, limit: float = 0.9, window: int = 64, miss: float = 1e-4, seed: int = 20240607) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding; other columns ignored).

    Vectors are linked from a cosine of ``limit`` in double precision; component_id is the smallest vec_id reachable.  Null,
    empty and zero vectors, vectors with null or non-finite components, and vectors of different length link with nothing.
    Rows that repeat a vec_id are one vector for components, and each equal row counts as a link of the other.  Rows without
    vec_id take no part: no component, no links, kept.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    units, units_path = stored(good_vectors(vectors), "good-vectors")
    classes, _ = stored(units.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    single = units.join(classes.select(F.col("digest").alias("d"), "id", "copies"), (F.col("digest") == F.col("d")) & (F.col("vec_id") == F.col("id")))
    single, single_path = stored(single.select("id", "copies", "v").dropDuplicates(["id"]), "single-vectors")
    n = single.count()
    # With some passes to spare, so that an even table has no vectors left to compare in full.
    links = neighbour_links(single, pass_count(n, window, limit, miss / 10), window, limit, seed, miss)
    labels, labels_path = stored(components(links), "vector-components")
    members = single.join(labels, single["id"] == labels["node"]).select("component", "id", "copies", "v")
    counts = counted_links(members, limit)
    facts = (
        classes.join(labels.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    facts = materialise(facts, "vector-facts")
    named = units.select("vec_id", "digest").join(facts, "digest").select(F.col("vec_id").alias("id"), "component", "links").groupBy("id").agg(F.min("component").alias("component"), F.max("links").alias("links"))
    named = materialise(named, "vector-links")
    for path in (units_path, single_path, labels_path):
        drop_path(spark, path)
    whole = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return vectors.select("vec_id").join(named, F.col("vec_id") == F.col("id"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), whole.cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == whole, F.lit(True)).alias("kept")
    )
