"""Near-dedup of documents by min-max hashing.

One evaluation of a random permutation of a shingle set gives two values, its smallest and its largest image; both agree
between two sets with their Jaccard similarity, so ``bands * rows`` values need half as many evaluations.  Bands of
``rows`` values are candidate buckets; every link is confirmed on the full sets.

Equal sets are one class with its smallest doc_id as representative; only representatives go on.  Buckets of up to
``SMALL`` members compare all of them.  A larger one makes no list of its pairs:

1. Shingles that few documents of large buckets have are joined directly.  Two documents that share none of these can have
   no more in common than their other shingles.  With the sizes of both this is an exact bound; it takes out at once
   the edited copies that are too far from every other.
2. A few members, the same ones in all buckets, are compared with the others.  That unites nearly all of a group of
   copies, and members of one component need no further comparison.
3. What is not in a bucket's largest component is compared with all its members.

Of the buckets that two documents share, one makes their pair.

So every pair of different components in a bucket is either compared or ruled out by the bound.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.llm.graph import components
from stallweave.llm.shingles import mixed, shingle_sets
from stallweave.llm.tables import drop_path, per_worker, sliced, stored

#: Members of a bucket that are all compared with each other.
SMALL = 32
#: A shingle of at most so many documents of large buckets is rare.
RARE = 16
#: Members of a larger bucket that are compared with the others, turn by turn; at last all outside its main component.
CENTRES = (32, None)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and offsets of ``count`` permutations of the 64-bit numbers, as columns."""
    rng = np.random.default_rng(8191)
    return (rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None], rng.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hashes of the bands of a non-empty set's signature."""
    factor, offset = per_worker(f"minmax {bands * rows}", lambda: permutations(-(-bands * rows // 2)))
    low, high = np.full(len(factor), np.iinfo(np.uint64).max), np.zeros(len(factor), np.uint64)
    for start in range(0, len(shingles), 2048):
        images = shingles[start : start + 2048][None, :] * factor + offset
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    values = np.concatenate([low, high])[: bands * rows].reshape(bands, rows)
    h = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        h = mixed(h * np.uint64(3) + values[:, k])
    return h


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, digest (of the set; null for an empty one), n (its size), bands."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sizes, signatures = [], [], []
        for shingles in shingle_sets(batch.column("text").to_pylist(), width):
            sizes.append(len(shingles))
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            signatures.append(band_hashes(shingles, bands, rows).view(np.int64) if len(shingles) else np.empty(0, np.int64))
        ends = np.cumsum([0, *map(len, signatures)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *signatures])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists], ["doc_id", "digest", "n", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sliced(work, 2 << 20), f"doc_id {kind}, digest binary, n long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough.  Sorted by a, so a centre's set is made once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        fresh = [i for i in range(len(left)) if i == 0 or left[i] != left[i - 1]]
        own = shingle_sets([left[i] for i in fresh], width)
        keep, k = [], -1
        for i, other in enumerate(shingle_sets(right, width)):
            k += i == 0 or left[i] != left[i - 1]
            same = len(np.intersect1d(own[k], other, assume_unique=True))
            keep.append(100 * same >= percent * (len(own[k]) + len(other) - same))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    kind = texts.schema["doc"].dataType.simpleString()
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(sliced(work, 4 << 20), f"a {kind}, b {kind}").distinct()


def crowd_shingles(texts: DataFrame, width: int) -> DataFrame:
    """(shingle, doc) of all texts (doc, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), width)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)), batch.column("doc").take(pa.array(owner, pa.int64()))], ["shingle", "doc"])

    kind = texts.schema["doc"].dataType.simpleString()
    return texts.mapInArrow(sliced(work, 2 << 20), f"shingle long, doc {kind}")


def crowds_of(buckets: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(key, doc, n, can, m) of the large buckets, and (a, b) of their documents that share a rare shingle.

    A shingle that at most ``RARE`` of these documents have is rare.  Two documents that share no rare one have at most
    ``can`` shingles in common, the smaller of their numbers of others; ``common >= percent / 100 * all`` needs
    ``common * (100 + percent) >= percent * (n + n of the other)``.  Members whose bound rules out every such partner go.
    Those that do share rare ones are pairs of their own, at most ``RARE`` to a document and shingle.
    """
    large = buckets.where(F.col("m") > SMALL)
    sizes = large.groupBy("doc").agg(F.first("n").alias("n"))
    shingles, path = stored(crowd_shingles(texts.join(sizes, "doc", "left_semi"), width), "crowd-shingles")
    rare = shingles.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") <= RARE)
    held, held_path = stored(shingles.join(rare.select("shingle"), "shingle", "left_semi"), "rare-shingles")
    rare_of = held.groupBy("doc").agg(F.count("*").alias("rare"))
    bounds, bounds_path = stored(sizes.join(rare_of, "doc", "left").withColumn("can", F.col("n") - F.coalesce("rare", F.lit(0))).select("doc", "n", "can"), "crowd-bounds")
    able, able_path = stored(large.drop("n").join(bounds.where(F.col("can") * 100 >= F.col("n") * percent), "doc"), "crowd-members")
    least = able.groupBy("key").agg(F.min("n").alias("least_n"))
    crowds = able.join(least, "key").where(F.col("can") * (100 + percent) >= (F.col("n") + F.col("least_n")) * percent).select("key", "doc", "n", "can", "m")
    sharing = held.groupBy("shingle").agg(F.sort_array(F.collect_list("doc")).alias("docs")).where(F.size("docs") > 1)
    pairs = (
        sharing.select(F.posexplode("docs").alias("i", "a"), "docs")
        .select("a", F.explode(F.expr("slice(docs, i + 2, size(docs))")).alias("b"))
        .groupBy("a", "b").agg(F.count("*").alias("shared"))
        .join(bounds.select(F.col("doc").alias("a"), F.col("n").alias("a_n"), F.col("can").alias("a_can")), "a")
        .join(bounds.select(F.col("doc").alias("b"), F.col("n").alias("b_n"), F.col("can").alias("b_can")), "b")
        .where((F.col("shared") + F.least("a_can", "b_can")) * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent)
        .where(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)
        .select("a", "b")
    )
    return crowds, pairs, [path, held_path, bounds_path, able_path]


def crowd_pairs(crowds: DataFrame, chosen: Column, percent: int) -> DataFrame:
    """(a, b): chosen members of each bucket against all members of other components that the bound leaves."""
    marked = crowds.withColumn("centre", chosen)
    # Of the buckets two documents share, only the one with the least key makes their pair.
    centres = marked.where("centre").select(
        "key", F.col("doc").alias("c"), F.col("n").alias("c_n"), F.col("can").alias("c_can"), F.col("component").alias("c_component"), F.col("keys").alias("c_keys")
    )
    able = F.least("can", "c_can") * (100 + percent) >= (F.col("n") + F.col("c_n")) * percent
    near = F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent
    once = ~F.col("centre") | (F.col("doc") > F.col("c"))
    first = F.array_min(F.array_intersect("keys", "c_keys")) == F.col("key")
    apart = F.col("component") != F.col("c_component")
    return marked.join(centres, "key").where(apart & able & near & once & first).select(F.col("c").alias("a"), F.col("doc").alias("b")).distinct()


def small_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all members of each bucket of at most ``SMALL`` whose sizes allow a link."""
    small = buckets.where(F.col("m") <= SMALL)
    other = small.select("key", F.col("doc").alias("b"), F.col("n").alias("b_n"))
    near = F.least("n", "b_n") * 100 >= F.greatest("n", "b_n") * percent
    return small.join(other, "key").where((F.col("doc") < F.col("b")) & near).select(F.col("doc").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; other columns ignored).

    Documents whose sets of ``width``-word shingles have ``100 * common >= percent * all`` are linked; component_id is the
    smallest doc_id reachable, kept tells whether it is the row's own.  A pair at the threshold is missed as a candidate
    with probability ``(1 - (percent / 100) ** rows) ** bands`` (3e-6 with the defaults).  Null and empty texts link with
    nothing.  Rows that repeat a doc_id are one document.  Rows without doc_id take no part: no component, kept.  An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sketch, _ = stored(sketches(docs, width, bands, rows), "sketches")
    named = sketch.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes, _ = stored(named.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    keys = (
        named.join(classes.select(F.col("digest").alias("d"), "rep"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("rep")))
        .select(F.col("rep").alias("doc"), "n", F.explode("bands").alias("key"))
        .distinct()
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    buckets, buckets_path = stored(keys.join(shared, "key"), "buckets")
    texts, texts_path = stored(docs.join(buckets.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text").distinct(), "bucket-texts")
    crowds, sharing, used = crowds_of(buckets, texts, width, percent)
    crowds, crowds_path = stored(crowds, "crowds")
    used += [buckets_path, texts_path, crowds_path]
    pairs = small_pairs(buckets, percent).unionByName(sharing)
    links, label, link_paths = None, None, []
    for turn, centres in enumerate(CENTRES):
        if label is None:
            members = crowds.withColumn("component", F.col("doc"))
        else:
            # Names meet each document once, and then its rows in the buckets.
            own = crowds.select("doc").distinct().join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
            members, members_path = stored(crowds.join(own, "doc"), "named-members")
            used.append(members_path)
            open_keys = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
            members = members.join(open_keys, "key", "left_semi")
        # What a document needs of all its buckets, at most ``bands`` keys and the size of the largest.
        members = members.join(members.groupBy("doc").agg(F.max("m").alias("largest"), F.collect_set("key").alias("keys")), "doc")
        if centres is not None:
            # One choice for all buckets of a document.
            chosen = F.pmod(F.xxhash64("doc", F.lit(turn)), F.lit(1 << 30)) <= F.lit(float(centres)) / F.col("largest") * (1 << 30)
        else:
            counts = members.groupBy("key", "component").agg(F.count("*").alias("size"))
            main = counts.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
            members, chosen = members.join(main, "key"), F.col("component") != F.col("main")
        members, members_path = stored(members.withColumn("chosen", chosen), "members")
        more = crowd_pairs(members, F.col("chosen"), percent)
        found, found_path = stored(confirmed(pairs.unionByName(more).distinct() if label is None else more, texts, width, percent), "links")
        link_paths.append(found_path)
        links = spark.read.schema(found.schema).parquet(*link_paths)
        label, label_path = stored(components(links), "labels")
        used += [members_path, label_path]
        if crowds.isEmpty():
            break
    groups, _ = stored(classes.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("group_id")), "groups")
    for path in used + link_paths:
        drop_path(spark, path)
    out = sketch.select("doc_id", "digest", F.col("n").alias("n_shingles")).join(groups, "digest", "left")
    whole = F.when(F.col("doc_id").isNotNull(), F.coalesce("group_id", "doc_id"))
    return out.select("doc_id", "n_shingles", whole.alias("component_id"), F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, without those whose component has a smaller doc_id."""
    gone = near_duplicates(docs, **options).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
