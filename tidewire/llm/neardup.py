"""Near-duplicate groups: DartMinHash signatures, banded joining, exact check, distributed components.

Two texts are linked if the sets of their five-word runs have a Jaccard similarity of 0.8 or more; a class is a
connected set of linked texts, and its id the smallest doc_id in it. Equal texts are one text throughout.

1. One pass gives every text a signature of 240 coordinates (every run weighs 1, as the similarity is one of sets), hashed into 40 bands of 6: a pair at 0.8 shares some band
   but for one time in 200,000.
2. Texts that share a band make a bucket. A bucket is never expanded into all its pairs. Each text has a centrality,
   the sum of the sizes of its buckets: the text that copies were made from shares buckets with most of them. The most
   central texts of a bucket are its hubs, and every other member is compared with each hub; buckets of up to
   ``HUBS + 1`` texts are thus compared in full.
3. Candidates are checked exactly on the sets of runs of their whole texts.
4. Two members of a larger bucket that aren't hubs need no comparison if they are in one class by now. All others are
   compared with each other, block by block: a task counts the common runs of all pairs of two blocks at once. So every
   pair of texts that share a bucket is compared or in one class.
5. Links become classes by rounds of contraction: texts move to their best linked neighbour. Links and moves stay
   distributed, and every round is a table in the shared folder.

Every join on a bucket, a text, a class or a key deals the rows of hot ones to many tasks (``salted_join``).

Nulls and edge cases: a text of fewer than five words, but not none, has one run of all of them; texts without words
are only equal to themselves; a null text is a class of its own, with its doc_id as class_id; a null doc_id sorts last
and is a class id only where all of the class are null; repeated rows are in one class, as their texts are equal; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SALTS, hot_from, importable, read_table, salted_join, stage, text_key
from .dartminhash import bands, signatures
from .textkernel import batches_by_bytes, shingles, words

RUN = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 6
#: Hubs of a bucket of up to SMALL texts, and of a larger one.
HUBS, FEW_HUBS, SMALL = 7, 1, 64
#: Texts and runs of a block of a larger bucket's members.
BLOCK, BLOCK_RUNS = 256, 500_000
#: Above so many texts to compare their ids aren't broadcast.
MAX_KEYS = 500_000


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text"):
        text = batch.column("text")
        for w in words(text):
            s, bounds = shingles(w.hashes(), w.bounds, RUN)
            b = bands(signatures(s, bounds, BANDS * ROWS), ROWS)
            part = text.slice(w.first, len(bounds) - 1)
            keys = [None if t is None else hashlib.sha256(t.encode()).digest()[:16] for t in part.to_pylist()]
            some = np.diff(bounds) > 0
            flat = [row.tobytes() if ok else None for row, ok in zip(b, some)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(w.first, len(keys)), "key": pa.array(keys, pa.binary()), "n_runs": pa.array(np.diff(bounds), pa.int64()), "bands": pa.array(flat, pa.binary())})


def sign(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, n_runs, bands), one for each row of docs, staged."""
    importable(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(_sign, f"doc_id {kind}, key binary, n_runs bigint, bands binary"), "signatures")


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 20_000):
            part = batch.slice(lo, 20_000)
            b = np.frombuffer(b"".join(part.column("bands").to_pylist()), np.int64)
            yield pa.RecordBatch.from_pydict({"text": pa.array(np.repeat(part.column("text").to_numpy(), BANDS)), "bucket": pa.array(b + np.tile(np.arange(BANDS), part.num_rows))})


def buckets(texts: DataFrame) -> DataFrame:
    """Rows (bucket, text, size, central) of the buckets of two texts or more, staged."""
    cells = texts.filter("bands IS NOT NULL").select("text", "bands").mapInArrow(_explode, "text bigint, bucket bigint")
    cells = stage(cells, "cells")
    sizes = stage(cells.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    hot = sizes.filter(F.col("size") >= hot_from(cells.count()))
    shared = stage(salted_join(cells, sizes, "bucket", hot), "shared")
    central = shared.groupBy("text").agg(F.sum("size").alias("central"))
    return stage(shared.join(central, "text"), "buckets")


def _top(rows: DataFrame, n: int) -> DataFrame:
    """The n most central rows of each bucket, by a partial pass in every task first."""
    best = F.struct((-F.col("central")).alias("c"), "text")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)))
    for keys in (["bucket", "salt"], ["bucket"]):
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(best))
        salted = salted.withColumn("rank", rank).filter(F.col("rank") <= n)
    return salted.select("bucket", F.col("text").alias("hub"), F.col("central").alias("hub_central"), "rank", "size")


def hubs_of(members: DataFrame) -> DataFrame:
    """Rows (bucket, hub, size), staged."""
    hubs = _top(members, HUBS).filter(F.col("rank") <= F.when(F.col("size") > SMALL, FEW_HUBS).otherwise(HUBS))
    return stage(hubs.select("bucket", "hub", "size"), "hubs")


def candidates(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of each bucket's hubs with all its members."""
    large = F.col("size") > SMALL
    # the members of a large bucket are dealt to several tasks, each with the bucket's hubs
    hubs = hubs.select("bucket", "hub", F.explode(F.when(large, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salt = F.when(large, F.pmod(F.xxhash64("text"), F.lit(SALTS))).otherwise(0).cast("int").alias("salt")
    pairs = members.select("bucket", "text", salt).join(hubs, ["bucket", "salt"]).filter("text <> hub")
    return pairs.select(F.least("text", "hub").alias("a"), F.greatest("text", "hub").alias("b")).distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text"):
        for w in words(batch.column("text")):
            s, bounds = shingles(w.hashes(), w.bounds, RUN)
            sets = [np.unique(s[lo:hi]).tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(w.first, len(sets)), "runs": pa.array(sets, pa.binary())})


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("runs_a"), batch.column("runs_b")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
                keep.append(False)
                continue
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            keep.append(common >= SIMILARITY * (len(x) + len(y) - common) - 1e-9)
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(keep, pa.bool_()))


def run_sets(needed: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (id, runs), the sorted set of runs of each text in needed, staged."""
    needed = stage(needed.join(texts.select("text", "doc", "key"), "text").select(F.col("text").alias("id"), "doc", "key"), "needed")
    source = docs.select(F.col("doc_id").alias("doc"), "text")
    if needed.count() <= MAX_KEYS:
        needed = F.broadcast(needed)
    else:  # rows that repeat would meet in one task
        source = source.dropDuplicates()
    found = needed.join(source, needed["doc"].eqNullSafe(source["doc"])).filter(text_key(source["text"]) == needed["key"]).select("id", source["text"])
    return stage(found.mapInArrow(_sets, "id bigint, runs binary").dropDuplicates(["id"]), "sets")


def verify(pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) at or over the similarity."""
    degree = stage(pairs.select(F.explode(F.array("a", "b")).alias("text")).groupBy("text").agg(F.count("*").alias("n")), "degrees")
    sets = run_sets(degree.select("text"), texts, docs)
    hot = degree.filter(F.col("n") >= hot_from(pairs.count()))
    left = salted_join(pairs, sets.select(F.col("id").alias("a"), F.col("runs").alias("runs_a")), "a", hot.withColumnRenamed("text", "a"))
    both = salted_join(left, sets.select(F.col("id").alias("b"), F.col("runs").alias("runs_b")), "b", hot.withColumnRenamed("text", "b"))
    return stage(both.select("a", "b", "runs_a", "runs_b").mapInArrow(_similar, "a bigint, b bigint"), "links")


def blocks(members: DataFrame, hubs: DataFrame, label: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (bucket, i, j, block, text, root), staged: blocks i and j of a bucket, of which all pairs are to be compared.

    Hubs are left out, and buckets whose other members are in one class. A bucket of several blocks has its largest
    class in blocks of its own, which aren't paired with each other.
    """
    rest = members.filter(F.col("size") > HUBS + 1).join(hubs.select("bucket", F.col("hub").alias("text")), ["bucket", "text"], "left_anti")
    rest = rest.join(label, "text", "left").join(texts.select("text", "n_runs"), "text")
    rest = stage(rest.select("bucket", "text", F.coalesce("root", "text").alias("root"), "n_runs"), "rest")
    by_class = rest.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("n_runs").alias("runs"))
    open_ = by_class.groupBy("bucket").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("runs").alias("runs"), F.max(F.struct("n", "root", "runs")).alias("main")).filter("classes > 1")
    open_ = stage(open_, "open")
    hot = open_.filter(F.col("n") >= hot_from(rest.count()))
    fill = lambda n, runs: F.ceil(F.greatest(n / BLOCK, runs / BLOCK_RUNS))
    whole = fill(F.col("n"), F.col("runs")) == 1
    first = F.when(whole, 1).otherwise(fill(F.col("n") - F.col("main.n"), F.col("runs") - F.col("main.runs"))).alias("first")
    last = F.when(whole, 0).otherwise(fill(F.col("main.n"), F.col("main.runs"))).alias("last")
    dealt = salted_join(rest, open_.select("bucket", F.when(~whole, F.col("main.root")).alias("main"), first, last), "bucket", hot)
    dealt = dealt.withColumn("in_main", F.coalesce(F.col("root") == F.col("main"), F.lit(False))).withColumn("hash", F.xxhash64("text"))
    dealt = dealt.withColumn("block", F.when(F.col("in_main"), F.expr("first + pmod(hash, last)")).otherwise(F.expr("pmod(hash, first)")))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, first + if(in_main, 0, last) - 1)")))
    return stage(dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "text", "root"), "blocks")


def _compare(key: tuple, rows: pa.Table) -> pa.Table:
    """The pairs (a, b) of two blocks, or in one, that are in two classes and at or over the similarity."""
    runs = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("runs")]
    n = np.array([len(x) for x in runs])
    text, root, block = (rows.column(c).to_numpy() for c in ("text", "root", "block"))
    x, y = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
    _, run, seen = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(runs)), n)
    shared = seen > 1  # a run of one text is common to none
    of, run = of[shared[run]], (np.cumsum(shared) - 1)[run[shared[run]]]
    order = np.argsort(run, kind="stable")
    of, run = of[order], run[order]
    common = np.zeros((len(x), len(y)), np.float32)
    step = 4096
    for lo in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(run, [lo, lo + step])
        has = np.zeros((len(runs), step), np.float32)
        has[of[a:b], run[a:b] - lo] = 1
        common += has[x] @ has[y].T
    common = common.astype(np.float64)
    close = (common >= SIMILARITY * (n[x][:, None] + n[y] - common) - 1e-9) & (root[x][:, None] != root[y])
    p, q = np.nonzero(close)
    p, q = text[x[p]], text[y[q]]
    pairs = np.unique(np.stack([np.minimum(p, q), np.maximum(p, q)], axis=1), axis=0).astype(np.int64)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def compare(dealt: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The links (a, b) between the classes in the blocks."""
    sets = run_sets(dealt.select("text").distinct(), texts, docs)
    rows = dealt.join(sets.withColumnRenamed("id", "text"), "text")
    return stage(rows.groupBy("bucket", "i", "j").applyInArrow(_compare, "a bigint, b bigint").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """Rows (text, root): one text of each connected set, for every text with a link.

    Each round every text moves to the best of itself and its neighbours: the one with the most links, ties by a hash
    that changes with the round. Links then join the new places; those inside one place are done. A star is one place
    after one round, and whatever is left shrinks by a constant factor in each, so rounds grow with the logarithm.
    """
    edges = stage(links.select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    while total := edges.count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = stage(both.groupBy("a").agg(F.count("*").alias("links")), "degrees")
        hot = degree.filter(F.col("links") >= hot_from(total)).select("a")
        hot_b = hot.withColumnRenamed("a", "b")
        rank = degree.select(F.col("a").alias("b"), F.struct((-F.col("links")).alias("links"), F.xxhash64(F.col("a"), F.lit(len(moves))).alias("hash"), F.col("a").alias("text")).alias("rank"))
        best = salted_join(both, rank, "b", hot_b).groupBy("a").agg(F.min("rank").alias("best"))
        move = best.join(rank.withColumnRenamed("b", "a"), "a").select(F.col("a").alias("text"), F.least("best", "rank")["text"].alias("root"))
        move = stage(move, "moves")
        moved = salted_join(edges, move.select(F.col("text").alias("a"), F.col("root").alias("x")), "a", hot)
        moved = salted_join(moved, move.select(F.col("text").alias("b"), F.col("root").alias("y")), "b", hot_b)
        edges = stage(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        moves.append(move)
    label = moves[0] if moves else links.select(F.col("a").alias("text"), F.col("a").alias("root"))
    for move in moves[1:]:
        sizes = stage(label.groupBy("root").agg(F.count("*").alias("n")), "sizes")
        hot = sizes.filter(F.col("n") >= hot_from(label.count()))
        label = salted_join(label, move.select(F.col("text").alias("root"), F.col("root").alias("next")), "root", hot, "left").select("text", F.coalesce("next", "root").alias("root"))
        label = stage(label, "labels")
    return label if moves[1:] else stage(label, "labels")


def classes(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, class_id, class_key, class_size) for each row of docs; size counts rows.

    (class_id, class_key) name the text that stands for the class: the smallest doc_id in it, and of the texts with
    that id the smallest key.
    """
    signed = sign(docs)
    # equal texts become one text, named by a number made from its key
    one = signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("bands", True).alias("bands"), F.first("n_runs", True).alias("n_runs"), F.count("*").alias("n"))
    texts = stage(one.withColumn("text", F.monotonically_increasing_id()), "texts")
    members = buckets(texts)
    hubs = hubs_of(members)
    links = verify(stage(candidates(members, hubs), "pairs"), texts, docs)
    label = components(links)
    rest = blocks(members, hubs, label, texts)
    if rest.limit(1).count():
        more = compare(rest, texts, docs)
        if more.limit(1).count():
            label = components(links.union(more))
    named = stage(texts.join(label, "text", "left").select("key", "doc", "n", F.coalesce("root", "text").alias("root")), "named")
    heads = named.groupBy("root").agg(F.min(F.struct(F.isnull("doc").alias("none"), "doc", F.hex("key").alias("key"))).alias("head"), F.sum("n").alias("class_size"), F.count("*").alias("n_texts"))
    heads = stage(heads, "heads")
    hot = heads.filter(F.col("n_texts") >= hot_from(named.count())).select("root")
    by_key = salted_join(named, heads, "root", hot).select("key", F.col("head.doc").alias("class_id"), F.unhex("head.key").alias("class_key"), "class_size", "n")
    by_key = stage(by_key, "classes")
    rows = signed.select("doc_id", "key")
    hot = by_key.filter(F.col("n") >= hot_from(signed.count())).select("key")
    out = salted_join(rows.filter("key IS NOT NULL"), by_key, "key", hot).select("doc_id", "key", "class_id", "class_key", "class_size")
    # null texts need no join, which would bring them into one task
    alone = rows.filter("key IS NULL").select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(None).cast("binary").alias("class_key"), F.lit(1).cast("bigint").alias("class_size"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each class, with all its columns: that of the text which stands for the class."""
    found = classes(docs)
    heads = stage(found.filter("key IS NOT NULL AND doc_id <=> class_id AND key = class_key").select("doc_id", "key").distinct(), "heads")
    # rows that repeat become one before they meet their head: the aggregate merges them in every task first
    name = F.when(F.col("doc_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("doc_id").cast("string")))
    tagged = docs.filter("text IS NOT NULL").select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), name.alias("who"), text_key(docs["text"]).alias("what"))
    one = tagged.groupBy("who", "what").agg(F.first("row").alias("row"))
    kept = one.join(heads.select(name.alias("who"), F.col("key").alias("what")), ["who", "what"]).select("row.*")
    return kept.unionByName(docs.filter("text IS NULL"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")
