"""Benchmark decontamination by a distributed positional inverted index (native: DataFrame functions only).

Index: one pass over the texts writes a posting (term, document, position) for every training token whose term occurs
in the test windows; with a vocabulary over ``max_terms`` it writes all tokens' postings instead, without a broadcast.
A posting of the empty term at position 0 stands for the document itself and carries its number of words. The index
is partitioned by document, so building it needs no shuffle.

Search: the frequency of each test term comes from all postings. Every window takes its rarest term; that term's
postings, moved back by its offset in the window, are the possible starts. They are intersected with the moved postings
of the window's second rarest term, and what remains is compared word by word with the text: for phrase matches at the
start itself, for proximity matches at the starts around it, where each word of the window has to stand at most
``slop`` words from its place. So both kinds of matches are complete and exact.

Nulls and edge cases: a null or wordless text has no words and no hits; a null item text gives no windows; a null item
id is never counted; repeated items count once by id; repeated document rows each get a result row; an empty benchmark
or an empty table is fine; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_table, row_hash, stage

WINDOW = 8
#: So many words may a word of a proximity match be from its place.
SLOP = 1
#: Above so many test terms or windows nothing of the benchmark is broadcast.
MAX_TERMS = 200_000
#: Above so many documents with possible matches their keys aren't broadcast.
MAX_DOCS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAPS), "")


def windows_of(items: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """Rows (item_id, words) of the windows of ``size`` words; an item of fewer, but not none, is one."""
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - F.lit(size - 1)))
    out = words.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.expr(f"slice(w, at, {size})").alias("words"))
    return out.distinct()


def build_index(docs: DataFrame, terms: DataFrame | None) -> DataFrame:
    """Postings (doc_id, h, n_words, term, pos); positions count from 1. terms: a small table of the terms to keep."""
    empty = F.array(F.lit(""))
    rows = docs.select("doc_id", row_hash(F.col("text")).alias("h"), words_of(F.col("text")).alias("w"))
    tokens = rows.select("doc_id", "h", F.size("w").cast("bigint").alias("n_words"), F.posexplode(F.concat(empty, "w")).alias("pos", "word"))
    postings = tokens.select("doc_id", "h", "n_words", F.xxhash64("word").alias("term"), "pos")
    if terms is not None:
        postings = postings.join(F.broadcast(terms), "term", "left_semi")
    return stage(postings, "postings")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])


def candidates(index: DataFrame, windows: DataFrame, slop: int, small: bool) -> DataFrame:
    """Rows (doc_id, h, phrase_id, start) where the postings of a window's two rarest terms fit together.

    windows: rows (phrase_id, words). A window with a term that no document has is dropped first. start is where the
    window begins if the rarest term is in its place; with a slop both terms may be so many words from theirs.
    """
    hint = F.broadcast if small else (lambda df: df)
    terms = windows.select("phrase_id", F.size("words").alias("n"), F.posexplode("words").alias("off", "word")).select("phrase_id", "n", "off", F.xxhash64("word").alias("term"))
    frequency = index.groupBy("term").agg(F.count("*").alias("n_postings"))
    by_rarity = W.partitionBy("phrase_id").orderBy("n_postings", "off")
    ranked = terms.join(hint(frequency), "term").withColumn("found", F.count("*").over(W.partitionBy("phrase_id"))).filter("found = n").withColumn("rank", F.row_number().over(by_rarity))
    ranked = stage(ranked.filter("rank <= 2").select("phrase_id", "n", "off", "term", "rank"), "rare-terms")
    first = ranked.filter("rank = 1").select("phrase_id", "n", "off", "term")
    second = ranked.filter("rank = 2").select("phrase_id", F.col("off").alias("off2"), F.col("term").alias("term2"))
    moved = index.join(hint(first), "term").withColumn("start", F.col("pos") - F.col("off")).filter(f"start >= 1 - {2 * slop} AND start + n - 1 <= n_words + {2 * slop}")
    moved = moved.select("doc_id", "h", "phrase_id", "start", "n")
    alone = moved.filter("n = 1").select("doc_id", "h", "phrase_id", "start")
    # places fall into cells as wide as what is allowed, so that the range becomes an equality of at most two cells
    reach = 2 * slop
    cell = lambda pos: F.floor(pos / (2 * reach + 1)).cast("int")
    left = moved.filter("n > 1").join(hint(second), "phrase_id").select("doc_id", "h", "phrase_id", "start", "term2", (F.col("start") + F.col("off2")).alias("pos2"))
    left = left.withColumn("cell", F.explode(F.array_distinct(F.array(cell(F.col("pos2") - reach), cell(F.col("pos2") + reach)))) if slop else F.col("pos2"))
    right = index.join(hint(second.select(F.col("term2").alias("term")).distinct()), "term", "left_semi").select("doc_id", "h", "term", "pos").distinct()
    right = right.withColumn("cell", cell(F.col("pos")) if slop else F.col("pos"))
    both = left.join(right, _same(left, right) & (left["term2"] == right["term"]) & (left["cell"] == right["cell"]) & (F.abs(left["pos2"] - right["pos"]) <= reach), "left_semi")
    return both.select("doc_id", "h", "phrase_id", "start").union(alone)


def _exact(w: Column, place: Column) -> Column:
    """Whether a place's phrase stands there word for word."""
    return (place["start"] >= 1) & (F.slice(w, F.greatest(place["start"], F.lit(1)), F.size(place["words"])) == place["words"])


def _near(w: Column, place: Column, slop: int) -> Column:
    """Whether every word of a place's phrase stands within slop words of its own place, for a start at most slop away."""

    def there(start: Column) -> Column:
        def word_there(word: Column, off: Column) -> Column:
            low = F.greatest(start + off - slop, F.lit(1))
            return F.array_contains(F.slice(w, low, F.greatest(start + off + slop - low + 1, F.lit(0))), word)

        # the positions of the words that are there, as forall doesn't tell its function the position
        return F.forall(F.transform(place["words"], word_there), lambda x: x)

    return F.exists(F.sequence(place["start"] - slop, place["start"] + slop), there)


def _union_length(spans: Column) -> Column:
    """Words covered by an array of structs (start, n)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(acc: Column, x: Column) -> Column:
        end = (x["start"] + x["n"]).cast("bigint")
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["total"] + F.greatest(F.lit(0).cast("bigint"), end - F.greatest(x["start"].cast("bigint"), acc["end"]))).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["total"])


def _texts_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The places (doc_id, h, places) with the words ``w`` of their documents, one row for each document."""
    texts = docs.select(F.col("doc_id").alias("d"), row_hash(F.col("text")).alias("k"), "text")
    if places.count() <= MAX_DOCS:
        keys = places.select("doc_id", "h")
        texts = texts.join(F.broadcast(keys), texts["d"].eqNullSafe(keys["doc_id"]) & (texts["k"] == keys["h"]), "left_semi")
    # rows that repeat are one here; the partial aggregate merges them before the shuffle
    texts = texts.groupBy("d", "k").agg(F.first("text").alias("text"))
    # split below the join: above it, the split would move into the functions that run for every place
    texts = texts.select("d", "k", words_of(F.col("text")).alias("w"))
    return places.join(texts, places["doc_id"].eqNullSafe(texts["d"]) & (places["h"] == texts["k"])).select("doc_id", "h", "places", "w")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, least_items: int = 2, slop: int = SLOP, max_terms: int = MAX_TERMS) -> DataFrame:
    """Rows (doc_id, h, n_words, n_hit, n_items, items_sha256, contaminated, n_near, near_sha256, n_whole), one for each
    row of docs.

    n_near counts the items with a window whose words all stand within ``slop`` words of their places (exact windows
    included); n_whole those with an exact window of all ``window`` words, which a shorter item can't have.
    """
    every = stage(windows_of(items, "item_id", "text", window), "windows")
    # windows get a number of their own: a hash could make two of them one
    windows = stage(every.select("words").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    terms = windows.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).union(docs.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("term"))).distinct()
    terms = stage(terms, "terms")
    small = max(terms.count(), every.count()) <= max_terms
    hint = F.broadcast if small else (lambda df: df)
    index = build_index(docs, terms if small else None)
    possible = candidates(index, windows, slop, small).distinct().join(hint(windows.select("phrase_id", "words")), "phrase_id")
    possible = stage(possible.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "words", "phrase_id")).alias("places")), "places")
    w = F.col("w")
    seen = _texts_at(docs, possible).select(
        "doc_id", "h",
        F.filter("places", lambda x: _exact(w, x)).alias("exact"),
        F.array_distinct(F.transform(F.filter("places", lambda x: _near(w, x, slop)), lambda x: x["phrase_id"])).alias("near"),
    ).filter(F.size("near") > 0)
    spans = F.transform("exact", lambda x: F.struct(x["start"].alias("start"), F.size(x["words"]).alias("n")))
    hits = stage(seen.select("doc_id", "h", _union_length(spans).alias("n_hit"), F.array_distinct(F.transform("exact", lambda x: x["phrase_id"])).alias("phrases"), "near"), "hits")
    found = hits.select("doc_id", "h", F.explode("near").alias("phrase_id"), "phrases").withColumn("is_exact", F.array_contains("phrases", F.col("phrase_id"))).drop("phrases")
    owners = every.join(windows, "words").select("phrase_id", F.col("item_id").cast("string").alias("item"), (F.size("words") == window).alias("whole")).filter("item IS NOT NULL").distinct()
    by_doc = found.join(hint(owners), "phrase_id").groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.when(F.col("is_exact"), F.col("item")))).alias("items"),
        F.array_sort(F.collect_set("item")).alias("near"),
        F.count_distinct(F.when(F.col("is_exact") & F.col("whole"), F.col("item"))).alias("n_whole"),
    )
    hits = hits.select("doc_id", "h", "n_hit")
    hits = hits.join(by_doc, _same(hits, by_doc), "left").select(hits["doc_id"].alias("d"), hits["h"].alias("k"), "n_hit", "items", "near", "n_whole")
    base = index.filter(F.col("term") == F.xxhash64(F.lit(""))).select("doc_id", "h", "n_words")
    out = base.join(hits, base["doc_id"].eqNullSafe(hits["d"]) & (base["h"] == hits["k"]), "left")
    none = F.array().cast("array<string>")
    zero = F.lit(0).cast("bigint")
    out = out.select("doc_id", "h", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"), F.coalesce("n_whole", zero).alias("n_whole"))
    n, sha = F.size("items").cast("bigint"), lambda c: F.sha2(F.array_join(c, ","), 256)
    return out.select("doc_id", "h", "n_words", "n_hit", n.alias("n_items"), sha("items").alias("items_sha256"), (n >= least_items).alias("contaminated"), F.size("near").cast("bigint").alias("n_near"), sha("near").alias("near_sha256"), "n_whole")


def clean(docs: DataFrame, items: DataFrame, least_whole: int = 1, least_items: int = 2) -> DataFrame:
    """The rows of docs without benchmark passages, with all their columns.

    A row goes if it holds a whole window (``WINDOW`` words) of ``least_whole`` items, or any windows of
    ``least_items``: one item of a few words alone is no evidence, as its words may stand in any text.
    """
    found = contamination(docs, items, least_items=least_items, slop=0)
    bad = stage(found.filter(F.col("contaminated") | (F.col("n_whole") >= least_whole)).select("doc_id", "h").distinct(), "contaminated")
    keys = F.broadcast(bad) if bad.count() <= MAX_DOCS else bad
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["doc_id"]) & (row_hash(docs["text"]) == keys["h"]), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("h", "n_whole")
