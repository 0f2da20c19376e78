"""Language-model scores from a log-frequency Bloom filter.

1. One pass turns the texts into tokens and stages them in chunks: the sorted hashes of a chunk's distinct tokens and,
   for each token, its place among them. The text isn't read again.
2. Distinct tokens go, in ranges of their hash, to tasks that add up their training counts and send each chunk its
   tokens' counts: so N, V and every unigram count are exact, and no task or broadcast holds all tokens.
3. Pairs of tokens go, in ranges of the hash of their first token, to tasks that count them and build a Bloom filter
   for the range: a count c is held as the entries (pair, 1) to (pair, 1 + floor(log c / log BASE)), and likewise the
   number of distinct followers of a token. A filter's size follows its number of entries. A first token with more
   training tokens than a range should hold is hot: its pairs are dealt by their own hash, and its followers, counted
   range by range, are added up and broadcast beside the filter. A token's training count, which every chunk has by
   then, tells whether it is hot, so no task holds all pairs of a common token, and there are at most ``HOT`` hot ones.
4. Filters are broadcast in shards of a size that follows the executors' memory (``shard_bytes``). For each shard a pass over the chunks, by now staged
   with their tokens' counts, adds up the tokens whose pair is in its ranges: memory stays bounded whatever the corpus, and
   a pass shuffles nothing. A count is read back by probing level after level until one is missing. The probability
   interpolates the pair with the unigram by absolute discounting: max(c(u,w) - D, 0) / c(u) + D T(u) / c(u) * p(w),
   with p(w) the add-0.1 unigram.

Nulls and edge cases: a null or empty text has one token, the end; a null id counts as fold 0 (held out); repeated
rows are scored each; with no training rows N and V are 0 and every score is 0; other columns are ignored; texts of
any length are read in full.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, forget_shuffles, importable, read_table, stage, unstage
from .textkernel import TOKEN_BYTES, U64, batches_by_bytes, mix, mix_int, release, words

FOLDS = 10
ALPHA = 0.1
DISCOUNT = 0.75
BASE = 1.5
BITS, PROBES = 10, 5
#: Bytes of text in a chunk, pairs of a range, and the least bytes of a broadcast shard of the filter.
CHUNK, RANGE, FILTER_BYTES = 8 << 20, 1 << 20, 52 << 20
#: What a shard may take of an executor's heap for each of its cores, as each worker holds it, of the driver's heap, which
#: holds it some times over, and of what may be collected at once.
OF_CORE, OF_DRIVER, OF_RESULT = 1 / 16, 1 / 16, 1 / 4
#: Bits of a pair within its range: at a million pairs a range, fewer than one of them is taken for another.
NARROW = U64((1 << 40) - 1)
#: Bits of a context within its range, and the bit that marks a hot one; a token is hot with over one in HOT of all.
CONTEXT, IS_HOT, HOT = U64((1 << 39) - 1), U64(1 << 39), 1 << 16
#: Tokens that are looked up at once.
PIECE = 1 << 17
END = U64(mix_int(0x656E64))
_PAIR, _FOLLOWERS = U64(0x9DDFEA08EB382D69), U64(0x5851F42D4C957F2D)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _pack40(x: np.ndarray) -> bytes:
    """40-bit numbers in five bytes each."""
    return (x & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (x >> U64(32)).astype(np.uint8).tobytes()


def _unpack40(x: bytes) -> np.ndarray:
    n = len(x) // 5
    return np.frombuffer(x, np.uint32, n).astype(U64) | (np.frombuffer(x, np.uint8, n, 4 * n).astype(U64) << U64(32))


def _tokenise(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches_by_bytes(batches, "text"):
            held_all = batch.column("fold").to_numpy() == 0
            for w in words(batch.column("text"), TOKEN_BYTES, CHUNK):
                n = len(w.bounds) - 1
                tokens = np.empty(len(w.starts) + n, U64)
                tokens[np.arange(len(w.starts)) + w.doc_of()] = w.hashes()
                bounds = w.bounds + np.arange(n + 1)
                tokens[bounds[1:] - 1] = END
                keys, code = np.unique(tokens, return_inverse=True)
                size = np.diff(bounds)
                held = held_all[w.first : w.first + n]
                count = np.bincount(code[np.repeat(~held, size)], minlength=len(keys))
                row = {
                    "block": pa.array([block], pa.int64()), "docs": _one(batch.column("doc_id").slice(w.first, n), kind), "held": _one(pa.array(held), pa.bool_()), "size": _one(pa.array(size, pa.int64()), pa.int64()),
                    "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([_pack(count.astype(np.uint32))], pa.binary()), "codes": pa.array([_pack(code.astype(np.uint32))], pa.binary()),
                }
                block += 1
                yield pa.RecordBatch.from_pydict(row)

    return run


def _one(values: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the 2^bits ranges of sorted hashes."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << U64(64 - bits) if bits else np.zeros(0, U64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _unigrams(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(batch.column("block").to_pylist(), batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                k, c = np.frombuffer(keys, U64), _unpack(counts, np.uint32)
                at = _ranges(k, bits)
                rows = [(p, block, k[a:b].tobytes(), _pack(c[a:b])) for p, (a, b) in enumerate(zip(at, at[1:])) if b > a]
                yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for n, v, t in zip(("part", "block", "keys", "counts"), zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))})

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Of a range: each chunk's counts over all chunks, and the range's tokens and distinct tokens."""
    keys = [np.frombuffer(x, U64) for x in table["keys"].to_pylist()]
    counts = [_unpack(x, np.uint32) for x in table["counts"].to_pylist()]
    _, code = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(code, np.concatenate(counts)).astype(np.int64)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    out = [_pack(total[c]) for c in np.split(code, cuts)]
    n, v = int(total.sum()), int((total > 0).sum())
    first = [1] + [0] * (len(out) - 1)
    return pa.table({"block": table["block"], "part": table["part"], "total": pa.array(out, pa.binary()), "n": pa.array([n * f for f in first], pa.int64()), "v": pa.array([v * f for f in first], pa.int64())})


def _context(code: np.ndarray, keys: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each token, the place of the token before it among the keys; before a document's first stands the end."""
    place = np.empty(len(code), np.uint32)
    place[1:] = code[:-1]
    place[np.concatenate([[0], np.cumsum(size)])[:-1]] = np.searchsorted(keys, END)
    return place


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * _PAIR + w)


def hot_over(n: int, range_pairs: int) -> int:
    """The training count above which a token is hot, so that of n tokens fewer than HOT are."""
    return max(range_pairs, n // HOT)


def _route(u: np.ndarray, pair: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """Hashes whose first bits are a pair's range: its context's, or if that is hot, its own, with the context after them."""
    if not hot.any():
        return u
    top = ~U64(0) << U64(64 - bits)
    return np.where(hot, (pair & top) | (u >> U64(bits)), u)


def _pairs(bits: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                size, held = np.array(get("size"), np.int64), np.array(get("held"), bool)
                keys, code = np.frombuffer(get("keys"), U64), _unpack(get("codes"), np.uint32)
                use = np.repeat(~held, size)
                place = _context(code, keys, size)[use]
                hot = (_unpack(get("counts"), np.int64) > limit)[place]
                u = keys[place]
                pair = _pair(u, keys[code[use]])
                order = np.argsort(pair)
                pair, u, hot = pair[order], u[order], hot[order]
                first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
                count = np.diff(np.concatenate([first, [len(pair)]])).astype(np.uint32)
                pair, u, hot = pair[first], u[first], hot[first]
                to = _route(u, pair, hot, bits)
                order = np.argsort(to, kind="stable")
                pair, count = pair[order], count[order]
                u = ((u & CONTEXT) | np.where(hot, IS_HOT, U64(0)))[order]
                at = _ranges(to[order], bits)
                rows = []
                for p, (a, b) in enumerate(zip(at, at[1:])):
                    if b > a:
                        head = np.flatnonzero(np.concatenate([[True], u[a + 1 : b] != u[a : b - 1]]))
                        runs = np.diff(np.concatenate([head, [b - a]])).astype(np.uint32)
                        rows.append((p, _pack40(u[a:b][head]), _pack(runs), _pack40(pair[a:b] & NARROW), _pack(count[a:b])))
                names = ("part", "contexts", "runs", "pairs", "counts")
                yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for n, v, t in zip(names, list(zip(*rows)) or [()] * 5, (pa.int32(), *[pa.binary()] * 4))})
        release()

    return run


def level(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / math.log(BASE) + 1e-9).astype(np.int64)


#: The count that a level stands for: the middle, on the log scale, of the counts at that level; 0 for level 0.
LEVELS = np.array([0.0] + [math.exp(np.mean(np.log(c))) if len(c := [x for x in range(1, 400) if level(np.array([x]))[0] == j]) else BASE ** (j - 0.5) for j in range(1, 120)])


def _masks(x: np.ndarray) -> np.ndarray:
    """PROBES of 64 bits, from a hash."""
    out = np.zeros(len(x), U64)
    for i in range(PROBES):
        out |= U64(1) << ((x >> U64(6 * i)) & U64(63))
    return out


def _entry(key: np.ndarray, j: int, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word within the filter, and mask, of the entry (key, level j)."""
    x = mix(key + U64((j * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
    return (x >> U64(32)) * n_words >> U64(32), _masks(mix(x))


def build_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A filter (64-bit words) of the keys with their counts' levels."""
    levels = level(counts)
    n_words = max(1, int(levels.sum()) * BITS // 64 + 1)
    out = np.zeros(n_words, U64)
    j = 1
    while len(keys):
        at, mask = _entry(keys, j, U64(n_words))
        np.bitwise_or.at(out, at.astype(np.int64), mask)
        more = levels > j
        keys, levels = keys[more], levels[more]
        j += 1
    return out


def _filter(table: pa.Table) -> pa.Table:
    """The filter of a range, and its hot contexts with their followers in this range."""
    u = np.concatenate([np.repeat(_unpack40(c), _unpack(r, np.uint32)) for c, r in zip(table["contexts"].to_pylist(), table["runs"].to_pylist())])
    pair = np.concatenate([_unpack40(x) for x in table["pairs"].to_pylist()])
    count = np.concatenate([_unpack(x, np.uint32) for x in table["counts"].to_pylist()])
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    count = np.add.reduceat(count[order].astype(np.int64), first)
    contexts, followers = np.unique(u[order][first], return_counts=True)
    hot = contexts >= IS_HOT
    words_ = build_filter(np.concatenate([pair[first], mix(contexts[~hot] ^ _FOLLOWERS)]), np.concatenate([count, followers[~hot]]))
    hot_rows = [{"context": c, "followers": f} for c, f in zip((contexts[hot] & CONTEXT).tolist(), followers[hot].tolist())]
    return pa.table({
        "part": table["part"].slice(0, 1), "n_words": pa.array([len(words_)], pa.int64()), "words": pa.array([words_.tobytes()], pa.binary()),
        "hot": pa.array([hot_rows], pa.list_(pa.struct([("context", pa.int64()), ("followers", pa.int64())]))),
    })


class Filters:
    """The filters of a run of ranges, side by side, and the followers of all hot contexts."""

    def __init__(self, bits: int, first: int, parts: dict[int, bytes], hot: dict[int, int] | None = None):
        hot = hot or {}
        self.hot_contexts = np.array(sorted(hot), U64)
        self.hot_followers = np.array([hot[c] for c in sorted(hot)], float)
        self.bits, self.first, self.end = bits, first, first + max(parts, default=first) - first + 1
        arrays = [np.frombuffer(parts.get(p, b""), U64) for p in range(first, self.end)]
        self.sizes = np.array([len(a) for a in arrays], U64)
        self.starts = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])[:-1].astype(np.int64)
        self.words = np.concatenate([*arrays, np.zeros(1, U64)])

    def has(self, route: np.ndarray) -> np.ndarray:
        part = (route >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(route), np.int64)
        return (part >= self.first) & (part < self.end)

    def followers(self, context: np.ndarray) -> np.ndarray:
        """The numbers of distinct followers of hot contexts."""
        return self.hot_followers[np.searchsorted(self.hot_contexts, context & CONTEXT)]

    def count(self, route: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The counts of keys, as the levels that are found one after another have it."""
        part = ((route >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(route), np.int64)) - self.first
        size, start = self.sizes[part], self.starts[part]
        found = np.zeros(len(key), np.int64)
        todo = np.flatnonzero(size > 0)
        j = 1
        while len(todo) and j < len(LEVELS):
            at, mask = _entry(key[todo], j, size[todo])
            todo = todo[(self.words[start[todo] + at.astype(np.int64)] & mask) == mask]
            found[todo] = j
            j += 1
        return LEVELS[found]


def _with_counts(chunk: pa.Table, totals: pa.Table) -> pa.Table:
    """A chunk with the training counts of its distinct tokens in place of its own counts."""
    totals = totals.sort_by("part")
    count = [_pack(np.concatenate([_unpack(x, np.int64) for x in totals["total"].to_pylist()]))] if chunk.num_rows else []
    return chunk.set_column(chunk.schema.get_field_index("counts"), "counts", pa.array(count, pa.binary()))


def _score(kind: pa.DataType, n: int, v: int, limit: int, filters):
    """Scores chunks with a shard of the filter; the base too, if the shard is the first."""

    def one(chunk: dict) -> pa.RecordBatch:
        shard = filters.value
        count, keys, code = _unpack(chunk["counts"], np.int64), np.frombuffer(chunk["keys"], U64), _unpack(chunk["codes"], np.uint32)
        size, held = np.array(chunk["size"], np.int64), np.array(chunk["held"], bool)
        docs = np.repeat(np.arange(len(size)), size)
        logs = np.log10((count + ALPHA) / (n + ALPHA * (v + 1)))
        place = _context(code, keys, size)
        hot = count > limit
        mine = shard.has(keys) | hot
        here = np.flatnonzero(mine & ~hot)
        followers = np.zeros(len(keys))
        followers[here] = shard.count(keys[here], mix((keys[here] & CONTEXT) ^ _FOLLOWERS))
        followers[hot] = shard.followers(keys[hot])
        score = np.zeros(len(size))
        for at in range(0, len(code), PIECE):
            u = place[at : at + PIECE]
            some = mine[u]
            u, w, doc = u[some], code[at : at + PIECE][some], docs[at : at + PIECE][some]
            pair = _pair(keys[u], keys[w])
            to = _route(keys[u], pair, hot[u], shard.bits)
            some = shard.has(to)
            if not some.all():
                u, w, doc, pair, to = u[some], w[some], doc[some], pair[some], to[some]
            p, seen, f = 10.0 ** logs[w], count[u].astype(float), followers[u]
            c = np.minimum(shard.count(to, pair & NARROW), seen)
            total = np.maximum(seen, 1)
            rest = np.where(f > 0, np.minimum(1.0, DISCOUNT * f / total), 1.0)
            smooth = np.maximum(c - DISCOUNT, 0) / total + rest * p
            score += np.bincount(doc, np.log10(np.minimum(np.where(seen > 0, smooth, p), 1.0)), minlength=len(size))
        m = len(size)
        out = {"block": pa.array([chunk["block"]] * m, pa.int64()), "nth": pa.array(range(m), pa.int64()), "doc_id": chunk["docs"].cast(kind), "held_out": pa.array(held), "n_tokens": pa.array(size)}
        if shard.first == 0:
            out |= {"n_known": pa.array(np.bincount(docs, count[code] > 0, minlength=m).astype(np.int64)), "base_score": pa.array(np.bincount(docs, logs[code], minlength=m).astype(float))}
        else:
            out |= {"n_known": pa.array(np.zeros(m, np.int64)), "base_score": pa.array(np.zeros(m))}
        return pa.RecordBatch.from_pydict(out | {"score": pa.array(score)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield one({c: batch.column(c)[i].values if c == "docs" else batch.column(c)[i].as_py() for c in batch.schema.names})
        release()

    return run


def _bytes(setting: str) -> int:
    """A size as Spark's settings have it, MB without a unit; 0 if it is none."""
    m = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", setting.strip().lower())
    return int(m[1]) << {"k": 10, "": 20, "m": 20, "g": 30, "t": 40}[m[2]] if m else 0


def shard_bytes(get: Callable[[str, str], str]) -> int:
    """The bytes of a shard, from the cluster's settings; without a number of cores, or in a small cluster, FILTER_BYTES."""
    cores = get("spark.executor.cores", "")
    if not cores.isdigit() or not int(cores):
        return FILTER_BYTES
    core, driver = _bytes(get("spark.executor.memory", "1g")) / int(cores), _bytes(get("spark.driver.memory", "1g"))
    result = get("spark.driver.maxResultSize", "1g")
    most = math.inf if result == "0" else (int(result) if result.isdigit() else _bytes(result)) * OF_RESULT
    return max(FILTER_BYTES, int(min(core * OF_CORE, driver * OF_DRIVER, most)))


def score(docs: DataFrame, filter_bytes: int | None = None, range_pairs: int = RANGE) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of docs.

    filter_bytes: of a shard of the filter; the scores are the same with any.
    """
    spark = docs.sparkSession
    importable(spark)
    filter_bytes = filter_bytes or shard_bytes(spark.sparkContext.getConf().get)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", fold(F.col("doc_id"), FOLDS).alias("fold"), "text")
    chunks = stage(rows.mapInArrow(_tokenise(kind), f"block bigint, docs array<{id_type}>, held array<boolean>, size array<bigint>, keys binary, counts binary, codes binary"), "chunks")
    n_all = chunks.agg(F.sum(F.aggregate("size", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(1, n_all / range_pairs))))

    unigrams = chunks.select("block", "keys", "counts").mapInArrow(_unigrams(bits), "part int, block bigint, keys binary, counts binary")
    totals = stage(unigrams.groupBy("part").applyInArrow(_add_up, "block bigint, part int, total binary, n bigint, v bigint"), "totals")
    forget_shuffles(spark)
    facts = totals.agg(F.sum("n"), F.sum("v")).first()
    n, v = facts[0] or 0, facts[1] or 0
    limit = hot_over(n, range_pairs)

    shape = f"block bigint, docs array<{id_type}>, held array<boolean>, size array<bigint>, keys binary, counts binary, codes binary"
    counted = stage(chunks.groupBy("block").cogroup(totals.select("block", "part", "total").groupBy("block")).applyInArrow(_with_counts, shape), "counted")
    unstage(chunks)

    pairs = counted.select("held", "size", "keys", "counts", "codes").mapInArrow(_pairs(bits, limit), "part int, contexts binary, runs binary, pairs binary, counts binary")
    filters = stage(pairs.groupBy("part").applyInArrow(_filter, "part int, n_words bigint, words binary, hot array<struct<context:bigint,followers:bigint>>"), "filters")
    forget_shuffles(spark)
    sizes = {r["part"]: 8 * r["n_words"] for r in filters.select("part", "n_words").collect()}
    hot = dict(filters.select(F.inline("hot")).groupBy("context").agg(F.sum("followers")).collect())  # fewer than HOT rows
    shards, at = [], 0
    while at < 1 << bits:
        end, total = at, 0
        while end < 1 << bits and (end == at or total + sizes.get(end, 0) <= filter_bytes):
            total += sizes.get(end, 0)
            end += 1
        shards.append((at, end))
        at = end
    out = None
    fields = f"block bigint, nth bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    for first, end in shards:
        got = filters.filter(F.col("part").between(first, end - 1)).select("part", "words").toArrow()
        shard = Filters(bits, first, dict(zip(got["part"].to_pylist(), got["words"].to_pylist())) | ({end - 1: b""} if end - 1 not in got["part"].to_pylist() else {}), hot)
        del got
        value = spark.sparkContext.broadcast(shard)
        part = stage(counted.mapInArrow(_score(kind, n, v, limit, value), fields), "scores")
        value.destroy()
        del shard
        out = part if out is None else out.unionByName(part)
    if len(shards) > 1:
        out = out.groupBy("block", "nth").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.first("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
