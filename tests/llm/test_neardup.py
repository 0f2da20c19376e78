import re
from collections import Counter, defaultdict

import pytest
from made import got, prose

from tidewire.llm import neardup as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    w = WORD.findall(text.translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Each row's class, as the smallest id in it; null texts are alone."""
    texts = {t: runs(t) for _, t, *_ in rows if t is not None}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    by_run = defaultdict(list)
    for t, s in texts.items():
        common = Counter(o for r in s for o in by_run[r])
        for o, n in common.items():
            if n >= 0.8 * (len(s) + len(texts[o]) - n):
                root[find(t)] = find(o)
        for r in s:
            by_run[r].append(t)
    first, size = {}, Counter()
    for doc, t, *_ in rows:
        if t is not None:
            c = find(t)
            size[c] += 1
            first[c] = min((x for x in (first.get(c), doc) if x is not None), default=None)
    return sorted(((doc, doc, 1) if t is None else (doc, first[find(t)], size[find(t)]) for doc, t, *_ in rows), key=repr)


def test_against_brute_force(docs, rows):
    want = brute(rows)
    assert sum(n > 1 for _, _, n in want) > 20
    assert got(op.classes(docs), "doc_id", "class_id", "class_size") == want


def test_hot_keys(docs, rows, monkeypatch):
    """Every join on a key with a share of the rows deals them to many tasks; the result stays."""
    from tidewire.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 2)
    monkeypatch.setattr(common, "HOT_SHARE", 1000)
    assert got(op.classes(docs), "doc_id", "class_id", "class_size") == brute(rows)
    test_keep_one(docs, rows)


def test_1500_pairs_on_a_template(spark):
    """1,500 pairs on one template: 0.802 alike in a pair, 0.786 across. At least 99 % are found, and nothing else is linked."""
    import random

    rng = random.Random(11)
    base = prose(rng, 204).split(" ")
    texts = [" ".join(base[:90] + [f"pair{i // 2}x{k}" if k < 2 else f"own{i}x{k}" for k in range(20)] + base[110:]) for i in range(3000)]
    alike = lambda i, j: len(runs(texts[i]) & runs(texts[j])) / len(runs(texts[i]) | runs(texts[j]))
    assert all(alike(i, i + 1) >= 0.8 > alike(i, i + 2) for i in range(0, 100, 2))
    found = Counter(r.class_id for r in op.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect())
    assert set(found.values()) <= {1, 2} and all(c % 2 == 0 for c, n in found.items() if n == 2)
    assert sum(n == 2 for n in found.values()) >= 0.99 * 1500


@pytest.mark.parametrize("seed", [1, 2])
def test_large_group_around_one_text(spark, seed):
    """Copies that are like the text they come from, but mostly not like each other; more than a bucket's hubs cover."""
    import random

    rng = random.Random(seed)
    base = prose(rng, 160).split(" ")
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        t = list(base)
        for at in rng.sample(range(160), 3):
            t[at] = f"other{i}x{at}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, prose(rng, 80)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(op.classes(df), "doc_id", "class_id", "class_size") == brute(rows)


@pytest.mark.parametrize("block", [16, None])
def test_pairs_on_a_template(spark, monkeypatch, block):
    """Texts on one template, 0.786 like each other, with a pair at 0.802 for each; a bucket's hubs are in few of them."""
    import random

    if block:
        monkeypatch.setattr(op, "BLOCK", block)
    rng = random.Random(5)
    base = prose(rng, 204).split(" ")
    rows = []
    for i in range(240):
        slot = [f"pair{i // 2}x{k}" if k < 2 else f"own{i}x{k}" for k in range(20)]
        rows.append((i, " ".join(base[:90] + slot + base[110:])))
    want = brute(rows)
    assert [n for _, _, n in want] == [2] * 240
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(op.classes(df), "doc_id", "class_id", "class_size") == want


def test_components(spark):
    import random

    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(200, 200 + i) for i in range(1, 90)]
    ring = [(400 + i, 400 + (i + 1) % 30) for i in range(30)]
    links = chain + star + ring + star[:5]
    rng.shuffle(links)
    label = {r.text: r.root for r in op.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for lo, n in ((0, 61), (200, 90), (400, 30)):
        assert len({label[i] for i in range(lo, lo + n)}) == 1
    assert len(set(label.values())) == 3
    assert op.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_no_documents(no_docs, spark):
    assert op.classes(no_docs).collect() == [] and op.keep_one(no_docs).collect() == []
    one = spark.createDataFrame([(1, None, None, None, None)], no_docs.schema)
    assert got(op.classes(one), "doc_id", "class_id", "class_size") == [(1, 1, 1)]


def test_keep_one(docs, rows):
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    found = got(kept, "doc_id", "text")
    want = brute(rows)
    nulls = sum(t is None for _, t, *_ in rows)
    by_class = {c for (d, c, n), in zip(want)}
    assert len([r for r in found if r[1] is None]) == nulls
    classes = {(r[0], r[1]) for r in got(op.classes(docs.filter("text IS NOT NULL")), "class_id", "class_size")}
    assert len([r for r in found if r[1] is not None]) == len(classes) and {r[0] for r in found} <= by_class
    assert got(op.classes(kept.select("doc_id", "text")), "class_size") == [(1,)] * len(found)
