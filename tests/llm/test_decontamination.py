import hashlib
import re

import pytest
from made import got

from tidewire.llm import decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, slop=1):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(8, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    sizes = {len(w) for w in windows}
    out = []
    for doc, text, *_ in rows:
        w, hit, found, at = words(text), set(), set(), {}
        for i, x in enumerate(w):
            at.setdefault(x, set()).add(i)
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= owners
        near = set()
        for phrase, owners in windows.items():
            # starts around the places of its rarest word: every near match has its word there
            rare = min(range(len(phrase)), key=lambda i: len(at.get(phrase[i], ())))
            for start in {p - rare + d for p in at.get(phrase[rare], ()) for d in range(-slop, slop + 1)}:
                if all(set(range(start + i - slop, start + i + slop + 1)) & at.get(x, set()) for i, x in enumerate(phrase)):
                    near |= owners
                    break
        sha = lambda x: hashlib.sha256(",".join(sorted(x)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha(found), len(found) >= 2, len(near), sha(near)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near", "near_sha256")


@pytest.fixture(scope="module")
def edited(rows, benchmark_rows):
    """Documents that hold items with a word put in, left out or two words swapped."""
    out = []
    for i, (_, text) in enumerate(x for x in benchmark_rows if x[1] and len(words(x[1])) >= 10):
        w = words(text)[:8]
        changed = [w[:4] + ["xx"] + w[4:], w[:3] + w[4:], [w[1], w[0], *w[2:]], w[:4] + ["xx", "yy", "zz"] + w[4:], w[::-1]]
        out += [(1000 + 10 * i + j, "so " + " ".join(x) + " it was") for j, x in enumerate(changed)]
    return out


@pytest.mark.parametrize("most", [op.MAX_TERMS, 0])
@pytest.mark.parametrize("slop", [1, 3])
def test_against_brute_force(docs, items, rows, benchmark_rows, edited, spark, slop, most):
    both = [r[:2] for r in rows] + edited
    want = brute(both, benchmark_rows, slop)
    assert sum(r[5] for r in want) >= 3 and sum(r[2] > 0 for r in want) > 8 and sum(r[6] > r[3] for r in want) >= 5
    more = docs.unionByName(spark.createDataFrame(edited, "doc_id long, text string"), allowMissingColumns=True)
    assert got(op.contamination(more, items, slop=slop, max_terms=most), *COLUMNS) == want


def test_empty_tables(docs, no_docs, items, spark, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(op.contamination(no_docs, items), *COLUMNS) == []
    assert got(op.contamination(docs, none), *COLUMNS) == brute(rows, [])


def test_clean_keeps_columns(docs, items, rows, benchmark_rows):
    """Whole windows of one item are enough to go; an item of a few words isn't."""
    whole = [x for x in benchmark_rows if len(words(x[1])) >= 8 and x[0] is not None]
    bad = lambda r: brute([r], whole)[0][3] >= 1 or brute([r], benchmark_rows)[0][3] >= 2
    good = [(r[0], r[1]) for r in rows if not bad(r)]
    assert 0 < len(good) < len(rows) and "two words" in [t for _, t in good]
    assert sum(brute([r], whole)[0][3] == 1 for r in rows) >= 1
    kept = op.clean(docs, items)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id", "text") == sorted(good, key=repr)


def test_one_passage_of_one_item(spark):
    """A single planted passage makes a document go, wherever it stands; seven of its words don't."""
    item = "the keeper of the northern light wrote down what every passing ship had carried that year".split()
    prose = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(prose)), (1, " ".join(prose[:200] + item[2:10] + prose[200:])), (2, " ".join(prose[:100] + item[2:9] + prose[100:])), (3, " ".join(item).upper()), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = op.clean(docs, spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 5]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one x two y three"), (3, "three two one"), (4, "one a b c d e f g two three"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "One, two, three")], "item_id long, text string")
    near = lambda slop: {r.doc_id for r in op.contamination(docs, items, slop=slop).filter("n_near > 0").collect()}
    assert [near(s) for s in (0, 1, 2, 4)] == [{1}, {1, 2}, {1, 2, 3}, {1, 2, 3, 4}]
    assert {r.doc_id for r in op.contamination(docs, items).filter("n_hit > 0").collect()} == {1}
