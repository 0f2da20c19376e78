import random
import re
import time

import pytest
from made import got

from tidewire.llm import licenses as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    out = []
    for doc, text, *_ in rows:
        w = WORD.findall((text or "").translate(LOWER))
        places = [(i, label) for i in range(len(w)) for p, label in op.PHRASES if w[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        out.append((doc, len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    return sorted(out, key=repr)


def test_base(docs, rows, spark):
    more = [(9000 + i, t, None, None, None) for i, t in enumerate(["MIT License mit  license, the mit-license", "the apache\n license apache  licensed", "general public licenses; general public license general public", "mit", "license mit", "xmit license", "é mit license é" * 50])]
    assert got(op.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == brute(rows)
    found = op.scan(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    assert got(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == brute(more)
    for r in [*found.collect(), *op.scan(docs).collect()]:
        labels = r.labels.split(",") if r.labels else []
        assert set(r.base_labels.split(",")) - {""} <= set(labels) and labels == sorted(set(labels)) and 0 <= r.score <= 1 and bool(labels) == (r.score > 0)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: GPL-2.0-only", {"gpl-2.0"}), ("released under the MIT License.", {"mit"}), ("Licensed under the Apache License, Version 2.0 (the License)", {"apache-2.0"}),
        ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}), ("https://www.apache.org/licenses/LICENSE-2.0.txt", {"apache-2.0"}), ("Redistribution and use in source and binary forms", {"bsd"}), ("free software of no license at all", set()),
        ("CC BY-NC-SA 4.0", {"cc-by-nc-sa"}), ("Mozilla Public\n License 2.0", {"mpl-2.0"}), ("", set()),
    ],
)
def test_labels(text, labels):
    assert {r.label for _, _, r in op.detections(text.translate(LOWER))} == labels


def test_rules():
    every = op.rules()
    assert len(every) >= 300 and all(r.keyword for r in every) and [r.priority for r in every] == sorted(r.priority for r in every)


def plainly(text):
    """Labels and spans by all rules over the whole text, without keywords, and with all detections compared in pairs."""
    text = re.sub(r"\s+", " ", text.translate(LOWER))
    found = [(r.priority, m.start() - m.end(), m.start(), nth, r) for nth, r in enumerate(op.rules()) for m in r.regex.finditer(text) if m.end() > m.start()]
    found.sort(key=lambda x: x[:4])
    kept = []
    for _, size, start, _, rule in found:
        if not any(a <= start and b >= start - size for a, b, _ in kept):
            kept.append((start, start - size, rule))
    return kept


PIECES = [
    "MIT License", "Apache License, Version 2.0", "GNU General Public License v3", "SPDX-License-Identifier: BSD-3-Clause", "https://opensource.org/licenses/MIT", "Mozilla Public License 2.0", "mpl 2.0", "permission is hereby granted, free of charge, to any person obtaining",
    "Licensed under the terms of the Eclipse Public License", "creative commons attribution share-alike", "All Rights Reserved", "redistribution and use in source\n and binary forms", "http://www.gnu.org/licenses/gpl-3.0.html", "public domain", "ISC licence", "zlib/libpng license", "cc0 1.0", "by-nc-sa",
    "neither the name of the copyright holder nor the names of its contributors", "released under the GNU Lesser General Public License version 2.1", "spdx-license-identifier:\tgpl-2.0-or-later", "www.opensource.org/licenses/bsd-3-clause.", "do what the fuck you want to public license", "apache - 2 license", "gpl-v3", "license", "general", "under the", "https://", "opensource.org/license", "opensource", "word",
]


def test_against_all_rules_plainly():
    rng = random.Random(3)
    for n in [1, 2, 3, 8, 30, 120] * 25:
        text = "".join(rng.choice(PIECES) + rng.choice([" ", "\n", "", ". ", "  ", "-", "\u00a0"]) for _ in range(n))
        assert op.detections(text.translate(LOWER)) == plainly(text)


def test_labels_and_scores(spark, docs, rows):
    rng = random.Random(8)
    more = [(5000 + i, " ".join(rng.choices(PIECES, k=rng.randint(1, 40)))) for i in range(60)] + [(None, "MIT license"), (1, None)]
    for df, table in ((docs, [r[:2] for r in rows]), (spark.createDataFrame(more, "doc_id long, text string"), more)):
        want = []
        for (doc, text), base in zip(sorted(table, key=lambda r: repr(r[0])), sorted(brute(table), key=lambda r: repr(r[0]))):
            kept = plainly(text or "")
            own = {label for phrase, label in op.PHRASES for w in [" ".join(WORD.findall((text or "").translate(LOWER)))] if f" {phrase} " in f" {w} "}
            want.append((doc, ",".join(sorted(own | {r.label for _, _, r in kept})), max([0.9 if own else 0.0] + [r.confidence for _, _, r in kept])))
        assert got(op.scan(df), "doc_id", "labels", "score") == sorted(want, key=repr)


def test_long_dense_text():
    """Time grows with the text, not with its square."""
    rng = random.Random(1)
    text = " ".join(rng.choices(PIECES[:20], k=40_000)).translate(LOWER)
    took = []
    for part in (text[: len(text) // 4], text):
        start = time.process_time()
        found = op.detections(part)
        took.append(time.process_time() - start)
    assert len(found) > 30_000 and took[1] < 8 * took[0] + 1


def test_contained_spans_are_suppressed():
    found = op.detections("licensed under the apache license, version 2.0")
    assert [(r.label, a) for a, _, r in found] == [("apache-2.0", 0)]
    spans = [(a, b) for a, b, _ in op.detections("gnu general public license version 2 and the mit license, mit license")]
    assert not any(x != y and x[0] >= y[0] and x[1] <= y[1] for x in spans for y in spans)


def test_no_documents(no_docs):
    assert op.scan(no_docs).collect() == []
