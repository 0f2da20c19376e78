"""Made documents and small helpers for the corpus operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, as extra columns of the inputs.
CLASHES = ["h", "key", "size", "shard", "part", "score", "fold", "x", "row", "nth", "a", "b", "bucket", "n_words", "words", "w", "d", "k", "term", "pos", "doc", "class_id", "n", "id", "label", "before", "length", "start"]


def word(rng):
    return "".join(rng.choices(["ba", "ko", "ri", "tes", "mun", "é", "Al", "ve"], k=rng.randint(1, 3)))


def prose(rng, n):
    out = [word(rng) for _ in range(n)]
    for i in range(6, n, 7):
        out[i] += rng.choice([".", ",", ".\n", "!", " -"])
    return " ".join(out)


def corpus(seed=1, n=60):
    """Documents with copies, near copies, nulls, empty and long texts, shared passages and repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(n)]
    passage = prose(rng, 40)
    texts += [texts[0]] * 5 + [t + " " + passage for t in texts[1:6]]
    base = prose(rng, 200).split(" ")
    for i in range(12):
        t = list(base)
        for _ in range(i % 4):
            t[rng.randrange(len(t))] = word(rng)
        texts.append(" ".join(t))
    texts += [None, None, "", "", " \n\t", "...", "A", "a", "two words", prose(rng, 30_000), "mit license", "The MIT License. Apache\nLicense; GNU general, PUBLIC license"]
    rows = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[2], None, None, None), (None, "no id here", None, None, None), (None, None, None, None, None)]
    return rows


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
