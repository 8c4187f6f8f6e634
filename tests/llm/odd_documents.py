"""Documents with every odd case, and columns named like those that operators use inside."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
        # Names that the operators use inside.
        T.StructField("h", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("block", T.StringType()),
    ]
)


def rows(pairs):
    """Documents with odd further columns; ``pairs`` holds ids, texts and sources."""
    langs = {"s0": "en", "s1": None, "s2": "de"}
    return [(i, t, s, langs.get(s, s), None if t is None else len(t), "h", None, "9", "x", "no", None, "b") for i, t, s in pairs]


def odd_texts(seed=5, n=120):
    """Ids, texts and sources with every odd case: nulls, empties, copies, near copies, one long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    found = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        if i % 5 == 0:
            text = f"{text} {passage} {rng.choice(words)}"
        if i % 7 == 0:
            text = text.replace(" ", "\n\t", 3)
        found.append((i, text, f"s{i % 4}"))
    found += [(200 + i, found[3][1], "s1") for i in range(20)]  # exact copies
    found += [(230 + i, found[10][1] + f" {words[i]}", "s0") for i in range(10)]  # near copies
    found += [(250, None, "s1"), (251, "", None), (252, " \t\n", "s2"), (None, "null id here", None)]
    found += [(260, "wörter mit ümlauten – und 漢字 " * 9, "s3"), (261, "ab" * 400, "s3"), (262, "#| x\n#| x\n" * 30, "s1")]
    found += [(263, " ".join(rng.choice(words) for _ in range(30000)), "s2")]
    found += [(264, "twice", "s1"), (264, "twice", "s1"), (265, "one id", "s1"), (265, "another text", "s1")]
    return found
