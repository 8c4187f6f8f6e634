"""The manifest against a tree built in plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree string, i string, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def climb(digests):
    """The root of digests, and for each its way up: the digest beside (None if alone) and its side."""
    ways = [[] for _ in digests]
    level, under = list(digests), [[k] for k in range(len(digests))]
    while len(level) > 1:
        for k in range(len(level)):
            other = level[k ^ 1] if k ^ 1 < len(level) else None
            for leaf in under[k]:
                ways[leaf].append((other, k % 2 == 1))
        level = [H(*level[k : k + 2]) for k in range(0, len(level), 2)]
        under = [sum(under[k : k + 2], []) for k in range(0, len(under), 2)]
    return level[0], ways


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in order:
        leaves = sorted((r[0] is not None, r[0] or 0, digest(r)) for r in groups[g])
        built.append((leaves, *climb([d for *_, d in leaves])))
    root, tops = climb([b[1] for b in built])
    found = Counter()
    for (leaves, subroot, ways), top in zip(built, tops):
        for (has, i, leaf), way in zip(leaves, ways):
            found[(i if has else None, leaf, subroot, root, tuple(way + top))] += 1
    return found


def some_rows(seed, n, langs, repeat=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(langs)
        row = (rng.choice([i, i, i, None, 3]), rng.choice(["s", "", None]), lang, rng.choice([i, None]), rng.choice([f"é{i}", None, ""]), "t", "i", "p")
        rows += [row] * rng.choice([1, repeat])
    return rows


CASES = {
    "mixed": some_rows(1, 700, ["en"] * 20 + ["de", "é", "Z", None, ""], repeat=3),
    "one group": some_rows(2, 300, ["en"]),
    "chunk exactly": some_rows(3, merkle.CHUNK, ["en"]) + some_rows(4, merkle.CHUNK + 1, ["fr"]),
    "every group alone": [(i, "s", f"l{i}", i, "x", "t", "i", "p") for i in range(40)],
    "one row": [(None, None, None, None, None, None, None, None)],
    "all equal": [(7, "s", "en", 1, "x", "t", "i", "p")] * 900,
}


@pytest.mark.parametrize("case", CASES)
def test_manifest_equals_plain_one(spark, case):
    rows = CASES[case]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    tampers = F.col("doc_id") % 3 == 0
    fields = [F.col(f) if f != "n_chars" else F.col(f) + 1 for f in merkle.FIELDS]
    found = merkle.merkle_manifest(docs, presented=F.when(tampers, merkle.row_digest(*fields))).collect()
    ways = Counter(
        (r.doc_id, r.leaf, r.subroot, r.root, tuple((p.digest and p.digest.hex(), p.left) for p in r.proof)) for r in found
    )
    assert ways == plain_manifest(rows)
    changed = {digest(r) for r in rows if r[0] is not None and r[0] % 3 == 0 and r[3] is not None}
    for r in found:
        assert r.verified == (r.folded_root == r.root)
        assert r.verified == (r.leaf not in changed)


def test_empty_table(spark):
    assert merkle.merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
