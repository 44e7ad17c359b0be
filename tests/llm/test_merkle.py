"""The Merkle manifest against plain Python on trees of every shape."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortguard.llm.merkle import digest_of, merkle_manifest, proof_digest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """Root and, for each leaf, the (before, after) steps to it."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(own):
            run = nodes[at // fanout * fanout:(at // fanout + 1) * fanout]
            paths[leaf].append(("".join(run[:at % fanout]), "".join(run[at % fanout + 1:])))
        nodes = [h("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        own = [at // fanout for at in own]
    return nodes[0], paths


def brute(rows, fanout=16):
    """(id, leaf, subroot, root, proof digest, folded root) of every row."""
    groups = {}
    for r in rows:
        row = dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r))
        leaf = h("".join(field(row[c]) for c in COLUMNS))
        row["text"] = row["text"] and row["text"].replace("A", "a")
        groups.setdefault(row["source"], []).append((row["doc_id"], leaf, h("".join(field(row[c]) for c in COLUMNS))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0], x[1]))
        trees[g] = tree([x[1] for x in groups[g]], fanout)
    root, above = tree([trees[g][0] for g in order], 16)
    out = []
    for k, g in enumerate(order):
        for (i, leaf, seen), path in zip(groups[g], trees[g][1]):
            steps, now = path + above[k], seen
            for before, after in steps:
                now = h(before + now + after)
            out.append((i, leaf, trees[g][0], root, h("".join(a + b for a, b in steps)), now, now == root))
    return out


def run(df, **options):
    seen = digest_of(*[F.translate("text", "A", "a") if c == "text" else F.col(c) for c in COLUMNS])
    found = merkle_manifest(df, observed=seen, **options)
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), "folded_root", "verified")


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def documents_of(sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i = (i * 7 + 3) % 1009
            rows.append((i, f"t{i}A" if i % 3 else f"é {i}", "en", source, i))
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, "b": 1, None: 3}, {"a": 300, "é": 256, "": 2, "z": 1}])
def test_trees_of_every_height(spark, sizes):
    rows = documents_of(sizes)
    same(run(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), brute(rows))


def test_more_groups_than_one_run(spark):
    rows = documents_of({f"s{k:03}": 1 + k % 3 for k in range(40)})
    same(run(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, "A", None, None, 1), (1, "", "", "s", 0), (1, "A", "", "s", 0),
            (1, "A", "", "s", 0), (1, None, "", "s", None), (2, "A" * 300_000, "en", "s", 300_000)]
    same(run(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows))


def test_small_fanout(spark):
    rows = documents_of({"a": 9, "b": 4})
    same(run(spark.createDataFrame(rows, SCHEMA), fanout=2).collect(), brute(rows, fanout=2))


def test_clashing_columns_and_no_rows(spark, documents):
    names = ("tree", "pos", "n", "node", "_spot", "_part", "path", "root", "leaf", "digest", "s0", "parent", "observed")
    plain = documents(["x", "A", None])
    clash = plain.select("*", *[F.col("doc_id").alias(c) for c in names])
    same(run(clash).collect(), [tuple(r) for r in run(plain).collect()])
    assert run(documents([])).count() == 0


def test_untouched_rows_verify(documents):
    assert all(r.verified for r in merkle_manifest(documents([f"t{i}" for i in range(40)])).collect())
