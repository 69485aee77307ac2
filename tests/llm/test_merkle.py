"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_of(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """The node that remains, and for every first node the runs it passes through with its place in them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for p, i in zip(paths, at):
            p.append((runs[i // 16], i % 16))
        at, nodes = [i // 16 for i in at], [H(*r) for r in runs]
    return nodes[0], paths


def brute(rows):
    first = lambda v: (v is not None, v)
    by_source = {}
    for i, text, lang, source, n in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        leaf = leaf_of(i, source, lang, n, text)
        got = leaf_of(i, source, lang, n, text.translate(LOWER) if text is not None else None) if hit else leaf
        by_source.setdefault(source, []).append((first(i), leaf, got, i))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([leaf for _, leaf, _, _ in sorted(by_source[s])]) for s in sources]
    root, above = climb([t[0] for t in trees])
    out = []
    for s, (subroot, paths), top in zip(sources, trees, above):
        for (_, leaf, got, i), path in zip(sorted(by_source[s]), paths):
            proof, cur = [], got
            for run, at in [*path, *top]:
                proof += run[:at] + run[at + 1:]
                cur = H(*run[:at], cur, *run[at + 1:])
            out.append((i, leaf, subroot, root, H(*proof), cur, cur == root))
    return Counter(out)


def check(spark, docs, rows):
    from ferrolake.llm.merkle import merkle_report
    got = merkle_report(spark, docs)
    assert got.columns == COLUMNS
    want = brute(rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    return want


def test_edges(spark, edge_docs, edges, no_docs):
    check(spark, edge_docs, [e[:5] for e in edges])
    from ferrolake.llm.merkle import merkle_report
    assert merkle_report(spark, no_docs).collect() == []


def test_several_levels(spark):
    """A source that holds most rows, and more sources than one run of the upper tree."""
    rows = [(i, f"Text {i} Ünï", "en", "hot" if i % 3 else f"s{i % 60}", i) for i in range(700)]
    rows += [(1000, "ALONE", None, None, None)]
    want = check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5), rows)
    assert 50 < sum(not r[-1] for r in want) < 250
    check(spark, spark.createDataFrame(rows[-1:], "doc_id long, text string, lang string, source string, n_chars long"), rows[-1:])


def test_a_moved_or_changed_leaf_is_found(spark):
    from pyspark.sql import functions as F

    from ferrolake.llm.merkle import folded, leaf_hash, manifest
    docs = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 2}", 1) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    m = manifest(spark, docs, F.when(F.col("doc_id") == 7, leaf_hash(text=F.lit("t8"))))
    bad = m.where(folded(F.coalesce("candidate", "leaf"), F.col("above")) != F.col("root"))
    assert [r.doc_id for r in bad.collect()] == [7]


def test_nodes_are_hashes_of_bare_digests(spark):
    """The contract's figures for 17 leaves of one source and one of another, written out."""
    from ferrolake.llm.merkle import merkle_report
    rows = [(i, f"T{i}", None, "a", 2) for i in range(17)] + [(99, None, "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    leaves = [sha(f"{len(str(i))}:{i}1:a-1:2{len(t)}:{t}") for i, t, _, s, _ in rows if s]
    alone = sha("2:99-2:en--")
    first, last = sha("".join(leaves[:16])), sha(leaves[16])
    subroot = sha(first + last)
    root = sha(alone + subroot)
    got = {r.doc_id: r for r in merkle_report(spark, docs).collect()}
    assert {r.root for r in got.values()} == {root}
    assert (got[99].leaf, got[99].subroot, got[99].proof_sha256) == (alone, alone, sha(subroot))
    assert (got[16].leaf, got[16].subroot, got[16].proof_sha256) == (leaves[16], subroot, sha(first + alone))
    assert got[3].proof_sha256 == sha("".join(leaves[:3] + leaves[4:16]) + last + alone)
