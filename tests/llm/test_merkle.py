import hashlib
import zlib
from collections import defaultdict

from tests.llm.samples import awkward, documents, words
from tidedesk.llm.merkle import merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*[field(row[c]) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def small(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(digests):
    """The root and, for every leaf, the (left, right) siblings from the leaf upward."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, p in enumerate(at):
            run = p // 16 * 16
            paths[k].append(("".join(digests[run:p]), "".join(digests[p + 1 : run + 16])))
        digests, at = [h(*digests[i : i + 16]) for i in range(0, len(digests), 16)], [p // 16 for p in at]
    return digests[0], paths


def manifest(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in by_source[s]]))
    root, trunk = tree([r for r, _ in trees])
    out = []
    for s, (subroot, paths), upper in zip(sources, trees, trunk):
        for (_, _, own, r), path in zip(by_source[s], paths):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            folded = leaf(r, small(r["text"])) if tampered else own
            for left, right in path + upper:
                folded = h(left, folded, right)
            proof = h(*[left + right for left, right in path + upper])
            out.append((r["doc_id"], own, subroot, root, proof, folded, folded == root))
    return out


def check(docs):
    got = [tuple(r) for r in merkle_manifest(docs).collect()]
    expected = manifest([r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert sorted(got, key=str) == sorted(expected, key=str)
    return got


def test_trees_of_every_shape(spark):
    rows = []
    for source, n in (("one", 1), ("run", 16), ("ragged", 17), ("deep", 275), ("Äö", 33), ("two", 2)):
        rows += [(len(rows) * 7 % 5003, f"Text {source} {k} " + words(k, 3), "en", source) for k in range(n)]
    got = check(documents(spark, rows))
    assert {r[-1] for r in got} == {True, False}


def test_many_sources(spark):
    check(documents(spark, [(n, f"T{n}", "en", f"host{n % 40}") for n in range(300)]))


def test_a_single_leaf(spark):
    (row,) = check(documents(spark, [(3, "Only one")]))
    assert row[1] == row[2] == row[3]


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark).withColumnsRenamed({"row": "rank", "grp": "place", "fp": "digest", "block": "tree", "seed": "path"})
    assert len(check(docs)) == docs.count()
    assert merkle_manifest(documents(spark, [])).count() == 0
