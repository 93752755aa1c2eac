"""The manifest against a plain Merkle tree in memory."""

import hashlib
import zlib

from airlens.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, more=0):
    fields = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """The root and for each leaf its siblings, lowest first, with the side they are on."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            if p ^ 1 < len(nodes):
                proofs[i].append((p & 1, nodes[p ^ 1]))
            else:
                proofs[i].append(None)
            at[i] = p >> 1
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {}
    for lang in langs:
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        parts[lang] = (mine, *tree([leaf(r) for r in mine]))
    root, tops = tree([parts[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        mine, sub, proofs = parts[lang]
        for r, proof in zip(mine, proofs):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            h = leaf(r, 1 if hit else 0)
            for step in [*proof, *top]:
                h = sha(h if step is None else step[1] + h if step[0] else h + step[1])
            out.append((r["doc_id"], leaf(r), sub, root, sha("".join(s[1] for s in [*proof, *top] if s)), h, h == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_hard_rows(spark, hard):
    assert got(merkle.manifest(hard)) == brute([r.asDict() for r in hard.collect()])


def test_nothing(spark, nothing):
    assert merkle.manifest(nothing).collect() == []


def test_a_lone_leaf_is_the_root(spark):
    docs = spark.createDataFrame([(5, "s", None, 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    (row,) = merkle.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


def test_several_pages_and_many_trees(spark, monkeypatch):
    """Pages of 4 leaves: several tiers of pages in a tree, and in the tree of subroots."""
    monkeypatch.setattr(merkle, "PAGE_LEVELS", 2)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("shiftright(c.pos, 8)", "shiftright(c.pos, 2)").replace("& 255", "& 3"))
    rows = [(i, "s", None if i % 31 == 3 else f"l{i % 23}" if i % 3 else "hot", i, f"t{i}") for i in range(301)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(merkle.manifest(docs)) == brute([r.asDict() for r in docs.collect()])
