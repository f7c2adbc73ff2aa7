import hashlib
import random
import zlib

import numpy as np
import pytest

from inkwell.llm import merkle
from inkwell.llm.queries import op12
from tests.llm.helpers import documents, save


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def slow_tree(leaves):
    """The root, and for each leaf its steps: siblings before and behind."""
    paths, where, row = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(row) > 1:
        for k, at in enumerate(where):
            run = row[at // 2 * 2:at // 2 * 2 + 2]
            paths[k].append((run[:at % 2], run[at % 2 + 1:]))
            where[k] = at // 2
        row = [sha(*row[i:i + 2]) for i in range(0, len(row), 2)]
    return row[0], paths


def slow(rows):
    """rows of documents as tuples (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs.append((own, *slow_tree([leaf(r) for r in own])))
    root, above = slow_tree([s[1] for s in subs])
    out = []
    for (own, subroot, paths), top in zip(subs, above):
        for r, path in zip(own, paths):
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for before, behind in path + top:
                at = sha(*before, at, *behind)
            proof = sha(*[d for before, behind in path + top for d in before + behind])
            out.append((r[0], leaf(r), subroot, root, proof, at, at == root))
    return sorted(out, key=str)


def rows_of(n, langs, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *range(n)]) if rnd.random() < 0.05 else k, rnd.choice(["", "é" * k, None, "a:b", "x" * 50]),
             rnd.choice(langs), rnd.choice(["s", None])) for k in range(n)]
    return rows + rows[:3]


def table_of(spark, rows):
    return documents(spark, rows, leaf="x", tree="y", at="z", claimed="c")


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (5, ["en", None]), (130, ["en", "en", "de", None, "Z", "é", ""])])
@pytest.mark.parametrize("height", [2, 10])
def test_against_brute_force(spark, n, langs, height):
    docs = table_of(spark, rows_of(n, langs))
    expected = slow([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])
    found = merkle.proofs(merkle.build(merkle.document_leaves(docs), ["doc_id"], height))
    assert sorted([tuple(r) for r in found.collect()], key=str) == expected


def test_query(spark, tmp_path):
    docs = table_of(spark, rows_of(60, ["en", "de"]))
    got = op12(spark, save(spark, tmp_path, documents=docs))
    assert sorted([tuple(r) for r in got.collect()], key=str) == slow([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])
    assert 0 < sum(not r["verified"] for r in got.collect()) < 20


def test_one_group_over_many_partitions(spark):
    docs = table_of(spark, [(k, f"text {k % 7}", "en") for k in range(500)] + [(5, "text 5", "en")] * 100)
    leaves = merkle.document_leaves(docs)
    places = [r["at"] for r in merkle.numbered(leaves, ["doc_id"]).orderBy("at").select("at").collect()]
    assert places == list(range(600))
    found = merkle.proofs(merkle.build(leaves, ["doc_id"], 4))
    assert sorted([tuple(r) for r in found.collect()], key=str) == slow([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_recursive_halves(levels):
    places = np.concatenate([merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)])
    assert sorted(places) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        inside = np.concatenate([merkle.address(levels, d, np.arange(1 << d)) for d in range(top)])
        assert sorted(inside) == list(range((1 << top) - 1))
        first = np.concatenate([merkle.address(levels, d, np.arange(1 << (d - top))) for d in range(top, levels)])
        assert sorted(first) == list(range((1 << top) - 1, (1 << top) + (1 << (levels - top)) - 2))


def test_empty_table(spark):
    docs = table_of(spark, rows_of(3, ["en"])).limit(0)
    assert merkle.proofs(merkle.build(merkle.document_leaves(docs), ["doc_id"])).count() == 0
