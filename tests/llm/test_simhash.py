import random
import re

import pytest
import xxhash

from inkwell.llm import simhash
from inkwell.llm.queries import op3
from tests.llm.helpers import documents, save


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, distance):
    """{row: smallest row reachable}, by brute force over all pairs."""
    comp = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= distance and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return comp


def texts(n=160):
    rnd = random.Random(5)
    vocabulary = ["Aa", "bÉ", "Ünd", "cat x", "DOG", "e", "1", "of", "the"]
    out = [None, "", " \t\n", "One", "one  TWO", " ", "a b c", "A\x0bB\x1cC d"]
    while len(out) < n:
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 40, 400]))]
        for _ in range(rnd.randint(1, 4)):
            edited = list(base)
            edited[rnd.randrange(len(edited))] = rnd.choice(vocabulary)
            out.append(" ".join(edited))
    return out[:n]


def test_query_against_brute_force(spark, tmp_path):
    rows = texts()
    sf = save(spark, tmp_path, documents=documents(spark, list(enumerate(rows)), fingerprint="x", component_id="y", label="z"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op3(spark, sf).collect()}
    fps = [slow_fingerprint(t) for t in rows]
    comp = slow_components(fps, 2)
    assert got == {i: (f"{fp:016x}", comp[i]) for i, fp in enumerate(fps)}
    assert len(set(comp)) < len(set(fps))


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_links_connect_all_pairs_within_the_radius(spark, distance):
    rnd = random.Random(distance)
    fps = [0, (1 << 64) - 1, 1 << 63]
    for _ in range(12):
        fp = rnd.getrandbits(64)
        for _ in range(4):
            fps.append(fp)
            for _ in range(rnd.randint(1, 3)):
                fp ^= 1 << rnd.randrange(64)
    fps = sorted(set(fps))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint bigint"), distance)
    labels = {r["node"] % (1 << 64): r["label"] for r in simhash.connected_components(edges).collect()}
    comp = slow_components(fps, distance)
    for i, a in enumerate(fps):
        for j, b in enumerate(fps):
            assert (comp[i] == comp[j]) == (a == b or a in labels and labels.get(a) == labels.get(b))


def test_a_long_chain_is_one_component(spark):
    n = 600
    edges = spark.range(n - 1).selectExpr("xxhash64(id) as a", "xxhash64(id + 1) as b")
    labels = simhash.connected_components(edges).collect()
    assert len(labels) == n and len({r["label"] for r in labels}) == 1


def test_nulls_ties_and_empty(spark, tmp_path):
    df = documents(spark, [(None, "a b c"), (7, "A B C"), (7, "A B C"), (None, "x y z w"), (3, None), (5, "")])
    got = sorted(((r["doc_id"], r["component_id"]) for r in op3(spark, save(spark, tmp_path, documents=df)).collect()), key=str)
    assert got == sorted([(None, 7), (7, 7), (7, 7), (None, None), (3, 3), (5, 3)], key=str)
    assert op3(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0


def test_blocks_do_not_change_a_long_text(monkeypatch):
    text = " ".join(texts(60)[8:])
    whole = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 50)
    assert simhash.fingerprint(text.encode(), 3) == whole == slow_signed(text)


def slow_signed(text):
    fp = slow_fingerprint(text)
    return fp - (1 << 64) if fp >> 63 else fp


def test_a_large_group_of_copies_is_salted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY_SHARE", 10)
    rows = [(i, "one common text" if i % 3 else f"text number {i} of many") for i in range(300)]
    got = {r["doc_id"]: r["component_id"] for r in op3(spark, save(spark, tmp_path, documents=documents(spark, rows))).collect()}
    assert len(got) == 300 and {got[i] for i in range(300) if i % 3} == {1}
