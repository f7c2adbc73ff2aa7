import hashlib
import random
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest

from inkwell.llm import conversation_repair as cr
from inkwell.llm.queries import op11
from tests.llm.helpers import save

sys.setrecursionlimit(20_000)

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The rows of each conversation after damage, by turn."""
    convs = {}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = convs.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        role = "user" if fault == 4 else role
        own += [(turn, role, text)] * (2 if fault == 3 else 1)
    for own in convs.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return convs


def fault_of(rows, k):
    _, role, text = rows[k]
    bare = text.rstrip(SPACE)
    if not bare:
        return "blank"
    if any(r[1:] == (role, text) for r in rows[:k]):
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


def cheapest(rows, faults):
    """(cost, audit, repaired) by trying every edit at every place."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(k, state, inserts):
        found = [(0, "", ())] if k == len(rows) and state in ("", "a") else []

        def add(cost, letter, role, text, k, state, inserts):
            c, audit, said = best(k, state, inserts)
            if c is not None:
                found.append((c + cost, letter + audit, ((role + ":" + text,) if role is not None else ()) + said))

        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in after:
                    add(2, "I", role, "", k, after[state, role[0]], inserts + 1)
        if k < len(rows):
            add(3, "D", None, "", k + 1, state, 0)
            if faults[k] not in ("blank", "duplicate"):
                late = faults[k] == "truncated"
                _, role, text = rows[k]
                if (state, role[:1]) in after:
                    add(late, "K", role, text, k + 1, after[state, role[:1]], 0)
                for other in ("user", "assistant"):
                    if (state, other[0]) in after:
                        add(2 + late, "R", other, text, k + 1, after[state, other[0]], 0)
        return min(found) if found else (None, None, None)

    return best(0, "", 0)


def expected(rows):
    out = {}
    for conv, own in damaged(rows).items():
        faults = [fault_of(own, k) for k in range(len(own))]
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = cheapest(own, faults)
        sha = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)
    return out


def conversations(n, seed=2, longest=9):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for k in range(rnd.randint(1, longest)):
            turn = rnd.choice([k, k, k, k, k + 2, None, -k])
            role = rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""])
            text = rnd.choice([f"Said {rnd.randint(0, 9)}.", "What?", "", " \n", None, "no end", "É!\x0b", "same."])
            rows.append((conv, turn, role, text))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return df.withColumn("key", F.lit("k")).withColumn("present", F.lit("p")).withColumn("block", F.lit(1))


def results(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_against_brute_force(spark, tmp_path):
    rows = conversations(150)
    assert results(op11(spark, save(spark, tmp_path, conversations=frame(spark, rows)))) == expected(rows)


@pytest.mark.parametrize("block,bits", [(4, 1), (16, 8)])
def test_conversations_over_many_blocks(spark, monkeypatch, block, bits):
    monkeypatch.setattr(cr, "BLOCK", block)
    monkeypatch.setattr(cr, "SCAN_BITS", bits)
    rows = conversations(12, seed=7, longest=50)
    rows += [(1000, k if k % 3 else None, random.Random(k).choice(["user", "assistant", "system"]), f"t{k % 40}.") for k in range(300)]
    assert results(cr.repair(cr.damage(frame(spark, rows)))) == expected(rows)


def test_one_conversation_holds_all_rows(spark):
    rows = [(5, k, "user" if k % 2 else "assistant", f"{k}.") for k in range(4000)]
    found = results(cr.repair(cr.damage(frame(spark, rows))))
    own = damaged(rows)[5]
    conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha = found[5]
    turns = [r[0] for r in own]
    assert gaps == max(turns) - min(turns) + 1 - len(set(turns))
    faults, seen = [], set()
    for r in own:
        faults.append("blank" if not r[2] else "duplicate" if r[1:] in seen else None if r[2][-1] == "." else "truncated")
        seen.add(r[1:])
    assert (blank, duplicate, truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
    assert audit.count("D") + audit.count("K") + audit.count("R") == len(own)


def test_ranks_order_the_audits():
    rnd = random.Random(3)
    n = np.array([0, 1, 5, 12, 3])
    begins = np.concatenate([[0], np.cumsum(n)])
    code = np.array([rnd.randrange(4) for _ in range(n.sum())])
    forced, late = (np.array([rnd.random() < 0.2 for _ in code]) for _ in range(2))
    plan = cr.Plan(code, forced, late, begins, np.tile(cr.AT_END, (len(n), 1)), np.ones(len(n), bool))
    nodes, ends = plan.paths(np.arange(len(plan.done)))
    audits = [plan.audit(nodes[a:b]) for a, b in zip([0, *ends], ends)]
    by_rank = sorted(range(len(audits)), key=lambda k: plan.rank[k])
    assert [audits[k] for k in by_rank] == sorted(audits)
    for k, audit in enumerate(audits):
        for j, other in enumerate(audits):
            assert (plan.rank[k] == plan.rank[j]) == (audit == other)


def test_empty_and_all_dropped(spark):
    gone = [(c, t, "user", "x.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    only = {c for c, *_ in gone}
    found = results(cr.repair(cr.damage(frame(spark, gone))))
    assert found == {c: (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in only}
    assert cr.repair(cr.damage(frame(spark, gone).limit(0))).count() == 0
