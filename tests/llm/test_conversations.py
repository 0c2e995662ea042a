"""Conversation repair against a plain search over whole strings."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from siftwork.llm import conversation_repair as cr


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        out += [(conv, turn, role, text)] * (2 if case == 3 else 1)
    return out


def in_order(rows):
    def key(r):
        said = f"{len(r[2])}:{r[2]}{r[3]}".encode()
        return (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(said).digest())

    return sorted(rows, key=key)


def fault_of(row, seen):
    words = re.findall("[^\x20\x09-\x0d]", row[3])
    if not words:
        return cr.BLANK
    if row[2:] in seen:
        return cr.DUPLICATE
    return cr.FINE if words[-1] in ".!?" else cr.TRUNCATED


PATTERN = re.compile("(s?(ua)+)?")


def brute_repair(initials, faults):
    """Best (cost, audit, roles) by whole strings, one state of the automaton at a time."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for to in steps[state]:
                    if to != "s":
                        new = (cost + 5, audit + "I", out + (("I", to),))
                        best[to] = min(best.get(to, new), new)
        return best

    best = inserts(best)
    for i, (initial, fault) in enumerate(zip(initials, faults)):
        after = {}
        for state, (cost, audit, out) in best.items():
            offers = [(state, (cost + 2, audit + "D", out))]
            if fault < cr.DUPLICATE:
                more = 5 if fault == cr.TRUNCATED else 0
                for to in steps[state]:
                    if initial == to:
                        offers.append((to, (cost + more, audit + "K", out + ((i, None),))))
                    if to != "s":
                        offers.append((to, (cost + 1 + more, audit + "R", out + ((i, to),))))
            for to, new in offers:
                after[to] = min(after.get(to, new), new, key=lambda x: x[:2])
        best = inserts(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute(rows):
    convs, damaged = {r[0] for r in rows}, brute_damage(rows)
    out = {}
    for conv in convs:
        own = in_order([r for r in damaged if r[0] == conv])
        seen, faults = set(), []
        for r in own:
            faults.append(fault_of(r, seen))
            seen.add(r[2:])
        initials = [r[2][:1] for r in own]
        cost, audit, kept = brute_repair(initials, faults)
        full = {"u": "user", "a": "assistant"}
        lines = [f"{full[to]}:" if i == "I" else f"{full.get(to, own[i][2])}:{own[i][3]}" for i, to in kept]
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, faults.count(cr.BLANK), faults.count(cr.DUPLICATE), faults.count(cr.TRUNCATED), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows, kind="long", n=4):
    df = spark.createDataFrame(rows, f"conv_id {kind}, turn long, role string, text string").repartition(n)
    return {r.conv_id: tuple(r)[1:] for r in cr.repair_damaged(df).collect()}


def conversations(seed, convs, most, null=True):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "User", "tool", ""] + [None] * null
    texts = ["Yes.", "No", "Well!", "so ?\n", "", " \t", "Yes.", "a\xa0", "é."] + [None] * null
    rows = []
    for c in range(convs):
        good = rng.random() < 0.6
        for t in range(rng.randint(1, most)):
            turn = t + (rng.random() < 0.1) * rng.randint(1, 4) if rng.random() > 0.05 or not null else None
            role = ("user", "assistant")[t % 2] if good and rng.random() < 0.85 else rng.choice(roles)
            rows.append((c, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randint(0, 40)}."))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = conversations(seed, 300, 9)
    assert found(spark, rows) == brute(rows)


def test_exhaustive_enumeration():
    """The brute force itself: all edit strings up to two insertions, on short inputs."""

    def runs(initials, faults, state="", inserted=0):
        if state in ("", "a") and not initials:
            yield 0, ""
        if inserted < 2:
            for to in {"": "u", "s": "u", "u": "a", "a": "u"}[state]:
                for c, a in runs(initials, faults, to, inserted + 1):
                    yield c + 5, "I" + a
        if initials:
            for c, a in runs(initials[1:], faults[1:], state, inserted):
                yield c + 2, "D" + a
            if faults[0] < cr.DUPLICATE:
                more = 5 * (faults[0] == cr.TRUNCATED)
                for to in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    for c, a in runs(initials[1:], faults[1:], to, inserted):
                        if initials[0] == to:
                            yield c + more, "K" + a
                        if to != "s":
                            yield c + 1 + more, "R" + a

    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(0, 5)
        initials, faults = [rng.choice("suaxt") for _ in range(n)], [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, audit, _ = brute_repair(initials, faults)
        assert (cost, audit) == min(runs(initials, faults))
        table = cr.table_of("".join(initials), np.array(faults, int), (cr.EMPTY,))
        (way,) = cr.path_through([table])
        assert (way.cost, way.letters) == (cost, audit)


def test_runs_join_to_the_same_path():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 30)
        initials, faults = "".join(rng.choice("suaax") for _ in range(n)), np.array([rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)])
        cuts = sorted(rng.sample(range(1, n), min(n - 1, rng.randint(0, 4))))
        tables = [cr.table_of(initials[a:b], faults[a:b], tuple(range(4))) for a, b in zip([0, *cuts], [*cuts, n])]
        ways = cr.path_through(tables)
        assert (ways[-1].cost, "".join(w.letters for w in ways)) == brute_repair(initials, faults)[:2]


def test_comparison_of_trails():
    rng = random.Random(7)
    trail, texts = cr.Trail(), {0: ""}
    for _ in range(600):
        parent = rng.choice(list(texts)[-60:])
        letter = rng.choice("DK")
        texts[trail.add(parent, letter)] = texts[parent] + letter
    nodes = list(texts)
    for _ in range(4000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        assert trail.less(x, y) == (texts[x] < texts[y]) and trail.text(x) == texts[x]


def test_hash_collisions_are_noticed(monkeypatch):
    monkeypatch.setattr(cr, "MODULUS", 2)
    test_comparison_of_trails()


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(9)
    rows = conversations(3, 40, 6, null=False)
    rows += [(77, i // 2 * 2 if i > 900 else i, ("user", "assistant")[i % 2] if rng.random() < 0.8 else "tool", f"t {rng.randint(0, 700)}" + "." * (rng.random() < 0.9)) for i in range(3000)]
    want = brute(rows)
    keep = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = cr.runs_of(cr.sorted_rows(cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
        assert spread.where("conv = 77").count() > 5
        assert found(spark, rows) == want
    finally:
        for n, v in keep.items():
            spark.conf.set(n, v)


def test_edge_cases(spark):
    gone = next(f"c{i}" for i in range(1000) if zlib.crc32(f"c{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x."), (None, None, None, None), (None, 1, "user", "hi."), ("a", None, "assistant", "x." * 500_000), ("a", 3, "user", "y."), ("a", 3, "user", "y."), ("a", 3, "user", "y.")]
    got = found(spark, rows, "string")
    assert got == brute(rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_damaged(empty).collect() == []
    rows = conversations(5, 20, 5)
    odd = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, conv int, audit string")
    assert {r.conv_id: tuple(r)[1:] for r in cr.repair_damaged(odd).collect()} == brute(rows)
