"""Conversation repair against a plain version of its contract."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from valuetide.llm import dialogs

from .conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256(b"").hexdigest()


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        role, text = name(role), name(text)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        held = out[conv]
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        held += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def plain_edits(rows):
    """(cost, audit, turns): every edit tried from every state, whole audits compared.

    rows: (role, text, must go, cut short).  From the last row backwards the
    least (cost, audit) of a state is final, as what came before is common.
    """
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {q: (10**9, "", []) for q in due}
    best[""] = best["a"] = (0, "", [])
    inserted = lambda q, after: min(
        after[q],
        *[
            (5 * n + after[state][0], "I" * n + after[state][1], [(x, "") for x in names] + after[state][2])
            for n, state, names in chains(q)
        ],
    )

    def chains(q):
        state, names = q, []
        for n in (1, 2, 3):
            state = due[state]
            names = [*names, {"u": "user", "a": "assistant"}[state]]
            yield n, state, names

    best = {q: inserted(q, best) for q in due}
    for role, text, must_go, cut in reversed(rows):
        step = {}
        for q in due:
            ways = [(2 + best[q][0], "D" + best[q][1], best[q][2])]
            if not must_go:
                add = 5 if cut else 0
                r = role[:1]
                if r and (r == due[q] or (q == "" and r == "s")):
                    c, a, t = best[r]
                    ways.append((add + c, "K" + a, [(role, text), *t]))
                c, a, t = best[due[q]]
                ways.append((1 + add + c, "R" + a, [({"u": "user", "a": "assistant"}[due[q]], text), *t]))
            step[q] = min(ways)
        best = {q: inserted(q, step) for q in due}
    return best[""]


def plain_repair(rows, hash_order):
    out = []
    for conv, held in plain_damage(rows).items():
        held = sorted(held, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hash_order.get(r[1:], ())))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, judged = [0, 0, 0], set(), []
        for _, role, text in held:
            end = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            if not end:
                fault = 0
            elif (role, text) in seen:
                fault = 1
            elif end[0] not in ".!?":
                fault = 2
            else:
                fault = None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        initials = [r[:1] for r, *_ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, left = plain_edits(judged)
        text = "\n".join(f"{r}:{t}" for r, t in left)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in left))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def hash_order(spark, rows):
    """Where the hashes of role and text put rows of one turn and role."""
    held = {(r, t) for x in plain_damage(rows).values() for _, r, t in x}
    df = spark.createDataFrame([*held, ("", "")], "role string, text string")
    return {(r.role, r.text): (r.h1, r.h2) for r in dialogs.with_hashes(df).collect()}


def made_conversations():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "usr", "User", "", None]
    texts = ["One.", "Two!", "three", "Is it? ", "  ", "", None, "four\n", "x.\x0b\t", "ñ。", "end. "]
    rows = []
    for conv in [*range(60), None]:
        n = rng.choice([0, 1, 2, 3, 5, 8, 13, 40])
        for turn in range(n):
            role = rng.choices(roles, [9, 9, 2, 1, 1, 1, 1, 1])[0]
            if rng.random() < 0.5:
                role = ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.6 else f"turn {rng.randrange(99)}."
            rows.append((conv, None if rng.random() < 0.1 else turn + rng.randrange(2), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    long = [(1000, t, ("user", "assistant")[(t + t // 7) % 2], f"turn {t % 90}" + "."[: t % 11]) for t in range(1500)]
    return rows + long + [(2000, 0, "assistant", "long. " * 50_000 + "x"), (2000, 1, "assistant", "long. " * 50_000)]


def check(spark, df, rows):
    got = dialogs.damaged_repairs(df)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    want = plain_repair(rows, hash_order(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def test_made_conversations(spark):
    rows = made_conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS part", "1 AS copies", "2 AS cost", "'x' AS audit")
    want = check(spark, df.repartition(5), rows)
    assert {x for r in want for x in r[7]} == set("DKR")


def test_small_table(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    check(spark, df, [tuple(r) for r in df.collect()])


def test_no_rows_and_only_dropped_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dialogs.damaged_repairs(none).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA)
    assert [tuple(r) for r in dialogs.damaged_repairs(one).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", NOTHING)]


@pytest.mark.parametrize("seed", range(4))
def test_halves_and_pieces_give_the_least_audit(seed):
    """Random rows: whole, halved and in pieces, against whole audits compared."""
    rng = random.Random(seed)
    for _ in range(400):
        codes = bytes(rng.choice(range(16)) for _ in range(rng.randrange(1, 14)))
        rows = [("sua?"[c & 3], "t", bool(c & 4), bool(c & 8)) for c in codes]
        cost, audit, _ = plain_edits(rows)
        assert dialogs.solve(codes) == (cost, audit)
        cuts = sorted(rng.randrange(len(codes) + 1) for _ in range(3))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)]) if a < b]
        total, states = dialogs.crossings([dialogs.matrix(p) for p in parts])
        pieces = [dialogs.audit_between(p, *states[k : k + 2]) for k, p in enumerate(parts)]
        assert (total, "".join(pieces) + dialogs.FINISH[states[-1]][1]) == (cost, audit)


def test_repaired_rows_hold_the_texts(spark):
    rows = [(5, 1, "assistant", "First?", 1), (5, 2, "user", "Second.", 2), (5, 3, "user", "Third.", 1)]
    df = spark.createDataFrame(rows, SCHEMA + ", copies int")
    found, left = dialogs.repair(df)
    assert [(r.cost, r.audit) for r in found.collect()] == [(5, "DKDR")]
    got = sorted((r.place, r.turn, r.role, r.text, r.edit) for r in left.collect())
    assert got == [(0, 2, "user", "Second.", "K"), (1, 3, "assistant", "Third.", "R")]
