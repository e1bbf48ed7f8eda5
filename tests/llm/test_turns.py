"""Conversation repair against a search over all edits, and against its SQL."""

import binascii
import hashlib
import heapq
import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from plenaria.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(seed=5):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        for t in range(r.choice([1, 2, 3, 6, 9])):
            role = r.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]) if r.random() < 0.5 else ("user", "assistant")[t % 2]
            rows.append((c, t * r.choice([1, 1, 1, 2]), role, r.choice(["Yes.", "No?", "well", " \n", "", None, f"Turn {t}!", f"cut {t}", "end.\t"])))
    return [*rows, (None, 1, "user", "Who?"), (None, None, "assistant", "Nobody."), (7, None, "user", "Null turn."), (7, None, "user", "Null turn."), (61, 0, None, None)]


def damaged(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        k, role, text = binascii.crc32(f"{said(c)}:{said(t)}".encode()) % 20, said(role), said(text)
        text = "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        out[c] += [(t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return {c: sorted(x, key=lambda y: (y[0] is not None, y[0] or 0, y[1], y[2])) for c, x in out.items()}


def cheapest(said, faults):
    """Dijkstra over places and states, by cost and audit."""
    best, heap = {}, [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(said) and last in ("", "a"):
            return cost, audit, made
        if best.get((i, last), (cost + 1,)) <= (cost, audit):
            continue
        best[i, last] = (cost, audit)
        to = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[to]
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*made, (name, ""))))
        if i < len(said):
            (_, role, text), fault = said[i], faults[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, made))
            if fault not in ("blank", "duplicate"):
                more = cost + 5 * (fault == "truncated")
                if role[:1] == "s" and not last and not any(made):
                    heapq.heappush(heap, (more, audit + "K", i + 1, "s", (*made, (role, text))))
                edit = (0, "K", role) if role[:1] == to else (1, "R", name)
                heapq.heappush(heap, (more + edit[0], audit + edit[1], i + 1, to, (*made, (edit[2], text))))
    raise AssertionError


def brute(rows):
    out = {}
    for c, said in damaged(rows).items():
        seen, faults = set(), []
        for _, role, text in said:
            body = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
        at = [t for t, _, _ in said if t is not None]
        cost, audit, made = cheapest(said, faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
        out[c] = (max(at) - min(at) + 1 - len(set(at)) if at else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(map(":".join, made)).encode()).hexdigest())
    return out


def asked(spark, rows, tmp_path, more=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in more:
        df = df.withColumn(c, F.lit("x"))
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    return {r[0]: tuple(r)[1:] for r in turns.query(spark, str(tmp_path)).collect()}


def test_brute_force(spark, tmp_path):
    rows = rows_of()
    want = brute(rows)
    assert asked(spark, rows, tmp_path, ("gone", "fault", "times", "all", "audit", "best")) == want and len(want) == 62
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert {r[0]: r[1:] for r in db.execute(turns.SQL).fetchall()} == want


def test_inserts_where_they_are_cheap(spark):
    """With other costs a missing answer is put in, and the repaired turns say whose it is."""
    rows = spark.createDataFrame([(1, t, r, x, False) for t, (r, x) in enumerate([("system", "Be brief."), ("user", "One?"), ("user", "Two?"), ("assistant", "Both.")])], SCHEMA + ", gone boolean")
    r = turns.repair(rows, turns.Costs(rerole=9, delete=9, insert=1)).first()
    assert (r.cost, r.audit, [tuple(x) for x in r.turns]) == (1, "KKIKK", [("system", "Be brief."), ("user", "One?"), ("assistant", ""), ("user", "Two?"), ("assistant", "Both.")])


def test_empty_and_long(spark, tmp_path):
    assert asked(spark, [], tmp_path / "none") == {}
    rows = [(1, t, ("user", "assistant")[t % 2], f"{'long ' * 2000}{t}.") for t in range(300)]
    assert asked(spark, rows, tmp_path / "long") == brute(rows)
