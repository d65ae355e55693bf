import hashlib
import random
import zlib

import pytest
from llm.odd import table

from carelake.llm import conversation_repair as C

SPACE = " \t\n\v\f\r"


def plain_search(tokens):
    """Every way, row by row, the best (cost, audit) of each role state kept."""

    def with_inserts(best):
        for _ in range(3):
            for q in list(best):
                new, to = (best[q][0] + 5, best[q][1] + "I"), C.MADE[q]
                best[to] = min(best.get(to, new), new)
        return best

    best = with_inserts({0: (0, "")})
    for t in tokens:
        after = {}
        for q, (cost, audit) in best.items():
            ways = [(q, 2 * len(t), "D" * len(t))]
            if t[0] != "D":
                cut = 5 if t.isupper() else 0
                ways.append((C.MADE[q], 1 + cut, "R"))
                if (to := {"0s": 1, "0u": 2, "1u": 2, "2a": 3, "3u": 2}.get(f"{q}{t.lower()}")) is not None:
                    ways.append((to, cut, "K"))
            for to, more, letter in ways:
                new = cost + more, audit + letter
                after[to] = min(after.get(to, new), new)
        best = with_inserts(after)
    return min(best[q] for q in (0, 3) if q in best)


def brute(rows):
    by_conv = {}
    for r in rows:
        found = by_conv.setdefault(r.conv_id, [])
        told = lambda v: " " if v is None else str(v)
        code, role, text = zlib.crc32(f"{told(r.conv_id)}:{told(r.turn)}".encode()) % 20, told(r.role), told(r.text)
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        found += [(r.turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = []
    for conv, found in by_conv.items():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [x[0] for x in found if x[0] is not None]
        counts, seen, tokens = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in found:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            if fault:
                counts[fault] += 1
            token = role[:1] if role[:1] in ("s", "u", "a") else "x"
            tokens.append("D" if fault in ("blank", "duplicate") else token.upper() if fault else token)
            seen.add((role, text))
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(found, found[1:]))
        cost, audit = plain_search(tokens)
        state, lines, rest = 0, [], iter(found)
        for letter in audit:
            if letter != "I":
                _, role, text = next(rest)
            if letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append(f"{role}:{text}")
            elif letter in "RI":
                state = C.MADE[state]
                lines.append(("assistant:" if state == 3 else "user:") + (text if letter == "R" else ""))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_search_against_every_way():
    some = random.Random(1)
    for trial in range(1500):
        n = some.choice([0, 1, 2, 3, 5, 8, 20, 70 if trial % 50 == 0 else 9])
        tokens = [some.choice(["s", "u", "a", "x", "S", "U", "A", "X", "D", "DD", "u", "a"]) for _ in range(n)]
        want = plain_search(tokens)
        assert C.cheapest(tokens) == want
        whole = C.table(tokens)
        assert min(whole[0, end] for end in C.ENDS if (0, end) in whole) == want


def test_table(spark):
    rows = table(spark, "conversations")
    assert sorted(map(tuple, C.repair(rows).collect()), key=repr) == brute(rows.collect())


def odd(spark):
    some = random.Random(2)
    rows = [
        (None, None, None, None), (None, 1, "user", "hi."), (None, 1, "user", "hi."), (1, None, "assistant", None), (1, None, "user", "x"), (1, 3, "", "text."), (1, 3, "user", "b."),
        (1, 2, "user", "b."), (2, 5, "user", ""), (3, 7, "System", "Hm?\n"), (4, 1, "user", "  "), (9, 0, "user", "long " * 50_000 + "."),
    ]
    rows += [(5, i % 37, some.choice(["user", "assistant", "system", "tool", ""]), some.choice(["ok.", "ok", "a b c!", " ", "\t", "why? ", "é😀."])) for i in range(400)]
    rows += [(6, 0, "user", "same.")] * 50 + [(7, i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(200)]
    rows += [(8, None, "user", "q?")] * 7 + [(c, 0, "user", "only.") for c in range(100, 140)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n", "2 as conv", "3 as cost").repartition(5)


@pytest.mark.parametrize("limits", [{}, {"large": 10, "block_rows": 16}, {"large": 0, "block_rows": 5}])
def test_odd_rows_and_long_conversations(spark, limits):
    rows = odd(spark)
    got = C.repair(rows, **limits)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows.collect())
    assert C.repair(rows.limit(0), **limits).collect() == []


def test_nothing_left():
    assert C.cheapest([]) == (0, "") == C.search((), 0, C.ENDS)
    assert C.Written("").digest() == hashlib.sha256(b"").hexdigest()
