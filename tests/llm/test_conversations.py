"""Repairs of conversations against a search over all edits and a plain pass over each conversation."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from parcela.llm import conversations

BLANK = " \t\n\x0b\f\r"


def search(letters):
    """Least cost and ASCII-least audit, by trying edits in order of cost and audit until the roles fit."""
    queue, seen = [(0, "", 0, "")], set()
    while queue:
        cost, audit, at, roles = heapq.heappop(queue)
        if at == len(letters) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        state = (at, roles)
        if state in seen or not re.fullmatch("s?(ua)*u?", roles):
            continue
        seen.add(state)
        for role in "ua":
            heapq.heappush(queue, (cost + 3, audit + "I", at, roles + role))
        if at < len(letters):
            x, more = letters[at], 3 * letters[at].isupper()
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, roles))
            if x != "x":
                heapq.heappush(queue, (cost + more, audit + "K", at + 1, roles + x.lower()))
                for role in "ua":
                    heapq.heappush(queue, (cost + 3 + more, audit + "R", at + 1, roles + role))
    return None


def plain(rows):
    """What a conversation's rows (turn, role, text) give."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, letters, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        ended = text.rstrip(BLANK)
        fault = "blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letters += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = search(letters)
    odd, out, at = (len(audit) - audit.count("D")) % 2, [], 0
    for e in audit:
        role = ("user", "assistant")[(len(out) + odd) % 2]
        if e == "I":
            out.append((role, ""))
            continue
        if e != "D":
            out.append((rows[at][1] if e == "K" else role, rows[at][2]))
        at += 1
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *count.values(), illegal, cost, audit, digest), out


def broken(rows):
    out = []
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what:
            row = (conv, turn, "user" if what == 4 else role, "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text)
            out += [row] * (1 + (what == 3))
    return out


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(row)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def results(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_solver_against_search():
    random.seed(1)
    solver = conversations.Solver(50)
    cases = {"".join(random.choice("suaoxSUAO") for _ in range(random.randint(0, 7))) for _ in range(400)}
    for s in cases | {"", "s", "u", "a", "x", "uaua", "suaua", "ssss", "aaaa", "uuuu", "S", "o"}:
        assert solver.solve(s) == search(s), s


def test_solver_of_long_signatures():
    random.seed(2)
    solver = conversations.Solver(200)
    s = "".join(random.choice("suaoxUA") for _ in range(5000))
    cost, audit = solver.solve(s)
    assert conversations.Solver(0).solve(s) == (cost, audit)
    assert len(audit.replace("I", "")) == len(s)
    # Row by row, with the costs of all that may follow.
    after = [(0, 6, 3, 0)]
    for x in reversed(s):
        table = conversations.Solver()._costs_of(x)
        after.append(tuple(min(c + a for c, a in zip(row, after[-1], strict=True)) for row in table))
    assert cost == after[-1][0]


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    after = grouped(broken(rows))
    expected = {c: plain(after.get(c, []))[0] for c in {r[0] for r in rows}}
    assert results(conversations.audit(conversations.damaged(table), table)) == expected


@pytest.fixture(scope="module")
def odd_talk():
    random.seed(4)
    rows = [(1, None, None, None), (1, None, "user", "x."), (1, 3, "user", " \t"), (1, 3, "user", " \t"), (2, 1, "system", "only.")]
    rows += [(None, 1, "user", "who?"), (None, 2, "assistant", "Nobody"), (None, None, "assistant", " ")]
    rows += [(3, 5, "", "no role."), (3, 9, "User", "capital!"), (3, 9, "user", "a. \n"), (3, -4, "assistant", "日本語。")]
    rows += [(4, 1, "user", "again."), (4, 2, "assistant", "yes."), (4, 3, "user", "again."), (4, 4, "assistant", "yes.")] * 2
    rows += [(5, i, random.choice(["system", "user", "assistant", "tool"]), random.choice(["", "a.", "b", "c!", f"{i}?"])) for i in range(300)]
    rows += [(6, 1, "user", "w " * 100_000)]
    return rows


def test_odd_rows(spark, odd_talk):
    schema = "conv_id bigint, turn bigint, role string, text string, pos int, letter string, audit string, fault int, signature int"
    table = spark.createDataFrame([(*r, 1, "x", "x", 1, 1) for r in odd_talk], schema).repartition(3)
    small = {c: rows for c, rows in grouped(odd_talk).items() if c != 5}
    found = conversations.faults(table)
    audited = conversations.audits(found)
    out = results(audited.join(conversations.digests(found, audited).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))))
    expected = {c: plain(rows) for c, rows in small.items()}
    assert {c: r for c, r in out.items() if c != 5} == {c: r for c, (r, _) in expected.items()}
    mended = {}
    for r in sorted(conversations.repaired(found, audited).collect(), key=lambda r: r.pos):
        mended.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {c: r for c, r in mended.items() if c != 5} == {c: r for c, (_, r) in expected.items() if r}
    for rows in mended.values():
        assert re.fullmatch("s?(ua)+", "".join(r[0] for r, _ in rows))
    assert hashlib.sha256("\n".join(f"{r}:{x}" for r, x in mended[5]).encode()).hexdigest() == out[5][-1]


def test_damage_and_lost_conversations(spark, odd_talk):
    rows = [*odd_talk, *((i, None, "user", "x.") for i in range(100, 200))]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(2)
    after = grouped(broken(rows))
    found = results(conversations.audit(conversations.damaged(table), table))
    assert set(found) == {r[0] for r in rows}
    for c in set(found) - {5}:
        assert found[c] == plain(after.get(c, []))[0], c
    assert any(c not in after for c in found)


def test_pieces(spark, monkeypatch):
    """Signatures are the same whatever the length of pieces, also where cases are joined by shuffle."""
    random.seed(6)
    rows = [(c, i, random.choice(["user", "assistant"]), random.choice(["a.", "b", f"{i}."])) for c in range(3) for i in range(40)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = results(conversations.audit(table, table))
    monkeypatch.setattr(conversations, "_PIECE", 7)
    monkeypatch.setattr(conversations, "_MOST", 0)
    assert results(conversations.audit(table, table)) == whole


def test_empty(spark):
    table = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversations.audit(conversations.damaged(table), table).collect() == []
