"""Conversation repair against a plain dynamic programme and a plain walk."""

import hashlib
import random
import re
import zlib

import pytest

from fieldpulse.llm import repair

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_cheapest(codes, start=0, ends=(0, 3)):
    """All states after each row with their least (cost, audit), insertions closed over."""
    def close(at):
        for _ in range(4):
            for s, (c, a) in list(at.items()):
                to = 3 if s == 2 else 2
                new = (c + 2, a + "I")
                if to not in at or new < at[to]:
                    at[to] = new
        return at

    at = close({start: (0, "")})
    for code in codes:
        kind, fault = divmod(code - 65, 3)
        nxt = {}
        for s, (c, a) in at.items():
            ways = [("D", 3, s)]
            if fault != 1:
                extra = 1 if fault == 2 else 0
                if kind == 1 and s == 0:
                    ways.append(("K", extra, 1))
                if kind == 2 and s != 2:
                    ways.append(("K", extra, 2))
                if kind == 3 and s == 2:
                    ways.append(("K", extra, 3))
                ways.append(("R", 2 + extra, 3 if s == 2 else 2))
            for letter, cost, to in ways:
                new = (c + cost, a + letter)
                if to not in nxt or new < nxt[to]:
                    nxt[to] = new
        at = close(nxt)
    found = [at[s] for s in ends if s in at]
    return min(found) if found else None


def test_cheapest_against_dynamic_programme():
    rng = random.Random(3)
    for _ in range(4000):
        weights = rng.choice([[1] * 12, [0, 0, 0, 4, 1, 1, 9, 1, 2, 9, 1, 2], [0, 0, 0, 0, 0, 0, 5, 3, 1, 1, 0, 0]])
        codes = bytes(rng.choices(range(65, 77), weights, k=rng.randint(1, 14)))
        assert repair.cheapest(codes, 0, (0, 3)) == plain_cheapest(codes)
        a, b = rng.randrange(4), rng.randrange(4)
        assert repair.cheapest(codes, a, (b,)) == plain_cheapest(codes, a, (b,))


def plain(rows):
    """What the query returns for one conversation's damaged rows, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts, codes, seen = [0, 0, 0], [], set()
    for _, role, text in rows:
        said = WORD.findall(text)
        fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        codes.append(65 + 3 * ("?sua".index(role[0]) if role[:1] in ("s", "u", "a") else 0) + {None: 0, 0: 1, 1: 1, 2: 2}[fault])
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = plain_cheapest(bytes(codes)) if rows else (0, "")
    out, left = [], list(rows)
    for letter in audit:
        due = "assistant" if out and out[-1][0][0] == "u" else "user"
        if letter == "I":
            out.append((due, ""))
            continue
        _, role, text = left.pop(0)
        if letter != "D":
            out.append((due if letter == "R" else role, text))
    assert not left and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def plain_query(table):
    convs = {}
    for conv, turn, role, text in table:
        kept = convs.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        kept += [(turn, role, text)] * (2 if hit == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: plain(sorted(rows, key=order)) for c, rows in convs.items()}


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query_against_plain(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(repair.op13_repair(spark, SF)) == plain_query(table)


def made_table():
    rng = random.Random(8)
    texts = ["Yes.", "No", "  ", "", None, "What?\n", "Fine! \t", "a.b", "\x0b", "ends ", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(c, rng.choice([None, *range(12)]) if c % 3 else t, rng.choice(roles) if c % 2 else ["system", "user", "assistant"][min(t, 1 + t % 2)], rng.choice(texts))
            for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(None, t, "user", "Yes.") for t in range(4)] + [(500, 1, "user", "Again.")] * 40
    rows += [(501, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(90)}{rng.choice(['.', ''])}") for t in range(700)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_nulls_ties_repeats_and_long_conversations(spark, tmp_path, monkeypatch, small):
    if small:  # conversations cut into many pieces
        monkeypatch.setattr(repair, "BLOCK_ROWS", 5)
        monkeypatch.setattr(repair, "PIECE_ROWS", 3)
    rows = made_table()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as `a.b`", "'x' as key", "2 as codes")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(repair.op13_repair(spark, str(tmp_path))) == plain_query(rows)


def test_repaired_rows(spark):
    rows = [(7, 0, "assistant", "Hello."), (7, 1, "user", "Hi"), (7, 1, "user", "Hi"), (7, 2, "assistant", " "), (8, 0, "user", ""), (9, 0, "system", "Be brief.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.audits(repair.facts(df))
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {7: (11, "IKDDD"), 8: (3, "D"), 9: (3, "D")}
    got = [tuple(r) for r in repair.repaired_rows(df, found).orderBy("conv_id", "position").collect()]
    for conv in (7, 8, 9):
        said = "".join(r[4][0] for r in got if r[0] == conv)
        assert re.fullmatch("(s?(ua)+)?", said)
    assert [r for r in got if r[0] == 8] == []


def test_empty_table_and_all_dropped(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e/conversations.parquet")
    assert repair.op13_repair(spark, f"{tmp_path}/e").count() == 0
    gone = next((c, t) for c in range(100) for t in range(10) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(*gone, "user", "Hi.")], schema).write.parquet(f"{tmp_path}/g/conversations.parquet")
    assert result(repair.op13_repair(spark, f"{tmp_path}/g")) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
