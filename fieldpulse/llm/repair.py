"""Repair of a conversation's structure at least cost, by bidirectional Dijkstra over the edit lattice.

A conversation shall read: a system turn or none, then pairs of a user's and an assistant's turn (or nothing
at all). Its rows in order and four states (nothing yet, after the system turn, after a user, after an
assistant) span a lattice: keeping, re-roling or deleting the next row and inserting an empty turn are its
edges. One heap grows from the start, one backwards from the end; every edge between what the two have
settled is a crossing. They stop once no crossing can be as cheap as the best, so all crossings of equal
cost are seen, and the least audit string among them is taken.

An audit has one letter a row and an ``I`` for each insertion. Of two audits of one stretch with the same cost
and ends neither is the front of the other (more insertions cost more), so least audits of stretches joined
are least: a long conversation is cut into pieces that are solved apart, for every pair of states, and put
together. No task holds a conversation's rows; the conversation's audit is one string, as in the result.

What is compared moves as a hash. Texts move once, to the task that writes their conversation, and are
streamed through it in order.

Rows are taken by turn (null first); rows of one turn by the SHA-256 of role and text, so equal rows are
neighbours. Null role or text is one space, a null conv_id is a conversation of its own. A row has one fault
at most: blank, else a repetition of an earlier row's role and text, else truncated. A role counts by its first
letter (``s``, ``u`` or ``a``); any other, or an empty role, can't be kept. Extra columns are not read. No rows:
no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldpulse.llm._common import map_batches, read_table, staged

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Rows numbered together, and rows solved at once.
BLOCK_ROWS, PIECE_ROWS = 4096, 512
#: Short conversations' solutions remembered by a task, and rows of the longest.
REMEMBERED, REMEMBERED_ROWS = 100_000, 24
START, SYSTEM, USER, ASSISTANT = range(4)
ENDED = (START, ASSISTANT)
INITIALS = "?sua"  # other, and the roles by their state

# A row as a letter: 'A' + 3 * role (0 other, else its state) + fault (0 none, 1 has to go, 2 truncated).
FREE, GO, CUT = range(3)


def row_code(role: Column, fault: Column) -> Column:
    kind = F.instr(F.lit("sua"), F.when(role == "", F.lit("?")).otherwise(F.substring(role, 1, 1)))
    return F.char((F.lit(65) + 3 * kind + fault).cast("int"))


def moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edges that take a row: letter, cost, next state."""
    kind, fault = divmod(code - 65, 3)
    out = [(DELETE, DELETE_COST, state)]
    if fault != GO:
        more = TRUNCATED_COST if fault == CUT else 0
        nxt = ASSISTANT if state == USER else USER
        if kind == nxt or (kind == SYSTEM and state == START):
            out.append((KEEP, more, kind))
        if kind != nxt:
            out.append((REROLE, REROLE_COST + more, nxt))
    return out


MOVES = {65 + c: [moves(65 + c, s) for s in range(4)] for c in range(12)}
#: The same edges by the state they lead to: letter, cost, state before.
BACK = {c: [[(letter, cost, s) for s in range(4) for letter, cost, to in m[s] if to == t] for t in range(4)] for c, m in MOVES.items()}
INSERT_FROM = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,), START: (), SYSTEM: ()}


def cheapest(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """The least cost from ``start`` before the first row to one of ``ends`` after the last, and the least audit
    of that cost; None where no edits lead there."""
    n = len(codes)
    # Edges of no cost take a row, so within one cost the forward heap goes by rows taken and the backward heap
    # by rows left: a popped label is final, and the least audit comes first.
    ahead, behind = [(0, 0, "", start)], [(0, -n, "", s) for s in ends]
    done_f: dict[int, tuple[int, str]] = {}
    done_b: dict[int, tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    while ahead and behind:
        if best is not None and ahead[0][0] + behind[0][0] > best[0]:
            break
        forward = ahead[0][0] <= behind[0][0]
        cost, i, audit, state = heappop(ahead if forward else behind)
        i = abs(i)
        node, mine, other = i * 4 + state, *((done_f, done_b) if forward else (done_b, done_f))
        if node in mine:
            continue
        mine[node] = cost, audit
        met = other.get(node)
        if met is not None:
            found = (cost + met[0], audit + met[1] if forward else met[1] + audit)
            best = found if best is None else min(best, found)
        if forward:
            steps = [(INSERT, INSERT_COST, i, ASSISTANT if state == USER else USER)]
            if i < n:
                steps += [(letter, c, i + 1, to) for letter, c, to in MOVES[codes[i]][state]]
        else:
            steps = [(INSERT, INSERT_COST, i, s) for s in INSERT_FROM[state]]
            if i:
                steps += [(letter, c, i - 1, s) for letter, c, s in BACK[codes[i - 1]][state]]
        for letter, c, j, to in steps:
            at = j * 4 + to
            met = other.get(at)
            if met is not None:
                found = (cost + c + met[0], audit + letter + met[1] if forward else met[1] + letter + audit)
                best = found if best is None else min(best, found)
            if at not in mine:
                if forward:
                    heappush(ahead, (cost + c, j, audit + letter, to))
                else:
                    heappush(behind, (cost + c, -j, letter + audit, to))
    return best  # None: one side has seen all it can reach, and nothing of the other's


def illegal_pairs(codes: bytes) -> int:
    kinds = [INITIALS[(c - 65) // 3] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))


# -- the Spark side


def facts(rows: DataFrame) -> DataFrame:
    """Rows by hash: ``conv_id, turn, key, n`` (equal rows counted), the first row's fault and the code."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    said = F.rtrim(text, F.lit(SPACES))
    narrow = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), row_key(role, text).alias("key"), F.substring(role, 1, 1).alias("initial"),
                         (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(*ENDS)).alias("cut"))
    equal = narrow.groupBy("conv_id", "turn", "key").agg(F.count("*").alias("n"), F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    first = equal.groupBy("conv_id", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first")).select(F.col("conv_id").alias("_c"), F.col("key").alias("_k"), "first")
    met = equal.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k")))
    again = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("blank") | again, GO).when(F.col("cut"), CUT).otherwise(FREE)
    return met.select("conv_id", "turn", "key", "n", "blank", again.alias("again"), "cut",
                      F.concat(row_code(F.col("initial"), fault), F.repeat(row_code(F.col("initial"), F.lit(GO)), (F.col("n") - 1).cast("int"))).alias("codes"))


def row_key(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def counted(facts_: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated`` (long)."""
    n, blank, again = F.col("n"), F.col("blank"), F.col("again")
    per_turn = facts_.groupBy("conv_id", "turn").agg(
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"), F.sum(F.when(blank, 0).when(again, n).otherwise(n - 1)).alias("duplicate"),
        F.sum(F.when(blank | again | ~F.col("cut"), 0).otherwise(1)).alias("truncated"))
    return per_turn.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
                                           *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def pieces(facts_: DataFrame) -> DataFrame:
    """Codes of consecutive rows: ``conv_id, part, block, at, codes, alone`` in the order of the rows."""
    order = ["conv_id", "turn", "key"]
    ranged = facts_.repartitionByRange(*order).sortWithinPartitions(*order)
    no = F.monotonically_increasing_id()
    numbered = staged(ranged.select("conv_id", F.shiftrightunsigned(no, 33).alias("part"), no.alias("no"), "codes"), "repair-order")
    blocks = numbered.groupBy("conv_id", "part", F.expr(f"no div {BLOCK_ROWS}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("no", "codes"))).alias("rows"))
    blocks = blocks.select("conv_id", "part", "block", F.array_join("rows.codes", "").alias("codes"))
    cuts = F.sequence(F.lit(0), F.expr(f"int((length(codes) - 1) div {PIECE_ROWS})"))
    each = blocks.select("conv_id", "part", "block", F.explode(cuts).alias("at"), "codes")
    each = each.select("conv_id", "part", "block", "at", F.substr("codes", F.col("at") * PIECE_ROWS + 1, F.lit(PIECE_ROWS)).alias("codes"))
    total = each.groupBy("conv_id").agg((F.count("*") == 1).alias("alone")).select(F.col("conv_id").alias("_c"), "alone")
    return each.join(total, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")


WAYS = "array<struct<a:int,b:int,cost:bigint,audit:string>>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cheapest ways through each piece: from start to end where it is the whole, else between all states."""
    known: dict[str, list] = {}
    way_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        codes, alone = batch.column("codes").to_pylist(), batch.column("alone").to_pylist()
        ways, wrong = [], []
        for c, one in zip(codes, alone):
            got = known.get(c) if one else None
            if got is None:
                raw = c.encode()
                if one:
                    cost, audit = cheapest(raw, START, ENDED)
                    got = [{"a": START, "b": ASSISTANT, "cost": cost, "audit": audit}]
                    if len(c) <= REMEMBERED_ROWS:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[c] = got
                else:
                    found = [(a, b, cheapest(raw, a, (b,))) for a in range(4) for b in range(4)]
                    got = [{"a": a, "b": b, "cost": w[0], "audit": w[1]} for a, b, w in found if w is not None]
            ways.append(got)
            wrong.append(illegal_pairs(c.encode()))
        ends = pa.array([c[0] + c[-1] for c in codes])
        rest = [batch.column(c) for c in ("conv_id", "part", "block", "at")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(ways, way_type), pa.array(wrong, pa.int64()), ends], ["conv_id", "part", "block", "at", "ways", "illegal", "ends"])


def _join_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            row = batch.slice(r, 1)
            parts = row.column("pieces").to_pylist()[0]
            illegal = sum(p["illegal"] for p in parts) + sum(illegal_pairs((p["ends"][1] + q["ends"][0]).encode()) for p, q in zip(parts, parts[1:]))
            at: dict[int, tuple[int, list[str]]] = {START: (0, [])}
            for p in parts:
                nxt: dict[int, tuple[int, list[str]]] = {}
                for w in p["ways"]:
                    if w["a"] not in at:
                        continue
                    cost, said = at[w["a"]]
                    new, old = (cost + w["cost"], [*said, w["audit"]]), nxt.get(w["b"])
                    if old is None or new[0] < old[0] or (new[0] == old[0] and "".join(new[1]) < "".join(old[1])):
                        nxt[w["b"]] = new
                at = {s: (cost, ["".join(said)]) for s, (cost, said) in nxt.items()}
            cost, audit = min((at[s][0], "".join(at[s][1])) for s in ENDED if s in at)
            yield pa.RecordBatch.from_arrays([row.column("conv_id"), pa.array([cost], pa.int64()), pa.array([audit]), pa.array([illegal], pa.int64())],
                                             ["conv_id", "cost", "audit", "illegal"])


def audits(facts_: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, illegal`` of each conversation."""
    kind = facts_.schema["conv_id"].dataType.simpleString()
    cut = pieces(facts_)
    solved = map_batches(cut.select("conv_id", "part", "block", "at", "codes", "alone"), _solve,
                         f"conv_id {kind}, part bigint, block bigint, at int, ways {WAYS}, illegal bigint, ends string")
    whole = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "block", "at", "ways", "illegal", "ends"))).alias("pieces"))
    return map_batches(whole, _join_ways, f"conv_id {kind}, cost bigint, audit string, illegal bigint")


def _in_order(rows: DataFrame, audits_: DataFrame) -> DataFrame:
    """A conversation's audit, then its rows, side by side in one partition."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    own = rows.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), row_key(role, text).alias("key"), role.alias("role"), text.alias("text"))
    head = audits_.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(b"").alias("key"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return head.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "key")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, None)`` when a conversation begins, then ``(conv_id, edit, turn, role, text)`` of each edit in
    order; role and text are null for a deleted row."""
    names = {"u": "user", "a": "assistant"}
    other = {"u": "a"}  # behind anything but a user's turn comes a user's
    conv, audit, at, last = None, "", 0, ""
    for batch in batches:
        for c, kind, turn, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "kind", "turn", "role", "text"))):
            while at < len(audit) and audit[at] == INSERT:
                at, last = at + 1, other.get(last, "u")
                yield conv, INSERT, None, names[last], ""
            if kind == 0:
                conv, audit, at, last = c, text, 0, ""
                yield conv, None
                continue
            edit, at = audit[at], at + 1
            if edit == DELETE:
                yield conv, edit, turn, None, None
            elif edit == REROLE:
                last = other.get(last, "u")
                yield conv, edit, turn, names[last], text
            else:
                last = role[0]
                yield conv, edit, turn, role, text
    for at in range(at, len(audit)):
        last = other.get(last, "u")
        yield conv, INSERT, None, names[last], ""


def repaired_rows(rows: DataFrame, audits_: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, turn, role, text``; inserted rows have no turn."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "position", "edit", "turn", "role", "text"]
    conv_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def run(batches):
        out, size, position = [], 0, 0
        for step in _walk(batches):
            if step[1] is None:
                position = 0
            elif step[3] is not None:
                out.append((step[0], position, *step[1:]))
                position, size = position + 1, size + len(step[4]) + 32
            if size > 1 << 22:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    def batch_of(out):
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return map_batches(_in_order(rows, audits_), run, f"conv_id {kind}, position bigint, edit string, turn bigint, role string, text string")


def repaired_digests(rows: DataFrame, audits_: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the repaired ``role:text``, newline-joined, streamed row by row."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    conv_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def run(batches):
        done: list[tuple] = []
        conv, sha, some = None, None, False
        for step in _walk(batches):
            if step[1] is None:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha, some = step[0], hashlib.sha256(), False
            elif step[3] is not None:
                sha.update(f"\n{step[3]}:{step[4]}".encode() if some else f"{step[3]}:{step[4]}".encode())
                some = True
            if len(done) >= 10_000:
                yield batch_of(done)
                done = []
        if sha is not None:
            done.append((conv, sha.hexdigest()))
        if done:
            yield batch_of(done)

    def batch_of(done):
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], conv_type), pa.array([d[1] for d in done])], ["conv_id", "repaired_sha256"])

    return map_batches(_in_order(rows, audits_), run, f"conv_id {kind}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows that the query repairs: a fifth to a quarter of all rows dropped, emptied, unpointed, doubled or
    given to the user, by a checksum of conversation and turn."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), part("role").alias("role"), part("text").alias("text"), hit.alias("hit")).filter("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op13_repair(spark, sf_dir: str) -> DataFrame:
    talks = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(talks)
    known = staged(facts(rows), "repair-facts")
    found = staged(audits(known), "repair-audits")
    out = talks.select(F.col("conv_id").alias("c")).distinct()
    for i, table in enumerate((counted(known), found, repaired_digests(rows, found))):
        out = out.join(table.withColumnRenamed("conv_id", f"c{i}"), F.col("c").eqNullSafe(F.col(f"c{i}")), "left")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("c").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
