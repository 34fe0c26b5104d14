"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation is a sequence of rows, each a symbol: its role's initial and its fault.
The cheapest edits that make it a dialogue (an optional system turn, then pairs of user
and assistant) are found by a min-plus product: every symbol is a matrix of the costs of
going from one state of the dialogue to another, each with its audit, the edits' initials.

1. ``segments``: rows are sorted by conversation over the cluster (range partitions, so that
   one conversation may span many tasks) and cut into segments of at most
   ``SEGMENT_ROWS`` rows.
2. ``grammar``: Re-Pair over all distinct segments with their counts: each round the
   commonest pairs of symbols (no symbol both first and last in the round's pairs) become
   rules.  A rule has one transfer matrix, the product of its two parts', evaluated
   bottom-up and shared by all conversations; its audits are ropes of the parts' audits.
3. ``entries``: a segment's matrix is the product over its compressed symbols.  The
   matrices of a conversation's segments are chained (four costs, four ranks and four back
   pointers a segment), which gives every segment its first and last state.
4. ``repair``: every segment writes its part of the audit and of the repaired text.
   Parts of conversations with more than one segment are hashed in order, as a stream.

Edits: Keep 0; Rerole to user or assistant 3; Delete 4, required for blank and duplicate
rows; Insert an empty user or assistant turn 3; rows that stay truncated add 3.  Ties go to the
audit that is least as ASCII.  Insertions are taken before a row's edit (and at the end of
the conversation), so of two audits of a segment neither begins the other, and ranks
within segments order whole audits.

Bounded: rules (``MAX_RULES``; what stays uncompressed is multiplied symbol by symbol),
rows of a segment, bytes of a piece of text.  The hash of one conversation is sequential by
its definition: its text streams through one task in pieces, never as a whole.

Defined cases: null roles and texts count as one space, as do nulls in the damage's key;
rows of one turn stand in order of role, then of a digest of role and text (null turns
first); repeated rows count as duplicates; a null conv_id is a conversation of its own; a
conversation that loses all rows has zeros, an empty audit and the hash of the empty text;
an empty table gives an empty result; other columns are ignored.  A duplicate is found
by a 256-bit digest.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import staged

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
SEGMENT_ROWS = 4096
SEGMENT_BYTES = 1 << 18
MAX_RULES = 128
ROUNDS = 16
PIECE_BYTES = 1 << 17
STATES = range(4)                       # nothing yet, after system, after user, after assistant
NEXT_USER = {0: 2, 1: 2, 3: 2}          # state -> state after a user turn
NEXT_ASSISTANT = {2: 3}
ENDS = (0, 3)
#: symbols: role initial, upper case where truncated; x: another role; d: must go
KEPT = "suaxSUAX"
MUST_GO = "d"
FIRST_RULE = 0xE000                     # rules are named by private-use code points

Entry = tuple[int, str]
Matrix = dict[tuple[int, int], Entry]


def _least(into: Matrix, key, entry: Entry) -> None:
    if key not in into or entry < into[key]:
        into[key] = entry


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; audits are joined, ties go to the least."""
    out: Matrix = {}
    for (p, q), (c, w) in a.items():
        for (q2, r), (c2, w2) in b.items():
            if q2 == q:
                _least(out, (p, r), (c + c2, w + w2))
    return out


def insertions() -> Matrix:
    """Any number of inserted turns (a loop never pays)."""
    out: Matrix = {(p, p): (0, "") for p in STATES}
    step = {(p, q): (INSERT, "I") for p, q in [*NEXT_USER.items(), *NEXT_ASSISTANT.items()]}
    for _ in STATES:
        for key, entry in times(out, step).items():
            if key[0] != key[1]:
                _least(out, key, entry)
    return out


def edit(symbol: str) -> Matrix:
    """One row's edit, without insertions."""
    out: Matrix = {(p, p): (DELETE, "D") for p in STATES}
    if symbol == MUST_GO:
        return out
    more = TRUNCATED if symbol.isupper() else 0
    role = symbol.lower()
    for moves, initial in ((NEXT_USER, "u"), (NEXT_ASSISTANT, "a"), ({0: 1}, "s")):
        for p, q in moves.items():
            if role == initial:
                _least(out, (p, q), (more, "K"))
            elif initial != "s":
                _least(out, (p, q), (REROLE + more, "R"))
    return out


class Grammar:
    """Rules (a pair of symbols each, in order) and the matrix of every symbol."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        before = insertions()
        self.matrix = {s: times(before, edit(s)) for s in KEPT + MUST_GO}
        for i, pair in enumerate(pairs):
            self.matrix[chr(FIRST_RULE + i)] = times(self.matrix[pair[0]], self.matrix[pair[1]])

    def compress(self, symbols: str) -> str:
        for i, pair in enumerate(self.pairs):
            if len(symbols) < 2:
                break
            symbols = symbols.replace(pair, chr(FIRST_RULE + i))
        return symbols

    def of(self, symbols: str) -> Matrix:
        """Matrix of a whole segment."""
        parts = [self.matrix[s] for s in self.compress(symbols)]
        while len(parts) > 1:           # by halves, so audits are joined as a balanced rope
            parts = [times(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the stated damage."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce("text", blank)
    return (conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"),
                                 (F.crc32(key.cast("binary")) % 20).alias("_kind"))
            .filter(F.col("_kind") != 0)
            .select("conv_id", "turn",
                    F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") == 1, F.lit(""))
                    .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def _key(conv_id: Column) -> Column:
    """conv_id as text, with a value for null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their symbol and fault; duplicates are found over the cluster from
    digests, without moving texts where few digests repeat."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = staged(rows.select("conv_id", "turn", "role", "text", _key(F.col("conv_id")).alias("conv"),
                              F.unhex(digest).alias("digest"), F.monotonically_increasing_id().alias("uid")),
                  "conversation-rows")
    place = F.struct("turn", "uid")                       # nulls come first in a minimum of structs
    again = (rows.groupBy("conv", "digest").agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
             .filter("n > 1").select("conv", "digest", F.col("earliest.uid").alias("first_uid")))
    space = r"[\x20\x09-\x0D]"
    blank = ~F.col("text").rlike(rf"[^\x20\x09-\x0D]")
    duplicate = F.col("first_uid").isNotNull() & (F.col("first_uid") != F.col("uid"))
    truncated = ~F.col("text").rlike(rf"[.!?]{space}*\z")
    fault = F.when(blank, "blank").when(duplicate, "duplicate").when(truncated, "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return (rows.join(again, ["conv", "digest"], "left").withColumn("fault", fault)
            .withColumn("symbol", F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
                        .when(F.col("fault") == "truncated", F.upper(role)).otherwise(role))
            .withColumn("initial", initial)
            .select("conv_id", "conv", "turn", "role", "text", "digest", "uid", "fault", "symbol", "initial"))


_NUMBERS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "turns")
_ENDS = ("first_turn", "last_turn", "low_turn")


def segments(rows: DataFrame) -> DataFrame:
    """Marked rows as segments: conv, part and chunk (their order), symbols, roles and texts
    as lists, and counts."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("uid")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", "symbol", "initial",
        F.spark_partition_id().alias("part"))

    def cut(batches):
        import pyarrow as pa
        schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()),
                            ("symbols", pa.string()), ("roles", pa.list_(pa.string())),
                            ("texts", pa.list_(pa.string())), ("initials", pa.list_(pa.string())),
                            *((c, pa.int64()) for c in _NUMBERS + _ENDS)])
        done, now, last = [], None, ("", -1)

        def close(s):
            turns = [t for t in s["turn"] if t is not None]
            pairs = [a + b for a, b in zip(s["initial"], s["initial"][1:])]
            done.append({
                "conv": s["conv"], "part": s["part"], "chunk": s["chunk"], "symbols": "".join(s["symbol"]),
                "roles": s["role"], "texts": s["text"], "initials": [s["initial"][0], s["initial"][-1]],
                "n_rows": len(s["role"]), "blank": s["fault"].count("blank"),
                "duplicate": s["fault"].count("duplicate"), "truncated": s["fault"].count("truncated"),
                "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "turns": len(set(turns)),
                "first_turn": s["turn"][0], "last_turn": s["turn"][-1], "low_turn": min(turns, default=None)})

        def flush():
            out = pa.RecordBatch.from_pylist(done, schema=schema)
            done.clear()
            return out

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            for i, conv in enumerate(columns["conv"]):
                if now is not None and (conv != now["conv"] or len(now["role"]) >= SEGMENT_ROWS
                                        or now["bytes"] >= SEGMENT_BYTES):
                    last = (now["conv"], now["chunk"])
                    close(now)
                    now = None
                    if len(done) >= 1000 or sum(len(x) for x in done[-1]["texts"]) > SEGMENT_BYTES:
                        yield flush()
                if now is None:
                    now = {"conv": conv, "part": columns["part"][i], "bytes": 0,
                           "chunk": last[1] + 1 if last[0] == conv else 0,
                           "turn": [], "role": [], "text": [], "fault": [], "symbol": [], "initial": []}
                for c in ("turn", "role", "text", "fault", "symbol", "initial"):
                    now[c].append(columns[c][i])
                now["bytes"] += len(columns["text"][i])
        if now is not None:
            close(now)
        if done:
            yield flush()

    return staged(placed.mapInArrow(
        cut, "conv string, part int, chunk long, symbols string, roles array<string>, texts array<string>, "
        "initials array<string>, " + ", ".join(f"{c} long" for c in _NUMBERS + _ENDS)), "conversation-segments")


def grammar(parts: DataFrame) -> Grammar:
    """Re-Pair over all segments.  What reaches the driver are the commonest pairs of a
    round, at most ``MAX_RULES``."""
    texts = staged(parts.groupBy("symbols").agg(F.count("*").alias("n")), "conversation-sequences")
    pairs: list[str] = []
    now = F.col("symbols")
    for _ in range(ROUNDS):
        places = F.when(F.length("s") > 1, F.sequence(F.lit(1), F.length("s") - 1)).otherwise(F.array())
        counts = (texts.select(now.alias("s"), "n")
                  .select("n", F.explode(F.transform(places, lambda i: F.substring("s", i, F.lit(2)))).alias("pair"))
                  .groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
                  .orderBy(F.desc("n"), "pair").limit(MAX_RULES).collect())
        lefts, rights, chosen = set(), set(), []
        for row in counts:
            a, b = row["pair"]
            if len(pairs) + len(chosen) < MAX_RULES and a not in rights and b not in lefts and a != b:
                lefts.add(a)
                rights.add(b)
                chosen.append(row["pair"])
            elif a == b and not chosen:                   # a run of one symbol has a round of its own
                chosen.append(row["pair"])
                break
        if not chosen or len(pairs) + len(chosen) > MAX_RULES:
            break
        for pair in chosen:
            now = F.replace(now, F.lit(pair), F.lit(chr(FIRST_RULE + len(pairs))))
            pairs.append(pair)
    return Grammar(pairs)


def matrices(parts: DataFrame, rules: Grammar) -> DataFrame:
    """Costs and ranks of every segment's matrix, 16 each (cost -1: no way).  Ranks order
    the audits that begin in one state."""
    def of(batches):
        import pyarrow as pa
        known: dict[str, tuple[list[int], list[int]]] = {}
        for batch in batches:
            costs, ranks = [], []
            for symbols in batch.column("symbols").to_pylist():
                if symbols not in known:
                    if len(known) >= 10_000:              # short segments only, see below
                        known.clear()
                    found = _numbers(rules.of(symbols))
                    if len(symbols) > 256:
                        costs.append(found[0])
                        ranks.append(found[1])
                        continue
                    known[symbols] = found
                costs.append(known[symbols][0])
                ranks.append(known[symbols][1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(costs, pa.list_(pa.int64())),
                 pa.array(ranks, pa.list_(pa.int8()))], [*names, "costs", "ranks"])

    names = ["conv", "part", "chunk", "initials", *_NUMBERS, *_ENDS]
    return parts.select(*names, "symbols").mapInArrow(
        of, "conv string, part int, chunk long, initials array<string>, "
        + ", ".join(f"{c} long" for c in _NUMBERS + _ENDS) + ", costs array<long>, ranks array<byte>")


def _numbers(m: Matrix) -> tuple[list[int], list[int]]:
    costs, ranks = [-1] * 16, [0] * 16
    for p in STATES:
        ends = sorted((m[p, q][1], q) for q in STATES if (p, q) in m)
        for n, (_, q) in enumerate(ends):
            costs[4 * p + q], ranks[4 * p + q] = m[p, q][0], n
    return costs, ranks


def _chain(steps) -> tuple[list[tuple[int, int]], int, str]:
    """First and last state of each of a conversation's segments, the cost, and the audit of
    the insertions at the end."""
    now = {0: (0, 0)}                   # state -> cost, rank among the states' audits
    back = []
    for costs, ranks in steps:
        ways = {}
        for p, (c, r) in now.items():
            for q in STATES:
                if costs[4 * p + q] >= 0:
                    way = (c + costs[4 * p + q], r, ranks[4 * p + q], p)
                    if q not in ways or way < ways[q]:
                        ways[q] = way
        order = sorted(ways, key=lambda q: ways[q][1:3])
        now = {q: (ways[q][0], order.index(q)) for q in ways}
        back.append(bytes(ways[q][3] if q in ways else 9 for q in STATES))
    # whole audits are compared: a state's rank, then the insertions that follow it
    end = insertions()
    cost, _, tail, q, _ = min((now[p][0] + end[p, e][0], now[p][1], end[p, e][1], p, e)
                              for p in now for e in ENDS if (p, e) in end)
    states = []
    for pointers in reversed(back):
        states.append((pointers[q], q))
        q = pointers[q]
    return states[::-1], cost, tail


def entries(found: DataFrame) -> DataFrame:
    """Per segment its first and last state, with the conversation's figures and the
    insertions at its end on the last one."""
    out = ("conv string, part int, chunk long, state int, goal int, n_segments long, tail string, gaps long, "
           "blank long, duplicate long, truncated long, illegal long, cost long")
    ordered = found.repartition("conv").sortWithinPartitions("conv", "part", "chunk")

    def chained(batches):
        import pyarrow as pa
        names = [x.split()[0] for x in out.split(", ")]
        schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()),
                            ("state", pa.int32()), ("goal", pa.int32()), ("n_segments", pa.int64()),
                            ("tail", pa.string()), *((c, pa.int64()) for c in names[7:])])
        rows, held = [], []

        def close():
            states, cost, tail = _chain([(s["costs"], s["ranks"]) for s in held])
            total = {c: sum(s[c] for s in held) for c in _NUMBERS}
            for a, b in zip(held, held[1:]):
                total["illegal"] += a["initials"][1] + b["initials"][0] not in ("su", "ua", "au")
                total["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
            low = [s["low_turn"] for s in held if s["low_turn"] is not None]
            gaps = held[-1]["last_turn"] - low[0] + 1 - total["turns"] if low else 0
            for i, (s, (p, q)) in enumerate(zip(held, states)):
                ending = i == len(held) - 1
                rows.append((s["conv"], s["part"], s["chunk"], p, q, len(held), tail if ending else "",
                             gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost))
            held.clear()

        def flush():
            done = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return done

        for batch in batches:
            for s in batch.to_pylist():
                if held and held[0]["conv"] != s["conv"]:
                    close()
                    if len(rows) >= 5000:
                        yield flush()
                held.append(s)
        if held:
            close()
        if rows:
            yield flush()

    return ordered.mapInArrow(chained, out)


def _repaired(symbols: str, roles: list[str], texts: list[str], audit: str, state: int, tail: str):
    """The repaired rows of a segment as ``role:text``."""
    row = 0
    for action in audit + tail:
        if action == "D":
            row += 1
            continue
        user = state in NEXT_USER
        if action == "I":
            yield "user:" if user else "assistant:"
        elif action == "R":
            yield f"{'user' if user else 'assistant'}:{texts[row]}"
            row += 1
        else:
            yield f"{roles[row]}:{texts[row]}"
            if symbols[row].lower() == "s":
                state, row = 1, row + 1
                continue
            row += 1
        state = NEXT_USER[state] if user else NEXT_ASSISTANT[state]


def pieces(parts: DataFrame, ways: DataFrame, rules: Grammar) -> DataFrame:
    """Per segment its audit, and the hash of its repaired text (conversations of one segment)
    or that text in pieces of about ``PIECE_BYTES``, each row after a line feed."""
    names = ["conv", "part", "chunk", "piece", "n_segments", "audit", "sha256", "body"]
    both = parts.select("conv", "part", "chunk", "symbols", "roles", "texts").join(
        ways.select("conv", "part", "chunk", "state", "goal", "n_segments", "tail"), ["conv", "part", "chunk"])

    def write(batches):
        import pyarrow as pa
        schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()), ("piece", pa.int64()),
                            ("n_segments", pa.int64()), ("audit", pa.string()), ("sha256", pa.string()),
                            ("body", pa.binary())])
        known: dict[str, Matrix] = {}
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                symbols = s["symbols"]
                m = known.get(symbols) or rules.of(symbols)
                if len(symbols) <= 256:
                    if len(known) >= 1000:
                        known.clear()
                    known[symbols] = m
                audit = m[s["state"], s["goal"]][1]
                lines = _repaired(symbols, s["roles"], s["texts"], audit, s["state"], s["tail"])
                head = (s["conv"], s["part"], s["chunk"])
                if s["n_segments"] == 1:
                    done = hashlib.sha256("\n".join(lines).encode()).hexdigest()
                    out.append((*head, 0, 1, audit + s["tail"], done, None))
                    continue
                body, n = bytearray(), 0
                for line in lines:
                    body += b"\n" + line.encode()
                    if len(body) >= PIECE_BYTES:
                        out.append((*head, n, s["n_segments"], "", None, bytes(body)))
                        body, n = bytearray(), n + 1
                out.append((*head, n, s["n_segments"], audit + s["tail"], None, bytes(body)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return staged(both.mapInArrow(
        write, "conv string, part int, chunk long, piece long, n_segments long, audit string, sha256 string, body binary")
        .select(*names), "conversation-pieces")


def hashed(long: DataFrame) -> DataFrame:
    """Audit and hash of conversations of several segments, streamed in order."""
    def run(batches):
        import pyarrow as pa
        now, audit, digest, begun, out = None, [], None, False, []

        def close():
            out.append((now, "".join(audit), digest.hexdigest()))

        for batch in batches:
            for conv, part, body in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "body"))):
                if conv != now:
                    if now is not None:
                        close()
                    now, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(part)
                digest.update(body if begun else body[1:])
                begun = begun or len(body) > 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)],
                                                 ["conv", "audit", "sha256"])
                out = []
        if now is not None:
            close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["conv", "audit", "sha256"])

    return staged(long.repartition("conv").sortWithinPartitions("conv", "part", "chunk", "piece")
                  .select("conv", "audit", "body").mapInArrow(run, "conv string, audit string, sha256 string"),
                  "conversation-hashes")


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Repairs the conversations of ``rows`` (conv_id, turn, role, text); one row for every
    conv_id of ``every``."""
    parts = segments(marked(rows))
    rules = grammar(parts)
    ways = staged(entries(matrices(parts, rules)), "conversation-entries")
    written = pieces(parts, ways, rules)
    short = written.filter("n_segments = 1").select("conv", "audit", "sha256")
    texts = short.unionByName(hashed(written.filter("n_segments > 1")))
    figures = ways.groupBy("conv").agg(
        *(F.first(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")))
    whole = (every.select("conv_id").distinct().withColumn("conv", _key(F.col("conv_id")))
             .join(figures, "conv", "left").join(texts, "conv", "left"))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
               for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair(damaged(told), told)
