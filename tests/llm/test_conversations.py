"""Conversation repair against a brute-force search over whole audits."""

import hashlib
import random
import re
import zlib
from collections import Counter

from bankmart.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, state int, uid long"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = [" " if x is None else x for x in (role, text)]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Best audit by a search that knows no states: partial results by their role initials' tail."""
    best = {"": (0, "", "")}                                  # initials -> cost, audit, text

    def shorter(initials):                                    # what the rest of the pattern depends on
        return initials if len(initials) < 2 else initials[-1] + "."

    def put(into, initials, entry):
        if not re.match(r"s?(ua)*u?\Z", initials):
            return
        key = shorter(initials)
        if key not in into or entry[:2] < into[key][1][:2]:
            into[key] = (initials, entry)

    def inserted(now):
        for _ in range(3):
            for initials, (cost, audit, text) in list(now.values()):
                for role in ("user", "assistant"):
                    put(now, initials + role[0], (cost + 3, audit + "I", text + f"\n{role}:"))
        return now

    now = {"": ("", (0, "", ""))}
    for (_, _, role, text), kind in zip(rows, kinds):
        now, after = inserted(now), {}
        for initials, (cost, audit, done) in now.values():
            put(after, initials, (cost + 4, audit + "D", done))
            if kind in ("blank", "duplicate"):
                continue
            more = 3 if kind == "truncated" else 0
            put(after, initials + role[:1], (cost + more, audit + "K", done + f"\n{role}:{text}")) if role else None
            for new in ("user", "assistant"):
                put(after, initials + new[0], (cost + more + 3, audit + "R", done + f"\n{new}:{text}"))
        now = after
    cost, audit, text = min(e for i, e in inserted(now).values() if LEGAL.match(i))
    return cost, audit, hashlib.sha256(text[1:].encode()).hexdigest()


def brute(told):
    out = {}
    rows = damage(told)
    for conv in {r[0] for r in told}:
        mine = [r for r in rows if r[0] == conv]

        def order(r):
            digest = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
            return (r[1] is not None, r[1] or 0, r[2].encode(), digest)

        mine.sort(key=order)
        kinds = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        count = Counter(kinds)
        cost, audit, digest = cheapest(mine, kinds)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def answer(df):
    rows = df.collect()
    found = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"],
                            r["audit"], r["repaired_sha256"]) for r in rows}
    assert len(found) == len(rows)
    return found


def awkward(seed, convs=60, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "", " \t", None, "Why? ", "…", "x" * 300 + ".", "line\nline.\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "System", "ua"]
    rows = []
    for conv in [*range(convs), None]:
        for i in range(rng.randint(1, longest)):
            turn = rng.choice([i, i, i, i, i + 2, None, rng.randint(0, 5)])
            role = roles[i % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows + rows[:3] + [(7, 3, "user", "same.")] * 5


def run(spark, rows):
    told = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    return conversations.repair(conversations.damaged(told), told)


def test_equals_brute_force(spark):
    rows = awkward(3)
    assert answer(run(spark, rows)) == brute(rows)


def test_long_conversation_in_many_segments(spark, monkeypatch):
    """A conversation with most rows spans segments and tasks; ties across them are kept."""
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", 7)
    monkeypatch.setattr(conversations, "PIECE_BYTES", 64)
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant", "system", "tool"]),
             rng.choice(["a.", "b", "", f"t{i}."])) for i in range(900)]
    rows += awkward(9, 20)
    assert answer(run(spark, rows)) == brute(rows)


def test_empty_table_and_lost_conversations(spark):
    assert run(spark, []).count() == 0
    gone = [(c, t, "user", "x.") for c in range(400) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    assert set(answer(run(spark, gone)).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    told = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert answer(conversations.op13(spark, folder)) == brute(told)


def test_rules_shorten_sequences_without_changing_them(spark):
    sequences = ["ua" * 40, "sua" + "ua" * 9, "uuda" * 5, "d"]
    parts = spark.createDataFrame([(s,) for s in sequences * 3], "symbols string")
    rules = conversations.grammar(parts)
    assert 0 < len(rules.pairs) <= conversations.MAX_RULES
    plain = conversations.Grammar([])
    for s in sequences:
        assert rules.of(s) == plain.of(s)
    assert len(rules.compress(sequences[0])) < 6
