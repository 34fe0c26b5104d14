"""Quality rules against a plain re-count, policies and ablations."""

import random
import re
from collections import Counter

from bankmart.llm import quality_rules as Q
from tests.llm import helpers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def count(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    bare = [x.strip(" \t\r\x0b\x0c") for x in lines]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)),
            len(hit), sum(bool(re.search("[A-Za-z\x80-\U0010FFFF]", x)) for x in w),
            sum(x.startswith(("-", "*", "•")) for x in bare), sum(x.endswith(("...", "…")) for x in bare))


def texts():
    rng = random.Random(4)
    line = helpers.words(rng, 12)
    return helpers.texts() + [
        "\n".join([line] * 6), (helpers.words(rng, 8) + " ") * 5, " ".join("abcdefgh" * 3),
        "- " + "\n- ".join(helpers.words(rng, 4) for _ in range(9)), "wait ...\nfor it…\n so\n", "## | $$ %%% " * 12,
        "1234 5678 " * 15, f"{line} x {line}", "a b c d e f g h a b c d e f g h", "ab " * 300_000, "\n\n \n", "\x00 x\x01y"]


def test_measurements_equal_a_plain_count(spark):
    rows = [(i, t, None, None) for i, t in enumerate(texts())]
    found = {r["doc_id"]: tuple(r[m] for m in Q.MEASURES)
             for r in Q.measurements(helpers.documents(spark, rows)).collect()}
    assert found == {i: count(t) for i, t, _, _ in rows}


def test_policies_and_ablation_from_the_ledger(spark):
    rows = Q.ledger(helpers.documents(spark, [(i, t, None, None) for i, t in enumerate(texts())])).cache()
    names = list(Q.RULES)
    assert Q.mask("few_words", "symbols") == 1 | 4
    for policy in (*Q.POLICIES.values(), Q.Policy("t", Q.mask("symbols"), Q.mask(*names[3:]), 0)):
        failed = [r["failed"] for r in rows.collect()]

        def drops(mask, hard, soft):
            return bool(mask & hard) or bin(mask & soft).count("1") > policy.soft_allowed

        kept = [r["kept"] for r in Q.apply_policy(rows, policy).collect()]
        assert kept == [not drops(m, policy.hard, policy.soft) for m in failed]
        for r in Q.ablation(rows, policy).collect():
            bit = 1 << names.index(r["rule"])
            dropped = [m for m in failed if drops(m, policy.hard, policy.soft)]
            assert r["n_failed"] == sum(bool(m & bit) for m in failed)
            assert r["n_dropped"] == sum(bool(m & bit) for m in dropped)
            assert r["n_only"] == sum(not drops(m, policy.hard & ~bit, policy.soft & ~bit) for m in dropped)


def test_defined_cases(spark):
    judged = Q.judge(helpers.documents(spark)).collect()
    assert len(judged) == helpers.documents(spark).count()
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert Q.judge(helpers.documents(spark, [])).count() == 0
    assert Q.ablation(Q.ledger(helpers.documents(spark, [])), Q.POLICIES["v2"]).filter("n_failed > 0").count() == 0


def test_clean_documents_are_kept(spark):
    rng = random.Random(1)
    docs = [(i, ". ".join(helpers.words(rng, 9).capitalize() for _ in range(rng.randint(4, 40))), None, None)
            for i in range(60)]
    assert Q.judge(helpers.documents(spark, docs)).filter("kept").count() == 60
