import collections
import random
import re

import numpy as np
import pytest

from bankmart.llm import decontaminate, jaccard_join, repeats
from tests.llm.helpers import documents, texts, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components_of(rows):
    """Brute force: every pair, then the smallest reachable doc_id."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for (d, _), c in zip(rows, label):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return collections.Counter((d, len(s), least.get(c)) for (d, _), s, c in zip(rows, sets, label))


@pytest.mark.parametrize("frequent", [2, 8])
def test_jaccard_components_equal_all_pairs(spark, frequent):
    docs = documents(spark)
    got = jaccard_join.jaccard_components(docs, frequent=frequent)["classes"].collect()
    want = components_of([(r.doc_id, r.text) for r in docs.collect()])
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_empty_table_and_one_of_each(spark):
    empty = documents(spark, [])
    assert jaccard_join.jaccard_components(empty)["classes"].count() == 0
    docs = documents(spark)
    kept = jaccard_join.one_of_each(docs)
    want = components_of([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in want}
    assert kept.columns == docs.columns


def test_different_texts_under_one_id_stay(spark):
    """Near copies and leaks are rows, not doc_ids; a null doc_id names no document."""
    rng = random.Random(9)
    a, b, c, d, leak = (words(rng, 60) for _ in range(5))
    rows = [(5, a), (5, b), (5, b), (5, leak), (2, a + " more"), (None, c), (None, d), (None, d), (None, leak),
            (7, d), (None, ""), (None, None), (5, "")]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])

    def texts_of(df):
        return collections.Counter((r.doc_id, r.text) for r in df.collect())

    kept = jaccard_join.one_of_each(docs)
    assert texts_of(kept) == collections.Counter(
        [(5, b), (5, leak), (2, a + " more"), (None, c), (7, d), (None, ""), (None, None), (5, "")])
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    assert texts_of(decontaminate.without_leaks(docs, items)) == collections.Counter(x for x in rows if x[1] != leak)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for n in list(range(1, 40)) + [100, 333]:
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        gone = (n - 1) // 4
        while gone and (n - gone) * 4 < 3 * n:
            gone -= 1
        y = np.delete(x, rng.choice(len(x), gone, replace=False))
        frequent = np.sort(x >> np.uint64(24))          # the worst case: all are frequent
        for f in (frequent, frequent[::2], frequent[:0]):
            a, b = (jaccard_join.signatures(s, f)[0] for s in (x, y))
            assert len(np.intersect1d(a, b)) or len(x) == len(y), n


def test_last_round_makes_a_pair_once(spark):
    """Sets that share many buckets make a pair in few of them, and none is lost."""
    rng = np.random.default_rng(8)
    keys = rng.integers(-2**63, 2**63, 200)
    held = {sid: np.sort(rng.choice(keys, rng.choice([1, 3, 60, 150]), replace=False)) for sid in range(40)}
    after = {(sid, int(k)): 599 - i for sid, own in held.items() for i, k in enumerate(sorted(own, key=lambda k: int(k) % 2**64))}
    entries = spark.createDataFrame(
        [(k, sid, 600, at, sid % 35, [0] * jaccard_join.PARITY_WORDS) for (sid, k), at in after.items()],
        "key long, sid long, n long, after long, component long, parity array<long>")
    made = collections.Counter((r.a, r.b) for r in jaccard_join.last_pairs(
        entries.join(jaccard_join._landmarks(entries), "sid"), 4).collect())
    # buckets in which the positions let two sets of 600 shingles share 515 of them
    shared = {(a, b): sum(min(after[a, k], after[b, k]) >= 514 for k in np.intersect1d(held[a], held[b]).tolist())
              for a in held for b in held if a < b and a % 35 != b % 35}
    assert made.keys() == {p for p, n in shared.items() if n}
    assert sum(made.values()) < sum(shared.values()) / 5
    assert all(made[p] == 1 for p, n in shared.items() if n >= 60)


def item_words(t):
    return [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if x]


def windows(t):
    w = item_words(t)
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def test_leaks_equal_every_window(spark):
    rng = random.Random(11)
    items = [(i, words(rng, n)) for i, n in enumerate([12, 20, 33, 50, 21, 2, 60])] + [
        (7, None), (8, ""), (None, words(rng, 15)), (9, "x y x y x y x y x y x y")]
    rows = list(enumerate(texts()))
    for d, (_, t) in enumerate(items, 100):
        w = (t or "").split()
        rows.append((d, f"{words(rng, 10)} {' '.join(w).upper()}; {words(rng, 7)}"))
        for cut in (1, 2, 5):
            v = list(w)
            for _ in range(min(cut, len(v) // 3)):
                v[rng.randrange(len(v))] = "changed"
            rows.append((d + 20 * cut, f"{words(rng, 30)} {' '.join(v)}"))
        rows.append((d + 200, " ".join(w[len(w) // 8:])))
    docs = documents(spark, [(d, t, "en", "a") for d, t in rows])
    table = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, size int")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(docs, table).collect()}
    want = {}
    for d, t in rows:
        s = windows(t)
        for i, x in items:
            item = windows(x)
            if not item or not s:
                continue
            if len(item_words(x)) < 5:                   # its words in a row
                w, k = item_words(t), item_words(x)
                best = float(any(w[p:p + len(k)] == k for p in range(len(w))))
            else:
                c, m, best = collections.Counter(item), len(item), 0.0
                for p in range(len(s)):
                    own = collections.Counter(s[p:p + m])
                    both = sum((own & c).values())
                    best = max(best, both / (sum(own.values()) + m - both))
            if best >= 0.75:
                want[d, i] = max(best, want.get((d, i), 0))
    assert got.keys() == want.keys()
    assert [(k, got[k], want[k]) for k in want if abs(got[k] - want[k]) > 1e-9] == []
    gone = {d for d, _ in want}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, table).collect()} == {d for d, _ in rows} - gone
    assert decontaminate.leaks(docs, table.limit(0)).count() == 0
    assert decontaminate.leaks(documents(spark, []), table).count() == 0


def test_short_items_at_the_threshold(spark):
    """Items of 7 to 10 shingles with one end changed: (m - 1) / (m + 1) >= 0.75."""
    rng = random.Random(3)
    items = [(i, words(rng, 11 + i % 4)) for i in range(400)]
    rows = [(i, f"{words(rng, 9)} {t.rsplit(' ', 1)[0]} changed {words(rng, 9)}") for i, t in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity
           for r in decontaminate.leaks(documents(spark, [(d, t, "en", "a") for d, t in rows]), table).collect()}
    assert got == {(i, i): pytest.approx((6 + i % 4) / (8 + i % 4)) for i, _ in items}


def test_nested_short_items_and_null_documents(spark):
    """Items of one to five words that begin at the same word, and longer ones among them."""
    rng = random.Random(6)
    items, rows = [], []
    for f in range(30):
        w = words(rng, 5).split()
        w = [f"{x}{f}" for x in w]
        items += [(10 * f + n, " ".join(w[:n])) for n in range(1, 6)]
        items.append((10 * f + 6, " ".join([*w, *words(rng, 2).split(), *w, *words(rng, 3).split()])))
        rows += [(None if f % 3 == 0 else f, f"{words(rng, 6)} {' '.join(w[:n])} {words(rng, 6)}") for n in range(1, 6)]
        rows.append((100 + f, f"{words(rng, 6)} {items[-1][1]}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, [(d, t, "en", "a") for d, t in rows])
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, table).collect())
    want = collections.Counter()
    for d, t in rows:
        for i, x in items:
            want[d, i] += f" {x} " in f" {t} "
    assert got == +want


@pytest.mark.parametrize("crowded", [10_000, 3])
def test_repeats_equal_brute_force(spark, crowded):
    docs = documents(spark)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                              repeats.without_repeats(docs, 50, crowded).collect())
    rows = sorted(docs.selectExpr("doc_id", "text", "xxhash64(text) as mark").collect(),
                  key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.mark))
    seen, want = set(), collections.Counter()
    for r in rows:
        body = (r.text or "").encode()
        gone = bytearray(len(body))
        for j in range(len(body) - 99):
            if body[j:j + 100] in seen:
                gone[j:j + 100] = b"\1" * 100
            seen.add(body[j:j + 100])
        spans = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        want[r.doc_id, len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)] += 1
    assert got == want
    assert repeats.without_repeats(documents(spark, [])).count() == 0


def test_run_length_index_matches():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(3, 5, 200), [0], rng.integers(3, 5, 150), [1], np.full(90, 3), [2]])
    order, match = repeats.run_length_index(text)
    suffixes = [tuple(text[i:]) for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=lambda i: suffixes[i])
    for k in range(1, len(text)):
        a, b = suffixes[order[k]], suffixes[order[k - 1]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert match[k] == same


def test_long_texts_full_of_hits_run_in_fixed_memory(spark):
    """A one-word item and a long item over texts of 10,000 and 300,000 words."""
    rng = random.Random(12)
    known = [words(rng, 1) for _ in range(400)]
    item = " ".join(rng.choice(known) for _ in range(700))
    long = ["zz"] * 10_000
    longer = [rng.choice(("zz", "yy")) for _ in range(300_000)]
    middle = [rng.choice(known) for _ in range(3000)]
    middle[1700:1700] = item.split()
    docs = documents(spark, [(1, " ".join(long), "en", "a"), (2, " ".join(longer), "en", "a"),
                                     (3, " ".join(middle), "en", "a"), (4, "yy " * 50, "en", "a")])
    items = spark.createDataFrame([(1, "zz"), (2, item), (3, "zz zz zz"), (4, "zz " * 200)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.leaks(docs, items).collect()}
    first = next(i for i in range(300_000) if longer[i:i + 3] == ["zz"] * 3)
    assert got == {(1, 1): (1.0, 0), (1, 3): (1.0, 0), (1, 4): (1.0, 0), (2, 1): (1.0, longer.index("zz")),
                   (2, 3): (1.0, first), (3, 2): (1.0, 1700)}


def test_contexts_are_counted_once_per_batch():
    own = np.array([7, 7, 5, 7, 7, 9], np.int64)
    anchor = np.array([1, 1, 1, 2, 1, 3], np.int64)
    doc = np.array([4, 3, 3, 3, 3, 3], np.int64)
    start = np.array([0, 8, 0, 0, 8, 2], np.int64)
    # (1, 7): document 3 comes before 4; its row comes twice
    assert repeats.batch_copies(anchor, own, doc, doc * 0, start).tolist() == [0, 2, 1, 1, -1, 1]


def test_text_hashes_order_repeated_doc_ids_only(spark):
    rows = [(1, "a", None, None), (2, "b", None, None), (None, None, None, None)]
    texts_, repeated = repeats._placed(documents(spark, rows))
    assert not repeated and {r.mark for r in texts_.collect()} == {0}
    texts_, repeated = repeats._placed(documents(spark, [*rows, (2, "c", None, None)]))
    assert repeated and len({r.mark for r in texts_.collect()}) == 4
