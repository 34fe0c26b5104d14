import collections
import math
import re
import zlib

import numpy as np
import pytest

from bankmart.llm import knn, language, language_model, licenses, mixing, token_files, url_rules
from bankmart.llm.common import open_fs, release_memory
from tests.llm.helpers import documents, texts


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    docs = documents(spark)
    manifest = token_files.write_tokens(docs, partitions=3)
    got = token_files.read_tokens(manifest).orderBy("start").collect()
    tk = Tokenizer.from_file(token_files.default_tokenizer())
    rows = docs.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()
    start = 0
    for r, want in zip(got, sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))):
        ids = np.array([*tk.encode(want.text, add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (want.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
    one = token_files.read_tokens(manifest, wanted=[5]).collect()
    assert [r.doc_id for r in one] == [5]
    fsys, path = open_fs(one[0].shard)
    reader = token_files.ShardReader(fsys, path)
    assert zlib.crc32(reader.read(one[0].frame)) == one[0].ids_crc32
    with fsys.open_input_stream(path) as f:
        raw = bytearray(f.read())
    raw[int(reader.at[one[0].frame]) + 10] ^= 1
    with fsys.open_output_stream(path + ".bad") as f:
        f.write(bytes(raw))
    with pytest.raises(Exception):
        token_files.ShardReader(fsys, path + ".bad").read(one[0].frame)
    assert token_files.read_tokens(token_files.write_tokens(documents(spark, []))).count() == 0


def test_token_memo_keeps_a_million_chunks_until_released():
    path = token_files.default_tokenizer()
    memo = token_files._MEMO.setdefault(path, {})
    memo.clear()
    memo.update((b"%d-" % i, b"") for i in range(600_000))
    token_files.encode_ids(["one two"], path, 2)
    assert len(memo) > 600_000
    release_memory()
    assert not token_files._MEMO


def test_token_chunks_equal_whole_texts():
    from tokenizers import Tokenizer
    path = token_files.default_tokenizer()
    tk = Tokenizer.from_file(path)
    odd = ["É é É", "H\u0331. h\u0331", "İ... x", "<|endoftext|> <|ENDOFTEXT|>", "don't we'LL's",
           "a\x1cb\x85c\xa0d", "Σς Σ.", "12 3a4", "…!! x…", "日本 한국", "\u0300 \ufeff a\u200db", "ab" * 100]
    for t, b in zip(odd, token_files.encode_ids(odd, path, 2)):
        assert np.frombuffer(b, "<u4").tolist() == [*tk.encode(t, add_special_tokens=False).ids, 2], t


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), i) for i in range(400)]
    rows += [(i, [0.5] * 8, 1) for i in range(400, 700)]                 # one vector very often
    rows += [(1000, None, 1), (1050, [float("nan")] * 8, 1), (1100, [None] * 8, 1), (1150, [], 1),
             (None, [1.0] * 8, 1), (50, [0.1] * 8, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in knn.top_k(table, n_pivots=9, group_queries=4, block_rows=60)
           .orderBy("query_id", "rank", "vec_id").collect()]
    ok = [(i, np.floor(np.array(v) * 256).astype(int)) for i, v, _ in rows
          if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    by_id = collections.defaultdict(list)
    for q, x in ok:
        if q % 50 == 0:
            by_id[q].append(sorted((-int(x @ v), i) for i, v in ok if i != q)[:5])
    for q in sorted(by_id):
        best = sorted(s for part in by_id[q] for s in part)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert [w for w in got if w[0] != 50] == [w for w in want if w[0] != 50]
    assert [(w[0], w[1], w[3]) for w in got] == [(w[0], w[1], w[3]) for w in want]
    assert knn.top_k(table.limit(0)).count() == 0


def test_top_k_within_one_small_cell(spark):
    """All five neighbours of each query lie in its own cell of ten rows."""
    rng = np.random.default_rng(8)
    rows = []
    for c in range(6):
        centre = rng.normal(size=8) * 100
        rows += [(50 * c + j, (centre + rng.normal(size=8)).tolist()) for j in range(10)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in knn.top_k(table, n_pivots=60).orderBy("query_id", "rank").collect()]
    whole = {i: np.floor(np.array(v) * 256).astype(int) for i, v in rows}
    want = []
    for q in range(0, 300, 50):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == want
    one_cell = [tuple(r) for r in knn.top_k(table, n_pivots=1).orderBy("query_id", "rank").collect()]
    assert one_cell == want


def test_language_model_equals_counts(spark):
    docs = documents(spark)
    train = docs.doc_id.isNotNull() & (docs.doc_id % 4 != 0)
    trie = language_model.train(docs, train, order=3)
    got = language_model.score(docs, trie).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b"\0end"]
    grams = [collections.Counter() for _ in range(3)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for d, t in rows:
        if d is not None and d % 4:
            w = tokens(t)
            for k in range(3):
                grams[k].update(tuple(w[i:i + k + 1]) for i in range(len(w) - k))
    n, v = sum(grams[0].values()), len(grams[0])
    after = [collections.defaultdict(list) for _ in range(3)]
    discount = [0, 0, 0]
    for k in (1, 2):
        for g, c in grams[k].items():
            after[k][g[:-1]].append(c)
        once, twice = (sum(c == x for c in grams[k].values()) for x in (1, 2))
        discount[k] = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
    want = []
    for d, t in rows:
        w, base, score = tokens(t), 0.0, 0.0
        for i, x in enumerate(w):
            p = (grams[0][x,] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            for k in (1, 2):
                c = tuple(w[i - k:i]) if i >= k else None
                if c in after[k]:
                    total = sum(after[k][c])
                    p = (max(grams[k][(*c, x)] - discount[k], 0) + discount[k] * len(after[k][c]) * p) / total
            score += math.log10(p)
        want.append((d, len(w), sum(grams[0][x,] > 0 for x in w), n, base, score))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, x in zip(sorted((tuple(r) for r in got), key=key), sorted(want, key=key)):
        assert g[:4] == x[:4] and abs(g[4] - x[4]) < 1e-6 * (1 + abs(x[4]))
        assert abs(g[5] - x[5]) <= 0.02 * x[1]           # one byte per probability
    none = language_model.train(docs, docs.doc_id < 0)
    assert {(r.train_tokens, r.base_score, r.score) for r in language_model.score(docs, none).collect()} == {(0, 0.0, 0.0)}
    level = trie.level(2, 0)
    assert level.successors(0)[0] == 0 and level.pointers.n > 1


def test_elias_fano_finds_all():
    rng = np.random.default_rng(2)
    for n, u in ((0, 10), (1, 1), (500, 600), (500, 10**12), (4000, 2**40)):
        v = np.unique(rng.integers(0, u, n, dtype=np.uint64)) if n else np.empty(0, np.uint64)
        if n > 1000:
            v = np.unique(np.concatenate([v, np.arange(10**6, 10**6 + 900, dtype=np.uint64)]))   # a dense stretch
        e = language_model.EliasFano(language_model.ef_encode(v, u))
        assert e.find(v).tolist() == list(range(len(v)))
        if n:
            assert (e.access(np.arange(len(v))) == v).all()
            probe = rng.integers(0, u, 300, dtype=np.uint64)
            assert ((e.find(probe) >= 0) == np.isin(probe, v)).all()


URLS = ["http://a.net/x", "https://A.NET", "http://a.b.example.net/en/1?q=http://x.org/", "ftp://example.com/de/",
        "http://example.com/de", "http://notexample.com/de/x", "x.org/fr/", "http://x.org/fr/a#b", "http://org/fr/",
        None, "", "://", "http://www.cheap-pills.com/", "http://ads.example.org/en", "http://a.org/b.exe", "http://a.org/B.EXE",
        "http://x.com/banner/1", "http://casino.org/robots.txt", "a://b://c.net/", "http://ünï.net/é", "http://xads.org/"]


def test_url_rules_equal_sql(spark):
    import duckdb
    pages = spark.createDataFrame([(i % 19, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = collections.Counter(tuple(r) for r in url_rules.judge(pages).collect())
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas())
    want = collections.Counter(con.sql(url_rules.op5_sql()).fetchall())
    assert got == want
    assert {r[3] for r in got} >= {"net/", "example.net/en/", "example.com/de/", "org/fr/", None}
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_license_places_equal_scan(spark):
    rows = list(enumerate(texts())) + [
        (50, "CC BY, cc-by cc by"), (51, "the GNU General Public License. All rights reserved"), (52, "ccby cc  BY-nc"),
        (53, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation"), (54, "all rights reserved " * 40), (55, "cc éby cc by"), (56, "K cc\nby")]
    docs = documents(spark, [(d, t, "en", "a") for d, t in rows] + [(None, "cc by", None, None), (50, "cc by", None, None)])
    got = {(r.doc_id, r.n_words, r.n_base): r for r in licenses.scan(docs)["summary"].collect()}
    for d, t in [*rows, (None, "cc by"), (50, "cc by")]:
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) if x]
        at = {(i, label) for phrase, label in licenses.BASE for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()}
        r = got[d, len(w), len(at)]
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert got[53, 19, 0].labels == "mit" and got[53, 19, 0].score >= 0.75
    assert licenses.scan(documents(spark, []))["summary"].count() == 0


def test_mixing_targets_and_copies(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 60)), "en", "aab"[i % 3] if i % 10 else "rare") for i in range(900)]
    rows += [(None, "x y", None, None), (5, None, None, "b"), (7, "same", None, "b"), (7, "same", None, "b")]
    docs = documents(spark, rows)
    plan = mixing.mixing_plan(docs).collect()
    again = mixing.mixing_plan(docs.repartition(5)).collect()
    key = lambda p: sorted((r.doc_id or -1, r.mark, r.copies) for r in p)
    assert len(plan) == len(rows) and key(plan) == key(again)
    size = collections.Counter()
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, total, target = set(order), float(sum(size.values())), {}
    while left:
        share = {s: total * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * size[s]}
        target.update({s: 3.0 * size[s] for s in over} if over else share)
        total -= sum(3.0 * size[s] for s in over)
        left = left - over if over else set()
    taken = collections.Counter()
    for r in plan:
        assert abs(r.target - target[r.source]) < 1e-6 * (1 + r.target) and r.source_size == size[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 60 for s in order)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.copies for r in plan)
    assert mixing.mixing_plan(documents(spark, [])).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs, language.in_training(docs.doc_id))
    rows = language.identify(docs.filter(~language.in_training(docs.doc_id)), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    odd = language.identify(documents(spark), model).collect()
    assert {r.lang_pred for r in odd if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert all(0 <= r.score <= 1 and r.lang_pred in {*model.langs, "und"} for r in odd)
    nothing = language.fit(docs.limit(0), language.in_training(docs.doc_id))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(documents(spark, []), model).count() == 0


def test_mix_is_a_function_of_its_own_columns(spark):
    """Other columns change no copies, and may have any name and type."""
    from pyspark.sql import functions as F
    rows = [(i, "w " * (i % 17), None, ["a", "b", None][i % 3]) for i in range(60)] + [(5, "again", None, "a")] * 3
    docs = documents(spark, rows)
    more = (docs.withColumn("_place", F.lit(1)).withColumn("_copy", F.col("doc_id")).withColumn("_mark", F.lit("m"))
            .withColumn("mark", F.lit(2)).withColumn("copies", F.lit(9)).withColumn("place", F.lit(0))
            .withColumn("t", F.create_map(F.lit("a"), F.lit(1))).withColumn("a.b", F.lit(3)))

    def plan(d):
        return sorted(map(str, mixing.mixing_plan(d).select("doc_id", "size", "target", "copies").collect()))

    assert plan(more) == plan(docs)
    a, b = mixing.mixed(docs), mixing.mixed(more)
    assert b.columns == more.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(docs.columns).collect()))
    assert all(r["t"] == {"a": 1} and r["_mark"] == "m" and r["mark"] == 2 for r in b.collect())


def test_url_tokens_are_read_off_the_pattern(spark):
    """Every token of an alternative is a whole token of each URL that it matches."""
    tokens = url_rules.literal_tokens
    assert tokens(r"(?s)^(?:[^/]*\.)?ads?\.") == [("ad",), ("ads",)]
    assert tokens(r"/tracking/pixel") == [("tracking",)]
    assert tokens(r"\.exe$") == [("exe",)] and tokens(r"\bCheap-pills\b") == [("cheap", "pills")]
    assert tokens(r"/(?:a|bc)+x/") == [()] and tokens(r"/(a|bc)/d[0-9]*/") == [("a",), ("bc",)]
    assert tokens(r"foo") == [()] and tokens(r"/foo") == [()] and tokens(r"/[^a-z0-9]foo-bar/") == [("bar",)]
    assert tokens(r"/foo[-_]+bar/") == [("bar", "foo")] and tokens(r"/foo[-_]*bar/") == [()]
    assert tokens(r"(?=x)/a\Bb/") == [()] and tokens(r"/\d/q/") == [("q",)] and tokens(r"(?<n>java") == [()]
    rng = np.random.default_rng(3)
    parts = ["ad", "ads", "x", "banner", "tracking", "/", ".", "-", "_", "casino", "exe", "é", "1", "robots", "txt"]
    urls = ["".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(3000)]
    for rule in url_rules.HOST_RULES + url_rules.PATTERN_RULES:
        pattern = url_rules.host_pattern(rule.text) if rule.kind == "host" else rule.text
        choices = [set(t) for t in tokens(pattern)]
        assert all(choices), rule
        for u in urls + [u + "example.net/en/" for u in urls[:200]]:
            if re.search(pattern, u):
                have = set(re.findall("[a-z0-9]+", u.lower()))
                assert any(c <= have for c in choices), (rule, u)


def test_dirty_labels_stay_bounded(spark):
    """Labels beyond the commonest are not learned; the vote equals a plain count of duels."""
    rows = [(i, "the and of " * 5, "en", "a") for i in range(30)] + [(100 + i, "der die das " * 5, "de", "a") for i in range(30)]
    rows += [(200 + i, "la que el " * 5, "es", "a") for i in range(20)]
    rows += [(1000 + i, f"junk{i} text", f"x{i}", "a") for i in range(300)]
    docs = documents(spark, rows)
    model = language.fit(docs, docs.doc_id >= 0, per_language=10, languages=3, rows=24)
    assert model.langs == ["de", "en", "es"]
    assert language.fit(docs, docs.doc_id >= 0, languages=5).langs == ["de", "en", "es", "x0", "x1"]
    for text in [r[1] for r in rows[:90:7]] + ["the der la", "zzz"]:
        x = language.features(text)

        def vote(names, machines):
            wins = collections.Counter({n: 0 for n in names})
            for a, b, w, bias in machines:
                wins[a if float(x @ w) + bias >= 0 else b] += 1
            return {n for n in names if wins[n] == max(wins.values())}

        group = language.family(model.predict(text)[0])
        assert group in vote(list(model.families), model.between)
        assert model.predict(text)[0] in vote(model.families[group], model.within[group])
