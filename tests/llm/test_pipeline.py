import zlib

import numpy as np

import corpus_pipeline
from bankmart.llm import token_files
from bankmart.llm.common import documents, staged
from tests.llm.helpers import documents as small_documents
from tests.llm.test_pairs import components_of

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    from tokenizers import Tokenizer
    docs = documents(spark, SMALL)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SMALL), name))
    assert all(d.columns == list(corpus_pipeline.COLUMNS) for d in kept[1:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert ids[1] == letters
    want = components_of([(r.doc_id, r.text) for r in kept[1].collect()])
    assert ids[2] == {c for _, _, c in want}
    assert ids[3] <= ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]
    tk = Tokenizer.from_file(token_files.default_tokenizer())
    want = sorted((r.doc_id, zlib.crc32(np.array([*tk.encode(r.text, add_special_tokens=False).ids, 2], "<u4").tobytes()))
                  for r in kept[4].collect())
    assert sorted((r.doc_id, r.ids_crc32) for r in kept[5].collect()) == want
    assert sorted((r.doc_id, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()) == want


def test_unlabelled_texts_stay(spark):
    """Without a labelled row the language stage keeps every text with letters."""
    rows = [(i, t, None, "a") for i, t in enumerate(["one two", "é", "!!!", "", None, "12", "три"])]
    kept = corpus_pipeline.known_language(spark, small_documents(spark, rows), SMALL)
    assert {r.doc_id for r in kept.collect()} == {0, 1, 6}


def test_a_text_is_judged_once(spark):
    """The filter on the verdict and the filled language share one run of the judge."""
    rows = [(i, t, lang, "a") for i, (t, lang) in enumerate([
        ("one two three", "en"), ("eins zwei drei", "de"), ("one three", None), ("zwei drei", None), ("!!!", None), (None, None)])]
    known = corpus_pipeline.known_language(spark, small_documents(spark, rows), SMALL)
    assert known._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    assert {r.doc_id: r.lang for r in known.collect()} == {0: "en", 1: "de", 2: "en", 3: "de"}


def test_registered_queries():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
