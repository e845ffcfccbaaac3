from __future__ import annotations

import corpus_pipeline as cp
from bankmart.llm import queries
from bankmart.llm.common import table, written
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_pack import check

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in cp.STAGES[:-1]:
        docs.append(written(stage(spark, docs[-1], SF), name))
        assert docs[-1].schema.simpleString() == docs[0].schema.simpleString()
    raw, safe, cut, single, clean = [{r.doc_id: r for r in d.collect()} for d in docs]
    toxic = {r.doc_id for r in queries.op6_toxicity(spark, SF).collect() if r.predicted}
    assert set(safe) == set(raw) - toxic
    rows = [(i, safe[i].text) for i in sorted(safe)]
    texts = {i: t for (i, old), t in zip(rows, brute_lines(rows, 50)) if t == old or (t or "").strip()}
    assert {i: r.text for i, r in cut.items()} == texts and all(r.n_chars == len(r.text) for r in cut.values())
    groups = brute_groups([(i, r.text) for i, r in cut.items()], 5, 80)
    assert len(single) == len({c for _, _, c in groups}) == len({c for i, _, c in groups if i in single})
    leaking = {r.doc_id for r in queries.op5_decontaminate(spark, SF).collect()}
    assert set(clean) <= set(single) and set(single) - set(clean) <= leaking
    check(cp.run(spark, SF).collect(), [(i, r.text) for i, r in clean.items()])


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "alone here", None, "s", 10), (3, "same words in a row here", "en", "s", 24),
            (3, "same words in a row here", "en", "s", 24), (4, "long " * 40000, "en", "s", 200000)]
    docs = spark.createDataFrame(rows, schema).withColumn("label", cp.F.lit("x"))
    for _, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "edge")
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 2, 3, 4, None]
    assert docs.columns[-1] == "label"
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).collect() == []
