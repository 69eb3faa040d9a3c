from collections import Counter

import public_tokenizers
from helpers import groups, removed_by_windows

import corpus_pipeline as pipe
from tabsmith.llm import op10_quality, queries
from tabsmith.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_match_their_brute_force_versions(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    stages = dict(pipe.STAGES)

    model = op10_quality.fit(docs, labels)
    kept = written(stages["quality"](spark, docs, SF), "t")
    rows = docs.collect()
    accepted = {r.doc_id for r, s in zip(rows, model.score(op10_quality._matrix([r.text for r in rows]))) if s >= 0.3}
    assert sorted(kept.collect()) == sorted(r for r in rows if r.doc_id in accepted)

    firsts = written(stages["near_duplicates"](spark, kept, SF), "t")
    of = groups([(r.doc_id, r.text) for r in kept.collect()])
    assert sorted(firsts.collect()) == sorted(r for r in kept.collect() if of[r.doc_id][0] == r.doc_id)

    cut = written(stages["repeated_passages"](spark, firsts, SF), "t")
    want = {k: b" ".join(w).decode() for k, w, _ in removed_by_windows([(r.doc_id, r.text) for r in firsts.collect()])}
    assert {r.doc_id: r.text for r in cut.collect()} == want and cut.columns == docs.columns

    mixed = written(stages["mixture"](spark, cut, SF), "t")
    from test_op4_mixing import poisson
    texts, sources = {r.doc_id: r for r in cut.collect()}, Counter(r.source for r in cut.collect())
    roots = sum(n ** 0.5 for n in sources.values())
    rate = {s: n ** 0.5 / roots * len(texts) / n for s, n in sources.items()}
    copies = Counter({k: n for k, r in texts.items() if (n := poisson("mix", k, rate[r.source]))})
    got = mixed.collect()
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in got) == copies and all(r == texts[r.doc_id] for r in got)

    from test_op1_packing import check
    check(stages["packing"](spark, mixed, SF).collect(), [(r.doc_id, r.text) for r in mixed.collect()], 4096)


def test_run_and_odd_documents(spark, docs_of):
    assert pipe.run(spark, SF).count() > 0 and pipe.ORACLE_SQL is None
    docs = docs_of([(1, None), (1, None), (2, ""), (None, "x"), (3, "a b c d e f g " * 20)])
    for _, stage in pipe.STAGES:
        docs = written(stage(spark, docs, SF), "t")
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and public_tokenizers


def test_stages_take_empty_tables_clashing_columns_and_long_texts(spark, docs_of):
    for _, stage in pipe.STAGES:
        assert stage(spark, docs_of([]), SF).collect() == []
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = docs_of([(1, long), (2, "x " + long), (3, "short text of a few words"), (None, None)])
    for name in ("score", "raw", "key", "copy", "text_hash", "piece"):
        docs = docs.selectExpr("*", f"'z' AS `{name}`")
    for _, stage in pipe.STAGES[:4]:
        docs = written(stage(spark, docs, SF), "t")
        assert docs.columns == pipe.COLUMNS
