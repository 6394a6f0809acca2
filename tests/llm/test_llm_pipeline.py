import llm_data as D
import numpy as np

import __spark_entry__ as E
import corpus_pipeline
from saleswh.llm import decontaminate, quality, tables


def test_queries_are_registered():
    names = set(E.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert {n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "substring dedup", "benchmark decontamination", "packing"]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{D.SMALL}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(tables.written(stage(spark, seen[-1], D.SMALL), name.replace(" ", "-")))
    for out in seen[1:-1]:
        assert out.columns == docs.columns
    counts = [x.count() for x in seen]
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] > 0
    kept = {r.doc_id for r in quality.judged(docs, spark.read.parquet(f"{D.SMALL}/labels.parquet")).where("kept").collect()}
    assert {r.doc_id for r in seen[1].collect()} == kept
    items = spark.read.parquet(f"{D.SMALL}/benchmark.parquet")
    assert decontaminate.matched(seen[4], items).where("n_hit > 0").count() == 0
    pieces = seen[5].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in seen[4].select("doc_id").collect()}
    assert sum(len(np.frombuffer(r.ids, "<u4")) for r in pieces) == sum(r.length for r in pieces)
    whole = corpus_pipeline.run(spark, D.SMALL).drop("ids")
    assert whole.exceptAll(seen[5].drop("ids")).count() == 0 and whole.count() == len(pieces)


def test_extra_columns_nulls_and_empty_tables(spark):
    docs = D.frame(spark, [(1, None), (2, ""), (3, D.sentences(1, 60)), (3, D.sentences(1, 60)), (4, D.sentences(1, 60)), (None, D.sentences(2, 60))]) \
        .selectExpr("*", "'x' as stratum2", "1 as chunk", "2 as bits", "3 as curve")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = tables.written(stage(spark, frame, D.SMALL), "test")
            assert frame.columns == docs.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, frame, D.SMALL).collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in frame.select("doc_id").collect()}


#: Every name that a stage adds or uses inside.
NAMES = [*decontaminate.ADDED, *quality.ADDED, "kept", "rejected_by", "word_spans", "_bits", "_row", "_cutoff0", "bits", "root", "component_id", "goes", "stays",
         "chunk", "blob", "good", "carried", "item", "terms", "place", "owner"]


def test_columns_named_like_the_stages_own(spark):
    """Extra columns come through every stage with their values, whatever their names."""
    text = D.sentences(1, 60)
    docs = D.frame(spark, [(1, D.sentences(5, 80)), (2, None), (3, text), (4, text), (None, D.sentences(2, 60)), (5, D.sentences(6, 50) + " " + text)])
    for i, name in enumerate(dict.fromkeys(NAMES)):
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"concat('{i}-', coalesce(doc_id, -1)) as `{name}`")
    docs = tables.written(docs, "test")
    own = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    before = {r.doc_id: tuple(r[c] for c in own) for r in docs.collect()}
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = tables.written(stage(spark, frame, D.SMALL), "test")
        assert frame.columns == docs.columns
    after = {r.doc_id: tuple(r[c] for c in own) for r in frame.collect()}
    assert after and all(before[i] == v for i, v in after.items())


def test_representatives_against_brute_force(spark):
    """One row of each group stays, also where an id stands for several texts (seen with the groups of brute force)."""
    from saleswh.llm import simhash

    texts = {k: D.sentences(n, 40) for n, k in enumerate("ABCDEF", 1)}
    rows = [(3, "B"), (5, "A"), (9, "A"), (5, "B"), (7, "C"), (7, "C"), (8, "D"), (7, "D"), (6, "E"), (None, "E"), (None, "F"), (None, "F"), (2, "D")]
    docs = D.frame(spark, [(i, texts[k]) for i, k in rows])
    name = {t: k for k, t in texts.items()}
    least = {k: min((i for i, x in rows if x == k and i is not None), default=None) for k in texts}
    want = sorted([(i, k) for i, k in rows if i is not None and i == least[k]] + [(-1, k) for k in texts if least[k] is None])
    got = sorted((-1 if r.doc_id is None else r.doc_id, name[r.text]) for r in simhash.representatives(docs).collect())
    assert got == want and {k for _, k in got} == set("ABCDEF")


def test_quality_verdicts_against_a_plain_evaluation(spark):
    """``kept`` of every document: base rules by hand, then each rule's cutoff of its language."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judged(docs, labels).collect()
    cutoffs = quality.thresholds(tables.written(quality.features(docs), "test"), labels)
    for r in rows:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        beyond = [x for x, (feature, high, _) in quality.RULES.items() if (c := cutoffs.get((r.stratum, x))) is not None
                  and (r[feature] > c if high else r[feature] < c)]
        assert r.kept == (not failed and not beyond) and (r.rejected_by is None) == r.kept
