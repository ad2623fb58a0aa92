"""Each stage on its own input against the operator's tests' plain versions."""

import corpus_pipeline
from starmill.llm import near_copies as nc
from starmill.llm import perplexity
from starmill.llm.common import cut, read_table
from tests.llm.test_bpe import PATH, Tokenizer, expected
from tests.llm.test_decontamination import expected as contaminated
from tests.llm.test_pii import by_patterns
from tests.llm.test_near_copies import apart
from tests.llm.test_simhash import least_reached


def test_stages(spark, folder):
    docs = read_table(spark, folder, "documents")
    items = [tuple(r) for r in read_table(spark, folder, "benchmark").collect()]
    library = Tokenizer.from_file(PATH)
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = cut(stage(spark, docs, folder))
        rows = {r["doc_id"]: r for r in out.collect()}
        assert len(rows) == out.count()
        if name == "quality_rules":
            want = {r["doc_id"] for r in perplexity.quality(docs).where("kept").collect()}
            assert set(rows) == want and 0.7 * len(before) < len(want) < len(before)
        elif name == "near_duplicates":
            sketches = {i: nc.sketch(nc.shingles(r["text"])) for i, r in before.items()}
            prints = {i: f for i, (f, _) in sketches.items()}
            keys = {i: set(k) for i, (_, k) in sketches.items()}
            near = lambda a, b: keys[a] & keys[b] and apart(prints, a, b) <= nc.RADIUS
            assert set(rows) == set(least_reached(before, near).values())
        elif name == "decontamination":
            want = {i for i, r in before.items() if not contaminated(r["text"], items)[1]}
            assert set(rows) == want
        elif name == "personal_data":
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert not by_patterns(r["text"]) and r["n_chars"] == len(r["text"])
                if not by_patterns(before[i]["text"]) and "@" not in r["text"]:
                    assert r["text"] == before[i]["text"] or "[" in r["text"]
        else:
            assert {i: tuple(r)[1:] for i, r in rows.items()} == {
                i: expected(library, r["text"]) for i, r in before.items()
            }
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out


def test_empty_documents(spark, folder):
    docs = read_table(spark, folder, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, folder))
    assert docs.count() == 0


def test_hard_documents(spark, folder, hard):
    """Nulls, repeated ids, long texts and other columns pass through every stage."""
    docs = hard.withColumnRenamed("word", "a.b")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        # Each stage on all hard rows, as the first one leaves few.
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}, name
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert encoded.count() == docs.count()
