import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from citylake.llm import near_dedup, toxicity
from tests.llm.helpers import docs, with_extra

PROSE = " ".join(f"plain{i} word" for i in range(60))


def test_deduplicate_rows(spark):
    texts = [PROSE, PROSE, PROSE + " more", None, None, "", "", "other text of its own here"]
    df = with_extra(docs(spark, texts, ids=[5, 3, 3, 1, 1, None, 9, 9]))
    got = near_dedup.deduplicate(df)
    assert got.columns == df.columns
    rows = sorted((str(r.doc_id), str(r.text)[:5]) for r in got.collect())
    assert rows == sorted([("3", "plain"), ("1", "None"), ("1", "None"), ("None", ""), ("9", "other")])
    assert near_dedup.deduplicate(docs(spark, [])).count() == 0


def test_stages_take_effect(spark, tmp_path, monkeypatch):
    passage = " ".join(f"benchword{i}" for i in range(20))
    key = "xK9fQ2mZ7LpR4vT8wB3n"
    texts = {1: PROSE, 2: PROSE, 3: PROSE + " tail", 4: "insult stupid moron trash idiot " + PROSE[:50], 5: "lead " + passage + " end",
             6: f"a note with password={key} inside of it", 7: None, 8: "", 9: "clean short text"}
    d = str(tmp_path)
    docs(spark, list(texts.values()), ids=list(texts)).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    monkeypatch.setattr(toxicity, "_scorer", lambda net, column: lambda batch: __import__("numpy").array(
        [float("moron" in (t or "")) for t in batch.column(column).to_pylist()]))
    now = spark.read.parquet(f"{d}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, d)
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r.doc_id: r for r in now.collect()}
    assert set(left["toxicity"]) == set(texts) - {4}
    assert set(left["near_dedup"]) == {1, 5, 6, 7, 8, 9}
    assert set(left["decontamination"]) == {1, 6, 7, 8, 9}
    last = left["secret_scan"]
    assert last[6].text == "a note with [SECRET] inside of it" and last[6].n_chars == len(last[6].text) and last[1].text == PROSE
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == {k: len(tok.encode(r.text or "").ids) + 1 for k, r in last.items()}
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("table", ["documents"])
def test_empty_corpus(spark, tmp_path, table):
    d = str(tmp_path)
    docs(spark, []).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
