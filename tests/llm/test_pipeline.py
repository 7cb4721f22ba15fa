from collections import Counter

import corpus_pipeline as C


def test_stages_keep_clean_documents(spark, tables, documents):
    names = [n for n, _ in C.STAGES]
    assert names == ["language ID", "SimHash near-dedup", "PII", "mixing", "BPE"] and C.ORACLE_SQL is None
    ids = lambda df: Counter(r["doc_id"] for r in df.collect())
    stage = dict(C.STAGES)
    spoken = stage["language ID"](spark, documents, tables)
    letters = {r["doc_id"] for r in documents.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert spoken.columns == list(C.COLUMNS) and set(ids(spoken)) == letters
    single = stage["SimHash near-dedup"](spark, spoken, tables).cache()
    assert single.columns == list(C.COLUMNS) and max(ids(single).values()) == 1
    clean = stage["PII"](spark, single, tables).cache()
    assert clean.columns == list(C.COLUMNS) and ids(clean) == ids(single)
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    changed = [r for r in clean.collect() if r["text"] != before[r["doc_id"]]]
    assert changed and all("[" in r["text"] and r["n_chars"] == len(r["text"]) for r in changed)
    mix = stage["mixing"](spark, clean, tables)
    assert mix.columns == list(C.COLUMNS) and set(ids(mix)) <= set(ids(clean))
    assert ids(stage["BPE"](spark, mix, tables)) == ids(mix)


def test_run_and_empty_input(spark, tables, no_docs, awkward, tmp_path):
    assert C.run(spark, tables).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name, docs in (("none", no_docs), ("awkward", awkward)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = C.run(spark, str(tmp_path / name)).collect()
        assert (name == "none") == (not rows)
