import zlib

import corpus_pipeline
from logloom.llm.common import materialize

from .brute import kept_lines, library_ids, near_classes, packing_is_sound
from .conftest import SF


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_each_stage_against_brute_force(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = texts_of(docs)
        out = materialize(stage(spark, docs, SF), name)
        if name == "packing":
            packing_is_sound(out.collect(), library_ids(before, "word_bpe_49k.json", 0))
            break
        assert out.columns == docs.columns
        after = texts_of(out)
        if name == "toxicity":
            marked = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            gone = set(before) - set(after)
            assert gone and all(after[i] == before[i] for i in after)
            clean = [i for i in before if marked.get(i) == 0 and zlib.crc32(str(i).encode()) % 5 == 0]
            assert sum(i in gone for i in clean) <= 0.03 * len(clean)
        elif name == "line_dedup":
            assert after == {i: x[2] for i, x in kept_lines(before).items()}
        else:
            assert after == {i: before[i] for i in set(near_classes(before).values())}
        docs = out


def test_pipeline_over_no_documents(spark, tmp_path, documents):
    documents.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
