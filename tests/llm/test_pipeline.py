import numpy as np
import public_tokenizers

import __spark_entry__ as E
import corpus_pipeline
from genrec.llm import order_minhash, piece_sampling, quality_rules
from genrec.llm.common import table
from genrec.session import scratch_dir
from tests.llm.conftest import SF001
from tests.llm.test_personal_data import brute as personal
from tests.llm.test_source_mix import brute_targets, size


def test_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "order_minhash", "personal_data", "source_mix", "piece_sampling"]


def test_each_stage_on_its_own_input(spark):
    docs = table(spark, SF001, "documents")
    folder = scratch_dir(spark, "stages")
    inputs, outputs = [], []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(docs)
        stage(spark, docs, SF001).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        outputs.append(docs)
    for out in outputs[:-1]:
        assert out.columns == inputs[0].columns

    rows = [[r.asDict() for r in x.collect()] for x in (inputs[0], *outputs)]
    kept = {r.doc_id for r in quality_rules.judge(inputs[0], table(spark, SF001, "labels")).where("kept").collect()}
    assert {r["doc_id"] for r in rows[1]} == kept and 0 < len(kept) < len(rows[0])

    leaders = {r.doc_id for r in order_minhash.classes(inputs[1]).where("kept").collect()}
    assert {r["doc_id"] for r in rows[2]} == leaders

    before = {r["doc_id"]: r["text"] for r in rows[2]}
    for r in rows[3]:
        assert personal(r["text"]) == "" and r["n_chars"] == len(r["text"])
        if not personal(before[r["doc_id"]]) and "token" not in before[r["doc_id"]]:
            assert r["text"] == before[r["doc_id"]]
    assert len(rows[3]) == len(rows[2])

    sizes, taken = {}, {}
    for r in rows[3]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    for r in rows[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    for s, t in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= 64

    pieces = piece_sampling.Pieces(public_tokenizers.path(corpus_pipeline.PIECES))
    texts = {r["text"].replace("▁", " ") for r in rows[4]}
    assert {pieces.decode(np.frombuffer(r["ids"], "<u2")) for r in rows[5]} == texts


def test_run(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == ["doc_id", "sample", "n_tokens", "log_prob", "log_inclusion", "ids"] and out.count() > 0
