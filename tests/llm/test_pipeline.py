import corpus_pipeline as P
from rivulet.util import stage
from tests.llm.cases import awkward, awkward_rows, prose

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]
    sizes = [docs.count()]
    for k, (name, function) in enumerate(P.STAGES):
        docs = stage(function(spark, docs, SF_DIR), name)
        assert docs.columns[:5] == COLUMNS and (len(docs.columns) == 5 or k == 4)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] >= sizes[4] > 0
    again = P.run(spark, SF_DIR)
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_awkward_rows_pass_every_stage(spark):
    extra = [(400 + k, prose(900 + k, 60), "en", f"s{k}", 1) for k in range(5)]
    for table in (awkward_rows() + extra, []):
        docs = awkward(spark, table).select(*COLUMNS)
        for name, function in P.STAGES:
            out = stage(function(spark, docs, SF_DIR), name)
            assert {r.doc_id for r in out.collect()} <= {r[0] for r in table}
            # this table's texts are unlike the trusted ones, so the next stages get them all
            docs = docs if name == "quality_rules" else out
        ids = {r.doc_id for r in docs.collect()}
        if table:
            assert ids & {400, 401, 402, 403, 404}
