import corpus_pipeline as cp
from sifter.llm.common import materialize

from .conftest import SF_MID
from .test_decontam import brute as brute_windows
from .test_line_dedup import brute as brute_lines
from .test_packing import check as check_packing
from .test_simhash import components, fingerprint


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_MID), "test-stage")
        assert docs.columns == columns and dict(docs.dtypes) == {
            "doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
        kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    clean = [k for k, y in truth.items() if y == 0]
    assert sum(k in kept["toxicity"] for k in clean) > 0.97 * len(clean)
    assert sum(k in kept["toxicity"] for k, y in truth.items() if y == 1) < 0.2 * (len(truth) - len(clean))
    source = sorted(kept["toxicity"].items())
    assert kept["line dedup"] == {source[i][0]: t for i, t in brute_lines(source, 50).items()}
    source = sorted(kept["line dedup"].items())
    fps = [fingerprint(t) for _, t in source]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    first = {source[r][0] for r in components(len(fps), near)}
    assert set(kept["SimHash near-dedup"]) == first
    source = sorted(kept["SimHash near-dedup"].items())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    bad = {int(r[0]) for r in brute_windows(source, items) if r[5]}
    assert set(kept["benchmark decontamination"]) == {k for k, _ in source} - bad
    from sifter.llm.packing import pack_documents

    check_packing(pack_documents(docs).collect(), sorted(kept["benchmark decontamination"].items()), 4096)
    whole = cp.run(spark, SF_MID)
    assert sorted({r.doc_id for r in whole.select("doc_id").collect()}) == sorted(kept["benchmark decontamination"])


def test_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_MID}/{t}.parquet").limit(0).write.parquet(f"{sf}/{t}.parquet")
    assert cp.run(spark, sf).count() == 0
