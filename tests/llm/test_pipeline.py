"""The stages of the pipeline, each on its predecessor's result, and what the package promises as a whole."""

import collections
from pathlib import Path

import corpus_pipeline
from fieldsignal.llm import decontaminate, packing, quality, queries, simhash, suffixdedup
from fieldsignal.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, names = table(spark, SF, "documents"), [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    columns, results = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], SF).cache())
    good, single, cut, clean, packed = results[1:]
    assert all(x.columns == columns for x in (good, single, cut, clean))
    judged = quality.judge(docs, table(spark, SF, "labels").where("quality = 1"))
    ids = lambda df: sorted(x.doc_id for x in df.select("doc_id").collect())
    assert ids(good) == ids(judged.where("kept"))
    assert ids(single) == ids(simhash.near_duplicates(good).where("doc_id = component_id"))
    assert ids(cut) == ids(single)
    kept = {x.doc_id: x.n_bytes - x.n_removed for x in suffixdedup.dedup_digest(single).collect()}
    for x in cut.collect():
        assert 0 <= kept[x.doc_id] - len(x.text.encode()) < 8 * 40 and x.n_chars == len(x.text)
    found = decontaminate.find_contamination(cut, table(spark, SF, "benchmark"))
    assert ids(clean) == ids(found.where("not contaminated"))
    assert set(ids(packed)) == set(ids(clean))
    again = packing.pack(clean, queries.tokenizer_path("word_bpe_49k.json"))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, packed.select(key).collect()))
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.select(key).collect())) == sorted(map(tuple, packed.select(key).collect()))


def test_every_operator_has_one_query():
    numbers = collections.Counter(name.split("_")[0] for name in queries.QUERIES)
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent / "fieldsignal"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
