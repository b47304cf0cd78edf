import re

import corpus_pipeline
from shortlist.llm import benchmarks
from tests.llm.test_near_docs import linked, signed, slow_fingerprint

NAMES = ["toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "mixing sources to target weights"]


def test_stages(spark, folder, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], folder).write.parquet(str(tmp_path / str(n)))
        steps.append(spark.read.parquet(str(tmp_path / str(n))))
        if n < 4:
            assert steps[-1].columns == columns
    start, calm, lined, single, clean, mixed = ({r["doc_id"]: r for r in s.collect()} for s in steps)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = set(start) - set(calm)
    assert sum(labels.get(i) == 1 for i in gone) >= 0.6 * sum(labels[i] == 1 for i in labels if i in start)
    # Some twenty toxic rows are all that there is to learn from.
    assert sum(labels.get(i) == 0 for i in gone) <= 0.1 * sum(labels[i] == 0 for i in labels if i in start)
    assert set(lined) == set(calm)
    for i, r in lined.items():
        rest = iter(calm[i]["text"].split("\n"))
        assert all(line in rest for line in r["text"].split("\n") if line) and r["n_chars"] <= calm[i]["n_chars"]
    long_lines = [" ".join(w) for r in lined.values() for x in r["text"].split("\n") if len(w := re.findall(r"[^\W_]+", x.lower())) >= 5]
    assert len(long_lines) == len(set(long_lines))
    fps = {i: signed(slow_fingerprint(r["text"])) for i, r in lined.items()}
    groups, first = linked(sorted(set(fps.values()))), {}
    for i in sorted(fps):
        first.setdefault(groups.find(fps[i]), i)
    assert set(single) == set(first.values())
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    shingled = [[benchmarks.shingles(p) for p in benchmarks.question_and_answer(t)] for t in items]

    def leaks(text):
        words = benchmarks.words_of(text)
        # Parts of fewer than five words are one shorter shingle.
        seen = set().union(*[benchmarks.shingles(words, n) for n in range(1, 6)])
        return any(all(len(p & seen) >= 0.8 * len(p) for p in parts) for parts in shingled)

    assert set(clean) == {i for i, r in single.items() if not leaks(r["text"])}
    assert set(mixed) <= set(clean) and all(r["copies"] in (1, 2) for r in mixed.values())


def test_run_gives_the_last_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"] and found.count() > 50


def test_odd_documents(spark, odd, none, folder):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, folder)
            assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
            docs = kept
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0


