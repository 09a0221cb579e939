"""The pipeline's stages keep their contract on the smallest tables."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
    assert counts[1] <= counts[0] and counts[2] == counts[1] and counts[3] <= counts[2] and counts[4] == counts[3]
    assert docs.select("doc_id").distinct().count() == counts[4]
    assert len(corpus_pipeline.STAGES) == 5


def test_a_task_gives_its_memory_back():
    import re
    from pathlib import Path

    from curiota.llm.arrow import released

    outlives = []

    def run(batches):
        held = [bytes(1000) for _ in range(150_000)]
        # a piece in a thousand outlives the task: nothing below it is given back unasked
        outlives.extend(held[::1000])
        yield len(held)

    def resting():
        """This process's own memory in MB."""
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) // 1024

    before = resting()
    assert list(run([])) == [150_000] and resting() - before > 100
    assert list(released(run)([])) == [150_000] and resting() - before < 60
