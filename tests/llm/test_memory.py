"""What a Python worker holds: batches bounded in bytes, and nothing of an earlier stage."""

import random
import weakref

import public_tokenizers
import pyarrow as pa
import pytest

from tidebook.llm import lang_id, packing, similar, simhash
from tidebook.llm.common import BATCH_BYTES, lean


@pytest.mark.parametrize("make", [lambda: lang_id._parser({"en": b"some words"}), lambda: packing.loaded(public_tokenizers.path("byte_bpe_50k.json"))], ids=["parser", "encoder"])
def test_tasks_of_other_stages_let_go(make):
    made = make()
    assert make() is made  # kept for the tasks of its own stage
    seen = weakref.ref(made)
    del made
    assert list(lean(iter)([1, 2])) == [1, 2]
    assert seen() is None


def test_batches_are_bounded_in_bytes(spark):
    """8,000 texts of 4 kB in one task: 32 MB, which Spark's limit of 10,000 rows leaves in one batch."""
    rows = spark.range(0, 8000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 380) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    got = lang_id.keep_known(rows, {"en": b"some words"}).mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r["rows"] for r in got) == 8000
    assert max(r["size"] for r in got) < 2 * BATCH_BYTES


def test_small_tables_have_few_files(spark, monkeypatch):
    """Links and components of near copies, with 64 shuffle partitions that nothing joins: a file each before."""
    rnd, files, write = random.Random(3), {}, similar.written
    words = [[f"w{rnd.random()}" for _ in range(60)] for _ in range(40)]
    rows = [(10 * i + j, " ".join(w + ["more"] * j)) for i, w in enumerate(words) for j in range(3)]

    def counted(df, name, *args, **more):
        out = write(df, name, *args, **more)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    for module in (similar, simhash):
        monkeypatch.setattr(module, "written", counted)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = similar.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r["doc_id"] for r in left.collect()} == {10 * i for i in range(40)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    small = {"links", "large", "star", "small", "tried", "pairs", "marks", "similar", "more"}
    assert small <= {*files} and max(files[x] for x in small) <= spark.sparkContext.defaultParallelism
