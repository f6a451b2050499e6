"""How much text a Python task is handed at once."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import packing, shared, toxicity
from siltstone.llm.setsketch import SKETCH_BYTES
from siltstone.llm.shared import ship
from siltstone.llm.textbytes import text_slices

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = dict(spark.conf.getAll).get(BYTES)
    spark.conf.unset(BYTES)
    yield
    if before is None:
        spark.conf.unset(BYTES)
    else:
        spark.conf.set(BYTES, before)


def _sizes(spark):
    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("long text "), 1_000).alias("text"))
    return [r.size for r in rows.mapInArrow(task, "size long").collect()]


def test_batches_are_bounded_in_bytes(spark, unset):
    ship(spark)
    sizes = _sizes(spark)
    assert len(sizes) > 4
    assert max(sizes) < 1 << 20


def test_a_limit_of_the_session_stays(spark, unset):
    spark.conf.set(BYTES, "2m")
    ship(spark)
    assert spark.conf.get(BYTES) in ("2m", "2097152b")


def test_sketches_take_small_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(["word " * 4_000] * 40)], ["text"])
    sizes = [part.nbytes for part in text_slices(batch, "text", SKETCH_BYTES)]
    assert len(sizes) > 4
    assert max(sizes) < 1 << 18


def test_packing_tokenizes_short_batches_together(monkeypatch):
    words = packing.words_of(packing.vocabulary_path())
    sizes = []

    def encode(texts):
        sizes.append(len(texts))
        return words.encode(texts)

    monkeypatch.setattr(packing, "words_of", lambda path: SimpleNamespace(encode=encode))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "TEXT_BYTES", 1_000)
    rows = [(i, "some words " * (i % 5)) for i in range(60)] + [(60, None), (61, "long " * 400), (62, "")]
    table = pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())})
    task = packing._pack_locally("", 4096, 1, "doc_id", "text")
    found = pa.Table.from_batches(task(iter(table.to_batches(max_chunksize=2))))
    assert sorted(found.column("doc_id").to_pylist()) == list(range(63))
    assert sum(sizes) == 63
    # 32 batches of up to 88 bytes: about 1,300 bytes, then one long text.
    assert len(sizes) <= 4


def _labelled(n_rows, n_words):
    random = np.random.default_rng(5)
    texts = [" ".join(f"Wort{k}" for k in random.integers(0, 4_000, n_words)) for _ in range(n_rows)]
    return pa.RecordBatch.from_pydict({"text": texts, "label": pa.array([i % 3 == 0 for i in range(n_rows)]).cast(pa.int32())})


def test_counting_takes_little_memory():
    batch = _labelled(280, 200)
    assert 400_000 < batch.nbytes < toxicity.COUNTED_BYTES
    list(toxicity._presences(iter([batch])))
    tracemalloc.start()
    list(toxicity._presences(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 << 20


def test_presences_do_not_depend_on_runs(monkeypatch):
    batch = _labelled(40, 12)
    rows = [*batch.to_pylist(), {"text": None, "label": 1}, {"text": "", "label": 0}, {"text": "long " * 30 + "wort1 other", "label": 1}]
    batch = pa.RecordBatch.from_pylist(rows, batch.schema)

    def counted():
        found = pa.Table.from_batches(toxicity._presences(iter([batch]))).to_pydict()
        return {g: (c, t) for g, c, t in zip(found["gram"], found["clean"], found["toxic"], strict=True)}

    def scored():
        features = toxicity.Features(hashes)
        own = pa.Table.from_batches(toxicity._rows(hashes)(iter([batch]))).to_pydict()
        model = toxicity.Classifier(hashes, np.linspace(-1, 1, len(hashes)), 0.25)
        return own, model.scores(batch.column("text"), features).tolist()

    hashes = np.unique(toxicity.word_grams(pa.array(["wort1", "other", "wort2", "wort30"]))[1])
    whole = counted(), scored()
    monkeypatch.setattr(toxicity, "TOGETHER", 60)
    assert (counted(), scored()) == whole

    expected = {}
    for row in rows:
        grams = {g for w in (row["text"] or "").lower().split() for k in toxicity.ORDERS for g in (f" {w} "[i : i + k] for i in range(len(w) + 3 - k))}
        for gram in grams:
            expected.setdefault(gram, [0, 0])[row["label"]] += 1
    assert sorted(map(tuple, expected.values())) == sorted(whole[0].values())


def test_tasks_hand_their_memory_back(monkeypatch):
    calls = []
    pool = SimpleNamespace(release_unused=lambda: calls.append(1))
    pools = SimpleNamespace(default_memory_pool=lambda: pool, system_memory_pool=lambda: pool)
    monkeypatch.setattr(shared, "pa", pools)
    assert list(shared.handing_back(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert len(calls) == 2
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words"]})
    assert len(list(packing._pack_locally(packing.vocabulary_path(), 4096, 1, "doc_id", "text")(iter([batch])))) == 1
    assert len(calls) == 4
