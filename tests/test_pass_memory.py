"""What an Arrow pass holds: bounded by a slice, whatever its batch, and the same after many batches."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StructField

from wordloom.functions import in_row


class Passed:
    """Stands for rows: takes the function of an Arrow pass, so that it runs here."""

    columns, sparkSession = ["doc_id", "text"], None
    schema = {"doc_id": StructField("doc_id", LongType())}

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


class Sent:
    value = ["common", "w7"]


STRIP = ["mm", "w1"]
PASSES = {
    "partial_counts": lambda: in_row.partial_counts(Passed(), STRIP),
    "partial_frequencies": lambda: in_row.partial_frequencies(Passed()),
    "partial_frequencies of stripped, stemmed texts": lambda: in_row.partial_frequencies(Passed(), stem=True, strip=STRIP),
    "partial_pairs": lambda: in_row.partial_pairs(Passed(), Sent, 4, False),
    "partial_pairs, directed": lambda: in_row.partial_pairs(Passed(), Sent, 2, True),
}
TALLIES = {"dense": {}, "found only": {"dense": False}, "stems": {"stem": True, "dense": False}, "running": {"stem": True, "running": True}}


def batch_of(copies):
    texts = [" ".join(f"w{(i * 31 + j) % 997} common" for j in range(100)) for i in range(100)] * copies
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts)], ["doc_id", "text"])


def peak_of(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("how", TALLIES.values(), ids=TALLIES)
def test_memory_of_a_tally_does_not_grow_with_its_batch(how, monkeypatch):
    monkeypatch.setattr(in_row.F, "arrow_udf", lambda kind: lambda tally: lambda column: tally)
    monkeypatch.setattr(in_row.F, "col", lambda name: name)
    tally = in_row.term_tally(Passed(), Sent, **how)
    small, large = (batch_of(copies).column("text") for copies in (40, 160))  # 4 and 16 MB of text
    assert len(tally(small)) == 4_000
    assert peak_of(lambda: tally(large)) < 1.3 * peak_of(lambda: tally(small)) + 2_000_000


@pytest.mark.parametrize("name", PASSES)
def test_memory_of_a_pass_does_not_grow_with_the_number_of_its_batches(name):
    run, batch = PASSES[name](), batch_of(20)
    few, many = (peak_of(lambda n=n: [None for _ in run(iter([batch] * n))]) for n in (2, 8))
    assert many < 1.1 * few + 1_000_000
