"""What the pipeline's driver holds: a mixing plan that grows with the levels, and no memory of a fit that is over."""

import ctypes
import random
import re
import sys
from pathlib import Path

import pytest

pytest.importorskip("ternion.llm")
import pyarrow as pa

from ternion.llm import mixing, toxicity
from ternion.plans import lineage


def test_mixing_reads_its_leaves_once_a_level(spark, monkeypatch):
    read = {}

    def cut(df, name):
        read[name] = df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
        return lineage.cut(df, name)

    monkeypatch.setattr(mixing, "cut", cut)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('a b ', id) AS text", "concat('d', id % 4) AS domain", "if(id % 3 = 0, 'en', 'de') AS lang", "concat('src', id % 7) AS source")
    assert mixing.mix(docs, share_percent=100, max_epochs=1).count() == 60
    assert read["mix-plan"] <= len(mixing.LEVELS) + 2  # and once each for the budget and the tokens


def held_mb():
    pa.default_memory_pool().release_unused()
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_fit_hands_its_memory_back(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(40_000)}" for _ in range(500)), i % 3 % 2) for i in range(2_000)]
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    docs = lineage.cut(made, "fit-memory")
    ctypes.CDLL(None).malloc_trim(0)
    before = held_mb()
    index = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    own = sum(getattr(x, "nbytes", 0) for x in vars(index).values()) / 2**20
    assert len(index.rows) > 500_000
    assert held_mb() - before < own + 40
