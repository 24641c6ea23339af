"""What tasks leave behind in processes that stay."""

import os
import subprocess
import sys

from tessera.llm import decontam

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TASK = r"""
import re
import pyarrow as pa
from tessera.llm import neardup


def held():
    return sum(map(int, re.findall(r"Pss_Anon: +(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024


def task(n):
    texts = [" ".join(f"w{(i * 7919 + k) % 50021}" for k in range(300)) for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts)], ["doc_id", "text"])
    return sum(b.num_rows for b in neardup._signatures(iter([batch])))


task(8)
before = held()
assert task(4096) == 4096
print(held() - before)
"""


def test_tasks_give_their_memory_back():
    """MB that a Python worker holds on to after a task of large batches."""
    said = subprocess.run([sys.executable, "-c", TASK], capture_output=True, text=True, cwd=REPO, timeout=300)
    assert said.returncode == 0, said.stderr
    assert float(said.stdout) < 24


def test_leaks_start_no_other_python_workers(spark, messy, tmp_path):
    """Rows made from a list on the driver run Python workers of a second kind, which stay."""
    messy.select("doc_id", "text").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    bench = spark.createDataFrame([(7, " ".join(f"q{i}" for i in range(40)))], "item_id long, text string")
    for items in (bench, bench.limit(0)):
        found = decontam.leaks(docs, items)
        assert "RDD" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.dtypes == [("doc_id", "bigint"), ("item_id", "bigint"), ("cosine", "double"), ("coverage", "double"), ("word_start", "bigint"), ("word_end", "bigint")]
        assert found.count() == 0
