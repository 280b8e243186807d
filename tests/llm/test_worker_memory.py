"""What Python workers hold once their tasks are over: they stay, and so does their memory."""

import gc
import re

import pandas as pd

from candlelake.llm import common, packing, queries


def test_packing_leaves_no_words_in_workers(spark):
    rows = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 50), i -> md5(concat(id, ':', i)))) AS text")
    assert packing.cut(rows, queries.TOKENIZER, 256, 1).count() >= 400

    def probe(batches):
        for batch in batches:
            yield pd.DataFrame({"words": [len(e.places) + len(e.flat) for e in packing._encoders.values()]}, dtype="int64")

    found = [r.words for r in spark.range(0, 64, 1, 64).mapInPandas(probe, "words long").collect()]
    assert found and not any(found)


def test_tidied_gives_all_rows_and_returns_memory():
    def held():
        return sum(map(int, re.findall(r"\nPrivate_Dirty:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

    def run(batches):
        for batch in batches:
            # Small blocks that a last one, which stays, keeps the allocator from returning.
            blocks = [bytes(2000) for _ in range(50_000)]
            stays.append(blocks[-1])
            yield batch.assign(n=len(blocks))

    stays: list[bytes] = []
    batches = [pd.DataFrame({"a": [i]}) for i in range(3)]
    before = held()
    out = list(common.tidied(run)(iter(batches)))
    gc.collect()
    assert [(int(x.a[0]), int(x.n[0])) for x in out] == [(0, 50_000), (1, 50_000), (2, 50_000)]
    assert held() - before < 50
