"""What a worker keeps between batches."""

import gc
import subprocess
import sys

import public_tokenizers
import pyarrow as pa
import pytest

from starmill.llm import bpe_codec, common
from starmill.llm.common import pieces

HELD = """
import re
import pyarrow as pa
from starmill.llm.common import pieces
def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"Pss_Anon:\\s+(\\d+)", file.read())[1]) >> 10
before = held()
big = [pa.array(["x" * 1000] * 500) for _ in range(200)]
del big
assert len(list(pieces(pa.RecordBatch.from_pydict({"text": ["a", None]})))) == 1
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_memory_of_former_batches_goes_back():
    """A hundred MB of arrays that are gone don't stay with the worker."""
    done = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 30


def test_a_stage_holds_nothing_of_another(spark, small):
    """The tables of a codec don't stay with the workers that go on to other stages."""

    def codecs(batches):
        for batch in batches:
            list(pieces(batch))
            found = sum(type(x) is bpe_codec.Codec for x in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"n": [found]})

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = small.limit(20).select("doc_id", "text")
    for _ in range(2):
        assert bpe_codec.bpe_digest(texts, path).count() == 20
        found = texts.mapInArrow(codecs, "n long").collect()
        assert [r["n"] for r in found] == [0] * len(found)


def test_memory_goes_back_after_the_last_batch():
    """Also when no batch follows: stages that need no Python run beside waiting workers."""
    seen = []

    @common.returning
    def run(batches):
        yield from batches
        seen.append("last")

    before, common.given_back = common.given_back, lambda: seen.append("returned")
    try:
        assert list(run(iter([1, 2]))) == [1, 2]
    finally:
        common.given_back = before
    assert seen == ["last", "returned"]


def test_held_once_per_stage(monkeypatch):
    made, at = [], [1]
    monkeypatch.setattr(common, "stage", lambda: at[0])
    make = lambda: made.append(at[0]) or made[-1]
    assert [common.held("x", make) for _ in range(3)] == [1, 1, 1]
    at[0] = 2
    assert common.held("x", make) == 2 and made == [1, 2]
    at[0] = 3
    common.given_back()
    assert not common._held
