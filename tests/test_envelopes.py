"""Documents read as streams: every way to cut them into blocks, odd documents, and bounded memory."""

import gzip
import io
import json
import random
import tracemalloc
from itertools import chain

import pytest
from pyspark.sql.types import StructType

from caselog.sources.envelopes import TASK_BYTES, Document, shares, stream_envelope

ODD = {
    "meta": {"results": {"skip": 0, "total": 9}, "text": "a \"quoted\" [ ] { } \\ end", "list": [{"id": "no item"}]},
    "numbers": [1, -2.5e10, [3]],
    "results": [{"id": "é😀", "n": 1}, {}, {"id": "}]", "n": None, "deep": {"a": [[{"b": "]}"}]]}}, {"id": " \\\""}, 12345, "text", None],
    "after": 123456,
    "empty": [],
}


class Slow(io.BytesIO):
    """Gives blocks of random size, cut through characters too."""

    def read(self, size=-1):
        return super().read(random.Random(self.tell()).randrange(1, 1 + max(1, size)))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("style", [{"ensure_ascii": False}, {"indent": 1}, {"separators": (",", ":")}])
def test_items_however_the_document_is_cut(block, style):
    data = json.dumps(ODD, **style).encode()
    for stream in (io.BytesIO(data), Slow(data), io.BytesIO(b"\xef\xbb\xbf" + data + b"\n")):
        assert [json.loads(x) for x in Document(stream, block).items("results")] == ODD["results"]


def test_documents_without_items():
    for text in ("{}", '{"results": []}', '{"results": null}', '{"meta": 1}', ' {"meta": {"results": [1]}} '):
        assert list(Document(io.BytesIO(text.encode())).items("results")) == []


@pytest.mark.parametrize(
    "text", ["", "[]", '{"results": [', '{"results": [{"id": 1}', '{"results": [1 2]}', '{"results": [1]', '{"results": [1]} {}', '{"results": {}}', '{"results": [tru]}', "{results: []}"]
)
def test_documents_that_are_not_whole(text):
    for block in (1, 1 << 20):
        with pytest.raises(ValueError):
            list(Document(io.BytesIO(text.encode()), block).items("results"))


class Endless(io.RawIOBase):
    """A document of n items that exists only as it is read."""

    def __init__(self, n):
        items = (b'{"id": "%d", "text": "%s"},' % (i, b"x" * 2000) for i in range(n))
        self.parts = chain([b'{"meta": {}, "results": ['], items, [b'{"id": "last"}]}'])
        self.rest = b""

    def read(self, size=-1):
        while len(self.rest) < size and (part := next(self.parts, None)):
            self.rest += part
        data, self.rest = self.rest[:size], self.rest[size:]
        return data


def test_memory_does_not_grow_with_the_document():
    peaks = []
    for n in (5_000, 50_000):
        tracemalloc.start()
        assert sum(1 for _ in Document(Endless(n)).items("results")) == n + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] < 20 << 20


def test_small_documents_share_a_task(spark, tmp_path):
    files = [(f"f{i:05}", 180_000) for i in range(10_000)]
    runs = shares(files, 12)
    assert [u for r in runs for u in r] == [u for u, _ in files] and len(runs) < 80
    assert len(shares(files[:24], 12)) in (12, 24) and shares([], 12) == []
    assert shares([("a", 1), ("b", 10 * TASK_BYTES), ("c", 1)], 1) == [["a"], ["b"], ["c"]]
    for i in range(300):
        (tmp_path / f"{i:03}.json").write_text(json.dumps({"results": [{"id": f"{i}-{k}"} for k in range(3)]}))
    rows = stream_envelope(spark, str(tmp_path), StructType.fromDDL("id string"), "now")
    assert rows.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert sorted((r.id, r.seq, r.file[-8:]) for r in rows.collect()) == sorted((f"{i}-{k}", k, f"{i:03}.json") for i in range(300) for k in range(3))


def test_typed_rows_of_plain_and_gzipped_documents(spark, tmp_path):
    folder = tmp_path / "in [x] y"
    (folder / "deep").mkdir(parents=True)
    docs = {"a.json": [{"id": "1", "n": 1}, {"id": "2"}], "deep/b.json.gz": [{"id": "3", "n": 3, "more": [1]}], "c.json": []}
    for name, items in docs.items():
        data = json.dumps({"meta": {}, "results": items}).encode()
        (folder / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    (folder / "other.txt").write_text("no document")
    schema = StructType.fromDDL("id string, n bigint")
    for path in (str(folder), folder.as_uri() if " " not in str(folder) else str(folder)):
        rows = stream_envelope(spark, path, schema, "now").collect()
        assert sorted((r.id, r.n, r.file.rsplit("/", 1)[1], r.seq) for r in rows) == [
            ("1", 1, "a.json", 0), ("2", None, "a.json", 1), ("3", 3, "b.json.gz", 0),
        ]
    one = stream_envelope(spark, str(folder / "a.json"), schema, "now")
    assert one.count() == 2 and {r._pulled_at for r in one.collect()} == {"now"}
    (folder / "broken.json").write_text('{"results": [{"id": "1"}')
    with pytest.raises(Exception, match="broken.json"):
        stream_envelope(spark, str(folder), schema, "now").collect()
