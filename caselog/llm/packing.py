"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Documents and gaps are kept sorted by size as runs of equal size: a run of documents is a range of
ranks within their length, a run of gaps a range of sequence numbers. A round sweeps both from small
to large; each gap meets the longest waiting document that fits it, which is the document whose
successor the gap is. Where documents compete, the lower ranks win and the others wait for the next
gap or round. Then all gaps are updated at once, and the rounds repeat; when no document fits any gap,
new sequences are opened for the longest ones left.

Lengths are at most the capacity, so a round's state is bounded by it and not by the data: the driver
sweeps a histogram of at most `capacity` entries. Everything with a row per document runs in Spark:
tokenising, ranking (each task ranks its own rows; the tasks' counts give the offsets, so no length is
gathered anywhere), and finding each piece's run by binary search.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, table
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY, END = 2048, 0
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 400_000
IDS = np.dtype("<u4")


class WordIds(dict):
    """Token ids, as little-endian bytes, of chunks without ASCII white space; the latest are kept.

    The tokenizer drops white space and never joins characters across it, so a text's ids are those of
    its chunks in order. Letters alone are one BPE word, which skips the tokenizer's own splitting;
    a full stop or comma after a letter or digit is a word by itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=IDS).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(chunk) > 1 and chunk[-1] in b".," and chunk[-2:-1].isalnum():
            ids = self[chunk[:-1]] + self[chunk[-1:]]
        else:
            text = chunk.decode("utf-8", "replace")
            plain = text if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
            if plain.isalpha():
                if not plain.isascii():
                    plain = self.bytewise.pre_tokenize_str(plain)[0][0]
                found = [x.id for x in self.tokenizer.model.tokenize(plain)]
                ids = np.array(found, dtype=IDS).tobytes()
            else:
                ids = self.whole(text)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[chunk] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text. One that may name a special token goes to the tokenizer as it is."""
        if b"<|" in text:
            return self.whole(text.decode("utf-8", "replace"))
        return b"".join(map(self.__getitem__, text.lower().split()))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row per piece of each document's ids and the end id: doc_id, piece, start, length, ids_crc32,
    and the task it came from with its rank among that task's pieces of its length."""
    end = np.array([END], dtype=IDS).tobytes()
    width = capacity * IDS.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordIds(path), np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for b in batches:
            rows, at = [], []
            for i, text in enumerate(b["text"].cast(pa.binary())):
                ids = words.of(text.as_py()) + end
                for piece, start in enumerate(range(0, len(ids), width)):
                    part = ids[start : start + width]
                    length = len(part) // IDS.itemsize
                    values = np.frombuffer(part, dtype=IDS).astype(np.int32) if keep_ids else None
                    rows.append((piece, start // IDS.itemsize, length, zlib.crc32(part), task, seen[length], values))
                    seen[length] += 1
                    at.append(i)
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            ids_of = b["doc_id"].take(pa.array(at, pa.int64()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"]
            yield pa.RecordBatch.from_arrays([ids_of, *arrays], names)

    rows = docs.select("doc_id", or_empty(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint, ids array<int>"
    made = rows.mapInArrow(run, schema)
    return made if keep_ids else made.drop("ids")


def best_fit(lengths: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Placement of runs for a histogram of lengths: rows of (length, first rank, count, first
    sequence, offset), sorted by length and rank."""
    left, rank = [0] * (capacity + 1), [0] * (capacity + 1)
    for length, n in lengths.items():
        left[length] = n
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs, opened = [], 0

    def put(length: int, sequence: int, count: int, offset: int) -> tuple[int, tuple[int, int]]:
        runs.append((length, rank[length], count, sequence, offset))
        rank[length] += count
        left[length] -= count
        return capacity - offset - length, (sequence, count)

    while any(left):
        updated, waiting = [], []
        for size in range(1, capacity + 1):
            if left[size]:
                waiting.append(size)
            if not gaps[size] or not waiting:
                continue
            kept = []
            for sequence, count in gaps[size]:
                while count and waiting:
                    length = waiting[-1]
                    taken = min(count, left[length])
                    updated.append(put(length, sequence, taken, capacity - size))
                    sequence, count = sequence + taken, count - taken
                    if not left[length]:
                        waiting.pop()
                if count:
                    kept.append((sequence, count))
            gaps[size] = kept
        if not updated:
            needed = -(-sum(size * n for size, n in enumerate(left)) // capacity)
            for length in range(capacity, 0, -1):
                if needed and left[length]:
                    taken = min(needed, left[length])
                    updated.append(put(length, opened, taken, 0))
                    opened, needed = opened + taken, needed - taken
        for gap, run in updated:
            if gap:
                gaps[gap].append(run)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every piece of (doc_id, text) with its sequence_id and offset there.

    Null and empty texts are the end id alone. Rows are packed each by itself, so repeated rows and
    null ids take their own places. No rows give no sequences.
    """
    spark = docs.sparkSession
    rows = save(pieces(docs, path or vocabulary(), capacity, keep_ids), "pieces")
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = save(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = spark.sparkContext.broadcast(best_fit({r["length"]: r["n"] for r in histogram}, capacity))
    ranked = rows.join(counts.select("task", "length", "before"), ["task", "length"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("task", "before")
    order = [c for c in ranked.columns if c not in ("rank", "ids")] + ["rank"] + (["ids"] if keep_ids else [])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = runs.value
        starts = plan[:, 0] << 44 | plan[:, 1]
        for b in batches:
            length, rank = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = np.searchsorted(starts, length << 44 | rank, side="right") - 1
            sequence = plan[run, 3] + rank - plan[run, 1]
            columns = {c: b[c] for c in order if c != "rank"}
            columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(plan[run, 4])}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(order).drop("rank").schema)
    return ranked.select(order).mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) from pieces packed with `keep_ids`; a sequence is at most the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
