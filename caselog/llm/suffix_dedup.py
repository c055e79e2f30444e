"""Removal of repeated strings by a hash-compared suffix sort.

Every byte is removed that lies in a LENGTH-byte string starting anywhere else too. Sorting all suffixes
of a corpus isn't needed for that: of the GRAM-byte strings in each LENGTH-byte window the one of least
hash is an anchor, so equal windows have equal anchors at equal places, and it is enough to sort the
suffixes around anchors that occur twice.

1. Anchors of each document are hashed, together with their context, the bytes of all windows they can
   be the anchor of. Anchors that occur once are dropped; equal contexts repeat as a whole.
2. The other contexts, and one of each equal kind, are cut from the texts and shuffled by anchor.
3. A task sorts the suffixes that start at an anchor by merge sort. Two are compared by the length of
   their common extension, found by binary search over prefix hashes, and the byte after it. The order
   of the suffixes that start 1, 2, ... bytes earlier follows by one stable pass per byte. Neighbours
   whose extension reaches LENGTH are repeats; their bytes are compared, so that no collision counts.
4. Repeated ranges are merged per document, and the rest is kept.

An anchor with over MAX_GROUP contexts isn't sorted in one task; the windows of its contexts are counted
by two hashes in a shuffle that may spill.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, row_key, table
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, GRAM = 200, 64
MAX_GROUP = 20_000
CHUNK = 4_000
BASE, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_values(base: int) -> np.ndarray:
    """A well-mixed 64-bit value for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(base)
    return mixed(x ^ np.uint64(base >> 7))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Prefix polynomial hashes modulo 2**64 of texts, with powers kept between texts."""

    def __init__(self, base: int = BASE) -> None:
        self.base, self.values = base, byte_values(base)
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def prefixes(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        if len(self.up) <= n:
            self.up = powers(self.base, 2 * n + 1)
            self.down = powers(pow(self.base, -1, 1 << 64), 2 * n + 1)
        return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.values[text] * self.up[:n])])

    def of(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of text[start:end]."""
        return mixed((prefixes[end] - prefixes[start]) * self.down[start])


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def anchors(text: np.ndarray, hasher: Hasher, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Starts, hashes, bytes of context before and from the start on, and context hashes of the anchors."""
    reach = length - gram
    prefixes = hasher.prefixes(text)
    at = np.arange(len(text) - gram + 1)
    h = hasher.of(prefixes, at, at + gram)
    least = sliding(h, reach + 1, np.minimum)
    lowest = np.zeros(reach, dtype=np.uint64)
    chosen = np.flatnonzero(sliding(np.concatenate([lowest, least, lowest]), reach + 1, np.maximum) == h)
    before, after = np.minimum(chosen, reach), np.minimum(len(text) - chosen, length)
    context = hasher.of(prefixes, chosen - before, chosen + after)
    shape = (before << 16 | after).astype(np.uint64)
    return chosen, h[chosen], before, after, mixed(context ^ mixed(shape))


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, pos, before, after, h, c, sure, weight) of each anchor. Where a batch holds a context twice,
    all of it is sure to repeat and one row with weight 2 stands for it in the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            rows, got = [], []
            for i, value in enumerate(b["text"].cast(pa.binary())):
                text = np.frombuffer(value.as_py(), dtype=np.uint8)
                if len(text) >= length:
                    got.append(anchors(text, hasher, length, gram))
                    rows.append(np.full(len(got[-1][0]), i))
            if not got:
                continue
            row = np.concatenate(rows)
            pos, h, before, after, c = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((c, h))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (h[order[1:]] != h[order[:-1]]) | (c[order[1:]] != c[order[:-1]])
            sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
            size, weight = np.empty(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
            size[order] = np.repeat(sizes, sizes)
            weight[order[new]] = np.minimum(sizes, 2)
            at = pa.array(row)
            arrays = [
                b["k1"].take(at), b["k2"].take(at), pa.array(pos.astype(np.int32)), pa.array(before.astype(np.int16)), pa.array(after.astype(np.int16)),
                pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(size > 1), pa.array(weight.astype(np.int8)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "pos", "before", "after", "h", "c", "sure", "weight"])

    schema = "k1 bigint, k2 bigint, pos int, before smallint, after smallint, h bigint, c bigint, sure boolean, weight tinyint"
    return docs.select("k1", "k2", "text").mapInArrow(run, schema)


def common_extension(p: np.ndarray, limit: np.ndarray, a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Length of the common extension of rows a and b from column `start`, by binary search over their
    prefix hashes; equal columns need no shift."""
    low, high = np.zeros(len(a), dtype=np.int64), np.minimum(limit[a], limit[b])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = p[a, start + middle] - p[a, start] == p[b, start + middle] - p[b, start]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def merge_sorted(text: np.ndarray, p: np.ndarray, limit: np.ndarray, group: np.ndarray, start: int) -> np.ndarray:
    """Rows in order of their group, which is sorted already, and then of their suffixes from `start`."""
    n = len(group)
    order = np.arange(n)
    first = np.searchsorted(group, group, side="left")
    last = np.searchsorted(group, group, side="right")

    def before(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        at = common_extension(p, limit, a, b, start)
        end_a, end_b = at >= limit[a], at >= limit[b]
        column = np.minimum(start + at, text.shape[1] - 1)
        less = np.where(end_a | end_b, end_a & ~end_b, text[a, column] < text[b, column])
        return less | (end_a & end_b & ties)

    width, largest = 1, int((last - first).max(initial=0))
    while width < largest:
        at = np.arange(n)
        run = (at - first) // width
        own = first + run * width
        other = np.minimum(first + (run ^ 1) * width, last)
        low, high = other.copy(), np.minimum(other + width, last)
        right = run % 2 == 1
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            less = before(order[middle], order[open_], right[open_])
            low[open_], high[open_] = np.where(less, middle + 1, low[open_]), np.where(less, high[open_], middle)
        to = np.minimum(own, other) + (at - own) + (low - other)
        merged = np.empty(n, dtype=np.int64)
        merged[to] = order
        order, width = merged, 2 * width
    return order


def repeated(text: np.ndarray, before: np.ndarray, after: np.ndarray, group: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each row and each a, whether the window that starts a bytes before its anchor repeats in the
    group. Anchors are all in column length - gram."""
    reach = length - gram
    up = powers(BASE, text.shape[1])
    p = np.zeros((len(text), text.shape[1] + 1), dtype=np.uint64)
    np.cumsum(byte_values(BASE)[text] * up, axis=1, out=p[:, 1:])
    order = merge_sorted(text, p, after, group, reach)
    found = np.zeros((len(text), reach + 1), dtype=bool)
    partner = np.full(len(text), -1)
    for a in range(reach + 1):
        start, end = reach - a, reach - a + length
        whole = (before >= a) & (after >= length - a)
        value = p[:, end] - p[:, start]
        x, y = order[:-1], order[1:]
        same = (group[x] == group[y]) & whole[x] & whole[y] & (value[x] == value[y])
        x, y = x[same], y[same]
        kept = partner[x] == y
        true = np.empty(len(x), dtype=bool)
        true[kept] = text[x[kept], start] == text[y[kept], start]
        true[~kept] = (text[x[~kept], start:end] == text[y[~kept], start:end]).all(axis=1)
        x, y = x[true], y[true]
        found[x, a] = found[y, a] = True
        partner = np.full(len(text), -1)
        partner[x] = y
        if a < reach:
            byte = np.where(before > a, text[:, start - 1], 256).astype(np.uint16)
            order = order[np.argsort(byte[order], kind="stable")]
    return found


def contexts(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, pos, before, h, spare, text) with the context bytes of the wanted anchors."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "before", "after", "h", "spare", "hot")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k1, k2, text, asked in zip(b["k1"].to_pylist(), b["k2"].to_pylist(), b["text"].cast(pa.binary()), b["wanted"].to_pylist(), strict=True):
                data = text.as_py()
                for w in asked:
                    cut = data[w["pos"] - w["before"] : w["pos"] + w["after"]]
                    out.append((k1, k2, w["pos"], w["before"], w["h"], w["spare"], w["hot"], cut))
            columns = list(zip(*out, strict=True)) or [()] * 8
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "pos", "before", "h", "spare", "hot", "cut"])

    joined = docs.join(lists, ["k1", "k2"])
    schema = "k1 bigint, k2 bigint, pos int, before smallint, h bigint, spare boolean, hot boolean, cut binary"
    return joined.select("k1", "k2", "text", "wanted").mapInArrow(run, schema)


def sorted_spans(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, s, e) of the repeats among contexts, group by group."""
    reach = length - gram

    def spans(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        cut = t["cut"].to_pylist()
        before = t["before"].to_numpy().astype(np.int64)
        after = np.array([len(c) for c in cut]) - before
        text = np.zeros((len(cut), reach + length), dtype=np.uint8)
        for i, c in enumerate(cut):
            text[i, reach - before[i] : reach + after[i]] = np.frombuffer(c, dtype=np.uint8)
        found = repeated(text, before, after, t["h"].to_numpy(), length, gram)
        found[t["spare"].to_numpy()] = False
        edges = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        (row, low), (_, high) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        pos = t["pos"].to_numpy().astype(np.int64)[row]
        at = t.select(["k1", "k2"]).combine_chunks().take(pa.array(row))
        keys = [pa.array(at[k].to_numpy()) for k in ("k1", "k2")]
        return pa.RecordBatch.from_arrays([*keys, pa.array(pos - high + 1), pa.array(pos - low + length)], ["k1", "k2", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if n >= CHUNK:
                h = b["h"].to_numpy()
                same = h == held[-1]["h"][-1].as_py()
                split = len(h) if same.all() else int(np.argmin(same))
                held.append(b.slice(0, split))
                if split < len(h):
                    yield spans(held)
                    held, n = [], 0
                b = b.slice(split)
                if not b.num_rows:
                    n += split
                    continue
            held.append(b)
            n += b.num_rows
        if held:
            yield spans(held)

    ordered = cuts.repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, "k1 bigint, k2 bigint, s bigint, e bigint")


def counted_spans(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """As `sorted_spans`, for contexts of hot anchors: a shuffle of every window by two hashes tells whether it is
    in more than one place. Anchors close together share windows, which is one place. Windows that a batch
    already has twice are sure to repeat: one of them stands for all in the shuffle, and the others go
    through it under keys of their own, so that no window is hot."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Hasher(), Hasher(SECOND)
        for b in batches:
            got = []
            for i, cut in enumerate(b["cut"].to_pylist()):
                text = np.frombuffer(cut, dtype=np.uint8)
                before = b["before"][i].as_py()
                first = np.arange(min(reach, before) + 1)
                first = first[first + length <= len(text)]
                a, c = (x.of(x.prefixes(text), first, first + length).view(np.int64) for x in (one, two))
                fixed = (np.full(len(first), b[k][i].as_py(), dtype=np.int64) for k in ("k1", "k2", "spare"))
                got.append(np.stack([a, c, *fixed, b["pos"][i].as_py() - before + first]))
            if not got:
                continue
            a, c, k1, k2, spare, s = np.concatenate(got, axis=1)
            order = np.lexsort((spare, s, k2, k1, c, a))
            a, c, k1, k2, spare, s = (x[order] for x in (a, c, k1, k2, spare, s))
            place = np.ones(len(a), dtype=bool)
            place[1:] = (np.diff(a) != 0) | (np.diff(c) != 0) | (np.diff(k1) != 0) | (np.diff(k2) != 0) | (np.diff(s) != 0)
            a, c, k1, k2, spare, s = (x[place] for x in (a, c, k1, k2, spare, s))
            new = np.ones(len(a), dtype=bool)
            new[1:] = (np.diff(a) != 0) | (np.diff(c) != 0)
            sizes = np.diff(np.append(np.flatnonzero(new), len(a)))
            sure = np.repeat(sizes, sizes) > 1
            own = sure & ~new
            a[own], c[own] = mixed(k1[own].view(np.uint64) + s[own].astype(np.uint64)).view(np.int64), k2[own]
            columns = [pa.array(x) for x in (a, c, k1, k2, s, spare.astype(bool), sure, sure & new)]
            yield pa.RecordBatch.from_arrays(columns, ["w1", "w2", "k1", "k2", "s", "spare", "sure", "many"])

    schema = "w1 bigint, w2 bigint, k1 bigint, k2 bigint, s bigint, spare boolean, sure boolean, many boolean"
    windows = cuts.mapInArrow(run, schema)
    place, equal = F.struct("k1", "k2", "s"), Window.partitionBy("w1", "w2")
    elsewhere = (F.min(place).over(equal) < F.max(place).over(equal)) | F.max("many").over(equal)
    twice = windows.withColumn("elsewhere", elsewhere).where("(sure or elsewhere) and not spare")
    return twice.select("k1", "k2", "s", (F.col("s") + length).alias("e"))


def ranges(docs: DataFrame, length: int, gram: int, max_group: int) -> DataFrame:
    """(k1, k2, spans): the repeated ranges, not merged yet, of each row that has some."""
    found = save(anchor_rows(docs, length, gram), "anchors")
    by_anchor, by_context = Window.partitionBy("h"), Window.partitionBy("h", "c")
    counted = (
        found.where("weight > 0")
        .withColumn("n_h", F.sum("weight").over(by_anchor))
        .where("n_h > 1")
        .withColumn("n_c", F.sum("weight").over(by_context))
        .withColumn("nth", F.row_number().over(by_context.orderBy("k1", "k2", "pos")))
    )
    counted = save(counted, "repeated-anchors")
    whole = (F.col("pos") - F.col("before")).cast("bigint").alias("s"), (F.col("pos") + F.col("after")).cast("bigint").alias("e")
    equal = counted.where("n_c > 1").select("k1", "k2", *whole, "before", "after")
    sure = found.where("sure").select("k1", "k2", *whole, "before", "after")
    equal = equal.unionByName(sure).where(F.col("before") + F.col("after") >= length).select("k1", "k2", "s", "e")
    wanted = counted.where("n_c = 1 or (n_h > n_c and nth = 1)")
    wanted = wanted.select("k1", "k2", "pos", "before", "after", "h", (F.col("n_c") > 1).alias("spare"), (F.col("n_h") > max_group).alias("hot"))
    cuts = contexts(docs, wanted, length, gram)
    if wanted.where("hot").isEmpty():
        more = sorted_spans(cuts, length, gram)
    else:
        cuts = save(cuts, "contexts")
        more = sorted_spans(cuts.where("not hot"), length, gram).unionByName(counted_spans(cuts.where("hot"), length, gram))
    return equal.unionByName(more).groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of (doc_id, text), and the kept bytes if
    asked for.

    Null and empty texts have no bytes; texts shorter than `length` lose none. Repeated rows are texts
    like others and lose all bytes if long enough.
    """
    keys = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", or_empty(F.col("text")).alias("text"), keys[0].alias("k1"), keys[1].alias("k2"))
    found = ranges(rows, length, gram, max_group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for value, spans in zip(b["text"].cast(pa.binary()), b["spans"].to_pylist(), strict=True):
                data, at, kept, cut = value.as_py(), 0, [], merged(spans or [])
                for s, e in cut:
                    kept.append(data[at:s])
                    at = e
                rest = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest if keep_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [b["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(found, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    made = joined.mapInArrow(run, schema)
    return made if keep_text else made.drop("kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
