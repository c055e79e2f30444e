"""Language-model scores by prediction by partial matching over bytes.

A text is its words, ASCII lower case and joined by one space, then one end. A byte is predicted from
the ORDER bytes before it, across word borders; before a text stand ends. A context that has
seen the byte n times gives it (n - d) / T for T bytes seen, d the DISCOUNT. Else, of U different bytes seen, it
escapes with d U / T to the next shorter context, whose distribution is taken without the bytes the longer one has seen:
symbol exclusion. Below the empty context all bytes are alike.

The probability of a byte depends on its gram alone, the ORDER bytes before it and itself. Grams of all
documents are counted per batch and summed in a shuffle; shorter contexts are sums over grams. All
contexts of two bytes or more of one prediction end in the same two, so grams are coded in parts by
those two bytes, beside the counts of single bytes and pairs, of which there are at most 65,536. No trie
is gathered.

Of the most frequent grams, at most MAX_FREQUENT have their code in a broadcast; those with a millionth
of all tokens, at most a million, are the words that documents look up in one. All other grams and words
are summed through a shuffle, one row per document and gram or word.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, remainder, table
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 6
FOLDS = 10
MAX_NODES = 2_000_000
MAX_FREQUENT = 2_000_000
FREQUENT_SHARE = 1_000_000
HELD_WORDS = 300_000
HELD_BYTES = 8_000_000
PIECE = 200_000
SPACE, END = 32, 10
SMOOTHING = 0.1
DISCOUNT = 0.3


def tokens(text: bytes) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only."""
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, n): occurrences in training documents and in all. Counted per task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(train.keys() | rest.keys())
            c = [train[w] for w in words]
            n = [a + rest[w] for a, w in zip(c, words, strict=True)]
            train.clear(), rest.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], ["word", "c", "n"])

        for b in batches:
            for text, held in zip(b["text"].cast(pa.binary()), b["held"].to_pylist(), strict=True):
                (rest if held else train).update(tokens(text.as_py()))
            if len(train) + len(rest) > HELD_WORDS:
                yield flush()
        yield flush()

    rows = docs.select(or_empty(F.col("text")).alias("text"), (remainder(F.col("doc_id"), FOLDS) == 0).alias("held"))
    parts = rows.mapInArrow(run, "word binary, c bigint, n bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def spelled(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, ORDER ends before each and one after it; and for each byte but the first, how
    many bytes of context it is predicted from, -1 for the ends before a text."""
    pad, end = bytes([END]) * ORDER, bytes([END])
    text = np.frombuffer(b"".join([x for t in texts for x in (pad, t, end)]), dtype=np.uint8)
    runs = [n for t in texts for n in (ORDER, len(t) + 1)]
    return text, np.repeat(np.tile([-1, ORDER], len(texts)), runs)[1:]


def keys(text: np.ndarray, order: int) -> np.ndarray:
    """For each byte but the first, the `order` bytes before it and itself as one number; the leading
    ones, which lack context, are short of bytes."""
    key = np.zeros(len(text) - 1, dtype=np.int64)
    for back in range(order, -1, -1):
        key <<= 8
        skip = max(back - 1, 0)
        key[skip:] |= text[1 - min(back, 1) : max(len(text) - back, 0)]
    return key


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys and where each starts in the sorted keys."""
    key = np.sort(key)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.append(first, len(key))


def pieces(texts: list, size: int) -> Iterator[slice]:
    """Slices of the texts of about this many bytes, a text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(key, c, n): how often each gram of `order` bytes of context and one more occurs in training
    documents and in all. Counted per batch, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, train, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for part in pieces(held, HELD_BYTES):
                text, context = spelled(held[part])
                mark = np.repeat(train[part], [len(t) + 1 for t in held[part]])
                found, first = distinct(keys(text, order)[context >= 0] << 1 | mark)
                n = np.diff(first)
                c = np.where(found & 1 == 1, n, 0)
                for i in range(0, len(found), HELD_WORDS):
                    arrays = [pa.array(x[i : i + HELD_WORDS]) for x in (found >> 1, c, n)]
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "c", "n"])

        for b in batches:
            for text, out in zip(b["text"].cast(pa.binary()), b["held"].to_pylist(), strict=True):
                held.append(b" ".join(tokens(text.as_py())))
                train.append(int(not out))
                size += len(held[-1]) + 1
            if size >= HELD_BYTES:
                yield from flush()
                held, train, size = [], [], 0
        yield from flush()

    rows = docs.select(or_empty(F.col("text")).alias("text"), (remainder(F.col("doc_id"), FOLDS) == 0).alias("held"))
    parts = rows.mapInArrow(run, "key bigint, c bigint, n bigint")
    return parts.groupBy("key").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def levels_of(k: np.ndarray, key: np.ndarray, n: np.ndarray) -> Levels:
    """Sorted arrays by order: seen (context, byte) and log10 of their probability; contexts, and log10
    of what the probability of a byte they haven't seen is multiplied by."""
    levels = []
    top = int(k.max(initial=-1))
    sorted_keys = [np.sort(key[k == order]) for order in range(top + 1)]
    counts = [n[k == order][np.argsort(key[k == order])].astype(float) for order in range(top + 1)]
    lower_key, lower_p = np.arange(256), np.full(256, 1 / 256)
    for order in range(top + 1):
        own, count = sorted_keys[order], counts[order]
        contexts, first, kinds = np.unique(own >> 8, return_index=True, return_counts=True)
        total = np.add.reduceat(count, first) if len(own) else np.zeros(0)
        p = (count - DISCOUNT) / np.repeat(total, kinds)
        shorter = own & ((1 << 8 * max(order, 1)) - 1)
        excluded = lower_p[np.minimum(np.searchsorted(lower_key, shorter), len(lower_key) - 1)]
        mass = np.add.reduceat(excluded, first) if len(own) else np.zeros(0)
        escape = DISCOUNT * kinds / total / np.maximum(1 - mass, 1e-12)
        levels.append((own, np.log10(p), contexts, np.log10(np.maximum(escape, 1e-300))))
        lower_key, lower_p = own, p
    return levels


def code_of(levels: Levels, text: np.ndarray, context: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """log10 of the probability of each byte but the first, where wanted; else zero."""
    return code_of_keys(levels, keys(text, max(len(levels) - 1, 0)), context, wanted)


def code_of_keys(levels: Levels, keys: np.ndarray, context: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys))
    left = wanted.copy()
    for k in range(len(levels) - 1, -1, -1):
        own, logp, contexts, escape = levels[k]
        at = np.flatnonzero(left & (context >= k))
        if not len(at) or not len(own):
            continue
        key = keys[at] & ((1 << 8 * (k + 1)) - 1)
        i = np.minimum(np.searchsorted(own, key), len(own) - 1)
        hit = own[i] == key
        out[at[hit]] += logp[i[hit]]
        left[at[hit]] = False
        at, key = at[~hit], key[~hit] >> 8
        i = np.minimum(np.searchsorted(contexts, key), len(contexts) - 1)
        known = contexts[i] == key
        out[at[known]] += escape[i[known]]
    out[left] += np.log10(1 / 256)
    return out


def coded(grams: DataFrame, order: int, limit: int = MAX_NODES) -> DataFrame:
    """(key, n, code) of the grams: `code` is the log10 probability of the last byte after the others.

    Grams whose contexts end in the same two bytes are coded together, and several such sets at once up
    to about `limit` grams.
    """
    spark = grams.sparkSession
    short = min(order, 1)
    pairs = grams.where("c > 0").groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (short + 1)) - 1)).alias("key")).agg(F.sum("c").alias("n"))
    pairs = sorted((r["key"], r["n"]) for r in pairs.collect())
    shared = spark.sparkContext.broadcast(np.array(pairs, dtype=np.int64).reshape(-1, 2))

    def summed(key: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        key = key & ((1 << 8 * (order + 1)) - 1)
        found, at = np.unique(key, return_inverse=True)
        return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value

        def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            key, c, n = rows
            seen = c > 0
            sums = [summed(*counts.T, k) for k in range(short + 1)] + [summed(key[seen], c[seen], k) for k in range(2, order + 1)]
            level = np.repeat(np.arange(len(sums)), [len(x) for x, _ in sums])
            levels = levels_of(level, *(np.concatenate(x) for x in zip(*sums, strict=True)))
            code = code_of_keys(levels, key, np.full(len(key), order), np.full(len(key), True))
            for i in range(0, len(key), HELD_WORDS):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + HELD_WORDS]) for x in (key, n, code)], ["key", "n", "code"])

        held, size, wait = [], 0, limit
        for b in batches:
            held.append(np.stack([b[x].to_numpy() for x in ("key", "c", "n")]))
            size += b.num_rows
            if size >= wait:
                rows = np.concatenate(held, axis=1)
                pair = rows[0] >> 8 & 0xFFFF
                cut = int(np.searchsorted(pair, pair[-1]))
                if cut:
                    yield from done(rows[:, :cut])
                held, size = [rows[:, cut:]], rows.shape[1] - cut
                wait = max(limit, 2 * size)
        if size:
            yield from done(np.concatenate(held, axis=1))

    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = grams.withColumn("pair", pair).repartition("pair").sortWithinPartitions("pair")
    return dealt.select("key", "c", "n").mapInArrow(run, "key bigint, n bigint, code double")


def least_frequent(grams: DataFrame, limit: int) -> float:
    """A count that at most `limit` grams reach."""
    steps = grams.groupBy(F.floor(F.log2("n") * 16).alias("step")).count().collect()
    size, least = 0, float("inf")
    for r in sorted(steps, key=lambda r: -r["step"]):
        size += r["count"]
        if size > limit:
            break
        least = r["step"]
    return least


Slots = list[tuple[int, int, np.ndarray, np.ndarray]]


def slots_of(key: np.ndarray, code: np.ndarray) -> Slots:
    """The codes in hash tables: keys whose place in one is taken are in the next."""
    slots = []
    factor = 0x9E3779B97F4A7C15
    while len(key):
        bits = len(key).bit_length() + 1
        place = (key.astype(np.uint64) * np.uint64(factor) >> np.uint64(64 - bits)).astype(np.int64)
        at = np.full(1 << bits, -1, dtype=np.int64)
        at[place] = np.arange(len(key))
        won = at[place] == np.arange(len(key))
        held, codes = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits)
        held[place[won]], codes[place[won]] = key[won], code[won]
        slots.append((factor, bits, held, codes))
        key, code = key[~won], code[~won]
        factor = factor * 0xD1342543DE82EF95 + 2 & (1 << 64) - 1 | 1
    return slots


def looked_up(slots: Slots, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes, zero for other keys; and the places of those. A key whose place is free in one table is in
    none of the later ones."""
    out, known = np.zeros(len(key)), np.zeros(len(key), dtype=bool)
    left, own = np.arange(len(key)), key
    for factor, bits, held, codes in slots:
        place = (own.view(np.uint64) * np.uint64(factor) >> np.uint64(64 - bits)).view(np.int64)
        there = held[place]
        hit = there == own
        at = np.flatnonzero(hit)
        out[left[at]] = codes[place[at]]
        known[left[at]] = True
        taken = np.flatnonzero(~hit & (there >= 0))
        left, own = left[taken], own[taken]
    return out, np.flatnonzero(~known)


def hashed(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def score(docs: DataFrame, order: int = ORDER, max_nodes: int = MAX_NODES) -> DataFrame:
    """Base score and model score of each row of (doc_id, text).

    Null and empty texts are the end alone. Each row is scored by itself; repeated rows count as often in
    the training. Without training rows every word is new to both models.
    """
    spark = docs.sparkSession
    held_out = (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out")
    n_train = docs.select(held_out).where("not held_out").count()
    words = save(word_counts(docs), "words")
    grams = save(coded(save(gram_counts(docs, order), "grams"), order, max_nodes), "coded-grams")
    step = F.floor(F.log2("n") * 16)
    least = least_frequent(grams, MAX_FREQUENT)
    often = grams.where(step >= least).select("key", "code").toArrow()
    sums = words.agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v"), F.sum("n").alias("n")).first()
    total = (sums["c"] or 0) + n_train
    distinct = sums["v"] + (n_train > 0)
    norm = np.log10(total + SMOOTHING * (distinct + 1))
    base = F.log10(F.col("c") + SMOOTHING) - float(norm)
    entries = words.select("word", (F.col("c") > 0).alias("known"), base.alias("base"), "n")
    is_frequent = F.col("n") * FREQUENT_SHARE >= max(sums["n"] or 0, 1)
    top = entries.where(is_frequent).toArrow()
    shared = spark.sparkContext.broadcast(
        {
            "index": {w: i for i, w in enumerate(top["word"].to_pylist())},
            "known": top["known"].to_numpy(zero_copy_only=False).astype(np.int64),
            "base": top["base"].to_numpy(),
            "key": often["key"].to_numpy().astype(np.int64),
            "code": often["code"].to_numpy(),
        }
    )
    end = (int(n_train > 0), float(np.log10(n_train + SMOOTHING) - norm))

    def lists(held: list[list[tuple[int, int]]]) -> pa.Array:
        flat = [x for v in held for x in v]
        offsets = np.cumsum([0] + [len(v) for v in held])
        pairs = [pa.array([h for h, _ in flat], pa.int64()), pa.array([n for _, n in flat], pa.int32())]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(pairs, ["word", "times"]))

    def gram_codes(slots: Slots, texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        """Sums of the frequent grams' codes by text, and each text's other grams with their times."""
        text, context = spelled(texts)
        key = keys(text, order)[context >= 0]
        code, other = looked_up(slots, key)
        lengths = np.array([len(t) + 1 for t in texts])
        starts = np.cumsum(lengths) - lengths
        row, word = np.repeat(np.arange(len(texts)), lengths)[other], key[other]
        at = np.lexsort((word, row))
        row, word = row[at], word[at]
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1]))) if len(row) else np.zeros(0, dtype=np.int64)
        pairs = [pa.array(word[first]), pa.array(np.diff(np.append(first, len(row))).astype(np.int32))]
        offsets = np.searchsorted(row[first], np.arange(len(texts) + 1)).astype(np.int32)
        return np.add.reduceat(code, starts), pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(pairs, ["word", "times"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shared.value
        if "slots" not in have:
            have["slots"] = slots_of(have["key"], have["code"])
        index, known, base = have["index"], have["known"], have["base"]
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            texts = [x.as_py() for x in b["text"].cast(pa.binary())]
            for part in pieces(texts, PIECE):
                out, normal = [], []
                for text in texts[part]:
                    held = tokens(text)
                    normal.append(b" ".join(held))
                    own = Counter(held)
                    at = [(index[w], n) for w, n in own.items() if w in index]
                    rare = [(hashed(w), n) for w, n in own.items() if w not in index]
                    i, n = np.array(at, dtype=np.int64).reshape(-1, 2).T
                    out.append((row, len(held) + 1, int(n @ known[i]) + end[0], float(n @ base[i]) + end[1], rare))
                    row += 1
                columns = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                code, grams = gram_codes(have["slots"], normal)
                arrays = [b["doc_id"][part.start : part.stop], *arrays, pa.array(code), lists(columns[4]), grams]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row", "n_tokens", "n_known", "base", "code", "rare", "grams"])

    source = docs.select("doc_id", or_empty(F.col("text")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    uses = "array<struct<word:bigint,times:int>>"
    schema = f"doc_id {kind}, row bigint, n_tokens bigint, n_known bigint, base double, code double, rare {uses}, grams {uses}"
    rows = save(source.mapInArrow(run, schema), "scored-rows")

    used = lambda c: rows.select("row", F.explode(c).alias("x")).select("row", "x.word", "x.times")
    added = (
        used("rare")
        .join(made_rare(entries.where(~is_frequent)), "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("known").cast("bigint")).alias("n_known2"), F.sum(F.col("times") * F.col("base")).alias("base2"))
    )
    rare_grams = grams.where(step < least).select(F.col("key").alias("word"), F.col("code").alias("gram_code"))
    coded_more = used("grams").join(rare_grams, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("gram_code")).alias("code2"))
    joined = rows.drop("rare", "grams").join(added, "row", "left").join(coded_more, "row", "left")
    plus = lambda c, d: F.col(c) + F.coalesce(F.col(d), F.lit(0))
    return joined.select(
        "doc_id",
        held_out,
        "n_tokens",
        plus("n_known", "n_known2").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        plus("base", "base2").alias("base_score"),
        plus("code", "code2").alias("score"),
    )


def made_rare(entries: DataFrame) -> DataFrame:
    """Entries under the hash of their word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = pa.array([hashed(w) for w in b["word"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([marks, b["known"], b["base"]], ["word", "known", "base"])

    return entries.select("word", "known", "base").mapInArrow(run, "word bigint, known boolean, base double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
