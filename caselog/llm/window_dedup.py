"""Removal of repeated word windows, found by difference-cover anchors.

Every word is removed that lies in a window of LENGTH words whose words also start earlier: in a document
of smaller id, or earlier in the same one.

The positions modulo PERIOD that are in COVER form a difference cover: for any two positions there is a
shift below PERIOD that takes both into it. So the words at cover positions are hashed only, GRAM at a
time: two equal windows, wherever they start, contain the same gram at the same shift, an anchor of both.

1. Anchors are hashed alone (h) and together with all windows around them, their context (c). Of equal
   contexts that a batch holds, the earliest stands for all in the shuffle; the others repeat.
2. A window over the anchors' hash finds contexts that stand elsewhere too, whose later ones repeat as
   a whole, and anchors with several contexts.
3. The first of each of these is extended: all windows around it are hashed and compared with the windows
   around other contexts. The windows that stand earlier too repeat.
4. The repeated ranges are merged per document, and the other words kept.

Sequences of words count as equal if two independent 64-bit hashes are: of a gram and of its context, or
two of a window.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, table
from caselog.llm.suffix_dedup import BASE, SECOND, byte_values, mixed, powers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
GRAM = LENGTH - PERIOD + 1
#: Words of a batch whose anchors are compared before the shuffle.
BATCH_WORDS = 2_000_000
#: Words whose bytes are hashed at once.
CHUNK_WORDS = 200_000
#: Contexts of one anchor that a batch sends to the anchor's task; more are extended at once.
BATCH_CONTEXTS = 4
#: Words longer than this are hashed by another function than short ones.
LONG_WORD = 255
#: Rows of repeated ids, if any, that are broadcast at most.
BROADCAST_IDS = 100_000
PLAIN, MANY, LATER, OPEN = range(4)

_BYTES = byte_values(BASE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Rolling:
    """Polynomial hashes modulo 2**64 of stretches of numbers, with powers kept between calls."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) <= n:
            self.up, self.down = powers(self.base, 2 * n + 1), powers(pow(self.base, -1, 1 << 64), 2 * n + 1)
        return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * self.up[:n])])

    def of(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end]."""
        return mixed((prefixes[end] - prefixes[start]) * self.down[start])


def word_hashes(texts: pa.Array, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a batch of binary texts, and where each text's words begin, and the end."""
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inside = ~_SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[edges] = True
    starts = np.flatnonzero(inside & (border[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (border[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    for i in range(0, len(starts), CHUNK_WORDS):
        s, e = starts[i : i + CHUNK_WORDS], ends[i : i + CHUNK_WORDS]
        hashes[i : i + CHUNK_WORDS] = rolling.of(rolling.prefixes(_BYTES[data[s[0] : e[-1]]]), s - s[0], e - s[0])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes, np.searchsorted(starts, edges)


class Scan:
    """The words of several documents, and hashes of stretches of them."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, one: Rolling, two: Rolling) -> None:
        self.first, self.n = first, np.diff(first)
        self.one, self.two = one, two
        self.p, self.q = one.prefixes(hashes), two.prefixes(mixed(hashes))

    def sequence(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.one.of(self.p, start, end)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.two.of(self.q, start, end)


def batches_of_words(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, Scan]]:
    """Batches joined until they have so many words, and their words' hashes."""
    one, two = Rolling(BASE), Rolling(SECOND)
    held, hashes, firsts, n = [], [], [], 0

    def scan() -> tuple[pa.Table, Scan]:
        return pa.Table.from_batches(held), Scan(np.concatenate(hashes), np.concatenate([*firsts, [n]]), one, two)

    for b in batches:
        if not b.num_rows:
            continue
        words, first = word_hashes(b["text"].cast(pa.binary()), one)
        held.append(b)
        hashes.append(words)
        firsts.append(first[:-1] + n)
        n += len(words)
        if n >= limit:
            yield scan()
            held, hashes, firsts, n = [], [], [], 0
    if held:
        yield scan()


def runs(*keys: np.ndarray) -> np.ndarray:
    """Whether each of the rows, which are sorted, begins a run of equal keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def spans_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each document, overlapping and adjoining ones merged."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    shift = np.int64(end.max(initial=0) + 2)
    reach = np.maximum.accumulate(end + doc * shift)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = start[1:] + doc[1:] * shift > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.append(at[1:], len(doc)) - 1] - doc[at] * shift


#: `at` holds a position and the kind of the row, and zeros stand together: rows of few bytes to shuffle.
_ROWS = "k bigint, h bigint, c bigint, id bigint, at bigint"
_POSITION, _KIND = "at div 4", "at % 4"


def _rows(t: pa.Table, parts: list[tuple]) -> pa.RecordBatch:
    """Parts (h, c, document, position, kind) as rows with the documents' keys."""
    h, c, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
    at = np.concatenate([p[3] * 4 + p[4] for p in parts])
    id_, k = (t[x].to_numpy()[doc] for x in ("id", "k"))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (k, h.view(np.int64), c.view(np.int64), id_, at)], ["k", "h", "c", "id", "at"])


def _known(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple:
    """The rows of ranges that repeat; they need not meet any other row."""
    return _spread(doc, start), end.view(np.uint64), doc, start, LATER


def _later(h: np.ndarray, c: np.ndarray, doc: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by hashes and place, and for each whether none of equal hashes is earlier."""
    order = np.lexsort((at, rank[doc], c, h))
    h, c, place, at = h[order], c[order], rank[doc[order]], at[order]
    begins = runs(h, c)
    at_first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    return order, (place == place[at_first]) & (at == at[at_first])


def _ranks(t: pa.Table) -> np.ndarray:
    """The documents' places in the order of ids; rows of one key share a place."""
    ids, keys = t["id"].to_numpy(), t["k"].to_numpy()
    order = np.lexsort((keys, ids))
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.cumsum(runs(ids[order], keys[order]))
    return rank


def _spread(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes for rows that need not meet any other."""
    return mixed(doc.astype(np.uint64) * np.uint64(SECOND) + at.astype(np.uint64))


def anchor_rows(docs: DataFrame, length: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """A row for each anchor: h, c, the document's key, its position and kind. Of LATER rows c is the range's end.

    PLAIN rows meet in the shuffle by h. Of equal contexts in a batch there is the earliest; the others
    are LATER rows, merged ranges [at, until) of repeated words. Where a batch has more than
    BATCH_CONTEXTS contexts of one anchor, one PLAIN row and one row of kind MANY stand for them, and
    all are OPEN, to be extended.
    """
    gram, reach = length - period + 1, period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s in batches_of_words(batches, BATCH_WORDS):
            doc = np.repeat(np.arange(t.num_rows), s.n)
            pos = np.arange(s.first[-1]) - s.first[doc]
            chosen = np.flatnonzero(np.isin(np.arange(period), cover)[pos % period] & (pos + gram <= s.n[doc]) & (s.n[doc] >= length))
            doc, pos = doc[chosen], pos[chosen]
            before, after = np.minimum(pos, reach), np.minimum(s.n[doc] - pos, length)
            h = s.sequence(chosen, chosen + gram)
            c = mixed(s.stretch(chosen - before, chosen + after) ^ mixed((before << 16 | after).astype(np.uint64)))
            order, first = _later(h, c, doc, pos, _ranks(t))
            doc, pos, before, after, h, c = (x[order] for x in (doc, pos, before, after, h, c))
            late = ~first
            spans = spans_of(doc[late], (pos - before)[late], (pos + after)[late])
            one = first & runs(h, c)  # rows of one key are alike
            doc, pos, h, c = (x[one] for x in (doc, pos, h, c))
            begins = runs(h)
            sizes = np.diff(np.append(np.flatnonzero(begins), len(h)))
            many = np.repeat(sizes, sizes) > BATCH_CONTEXTS
            parts = [(h[x], c[x], doc[x], pos[x], kind) for x, kind in ((~many, PLAIN), (many & begins, MANY))]
            parts.append((_spread(doc[many], pos[many]), c[many], doc[many], pos[many], OPEN))
            yield _rows(t, [*parts, _known(*spans)])

    return docs.select("id", "k", "text").mapInArrow(run, _ROWS)


def asked(rows: DataFrame) -> DataFrame:
    """(id, k, asked) of each document with repeated ranges, or contexts to extend: pairs (at, until), until
    null for the position of an anchor to extend, -1 for one whose context repeats."""
    rows = rows.repartition("h")
    same, anchor = Window.partitionBy("h", "c").orderBy("id", "k", "at"), Window.partitionBy("h")
    found = (
        rows.withColumn("nth", F.rank().over(same))
        .withColumn("several", (F.min("c").over(anchor) < F.max("c").over(anchor)) | (F.max(F.expr(_KIND)).over(anchor) == MANY))
        .withColumn("kind", F.expr(_KIND))
        .where(f"kind in ({LATER}, {OPEN}) or kind = {PLAIN} and (nth > 1 or several)")
        .withColumn("until", F.when(F.col("kind") == LATER, F.col("c")).when((F.col("kind") == PLAIN) & (F.col("nth") > 1), -1))
    )
    return found.groupBy("id", "k").agg(F.collect_set(F.struct(F.expr(_POSITION).alias("at"), "until")).alias("asked"))


def window_rows(docs: DataFrame, found: DataFrame, length: int, period: int) -> DataFrame:
    """The rows of windows around the contexts to extend, by two hashes of the window, and ranges known to
    repeat, as LATER rows. A window around several anchors is one row."""
    reach = period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s in batches_of_words(unpacked(batches), BATCH_WORDS):
            lists = t["asked"].combine_chunks()
            doc = np.repeat(np.arange(t.num_rows), pc.list_value_length(lists).fill_null(0).to_numpy())
            pairs = lists.flatten()
            at, until = pairs.field("at").to_numpy(), pairs.field("until")
            plain, until = until.is_null().to_numpy(zero_copy_only=False), until.fill_null(0).to_numpy()
            whole = until == -1
            start = np.where(whole, np.maximum(at - reach, 0), at)
            end = np.where(whole, np.minimum(at + length, s.n[doc]), until)
            doc_open, at, start, end, doc_known = doc[plain], at[plain], start[~plain], end[~plain], doc[~plain]
            back = np.arange(reach + 1)
            first = at[:, None] - back
            fits = (first >= 0) & (first + length <= s.n[doc_open][:, None])
            row, _ = np.nonzero(fits)
            first, doc = first[fits], doc_open[row]
            window = s.first[doc] + first
            h, w = s.sequence(window, window + length), s.stretch(window, window + length)
            order, earliest = _later(h, w, doc, first, _ranks(t))
            h, w, doc, first = (x[order] for x in (h, w, doc, first))
            late, one = ~earliest, earliest & runs(h, w)
            spans = spans_of(*(np.concatenate(x) for x in ((doc_known, doc[late]), (start, first[late]), (end, first[late] + length))))
            yield _rows(t, [(h[one], w[one], doc[one], first[one], PLAIN), _known(*spans)])

    # the same columns as in `deduplicate`, so that the texts are shuffled once for both
    return docs.join(found, ["id", "k"], "left").select("doc_id", "id", "k", "text", "asked").mapInArrow(run, _ROWS)


def repeated(rows: DataFrame, length: int) -> DataFrame:
    """(id, k, spans): the repeated ranges, not merged yet, of each document that has some."""
    same = Window.partitionBy("h", "c").orderBy("id", "k", "at")
    late = rows.withColumn("nth", F.rank().over(same)).where(f"{_KIND} = {LATER} or nth > 1")
    until = F.when(F.expr(_KIND) == LATER, F.col("c")).otherwise(F.expr(_POSITION) + length)
    return late.groupBy("id", "k").agg(F.collect_list(F.struct(F.expr(_POSITION).alias("at"), until.alias("until"))).alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the document's key: id, by which documents are ordered, and k, zero unless the id
    is null or stands in several rows. Rows of one id and text have one key."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("_again"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    text = or_empty(F.col("text"))
    k = F.when(F.col("doc_id").isNull(), F.xxhash64(text, F.lit("null"))).when(F.col("_again"), F.xxhash64(text))
    last = F.lit((1 << 63) - 1)
    return docs.select("doc_id", text.alias("text")).join(ids, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("doc_id").cast("bigint"), last).alias("id"), F.coalesce(k, F.lit(0)).alias("k"), "text"
    )


def packed(docs: DataFrame) -> DataFrame:
    """The documents with their texts compressed: they are the larger part of what is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            pressed = pa.array([press(t.as_py()) for t in b["text"].cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["id"], b["k"], pressed], ["doc_id", "id", "k", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, id bigint, k bigint, text binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of `packed` documents with their texts as they were."""
    unpress = zstandard.ZstdDecompressor().decompress
    for b in batches:
        if b.num_rows:
            texts = pa.array([unpress(t.as_py()) for t in b["text"]], pa.binary())
            yield b.set_column(b.schema.get_field_index("text"), "text", texts)


def deduplicate(
    docs: DataFrame, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER, keep_text: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of (doc_id, text), and the kept words if asked for.

    Ids are whole numbers; a null id comes after all others. Rows of one id and different texts are different
    documents, in the order of a hash of their texts; rows of one id and text are one document, and get
    the same result. Null and empty texts have no words; texts of fewer than `length` words lose none.
    Every two numbers below `period` must be taken into `cover` by one shift, and `period` be at most `length`.
    """
    if period > length or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover modulo a period of at most the length")
    rows = keyed(docs)
    known = asked(anchor_rows(rows, length, period, cover))
    rows = packed(rows)
    found = repeated(window_rows(rows, known, length, period), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in unpacked(batches):
            out = []
            for value, spans in zip(b["text"], b["spans"].to_pylist(), strict=True):
                words, kept, at = value.as_py().split(), [], 0
                for s, e in sorted((x["at"], x["until"]) for x in spans or []):
                    kept += words[at:s] if at < s else []
                    at = max(at, e)
                kept += words[at:]
                rest = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode() if keep_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 4
            arrays = [b["doc_id"], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    joined = rows.join(found, ["id", "k"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = joined.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return made if keep_text else made.drop("kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


ORACLE = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
windows as (
  select doc_id, i, array_to_string(words[i : i + 19], ' ') as w
  from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from texts)
),
late as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by w order by doc_id, i) as nth from windows) where nth > 1
),
marked as (
  select t.doc_id, t.i, t.word,
    max(l.i) over (partition by t.doc_id order by t.i rows between 19 preceding and current row) is not null as removed
  from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from texts) t
  left join late l on l.doc_id = t.doc_id and l.i = t.i
),
kept as (
  select doc_id, count(*) filter (removed) as n_removed, string_agg(word, ' ' order by i) filter (not removed) as rest
  from marked group by doc_id
)
select t.doc_id, cast(len(t.words) as bigint) as n_words, coalesce(k.n_removed, 0) as n_removed,
  sha256(coalesce(k.rest, '')) as kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""
