"""Lexical search, clustering and word-window dedup against brute force, on whole small tables and odd rows."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from caselog.llm import clustering, lexical_search, window_dedup

TERM, WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def late_windows(rows, length):
    """(words, removed places) of each distinct (id, text), ids in order and null last."""
    docs = {(i, t or ""): WORD.findall(t or "") for i, t in rows}
    seen, out = {}, {}
    first = sorted(docs, key=lambda k: (k[0] is None, k[0] or 0))
    for key in first:
        words, gone = docs[key], set()
        for s in range(len(words) - length + 1):
            w = tuple(words[s : s + length])
            if w in seen:
                gone.update(range(s, s + length))
            seen.setdefault(w, (key, s))
        out[key] = words, gone
    return out


def digests(rows, length):
    known = late_windows(rows, length)
    out = []
    for i, t in rows:
        words, gone = known[i, t or ""]
        rest = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), sha256(rest.encode()).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("batch_words,contexts", [(2_000_000, 4), (50, 4), (2_000_000, 1)])
def test_windows_anywhere_are_found(spark, small, monkeypatch, batch_words, contexts):
    """Passages at all distances modulo the period, overlapping, and in one document twice."""
    monkeypatch.setattr(window_dedup, "BATCH_WORDS", batch_words)
    monkeypatch.setattr(window_dedup, "BATCH_CONTEXTS", contexts)
    rng = random.Random(7)
    passages = [[f"p{k}w{i}" for i in range(n)] for k, n in enumerate((19, 20, 21, 33, 60, 200))]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(5)):
            words += [rng.choice("abcdefgh") for _ in range(rng.randrange(30))]
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            words += p[a : a + rng.randrange(len(p))]
        rows.append((i, rng.choice((" ", "\n", "\t ")).join(words)))
    rows.append((80, " ".join(["same"] * 100)))
    rows.append((81, "x" * 5000 + " " + " ".join(["same"] * 20)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(window_dedup.deduplicate(docs)) == digests(rows, 20)


def test_windows_of_whole_documents(spark, small, texts):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert found(window_dedup.deduplicate(docs)) == digests(list(texts.items()), 20)


def test_windows_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = found(window_dedup.deduplicate(odd, length=3, period=3, cover=(0, 1)))
    assert got == digests(rows, 3)
    kept = window_dedup.deduplicate(odd, keep_text=True).where("doc_id = 8").first().kept
    assert kept == "é😀 ß\u00a0x"  # two words, as no ASCII space parts the second; every later window repeats
    assert window_dedup.deduplicate(empty).count() == 0
    with pytest.raises(ValueError, match="difference cover"):
        window_dedup.deduplicate(odd, length=5, period=13)


def test_text_fields_are_told_apart_by_whole_words(spark, small):
    """Words that differ only beyond the bytes hashed in one go, and words that join to the same bytes."""
    base = ["w"] * 19
    rows = [(1, " ".join(["a" * 300 + "b", *base])), (2, " ".join(["a" * 300 + "c", *base])), (3, " ".join(["ab", *base])), (4, " ".join(["a", "b", *base]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(window_dedup.deduplicate(docs)) == digests(rows, 20)


def ranking(rows, items, top):
    docs = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in rows]
    n_docs, total = sum(bool(d) for _, d in docs), sum(len(d) for _, d in docs)
    df = Counter(t for _, d in docs for t in set(d))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, d in docs:
            m, tf = 100 - 50 + (50 * len(d) * n_docs) // max(total, 1), Counter(d)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


@pytest.mark.parametrize("vocabulary", [100_000, 10])
def test_search_over_many_shards_and_bundles(spark, small, texts, monkeypatch, vocabulary):
    monkeypatch.setattr(lexical_search, "BROADCAST_TERMS", vocabulary)
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = lexical_search.search(docs, items, top=5, owners=4, bundle=7, shard=16)
    assert found(got) == ranking(list(texts.items()), [(r.item_id, r.text) for r in items.collect()], 5)


def test_search_of_odd_rows(spark, odd, empty):
    asked = [(1, "same TEXT rows é😀"), (1, "word"), (None, "ß one"), (3, None), (4, ""), (5, "nowhere")]
    items = spark.createDataFrame(asked, "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(lexical_search.search(odd, items, shard=2)) == ranking(rows, asked, 50)
    assert found(lexical_search.search(odd, items, top=2, shard=2, bundle=1)) == ranking(rows, asked, 2)
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


def test_an_owner_leaves_out_only_hopeless_documents():
    """The bar is what the later owners can add at most."""
    import pyarrow as pa

    spec = [{"item": 0, "tid": 1, "w": 10, "most": 100, "owner": 0}, {"item": 0, "tid": 2, "w": 1, "most": 5, "owner": 1}]
    spec_type = pa.list_(pa.struct([("item", pa.int32()), ("tid", pa.int64()), ("w", pa.int64()), ("most", pa.int64()), ("owner", pa.int32())]))
    acc_type = pa.list_(pa.struct([("item", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))
    state = pa.table({"bundle": pa.array([0], pa.int32()), "shard": pa.array([0], pa.int32()), "spec": pa.array([spec], spec_type), "acc": pa.array([[]], acc_type)})
    gains = [10, 9, 9, 8]
    postings = pa.table({"row": pa.array(range(4), pa.int64()), "doc_id": pa.array([4, 3, None, 1], pa.int64()), "tid": pa.array([1] * 4, pa.int64()), "gain": pa.array(gains, pa.int64())})
    after = lexical_search.added(state, postings, 0, 2)["acc"][0].as_py()
    assert [(a["row"], a["score"]) for a in after] == [(1, 90), (0, 100), (2, 90)]  # 80 + 5 can't reach 90


def clusters(vectors, k, rounds):
    """{vec_id: (cluster, distance)} and centroids, by all distances."""
    centroids = [v for _, v in sorted((sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in vectors)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in vectors:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return {i: near(v)[::-1] for i, v in vectors}, centroids


def test_clusters_with_ties_and_copies(spark, small):
    rng = random.Random(3)
    vectors = [(i, [rng.randrange(-2, 3) for _ in range(4)]) for i in range(200)]
    vectors += [(200 + i, [1, 1, 1, 1]) for i in range(100)]
    df = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in vectors], "vec_id bigint, embedding array<float>").repartition(3)
    got = clustering.cluster(df, k=9, rounds=3, size=4).collect()
    want, centroids = clusters(vectors, 9, 3)
    assert {r.vec_id: (r.cluster, r.distance) for r in got} == want
    assert {r.inertia for r in got} == {sum(d for _, d in want.values())}
    for r in got:
        assert r.cluster_inertia == sum(d for c, d in want.values() if c == r.cluster)
        assert r.centroid_sha256 == sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_bisectors_agree_with_all_distances():
    rng = np.random.default_rng(5)
    top = clustering.LIMIT - 1
    for high in (3, 1000, top):
        v, c = rng.integers(-high, high + 1, (500, 6)), rng.integers(-high, high + 1, (20, 6))
        v[:20], c[19] = c, c[0]
        b = clustering.Bisectors(c)
        every = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert (b.winners(v) == every.argmin(axis=1)).all()
        assert (b.distances(v, b.winners(v)) == every.min(axis=1)).all()


def test_clusters_of_odd_rows(spark, small):
    ok, other = [0.5] * 64, [-0.25] * 64
    odd = [(1, ok), (1, ok), (None, other), (2, None), (3, []), (4, ok[:63]), (5, [*ok, 1.0]), (6, [None, *ok[1:]]), (7, [math.nan, *ok[1:]]), (8, [math.inf, *ok[1:]]), (9, [1e30, *ok[1:]])]
    df = spark.createDataFrame([(*r, 1, 2) for r in odd], "vec_id bigint, embedding array<float>, v int, cluster int")
    got = Counter((r.vec_id, r.distance, r.inertia) for r in clustering.cluster(df).collect())
    assert got == Counter({(1, 0, 0): 2, (None, 0, 0): 1})
    assert clustering.cluster(df.limit(0)).count() == 0
    assert clustering.cluster(df.where("vec_id = 3")).columns == clustering.cluster(df).columns
