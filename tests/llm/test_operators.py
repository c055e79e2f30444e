"""Each operator against brute force, on the smallest test table and on odd rows."""

import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselog.llm import (
    chat,
    decontamination,
    language_model,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    suffix_dedup,
)
from caselog.llm.queries import ORACLES, QUERIES
from caselog.llm.spans import joined
from tests.compare import differences, oracle_connection
from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS


@pytest.fixture(scope="session")
def both(spark, small, odd, texts):
    """The small table and the odd rows, as (frame, rows)."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    return [(docs, list(texts.items())), (odd, ODD_TEXTS)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, small, name):
    assert differences(spark, oracle_connection(small), QUERIES[name], ORACLES[name], small) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pii_base_spans(both):
    for docs, rows in both:
        got = pii.find(docs).select("doc_id", joined(F.col("base"))).collect()
        assert Counter(map(tuple, got)) == Counter((d, brute.joined(brute.pii(x))) for d, x in rows)


def test_pii_matches_start_as_plainly_searched(spark, small):
    texts = [
        "a@b.c_d@e.f.g x@y.z..w@v.u", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3.4.", "4111 1111-1111 1111 é 4111111111111111 5",
        "+1 (2) 3.4-567 8901 +12345678901234567", "@@ x@y", "é😀 a.b@c.de 10.0.0.1",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r[0]: r[1] for r in pii.find(df).select("doc_id", joined(F.col("base"))).collect()} == {
        i: brute.joined(brute.pii(t)) for i, t in enumerate(texts)
    }


def test_pii_finds_planted_forms_and_leaves_decoys(spark, small):
    base = "please call +1 {0} 555 {1} or write to ann{0}@host.org, server 10.0.0.7 is up. Paid by card 4111 1111 1111 1111 on 2024-01-12. Order 2024{1} at 12:34:56"
    planted = ["please call {0} 555-{1} today", "mail name{0} (at) host{0} (dot) org. Next we go", "the server fe80:0:0:0:12:34ff:fe56:{1} answers"]
    decoys = ["on 2024-01-02 we met @ noon. Then left", "order number 12345678 was sent", "pi is 3.14159265", "at 12:34:56:78 the run ended",
              "isbn 978-3-16-148410-0", "look at example.com now", "card 4111.1111.1111.1112 fails", "years 1999-2003 and 1 000 000 people"]
    rows = [(i, base.format(200 + i, 1000 + i)) for i in range(100)]
    rows += [(1000 + i, planted[i % 3].format(200 + i, 1000 + i)) for i in range(300)]
    rows += [(2000 + i, d) for i, d in enumerate(decoys)]
    df = pii.find(spark.createDataFrame(rows, "doc_id int, text string"))
    got = {r[0]: (r[1], r[2]) for r in df.select("doc_id", joined(F.col("base")), joined(F.col("spans"))).collect()}
    place = [("phone", 12), ("email", 5), ("ip", 11)]
    ends = [24, 35, 39]
    assert all(got[1000 + i] == ("", f"{k}:{s}:{e}") for i in range(300) for (k, s), e in [(place[i % 3], ends[i % 3])])
    assert all(got[2000 + i] == ("", "") for i in range(len(decoys)))
    assert all(got[i][0] == got[i][1] and got[i][0].count(":") == 8 for i in range(100))


def test_pii_without_base_spans_adds_nothing(spark, small):
    df = pii.find(spark.createDataFrame([(1, "call 200 555-1000"), (2, None), (3, "")], "doc_id int, text string"))
    assert [r[0] for r in df.select(F.size("spans")).collect()] == [0, 0, 0]


def test_pii_is_within_the_kind(spark, small):
    """A candidate is dropped unjudged only where it touches a base span of its own kind."""
    df = pii.candidates(spark.createDataFrame([(1, "call 10.20.30.40 or a@b.org")], "doc_id int, text string"), "doc_id")
    row = df.first()
    assert [x["kind"] for x in row["base"]] == ["email", "ip"]
    failed = [("card", False)] * 4  # each number is a base match that fails the check
    assert [(x["kind"], x["ok"]) for x in row["others"]] == [*failed, ("phone", False)]


def test_chat_reads_back_hostile_texts(spark, small):
    hostile = ["<|end|>", "<\\|end|>", "<\\\\|turn|>x", "<<SYS>>", "<<<SYS>>[[INST]<s></s>", "a<|", "|end|>", "\n", "", "<|text|>[/INST"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in hostile for t in hostile)]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    turns = made.select(chat.read_back(F.col("formatted"))).first()[0]
    assert [tuple(t) for t in turns] == [(r, t) for _, _, r, t in rows]


def test_chat_rows_with_nulls_and_ties(spark, small):
    rows = [(None, 1, None, None, 7), (None, 1, None, None, 7), (2, None, "assistant", "b", 7), (2, 0, "assistant", "a", 7)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, formatted int")
    got = {r[0]: (r[1], r[2]) for r in chat.format_chats(df).select("conv_id", F.size(chat.read_back(F.col("formatted"))), chat.under_mask(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert got == {None: (2, ""), 2: (2, "ba")}


def test_chat_layouts_by_fingerprint(spark, small):
    records = [
        '{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}',
        '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":null}]}',
        '{"instruction":"i","input":"more","output":"o"}',
        '{"answer":"c","question":"p"}',
        '{"other":1}', "{broken", None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, j string")
    got = [(r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical_records(df, "j").orderBy("i").collect()]
    assert got == [
        ("messages", [("user", "a"), ("assistant", "b")]),
        ("conversations", [("user", "x"), ("assistant", "")]),
        ("instruction with input", [("user", "i\n\nmore"), ("assistant", "o")]),
        ("question", [("user", "p"), ("assistant", "c")]),
        (None, None), (None, None), (None, None),
    ]


def test_chat_layouts_among_other_fields(spark, small):
    records = [
        '{"id":7,"messages":[{"role":"user","content":"a"}]}',
        '{"messages":[]}',
        '{"messages":[{"role":"user","content":"a","weight":{"w":[1]}},{"content":"b"},{"role":"gpt"}]}',
        '{"source":{"name":"s","tags":["t"]},"instruction":"i","output":"o"}',
        '{"prompt":"p","completion":"c"}',
        '{"prompt":null,"response":2,"question":"q"}',
        '{"output":"o","input":"","instruction":"i","prompt":"p","response":"r"}',
        '{"messages":[{"role":null,"content":null}]}',
        '{"messages":[{"role":"user"}]}', '{"messages":"text"}', '{"messages":null}', '{"prompt":"p","prompt":"p","completion":"c"}',
        '{"prompt":"p","completion":"c"', "[]", "[1]", "3", "", "{}", '{"messages":[null]}',
    ]
    df = spark.createDataFrame([(i, r, "kept") for i, r in enumerate(records)], "i int, j string, source string")
    rows = chat.canonical_records(df, "j").orderBy("i").collect()
    assert all(r["source"] == "kept" for r in rows)
    got = [(r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in rows]
    assert got == [
        ("messages", [("user", "a")]),
        ("messages", []),
        ("messages", [("user", "a"), ("", "b"), ("assistant", "")]),
        ("instruction", [("user", "i"), ("assistant", "o")]),
        ("prompt", [("user", "p"), ("assistant", "c")]),
        ("response", [("user", ""), ("assistant", "2")]),
        ("instruction with input", [("user", "i"), ("assistant", "o")]),
        ("messages", [("", "")]),
    ] + [(None, None)] * 11
    assert chat.canonical_records(df.limit(0), "j").collect() == []
    long = '{"prompt":"' + "x y " * 200_000 + '","completion":"c"}'
    made = chat.canonical_records(spark.createDataFrame([(long,)], "j string"), "j").first()["turns"]
    assert [len(t["text"]) for t in made] == [800_000, 1]


def test_chat_layout_of_a_frame(spark, small):
    frame = spark.createDataFrame([(1, "p", "c", 9)], "conv_id int, prompt string, completion string, extra int")
    assert chat.layout_of(frame.schema).name == "prompt"
    assert [tuple(t) for t in chat.canonical_turns(frame).first()["turns"]] == [("user", "p"), ("assistant", "c")]


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_HASHES, 0])
def test_decontamination(spark, both, texts, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_HASHES", limit)
    words = texts[7].split()
    items = [(1, " ".join(words[3:40])), (2, " ".join(words[3:40])), (3, "one two"), (4, "ONE"), (5, None), (6, "..."),
             (7, "same LINE the same line the same line the same line the same line the same line"), (8, " ".join(words[5:17]))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    for docs, rows in both:
        got = decontamination.decontaminate(docs, bench).collect()
        want = brute.contaminated(rows, items)
        order = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert Counter(tuple(r[c] for c in order) for r in got) == Counter(want)
        assert decontamination.drop_contaminated(docs, bench).count() == sum(not w[-1] for w in want)


def test_decontamination_finds_words_quickly(spark, small):
    ranges = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    chars = [chr(c) for c in (*range(0x180), 0x2028, 0x3000, 0xFFFD, 0x1F600)]
    odd = spark.createDataFrame([(f"a{c}b{c}{c}C{c}9",) for c in chars], "text string")
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (decontamination.WORD, ranges)]
    assert odd.where(found[0] != found[1]).count() == 0

    line = "The quick brown fox, and 12 lazy dogs of K\u00f6ln. "
    long = spark.range(64, numPartitions=8).select(F.repeat(F.concat(F.lit(line), "id"), 4000).alias("text"))

    def seconds(pattern):
        def once():
            began = time.perf_counter()
            assert long.agg(F.sum(F.regexp_count("text", F.lit(pattern)))).first()[0] == 64 * 4000 * 10 + 64
            return time.perf_counter() - began

        return min(once() for _ in range(3))

    assert seconds(decontamination.WORD) < seconds(ranges) / 2


def test_packing(both):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    for docs, rows in both:
        got = packing.pack(docs, capacity=256).collect()
        want = Counter()
        for d, x in rows:
            ids = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0]
            for i in range(0, len(ids), 256):
                part = np.array(ids[i : i + 256], dtype="<u4")
                want[(d, i // 256, i, len(part), zlib.crc32(part.tobytes()))] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        places = defaultdict(list)
        for r in got:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        for place in places.values():
            at = 0
            for offset, length in sorted(place):
                assert offset == at
                at += length
            assert at <= 256
        assert len(places) <= 1.05 * sum(r["length"] for r in got) / 256 + 2


def test_packed_sequences_hold_the_ids(odd):
    packed = packing.pack(odd, capacity=64, keep_ids=True)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_word_ids_are_the_tokenizers():
    ids = packing.WordIds(packing.vocabulary())
    for text in ["It's a.b, c.. 3. x1. É. ÀÉ, b ́a ΣΑΣ İ ﬁ", "<|endoftext|> a<|startoftext|>", "\x1c a\x85b!!. don't. '. ,", "日本語 テスト。 ok."]:
        assert ids.of(text.encode()) == ids.whole(text)
    assert ids.of(b"a. a. a,") == ids.whole("a. a. a,")


def test_best_fit_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    lengths = Counter(np.minimum(2048, rng.lognormal(6, 1.2, 200_000).astype(int) + 1).tolist())
    runs = packing.best_fit(lengths)
    assert runs[:, 2].sum() == sum(lengths.values())
    assert (runs[:, 3] + runs[:, 2]).max() <= 1.005 * sum(k * n for k, n in lengths.items()) / 2048 + 1


def test_simhash(both):
    for docs, rows in both:
        prints = [(d, brute.simhash(x)) for d, x in rows]
        least = brute.components(prints)
        got = simhash.near_duplicates(docs).collect()
        assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == Counter((d, f, least[f]) for d, f in prints)


def test_simhash_links_chains_and_keeps_one_of_each(spark, small):
    prints = [0, 1, 3, 7, 15, 31, 63, 255, 2**63, 2**62, 0x0F0F0F0F, 0x0F0F0F3C]
    nodes = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in prints], "fp bigint")
    from caselog.llm.shuffles import connected_components

    got = {r["node"] % 2**64: r["root"] % 2**64 for r in connected_components(simhash.links(nodes)).collect()}
    want = brute.components([(None, f) for f in prints])
    groups = lambda m: sorted(sorted(f for f in m if m[f] == r) for r in set(m.values()))
    parent = {f: f for f in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                x, y = parent[a], parent[b]
                parent = {f: min(x, y) if p in (x, y) else p for f, p in parent.items()}
    assert set(want) == set(prints)
    assert groups(got) == [g for g in groups(parent) if len(g) > 1]
    path = spark.createDataFrame([(i, i + 1) for i in range(200)], "u bigint, v bigint")
    assert {r["root"] for r in connected_components(path).collect()} == {0}


def test_simhash_keeps_one_row_of_each_component(both):
    for docs, rows in both:
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        prints = [(d, brute.simhash(x)) for d, x in rows]
        assert kept.count() == len({m for m in _roots(prints).values()})


def _roots(prints):
    numbered = list(enumerate(f for _, f in prints))
    return brute.components(numbered)


@pytest.mark.parametrize("nodes", [language_model.MAX_NODES, 2_000])
def test_language_model_base(both, nodes):
    for docs, rows in both:
        got = language_model.score(docs, max_nodes=nodes).collect()
        made = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got]
        assert Counter(x[:5] for x in made) == Counter(x[:5] for x in brute.base_scores(rows))
        assert np.allclose(sorted(x[5] for x in made), sorted(x[5] for x in brute.base_scores(rows)), rtol=1e-6, atol=1e-3)


def test_language_model_is_a_distribution():
    words = [b"the", b"then", b"that", b"thing", b"a", b"an"]
    text, context = language_model.spelled(words)
    keys, k = [], []
    for order in range(4):
        key = language_model.keys(text, order)[context >= order]
        keys.append(key), k.append(np.full(len(key), order))
    found = Counter(zip(np.concatenate(k).tolist(), np.concatenate(keys).tolist(), strict=True))
    k, key = np.array(list(found)).T
    levels = language_model.levels_of(k, key, np.array(list(found.values())))
    for before in (b" ", b" t", b" th", b" xq", b" tha"):
        total = 0.0
        for byte in range(256):
            line = np.frombuffer(before + bytes([byte]), dtype=np.uint8)
            at = np.arange(1, len(line))
            total += 10 ** language_model.code_of(levels, line, at, np.arange(len(line) - 1) == len(line) - 2).sum()
        assert abs(total - 1) < 1e-9


def test_language_model_scores_do_not_depend_on_shards(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one, many = ({r["doc_id"]: r["score"] for r in language_model.score(docs, max_nodes=n).collect()} for n in (10**9, 500))
    assert all(abs(one[d] - many[d]) < 1e-6 * abs(one[d]) for d in one)


def test_language_model_scores_follow_the_order_of_words(spark, small):
    words = "over the hill a quick brown fox jumps and runs away from one lazy old dog".split()
    rows = [(i, " ".join(words)) for i in range(40)]
    rows += [(40, " ".join(reversed(words))), (41, " ".join(sorted(words))), (42, "  ".join(words).upper())]
    got = {r["doc_id"]: r for r in language_model.score(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[40]["score"] < got[0]["score"] - 1 and got[41]["score"] < got[0]["score"] - 1
    assert abs(got[42]["score"] - got[0]["score"]) < 1e-6
    assert abs(got[40]["base_score"] - got[0]["base_score"]) < 1e-6


def test_language_model_gathers_no_crowded_last_byte(spark, small, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(language_model, "MAX_FREQUENT", 50, raising=False)
    monkeypatch.setattr(language_model, "FREQUENT_SHARE", 50)
    gathered, whole = [], DataFrame.toArrow

    def noted(df):
        got = whole(df)
        gathered.append(got.num_rows)
        return got

    monkeypatch.setattr(DataFrame, "toArrow", noted)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcdef"), 4)) + "ee" + x for x in "abcdefgh")) for i in range(60)]
    assert language_model.score(spark.createDataFrame(rows, "doc_id int, text string"), max_nodes=50).count() == 60
    assert gathered and max(gathered) <= 50


def _escaping(rows, order, discount):
    """Scores by the definition: counts of contexts of each text, and recursion with exclusion."""
    seen = defaultdict(Counter)
    lines = [(d, b"\n" * order + b" ".join(brute.tokens(x))) for d, x in rows]  # the last token is the end
    lines = [(d, line[:-2] + b"\n" if len(line) > order + 1 else line) for d, line in lines]
    for d, line in lines:
        for i in range(order, len(line) if not brute.held(d, 10) else 0):
            for k in range(order + 1):
                seen[line[i - k : i]][line[i]] += 1

    def chance(context, byte):
        lower = context[1:]
        have = seen.get(context)
        if not have:
            return chance(lower, byte) if context else 1 / 256
        total = sum(have.values())
        if byte in have:
            return (have[byte] - discount) / total
        below = (lambda b: chance(lower, b)) if context else lambda b: 1 / 256
        return discount * len(have) / total * below(byte) / (1 - sum(map(below, have)))

    return {d: sum(np.log10(chance(line[i - order : i], line[i])) for i in range(order, len(line))) for d, line in lines}


@pytest.mark.parametrize("frequent", [language_model.MAX_FREQUENT, 50])
def test_language_model_by_its_definition(spark, small, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "MAX_FREQUENT", frequent)
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the dog sat", "", None, "A  mat\na cat", "x é y", "the cat ran off"] * 3)]
    got = language_model.score(spark.createDataFrame(rows, "doc_id int, text string"), max_nodes=20).collect()
    want = _escaping(rows, language_model.ORDER, language_model.DISCOUNT)
    assert all(abs(r["score"] - want[r["doc_id"]]) < 1e-6 for r in got) and len(got) == len(rows)


def test_rules_on_odd_rows(odd):
    got = Counter((r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in quality_rules.apply_rules(odd).collect())
    assert sum(got.values()) == len(ODD_TEXTS)
    assert got[(1, 0, True, False)] == got[(2, 0, True, False)] == got[(3, 0, True, False)] == 1
    assert got[(6, 8, True, False)] == 2
    assert got[(12, 900, True, False)] == 1


def test_repeated_words_by_either_search(spark, small):
    rows = [(i, " ".join(f"w{j % n}" for j in range(2 * n + 1))) for i, n in enumerate((3, 20, 40, 500))]
    got = quality_rules.measures(spark.createDataFrame(rows, "doc_id int, text string")).select("n_words", "n_repeat_words").collect()
    assert all(n == r for n, r in got)


@pytest.mark.parametrize("group", [suffix_dedup.MAX_GROUP, 2])
def test_suffix_dedup(both, group):
    for docs, rows in both:
        got = suffix_dedup.deduplicate(docs, max_group=group).collect()
        assert Counter(map(tuple, got)) == Counter(brute.without_repeats(rows))


def test_suffix_dedup_of_mixed_passages(spark, small):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, rows = [prose(120) for _ in range(4)], []
    for i in range(60):
        b = base[i % 4]
        s = int(rng.integers(0, len(b)))
        x = prose(int(rng.integers(0, 30))) + b[s : s + int(rng.integers(150, 400))] + prose(int(rng.integers(0, 30)))
        rows.append((i, [x, x + x, b, "abc" * int(rng.integers(10, 200))][min(3, int(rng.integers(0, 12)) // 8 * int(rng.integers(0, 4)))]))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    for chunk in (suffix_dedup.MAX_GROUP, 3):
        got = suffix_dedup.deduplicate(df, max_group=chunk, keep_text=True).collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter(brute.without_repeats(rows))
        assert all(r["n_bytes"] - r["n_removed"] == len(r["kept"]) for r in got)


def test_classifier_on_held_out_rows(spark, small):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = got.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert right >= 0.95 * n > 20


def test_classifier_statistics_cover_all_rows(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = quality_classifier.features(docs)
    x = np.array([r["_f"] for r in rows.collect()])
    n, mean, scale = quality_classifier.statistics(rows)
    assert n == len(x) and np.allclose(mean, x.mean(axis=0)) and np.allclose(scale, np.maximum(x.std(axis=0), 1e-3))
    model = quality_classifier.Model(0.5, mean, scale, [0.1 * i - 1 for i in range(2 * len(mean) + 1)])
    z = quality_classifier.expanded(np.clip((x - np.array(mean)) / np.array(scale), -8, 8))
    scores = np.hstack([z, np.ones((len(z), 1))]) @ np.array(model.weights)
    cuts = np.quantile(scores, [0, 0.2, 0.5, 0.9]) + 1e-6
    assert quality_classifier.reached(rows, model, cuts).tolist() == [(scores >= c).sum() for c in cuts]


def test_classifier_samples_each_text_of_an_id_once(spark, small):
    rows = spark.createDataFrame([(1, [1.0] * 13)] * 300 + [(i, [float(i)] * 13) for i in range(2, 30)], "doc_id int, _f array<double>")
    assert sorted(quality_classifier.sample(rows, 100)[:, 0]) == list(range(1, 30))
    assert len(quality_classifier.sample(rows, 10)) == 10
    assert quality_classifier.sample(rows, 10).tolist() == quality_classifier.sample(rows.repartition(5), 10).tolist()


def _risk_by_definition(pos, unl, prior, w, clip=True):
    """Non-negative unbiased risk, row by row."""
    loss = lambda z: np.log1p(np.exp(-z))
    as_pos = prior * np.mean([loss(x @ w) for x in pos])
    negative = np.mean([loss(-x @ w) for x in unl]) - prior * np.mean([loss(-x @ w) for x in pos])
    return as_pos + (max(0, negative) if clip else negative), negative


def test_classifier_risk_covers_all_rows(spark, small):
    """The risk of the whole table, its gradient and its curvature, against sums row by row and differences."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = quality_classifier.features(docs)
    _, mean, scale = quality_classifier.statistics(rows)
    x = quality_classifier.with_bias(np.array([r["_f"] for r in rows.collect()]), mean, scale)
    pos, w, prior = x[:30], np.linspace(-0.2, 0.3, x.shape[1]), 0.4
    got = quality_classifier.corpus_risk(rows.repartition(5), mean, scale, w)
    at = lambda v: quality_classifier.pu_risks((1 / len(x)) * quality_classifier.summed_risk(x, v, -1), pos, v, prior)
    assert np.isclose(got.value, np.log1p(np.exp(x @ w)).sum())
    whole = sum(quality_classifier.pu_risks((1 / len(x)) * got, pos, w, prior), start=0.0 * got)
    assert np.isclose(whole.value, _risk_by_definition(pos, x, prior, w, clip=False)[0])
    for i, h in enumerate(np.eye(len(w)) * 1e-5):
        up, down = (_risk_by_definition(pos, x, prior, w + s * h, clip=False)[0] for s in (1, -1))
        assert np.isclose(whole.gradient[i], (up - down) / 2e-5, atol=1e-6)
        steeper = [sum(at(w + s * h), start=0.0 * got).gradient for s in (1, -1)]
        assert np.allclose(whole.curvature[i], (steeper[0] - steeper[1]) / 2e-5, atol=1e-6)


def test_classifier_minimum_keeps_the_risk_on_negatives_from_falling_below_zero():
    """No other weights have a lower risk, unless the prior is far too high: then the search stops at zero."""
    rng = np.random.default_rng(3)
    for prior, clipped in ((0.3, False), (0.9, True)):
        pos = np.hstack([rng.normal(1, 1, (60, 2)), np.ones((60, 1))])
        good, bad = rng.normal(1, 1, (120, 2)), rng.normal(-1, 1, (180, 2))
        unl = np.hstack([np.vstack([good, bad]), np.ones((300, 1))])
        mean_risk = lambda w: (1 / 300) * quality_classifier.summed_risk(unl, w, -1)  # noqa: B023, E731
        w = quality_classifier.minimise(lambda v: quality_classifier.pu_risks(mean_risk(v), pos, v, prior), 3, -1e-3)  # noqa: B023
        least, negative = _risk_by_definition(pos, unl, prior, w)
        assert negative >= -1e-3 and (negative < 0.02) == clipped
        assert least < _risk_by_definition(pos, unl, prior, 0 * w)[0]
        for step in rng.normal(0, 1, (200, 3)) * rng.choice([1e-3, 1e-2, 0.1, 1], (200, 1)) if not clipped else []:
            other = w + step
            assert _risk_by_definition(pos, unl, prior, other)[0] + 5e-5 * other @ other >= least + 5e-5 * w @ w - 1e-5


def test_classifier_prior():
    rng = np.random.default_rng(3)
    pos = rng.normal(2, 1, 4000)
    for share in (0.2, 0.6):
        unl = np.concatenate([rng.normal(2, 1, int(40_000 * share)), rng.normal(-2, 1, int(40_000 * (1 - share)))])
        cuts = quality_classifier.prior_cuts(pos)
        found = quality_classifier.estimate_prior(pos, cuts, np.array([(unl >= c).sum() for c in cuts]), len(unl))
        assert abs(found - share) < 0.06


def test_classifier_on_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(6, 1, 1), (9, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, score int")
    for train in (labels, labels.limit(0)):
        got = quality_classifier.classify(odd, train).collect()
        assert len(got) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
        assert quality_classifier.keep_good(odd, train).columns == odd.columns


def test_secret_base_spans(both):
    for docs, rows in both:
        got = secrets.scan(docs).select("doc_id", joined(F.col("base"))).collect()
        assert Counter(map(tuple, got)) == Counter((d, brute.joined(brute.secrets(x))) for d, x in rows)


def test_secrets_widely_copied_are_examples(spark, small):
    example, live = "sk-Abc123Def456Ghi789Jkl", "sk-Zyx987Wvu654Tsr321Qpo"
    rows = [(i, f"key {example}", f"o{i}") for i in range(9)] + [(9, f"key {live}", "o1"), (10, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    spans = {r["doc_id"]: [x["kind"] for x in r["spans"]] for r in secrets.scan(df).collect()}
    assert spans[9] and all(not spans[i] for i in spans if i != 9)
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert texts[9] == "key [SECRET]" and texts[0] == f"key {example}" and texts[10] is None


@pytest.mark.parametrize("copies", [6, 1000])
def test_secrets_of_one_owner_are_live_in_any_number_of_documents(spark, small, copies):
    keyed, letters = "sk-Zyx987Wvu654Tsr321Qpo", "QwErTyUiOpAsDfGhJkLzXcVbNmQaWsEdRfTg"
    rows = [(i, f"{a} key sk-Zyx987Wvu654Tsr321Qpo and {letters}", "one") for i, a in enumerate(["same", "other"] * (copies // 2))]
    rows += [(copies + i, f"key {keyed[:-1]}X", f"o{i}") for i in range(3)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()
    kinds = {r["doc_id"]: {x["kind"] for x in r["spans"]} for r in got}
    assert len(kinds) == copies + 3
    assert all(v == ({"keyed", "random"} if i < copies else set()) for i, v in kinds.items())


def test_redaction_keeps_rows_and_columns(odd):
    got = secrets.redact(odd)
    assert got.columns == odd.columns and got.count() == len(ODD_TEXTS)
    row = got.where("doc_id = 11").first()
    assert row["text"].startswith("[SECRET] and a.b@c.de") and row["n_chars"] == len(row["text"])


def test_empty_tables(spark, empty, small):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    items = spark.createDataFrame([], "item_id int, text string")
    made = [
        pii.find(empty), decontamination.decontaminate(empty, items), packing.pack(empty), simhash.near_duplicates(empty),
        language_model.score(empty), quality_rules.apply_rules(empty), suffix_dedup.deduplicate(empty),
        quality_classifier.classify(empty, labels), secrets.scan(empty), secrets.redact(empty), simhash.keep_one(empty),
        chat.format_chats(spark.createDataFrame([], "conv_id int, turn int, role string, text string")),
    ]
    assert [df.count() for df in made] == [0] * len(made)
    some = spark.createDataFrame([(1, "a text")], "doc_id int, text string")
    assert decontamination.decontaminate(some, items).first()["n_hit"] == 0
