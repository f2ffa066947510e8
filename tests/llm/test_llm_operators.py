"""The operators against plain versions, on the small tables and on edge cases."""

import random
import time
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from bench import shuffled
from pyspark.sql import functions as F

from fondscope.llm import common
from fondscope.llm import components as CC
from fondscope.llm import decontamination, language, line_dedup, ngram_join, packed_output, packing, pii, quality, registry, search, sharding, tokens, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, `n` int, hash string, shard string, spans string"
BASE = "the quick brown fox jumps over the lazy dog while seven clever cats watch from a warm red roof near the old mill".split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    near = [" ".join(BASE[:k] + [f"w{k}"] + BASE[k + 1 :]) for k in (0, 22)]
    texts = [(1, " ".join(BASE)), (2, near[0]), (3, near[1]), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "ONE  two"), (None, " ".join(BASE)), (9, " ".join(BASE).upper()), (9, " ".join(BASE).upper()), (10, "long " * 30000), (11, "a\n" * 3), (12, "123 !!"), (13, "x" * 70000)]
    return spark.createDataFrame([(d, t, "en" if t else None, None, None if t is None else len(t), 1, "k", 2, "h", "s", "p") for d, t in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_shingles(rows):
    import pyarrow as pa

    texts = [t for _, t in rows] + ["", None, "a", "A b\x0bc  d é", "x" * 300000, "y " * 200000]
    data, at = words.bytes_of(pa.array(texts))
    seen, sizes = [], []
    for s in words.slices(data, at):
        assert s.first == len(seen)
        seen += s.counts.tolist()
        sizes += words.distinct_shingles(s)[2].tolist()
    assert seen == [len(brute.words(t)) for t in texts] and sizes == [len(brute.shingle_set(t)) for t in texts]


def test_long_words_of_two_letters():
    """Words whose letters follow the Thue-Morse order cancel in any sum of powers modulo a power of 2, so theirs must not be one."""
    word, other = "a", "b"
    for _ in range(12):
        word, other = word + other, other + word
        data = np.frombuffer(f"{word} {other} x{word}".encode(), np.uint8)
        h = [x for s in words.slices(data, np.array([0, len(data)])) for x in s.hashes.tolist()]
        assert len(set(h)) == 3
    many = " ".join("a" * k for k in range(1, 200))
    data = np.frombuffer(f"{many} {many}".encode(), np.uint8)
    (s,) = words.slices(data, np.array([0, len(data)]))
    assert len(set(s.hashes.tolist())) == 199 and s.hashes[:199].tolist() == s.hashes[199:].tolist()


def test_joins_with_hot_keys(spark, monkeypatch):
    """A third of the rows have one key: they lie in several tasks, and the rows are those of a plain join."""
    monkeypatch.setattr(common, "SPLIT", 50)
    rows_ = spark.createDataFrame([(0 if k % 3 else k, k) for k in range(3000)], "key long, id long")
    one = spark.createDataFrame([(k, f"v{k}") for k in range(0, 3000, 2)], "key long, value string")
    times = rows_.groupBy("key").agg(F.count("*").alias("times"))
    for how in ("inner", "left"):
        got = common.salted_join(rows_, one, ["key"], ["id"], times, 3000, how)
        want = rows_.join(one, "key", how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = common.salted_join(rows_, one, ["key"], ["id"], times, 3000)
        assert got.filter("key = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    got = {r.id: r.component for r in CC.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {x: root(x) for x in parent if x not in loops}
    assert CC.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join(docs, rows, odd, spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs).collect()}
    assert got == brute.components(rows)
    out = [tuple(r) for r in ngram_join.similar_sets(odd).collect()]
    assert len(out) == odd.count()
    found = dict((d, (n, c)) for d, n, c in out)
    assert found[2][1] == found[3][1] == found[9][1] == 1 and found[8] == (1, 7) and found[4] == (0, 4) and found[5] == (0, 5) and found[6] == (0, 6) and found[10] == (1, 10) and found[None][1] is None
    assert ngram_join.similar_sets(empty(spark)).count() == 0
    left = ngram_join.one_of_each(odd)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 4, 5, 6, 7, 10, 11, 12, 13]


def test_hot_group_of_near_copies(spark, monkeypatch):
    """Near copies that are mostly not similar to each other, but chained through others, with clean texts beside them."""
    monkeypatch.setattr(common, "SPLIT", 5)
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(5000)]
    base = rng.sample(vocabulary, 120)
    rows_ = []
    for d in range(260):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows_.append((d, " ".join(w)))
    rows_ += [(1000 + d, " ".join(rng.sample(vocabulary, 90)) + " " + " ".join(base[:60])) for d in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(spark.createDataFrame(rows_, "doc_id long, text string").repartition(6)).collect()}
    assert got == brute.components(rows_)


def test_parts_follow_the_entries(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join.J, "PART", 500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs).collect()}
    assert got == brute.components(rows)


def test_line_dedup(docs, rows, odd, spark):
    want = brute.removed_lines(rows)
    got = {r.doc_id: r for r in line_dedup.without_repeats(docs).collect()}
    for d, text in rows:
        gone = set(want.get(d, []))
        assert got[d].n_removed == len(gone) and got[d].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
    out = line_dedup.without_repeats(odd.withColumn("n_lines", F.lit(99)))
    assert out.columns == [*odd.columns, "n_lines", "n_removed"]
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd.count() and by[None].n_removed == 0 and by[1].text == "" and by[1].n_removed == 1 and by[4].text is None and by[4].n_lines == 0 and by[5].n_lines == 1 and by[8].n_removed == 1 and by[11].text == "a\n" and by[7].n_removed == 0
    kept = line_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, 7, 10, 11, 12, 13}
    assert line_dedup.without_repeats(empty(spark)).count() == 0


def test_near_lines(spark):
    base = " ".join(BASE)
    rows_ = [(1, f"{base}\nfirst of all lines here now"), (2, f"clean line of this text only\n{base} mill"), (3, f"w0 {base} w1 w2\n\n{base.upper()}"), (4, "first of all lines here now")]
    got = {r.doc_id: r.n_removed for r in line_dedup.without_repeats(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    want = brute.removed_lines(rows_)
    assert got == {d: len(want.get(d, [])) for d, _ in rows_} and sum(got.values()) >= 3


def test_decontamination(spark, docs, rows, odd):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.passages(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute.contaminated(rows, items)
    text = items[0][1]
    w = text.split()
    cases = [(1, f"x y z {text.upper()} q"), (2, " ".join(w[: int(len(w) * 0.85)])), (3, " ".join(w[:4])), (4, "a b " + " ".join([*w[:-1], "other", "c"])), (5, None), (6, "")]
    made = spark.createDataFrame(cases, "doc_id long, text string")
    odd_items = spark.createDataFrame([*items[:3], items[0], (900, None), (901, ""), (902, "two words")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.passages(made, odd_items).collect()}
    assert found == brute.contaminated(cases, [*items[:3], (902, "two words")]) and {(1, items[0][0]), (2, items[0][0])} <= found
    left = decontamination.decontaminated(odd, benchmark)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert decontamination.passages(empty(spark), benchmark).count() == 0 and decontamination.passages(docs, benchmark.filter("false")).count() == 0


def test_windows_cut_in_short_documents(spark):
    """Documents with fewer words than the item: a passage without its end or start, beside other words."""
    rng = random.Random(11)
    item = [f"i{k}" for k in range(59)]
    cases = []
    for before, after in ((9, 0), (0, 9), (1, 1), (5, 4), (0, 0), (11, 0)):
        for a, z in ((0, 48), (11, 59), (5, 53), (0, 40)):
            w = [f"x{rng.randrange(999)}" for _ in range(before + after)]
            cases.append((len(cases), " ".join([*w[:before], *item[a:z], *w[before:]])))
    items = [(1, " ".join(item)), (2, " ".join(BASE))]
    made = spark.createDataFrame(cases, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.passages(made, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == brute.contaminated_with_cuts(cases, items) and (0, 1) in found and found > brute.contaminated(cases, items)


def test_items_of_few_words(spark):
    """Items of one to four words in documents of any length, at their ends and across documents that lie side by side."""
    items = [(1, "alpha"), (2, "Two words"), (3, "now three words"), (4, "there are four words"), (5, "five words are one shingle"), (6, " ")]
    texts = ["alpha", "x ALPHA", "two", "words two", "two words", "a b c d two words", "TWO  words a b c d", "now three", "words e f g h now", "three words", "now three words", "i j now three words k l", "there are four", "there are four words", "m there are four words n o p q", "five words are one shingle and more", "there are\nfour words", "", None]
    made = [(k, t) for k, t in enumerate(texts)]
    got = decontamination.passages(spark.createDataFrame(made, "doc_id long, text string").coalesce(1), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.contaminated_with_cuts(made, items) and len(got) == len({(r.doc_id, r.item_id) for r in got}) == 11
    assert [(r.first_word, r.n_words, r.distance, r.similarity) for r in got if r.doc_id == 5] == [(4, 2, 0, 1.0)]


def test_rows_go_by_doc_id_and_text(spark):
    item, clean = " ".join(BASE), "nothing of it is here at all"
    made = [(None, item, "a"), (None, clean, "b"), (None, None, "c"), (1, item, "d"), (1, clean, "e"), (1, item, "f"), (2, None, "g"), (3, f"so {item} so", "h")]
    left = decontamination.decontaminated(spark.createDataFrame(made, "doc_id long, text string, version string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == ["doc_id", "text", "version"] and sorted(r.version for r in left.collect()) == ["b", "c", "e", "g"]


def test_items_in_passes(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "PASS_BYTES", 4000)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sum(len(t) for _, t in items) > 8000
    got = decontamination.passages(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute.contaminated(rows, items)


def test_hamming_blocks():
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 63))
    index = decontamination.Index([decontamination.Item(1, 30, {5: 1}, base)])
    prints = np.array([base ^ sum(1 << int(b) for b in rng.choice(64, d, replace=False)) for d in range(0, 40)], np.uint64)
    assert sorted((w, d) for w, _, d in index.near(30, prints)) == [(d, d) for d in range(decontamination.RADIUS + 1)]


def test_pii(spark, rows, odd):
    assert pii.luhn("4532015112830366") and not pii.luhn("4532015112830367") and pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")

    def base(t):
        out = [("email", *m.span()) for m in pii.EMAIL.finditer(t)]
        out += [("ip", *m.span()) for m in pii.IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in pii.CARD.finditer(t) if 16 <= len(pii.digits(m[0])) <= 19 and pii.luhn(pii.digits(m[0]))]
        return out + [("phone", *m.span()) for m in pii.PHONE.finditer(t) if 8 <= len(pii.digits(m[0])) <= 15]

    made = ["a@b.c@d.e.f x@y", "@@a@b.cc", "a" * 9000 + "@b.cc d@e.f", "x@y.z@q.w.e a.b@c-d.e.", "1.2.3.4.5.6.7.8 300.1.1.1 0000000000001.2.3.4", "4532015112830366 4532015112830366", "é +1 (234) 555-0199. +12 3", "4532-0151-1283-0366", ""]
    rng = random.Random(3)
    made += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for alphabet in ("a_@.b", "1.2", "12.@a -+(") for _ in range(3000)]
    for t in [t for _, t in rows] + made:
        assert pii.base_spans(t) == base(t)
    found = {(s["kind"], s["start"]) for s in pii.spans("card 4532015112830366 4532015112830366 iban GB82 WEST 1234 5698 7654 32.")}
    assert {("card", 5), ("card", 22), ("iban", 44)} <= found
    assert pii.spans("nothing 1234567890123456 here") == []
    out = pii.personal_data(odd).collect()
    assert len(out) == odd.count() and all(r.spans == [] for r in out) and pii.personal_data(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "é x@y.zz and 1.2.3.4"), (2, None)], "doc_id long, text string")
    assert [r.text for r in pii.redacted(df).orderBy("doc_id").collect()] == ["é <email> and <ip>", None]
    texts = dict(rows)
    found = pii.op3_pii(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:  # against the plain patterns
        want = base(texts[r.doc_id] or "")
        assert r.base_sha256 == pii.sha256(want) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in pii.KINDS[:4]]
        assert set(filter(None, r.spans.split(","))) >= {f"{k}:{a}:{b}" for k, a, b in want}


def test_personal_data_in_very_long_runs():
    """A million places of what a pattern could begin with: no match is retried from each of them."""
    began = time.time()
    for t in ("1" * 10**6, "a" * 10**6 + "@", "a" * 10**6 + "@b", "1." * 500_000, "1 " * 500_000, "+1" + "(" * 10**6, "4532015112830366 " * 5000 + "é a@b.cc " * 5000, "a@" * 500_000):
        got = pii.spans(t)
        assert bool(got) == ("@b.cc" in t or t.startswith("1.1")), t[:20]
    assert time.time() - began < 60


def test_packing_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([5, 17, 64, 2048])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        runs, bins = packing.best_fit_decreasing(Counter(lengths), capacity)
        used = [[] for _ in range(bins)]
        for r in runs:
            for k in range(r.count):
                used[r.bin + k // r.each].append((r.offset + k % r.each * r.length, r.length))
        assert bins == brute.best_fit(lengths, capacity) and sorted(n for b in used for _, n in b) == sorted(lengths)
        for b in used:
            ends = [0, *np.cumsum([n for _, n in sorted(b)]).tolist()]
            assert [a for a, _ in sorted(b)] == ends[:-1] and ends[-1] <= capacity


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary())


def test_token_ids(rows):
    t = tokenizer()
    odd_texts = ["", "İstanbul ΣΑΣ ﬁ é é", "a b c", "<|endoftext|> x<|startoftext|>y", "don't WE'LL 12 3\x1c4 日本語", "ŉ ß ẞ Ǆ ª º ²"]
    for text in [t for _, t in rows] + odd_texts:
        assert np.frombuffer(tokens.ids_of(text, tokens.vocabulary()), "<u4").tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]


def test_packed(spark, docs, rows, odd):
    t = tokenizer()
    got = packing.packed(docs).collect()
    want = {d: [*t.encode(x, add_special_tokens=False).ids, 0] for d, x in rows}
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    for r in got:
        part = want[r.doc_id][r.start : r.start + r.length]
        assert r.start == r.piece * 2048 and r.length == len(part) <= 2048 and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    bins = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 2048 and len(bins) == brute.best_fit([r.length for r in got], 2048)
    some = packing.packed(odd)
    assert {r.doc_id for r in some.collect()} == {r.doc_id for r in odd.collect()} and some.filter("doc_id in (4, 5)").agg(F.sum("length")).first()[0] == 2
    assert packing.packed(empty(spark)).count() == 0


def test_packed_rows(spark, docs, rows, odd, tmp_path):
    t = tokenizer()
    packed = packed_output.write_packed(docs, f"file://{tmp_path}/packed")
    for r in packed.collect():
        ids, places = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.position_ids, "<i4")
        assert len(ids) == len(places) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.used
        for a, z in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert places[a:z].tolist() == list(range(z - a))
    whole = {}
    for r in packed_output.unpacked(packed).orderBy("doc_id", "piece").collect():
        whole[r.doc_id] = whole.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert whole == {d: [*t.encode(x, add_special_tokens=False).ids, 0] for d, x in rows}
    assert packed_output.unpacked(packed_output.packed_rows(odd)).count() >= odd.count() and packed_output.packed_rows(empty(spark)).count() == 0


def test_sharding(spark, docs, odd):
    got = sharding.op6_sharding(spark, SF).collect()
    size = {r.doc_id: len((r.text or "").encode()) + 16 for r in docs.collect()}
    crc = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in docs.collect()}
    by, slots = Counter(), {}
    for r in got:
        assert r.size == size[r.doc_id] and r.text_crc32 == crc[r.doc_id] and r.law == "bytes" and r.grown_shard is None
        by[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(by) <= set(range(40))
    assert max(by.values()) - sum(by.values()) / 40 <= 1.5 * max(size.values())
    some = sharding.shards(odd, 4).collect()
    assert len(some) == odd.count() and sharding.shards(empty(spark)).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text of a hot group").otherwise(F.concat(F.lit("text number "), F.col("id").cast("string"))).alias("text"))
    sums = [r.b for r in sharding.shards(hot, 10).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sums) == 10 and max(sums) < 1.05 * sum(sums) / 10
    twice = spark.createDataFrame([(d, f"t{d % 40}") for d in range(80)], "doc_id long, text string")
    placed = sharding.shards(twice, 1).count()
    assert placed == 80


def test_groups_of_equal_texts_stay_together(spark):
    """Six hot texts, null doc_ids among them, and many small groups: only what fits in no shard is cut, and sizes stay near equal."""
    rng = random.Random(8)
    made = [(d if d % 7 else None, f"hot text {d % 6}") for d in range(12000)] + [(d, f"group {d // 3} " + "x" * (d // 3 % 200)) for d in range(20000, 32000)]
    made += [(d, "y" * 30) for d in range(40000, 60000)]
    rng.shuffle(made)
    got = sharding.shards(spark.createDataFrame(made, "doc_id long, text string"), 10).collect()
    assert len(got) == len(made)
    of, bytes_, slots = {}, Counter(), {}
    for r in got:
        of.setdefault(r.text_crc32, set()).add(r.shard)
        bytes_[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(bytes_.values()) / 10
    assert len(bytes_) == 10 and max(bytes_.values()) < 1.02 * mean and min(bytes_.values()) > 0.98 * mean
    assert [c for c, x in of.items() if len(x) > 1] == [zlib.crc32(("y" * 30).encode())]


def test_heavy_groups_are_cut_only_if_they_must_be():
    parts, room = sharding.spread_groups([(1, 60), (2, 60), (3, 250), (4, 30), (5, 10)], 5, 100.0)
    assert [len(parts[k]) for k in (1, 2, 4, 5)] == [1, 1, 1, 1] and len(parts[3]) == 3 and parts[3][-1][0] == 250
    assert sum(room) == 500 - 410 and min(room) >= 0


def test_search(spark, docs, rows, odd):
    found = search.top_k(docs, docs.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")).collect()
    want = brute.bm25(rows, [(d, t) for d, t in rows if d % 20 == 0])
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert {q: [d for d, _ in x] for q, x in got.items()} == {q: [d for d, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 2e-6 for q in got for a, b in zip(got[q], want[q], strict=True))
    asked = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (4, "nowhere"), (None, "one")], "query_id long, text string")
    assert [(r.query_id, r.doc_id) for r in search.top_k(odd, asked).orderBy("query_id", "rank").collect()] == [(1, 7), (1, 8)]
    assert search.top_k(empty(spark), asked).count() == 0 and search.top_k(odd, asked.filter("false")).count() == 0


def test_pruned_search_is_exact(monkeypatch):
    """Random documents of frequent and rare terms in two kinds, with many ties, in one shard or several that carry thresholds, against
    scores of all documents."""
    monkeypatch.setattr(search, "BLOCK", 8)
    monkeypatch.setattr(search, "TOGETHER", 3)
    rng = np.random.default_rng(4)
    for turn in range(40):
        n, terms_, tfs = int(rng.integers(1, 700)), [], []
        for d in range(n):
            t = np.unique(np.r_[rng.integers(0, 12, rng.integers(0, 12)) + 500 * (d % 3 == 0), rng.integers(20, 400, rng.integers(0, 6))])
            terms_.append(t)
            tfs.append(rng.integers(1, 4, len(t)).astype(np.int32))
        for d in range(n // 3):  # many equal ones
            terms_[d], tfs[d] = terms_[0], tfs[0]
        ids, lengths = rng.permutation(n * 3)[:n], np.array([x.sum() for x in tfs], float)
        asked = [np.unique(np.r_[rng.integers(0, 12, 6) + 500 * (k % 2), rng.integers(20, 400, 5)]) for k in range(7)] + [np.array([999])]
        weights = [rng.integers(1, 4, len(t)) if turn % 2 else np.ones(len(t), int) for t in asked]
        queries = search.Queries(np.arange(8), np.zeros(8, np.int64), np.array([len(t) for t in asked]), np.concatenate(asked), np.concatenate(weights), np.concatenate([1.0 + t % 9 for t in asked]), 20, 10)
        for part in np.array_split(np.arange(n), turn % 4 + 1):
            if len(part):
                search.Shard(queries, ids[part], lengths[part], np.array([len(terms_[d]) for d in part]), np.concatenate([terms_[d] for d in part]), np.concatenate([tfs[d] for d in part]), 9.0).answer(queries)
        for q, (t, w) in enumerate(zip(asked, weights, strict=True)):
            weight = {int(x): float(y * np.log(1 + (20 - (1 + x % 9) + 0.5) / (1.5 + x % 9))) for x, y in zip(t, w, strict=True)}
            score = {int(d): sum(weight.get(int(x), 0) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / 9.0)) for x, f in zip(xs, fs, strict=True)) for d, xs, fs, size in zip(ids, terms_, tfs, lengths, strict=True)}
            want = sorted((-round(s, 6), d) for d, s in score.items() if s > 0)[:10]
            some = np.isfinite(queries.scores[q])
            assert queries.best[q][some].tolist() == [d for _, d in want] and np.allclose(queries.scores[q][some], [-s for s, _ in want], atol=2e-6)


def test_search_in_many_tasks(spark, docs, rows, monkeypatch):
    """Queries of more than one task's share, repeated ones, and two texts of one id."""
    monkeypatch.setattr(search, "QUERY_BYTES", 20_000)
    texts = [(d, t) for d, t in rows if d % 10 == 0]
    asked = spark.createDataFrame([*texts, *texts[:3], (-1, texts[0][1]), (-1, texts[1][1])], "query_id long, text string")
    got = {}
    for r in search.top_k(docs, asked).orderBy("query_id", "rank", "doc_id").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    want = brute.bm25(rows, texts)
    assert {q: x for q, x in got.items() if q != -1} == {q: [d for d, _ in x] for q, x in want.items() if x}
    assert sorted(got[-1]) == sorted(d for q in (texts[0][0], texts[1][0]) for d, _ in want[q])


def test_search_sends_documents_and_queries_once(spark, docs, monkeypatch):
    """More queries take more tasks, but no more of the shuffles' disk; the answers are the same."""
    asked = docs.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    found, sent = [], []
    for most in (search.QUERY_BYTES, 20_000):
        monkeypatch.setattr(search, "QUERY_BYTES", most)
        before = shuffled(spark)
        found.append(sorted(search.top_k(docs, asked).collect()))
        sent.append(shuffled(spark) - before)
    assert found[0] == found[1] and found[0] and sent[1] < 1.5 * sent[0]


def test_language(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in language.op8_language_id(spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert held == [d for d in got if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) >= 0.97 and all(0 <= r.score <= 1 for r in got.values())
    model = language.learned(docs)
    assert set(model.families) == {"germanic", "romance"} and len(model.pairs) == 2
    out = {r.doc_id: r for r in language.languages(odd, model).collect()}
    assert all(out[d].lang_pred == "und" and out[d].score == 0 for d in (4, 5, 6, 12)) and out[7].lang_pred != "und"
    alone = language.learned(empty(spark))
    assert {r.lang_pred for r in language.languages(odd, alone).collect()} == {"und"}
    assert language.accepted(odd).columns == odd.columns
    assert not {4, 5, 6, 12} & {r.doc_id for r in language.accepted(odd).collect()} and language.accepted(docs).count() >= docs.count() - 3
    whole = language.margins(["ab cd " * 50000], model)[0]
    assert np.allclose(whole, language.margins(["ab cd " * 50000, "x"], model)[0][0], atol=1e-4)


def test_training_table(spark, monkeypatch):
    """The compact table gives a dense one's products, also across blocks; languages with long texts only are learned."""
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(rng.randint(1, 60))) for a in ("abcd", "cdef", "wxyz") for _ in range(30)]
    x, d = language.Table.of(texts), language.ORDERS * language.BUCKETS
    dense = np.zeros((len(texts), d))
    for k, t in enumerate(texts):
        c = language.codes(t)
        for b in language.buckets(c):
            np.add.at(dense[k], b, 1 / (len(c) - 2))
    dense = (dense - dense.mean(0)) / (dense.std(0) + 1e-4) / np.sqrt(d)
    v, some = np.random.default_rng(1).normal(size=d), np.array([80, 3, 4, 50])
    for table, want in ((x, dense), (x.rows(some), dense[some])):
        g = np.arange(len(want)) - 1.5
        before, language.TABLE_BLOCK = language.TABLE_BLOCK, 150
        assert np.allclose(table.times(v), want @ v, atol=1e-3) and np.allclose(table.turned(g), g @ want, atol=1e-3) and np.allclose(table.norms(), (want * want).sum(1), atol=1e-3)
        language.TABLE_BLOCK = before
    made = [(k, t if k % 2 else f"{t} " * 3000, "it" if k % 2 else "fi") for k, t in enumerate(x for pair in zip(texts[30:60], texts[60:], strict=True) for x in pair)]
    model = language.learned(spark.createDataFrame(made, "doc_id long, text string, lang string"))
    assert model.languages == ["fi", "it"] and language.PER_LANGUAGE == 400
    assert [language.per_language(n) for n in (0, 4, 100, 400, 10**4)] == [400, 400, 400, 100, 25]
    codes = [f"x{k:03}" for k in range(220)]  # more languages than there once were places for
    many = [(k, f"{c} {c} {c}", c) for k, c in enumerate(c for c in codes for _ in range(3))]
    before, language.PER_LANGUAGE = language.PER_LANGUAGE, 1
    monkeypatch.setattr(language, "machine", lambda x, y: (np.zeros(d), 0.0))
    assert language.learned(spark.createDataFrame(many, "doc_id long, text string, lang string"), -1).languages == codes
    language.PER_LANGUAGE = before
    assert language.predicted([texts[30], texts[60], texts[59] * 900], model)[0] == ["fi", "it", "fi"]


def test_texts_without_a_learned_language_go(spark):
    """Planted gibberish and unlearned languages go, labelled or not; clean documents stay, also held-out, short and mixed ones."""
    rng = random.Random(7)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in (15, 40, 200, 3000) for _ in range(5)]
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto"
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem"
    foreign = [finnish, polish, f"{finnish}\n{polish}" * 30, "Все люди рождаются свободными и равными в своем достоинстве и правах"]
    own = [r.text for r in docs.filter("lang = 'fr'").orderBy("doc_id").limit(6).collect()]
    mixed = [f"{t}\n{x[: len(t) // 2]}" for t, x in zip(own, [noise[-1], finnish * 9, polish * 9] * 2, strict=True)]
    made = [*[(10**6 + k, t, None) for k, t in enumerate(noise + foreign)], *[(2 * 10**6 + k, t, "en") for k, t in enumerate(noise)], *[(3 * 10**6 + k, t, None) for k, t in enumerate(mixed)]]
    kept = {r.doc_id for r in language.accepted(docs.union(spark.createDataFrame(made, docs.schema))).collect()}
    clean = {r.doc_id for r in docs.collect()}
    held = {d for d in clean if zlib.crc32(str(d).encode()) % 3 == 1}
    assert not {d for d in kept if 10**6 <= d < 3 * 10**6}
    assert {d for d in kept if d >= 3 * 10**6} == {d for d, _, _ in made if d >= 3 * 10**6}
    assert clean <= kept and held <= kept


def test_the_predicted_language_decides_what_is_usual(spark, monkeypatch):
    """A text is judged by the language that is predicted for it, so the prediction has an effect on what follows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learned(docs)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.orderBy("doc_id").limit(200).collect()]
    lang, _ = language.predicted([t for _, t, _ in rows], model)
    want = {d for (d, t, _), k in zip(rows, lang, strict=True) if language.is_usual(t, model.languages.index(k), model)}
    some = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "learned", lambda _: model)
    assert {r.doc_id for r in language.accepted(some).collect()} == want == {d for d, _, _ in rows}
    turned = model._replace(weights=-model.weights, bias=-model.bias)  # predicts other languages
    wrong, _ = language.predicted([t for _, t, _ in rows], turned)
    monkeypatch.setattr(language, "learned", lambda _: turned)
    kept = {r.doc_id for r in language.accepted(some).collect()}
    assert kept == {d for (d, t, _), k in zip(rows, wrong, strict=True) if language.is_usual(t, model.languages.index(k), model)} and len(kept) < len(rows) / 2


def test_few_and_rare_labels_neither_drop_the_table_nor_let_all_through(spark):
    """With 0, 1, 7 and 8 short labelled texts of one language, and with one rare language beside others."""
    schema = "doc_id long, text string, lang string"
    odd_ones = [k for k in range(1, 200) if zlib.crc32(str(k).encode()) % 3 != 1]
    piece = "the old mill stands by the river where seven boats lie in the evening sun".split()
    for n in (0, 1, 7, 8):
        made = [(odd_ones[k], " ".join(piece[k % 5 :] + piece[: k % 5])[:40], "en") for k in range(n)] + [(500, "a clean sentence about the river and the mill", None), (501, "12 !", None)]
        kept = {r.doc_id for r in language.accepted(spark.createDataFrame(made, schema)).collect()}
        assert {d for d, _, k in made if k} <= kept and 501 not in kept and 500 in kept
    rng = random.Random(9)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*schema.replace(" long", "").replace(" string", "").split(", "))
    clean = {r.doc_id for r in docs.collect()}
    finnish = next(k for k in range(10**6, 10**6 + 9) if zlib.crc32(str(k).encode()) % 3 != 1)
    noise = [(2 * 10**6 + k, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(30)), None) for k in range(20)]
    more = [(finnish, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan", "fi"), *noise]
    kept = {r.doc_id for r in language.accepted(docs.union(spark.createDataFrame(more, schema))).collect()}
    assert clean <= kept and finnish in kept and not {d for d, _, _ in noise} & kept


def test_quality(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.op4_quality_classifier(spark, sf).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d, r in got.items() if r.held_out and d in truth]
    assert np.mean([got[d].predicted == truth[d] for d in held]) >= 0.9 and len(got) == docs.count()
    model = quality.learned(docs, labels)
    out = [r.score for r in quality.scored(odd, model).collect()]
    assert len(out) == odd.count() and all(0 <= s <= 1 for s in out)
    none = quality.learned(empty(spark), labels)
    assert {round(r.score, 3) for r in quality.scored(odd, none).collect()} == {0.5} and quality.scored(empty(spark), none).count() == 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    want = duck.sql(registry.SQL[name])
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda frame: sorted(map(repr, frame[sorted(got.columns)].astype(object).values.tolist()))
    assert rows(got.toPandas()) == rows(want.df())
