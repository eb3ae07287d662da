"""The corpus operators against brute force, on edge cases, and the pipeline."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaar.llm import (bloom_lm, bpe, common, components, language, mixing, order_minhash, quality, suffix_dedup,
                        toxicity, va_file, vectors, vp_tree)

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = [(1, None, None, "x"), (2, "", "a", None), (3, " \n\t", None, "y"), (4, "a b c d e f g", "s", "x"),
        (4, "a b c d e f g", "s", "x"), (None, "日本 ½ é <|endoftext|> don't", "s", "y"),
        (9, "lorem ipsum " * 20_000, None, "x"), (10, "z" * 50_000, "a", "x")]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    return (spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string")
            .withColumn("row", F.lit(1)).withColumn("block", F.lit("b")).withColumn("score", F.lit(0.5))
            .withColumn("n_chars", F.length("text")))


def test_shared_names_and_word_spans():
    names = np.sort(np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(names)) == names).all()
    texts = ["a bc", "", "  d\n", "é\xa0x y"]
    import pyarrow as pa
    b = common.Bytes(pa.array(texts))
    s, e, t = common.word_spans(b.data, b.offs)
    got = [(i, b.data[x:y].tobytes().decode()) for x, y, i in zip(s, e, t)]
    assert got == [(i, w) for i, x in enumerate(texts) for w in WORD.findall(x)]


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {x for x in parent if x not in got}
    assert all(a == b for a, b in edges if a in alone)
    assert got == {x: root(x) for x in got}


def test_merged_components_are_those_of_all_edges(spark):
    rng = random.Random(8)
    for n in (0, 40):
        first = [(rng.randrange(80), rng.randrange(80)) for _ in range(40)]
        more = [(rng.randrange(120), rng.randrange(120)) for _ in range(n)]
        schema = "a long, b long"
        part = components.components(spark.createDataFrame(first, schema))
        got = {r.node: r.root for r in components.merged(part, spark.createDataFrame(more, schema)).collect()}
        want = {r.node: r.root for r in components.components(spark.createDataFrame(first + more, schema)).collect()}
        assert got == want


# ------------------------------------------------------------------ op2

def removed(rows, length):
    count = Counter(b[i:i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        m = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                m[i:i + length] = b"\1" * length
        spans = sum(m[i] and not (i and m[i - 1]) for i in range(len(m)))
        out.append((d, len(b), sum(m), spans, hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [1, 7, 30])
def test_suffix_dedup_is_exact(spark, length):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abé") for _ in range(rng.choice([0, 3, 60, 300])))) for i in range(40)]
    rows += [(1, None), (None, "abab" * 30), (None, "abab" * 30)] + [(100 + i, "z" * i) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.removed_digest(df, length).collect()), key=repr) == removed(rows, length)


def test_suffix_dedup_keeps_columns_and_edges(spark, edge):
    out = suffix_dedup.suffix_dedup(edge).collect()
    assert len(out) == len(ROWS) and suffix_dedup.suffix_dedup(edge).columns == edge.columns
    by = {r.doc_id: r for r in out}
    assert by[1].text is None and by[4].text == "a b c d e f g" and by[10].text == "" and by[10].n_chars == 0
    assert suffix_dedup.suffix_dedup(edge.limit(0)).count() == 0


@here
def test_op2_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffix_dedup.op2_suffix_dedup(spark, SF).collect()), key=repr) == removed(rows, 400)


# ------------------------------------------------------------------ op5

def shingle_classes(rows):
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [WORD.findall(t or "")]}
    words = {i: tuple(WORD.findall(t or "")) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= 0.8 or words[a] and words[a] == words[b]:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_order_minhash_finds_the_classes_and_respects_order(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abc") for _ in range(4)) for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):  # a hot group of loose and close variants
        w = list(base)
        for _ in range(rng.choice([1, 2, 5, 12])):
            w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(70, None), (71, ""), (72, " \n"), (73, "a b"), (74, "a  b"), (75, "a b c d e"), (76, "a b c d e")]
    rows += [(90, " ".join(base[150:] + base[:150]))]  # the same words in another order
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = shingle_classes(rows[:-1])
    assert {i: got[i] for i in want} == want and got[90] == 90


def test_order_minhash_on_a_hot_group_of_loose_variants(spark, monkeypatch):
    """Variants of one text that share their edits: many just below the
    similarity of each other, links between them that no hub sees, and blocks
    far smaller than the group.  Recall of the links is 1, no class is joined
    that has none."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(150)]
    edits = [(rng.randrange(150), f"y{k}") for k in range(40)]
    rows = []
    for i in range(260):
        w = list(base)
        for at, word in rng.sample(edits, rng.choice([1, 2, 3, 5, 6, 7, 8])):
            w[at] = word
        rows.append((i, " ".join(x for k, x in enumerate(w) if k != (i % 150 if i % 4 == 0 else -1))))
    rows += [(1000 + i, " ".join(base[:60]) + f" tail{i} " + " ".join(f"z{i}k{k}" for k in range(60))) for i in range(40)]
    links = set()
    sets = {i: set(order_minhash.labelled(*order_minhash.shingles(*order_minhash._words(
        pa.RecordBatch.from_arrays([pa.array([t])], names=["t"]), "t"))).tolist()) for i, t in rows}
    for k, (a, _) in enumerate(rows):
        for b, _ in rows[k + 1:]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links.add((a, b))
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in sorted(links):
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (1 << 20, 1 << 13):
        monkeypatch.setattr(order_minhash._open_links, "__defaults__", (block,))
        got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
        assert np.mean([got[a] == got[b] for a, b in links]) >= 0.999
        assert all(root(a) == root(c) for a, c in got.items())
    assert len(set(got.values())) > 60


def test_open_texts_are_joined_once_whatever_the_number_of_blocks(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(24):
        t = list(base if i % 2 else base[::-1])
        t[rng.randrange(200)] = f"x{i}"
        texts.append((i, " ".join(t)))
    df = spark.createDataFrame(texts, "row long, text string")
    words = order_minhash._word_table(df, "row", "text")
    placed = df.select(F.lit(1).cast("long").alias("sketch"), "row", F.lit(200).cast("long").alias("n"), F.col("row").alias("root"))
    kept, keep = [], common.keep
    monkeypatch.setattr(common, "keep", lambda df, name: kept.append(name) or keep(df, name))
    for block in (1 << 20, 900):  # one text in a block, and all
        kept.clear()
        parent = list(range(24))
        for a, b in order_minhash._open_links(placed, words, block).collect():
            x, y = parent[a], parent[b]
            parent = [x if p == y else p for p in parent]
        assert kept.count("open-texts") == 1 and kept.count("open-words") == 1
        assert all((parent[i] == parent[j]) == (i % 2 == j % 2) for i in range(24) for j in range(24))


def test_picked_rows_by_bits(spark, monkeypatch):
    rng = random.Random(6)
    numbers = sorted({rng.randrange(-300, 300) for _ in range(200)} | {(k << 33) + i for k in range(3) for i in range(70)} | {-2**63, 2**63 - 1})
    chosen = rng.sample(numbers, 90) + [63, 64, 7, 7]
    df = spark.createDataFrame([(i, f"t{i}", 1, 2) for i in numbers], "no long, `a.b` string, at int, Bits int")
    rows = spark.createDataFrame([(i,) for i in chosen * 2], "row long")
    for longs in (common.PICKED, 0):
        monkeypatch.setattr(common, "PICKED", longs)
        for inside in (True, False):
            got = common.picked(df, "no", rows, inside)
            assert got.columns == df.columns
            assert sorted(r.no for r in got.collect()) == [i for i in numbers if (i in chosen) == inside]
        assert common.picked(df, "no", rows.limit(0)).count() == 0
        assert common.picked(df, "no", rows.limit(0), inside=False).count() == len(numbers)


def test_texts_do_not_move_to_be_picked(spark, monkeypatch):
    """However small the engine's own broadcasts are, no text is shuffled to
    find those that another one's sketch meets."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(200), 1 + i % 9):
            w[at] = f"x{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(r.doc_id for r in order_minhash.near_dedup(df).collect())
    plans, keep = defaultdict(list), common.keep
    monkeypatch.setattr(common, "keep", lambda d, name: plans[name].append(
        d._jdf.queryExecution().executedPlan().toString()) or keep(d, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = order_minhash.near_dedup(df)
        plans["out"].append(out._jdf.queryExecution().executedPlan().toString())
        assert sorted(r.doc_id for r in out.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("words", "open-words", "out"):
        assert len(plans[name]) == 1 and "BroadcastHashJoin" in plans[name][0] and "Exchange hashpartitioning" not in plans[name][0]


def test_row_numbers_survive_another_parallelism(spark, tmp_path):
    """Executors come and go between stages: rows, and so results, stay the same."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(60)]
    rows = [(i % 90, texts[i % 60] if i % 2 else texts[i % 60][::-1], f"s{i % 3}") for i in range(240)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(24).write.parquet(path)

    results, keep, seen = [], common.keep, []

    def kept(df, name):
        """Files packed into one partition, or one partition a file, by turns."""
        seen.append(name)
        spark.conf.set("spark.sql.files.openCostInBytes", "128m" if len(seen) % 2 else "0")
        return keep(df, name)
    try:
        for change in (False, True):
            with pytest.MonkeyPatch.context() as m:
                if change:
                    m.setattr(common, "keep", kept)
                docs = spark.read.parquet(path)
                results.append([sorted(map(tuple, order_minhash.near_dedup(docs).collect())),
                                sorted(map(tuple, mixing.mix_sources(docs).collect()))])
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert results[0][0] == results[1][0] and len(results[0][0]) == 60  # each text one way
    assert abs(len(results[0][1]) - len(results[1][1])) <= 6


def test_aligned_is_a_longest_common_subsequence():
    rng = random.Random(4)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            prev = 0
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(20))] for _ in range(2))
        assert order_minhash.aligned(a, b, 20) == lcs(a, b)


def test_near_dedup_edges(spark, edge):
    out = order_minhash.near_dedup(edge)
    assert out.columns == edge.columns and out.count() == len(ROWS) - 1
    assert order_minhash.near_dedup(edge.limit(0)).count() == 0


# ------------------------------------------------------------------ op1

@here
def test_quality_agrees_with_labels(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r.doc_id: r.kept for r in quality.op1_quality_classifier(spark, sf).collect()}
    lab = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert np.mean([got[d] == bool(q) for d, q in lab.items()]) > 0.98


def test_quality_edges(spark, edge):
    out = quality.quality_filter(edge)
    assert out.columns == edge.columns and {r.doc_id for r in out.collect()} <= {4, None, 9, 10}
    assert quality.quality_filter(edge.limit(0)).count() == 0
    p, _ = quality.posteriors(np.array([2 + 6, 1 + 3, 0]), np.array([90.0, 10.0, 1.0]))
    assert p[0] > 0.9 > 0.5 > p[1]


def copies_and_others(spark):
    """3000 copies of the one text of 1000 whose hash is picked first, before 600 others."""
    texts = spark.range(1000).select(F.concat(F.lit("copied words here "), "id").alias("text"))
    copied = texts.orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 30))).first().text
    rows = [(copied, "x")] * 3000 + [(f"some other words {i}", "xy"[i % 2]) for i in range(600)]
    return spark.createDataFrame(rows, "text string, lang string")


def test_quality_sample_counts_copies_once(spark, monkeypatch):
    got, fit = [], quality._fit
    monkeypatch.setattr(quality, "_fit", lambda rows: got.extend(rows) or fit(rows))
    assert quality.train(copies_and_others(spark), sample=200) and len(got) == 200
    got.clear()
    assert quality.train(copies_and_others(spark), sample=2000) and len(got) == 601


# ------------------------------------------------------------------ op3

@here
def test_lm_base_is_exact_and_the_model_better(spark):
    got = {r.doc_id: r for r in bloom_lm.op3_bloom_lm(spark, SF).collect()}
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d: [*WORD.findall(t.translate(low)), 0] for d, t in docs}
    c = Counter(w for d, x in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in x)
    n, v = sum(c.values()), len(c)
    for d, x in tokens.items():
        g = got[d]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(x), sum(c[w] > 0 for w in x), n)
        assert g.base_score == pytest.approx(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in x), rel=1e-9)
    assert sum(g.score for g in got.values()) > sum(g.base_score for g in got.values())


def test_filter_counts_never_exceed_and_edges(spark, edge):
    names = np.sort(common.mix(np.arange(1, 3000, dtype=np.uint64)))
    count = np.random.default_rng(1).integers(2, 5000, len(names))
    level = bloom_lm.levels(count)
    e = common.bucket_edges(names, 4)
    bloom = bloom_lm.LogBloom({k: bloom_lm.LogBloom.segment(names[e[k]:e[k + 1]], level[e[k]:e[k + 1]]) for k in range(4)}, 4)
    read = bloom.counts(names)
    assert (read >= np.floor(count / 2 ** 0.5) - 1).all() and np.mean(read <= count) > 0.97
    assert np.mean(bloom.counts(common.mix(np.arange(10**6, 10**6 + 3000, dtype=np.uint64))) > 0) < 0.05
    docs = edge.select("doc_id", "text", F.lit(False).alias("held_out"))
    assert bloom_lm.lm_scores(docs).count() == len(ROWS) and bloom_lm.lm_scores(docs.limit(0)).count() == 0


def test_lm_uses_every_training_bigram(spark, monkeypatch):
    """Counts of 1 and more, each bigram a token would otherwise leave to the
    unigrams; read from the broadcast filter, in one pass or in many."""
    seen, build = [], bloom_lm.filter_segments
    monkeypatch.setattr(bloom_lm, "filter_segments", lambda *a: seen.append(build(*a)) or seen[-1])
    texts = ["the cat sat", "the dog ran off", "the dog ran home", *["red fox"] * 5, *["blue owl"] * 9]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)] + [(100, "the cat ran home", True)],
                                 "doc_id long, text string, held_out boolean")
    pairs, c = Counter(), Counter()
    for t in texts:
        x = ["<s>", *t.split(), 0]
        c.update(x)
        pairs.update(zip(x, x[1:]))
    v, n = len(c) - 1, sum(c.values()) - c["<s>"]
    quant = lambda k: math.floor(2 ** (math.floor(2 * math.log2(k) + 1e-9) / 2) + 1e-6) if k else 0
    want = {}
    for d, t in [*enumerate(texts), (100, "the cat ran home")]:
        x, want[d] = ["<s>", *t.split(), 0], 0.0
        for h, w in zip(x, x[1:]):
            p0 = (c[w] + bloom_lm.ALPHA) / (n + bloom_lm.ALPHA * (v + 1))
            want[d] += math.log10((quant(pairs[h, w]) + bloom_lm.MU * p0) / (c[h] + bloom_lm.MU))
    made = []
    for most in (bloom_lm.FILTER_BYTES, 1):  # the whole filter at once, and one segment after the other
        monkeypatch.setattr(bloom_lm, "FILTER_BYTES", most)
        got = {r.doc_id: r for r in bloom_lm.lm_scores(docs).collect()}
        assert {d: r.score for d, r in got.items()} == pytest.approx(want, rel=1e-9)
        assert all(r.n_tokens == len(t.split()) + 1 for r, t in zip(map(got.get, range(len(texts))), texts))
        made.append(len(bloom_lm.name_ranges(seen[-1], most)))
    assert made[0] == 1 < made[1]
    # nothing but the filter tells counts: without its bits every bigram is unknown
    monkeypatch.setattr(bloom_lm, "filter_segments", lambda *a: build(*a).withColumn("segment", F.lit(bytearray(8))))
    blind = {r.doc_id: r.score for r in bloom_lm.lm_scores(docs).collect()}
    assert all(blind[d] < want[d] for d in range(len(texts)))


def test_lm_texts_are_scored_once_however_many_ranges(spark, monkeypatch):
    """More ranges of the filter are more broadcasts, not more passes over the
    texts; every block gets each of its bigrams' levels once."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.5, 30) % 200) for _ in range(60)] + [None, "", "new words only"]
    docs = spark.createDataFrame([(i, t, i % 7 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    whole = {r.doc_id: r[:] for r in bloom_lm.lm_scores(docs).collect()}
    kept, keep, seen, build = [], common.keep, [], bloom_lm.filter_segments
    monkeypatch.setattr(common, "keep", lambda df, name, *a, **k: kept.append(name) or keep(df, name, *a, **k))
    monkeypatch.setattr(bloom_lm, "filter_segments", lambda *a: seen.append(build(*a)) or seen[-1])
    monkeypatch.setattr(bloom_lm, "FILTER_BYTES", 1)
    got = {r.doc_id: r[:] for r in bloom_lm.lm_scores(docs).collect()}
    assert len(bloom_lm.name_ranges(seen[-1], 1)) > 1 and kept.count("scores") == 1
    assert got.keys() == whole.keys() and all(got[d] == pytest.approx(whole[d], rel=1e-12) for d in whole)
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 300)  # many blocks
    got = {r.doc_id: r[:] for r in bloom_lm.lm_scores(docs).collect()}
    assert got.keys() == whole.keys() and all(got[d] == pytest.approx(whole[d], rel=1e-12) for d in whole)
    replies = bloom_lm.probed(seen[-1], 4 * common.parallelism(spark))
    assert replies.select("block").distinct().count() > 3
    assert replies.count() == replies.select("block", "bucket").distinct().count()
    assert replies.filter(F.length("reply") == 0).count() == 0


# ------------------------------------------------------------------ op4, op6

def embeddings(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)] + [(400 + i, [0.5] * 8) for i in range(40)]
    rows += [(20, None), (500, None), (520, [None] * 8), (540, [float("nan")] * 8), (560, [0.0] * 8), (580, [1.0, 2.0]),
             (None, [1.0] * 8), (600, []), (0, rows[0][1]), (0, rows[5][1]), (40, rows[7][1]), (1, rows[9][1]), (1, rows[9][1])]
    live = [(i, np.float32(v).astype(float)) for i, v in rows if v and None not in v and not np.isnan(v).any()]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit(1)), live


def nearest_rows(live, every, score, k):
    """Counter of (query id, rank, id) by brute force over rows; ids of null last."""
    out, late = [], float("inf")
    for a, (q, x) in enumerate(live):
        if q is not None and q % every == 0:
            s = sorted((score(x, y), late if i is None else i) for b, (i, y) in enumerate(live) if a != b and len(x) == len(y))[:k]
            out += [(q, r, None if i == late else i, c) for r, (c, i) in enumerate(s, 1)]
    return out


def test_va_file_is_exact(spark):
    df, live = embeddings(spark)
    v = vectors.usable(df, "vec_id", "embedding")
    got = Counter(map(tuple, va_file.top_k(v, v.filter("vec_id % 20 = 0"), k=7, shard=50, block=4).collect()))
    want = nearest_rows([(i, np.floor(64 * x).astype(int)) for i, x in live], 20, lambda x, y: -int(x @ y), 7)
    assert got == Counter((q, r, i, -c) for q, r, i, c in want)
    # a vec_id that repeats has all its rows: five under 0, 1 and 40 twice or more
    small = spark.createDataFrame([(20, [1.0]), (1, [0.5]), (1, [0.25]), (2, [0.1])], "vec_id long, embedding array<double>")
    v = vectors.usable(small, "vec_id", "embedding")
    assert [tuple(r)[:3] for r in va_file.top_k(v, v.filter("vec_id = 20")).orderBy("rank").collect()] == [
        (20, 1, 1), (20, 2, 1), (20, 3, 2)]
    none = v.limit(0)
    assert va_file.top_k(none, none).count() == 0


def test_va_file_sql_counts_rows_as_the_query_does(spark):
    import duckdb
    df, live = embeddings(spark)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [tuple(r)[:2] for r in df.collect()])
    want = nearest_rows([(i, np.floor(64 * x).astype(int)) for i, x in live], 20, lambda x, y: -int(x @ y), 20)
    assert Counter(con.execute(va_file.ORACLE).fetchall()) == Counter((q, r, i, -c) for q, r, i, c in want)


def test_vp_tree_is_exact_at_factor_one(spark):
    df, live = embeddings(spark)
    v = vectors.usable(df, "vec_id", "embedding", zero=False)
    got = sorted(map(tuple, vp_tree.neighbours(v, v.filter("vec_id % 20 = 0"), k=5, factor=1.0, shard=60, block=4).collect()),
                 key=repr)
    want = sorted(nearest_rows([(i, x) for i, x in live if x.any()], 20,
                               lambda x, y: float(np.sqrt(((x - y) ** 2).sum())), 5), key=repr)
    assert Counter(g[:3] for g in got) == Counter(w[:3] for w in want)
    assert np.allclose(sorted(g[3] for g in got), sorted(w[3] for w in want), rtol=1e-12)
    none = v.limit(0)
    assert vp_tree.neighbours(none, none).count() == 0


def test_search_shuffles_no_vectors(spark):
    """Shards are written once; the joins with the query blocks are broadcasts of bounded blocks."""
    df, _ = embeddings(spark)
    v = vectors.usable(df, "vec_id", "embedding")
    coded, asked = vectors.shards(v, 50, lambda x: b""), vectors.blocks(v.filter("vec_id % 20 = 0"), 4)
    pairs = coded.join(F.broadcast(asked.filter("block = 0").drop("block")), "dim")
    text = pairs._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert asked.agg(F.max(F.length("q_vecs"))).first()[0] <= 8 * 8 * 16


@here
def test_vp_tree_recall(spark):
    sf = SF.replace("0.001", "0.1")
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    got = vp_tree.op6_vp_tree(spark, sf).toPandas().groupby("query_id").vec_id.apply(set)
    hits = []
    for k in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[k]) ** 2).sum(1)
        d[k] = np.inf
        hits.append(len(got[ids[k]] & set(ids[np.argsort(d)[:10]])) / 10)
    assert np.mean(hits) >= 0.9


# ------------------------------------------------------------------ op7

def test_mix_reaches_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.choice([3, 3, 3, 10, 50])), rng.choice(["a", "a", "a", "b", "c", None, "d"]))
            for i in range(6000)] + [(9000, None, "a"), (9001, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keyed = common.numbered(df, "k")
    got = mixing.copies(keyed, "k").toPandas()
    again = mixing.copies(keyed, "k").toPandas()
    assert sorted(zip(got.row, got.copies)) == sorted(zip(again.row, again.copies))
    source = dict((i, s) for i, _, s in rows)
    size = defaultdict(int)
    for i, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted(k for k in size if k) + [None]
    weight, target = {k: (3, 1, 2)[i % 3] for i, k in enumerate(names)}, {}
    left, free = 1.5 * sum(size.values()), set(names)
    while True:
        unit = left / sum(weight[k] for k in free)
        over = {k for k in free if weight[k] * unit > 2 * size[k]}
        if not over:
            target.update({k: unit * weight[k] for k in free})
            break
        target.update({k: 2 * size[k] for k in over})
        left, free = left - sum(2 * size[k] for k in over), free - over
    taken = defaultdict(int)
    for i, c, n, t in zip(got.id, got.copies, got["size"], got.target):
        taken[source[i]] += c * n
        assert t == pytest.approx(target[source[i]]) and c <= 2
    assert all(abs(taken[k] - target[k]) <= 110 for k in names)


def test_mix_edges(spark, edge):
    out = mixing.mix_sources(edge)
    assert out.columns == edge.columns and out.count() <= 2 * len(ROWS)
    assert mixing.mix_sources(edge.limit(0)).count() == 0


# ------------------------------------------------------------------ op8, op9

@here
def test_language_accuracy(spark):
    got = [r for r in language.op8_string_kernel(spark, SF.replace("0.001", "0.01")).collect() if r.held_out]
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()}
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in got]) > 0.95


def test_language_edges(spark, edge):
    model = language.train(edge)
    got = {r.doc_id: r for r in language.predict(edge, model, ["doc_id"]).collect()}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (1, 2, 3)) and got[4].lang_pred in ("x", "y")
    assert language.train(edge.limit(0)) is None and language.predict(edge, None, ["doc_id"]).first().lang_pred == "und"


def test_language_sample_counts_copies_once(spark, monkeypatch):
    got = []
    monkeypatch.setattr(language, "fit", lambda texts, langs: got.extend(zip(texts, langs)))
    language.train(copies_and_others(spark), per_language=50)
    assert len(set(got)) == len(got) and Counter(k for _, k in got) == {"x": 50, "y": 50}


def test_language_trains_on_the_true_middle(spark, monkeypatch):
    got = []
    monkeypatch.setattr(language, "fit", lambda parts, langs: got.extend(parts))
    text = "a" * 100_000 + "M" * 2_000 + "b" * 99_000
    language.train(spark.createDataFrame([(text, "x"), ("short", "y")], "text string, lang string"))
    assert sorted(got) == [b"M" * 1000, b"a" * 1000, b"short"]


def test_toxicity_finds_marked_documents(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    rows, labels = [], []
    for i in range(500):
        w, bad = [word() for _ in range(rng.randint(20, 200))], i % 4 == 0
        for _ in range(3 * bad):
            w[rng.randrange(len(w))] = rng.choice(["vilenasty", "hatewordy", "grossinsult"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.scores(
        docs, toxicity.train(docs, known.filter("doc_id % 5 != 0")), ["doc_id"]).collect()}
    assert np.mean([got[i] == y for i, y in labels if i % 5 == 0]) > 0.95


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(4, 0), (9, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.scores(edge, toxicity.train(edge, labels), ["doc_id"]).count() == len(ROWS)
    assert {r.score for r in toxicity.scores(edge, toxicity.train(edge, labels.limit(0)), ["doc_id"]).collect()} == {0.0}


# ------------------------------------------------------------------ op10

def test_tree_concatenation_equals_the_library():
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(bpe.vocabulary()), bpe.Encoder(bpe.vocabulary(), leaf=16)
    rng = random.Random(1)
    for k in range(150):
        letters = rng.choice(["ab", "aeinst", "thela", "!?#", "日本éß", "abc1", "xyz<|endoftext|>", "aÁe\xa0Σ"])
        s = "".join(rng.choice(letters) for _ in range(rng.choice([10, 50, 300, 2000])))
        s = s + "<|endoftext|>" + s if k % 5 == 0 else s
        e = tok.encode(s, add_special_tokens=False)
        assert enc.encode_long(s) == (e.ids, e.tokens)


def test_bpe_edges_and_round_trip(spark, edge):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.vocabulary())
    rows = bpe.decode(bpe.encode(edge, bpe.vocabulary()), bpe.vocabulary()).collect()
    want = sorted(((i, tok.encode(t or "", add_special_tokens=False).ids) for i, t, _, _ in ROWS), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in rows), key=repr) == want
    assert all(r.text == r.decoded for r in rows)
    assert bpe.encode(edge.limit(0), bpe.vocabulary()).count() == 0


# ------------------------------------------------------------------ pipeline

@here
def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = common.read(spark, SF, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.keep(stage(spark, docs, SF), name)
        assert docs.columns == columns
        n, before = docs.count(), n
        assert 0 < n <= before or name == "systematic_mix"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == n


# ------------------------------------------------------------------ registered queries

@here
def test_op10_digests_equal_the_library(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.vocabulary())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op10_bpe_tree(spark, SF).collect()}
    assert got == want


@here
def test_op5_classes_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in order_minhash.op5_order_minhash(spark, SF).collect()}
    want = shingle_classes(rows)  # by sets: order does not count there, so its classes can only be larger
    assert len(got) == len(rows) and all(want[i] == want[r.class_id] for i, r in got.items())
    assert np.mean([got[i].class_id == c for i, c in want.items()]) > 0.99
    assert sum(r.kept for r in got.values()) == len({r.class_id for r in got.values()})


@here
def test_op7_takes_words_near_the_targets(spark):
    got = mixing.op7_systematic_mix(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(docs) and (got.taken <= 2 * got["size"]).all()
    got["source"] = got.doc_id.map(docs.source)
    assert (got["size"] == got.doc_id.map(docs.text.map(lambda t: len(WORD.findall(t or ""))))).all()
    for _, part in got.groupby("source", dropna=False):
        assert part["size"].sum() == part.source_size.iloc[0] and part.target.nunique() == 1
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 2 * part["size"].max()


@here
def test_op9_scores_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    got = toxicity.op9_zstd_distance(spark, sf).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in got if r.held_out and toxic.get(r.doc_id) is not None]) > 0.85
