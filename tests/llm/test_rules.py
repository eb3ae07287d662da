"""Quality rules (compression bands) and the filter audit against brute force."""

import base64
import itertools
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from bazaar.llm import compression_bands as bands
from bazaar.llm import filter_audit as audit
from bazaar.llm import text_counts

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", "a b c d e f g h a b c d e f g h", "x " * 9, "x " * 7 + "y", "l one\nl one\n l one\nl one\n\n\n",
         "l\r\nl\r\nl", "é ½ 日本 # $ |\x0b<*>\x0c%&", "a b c d e f g h i j a b c d e f g h q r b c d e f g h i",
         "w " * 30 + "\n" + "w " * 30, "lorem ipsum " * 5000, "z" * 30000, "\n", "tail\n", "\nhead", "A b"]


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by the definitions."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    at = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if at[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def verdict(text):
    """Whether the rules keep a text, each band looked up on its own."""
    n, _, _, _, repeated = counts(text)
    if n < 20 or 100 * repeated > 30 * n:
        return True, False

    def bad(b):
        ratio = len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))
        low, high = next((lo, hi) for upto, lo, hi in bands.LIMITS if len(b) <= upto)
        return not low <= ratio <= high
    raw = text.encode()
    parts = [raw[i:i + 2048] for i in range(0, len(raw), 2048)]
    return False, not bad(raw) and sum(len(p) for p in parts if bad(p)) <= 0.25 * len(raw)


def test_counts_match_brute_force():
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab \n\té") for _ in range(rng.choice([0, 1, 5, 80, 400]))) for _ in range(200)]
    for column in (pa.array(texts), pa.array(["skipped", *texts]).slice(1), pa.array([], pa.string()), pa.array([None], pa.string())):
        t = text_counts.Counted(column)
        got = list(zip(*(x.tolist() for x in (t.words(), t.code_points(True), t.chars(text_counts.flags(bands.SYMBOLS)),
                                              t.duplicate_lines(), t.repeated_windows(8)))))
        assert got == [counts(x) for x in column.to_pylist()]
        assert t.distinct_words().tolist() == [len(set(WORD.findall(x or ""))) for x in column.to_pylist()]
        assert t.code_points().tolist() == [len(x or "") for x in column.to_pylist()]


def test_long_texts_compress_in_pieces():
    z, data = zstandard.ZstdCompressor(level=3), base64.b64encode(np.random.default_rng(1).bytes(3 << 20))
    assert abs(bands.compressed(z, memoryview(data)) / len(z.compress(data)) - 1) < 0.01
    assert zstandard.ZstdDecompressor().decompress(z.compress(data)) == data


def test_bands_reject_repetitive_and_incompressible(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.choice([2, 3, 4, 5, 6, 8]))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choices(vocabulary, weights=[1 / (i + 3) for i in range(900)], k=n))
    noise = lambda n: " ".join(base64.b64encode(rng.randbytes(30)).decode() for _ in range(n))
    pattern = " ".join(f"item {i % 50} costs {i % 7} coins" for i in range(600))
    rows = [(0, prose(60)), (1, prose(300)), (2, prose(5000)), (3, noise(100)), (4, pattern), (5, prose(1500) + " " + noise(250)),
            (6, prose(3000) + " " + noise(20)), (7, prose(3))]
    got = {r.doc_id: r for r in bands.judge(spark.createDataFrame(rows, "doc_id long, text string"), keep=("doc_id",)).collect()}
    assert [got[i].kept for i in range(8)] == [True, True, True, False, False, False, True, False]
    assert got[3].verdict == "incompressible" and got[5].verdict == "chunks" and got[5].noisy_chunks > 3
    assert got[7].verdict == "few words" and got[7].base_failed and not got[3].base_failed
    assert all((r.base_failed, r.kept) == verdict(rows[i][1]) for i, r in got.items())


def test_bands_on_edges(spark):
    rows = [(i if i % 3 else None, t, "x") for i, t in enumerate(TEXTS + TEXTS[3:6])]
    df = (spark.createDataFrame(rows, "doc_id long, text string, kept string")
          .withColumn("ratio", F.lit("b")).withColumn("keep0", F.lit(1)).repartition(3))
    got = bands.judge(df, keep=("doc_id", "keep0"))
    assert got.columns[:2] == ["doc_id", "keep0"]
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                    for r in got.collect())
    assert found == Counter((d, *counts(t), *verdict(t)) for d, t, _ in rows)
    assert bands.judge(df.limit(0), keep=("doc_id",)).count() == 0


@here
def test_op13_on_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:8] for r in bands.op13_compression_bands(spark, SF).collect()}
    assert got == {r.doc_id: (*counts(r.text), *verdict(r.text)) for r in rows}
    assert "Exchange" not in bands.op13_compression_bands(spark, SF)._jdf.queryExecution().executedPlan().toString()


# ----------------------------------------------------------------- op12

def audited(docs, labels):
    """The audit by applying every order to every document."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({d for d, q in labels[k] if q == 1 and d is not None} for k in (0, 1))
    fails = []
    for d, t, lang in docs:
        text, words = t or "", WORD.findall(t or "")
        f = "".join(x for x, hit in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search(r"[#$%&*|]", text)), d is not None and least[text] < d)) if hit)
        fails.append((lang or "", d, f))
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in fails}:
        rows = [(d, f) for p, d, f in fails if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for k, x in enumerate(order):
                here_, left = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                shapley[part, x] += len(here_)
                out[part, order, k + 1] = (len(left), len(here_), sum(x in f for _, f in rows) - len(here_),
                                           sum(f == x for _, f in rows), sum(d in good for d, _ in here_),
                                           sum(d in toxic for d, _ in here_))
    return {(p, o, k): (*v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def as_audit(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_galloping_merges_match_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 700, 5000):
        lists = [np.unique(rng.integers(0, 20000, int(n * x))) for x in (1, 0.01, 0.5, 0)]
        lists.append(np.arange(9000, 9000 + n))  # a stretch that others lack
        for many in itertools.permutations(lists, 3):
            assert audit.union(list(many)).tolist() == sorted(set(np.concatenate(many).tolist()))
            assert audit.difference(many[0], many[1]).tolist() == sorted(set(many[0].tolist()) - set(many[1].tolist()))
    ids = np.arange(0, 3000, 3)
    assert all(audit.gallop(ids, k, lo) == max(lo, -(-k // 3)) for k in (0, 1, 3, 1500, 2998, 2999) for lo in (0, 1, -(-k // 3)))


def rows_to_audit():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["ab", "Cd", "e", "f#", "gh", f"w{i}", f"x{i}y"]) for _ in range(rng.choice([0, 3, 150, 260])))
             for i in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(220)]
    docs += [(7, "copy of itself", "en"), (7, "copy of itself", "en"), (None, texts[0], "en"), (None, None, None), (300, None, "xx"),
             (301, "", "xx"), (302, "B " * 30000, "xx")]
    labels = ([(i, rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(None, 1), (7, 1), (7, 0)],
              [(i, rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(None, 1), (7, None), (7, 1)])
    return docs, labels


@pytest.mark.parametrize("bits,hot", [(15, 1000), (2, 3)])
def test_audit_matches_brute_force(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(audit, "RANGE_BITS", bits)
    monkeypatch.setattr(audit, "HOT", hot)
    docs, labels = rows_to_audit()
    df = (spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("part", F.lit("p"))
          .withColumn("row", F.lit(1)).withColumn("audit_row", F.lit(2)).withColumn("good", F.lit(True)).repartition(5))
    marks = spark.createDataFrame([(a, q, t) for (a, q), (_, t) in zip(*labels)], "doc_id long, quality int, toxic int")
    assert as_audit(audit.audit(df, marks)) == audited(docs, labels)
    assert audit.audit(df.limit(0), marks).count() == 0
    nothing = as_audit(audit.audit(df.filter("lang = 'xx'"), marks.limit(0)))
    assert nothing == audited([d for d in docs if d[2] == "xx"], ([], []))


def test_audit_sql_matches_brute_force():
    docs, labels = rows_to_audit()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", [(a, q, t) for (a, q), (_, t) in zip(*labels)])
    assert {r[:3]: r[3:] for r in con.execute(audit.ORACLE).fetchall()} == audited(docs, labels)


@here
def test_op12_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    marks = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = audited(rows, ([(r.doc_id, r.quality) for r in marks], [(r.doc_id, r.toxic) for r in marks]))
    assert as_audit(audit.op12_filter_audit(spark, SF)) == want
