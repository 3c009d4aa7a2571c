"""Operators 1 and 7."""

import math
import random

import numpy as np
import pytest
from llm_fixtures import docs, make, no_docs, pairs, prose  # noqa: F401
from pyspark.sql import functions as F

from cohort_effects.llm import op1_decontaminate as op1
from cohort_effects.llm.op1_decontaminate import clean, common_subsequence, contamination, randomised_svd
from cohort_effects.llm.op7_topk import op7_topk, scaled, top_k


def planted(spark):
    rng = random.Random(8)
    bench = [prose(rng, n) + ". " + prose(rng, 6) + "." for n in (9, 20, 35, 45, 120)]
    rows, leaks = [], set()
    for i in range(60):
        rows.append((i, prose(rng, 40 + 5 * i)))
    for k, b in enumerate(bench):
        rows.append((100 + k, prose(rng, 77) + " " + b + " " + prose(rng, 50)))
        rows.append((110 + k, b.upper()))
        w = b.split()  # a paraphrase: every fourth word replaced, but for the answer
        w = [f"other{j}" if j % 4 == 1 and j < len(w) - 6 else x for j, x in enumerate(w)]
        rows.append((120 + k, prose(rng, 20) + " " + " ".join(w) + " " + prose(rng, 30)))
        leaks |= {(100 + k, k), (110 + k, k), (120 + k, k)}
    rows += [(200, None), (201, ""), (202, " . "), (None, bench[1])]
    items = [(k, b, "x") for k, b in enumerate(bench)] + [(9, None, "x"), (10, "", "x"), (0, bench[0], "x")]
    leaks.add((None, 1))
    return make(spark, rows), spark.createDataFrame(items, "item_id long, text string, score string"), leaks, rows


def test_leaks_and_paraphrases(spark):
    docs, bench, leaks, rows = planted(spark)
    got = contamination(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    stay = clean(docs, bench)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {i for i, _ in rows} - {i for i, _ in leaks}


ITEM = "item_id long, text string"


def dump(spark):
    """Short items next to each other in one document, five or so a window."""
    rng = random.Random(21)
    items = [(k, prose(rng, 12) + ". " + prose(rng, 5) + ".") for k in range(14)]
    rows = [(1, " ".join(b for _, b in items)), *((k, prose(rng, 200)) for k in range(2, 12))]
    return make(spark, rows), spark.createDataFrame(items, ITEM), {(1, k) for k, _ in items}


def test_adjacent_items(spark):
    docs, bench, leaks = dump(spark)
    assert {(r.doc_id, r.item_id) for r in contamination(docs, bench).collect()} == leaks
    assert 1 not in {r.doc_id for r in clean(docs, bench).collect()}


def test_paraphrases_that_exchange_the_rarest_words(spark):
    rng = random.Random(22)
    common = [f"func{j}" for j in range(12)]
    items, rows, leaks = [], [(k, prose(rng, 150) + " " + " ".join(common)) for k in range(50, 60)], set()
    for k in range(8):
        rare, answer = prose(rng, 12).split(), prose(rng, 6)
        text = lambda words: " ".join(f"{a} {b}" for a, b in zip(common, words, strict=True)) + ". " + answer  # noqa: B023, E731
        items.append((k, text(rare)))
        rows.append((k, prose(rng, 40) + " " + text([f"new{k}x{j}" for j in range(12)]) + " " + prose(rng, 40)))
        leaks.add((k, k))
    got = contamination(make(spark, rows), spark.createDataFrame(items, ITEM)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks


def test_blocks_change_nothing(spark, monkeypatch):
    docs, bench, leaks = dump(spark)
    found = []
    for block in (256, 13, 5):
        monkeypatch.setattr(op1, "BLOCK", block)
        found.append({(r.doc_id, r.item_id): tuple(r) for r in contamination(docs, bench).collect()})
    assert set(found[0]) == leaks
    for other in found[1:]:
        assert set(other) == leaks
        assert all(other[k] == pytest.approx(found[0][k], abs=1e-5) for k in leaks)


def test_least_share_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n, square = rng.integers(1, 4, 8), rng.random(8)
        need = int(rng.integers(1, n.sum() + 1))
        held = [[b >> j & 1 for j in range(8)] for b in range(256)]
        least = min(np.dot(h, square) for h in held if np.dot(h, n) >= need) / square.sum()
        assert op1.least_share(n, square, need) <= least + 1e-12


def test_no_benchmark_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).collect() == []
    assert contamination(no_docs, spark.createDataFrame([(1, "one two three four five six seven eight nine")], none.schema)).collect() == []


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        masks = {}
        for j, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << j
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert common_subsequence(masks, len(a), b) == t[-1][-1]


def test_common_subsequences_at_once():
    rng = random.Random(31)
    pairs = []
    for n in (1, 2, 7, 8, 33, 63, 64, 64):
        for _ in range(6):
            pairs.append(([rng.randrange(9) for _ in range(n)], [rng.randrange(12) for _ in range(96)]))
    pairs += [(list(range(64)), list(range(64)) + [99] * 32), (list(range(64)), [99] * 96)]
    want, masks = [], np.zeros((96, len(pairs)), np.uint64)
    for i, (a, b) in enumerate(pairs):
        bits = {x: sum(1 << j for j, y in enumerate(a) if y == x) for x in a}
        want.append(common_subsequence(bits, len(a), b))
        masks[:, i] = [bits.get(x, 0) for x in b]
    assert op1.common_subsequences(masks, np.array([len(a) for a, _ in pairs])).tolist() == want


def test_windows_add_up_each_term_of_a_cell_once(monkeypatch):
    """A window holds three cells; its rows were added up once for each."""
    monkeypatch.setattr(op1, "CELLS", 4)
    rng = np.random.default_rng(12)
    size = np.array([0, 1, 31, 32, 33, 500, 64, 0, 97])
    at = rng.integers(-3, 40, size.sum())
    packed = rng.integers(0, 9, (40, 2)).astype(np.uint64)
    first, n_cells = np.cumsum(size) - size, np.maximum(-(-size // op1.STRIDE), 1)
    base = np.cumsum(n_cells + 2) - n_cells
    cell = np.concatenate([base[d] + np.arange(n) // op1.STRIDE for d, n in enumerate(size)])
    asked = []

    class Counted(np.ndarray):
        def __getitem__(self, k):
            asked.append(k)
            return np.asarray(self)[k]

    got = {}
    for s, held in op1.window_counts(at, op1.previous(at), cell, packed.view(Counted)):
        got |= {s + k: row.tolist() for k, row in enumerate(held)}
    for d, n in enumerate(size):
        for k in range(int(n_cells[d]) if n else 0):
            held = set(at[first[d] + k * op1.STRIDE : first[d] + min(n, k * op1.STRIDE + op1.SPAN)].tolist()) - {-1, -2, -3}
            assert got[int(base[d]) + k] == packed[sorted(held)].sum(axis=0).tolist()
    # slices of four cells read two cells of the next slice again
    alone = sum(len(set(at[(cell == c) & (at >= 0)].tolist())) for c in set(cell.tolist()))
    assert alone <= sum(map(len, asked)) <= 1.6 * alone


def test_lookup_of_terms_with_the_same_leading_bits():
    rng = random.Random(2)
    terms = np.unique(np.array([*range(50), *range(2**63, 2**63 + 9), *range(2**64 - 7, 2**64), *(rng.getrandbits(64) for _ in range(200))], np.uint64))
    asked = np.concatenate([terms, terms + np.uint64(1), terms - np.uint64(1)])
    number = {int(x): k for k, x in enumerate(terms)}
    assert op1._lookup(terms)(asked).tolist() == [number.get(int(x), -1) for x in asked]


def brute_leaks(rows, items):
    """Every passage against every window, by the rule itself."""
    strip = lambda text: [(w.strip(MARKS), w[-1] in ".!?") for w in text.lower().split() if w.strip(MARKS)]
    out = {}
    for item, text in items:
        words = strip(text)
        a = [w for w, _ in words]
        stops = [k for k, (_, stop) in enumerate(words[:-1]) if stop]
        tail = a[-min(len(a), max(3, len(a) - 1 - stops[-1] if stops else len(a))) :]
        masks = {x: sum(1 << j for j, y in enumerate(a) if y == x) for x in a}
        for doc, body in rows:
            b = [w for w, _ in strip(body)]
            for start in range(0, max(len(b), 1), 32):
                window = b[start : start + 96]
                holds = lambda part: any(window[k : k + len(part)] == part for k in range(len(window)))  # noqa: B023, E731
                lcs = common_subsequence(masks, len(a), window)
                if (lcs == len(a) and holds(a)) if len(a) < 8 else lcs >= 0.7 * len(a) or (lcs >= 0.5 * len(a) and holds(tail)):
                    inside = [p for p, w in enumerate(window) if w in masks]
                    found = (lcs / len(a), lcs, len(a), start + inside[0], inside[-1] - inside[0] + 1)
                    if found[:2] > out.get((doc, item), (0, 0))[:2]:
                        out[doc, item] = found
    return out


MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def test_leaks_against_brute_force(spark):
    """Few different words, so that windows meet terms again and most passages
    share many words with most windows; documents of several chunks of text."""
    rng = random.Random(41)
    few = [prose(rng, 1) for _ in range(45)]
    text = lambda n: " ".join(rng.choice(few) + rng.choice(("", "", "", ",", ".")) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate((1, 3, 7, 8, 9, 15, 16, 24, 33, 48, 63, 64))]
    items += [(20 + k, text(n) + ". " + text(4)) for k, n in enumerate((10, 20, 30, 59))]
    rows = [(k, text(rng.choice((0, 1, 5, 31, 32, 33, 96, 97, 200, 400)))) for k in range(60)]
    for k, (_, b) in enumerate(items):
        w = b.split()
        rows.append((100 + k, text(rng.randrange(90)) + " " + b.upper() + " " + text(rng.randrange(60))))
        rows.append((150 + k, text(33) + " " + " ".join(x for j, x in enumerate(w) if j % 4 or j > len(w) - 5) + " " + text(10)))
        rows.append((200 + k, text(20) + " " + " ".join(x if j % 2 or j > len(w) - 5 else "other" for j, x in enumerate(w))))
    rows.append((300, text(300) + " " + " ".join(prose(rng, 1) + "x" for _ in range(45_000)) + " " + items[11][1]))
    rows = [(i, " ".join(t.split())) for i, t in rows]
    got = contamination(make(spark, rows).coalesce(1), spark.createDataFrame(items, ITEM)).collect()
    want = brute_leaks(rows, items)
    assert {(r.doc_id, r.item_id): (r.share, r.common_words, r.passage_words, r.start_word, r.n_words) for r in got} == want
    assert len(got) == len(want) > 100 and all(0 < r.cosine <= 1 for r in got)


def test_svd_spans_the_passages(spark):
    rng = np.random.default_rng(6)
    terms = np.unique(rng.integers(0, 2**63, 300)).astype(np.uint64)
    lists = [rng.choice(terms, 12, replace=False).astype(np.int64).tolist() for _ in range(20)]
    rows = spark.createDataFrame([(w,) for w in lists], "words array<long>").repartition(3)
    v = randomised_svd(rows, terms, np.ones(len(terms)), 20)
    a = np.zeros((20, len(terms)))
    for k, w in enumerate(lists):
        a[k, np.searchsorted(terms, np.array(w, np.int64).astype(np.uint64))] = 1 / math.sqrt(12)
    assert np.allclose(a @ v @ v.T, a, atol=1e-8)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(700)]
    rows += [(i, rows[5][1]) for i in range(700, 712)]  # ties
    rows += [(800, None), (900, [1.0, None, 2.0]), (1000, [float("nan")] * 8), (1100, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(1200, [0.5, -0.5]), (1300, []), rows[3]]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    want = brute_top_k([(i, [*v, *[0.0] * (8 - len(v))]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)])
    got = top_k(scaled(df), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def brute_top_k(rows, k=10):
    """Every row a candidate; the rows of one query id ranked together."""
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in whole if i % 100 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for j, x in whole if j == q for i, v in whole if i != q)
        out += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -t))) for n, (t, i) in enumerate(scores[:k])]
    return out


def test_repeated_rows_all_count(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(120)]
    rows += [rows[7]] * 4 + [rows[100]] * 2 + [(100, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = top_k(scaled(df), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top_k(rows))


def test_large_components_are_scored_exactly(spark):
    rows = [(100, [2.0**40, -1.0]), (1, [2.0**40, 3.0]), (2, [2.0**40, 2.0]), (3, [-(2.0**40), 5.0]), (4, [1.0, 1.0]), (200, [2.0**19, 1.0]), (5, [2.0**20, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(scaled(df), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top_k(rows))


@pytest.mark.parametrize("block", [1 << 24, 1 << 11])
def test_few_exact_vectors_are_read(spark, monkeypatch, block):
    """Of 3000 x 30 pairs, the cells leave a few open and fewer are scored."""
    from cohort_effects.llm import op7_topk as T

    monkeypatch.setattr(T, "BLOCK_BYTES", block)
    monkeypatch.setattr(T, "QUERIES", 16)
    read, plain = [], T.exact_scores
    monkeypatch.setattr(T, "exact_scores", lambda pairs, rows: read.append(pairs.count()) or plain(pairs, rows))
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(3000)]
    got = T.top_k(scaled(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), F.col("vec_id") % 100 == 0).collect()
    whole = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    for q in range(0, 3000, 100):
        scores = whole @ whole[q]
        best = sorted((-int(x), i) for i, x in enumerate(scores) if i != q)[:10]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(i, -x) for x, i in best]
    assert len(read) == 2 and 300 <= sum(read) < 0.02 * 3000 * 30


def test_top_k_no_rows(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op7_topk(spark, str(tmp_path)).collect() == []
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(scaled(one), F.col("vec_id") % 100 == 0).collect() == []


def test_top_k_against_its_sql(spark):
    import duckdb

    from cohort_effects.llm.op7_topk import OP7_SQL

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.execute(OP7_SQL).fetchall()
    got = op7_topk(spark, "/root/testdata/sf0.001").select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_repeated_ids_with_different_vectors_against_the_sql(spark):
    import duckdb
    import pandas as pd

    from cohort_effects.llm.op7_topk import OP7_SQL

    rng = np.random.default_rng(12)
    rows = [(i % 70 * 5, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(200)]  # 0, 100, 200, 300 are queries
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["vec_id", "embedding"]))
    con.execute("CREATE VIEW embeddings AS SELECT vec_id, CAST(embedding AS FLOAT[]) AS embedding FROM given")
    want = con.execute(OP7_SQL).fetchall()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(scaled(df), F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 40
