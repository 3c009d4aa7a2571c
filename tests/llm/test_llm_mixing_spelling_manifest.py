"""Operators 11, 12 and 13."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_fixtures import SCHEMA, docs, make, no_docs, pairs, prose  # noqa: F401
from pyspark.sql import functions as F

from cohort_effects.llm import op11_mixing as X
from cohort_effects.llm import op12_spelling as W
from cohort_effects.llm import op13_manifest as M
from cohort_effects.llm.oracle import OP12_SQL, OP13_SQL


def in_sql(df, sql):
    """Rows of ``sql`` over ``df`` as the table ``documents``."""
    con = duckdb.connect()
    con.register("arrow_docs", df.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    con.execute("CREATE TABLE documents AS SELECT * FROM arrow_docs")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return Counter(tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in got.fetchall())


def in_spark(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


# --- 11


def poured(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing what is above the limit, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in order if s not in full)
        out = {s: most * sizes[s] if s in full else left * w[s] / free for s in order}
        over = {s for s in order if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, None: 300, "ä": 7, "Z": 0},
    {"one": 100},
    {f"s{k:02d}": (k * k * 37) % 911 for k in range(40)},
    {"a": 0, None: 0},
])
def test_targets(spark, sizes):
    got = X.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = poured(sizes) if any(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert {r.source: pytest.approx(r.target) for r in got.collect()} == want


def sourced(spark, n, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        size = int(rng.lognormvariate(3, 1.5)) if k % 11 else 0
        source = "hot" if rng.random() < 0.4 else rng.choice(["b", "c", None, "z", "é"])
        rows.append((k, " ".join(["w"] * size) if size or k % 2 else None, "en", source, size))
    rows += [(n, "same words here", "en", "hot", 3)] * 23 + [(None, "no id", "en", "b", 2)] * 7
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_mix(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("FAN", 3), ("RESERVE", 4), ("RUN", 5)):
        monkeypatch.setattr(X, name, value)
    rows, df = sourced(spark, 900)
    got = X.mix_documents(df.repartition(3)).collect()
    again = X.mix_documents(df.repartition(7, "text")).collect()
    key = lambda r: (r.doc_id, r.source, r["size"], r.copies, r.target)
    assert Counter(map(key, got)) == Counter(map(key, again))
    words = Counter()
    for i, t, _, s, _ in rows:
        words[i, s, len((t or "").split())] += 1
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == words
    sizes = Counter()
    for (_, s, n), times in words.items():
        sizes[s] += n * times
    want = poured(sizes)
    by = defaultdict(list)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 2
        by[r.source].append(r)
    for s, members in by.items():
        due = want[s] / sizes[s] if sizes[s] else 0
        assert all(r.copies in (int(due), int(due) + 1) for r in members)
        assert abs(sum(r.copies * r["size"] for r in members) - want[s]) <= max(r["size"] for r in members) / 2 + 1e-6
    times = {(r.doc_id, r.source): 0 for r in got}
    for r in got:
        times[r.doc_id, r.source] += r.copies
    out = X.mixed(df).groupBy("doc_id", "source").count().collect()
    assert {(r.doc_id, r.source): r["count"] for r in out} == {k: v for k, v in times.items() if v}


def test_exchange_keeps_sums_and_chances(spark):
    sizes, masses = [40, 17, 17, 9, 3, 1], [10.0, 12.5, 0.5, 8.0, 1.0, 0.25]
    items = spark.range(4000).select(
        F.col("id").alias("node"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).cast("long").alias("size"), F.lit(m).alias("mass")) for k, (s, m) in enumerate(zip(sizes, masses, strict=True))])).alias("x"),
    ).select("node", X._item({"size": F.col("x.size"), "h": F.xxhash64("node", "x.k"), "doc_id": F.col("x.k").cast("long"), "text_hash": F.lit(0).cast("long")}, F.col("x.mass")).alias("item"))
    rows = X._settled(items, ["node"], 5).toPandas()
    item = rows.item.apply(lambda r: r.asDict())
    rows["k"], rows["size"], rows["mass"] = (item.str[c] for c in ("doc_id", "size", "mass"))
    assert (rows.groupby("node").extra.apply(lambda x: x.isna().sum()) == 1).all()
    rows["words"] = np.where(rows.extra.isna(), rows["mass"], rows.extra.fillna(0) * rows["size"])
    assert np.allclose(rows.groupby("node").words.sum(), sum(masses))
    for k, group in rows.groupby("k"):
        p = masses[k] / sizes[k]
        assert abs(group.words.mean() / sizes[k] - p) < 5 * np.sqrt(p * (1 - p) / 4000)


def test_mix_of_odd_tables(docs, no_docs, pairs):
    assert X.mix_documents(no_docs).collect() == [] and X.mixed(no_docs).collect() == []
    got = X.mix_documents(docs).collect()
    assert len(got) == len(pairs) and X.mixed(docs).columns == docs.columns
    assert all(r.copies == 0 for r in got if r["size"] == 0 and r.target / r.source_size < 1)


def test_word_count(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a b c \x1c d", "x" * 50_000, "é é\ny"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", X.word_count(F.col("t")).alias("n"))
    assert {r.k: r.n for r in got.collect()} == {k: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for k, t in enumerate(texts)}


# --- 12


def one_edit(words):
    """Near words by trying every edit."""
    alphabet = sorted(set("".join(words)))
    out = {}
    for w in words:
        near = set()
        for i in range(len(w) + 1):
            near |= {w[:i] + a + w[i:] for a in alphabet} | {w[:i] + w[i + 1 :]} | ({w[:i] + a + w[i + 1 :] for a in alphabet} if i < len(w) else set())
        out[w] = (near & words) - {w}
    return out


def grouped(counts):
    near, form = one_edit(set(counts)), {}
    for w, x in near.items():
        best = min(x, key=lambda y: (-counts[y], y), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def slipped(pairs):
    counts = Counter()
    for i, t in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def cells(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spelling_of_texts(docs, no_docs, pairs):
    counts = slipped(pairs)
    assert len(counts) > 300
    got = W.group_variants(W.slipped_words(docs))
    assert cells(got) == grouped(counts) and got.count() == len(counts)
    assert W.group_variants(W.slipped_words(no_docs)).collect() == []
    assert in_spark(got.select("word", "form", "root", "n", "n_near", "form_n")) == in_sql(docs, OP12_SQL)


@pytest.mark.parametrize("hot", [4096, 2])
def test_all_near_words(spark, monkeypatch, hot):
    """Few letters, so that bigrams repeat and tie, and some beyond Latin-1."""
    monkeypatch.setattr(W, "HOT", hot)
    rng = random.Random(hot)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([4, 5, 6, 7]))) for _ in range(500)}
    words |= {"".join(rng.choice("語文𝒜a") for _ in range(rng.choice([4, 5]))) for _ in range(200)}
    got = W.near_words(spark.createDataFrame([(w,) for w in words], "word string"))
    assert Counter((r.word, r.near) for r in got.collect()) == Counter((w, x) for w, near in one_edit(words).items() for x in near)


def test_roots_follow_forms(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb"]
    counts = {w: 10 ** (6 - k) for k, w in enumerate(chain)} | {"zzzzzzz": 50, "zzzzzzx": 50, "zzzzzzzz": 4, "alonealone": 3}
    got = W.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    want = grouped(counts)
    assert cells(got) == want and {r[2] for r in want if r[0] in chain} == {chain[0]}
    assert ("zzzzzzzz", "zzzzzzz", "zzzzzzz", 4, 1, 50) in want


def test_pivots_are_the_best_pair():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 12, (300, 8))
    counts = np.zeros(W.CODES, np.int64)
    counts[:12] = rng.integers(1, 9, 12)
    order = np.argsort(np.argsort(counts, kind="stable"), kind="stable")
    prefix, a, b = W.pivots(codes, counts, order)
    for row, p, left, right in zip(codes, prefix, a, b, strict=True):
        third = sorted(order[row])[2]
        assert p.tolist() == (order[row] <= third).tolist() and p[left] and p[right] and right - left >= 2
        best = min(counts[row[i]] + counts[row[j]] for i, j in itertools.combinations(np.flatnonzero(p), 2) if j - i >= 2)
        assert counts[row[left]] + counts[row[right]] == best


# --- 13


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, low=False):
    out = ""
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[c]
        if v is not None and c == "text" and low:
            v = "".join(x.lower() if x.isascii() else x for x in v)
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def tree(digests):
    """(root, path of each leaf): a path is the (left, right) beside each node."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 8 * 8
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        at = [i // 8 for i in at]
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def proofs(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[r["lang"]].append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        langs[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in langs[name]])
    root, over = tree([trees[n][0] for n in names])
    out = Counter()
    for name, above in zip(names, over, strict=True):
        for r, path in zip(langs[name], trees[name][1], strict=True):
            bad = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0
            node = leaf(r, low=bad)
            for left, right in path + above:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + above))
            out[r["doc_id"], node, leaf(r), proof, root, trees[name][0], node == root] += 1
    return out


def checked(df):
    return in_spark(M.document_manifest(df, M.held_out(F.col("doc_id"), 3, 0)))


def test_manifest_of_texts(docs):
    rows = [r.asDict() for r in docs.collect()]
    got = checked(docs)
    assert got == proofs(rows) == in_sql(docs, OP13_SQL)


def test_manifest_over_storeys_and_languages(spark):
    rng = random.Random(2)
    langs = [None, "", "en", "é", "z"] + [f"l{k}" for k in range(9)]
    rows = [(k, f"Text {k}", "en" if k % 3 else rng.choice(langs), "S", k) for k in range(1400)]
    rows += [(None, "x", "en", None, None)] * 40 + [(7, "Text 7", "en", "S", 7)] * 600 + [(5000, None, "solo", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = proofs([dict(zip(df.columns, r, strict=True)) for r in rows])
    assert checked(df) == want == in_sql(df, OP13_SQL)
    assert {k[-1] for k in want} == {True, False}


def test_manifest_of_small_tables(spark, no_docs):
    assert checked(no_docs) == Counter()
    one = make(spark, [(3, "Alone")])
    assert checked(one) == proofs([r.asDict() for r in one.collect()])
