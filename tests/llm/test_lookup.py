"""Identifiers in context, vector codes and ranked search, against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import catalog, gnat, identifiers, maxscore, vectorcodes

# The four kinds as the contract writes them.
FORMS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def _plain(text):
    return [(k, *m.span()) for k, form in enumerate(FORMS) for m in form.finditer(text) if _valid(k, m.group())]


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("012459.+-@() ab_%é\n"), max_size=60))
def test_plain_spans(text):
    assert identifiers.base_spans(text) == _plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4539 1488 0343 6467", "4111111111111111", "1.2.3.4", "999.1.1.1.7", "a.b@c.d", "x@y", "+1 (838) 555-9577", "+12", " ", ".", "-", "@", "7"]), max_size=12))
def test_plain_spans_of_pieces(parts):
    text = "".join(parts)
    assert identifiers.base_spans(text) == _plain(text)


def test_endless_runs():
    for text in ("1" * 500_000, "a" * 500_000 + "@", "1." * 200_000, "+1" + " " * 500_000, "@" * 200_000, "a@b" * 100_000, "1 " * 200_000):
        identifiers.places(text)


def _letters(spark):
    """Phone numbers after "call me on", numbers written without a plus among them, and the same numbers elsewhere."""
    rows = [f"please call me on +1 555 01{i:02d} 77{i:02d} today or else" for i in range(12)]
    rows += ["please call me on 555-9911-22 today or else", "item 555-9911-22 again, item 555-4411-33 not"]
    rows += [f"the order 88123{i:03d}456 was sent" for i in range(9)]
    rows += [f"write to user{i}@mail{i}.example.com soon" for i in range(9)] + ["write to someone (at) mail (dot) org soon", "look (at) this"]
    return spark.createDataFrame([*enumerate(rows), (None, None), (None, ""), (7, rows[0])], "doc_id long, text string")


def _brute(texts):
    """The scored graph in plain Python."""
    every = [identifiers.places(t or "") for t in texts]
    flat = [(i, p) for i, (_, found) in enumerate(every) for p in found]
    seeds, open_ = defaultdict(set), defaultdict(set)
    allowed = {}
    for _, p in flat:
        for x in p["patterns"]:
            pattern = (p["address"], x)
            if p["kind"] is None:
                open_[pattern].add(p["name"])
                allowed[p["name"], p["address"]] = p["allowed"]
            else:
                seeds[pattern].add((p["name"], p["kind"]))
    known = {(n, pattern[0], k) for pattern, s in seeds.items() for n, k in s}
    same = {(n, a, k): 1.0 for n, a, k in known if allowed.get((n, a), 0) >> k & 1}
    scores = same
    for _ in range(identifiers.ROUNDS):
        sure = {}
        for pattern, s in seeds.items():
            for k, hits in Counter(k for _, k in s).items():
                if hits >= identifiers.SUPPORT and open_[pattern]:
                    new = sum(scores.get((n, pattern[0], k), 0) for n in open_[pattern])
                    c = (hits + new) / (len(open_[pattern]) + len(s) + 1)
                    if c >= identifiers.CONFIDENCE:
                        sure[pattern, k] = c
        missing = defaultdict(lambda: 1.0)
        for (pattern, k), c in sure.items():
            for n in open_[pattern]:
                if allowed[n, pattern[0]] >> k & 1:
                    missing[n, pattern[0], k] *= 1 - c
        scores = {x: max(same.get(x, 0), 1 - missing[x] if x in missing else 0) for x in {*same, *missing}}
    best = {}
    for (n, a, k), s in sorted(scores.items(), key=lambda x: (x[1], -x[0][2])):
        if s >= identifiers.CONFIDENCE:
            best[n, a] = k
    return [
        (sorted(base), sorted((best[p["name"], p["address"]], p["start"], p["end"]) for p in found if p["kind"] is None and p["allowed"] >> best.get((p["name"], p["address"]), 9) & 1))
        for base, found in every
    ]


def _joined(spans):
    return ",".join(f"{identifiers.KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def test_context_finds_more(spark, documents, odd, nothing):
    letters = _letters(spark)
    for docs in (letters, documents, odd):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = Counter(
            (d, *(sum(s[0] == k for s in base) for k in range(4)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined([*base, *added]), len(added))
            for (d, _), (base, added) in zip(rows, _brute([t for _, t in rows]))
        )
        assert Counter(map(tuple, identifiers.report(docs).collect())) == want
    added = {r["doc_id"]: r["spans"] for r in identifiers.report(letters).where("n_added > 0").collect()}
    assert added == {12: "phone:18:29", 13: "phone:5:16", 32: "email:9:36"}
    assert identifiers.report(nothing).count() == 0


def test_learnt_patterns(spark):
    found = identifiers.learn(identifiers.write_settled(identifiers.scan(_letters(spark))))[0]
    assert {(r["pattern"], r["kind"]) for r in found.collect()} >= {("on _", 3), ("to _", 0)}


@pytest.mark.parametrize("spread,n", [(3, 256), (40, 256), (2000, 300), (1 << 24, 64), (1, 40)])
def test_tree_equals_scan(spread, n):
    rng = np.random.default_rng(n + spread)
    points = rng.integers(-spread, spread, (n, 6)) + rng.integers(-5, 5, (n, 1)) * 4 * spread
    queries = np.concatenate((points[:50], rng.integers(-20 * spread, 20 * spread, (400, 6))))
    tree = gnat.Gnat(points, degree=6, leaf=3)
    apart = ((queries[:, None].astype(object) - points[None].astype(object)) ** 2).sum(2)
    index, best = tree.nearest(queries)
    assert index.tolist() == [min(range(n), key=lambda j: (row[j], j)) for row in apart]
    assert best.tolist() == apart.min(1).tolist()
    assert spread == 1 or tree.asked < 0.7 * apart.size


def _codes(rows, parts, entries, rounds):
    """Whole-number codebooks in plain Python."""
    whole = [(i, label, [int(np.floor(1024 * x)) for x in v]) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(whole[0][2])
    cuts = [width * p // parts for p in range(parts + 1)]
    fit = [r for r in whole if len(r[2]) == width]
    books = [[r[2][cuts[p] : cuts[p + 1]] for r in fit[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[cuts[p] : cuts[p + 1]], e)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, _, v in fit:
            for p in range(parts):
                groups[p, nearest(p, v)[1]].append(v[cuts[p] : cuts[p + 1]])
        for (p, j), vs in groups.items():
            books[p][j] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for i, label, v in whole:
        found = [nearest(p, v) for p in range(parts)] if len(v) == width else None
        out.append((i, label, found and "".join(f"{j:02x}" for _, j in found), found and sum(d for d, _ in found)))
    by_label = defaultdict(int)
    for _, label, _, e in out:
        by_label[label] += e or 0
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, e, by_label[label], sha) for i, label, code, e in out)


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 1, 10).round(3).tolist(), int(i) % 3 or None) for i in rng.permutation(60)]
    rows += [(3, rows[0][1], 1), (None, rows[1][1], None), (None, rows[1][1], 7), (70, None, 1), (71, [1.0] * 9 + [None], 1)]
    rows += [(72, [float("nan")] * 10, 1), (73, [float("inf")] * 10, 2), (74, [1.0, 2.0], 1), (75, [], 2), (None, None, None)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, _v int").repartition(5)
    found = vectorcodes.compress(table, parts=3, entries=7, rounds=3)
    assert Counter(map(tuple, found.collect())) == _codes(rows, 3, 7, 3)
    assert vectorcodes.compress(table.where("false")).count() == 0
    huge = spark.createDataFrame([(1, [0.5] * 4, 0), (2, [3e38] * 4, 0)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r)[:4] for r in vectorcodes.compress(huge).orderBy("vec_id").collect()] == [(1, "00000000", 0, 0), (2, None, None, 0)]


def test_label_sums(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "HOT", 4)
    rows = spark.range(200).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 40).alias("label"), F.col("id").alias("error"))
    rows = vectorcodes.write_settled(rows)
    want = rows.groupBy("label").agg(F.sum("error")).collect()
    found = vectorcodes.with_group_sum(rows, "label", "error", "s")
    assert found.count() == 200 and {tuple(r) for r in found.select("label", "s").collect()} == {tuple(r) for r in want}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _ranked(docs, items, k=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = [(d, Counter(TERM.findall((t or "").translate(lower)))) for d, t in docs]
    held = [(d, c, c.total()) for d, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in held:
            m = 100 - 75 + 75 * size * n // total
            s = sum(
                q * int(np.floor(1000 * np.log((2 * n + 2) / (2 * df[t] + 1)))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t, q in Counter(TERM.findall((text or "").translate(lower))).items()
                if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return Counter(out)


def _search(docs, items, k=10):
    named = lambda t, c: t.select(F.col(c).alias("id"), "text")
    return Counter(map(tuple, maxscore.search(named(docs, "doc_id"), named(items, "item_id"), k).collect()))


@pytest.mark.parametrize("k", [1, 10])
def test_search(spark, documents, k, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 40_000)
    monkeypatch.setattr(maxscore, "TERMS", 150)
    items = documents.where("doc_id % 20 = 3").select(F.col("doc_id").alias("item_id"), "text")
    items = items.union(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(20).select("item_id", "text"))
    docs = documents.union(documents.limit(30))
    rows = [[tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), items)]
    assert _search(docs, items, k) == _ranked(*rows, k)


def test_search_odd(spark, odd, nothing):
    queries = [(1, "one TWO three"), (2, None), (3, " .,;"), (None, "word tail"), (4, "word"), (4, "word"), (5, "ñandú DÉJÀ 漢字"), (6, "lorem " * 2000)]
    items = spark.createDataFrame(queries, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _search(odd, items) == _ranked(rows, queries)
    assert not _search(nothing, items) and not _search(odd, items.where("false"))


def test_pruning_opens_fewer_blocks():
    """Rare terms settle the best; of a frequent term's blocks few are decompressed."""
    rng = np.random.default_rng(1)
    n = 20_000
    sizes = rng.integers(20, 400, n)
    of = np.concatenate((np.repeat(np.arange(n), rng.integers(0, 4, n)), np.arange(0, n, 997), np.repeat(np.arange(n), 2)))
    terms = np.concatenate((np.full(len(of) - 2 * n - len(range(0, n, 997)), 5), np.full(len(range(0, n, 997)), 7), np.tile([11, 12], n)))
    import pyarrow as pa

    total = int(np.bincount(of, minlength=n).sum())
    batch = maxscore._shard([pa.array(np.arange(n))], [terms], [of], n, total)
    shard = maxscore.Shard({c: batch.column(c)[0].as_py() for c in maxscore._FIELDS}, batch.column("ids")[0].values, n, total)
    heap = maxscore.Heap(10)
    shard.top(np.array([5, 7, 11]), np.array([900, 9000, 1]), heap)
    assert shard.opened < shard.passed / 4 and len(heap.ids) == 10 and sizes is not None
    whole = np.zeros(n, np.int64)
    for t, w in ((5, 900), (7, 9000), (11, 1)):
        count = np.bincount(of[terms == t], minlength=n)
        whole += w * maxscore._impact(count, maxscore._lengths(np.bincount(of, minlength=n), n, total))
    assert heap.scores.tolist() == sorted(whole.tolist())[::-1][:10]


@pytest.mark.parametrize("name", ["op2_mixing", "op3_merkle_audit", "op12_vector_codes", "op13_ranked_search"])
def test_queries_equal_sql(spark, name):
    from oracle_check import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, catalog.QUERIES[name], catalog.ORACLES[name]) is None


def test_identifier_query(spark):
    found = catalog.QUERIES["op11_identifiers"](spark, "/root/testdata/sf0.001")
    rows = {r["doc_id"]: r for r in found.collect()}
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        plain = _plain(text or "")
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(_joined(plain).encode()).hexdigest()
        assert [rows[doc_id][f"n_{k}"] for k in identifiers.KINDS] == [sum(s[0] == i for s in plain) for i in range(4)]
