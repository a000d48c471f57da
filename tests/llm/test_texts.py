"""Near duplicates, repeats, fingerprints, search and the audit, against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import bwt, catalog, fingerprints, graph, minhash, repeats, search, warc
from tidemill.session import write_settled


def _set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def _components(rows, k, percent):
    sets = [_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


def _chain(spark):
    """Copies with more and more words changed, so that links form chains and stars miss some."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, documents, k, percent, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 16)
    for docs in (documents, _chain(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        found = minhash.near_duplicates(docs, k, percent).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(_components(rows, k, percent))
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_odd(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = minhash.near_duplicates(odd, 3, 85).collect()
    want = [(d, n, d if n == 0 else c) for d, n, c in _components(rows, 3, 85)]
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == Counter(want)
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.without_near_duplicates(odd).columns == odd.columns
    assert {r["doc_id"] for r in minhash.without_near_duplicates(odd).collect()} >= {1, 3, 4, 5, 6, 8, 9}


def test_one_row_of_each_group_stays(spark):
    text = lambda g, tail="": " ".join(f"g{g}w{i}" for i in range(60)) + tail
    rows = [(1, text(1), k) for k in range(5)]  # one document, repeated, other columns differing
    rows += [(2, text(2), 0)] * 4  # equal in everything
    rows += [(None, text(3), 0)] * 6 + [(None, text(3, " tail"), 0)] * 3  # copies and near copies without ids
    rows += [(None, text(4), 0), (9, text(4, " tail"), 0), (8, text(4), 0), (8, text(4, " end"), 0)]
    rows += [(None, None, 0), (None, "", 0), (5, " ", 0), (5, " ", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int").repartition(3)
    left = minhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    left = left.collect()
    assert Counter((r["text"] or "").split("w")[0] for r in left if (r["text"] or "").strip()) == {"g1": 1, "g2": 1, "g3": 1, "g4": 1}
    assert {r["doc_id"] for r in left if (r["text"] or "").startswith("g4")} == {8}
    assert sum(not (r["text"] or "").strip() for r in left) == 4


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, 3), (5, 5)]
    named = lambda x: f"{x:03d}".encode()
    found = graph.components(spark.createDataFrame([(bytearray(named(a)), bytearray(named(b))) for a, b in links], "a binary, b binary"))
    groups = defaultdict(set)
    for r in found.collect():
        groups[bytes(r["root"])].add(bytes(r["node"]))
    assert all(min(g) == k for k, g in groups.items())
    assert {named(x) for x in range(1, 8)} | {named(100)} in groups.values()


def test_bwt():
    rng = np.random.default_rng(1)
    for trial in range(60):
        strings = [rng.integers(1, 4, rng.integers(0, 40)).astype(np.uint16) for _ in range(rng.integers(1, 9))]
        if trial % 3 == 0:
            strings = [np.concatenate([s, strings[0]]) for s in strings]
        transform, lcp, places = bwt.build(strings)
        at = {int(places[i][o]): (i, o) for i, s in enumerate(strings) for o in range(len(s) + 1)}
        suffixes = sorted([*s[o:].tolist(), 0] for s in strings for o in range(len(s) + 1))
        for k, suffix in enumerate(suffixes):
            i, o = at[k]
            assert [*strings[i][o:].tolist(), 0] == suffix and transform[k] == (strings[i][o - 1] if o else 0)
            if k:
                j, p = at[k - 1]
                a, b = strings[i][o:], strings[j][p:]
                n = min(len(a), len(b))
                same = a[:n] == b[:n]
                assert lcp[k] == (n if same.all() else int(np.argmin(same)))


def _repeats(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    found = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        found.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


@pytest.mark.parametrize("length,core,collection", [(400, 200, 2000), (40, 20, 50), (60, 20, 3)])
def test_repeats(spark, documents, length, core, collection, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 20)
    rng = np.random.default_rng(5)
    tangle = [(10_000 + i, "".join(rng.choice(["abcdefghij" * 3, "klmnopqrs" * 4, "tuv" * 9], rng.integers(1, 12)))) for i in range(40)]
    docs = documents.select("doc_id", "text").limit(120).union(spark.createDataFrame(tangle, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.deduplicated(docs, length, core, collection)
    assert sorted(tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == sorted(_repeats(rows, length))


@pytest.mark.parametrize("shown,length", [(40, 60), (30, 100)])
def test_repeats_shown(spark, documents, shown, length, monkeypatch):
    """No shared string of the lesser length goes unseen, none of less than half of it is shown, and the rest is as without."""
    monkeypatch.setattr(repeats, "HOT", 20)
    rng = np.random.default_rng(6)
    tangle = [(10_000 + i, "".join(rng.choice(["abcdefghij" * 3, "klmnopqrs" * 4, "tuv" * 9], rng.integers(1, 12)))) for i in range(40)]
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").limit(60).collect()] + tangle
    rows += [(20_000 + i, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 2_000))) for i in range(20)]  # nothing shared
    rows += [(None, tangle[0][1]), (20_200, None), (20_201, ""), (20_100, "q" * shown), (20_101, "q" * shown), (20_102, "z" * (shown - 1))]
    found = repeats.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), length, length // 2, 50, shown=shown).collect()
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r[c] for c in columns) for r in found) == Counter(_repeats(rows, length))
    by = defaultdict(list)
    for r in found:
        by[(r["doc_id"], r["kept_sha256"])].append(r["n_shared"])
    at_least, at_most = _repeats(rows, shown), _repeats(rows, shown // 2)
    for (d, n, a, _, _), (_, _, b, _, _), (_, _, _, _, kept) in zip(at_least, at_most, _repeats(rows, length)):
        for n_shared in by[(d, kept)]:
            assert (n_shared > 0) >= (a > 0) and n_shared <= b


def test_marks_of_pieces():
    """A text looked at in pieces has each anchor once, as if looked at whole."""
    text = "".join(np.random.default_rng(8).choice(list("abcd"), 5_000))
    batch = pa.RecordBatch.from_pydict({"text": [text], "_h1": [1], "_h2": [2]})
    whole, cut = (pa.Table.from_batches(repeats._mark_rows(40, 20, piece)(iter([batch]))).to_pylist() for piece in (1 << 20, 97))
    assert whole == cut and len({r["at"] for r in cut}) == len(cut) > 200


def test_op4_shows_passages_of_fifty_words(spark, tmp_path):
    """A shared passage of 55 words below 400 bytes stays, as the contract says, but its documents show it."""
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 8))) for _ in range(4000)]
    prose = lambda n: " ".join(rng.choice(words, n))
    passages = [prose(55) for _ in range(6)]
    assert all(250 < len(p) < 390 for p in passages)
    rows = [(i, f"{prose(60)} {passages[i % 6]} {prose(80)}") for i in range(18)] + [(100 + i, prose(150)) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in catalog.QUERIES["op4_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert all(found[d]["n_removed"] == 0 and found[d]["n_bytes"] == len(t) for d, t in rows)
    assert all(120 <= found[i]["n_shared"] <= len(passages[i % 6]) + 20 for i in range(18))
    assert all(found[100 + i]["n_shared"] == 0 for i in range(30))


def test_repeats_odd(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = repeats.deduplicated(odd, piece=10_000).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, found)) == Counter(_repeats(rows, 400))
    assert repeats.deduplicated(nothing).count() == 0
    left = repeats.without_repeats(odd)
    assert left.columns == odd.columns and left.count() == 15
    assert left.where("text IS NULL").count() == 2


def test_fingerprints(documents, odd, nothing):
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.collect()), reverse=True)
    found = {r["doc_id"]: r for r in fingerprints.fingerprint(documents).collect()}
    errors = []
    for i, (d, t) in enumerate(rows):
        m, after = len(t) // 3, rows[(i + 1) % len(rows)][1]
        edited = t[: len(t) - m] + after[:m]
        assert found[d]["n_chars"] == len(t) and found[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = (Counter(zip(w, [*w[1:], None])) for w in (t.split(), edited.split()))
        errors.append(found[d]["near_edited"] - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.15
    rows = fingerprints.fingerprint(odd).collect()
    assert len(rows) == 15
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(r["fingerprint"])
    assert by[1] == by[2] and by[6] == by[7] and by[3] == {""} and by[4] == {""}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.fingerprint(nothing).count() == 0
    one = fingerprints.fingerprint(odd.where("doc_id = 1")).collect()
    assert one[0]["near_next"] == 1.0


def test_fingerprints_of_skewed_weights(spark):
    """One very frequent phrase, texts of few words, and equal texts: the mean error over many texts is small."""
    rng = np.random.default_rng(11)
    kinds = {"phrase": [], "few": [], "half": []}
    for k in range(60):
        words = [f"k{k}w{i}" for i in range(60)]
        kinds["phrase"].append((" ".join(words) + " buy now" * 300, " ".join(words) + " buy now" * 30))
        kinds["few"].append((" ".join(words[:4]), " ".join(words[:3])))
        kinds["half"].append((" ".join(words) + " buy" * 100, " ".join(rng.permutation(words[:30])) + " buy" * 50))
    rows = [(kind, k, a, b) for kind, pairs in kinds.items() for k, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "kind string, k int, a string, b string")
    df = fingerprints.with_samples(fingerprints.with_samples(df, "a", "_a"), "b", "_b")
    errors = defaultdict(list)
    for r in df.withColumn("near", fingerprints.likeness(F.col("_a"), F.col("_b"))).collect():
        assert len(r["_a"]) == len(r["_b"]) == fingerprints.SAMPLES
        a, b = (Counter(zip(w, [*w[1:], None])) for w in (r["a"].split(), r["b"].split()))
        errors[r["kind"]].append(r["near"] - sum((a & b).values()) / sum((a | b).values()))
    for kind, e in errors.items():  # sd of one estimate is at most 0.0625
        assert abs(np.mean(e)) < 0.04 and np.std(e) < 0.1, kind


def _bm25(rows, queries, k):
    words = [Counter((t or "").encode().lower().split()) for _, t in rows]
    n, size = len(rows), [sum(c.values()) for c in words]
    average = sum(size) / n
    spread = Counter(w for c in words for w in c)
    out = {}
    for q, text in queries:
        asked = Counter((text or "").encode().lower().split())
        scores = []
        for (d, _), c, s in zip(rows, words, size):
            score = sum(
                t * math.log1p((n - spread[w] + 0.5) / (spread[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * s / average))
                for w, t in asked.items() if w in c
            )
            if score > 0:
                scores.append((-round(score, 8), d if d is not None else -1))
        out[q] = sorted(scores)[:k]
    return out


def test_search(spark, documents, odd, nothing, monkeypatch):
    monkeypatch.setattr(search, "SHARD", 60_000)
    for docs, every in ((documents.select(F.col("doc_id").alias("id"), "text"), 20), (odd.select(F.col("doc_id").alias("id"), "text").where("id <> 7 AND id <> 11 OR id IS NULL"), 1)):
        rows = [tuple(r) for r in docs.collect()]
        queries = docs.where(f"id % {every} = 0")
        want = _bm25(rows, [tuple(r) for r in queries.collect()], 5)
        got = defaultdict(list)
        for r in sorted(search.search(docs, queries, 5, 3).collect(), key=lambda r: (r["query"], r["rank"])):
            got[r["query"]].append((-round(r["score"], 8), r["id"] if r["id"] is not None else -1))
        for q, best in want.items():
            assert [d for _, d in got[q]] == [d for _, d in best]
            assert np.allclose([s for s, _ in got[q]], [s for s, _ in best])
    empty = nothing.select(F.col("doc_id").alias("id"), "text")
    assert search.search(empty, empty).count() == 0


def test_search_with_queries_twice(spark, documents):
    docs = documents.select(F.col("doc_id").alias("id"), "text").where("id < 150")
    queries = docs.where("id % 20 = 0")
    once, twice = (sorted(map(tuple, search.search(docs.union(docs), q).collect())) for q in (queries, queries.union(queries)))
    assert once == twice


def test_search_asks_a_shard_in_batches(monkeypatch):
    """Two languages: exact by bounds, far blocks left out, memory in proportion to the postings."""
    import tracemalloc

    import pyarrow as pa

    from tidemill.llm import textbytes

    rng = np.random.default_rng(5)
    n = 6_000
    texts = [" ".join(f"{'ab'[i % 2]}{int(w)}" for w in 3_000 * rng.random(80) ** 4) for i in range(n)]
    texts[7], texts[11], texts[2_000] = texts[5], None, texts[5]
    data, starts = textbytes.buffer(pa.array(texts))
    of, terms, counts = search._counted(data, starts)
    row = search._shard(0, [np.arange(n)[::-1]], [terms], [of], [counts])
    cells = {c: np.asarray(row.column(c)[0].values) for c in row.schema.names if c != "shard"}
    tracemalloc.start()
    shard = search.Shard(cells, 80.0)
    asked = [i for i in range(0, 600) if i != 11]
    words = [np.sort(terms[of == i]) for i in asked]
    idf = np.log1p((n - shard.spread + 0.5) / (shard.spread + 0.5))
    weights = [idf[np.searchsorted(shard.terms, w)] for w in words]
    starts = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    rows = []
    monkeypatch.setattr(search.np, "partition", lambda x, *a, whole=np.partition, **k: rows.append(x.shape[0] * (x.shape[1] - 10)) or whole(x, *a, **k))
    found = {q: (ids, scores) for q, ids, scores in shard.top(starts, np.concatenate(words), np.concatenate(weights), 10)}
    monkeypatch.undo()
    assert tracemalloc.get_traced_memory()[1] < 100e6 + 60 * len(terms)
    tracemalloc.stop()
    assert sum(rows) < 0.7 * n * len(asked)
    for q, (w, x) in enumerate(zip(words, weights)):
        at = np.searchsorted(shard.terms, w)
        shard.weight[at], shard.asked[at] = x, True
        scores = shard._scores(np.arange(n))
        shard.weight[at], shard.asked[at] = 0, False
        best = np.lexsort((shard.ids, -scores))[:10]
        assert np.array_equal(found[q][0], shard.ids[best]) and np.array_equal(found[q][1], scores[best])


def _shard_of(rng, n, words):
    """A shard of random texts: its documents' terms and counts, and the row."""
    of = np.repeat(np.arange(n), words)
    pair = np.unique(of * 5_000 + (5_000 * rng.random(n * words) ** 3).astype(np.int64), return_counts=True)
    of, terms, counts = pair[0] // 5_000, pair[0] % 5_000 * 7, pair[1]
    return of, terms, counts, search._shard(0, [np.arange(n)], [terms.copy()], [of.copy()], [counts.copy()])


def test_search_index_is_narrow():
    """Building a shard and making it ready take few bytes for a posting; its rows are stretches of it."""
    import tracemalloc

    rng = np.random.default_rng(3)
    tracemalloc.start()
    of, terms, counts, row = _shard_of(rng, 8_000, 10)  # what is loaded at first use
    of, terms, counts = (np.tile(x, 25) for x in (of, terms, counts))
    of = np.sort(of)
    lists = [np.array_split(x, 50) for x in (terms, of.astype(np.int32), counts.astype(np.int32))]
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    row = search._shard(0, [np.arange(8_000)], *lists)
    assert tracemalloc.get_traced_memory()[1] - before < 45 * len(of)
    cells = {c: np.asarray(row.column(c)[0].values) for c in row.schema.names if c != "shard"}
    assert row.nbytes < 5 * len(of)
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    shard = search.Shard(cells, 80.0)
    assert tracemalloc.get_traced_memory()[1] - before - shard.heavy.nbytes < 36 * len(of)
    tracemalloc.stop()
    parts = list(search._parts(row))
    assert len(parts) == search.PARTS and max(p.nbytes for p in parts) < 2 * row.nbytes / search.PARTS
    for batches in (parts, [pa.Table.from_batches(parts).combine_chunks().to_batches()[0]]):
        (whole,) = search._whole(iter(batches))
        assert all(np.array_equal(whole[c], cells[c]) for c in cells)
    with pytest.raises(RuntimeError):
        list(search._whole(iter(parts[1:])))


def test_search_index_in_steps(monkeypatch):
    of, terms, counts, row = _shard_of(np.random.default_rng(4), 700, 40)
    cells = {c: np.asarray(row.column(c)[0].values) for c in row.schema.names if c != "shard"}
    place = np.empty(700, np.int64)
    place[cells["ids"]] = np.arange(700)  # ids are the numbers of the documents
    by_term = np.lexsort((place[of], terms))
    assert np.array_equal(cells["docs"], place[of][by_term]) and np.array_equal(cells["counts"], counts[by_term])
    assert np.array_equal(np.repeat(cells["terms"], np.diff(cells["starts"])), terms[by_term])
    assert np.array_equal(cells["sizes"], np.bincount(place[of], weights=counts))
    monkeypatch.setattr(search, "STEP", 37)
    shard, by_doc = search.Shard(cells, 30.0), np.lexsort((terms, place[of]))
    assert np.array_equal(shard.terms[shard.doc_terms], terms[by_doc]) and np.array_equal(shard.doc_counts, counts[by_doc])
    assert np.array_equal(np.diff(shard.doc_starts), np.bincount(place[of]))
    for heavy, at in zip(shard.heavy, np.argsort(-shard.spread, kind="stable")):
        own = slice(shard.starts[at], shard.starts[at + 1])
        dense = np.zeros(len(heavy), np.float32)
        dense[shard.docs[own]] = shard.part[own]
        assert np.array_equal(heavy, dense)
    # Documents and counts that do not fit 16 bits, nor both with the term one number.
    n = 1 << 17
    counts = np.arange(n) + (1 << 31) - 1 - n
    row = search._shard(0, [np.arange(n)], [np.arange(n) * 3], [np.arange(n)], [counts])
    (whole,) = search._whole(search._parts(row))
    assert np.array_equal(whole["docs"], np.argsort(whole["ids"])) and np.array_equal(whole["counts"], counts)
    assert np.array_equal(whole["terms"], np.arange(n) * 3) and np.array_equal(whole["starts"], np.arange(n + 1))


def test_search_rows_and_files(spark, documents, monkeypatch):
    """A shard comes in many rows, whatever their batches; results are in a few files, not one for each shard and block."""
    docs = documents.select(F.col("doc_id").alias("id"), "text").where("id < 200")
    queries = docs.where("id % 10 = 0")
    want = sorted(map(tuple, search.search(docs, queries).collect()))
    monkeypatch.setattr(search, "SHARD", 10_000)
    monkeypatch.setattr(search, "TERMS", 300)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, "5")
    try:
        rows, numbers = search.index(docs).agg(F.count(F.lit(1)), F.countDistinct("shard")).first()
        assert numbers > 15 and rows == search.PARTS * numbers
        found = search.search(docs, queries)
        assert sorted((q, r, i, round(s, 9)) for q, r, i, s in found.collect()) == [(q, r, i, round(s, 9)) for q, r, i, s in want]
        assert len(found.inputFiles()) < numbers
    finally:
        spark.conf.set(batch, old)


def test_audit(spark):
    pages = [(i, f"u{i}", "x" * (i % 50)) for i in range(300)] + [(None, None, None), (None, "u", None), (7, "u7", "x" * 7)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("ours", F.lit(1)).withColumn("node", F.lit(1))
    found = warc.audit(df, warc.damaged(97, 5, F.col("page_id"))).collect()
    assert sorted(r["page_id"] for r in found) == [5, 102, 199, 296]
    whole = df.select(F.sum(F.octet_length(warc.record(F.col("url"), F.col("html"))))).first()[0]
    assert all(0 <= r["start"] < r["end"] <= whole and r["ours"] != r["theirs"] for r in found)
    assert warc.audit(df, lambda x: x).count() == 0
    assert warc.audit(df.where("false"), lambda x: x).count() == 0


def test_audit_of_another_table(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "x" * (i % 50)) for i in range(300)], "page_id long, url string, html string")
    ours = warc.records(pages)
    rows = sorted((r["page_id"], r["record"]) for r in ours.collect())

    def want(theirs):
        places = []
        for side in (rows, theirs):
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            places.append([(d, x, e - len(x), e) for (d, x), e in zip(side, ends)])
        places = [p + [None] * (max(map(len, places)) - len(p)) for p in places]
        return sorted((a or b)[0] for a, b in zip(*places) if a is None or b is None or a[1:] != b[1:])

    def found(replica):
        return sorted(r["page_id"] for r in warc.audit(pages, replica).collect())

    lost = ours.where("page_id <> 290")
    cut = ours.withColumn("record", F.expr("IF(page_id = 280, substr(record, 1, 20), record)"))
    more = ours.union(ours.where("page_id = 297"))
    assert found(ours) == []
    for replica, least in ((lost, 10), (cut, 20), (more, 3), (ours.where("page_id <> 299"), 1), (ours.where("false"), 300)):
        theirs = sorted((r["page_id"], r["record"]) for r in replica.collect())
        assert found(replica) == want(theirs) and len(want(theirs)) == least
    gone = warc.audit(pages, lambda x: F.when(~x.contains("URI: u17\r"), x)).collect()
    assert [(r["page_id"], r["theirs"]) for r in gone] == [(17, None)]
    last = warc.audit(pages.where("false"), ours.where("page_id = 3")).collect()
    assert [(r["page_id"], r["ours"], r["their_start"]) for r in last] == [(3, None, 0)]


def test_audit_by_id_reports_only_what_is_damaged(spark):
    pages = [(i, f"u{i}", "x" * (i % 50)) for i in range(300)] + [(None, "n", "n"), (7, "again", "y"), (7, "again", "y")]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    clashing = pages.withColumns({c: F.lit(1) for c in ("record", "size", "sha", "node", "nth", "at", "ours", "_first", "_salt", "_one")})
    ours = warc.records(pages)
    cut = F.expr("IF(page_id = 280, substr(record, 1, 20), record)")
    noted = ours.withColumns({c: F.lit(2) for c in ("size", "sha", "node", "nth", "at", "theirs", "_id", "_n")})

    def found(replica, table=clashing):
        return sorted((-1 if r["page_id"] is None else r["page_id"], r["ours"] is None, r["theirs"] is None) for r in warc.audit(table, replica, "id").collect())

    assert found(noted) == []
    assert found(ours.where("page_id <> 3 OR page_id IS NULL")) == [(3, False, True)]
    assert found(ours.where("page_id IS NOT NULL")) == [(-1, False, True)]
    assert found(ours.withColumn("record", cut)) == [(280, False, False)]
    assert found(ours.union(ours.where("page_id = 9"))) == [(9, True, False)]
    assert found(ours.union(ours.where("page_id = 9").withColumn("page_id", F.lit(1000)))) == [(1000, True, False)]
    assert found(ours.where("page_id <> 7 OR page_id IS NULL").union(ours.where("page_id = 7").limit(2)))[0][0] == 7
    assert len(found(ours.where("false"))) == 303 and len(found(ours, clashing.where("false"))) == 303
    assert found(ours.where("false"), clashing.where("false")) == []
    row = warc.audit(pages, ours.where("page_id <> 3 OR page_id IS NULL").withColumn("record", cut), "id").where("page_id = 280").first()
    size = {r["page_id"]: len(r["record"]) for r in ours.where("page_id <> 7").collect()}
    assert row["end"] - row["start"] == size[280] and row["their_end"] - row["their_start"] == 20
    assert row["start"] - row["their_start"] == size[3]


def test_descent_reads_only_stretches_under_differing_nodes(spark):
    level = write_settled(spark.range(0, 100_000, 1, 20).select(F.col("id").alias("node")))
    parents = spark.createDataFrame([(10,), (11,), (6249,)], "node long")
    kept = level.where(warc._under(parents, level))
    nodes = sorted(r["node"] for r in kept.collect())
    wanted = {n for p in (10, 11, 6249) for n in range(p * 16, p * 16 + 16)}
    assert wanted <= set(nodes) and len(nodes) <= 2 * 3125
    assert "PushedFilters: [Or(" in kept._jdf.queryExecution().executedPlan().toString()
    assert level.where(warc._under(parents.where("false"), level)).count() == 0
