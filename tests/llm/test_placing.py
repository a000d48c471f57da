"""Sharding, mixing, packing, and the helpers they stand on."""

import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import mixing, order, packing, sharding


def _least_capacity(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > middle:
                used, at = used + 1, 0
            at += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_positions(odd):
    found = order.positions(odd.select("doc_id", F.lit(2).cast("long").alias("w")), [F.col("doc_id")], "w").collect()
    assert sorted(r["_row"] for r in found) == list(range(15))
    assert all(r["_end"] == 2 * (r["_row"] + 1) for r in found)
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["_row"])][-2:] == [None, None]


def test_shards_are_minimax_and_gapless(documents):
    for detail in (40, 8192):
        rows = sharding.shard(documents, 24, detail).collect()
        text = {r["doc_id"]: r["text"] for r in documents.collect()}
        groups = Counter()
        for r in rows:
            assert r["size"] == len(text[r["doc_id"]].encode()) + 8
            assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
            groups[text[r["doc_id"]]] += r["size"]
        import hashlib

        ordered = [groups[t] for t in sorted(groups, key=lambda t: hashlib.sha256(t.encode()).hexdigest())]
        per = Counter()
        for r in rows:
            per[r["shard"]] += r["size"]
        assert max(per.values()) == _least_capacity(ordered, 24)
        assert len({(t, r["shard"]) for r in rows for t in [text[r["doc_id"]]]}) == len(groups)
        for s in range(24):
            slots = sorted(r["slot"] for r in rows if r["shard"] == s)
            assert slots == list(range(len(slots)))


def test_shard_odd_rows(odd, nothing):
    rows = sharding.shard(odd, 4).collect()
    assert len(rows) == 15
    assert {r["shard"] for r in rows if r["size"] == 8} == {next(r["shard"] for r in rows if r["doc_id"] == 3)}
    assert all(r["text_crc32"] == 0 for r in rows if r["size"] == 8)
    assert sharding.shard(nothing).count() == 0


def test_mix_odd_rows(odd, nothing):
    rows = mixing.mix(odd).select("doc_id", "source", "_size", "_source_size", "_target", "_copies").collect()
    assert len(rows) == 15
    total = sum(r[2] for r in rows)
    goals = {r["source"]: (r[3], r[4]) for r in rows}
    assert abs(sum(t for _, t in goals.values()) - 1.5 * total) < 1e-6 * total
    assert all(t <= 2 * s + 1e-9 for s, t in goals.values())
    assert all(r[5] <= 2 for r in rows)
    again = mixing.mix(odd).select("doc_id", "_copies").collect()
    assert Counter(map(tuple, again)) == Counter((r["doc_id"], r["_copies"]) for r in rows)
    assert mixing.repeated(odd).columns == odd.columns
    assert mixing.mix(nothing).count() == mixing.repeated(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_place(sizes):
    sequence, offset = packing.place(np.array(sizes, np.int64), 64)
    filled = Counter()
    for s, q, o in zip(sizes, sequence.tolist(), offset.tolist()):
        assert o == filled[q]
        filled[q] += s
    assert not sizes or max(filled.values()) <= 64


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encoder_equals_tokenizers(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = test_encoder_equals_tokenizers.__dict__.setdefault("own", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    own.encode_special_tokens = True
    assert packing.encoder()(text) == own.encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizers_as_it_comes():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|", *(f"x{c * 1_000_000}y" for c in " \n\u3000"), " " * 999 + "z", "w" * 200_000]
    for text in texts:
        assert packing.encoder()(text) == own.encode(text, add_special_tokens=False).ids
    assert packing.encoder()("<|endoftext|>") == [50256]


def test_pack(odd, nothing):
    rows = packing.pack(odd, keep_ids=True).collect()
    text = {}
    for r in odd.collect():
        text.setdefault(r["doc_id"], []).append(r["text"] or "")
    pieces = {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        if r["doc_id"] == 8:
            pieces[r["piece"]] = r
    ids = [x for k in sorted(pieces) for x in pieces[k]["ids"]]
    assert ids == [*packing.encoder()(text[8][0]), 2]
    assert all(pieces[k]["length"] == 1024 for k in pieces if k) and len(pieces) > 1
    starts = np.cumsum([0] + [pieces[k]["length"] for k in sorted(pieces)])
    assert [pieces[k]["start"] for k in sorted(pieces)] == starts[:-1].tolist()
    assert sum(r["length"] == 1 for r in rows) == 3  # the end id alone
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for q in by.values():
        q.sort()
        assert [o for o, _ in q] == np.cumsum([0] + [n for _, n in q])[:-1].tolist() and sum(n for _, n in q) <= 1024
    assert packing.pack(nothing).count() == 0


def test_two_thousand_windows(spark):
    ends = np.cumsum(np.random.default_rng(4).integers(1, 90, 30_000))
    table = spark.createDataFrame([(int(e), i) for i, e in enumerate(ends)], "_end long, _row long").repartition(7)
    bounds = sorted(np.random.default_rng(5).choice(int(ends[-1]), 4_000, replace=False).tolist())
    windows = list(zip(bounds[::2], bounds[1::2]))
    for detail in (500, 8_192):
        each = max(1, detail // len(windows))
        want = []
        for low, high in windows:
            width = max(1, -(-(high - low) // each))
            slices = {}
            for i in range(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "right")):
                slices.setdefault((int(ends[i]) - low - 1) // width, []).append(i)
            want += [(int(ends[s[0]]), s[0] + 1, int(ends[s[-1]]), s[-1] + 1, len(s)) for s in slices.values()]
        assert sorted(sharding._ask(table, windows, detail)) == sorted(want)
