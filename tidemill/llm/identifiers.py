"""Personal data: plain patterns of four kinds, and identifiers that context gives away.

Matches of the plain patterns are the seeds. What looks alike without being one of them (a
number of seven digits or more, an address with another sign for @ or without a dot) is an
open candidate. Each occurrence has lexical patterns, the words around it: the last one, the
last two, and the last with the next. Patterns and identifiers (digits, or the address in
lower case) make a graph, scored in rounds as Spark aggregations:

* a pattern's confidence in a kind is the sum of its identifiers' scores for the kind, divided
  by the number of its distinct identifiers and one; it counts from ``CONFIDENCE`` up and with
  ``SUPPORT`` distinct seeds at least;
* an open candidate's score is the noisy or of its confident patterns, 1 - product(1 - confidence),
  where its form allows the kind; one that is a seed elsewhere has score 1.

After ``ROUNDS`` rounds candidates of a score of ``CONFIDENCE`` or more are added as spans of
their best kind, in all places. Copies add no evidence, as identifiers count once a pattern.

Matching is linear in the text's length, also for endless runs of digits or letters. A null
text is an empty one. Rows are handled each for itself, so nulls and repeats of ``doc_id`` do
no harm; equal texts have equal spans. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
CONFIDENCE = 0.8
SUPPORT = 5
ROUNDS = 3
SALT = 16

# The characters and forms of the four kinds.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_FOUR = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Open candidates.
_SIGN = re.compile(r"@|[(\[{] ?at ?[)\]}]", re.I)
_HOST = re.compile(r" ?[A-Za-z0-9-]++(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?)[A-Za-z0-9-]++)*+", re.I)
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-/:]{0,2}[0-9])*+")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_REACH = 64  # characters of context looked at on either side

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[Span]:
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield EMAIL, start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            for found in _FOUR.finditer(run.group()):
                parts = [p.lstrip("0") for p in found.group().split(".")]
                if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                    yield IP, run.start() + found.start(), run.start() + found.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 13 and 13 <= len(digits := _digits(found.group())) <= 19 and _luhn(digits):
            yield CARD, *found.span()


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_digits(found.group())) <= 15:
            yield PHONE, *found.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the four kinds by kind, then start, in code points, the end not included."""
    found = list(_emails(text)) if "@" in text else []
    return [*found, *_ips(text), *_cards(text), *_phones(text)]


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    low = 0
    for sign in _SIGN.finditer(text):
        end = sign.start() - (text[sign.start() - 1 : sign.start()] == " " and sign.group() != "@")
        start = low + len(text[low:end].rstrip(_LOCAL)) if end > low else end
        host = _HOST.match(text, sign.end()) if start < end else None
        low = host.end() if host else sign.end()
        if host:
            yield start, low


def _numbers(text: str) -> Iterator[tuple[int, int, int]]:
    """Start, end and the kinds, as bits, that the number's form allows."""
    for found in _NUMBER.finditer(text):
        start, end = found.span()
        if end - start < 7 or (start and text[start - 1].isalnum()) or text[end : end + 1].isalnum():
            continue
        n = len(_digits(found.group()))
        allowed = (1 << PHONE) * (7 <= n <= 15) + (1 << CARD) * (12 <= n <= 19)
        if allowed:
            yield start, end, allowed


def patterns_of(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: words in lower case, digits alike, ``^`` and ``$`` for the text's ends."""
    left = _TOKEN.findall(text[max(0, start - _REACH) : start])[-2:]
    right = _TOKEN.findall(text[end : end + _REACH])[:1]
    left, right = ([re.sub("[0-9]", "0", t.lower()) for t in side] for side in (left, right))
    if start <= _REACH and len(left) < 2:
        left = ["^", *left]
    after = right[0] if right else "$"
    before = left[-1] if left else ""
    return [f"{before} _", f"{' '.join(left)} _ ", f"{before} _ {after}"]


def _name(text: str, kind: int | None) -> int:
    """64 bits that name an identifier: digits, or an address in lower case without the writing of its signs."""
    if kind == EMAIL:
        plain = re.sub(r" ?[(\[{] ?dot ?[)\]}] ?", ".", re.sub(r" ?[(\[{] ?at ?[)\]}] ?", "@", text.lower()))
    else:
        plain = _digits(text)
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def places(text: str) -> tuple[list[Span], list[dict]]:
    """Plain spans, and all places with their patterns: seeds with a kind, candidates with the kinds allowed."""
    base = base_spans(text)
    if not base and not any("0" <= c <= "9" for c in text) and not _SIGN.search(text):
        return base, []
    # One row for each place: what is taken goes by start, and candidates never overlap it.
    taken = sorted((s, e) for _, s, e in base)
    found = [
        {"kind": k, "start": s, "end": e, "allowed": 0, "name": _name(text[s:e], k), "patterns": patterns_of(text, s, e), "address": k == EMAIL}
        for k, s, e in base
    ]
    addresses = _free(((s, e, 1 << EMAIL) for s, e in _addresses(text)), taken)
    numbers = _free(_numbers(text), sorted([*taken, *((s, e) for s, e, _ in addresses)]))
    for group, address in ((addresses, True), (numbers, False)):
        for s, e, allowed in group:
            found.append(
                {"kind": None, "start": s, "end": e, "allowed": allowed, "name": _name(text[s:e], EMAIL if address else None), "patterns": patterns_of(text, s, e), "address": address}
            )
    return base, found


def _free(candidates: Iterator[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Candidates, by start, that overlap nothing that is taken; what is taken may overlap itself."""
    out, i, reach = [], 0, -1
    for s, e, allowed in candidates:
        while i < len(taken) and taken[i][0] < e:
            reach, i = max(reach, taken[i][1]), i + 1
        if reach <= s:
            out.append((s, e, allowed))
    return out


_ALLOWS = "(allowed & shiftleft(1, kind)) > 0"
_SPAN = "struct<kind:int,start:int,end:int>"
_PLACE = "struct<kind:int,start:int,end:int,allowed:int,name:bigint,patterns:array<string>,address:boolean>"


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document: ``row``, ``doc_id``, ``base`` spans and ``places``. Whole texts are read once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        spans = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")]))
        place = pa.list_(
            pa.struct([*((n, pa.int32()) for n in ("kind", "start", "end", "allowed")), ("name", pa.int64()), ("patterns", pa.list_(pa.string())), ("address", pa.bool_())])
        )
        for batch in batches:
            base, found = [], []
            for text in batch.column("text"):
                own, there = places(text.as_py() or "")
                base.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                found.append(there)
            rows = pa.array(range(row, row + len(base)), pa.int64())
            row += len(base)
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id"), pa.array(base, spans), pa.array(found, place)], names=["row", "doc_id", "base", "places"])

    return docs.select("doc_id", "text").mapInArrow(look, f"row long, doc_id {kind}, base array<{_SPAN}>, places array<{_PLACE}>")


def _salted(many: DataFrame, few: DataFrame, key: str, spread: str) -> DataFrame:
    """Join on a key that may hold a large part of ``many``: its rows are dealt by another column too."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    return many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int")).join(few.withColumn("_salt", salts), [key, "_salt"]).drop("_salt")


def learn(scanned: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Confident ``pattern``, ``address``, ``kind``, ``confidence``; and ``name``, ``address``, ``kind``, ``score`` of candidates, over :func:`scan` (settled)."""
    edges = scanned.select(F.explode("places").alias("p")).select("p.kind", "p.name", "p.allowed", "p.address", F.explode("p.patterns").alias("text"))
    edges = edges.withColumn("pattern", F.struct("address", "text")).drop("text", "address")
    seeds = write_settled(edges.where("kind IS NOT NULL").select("pattern", "name", "kind").distinct(), "seeds")
    open_ = write_settled(edges.where("kind IS NULL").select("pattern", "name", "allowed").distinct(), "open")
    # A pattern without open candidates has nothing to find.
    reach = open_.groupBy("pattern").agg(F.count_distinct("name").alias("n_open"))
    hits = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("hits"))
    all_hits = hits.groupBy("pattern").agg(F.sum("hits").alias("n_seeds"))
    able = write_settled(
        hits.where(F.col("hits") >= SUPPORT).join(reach, "pattern").join(all_hits, "pattern")
        .select("pattern", "kind", "hits", (F.col("n_open") + F.col("n_seeds") + 1).alias("n")),
        "able",
    )
    known = seeds.select("name", "pattern.address", "kind").distinct()
    same = write_settled(
        open_.select("name", "pattern.address", "allowed").distinct().join(known, ["name", "address"]).where(_ALLOWS)
        .select("name", "address", "kind", F.lit(1.0).alias("score")).distinct(),
        "same",
    )
    scores, sure = same, None
    for _ in range(rounds):
        new = _salted(open_.withColumn("address", F.col("pattern.address")), scores.withColumnRenamed("address", "_a"), "name", "pattern")
        new = new.where("address = _a").where(_ALLOWS).groupBy("pattern", "kind").agg(F.sum("score").alias("new"))
        confident = (
            able.join(new, ["pattern", "kind"], "left")
            .withColumn("confidence", (F.col("hits") + F.coalesce("new", F.lit(0.0))) / F.col("n"))
            .where(F.col("confidence") >= CONFIDENCE)
            .select("pattern", "kind", "confidence")
        )
        old, sure = sure, write_settled(confident, "patterns")
        reached = _salted(open_, sure, "pattern", "name").where(_ALLOWS)
        either = reached.groupBy("name", F.col("pattern.address").alias("address"), "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
        before = scores
        scores = write_settled(same.unionByName(either).groupBy("name", "address", "kind").agg(F.max("score").alias("score")), "scores")
        drop_settled(*(t for t in (old, before) if t is not None and t is not same))
    drop_settled(seeds, open_, able, same)
    return sure.select("pattern.*", "kind", "confidence").withColumnRenamed("text", "pattern"), scores


def extract(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` spans (kind, start, end; in order) of each row of ``docs`` (``doc_id``, ``text``)."""
    scanned = write_settled(scan(docs), "places")
    _, scores = learn(scanned, rounds)
    rank = F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")
    best = scores.where(F.col("score") >= CONFIDENCE).groupBy("name", "address").agg(rank)
    open_ = scanned.select("row", F.explode(F.filter("places", lambda p: p["kind"].isNull())).alias("p")).select("row", "p.name", "p.address", "p.start", "p.end", "p.allowed")
    held = _salted(open_, best.withColumnRenamed("address", "_a"), "name", "row").where("address = _a").where(_ALLOWS)
    added = held.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    settled = write_settled(added, "added")
    drop_settled(scores)
    none = F.expr(f"CAST(array() AS array<{_SPAN}>)")
    some = F.exists("places", lambda p: p["kind"].isNull())
    # Only documents with a candidate meet the table of added spans.
    plain = scanned.where(~some).select("doc_id", "base", none.alias("added"))
    other = scanned.where(some).join(settled, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))
    return plain.unionByName(other)


def joined(spans: str) -> F.Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Numbers of plain spans by kind, their digest, and all spans as text; ``n_added`` of them come from context."""
    found = extract(docs).withColumn("every", F.array_sort(F.concat("base", "added")))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS bigint) AS n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("every").alias("spans"), F.size("added").cast("long").alias("n_added"))
