"""Packing of tokenized documents into sequences by the sum-of-squares rule.

Documents become ids, closed by an end id; one longer than a sequence is cut so that only its
first piece may be short. Full pieces are sequences of their own. The others are placed one
by one: with N(g) the number of open sequences that have g free places, each piece goes to the
open sequence after which the sum of N(g)^2 is least; a new one is opened where none has room.
Tasks pack about ``GROUP`` pieces each, longest first, so a task is bounded however large the
corpus is, and a group wastes at most the few sequences that are open at its end.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled

LENGTH = 1024
END = 2
GROUP = 50_000
LONG_SPACE = 1_000  # white space in a row that the rank encoder is not given
TOKENIZER = "byte_bpe_50k"

_LOADED: dict = {}


def encoder(name: str = TOKENIZER):
    """The ids that the JSON tokenizer of that name gives a text, without special tokens around it.

    The ranks file holds the same vocabulary and merges; the rank encoder gives the same ids about
    four times as fast, but knows no added tokens and overflows its stack on very long runs of
    white space. Texts with either go to the JSON tokenizer itself.
    """
    if name not in _LOADED:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        own = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain = own.encode_ordinary
        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        added = [re.escape(t.content) for t in whole.get_added_tokens_decoder().values()]
        apart = re.compile("|".join([*added, rf"\s{{{LONG_SPACE}}}"])).search
        _LOADED[name] = lambda text: whole.encode(text, add_special_tokens=False).ids if apart(text) else plain(text)
    return _LOADED[name]


def cuts(size: int, length: int) -> list[int]:
    """Where the pieces of a document of ``size`` ids begin."""
    first = size % length or length
    return [0, *range(first, size, length)] if size > length else [0]


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """A row for each piece: ``doc_id``, ``_row`` (names the document), ``piece``, ``start``,
    ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids_field = ", ids array<int>" if keep_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for begin in range(0, batch.num_rows, 256):
                of, number, start, size, crc, kept = [], [], [], [], [], []
                for k in range(begin, min(begin + 256, batch.num_rows)):
                    ids = np.array([*encode(texts[k].as_py() or ""), end], "<u4")
                    edges = [*cuts(len(ids), length), len(ids)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                        of.append(k), number.append(piece), start.append(a), size.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        if keep_ids:
                            kept.append(ids[a:b].astype(np.int32))
                at = pa.array(of, pa.int64())
                columns = [
                    batch.column("doc_id").take(at), batch.column("_row").take(at), pa.array(number, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, size, crc)),
                ]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                names = ["doc_id", "_row", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), "text")
    return rows.mapInArrow(
        cut, f"doc_id {kind}, _row long, piece int, start long, length long, ids_crc32 long{ids_field}"
    )


def place(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, in the order given, by the sum-of-squares rule.

    Putting a piece of size s into a sequence with gap g changes the sum of squares by
    2 (N(g - s) - N(g) + 1). A gap of 0 is closed and does not count. Of equal changes the
    smallest gap is taken.
    """
    n = np.zeros(length + 1, np.int64)  # open sequences by gap
    held: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    opened = 0
    for i, s in enumerate(sizes.tolist()):
        room = np.flatnonzero(n[s:])  # gaps, less s, of the sequences with room
        if len(room):
            change = 2 * (n[room] - n[room + s] + 1)
            if room[0] == 0:
                change[0] = 1 - 2 * n[s]  # closes one: only the loss counts
            gap = int(room[np.argmin(change)]) + s
        else:
            gap = length
        if gap == length:
            number, opened = opened, opened + 1
        else:
            number = held[gap].pop()
            n[gap] -= 1
        sequence[i], offset[i] = number, length - gap
        if gap > s:
            held[gap - s].append(number)
            n[gap - s] += 1
    return sequence, offset


def pack(
    docs: DataFrame, length: int = LENGTH, end: int = END, tokenizer: str = TOKENIZER, keep_ids: bool = False, group: int = GROUP
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset`` (gapless from 0).

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty and is one piece
    of the end id alone. A null ``doc_id`` is kept. Repeated rows are packed each. An empty table
    gives an empty result.
    """
    all_pieces = write_settled(pieces(docs, length, end, tokenizer, keep_ids), "pieces")
    full = all_pieces.where(F.col("length") == length).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    short = all_pieces.where(F.col("length") < length)
    groups = max(1, -(-short.count() // group))

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        batches = [b for b in frames if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        table = table.sort_by([("length", "descending"), ("_row", "ascending")])
        sequence, offset = place(np.asarray(table.column("length")), length)
        table = table.append_column("sequence_id", pa.array(sequence + (part << 32)))
        yield from table.append_column("offset", pa.array(offset)).to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in all_pieces.schema.fields)
    packed = short.repartition(groups, F.xxhash64("_row")).mapInArrow(fill, f"{schema}, sequence_id long, offset long")
    return full.union(packed).drop("_row")
