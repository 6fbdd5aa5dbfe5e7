"""Packing along a space-filling curve.

A document's token counts are hashed into a vector and projected to a few dimensions. The cell of
the projection has a Hilbert key; documents are range-sorted by it, and the stream of their ids along
the curve is cut every ``length`` ids. Neighbours in a sequence are therefore alike, and only the
last sequence has padding. Ids are stored once and shuffled once; ordering and running totals move
a few numbers for each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, query, table
from clickfeat.llm.tokens import WordEncoder, in_chunks, vocabulary_path
from clickfeat.operators.ordering import running_totals, store_in_order

LENGTH = 4096
END_ID = 2
DIMENSIONS = 4
#: Bits of a Hilbert cell's side, and entries of the hashed document vector.
CELL_BITS = 10
HASHED = 4096
#: Widens the projections of mean vectors to the range where cells differ.
SPREAD = 6.0


def projection(ids: int, dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    """A row of the projection for each token id: that of the id's place in the hashed vector."""
    places = (np.arange(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    rows = np.random.default_rng(seed).standard_normal((HASHED, dimensions))
    return rows[(places % np.uint64(HASHED)).astype(np.int64)]


def cells(ids: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cell of each document's mean projected vector; empty documents are at the origin."""
    totals = np.zeros((len(lengths) + 1, rows.shape[1]))
    ends = np.cumsum(lengths)
    for d in range(rows.shape[1]):
        sums = np.concatenate([[0.0], np.cumsum(rows[:, d][ids])])
        totals[:-1, d] = sums[ends] - sums[ends - lengths]
    means = totals[:-1] / np.maximum(lengths, 1)[:, None]
    # Rounded, so that the order of a batch's additions can't move a document to another cell.
    side = np.round(1 / (1 + np.exp(-SPREAD * means)), 9)
    return np.minimum((side * (1 << CELL_BITS)).astype(np.int64), (1 << CELL_BITS) - 1)


def hilbert_key(cell: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """Place on the Hilbert curve of cells, one row each: by reflections and exchanges of axes."""
    x = cell.T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            flip = (x[i] & high) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _encoder(path: str, end_id: int):
    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(path)
        rows = projection(len(encoder.ends))
        for batch in batches:
            texts = batch["_text"].tolist()
            for start, stop in in_chunks(texts):
                ids, lengths = encoder.encode(texts[start:stop])
                keys = hilbert_key(cells(ids, lengths, rows))
                stops = np.cumsum(lengths)
                end = np.array([end_id], "<u4")
                own = [
                    np.concatenate([ids[b - n : b].astype("<u4"), end]) for b, n in zip(stops, lengths)
                ]
                small = len(encoder.ends) <= 1 << 16 and end_id < 1 << 16
                yield pd.DataFrame(
                    {
                        "_id": batch["_id"].iloc[start:stop].to_numpy(),
                        "_key": keys,
                        "_n": lengths + 1,
                        "_ids": [a.astype("<u2").tobytes() if small else a.tobytes() for a in own],
                    }
                )

    return encoded


def _cutter(length: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc, end, n, raw in zip(
                batch["_id"].array, batch["_end"], batch["_n"], batch["_ids"]
            ):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                first = end - n
                at = 0
                while at < n:
                    sequence, offset = divmod(first + at, length)
                    size = min(n - at, length - offset)
                    piece = ids[at : at + size]
                    found.append(
                        (doc, at, size, crc32(piece.tobytes()), n, sequence, offset)
                        + ((piece.astype(np.int32),) if with_ids else ())
                    )
                    at += size
            yield pd.DataFrame(found, columns=_NAMES + (["ids"] if with_ids else []))

    return cut


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: document, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds the piece's token ids. Null text counts as empty and gives just the end id. Every
    input row is packed, also with a null or repeated id (rows are told apart by where they are
    stored); ties on the curve go by id. Other columns are not read. An empty table gives no pieces.
    ``length`` is a power of two, and all sequences but the last are full.
    """
    path = vocabulary or vocabulary_path()
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    tokens = keep(
        texts.mapInPandas(
            _encoder(path, end_id), f"_id {id_type}, _key bigint, _n bigint, _ids binary"
        ).withColumn("_row", F.monotonically_increasing_id()),
        "tokens",
    )
    order = ["_key", "_id", "_row"]
    along = store_in_order(tokens.select(*order, "_n"), order, "curve")
    ends = running_totals(along, order, {"_end": F.col("_n")}).select("_row", "_end")
    kinds = f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in _NAMES[1:])
    return tokens.join(ends, "_row").mapInPandas(
        _cutter(length, with_ids), kinds + (", ids array<int>" if with_ids else "")
    )


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
