"""Token ids in packed rows: best-fit-decreasing with a segment tree over free capacities.

Documents are turned into ids and end with a separator. Longer ones than a row are split into pieces without loss. A task takes pieces in blocks of
bounded size, longest first, and puts each into the fullest open row that still has room: a segment tree over the possible free capacities finds the least
one that suffices. Rows come out as an id matrix (little-endian 16 or 32 bits, padded), cumulative segment lengths, and positions that begin anew
at every segment. Blocks are packed independently, so no task or driver sees more than a block and a lost task is simply repeated.

Null and empty texts are a separator alone, so every row of docs is in the result. Repeated rows are packed repeatedly. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import portions

LENGTH = 2048
BLOCK_TOKENS = 4_000_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public byte-level tokenizers cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict = {}


def encoder(path: str):
    """The byte-level tokenizer of a rank file; its separator is the first free id."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1
    return _encoders[path]


def encode(text: str, path: str = TOKENIZER) -> np.ndarray:
    """Ids of a text and the separator."""
    tokenizer, end = encoder(path)
    ids = np.frombuffer(tokenizer.encode_to_numpy(text, disallowed_special=()), np.uint32) if text else np.zeros(0, np.uint32)
    return np.append(ids, np.uint32(end))


class Capacities:
    """Segment tree: how many open rows have each free capacity; finds the least capacity that suffices."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of a row with the least capacity of at least need, removed from the tree; None if there is none."""
        node = need + self.size
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.tree[node] += by
            node >>= 1


def pack(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers: best fit, longest pieces first; every size is at most length."""
    free, rows = Capacities(length), []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = free.take(sizes[piece])
        if found is None:
            rows.append([piece])
            left, row = length - sizes[piece], len(rows) - 1
        else:
            left, row = found[0] - sizes[piece], found[1]
            rows[row].append(piece)
        if left:
            free.add(left, row)
    return rows


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(pack_id, doc_ids, pieces, n_tokens, cu_seqlens, input_ids, position_ids): one row per packed row.

    pieces[i] is the number of the piece of doc_ids[i], from 0; segment i has the ids cu_seqlens[i] to cu_seqlens[i + 1]. input_ids and position_ids are
    little-endian numbers, `length` of them: 16 bits where the vocabulary allows, else 32. Free places hold the separator and position 0.
    """
    kind = docs.schema[id].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = encoder(tokenizer)[1]
        width = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
        places = np.arange(length, dtype=width)
        state = {"rows": 0}

        def flush(pieces: list) -> pa.RecordBatch:
            packed = pack([len(p[2]) for p in pieces], length)
            ids, parts, counts, ends, inputs, positions = [], [], [], [], [], []
            for row in packed:
                matrix, position, edges = np.full(length, end, width), np.zeros(length, width), [0]
                for i in row:
                    at = edges[-1]
                    edges.append(at + len(pieces[i][2]))
                    matrix[at:edges[-1]] = pieces[i][2]
                    position[at:edges[-1]] = places[:edges[-1] - at]
                ids.append([pieces[i][0] for i in row])
                parts.append([pieces[i][1] for i in row])
                counts.append(edges[-1])
                ends.append(edges)
                inputs.append(matrix.tobytes())
                positions.append(position.tobytes())
            first = state["rows"]
            state["rows"] += len(packed)
            return pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + len(packed)), pa.int64()), pa.array(ids, pa.list_(state["type"])), pa.array(parts, pa.list_(pa.int32())),
                 pa.array(counts, pa.int32()), pa.array(ends, pa.list_(pa.int32())), pa.array(inputs, pa.binary()), pa.array(positions, pa.binary())],
                names=["number", "doc_ids", "pieces", "n_tokens", "cu_seqlens", "input_ids", "position_ids"])

        pieces, tokens = [], 0
        for batch in portions(batches):
            state["type"] = batch.schema.field("id").type
            for key, body in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                coded = encode(body or "", tokenizer)
                for k in range(0, len(coded), length):
                    piece = coded[k:k + length]
                    if tokens + len(piece) > block_tokens and pieces:
                        yield flush(pieces)
                        pieces, tokens = [], 0
                    pieces.append((key, k // length, piece.astype(width)))
                    tokens += len(piece)
        if pieces:
            yield flush(pieces)

    schema = f"number long, doc_ids array<{kind}>, pieces array<int>, n_tokens int, cu_seqlens array<int>, input_ids binary, position_ids binary"
    packed = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(rows, schema)
    number = F.concat_ws("-", F.lpad(F.spark_partition_id().cast("string"), 6, "0"), F.lpad(F.col("number").cast("string"), 9, "0"))
    return packed.select(number.alias("pack_id"), "doc_ids", "pieces", "n_tokens", "cu_seqlens", "input_ids", "position_ids")
