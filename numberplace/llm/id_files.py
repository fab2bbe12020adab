"""Token ids of documents in files of coded blocks, and back.

Documents lie in ascending order of id, each closed by an end id; the ids of a
write task are one stream, cut into blocks of ``id_coder.BLOCK``. The files are
Parquet with a row per block: its part and number, the ids before it in its part,
its size, the CRC-32 of its ids, the code, and which pieces of documents it
holds. A block is decoded without any other, and fails if its checksum is wrong.

The ids are those of the ``tokenizers`` library for a byte-level BPE file. Texts
of plain Latin characters go through ``tiktoken`` with the same vocabulary, which
is some four times as fast; all others, and texts with a special token's string,
through ``tokenizers``.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from numberplace.llm import id_coder
from numberplace.llm.shared import shared

END_ID = 0
#: Characters of a text in a range key, which tell rows of equal id apart.
RANGE_CHARS = 32
#: Characters on which both libraries cut words alike whatever their Unicode version.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")
_PIECES = ("piece_of", "piece_id", "piece_size", "piece_after")


class Encoder:
    """Ids of texts, without special tokens around them."""

    def __init__(self, definition: bytes, ranks: bytes | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition.decode())
        special = [token["content"] for token in json.loads(definition).get("added_tokens", [])]
        self._slow = re.compile("|".join([_UNUSUAL.pattern, *map(re.escape, special)]))
        self._fast: Callable[[str], np.ndarray] | None = None
        if ranks and pattern:
            import tiktoken

            pairs = (line.split() for line in ranks.splitlines() if line)
            known = {base64.b64decode(token): int(rank) for token, rank in pairs}
            encoding = tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=known, special_tokens={})
            self._fast = lambda text: encoding.encode_to_numpy(text, disallowed_special=())

    def __call__(self, text: str) -> np.ndarray:
        if self._fast and not self._slow.search(text):
            return self._fast(text).astype(np.int32)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def size(self) -> int:
        return self._tokenizer.get_vocab_size(with_added_tokens=True)


def _read(path: str | None) -> bytes | None:
    if path is None:
        return None
    with open(path, "rb") as file:
        return file.read()


def write_ids(
    df: DataFrame, path: str, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
    id_column: str = "doc_id", text: str = "text", end_id: int = END_ID,
) -> None:
    """Write the ids of all rows to ``path``, in ascending order of ``id_column`` (nulls first, equal ids by text).

    ``tokenizer`` is a file of the ``tokenizers`` library; ``ranks`` and
    ``pattern`` are the same vocabulary for ``tiktoken``, if there is one. Tokenizer
    files are read here and sent along. A null text is empty and has the end id alone.
    """
    files = (_read(tokenizer), _read(ranks), pattern)
    alphabet = max(Encoder(*files).size(), end_id + 1)
    opened = shared(df.sparkSession, files)
    kind = dict(df.dtypes)[id_column]
    names = ["part", "block", "first", "size", "checksum", "alphabet", "code", *_PIECES]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(*opened()), TaskContext.get().partitionId()
        blocks: list[np.ndarray] = []
        pieces: list[list[tuple]] = []
        held: list[np.ndarray] = []
        room, number, first, document = id_coder.BLOCK, 0, 0, 0
        own: list[tuple] = []
        id_type: pa.DataType | None = None

        def rows() -> pa.RecordBatch:
            nonlocal blocks, pieces, number, first
            coded = id_coder.encode_blocks(blocks, alphabet)
            sizes = [len(b) for b in blocks]
            flat = [list(x) for x in zip(*(p for ps in pieces for p in ps), strict=True)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(ps) for ps in pieces])]), pa.int32())
            kinds = (pa.int64(), id_type, pa.int32(), pa.int64())
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(blocks), pa.int32()), pa.array(range(number, number + len(blocks)), pa.int64()),
                 pa.array(first + np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array([id_coder.checksum(b) for b in blocks], pa.int64()),
                 pa.array([alphabet] * len(blocks), pa.int32()), pa.array(coded, pa.binary()),
                 *(pa.ListArray.from_arrays(offsets, pa.array(x, k)) for x, k in zip(flat, kinds, strict=True))], names)
            number, first, blocks, pieces = number + len(blocks), first + sum(sizes), [], []
            return out

        for batch in batches:
            id_type = batch.schema.field(id_column).type
            for own_id, value in zip(batch.column(id_column).to_pylist(), batch.column(text).to_pylist(), strict=True):
                ids = np.append(encode(value or ""), np.int32(end_id))
                at = 0
                while at < len(ids):
                    taken = min(room, len(ids) - at)
                    held.append(ids[at : at + taken])
                    at += taken
                    room -= taken
                    own.append((document, own_id, taken, len(ids) - at))
                    if not room:
                        blocks.append(np.concatenate(held))
                        pieces.append(own)
                        held, own, room = [], [], id_coder.BLOCK
                        if len(blocks) == id_coder.SIDE_BY_SIDE:
                            yield rows()
                document += 1
        if held:
            blocks.append(np.concatenate(held))
            pieces.append(own)
        if blocks:
            yield rows()

    schema = ("part int, block long, first long, size int, checksum long, alphabet int, code binary, "
              f"piece_of array<long>, piece_id array<{kind}>, piece_size array<int>, piece_after array<long>")
    # Range keys are sampled to the driver, so they hold the first characters of a text only; these order texts as a whole does.
    ranged = df.select(id_column, text).repartitionByRange(id_column, F.substring(text, 1, RANGE_CHARS))
    ordered = ranged.sortWithinPartitions(id_column, text)
    ordered.mapInArrow(code, schema).write.parquet(path)


def _decoded(batch: pa.RecordBatch) -> list[np.ndarray]:
    columns = (batch.column(c).to_pylist() for c in ("code", "size", "checksum"))
    alphabets = batch.column("alphabet")
    return id_coder.decode_blocks(*columns, alphabets[0].as_py()) if len(batch) else []


def _zero_tables() -> list[np.ndarray]:
    """For each power of two, how a CRC-32 changes when so many zero bytes follow: a table per byte of it."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    low = np.arange(256, dtype=np.uint32)
    one = np.stack([step, low, low << 8, low << 16])  # a zero byte moves the upper bytes down
    tables = [one]
    for _ in range(40):
        tables.append(np.stack([_moved(tables[-1], t) for t in tables[-1]]))
    return tables


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def followed(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What a CRC-32 adds to that of a longer text in which ``zeros`` more bytes follow."""
    crc, zeros = crc.astype(np.uint32), zeros.astype(np.int64)
    for power, table in enumerate(_zero_tables()):
        due = np.flatnonzero(zeros >> power & 1)
        if len(due):
            crc[due] = _moved(table, crc[due])
        if not (zeros >> power > 1).any():
            break
    return crc


def _part_starts(blocks: DataFrame) -> DataFrame:
    """(part, before): ids of all parts before each; a row per write task."""
    totals = blocks.groupBy("part").agg(F.sum("size").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def read_digests(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Per document: the id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of its decoded ids.

    A document's CRC is put together from those of its pieces.
    """
    blocks = spark.read.parquet(path)
    kind = dict(blocks.dtypes)["piece_id"].removeprefix("array<").removesuffix(">")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), id_coder.SIDE_BY_SIDE):
                batch = whole.slice(start, id_coder.SIDE_BY_SIDE)
                crcs, offsets = [], []
                sizes = batch.column("piece_size").to_pylist()
                for ids, first, own in zip(_decoded(batch), batch.column("first").to_pylist(), sizes, strict=True):
                    data, at = ids.astype("<u4").tobytes(), 0
                    for size in own:
                        crcs.append(zlib.crc32(data[4 * at : 4 * (at + size)]))
                        offsets.append(first + at)
                        at += size
                counts = pa.array(np.repeat(np.arange(len(batch)), [len(x) for x in sizes]))
                after = batch.column("piece_after").flatten().to_numpy()
                crc = followed(np.array(crcs, np.uint32), 4 * after)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").take(counts), batch.column("piece_of").flatten(), batch.column("piece_id").flatten(),
                     pa.array(offsets, pa.int64()), batch.column("piece_size").flatten().cast(pa.int64()),
                     pa.array(crc.astype(np.int64))],
                    ["part", "document", "id", "offset", "size", "crc"])

    found = blocks.mapInArrow(pieces, f"part int, document long, id {kind}, offset long, size long, crc long")
    whole = found.groupBy("part", "document", "id").agg(
        F.min("offset").alias("offset"), F.sum("size").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    return whole.join(_part_starts(blocks), "part").select(
        F.col("id").alias(id_column), (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, piece, ids): the ids of each document in pieces as its blocks hold them, numbered by their first id's place in the part."""
    blocks = spark.read.parquet(path)
    kind = dict(blocks.dtypes)["piece_id"].removeprefix("array<").removesuffix(">")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), id_coder.SIDE_BY_SIDE):
                batch = whole.slice(start, id_coder.SIDE_BY_SIDE)
                decoded = _decoded(batch)
                sizes = batch.column("piece_size").flatten().to_numpy()
                first = np.repeat(batch.column("first").to_numpy(), [len(x) for x in batch.column("piece_size")])
                ends = np.cumsum(sizes)
                block_first = np.repeat(np.cumsum([0, *map(len, decoded[:-1])]), [len(x) for x in batch.column("piece_size")])
                flat = pa.array(np.concatenate(decoded) if decoded else np.empty(0, np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("piece_id").flatten(), pa.array(first + ends - sizes - block_first, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat)],
                    ["id", "piece", "ids"])

    return blocks.mapInArrow(pieces, f"id {kind}, piece long, ids array<long>").withColumnRenamed("id", id_column)
