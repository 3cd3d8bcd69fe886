"""Token ids as files for training: frequency-ranked ids in bytes of variable number.

An id is written as its rank by frequency in the corpus, so the commonest 256 ids take
one byte and the next 65,280 two.  Four ids share a control byte, two bits each for their
number of bytes; control bytes and data bytes are separate streams.  A reader looks the
control bytes up in a table of numbers of bytes, which gives every id's place at once,
and masks four bytes from there: no loop over ids.

A folder of token files holds Parquet tables, so Spark's commits make them whole on any
file system:
  ranks     rank, id, n: the order of ids, at most one row per id of the vocabulary
  segments  part, place, before, documents, control, data: about SEGMENT_IDS ids each,
            in ascending order of documents by (part, place); `before` counts the ids of
            the part's earlier segments
  starts    part, start: the ids of all earlier parts
Parts are ranges of documents of about PART_IDS ids, so tasks write and read them alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .encoding import id_bytes, id_encoder
from .scratch import BATCH, BATCH_BYTES, CLEANUP, setting, staged

SEGMENT_IDS = 1 << 18
PART_IDS = 1 << 23
# Parts in a block of the running total.
BLOCK = 1 << 10

# Bytes of each of the four ids of a control byte, and the mask of an id of so many bytes.
WIDTHS = np.array([[1 + (control >> 2 * i & 3) for i in range(4)] for control in range(256)], dtype=np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The control bytes and the data bytes of 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    codes[: len(values)] = extra
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control, values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values of a control and a data stream."""
    widths = WIDTHS[control].ravel()[:n]
    ends = np.cumsum(widths, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    fours = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    return fours[ends - widths] & MASKS[widths]


def binary(parts: list[np.ndarray]) -> pa.Array:
    """A binary column with the bytes of each array."""
    ends = np.cumsum([0, *[p.nbytes for p in parts]])
    data = np.concatenate([p.view(np.uint8) for p in parts]) if parts else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def fields(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*names).schema.fields)


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def id_type(tokenizer_path: str, end_id: int) -> str:
    """The narrowest integers that hold every id, for rows on their way to the files."""
    ids = max(len(id_bytes(tokenizer_path, read_file(tokenizer_path))), end_id + 1)
    return "<u2" if ids <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, kind: str, keys: list[str], text: str) -> DataFrame:
    """Per row `keys`, tie_ and row_ (the order of rows of equal keys), n_ and ids_ (of a
    type, `end_id` last)."""
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_path, read_file(tokenizer_path)))  # one file of a few MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = None
        for batch in batches:
            ids_of = ids_of or id_encoder(*shared.value, special=True)
            texts = batch.column("text_")
            ids = []
            for part, _, _ in W.chunks(texts):
                ids += [np.append(x, end_id).astype(kind) for x in ids_of(texts[part].to_pylist())]
            columns = [*batch.columns[:-1], pa.array([len(i) for i in ids], pa.int64()), binary(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_", "ids_"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keys, F.xxhash64(whole).alias("tie_"), F.monotonically_increasing_id().alias("row_"), whole.alias("text_"))
    return rows.mapInArrow(encode, f"{fields(docs, keys)}tie_ long, row_ long, n_ long, ids_ binary")


def ranked(rows: DataFrame, kind: str) -> DataFrame:
    """(rank, id, n) of the ids in `rows`: the commonest first, of equals the lowest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids_"):
                more = np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=len(seen))
                more[: len(seen)] += seen
                seen = more
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(seen[ids])], names=["id", "n"])

    counts = rows.select("ids_").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary at most: the window's one task holds no more.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1
    return counts.select(rank.cast("long").alias("rank"), "id", "n")


def running_total(parts: DataFrame, part: str, size: str) -> DataFrame:
    """(part, start): the sum of `size` over all smaller parts.  Blocks of parts are summed
    first, so that no window holds all parts of a large table."""
    block = F.floor(F.col(part) / BLOCK).alias("block")
    own = parts.select(part, size, block)
    before = F.coalesce(F.sum(size).over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = own.groupBy("block").agg(F.sum(size).alias(size)).select("block", before.alias("blocks_before"))
    within = Window.partitionBy("block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(within), F.lit(0))
    return own.select(part, "block", inside.alias("inside")).join(blocks, "block").select(
        part, (F.col("blocks_before") + F.col("inside")).cast("long").alias("start")
    )


def segments(rows: DataFrame, kind: str, rank_of: np.ndarray, keys: list[str]) -> DataFrame:
    """The rows in ascending order of `keys`, packed."""
    shared = rows.sparkSession.sparkContext.broadcast(rank_of)  # one rank per id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = before = 0
        held: list[pa.RecordBatch] = []
        part = None

        def segment() -> pa.RecordBatch:
            nonlocal place, before
            table = pa.Table.from_batches(held).combine_chunks()
            ids = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table["ids_"]])
            control, data = pack(shared.value[ids])
            columns = [table[k].combine_chunks() for k in (*keys, "n_")]
            documents = pa.StructArray.from_arrays(columns, names=[*keys, "n_"])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([before], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents),
                    binary([control]), binary([data]),
                ],
                names=["part", "place", "before", "documents", "control", "data"],
            )
            place, before = place + 1, before + len(ids)
            held.clear()
            return out

        room = SEGMENT_IDS
        for batch in batches:
            part = part if part is not None or not batch.num_rows else batch.column("part")[0].as_py()
            sizes = np.asarray(batch.column("n_"))
            row = 0
            while row < batch.num_rows:
                # As many documents as there is room for; a larger one is alone or last.
                last = max(int(np.searchsorted(np.cumsum(sizes[row:]), room, side="right")), 0 if held else 1) + row
                if last > row:
                    held.append(batch.slice(row, last - row))
                    room -= int(sizes[row:last].sum())
                    row = last
                if row < batch.num_rows or room <= 0:
                    yield segment()
                    room = SEGMENT_IDS
        if held:
            yield segment()

    total = rows.agg(F.sum("n_")).first()[0] or 0
    order = [*keys, "tie_", "row_"]
    dealt = rows.repartitionByRange(max(1, -(-total // PART_IDS)), *order)
    sorted_ = dealt.select("*", F.spark_partition_id().alias("part")).sortWithinPartitions(*order)
    document = f"struct<{fields(rows, keys).replace('` ', '`: ')}n_: long>"
    return sorted_.mapInArrow(write, f"part int, place long, before long, documents array<{document}>, control binary, data binary")


def write_tokens(
    docs: DataFrame, tokenizer_path: str, end_id: int, path: str, keys: list[str], text: str = "text"
) -> None:
    """Writes the ids of every row's whole text, and `end_id` after each, in ascending order
    of `keys` (null first, rows of equal keys by their text) below `path`.

    No begin or end tokens are added by the tokenizer; strings of special tokens inside a
    text count as the library's default has them.  Null counts as empty: `end_id` alone.
    Repeated rows are written each; no rows give tables without rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer_path, end_id)
    rows = staged(encoded(docs, tokenizer_path, end_id, kind, keys, text), "token-ids")
    with setting(spark, CLEANUP, "true"), setting(spark, BATCH, BATCH_BYTES):
        ranked(rows, kind).write.parquet(f"{path}/ranks")
        segments(rows, kind, np.argsort(id_of_rank(spark, path, end_id)), keys).write.option("compression", "none").parquet(f"{path}/segments")
        stored = spark.read.parquet(f"{path}/segments")
        sizes = stored.groupBy("part").agg(F.sum(F.aggregate("documents", F.lit(0).cast("long"), lambda n, d: n + d["n_"])).alias("size"))
        running_total(sizes, "part", "size").write.parquet(f"{path}/starts")


def id_of_rank(spark: SparkSession, path: str, at_least: int = 0) -> np.ndarray:
    """The id of each rank; ids that the corpus lacks follow, so all ids have a rank."""
    found = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow()["id"].to_numpy().astype(np.uint32)
    rest = np.setdiff1d(np.arange(max(at_least, int(found.max(initial=0))) + 1, dtype=np.uint32), found)
    return np.concatenate([found, rest])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document of the files: its keys, start (ids of all documents before it), n_tokens,
    ids_crc32 (unsigned, of the ids as little-endian 32-bit integers) and, unless turned
    off, ids."""
    stored = spark.read.parquet(f"{path}/segments")
    document = stored.schema["documents"].dataType.elementType
    keys = document.names[:-1]
    shared = spark.sparkContext.broadcast(id_of_rank(spark, path))  # one id per rank of the vocabulary

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("documents")[i].values
                sizes = np.asarray(rows.field("n_"))
                streams = [np.frombuffer(batch.column(s)[i].as_buffer(), np.uint8) for s in ("control", "data")]
                ids = shared.value[unpack(*streams, int(sizes.sum()))].astype("<u4")
                ends = np.cumsum(np.r_[0, sizes])
                checks = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                columns = [
                    *rows.flatten()[:-1],
                    pa.array(np.full(len(rows), batch.column("part")[i].as_py(), np.int32)),
                    pa.array(ends[:-1] + batch.column("before")[i].as_py()),
                    pa.array(sizes),
                    pa.array(checks, pa.int64()),
                ]
                names = [*keys, "part_", "inside_", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in document.fields[:-1])
    schema = f"{kept}part_ int, inside_ long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    rows = stored.mapInArrow(read, schema)
    starts = spark.read.parquet(f"{path}/starts").withColumnsRenamed({"part": "part_", "start": "start_"})
    outputs = ["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return rows.join(starts, "part_").select(*keys, (F.col("start_") + F.col("inside_")).alias("start"), *outputs)
