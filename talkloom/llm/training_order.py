"""Token ids in training order: a keyed permutation gives every sequence its slot, shards hold slot ranges.

Texts become token ids, each followed by an end id, and the stream of each scan task is
cut into sequences of a fixed length (the last one padded). Sequences are numbered without
gaps; a keyed Feistel network over the next even power of two, walked until it falls below
their number, maps number to slot: a bijection that needs no table, is undone with the
same key, and shuffles anew with another. A shard is a range of slots, written in slot order as raw
little-endian ids of fixed stride, so slot s lies at byte (s mod shard) * stride of its file and
a reader resumes anywhere by arithmetic alone. Files are written under another name and moved when
whole, so a repeated task leaves the same file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.textbytes import mix, slices
from talkloom.llm.token_ids import encoder_of
from talkloom.llm.work import Work

ROUNDS = 6
END_ID = 1
PAD_ID = 0
PIECES = "array<struct<id:{},start:long,length:long,offset:long,ids_crc32:long>>"


def feistel(x: np.ndarray, key: int, half: int, undo: bool = False) -> np.ndarray:
    """A bijection of 2 * half bits chosen by ``key``."""
    mask, low = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> low, x & mask
    for r in reversed(range(ROUNDS)) if undo else range(ROUNDS):
        salt = mix(np.array([(key + 0x632BE59BD9B4E019 * (r + 1)) & (1 << 64) - 1], np.uint64))
        if undo:
            left, right = right ^ (mix(left ^ salt) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ salt) & mask)
    return (left << low) | right


def slot_of(number: np.ndarray, total: int, key: int, undo: bool = False) -> np.ndarray:
    """Slots of sequence numbers below ``total`` (or back): the network is applied again while it falls outside."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    out = feistel(number.astype(np.uint64), key, half, undo)
    while (outside := out >= np.uint64(total)).any():
        out[outside] = feistel(out[outside], key, half, undo)
    return out.astype(np.int64)


def sequences(docs: DataFrame, tokenizer: str, length: int, end_id: int, dtype: str, id_col: str, text: str) -> DataFrame:
    """part, local, ids, pieces: the streams of the scan tasks, cut. Null text counts as empty."""
    wide = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = wide.schema["id"].dataType.simpleString()
    schema = f"part int, local long, ids binary, pieces {PIECES.format(id_type)}"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        part, local = TaskContext.get().partitionId(), 0
        kept = np.zeros(0, dtype)  # the sequence begun, and its pieces
        kept_ids, kept_parts = None, [np.zeros(0, np.int64)] * 4

        def emit(ids: np.ndarray, which: np.ndarray, names: pa.Array, parts: list[np.ndarray]) -> pa.RecordBatch:
            """Whole sequences; ``which``: the sequence of each piece."""
            nonlocal local
            n = len(ids) // length
            ends = np.arange(n + 1, dtype=np.int32) * np.int32(length * ids.itemsize)
            blobs = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())])
            own = pa.StructArray.from_arrays([names, *map(pa.array, parts)], ["id", "start", "length", "offset", "ids_crc32"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(which, np.arange(n + 1)), pa.int32()), own)
            numbers = pa.array(np.arange(local, local + n))
            local += n
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), numbers, blobs, lists], ["part", "local", "ids", "pieces"])

        for batch in batches:
            for rows, data, off in slices(batch):
                ids, bound = encoder.encode(data, off)
                tokens = np.insert(ids, bound[1:], end_id).astype("<u4")
                bound = bound + np.arange(len(bound))
                filled, total = len(kept), len(tokens)
                begin = np.union1d(bound[:-1], np.arange(length - filled, total, length))
                end = np.append(begin[1:], total)
                doc = np.searchsorted(bound, begin, "right") - 1
                raw = memoryview(tokens.tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(begin.tolist(), end.tolist())]
                parts = [begin - bound[doc], end - begin, (begin + filled) % length, np.array(crc, np.int64)]
                which = np.concatenate([np.zeros(len(kept_parts[0]), np.int64), (begin + filled) // length])
                parts = [np.concatenate(x) for x in zip(kept_parts, parts)]
                names = rows.column("id").take(pa.array(doc))
                names = names if kept_ids is None else pa.concat_arrays([kept_ids, names])
                tokens = np.concatenate([kept, tokens.astype(dtype)])
                full = len(tokens) // length
                cut = int(np.searchsorted(which, full))
                if full:
                    yield emit(tokens[: full * length], which[:cut], names[:cut], [x[:cut] for x in parts])
                kept, kept_ids, kept_parts = tokens[full * length :].copy(), names[cut:], [x[cut:] for x in parts]
        if len(kept):
            padded = np.append(kept, np.full(length - len(kept), PAD_ID, dtype))
            yield emit(padded, np.zeros(len(kept_ids), np.int64), kept_ids, kept_parts)

    return wide.mapInArrow(stream, schema)


def write_shards(rows: DataFrame, folder: str, stride: int, slots: int) -> DataFrame:
    """Write (shard, slot, ids), sorted by slot inside a task, as files; a row per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        context = TaskContext.get()
        out, now, count, crc, first, made = None, None, 0, 0, 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                system.move(f"{base}/{name(now)}.{context.taskAttemptId()}", f"{base}/{name(now)}")
                made.append({"shard": now, "first_slot": first, "n_sequences": count, "file_bytes": count * stride, "file_crc32": crc})
                out = None

        def name(shard: int) -> str:
            return f"shard-{shard:08d}.bin"

        for batch in batches:
            for shard, slot, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "ids"))):
                if shard != now:
                    close()
                    now, count, crc, first = shard, 0, 0, slot
                    out = system.open_output_stream(f"{base}/{name(shard)}.{context.taskAttemptId()}")
                if slot != first + count or len(ids) != stride or slot // slots != shard:
                    raise ValueError(f"slot {slot} does not follow in shard {shard}")
                out.write(ids)
                crc = zlib.crc32(ids, crc)
                count += 1
        close()
        kinds = pa.schema([("shard", pa.int64()), ("first_slot", pa.int64()), ("n_sequences", pa.int64()), ("file_bytes", pa.int64()), ("file_crc32", pa.int64())])
        yield pa.RecordBatch.from_pylist(made, kinds)

    return rows.mapInArrow(write, "shard long, first_slot long, n_sequences long, file_bytes long, file_crc32 long")


def materialise(
    docs: DataFrame, tokenizer: str, folder: str | None = None, key: int = 1, length: int = 2048, slots: int = 2048,
    end_id: int = END_ID, dtype: str = "<u2", id_col: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame, str]:
    """(pieces, manifest, folder). Pieces: id, start, length, offset, ids_crc32, slot, shard: where every id of every
    document lies. Manifest: a row per shard file of ``slots`` sequences. ``dtype`` must hold every id.

    Null ids and repeated rows are kept as they are; an empty table gives no rows and no files.
    """
    spark = docs.sparkSession
    work = Work(spark)
    folder = folder or f"{work.root}/shards"
    cut = work.keep(sequences(docs, tokenizer, length, end_id, dtype, id_col, text), "sequences")
    per_part = sorted((r["part"], r["n"]) for r in cut.groupBy("part").agg(F.count("*").alias("n")).collect())  # one per scan task
    total = sum(n for _, n in per_part)
    bases, at = {}, 0
    for part, n in per_part:
        bases[part], at = at, at + n

    @F.pandas_udf("long")
    def slot(part, local):
        import pandas as pd

        number = part.map(bases).to_numpy(np.int64) + local.to_numpy(np.int64)
        return pd.Series(slot_of(number, total, key))

    placed = cut.withColumn("slot", slot("part", "local")).withColumn("shard", F.expr(f"slot div {slots}L"))
    files = max(1, -(-total // slots))
    ordered = placed.select("shard", "slot", "ids").repartitionByRange(files, "shard").sortWithinPartitions("slot")
    manifest = work.keep(write_shards(ordered, folder, length * np.dtype(dtype).itemsize, slots), "manifest")
    where = placed.select("slot", "shard", F.explode("pieces").alias("p"))
    return where.select(F.col("p.id").alias(id_col), "p.start", "p.length", "p.offset", "p.ids_crc32", "slot", "shard"), manifest, folder


def read_slots(folder: str, first: int, end: int, length: int = 2048, slots: int = 2048, dtype: str = "<u2") -> Iterator[np.ndarray]:
    """The sequences of slots ``first`` to ``end``, read by position: how training reads and resumes."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder)
    stride = length * np.dtype(dtype).itemsize
    while first < end:
        shard, inside = divmod(first, slots)
        with system.open_input_file(f"{base}/shard-{shard:08d}.bin") as source:
            for i in range(inside, min(slots, inside + end - first)):
                yield np.frombuffer(source.read_at(stride, i * stride), dtype)
        first = (shard + 1) * slots
