"""Token ids in binary files of patched frame-of-reference blocks.

A file holds blocks of ``BLOCK`` ids. A block stores its least id, the differences to it
packed at a width that fits the chosen share of them, and the larger differences as a list
of exceptions (place, value). The footer indexes the block starts and lists the documents
with their token counts, so a reader can begin at any block or document.

Layout, little-endian: the blocks; their starts (u64 each); the documents (id i64, null
flag u8, tokens u64, as three arrays); the tail ``TAIL``. A block is ``HEAD``, then the
packed bits, the places (u16 each) and the values (u32 each) of its exceptions.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import map_batches
from tessella.llm.registry import query, table
from tessella.llm.tokenizing import worker_encoder
from tessella.session import shared_folder

BLOCK = 1024
HEAD = "<IBHH"  # least id, width in bits, ids, exceptions
TAIL = "<QQQQQ8s"  # place of the block starts, of the documents; blocks, documents, ids
MAGIC = b"PFORTOK1"
_STEP = 64
#: Widths of whole bytes need no bit packing; the bits are the same, high ones first.
_WHOLE = {8: ">u1", 16: ">u2", 32: ">u4"}
_TEXT_BYTES = 1 << 23


def pack_blocks(ids: np.ndarray, share: float) -> list[bytes]:
    """Blocks of ``BLOCK`` ids each (the last may be shorter)."""
    full = len(ids) // BLOCK * BLOCK
    out = _pack_rows(ids[:full].reshape(-1, BLOCK), share) if full else []
    return out + (_pack_rows(ids[full:].reshape(1, -1), share) if full < len(ids) else [])


def _pack_rows(rows: np.ndarray, share: float) -> list[bytes]:
    count, size = rows.shape
    least = rows.min(axis=1)
    rest = (rows - least[:, None]).astype(np.uint32)
    at = min(size - 1, max(0, int(np.ceil(share * size)) - 1))
    typical = np.partition(rest, at, axis=1)[:, at]
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        part = rest[chosen]
        large = part >> width > 0 if width < 32 else np.zeros(part.shape, bool)
        if width in _WHOLE:
            packed = np.where(large, 0, part).astype(_WHOLE[width]).view(np.uint8).reshape(len(chosen), -1)
        else:
            bits = np.unpackbits(np.where(large, 0, part).astype(">u4").view(np.uint8).reshape(len(chosen), size, 4), axis=2)[:, :, 32 - width:]
            packed = np.packbits(bits.reshape(len(chosen), -1), axis=1)
        for i, row in enumerate(chosen):
            places = np.flatnonzero(large[i])
            out[row] = b"".join((
                struct.pack(HEAD, int(least[row]), int(width), size, len(places)), packed[i].tobytes(),
                places.astype("<u2").tobytes(), part[i][places].astype("<u4").tobytes(),
            ))
    return out


def unpack_block(data: bytes) -> np.ndarray:
    least, width, size, odd = struct.unpack_from(HEAD, data)
    at = struct.calcsize(HEAD)
    packed = (size * width + 7) // 8
    ids = np.zeros(size, np.uint32)
    if width in _WHOLE:
        ids = np.frombuffer(data, _WHOLE[width], size, at).astype(np.uint32)
    elif width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, packed, at), count=size * width).reshape(size, width)
        wide = np.zeros((size, 32), np.uint8)
        wide[:, 32 - width:] = bits
        ids = np.packbits(wide, axis=1).view(">u4").reshape(size).astype(np.uint32)
    places = np.frombuffer(data, "<u2", odd, at + packed)
    ids[places] = np.frombuffer(data, "<u4", odd, at + packed + 2 * odd)
    return ids + np.uint32(least)


def _file_system(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


class TokenFileWriter:
    """Writes one file under a name of its own and moves it to its place at the end."""

    def __init__(self, folder: str, name: str, share: float):
        self.fs, path = _file_system(folder)
        self.path, self.part = f"{path}/{name}", f"{path}/_{name}.{uuid.uuid4().hex}"
        self.out, self.at, self.share = self.fs.open_output_stream(self.part), 0, share
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        self.tokens: list[int] = []

    def add(self, doc: int | None, ids: np.ndarray):
        self.docs.append(doc)
        self.tokens.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= _STEP * BLOCK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, count: int):
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, count, _STEP * BLOCK):
            for block in pack_blocks(ids[at:min(count, at + _STEP * BLOCK)], self.share):
                self.starts.append(self.at)
                self.out.write(block)
                self.at += len(block)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> tuple[int, int]:
        self._flush(self.held)
        blocks_at = self.at
        starts = np.array(self.starts, "<u8").tobytes()
        docs = np.array([d if d is not None else 0 for d in self.docs], "<i8").tobytes()
        nulls = np.array([d is None for d in self.docs], "u1").tobytes()
        tail = struct.pack(TAIL, blocks_at, blocks_at + len(starts), len(self.starts), len(self.docs), sum(self.tokens), MAGIC)
        for piece in (starts, docs, nulls, np.array(self.tokens, "<u8").tobytes(), tail):
            self.out.write(piece)
        self.out.close()
        self.fs.move(self.part, self.path)
        return len(self.docs), sum(self.tokens)


class TokenFile:
    """Reads a file; ``documents`` goes through it from the first block to the last."""

    def __init__(self, folder: str, name: str):
        fs, path = _file_system(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        self.file.seek(self.file.size() - struct.calcsize(TAIL))
        self.blocks_at, docs_at, blocks, docs, self.tokens, magic = struct.unpack(TAIL, self.file.read(struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.file.seek(self.blocks_at)
        self.starts = np.append(np.frombuffer(self.file.read(8 * blocks), "<u8"), self.blocks_at).astype(np.int64)
        self.file.seek(docs_at)
        ids, nulls = np.frombuffer(self.file.read(8 * docs), "<i8"), np.frombuffer(self.file.read(docs), "u1")
        self.docs = [None if n else int(d) for d, n in zip(ids, nulls)]
        self.sizes = np.frombuffer(self.file.read(8 * docs), "<u8").astype(np.int64)

    def ids(self, first: int, count: int) -> np.ndarray:
        """Ids of ``count`` blocks from block ``first``."""
        last = min(first + count, len(self.starts) - 1)
        if last <= first:
            return np.zeros(0, np.uint32)
        base = int(self.starts[first])
        self.file.seek(base)
        data = self.file.read(int(self.starts[last]) - base)
        return np.concatenate([unpack_block(data[self.starts[i] - base:self.starts[i + 1] - base]) for i in range(first, last)])

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc id, first id's place in the file, ids, crc32 of the ids as u32)."""
        start, block, ids, used = 0, 0, np.zeros(0, np.uint32), 0
        for doc, size in zip(self.docs, self.sizes.tolist()):
            crc, left = 0, size
            while left:
                if used == len(ids):
                    ids, used, block = self.ids(block, _STEP), 0, block + _STEP
                step = ids[used:used + left]
                crc = zlib.crc32(step.astype("<u4").tobytes(), crc)
                used, left = used + len(step), left - len(step)
            yield doc, start, size, crc
            start += size


def _name(number: int) -> str:
    return f"tokens-{number:06d}.bin"


def _shares(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Runs of texts of like size, of about ``_TEXT_BYTES`` at most: first and count."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    size = int(ends[-1]) if len(ends) else 0
    parts = -(-size // _TEXT_BYTES) or 1
    cuts = np.searchsorted(ends, size * np.arange(1, parts) // parts, "right")
    cuts = np.unique([0, *cuts, len(texts)])
    yield from zip(cuts[:-1].tolist(), np.diff(cuts).tolist())


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int | None = 0, share: float = 0.95,
) -> DataFrame:
    """Encode whole texts and write them in ascending id order; the manifest, one row a file.

    The documents are dealt into ranges of ids, one file each; null ids come first and rows
    of one id are ordered by their text's hash, so a frequent id is spread as well. A null
    text counts as empty and has only the end id; an empty table gives no files. Only the
    two named columns are read. A file appears under its name when it is complete, so tasks
    may be repeated.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row").select("id", "text")

    def write(batches):
        number, encoder, writer = TaskContext.get().partitionId(), None, None
        end = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

        def put(held):
            ids, texts = (pa.concat_arrays([b[n] for b in held]) if len(held) > 1 else held[0][n] for n in ("id", "text"))
            for at, count in _shares(texts):
                for doc, tokens in zip(ids.slice(at, count).to_pylist(), encoder.encode(texts.slice(at, count))):
                    writer.add(doc, np.concatenate([tokens, end]))

        held, size = [], 0
        for batch in batches:
            if writer is None and len(batch["id"]):
                encoder, writer = worker_encoder(tokenizer), TokenFileWriter(folder, _name(number), share)
            if held and size + batch["text"].nbytes > _TEXT_BYTES:
                put(held)
                held, size = [], 0
            held.append(batch)
            size += batch["text"].nbytes
        if held:
            put(held)
        if writer is not None:
            count, tokens = writer.close()
            encoder.rest()
            yield {"file": [number], "docs": [count], "tokens": [tokens]}

    spark = docs.sparkSession
    parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(parent)
    map_batches(ordered, write, "file int, docs bigint, tokens bigint").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32.

    The manifest (one row a file) comes to the driver; each file is read by a task of its own.
    """
    files = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/manifest").select("file", "tokens").collect())
    bases = np.cumsum([0, *(tokens for _, tokens in files)]).tolist()

    def read(batches):
        for batch in batches:
            for i in batch["id"]:
                number, base = files[i.as_py()][0], bases[i.as_py()]
                rows: list[tuple] = []
                for doc, start, size, crc in TokenFile(folder, _name(number)).documents():
                    rows.append((doc, base + start, size, crc))
                    if len(rows) == 10_000:
                        yield dict(zip((id_col, "start", "n_tokens", "ids_crc32"), zip(*rows)))
                        rows = []
                if rows:
                    yield dict(zip((id_col, "start", "n_tokens", "ids_crc32"), zip(*rows)))

    schema = f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_batches(spark.range(0, len(files), 1, max(1, len(files))), read, schema)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_index(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents' ids into a folder of their own and read the files back."""
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, tokenizer or tokenizer_path())
    return read_tokens(docs.sparkSession, folder)


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    return token_index(table(spark, sf_dir, "documents"))
