"""Token files with directly addressable codes: any token is read by itself.

Documents, in ascending order of their id, become token ids with an end id.
Within a file the ids are split into chunks of a few bits, one level after the
other: level 0 has a chunk of every id, level k + 1 a chunk of each id whose
level-k continuation bit is set. The place of an id's chunk in the next level is
the number of continuation bits set before it, which a rank directory gives from
one counter and at most 64 bytes of the bitmap. So a token costs a few short
reads and no block is decoded. Chunk widths are chosen for each file so that
chunks, bitmaps and counters take the fewest bits.

Layout of a file, all integers little-endian: ``MAGIC``; the length of the
header (4 bytes); the header, as JSON, with counts, widths and the byte ranges
of all parts; then an Arrow stream with the documents' ids and token counts;
then of each level the chunks, the bitmap (one bit per chunk; the last level has
none) and the counters (8 bytes for each 512 bits: ones before them).

Documents are range-partitioned by id, then stored file and row, so a hot id is
no single task. A task writes its documents to files of about ``FILE_TOKENS``
tokens under names of its own; the manifest, a staged table with a row per file,
names those of the tasks that ended well, so a repeated task leaves at most a
file that nothing refers to. Where a file's tokens begin among all is a running
sum over the manifest: a few numbers for each 8 million tokens.

Defined cases: a null or empty text is the end id alone; null ids come last;
rows with equal ids follow each other as stored and are written each; an empty
table writes no file and gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from posloom.llm.common import KEY, Scratch, read_table, row_keyed
from posloom.llm.tokens import VOCABULARY, slices, with_end, worker_encoder
from posloom.session import shared_dir

MAGIC = b"DACTOKEN"
END_ID = 0
FILE_TOKENS = 8 << 20
RANK_BITS = 512
COUNTER_BITS = 64
AT_ONCE = 1 << 16  # values packed or unpacked at a time; a multiple of 8
TEXT_AT_ONCE = 4 << 20  # bytes of text encoded at a time
READ_TOKENS = 1 << 20


def chunk_widths(ids: np.ndarray) -> list[int]:
    """Widths, lowest chunk first, with the fewest bits for chunks, bitmaps and counters."""
    of_bits = np.zeros(33, np.int64)
    for at in range(0, len(ids), AT_ONCE):
        bits = np.frexp(ids[at : at + AT_ONCE].astype(np.float64))[1]  # exact: the bits of an integer
        of_bits += np.bincount(bits, minlength=33)
    top = max(1, int(np.flatnonzero(of_bits).max(initial=1)))
    longer = len(ids) - np.cumsum(of_bits)  # ids of more than t bits
    counts = [len(ids), *longer[1 : top + 1].tolist()]  # that reach bit t
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for low in range(top - 1, -1, -1):
        choices = []
        for high in range(low + 1, top + 1):
            marks = (1 + COUNTER_BITS / RANK_BITS) if high < top else 0
            choices.append((counts[low] * (high - low + marks) + best[high][0], [high - low, *best[high][1]]))
        best[low] = min(choices)
    return best[0][1]


def pack(values: np.ndarray, width: int) -> bytes:
    parts = []
    for at in range(0, len(values), AT_ONCE):
        raw = values[at : at + AT_ONCE].astype("<u4").view(np.uint8).reshape(-1, 4)
        bits = np.unpackbits(raw, axis=1, count=width, bitorder="little")
        parts.append(np.packbits(bits, bitorder="little").tobytes())
    return b"".join(parts)


def unpack(data: bytes, first_bit: int, count: int, width: int) -> np.ndarray:
    """``count`` values of ``width`` bits, from a bit of ``data`` on."""
    out = np.empty(count, np.uint32)
    scale = (np.uint32(1) << np.arange(width, dtype=np.uint32)).astype(np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, count, AT_ONCE):
        some = min(AT_ONCE, count - at)
        low = first_bit + at * width
        bits = np.unpackbits(raw[low // 8 : -(-(low + some * width) // 8)], bitorder="little")
        out[at : at + some] = bits[low % 8 : low % 8 + some * width].reshape(some, width) @ scale
    return out


def encoded(ids: np.ndarray, documents: pa.Table) -> bytes:
    """A whole file: the ids of ``documents`` (columns ``id`` and ``n_tokens``), side by side."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as stream:
        stream.write_table(documents)
    parts, levels, at = [sink.getvalue().to_pybytes()], [], 0
    widths, values = chunk_widths(ids), ids.astype(np.uint32)
    for level, width in enumerate(widths):
        chunks = pack(values & np.uint32((1 << width) - 1), width)
        more = (values >> np.uint32(width)) > 0 if width < 32 else np.zeros(len(values), bool)
        bitmap, counters = b"", b""
        if level < len(widths) - 1:
            bitmap = np.packbits(more, bitorder="little").tobytes()
            sums = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
            counters = (np.cumsum(sums, dtype=np.uint64) - sums).astype("<u8").tobytes()
        levels.append({"width": width, "count": len(values), "parts": [len(chunks), len(bitmap), len(counters)]})
        parts += [chunks, bitmap, counters]
        values = values[more] >> np.uint32(width) if bitmap else values[:0]
        at += len(chunks)
    header = json.dumps({"tokens": len(ids), "documents": documents.num_rows, "directory": len(parts[0]), "levels": levels}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *parts])


class TokenFile:
    """A file opened for reading; ``source`` is a pyarrow input file or any object with ``read_at(size, offset)``."""

    def __init__(self, source):
        self.source = source
        start = source.read_at(12, 0)
        if start[:8] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(start[8:12], "little")
        head = json.loads(bytes(source.read_at(size, 12)))
        self.tokens_count, self.documents_count = head["tokens"], head["documents"]
        self.directory = (12 + size, head["directory"])
        at = sum(self.directory)
        self.levels = []
        for level in head["levels"]:
            chunks, bitmap, counters = level["parts"]
            self.levels.append((level["width"], level["count"], at, at + chunks if bitmap else None, at + chunks + bitmap))
            at += chunks + bitmap + counters

    def documents(self) -> pa.Table:
        at, size = self.directory
        return pa.ipc.open_stream(self.source.read_at(size, at)).read_all()

    def _rank(self, level: int, place: int) -> int:
        """Continuation bits set before ``place``."""
        _, count, _, bitmap, counters = self.levels[level]
        if place >= count:  # only asked for as the end of a range
            return self.levels[level + 1][1]
        block = place // RANK_BITS
        before = int.from_bytes(self.source.read_at(8, counters + 8 * block), "little")
        first = block * RANK_BITS // 8
        bits = np.unpackbits(np.frombuffer(self.source.read_at(place // 8 + 1 - first, bitmap + first), np.uint8), bitorder="little")
        return before + int(bits[: place % RANK_BITS].sum())

    def _chunks(self, level: int, low: int, high: int) -> np.ndarray:
        width, _, at, _, _ = self.levels[level]
        first, last = low * width // 8, -(-high * width // 8)
        return unpack(self.source.read_at(last - first, at + first), low * width - 8 * first, high - low, width)

    def token(self, place: int) -> int:
        """One token, from a chunk, a bit and a counter of each level that it has."""
        if not 0 <= place < self.tokens_count:
            raise IndexError(place)
        value, shift = 0, 0
        for level, (width, _, _, bitmap, _) in enumerate(self.levels):
            value |= int(self._chunks(level, place, place + 1)[0]) << shift
            shift += width
            if bitmap is None or not self.source.read_at(1, bitmap + place // 8)[0] >> place % 8 & 1:
                break
            place = self._rank(level, place)
        return value

    def tokens(self, low: int, high: int, level: int = 0) -> np.ndarray:
        """Tokens ``low`` to ``high``, level by level."""
        width, _, _, bitmap, _ = self.levels[level]
        out = self._chunks(level, low, high)
        if bitmap is not None and high > low:
            first = low // 8
            bits = np.unpackbits(np.frombuffer(self.source.read_at(-(-high // 8) - first, bitmap + first), np.uint8), bitorder="little")
            more = bits[low - 8 * first : high - 8 * first].astype(bool)
            begin = self._rank(level, low)
            out[more] |= self.tokens(begin, begin + int(more.sum()), level + 1) << np.uint32(width)
        return out


def _written(root: str, vocabulary: str, file_tokens: int, schema: pa.Schema):
    """A task's part: its documents in order, into files; a manifest row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encoder = worker_encoder(vocabulary)
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        keys: list[pa.RecordBatch] = []
        data: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def file() -> pa.RecordBatch:
            table = pa.Table.from_batches(keys)
            documents = pa.table({"id": table.column("id"), "n_tokens": np.concatenate(sizes)})
            ids = np.concatenate(data)
            name = f"{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{folder}/{name}") as out:
                out.write(encoded(ids, documents))
            first = table.slice(0, 1)
            row = [*(first.column(c).combine_chunks() for c in ("id", *KEY)), pa.array([name]), *(pa.array([n], pa.int64()) for n in (len(table), len(ids)))]
            for held_ in (keys, data, sizes):
                held_.clear()
            return pa.RecordBatch.from_arrays(row, schema=schema)

        held = 0
        for batch in batches:
            for part, texts in slices(batch, "text", TEXT_AT_ONCE):
                keys.append(part.select(["id", *KEY]))
                ids, counts = with_end(*encoder.encode(texts), END_ID)
                data.append(ids)
                sizes.append(counts)
                held += len(ids)
                if held >= file_tokens:
                    yield file()
                    held = 0
        if data:
            yield file()

    return run


def write_tokens(
    docs: DataFrame,
    root: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write all documents below ``root``; the manifest has ``name``, ``base`` (tokens of earlier files) and counts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    scratch = Scratch(docs.sparkSession)
    rows = row_keyed(docs.select(id_col, text_col), scratch).select(F.col(id_col).alias("id"), *KEY, F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last(), *KEY]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    types = StructType(rows.drop("text").schema.fields)
    types = types.add("name", StringType()).add("documents", LongType()).add("tokens", LongType())
    files = scratch.stage(rows.mapInArrow(_written(root, vocabulary, file_tokens, to_arrow_schema(types)), types))
    earlier = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return files.select("name", "documents", "tokens", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"), "id")


def read_tokens(manifest: DataFrame, root: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """A row per document of the files: id, start, n_tokens, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema

    manifest = Scratch(manifest.sparkSession).stage(manifest)
    whole = manifest.agg(F.sum("tokens")).first()[0] or 0
    types = manifest.select("id").schema
    for name in ("start", "n_tokens", "ids_crc32"):
        types = types.add(name, LongType())
    schema = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{folder}/{name}") as source:
                    file = TokenFile(source)
                    documents = file.documents()
                    counts = documents.column("n_tokens").to_numpy()
                    ends = np.cumsum(counts)
                    sums = np.empty(len(counts), np.int64)
                    at = 0
                    while at < len(counts):
                        begin = int(ends[at] - counts[at])
                        to = max(at + 1, int(np.searchsorted(ends, begin + READ_TOKENS, side="right")))
                        ids = file.tokens(begin, int(ends[to - 1])).astype("<u4")
                        for k in range(at, to):
                            sums[k] = zlib.crc32(ids[ends[k] - counts[k] - begin : ends[k] - begin])
                        at = to
                    columns = [documents.column("id").combine_chunks(), *(pa.array(x) for x in (base + ends - counts, counts, sums))]
                    yield from pa.Table.from_arrays(columns, schema=schema).to_batches(100_000)

    parts = manifest.select("name", "base").repartition(1 + int(whole // file_tokens), "name")
    return parts.mapInArrow(run, types)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = write_tokens(read_table(spark, sf_dir, "documents"), root)
    return read_tokens(manifest, root).withColumnRenamed("id", "doc_id")
