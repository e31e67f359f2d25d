"""Repeated substrings removed, by bucket-pointer refinement over sampled suffixes.

Which bytes does a ``LENGTH``-byte string cover that also starts elsewhere? A
suffix array has a row per byte; here suffixes are sampled first. In every
string of that length the ``GRAM``-byte piece with the smallest hash (the
leftmost of equal ones) is its sample, so equal strings have equal samples at
the same distance, and neighbouring strings mostly share one. A sample stands
for the strings that chose it: a range of distances from a string's start to it.

1. Initial buckets: samples with the same piece. A sample alone in its bucket
   has no string that is repeated, and leaves.
2. If all bytes around a sample that any string through it can reach occur
   around another sample as well, all its strings are repeated: settled.
3. Otherwise its range of distances is cut into seven. The strings of a part
   share more bytes, so a part's bucket identifier is that of the range with
   the identifiers of the bytes at the further offsets; samples alone in the new
   bucket leave, others are settled as in 2 or cut again, reusing the identifier.
   At a range of one distance the bucket is the string itself.

Only identifiers and positions are shuffled in 1 and 2; bytes around a sample
travel with it only where a repeat begins or ends. A bucket is reduced to its
smallest and largest member before the shuffle, so its size does not matter.

Identifiers are 128 bits of hash (64 for the initial buckets, whose members are
compared again). Defined cases: a null text is empty; texts shorter than the
length lose nothing; repeated rows repeat each other's strings; matches never
cross texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.llm.common import KEY, Scratch, read_table, row_keyed

LENGTH = 400
GRAM = 64  # a power of two
PARTS = 7
CHUNK = 1 << 20
PLACE_BITS = 22

_RANDOM = np.random.default_rng(20_011)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def widths(length: int = LENGTH, gram: int = GRAM) -> list[int]:
    """Sizes of the ranges of distances, from the first cut down to one."""
    out = [1]
    while out[-1] * PARTS < length - gram + 1:
        out.append(out[-1] * PARTS)
    return out[::-1]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes at every place, by doubling."""
    out, width, step = _BYTE_CODES[data], 1, 0
    while width < gram:
        out = out[:-width] * _STEPS[step] + out[width:]
        width, step = 2 * width, step + 1
    out ^= out >> np.uint64(29)
    out *= _STEPS[15]
    out ^= out >> np.uint64(32)
    return out


def sliding_smallest(values: np.ndarray, window: int) -> np.ndarray:
    """Smallest value of each window, from running minima within blocks."""
    padded = np.full(-(-len(values) // window) * window, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - window + 1
    return np.minimum(back[:count], ahead[window - 1 : window - 1 + count])


def samples(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Text, place, first and last string start, and hash of each sample in texts that lie side by side."""
    counts = np.maximum(ends - starts - length + 1, 0)
    if not counts.sum():
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data, gram)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    smallest = sliding_smallest(ranked, length - gram + 1)
    text = np.repeat(np.arange(len(starts)), counts)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    place = (smallest[begin] & mask).astype(np.int64)
    new = np.flatnonzero((place[1:] != place[:-1]) | (text[1:] != text[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(text)]]) - 1
    return text[first], place[first], begin[first], begin[last], hashes[place[first]]


def _sampled(length: int, gram: int, schema: pa.Schema):
    import xxhash

    reach = length - gram

    def groups(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
        """Texts, or overlapping stretches of long ones, up to a chunk at a time."""
        now, size = [], 0
        for row, text in enumerate(texts):
            at = 0
            while len(text) - at >= length:
                end = min(len(text), at + CHUNK)
                now.append((row, at, end))
                size += end - at
                if size >= CHUNK:
                    yield now
                    now, size = [], 0
                at = end - length + 1
        if now:
            yield now

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(2)]
            for group in groups(texts):
                data = np.frombuffer(b"".join([texts[r][a:b] for r, a, b in group]), np.uint8)
                sizes = np.asarray([b - a for _, a, b in group])
                ends = np.cumsum(sizes)
                which, place, low, high, code = samples(data, ends - sizes, ends, length, gram)
                rows = np.asarray([r for r, _, _ in group])[which]
                shift = np.asarray([a for _, a, _ in group])[which] - (ends - sizes)[which]
                at, near, far = place + shift, place - high, place - low
                around = bytearray()
                for r, a in zip(rows.tolist(), at.tolist()):
                    if a >= reach and a + length <= len(texts[r]):
                        around += xxhash.xxh3_128_digest(texts[r][a - reach : a + length])
                    else:  # no such bytes: an identifier of its own
                        around += b"\0" * 16
                hull = np.frombuffer(bytes(around), np.int64).reshape(-1, 2)
                keys = batch.select([0, 1]).take(pa.array(rows))
                columns = [pa.array(x) for x in (at, near, far, code.view(np.int64), hull[:, 0], hull[:, 1])]
                yield pa.RecordBatch.from_arrays([*keys.columns, *columns], schema=schema)

    return run


def _me() -> Column:
    return F.xxhash64(*KEY, "at")


def _shared(df: DataFrame, *ids: str) -> DataFrame:
    """Identifiers that two different samples have, with the smallest of these."""
    members = df.groupBy(*ids).agg(F.min(_me()).alias("chief"), F.max(_me()).alias("_most"))
    return members.filter("chief <> _most").drop("_most")


def _judged(df: DataFrame, *reach_ids: str) -> DataFrame:
    """``df`` with ``chief``: the first sample with the same surroundings, null if there is no other."""
    return df.join(_shared(df, *reach_ids), list(reach_ids), "left")


def _open(judged: DataFrame, *bucket: str) -> DataFrame:
    """Samples to refine: those not settled, and one of each settled kind in a bucket with such.

    A string of an open sample may repeat one of a settled sample, and equal
    surroundings need one member to compare with.
    """
    loose = judged.filter("chief IS NULL")
    kinds = judged.filter(F.col("chief") == _me()).join(loose.select(*bucket).distinct(), list(bucket), "left_semi")
    return loose.unionByName(kinds).drop("chief")


def _unless_inside(inside: Column, value: Column, salt: int) -> Column:
    return F.when(inside, value).otherwise(F.xxhash64(F.lit(salt), *KEY, "at"))


def _around(docs: DataFrame, open_: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes that strings through a sample can reach, for samples still open."""
    reach = length - gram
    places = open_.groupBy(*KEY).agg(F.collect_list(F.struct("at", "near", "far", "c1")).alias("places"))
    met = docs.join(places, KEY).select(*KEY, "data", "places")
    types = "_file long, _row long, at long, near long, far long, c1 long, c2 long, base long, bytes binary"
    schema = pa.schema(
        [(n, pa.int64()) for n in ("_file", "_row", "at", "near", "far", "c1", "c2", "base")] + [("bytes", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows = []
            for file, row, data, found in zip(*(batch.column(i) for i in range(4))):
                data = data.as_py()
                for p in found.as_py():
                    at = p["at"]
                    base = max(0, at - reach)
                    c2 = xxhash.xxh3_64_intdigest(data[at : at + gram], seed=9) - (1 << 63)
                    rows.append((file.as_py(), row.as_py(), at, p["near"], p["far"], p["c1"], c2, base, data[base : at + length]))
                if len(rows) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return met.mapInArrow(cut, types)


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans ``begin`` to ``end`` (by row key) of bytes that repeated strings cover.

    ``docs`` has the row key and ``data``, the text's bytes. Spans may overlap.
    """
    reach = length - gram
    longs = ("at", "near", "far", "c1", "h1", "h2")
    schema = pa.schema([(n, pa.int64()) for n in (*KEY, *longs)])
    found = docs.select(*KEY, "data").mapInArrow(
        _sampled(length, gram, schema), ", ".join(f"{n} long" for n in (*KEY, *longs))
    )
    found = scratch.stage(found)
    inside = (F.col("h1") != 0) | (F.col("h2") != 0)
    known = found.withColumns({"h1": _unless_inside(inside, F.col("h1"), 1), "h2": _unless_inside(inside, F.col("h2"), 2)})
    same = scratch.stage(known.join(_shared(known, "c1"), "c1", "left_semi"))
    scratch.forget(found)
    judged = scratch.stage(_judged(same, "h1", "h2").drop("h1", "h2"))
    scratch.forget(same)
    spans = judged.filter("chief IS NOT NULL").select(
        *KEY, (F.col("at") - reach).alias("begin"), (F.col("at") + length).alias("end")
    )
    active = scratch.stage(_around(docs, _open(judged, "c1"), length, gram).withColumn("low", F.lit(0).cast("long")))
    wide = reach + 1
    for width in widths(length, gram):
        cut = scratch.stage(_cut(active, wide, width, length, reach).drop("bytes", "base"))
        parts = cut
        if width > 1:
            parts = parts.join(_shared(parts, "low", "c1", "c2"), ["low", "c1", "c2"], "left_semi")
        parts = scratch.stage(_judged(parts, "low", "h1", "h2").drop("h1", "h2"))
        scratch.forget(cut)
        top = F.least(F.col("low") + (width - 1), F.lit(reach))
        spans = spans.unionByName(
            parts.filter("chief IS NOT NULL").select(*KEY, (F.col("at") - top).alias("begin"), (F.col("at") - F.col("low") + length).alias("end"))
        )
        if width > 1:
            open_ = _open(parts, "low", "c1", "c2")
            bytes_ = active.select(*KEY, "at", "near", F.col("low").alias("parent"), "base", "bytes")
            open_ = open_.withColumn("parent", F.col("low") - F.col("low") % wide if wide <= reach else F.lit(0).cast("long"))
            earlier = active
            active = scratch.stage(open_.join(bytes_, [*KEY, "at", "near", "parent"]).drop("parent"))
            scratch.forget(earlier)
            wide = width
    return spans


def _cut(active: DataFrame, wide: int, width: int, length: int, reach: int) -> DataFrame:
    """Parts of each range, with the identifiers of what their strings share (c) and reach (h)."""
    last = F.least(F.col("low") + (wide - 1), F.lit(reach))
    first_part = F.floor(F.greatest(F.col("near"), F.col("low")) / width)
    last_part = F.floor(F.least(F.col("far"), last) / width)
    cut = active.withColumn("was", F.col("low")).withColumn("part", F.explode(F.sequence(first_part, last_part)))
    low, was = F.col("part") * width, F.col("was")
    high = F.least(low + (width - 1), F.lit(reach))
    was_high = F.least(was + (wide - 1), F.lit(reach))
    at = F.col("at") - F.col("base")

    def piece(begin: Column, end: Column) -> Column:
        return F.substring(F.col("bytes"), (begin + 1).cast("int"), (end - begin).cast("int"))

    before = piece(at - low, at - was)
    after = piece(at + length - was_high, at + length - high)
    hull = piece(at - high, at + length - low)
    inside = (at - high >= 0) & (at + length - low <= F.octet_length("bytes"))
    return cut.select(
        *KEY, "at", "near", "far", "base", "bytes",
        low.cast("long").alias("low"),
        F.xxhash64("c1", low, before, after).alias("c1"),
        F.xxhash64("c2", F.lit(1), low, before, after).alias("c2"),
        _unless_inside(inside, F.xxhash64(low, hull), 1).alias("h1"),
        _unless_inside(inside, F.xxhash64(F.lit(1), low, hull), 2).alias("h2"),
    )


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, with_kept: bool = True) -> DataFrame:
    """A row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes, if asked for)."""
    scratch = Scratch(docs.sparkSession)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = row_keyed(docs.select(id_col, text_col), scratch).select(F.col(id_col).alias("id"), *KEY, data.alias("data"))
    spans = repeated_spans(keyed, scratch, length, gram)
    by_row = spans.groupBy(*KEY).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    met = keyed.join(by_row, KEY, "left").select("id", "data", "spans")
    from pyspark.sql.pandas.types import to_arrow_schema

    types = met.select("id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    types = types.add("kept_sha256", "string")
    if with_kept:
        types = types.add("kept", "binary")
    schema = to_arrow_schema(types)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, spans in zip(batch.column(1), batch.column(2)):
                data, gone = data.as_py(), _merged(spans.as_py() or [])
                edges = [0, *[x for span in gone for x in span], len(data)]
                kept = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])]) if gone else data
                out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:])] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return met.mapInArrow(remove, types).withColumnRenamed("id", id_col)


def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents"), with_kept=False)
