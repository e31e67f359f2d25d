"""Near duplicates by BagMinHash over multisets of five-word shingles.

A text is the multiset of its five-word shingles (shorter texts: one shingle of
all words). Each weight is cut into the levels [0, 1), [1, 2), [2, 4), [4, 8) ..
and each shingle and level has a Poisson process whose rate is the level's
width, seeded by both; a point falls on a step inside its level and counts if
that step is below the shingle's weight, and it falls on one of the signature's
registers, which keep their earliest point. Registers of two texts agree with
the probability of their weighted Jaccard similarity. A process is followed only
as long as a register can still be reached. Times are integers, so equal points
are equal in every task.

Signatures are cut into bands. Texts that share a band are candidates; at the
threshold itself a pair shares none of the bands with a probability of about
three in a million. Candidates are verified by the exact overlap of multisets:

1. every text with the smallest text of its buckets (one pair per text);
2. large buckets are joined into groups, and what step 1 did not link is
   compared with the whole group, in pairs of blocks of bounded size;
3. in small buckets, all pairs that no link connects yet.

Only pairs that links already connect are skipped, so classes are the connected
components of all candidate pairs at or over the threshold. Equal texts (the
same words in the same order) are one node from the start, so thousands of
copies cost one signature. No pair of copies is ever made a row.

Defined cases: texts without words are equal to each other; a null id is larger
than any other; of a class the smallest id stays, then the row stored first; an
empty table gives no rows. Columns of any name are returned with their values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from posloom.llm.common import KEY, Scratch, read_table, row_keyed, wrapped

WORDS = 5
BANDS = 32
ROWS = 5
REGISTERS = BANDS * ROWS
SIMILAR = (4, 5)  # 0.8 as a fraction
SMALL_BUCKET = 32
BLOCK_UNITS = 200_000
TEXTS_AT_ONCE = 250

_U = np.uint64
_ONE = 32  # bits after the point of a time
_GOLD = _U(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread function of 64-bit integers (the finaliser of splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of each different shingle, ordered by text and shingle."""
    import xxhash

    split = [t.split() for t in texts]  # ASCII white space only, for bytes
    sizes = np.asarray([len(w) for w in split], dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    codes = np.fromiter((digest(w) for words in split for w in words), _U, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    count = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(texts)), count)
    at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    end = np.repeat(first + sizes, count)
    out = np.zeros(len(text), _U)
    padded = np.concatenate([codes, np.zeros(WORDS, _U)])
    for k in range(WORDS):
        here = np.where(at + k < end, padded[at + k], _U(0))
        out = mixed(out ^ (here + _U(k)))
    order = np.lexsort((out, text))
    text, out = text[order], out[order]
    new = np.ones(len(out), bool)
    new[1:] = (text[1:] != text[:-1]) | (out[1:] != out[:-1])
    at = np.flatnonzero(new)
    return text[at], out[at], np.diff(np.append(at, len(out)))


def units(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's multiset as sorted distinct codes: one for each copy of a shingle."""
    text, code, weight = shingles(texts)
    which = np.repeat(np.arange(len(code)), weight)
    copy = np.arange(len(which)) - np.repeat(np.cumsum(weight) - weight, weight)
    codes = mixed(code[which] + copy.astype(_U) * _GOLD)
    ends = np.searchsorted(text[which], np.arange(len(texts) + 1))
    return [np.sort(codes[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def bag_signatures(text: np.ndarray, code: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """Earliest point of each register, for each of ``count`` texts; all-ones where a text has no shingle."""
    starts, shifts, owners = [np.zeros(len(code), np.int64)], [np.zeros(len(code), np.int64)], [np.arange(len(code))]
    level = 0
    while len(code) and (wide := np.flatnonzero(weight > (1 << level))).size:
        starts.append(np.full(len(wide), 1 << level))
        shifts.append(np.full(len(wide), level))
        owners.append(wide)
        level += 1
    start, shift, owner = np.concatenate(starts), np.concatenate(shifts), np.concatenate(owners)
    total = np.bincount(text, weights=weight, minlength=count)
    least = np.full(count * REGISTERS, np.iinfo(np.uint64).max, _U)
    reach = REGISTERS * (np.log(REGISTERS) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        limit = (reach * (1 << _ONE)).astype(_U)
        mine = np.flatnonzero(todo[text[owner]])
        _follow(
            text[owner[mine]], mixed(code[owner[mine]] + start[mine].astype(_U) * _GOLD), start[mine], shift[mine],
            weight[owner[mine]], limit, least,
        )
        todo &= (least.reshape(count, -1) == np.iinfo(np.uint64).max).any(axis=1)
        reach = reach * 2
    return least.reshape(count, -1)


def _follow(text, seed, start, shift, weight, limit, least) -> None:
    """Points of processes up to their text's limit, into the registers."""
    spent = np.zeros(len(seed), _U)
    index = np.zeros(len(seed), np.int64)
    while len(seed):
        bits = shift.astype(_U)
        ahead = ((limit[text] << bits) - spent) >> _U(_ONE)
        points = np.clip(ahead.astype(np.int64), 0, 4096) + 1
        which = np.repeat(np.arange(len(seed)), points)
        begin = np.cumsum(points) - points
        nth = np.arange(len(which)) - begin[which] + index[which]
        x = mixed(seed[which] + nth.astype(_U) * _GOLD)
        gaps = (-np.log(((x >> _U(11)).astype(float) + 0.5) * 2.0**-53) * (1 << _ONE)).astype(_U) + _U(1)
        sums = np.cumsum(gaps)
        when = spent[which] + sums - (sums[begin] - gaps[begin])[which]
        time = when >> bits[which]
        y = mixed(x ^ _GOLD)
        register = ((y >> _U(40)) % _U(REGISTERS)).astype(np.int64)
        step = (y & ((_U(1) << bits[which]) - _U(1))).astype(np.int64)
        good = (time <= limit[text[which]]) & (start[which] + step < weight[which])
        np.minimum.at(least, text[which[good]] * REGISTERS + register[good], time[good])
        spent, index = when[begin + points - 1], index + points
        on = (spent >> bits) <= limit[text]
        text, seed, start, shift, weight, spent, index = (a[on] for a in (text, seed, start, shift, weight, spent, index))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=_U), parts.shape[:2]).copy()
    for k in range(ROWS):
        out = mixed(out ^ parts[:, :, k])
    return out


def _signed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = [x.as_py() or b"" for x in part.column(3)]
                text, code, weight = shingles(texts)
                keys = band_keys(bag_signatures(text, code, weight, len(texts)))
                sizes = np.bincount(text, weights=weight, minlength=len(texts)).astype(np.int64)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]), pa.int32()),
                    pa.array(keys[sizes > 0].ravel().view(np.int64)),
                )
                node = pa.array([xxhash.xxh3_128_digest(b" ".join(t.split())) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), node, pa.array(sizes), bands], schema=schema
                )

    return run


def _contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Units, as bytes, of one stored row per node."""
    met = docs.join(wanted, KEY).select("node", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                packed = [u.tobytes() for u in units([x.as_py() for x in part.column(1)])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["node", "units"])

    return met.mapInArrow(run, "node binary, units binary")


def _similar(both: np.ndarray | int, one: int, other: np.ndarray | int):
    top, bottom = SIMILAR
    return bottom * both >= top * (one + other - both)


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` whose multisets overlap enough."""
    left = contents.select(F.col("node").alias("a"), F.col("units").alias("a_units"))
    right = contents.select(F.col("node").alias("b"), F.col("units").alias("b_units"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "a_units", "b_units")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(_similar(both, len(x), len(y))))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return met.mapInArrow(run, "a binary, b binary")


def _sizes_fit(a: str, b: str) -> Column:
    """No overlap can reach the threshold if the sizes are too far apart."""
    top, bottom = SIMILAR
    return F.least(a, b) * bottom >= F.greatest(a, b) * top


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of an edge.

    Labels take the smallest label among neighbours, then the label of their
    label; each round is staged. Rounds grow with the logarithm of distances.
    """
    both = scratch.stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = scratch.stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        lower = scratch.stage(lower)
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("next"))
        following = scratch.stage(
            lower.join(jump, "low").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
        )
        moved = following.filter("moved").limit(1).count()
        for old in (labels, lower):
            scratch.forget(old)
        labels = following
        if not moved:
            return labels.select("node", "label")


def _blocks(members: DataFrame, contents: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between blocks of each group, where they connect different labels.

    ``members`` has group, node, label and units. The members of a group's most
    frequent label stand in blocks of their own, which are not compared with
    each other; every other pair of blocks is.
    """
    counted = members.groupBy("group", "label").agg(F.count("*").alias("n"))
    main = counted.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    marked = members.join(main, "group").withColumn("is_main", F.col("label") == F.col("main")).drop("main")
    rooms = marked.groupBy("group").agg(
        F.ceil(F.sum(F.when(F.col("is_main"), F.col("size"))) / BLOCK_UNITS).alias("main_blocks"),
        F.coalesce(F.ceil(F.sum(F.when(~F.col("is_main"), F.col("size"))) / BLOCK_UNITS), F.lit(0)).alias("other_blocks"),
    )
    rooms = scratch.stage(rooms.filter("other_blocks > 0"))
    spread = F.xxhash64("node")
    placed = marked.join(rooms, "group").withColumn(
        "block",
        F.when(F.col("is_main"), F.col("other_blocks") + F.pmod(spread, F.col("main_blocks"))).otherwise(
            F.pmod(spread, F.col("other_blocks"))
        ),
    )
    blocks = scratch.stage(
        placed.select("group", "block", "node", "label")
        .join(contents, "node")
        .groupBy("group", "block")
        .agg(F.collect_list(F.struct("node", "label", "units")).alias("texts"))
    )
    one = rooms.select("group", "main_blocks", "other_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1)).alias("i"))
    pairs = one.select("group", "i", F.explode(F.sequence("i", F.col("other_blocks") + F.col("main_blocks") - 1)).alias("j"))
    met = pairs.join(
        blocks.select("group", F.col("block").alias("i"), F.col("texts").alias("left")), ["group", "i"]
    ).join(blocks.select("group", F.col("block").alias("j"), F.col("texts").alias("right")), ["group", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                links = _links(a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in links], pa.binary()), pa.array([y for _, y in links], pa.binary())], names=["a", "b"]
                )

    return met.select("left", "right").mapInArrow(run, "a binary, b binary")


def _links(left: list[dict], right: list[dict]) -> list[tuple[bytes, bytes]]:
    """Links that join different labels of two blocks; none that a chain of the others implies."""
    sides = [left, right]
    codes = [[np.frombuffer(t["units"], _U) for t in side] for side in sides]
    shared = np.intersect1d(*[np.unique(np.concatenate(c)) if c else np.zeros(0, _U) for c in codes], assume_unique=True)
    if not len(shared):
        return []
    overlap = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(shared), 4096):
        part = shared[low : low + 4096]
        grids = []
        for side in codes:
            grid = np.zeros((len(side), len(part)), np.float32)
            for row, units_ in enumerate(side):
                at = np.searchsorted(part, units_)
                at[at == len(part)] = 0
                grid[row, at[part[at] == units_]] = 1
            grids.append(grid)
        overlap += grids[0] @ grids[1].T
    both = overlap.astype(np.int64)
    size = [np.asarray([len(u) for u in side]) for side in codes]
    rows, columns = np.nonzero(_similar(both, size[0][:, None], size[1][None, :]))
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(rows.tolist(), columns.tolist()):
        x, y = root(left[i]["label"]), root(right[j]["label"])
        if x != y:
            parent[x] = y
            out.append((left[i]["node"], right[j]["node"]))
    return out


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, row key, class_id, class_size, kept."""
    scratch = Scratch(docs.sparkSession)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = row_keyed(docs.select(id_col, text_col), scratch).select(F.col(id_col).alias("id"), *KEY, data.alias("data"))
    rows = scratch.stage(_signed_rows(keyed))
    order = F.struct(*KEY)
    nodes = scratch.stage(
        rows.filter("size > 0").groupBy("node").agg(F.min_by(F.struct("size", "bands", *KEY), order).alias("row")).select("node", "row.*")
    )
    labels = _labels(keyed, nodes, scratch)
    grouped = rows.select("id", *KEY, "node").join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    first = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), *KEY)
    classes = grouped.groupBy("class").agg(F.min(first).alias("keep"), F.count("*").alias("n")).filter("n > 1")
    out = grouped.join(classes, "class", "left")
    alone = F.col("n").isNull()
    return out.select(
        F.col("id").alias(id_col),
        *KEY,
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("class_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("class_size"),
        (alone | (first == F.col("keep"))).alias("kept"),
    )


def _signed_rows(keyed: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    types = StructType(keyed.drop("data").schema.fields).add("node", BinaryType()).add("size", LongType())
    types = types.add("bands", ArrayType(LongType()))
    return keyed.select("id", *KEY, "data").mapInArrow(_signed(to_arrow_schema(types)), types)


def _labels(keyed: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Component of each node that any link reaches."""
    banded = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("hub")).filter("members > 1")
    members = scratch.stage(banded.join(shared, "bucket"))
    contents = scratch.stage(_contents(keyed, nodes.select("node", *KEY).join(members.select("node").distinct(), "node", "left_semi")))
    sizes = nodes.select(F.col("node").alias("a"), F.col("size").alias("a_size"))
    hubs = members.groupBy(F.col("node").alias("b"), F.col("size").alias("b_size")).agg(F.min("hub").alias("a")).filter("a <> b")
    stars = hubs.join(sizes, "a").filter(_sizes_fit("a_size", "b_size")).select("a", "b")
    links = scratch.stage(_verified(stars, contents))
    labels = components(links, scratch)

    large = members.filter(F.col("members") > SMALL_BUCKET)
    groups = components(_hub_edges(large), scratch)
    standing = (
        groups.withColumnRenamed("label", "group")
        .join(nodes.select("node", "size"), "node")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    labels = _relabelled(labels, _blocks(standing, contents, scratch), scratch)

    small = members.filter(F.col("members") <= SMALL_BUCKET).join(labels, "node", "left")
    small = small.select("bucket", "node", "size", F.coalesce("label", "node").alias("label"))
    mixed_ = small.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    small = scratch.stage(small.join(mixed_.select("bucket"), "bucket", "left_semi"))
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")))
    pairs = pairs.filter(_sizes_fit("x.size", "y.size")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    pairs = pairs.join(stars, ["a", "b"], "left_anti")
    return _relabelled(labels, _verified(pairs, contents), scratch)


def _hub_edges(members: DataFrame) -> DataFrame:
    """Edges that connect what buckets connect: a text with its smallest hub, and that hub with the text's others.

    A bucket's own hub is one of its texts, and pairs of hubs are few however many texts share them.
    """
    texts = members.groupBy("node").agg(F.min("hub").alias("least"), F.collect_set("hub").alias("hubs"))  # at most BANDS
    own = texts.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    between = texts.select(F.col("least").alias("a"), F.explode("hubs").alias("b")).filter("a <> b").distinct()
    return own.unionByName(between)


def _relabelled(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after further links: components of the labels that the links join, so old links are not walked again."""
    links = scratch.stage(links)
    for end in ("a", "b"):
        here = labels.select(F.col("node").alias(end), F.col("label").alias("_label"))
        links = links.join(here, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")
    joined = scratch.stage(components(links.filter("a <> b").distinct(), scratch))
    lower = joined.select(F.col("node").alias("label"), F.col("label").alias("low"))
    moved = labels.join(lower, "label", "left").select("node", F.coalesce("low", "label").alias("label"))
    fresh = joined.join(labels.select("node"), "node", "left_anti")
    return scratch.stage(moved.unionByName(fresh))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class; columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    keyed = wrapped(docs, scratch, id=id_col, text=text_col)
    dropped = near_classes(keyed.select("id", "text"), "id", "text").filter("NOT kept").select(*KEY)
    return keyed.join(dropped, KEY, "left_anti").select("doc.*")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents")).drop(*KEY)
