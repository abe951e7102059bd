"""N-gram Jaccard join by vertical partitioning.

1. Each document becomes its set of word shingles. A fixed-size sketch counts shingles by
   the top bits of their hash; ordering the cells by count gives one global order, rarest
   first. The order steers cost only: any order finds the same links.
2. Documents with equal sets form a class; the rest works on classes.
3. Classes that share a shingle among the first n - ceil(t n) + 1 of their order are
   candidates; size and position bounds drop those that cannot reach the threshold. Few
   classes around a shingle are all paired. Many are first paired with the one of least
   name, mostly the same in all groups of a cluster; after linking, pairs across different components follow, so no pair that
   could join two components is left out.
4. The parities of a set, a bit or two for each shingle, bound from below by how many
   shingles two sets differ. Pairs that differ by too many go before any shingle moves.
5. The global order is cut into fragments of equal weight. Each fragment counts the
   partial overlap of every pair that is left, and the counts are summed per pair.
6. Groups that would still give more than PAIRS_PER_MEMBER pairs per class go by their
   differences from a centre, the shingles that most of a few members hold. Classes near
   the centre link with the nearest one, which needs no comparison; others can only link
   across components if they share one of their first differences, rarely a long list.
   The choice of the centre steers cost only.
7. Verified links give connected components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize
from . import textual
from .components import components
from .katz import pack, unpack

CELL_BITS = 20
CELLS = 1 << CELL_BITS
PARTS = 256
FRAGMENTS = 8
BITMAP_BITS = 26
SMALL_GROUP = 3
PAIRS_PER_MEMBER = 2
CENTRE_SAMPLE = 9
PAIR_BLOCK = 200_000
TASK_BYTES = 24 << 20

_LOW = np.uint64((1 << (64 - CELL_BITS)) - 1)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash) ordered by both, set sizes, and a 64-bit name of each set (0: empty)."""
    w = textual.words_of(texts)
    text, value = textual.shingles(w.hashes(), w.counts, width)
    sizes = np.bincount(text, minlength=len(w.counts))
    name = np.zeros(len(sizes), dtype=np.uint64)
    full = sizes > 0
    if full.any():
        starts = np.cumsum(sizes) - sizes
        name[full] = textual.mix(np.add.reduceat(textual.mix(value), starts[full]) ^ sizes[full].astype(np.uint64))
    return text, value, sizes, name.view(np.int64)


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """Rows of documents (doc_id, print of the text, n, name) and, with ``part`` set, slices of each task's counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "print", "n", "name", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.uint32)
        doc_type = None
        for s in textual.slices(batches):
            _, value, sizes, name = shingle_sets(s.column("text"), width)
            counts += np.bincount((value >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            doc_type = s.schema.field("doc_id").type
            none = pa.nulls(s.num_rows, pa.int32()), pa.nulls(s.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("print"), pa.array(sizes, pa.int64()), pa.array(name), *none], names)
        if doc_type is not None:
            pieces = [pack(c) for c in counts.reshape(PARTS, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, doc_type), *[pa.nulls(PARTS, pa.int64())] * 3, pa.array(range(PARTS), pa.int32()), pa.array(pieces, pa.binary())], names
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    return rows.mapInArrow(run, f"doc_id {kind}, print bigint, n bigint, name bigint, part int, counts binary")


def global_order(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each cell, rarest first, and its fragment; both of fixed size."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // PARTS, dtype=np.int64)
        for piece in table.column("counts").to_pylist():
            total += unpack(piece)
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    counts = np.zeros((PARTS, CELLS // PARTS), dtype=np.int64)
    summed = sets.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary")
    for row in summed.toLocalIterator():  # PARTS rows, 8 MB in all
        counts[row.part] = np.frombuffer(bytes(row.counts), dtype=np.int64)
    flat = counts.ravel()
    order = np.argsort(flat, kind="stable")
    rank = np.empty(CELLS, dtype=np.uint32)
    rank[order] = np.arange(CELLS, dtype=np.uint32)
    weight = np.cumsum(flat[order]) - flat[order]
    fragment = np.empty(CELLS, dtype=np.uint8)
    fragment[order] = np.minimum(weight * FRAGMENTS // max(int(flat.sum()), 1), FRAGMENTS - 1)
    return rank, fragment


def in_order(value: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A shingle's place in the global order: the rank of its cell, then its other bits (one to one)."""
    cell = (value >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    return (rank[cell].astype(np.uint64) << np.uint64(64 - CELL_BITS)) | (value & _LOW)


def prefix_entries(docs: DataFrame, width: int, num: int, den: int, rank, buckets: int) -> DataFrame:
    """(bucket, entries): first shingles of each set with set name, position and size, dealt by shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            e = np.unique(np.concatenate(held), axis=None)  # copies within the task count once
            to = (textual.mix(e["at"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            e, to = e[order], to[order]
            used, first = np.unique(to, return_index=True)
            pieces = [x.tobytes() for x in np.split(e, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(pieces, pa.binary())], ["bucket", "entries"])

        for s in textual.slices(batches):
            text, value, sizes, name = shingle_sets(s.column("text"), width)
            at = in_order(value, shared.value)
            order = np.lexsort((at, text))
            text, at = text[order], at[order]
            place = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[text]
            n = sizes[text]
            keep = place < n - -(-n * num // den) + 1
            e = np.zeros(int(keep.sum()), dtype=ENTRY)
            e["at"], e["name"], e["place"], e["n"] = at[keep], name[text[keep]], place[keep], n[keep]
            held.append(e)
            size += len(s.column("text")) and textual.raw_bytes(s.column("text"))[0].size
            if size > TASK_BYTES:
                yield out()
                held, size = [], 0
        if sum(map(len, held)):
            yield out()

    return docs.select("text").mapInArrow(run, "bucket int, entries binary")


GROUP_FIELDS = (("at", "<i8", pa.int64()), ("name", "<i8", pa.int64()), ("place", "<i4", pa.int32()), ("n", "<i4", pa.int32()))
ENTRY = np.dtype([("at", "<u8"), ("name", "<i8"), ("place", "<i4"), ("n", "<i4")])


def may_reach(n1, p1, n2, p2, num: int, den: int) -> np.ndarray:
    """Whether two sets of these sizes, whose first common shingle has these places, can reach the threshold."""
    low, high = np.minimum(n1, n2), np.maximum(n1, n2)
    need = -(-(num * (n1 + n2)) // (num + den))
    return (den * low >= num * high) & (np.minimum(n1 - p1, n2 - p2) >= need)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.stack([a, b], axis=1)
    return np.unique(out, axis=0) if len(out) else out


def pair_bucket(table: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """First candidate pairs of a bucket, leader first, and the entries of the large groups.

    The leader of a group is its least name: the groups of a cluster mostly agree on it, so
    a class is paired with few leaders and not with one for each of its shingles.
    """
    e = np.concatenate([np.frombuffer(x, dtype=ENTRY) for x in table.column("entries").to_pylist()])
    e = e[np.lexsort((e["n"], e["place"], e["name"], e["at"]))]
    same = np.concatenate([[False], (e["at"][1:] == e["at"][:-1]) & (e["name"][1:] == e["name"][:-1])])
    e = e[~same]
    starts = np.flatnonzero(np.concatenate([[True], e["at"][1:] != e["at"][:-1]]))
    sizes = np.diff(np.append(starts, len(e)))
    left, right = [], []
    for size in range(2, SMALL_GROUP + 1):
        at = starts[sizes == size]
        if len(at):
            i, j = np.triu_indices(size, 1)
            left.append((at[:, None] + i).ravel())
            right.append((at[:, None] + j).ravel())
    big = sizes > SMALL_GROUP
    grouped = np.repeat(big, sizes)
    leader = np.repeat(starts, sizes)[grouped]
    left.append(leader)
    right.append(np.flatnonzero(grouped))
    i, j = np.concatenate(left), np.concatenate(right)
    ok = (i != j) & may_reach(e["n"][i].astype(np.int64), e["place"][i], e["n"][j].astype(np.int64), e["place"][j], num, den)
    return _pairs(e["name"][i[ok]], e["name"][j[ok]]), e[grouped]


def cross_pairs(n: np.ndarray, place: np.ndarray, name: np.ndarray, root: np.ndarray, num: int, den: int) -> Iterator[np.ndarray]:
    """Candidate pairs of one group whose components differ, in blocks."""
    if (root == root[0]).all():
        return
    shape, of = np.unique(n * (1 << 24) + place, return_inverse=True)
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of))
    sn, sp = shape >> 24, shape & ((1 << 24) - 1)
    for k in range(len(shape)):
        fits = k + np.flatnonzero(may_reach(sn[k], sp[k], sn[k:], sp[k:], num, den))
        if not len(fits):
            continue
        mine = order[ends[k - 1] if k else 0 : ends[k]]
        theirs = np.concatenate([order[ends[f - 1] if f else 0 : ends[f]] for f in fits])
        step = max(1, PAIR_BLOCK // len(theirs))
        for at in range(0, len(mine), step):
            rows = mine[at : at + step]
            i, j = np.nonzero(root[rows][:, None] != root[theirs][None, :])
            if len(i):
                a, b = name[rows[i]], name[theirs[j]]
                yield _pairs(np.minimum(a, b), np.maximum(a, b))


def crossing(n: np.ndarray, place: np.ndarray, root: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which classes of one group have a candidate of another component, without pairing them."""
    shape, of = np.unique(n * (1 << 24) + place, return_inverse=True)
    order = np.argsort(of, kind="stable")
    starts = np.cumsum(np.bincount(of)) - np.bincount(of)
    low, high = np.minimum.reduceat(root[order], starts), np.maximum.reduceat(root[order], starts)
    sn, sp = shape >> 24, shape & ((1 << 24) - 1)
    out = np.zeros(len(n), dtype=bool)
    for k in range(len(shape)):
        fits = may_reach(sn[k], sp[k], sn, sp, num, den)
        if fits.any():
            mine = order[starts[k] : starts[k + 1] if k + 1 < len(shape) else len(n)]
            out[mine] = (root[mine] != low[fits].min()) | (root[mine] != high[fits].max())
    return out


def few_or_members(n: np.ndarray, place: np.ndarray, name: np.ndarray, root: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of one group across components, or, of more than PAIRS_PER_MEMBER a class, the classes concerned."""
    blocks, held = [], 0
    for block in cross_pairs(n, place, name, root, num, den):
        blocks.append(block)
        held += len(block)
        if held > PAIRS_PER_MEMBER * len(name):
            return np.zeros((0, 2), dtype=np.int64), np.flatnonzero(crossing(n, place, root, num, den))
    return (np.concatenate(blocks) if blocks else np.zeros((0, 2), dtype=np.int64)), np.zeros(0, dtype=np.int64)


def _pair_batch(pairs: np.ndarray) -> dict[str, pa.Array]:
    return {"x": pa.array(pairs[:, 0], pa.int64()), "y": pa.array(pairs[:, 1], pa.int64())}


def bitmap(keys: DataFrame) -> np.ndarray:
    """Packed bits, 8 MB whatever the input: the places that ``keys`` (one bigint ``key``) fall on."""
    width = 1 << (BITMAP_BITS - 8)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
        for batch in batches:
            cell = _cell_of(batch.column("key").to_numpy())
            np.bitwise_or.at(bits, cell >> 3, (128 >> (cell & 7)).astype(np.uint8))
        # A row for each part of the bitmap that the task marked.
        for k, part in enumerate(bits.reshape(256, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["part", "bits"])

    def join(table: pa.Table) -> pa.Table:
        bits = np.zeros(width // 8, dtype=np.uint8)
        for piece in table.column("bits").to_pylist():
            bits |= np.frombuffer(piece, dtype=np.uint8)
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    out = np.zeros((256, width // 8), dtype=np.uint8)
    marked = keys.coalesce(64).mapInArrow(mark, "part int, bits binary")
    for row in marked.groupBy("part").applyInArrow(join, "part int, bits binary").collect():  # 256 rows at most
        out[row.part] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return out.ravel()


def _cell_of(key: np.ndarray) -> np.ndarray:
    return (textual.mix(key.view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, key: np.ndarray) -> pa.Array:
    cell = _cell_of(key)
    return pa.array((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1)


def _wanted(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(_marked(bits, batch.column("key").to_numpy()))


def parities(text: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words of each text's parities, run together, and their number per text.

    A set of n shingles has the least power of two of bits, 64 at least, that is not under
    n; a bit tells whether an odd number of shingles ends in its place.
    """
    words = 1 << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64)
    first = (np.cumsum(words) - words) * 64
    place = first[text] + (value & (words[text] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=int(words.sum()) * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64), words


def signatures(docs: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    """(name, n, signature): the parities of the documents marked in ``bits``."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in textual.slices(_wanted(batches, shared.value)):
            text, value, sizes, name = shingle_sets(s.column("text"), width)
            odd, words = parities(text, value, sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(words)]), pa.int32()), pa.array(odd))
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(sizes, pa.int64()), lists], ["name", "n", "signature"])

    return docs.select("text", F.xxhash64("doc_id").alias("key")).mapInArrow(run, "name bigint, n bigint, signature array<bigint>")


def segments(docs: DataFrame, bits: np.ndarray, width: int, rank, fragment) -> DataFrame:
    """(name, fragment, n, part): the shingles of the documents marked in ``bits``, one row per fragment.

    The bitmap saves moving texts; the few documents that only share a place with a
    wanted one are harmless.
    """
    shared = docs.sparkSession.sparkContext.broadcast((rank, fragment, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, fragment, bits = shared.value
        for s in textual.slices(_wanted(batches, bits)):
            text, value, sizes, name = shingle_sets(s.column("text"), width)
            part = fragment[(value >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            value = in_order(value, rank).view(np.int64)
            key = text * FRAGMENTS + part
            order = np.argsort(key, kind="stable")
            ends = np.cumsum(np.bincount(key, minlength=s.num_rows * FRAGMENTS))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(value[order]))
            of = np.repeat(np.arange(s.num_rows), FRAGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[of]), pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), s.num_rows)), pa.array(sizes[of], pa.int64()), lists],
                ["name", "fragment", "n", "part"],
            )

    return docs.select("text", F.xxhash64("doc_id").alias("key")).mapInArrow(run, "name bigint, fragment int, n bigint, part array<bigint>")


def plausible(pairs: DataFrame, signatures_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """Pairs (x, y) but for those whose parities show that they cannot reach the threshold.

    A place where parities differ holds a shingle of one set only, so two sets differ by as
    many shingles at least. The longer signature is folded to the length of the shorter.
    """
    names = pairs.select(F.col("x").alias("name")).union(pairs.select("y"))
    signed = materialize(signatures_of(names).dropDuplicates(["name"]), "signatures")
    side = lambda x: signed.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("signature").alias(f"s{x}"))
    both = pairs.join(side("y"), "y").join(side("x"), "x").withColumn("both", F.concat("sx", "sy"))
    # Lengths are powers of two: words that fall on one another stand a whole number of the shorter length apart.
    words = F.least(F.size("sx"), F.size("sy"))
    none = F.lit(0).cast("bigint")
    folded = lambda i: F.aggregate(F.sequence(i, F.size("both"), words), none, lambda odd, k: odd.bitwiseXOR(F.element_at("both", k)))
    apart = F.aggregate(F.transform(F.sequence(F.lit(1), words), folded), none, lambda total, word: total + F.bit_count(word))
    return materialize(both.where(_links_at(apart, F.col("nx") + F.col("ny"), num, den)).select("x", "y"), "plausible-pairs")


def verified(pairs: DataFrame, parts_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """Pairs (x, y) that reach the threshold: partial overlaps by fragment, summed per pair.

    ``parts_of`` gives the segments of some classes (name). They are cut anew from the
    texts each time: reading again is cheaper than keeping sets on disk.
    """
    cut = pairs.select("x", "y", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"))
    mine = parts_of(pairs.select(F.col("x").alias("name"))).select(F.col("name").alias("x"), "fragment", F.col("n").alias("nx"), F.col("part").alias("px"))
    theirs = parts_of(pairs.select(F.col("y").alias("name"))).select(F.col("name").alias("y"), "fragment", F.col("n").alias("ny"), F.col("part").alias("py"))
    partial = (
        cut.join(theirs, ["y", "fragment"]).join(mine, ["x", "fragment"])
        .select("x", "y", "fragment", "nx", "ny", F.size(F.array_intersect("px", "py")).cast("bigint").alias("common"))
    )
    # Copies of a class give the same partial overlap again.
    once = partial.groupBy("x", "y", "nx", "ny", "fragment").agg(F.max("common").alias("common"))
    return (
        once.groupBy("x", "y", "nx", "ny").agg(F.sum("common").alias("common"))
        .where(F.col("common") * den >= (F.col("nx") + F.col("ny") - F.col("common")) * num)
        .select("x", "y")
    )


def differences(members: DataFrame, parts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(centre, name, n, apart): what sets the classes ``members`` (centre, name, n) apart from their centre.

    A centre holds the shingles that more than half of CENTRE_SAMPLE of its members have.
    ``apart`` lists shingles outside the centre first, then those of it that the class
    lacks, both by the global order: one order for all members of a centre.
    """
    parts = materialize(parts_of(members.select("name")).dropDuplicates(["name", "fragment"]).select("name", "fragment", "part"), "member-parts")
    least = Window.partitionBy("centre").orderBy("name")
    sample = members.withColumn("place", F.row_number().over(least)).where(F.col("place") <= CENTRE_SAMPLE).select("centre", "name")
    held = parts.join(sample, "name").groupBy("centre", "fragment").agg(F.sort_array(F.flatten(F.collect_list("part"))).alias("held"), F.count("*").alias("sets"))
    # In sorted lists a value stands k times if it stands again k - 1 places on.
    again = F.filter("held", lambda x, i: F.get("held", (i + F.floor(F.col("sets") / 2)).cast("int")) == x)
    centre = held.select("centre", "fragment", F.array_distinct(again).alias("most"))
    in_turn = lambda lists: F.sort_array(F.flatten(F.collect_list(F.transform(lists, lambda x: x.bitwiseXOR(F.lit(-(1 << 63)))))))  # noqa: E731  as unsigned
    return (
        members.join(parts, "name").join(centre, ["centre", "fragment"]).groupBy("centre", "name", "n")
        .agg(in_turn(F.array_except("part", "most")).alias("more"), in_turn(F.array_except("most", "part")).alias("fewer"))
        .select("centre", "name", F.col("n").cast("bigint").alias("n"), F.concat("more", "fewer").alias("apart"))
    )


def _links_at(apart: Column, sizes: Column, num: int, den: int) -> Column:
    """Whether two sets of these sizes, together, link if so many shingles are in one of them only."""
    return apart * (den + num) <= sizes * (den - num)


def near_centre(apart: DataFrame, num: int, den: int) -> DataFrame:
    """Links (x, y) of the classes near a centre with the nearest one.

    Two sets differ by at most the sum of what sets them apart from the centre. Where that
    sum is small enough for a pair, it is for each of the two with the nearest class too.
    """
    far = apart.select("centre", "name", "n", F.size("apart").cast("bigint").alias("d"))
    far = far.withColumn("far", F.col("d") * (den + num) - F.col("n") * (den - num))
    nearest = far.groupBy("centre").agg(F.min(F.struct("far", "name", "n", "d")).alias("near"))
    near = far.join(nearest, "centre").where(F.col("name") != F.col("near.name"))
    near = near.where(_links_at(F.col("d") + F.col("near.d"), F.col("n") + F.col("near.n"), num, den))
    return near.select(F.least("name", "near.name").alias("x"), F.greatest("name", "near.name").alias("y"))


def across(apart: DataFrame, roots: DataFrame, num: int, den: int) -> DataFrame:
    """Links (x, y) between members of a centre whose components (node, root) differ and whose differences meet.

    Linked sets differ by at most n (den - num) / num shingles, so their first common
    difference has at most so many before it.
    """
    known = apart.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    open_ = known.groupBy("centre").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("centre")
    first = F.slice("apart", F.lit(1), F.expr(f"cast(n * {den - num} div {num} + 1 as int)"))
    rows = known.join(open_, "centre", "left_semi").select(
        "centre", "name", "n", "root", F.size("apart").cast("bigint").alias("d"), F.posexplode(first).alias("at", "token")
    )
    a, b = rows.alias("a"), rows.alias("b")
    rest = F.abs((F.col("a.d") - F.col("a.at")) - (F.col("b.d") - F.col("b.at")))
    meet = (
        (F.col("a.centre") == F.col("b.centre")) & (F.col("a.token") == F.col("b.token")) & (F.col("a.name") < F.col("b.name"))
        & (F.col("a.root") != F.col("b.root")) & _links_at(F.col("a.at") + F.col("b.at") + rest, F.col("a.n") + F.col("b.n"), num, den)
    )
    pairs = a.join(b, meet).groupBy(F.col("a.name").alias("x"), F.col("b.name").alias("y")).agg(F.min("a.centre").alias("centre"))
    side = lambda x: apart.select("centre", F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("apart").alias(f"a{x}"))
    differ = F.size("ax") + F.size("ay") - 2 * F.size(F.array_intersect("ax", "ay"))
    both = pairs.join(side("x"), ["centre", "x"]).join(side("y"), ["centre", "y"])
    return both.where(_links_at(differ.cast("bigint"), F.col("nx") + F.col("ny"), num, den)).select("x", "y")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after more ``links`` (x, y)."""
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links.select("x", "y")))


def link(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id and text_print (xxhash64 of the text) of every row of ``docs`` (doc_id, text).

    Two documents link when den * |intersection| >= num * |union| of their shingle sets;
    component_id is the smallest doc_id reachable by links. A null text, or one without
    words, has an empty set, links with nothing and is its own component; a text with
    fewer words than ``width`` has its whole sequence as one shingle. Sets and shingles
    are named by 64-bit hashes. Rows that repeat a doc_id are kept, each with its set.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = materialize(set_table(docs, width), "shingle-sets")
    rank, fragment = global_order(sets)
    rows = sets.where("part is null").select("doc_id", "print", "n", "name")
    classes = rows.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("doc_id"))

    def first_round(table: pa.Table) -> pa.Table:
        pairs, big = pair_bucket(table, num, den)
        shown = {k: pa.array(np.ascontiguousarray(big[k]).view(t), t_pa) for k, t, t_pa in GROUP_FIELDS}
        pairs = _pair_batch(pairs)
        return pa.concat_tables([pa.table(pairs), pa.table(shown)], promote_options="default").select(["x", "y", *shown])

    dealt = prefix_entries(docs, width, num, den, rank, buckets).groupBy("bucket")
    found = materialize(dealt.applyInArrow(first_round, "x bigint, y bigint, at bigint, name bigint, place int, n int"), "candidates")
    first = materialize(found.where("x is not null").select("x", "y").distinct(), "first-pairs")
    repeated = not rows.where("n > 0").groupBy("name", "doc_id").count().where("count > 1").isEmpty()

    def marks_of(names: DataFrame) -> np.ndarray:
        return bitmap(names.distinct().join(classes, "name").select(F.xxhash64("doc_id").alias("key")))

    def signatures_of(names: DataFrame) -> DataFrame:
        return signatures(docs, marks_of(names), width)

    def parts_of(names: DataFrame) -> DataFrame:
        parts = segments(docs, marks_of(names), width, rank, fragment)
        return parts.dropDuplicates(["name", "fragment"]) if repeated else parts

    links = materialize(verified(plausible(first, signatures_of, num, den), parts_of, num, den), "first-links")
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))

    def second_round(table: pa.Table) -> pa.Table:
        n, place, name, root = (table.column(c).to_numpy() for c in ("n", "place", "name", "root"))
        pairs, members = few_or_members(n.astype(np.int64), place.astype(np.int64), name, root, num, den)
        shown = {"centre": np.full(len(members), name.min()), "name": name[members], "n": n[members]}
        return pa.concat_tables([pa.table(_pair_batch(pairs)), pa.table(shown)], promote_options="default").select(["x", "y", *shown])

    big = found.where("x is null").select("at", "name", "place", "n").join(roots.withColumnRenamed("node", "name"), "name", "left")
    big = big.select("at", "name", "place", "n", F.coalesce("root", "name").alias("root"))
    mixed = big.groupBy("at").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("at")
    more = big.join(mixed, "at", "left_semi").groupBy("at").applyInArrow(second_round, "x bigint, y bigint, centre bigint, name bigint, n int")
    more = materialize(more.distinct(), "second-round")
    pairs = materialize(more.where("x is not null").select("x", "y").join(first, ["x", "y"], "left_anti"), "second-pairs")
    links = verified(plausible(pairs, signatures_of, num, den), parts_of, num, den)
    members = more.where("x is null").select("centre", "name", "n")
    if members.isEmpty():
        roots = joined(roots, links)
    else:
        apart = materialize(differences(members, parts_of), "differences")
        roots = joined(roots, links.union(near_centre(apart, num, den)))
        roots = joined(roots, materialize(across(apart, roots, num, den), "crossing-links"))
    placed = classes.join(roots.withColumnRenamed("node", "name"), "name", "left").select("name", "doc_id", F.coalesce("root", "name").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = placed.select("name", "root").join(least, "root").select("name", "component_id")
    return rows.join(of_class, "name", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("print").alias("text_print")
    )


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is the smallest of their group of near copies.

    Rows that share doc_id and text are one document and stay or go together; a null
    doc_id stays.
    """
    linked = materialize(link(docs, width, num, den), "linked")
    doomed = linked.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"), F.col("text_print").alias("gone_print")).distinct()
    return docs.join(doomed, (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_print")), "left_anti")
