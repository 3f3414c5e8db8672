"""Exact self-join of documents on the Jaccard similarity of their word shingles.

Jaccard distance is a metric, and the join works by pivots and windows in it:

* Pivots of the first level are single shingles. Of the shingles that a set
  holds, which are all its nearest such pivots, the rarest is its own region;
  a set within the distance limit can differ in a bounded share of its
  shingles, so its region lies among the ``window`` rarest shingles, and the
  set is replicated to those regions. A shingle of one set only needs no
  region. A set whose window holds such shingles alone links with nothing.
* Within a region a member is the pivot of the next level. By the triangle
  inequality two members can link only if their distances to it differ by the
  limit at most. Members within twice the limit stay with the pivot; those
  farther away, with the near ones that reach into their window, form the
  region that is joined next, and so on while pivots divide the regions. Sets
  that share next to nothing with any pivot are not divided by them (all
  distances are near one): what such regions leave is compared exactly, block
  by block.

Shingles that more than a hundred-thousandth of all sets hold come last in
every window, so they need no count and no task sees all their sets. Equal sets are one class throughout. Shingle counts come from all documents,
shuffled as packed arrays, one per range of shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.components import connected_components
from timeloom.llm.runtime import cut, map_arrow, per_group, slices, text_of
from timeloom.llm.textarrays import joined, mix, span_hashes

LOW = 40  # bits of a shingle hash below its range
BLOCK = 512  # sets compared at a time
BLOCK_SHINGLES = 2_000_000  # and shingles that they hold, but for a set that holds more alone
SLICE = 1_000_000  # shingles of a block laid out at a time
SMALL = 48  # members of a region that is compared whole at once
SHRINK = 0.75  # of a region's members that the next pivot may leave; where pivots divide less, the rest is compared whole, block by block
FLUSH = 1_000_000  # shingles packed at a time
SEEN = 16  # sets of one flush that must hold a shingle for it to be counted as one that may be hot
MOST = 100_000  # hot shingles, and heavy classes, at most: each has more than this share of all
LEAST = 4_096  # sets or documents that a hot shingle or a heavy class has at least
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def shingle_sets(texts: list[str], words: int = 5) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles.

    Words are runs of anything but ASCII white space, A-Z read as a-z. A text
    of fewer words has its whole sequence as one shingle, one without words
    an empty set.
    """
    points, offsets = joined(texts)
    points = np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    n = len(points)
    if not n:
        return [np.zeros(0, np.uint64) for _ in texts]
    opens = np.zeros(n + 1, bool)
    opens[offsets] = True
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1] | opens[1:-1])))
    last = np.flatnonzero(~space & np.concatenate((space[1:] | opens[1:-1], [True]))) + 1
    hashed = span_hashes(points, first, last)
    bounds = np.searchsorted(first, offsets)
    out = []
    with np.errstate(over="ignore"):
        steps = [np.uint64(pow(int(_STEPS[j % 5]), 1 + j // 5, 1 << 64)) for j in range(words)]
        whole = np.zeros(max(0, len(hashed) - words + 1), np.uint64)
        for j in range(words):
            whole += hashed[j : j + len(whole)] * steps[j]
        whole = mix(whole)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= words:
                out.append(np.unique(whole[a : b - words + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for j in range(b - a):
                    short += hashed[a + j] * steps[j]
                out.append(mix(np.array([short], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _slice(values: np.ndarray, number: int, of: int) -> np.ndarray:
    return values[values % np.uint64(of) == number] if of > 1 else values


def set_key(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)


def classes_of(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, the size of its set and the key of its set (null: empty).

    Some rows also carry, packed, the shingles that ``SEEN`` or more sets of
    a flush held, and in how many.
    """

    def often(sets: list[np.ndarray]) -> tuple[bytes, bytes]:
        flat = np.concatenate(sets)
        slot = (flat >> np.uint64(44)).astype(np.int64)
        flat = flat[np.bincount(slot, minlength=1 << 20)[slot] >= SEEN]
        values, counts = np.unique(flat, return_counts=True)
        return values[counts >= SEEN].tobytes(), counts[counts >= SEEN].astype("<i8").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for part in slices(texts):
                sets = shingle_sets(texts[part], words)
                keys = [set_key(s) if len(s) else None for s in sets]
                for key, s in zip(keys, sets, strict=True):
                    total += 0 if key is None or key in held else len(s)
                    if key is not None:
                        held[key] = s
                some: list[bytes | None] = [None] * len(sets)
                counts = list(some)
                if total >= FLUSH:
                    some[0], counts[0] = often(list(held.values()))
                    held, total = {}, 0
                yield pa.RecordBatch.from_arrays([ids[part.start : part.stop], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()), pa.array(some, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "n_shingles", "key", "often", "counts"])
        if held:
            some, counts = often(list(held.values()))
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([None], pa.int64()), pa.array([some], pa.binary()), pa.array([counts], pa.binary())], names=["doc_id", "n_shingles", "key", "often", "counts"])

    return map_arrow(documents, work, "doc_id bigint, n_shingles bigint, key bigint, often binary, counts binary")


def hot_shingles(flushed: DataFrame, total: int) -> np.ndarray:
    """Sorted shingles that very many sets hold; at most ``MOST``, since each has more than that share of all ``total``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, counts in zip(batch.column("often"), batch.column("counts"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(some.as_py(), np.int64)), pa.array(np.frombuffer(counts.as_py(), np.int64))], names=["shingle", "n"])

    counted = map_arrow(flushed.where("octet_length(often) > 0").select("often", "counts"), work, "shingle bigint, n bigint", 100)
    found = counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") > max(LEAST, total // MOST))
    return np.sort(np.array([r[0] for r in found.select("shingle").collect()], np.int64).view(np.uint64))


def postings(documents: DataFrame, words: int, bits: int, buckets: int, hot: np.ndarray, heavy: dict[int, int]) -> DataFrame:
    """Packed postings: per flush and hash range the shingles, and runs of them by class.

    Hot shingles need no count, as they come last in every window: they go
    straight to the bucket of their class, under a negative range. Of a heavy
    class only the document that ``heavy`` names is taken.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        total = 0

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(list(held.values()))
            sizes = np.array([len(s) for s in held.values()])
            owner = np.repeat(np.arange(len(sizes)), sizes)
            opening = np.zeros(len(flat), bool)
            opening[np.cumsum(sizes) - sizes] = True
            keys = np.array(list(held), np.int64)
            where = (flat >> np.uint64(64 - bits)).astype(np.int32)
            if len(hot):
                is_hot = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
                where[is_hot] = -1 - (keys[owner[is_hot]] & np.int64(buckets - 1)).astype(np.int32)
            order = np.argsort(where, kind="stable")
            flat, owner, opening, where = flat[order], owner[order], opening[order], where[order]
            edges = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))).tolist() + [len(where)]
            rows = []
            for a, b in zip(edges, edges[1:], strict=False):
                start = np.flatnonzero(np.concatenate(([True], owner[a + 1 : b] != owner[a : b - 1])))
                own = owner[a:b][start]
                counts = np.diff(np.concatenate((start, [b - a])))
                has = opening[a:b][start]
                rows.append((int(where[a]), _packed(flat[a:b], 8) if where[a] < 0 else _packed(flat[a:b] & np.uint64((1 << LOW) - 1), LOW // 8), keys[own].tobytes(), counts.astype("<u4").tobytes() if counts.max() > 65_535 else counts.astype("<u2").tobytes(), keys[own[has]].tobytes(), sizes[own[has]].astype("<u4").tobytes()))
            kinds = (pa.int32(), *(pa.binary(),) * 5)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["range", "hashes", "keys", "counts", "sized", "sizes"])

        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for part in slices(texts):
                for ident, s in zip(ids[part], shingle_sets(texts[part], words), strict=True):
                    key = set_key(s) if len(s) else None
                    if key is not None and heavy.get(key, ident) == ident:
                        total += 0 if key in held else len(s)
                        held[key] = s
                if total >= FLUSH:
                    yield flush()
                    held.clear()
                    total = 0
        if held:
            yield flush()

    return map_arrow(documents, work, "range int, hashes binary, keys binary, counts binary, sized binary, sizes binary")


SHARED = "bucket int, range int, keys binary, counts binary, hashes binary, found binary, sized binary, sizes binary"


def shared_of_range(group: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """From all postings of a range: the shingles that several classes hold, dealt out by class."""
    number = int(group["range"].iloc[0])
    if number < 0:
        whole = {n: b"".join(group[n]) for n in ("keys", "hashes", "sized", "sizes")}
        counts = np.concatenate([np.frombuffer(c, "<u2" if len(c) * 4 == len(k) else "<u4") for c, k in zip(group["counts"], group["keys"], strict=True)])
        found = np.full(len(whole["hashes"]) // 8, 0xFFFFFF, "<u4")
        return pd.DataFrame([(-1 - number, -1, whole["keys"], counts.astype("<u4").tobytes(), whole["hashes"], found.tobytes(), whole["sized"], whole["sizes"])], columns=[c.split()[0] for c in SHARED.split(", ")])
    hashes = _unpacked(b"".join(group["hashes"]), LOW // 8)
    keys = np.frombuffer(b"".join(group["keys"]), np.int64)
    counts = np.concatenate([np.frombuffer(c, "<u2" if len(c) * 4 == len(k) else "<u4") for c, k in zip(group["counts"], group["keys"], strict=True)]).astype(np.int64)
    sized = np.frombuffer(b"".join(group["sized"]), np.int64)
    sizes = np.frombuffer(b"".join(group["sizes"]), "<u4")
    owner = np.repeat(np.arange(len(keys), dtype=np.int32), counts)
    order = np.argsort(hashes)
    h = hashes[order]
    again = h[1:] == h[:-1]
    several = np.concatenate((again, [False])) | np.concatenate(([False], again))
    h, k = h[several], keys[owner[order[several]]]
    order = np.lexsort((k, h))
    h, k = h[order], k[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])
    h, k = h[fresh], k[fresh]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    found = np.diff(np.concatenate((start, [len(h)])))
    found = np.repeat(found, found)
    kept = found > 1
    h, k, found = h[kept], k[kept], found[kept]
    order = np.lexsort((h, k))
    h, k, found = h[order], k[order], found[order]
    bucket = (k & np.int64(buckets - 1)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    h, k, found, bucket = h[order], k[order], found[order], bucket[order]
    sized, first = np.unique(sized, return_index=True)
    sizes = sizes[first]
    of = (sized & np.int64(buckets - 1)).astype(np.int32)
    rows = []
    for b in range(buckets):
        lo, hi = np.searchsorted(bucket, [b, b + 1])
        start = np.flatnonzero(np.concatenate(([True], k[lo + 1 : hi] != k[lo : hi - 1]))) if hi > lo else np.zeros(0, np.int64)
        runs = np.diff(np.concatenate((start, [hi - lo])))
        mine = of == b
        if hi > lo or mine.any():
            rows.append((b, number, k[lo:hi][start].tobytes(), runs.astype("<u4").tobytes(), _packed(h[lo:hi], LOW // 8), np.minimum(found[lo:hi], 0xFFFFFF).astype("<u4").tobytes(), sized[mine].tobytes(), sizes[mine].tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SHARED.split(", ")])


def windows_of_bucket(group: pd.DataFrame, percent: int, width: int) -> pd.DataFrame:
    """Per class of a bucket that can link: its size, the number of regions, its shared shingles, rarest first."""
    parts = [(np.frombuffer(k, np.int64), np.frombuffer(c, "<u4").astype(np.int64), np.frombuffer(h, "<u8") if r < 0 else _unpacked(h, LOW // 8) | np.uint64(r) << np.uint64(LOW), np.frombuffer(f, "<u4")) for r, k, c, h, f in zip(group["range"], group["keys"], group["counts"], group["hashes"], group["found"], strict=True)]
    sized, sizes = np.frombuffer(b"".join(group["sized"]), np.int64), np.frombuffer(b"".join(group["sizes"]), "<u4").astype(np.int64)
    k = np.concatenate([np.repeat(a, c) for a, c, _, _ in parts])
    h, found = np.concatenate([x for _, _, x, _ in parts]), np.concatenate([x for _, _, _, x in parts])
    order = np.lexsort((h, found, k))
    k, h = k[order], h[order]
    fresh = np.ones(len(k), bool)  # a hot shingle may come from several tasks
    fresh[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    k, h = k[fresh], h[fresh]
    start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    ends = np.concatenate((start[1:], [len(k)])) if len(k) else start
    by = np.argsort(sized)
    n = sizes[by][np.searchsorted(sized[by], k[start])] if len(k) else np.zeros(0, np.int64)
    window = n - (percent * n + 99) // 100 + 1
    take = window - (n - (ends - start))
    rows = [(int(k[a]), int(m), int(t), _packed(h[a:b], width)) for a, b, m, t in zip(start, ends, n, take, strict=True) if t > 0]
    return pd.DataFrame(rows, columns=["key", "n", "take", "shingles"])


def regions_of(sets: DataFrame, width: int) -> DataFrame:
    """(region, key): each set in the regions of its window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take = np.array(batch.column("take").to_pylist(), np.int64)
            if len(take):
                regions = np.concatenate([_unpacked(s[: width * t], width) for s, t in zip(batch.column("shingles").to_pylist(), take.tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(regions.view(np.int64)), pa.array(np.repeat(batch.column("key").to_numpy(), take))], names=["region", "key"])

    return map_arrow(sets.select("key", "take", "shingles"), work, "region bigint, key bigint", 500)


def overlaps(pairs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """Adds to distinct (pivot, key) pairs the sizes of intersection and union of their sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, x, common = None, np.zeros(0, np.uint64), []
            for pivot, a, b in zip(batch.column("pivot").to_pylist(), batch.column("left"), batch.column("right"), strict=True):
                if pivot != last:  # rows come in order of the pivot, as the join sorts them
                    last, x = pivot, np.sort(_unpacked(a.as_py(), width))
                y = _unpacked(b.as_py(), width)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common.append(int((x[at] == y).sum()))
            common = np.array(common, np.int64)
            union = batch.column("n").to_numpy() + batch.column("m").to_numpy() - common
            yield pa.RecordBatch.from_arrays([batch.column("pivot"), batch.column("key"), pa.array(common), pa.array(union, pa.int64())], names=["pivot", "key", "common", "whole"])

    right = pairs.join(sets.select("key", F.col("n").alias("m"), F.col("shingles").alias("right")), "key")
    both = right.join(sets.select(F.col("key").alias("pivot"), "n", F.col("shingles").alias("left")), "pivot")
    return map_arrow(both.select("pivot", "key", "n", "m", "left", "right"), work, "pivot bigint, key bigint, common bigint, whole bigint", 500)


def loose_pairs(sets: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs (a, b) of keys such that all links lie within what the pairs connect.

    Regions of up to ``SMALL`` members are compared whole. In others
    a pivot is paired with the members within twice the limit. A member beyond
    that (far) can link with other far ones, or with near ones that are at
    most the limit nearer to the pivot; these go on to the region's next pivot.
    """
    limit = 1 - percent / 100
    members = regions_of(sets, width).repartition("region")
    sizes = members.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    placed = cut(members.join(sizes, "region"))
    small = placed.where(F.col("n") <= SMALL).select("region", "key")
    pairs = small.withColumnRenamed("key", "pivot").join(small, "region").where("pivot < key").select("pivot", "key").distinct()
    linked = F.col("common") * 100 >= F.col("whole") * percent
    found = cut(overlaps(pairs, sets, width).where(linked).select(F.col("pivot").alias("a"), F.col("key").alias("b")))
    members = placed.where(F.col("n") > SMALL).select("region", "key", F.lit(0).alias("inner"))
    if members.isEmpty():
        return found
    before, now = float("inf"), members.count()
    while now <= SHRINK * before:
        heads = members.groupBy("region").agg(F.min(F.struct("inner", "key")).alias("head"), F.count("*").alias("n")).where("n > 1")
        seen = members.join(heads.select("region", F.col("head.key").alias("pivot")), "region").where("key <> pivot").select("region", "pivot", "key")
        measured = overlaps(seen.select("pivot", "key").distinct(), sets, width)
        measured = cut(measured.select("pivot", "key", (1 - F.col("common") / F.col("whole")).alias("d")))
        new = measured.where(F.col("d") <= 2 * limit + 1e-9).select(F.col("pivot").alias("a"), F.col("key").alias("b"))
        found = found.unionByName(new)
        placed = seen.join(measured.where(F.col("d") >= limit - 1e-9), ["pivot", "key"]).select("region", "key", (F.col("d") <= 2 * limit + 1e-9).alias("near"), "d")
        far = placed.where(~F.col("near")).groupBy("region").agg(F.min("d").alias("nearest"))
        again = placed.join(far, "region").where(~F.col("near") | (F.col("d") >= F.col("nearest") - limit - 1e-9))
        again = cut(again.select("region", "key", F.col("near").cast("int").alias("inner")))
        members = again.join(again.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").select("region"), "region")
        before, now = now, members.count()
        if not now:
            return found
    heads = members.groupBy("region").agg(F.min("key").alias("a"))
    left = members.join(heads, "region").where("key <> a").select("a", F.col("key").alias("b"))
    return found.unionByName(left)


def linked_in_block(group: pd.DataFrame, percent: int, width: int) -> pd.DataFrame:
    """Within each (component, i, j) of the group, each key with the least key that links reach."""
    keys, heads = [], []
    for _, part in group.groupby(["component", "i", "j"]):
        key, size = part["key"].to_numpy(), part["n"].to_numpy()
        raw = part["shingles"].tolist()
        common = np.zeros((len(key), len(key)), np.float32)
        cuts = -(-sum(map(len, raw)) // (width * SLICE))
        for cut_no in range(cuts):  # a slice of the shingles at a time, by their low bits
            sets = [_slice(_unpacked(s, width), cut_no, cuts) for s in raw]
            row = np.repeat(np.arange(len(key)), [len(s) for s in sets])
            column = np.unique(np.concatenate(sets), return_inverse=True)[1]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
                lo, hi = np.searchsorted(column, [at, at + 2048])
                held = np.zeros((len(key), 2048), np.float32)
                held[row[lo:hi], column[lo:hi] - at] = 1
                common += held @ held.T
        linked = common * 100 >= (size[:, None] + size[None, :] - common) * percent
        np.fill_diagonal(linked, True)
        least = key.copy()
        while True:
            values, rank = np.unique(least, return_inverse=True)
            new = values[np.where(linked, rank[None, :], len(values)).min(axis=1)]
            if (new == least).all():
                break
            least = new
        keys.append(key[key != least])
        heads.append(least[key != least])
    empty = np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.concatenate(keys or [empty]), "b": np.concatenate(heads or [empty])})


def links_between(sets: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) that connect exactly what all links between the sets connect.

    What loose pairs connect is compared whole, block by block, as products
    of incidence matrices, so no row is made for each pair.
    """
    loose = connected_components(loose_pairs(sets, percent, width))
    member = loose.withColumnRenamed("id", "key").join(sets.select("key", F.length("shingles").alias("bytes")), "key")
    most = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / (width * BLOCK_SHINGLES)))
    sizes = cut(member.groupBy("component").agg(most.cast("int").alias("blocks"), (most * F.count("*")).alias("dealt"), (most * F.sum("bytes")).alias("bytes")))
    placed = loose.withColumnRenamed("id", "key").join(sizes.select("component", "blocks"), "component").join(sets.select("key", "n", "shingles"), "key")
    placed = placed.withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = placed.select("component", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "key", "n", "shingles")
    dealt_rows, dealt_bytes = sizes.agg(F.sum("dealt"), F.sum("bytes")).first()
    parts = max(1, int(dealt_rows or 0) // 1024, int(dealt_bytes or 0) // (8 << 20))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("component", "i", "j"), F.lit(parts)))
    return per_group(dealt, "part", lambda g: linked_in_block(g, percent, width), "a bigint, b bigint")


def group_documents(documents: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Two documents link if 100 * intersection >= percent * union of their
    shingle sets; component_id is the least doc_id that links reach. Null,
    empty and wordless texts have an empty set and link with nothing. Rows
    that repeat a doc_id are documents of their own.
    """
    texts = text_of(documents)
    flushed = cut(classes_of(texts, words))
    rows = flushed.where("n_shingles >= 0").select("doc_id", "n_shingles", "key")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    bits = max(5, int(total // 2_000_000).bit_length())
    width = -(-(bits + LOW) // 8)
    n_rows = rows.count()
    grouped = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    firsts = grouped.select("key", "first")
    heavy = {r["key"]: r["first"] for r in grouped.where((F.col("copies") > max(LEAST, n_rows // MOST)) & F.col("first").isNotNull()).collect()}
    buckets = 1 << max(4, int(n_rows // 6_000).bit_length())
    shared = per_group(postings(texts, words, bits, buckets, hot_shingles(flushed, total), heavy), "range", lambda g: shared_of_range(g, buckets), SHARED)
    sets = per_group(shared, "bucket", lambda g: windows_of_bucket(g, percent, width), "key bigint, n bigint, take int, shingles binary")
    sets = cut(sets)
    joined_sets = connected_components(links_between(sets, percent, width))
    joined_sets = joined_sets.withColumnRenamed("id", "key").join(firsts, "key")
    least = joined_sets.groupBy("component").agg(F.min("first").alias("least"))
    found = joined_sets.join(least, "component").select("key", "least")
    per_class = firsts.join(found, "key", "left").select("key", F.coalesce("least", "first").alias("component_id"))
    return rows.join(per_class, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
