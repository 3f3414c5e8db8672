"""Spelling variants: words one edit apart, and the spelling that each follows.

Two words one edit apart (one code point inserted, deleted or replaced) share
either the first half of the shorter one or all that follows it. So each word
stands in a forward dictionary, sorted by what it starts with, and in a
reversed one, sorted by what it ends with; words that share a half are a block
there. A block of more than ``block`` words is divided the same way again: the
edit lies in the middle that its words don't share, and leaves one half of
that intact. A middle of one code point is as far as it goes, so no block
outgrows the alphabet squared. What is left in a block is compared.

A pair is near in one block only: where the words first differ says in which
half the edit lies, at each division. So no pair is counted twice and pairs
need no distinct.

Blocks are counted with partial sums before they are dealt; a block that holds
many words is divided, not sent to one task. Dictionary rows number about four
a word, more where blocks are divided.

Defined results: a null text has no words, a null doc_id reads as empty text
in the hash, repeated rows count as often as they stand, an empty table gives
no rows, and other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut, map_arrow

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
HELD = 300_000  # words that a task counts before it passes them on
BLOCK = 64  # words of a block that are compared without dividing it
PAIRS = 400_000  # compared at a time
KEY = ("m", "a", "b", "upto", "shared")


def count_words(documents: DataFrame, least: int = 5, seldom: int = 3, divisor: int = 97) -> DataFrame:
    """``word`` and ``n``: lower-cased runs of letters of ``least`` code points, found ``seldom`` times at least.

    Where ``divisor`` divides the crc32 h of ``<doc_id>:<run>``, the run loses its code point h % length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                text = text.encode().lower().decode()  # of bytes: only A to Z change
                for word, k in Counter(RUNS.findall(text) if len(text) < 1 << 22 else (m.group() for m in RUNS.finditer(text))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % divisor == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        held[word] += k
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seldom)


def _divided(rows: DataFrame) -> DataFrame:
    """Each row of a block in the two that divide it: by the first half of the unshared middle, or by all that follows it."""
    middle = F.col("m") - F.col("a") - F.col("b")
    half = F.floor(middle / 2).cast("int")
    fore = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("upto").alias("upto"))
    rear = F.struct(F.col("a").alias("a"), (F.col("b") + middle - half).alias("b"), F.least(F.col("upto"), F.col("a") + half).alias("upto"))
    both = rows.select("word", "n", "m", F.explode(F.array(fore, rear)).alias("e")).select("word", "n", "m", "e.a", "e.b", "e.upto")
    end = F.expr("if(b > 0, right(word, b), '')")
    return both.withColumn("shared", F.concat(F.expr("left(word, a)"), F.lit(" "), end))


def _dictionaries(words: DataFrame, least: int) -> DataFrame:
    """Each word as one of its own length, and as the longer of a pair: m is the shorter length."""
    size = F.length("word")
    lengths = F.array_compact(F.array(size, F.when(size > least, size - 1)))
    whole = words.select("word", "n", F.explode(lengths).alias("m")).select("word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"), (F.col("m") + 1).alias("upto"))
    return _divided(whole)


def _near(words: np.ndarray, i: np.ndarray, j: np.ndarray, m: np.ndarray, a: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) are one edit apart, the edit at a place that their block owns; j may be one longer."""
    x, y = words[i], words[j]
    differ = x != y
    where = differ.argmax(axis=1)
    own = (where >= a) & (where < upto)
    same_length = y[np.arange(len(j)), m] == 0
    near = own & same_length & (differ.sum(axis=1) == 1)
    k = np.flatnonzero(own & ~same_length)
    if len(k):
        moved = x[k, :-1] != y[k, 1:]
        moved &= np.arange(moved.shape[1]) >= where[k][:, None]
        near[k] = ~moved.any(axis=1)
    return near


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: for each word, the near words found here, their number and the best."""

    def lot(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        m, a, upto, block = (rows.column(c).to_numpy() for c in ("m", "a", "upto", "block"))
        block = np.concatenate(([0], np.cumsum(block[1:] != block[:-1])))
        texts = rows.column("word").to_pylist()
        words = np.array([t.encode("latin-1") for t in texts])
        codes = np.ascontiguousarray(words).view(np.uint8).reshape(len(words), -1)
        codes = np.concatenate((codes, np.zeros((len(words), 1), np.uint8)), axis=1)
        n = rows.column("n").to_numpy()
        own = np.fromiter((len(t) for t in texts), np.int64, len(texts)) == m
        order = np.lexsort((~own, block))
        ends = np.searchsorted(block[order], block[order], side="right")
        at = np.arange(len(order))
        partners = np.where(own[order], ends - at - 1, 0)
        distinct, word_id = np.unique(words, return_inverse=True)
        rank = np.empty(len(distinct), np.int64)
        size = np.zeros(len(distinct), np.int64)
        size[word_id] = n
        by_rank = np.lexsort((np.arange(len(distinct)), -size))  # latin-1 bytes stand in code-point order
        rank[by_rank] = np.arange(len(distinct))
        found, best = np.zeros(len(distinct), np.int64), np.full(len(distinct), len(distinct), np.int64)
        bounds = np.concatenate(([0], np.cumsum(partners)))
        start = 0
        while start < len(order):
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + PAIRS, side="right")) - 1)
            k = partners[start:stop]
            left = np.repeat(at[start:stop], k)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(k) - k, k)
            i, j = order[left], order[right]
            keep = _near(codes, i, j, m[i], a[i], upto[i]) if len(i) else np.zeros(0, bool)
            for p, q in ((i[keep], j[keep]), (j[keep], i[keep])):
                found += np.bincount(word_id[p], minlength=len(distinct))
                np.minimum.at(best, word_id[p], rank[word_id[q]])
            start = stop
        some = np.flatnonzero(found)
        chosen = by_rank[best[some]]
        named = [w.decode("latin-1") for w in distinct.tolist()]
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array([named[i] for i in some]), pa.array(found[some]), pa.array([named[i] for i in chosen]), pa.array(size[chosen])], names=["word", "n_near", "best", "best_n"])

    held: list[pa.RecordBatch] = []
    rows = cells = 0
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        width = int(batch.column("m").to_numpy().max()) + 2
        block = batch.column("block").to_numpy()
        if held and (rows > 20_000 or cells > 8_000_000) and block[0] != last:
            yield from lot(pa.Table.from_batches(held))
            held, rows, cells = [], 0, 0
        elif held and (rows > 20_000 or cells > 8_000_000) and block[-1] != last:
            cut_at = int(np.flatnonzero(block != last)[0])
            yield from lot(pa.Table.from_batches([*held, batch.slice(0, cut_at)]))
            batch = batch.slice(cut_at)
            held, rows, cells = [], 0, 0
        held.append(batch)
        rows += batch.num_rows
        cells += batch.num_rows * width
        last = block[-1]
    if held:
        yield from lot(pa.Table.from_batches(held))


def near_words(words: DataFrame, least: int = 5, block: int = BLOCK) -> DataFrame:
    """``word``, ``n_near``, ``best`` (near word of largest n, ties to the smallest) and ``best_n``; only words that have near ones.

    ``words`` has distinct ``word`` of code points up to U+00FF and ``n``.
    """
    level, dealt = cut(_dictionaries(words, least)), []
    while True:
        full = cut(level.groupBy(*KEY).count().where((F.col("count") > block) & (F.col("m") - F.col("a") - F.col("b") >= 2)).select(*KEY))
        if full.isEmpty():
            dealt.append(level)
            break
        dealt.append(level.join(full, [*KEY], "left_anti"))
        level = cut(_divided(level.join(full, [*KEY], "left_semi")))
    rows = dealt[0]
    for more in dealt[1:]:
        rows = rows.unionByName(more)
    keyed = rows.withColumn("block", F.xxhash64(*KEY))
    ranged = keyed.repartitionByRange("m", "shared", "a", "b", "upto").sortWithinPartitions("m", "shared", "a", "b", "upto")
    found = map_arrow(ranged.select("word", "n", "m", "a", "upto", "block"), _compare, "word string, n_near bigint, best string, best_n bigint", 5_000)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "first.best", (-F.col("first.less")).alias("best_n"))


def follow(links: DataFrame, key: str = "word", to: str = "form", root: str = "root") -> DataFrame:
    """``key`` and the last of its chain of links, by doubling; chains must end."""
    state = cut(links.select(F.col(key), F.col(to).alias(root)))
    while True:
        on = state.select(F.col(key).alias(root), F.col(root).alias("_next"))
        step = cut(state.join(on, root, "left").select(key, F.coalesce("_next", root).alias(root), F.col("_next").isNotNull().alias("_moved")))
        state = step.select(key, root)
        if step.where("_moved").isEmpty():
            return state


def group_variants(documents: DataFrame, least: int = 5, seldom: int = 3, divisor: int = 97, times: int = 2, block: int = BLOCK) -> DataFrame:
    """``word``, ``form`` (its commonest near word, where that stands ``times`` as often), ``root`` (the last of its forms), ``n``, ``n_near``, ``form_n``."""
    if times <= 1:
        raise ValueError("a form must be commoner than its word, or chains of forms would not end")
    words = cut(count_words(documents, least, seldom, divisor))
    near = near_words(words, least, block)
    follows: Column = F.col("best_n") >= F.col("n") * times
    formed = cut(words.join(near, "word", "left").select("word", F.when(follows, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(follows, F.col("best_n")).alias("form_n")))
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
