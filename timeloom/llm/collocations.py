"""Phrase collocations, counted by pivot partitions.

A phrase is frequent only if all its words are. So words are counted first,
and each phrase belongs to its rarest word, its pivot (the leftmost, where
that word repeats). For each place of a word the text around it is rewritten:
neighbours that are rarer, or lie behind such a one, become blanks, as no
phrase of this pivot holds them. Equal rewritten fragments of a task become
one with a count, and fragments go to their pivot's partition, where phrases
are mined; nothing is counted there that another pivot owns.

The ranks of words must be known to every task, and a dictionary grows with
the text. Ranks come therefore from a table of fixed size (``SLOTS`` counts):
a word's slot holds the count of all words that share it. That is the word's
own count unless slots are shared, never less, so no frequent word is lost,
and all tasks agree on who is rarest. All counts that are returned are exact.

A common pivot's neighbours are commoner still, so it has few distinct
fragments however often it stands. Pivots that hold more than a thousandth of
all words are dealt out over ``SPREAD`` parts all the same, and their counts
summed at the end; mining works on lots of bounded size, and a pivot that a
lot's end divides is summed in the same way.

Defined results: a null text is empty, a null language is ``und``, repeated
rows count as often as they stand, an empty table gives no rows, other
columns are not read. Texts are split into pieces before words, so no phrase
crosses a mark or a line; long texts are read in slices that keep pieces whole.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut, map_arrow, release

MARKS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + MARKS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(MARKS))
SLOTS = 1 << 22
BLOCK = 1 << 12  # slots of one row when the table is brought together
HELD = 250_000  # words of a language that a task numbers before it passes them on
TOKENS = 1_500_000  # of a language that a task holds likewise
SLICE = 1_000_000  # bytes of a long text that are read at a time
ROW = 500  # fragments of a row
LOT = 400_000  # fragments mined at a time
SPREAD = 16
NONE = np.int64(1) << 40


class _Numbered:
    """Words of one language as they are read: a number for each, and the texts as numbers; 0 ends a piece."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.ids[b"\n"], self.ids[b""]
        self.read: list[np.ndarray] = []
        self.tokens = 0

    def add(self, raw: bytes) -> None:
        words = raw.replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        numbers = numbers[numbers != 1]
        self.read.append(numbers)
        self.tokens += len(numbers)

    @property
    def full(self) -> bool:
        return self.tokens > TOKENS or len(self.ids) > HELD


def _sliced(raw: bytes) -> Iterator[bytes]:
    """Slices of a long text, cut at ends of pieces."""
    at = 0
    while len(raw) - at > SLICE:
        stop = raw.rfind(b"\n", at, at + SLICE)
        if stop < 0:
            stop = raw.find(b"\n", at + SLICE)
        if stop < 0:
            break
        yield raw[at:stop]
        at = stop + 1
    yield raw[at:]


def _read(batches: Iterator[pa.RecordBatch], held: dict[str, _Numbered]) -> Iterator[str]:
    """Numbers the words of all texts, and names each language that has enough to be passed on, at last all of them."""
    for batch in batches:
        waiting: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def pour(lang: str, waiting: dict = waiting, size: dict = size) -> bool:
            held.setdefault(lang, _Numbered()).add(b"\n".join([*waiting.pop(lang), b""]))
            size[lang] = 0
            return held[lang].full

        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for part in _sliced(text.encode().translate(TABLE)):
                waiting[lang].append(part)
                size[lang] += len(part)
                if size[lang] > 500_000 and pour(lang):
                    yield lang
        for lang in list(waiting):
            if pour(lang):
                yield lang
        if sum(x.tokens for x in held.values()) > 2 * TOKENS:
            yield max(held, key=lambda lang: held[lang].tokens)
    yield from [lang for lang, x in held.items() if x.tokens]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def count_words(documents: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``n``: all words and how often they occur."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Numbered] = {}
        for lang in _read(batches, held):
            mine = held[lang]
            n = np.bincount(np.concatenate(mine.read), minlength=len(mine.ids))[2:]
            words = list(mine.ids)[2:]
            mine.clear()
            made = pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])
            for at in range(0, made.num_rows, 20_000):
                yield made.slice(at, 20_000)

    return map_arrow(_texts(documents), work, "lang string, word string, n bigint", 400).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _slot_counts(words: DataFrame) -> np.ndarray:
    """The counts of all slots, ``SLOTS`` numbers of four bytes whatever the text."""
    slot = F.crc32(F.concat_ws("\n", "lang", "word")) % SLOTS
    summed = words.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n"))

    def pack(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        counts = np.zeros(BLOCK, np.float32)
        counts[rows.column("slot").to_numpy() % BLOCK] = rows.column("n").to_numpy()
        return pa.table({"block": [block], "counts": [counts.tobytes()]})

    table = np.zeros((SLOTS // BLOCK, BLOCK), np.float32)
    for row in summed.withColumn("block", F.floor(F.col("slot") / BLOCK)).groupBy("block").applyInArrow(pack, "block bigint, counts binary").toLocalIterator():
        table[row["block"]] = np.frombuffer(row["counts"], np.float32)
    return table.ravel()


def _ranks(lang: str, words: list[bytes], table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A place in the order of all words, commonest first, alike in all tasks; ``NONE`` for words that aren't frequent. And the slots' counts."""
    start = zlib.crc32(lang.encode() + b"\n")
    crc = np.fromiter((zlib.crc32(w, start) for w in words), np.int64, len(words))
    count = table[crc % SLOTS]
    order = np.lexsort((crc, -count))
    alike = np.flatnonzero((crc[order][1:] == crc[order][:-1]) & (count[order][1:] == count[order][:-1]))
    for run in np.split(alike, np.flatnonzero(np.diff(alike) > 1) + 1):
        if len(run):
            some = slice(run[0], run[-1] + 2)
            order[some] = sorted(order[some], key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    rank[count < least] = NONE
    rank[:2] = NONE
    return rank, count


def _rewritten(ids: np.ndarray, rank: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place with a phrase: the numbers from ``reach`` before to ``reach`` behind it, blanks as 0; and how often each such row stands."""
    r = np.concatenate((np.full(reach, NONE), rank[ids], np.full(reach, NONE)))
    w = np.concatenate((np.zeros(reach, np.int64), ids, np.zeros(reach, np.int64)))
    n = len(ids)
    own = r[reach : reach + n]
    columns: dict[int, np.ndarray] = {0: np.asarray(ids, np.int64)}
    for step in (-1, 1):
        open_ = own < NONE
        for k in range(1, reach + 1):
            there = r[reach + step * k : reach + step * k + n]
            open_ = open_ & ((there < own) if step < 0 else (there <= own))
            columns[step * k] = np.where(open_, w[reach + step * k : reach + step * k + n], 0)
    live = (columns[-1] > 0) | (columns[1] > 0)
    wide = [columns[k][live] for k in sorted(columns, key=lambda k: (k != 0, abs(k), k))]  # the pivot first
    keys, bits = [], len(rank).bit_length()
    for at in range(0, len(wide), 63 // bits):
        key = np.zeros(int(live.sum()), np.int64)
        for c in wide[at : at + 63 // bits]:
            key = (key << bits) | c
        keys.append(key)
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return np.zeros((0, 2 * reach + 1), np.int64), np.zeros(0, np.int64)
    new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(order)))
    place = order[first]
    return np.stack([columns[k][live][place] for k in sorted(columns)], axis=1), times


def _fragments(documents: DataFrame, table: object, total: int, least: int, reach: int) -> DataFrame:
    """``lang``, ``pivot``, ``part`` (-1, or the part of a very common pivot), ``around`` (what stands before and behind, blanks empty), ``times``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Numbered] = {}
        counts = table.value
        lots = itertools.count()
        for lang in _read(batches, held):
            mine = held[lang]
            words = list(mine.ids)
            rank, count = _ranks(lang, words, counts, least)
            ids = np.concatenate(mine.read)
            mine.clear()
            rows, times = _rewritten(ids, rank, reach)
            del ids
            part = next(lots) % SPREAD
            words[0] = words[1] = b""
            named = pa.array(words, pa.binary()).cast(pa.string())
            pivots = rows[:, reach]
            places = np.arange(len(pivots))
            new = np.concatenate(([True], pivots[1:] != pivots[:-1])) if len(pivots) else np.zeros(0, bool)
            since = places - np.maximum.accumulate(np.where(new, places, 0))
            starts = np.flatnonzero(since % ROW == 0)
            bounds = np.append(starts, len(pivots))
            at = 0
            while at < len(starts):
                stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 50_000, side="right")) - 1)
                low, high = bounds[at], bounds[stop]
                around = pc.binary_join_element_wise(*(named.take(pa.array(rows[low:high, c])) for c in range(2 * reach + 1) if c != reach), " ")
                offsets = pa.array(bounds[at : stop + 1] - low, pa.int32())
                heads = pivots[starts[at:stop]]
                parts = np.where(count[heads] * 1000 > total, part, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(heads), pa.string()), named.take(pa.array(heads)), pa.array(parts, pa.int32()), pa.ListArray.from_arrays(offsets, around), pa.ListArray.from_arrays(offsets, pa.array(times[low:high], pa.int32()))],
                    names=["lang", "pivot", "part", "around", "times"],
                )
                at = stop
            del rows, times, pivots
            release(collect=False)

    return map_arrow(_texts(documents), work, "lang string, pivot string, part int, around array<string>, times array<int>", 400)


def _mined(fragments: DataFrame, least: int, reach: int) -> DataFrame:
    """``lang``, ``phrase``, ``words``, ``f`` of the phrases that each pivot owns."""

    def lot(rows: list[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        """Counts of one lot; phrases of its first and last pivot, and of dealt ones, may be counted in others too and stay whatever their count."""
        table = pa.Table.from_batches(rows).combine_chunks()
        lang, pivot = table.column("lang").combine_chunks(), table.column("pivot").combine_chunks()
        around, times = table.column("around").combine_chunks(), table.column("times").combine_chunks()
        sizes = np.diff(around.offsets.to_numpy())
        row = np.repeat(np.arange(table.num_rows), sizes)
        times = times.flatten().to_numpy().astype(np.int64)
        split = pc.split_pattern(around.flatten(), " ").flatten()
        coded = pa.concat_arrays([split, pivot]).dictionary_encode()
        names, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        blank = pc.index(names, pa.scalar("", names.type)).as_py()
        grid = ids[: len(split)].reshape(len(row), 2 * reach)
        heads = ids[len(split) :]
        langs = lang.dictionary_encode()
        tongue = langs.indices.to_numpy().astype(np.int64)
        owner = heads * len(langs.dictionary) + tongue
        part = table.column("part").to_numpy()
        loose = part >= 0
        if not whole:
            loose |= (owner == owner[0]) | (owner == owner[-1])
        for before in range(reach + 1):
            for behind in range(reach + 1 - before):
                if not before + behind:
                    continue
                use = [reach - 1 - k for k in reversed(range(before))], [reach + k for k in range(behind)]
                some = np.flatnonzero((grid[:, use[0] + use[1]] != blank).all(axis=1))
                if not len(some):
                    continue
                columns = [grid[some, c] for c in use[0]] + [heads[row[some]]] + [grid[some, c] for c in use[1]]
                keys = [tongue[row[some]]]
                for at in range(0, len(columns), 2):
                    key = columns[at]
                    keys.append((key << 31) | columns[at + 1] if at + 1 < len(columns) else key)
                order = np.lexsort(keys[::-1])
                ordered = [k[order] for k in keys]
                first = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in ordered], axis=0))))
                f = np.add.reduceat(times[some][order], first)
                place = order[first]
                keep = (f >= least) | loose[row[some[place]]]
                f, place = f[keep], place[keep]
                if len(f):
                    phrase = pc.binary_join_element_wise(*(names.take(pa.array(c[place])) for c in columns), " ")
                    spoken = langs.dictionary.take(pa.array(tongue[row[some[place]]]))
                    made = pa.RecordBatch.from_arrays([spoken, phrase, pa.array(np.full(len(f), before + behind + 1, np.int32)), pa.array(f)], names=["lang", "phrase", "words", "f"])
                    for at in range(0, made.num_rows, 20_000):
                        yield made.slice(at, 20_000)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = lots = 0
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column(3).offsets.to_numpy()))
            at = done = 0
            while at < batch.num_rows:
                stop = min(int(np.searchsorted(ends, done + LOT - size)) + 1, batch.num_rows)
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1]) - done
                at, done = stop, int(ends[stop - 1])
                if size >= LOT:
                    yield from lot(held, False)
                    release(collect=False)
                    held, size, lots = [], 0, lots + 1
        if held:
            yield from lot(held, not lots)

    dealt = fragments.repartition("lang", "pivot", "part").sortWithinPartitions("lang", "pivot")
    counted = map_arrow(dealt, work, "lang string, phrase string, words int, f bigint", 500)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def phrase_counts(documents: DataFrame, words: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """``lang``, ``phrase``, ``words``, ``f`` of all phrases of 1 to ``longest`` words that occur ``least`` times; ``words`` from count_words."""
    total = int(words.agg(F.sum("n")).first()[0] or 0)
    table = documents.sparkSession.sparkContext.broadcast(_slot_counts(words))
    mined = _mined(_fragments(documents, table, total, least, longest - 1), least, longest - 1)
    single = words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    return single.unionByName(mined)


def _decimal(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases with ``a``, and ``l``, ``r``, ``score`` of the lowest-scoring cut, ties to the shortest first part."""
    cuts = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    square = (_decimal("a") * _decimal("a")).cast("decimal(38,0)")
    cuts = cuts.withColumn("above", (square * 1_000_000).cast("decimal(38,0)")).withColumn("below", (_decimal("l") * _decimal("r")).cast("decimal(38,0)"))
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def outlasting(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """Drops phrases that stand inside a longer one which occurs ``percent`` per cent as often, itself dropped or not."""
    inner = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(0, words - n), i -> concat_ws(' ', slice(split(phrase, ' '), i + 1, n)))))")
    longer = phrases.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return phrases.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("a") * percent).drop("longer")


def collocations(documents: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, percent: int = 50) -> DataFrame:
    """Each language's ``top`` phrases by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    words = cut(count_words(documents))
    counts = cut(phrase_counts(documents, words, longest, least))
    kept = outlasting(cut(scored(counts)), percent)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = kept.withColumn("_deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))  # a language's best are among the best of its parts
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_deal").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    said = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(said, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for phrases of 2 to 3 words, 10 occurrences, half as often, 2000 a language.
COLLOCATION_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS m, unnest(w) AS phrase FROM spoken
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM spoken)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM spoken)),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
said AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= 10),
cuts AS (
  SELECT lang, m, phrase, f AS a, k, list_aggregate(string_split(phrase, ' ')[1:k], 'string_agg', ' ') AS head, list_aggregate(string_split(phrase, ' ')[k + 1:m], 'string_agg', ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM frequent WHERE m > 1)),
each AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, h.f AS l, t.f AS r, ((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head JOIN frequent t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (SELECT * FROM each QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([list_aggregate(string_split(phrase, ' ')[1:2], 'string_agg', ' '), list_aggregate(string_split(phrase, ' ')[2:3], 'string_agg', ' ')]) AS phrase FROM frequent WHERE m = 3) GROUP BY ALL),
kept AS (SELECT x.* FROM lowest x LEFT JOIN longer y ON y.lang = x.lang AND y.phrase = x.phrase WHERE 100 * coalesce(y.f, 0) < 50 * x.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN said s ON s.lang = k.lang QUALIFY rank <= 2000
"""
