"""SentencePiece encoding and decoding with a max-plus scan over giant documents.

A BPE segmentation is the one path through the lattice of pieces on which
every two neighbours, joined and encoded, give themselves back. Weighting such
steps 0 and all others minus infinity makes encoding a best path in the
max-plus semiring. A giant document is cut into chunks. A boundary state is
the piece that reaches or crosses a boundary; each chunk yields the matrix of
best weights from its entry states to its exit states. The matrices are
combined associatively, which fixes one state per boundary, and each chunk is
then traced back on its own.

Words (runs that no piece can cross) that lie inside a chunk have one
segmentation each, so their weight is 0 and their ids come from a memo.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut, map_arrow, slices, text_of
from timeloom.llm.textarrays import code_points, joined, spread
from timeloom.llm.wordcache import WordCache

BLANK = "▁"
NEVER = -np.inf
State = tuple[int, int]  # start and end of a piece, relative to the boundary


class PieceCodec:
    """Ids of a SentencePiece BPE model with byte fallback, equal to the library's."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = {i: int(p[3:5], 16) for i, p in enumerate(pieces) if m.is_byte(i)}
        self.byte_id = {b: i for i, b in self.bytes.items()}
        normal = {p: i for i, p in enumerate(pieces) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
        self.normal = normal
        self.reach = max(map(len, normal), default=1)
        self.joining = {c for p in normal if len(p) > 1 for c in p}
        self.surface = [p.replace(BLANK, " ").encode() for p in pieces]
        for i, b in self.bytes.items():
            self.surface[i] = bytes([b])
        for i in range(len(pieces)):
            if m.is_control(i):
                self.surface[i] = b""
        self.sizes = np.array(list(map(len, self.surface)), np.int64)
        self.blob = np.frombuffer(b"".join(self.surface), np.uint8)
        self.blob_at = np.cumsum(self.sizes) - self.sizes
        if "\n" in self.joining or any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError("this model has pieces that cross word bounds")
        self.lone = len(m.encode("\n"))
        self.fits: dict[tuple[str, str], bool] = {}
        self.cache = WordCache(self.words)

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of words; a line feed before each keeps the library from adding its own blank."""
        return [ids[self.lone :] for ids in self.model.encode(["\n" + w for w in words], num_threads=1)]

    def starts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of words: no piece crosses them."""
        if not len(points):
            return np.zeros(0, np.int64)
        blank = (points == 0x20) | (points == ord(BLANK))
        known = np.zeros(0x110000, bool)
        known[[ord(c) for c in self.joining]] = True
        known[0x20] = known[0x20] | known[ord(BLANK)]
        apart = ~known[points]
        begin = np.zeros(len(points) + 1, bool)
        begin[offsets] = True
        begin[1:-1] |= (blank[1:] & ~blank[:-1]) | apart[1:] | apart[:-1]
        return np.flatnonzero(begin[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_joined([" " + t if t else t for t in texts])

    def encode_joined(self, texts: list[str]) -> list[np.ndarray]:
        points, offsets = joined(texts)
        starts = self.starts(points, offsets)
        if not len(starts):
            return [np.zeros(0, np.uint32) for _ in texts]
        ids, n = self.cache.ids(points, starts, np.concatenate((starts[1:], [len(points)])))
        bounds = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.blob[spread(self.blob_at[ids], self.sizes[ids])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank that encoding puts first."""
        return self.decode_bytes(ids).decode("utf-8", "replace").removeprefix(" ")

    # the lattice

    def fit(self, a: str, b: str) -> bool:
        got = self.fits.get((a, b))
        if got is None:
            got = self.fits[a, b] = self.words([(a + b).replace(BLANK, " ")])[0] == [self.normal[a], self.normal[b]]
        return got

    def piece(self, text: str, i: int, j: int) -> str | None:
        p = text[i:j].replace(" ", BLANK)
        return p if p in self.normal or (j - i == 1) else None

    def follows(self, a: str | None, b: str) -> bool:
        return a is None or a not in self.normal or b not in self.normal or self.fit(a, b)

    def paths(self, text: str, entries: list[State], stop: int, bounds: set[int]) -> list[dict[State, State | None]]:
        """For each entry, every piece that a feasible path reaches and the piece before it.

        Pieces start before ``stop`` and may cross it; none crosses a word bound.
        """
        out = []
        for entry in entries:
            back: dict[State, State | None] = {entry: None}
            ends: dict[int, list[State]] = {entry[1]: [entry]}
            for i in range(entry[1], stop):
                if i not in ends:
                    continue
                for j in range(i + 1, min(i + self.reach, len(text)) + 1):
                    b = self.piece(text, i, j)
                    if b is not None:
                        for s in ends[i]:
                            a = None if i in bounds or s[0] == s[1] else self.piece(text, *s)
                            if self.follows(a, b):
                                back[i, j] = s
                                ends.setdefault(j, []).append((i, j))
                                break
                    if j in bounds:
                        break
            out.append(back)
        return out


@functools.lru_cache(2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


class Chunk:
    """One chunk of a text with ``reach`` code points of context on either side."""

    def __init__(self, machine: PieceCodec, left: str, body: str, right: str) -> None:
        self.machine, self.body = machine, body
        self.text = left + body + right
        self.begin, self.end = len(left), len(left) + len(body)
        starts = machine.starts(code_points(self.text), np.array([0, len(self.text)]))
        self.bounds = set(starts.tolist()) | {len(self.text)}
        if not left:
            self.bounds.add(0)
        self.first = min((b for b in self.bounds if b >= self.begin and (b > 0 or not left)), default=self.end)
        self.first = min(self.first, self.end)
        self.last = max((b for b in self.bounds if b <= self.end and (b > 0 or not left)), default=self.begin)
        self.whole = self.last >= self.first and self.last >= self.begin
        self.entries, self.exits = self.states(self.begin), self.states(self.end)

    def states(self, at: int) -> list[State]:
        """Pieces that end at or cross ``at``; one empty piece stands for all at a word bound."""
        if at in self.bounds:
            return [(at, at)]
        m = self.machine
        lo = max((b for b in self.bounds if b < at), default=0)
        hi = min((b for b in self.bounds if b > at), default=len(self.text))
        return [(i, j) for i in range(max(lo, at - m.reach), at) for j in range(at, min(hi, i + m.reach) + 1) if m.piece(self.text, i, j) is not None]

    def _exit(self, back: dict[State, State | None], state: State) -> State | None:
        """The reached piece that realises an exit state."""
        if state[0] < state[1]:
            return state if state in back else None
        return next((s for s in back if s[1] == state[1] and (s[0] < s[1] or s[1] == state[1])), None)

    def matrix(self) -> np.ndarray:
        """Best weight from each entry state to each exit state."""
        out = np.full((len(self.entries), len(self.exits)), NEVER)
        if self.whole:
            head = self.machine.paths(self.text, self.entries, self.first, self.bounds)
            tail = self.machine.paths(self.text, [(self.last, self.last)], self.end, self.bounds)[0]
            ins = [any(s[1] == self.first for s in back) for back in head]
            outs = [self._exit(tail, s) is not None for s in self.exits]
            out[np.ix_(np.flatnonzero(ins), np.flatnonzero(outs))] = 0.0
        else:
            for i, back in enumerate(self.machine.paths(self.text, self.entries, self.end, self.bounds)):
                for j, s in enumerate(self.exits):
                    if self._exit(back, s) is not None:
                        out[i, j] = 0.0
        return out

    def _trace(self, entry: State, stop: int, exit_state: State) -> list[int]:
        back = self.machine.paths(self.text, [entry], stop, self.bounds)[0]
        s, ids = self._exit(back, exit_state), []
        while s is not None and s != entry:
            p = self.machine.piece(self.text, *s)
            ids.append([self.machine.normal[p]] if p in self.machine.normal else [self.machine.byte_id[b] for b in self.text[s[0] : s[1]].encode("utf-8", "replace")])
            s = back[s]
        return [x for piece in reversed(ids) for x in piece]

    def ids(self, entry: int, exit_: int) -> np.ndarray:
        """Ids of the pieces that start in this chunk, given its entry and exit state."""
        e, x = self.entries[entry], self.exits[exit_]
        if not self.whole:
            return np.array(self._trace(e, self.end, x), np.uint32)
        head = self._trace(e, self.first, (self.first, self.first)) if e[1] < self.first else []
        middle = self.machine.encode_joined([self.text[self.first : self.last]])[0] if self.last > self.first else np.zeros(0, np.uint32)
        tail = self._trace((self.last, self.last), self.end, x) if self.last < self.end else []
        return np.concatenate((np.array(head, np.uint32), middle, np.array(tail, np.uint32)))


def compose(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """The entry and exit state of each chunk on the best path over all of them.

    Prefix products from the start and suffix products from the end, both in
    max-plus; their sum at a boundary is largest at the state on the path.
    """
    prefix = [np.zeros(matrices[0].shape[0])]
    for m in matrices:
        prefix.append((prefix[-1][:, None] + m).max(axis=0))
    suffix = [np.zeros(matrices[-1].shape[1])]
    for m in reversed(matrices):
        suffix.append((m + suffix[-1][None, :]).max(axis=1))
    suffix.reverse()
    best = [int((a + b).argmax()) for a, b in zip(prefix, suffix, strict=True)]
    return list(zip(best[:-1], best[1:], strict=True))


def cut_text(text: str, size: int, context: int) -> Iterator[tuple[str, str, str]]:
    """Chunks of ``size`` code points with their left and right context."""
    for at in range(0, len(text), size):
        yield text[max(0, at - context) : at], text[at : at + size], text[at + size : at + size + context]


IDS = "doc_id bigint, ids array<int>, decoded string"


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids).astype(np.int32)))


def encode_small(documents: DataFrame, model: str) -> DataFrame:
    """Encodes and decodes texts that are one chunk each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(model)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            for part in slices(texts):
                ids = machine.encode(texts[part])
                yield pa.RecordBatch.from_arrays([keys[part.start : part.stop], _id_lists(ids), pa.array([machine.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return map_arrow(documents, work, IDS, 500)


def encode_giant(documents: DataFrame, model: str, size: int) -> DataFrame:
    """Encodes long documents chunk by chunk; of one document only the small matrices meet in a task.

    The work is keyed by the text, so repeated rows are encoded once and given
    back as often as they came.
    """
    chunk_rows = "row string, chunk bigint, left string, body string, right string"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = codec(model).reach
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for i, (left, body, right) in enumerate(cut_text(" " + text, size, context)):
                    yield pa.RecordBatch.from_pylist([{"row": row, "chunk": i, "left": left, "body": body, "right": right}])

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(model)
        for batch in batches:
            made = [Chunk(machine, *x).matrix() for x in zip(*(batch.column(n).to_pylist() for n in ("left", "body", "right")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array([m.shape[1] for m in made], pa.int32()), pa.array([m.ravel().tolist() for m in made], pa.list_(pa.float64()))], names=["row", "chunk", "width", "weights"])

    def scan(group):
        group = group.sort_values("chunk")
        path = compose([np.array(w).reshape(-1, n) for w, n in zip(group["weights"], group["width"], strict=True)])
        return group[["row", "chunk"]].assign(entry=[a for a, _ in path], exit=[b for _, b in path])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(model)
        for batch in batches:
            got = [Chunk(machine, left, body, right).ids(a, b) for left, body, right, a, b in zip(*(batch.column(n).to_pylist() for n in ("left", "body", "right", "entry", "exit")), strict=True)]
            text = [machine.decode_bytes(x).decode("utf-8", "replace") for x in got]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array([x.astype(np.int32).tolist() for x in got], pa.list_(pa.int32())), pa.array(text, pa.string())], names=["row", "chunk", "ids", "part"])

    keyed = documents.withColumn("row", F.sha2("text", 256))
    texts = keyed.select("row", "text").dropDuplicates(["row"])
    chunks = cut(map_arrow(texts, split, chunk_rows, 4).repartition("row", "chunk"))
    matrices = map_arrow(chunks, transfer, "row string, chunk bigint, width int, weights array<double>", 16)
    path = matrices.groupBy("row").applyInPandas(scan, "row string, chunk bigint, entry int, exit int")
    traced = chunks.join(path, ["row", "chunk"]).select("row", "chunk", "left", "body", "right", "entry", "exit")
    traced = map_arrow(traced, trace, "row string, chunk bigint, ids array<int>, part string", 16)
    whole = traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids", "part"))).alias("parts"))
    whole = whole.select("row", F.flatten("parts.ids").alias("ids"), F.expr("substring(array_join(parts.part, ''), 2)").alias("decoded"))
    return keyed.select("doc_id", "row").join(whole, "row").select("doc_id", "ids", "decoded")


def encode_documents(documents: DataFrame, model: str, chunk_chars: int = 32_768) -> DataFrame:
    """Ids of every whole text, and the text decoded from them.

    Columns doc_id, ids (without begin or end ids) and decoded. A null or
    empty text has no ids and decodes to an empty text. A text that holds the
    model's own blank mark decodes to a blank in its place, as in the library.
    """
    texts = text_of(documents)
    small = encode_small(texts.where(F.length("text") <= chunk_chars), model)
    return small.unionByName(encode_giant(texts.where(F.length("text") > chunk_chars), model, chunk_chars))


def decode_ids(rows: DataFrame, model: str) -> DataFrame:
    """Texts of rows of (doc_id, ids); null ids decode to an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(model)
        for batch in batches:
            got = [machine.decode(np.array(x or [], np.uint32)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.string())], names=["doc_id", "decoded"])

    return map_arrow(rows.select("doc_id", "ids"), work, "doc_id bigint, decoded string")
