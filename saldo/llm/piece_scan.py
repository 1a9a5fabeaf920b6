"""SentencePiece encoding and decoding; giant texts by a max-plus parallel scan.

A segmentation is a path through the lattice of vocabulary pieces. In a unigram model a path's weight is the
sum of its pieces' scores. In a byte-pair model the right path is the one in which every two neighbouring
pieces are compatible (merging their text alone gives these two pieces), so compatibility is 0 or -inf in
the max-plus algebra and the same scan finds it. Results equal those of the sentencepiece library.

A text of over CHUNK characters is cut into chunks at any place. The state at a cut is the piece that
crosses or ends at it. Each chunk yields a transfer matrix, the best weight from each state at its
left end to each state at its right end; matrices are combined associatively along the text, the best
state at every cut follows, and each chunk is backtraced on its own between its two states.
Inside a chunk, no piece crosses a place whose two characters are never side by side in a piece (such as a
word end before a blank). What lies between the first and the last such place does not depend on the states
at the cuts, so the library encodes it; only the stretches beyond them are walked state by state.

Scale: only giant texts are shuffled, a row for each chunk. Everything else is encoded where it is read.
Matrices have at most some dozens of states a side, and a row's size bounds the chunks of a text. The
model file is read on the driver and broadcast, MODEL_BYTES at most.

Defined cases: a null text gives null ids and decodes to null; an empty text gives no ids. A literal U+2581
in a text reads back as a blank, as in the library. Repeated rows and null ids stay rows of their own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from saldo.llm.common import bound_batches
from saldo.session import staged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20
CHUNK = 32768
# Characters whose ids are Python lists at once.
ENCODED = 1 << 19
REMEMBERED = 100_000
BLANK = "▁"
NEVER = -np.inf


class Pieces:
    """A vocabulary and what the scan needs from it."""

    def __init__(self, model: bytes) -> None:
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        norm, self.unigram = spec.normalizer_spec, spec.trainer_spec.model_type == 1
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is are supported")
        if spec.trainer_spec.model_type not in (1, 2) or any(p.type == 4 for p in spec.pieces):
            raise ValueError("only unigram and byte-pair models without user-defined pieces are supported")
        self.prefix = BLANK if norm.add_dummy_prefix else ""
        # what a piece of each kind reads as: ordinary text, unknown, control, byte
        kinds = {2: lambda p: " \u2047 ".encode(), 3: lambda p: b"", 5: lambda p: b"", 6: lambda p: bytes([int(p[1:-1], 16)])}
        self.spelled = [kinds.get(p.type, lambda p: p.replace(BLANK, " ").encode())(p.piece) for p in spec.pieces]
        norm.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        normal = [(p.piece, p.score) for p in spec.pieces if p.type == 1]
        self.scores = dict(normal)
        self.longest = max((len(p) for p in self.scores), default=1)
        self.pairs = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self.unknown_score = min((s for _, s in normal), default=0.0) - 10.0
        self.known = lru_cache(REMEMBERED)(self.bare.encode)
        self.valid = lru_cache(REMEMBERED)(self._valid)
        self.compatible = lru_cache(REMEMBERED)(self._compatible)

    def escaped(self, text: str) -> str:
        return self.prefix + text.replace(" ", BLANK) if text else ""

    def encode(self, escaped: str) -> list[int]:
        """Ids of a text whose ends are ends of pieces."""
        return self.bare.encode(escaped)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.prefix else text

    def _valid(self, part: str) -> bool:
        return len(part) == 1 or part in self.scores and (self.unigram or self.bare.encode(part, out_type=str) == [part])

    def _compatible(self, a: str, b: str) -> bool:
        """Whether merging the text of both gives these two again."""
        if self.unigram or a[-1] + b[0] not in self.pairs:
            return True
        return self.bare.encode(a + b) == [*self.known(a), *self.known(b)]

    def weight(self, part: str) -> float:
        return self.scores.get(part, self.unknown_score) if self.unigram else 0.0

    def safe(self, text: str, at: int) -> bool:
        """Whether no piece crosses this place."""
        return text[at - 1 : at + 1] not in self.pairs

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Pieces that begin before the cut and end at or after it, relative to the cut."""
        return [
            (a - cut, b - cut) for a in range(max(0, cut - self.longest), cut)
            for b in range(cut, min(len(text), a + self.longest) + 1) if self.valid(text[a:b])
        ]


class Chunk:
    """One chunk of an escaped text: `text` holds it from `low` to `high` with the context on both sides."""

    def __init__(self, pieces: Pieces, text: str, low: int, high: int, first: bool, last: bool) -> None:
        self.pieces, self.text, self.low, self.high = pieces, text, low, high
        self.entry = [None] if first else pieces.states(text, low)
        self.exit = [None] if last else pieces.states(text, high)
        inside = range(low + 1, high)
        self.head = low if first else next((p for p in inside if pieces.safe(text, p)), None)
        self.tail = None if self.head is None else high if last else next(
            (p for p in reversed(inside) if p >= self.head and pieces.safe(text, p)), self.head
        )

    def walk(self, begin: dict[int, list[tuple[str, np.ndarray]]], low: int, high: int):
        """Best weights of pieces that begin from `low` on and before `high`, by their end; the weights are
        vectors. begin: pieces before, by their end."""
        ends = {k: list(v) for k, v in begin.items()}
        text, p = self.text, self.pieces
        for at in range(low, high):
            for b in range(at + 1, min(len(text), at + p.longest) + 1) if at in ends else ():
                if p.valid(part := text[at:b]):
                    paths = [v for before, v in ends[at] if not before or p.compatible(before, part)]
                    if paths and (best := np.max(paths, axis=0) + p.weight(part)).max() > NEVER:
                        ends.setdefault(b, []).append((part, best))
        return ends

    def opened(self, states: list) -> dict[int, list[tuple[str, np.ndarray]]]:
        """One unit vector for each state at the left end."""
        begin: dict[int, list[tuple[str, np.ndarray]]] = {}
        for i, state in enumerate(states):
            unit = np.full(len(states), NEVER)
            unit[i] = 0.0
            end, part = (self.low, "") if state is None else (self.low + state[1], self.text[self.low + state[0] : self.low + state[1]])
            begin.setdefault(end, []).append((part, unit))
        return begin

    def closed(self, ends: dict, size: int, start: int) -> np.ndarray:
        """Weights (entry x exit) read off the pieces that cross the right end; a state that begins before
        `start` cannot occur."""
        out = np.full((size, len(self.exit)), NEVER)
        for j, state in enumerate(self.exit):
            end = self.high + (state[1] if state else 0)
            for part, v in ends.get(end, ()):
                if state is None or part and end - len(part) == self.high + state[0]:
                    out[:, j] = np.maximum(out[:, j], v)
        return out

    def matrix(self) -> np.ndarray:
        """The transfer matrix, entry states by exit states."""
        size, begin = len(self.entry), self.opened(self.entry)
        if self.head is None:
            return self.closed(self.walk(begin, self.low, self.high), size, self.low)
        head = np.max([v for _, v in self.walk(begin, self.low, self.head)[self.head]], axis=0)
        body = self.body_weight()
        if self.exit == [None]:
            return (head + body)[:, None]
        tail = self.closed(self.walk({self.tail: [("", np.zeros(1))]}, self.tail, self.high), 1, self.tail)
        return head[:, None] + body + tail

    def body_weight(self) -> float:
        if not self.pieces.unigram:
            return 0.0
        return float(sum(map(self.pieces.bare.get_score, self.pieces.encode(self.text[self.head : self.tail]))))

    def path(self, begin: tuple[int, str], low: int, end: int, last: str | None) -> list[str]:
        """The best pieces from `low` to `end`, the last one given, after the piece that ends at begin."""
        ends = self.walk({begin[0]: [(begin[1], np.zeros(1))]}, low, self.high if last else end)
        parts, after = [], last
        if last is not None:
            parts, end = [last], end - len(last)
        while end > begin[0]:
            part, _ = max(
                ((x, v[0]) for x, v in ends[end] if end - len(x) >= begin[0] and (after is None or self.pieces.compatible(x, after))),
                key=lambda x: (x[1], len(x[0])),
            )
            parts.append(part)
            after, end = part, end - len(part)
        return parts[::-1]

    def ids(self, entry: int, exit_: int) -> list[int]:
        """Ids of the pieces that begin in this chunk, between the two states."""
        a, b = self.entry[entry], self.exit[exit_]
        before = (self.low, "") if a is None else (self.low + a[1], self.text[self.low + a[0] : self.low + a[1]])
        end = self.high + (b[1] if b else 0)
        final = self.text[self.high + b[0] : end] if b else None
        known = self.pieces.known
        if self.head is None:
            return [i for x in self.path(before, before[0], end, final) for i in known(x)]
        out = [i for x in self.path(before, before[0], self.head, None) for i in known(x)]
        out += self.pieces.encode(self.text[self.head : self.tail])
        if b is not None:
            out += [i for x in self.path((self.tail, ""), self.tail, end, final) for i in known(x)]
        return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first i matrices, by pairwise combination (the product is associative)."""
    if len(matrices) == 1:
        return matrices
    paired = [times(*matrices[i : i + 2]) for i in range(0, len(matrices) - 1, 2)]
    inner = prefixes(paired)
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(inner[i // 2] if i % 2 else times(inner[i // 2 - 1], matrices[i]))
    return out


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every cut on the best path, from the first entry to the last exit."""
    before = prefixes(matrices)
    states = [0]
    for i in range(len(matrices) - 1, 0, -1):
        states.append(int((before[i - 1][0] + matrices[i][:, states[-1]]).argmax()))
    return [0, *reversed(states)] if len(matrices) > 1 else [0, 0]


def cut(escaped: str, size: int, context: int) -> Iterator[tuple[int, int, str, int, int]]:
    """(number, chunks, text with context, begin, end) of each chunk."""
    total = max(1, len(escaped) // size)
    for i in range(total):
        low, high = i * size, len(escaped) if i == total - 1 else (i + 1) * size
        start = max(0, low - context)
        yield i, total, escaped[start : high + context], low - start, high - start


def slices(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """Texts in order, some `size` characters at a time."""
    held, filled = [], 0
    for text in texts:
        if held and filled + len(text or "") > size:
            yield held
            held, filled = [], 0
        held.append(text)
        filled += len(text or "")
    if held:
        yield held


def flat_ids(rows: list[list[int]]) -> tuple[list[int], np.ndarray]:
    """Sizes of lists of ids, and all ids."""
    sizes = [len(x) for x in rows]
    return sizes, np.fromiter(chain.from_iterable(rows), np.int32, sum(sizes))


def list_array(missing: list[bool], sizes: list[int], flat: list[np.ndarray]) -> pa.Array:
    """Arrow list column of lists of ids; `sizes` has a 0 for what is missing."""
    offsets = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
    ids = np.concatenate([*flat, np.empty(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids, mask=pa.array(missing, pa.bool_()))


def traced(pieces: Pieces, batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The ids of chunks whose states at both cuts are known, `size` chunks at a time: (row, part, ids)."""
    for low in range(0, batch.num_rows, size):
        some = batch.slice(low, size)
        sizes, flat = [], []
        for x in some.to_pylist():
            own = Chunk(pieces, x["body"], x["low"], x["high"], x["part"] == 0, x["part"] == x["parts"] - 1).ids(x["entry"], x["exit"])
            sizes.append(len(own))
            flat.append(np.array(own, np.int32))
        ids = list_array([False] * len(sizes), sizes, flat)
        yield pa.RecordBatch.from_arrays([some["row"], some["part"], ids], ["row", "part", "ids"])


def read_model(path: str = MODEL) -> bytes:
    if os.path.getsize(path) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    with open(path, "rb") as file:
        return file.read()


@lru_cache(2)
def loaded(model: bytes) -> Pieces:
    return Pieces(model)


def encode_texts(documents: DataFrame, model: str = MODEL, chunk: int = CHUNK, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `text` of every document, with `token_ids` array<int>."""
    spark = documents.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(read_model(model))
    context = loaded(shared.value).longest
    if chunk < 2 * context:
        raise ValueError(f"a chunk has {2 * context} characters at least")
    slim = documents.select(*keep, F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk

    def encode(texts: pa.Array) -> pa.Array:
        pieces, rows, sizes, flat = loaded(shared.value), texts.to_pylist(), [], []
        # ids leave Python's lists, ten times their size, slice by slice
        for part in slices(rows, ENCODED):
            own, ids = flat_ids(pieces.bare.encode([pieces.escaped(x or "") for x in part], num_threads=1))
            sizes += own
            flat.append(ids)
        return list_array([x is None for x in rows], sizes, flat)

    direct = slim.where(~giant).withColumn("token_ids", F.arrow_udf(encode, "array<int>").asNondeterministic()(F.col("text")))

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = loaded(shared.value)
        for batch in batches:
            for row, text in zip(batch["row"], batch["text"], strict=True):
                for x in cut(pieces.escaped(text), chunk, context):
                    yield pd.DataFrame([(row, *x)], columns=["row", "part", "parts", "body", "low", "high"])

    def transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = loaded(shared.value)
        for batch in batches:
            rows = []
            for x in batch.itertuples():
                m = Chunk(pieces, x.body, x.low, x.high, x.part == 0, x.part == x.parts - 1).matrix()
                rows.append((x.row, x.part, m.shape[0], m.tobytes()))
            yield pd.DataFrame(rows, columns=["row", "part", "entries", "matrix"])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        matrices = [np.frombuffer(m).reshape(n, -1) for n, m in zip(group["entries"], group["matrix"], strict=True)]
        states = cut_states(matrices)
        return pd.DataFrame({"row": group["row"], "part": group["part"], "entry": states[:-1], "exit": states[1:]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from traced(loaded(shared.value), batch, max(1, ENCODED // chunk))

    giants = staged(slim.where(giant).withColumn("__row", F.monotonically_increasing_id()), "giant-texts")
    parts = staged(
        giants.select(F.col("__row").alias("row"), "text").mapInPandas(chunks, "row long, part int, parts int, body string, low int, high int"),
        "giant-chunks",
    )
    moves = parts.mapInPandas(transfer, "row long, part int, entries int, matrix binary")
    chosen = staged(moves.groupBy("row").applyInPandas(choose, "row long, part int, entry int, exit int"), "cut-states")
    ids = parts.join(chosen, ["row", "part"]).mapInArrow(trace, "row long, part int, ids array<int>")
    whole = ids.groupBy(F.col("row").alias("__row")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "ids"))), lambda x: x["ids"])).alias("token_ids")
    )
    return direct.unionByName(giants.join(whole, "__row").drop("__row"))


def decode_ids(spark: SparkSession, ids: Column, model: str = MODEL) -> Column:
    """Text of an array of ids."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(read_model(model))

    def decode(rows: pa.Array) -> pa.Array:
        pieces, flat, at = loaded(shared.value), rows.values.to_numpy(), rows.offsets.to_pylist()
        known = rows.is_valid().to_pylist()
        texts = [pieces.decode(flat[a:b].tolist()) if ok else None for ok, a, b in zip(known, at[:-1], at[1:], strict=True)]
        return pa.array(texts, pa.string())

    return F.arrow_udf(decode, "string")(ids)


def op8_pieces(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """Every document: number of ids and their digest, and whether decoding gives the text again."""
    coded = encode_texts(documents, model)
    read = coded.withColumn("back", decode_ids(documents.sparkSession, F.col("token_ids"), model))
    return read.select(
        "doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_ids"),
        F.sha2(F.col("token_ids").cast("string"), 256).alias("ids_sha256"),
        F.col("back").eqNullSafe(F.col("text")).alias("round_trip"),
    )
