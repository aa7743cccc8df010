"""Best-fit-decreasing packing with bounds that certify the bin count.

Documents are tokenised (a pass without a shuffle), and documents longer than
a sequence are cut.  Pieces, from here on only (key, length), are dealt evenly
over tasks, and each task packs its own by best fit decreasing.  It also
computes the largest of several dual-feasible-function lower bounds on how many
sequences its pieces need.  A task whose count equals its bound is certified;
one with a gap puts the pieces of all sequences that aren't nearly full back
into play, a certified one only those of its emptiest sequence.  The released
pieces are exchanged, in larger mixtures per sequence, and packed again, until
the total equals the lower bound of all pieces or a round saves nothing.
"""

from __future__ import annotations

import itertools
import math
import sys
import types
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize

CAPACITY = 4096
END = 1                 # id that ends every document
PER_TASK = 100_000      # pieces that one task packs
NEARLY_FULL = 0.99
KNOWN = 600_000         # words whose ids a worker remembers


# --------------------------------------------------------------------------
# Tokens

def tokenizer_text(path: str | None = None) -> str:
    """Text of a tokenizer file; by default the public 49k word BPE."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def worker_state(key: str) -> dict:
    """A dict that lives as long as the Python worker."""
    holder = sys.modules.setdefault("_chainsight_llm_worker", types.ModuleType("_chainsight_llm_worker"))
    return holder.__dict__.setdefault(key, {})


class Encoder(dict):
    """Ids of whole texts, equal to the tokenizer's.

    The tokenizer never merges across white space, nor across the border of a
    run of letters, so this remembers the ids of white-space-separated parts; a
    word before a comma or full stop is the word and the sign.  Texts that hold
    one of the few control characters on whose being white space Python and the
    tokenizer disagree are encoded whole."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_str(text)
        self.signs = {c: self.raw(c) for c in ",."}

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        sign = self.signs.get(part[-1])
        if sign is not None:
            word = part[:-1]
            # only where lower-casing leaves letters alone is there a border before the sign
            if word.isalpha() and (word.isascii() or word.lower().isalpha()):
                return self[word] + sign
        if part.isascii() and part.isalpha():  # the tokenizer knows ASCII letters as they are, lower-cased
            found = np.array([t.id for t in self.tokenizer.model.tokenize(part.lower())], "<u4").tobytes()
        else:
            found = self.raw(part)
        self[part] = found
        return found

    def encode(self, text: str) -> bytes:
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self.raw(text)
        if len(self) > KNOWN:
            self.clear()
        if "<|" not in text:  # the tokenizer lower-cases, except its special tokens
            text = text.encode().lower().decode()  # A to Z only
        return b"".join(map(self.__getitem__, text.split()))


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``id_col``, piece, start, length, ids_crc32 (and ids) of every piece of every document.

    A null text is an empty one, which is the end id alone."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    given = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))
    kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        state = worker_state("encoder")
        text = given.value
        key = zlib.crc32(text.encode())
        if key not in state:
            state.clear()
            state[key] = Encoder(text)
        encoder = state[key]
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids, piece, start, length, crc, data = [], [], [], [], [], []
            for doc, value in enumerate(batch.column(1)):
                tokens = encoder.encode(value.as_py() or "") + end
                for n, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at:at + 4 * capacity]
                    ids.append(doc)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    data.append(np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None)
            columns = [batch.column(0).take(pa.array(ids, pa.int64())).cast(kind), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(data, pa.list_(pa.int32()))] * with_ids,
                names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" \
        + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------------------
# Packing

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Largest of the dual-feasible-function bounds on the bins that a multiset of
    lengths (length -> count) needs: the plain volume, for each threshold t the
    lengths over capacity - t as whole bins and those under t as nothing, and
    for k up to 20 the rounding of (k + 1) * x / capacity to k-ths."""
    if not counts:
        return 0
    sizes = np.array(sorted(counts), np.int64)
    many = np.array([counts[s] for s in sizes.tolist()], np.int64)
    best = -(-int((sizes * many).sum()) // capacity)
    thresholds = np.unique(np.concatenate((sizes[sizes <= capacity // 2], capacity - sizes[sizes > capacity // 2] + 1)))
    volume = np.concatenate(([0], np.cumsum(sizes * many)))
    number = np.concatenate(([0], np.cumsum(many)))
    for t in thresholds[thresholds <= capacity // 2].tolist():
        big = np.searchsorted(sizes, capacity - t, side="right")
        small = np.searchsorted(sizes, t, side="left")
        whole = int(number[-1] - number[big])
        rest = int(volume[big] - volume[small]) if big > small else 0
        best = max(best, whole + -(-rest // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        worth = np.where(exact, sizes * k, scaled // capacity * capacity)  # times k
        best = max(best, -(-int((worth * many).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the fill of each bin."""
    place = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    fill: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some open bin has room for exactly r
    order = np.argsort(-lengths, kind="stable")
    for at, size in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bins = by_room[room]
            b = bins.pop()
            if not bins:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        place[at], offset[at] = b, fill[b]
        fill[b] += size
        room -= size
        if room:
            bins = by_room.setdefault(room, [])
            if not bins:
                rooms |= 1 << room
            bins.append(b)
    return place, offset, np.array(fill, np.int64)


def pack_task(capacity: int, turn: int):
    """mapInArrow function: pieces (key, length) of a task -> their places, whether
    each is released, and, in a row without key, the task's bins, those released,
    and its lower bound."""
    names = ["key", "length", "sequence", "offset", "released", "bins", "released_bins", "bound"]

    def run(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        keys, lengths = (np.concatenate(x) for x in zip(*parts))
        place, offset, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(Counter(lengths.tolist()), capacity)
        release = fill < NEARLY_FULL * capacity
        if len(fill) == bound:
            release &= np.arange(len(fill)) == fill.argmin()
        first = (turn << 48) + (TaskContext.get().partitionId() << 24)
        n = len(keys)
        none = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(lengths), pa.array(first + place), pa.array(offset),
             pa.array(release[place]), none, none, none], names=names)
        one = [pa.array([x], pa.int64()) for x in (len(fill), int(release.sum()), bound)]
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([False]), *one], names=names)
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_task: int = PER_TASK) -> DataFrame:
    """(key, sequence, offset) for each row (key, length) of ``pieces``; keys are distinct,
    lengths from 1 to ``capacity``."""
    schema = "key long, length long, sequence long, offset long, released boolean, " \
             "bins long, released_bins long, bound long"
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    bound = lower_bound({r["length"]: r["count"] for r in histogram}, capacity)
    rows = sum(r["count"] for r in histogram)
    todo, done, bins, earlier = pieces.select("key", "length"), None, 0, None
    for turn in itertools.count():
        tasks = max(1, math.ceil(rows / per_task))
        packed = materialize(todo.repartition(tasks, "key").mapInArrow(pack_task(capacity, turn), schema))
        told = packed.where("key IS NULL").agg(
            F.sum("bins").alias("bins"), F.sum("released_bins").alias("released")).first()
        now, released = told["bins"] or 0, told["released"] or 0
        places = packed.where("key IS NOT NULL")
        if earlier is not None and now >= earlier[1]:  # nothing saved: leave these as they were
            places, released, now = earlier[0], 0, earlier[1]
        bins += now
        chosen = places.select("key", "sequence", "offset")
        if bins <= bound or not released or released == 1 or \
                (earlier is not None and places is earlier[0]):
            return chosen if done is None else done.union(chosen)
        kept = places.where("NOT released").select("key", "sequence", "offset")
        done = kept if done is None else done.union(kept)
        todo = places.where("released")
        rows = todo.count()
        earlier = todo, released
        bins -= released
    raise AssertionError("unreachable")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Places of all pieces of all documents: ``id_col``, piece, start, length,
    ids_crc32, sequence_id, offset (and ids).

    A null or empty text is one piece, the end id.  Null ids and repeated rows
    are documents of their own.  An empty table gives no rows.  Other columns are
    not read."""
    pieces = materialize(pieces_of(docs, id_col, text_col, tokenizer, capacity, with_ids)
                         .withColumn("key", F.monotonically_increasing_id()))
    places = pack(pieces, capacity)
    return pieces.join(places, "key").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        F.col("sequence").alias("sequence_id"), "offset", *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of ``pack_documents(..., with_ids=True)``; a sequence has at most
    ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
