"""Best-fit packing of tokenised documents into sequences, with certified bounds.

Each document is its token ids and an end id; longer ones are cut so that only the first piece is short. Full pieces are
sequences of their own. The others are dealt evenly over partitions of a bounded number of pieces. Each partition packs its pieces by best-fit
decreasing and computes a lower bound on its sequences from dual feasible functions. A partition that meets its bound is certified and done.
A partition with a gap gives its emptiest sequences back; these are dealt anew, together with those of all other partitions with gaps, and packed
again. A partition of a later round keeps what it got unless it needs fewer sequences, so no round makes the packing worse.

Defined results: a null text is empty, so it is the end id alone. Rows that repeat an id are packed each for itself. An
empty table gives no pieces. Extra columns are neither read nor returned.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from creaseline.llm.common import ship_package, staged

SPECIAL = "<|endoftext|>"  # the tokenizer reads this in a text as one id
PIECE_FIELDS = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("slot", pa.int64())]


class TokenIds:
    """Ids of texts as bytes of little-endian unsigned 32-bit numbers.

    The ranks give the same ids as the tokenizer file, several times as fast; a text with the tokenizer's special token goes
    to the tokenizer itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.exact = Tokenizer.from_file(vocabulary)

    def encode(self, text: str) -> bytes:
        ids = self.exact.encode(text, add_special_tokens=False).ids if SPECIAL in text else self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def token_ids(vocabulary: str, ranks: str) -> TokenIds:
    return TokenIds(vocabulary, ranks)


def tokenize(docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
             ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, slot (a number of its own), and the ids if asked for."""
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fields = [T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "slot")]]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, slot = token_ids(vocabulary, ranks), TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                source, rows, ids = [], [], []
                for at, text in enumerate(part.column(text_col).to_pylist()):
                    data = encoder.encode(text or "") + tail
                    n, stop, piece = len(data) // 4, 0, 0
                    while stop < n:
                        start, stop = stop, stop + ((n - stop) % capacity or capacity)
                        bit = data[4 * start:4 * stop]
                        rows.append((piece, start, stop - start, zlib.crc32(bit), slot))
                        source.append(at)
                        if with_ids:
                            ids.append(np.frombuffer(bit, "<u4").astype(np.int32))
                        piece, slot = piece + 1, slot + 1
                columns = [part.column(id_col).take(pa.array(source, pa.int64())), *[pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(PIECE_FIELDS)]]
                names = [id_col, *[name for name, _ in PIECE_FIELDS]]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> float:
    """The largest sum that a dual feasible function gives, in sequences: no packing has fewer. counts: pieces by length.

    Two families: lengths above capacity - t become whole and those below t nothing, for each t up to one half; and for each k
    a length becomes floor((k + 1) x / C) / k, or stays x / C where (k + 1) x / C is whole. The second also after the first.
    """
    size = np.arange(capacity + 1)
    best = counts @ size / capacity
    used = np.flatnonzero(counts)
    size, weight = used, counts[used].astype(float)
    if not len(used):
        return 0.0
    turns = np.unique(np.concatenate(([0], used[used <= capacity // 2])))
    bent = np.where(size[None, :] > capacity - turns[:, None], capacity, np.where(size[None, :] < turns[:, None], 0, size[None, :]))
    best = max(best, float((bent @ weight).max()) / capacity)
    for k in range(1, 17):
        scaled = (k + 1) * bent
        step = np.where(scaled % capacity == 0, k * bent, scaled // capacity * capacity)
        best = max(best, float((step @ weight).max()) / (k * capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each piece, and the free room of each bin.

    Open bins stand in stacks by free room; a bit mask of the rooms in use finds the smallest that is large enough.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[at])
        fitting = mask >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            target = open_bins[free].pop()
            if not open_bins[free]:
                mask ^= 1 << free
        else:
            free, target = capacity, len(room)
            room.append(capacity)
        bins[at], offsets[at] = target, capacity - free
        room[target] = left = free - need
        if left:
            open_bins[left].append(target)
            mask |= 1 << left
    return bins, offsets, room


def pack_group(frame: pd.DataFrame, capacity: int, turn: int, last: bool, release: int) -> pd.DataFrame:
    """One partition: packed, with its bound; `done` marks the pieces that stay where they are.

    From the second round on a partition holds whole sequences of earlier ones, and keeps these unless it needs fewer. A partition with a gap
    gives back its emptiest sequences, `release` for each one that it is above its bound.
    """
    frame = frame.sort_values("slot", ignore_index=True)
    lengths = frame["length"].to_numpy()
    bins, offsets, room = best_fit(lengths, capacity)
    names = (turn << 56) + (int(frame["part"].iloc[0]) << 28) + np.arange(len(room))
    if turn > 1:
        old, places = np.unique(frame["sequence_id"].to_numpy(), return_inverse=True)
        if len(old) <= len(room):
            bins, offsets, names = places, frame["offset"].to_numpy(), old
            room = capacity - np.bincount(places, lengths).astype(np.int64)
    room = np.asarray(room)
    gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    done = np.ones(len(room), bool)
    if not last and gap > 1e-9:
        done[np.argsort(-room, kind="stable")[:release * math.ceil(gap)]] = False
    return frame.assign(sequence_id=names[bins], offset=offsets, gap=gap, done=done[bins])


def packer(capacity: int, turn: int, last: bool, release: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pack_group(frame, capacity, turn, last, release)
    return run


def pack(pieces: DataFrame, capacity: int = 1024, partition_pieces: int = 16_000, rounds: int = 4, release: int = 64) -> DataFrame:
    """`pieces` (staged: with length and slot) with sequence_id, offset and the certificate of the sequence: the round and partition that closed it, and the gap.

    gap is how many sequences that partition had above its bound then; below 1, no packing of its pieces has fewer. Pieces of the whole capacity have a sequence
    each, in round 0, without a partition and with gap 0. The last of `rounds` rounds, or one of a single partition, keeps all that it packs.
    """
    ship_package(pieces.sparkSession)
    full = pieces.where(F.col("length") == capacity).select("*", (F.col("slot") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
                                                           F.lit(0).alias("round"), F.lit(None).cast("bigint").alias("part"), F.lit(0.0).alias("gap"))
    done = [full]
    rest = pieces.where(F.col("length") < capacity).withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    schema = T.StructType([*rest.schema.fields, T.StructField("part", T.LongType()), T.StructField("gap", T.DoubleType()), T.StructField("done", T.BooleanType())])
    for turn in range(1, rounds + 1):
        n = rest.count()
        if not n:
            break
        parts = -(-n // partition_pieces)
        last = parts == 1 or turn == rounds
        deal = F.xxhash64("slot") if turn == 1 else F.xxhash64("sequence_id", F.lit(turn))  # sequences move as they are
        dealt = rest.withColumn("part", F.pmod(deal, F.lit(parts)))
        packed = staged(dealt.groupBy("part").applyInPandas(packer(capacity, turn, last, release), schema), f"packed-{turn}")
        done.append(packed.where("done").withColumn("round", F.lit(turn)).drop("done"))
        if last:
            break
        rest = packed.where("NOT done").drop("part", "gap", "done")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, **options) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset, round, part, gap (and ids)."""
    pieces = staged(tokenize(docs, capacity, end_id, id_col, text_col, with_ids=with_ids), "pieces")
    return pack(pieces, capacity, **options).drop("slot")


def certificate(packed: DataFrame, capacity: int = 1024) -> tuple[int, int]:
    """(sequences used, sequences that every packing of these pieces needs by the bound). One count for each length comes to the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in packed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    used = packed.where("offset = 0").count()
    return used, math.ceil(lower_bound(counts, capacity) - 1e-6)


def sequences(packed: DataFrame) -> DataFrame:
    """Token sequences from pieces packed with their ids: one row per sequence, pieces in order of their offset."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    return rows.select("sequence_id", F.flatten(F.col("pieces.ids")).alias("ids"))
