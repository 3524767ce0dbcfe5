"""Best-fit packing: the plan is made over a histogram of lengths, then documents take its slots by rank within their length."""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loom.llm.common import materialize, ship

CAPACITY, END = 2048, 0

#: Words that a task remembers, the longest of them in characters, words that are encoded at a time, words whose ids are held at a time.
_KNOWN, _LONGEST, _AT_ONCE, _RUN = 400_000, 64, 4096, 1 << 18
#: Letters and marks after them, which most tokenizers part anyway.
_PARTS = "^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?]*)$"


def _gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """flat[start : start + n] of each range, one after another."""
    upto = np.cumsum(n)
    return flat[np.repeat(start - upto + n, n) + np.arange(upto[-1] if len(upto) else 0)]


class WordIds:
    """Token ids of many texts, word by word; no token of the tokenizers that this serves reaches over a blank.

    The words of a batch are encoded once each; frequent ones are remembered over batches, in bounded number. Where the tokenizer
    parts marks from the letters before them and ignores case, letters and marks are words of their own; where it gives words of
    small ASCII letters to its model as they are, they go there at once. A few words tell whether it does.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._known = Tokenizer.from_str(tokenizer), {}
        ids = lambda w: self._tokenizer.encode(w, add_special_tokens=False).ids
        self._parted = all(ids(h + t) == ids(h.lower()) + ids(t) for h in ("Word", "ÉTÉ", "i", "THE") for t in (".", "!?", ",;:"))
        self._plain = all(self._by_model(w) == ids(w) for w in ("word", "i", "qqzzx", "antidisestablishmentarianism"))

    def _by_model(self, word: str) -> list[int]:
        return [t.id for t in self._tokenizer.model.tokenize(word)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        out = [self._known.get(w) for w in words]
        missing, others, model = [i for i, x in enumerate(out) if x is None], [], self._tokenizer.model
        for i in missing:
            word = words[i]
            if self._plain and word.isascii() and word.isalpha() and word.islower():
                out[i] = b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(word)])
            else:
                others.append(i)
        for k in range(0, len(others), _AT_ONCE):
            part = others[k : k + _AT_ONCE]
            for i, e in zip(part, self._tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        for i in missing:
            if len(self._known) >= _KNOWN:
                break
            if len(words[i]) <= _LONGEST:
                self._known[words[i]] = out[i]
        return out

    def _vocabulary(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, one after another, and the number of each word's."""
        parts = pc.extract_regex(words, _PARTS) if self._parted else None
        whole = parts is None or parts.null_count == len(parts)
        heads = words if whole else pc.if_else(parts.is_valid(), pc.utf8_lower(pc.struct_field(parts, "head")), words)
        tails = None if whole else pc.fill_null(pc.if_else(parts.is_valid(), pc.struct_field(parts, "tail"), ""), "")
        both = pa.concat_arrays([heads] if whole else [heads, tails]).dictionary_encode()
        coded = self._encoded(both.dictionary.to_pylist())
        flat, n = np.frombuffer(b"".join(coded), "<u4"), np.array([len(x) >> 2 for x in coded], np.int64)
        which = np.asarray(both.indices, dtype=np.int64).reshape(-1, len(words)).T
        return _gather(flat, (np.cumsum(n) - n)[which.ravel()], n[which.ravel()]), n[which].sum(axis=1)

    def runs(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(row, some of its ids, whether they are its last), rows in order; long texts come in several runs."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = pc.list_flatten(lists).dictionary_encode()
        flat, n = self._vocabulary(words.dictionary)
        start, which = np.cumsum(n) - n, np.asarray(words.indices, dtype=np.int64)
        ends = np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))
        row = 0
        for a in range(0, len(which), _RUN):
            w = which[a : a + _RUN]
            upto, ids = np.cumsum(n[w]), _gather(flat, start[w], n[w])
            done = 0
            while row < len(texts) and ends[row] <= a + len(w):
                end = int(upto[ends[row] - a - 1])
                yield row, ids[done:end], True
                row, done = row + 1, end
            if done < len(ids) and row < len(texts):
                yield row, ids[done:], False


def pieces(docs: DataFrame, tokenizer: str | Path, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, rank[, ids]): each document's ids and the end id, cut into pieces of capacity where longer.

    Null and empty texts are the end id alone; repeated rows are documents of their own, null ids too; no other column is read. rank counts
    the pieces of a length within their task. The tokenizer's file is read on the driver and broadcast (a vocabulary, not data). A
    task holds one Arrow batch of texts, and of a long text its words and the ids of _RUN words.
    """
    ship(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    kind = docs.schema[id_col].dataType
    fields = [T.StructField("id", kind), *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, task int, rank long").fields]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, words = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), WordIds(vocabulary.value)
        for batch in batches:
            rows, numbers, starts, parts = [], [], [], []
            held, piece = np.zeros(0, "<u4"), 0
            for row, ids, last in words.runs(batch.column(1)):
                held = np.concatenate([held, ids, np.array([end], "<u4")] if last else [held, ids])
                whole = len(held) if last else len(held) // capacity * capacity
                for a in range(0, whole, capacity):
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(piece * capacity)
                    parts.append(held[a : min(a + capacity, whole)])
                    piece += 1
                held = held[whole:]
                if last:
                    piece = 0
            n = np.array([len(x) for x in parts], np.int64)
            order = np.argsort(n, kind="stable")
            rank = np.empty(len(n), np.int64)
            rank[order] = seen[n[order]] + np.arange(len(n)) - np.searchsorted(n[order], n[order])
            seen += np.bincount(n, minlength=capacity + 1)
            crc = pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64())
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), crc,
                pa.array(np.full(len(n), task), pa.int32()), pa.array(rank)]
            if with_ids:
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, "<u4"), *parts]).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """The plan for counts of lengths: rows (length, first rank, first sequence, pieces a sequence, offset), sorted.

    Best fit by falling length, over counts: of all sequences with equal room, as many as there are pieces for take as many of the
    length as fit, the fullest sequences first. The piece of rank r stands in sequence first + (r - first rank) // each, at
    offset + (r - first rank) % each * length. Sequences with equal room are kept as intervals, at most a few for each length, so the
    plan's size has a bound that only capacity sets.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    levels: list[int] = []
    out, used = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                bisect.insort(levels, room)
                rooms[room] = []
            rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(room: int, first: int, n: int) -> int:
            """Fills sequences of this room while pieces are left; gives how many it touched."""
            nonlocal left, rank
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if full < n and left:
                out.append((length, rank, first + full, each, capacity - room))
                put(room - left * length, first + full, 1)
                left, rank, full = 0, rank + left, full + 1
            return full

        for room in levels[bisect.bisect_left(levels, length) :]:
            if not left:
                break
            levels.remove(room)
            for first, n in rooms.pop(room):
                touched = fill(room, first, n) if left else 0
                put(room, first + touched, n - touched)
        if left:
            used += fill(capacity, used, left)
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | Path, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with sequence_id and offset: packed into sequences of at most capacity tokens, gapless from 0.

    pieces() says what becomes of nulls, empty, long and repeated rows; an empty table gives an empty one. The pieces are
    written once. Driver and plan hold the counts of at most capacity lengths, however many documents there are. Ranks are
    counted within tasks and then shifted by the counts of the tasks before, so that no length's pieces meet in one task.
    """
    own = materialize(pieces(docs, tokenizer, capacity, end, id_col, text_col, with_ids))
    counts = materialize(own.groupBy("length", "task").agg(F.count("*").alias("n")))
    slots = best_fit({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    plan = docs.sparkSession.sparkContext.broadcast(slots)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    ranked = own.join(counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")), ["length", "task"])
    columns = [c for c in own.columns if c not in ("task", "rank")]
    ranked = ranked.select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    at, place = columns.index("length"), len(columns)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, each, offset = plan.value.T
        keys = (length << 44) + first
        for batch in batches:
            n, rank = np.asarray(batch.column(at), dtype=np.int64), np.asarray(batch.column(place), dtype=np.int64)
            i = np.searchsorted(keys, (n << 44) + rank, "right") - 1
            past = rank - first[i]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(sequence[i] + past // each[i]), pa.array(offset[i] + past % each[i] * n)],
                names=[*columns, "sequence_id", "offset"])

    fields = [ranked.schema[c] for c in columns] + T.StructType.fromDDL("sequence_id long, offset long").fields
    return ranked.mapInArrow(take, T.StructType(fields)).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with ids: at most capacity tokens a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
