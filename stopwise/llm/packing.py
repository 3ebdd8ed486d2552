"""Best-fit packing of documents into token sequences of one size, by minimum bin slack.

Every document becomes its token ids and an end id. A document longer than a sequence is cut
into full pieces and a rest; no other is cut. Pieces are written once with their ids, and only
the number of pieces of each length, at most ``size`` numbers, reaches the driver.

Minimum bin slack over these counts: the longest piece left opens a sequence, and a subset-sum
dynamic programme over the available lengths, a bit for each reachable sum, finds the fullest
combination for the rest of it. It is removed as often as the counts allow, since until then it
stays the fullest one for that opening piece. Each time, some length falls below its use in the
combination, hence to half its count at most when it is used again; so there are fewer than
``size * (2 + log2(size))`` combinations however many documents there are.

A piece finds its sequence by its rank among the pieces of its length. Ranks are counted within
the parts in which pieces were written and shifted by the counts of the parts before, so no
length, however common, is gathered in a task.

Rows. A null or empty text is the end id alone. Repeated rows and null ids are documents of
their own. An empty table gives no pieces. Only the two named columns are read.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.taskcontext import TaskContext

from ..session import stage
from .pretoken import row_portions

SIZE = 4096                  # tokens of a sequence
END_ID = 1
PORTION_BYTES = 4_000_000    # text that a task holds as words and ids at once
WORDS_KEPT = 250_000         # words of a generation; a worker keeps two
OFFSET_ROWS = 200_000        # counts of parts and lengths that are broadcast
BREAK = "<|endoftext|>"      # parts words in one call; its id cannot come from a word

_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_LOWER_LATER = re.compile("[^\x00-\u012f\u0131-\u017f]")   # lower case may depend on neighbours
_MARKS = string.punctuation.replace("'", "")     # after letters these are one word to the tokenizer


class WordEncoder:
    """Ids of whole texts, as the tokenizer gives them, from the ids of their words.

    The tokenizer drops white space and never joins characters across it, so the ids of a text
    are those of its words in order. The different words of many texts are looked up once, their
    letters apart from the marks after them. New letters and marks are encoded by the
    tokenizer's model alone, since the steps before it leave them one word; the rest, by all of it.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.split_id = self.tokenizer.token_to_id(BREAK)
        self.packed = [i.to_bytes(4, "little") for i in range(
            1 + max(self.tokenizer.get_vocab().values()))]
        splitter = self.tokenizer.pre_tokenizer     # it writes other characters as bytes
        letters = (chr(c) for c in range(0x80, 0x180) if chr(c).isalpha())
        self.as_bytes = {ord(c): splitter.pre_tokenize_str(c)[0][0] for c in letters}
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast(
            [text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, pieces: list[str]) -> None:
        known, older, packed, tokenize = self.known, self.older, self.packed, self.model.tokenize
        other = []
        for piece in pieces:
            found = older.get(piece)
            if found is None:
                if not piece.isalpha() and piece.rstrip(_MARKS):
                    other.append(piece)
                    continue
                if piece.isascii():
                    found = b"".join([packed[t.id] for t in tokenize(piece)])
                elif not _LOWER_LATER.search(piece):
                    found = b"".join([packed[t.id] for t in tokenize(
                        piece.translate(self.as_bytes))])
                else:
                    other.append(piece)
                    continue
            known[piece] = found
        self._add([w for w in other if "<|" not in w])
        known.update((w, self._ids(w).tobytes()) for w in other if "<|" in w)

    def _add(self, words: list[str]) -> None:
        """Encodes words many at a time, with a mark between them by which ids are told apart."""
        for k in range(0, len(words), 2000):
            part = words[k:k + 2000]
            ids = self._ids(BREAK.join(part))
            ends = np.append(np.flatnonzero(ids == self.split_id), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            if len(ends) != len(part):
                raise ValueError("the tokenizer's ids cannot be told apart by word")
            packed = ids.tobytes()
            self.known.update((w, packed[4 * a:4 * b]) for w, a, b in zip(
                part, starts.tolist(), ends.tolist()))

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:        # pieces not used since are forgotten
            self.known, self.older = {"": b""}, self.known
        known = self.known
        found = list(map(known.get, pieces))
        self._learn([p for p, ids in zip(pieces, found) if ids is None])
        return [known[p] if ids is None else ids for p, ids in zip(pieces, found)]

    def encode_column(self, texts: pa.Array) -> list[memoryview]:
        """Little-endian 32-bit ids of each text; no text is null."""
        lists = _words(texts)
        words = lists.flatten().dictionary_encode()
        pieces = _letters_and_marks(words.dictionary).dictionary_encode()
        ids = pa.array(self._piece_ids(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()),
                       pa.large_binary()).take(pieces.indices)
        # a word's two pieces lie side by side
        ends, data = _buffers(ids)
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.dictionary), [
            None, pa.py_buffer(ends[::2].copy()), data]).take(words.indices)
        ends, data = _buffers(ids)
        at = ends[lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()].tolist()
        data = memoryview(data)
        return [data[a:b] for a, b in zip(at[:-1], at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(bytes, self.encode_column(pa.array(texts, pa.string()))))


def _buffers(array: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Ends of the values of a text or binary array, after a first 0, and their bytes."""
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(
        array.type) else np.int32
    _, ends, data = array.buffers()
    ends = np.frombuffer(ends, kind)[array.offset:array.offset + len(array) + 1] if len(
        array) else np.zeros(1, kind)
    first, last = int(ends[0]), int(ends[-1])
    return ends - ends[0], (data or pa.py_buffer(b"")).slice(first, last - first)


def _lower_later(texts: pa.Array) -> np.ndarray:
    """Which texts have a character of ``_LOWER_LATER``: U+0180 and more begin with bytes from
    C6 on, U+0130 is C4 B0."""
    ends, data = _buffers(texts)
    signs = np.frombuffer(data, np.uint8)
    found = signs > 0xc5
    found[:-1] |= (signs[:-1] == 0xc4) & (signs[1:] == 0xb0)
    out = np.zeros(len(texts), bool)
    out[np.searchsorted(ends, np.flatnonzero(found), "right") - 1] = True
    return out


def _words(texts: pa.Array) -> pa.Array:
    """The words of each text, and maybe empty ones, which have no ids.

    They are in lower case where the tokenizer lowers each character alone; there are fewer then.
    """
    kept = _lower_later(texts) | np.asarray(pc.match_substring(texts, "<|"))
    texts = pc.if_else(pa.array(kept), texts, pc.utf8_lower(texts))
    signs = np.frombuffer(_buffers(texts)[1], np.uint8)
    if ((signs > 0x1b) & (signs < 0x20)).any():     # white space to Arrow, not to the tokenizer
        return pa.array([_WHITE.split(t) for t in texts.to_pylist()], pa.list_(texts.type))
    return pc.utf8_split_whitespace(texts)


def _letters_and_marks(words: pa.Array) -> pa.Array:
    """Two pieces of each word: lower-case letters, and the marks after them. Of any other
    word they are the word as it is, and nothing."""
    lower = pc.utf8_lower(words)
    letters = pc.utf8_rtrim(lower, _MARKS)
    split = ~_lower_later(words) & np.asarray(pc.utf8_is_alpha(letters))
    words = pc.if_else(pa.array(split), lower, words)
    ends, data = _buffers(words)
    cuts = np.empty(2 * len(words) + 1, ends.dtype)
    cuts[::2] = ends
    cuts[1::2] = np.where(split, ends[:-1] + np.asarray(pc.binary_length(letters)), ends[1:])
    return pa.Array.from_buffers(words.type, 2 * len(words), [None, pa.py_buffer(cuts), data])


_encoders: dict[str, WordEncoder] = {}


def _encoder(vocabulary: str) -> WordEncoder:
    if vocabulary not in _encoders:
        _encoders.clear()
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


def cut_pieces(docs: DataFrame, vocabulary_path: str, size: int = SIZE, end_id: int = END_ID,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Written pieces: doc_id, piece, start, length, ids, and part and nth.

    ``nth`` counts the pieces of a length within the part of the table they were written in.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
              "length long, ids binary, part long, nth long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            column = batch.column(1)
            for first, last in row_portions(column, PORTION_BYTES):
                owner, number, begin, length, ids, nth = [], [], [], [], [], []
                coded = encoder.encode_column(column.slice(first, last - first))
                for row, found in enumerate(coded, first):
                    found = b"".join((found, end))
                    for k, at in enumerate(range(0, len(found), 4 * size)):
                        piece = found[at:at + 4 * size]
                        n = len(piece) // 4
                        owner.append(row)
                        number.append(k)
                        begin.append(at // 4)
                        length.append(n)
                        ids.append(piece)
                        nth.append(seen[n])
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())),
                     pa.array(number, pa.int32()), pa.array(begin, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([part] * len(owner), pa.int64()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    return stage(rows.mapInArrow(run, schema), "pieces")


def fullest(counts: dict[int, int], space: int) -> dict[int, int]:
    """The lengths, with repeats, of the largest sum up to ``space``; long ones are tried first."""
    reach, within = 1, (1 << (space + 1)) - 1
    steps = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], space // length) if length else 0
        times = 1
        while left and not reach >> space & 1:
            times = min(times, left)
            left -= times
            steps.append((length, times, reach))
            reach = (reach | reach << length * times) & within
            times *= 2
        if reach >> space & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return chosen


def combinations(counts: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack: the lengths of a sequence, and how many sequences have them."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = fullest(rest, size - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // n for length, n in chosen.items())
        out.append((chosen, times))
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return out


def _places(counts: dict[int, int], size: int) -> dict[str, np.ndarray]:
    """By length and first rank: how many a sequence takes, its first number, the offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in combinations(counts, size):
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length << 48 | used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("key", "takes", "sequence", "offset"), table.T.copy()))


class Plan:
    """Which sequence takes the piece of each length and rank, and the ranks before each part."""

    def __init__(self, pieces: DataFrame, size: int = SIZE) -> None:
        spark = pieces.sparkSession
        counts = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
        total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(
            F.sum("n").alias("n")).collect()}
        self.places = spark.sparkContext.broadcast(_places(total, size))
        before = F.sum("n").over(Window.partitionBy("length").orderBy("part")
                                 .rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
        self.offsets = F.broadcast(offsets) if counts.count() <= OFFSET_ROWS else offsets

    def place(self, pieces: DataFrame) -> DataFrame:
        """Adds sequence_id and offset to rows with part, nth and length, in place of part and nth.

        Only these rows are shuffled where the offsets are too many to broadcast, so leave the
        ids out where they are not needed.
        """
        places = self.places

        @F.pandas_udf("sequence_id long, offset long")
        def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
            plan, n, rank = places.value, length.to_numpy(), rank.to_numpy()
            at = np.searchsorted(plan["key"], n << 48 | rank, "right") - 1
            rank = rank - (plan["key"][at] & (1 << 48) - 1)
            takes = plan["takes"][at]
            return pd.DataFrame({"sequence_id": plan["sequence"][at] + rank // takes,
                                 "offset": plan["offset"][at] + rank % takes * n})

        placed = pieces.join(self.offsets, ["part", "length"]).withColumn(
            "place", place("length", F.col("before") + F.col("nth")))
        return placed.select(*(c for c in pieces.columns if c not in ("part", "nth")),
                             "place.sequence_id", "place.offset")


def pack(docs: DataFrame, vocabulary_path: str, size: int = SIZE, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All pieces: doc_id, piece, start, length, ids, sequence_id and offset.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    pieces = cut_pieces(docs, vocabulary_path, size, end_id, doc_id, text)
    return Plan(pieces, size).place(pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens and ids in their order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("long"),
                                   lambda a, x: a + x["length"]).alias("n_tokens"),
        F.unhex(F.array_join(F.transform("parts", lambda x: F.hex(x["ids"])), "")).alias("ids"))
