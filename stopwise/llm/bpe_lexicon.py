"""Byte-level BPE with a lexicon of frequent words in a minimal acyclic transducer.

Words are counted over all documents; the frequent ones are merged once and compiled into
an acyclic automaton with shared suffixes. Its arcs carry numbers that add up to a word's
rank, under which the ids stand in one array. Tasks map the compiled file into memory, look
up the distinct words of a portion together, and merge words that it lacks exactly. So the
size of the lexicon changes the speed and never the ids.

Null text counts as empty; empty text has no ids and decodes to empty text. The text of a
special token gives its id, wherever it stands, and decodes to the same text. Repeated rows
are encoded alike; other columns stay as they are. Ids that do not form UTF-8 decode with
replacement characters; ids that the vocabulary lacks decode to nothing, null ids to null.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from .pretoken import row_portions, split_words
from .tables import free_name

LEXICON_WORDS = 1 << 16     # at most so many words are compiled
PORTION_CHARS = 1 << 19     # characters that are worked on together
PORTION_IDS = 1 << 17       # ids that are decoded together
HELD_WORDS = 1 << 17        # distinct words that a task remembers

#: Arrow columns from the ids of a portion, where each text's ids end, and their decoding.
Derive = Callable[[np.ndarray, np.ndarray, list[str]], list[pa.Array]]


def byte_letters() -> list[str]:
    """The letter of each byte in the vocabulary: itself if printable, else from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file."""

    def __init__(self, text: str) -> None:
        given = json.loads(text)
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        ids = given["model"]["vocab"]
        self.byte_id = np.array([ids[c] for c in letters])
        merges = [p if isinstance(p, list) else p.split(" ") for p in given["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges])
        self.pairs, self.pair_ranks = np.unique(keys, return_index=True)
        self.merged = np.array([ids[a + b] for a, b in merges])
        self.never = len(merges)
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        parts = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            parts[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            parts[i] = token.encode()
        self.parts = np.frombuffer(b"".join(parts), np.uint8)
        self.part_ends = np.cumsum([len(p) for p in parts])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], self.never)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids end.

        In each round every word merges its pair of lowest rank at all its places, from
        the left; words without such a pair are done.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_words = [], []
        rank = np.full(len(ids), self.never)
        if len(ids) > 1:
            same = word[1:] == word[:-1]
            rank[:-1] = np.where(same, self._ranks(ids[:-1], ids[1:]), self.never)
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, first),
                              np.diff(np.concatenate([first, [len(ids)]])))
            over = least == self.never
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                ids, word, rank, least = ids[~over], word[~over], rank[~over], least[~over]
                if not len(ids):
                    break
            hit = rank == least
            # of overlapping places every second one is taken
            at = np.arange(len(ids))
            fresh = hit & ~np.concatenate([[False], hit[:-1]])
            hit &= (at - np.maximum.accumulate(np.where(fresh, at, 0))) % 2 == 0
            places = np.flatnonzero(hit)
            ids[places] = self.merged[rank[places]]
            stays = np.ones(len(ids), bool)
            stays[places + 1] = False
            moved = places - np.arange(len(places))
            ids, word, rank = ids[stays], word[stays], rank[stays]
            for k in (moved, moved[moved > 0] - 1):
                inner = k[k + 1 < len(ids)]
                rank[k] = self.never
                inner = inner[word[inner] == word[inner + 1]]
                rank[inner] = self._ranks(ids[inner], ids[inner + 1])
        if not done_ids:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        ids = ids[np.argsort(word, kind="stable")].astype(np.int32)
        return ids, np.cumsum(np.bincount(word, minlength=len(words)))

    def text(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of id lists that stand in a row and end at ``ends``."""
        ids = np.asarray(ids, np.int64)
        known = (ids >= 0) & (ids < len(self.part_ends))
        safe = np.where(known, ids, 0)
        begins = np.concatenate([[0], self.part_ends])[safe]
        lengths = np.where(known, self.part_ends[safe] - begins, 0)
        flat, stops = ragged(self.parts, begins, lengths)
        data = flat.tobytes()
        byte_ends = np.concatenate([[0], stops])[ends].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *byte_ends], byte_ends)]


def ragged(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``values`` in a row, and where each ends."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(begins - (ends - lengths), lengths)
    return values[at], ends


class Lexicon:
    """Words with their ids: a minimal acyclic automaton whose arcs add up to a word's rank."""

    FIELDS = (("arc", np.int64), ("target", np.int64), ("add", np.int64),
              ("final", np.uint8), ("root", np.int64), ("ends", np.int64), ("ids", np.int32))

    def __init__(self, buffer) -> None:
        sizes = np.frombuffer(buffer, np.int64, len(self.FIELDS))
        at = sizes.nbytes
        for (name, kind), n in zip(self.FIELDS, sizes.tolist()):
            setattr(self, name, np.frombuffer(buffer, kind, n, at))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
        self.buffer = buffer

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @classmethod
    def of(cls, packed: bytes) -> Lexicon:
        """Maps a file of its own that has no name, so nothing of it is left behind."""
        with tempfile.TemporaryFile() as f:
            f.write(packed)
            f.flush()
            return cls(mmap.mmap(f.fileno(), len(packed), access=mmap.ACCESS_READ))

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> bytes:
        """Compile words in sorted order; states with equal futures are made once."""
        made: dict[tuple, int] = {}
        states: list[tuple] = []

        def settle(state: list) -> int:
            key = (state[0], tuple(state[1]))
            if key not in made:
                made[key] = len(states)
                states.append(key)
            return made[key]

        path: list[list] = [[0, []]]       # open states: final, arcs (byte, target)
        before = b""
        ordered = sorted(w for w in words if w)
        for word in ordered:
            shared = 0
            while shared < min(len(word), len(before)) and word[shared] == before[shared]:
                shared += 1
            while len(path) > shared + 1:
                last = settle(path.pop())
                path[-1][1].append((before[len(path) - 1], last))
            path += [[0, []] for _ in word[shared:]]
            path[-1][0] = 1
            before = word
        while len(path) > 1:
            last = settle(path.pop())
            path[-1][1].append((before[len(path) - 1], last))
        root = settle(path[0])
        holds = []                         # words below each state; targets come first
        for final, arcs in states:
            holds.append(final + sum(holds[t] for _, t in arcs))
        arc, target, add = [], [], []
        for s, (final, arcs) in enumerate(states):
            smaller = final
            for label, t in arcs:
                arc.append(s * 256 + label)
                target.append(t)
                add.append(smaller)
                smaller += holds[t]
        ids = [words[w] for w in ordered]
        values = (arc, target, add, [f for f, _ in states], [root],
                  np.cumsum([len(x) for x in ids]), np.concatenate([np.zeros(0, np.int32), *ids]))
        arrays = [np.asarray(v, kind) for v, (_, kind) in zip(values, cls.FIELDS)]
        out = [np.asarray([len(a) for a in arrays], np.int64).tobytes()]
        for a in arrays:
            data = a.tobytes()
            out.append(data + bytes(-len(data) % 8))
        return b"".join(out)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, or -1; all words go one byte on at a time."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths) - lengths
        rank = np.zeros(len(words), np.int64)
        state = np.full(len(words), self.root[0])
        live = np.arange(len(words)) if len(self.arc) else np.zeros(0, np.int64)
        rank[lengths == 0] = -1
        if not len(live):
            rank[:] = -1
        live = live[lengths[live] > 0]
        step = 0
        while len(live):
            key = state[live] * 256 + data[begins[live] + step]
            at = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            hit = self.arc[at] == key
            rank[live[~hit]] = -1
            live, at = live[hit], at[hit]
            rank[live] += self.add[at]
            state[live] = self.target[at]
            step += 1
            done = lengths[live] == step
            ended = live[done]
            rank[ended[self.final[state[ended]] == 0]] = -1
            live = live[~done]
        return rank


class Encoder:
    """Encodes portions of texts; remembers words between them, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self._forget()

    def _forget(self) -> None:
        """Start anew; the words so far stay within reach until the next time."""
        self.older = (self.place, self.ids, self.ends) if hasattr(self, "place") else None
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.n = self.used = 0

    def _add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        while self.n + len(words) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.ends[self.n + 1:self.n + 1 + len(words)] = ends + self.used
        self.place.update(zip(words, range(self.n + 1, self.n + 1 + len(words))))
        self.n += len(words)
        self.used += len(ids)

    def _learn(self, words: list[str]) -> None:
        if len(self.place) > HELD_WORDS:
            self._forget()
        special = self.vocabulary.special
        fresh = set(words).difference(self.place)
        if self.older:
            place, ids, ends = self.older
            again = list(fresh.intersection(place))
            at = np.fromiter(map(place.__getitem__, again), np.int64, len(again))
            self._add(again, *ragged(ids, ends[at - 1], ends[at] - ends[at - 1]))
            fresh.difference_update(again)
        for word in fresh.intersection(special):
            self._add([word], np.array([special[word]]), np.ones(1, np.int64))
        fresh = list(fresh.difference(special))
        coded = [w.encode("utf-8", "replace") for w in fresh]
        if self.lexicon:
            ranks = self.lexicon.ranks(coded)
            held = ranks[ranks >= 0]
            begins = np.concatenate([[0], self.lexicon.ends])[held]
            ids, ends = ragged(self.lexicon.ids, begins, self.lexicon.ends[held] - begins)
            known = ranks >= 0
            self._add([w for w, k in zip(fresh, known.tolist()) if k], ids, ends)
            fresh = [w for w, k in zip(fresh, known.tolist()) if not k]
            coded = [w for w, k in zip(coded, known.tolist()) if not k]
        self._add(fresh, *self.vocabulary.merge(coded))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end."""
        words, counts = self._words(texts)
        self._learn(words)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        begins = self.ends[at - 1]
        ids, ends = ragged(self.ids, begins, self.ends[at] - begins)
        return ids, np.concatenate([[0], ends])[np.cumsum(counts)]

    def _words(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        special = [s for s in self.vocabulary.special if any(s in t for t in texts)]
        if not special:
            return split_words(texts)
        pieces, owner = [], []
        for k, text in enumerate(texts):
            for piece in cut(text, special):
                pieces.append(piece)
                owner.append(k)
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for k, piece in zip(owner, pieces):
            own = [piece] if piece in self.vocabulary.special else split_words([piece])[0]
            words += own
            counts[k] += len(own)
        return words, counts


def cut(text: str, special: list[str]) -> list[str]:
    """The text in pieces, of which some are special tokens: the first that begins, longest first."""
    out = [text]
    for mark in sorted(special, key=len, reverse=True):
        out = [p for piece in out for p in
               ([piece] if piece in special else
                [x for q in piece.split(mark) for x in (mark, q)][1:])]
    return [p for p in out if p]


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Words of all texts with their number: ``(word, n)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def table():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["word", "n"])

        for batch in batches:
            for a, b in row_portions(batch.column(0), PORTION_CHARS):
                texts = [t for t in batch.column(0).slice(a, b - a).to_pylist() if t]
                held.update(split_words(texts)[0])
                if len(held) > HELD_WORDS:
                    yield table()
                    held.clear()
        if held:
            yield table()

    counted = docs.select(text).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counted: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """All words of at least some number of uses, that number being the least power of two
    at which they are at most ``most``. Only they come to the driver."""
    # a word that is used once cannot repay its place
    level = F.floor(F.log2("n")).cast("int")
    levels = counted.filter("n > 1").groupBy(level.alias("level")).count().collect()
    total, least = 0, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return []
    return [r["word"] for r in counted.filter(F.col("n") >= 2 ** least).select("word").collect()]


class BpeTokenizer:
    """Encodes and decodes columns with the vocabulary of a tokenizer file."""

    def __init__(self, spark, vocabulary_path: str) -> None:
        self.spark = spark
        with open(vocabulary_path, encoding="utf-8") as f:
            self.vocabulary = Vocabulary(f.read())
        self._share(None)

    def _share(self, packed: bytes | None) -> None:
        """Workers get the arrays of the vocabulary; none of them parses its file."""
        self._shared: Broadcast = self.spark.sparkContext.broadcast(
            (uuid.uuid4().hex, self.vocabulary, packed))

    def fit_lexicon(self, docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> bytes:
        """Compile the frequent words of ``docs``; returns the file's bytes, at most a few MB."""
        from ..session import stage
        words = frequent_words(stage(count_words(docs, text), "word-counts"), most)
        coded = [w.encode() for w in words]
        ids, ends = self.vocabulary.merge(coded)
        packed = Lexicon.build(dict(zip(coded, np.split(ids, ends[:-1]) if coded else [])))
        self.use_lexicon(packed)
        return packed

    def use_lexicon(self, packed: bytes) -> None:
        self._share(packed)

    def encode(self, docs: DataFrame, text: str = "text", out: str = "ids") -> DataFrame:
        """Add the ids of ``text``; a column named ``out`` is replaced."""
        shared, name = self._shared, free_name(docs, "text_to_encode")
        kept = [c for c in docs.columns if c != out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(shared)
            for batch in batches:
                column = batch.column(batch.num_columns - 1)
                for a, b in row_portions(column, PORTION_CHARS):
                    ids, ends = encoder.encode(
                        [t or "" for t in column.slice(a, b - a).to_pylist()])
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(a, b - a).columns[:-1], lists],
                        [*batch.schema.names[:-1], out])

        given = docs.select(*kept, F.col(text).alias(name))
        fields = [f for f in docs.schema.fields if f.name != out]
        return given.mapInArrow(run, T.StructType(
            [*fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))

    def round_trip(self, docs: DataFrame, fields: str, derive: Derive,
                   text: str = "text") -> DataFrame:
        """``docs`` without ``text`` but with what ``derive`` makes of its ids and their decoding.

        Texts are encoded, their ids decoded, and both handed to ``derive`` in the same task, a
        portion at a time, so that neither leaves it unless ``fields`` (DDL) have them.
        """
        shared, name = self._shared, free_name(docs, "text_to_encode")
        kept = [c for c in docs.columns if c != text]
        made = T.StructType.fromDDL(fields)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(shared)
            for batch in batches:
                column = batch.column(batch.num_columns - 1)
                for a, b in row_portions(column, PORTION_CHARS):
                    ids, ends = encoder.encode(
                        [t or "" for t in column.slice(a, b - a).to_pylist()])
                    decoded = encoder.vocabulary.text(ids, ends)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(a, b - a).columns[:-1], *derive(ids, ends, decoded)],
                        [*batch.schema.names[:-1], *made.fieldNames()])

        given = docs.select(*kept, F.col(text).alias(name))
        return given.mapInArrow(run, T.StructType(
            [*(docs.schema[c] for c in kept), *made.fields]))

    def decode(self, ids: str = "ids") -> F.Column:
        """The text of an array of ids."""
        shared = self._shared

        @F.arrow_udf("string")
        def run(lists: pa.Array) -> pa.Array:
            vocabulary = _encoder(shared).vocabulary
            lengths = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            ends = np.cumsum(lengths)
            values = lists.flatten()
            parts = [pa.array([], pa.string())]
            first = 0
            while first < len(ends):       # a portion of rows, of at least one
                begin = int(ends[first] - lengths[first])
                last = max(first + 1, int(np.searchsorted(ends, begin + PORTION_IDS, "right")))
                part = values.slice(begin, int(ends[last - 1]) - begin).fill_null(-1)
                parts.append(pa.array(vocabulary.text(np.asarray(part), ends[first:last] - begin),
                                      pa.string()))
                first = last
            return pa.compute.if_else(lists.is_valid(), pa.concat_arrays(parts), pa.scalar(None, pa.string()))

        return run(F.col(ids))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(ids: np.ndarray, ends: np.ndarray, decoded: list[str]) -> list[pa.Array]:
    """Of each text the number of ids, and the digests of the decimal ids and of the decoding."""
    decimal = list(map(_decimals(int(ids.max(initial=0)) + 1).__getitem__, ids.tolist()))
    begins = [0, *ends.tolist()]
    return [pa.array(np.diff(begins), pa.int64()),
            pa.array([hashlib.sha256(",".join(decimal[a:b]).encode()).hexdigest()
                      for a, b in zip(begins, begins[1:])], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())]


_DECIMALS: list[str] = []


def _decimals(n: int) -> list[str]:
    _DECIMALS.extend(map(str, range(len(_DECIMALS), n)))
    return _DECIMALS


_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    """One encoder in each worker process, as long as it serves the same vocabulary and lexicon."""
    key, vocabulary, packed = shared.value
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, Lexicon.of(packed) if packed else None)
    return _ENCODERS[key]
