"""Packing: ids against the library, subset sums against brute force, sequences without gaps."""

import random
from collections import defaultdict
from itertools import combinations as choose

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stopwise.llm import packing

from .plain import edge_docs, rows

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["A\x1cB c\x1d", "İstanbul ΣΑΣ Σ ὈΔΥΣΣΕΎΣ", "J̌ǰ é É",
       "x<|endoftext|>Y <|ENDOFTEXT|> <|a", "don't WE'LL 's", "a.b. c! d?! ... é. ß, x²! 中文。 ñ;",
       "　wide space᠎  \x85next\xa0", "Kelvin K µ ſt", "<|startoftext|>", "12.5, 7; 3:",
       "tab\tnew\r\nline\x0b\x0c", "<|endof text|>", "́ alone"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_words_give_the_ids_of_whole_texts(library):
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(3)
    signs = "aAbß ÉéΣσς́̌JİıK'st.,<|>endoftext 1٣½\t\n\x1c\x85 中-_"
    texts = ODD + [r[1] or "" for r in rows()] + [
        "".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u4").tolist() == library_ids(library, text)[:-1], repr(text)


def test_few_known_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 5)
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    for text in ODD * 2:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library_ids(library, text)[:-1]


def test_letters_and_marks_take_the_model_alone(library, monkeypatch):
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    monkeypatch.setattr(encoder, "_ids", lambda text: pytest.fail(text))
    letters = [chr(c) for c in range(0x180) if c != 0x130 and chr(c).isalpha()]
    texts = ["Plain words, ended: by.. marks?! *** <| (", "Ünï ÇÀ.###  _", *letters,
             *(f"x{c}Y{mark}" for c in letters for mark in ("", ".", "_-\"", "<|"))]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u4").tolist() == library_ids(library, text)[:-1], repr(text)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_of_a_slice_are_told_apart(library, kind):
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    texts = ["left out é", "", "  ", *ODD, "Слово ABC, Abc<|ENDOFTEXT|> É.", "Same Same same", "", "left out"]
    column = pa.array(texts, kind).slice(1, len(texts) - 2)
    found = encoder.encode_column(column)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
        library_ids(library, t)[:-1] for t in texts[1:-1]]
    assert [bytes(x) for x in encoder.encode_column(pa.array(["", ""], kind))] == [b"", b""]


def test_fullest_combination_against_all_subsets():
    rng = random.Random(1)
    for _ in range(300):
        items = [rng.randrange(1, 30) for _ in range(rng.randrange(0, 8))]
        space = rng.randrange(0, 60)
        best = max(sum(c) for k in range(len(items) + 1) for c in choose(items, k) if sum(c) <= space)
        counts = {x: items.count(x) for x in items}
        chosen = packing.fullest(counts, space)
        assert sum(x * n for x, n in chosen.items()) == best
        assert all(n <= counts[x] for x, n in chosen.items())


def test_combinations_use_every_piece_once():
    rng = random.Random(2)
    for size in (10, 97, 4096):
        counts = {rng.randrange(1, size + 1): rng.randrange(1, 5000) for _ in range(min(size, 300))}
        out = packing.combinations(counts, size)
        used = defaultdict(int)
        for chosen, times in out:
            assert times > 0 and sum(x * n for x, n in chosen.items()) <= size
            for x, n in chosen.items():
                used[x] += n * times
        assert used == counts and len(out) < size * (2 + np.log2(size))
        least = -(-sum(x * n for x, n in counts.items()) // size)
        halves = sum(n for x, n in counts.items() if 2 * x > size)
        assert sum(t for _, t in out) <= 1.05 * max(least, halves) + 2


@pytest.mark.parametrize("size", [16, 4096])
def test_packed_documents(spark, library, size):
    packed = packing.pack(edge_docs(spark), PATH, size)
    got = packed.collect()
    want = sorted((str(r[0]), library_ids(library, r[1])) for r in rows())
    docs, places = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and (r["length"] == size or r["start"] == r["piece"] * size)
        docs[str(r["doc_id"])].append((r["piece"], r["start"], ids))
        places[r["sequence_id"]].append((r["offset"], r["length"], ids))
    # rows of one id are told apart by nothing, so compare their tokens as a whole
    for doc_id, pieces in docs.items():
        own = [ids for d, ids in want if d == doc_id]
        assert sum(len(x) for x in own) == sum(len(p[2]) for p in pieces)
        assert sorted(x[at:at + size] for x in own for at in range(0, len(x), size)) == sorted(p[2] for p in pieces)
    assert sum(len(x) for x in docs.values()) == sum(-(-len(ids) // size) for _, ids in want)
    for pieces in places.values():
        end = 0
        for offset, length, _ in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size
    total = sum(r["length"] for r in got)
    if size == 4096:
        assert len(places) == -(-total // size)
    made = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for k, pieces in places.items():
        assert np.frombuffer(made[k]["ids"], "<u4").tolist() == [x for p in sorted(pieces) for x in p[2]]
        assert made[k]["n_tokens"] == sum(p[1] for p in pieces)


def test_empty_table_and_shuffled_offsets(spark, monkeypatch):
    assert packing.pack(edge_docs(spark, []), PATH).count() == 0
    usual = sorted(map(str, packing.pack(edge_docs(spark), PATH, 64).collect()))
    monkeypatch.setattr(packing, "OFFSET_ROWS", 0)
    assert sorted(map(str, packing.pack(edge_docs(spark), PATH, 64).collect())) == usual
