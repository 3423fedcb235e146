import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from lapline.llm import packing


def test_runs_are_best_fit_decreasing():
    """Against the plain loop: place each piece into the smallest gap it fits."""
    draw = random.Random(8)
    for _ in range(30):
        lengths = [min(64, 1 + int(draw.lognormvariate(2.5, 1))) for _ in range(draw.randrange(200))]
        counts = Counter(lengths)
        gaps = []
        for n in sorted(lengths, reverse=True):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(64 - n)
        runs = packing.best_fit_runs(counts, 64)
        filled = {}
        for i, (n, rank, each, first, offset) in enumerate(runs):
            end = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == n else counts[n]
            for k in range(end - rank):
                filled.setdefault(first + k // each, []).append((offset + k % each * n, n))
        for parts in filled.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
        assert sorted(64 - sum(n for _, n in p) for p in filled.values()) == sorted(gaps)


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    out = []
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        for k, a in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[a:first if k == 0 else a + capacity]
            out.append((str(r["doc_id"]), k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_pieces_and_places(spark, documents, odd_documents, capacity):
    for docs in (documents, odd_documents):
        found = packing.pack_documents(docs, capacity=capacity).collect()
        assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == \
            plain_pieces(docs.collect(), capacity)
        sequences = {}
        for r in found:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in sequences.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= capacity
        least = -(-sum(r["length"] for r in found) // capacity)
        assert len(sequences) <= least * 1.02 + 1


def test_white_space_and_marks_are_tokenised_alike(spark):
    texts = ["a  b", " a", "a\n\nb", "a \n b", "it's  we'll ", "x\ty\r\n", "\x1c a\x1fb", "Ünïcode—dash … ok", "汉字 kana かな", "1,2.3 ,.", "a ,b. c.\n",
             "<|endoftext|>", "tail   ", " nbsp  x", "", "\n", "é́ combining", "no.1a", "a.b,c|d | e"]
    encode = packing._encoder(packing.default_tokenizer())
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    rest = "".join(map(chr, [*range(0x80, 0x500), *range(0x500, 0xD800, 37), *range(0xE000, 0x30000, 211)]))
    texts += [f"a{c}b {c}1{c} {c}{c}." for c in rest]
    texts += ["x" * 5000, " " * 5000 + "a", "\x1c" * 5000, "ab1!" * 3000, "\x85" * 3000, "word " * 3000]
    assert encode.merges
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_go_through_the_same_merges(spark, documents):
    encode, tokenizer = packing._Encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    for r in documents.collect():
        assert np.frombuffer(encode(r["text"]), "<u4").tolist() == tokenizer.encode(r["text"], add_special_tokens=False).ids
    assert encode.tokenizer is None  # one vocabulary: no text needed the other


def test_other_tokenizers_are_not_taken_for_byte_level(tmp_path):
    import json
    import shutil

    path = str(tmp_path / "own.json")
    shutil.copy(packing.default_tokenizer(), path)
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    made["pre_tokenizer"]["add_prefix_space"] = True
    with open(path, "w", encoding="utf-8") as f:
        json.dump(made, f)
    encode = packing._Encoder(path)
    assert encode.merges is None
    assert np.frombuffer(encode("two words"), "<u4").tolist() == Tokenizer.from_file(path).encode("two words").ids


def test_ids_come_back(spark, documents):
    found = packing.pack_documents(documents.limit(20), with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in found)


def test_empty(spark, no_documents):
    assert packing.pack_documents(no_documents).collect() == []
