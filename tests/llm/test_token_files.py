"""Word-level ids and the mixing coder of token files against the library, and their cost."""

import json
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reachmark.llm import mixing_coder, token_files, tokens, trie_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def plain_characters():
    return [chr(c) for a, b in tokens._PLAIN for c in range(a, b + 1)]


def test_word_ids_of_every_plain_character(library):
    enc = tokens.word_encoder(PATH)
    assert isinstance(enc, tokens.WordEncoder)
    chars = plain_characters()
    some = [c for c in chars if c < "　" or c > "＀"] + chars[::97]
    texts = ["a".join(chars[i : i + 50]) for i in range(0, len(chars), 50)] + [f"{c} a{c}a 1{c}.{c}{c}'{c}s {c}'s x" for c in some]
    assert [i.tolist() for i in enc.encode_all(texts)] == [library(t) for t in texts]


def test_word_ids_of_contractions_blanks_and_long_texts(library, monkeypatch):
    enc, rng = tokens.word_encoder(PATH), random.Random(3)
    texts = ["", "'", "''", "'s", "''s", "'s's", "'S'LL 'l 'l' 'r e", "it's'", "don't,'single'", "!'s", "x'", "'re", "'v", "<|endoftext|>", "\x1c\x85a\xa0", "İ'S", "ȺȾ"]
    texts += ["".join(rng.choice("aelrvsmdt''  .1é\n") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += ["ΑΣ ΣΑΣ'S é́", "漢字'漢", "a" * 5000, "ab" * 3000 + " 's"]
    expected = [library(t) for t in texts]
    assert [i.tolist() for i in enc.encode_all(texts)] == expected
    assert enc.encode_all([]) == [] and [len(i) for i in enc.encode_all([""])] == [0]
    monkeypatch.setattr(tokens, "SLICE_CHARS", 8)
    assert [i.tolist() for i in enc.encode_all(texts)] == expected
    assert [i.tolist() for i in enc.encode_all(["the end  of it \n x y", "Σ of it and on"])] == [library("the end  of it \n x y"), library("Σ of it and on")]


def test_every_id_stands_alone():
    # a merge loop over ranks takes a word that is an id for that id
    bpe = trie_bpe.TrieBpe(PATH)
    assert all(bpe.stands(-1, i) for i in bpe.symbols)


def test_other_word_files_go_to_the_library(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    file["normalizer"]["normalizers"].pop()  # case is kept
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file))
    assert type(tokens.word_encoder(str(other))) is tokens.ChunkEncoder
    got = tokens.word_encoder(str(other)).encode_all(["The end", ""])
    assert [i.tolist() for i in got] == [Tokenizer.from_file(str(other)).encode("The end").ids, []]


def blocks(n, size):
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.2, 4 * n * size)
    ids = ids[ids < 49408][: n * size]
    for at in range(100, len(ids) - 60, 300):  # passages that come again
        ids[at + 30 : at + 60] = ids[at : at + 30]
    return np.split(ids, n)


def test_learned_mixtures_round_trip():
    made = [*blocks(6, 500), np.zeros(0, np.int64), np.zeros(40, np.int64), np.array([499_000, 0, 499_000])]
    payloads, mixture = mixing_coder.encode_learned(made)
    again = mixing_coder.Mixture.from_bytes(mixture.to_bytes())
    back = mixing_coder.decode_blocks(payloads, list(map(len, made)), again)
    assert all(np.array_equal(a, b) for a, b in zip(made, back, strict=True))
    one = mixing_coder.decode_blocks([payloads[3]], [500], again)  # a block needs no other
    assert np.array_equal(one[0], made[3])
    assert (again.two.astype(np.int64) + (again.unit.astype(np.int64) << 20) <= 1 << 28).all() and again.freq.sum() == 1 << 20
    assert mixing_coder.encode_learned([])[0] == [] and mixing_coder.decode_blocks([], []) == []
    with pytest.raises(ValueError):
        mixing_coder.encode_learned([np.array([1 << 20])])
    with pytest.raises(ValueError):
        mixing_coder.encode_blocks([np.array([499_001])], mixture)
    with pytest.raises(ValueError):
        mixing_coder.encode_blocks([np.array([498_999])], mixture)


def test_carries_run_through_many_digits():
    # sharp weights push the low end of the range against the top again and again
    rng = np.random.default_rng(7)
    made = [np.where(rng.random(1500) < 0.01, rng.integers(0, 3, 1500), 65535 - rng.integers(0, 2, 1500) * (k % 2)) for k in range(300)]
    for mixture in (None, mixing_coder.encode_learned(made)[1]):
        back = mixing_coder.decode_blocks(mixing_coder.encode_blocks(made, mixture), [1500] * 300, mixture)
        assert all(np.array_equal(a, b) for a, b in zip(made, back, strict=True))


def test_damaged_blocks_are_found():
    made = blocks(4, 700)
    data = token_files.MAGIC + token_files.segment([1, 2], [made[0], np.concatenate(made[1:])])
    assert sum(len(ids) for _, _, ids in token_files.segments(data)) == 2800
    found = 0
    for at in np.random.default_rng(5).integers(len(data) - 1500, len(data), 20).tolist():
        bad = bytearray(data)
        bad[at] ^= 255
        try:  # the last bits of a block may not matter
            assert np.array_equal(np.concatenate([ids for _, _, ids in token_files.segments(bytes(bad))]), np.concatenate(made))
        except ValueError:
            found += 1
    assert found >= 15


def test_coding_is_small_and_takes_few_steps():
    made = blocks(1024, 512)
    n = 1024 * 512
    began = time.process_time()
    data = token_files.MAGIC + token_files.segment([0], [np.concatenate(made)])
    found = [ids for _, _, ids in token_files.segments(data)]
    took = time.process_time() - began
    assert np.array_equal(np.concatenate(found), np.concatenate(made))
    assert took < 5e-6 * n  # seconds; 11e-6 an id when each order and part took a step of its own
    assert len(data) < 0.9 * len(zlib.compress(np.concatenate(made).astype("<u2").tobytes(), 9))
