"""Token alignment, trie BPE and periodic runs against the libraries and brute force."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reachmark.llm import alignment, periodic_runs, queries, tokens, trie_bpe
from reachmark.llm.common import KEY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_PATH, PIECE_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, _key string, _block string, pair int, runs string, n int, source string"


def texts():
    rng = random.Random(8)
    out = [None, "", "  \n\t ", "one", "a▁b", "漢字 " * 40 + "x", " " * 50 + "y", "\x00a", "a" * 333, "<0x41> <s> x", "  lead", "trail  "]
    out += ["<|endoftext|>a<|startoftext|>", "x<|endof<|endoftext|>|> <|ENDOFTEXT|>", "ΑΣ ΣΑΣ İstanbul ǅ ﬁ é́́", "don't I'LL 's''s", "\x1c\x85a b\xa0c　d"]
    out += ["漢字" * 300, "ab" * 100, "🎉👩‍👩‍👧 ß ẞ Ⅷ ª 𝄞𝒳", "12 ٣٤ a_b--c...!!", "na " * 700, ("a " * 30 + "b ") * 20, "x y\nz " * 9]
    out += ["".join(rng.choice("abcdeinsth'r .,é漢́ÀΣ<|>1\n") for _ in range(rng.randint(1, 200))) for _ in range(120)]
    out += [" ".join(rng.choice(["the", "of", "Uni", "é", "word"]) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    return out


@pytest.fixture(scope="module")
def rows():
    found = [(i, t) for i, t in enumerate(texts())]
    return [*found, (None, "null key"), found[40], found[40], (7, "a key twice")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "k", "b", 1, "r", 2, "s") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def sf(spark, docs, tmp_path_factory):
    """A folder in which the registered queries find the rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def as_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def expected(rows, fn):
    """Rows of ``fn(doc_id, text)``, a dict per row, in the order of ``as_rows``."""
    made = [{"doc_id": i, **fn(i, t or "")} for i, t in rows]
    return sorted((tuple(r[c] for c in sorted(r)) for r in made), key=repr)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# -- alignment ---------------------------------------------------------------------------


def brute_groups(text, byte_bpe, pieces):
    """Id lists of both sides by group."""
    to_byte = tokens.printable_bytes()
    a = byte_bpe.encode(" " + text, add_special_tokens=False).ids if text else []
    b = pieces.encode(text) if text else []
    spelled_a = [bytes(to_byte[c] for c in byte_bpe.id_to_token(i)) for i in a]
    spelled_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or not b"".join(spelled_a) == b"".join(spelled_b) == b" " + text.encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in spelled_a]), np.cumsum([len(x) for x in spelled_b])
    out, begin = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append(tuple([i for i, e in zip(ids, ends) if begin < e <= end] for ids, ends in ((a, ends_a), (b, ends_b))))
        begin = end
    return out


@pytest.mark.parametrize("block", [300, 4 << 20])
def test_alignment_matches_brute_force(spark, rows, sf, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    byte_bpe, pieces = Tokenizer.from_file(BYTE_PATH), sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    byte_bpe.encode_special_tokens = True
    grouped = [brute_groups(t or "", byte_bpe, pieces) for _, t in rows]
    links = [[(a, b) for g, h in groups for a in g for b in h] for groups in grouped]
    count = collections.Counter(p for found in links for p in set(found))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    of = iter(zip(grouped, links, strict=True))

    def row(_, __):
        groups, pairs = next(of)
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        return {
            "n_a": sum(len(g) for g, _ in groups), "n_b": sum(len(h) for _, h in groups), "n_groups": len(groups), "n_links": len(pairs),
            "n_best": sum(count[p] == best[p[0]] for p in pairs), "count_sum": sum(count[p] for p in pairs),
            "groups_sha256": sha(text) if text else "",
        }

    assert as_rows(queries.op11(spark, sf)) == expected(rows, row)


def test_wide_groups_are_counted_by_distinct_ids():
    rng = np.random.default_rng(2)
    na, nb = np.array([1, 40, 3, 2, 300]), np.array([1, 50, 2, 1, 400])
    a, b = rng.integers(0, 6, na.sum()), rng.integers(0, 6, nb.sum())
    want, i, j = collections.Counter(), 0, 0
    for x, y in zip(na, nb):
        want.update(p * 100 + q for p in a[i : i + x].tolist() for q in b[j : j + y].tolist())
        i, j = i + x, j + y
    pairs, times = alignment.linked_pairs(a, b, na, nb, 100)
    assert dict(zip(pairs.tolist(), times.tolist())) == dict(want)


def test_galloping_finds_first_places():
    rng = np.random.default_rng(4)
    for _ in range(200):
        long = np.sort(rng.integers(0, 200, rng.integers(1, 90)))
        short = np.sort(rng.integers(0, 220, rng.integers(0, 40)))
        start = np.zeros(len(short), np.int64)
        assert (alignment.gallop(short, long, start) == np.searchsorted(long, short)).all()


class Looked:
    """A list that counts the entries looked at."""

    def __init__(self, values):
        self.values, self.count = values, 0

    def __len__(self):
        return len(self.values)

    def __getitem__(self, at):
        self.count += len(at)
        return self.values[at]


def test_galloping_looks_at_few_places_in_long_lists():
    rng = np.random.default_rng(6)
    ends = np.cumsum(rng.integers(1, 9, 200_000))
    long, short = Looked(ends[rng.random(len(ends)) < 0.8]), ends[rng.random(len(ends)) < 0.6]
    assert (alignment.gallop(short, long, np.zeros(len(short), np.int64)) == np.searchsorted(long.values, short)).all()
    assert long.count < 12 * len(short)
    assert not len(alignment.gallop(short[:0], long, np.zeros(0, np.int64)))


def test_spellings_in_parts(monkeypatch):
    monkeypatch.setattr(alignment, "SPELLED", 3)
    words = [b"", b"a", b"bc", "é".encode(), b"\xff\x00", b"def"]
    many = alignment.Spellings(words)
    ids = [np.array(x, np.int64) for x in ([1, 2, 3, 5, 0, 4, 4, 1], [], [0], [2, 5])]
    right = [b"".join(words[i] for i in x) for x in ids]
    assert many.write(np.concatenate(ids)) == b"".join(right) and many.write(ids[1]) == b""
    assert many.spell(ids, right) == [True] * 4
    assert many.spell(ids, [right[0][:-1], b"x", b"", right[3] + b"y"]) == [False, False, True, False]
    assert many.spell([ids[3], ids[0]], [right[3][:-1], right[3][-1:] + right[0]]) == [False, False]


def test_alignment_of_no_rows(empty):
    assert alignment.link_scores(empty, BYTE_PATH, PIECE_PATH).count() == 0


def test_rank_encoder_equals_the_library():
    library = Tokenizer.from_file(BYTE_PATH)
    library.encode_special_tokens = True
    fast = tokens.encoder(BYTE_PATH, True)
    assert isinstance(fast, tokens.RankEncoder)
    for text in [*filter(None, texts()), "x" + " " * 60_000 + "y <|endoftext|>", "".join(map(chr, range(0x20, 0x3000)))]:
        assert fast.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert isinstance(tokens.encoder(WORD_PATH, False), tokens.ChunkEncoder)


# -- trie BPE ----------------------------------------------------------------------------


@pytest.mark.parametrize("limits", [None, (1, 1, 3)])
def test_trie_bpe_equals_the_library(spark, rows, sf, limits, monkeypatch):
    if limits:  # nothing remembered, words beyond the trie's depth
        library = trie_bpe.TrieBpe(WORD_PATH)
        for name, value in zip(("REMEMBERED_BYTES", "REMEMBERED_PAIRS", "TRIE_DEPTH"), limits, strict=True):
            monkeypatch.setattr(trie_bpe, name, value)
        whole = Tokenizer.from_file(WORD_PATH)
        given = [t or "" for _, t in rows]
        for _ in range(2):
            for text, ids in zip(given, library.encode(given), strict=True):
                assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        return
    library = Tokenizer.from_file(WORD_PATH)

    def row(_, text):
        ids = library.encode(text, add_special_tokens=False).ids
        return {
            "n_tokens": len(ids), "ids_sha256": sha(np.array(ids, "<u4").tobytes()),
            "decoded_sha256": sha(library.decode(ids, skip_special_tokens=False)),
        }

    assert as_rows(queries.op12(spark, sf)) == expected(rows, row)


def test_trie_bpe_of_long_words_and_many_texts():
    library, whole = trie_bpe.TrieBpe(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    long = ["漢" * 20_000, "ab" * 30_000 + " x", "!?" * 5_000]
    for text, ids in zip(long, library.encode(long), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_trie_bpe_round_trip_through_tables(docs, empty, rows):
    encoded = trie_bpe.encode_documents(docs, WORD_PATH)
    library = Tokenizer.from_file(WORD_PATH)
    got = sorted((r[KEY] is None, r[KEY], tuple(r.ids), r.text) for r in trie_bpe.decode_documents(encoded, WORD_PATH).collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i is None, i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert trie_bpe.encode_documents(empty, WORD_PATH).count() == trie_bpe.round_trip(empty, WORD_PATH).count() == 0


def test_trie_bpe_refuses_other_files():
    with pytest.raises(ValueError):
        trie_bpe.TrieBpe(BYTE_PATH)


# -- periodic runs -----------------------------------------------------------------------


def brute_runs(words, least=12):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                best.setdefault((i - q, j), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def strings():
    rng = random.Random(1)
    out = ["", "a", "a " * 12, "a " * 11, ("a " * 30 + "b ") * 20, ("a b " * 9 + "a ") * 20]
    fib = ["b", "a"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    out.append(" ".join(fib[-1]))
    for _ in range(600):
        words = [rng.choice("abcdefghijklmnopqrst"[: rng.choice([1, 2, 3, 5, 20])]) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.5:
            p = rng.randint(1, len(words) // 2 + 1)
            words = words[: rng.randint(0, 50)] + (words[:p] * 8)[: rng.randint(0, 4 * p)] + words[: rng.randint(0, 10)]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("batch", [1, 1 << 19])
def test_runs_match_brute_force(batch, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", batch)
    given = strings()
    for text, found in zip(given, periodic_runs.text_runs(given, 12), strict=True):
        assert [tuple(r) for r in found.runs.tolist()] == brute_runs(text.split())


def test_runs_of_long_texts():
    line = " ".join(f"w{i}" for i in range(37))
    long = ["a " * 200_000, f"{line} " * 4_000, " ".join(str(i * i % 7919) for i in range(60_000))]
    found = [f.runs.tolist() for f in periodic_runs.text_runs(long, 12)]
    assert found[:2] == [[[0, 200_000, 1]], [[0, 148_000, 37]]]
    assert all(p == 7919 for _, _, p in found[2])


def test_registered_runs_follow_the_contract(spark, rows, sf):
    def row(i, text):
        words, h = WORD.findall(text), zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute_runs(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        return {
            "n_runs": len(runs), "start": top[0], "length": top[1], "period": top[2],
            "exponent_milli": top[1] and 1000 * top[1] // top[2],
            "runs_sha256": sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            "collapsed_sha256": sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
        }

    assert as_rows(queries.op13(spark, sf)) == expected(rows, row)


def test_runs_of_no_rows(empty):
    assert periodic_runs.find_runs(empty).count() == 0


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
