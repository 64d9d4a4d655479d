"""Registered queries and the pipeline on a folder with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reachmark.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "_t string, _doc int, _k string, _key int, block string, fp double"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def texts():
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [body(rng.randint(60, 160)) for _ in range(20)]
    passage = body(70)
    out = [*base, base[0], base[1] + " more", f"{base[2][:80]} {passage} {body(40)}", f"{body(30)} {passage}", base[3].upper()]
    out += [None, "", " \n\t ", "one", "é日本 ñ <|endoftext|> don't 12345\n x", "na " * 300, body(90) + " a.b@c.de +1 (988) 555-2485 10.1.2.255"]
    return out


@pytest.fixture(scope="module")
def rows():
    found = list(enumerate(texts()))
    return [*found, (None, texts()[4] + " without a key"), found[5], found[5], (6, "the sixth key again " + texts()[7])]


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    data = [(i, t, "en", "s", len(t or ""), "t", 1, "k", 2, "b", 0.5) for i, t in rows]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if len(t or "") < 40 else 1) for i, t in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows_of(df, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in df.collect())


def test_language_model_learns_from_its_share(spark, sf, rows):
    got = rows_of(queries.op3(spark, sf), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    split = [(i, [*WORD.findall(lower(t)), None]) for i, t in rows]
    count = collections.Counter(w for i, ws in split if not held(i) for w in ws)
    total = sum(count.values())
    assert got == collections.Counter((i, held(i), len(ws), sum(w in count for w in ws), total) for i, ws in split)


def test_fingerprints_are_written_in_hex(spark, sf, rows):
    def brute(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)):016x}"

    got = queries.op4(spark, sf).collect()
    prints = [(i, brute(t)) for i, t in rows]
    assert collections.Counter((r.doc_id, r.fingerprint) for r in got) == collections.Counter(prints)
    root = {p: p for _, p in prints}
    for a in root:
        for b in root:
            if (int(a, 16) ^ int(b, 16)).bit_count() <= 3:
                x, y = root[a], root[b]
                root = {k: x if v == y else v for k, v in root.items()}
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    assert all(r.component_id == least.get(root[r.fingerprint]) for r in got)


def test_token_digests_equal_the_libraries(spark, sf, rows):
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    word.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    byte = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for i, t in rows:
        ids = byte.encode_ordinary(t or "")
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())] += 1
    assert rows_of(queries.op10(spark, sf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    files = queries.op9(spark, sf).collect()
    lengths = collections.Counter()
    for i, t in rows:
        ids = np.array([*word.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        lengths[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in files) == lengths
    at = 0
    for r in sorted(files, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_packed_pieces_cover_the_ids(spark, sf, rows):
    byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte.encode_special_tokens = True
    got = queries.op6(spark, sf).collect()
    lengths = collections.Counter((i, len(byte.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    total = collections.defaultdict(int)
    for r in got:
        total[r.sequence_id] += r.length
    assert sum(r.length for r in got) == sum(n * k for (_, n), k in lengths.items()) and max(total.values()) <= 1024
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for a, b in zip(places, places[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    assert len(total) <= -(-sum(total.values()) // 1024) + 1


def test_stages_keep_columns_and_clean_rows(spark, sf, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        docs = docs.cache()
        n = docs.count()
        assert before is None or n <= before
        before = n
    kept = {(r.doc_id, r._t, r._doc, r._k, r._key, r.block, r.fp) for r in docs.collect()}
    assert {k[1:] for k in kept} == {("t", 1, "k", 2, "b", 0.5)}
    ids = [r.doc_id for r in docs.collect()]
    assert set(range(2, 20)) - {5, 6, 7} <= set(ids) and ids.count(5) == 1 and not {20, 26, 27} & set(ids)
    assert docs.filter(F.col("text").contains("a.b@c.de")).count() == 0


def test_pipeline_packs_what_stages_kept(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(got.columns)
    found = got.collect()
    assert found and {r.doc_id for r in found} >= set(range(2, 20)) - {5, 6, 7}


def test_no_rows_anywhere(spark, empty):
    for name in ("op2", "op3", "op4", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13"):
        assert getattr(queries, name)(spark, empty).count() == 0, name
    assert corpus_pipeline.run(spark, empty).count() == 0
