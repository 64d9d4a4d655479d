"""The ten operators and the pipeline against brute force on small fixtures with awkward rows."""

import base64
import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from reachmark.llm import (
    bpe, embedding_dedup, language_model, mixing_coder, packing, pii, quality, queries, simhash, suffix_dedup, token_files, url_filter,
)
from reachmark.llm.common import KEY
from reachmark.llm.graph import components
from reachmark.llm.hnsw import Hnsw
from reachmark.llm.suffix_sort import sorted_suffixes
from reachmark.runtime import materialize, settle, shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, _key string, fp int, block string"  # names operators use themselves


def texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(40, 160))) for _ in range(12)]
    out = [*base, base[0], base[0], base[1] + " more", base[2][:300] + " x " + base[3][100:400], base[4].upper()]
    passage = " ".join(words[:60])
    out += [f"{b[:50]} {passage} {b[60:120]}" for b in base[5:9]]
    out += [None, "", "  \n\t ", "one", "two words", "é日本 ñ <|endoftext|> don't  it's 12345\n\n x", "na " * 400]
    out += ["a.b@c.de, +1 (988) 555-2485, 10.1.2.255, 4111 1111 1111 1111, 999.1.1.1", " ".join(words) * 12]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "b") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(df, key=KEY):
    return {r[key]: r for r in df.collect()}


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_url_filter_matches_sql_rules_and_joins(spark):
    urls = [
        "http://WWW.Example.com/en/1?x", "https://a.example.com/en", "https://com", "ftp://x.com/#a", None, "", "no scheme", "http://example.net/es/a",
        "http://a.net/fr/", "http://net.com/es/", "://", "http://example.com:80/en/", "http://xexample.com/en/a", "http://example.com?/en/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls * 2)], "page_id long, url string, k string")
    rules = spark.createDataFrame(list(queries.URL_RULES), "host string, path string, action string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls * 2)))
    want = sorted(map(str, con.execute(queries.ORACLES["op1_url_filter"].replace("url, '://'", "coalesce(url, ''), '://'")).fetchall()))
    for size in (url_filter.MAX_FILTER_BYTES, 0):  # the second has to join
        got = url_filter.judge_urls(pages, rules, max_bytes=size)
        assert got.columns == [*pages.columns, "url_host", "url_path", "url_rule", "url_verdict"]
        assert sorted(str((r.page_id, r.url_host, r.url_path, r.url_rule, r.url_verdict)) for r in got.collect()) == want
    none = url_filter.judge_urls(pages, rules.limit(0))
    assert {r.url_verdict for r in none.collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) AS k", "id % 7 = 0 AS listed").cache()
    levels = url_filter.build_cascade(keys, "k", keys.listed)
    assert len(levels) > 1
    assert keys.where(url_filter.contains(levels, keys.k) != keys.listed).count() == 0


def naive_repeats(rows, n=100):
    seen, out = set(), []
    for i, t in sorted(rows):
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - n + 1):
            w = b[k : k + n]
            if w in seen:
                cover[k] += 1
                cover[k + n] -= 1
            seen.add(w)
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_suffix_dedup_matches_brute_force(spark, docs, rows, empty):
    assert sorted(map(tuple, suffix_dedup.repeat_digests(docs).collect())) == naive_repeats(rows)
    left = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).collect()}
    kept = {r[0]: r[4] for r in naive_repeats(rows)}
    assert all(hashlib.sha256((left[i] or "").encode()).hexdigest() == kept[i] for i, t in rows if (t or "").isascii())
    assert suffix_dedup.repeat_digests(empty).count() == suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("memory", [1, 64 << 20])
def test_suffixes_are_sorted_with_shared_prefixes(memory):
    rng = random.Random(9)
    for _ in range(300):
        s = bytes(rng.choice(rng.choice([b"ab", b"\x00\x01\xff", bytes(range(256))])) for _ in range(rng.randint(0, 40))) * rng.randint(1, 3)
        cap = rng.choice([4, 9, 100])
        got = list(sorted_suffixes(np.frombuffer(s, np.uint8), cap, memory))
        order = [int(x) for a, _ in got for x in a]
        shared = [int(x) for _, b in got for x in b]
        assert sorted(order) == list(range(len(s)))
        for (i, j), n in zip(zip(order, order[1:]), shared[1:]):
            a, b = s[i:][:cap], s[j:][:cap]
            assert a <= b and n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_language_model_matches_counts(spark, docs, rows, empty):
    learn = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    from pyspark.sql import functions as F

    got = table(language_model.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 1, block_bytes=4000))
    words = {i: [*(t or "").encode().lower().split(), b""] for i, t in rows}
    one, two, starts = collections.Counter(), collections.Counter(), 0
    for i, w in words.items():
        if learn(i):
            one.update(w)
            two.update(zip([b" ", *w], w))
            starts += 1
    n, v = sum(one.values()), len(one)
    for i, w in words.items():
        p = [(one[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        full = sum(
            math.log10((two[a, x] + 4 * q) / ((starts if a == b" " else one[a]) + 4)) for a, x, q in zip([b" ", *w], w, p)
        )
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learn(i), len(w), sum(one[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, p))) and r.score == pytest.approx(full)
    assert language_model.score_documents(empty, F.lit(True)).count() == 0


def test_simhash_matches_all_pairs(docs, rows, empty):
    def fp(t):
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = {i: fp(t) for i, t in rows}
    got = table(simhash.near_duplicates(docs))
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == want
    assert {i: r.component for i, r in got.items()} == groups(list(want), lambda a, b: (want[a] ^ want[b]).bit_count() <= 3)
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_a_dense_cell_connect_all_that_is_close():
    rng = np.random.default_rng(2)
    center = rng.integers(0, 1 << 62, 4, np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (1500, 2), np.uint64), axis=1)
    fp = np.unique(center[rng.integers(0, 4, 1500)] ^ flips).view(np.int64)
    src, dst = simhash.close_links(fp, simhash.Pivots(), 3, block=64)
    assert len(src) == len(fp) - 4 and all(((int(a) ^ int(b)) % (1 << 64)).bit_count() <= 3 for a, b in zip(src, dst))


def test_similar_groups_keep_one_each(docs, rows, empty):
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert {0, 1, 2, 5} <= kept and not {12, 13, 14, 16} & kept
    assert simhash.keep_one(docs).columns == docs.columns and simhash.keep_one(empty).count() == 0


def test_keep_one_with_clashing_names_and_repeated_rows(spark):
    body = " ".join(f"w{i}" for i in range(50))
    data = [(1, body), (2, body + " x"), (2, body + " x"), (3, "other text"), (3, "other text"), (None, "no key"), (None, "no key"), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "a", 1, "b", 2.0) for i, t in data], "doc_id long, text string, _t string, _k int, _t2 string, _text_no double").repartition(3)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r._t, r._k, r._t2, r._text_no) for r in kept.collect()) == [
        (0, "no key", "a", 1, "b", 2.0), (1, body, "a", 1, "b", 2.0), (3, "other text", "a", 1, "b", 2.0), (4, None, "a", 1, "b", 2.0),
    ]


@pytest.mark.parametrize("block", [4096, 16])
def test_copies_that_only_resemble_their_origin_are_one_group(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(240)]

    def copy():
        out = list(words)
        for k in rng.sample(range(20, 220, 12), 4):
            out[k] = "".join(rng.choice("klmnop") for _ in range(7))
        return " ".join(out)

    data = [(i, copy()) for i in range(1, 60)] + [(0, " ".join(words)), (60, "quite another text of few words"), (61, " ".join(words[:5])), (62, " ")]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()}
    assert kept == {0, 60, 61, 62}


@pytest.mark.parametrize("gathered,paired", [(4096, 32), (6, 3)])
def test_similar_groups_match_all_pairs_of_whole_sets(spark, monkeypatch, gathered, paired):
    monkeypatch.setattr(simhash, "GATHERED", gathered)
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijklmn") for _ in range(8))
    line = [word() for _ in range(30)]  # common to many texts
    data = []
    for n in [20, 60, 100, 300, 1000, 2600] * 4:
        base = [word() for _ in range(n)]
        put = lambda k: [word() for _ in range(k)]
        data += [base, put(n // 6) + base, base + put(n // 5), base[n // 7 :], base[: n // 3] + base[n // 2 :], base[: n // 2] + put(n // 8) + base[n // 2 :]]
        data += [base[: n // 2] + put(n // 4) + base[n // 2 :], line + base, base[:20] + line]
    data += [line + [word() for _ in range(2)] for _ in range(12)] + [[]]
    rows = list(enumerate(map(" ".join, data)))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in data]
    want = groups(list(range(len(sets))), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    got = table(simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert {i: r.component for i, r in got.items()} == want


def test_links_of_long_texts_are_of_whole_sets():
    rng = np.random.default_rng(8)
    for own in range(195, 206):  # of a union of 2000, 400 members are the bound for what is not common
        h = rng.choice(1 << 32, 2000, replace=False)
        sets = [np.sort(x).astype(simhash.HASH).tobytes() for x in (h[: 2000 - own], h[own:])]
        assert simhash.resemblance(*sets) == (2000 - 2 * own) / 2000
        assert len(simhash.close_texts(None, sets, 0.8)[0]) == (own <= 200)


def test_reached_texts_match_all_pairs():
    rng = np.random.default_rng(6)
    pool = rng.choice(1 << 32, 700, replace=False)
    sets = [np.unique(rng.choice(pool[k % 3 * 40 : k % 3 * 40 + n], n - 8, replace=False)) for k, n in enumerate([90, 100, 110, 400, 420, 12] * 8)]
    sketches = [s[: simhash.SKETCH].astype(simhash.HASH).tobytes() for s in sets] + [b"", b""]
    prints = rng.integers(0, 4, (len(sketches), 2)).astype(np.uint64)
    near = lambda i, j: simhash.resemblance(sketches[i], sketches[j]) >= 0.8 and any(int(p ^ q).bit_count() <= 1 for p, q in zip(prints[i], prints[j]))
    a, b = simhash.close_texts(prints, sketches, 0.8, 1)
    linked = set(zip(a.tolist(), b.tolist()))
    ids = list(range(len(sketches)))
    assert all(near(i, j) for i, j in linked)
    assert groups(ids, lambda i, j: (i, j) in linked or (j, i) in linked) == groups(ids, near)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + k: 100 for k in range(50)}}


def test_embeddings_match_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.05, base[:5], 3 * base[5:8], base[:1].repeat(40, 0) + rng.normal(size=(40, 16)) * 0.01])
    data = [(i, [float(v) for v in r], "l") for i, r in enumerate(x.astype(np.float32))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    data += [(1000 + i, v, "l") for i, v in enumerate(odd)]
    got = table(embedding_dedup.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>, rep string"), shards=3))
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = groups(list(range(len(x))), lambda a, b: near[a, b])
    found = sum(got[i].n_links for i in range(len(x))) / (near.sum() - len(x))
    assert 0.9 <= found <= 1 and all(got[i].component == want[i] for i in want)
    assert all(r.kept == (i == r.component) for i, r in got.items())
    assert all(got[1000 + i].n_links == 0 and got[1000 + i].kept for i in range(len(odd)))


def test_audit_widens_the_beam_of_a_poor_graph(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16))
    x[300:] = x[:300] + rng.normal(size=(300, 16)) * 0.02
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    good = Hnsw(x[300:])
    place = np.argsort(good.order)
    own = np.concatenate((np.full(300, -1), place))
    ef, there, found = good.audit(0.95, 0.98, x.astype(np.float32), own)
    assert there[:256].sum() >= 256 and found.sum() >= 0.98 * there.sum()
    poor = Hnsw(x[300:])
    for layer in poor.layers:
        layer[1:] = layer[1:, :1]  # one way out of every row
    assert poor.audit(0.95, 0.98, x.astype(np.float32), own)[0] > ef
    assert good.audit(0.95, 0.98, x[300:].astype(np.float32), place)[1].sum() == 0  # pairs with itself only
    data = [(i, i % 2, [float(v) for v in r], 1) for i, r in enumerate(np.roll(x, 1, axis=0))]
    classes = spark.createDataFrame(data, "rep long, shard int, embedding array<float>, copies long")
    seen = {(r.shard, a.home): a for r in embedding_dedup.build_indexes(classes, 0.95, 0.98).collect() for a in r.audit}
    assert all(a.found >= 0.9 * a.links > 0 for a in seen.values()) and seen


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    rng = np.random.default_rng(3)
    size = rng.integers(1, 78, 800)
    bins, offsets = packing.best_fit(size, 100, 4, 6000.0, rule=rule)
    for b in np.unique(bins):
        mine = np.argsort(offsets[bins == b])
        s = size[bins == b][mine]
        assert s.sum() <= 100 and len(s) <= 4 and (s**2).sum() <= 6000
        assert (offsets[bins == b][mine] == np.cumsum(s) - s).all()


def test_packing_covers_all_ids(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x in rows}
    got = packing.pack_documents(docs, path, 64, 2, with_ids=True).collect()
    back = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.piece):
        assert r.start == len(back[r[KEY]]) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        back[r[KEY]] += r.ids
    assert back == ids
    place = collections.defaultdict(list)
    for r in got:
        place[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= 64 and all(o == sum(n for q, n in p if q < o) for o, _ in p) for p in place.values())
    assert packing.pack_documents(empty, path, 64, 2).count() == 0


def plain_spans(t):
    out = []
    for k, p in enumerate(
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    ):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            check = sum(v - 9 if (v := int(c) * (1 + i % 2)) > 9 else v for i, c in enumerate(reversed(d))) % 10 == 0
            if (k == 1 and any(int(x) > 255 for x in m.group().split("."))) or (k == 2 and not (14 <= len(d) <= 19 and check)) or (k == 3 and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_personal_data(spark, docs, rows, empty, sf_dir):
    rng = random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice("1.+@ a-()4") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t)
    field = pii.fit_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    got = table(pii.find_pii(docs, field))
    for i, t in rows:
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in plain_spans(t or ""))
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(got[i].spans.split(","))
    hidden = {r.doc_id: r.text for r in pii.mask_pii(docs, field).collect()}
    assert hidden[0] == rows[0][1] and None in hidden.values() and any("<EMAIL>, <PHONE>, <IP>, <CARD>, 999.1.1.1" in (t or "") for t in hidden.values())
    assert pii.fit_pii(empty) is None and pii.find_pii(empty, None).count() == 0


def test_messages_agree_with_enumeration():
    rng = np.random.default_rng(5)
    f = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS,) * 2), rng.normal(size=(pii.LABELS,) * 2))
    x = rng.normal(size=(3, pii.FEATURES))
    one, kind = np.array([(0, 1), (1, 2)]), np.array([0, 1])
    got = f.beliefs(x, np.concatenate((one, one[:, ::-1])), np.concatenate((kind, kind)), rounds=60)
    want = np.zeros((3, pii.LABELS))
    own = x @ f.unary
    for y in np.ndindex((pii.LABELS,) * 3):
        p = np.exp(sum(own[i, y[i]] for i in range(3)) + f.chain[y[0], y[1]] + f.skip[y[1], y[2]])
        for i in range(3):
            want[i, y[i]] += p
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-6)


def test_quality_counts_and_monotonic_trees(spark, docs, rows, empty, sf_dir):
    got = table(quality.judge_documents(docs, None))
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert tuple(got[i][c] for c in quality.COUNTS) == want
        assert got[i].base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) == (not got[i].kept)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] + 0.3 * np.sin(3 * x[:, 1]) + rng.normal(size=2000) * 0.3 > 0).astype(float)
    trees = quality.fit_trees(x, y, [1, 0, -1])
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.85 and trees.keeps(x)[y > 0].mean() > 0.99
    grid = np.repeat(rng.normal(size=(50, 1, 3)), 40, axis=1)
    for j, sign in ((0, 1), (2, -1)):
        g = grid.copy()
        g[:, :, j] = np.linspace(-3, 3, 40)
        assert (sign * np.diff(trees.margin(g.reshape(-1, 3)).reshape(50, 40), axis=1) >= -1e-9).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality.judge_documents(real, quality.fit_quality(real, labels)).withColumnRenamed(KEY, "doc_id").join(labels, "doc_id")
    assert judged.where("quality = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert judged.where("quality = 0 AND kept").count() <= 1
    assert quality.fit_quality(empty, labels) is None and quality.keep_good(empty, None).count() == 0
    assert quality.keep_good(docs, None).columns == docs.columns


@pytest.mark.parametrize("beam", [4, 24])  # filled with links, and not
def test_graph_finds_places_that_none_points_to(beam):
    rng = np.random.default_rng(0)
    x = np.array([1.0, 0, 0, 0]) + 0.03 * rng.normal(size=(12, 4))
    graph = embedding_dedup.Hnsw.__new__(embedding_dedup.Hnsw)
    graph.vec = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ring = np.array([[(i - 1) % 11, (i + 1) % 11] for i in range(11)] + [[3, 5]], np.int32)
    graph.layers = [ring]  # the last place points to others, and no other to it
    query, place = graph.within(graph.vec, 0.95, beam)
    assert sorted(zip(query.tolist(), place.tolist())) == [(a, b) for a in range(12) for b in range(12)]
    assert graph.audit(0.95, 0.98, graph.vec, np.arange(12))[0] == 24


def test_coder_round_trip_and_damage(docs, rows, empty, spark, tmp_path):
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65536, n) for n in (0, 1, 300)] + [np.tile(rng.integers(0, 5000, 9), 60), rng.zipf(1.3, 900) % 49408]
    coded = mixing_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, mixing_coder.decode_blocks(coded, list(map(len, blocks)))))
    assert len(coded[3]) < 200
    data = bytearray(token_files.MAGIC + token_files.segment([1, 2], [blocks[3], blocks[4]]))
    data[-40] ^= 1
    with pytest.raises(ValueError):
        list(token_files.segments(bytes(data)))
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    got, at = table(token_files.round_trip(docs, path)), 0
    for i, x in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.round_trip(empty, path).count() == 0


def test_byte_bpe_matches_the_library(docs, rows, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ids = bpe.encode_documents(docs, path, pattern)
    assert {r[KEY]: r.ids for r in ids.collect()} == {i: enc.encode_ordinary(t or "") for i, t in rows}
    assert {r[KEY]: bytes(r.decoded) for r in bpe.decode_documents(ids, path, pattern).collect()} == {i: (t or "").encode() for i, t in rows}
    assert bpe.encode_documents(empty, path, pattern).count() == 0
    one = bpe.ranked(path, pattern)
    assert sorted(one.hash.slot) == list(range(len(ranks))) and one.hash.find(b"\xff\xfe\xfd no") == -1


def test_pipeline_takes_effect(spark, sf_dir):
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test")
        assert after.columns == before.columns, name
        assert after.count() <= docs.count() and after.exceptAll(docs).count() + docs.exceptAll(after).count() > 0, name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "suffix-array dedup", "pii", "best-fit packing"]


def stored_stages(spark):
    path = shared_dir(spark).removeprefix("file://").removeprefix("file:") + "/reachmark"
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def test_stages_leave_only_what_their_result_reads(spark, docs, rows):
    before = stored_stages(spark)
    kept = simhash.keep_one(docs, shingle=5, least=0.8, distance=3)
    groups_left = {s.rsplit("-", 1)[0] for s in stored_stages(spark) - before}
    assert groups_left == {"groups"}
    assert kept.count() < len(rows)
    before = stored_stages(spark)
    cut = suffix_dedup.remove_repeats(docs)
    assert {s.rsplit("-", 1)[0] for s in stored_stages(spark) - before} == {"marks"}
    digests = {r.doc: r.kept_sha256 for r in suffix_dedup.repeat_digests(docs).collect()}
    whole = {r.doc_id: (r.text or "").encode() for r in cut.collect()}
    assert all(hashlib.sha256(whole[i]).hexdigest() == digests[i] for i, t in rows if (t or "").isascii())


def test_settled_stages_may_nest_and_fail(spark):
    before = stored_stages(spark)

    def inner():
        first = materialize(spark.range(7), "inner")
        return first.union(settle(spark, lambda: materialize(spark.range(5), "innermost"), "settled"))

    def fails():
        materialize(spark.range(3), "lost")
        raise ValueError("no")

    outside = materialize(spark.range(2), "outside")
    df = settle(spark, inner, "outer")
    with pytest.raises(ValueError):
        settle(spark, fails)
    materialize(spark.range(4), "later")
    assert sorted(s.rsplit("-", 1)[0] for s in stored_stages(spark) - before) == ["later", "outer", "outside"]
    assert df.count() == 12 and outside.count() == 2


def test_names_of_other_columns_do_not_clash(spark):
    line = "".join(f"{i:04d}" for i in range(60))
    data = [(1, line, 7, "a", "s", 1.5), (2, "x" + line, 8, "b", "t", 2.5), (2, "x" + line, 8, "b", "t", 2.5), (None, None, 9, "c", "u", 3.5)]
    df = spark.createDataFrame(data, "doc_id long, text string, _doc int, _t string, _spans string, _gone double")
    got = suffix_dedup.remove_repeats(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r._doc, r._t, r._spans, r._gone) for r in got.collect()) == [
        (0, None, 9, "c", "u", 3.5), (1, line, 7, "a", "s", 1.5), (2, "x", 8, "b", "t", 2.5), (2, "x", 8, "b", "t", 2.5),
    ]
    pages = spark.createDataFrame([("http://net/x", 1, 2, True)], "url string, _row int, _best int, block boolean")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, action string")
    for size in (url_filter.MAX_FILTER_BYTES, 0):
        row = url_filter.judge_urls(pages, rules, max_bytes=size).first()
        assert (row._row, row._best, row.block, row.url_verdict) == (1, 2, True, "block")
    with pytest.raises(ValueError, match="url_rule"):
        url_filter.judge_urls(pages.withColumnRenamed("block", "url_rule"), rules)


def test_rules_do_not_run_over_the_end_of_a_host(spark):
    pages = spark.createDataFrame([("http://neten/x",), ("http://net/en/x",), ("http://neten/",)], "url string")
    rules = spark.createDataFrame([("net", "en/", "block"), ("net", "/en/", "block")], "host string, path string, action string")
    for size in (url_filter.MAX_FILTER_BYTES, 0):
        got = {r.url: (r.url_rule, r.url_verdict) for r in url_filter.judge_urls(pages, rules, max_bytes=size).collect()}
        assert got == {"http://neten/x": (None, "allow"), "http://net/en/x": ("net/en/", "block"), "http://neten/": (None, "allow")}


def test_equal_rows_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 64)
    df = spark.createDataFrame([(5, "same words again")] * 600, "doc_id long, text string").repartition(2)
    got = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json"), 64, 2)
    assert got.columns == [KEY, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert len(rows) == 600 and len({r.sequence_id >> 32 for r in rows}) > 4
    assert len({(r.sequence_id, r.offset) for r in rows}) == 600


def test_counts_beyond_32_bits_survive_the_answers():
    n = np.array([0, 1, 2**32 + 5, 2**40], np.uint64)
    assert language_model._unzip(language_model._zip(n), np.uint64).tolist() == n.tolist()


def test_similar_groups_link_fingerprints_too(spark):
    """Groups are those of both kinds of links; fingerprints count repeats, which sets of shingles do not."""
    import random

    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for _ in range(6):
        line = " ".join(word() for _ in range(5))
        texts += [" ".join([line] * 60 + [word() for _ in range(10)]) for _ in range(3)]
    body = [word() for _ in range(100)]
    texts += [" ".join(body), " ".join(body[:96]), "", None, " ".join(word() for _ in range(50))]
    prints = [simhash.fingerprint((t or "").encode(), 5) for t in texts]
    sets = [set(simhash._shingles((t or "").encode(), 5).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (prints[i] ^ prints[j]).bit_count() <= 3 or not union or len(sets[i] & sets[j]) >= 0.8 * union:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["_key"]: r["component"] for r in simhash.similar_groups(df, distance=3).select(simhash.KEY, "component").withColumnRenamed(simhash.KEY, "_key").collect()}
    assert [got[i] for i in range(len(texts))] == group
    assert group[:3] == [0, 0, 0] and group[18:20] == [18, 18]
    alone = {r[simhash.KEY]: r["component"] for r in simhash.similar_groups(df).collect()}
    assert alone[1] == 1 and alone[19] == 18


def test_every_shingle_of_every_text_is_counted(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 50, raising=False)  # was a bound beyond which a share of the texts was counted
    monkeypatch.setattr(simhash, "CHUNK", 500)
    rng = random.Random(9)
    put = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, pair = put(12), put(12)
    data = [" ".join(put(20) + (line if i < 30 else []) + (pair if i in (3, 40) else [])) for i in range(60)] + ["", "two words"]
    texts = spark.createDataFrame(list(zip(data, range(len(data)))), "text string, t long").repartition(3)
    want = collections.Counter(g for t in data for g in simhash._shingles(t.encode(), 5).tolist())
    rank, most = simhash.common_shingles(texts, 5)
    ranks = dict(zip(want, rank(np.array(list(want), np.uint64)).tolist()))
    assert most == 30 and all(ranks[g] == c for g, c in want.items() if c > 1)
    assert max(ranks[g] for g, c in want.items() if c == 1) <= 1 and sum(ranks.values()) < sum(want.values())


def test_only_sets_of_likely_pairs_are_stored(spark, monkeypatch):
    """A text that shares no shingle with another one takes no room on disk but a number."""
    rng = random.Random(10)
    put = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    stored, real = [], simhash.materialize

    def counted(df, label="stage"):
        out = real(df, label)
        stored.append(out.count() if any(kind == "binary" for _, kind in out.dtypes) else 0)
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    body = put(60)
    data = [(i, put(60)) for i in range(300)] + [(300, body), (301, body + " x"), (302, body), (303, None), (304, " ")]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string").repartition(3), distance=3).collect()}
    assert kept == {*range(301), 303} and 0 < max(stored) < 20
