"""Registered queries against SQL or a brute-force version, over whole tables."""

import base64
import collections
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from varspark.llm import language_id, queries

SF = os.environ.get("VARSPARK_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = queries.all_queries(), queries.all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def in_order(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    assert in_order(df.columns, [tuple(r) for r in df.collect()]) == in_order(columns, expected.fetchall())


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def suffixes_removed(texts, width):
    """Per text: bytes, removed bytes, runs, digest of the rest."""
    seen = collections.Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        yield len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_suffix_dedup(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    expected = suffixes_removed([(d[1] or "").encode() for d in documents], 200)
    assert got == {d[0]: e for d, e in zip(documents, expected, strict=True)}


def test_warc(spark, duck):
    first, expected = {}, {}
    for page, html in duck.execute("SELECT page_id, html FROM pages ORDER BY page_id").fetchall():
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        origin = first.setdefault(data, page)
        expected[page] = (len(data), digest, "response" if origin == page else "revisit", None if origin == page else origin)
    assert {r.page_id: tuple(r)[1:] for r in QUERIES["op3_warc"](spark, SF).collect()} == expected


def shingles(text, gram=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + gram]) for i in range(max(1, len(words) - gram + 1))) if words else frozenset()


def groups(sets):
    """Smallest id of each set's component under Jaccard similarity of 0.75 or more."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = collections.Counter((a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k])
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in sets}


def test_jaccard_join(spark, documents):
    sets = {d[0]: shingles(d[1]) for d in documents}
    found = groups(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_jaccard_join"](spark, SF).collect()}
    assert got == {i: (len(s), found[i]) for i, s in sets.items()}


def test_mix_comes_near_its_targets(spark):
    got = QUERIES["op6_mix_sources"](spark, SF).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].clip(lower=1) == 0).all()
    again = QUERIES["op6_mix_sources"](spark, SF).toPandas()
    key = ["doc_id", "taken"]
    assert got.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()
    per_source = got.groupby(["source_size", "target"]).taken.sum().reset_index()
    largest = got.groupby(["source_size", "target"])["size"].max().reset_index()["size"]
    assert ((per_source.taken - per_source.target).abs() <= largest).all()
    assert abs(got.taken.sum() / (1.5 * got["size"].sum()) - 1) < 0.05


def test_nearest_recall(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = collections.defaultdict(list)
    for r in sorted(QUERIES["op7_nearest"](spark, SF).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
    hits = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[k]
        score[k] = -np.inf
        best = np.lexsort((ids, -score))[:5]
        mine = got[ids[k]]
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and ids[k] not in {r.vec_id for r in mine}
        assert np.allclose([r.score for r in mine], [score[np.flatnonzero(ids == r.vec_id)[0]] for r in mine], atol=1e-12)
        hits += len({r.vec_id for r in mine} & set(ids[best].tolist()))
        total += 5
    assert set(got) == set(ids[ids % 50 == 0].tolist()) and hits / total >= 0.9


def test_language_of_held_out_documents(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, SF).collect()}
    assert len(got) == len(documents)
    for d in documents:
        assert got[d[0]].held_out == (zlib.crc32(str(d[0]).encode()) % 3 == 1) and 0 <= got[d[0]].score <= 1
    held = [d for d in documents if got[d[0]].held_out]
    assert sum(got[d[0]].lang_pred == d[2] for d in held) >= 0.95 * len(held)


def plain_tokens(texts):
    """start, n_tokens and crc32 per text in order."""
    start = 0
    for e in Tokenizer.from_str(queries.tokenizer_json()).encode_batch(texts, add_special_tokens=False):
        ids = [*e.ids, 2]
        yield start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_ids(spark, documents):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op9_token_ids"](spark, SF).collect()}
    assert got == dict(zip([d[0] for d in documents], plain_tokens([d[1] or "" for d in documents]), strict=True))


def test_pipeline_equals_a_plain_version(spark, duck, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    named = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    left = [d for d in documents if named[d[0]].lang_pred != "und" and not named[d[0]].lang_ambiguous]
    assert len(left) > 0.98 * len(documents)
    component = groups({d[0]: shingles(d[1]) for d in left})
    left = [d for d in left if component[d[0]] == d[0]]
    bad = {r[0] for r in duck.execute(f"SELECT doc_id FROM ({SQL['op5_decontaminate']}) WHERE contaminated").fetchall()}
    left = [d for d in left if d[0] not in bad]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", left)
    copies = {i: t // n for i, n, t in con.execute(f"SELECT doc_id, size, taken FROM ({SQL['op6_mix_sources']}) WHERE taken > 0").fetchall()}
    mixed = [d for d in left for _ in range(copies.get(d[0], 0))]
    expected = [(d[0], *t) for d, t in zip(mixed, plain_tokens([d[1] for d in mixed]), strict=True)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixture", "token_output"]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(expected)
