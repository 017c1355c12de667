"""Edge cases of the operators: nulls, empty and long texts, ties, repeated rows, empty tables, columns of clashing names."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_queries import groups, plain_tokens, shingles, suffixes_removed

from varspark.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing, permutation_index, queries, suffix_dedup, token_store, url_filter, warc
from varspark.llm.blocks import RunHashes, spaced_words, text_blocks

HELPERS = ["_id", "_hash", "_source", "_copies", "_copy", "_doc", "_starts", "_kept", "_spans", "_tie", "__id", "ra", "rb", "low", "line", "copies"]
DOCS = "doc_id long, text string, lang string, source string, key long, n long, size long, id string, start long, spans string, " + ", ".join(f"{h} string" for h in HELPERS)


def docs_of(spark, rows):
    """Documents with more columns, whose names the operators use inside."""
    return spark.createDataFrame([(*r[:2], *(list(r[2:4]) + [None, None])[:2], 1, 2, 3, "x", 4, "y", *HELPERS) for r in rows], DOCS)


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, first long, verdict string")


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


# ---- line dedup


def test_lines_of_later_runs_go(spark):
    text = "a\nb\nc\nd"
    rows = [(1, text), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, None), (5, ""), (None, "p\na\nb\nc"), (None, None)]
    got = {(r.doc_id, r.text): (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    # The row without id comes first, so a, b, c are its own.
    assert got == {(1, "d"): (4, 3), (2, "x\ny"): (6, 4), (3, "a\nb"): (2, 0), (4, None): (0, 0), (5, ""): (1, 0), (None, "p\na\nb\nc"): (4, 0), (None, None): (0, 0)}


def test_lines_repeated_in_one_text_and_repeated_rows(spark):
    rows = [(1, "\n".join("abcabc")), (1, "\n".join("abcabc")), (2, "\n".join("aaaaa"))]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, rows)).collect())
    assert got == [(1, "a\nb\nc", 3), (1, "a\nb\nc", 3), (2, "", 5)] or got == [(1, "a\nb\nc", 3), (1, "a\nb\nc", 3), (2, "a", 4)]


def test_lines_of_no_documents(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [(1, "a")]).limit(0)).count() == 0


def test_short_runs_that_hold_enough_go(spark):
    long, other, half = " ".join(words(60, 1)), " ".join(words(60, 2)), [" ".join(words(25, s)) for s in (3, 4)]
    few = " ".join(words(49, 5))
    rows = [
        (1, f"a\n{long}\nb"), (2, long), (3, f"x\n{long}\n{other}\ny"), (4, other + "\nz"),  # one line
        (10, "p\n" + "\n".join(half)), (11, "\n".join(half) + "\nq\n" + half[1]), (12, "\n".join(half)),  # two lines
        (20, "s\nt"), (21, "s\nt"), (22, "s\nt\nu"), (23, "one"), (24, "one"), (25, "s"),  # whole texts
        (30, few + "\nc"), (31, few + "\nd"), (40, " \n"), (41, " \n"), (42, ""), (43, ""),  # too little
    ]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
    expected = {i: (t, 0) for i, t in rows}
    expected |= {2: ("", 1), 3: (f"x\n{other}\ny", 1), 4: ("z", 1), 11: (f"q\n{half[1]}", 2), 12: ("", 2), 21: ("", 2), 24: ("", 1)}
    assert got == expected
    plain = line_dedup.dedup_lines(docs_of(spark, rows), least_words=None).collect()
    assert {r.doc_id for r in plain if r.n_removed} == set()


def test_postings_are_the_chosen_lines(spark):
    rng = random.Random(8)
    rows = [(k, "\n".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) for k in range(30)]
    got = line_dedup.winnow(docs_of(spark, rows), least_words=None)
    plain = {(r.doc_id, r.line) for r in got.select("doc_id", "line").collect()}
    hashes = {r.x: r.h for r in spark.createDataFrame([(x,) for x in "abcdefgh"], "x string").selectExpr("x", "xxhash64(1, x) as h").collect()}
    expected, windows = set(), 0
    for k, text in rows:
        lines = text.split("\n")
        for s in range(len(lines) - 2):
            least = min(hashes[x] for x in lines[s : s + 3])
            expected.add((k, max(s + i for i in range(3) if hashes[lines[s + i]] == least)))
            windows += 1
    assert plain == expected and got.count() == len(expected) < windows
    assert line_dedup.extended(got, 3).count() == windows


# ---- suffix dedup


def test_rows_without_id_whose_texts_share_a_short_hash(spark):
    # Equal 32-bit hashes; the common passage is covered in both, the rest of each in none.
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    tails = [f"{k:08d}" for k in range(200_000)]
    found = spark.createDataFrame([(passage + t,) for t in tails], "t string").selectExpr("t", "hash(t) as h")
    pair = found.groupBy("h").agg({"t": "collect_list"}).toDF("h", "t").where("size(t) > 1").first().t[:2]
    rows = [(None, pair[0]), (None, pair[1] + "z"), (None, pair[1])]
    got = sorted(tuple(r)[1:5] for r in suffix_dedup.dedup_suffixes(docs_of(spark, rows)).collect())
    assert got == sorted(suffixes_removed([t.encode() for _, t in rows], 200))


@pytest.mark.parametrize("crowd", [1, 4096])
def test_suffixes_against_brute_force(spark, crowd):
    rng = random.Random(3)
    passage = bytes(rng.randrange(97, 123) for _ in range(500)).decode()
    texts = [passage, "x" * 7 + passage[100:420] + "é" * 90, passage[:199], passage[200:400] * 3, "ab" * 300, "z" * 1000, "", None, passage + passage, passage[250:] + passage[:250]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, passage), (None, passage[:300]), (None, "short")]
    got = [tuple(r)[:5] for r in suffix_dedup.dedup_suffixes(docs_of(spark, rows), crowd=crowd).collect()]
    expected = [(r[0], *e) for r, e in zip(rows, suffixes_removed([(r[1] or "").encode() for r in rows], 200), strict=True)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_suffixes_of_a_text_longer_than_a_part(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3 * suffix_dedup.PART_BYTES))
    edge = suffix_dedup.PART_BYTES
    rows = [(1, long), (2, long[edge - 150 : edge + 150]), (3, long[5:204])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.dedup_suffixes(docs_of(spark, rows)).collect()}
    assert got == {1: (len(long), 300, 1), 2: (300, 300, 1), 3: (199, 0, 0)}


def test_suffixes_of_no_documents(spark):
    assert suffix_dedup.dedup_suffixes(docs_of(spark, [(1, "a")]).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=5))
def test_slices_hold_all_windows_and_choose_alike(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    text, first, count, place, key, _ = suffix_dedup.slices_of(data, starts, 8, 3)
    chosen = collections.defaultdict(set)
    windows = []
    for t, f, c, p, k in zip(text, first, count, place, key, strict=True):
        for j in range(c):
            windows.append(f + j)
            assert starts[t] <= f + j and f + j + 8 <= starts[t + 1] and 0 <= p - j <= 5
            chosen[data[f + j : f + j + 8].tobytes()].add((k, p - j))
    assert sorted(windows) == [s + i for s, t in zip(starts, texts) for i in range(len(t) - 7)]
    assert all(len(c) == 1 for c in chosen.values())


# ---- WARC


def test_archives_round_trip(spark, tmp_path):
    rows = [(3, "http://a/", "x"), (1, "http://b/", "x"), (2, None, None), (5, "http://c/ \n", ""), (1, "http://b/", "x"), (None, "http://d/", "x"), (9, "u", "é" * 90000)]
    got = [tuple(r) for r in warc.archived_pages(pages_of(spark, rows)).drop("url", "payload_digest").collect()]
    one = [(1, 1, "response", None)] * 2
    assert sorted(got, key=repr) == sorted([*one, (3, 1, "revisit", 1), (2, 0, "response", None), (5, 0, "revisit", 2), (None, 1, "response", None), (9, 180000, "response", None)], key=repr)


def test_archives_are_streams_with_a_dictionary_first(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"<html>{i}" + " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(2000))) for i in range(60)]
    path = str(tmp_path / "warc")
    warc.write_archives(pages_of(spark, rows), path, archive_bytes=40_000)
    files = [p for p in (tmp_path / "warc").rglob("part-*")]
    assert len(files) > 1
    for f in files:
        content = f.read_bytes()
        assert content[:4] == bytes.fromhex("5d2a4d18")
        assert all(r.startswith(b"WARC/1.1\r\n") for r in warc.records_of(content))
        with pytest.raises(ValueError):
            list(warc.records_of(content[:-12]))
    back = {r.page_id: r.payload.decode() for r in warc.read_archives(spark, path).collect()}
    assert back == {r[0]: r[2] for r in rows}


def test_damaged_records_are_told():
    good = warc.page_record(1, "http://a/", b"payload", warc.digest_of(b"payload"), None)
    assert warc.page_of(*warc.parse_record(good))[:3] == (1, "http://a/", 7)
    for bad in (good.replace(b"payload\r", b"paYload\r"), good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Type", b"Other")):
        with pytest.raises(ValueError):
            warc.page_of(*warc.parse_record(bad))


def test_archives_of_no_pages(spark):
    assert warc.archived_pages(pages_of(spark, [(1, "u", "h")]).limit(0)).count() == 0


# ---- Jaccard join


def test_groups_against_brute_force(spark):
    base = words(60, 1)
    rows = [(1, " ".join(base)), (2, "\t".join(base).upper()), (3, " ".join(base[:52])), (4, " ".join(base[8:])), (5, "one two"), (6, "ONE  two\n"), (7, None), (8, " \n"), (9, "one")]
    rows += [(20 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(0, 60, 3)]
    small = words(9, 2)
    rows += [(100, " ".join(small)), (101, " ".join(small[:8])), (102, " ".join(small[1:])), (103, " ".join(small[2:]))]
    sets = {r[0]: shingles(r[1]) for r in rows}
    found = groups(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs_of(spark, rows)).collect()}
    assert got == {i: (len(s), found[i]) for i, s in sets.items()}


def test_groups_with_repeated_and_missing_ids(spark):
    text = " ".join(words(30, 4))
    rows = [(5, text), (5, text), (None, text), (None, None), (7, "other words here"), (7, text)]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.jaccard_groups(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None), (7, 7), (7, 5)], key=repr)
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each_group(docs_of(spark, rows)).collect()), key=repr)
    assert kept == sorted([(5, text), (None, None), (7, "other words here")], key=repr)


def test_groups_of_no_documents(spark):
    assert jaccard_join.jaccard_groups(docs_of(spark, [(1, "a")]).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(3, 120), st.integers(0, 40), st.integers(0, 40), st.integers(0, 60), st.integers(0, 10**6))
def test_linked_sets_share_the_keys_they_must(n, left, right, small, seed):
    rng = np.random.default_rng(seed)
    tokens = np.unique(rng.integers(0, 2**63, n + left + right, dtype=np.uint64))
    a, b = tokens[: n + left], np.concatenate([tokens[:n], tokens[n + left :]])
    plan = jaccard_join.Plan(rng.random(1 << jaccard_join.BUCKET_BITS) < 0.3, small, 75)
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both) or len(a) == len(b) == both:
        return
    x, y = (np.sort(s) for s in (a, b))
    assert jaccard_join._close(*[np.array([len(s)]) for s in (x, y)], *[np.frombuffer(jaccard_join.bitmap(s), np.uint64)[None] for s in (x, y)], 75)[0]
    shared = np.intersect1d(jaccard_join.keys_of(x, plan), jaccard_join.keys_of(y, plan))
    assert (shared & np.uint64(1) == 0).any() or (shared & np.uint64(1) == 1).sum() >= jaccard_join._meet(min(len(x), len(y)))


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    """Pairs of different components are found once per list, whatever the block size."""
    rng = np.random.default_rng(0)
    core = rng.integers(0, 2**63, 40, dtype=np.uint64)
    sets = {i: np.sort(np.concatenate([core, rng.integers(0, 2**63, 4, dtype=np.uint64)])) for i in range(30)}
    rows = [(key, i, 44, bytearray(jaccard_join.bitmap(s)), i % 10) for i, s in sets.items() for key in (11, 13, 15)]
    lists = spark.createDataFrame(rows, "key long, id long, n int, bits binary, component long")
    expected = {(a, b) for a in range(30) for b in range(a + 1, 30) if a % 10 != b % 10}
    for block in (7, 2048):
        monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
        monkeypatch.setattr(jaccard_join, "LEAD_ROWS", 4 * block)
        got = jaccard_join.cross_pairs(lists, jaccard_join.open_lists(lists), 75).collect()
        assert {(r.a, r.b) for r in got} == expected and {r.met for r in got} == {3}


@pytest.mark.parametrize("similarity", [51, 60, 66])
def test_lower_similarities_link_small_sets(spark, similarity):
    texts = {}
    for g in range(40):
        base = words(5 + g % 6, g)
        for k in range(3):  # one word more each time: sets of 1, 2, 3 shingles and so on
            texts[3 * g + k] = " ".join(base + words(k, 1000 + g))
    sets = {i: shingles(t) for i, t in texts.items()}
    expected = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                one, other = expected[a], expected[b]
                expected = {i: min(one, other) if c in (one, other) else c for i, c in expected.items()}
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(docs_of(spark, list(texts.items())), similarity=similarity).collect()}
    assert got == expected and any(len(sets[i]) == 2 and any(expected[j] == expected[i] for j in sets if j != i) for i in sets)


def test_similarities_that_the_keys_do_not_prove(spark):
    for similarity in (50, 101):
        with pytest.raises(ValueError, match="similarity"):
            jaccard_join.make_plan(np.ones(1 << jaccard_join.BUCKET_BITS), {}, similarity)
    # Sets of 19 and 20 shingles that share 19 have 95 per cent, but may have one list in common.
    lists = spark.createDataFrame([(11, 1, 19), (11, 2, 20)], "key long, id long, n int")
    assert {r.id for r in jaccard_join.with_partners(lists, 95).collect()} == {1, 2}
    assert {r.id for r in jaccard_join.with_partners(lists).collect()} == {1}


# ---- decontamination


def test_contamination_edges(spark):
    item = " ".join(f"i{k}" for k in range(20))
    bench = spark.createDataFrame([(10, item), (2, "Tiny Item"), (3, None), (4, "!?"), (None, "null id here")], "item_id long, text string")
    rows = [(1, "so " + item.upper() + " end"), (2, "a tiny, ITEM and more " * 3), (3, None), (4, ""), (5, "Éa tiny"), (None, "tiny item"), (6, "null id here " + "x " * 90), (2, "a tiny, ITEM and more " * 3)]
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.contamination(docs_of(spark, rows), bench).collect()), key=repr)
    assert got == sorted(
        [(1, 22, 20, ["10"], True), (2, 15, 6, ["2"], True), (2, 15, 6, ["2"], True), (3, 0, 0, [], False), (4, 0, 0, [], False), (5, 2, 0, [], False), (None, 2, 2, ["2"], True), (6, 93, 3, [], False)],
        key=repr,
    )
    joined = decontaminate.contamination(docs_of(spark, rows), bench, broadcast_windows=0)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in joined.collect()), key=repr) == got
    clean = decontaminate.without_contaminated(docs_of(spark, rows), bench)
    assert clean.columns == docs_of(spark, rows).columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6]
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(docs_of(spark, rows), bench).collect()}
    assert cut[1] == "so end" and cut[2] == "a and more a and more a and more " and cut[3] is None and cut[5] == "Éa tiny"


def test_contamination_without_rows(spark):
    docs, bench = docs_of(spark, [(1, "a b")]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert [(r.n_words, r.n_hit) for r in decontaminate.contamination(docs, bench.limit(0)).collect()] == [(2, 0)]


def test_native_operators_plan_no_python(spark):
    for name in ("op1_line_dedup", "op5_decontaminate", "op10_url_filter"):
        plan = queries.all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


# ---- mixing


def test_targets_fill_up_by_weight(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes, (3, 1, 2), 1.5, 2.0).collect()}
    # a and c stop at twice their size; b takes the rest.
    assert got == {"a": 200.0, "b": 1445.0, "c": 20.0, None: 0.0}


def test_mix_edges(spark):
    rows = [(i, " ".join(words(1 + i % 7, i)), None, "s" if i % 3 else None) for i in range(300)]
    rows += [(500, None, None, "s"), (501, "", None, "t"), (None, "a b c", None, "s"), (7, "same text", None, "s"), (7, "same text", None, "s")]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs, buckets=4).collect()
    assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
    total, target = collections.Counter(), {}
    for r in got:
        total[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(total[s] - t) <= 7 for s, t in target.items())
    twins = [r.copies for r in got if r.doc_id == 7 and r.size == 2]
    assert len(twins) == 2 and len(set(twins)) == 1
    out = mixing.mixed(docs, buckets=4)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_documents_are_taken_as_often_as_their_odds_say(spark):
    """Many sources of twenty like documents each, half of them preferred: p = 0.5, so 0.625 and 0.375."""
    from pyspark.sql import functions as F

    rows = [(100 * s + k, " ".join(["w"] * 10), "en" if k % 2 else "de", f"s{s:03}") for s in range(200) for k in range(20)]
    got = mixing.mix(docs_of(spark, rows), weights=(1,), share=0.5, preference=F.when(F.col("lang") == "en", 1.0).otherwise(0.0)).collect()
    per_source, taken = collections.Counter(), collections.Counter()
    for r in got:
        per_source[r.source] += r.copies
        taken[r.doc_id % 2] += r.copies / 2000
    assert set(per_source.values()) == {10} and len(per_source) == 200
    assert abs(taken[1] - 0.625) < 0.04 and abs(taken[0] - 0.375) < 0.04


def test_mix_prefers_long_documents_and_fills_the_target(spark):
    rows = [(k, " ".join(["w"] * (2000 if k % 2 else 50)), None, "s") for k in range(1000)]
    got = mixing.mix(docs_of(spark, rows), weights=(1,), share=0.3).collect()
    target = got[0].target
    assert abs(sum(r.copies * r.size for r in got) - target) <= 1000  # half of a long one: the closing one is the nearest that brings it nearer
    long, short = [sum(r.copies for r in got if r.doc_id % 2 == odd) / 500 for odd in (1, 0)]
    mean = 2000 / 2050 * 800 / 1000 + 50 / 2050 * 90 / 1000
    assert abs(long - (0.3 + 0.15 * (0.8 - mean))) < 0.03 and abs(short - (0.3 + 0.15 * (0.09 - mean))) < 0.07


def test_rows_without_id_that_differ_are_drawn_apart(spark):
    rows = [(None, f"a {k}", None, "s") for k in range(2000)] + [(None, "the same", None, "s")] * 500
    got = mixing.mix(docs_of(spark, rows), weights=(1,), share=0.5, buckets=64).collect()
    same = {r.copies for r in got if r.text_hash == collections.Counter(r.text_hash for r in got).most_common(1)[0][0]}
    assert len(got) == 2500 and len(same) == 1
    assert abs(sum(r.copies for r in got) - 1250) <= 250  # half of the copies that go together


# ---- nearest neighbours


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (0, [0.0, 5.0]), (100, [1e-200, 1e-200])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = collections.defaultdict(list)
    for r in sorted(permutation_index.neighbours(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, round(r.score, 6)))
    assert set(got) == {0, 50, 100}
    assert got[50][:2] == [(0, 1.0), (1, 1.0)] and {v for v, _ in got[50]} == {0, 1, 2, 100}
    assert got[100][0][1] == pytest.approx(0.707107) and 0 not in {v for v, _ in got[0]}
    assert permutation_index.neighbours(df.limit(0)).count() == 0


def test_queries_in_several_passes(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    one, many = permutation_index.neighbours(df, every=10), permutation_index.neighbours(df, every=10, pass_queries=7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in permutation_index.neighbours(df).collect()]
    assert sorted(g[2] for g in got if g[0] == 0) == [1, 2, 3, 4, 5] and sorted(g[2] for g in got if g[0] == 50) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("noise", [0.1, 0.01, 0.001])
def test_recall_in_a_tight_crowd(noise):
    """A third of a block lies around one place, without exact copies."""
    rng = np.random.default_rng(5)
    n, size, k = 6000, 64, 5
    rows = rng.normal(size=(n, size))
    crowd = rng.permutation(n)[: n // 3]
    rows[crowd] = permutation_index.unit(rng.normal(size=(1, size))) + noise * permutation_index.unit(rng.normal(size=(len(crowd), size)))
    units, ids = permutation_index.unit(rows), np.arange(n)
    pivots = np.concatenate([units[crowd[:1]], np.delete(units, crowd, axis=0)[: permutation_index.PIVOTS - 1]])
    near = permutation_index._order(rows, pivots)
    block = permutation_index.BlockIndex(ids, rows, near[:, : permutation_index.POSTED].astype(np.int16), len(pivots))
    hits, asked = 0, np.concatenate([crowd[:40], np.setdiff1d(ids, crowd)[:20]])
    for q in asked:
        score = units @ units[q]
        score[q] = -np.inf
        best = np.lexsort((ids, -score))[:k]
        got, _ = block.nearest(q, units[q], near[q][: permutation_index.READ], k, permutation_index.RERANKED, permutation_index.LEAST)
        hits += len(set(got.tolist()) & set(best.tolist()))
    assert hits / (k * len(asked)) >= 0.99


# ---- language


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 7, 20):
        code = language_id.codewords(n)
        assert len({tuple(r) for r in code}) == n and all(abs(c.sum()) < n for c in code.T)


def test_language_edges(spark):
    vowels, others = "aeiou", "bcdfg"
    make = lambda signs, seed: " ".join("".join(random.Random(seed * 100 + k).choices(signs, k=5)) for k in range(40))
    rows = [(i, make(vowels, i), "vo", None) for i in range(60)] + [(100 + i, make(others, i), "co", None) for i in range(60)]
    rows += [(900, None, "vo", None), (901, "", "co", None), (902, "12 34 !", "vo", None), (903, "éé aiueo", None, None), (None, make(others, 5), "vo", None), (904, "Я", None, None)]
    docs = docs_of(spark, rows)
    model = language_id.fit(docs)
    got = {(r.doc_id): r for r in language_id.identify(docs, model).collect()}
    assert model.languages == ["co", "vo"] and len(got) == len(rows)
    assert all(got[i].lang_pred == ("vo" if i < 100 else "co") for i in [*range(60), *range(100, 160)])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[902].lang_score == 0
    assert got[None].lang_pred == "co" and got[904].lang_pred != "und"
    assert language_id.identify(docs, model).drop("lang_pred", "lang_score", "lang_ambiguous").columns == docs.columns
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


# ---- token ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 70000), st.integers(0, 2**32 - 1)), max_size=300))
def test_packed_ranks_round_trip(ranks):
    control, data = token_store.pack(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_store.unpack(control, data, len(ranks)).tolist() == ranks


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab Z.,'\n\t1é 　ß漢<|>s")), max_size=30), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    encoder = token_store.PieceEncoder(TOKENIZER, 2, np.dtype("<u2"), most=20)
    expected = [[*e.ids, 2] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in (encoder.ids(texts) if texts else [])] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abÉ5 .,'\n\r\0\x1c\x85\xa0\u1680\u2009\u201d\u205f\u3000漢-")), max_size=25), min_size=1, max_size=5))
def test_cuts_beside_any_white_space_give_the_ids_of_whole_texts(texts):
    encoder = token_store.PieceEncoder(TOKENIZER, 2, np.dtype("<u2"))
    expected = [[*e.ids, 2] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.ids(texts)] == expected
    apart = pa.array(["before", *texts]).slice(1)  # a slice begins within its bytes
    assert [x.tolist() for x in encoder.ids(apart)] == expected


def test_words_are_learned_once_whatever_stands_after_them():
    """A line's end, a comma or a full stop makes no new piece of a known word."""
    encoder = token_store.PieceEncoder(TOKENIZER, 2, np.dtype("<u2"))
    encoder.ids(["x one two three.\nfour five, six"])
    known = encoder.n
    encoder.ids(["x six.\nfour three, one\nfour two. five one"])
    assert encoder.n == known


def test_slices_hold_all_texts_in_bounded_runs():
    sizes = [3, 0, 9, 20, 1, 1, 0]
    got = list(token_store._slices(sizes, 10))
    assert got == [(0, 2), (2, 3), (3, 4), (4, 7)] and list(token_store._slices([], 10)) == []


TOKENIZER = queries.tokenizer_json()


def test_token_edges(spark):
    rows = [(5, "b b b"), (1, "Hello, world.\nNew  line <|endoftext|> x"), (None, "z"), (3, None), (4, ""), (5, "b b b"), (5, "a"), (9, "word " * 70000)]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.encoded_documents(docs_of(spark, rows), TOKENIZER).collect())
    assert [g[1] for g in got] == [None, 1, 3, 4, 5, 5, 5, 9]
    assert got[0][0] == 0 and all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
    alone = {t: next(plain_tokens([t]))[1:] for t in {r[1] or "" for r in rows}}
    assert collections.Counter(g[2:] for g in got) == collections.Counter(alone[r[1] or ""] for r in rows)
    assert token_store.encoded_documents(docs_of(spark, rows).limit(0), TOKENIZER).count() == 0


def test_small_shards_keep_the_order_and_damage_is_told(spark, tmp_path):
    rows = [(i, " ".join(words(50, i))) for i in range(120)]
    path = str(tmp_path / "shards")
    token_store.write_shards(docs_of(spark, rows), path, TOKENIZER, 2, shard_ids=2000)
    shards = sorted((tmp_path / "shards").glob("shard=*"))
    assert len(shards) > 3
    order = []
    for shard in shards:
        content = next(shard.glob("part-*")).read_bytes()
        for doc_ids, _, ids in token_store.read_shard(content):
            order += doc_ids
            assert ids[-1] == 2
        with pytest.raises(ValueError):
            list(token_store.read_shard(content[:-5]))
        with pytest.raises(ValueError):
            list(token_store.read_shard(content[:-40] + bytes([content[-40] ^ 1]) + content[-39:]))
    assert order == list(range(120))


# ---- URLs


def test_url_edges(spark):
    rules = [url_filter.site_rule(*r) for r in queries.SITE_RULES] + [url_filter.name_rule(n) for n in queries.BLOCKED_NAMES]
    urls = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/net/": ("", "", None, "allow"),
        "http://A.NET": ("a.net", "", None, "allow"), "http://a.net/": ("a.net", "/", "net/", "block"), "http://net/x?y#z": ("net", "/x", "net/", "block"),
        "http://xnet/": ("xnet", "/", None, "allow"), "http://m.example.net/en/1": ("m.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/EN/1": ("example.net", "/EN/1", "net/", "block"), "http://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
        "http://example.com/de/x": ("example.com", "/de/x", "example.com/de/", "block"), "http://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://x.casino-win.org/fr/": ("x.casino-win.org", "/fr/", "org/fr/", "allow"), "http://x.casino-win.org/en/": ("x.casino-win.org", "/en/", None, "block"),
        "http://a#http://b.net/": ("a", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(0, None, None), (None, "http://a.net/", None)]
    got = sorted((tuple(r)[:5] for r in url_filter.judge_urls(pages_of(spark, rows), rules).collect()), key=repr)
    assert got == sorted([(r[0], *urls[r[1]]) for r in rows], key=repr)
    assert url_filter.judge_urls(pages_of(spark, rows).limit(0), rules).count() == 0


def test_rules_lie_under_their_rarest_token(spark):
    pages = pages_of(spark, [(i, f"http://ads.host{i}.com/", None) for i in range(5)] + [(9, "http://rare.com/", None)])
    rules = [url_filter.Rule("r", "block", "ads.*rare", ["ads", "rare", "com"], 1)]
    assert [r.token for r in url_filter.rule_index(pages, rules).collect()] == ["rare"]


# ---- helpers


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB \n\t\x0bé ", max_size=12)), max_size=8), st.integers(1, 40))
def test_words_of_blocks(texts, most):
    import pyarrow as pa

    found = []
    for block in text_blocks(pa.array(texts, pa.string()), most):
        data, starts, ends, first = spaced_words(block)
        found += [[data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert found == [(t or "").encode().lower().split() for t in texts]


def test_equal_runs_have_equal_hashes():
    data = np.frombuffer(b"xxabcabcabdxabc", np.uint8)
    hashes = RunHashes(data).of(np.array([2, 5, 12, 8, 2]), np.array([5, 8, 15, 11, 6]))
    assert len(set(hashes[:3].tolist())) == 1 and len(set(hashes.tolist())) == 3


# ---- names of helper columns, long texts, and a plain decoder


def test_all_columns_pass_through_whatever_their_names(spark):
    text = " ".join(words(40, 3))
    rows = [(k, text + f" {k}", "en", f"s{k % 2}") for k in range(6)] + [(None, None, None, None), (7, " ".join(words(40, 4)), "de", "s1")]
    docs, bench = docs_of(spark, rows), spark.createDataFrame([("i", rows[-1][1])], "item_id string, text string")
    for stage in (
        line_dedup.dedup_lines(docs).drop("n_lines", "n_removed"), jaccard_join.one_of_each_group(docs), mixing.mixed(docs),
        decontaminate.without_contaminated(docs, bench), decontaminate.without_spans(docs, bench),
        language_id.identify(docs, language_id.fit(docs)).select(*docs.columns),
    ):
        found = stage.collect()
        assert stage.columns == docs.columns and found
        assert all([r[h] for h in HELPERS] == HELPERS for r in found)


def test_language_of_a_long_text_in_bounded_memory(spark):
    import tracemalloc

    rows = [(k, " ".join(words(60, k)) + (" der die das" if k % 2 else " the and of") * 30, "de" if k % 2 else "en") for k in range(60)]
    model = language_id.fit(docs_of(spark, rows))
    long = ("und der die das Haus " * 400_000).encode()  # 8 MB
    tracemalloc.start()
    for order in language_id.ORDERS:
        block = next(iter(text_blocks(pa.array([long], pa.large_binary()))))
        for bucket, _, begins in language_id._ngrams(block, order):
            np.add.reduceat(model.odds[bucket], begins, axis=0, dtype=np.int64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # by slices, whatever the length
    got = language_id.identify(docs_of(spark, [(1, long.decode()), (2, "1" * (9 << 20)), (3, "1" * (1 << 20) + "é")]), model).collect()
    assert {r.doc_id: r.lang_pred == "de" for r in got} == {1: True, 2: False, 3: got[2].lang_pred == "de"} and got[1].lang_pred == "und"
    assert next(r for r in got if r.doc_id == 3).lang_pred != "und"


def plain_prediction(model, text):
    """Language and score by the definition: n-grams one by one, bit margins, weighted losses of all codewords."""
    data = bytes(language_id._CLASS[np.frombuffer((text or "").encode(), np.uint8)])
    sums, n = [0] * model.odds.shape[1], 0
    for order in language_id.ORDERS:
        for i in range(len(data) - order + 1):
            key = order
            for b in data[i : i + order]:
                key = (key << 8 | b) & (1 << 64) - 1
            for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
                key = (key ^ key >> shift) * factor & (1 << 64) - 1
            bucket = (key ^ key >> 33) >> (64 - language_id.BUCKET_BITS)
            sums = [s + int(o) for s, o in zip(sums, model.odds[bucket], strict=True)]
            n += 1
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    margin = [s / 65536 * min(n, language_id.ENOUGH) / max(n, 1) for s in sums]
    losses = [sum(float(w) * float(np.log1p(np.exp(-m * c))) for m, c, w in zip(margin, row, model.reliability, strict=True)) for row in model.code]
    weight = [float(np.exp(min(losses) - x)) for x in losses]
    best = losses.index(min(losses))
    return model.languages[best], weight[best] / sum(weight)


def test_predictions_equal_a_plain_decoder(spark):
    rng = random.Random(12)
    alphabets = {"en": "etaoin", "de": "enisrü", "fr": "esaité", "es": "eaosñr", "it": "eaionl"}
    make = lambda la, n: "".join(rng.choice(alphabets[la] + " ") for _ in range(n))
    rows = [(k, make(la, 120), la) for k in range(100) for la in [list(alphabets)[k % 5]]]
    model = language_id.fit(docs_of(spark, rows))
    tests = [(k, make(rng.choice(list(alphabets)), rng.randrange(1, 90))) for k in range(60)] + [(90, ""), (91, None), (92, "12 3"), (93, "é"), (94, "x")]
    tests.append((95, make("fr", language_id.SLICE // 64)))
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language_id.identify(docs_of(spark, tests), model).collect()}
    for k, text in tests:
        lang, score = plain_prediction(model, text)
        assert got[k][0] == lang and abs(got[k][1] - score) < 1e-6
