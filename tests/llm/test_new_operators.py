"""Edge cases of the filter audit, the Hilbert shards and the phrase collocations, against plain versions."""

import collections
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varspark.llm import collocations, filter_audit, hilbert_shards

DOCS = "doc_id long, text string, lang string, source string, a string, b long, mask long, n long, size long, row long, place long, shard string, curve long, part string, words string"


def docs_of(spark, rows):
    """Documents with more columns, whose names the operators use inside."""
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), "x", 1, 2, 3, 4, 5, 6, "y", 7, "z", "w") for r in rows], DOCS)


# ---- filter audit


def plain_audit(rows, labels):
    """(part, order, step) to its counts, document by document."""
    letters, firsts = "ABCDE", {}
    for i, text, *_ in rows:
        if i is not None and (text or "") in firsts:
            firsts[text or ""] = min(firsts[text or ""], i)
        elif i is not None:
            firsts[text or ""] = i
    parts = collections.defaultdict(list)
    for i, text, lang, *_ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), i is not None and i > firsts[text]]
        parts[lang or ""].append(({x for x, f in zip(letters, fails, strict=True) if f}, *labels.get(i, (0, 0))))
    found = {}
    for part, docs in parts.items():
        shapley = collections.Counter()
        for order in itertools.permutations(letters):
            gone = [False] * len(docs)
            for step, x in enumerate(order, 1):
                hit = [x in f for f, _, _ in docs]
                now = [h and not g for h, g in zip(hit, gone, strict=True)]
                shapley[x] += sum(now)
                redundant = sum(h and g for h, g in zip(hit, gone, strict=True))
                gone = [h or g for h, g in zip(hit, gone, strict=True)]
                good, toxic = [sum(d[k] for d, n in zip(docs, now, strict=True) if n) for k in (1, 2)]
                found[part, "".join(order), step] = [gone.count(False), sum(now), redundant, sum(f == {x} for f, _, _ in docs), good, toxic]
        for (p, order, step), counts in found.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def test_audit_against_a_plain_version(spark):
    rng = random.Random(4)
    kinds = ["a " * 300, " ".join(f"w{k}" for k in range(300)), "A B C $", "", None, "x y é" * 80, "Ab " * 200, "q" * 5000, "&"]
    rows = [(rng.choice([*range(40), None]), rng.choice(kinds), rng.choice(["en", "de", None, ""]), None) for _ in range(120)]
    rows += [(7, "$ twice", "en", None)] * 3 + [(8, "$ twice", "de", None), (None, "$ twice", "en", None), (2, "only", "fr", None)]
    marks = [(k, k % 2, k % 3 == 0) for k in range(30)]
    labels = spark.createDataFrame([(k, int(q), int(t), "x") for k, q, t in marks] + [(1, None, 1, "x"), (None, 1, 1, "x"), (4, 1, None, "x")], "doc_id long, quality int, toxic int, good string")
    known = {k: (int(q), int(t)) for k, q, t in marks} | {1: (1, 1), 4: (1, 0)}
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(docs_of(spark, rows), labels).collect()}
    assert got == plain_audit(rows, known)


def test_audit_of_no_documents_and_of_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs_of(spark, [(1, "a")]).limit(0), labels).count() == 0
    few = filter_audit.audit(docs_of(spark, [(1, "a", "en"), (2, "a", "en")]), labels, orders=["ABCDE"]).orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant, r.good_lost) for r in few] == [(0, 2, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 1, 0)]


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5])
def test_least_squares_give_shapley_values(m):
    rng = random.Random(m)
    value = [0, *[Fraction(rng.randrange(1000)) for _ in range((1 << m) - 1)]]
    mean = [Fraction(0)] * m
    orders = list(itertools.permutations(range(m)))
    for order in orders:
        seen = 0
        for x in order:
            mean[x] += Fraction(value[seen | 1 << x] - value[seen], len(orders))
            seen |= 1 << x
    assert [sum(w * v for w, v in zip(row, value, strict=True)) for row in filter_audit.shapley_weights(m)] == mean


def test_word_counts_of_a_text_longer_than_a_slice():
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(400_000)]
    assert filter_audit._word_counts((" \n".join(words) + " ").encode()) == (len(words), len(set(words)))
    assert filter_audit._word_counts(b"x" * 3_000_000) == (1, 1)


# ---- Hilbert shards


@pytest.mark.parametrize(("dims", "bits"), [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_steps_of_one(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hilbert_shards.curve_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def dimensions():
    return {"source": F.col("source"), "lang": F.col("lang"), "bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_hold_each_row_once_and_share_alike(spark, law):
    rng = random.Random(2)
    rows = [(k, "é" * rng.randrange(40), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s1", None])) for k in range(400)]
    rows += [(None, None, None, None), (None, "", "en", "s1"), (500, "x" * 70_000, "en", "s9"), (501, None, "en", "s1"), (2**62, "far", "de", "s2")]
    got = hilbert_shards.sharded_documents(docs_of(spark, rows), dimensions(), 7, law).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    per = collections.defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
        assert r.law == law and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in per.values()) and set(per) <= set(range(7))
    if law == "rows":
        assert len(per) == 7 and max(map(len, per.values())) - min(map(len, per.values())) <= 1
    again = hilbert_shards.sharded_documents(docs_of(spark, rows[::-1]).repartition(5), dimensions(), 7, law).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_bytes_are_shared_up_to_a_row(spark):
    rng = random.Random(3)
    rows = [(k, "x" * rng.randrange(300), "en", rng.choice(["s1", "s2"])) for k in range(600)]
    got = hilbert_shards.sharded_documents(docs_of(spark, rows), dimensions(), 6, "bytes").groupBy("shard").agg(F.sum("size").alias("n")).collect()
    mean = sum(r.n for r in got) / 6
    assert len(got) == 6 and all(abs(r.n - mean) <= 308 for r in got)


def test_few_equal_and_no_rows(spark):
    few = hilbert_shards.sharded_documents(docs_of(spark, [(1, "a"), (2, "b")]), dimensions()).collect()
    assert sorted(r.slot for r in few) == [0, 0] and len({r.shard for r in few}) == 2
    same = hilbert_shards.sharded_documents(docs_of(spark, [(1, "a", "en", "s")] * 9), dimensions()).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == list(range(9))
    assert hilbert_shards.sharded_documents(docs_of(spark, [(1, "a")]).limit(0), dimensions()).count() == 0


def test_files_are_skipped_by_every_dimension(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, "x" * rng.randrange(2000), f"l{rng.randrange(16)}", f"s{rng.randrange(40):02d}") for k in range(4000)]
    path = str(tmp_path / "shards")
    manifest = hilbert_shards.write_shards(docs_of(spark, rows), path, dimensions(), 64).persist()
    assert manifest.agg(F.sum("n")).first()[0] == len(rows)
    read = {}
    for name, low, high in (("source", "s03", "s05"), ("lang", "l7", "l7"), ("bytes", 100, 300)):
        part = hilbert_shards.read_shards(spark, path, manifest, **{name: (low, high)})
        value = {"source": lambda r: r.row.source, "lang": lambda r: r.row.lang, "bytes": lambda r: len(r.row.text)}[name]
        found = part.collect()
        read[name] = len(found)
        assert sorted(r.row.doc_id for r in found if low <= value(r) <= high) == sorted(
            i for i, t, la, s in rows if low <= {"source": s, "lang": la, "bytes": len(t)}[name] <= high
        )
    # A sort by one dimension alone would skip by that one and read all files for the others.
    assert all(n < 0.6 * len(rows) for n in read.values())
    assert len(hilbert_shards.read_shards(spark, path, manifest, source=("s03", "s05"), bytes=(100, 300)).collect()) < 0.25 * len(rows)


# ---- collocations


def plain_counts(rows, most=4):
    """Per language: words in all, and counts of all phrases with those that have a word before and after."""
    total, counts = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for _, text, lang, *_ in rows:
        lang, lower = lang if lang is not None else "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    c = counts[lang, tuple(w[i : i + k])]
                    c[0] += 1
                    c[1] += i > 0
                    c[2] += i + k < len(w)
    return total, counts


def plain_collocations(rows, least, best):
    total, counts = plain_counts(rows)
    candidates = {k: c for k, c in counts.items() if len(k[1]) > 1 and c[0] >= least}
    found = collections.defaultdict(list)
    for (lang, w), (a, before, after) in candidates.items():
        cuts = [(2_000_000 * a // (counts[lang, w[:k]][0] + counts[lang, w[k:]][0]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [c[0] for (la, x), c in candidates.items() if la == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))]
        if not any(100 * n >= 80 * a for n in longer):
            found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]][0], counts[lang, w[k:]][0], before, after))
    return {
        (lang, rank, p.decode(), -a, left, right, total[lang], -score, before, after)
        for lang, rows in found.items()
        for rank, (score, a, p, left, right, before, after) in enumerate(sorted(rows)[:best], 1)
    }


@pytest.mark.parametrize(("best", "shard_bytes", "bits"), [(2000, 300, 16), (5, 1 << 22, 4)])
def test_collocations_against_a_plain_version(spark, best, shard_bytes, bits):
    rng = random.Random(6)
    vocabulary = ["New", "York", "é", "the", "a", "of x", "b\x01", "日本", "x's"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", "  ", ". ", ",", "\n", "\r\n", "?"]) for _ in range(n))
    rows = [(k, text(rng.randrange(120)), rng.choice(["en", "en", None, "und", ""]), None) for k in range(60)]
    rows += [(k % 3, "red green blue Red", "en", None) for k in range(40)] + [(1, None, "en", None), (2, "", "fr", None), (3, " \t.", "fr", None), (None, "the the the the the " * 30, "en", None)]
    got = collocations.collocations(docs_of(spark, rows), least=9, best=best, shard_bytes=shard_bytes, bits=bits)
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, 9, best)


def test_counts_hold_all_words_of_each_language(spark):
    rows = [(1, "a b, a b", "en", None), (2, "c", None, None), (3, None, "fr", None)]
    got = {tuple(r) for r in collocations.phrase_counts(docs_of(spark, rows), least=2).collect()}
    assert got == {("en", 0, "", 4, 0, 0), ("und", 0, "", 1, 0, 0), ("fr", 0, "", 0, 0, 0), ("en", 1, "a", 2, 0, 2), ("en", 1, "b", 2, 2, 0), ("en", 2, "a b", 2, 0, 0)}


def test_collocations_of_no_documents(spark):
    assert collocations.collocations(docs_of(spark, [(1, "a")]).limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab .x\n", max_size=60), max_size=6), st.integers(1, 40))
def test_index_counts_all_phrases(texts, most):
    rows = [(k, t, "en") for k, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts), pa.string()), pa.array(texts, pa.string())], ["lang", "text"])
    found = collections.defaultdict(lambda: [0, 0, 0])
    for _, data in collocations.text_shards(iter([batch]), most):
        words = collocations.Words(data)
        if len(words.starts):
            index = collocations.Index(words, 4)
            spell = lambda i: words.data[slice(*index.bounds[i - 1])].tobytes().decode()
            for ids, *counts in index.phrases(4, lambda ids: np.ones(len(ids), bool)):
                for row, *c in zip(ids.tolist(), *counts, strict=True):
                    found["en", tuple(map(spell, row))] = [x + int(y) for x, y in zip(found["en", tuple(map(spell, row))], c, strict=True)]
    assert dict(found) == dict(plain_counts(rows)[1])


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    """Files of a finished write do not wait for the driver's garbage collection."""
    import time

    from varspark.llm.stages import Stages, shuffles_removed

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, given = blocks.getAllFiles().size(), spark.conf.get(setting)
    stages = Stages(spark, remove_shuffles=True)
    kept = [stages.stored(spark.range(1000).selectExpr("id", "id % 7 as k").repartition(20 + k, "k"), f"some-{k}") for k in range(3)]
    until = time.time() + 10
    while blocks.getAllFiles().size() > before and time.time() < until:
        time.sleep(0.1)
    assert blocks.getAllFiles().size() <= before and spark.conf.get(setting) == given
    stages.drop("some-1")
    assert len(stages.paths) == 2 and kept[0].count() == kept[2].count() == 1000
    stages.drop()
    assert stages.paths == []
    spark.conf.set(setting, "true")
    try:
        with shuffles_removed(spark), shuffles_removed(spark):
            pass
        assert spark.conf.get(setting) == "true"
    finally:
        spark.conf.unset(setting)
