"""Packed reference, normalised indels, allele counts over chunk edges, and stores that grow by generations."""

import random

import pytest

from varspark.operators import pileup, pon, reference, sites
from varspark.schemas import READS
from varspark.sources.store import VersionedStore

VARIANTS = "contig string, pos bigint, ref string, alt string"


def bases(spark, text, contig="c", first=1):
    return spark.createDataFrame([(contig, first + i, b) for i, b in enumerate(text) if b != " "], "contig string, pos bigint, base string")


def test_chunks_hold_the_reference_with_its_gaps(spark):
    got = reference.reference_chunks(bases(spark, "ACGT  GG  T"), 4).collect()
    assert {r.chunk: r.bases for r in got} == {0: " ACG", 1: "T  G", 2: "G  T"}


def plainly_normal(text, pos, ref, alt):
    """Trim and shift by the definition, a base at a time; ``text`` is the contig, blank where it is not held."""
    held = lambda p: 1 <= p <= len(text) and text[p - 1] != " "
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    long, short = (alt, ref) if len(alt) > len(ref) else (ref, alt)
    if len(short) != 1 or len(long) == 1 or (long[0] != short and long[-1] != short):
        return pos, ref, alt
    at, unit = (pos, long[1:]) if long[0] == short else (pos - 1, long[:-1])
    steps = 0
    while held(at) and held(at - 1) and text[at - 1] == unit[-1]:
        at, unit, steps = at - 1, unit[-1] + unit[:-1], steps + 1
    if not held(at):
        return pos, ref, alt
    base = text[at - 1]
    return (at, base, base + unit) if len(alt) > len(ref) else (at, base + unit, base)


def test_spellings_of_one_indel_become_one(spark):
    text = "GGTCACACACACATT"
    chunks = reference.reference_chunks(bases(spark, text), 5)
    spellings = [("c", 3, "TCA", "T"), ("c", 5, "ACA", "A"), ("c", 4, "CAC", "C"), ("c", 9, "ACACA", "ACA"), ("c", 12, "CAT", "T")]
    got = reference.normalise_indels(spark.createDataFrame(spellings, VARIANTS), chunks, 5).distinct().collect()
    assert [tuple(r) for r in got] == [("c", 3, "TCA", "T")]
    germline = spark.createDataFrame([("c", 3, "TCA", "T", 0.25), ("c", 1, "G", "A", 0.5)], VARIANTS + ", af double")
    variants = spark.createDataFrame([(*s, "x") for s in spellings] + [("c", 1, "G", "A", "y"), ("c", 2, "G", "C", "z")], VARIANTS + ", who string")
    whole = reference.reference_chunks(bases(spark, text))
    found = sites.annotate_germline(variants, germline, chunks=whole).collect()
    assert sorted((r.pos, r.ref, r.alt, r.who, r.af) for r in found) == sorted([(*s[1:], "x", 0.25) for s in spellings] + [(1, "G", "A", "y", 0.5), (2, "G", "C", "z", 1e-6)])
    plain = sites.annotate_germline(variants, germline).collect()
    assert sum(r.af == 0.25 for r in plain) == 1


@pytest.mark.parametrize("width", [3, 8, 8192])
def test_indels_move_as_far_as_base_by_base(spark, width):
    rng = random.Random(width)
    text = "A" * 9 + "".join(rng.choice("AC") for _ in range(40)) + "  " + "CACACACACACA" + "".join(rng.choice("AACG") for _ in range(30)) + " " + "T" * 12
    variants = set()
    for _ in range(150):
        pos = rng.randrange(1, len(text) - 6)
        ref = text[pos - 1 : pos - 1 + rng.randint(1, 5)]
        if " " not in ref:
            variants.add(("c", pos, ref, ref[0] if rng.random() < 0.4 and len(ref) > 1 else ref[: rng.randint(1, len(ref))] + "".join(rng.choice("AC") for _ in range(rng.randint(1, 4)))))
    variants |= {("c", 1, "AA", "A"), ("c", 1, "A", "AA"), ("c", 5, "AAA", "A"), ("zz", 5, "TT", "T"), ("c", 51, "C", "CA"), ("c", 2, "A", "G")}
    rows = sorted(v for v in variants if v[2] != v[3])
    given = spark.createDataFrame([(*v, *v[1:]) for v in rows], VARIANTS + ", p bigint, r string, a string")
    got = {(r.contig, r.p, r.r, r.a): (r.pos, r.ref, r.alt) for r in reference.normalise_indels(given, reference.reference_chunks(bases(spark, text), width), width).collect()}
    assert got == {v: plainly_normal(text if v[0] == "c" else "", *v[1:]) for v in rows}


def plain_counts(reads, text, least):
    """Alleles per position from reads walked base by base."""
    import re

    seen, spells = {}, {}
    for lab, flag, pos, cigar, seq, qual in reads:
        f1r2 = ((flag & 64) != 0) != ((flag & 16) != 0)
        at, off = pos, 0
        for n, op in re.findall(r"(\d+)([MIDS])", cigar):
            n = int(n)
            for i in range(n if op == "M" else 1 if op in "ID" else 0):
                p, what = (at + i, seq[off + i]) if op == "M" else (at - 1, "+" + seq[off : off + n] if op == "I" else f"-{n}")
                good = op != "M" or ord(qual[off + i]) - 33 >= least
                c = seen.setdefault((lab, p), {}).setdefault(what, [0, 0, 0])
                c[0], c[1], c[2] = c[0] + 1, c[1] + good, c[2] + (good and f1r2)
            at, off = at + (n if op in "MD" else 0), off + (n if op in "MIS" else 0)
    for (lab, p), what in seen.items():
        ref = text[p - 1 : p]
        if not ref.strip():
            continue
        passing = sum(c[0] for w, c in what.items() if w[0] not in "+-") - sum(c[0] for w, c in what.items() if w[0] in "+-")
        for w, (_, good, f) in what.items():
            if w != ref and good:
                gone = text[p - 1 : p + int(w[1:])] if w[0] == "-" else ref
                if " " not in gone and len(gone) == (int(w[1:]) + 1 if w[0] == "-" else 1):
                    alt = ref if w[0] == "-" else ref + w[1:] if w[0] == "+" else w
                    spells[lab, p, gone, alt] = (max(passing, 0) if w[0] in "+-" else what.get(ref, [0, 0])[1], good, f, good - f)
    return spells


@pytest.mark.parametrize(("width", "least"), [(7, 0), (7, 20), (64, 20), (8192, 0)])
def test_allele_counts_equal_a_walk_base_by_base(spark, width, least):
    rng = random.Random(width + least)
    text = "".join(rng.choice("ACGT") for _ in range(90)) + "   " + "".join(rng.choice("ACGT") for _ in range(40))
    reads = []
    for _ in range(150):
        cigar = rng.choice(["20M", "8M3D12M", "5S15M", "10M2I8M", "6M9D6M8S"])
        pos = rng.randrange(1, 120)
        clean = (text + "A" * 60)[pos - 1 : pos + 19].replace(" ", "A")
        seq = "".join(b if rng.random() < 0.9 else rng.choice("ACGTN") for b in clean)
        reads.append((rng.choice(["s", "t"]), rng.choice([65, 129, 81, 145]), pos, cigar, seq, "".join(rng.choice("#5I") for _ in range(20))))
    table = spark.createDataFrame([(lab, f"r{i}", flag, "c", pos, 60, cigar, seq, qual) for i, (lab, flag, pos, cigar, seq, qual) in enumerate(reads)], READS)
    got = {(r.lab_id, r.pos, r.ref, r.alt): (r.ref_count, r.alt_count, r.alt_f1r2, r.alt_f2r1) for r in pileup.allele_counts(table, bases(spark, text), least, width).collect()}
    assert got == plain_counts(reads, text, least)
    plan = pileup.allele_counts(table, bases(spark, text), least, width)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan


# ---- stores


def test_readers_see_whole_generations(spark, tmp_path, monkeypatch):
    store = VersionedStore(spark, str(tmp_path / "s"))
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "x long")
    assert store.version() == 0 and store.read("a", "x long").count() == 0
    store.commit({"a": one(1), "b": one(7)})
    store.commit({"a": one(2)})
    values = lambda name, v=None: sorted(r.x for r in store.read(name, "x long", v).collect())
    assert (values("a"), values("b"), values("a", 1)) == ([1, 2], [7], [1])
    store.commit({"a": one(1, 2)}, replacing=True)
    assert values("a") == [1, 2] and len(store.parts()["a"]) == 1 and values("b") == [7]
    # Two runs that saw the same generation: the second raises, and nothing of it is read.
    monkeypatch.setattr(VersionedStore, "version", lambda self: 2)
    with pytest.raises(FileExistsError):
        store.commit({"a": one(9)})
    monkeypatch.undo()
    assert store.version() == 3 and values("a") == [1, 2]


def test_a_failure_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    calls = lambda lab, *at: spark.createDataFrame([(lab, "c", p, "A", "C", 5, 5, 0.5) for p in at], "lab_id string, contig string, pos bigint, ref string, alt string, ref_count bigint, alt_count bigint, fraction double")
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "lab_id string")
    path = str(tmp_path / "panel")
    pon.write_panel_store(calls("a", 1, 2), names("a"), path)
    publish = VersionedStore._publish
    monkeypatch.setattr(VersionedStore, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pon.extend_pon(path, calls("b", 1), names("b"))
    monkeypatch.setattr(VersionedStore, "_publish", publish)
    panel = pon.extend_pon(path, calls("b", 1), names("b"))
    assert [(r.pos, r.n_seen, r.share_of_normals) for r in panel.collect()] == [(1, 2, 1.0)]
    for lab in "cdef":
        panel = pon.extend_pon(path, calls(lab, 1, 2), names(lab), most_parts=3)
    assert sorted((r.pos, r.n_seen) for r in panel.collect()) == [(1, 6), (2, 5)]
    assert len(VersionedStore(spark, path).parts()["sums"]) <= 3
