"""The registered queries once more, as plain SQL over the driver's tables.

Written apart from the operators: range joins are range predicates, ranks and
running sums are windows over whole groups, and the iterations are unrolled.
"""

from __future__ import annotations

import re

EPS = "0.001e0"


def pad(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 11, '0')"


def r6(x: str, name: str | None = None) -> str:
    """Rounded, without a negative zero."""
    return f"round({x}, 6) + 0e0 AS {name or x}"


def lik(ref: str, alt: str, f: str) -> str:
    return (
        f"({ref} * log10((1e0 - ({f})) * (1e0 - {EPS}) + ({f}) * ({EPS} / 3e0))"
        f" + {alt} * log10(({f}) * (1e0 - {EPS}) + (1e0 - ({f})) * ({EPS} / 3e0)))"
    )


def frac(ref: str, alt: str) -> str:
    return f"(CASE WHEN {ref} + {alt} > 0 THEN CAST({alt} AS DOUBLE) / ({ref} + {alt}) ELSE 0e0 END)"


def part_of(wanted: list[str], others: list[str]) -> str:
    everything = [*wanted, *others]
    top = f"greatest({', '.join(everything)})"
    mass = lambda terms: "(" + " + ".join(f"power(10e0, {x} - {top})" for x in terms) + ")"
    return f"{mass(wanted)} / {mass(everything)}"


def clamp(af: str) -> str:
    return f"least(greatest(coalesce({af}, 1e-6), 1e-6), 1e0 - 1e-6)"


def inherited(src: str, ref: str, alt: str, normal: tuple[str, str] | None, maf: str | None = None, diploid: str = "true") -> str:
    """SELECT of ``src`` with p_germline; log weights come first, so that the final expression stays short."""
    het = f"log10(2e0 * q * (1e0 - q)) + ({ref} + {alt}) * log10(0.5e0)"
    if maf:
        low, high = lik(ref, alt, maf), lik(ref, alt, f"1e0 - {maf}")
        het = f"""log10(2e0 * q * (1e0 - q)) + CASE WHEN {maf} IS NULL THEN ({ref} + {alt}) * log10(0.5e0) ELSE
          greatest({low}, {high}) + log10(0.5e0 * (power(10e0, {low} - greatest({low}, {high}))
          + power(10e0, {high} - greatest({low}, {high})))) END"""
    hom = f"2e0 * log10(q) + {lik(ref, alt, '1e0')}"
    som = f"log10(0.001e0) + 2e0 * log10(1e0 - q) + {lik(ref, alt, frac(ref, alt))}"
    if normal:
        het += " + " + lik(*normal, "0.5e0")
        hom += " + " + lik(*normal, "1e0")
        som += " + " + lik(*normal, "0e0")
    return f"""SELECT * EXCLUDE (q, w_het, w_hom, w_som), CASE WHEN {diploid} THEN {part_of(['w_het', 'w_hom'], ['w_som'])}
      ELSE {part_of(['w_hom'], ['w_som'])} END AS p_germline
    FROM (SELECT *, {het} AS w_het, {hom} AS w_hom, {som} AS w_som FROM (SELECT *, {clamp('af')} AS q FROM {src}))"""


def manifest(table: str, key: str, nation: str, balance: str, library: str) -> str:
    return f"""SELECT {key} AS s,
      CASE WHEN {balance} < -500 THEN '#' ELSE '' END || 'S' || {pad(key)} AS sample_id,
      'P' || {pad(f'{key} // 3')} || CASE
        WHEN ({key} // 3) % 11 = 5 THEN CASE {key} % 3 WHEN 0 THEN '-N' WHEN 1 THEN '-N3' ELSE '-B2' END
        WHEN {key} % 3 = 1 THEN '-T1'
        WHEN {key} % 3 = 0 AND {nation} = 7 THEN '-N10'
        WHEN {key} % 3 = 2 AND {nation} = 3 THEN '-B2'
        WHEN {key} % 3 = 0 THEN CASE WHEN ({key} // 3) % 2 = 0 THEN '-N' ELSE '-B1' END
        WHEN ({key} // 3) % 2 = 0 THEN '-M2' ELSE '-P2' END AS lab_id,
      'CENTRE' || CAST({nation} AS VARCHAR) AS seq_centre, CAST({library} AS INTEGER) AS library
    FROM {table}"""


def letter(n: str) -> str:
    return f"substr('ACGT', CAST(1 + ({n}) % 4 AS BIGINT), 1)"


STATE = {"balanced": "0.5e0", "art_f1r2": "0.95e0", "art_f2r1": "0.05e0"}
START = {"balanced": "0.8e0", "art_f1r2": "0.1e0", "art_f2r1": "0.1e0"}


def responsibilities(src: str, prior: dict[str, str], k: str, n: str) -> str:
    """``src`` with the share m_<state> of each state."""
    logs = {s: f"log10({prior[s]}) + {k} * log10({p}) + ({n} - {k}) * log10(1e0 - {p})" for s, p in STATE.items()}
    weights = ", ".join(f"{x} AS w_{s}" for s, x in logs.items())
    names = [f"w_{s}" for s in STATE]
    shares = ", ".join(f"{part_of([w], [x for x in names if x != w])} AS m_{s}" for s, w in zip(STATE, names))
    return f"SELECT *, {shares} FROM (SELECT *, {weights} FROM {src})"


def em_step(i: int) -> str:
    if i == 1:
        src, prior = "(SELECT * FROM em_cells)", START
    else:
        src = f"(SELECT c.*, p.balanced, p.art_f1r2, p.art_f2r1 FROM em_cells c JOIN em_{i - 1} p USING (pair, context, alt_base))"
        prior = {s: f"greatest({s}, 1e-12)" for s in STATE}
    sums = ", ".join(f"sum(n * m_{s}) / sum(n) AS {s}" for s in STATE)
    return f"SELECT pair, context, alt_base, {sums} FROM ({responsibilities(src, prior, 'f1r2', 'alt_count')}) GROUP BY ALL"


SITE = "contig, pos, ref, alt"

# Every entry may use the entries above it and the driver's tables.
CTES: dict[str, str] = {
    "fx_keyed": manifest("customer", "c_custkey", "c_nationkey", "c_acctbal", "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 2 ELSE 1 END"),
    "fx_second": manifest("supplier", "s_suppkey", "s_nationkey", "s_acctbal", "1"),
    "samples": """SELECT sample_id, lab_id, seq_centre, library, role,
      CASE WHEN role <> 'unknown' THEN regexp_replace(lab_id, '(-[NB].?|-[TMP].*)$', '') END AS patient,
      CASE WHEN role <> 'unknown' THEN regexp_extract(lab_id, '-([NB].?|[TMP].*)$', 1) END AS suffix
    FROM (SELECT *, CASE WHEN regexp_matches(lab_id, '-[NB].?$') THEN 'normal'
                         WHEN regexp_matches(lab_id, '-[TMP].*$') THEN 'tumour' ELSE 'unknown' END AS role
          FROM fx_keyed WHERE sample_id NOT LIKE '#%')""",
    "normals": "SELECT * FROM samples WHERE role = 'normal'",
    "tumours": "SELECT * FROM samples WHERE role = 'tumour'",
    "pairs": """SELECT t.lab_id || '_' || n.lab_id AS pair, t.patient, t.lab_id AS tumour_id, n.lab_id AS normal_id
    FROM tumours t JOIN normals n ON t.patient = n.patient""",
    "fx_loci": """SELECT p_partkey AS locus, 'chr' || CAST(1 + p_partkey % 4 AS VARCHAR) AS contig,
      100 + (p_partkey // 4) * 25 AS pos, (p_partkey * 5 + p_partkey // 16) % 4 AS r, p_size / 100e0 AS af FROM part""",
    "fx_alleles": f"""SELECT locus, contig, pos, {letter('r')} || CASE WHEN locus % 13 = 0 AND locus % 2 = 1 THEN 'A' ELSE '' END AS ref,
        CASE WHEN locus % 13 = 0 THEN {letter('r')} || CASE WHEN locus % 2 = 0 THEN 'A' ELSE '' END
             WHEN locus % 29 = 0 THEN {letter('r + 1')} ELSE {letter('r + 1 + locus % 3')} END AS alt,
        af, 0 AS allele, locus % 29 = 0 AND locus % 13 <> 0 AS several FROM fx_loci
      UNION ALL
      SELECT locus, contig, pos, {letter('r')}, {letter('r + 2')}, af / 2e0, 1, true FROM fx_loci WHERE locus % 29 = 0 AND locus % 13 <> 0""",
    "germline": f"SELECT {SITE}, af FROM fx_alleles WHERE af > 0.16e0",
    "common": f"SELECT {SITE}, af FROM fx_alleles WHERE NOT several AND length(ref) = 1 AND length(alt) = 1 AND af > 0.05e0",
    "fx_obs": """SELECT s, locus, CASE WHEN locus % 29 = 0 AND locus % 13 <> 0 THEN l_linenumber % 2 ELSE 0 END AS allele, d, f1, art,
        CASE WHEN art THEN d // 5 WHEN g < 8 THEN d - noise WHEN g < 24 THEN d // 2
             WHEN g < 30 AND s % 3 <> 0 THEN d // 4 ELSE noise END AS a
      FROM (SELECT *, locus % 97 = 5 AS art, (locus * 31 + (l_orderkey // 300) * 17) % 100 AS g
            FROM (SELECT l_orderkey, l_linenumber, l_orderkey // 100 AS s, low + ((l_orderkey // 300) * 40 + l_partkey % 400 - low + (high - low + 1)) % (high - low + 1) AS locus,
                    CAST(l_quantity AS BIGINT) AS d, l_suppkey % 2 AS f1,
                    CASE WHEN l_discount > 0.065e0 AND l_discount < 0.075e0 THEN 1 ELSE 0 END AS noise
              FROM lineitem, (SELECT min(p_partkey) AS low, max(p_partkey) AS high FROM part)))""",
    "counts": """SELECT m.lab_id, c.contig, c.pos, c.ref, c.alt,
        CAST(sum(o.d - o.a) AS BIGINT) AS ref_count, CAST(sum(o.a) AS BIGINT) AS alt_count,
        CAST(sum(CASE WHEN o.art OR o.f1 = 1 THEN o.a ELSE 0 END) AS BIGINT) AS alt_f1r2,
        CAST(sum(CASE WHEN o.art OR o.f1 = 1 THEN 0 ELSE o.a END) AS BIGINT) AS alt_f2r1
      FROM fx_obs o JOIN fx_keyed m ON o.s = m.s JOIN fx_alleles c ON o.locus = c.locus AND o.allele = c.allele
      WHERE m.sample_id NOT LIKE '#%' GROUP BY ALL""",
    "pileups": f"SELECT lab_id, contig, pos, ref_count, alt_count, CAST(0 AS BIGINT) AS other_alt_count, af FROM counts JOIN common USING ({SITE})",
    "intervals": """SELECT i AS interval_no, lpad(CAST(i AS VARCHAR), 4, '0') AS interval_id, 'chr' || CAST(1 + i // 25 AS VARCHAR) AS contig,
        100 + (i % 25) * w AS start_pos, 100 + (i % 25) * w + w - 1 AS end_pos
      FROM (SELECT CAST(ceil((max(pos) - 99) / 25e0) AS BIGINT) AS w FROM fx_loci), range(100) t(i)""",
    "excluded": "SELECT contig, pos - 11 AS bed_start, pos + 29 AS bed_end FROM fx_alleles WHERE allele = 0 AND af > 0.45e0",
    "dictionary": "SELECT contig, CAST(substr(contig, 4) AS BIGINT) - 1 AS idx, max(pos) + 1000 AS length FROM fx_loci GROUP BY contig",
    "contigs": f"SELECT 'ctg' || {pad('s_suppkey')} AS contig, s_suppkey AS idx, 1000 + (s_suppkey * 7919) % 5000 AS length FROM supplier",
    "ref_bases": f"SELECT contig, pos + o AS pos, {letter('r + o * (o + 1) // 2')} AS base FROM fx_loci, range(25) t(o)",
    "contexts": """SELECT c.contig, c.pos, b.base || m.base || a.base AS context FROM fx_loci c
      JOIN ref_bases b ON b.contig = c.contig AND b.pos = c.pos - 1
      JOIN ref_bases m ON m.contig = c.contig AND m.pos = c.pos
      JOIN ref_bases a ON a.contig = c.contig AND a.pos = c.pos + 1""",
    "mnps": """SELECT * FROM (SELECT 'chr' || CAST(1 + p_partkey % 4 AS VARCHAR) AS contig, p_partkey * 10 AS pos,
        substr('ACGTACGT', 1 + p_partkey % 4, 3) AS ref, translate(substr('ACGTACGT', 1 + p_partkey % 4, 1), 'ACGT', 'CGTA')
        || CASE WHEN p_partkey % 2 = 0 THEN substr('ACGTACGT', 2 + p_partkey % 4, 1) ELSE translate(substr('ACGTACGT', 2 + p_partkey % 4, 1), 'ACGT', 'GTAC') END
        || translate(substr('ACGTACGT', 3 + p_partkey % 4, 1), 'ACGT', 'TACG') AS alt FROM part)""",
    "reads": f"""SELECT 'P' || {pad('user_id // 10')} || '-N' AS lab_id, CAST(event_id AS VARCHAR) AS read_id,
        CAST(CASE event_id % 11 WHEN 0 THEN 1024 WHEN 1 THEN 256 WHEN 2 THEN 16 WHEN 3 THEN 16 ELSE 0 END
          + CASE WHEN event_id % 2 = 0 THEN 64 ELSE 128 END + 1 AS INTEGER) AS flag,
        'chr' || CAST(1 + user_id % 4 AS VARCHAR) AS contig, 1 + event_id * 5 // 4 AS pos, CAST(event_id % 61 AS INTEGER) AS mapq,
        CASE event_id % 5 WHEN 0 THEN '10M2I20M' WHEN 1 THEN '12M3D20M' WHEN 2 THEN '4S28M' WHEN 3 THEN '2H10=2X20=' ELSE '32M' END AS cigar,
        translate(md5(CAST(event_id AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
        translate(md5(CAST(event_id + 1 AS VARCHAR)), '0123456789abcdef', '#+5:?AFIIIIIIIII') AS qual FROM events""",
    "steps": r"""SELECT *, pos + coalesce(sum(CASE WHEN op IN ('M', '=', 'X', 'D', 'N') THEN n ELSE 0 END) OVER before, 0) AS ref_start,
        1 + coalesce(sum(CASE WHEN op IN ('M', '=', 'X', 'I', 'S') THEN n ELSE 0 END) OVER before, 0) AS read_start
      FROM (SELECT *, CAST(lens[i] AS BIGINT) AS n, ops[i] AS op
            FROM (SELECT *, unnest(range(1, len(ops) + 1)) AS i
                  FROM (SELECT *, regexp_extract_all(cigar, '(\d+)[MIDNSHP=X]', 1) AS lens,
                          regexp_extract_all(cigar, '\d+([MIDNSHP=X])', 1) AS ops FROM reads)))
      WINDOW before AS (PARTITION BY read_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "blocks": """SELECT lab_id, read_id, flag, mapq, contig, CAST(ref_start AS BIGINT) AS start_pos, CAST(ref_start + n - 1 AS BIGINT) AS end_pos,
        CAST(read_start AS BIGINT) AS read_offset, substr(seq, CAST(read_start AS BIGINT), n) AS bases, substr(qual, CAST(read_start AS BIGINT), n) AS quals
      FROM steps WHERE op IN ('M', '=', 'X')""",
    "good_blocks": "SELECT * FROM blocks WHERE flag & 3844 = 0 AND mapq >= 20",
    "bases": """SELECT lab_id, contig, start_pos + i AS pos, substr(bases, i + 1, 1) AS base, ascii(substr(quals, i + 1, 1)) - 33 AS baseq,
        (flag & 64 > 0 AND flag & 16 = 0) OR (flag & 128 > 0 AND flag & 16 > 0) AS f1r2
      FROM (SELECT *, unnest(range(0, length(bases))) AS i FROM good_blocks)""",
    "all_pileups": f"""SELECT b.lab_id, {', '.join('c.' + c for c in SITE.split(', '))},
        count(*) FILTER (b.base = c.ref) AS ref_count, count(*) FILTER (b.base = c.alt) AS alt_count,
        count(*) FILTER (b.base <> c.ref AND b.base <> c.alt) AS other_alt_count, c.af
      FROM bases b JOIN common c ON b.contig = c.contig AND b.pos = c.pos GROUP BY ALL""",
    "good_pileups": f"""SELECT b.lab_id, {', '.join('c.' + c for c in SITE.split(', '))},
        count(*) FILTER (b.base = c.ref) AS ref_count, count(*) FILTER (b.base = c.alt) AS alt_count,
        count(*) FILTER (b.base <> c.ref AND b.base <> c.alt) AS other_alt_count, c.af
      FROM bases b JOIN common c ON b.contig = c.contig AND b.pos = c.pos WHERE b.baseq >= 10 GROUP BY ALL""",
    "snv_counts": """SELECT b.lab_id, b.contig, b.pos, r.base AS ref, b.base AS alt,
        (SELECT 0) AS unused, count(*) AS alt_count, count(*) FILTER (b.f1r2) AS alt_f1r2, count(*) FILTER (NOT b.f1r2) AS alt_f2r1
      FROM bases b JOIN ref_bases r ON b.contig = r.contig AND b.pos = r.pos WHERE b.baseq >= 10 AND b.base <> r.base GROUP BY ALL""",
    "ref_depth": """SELECT b.lab_id, b.contig, b.pos, count(*) AS ref_count FROM bases b
      JOIN ref_bases r ON b.contig = r.contig AND b.pos = r.pos AND b.base = r.base WHERE b.baseq >= 10 GROUP BY ALL""",
    "depths": "SELECT lab_id, contig, pos, count(*) AS depth FROM bases GROUP BY ALL",
    "indel_events": """SELECT lab_id, contig, CAST(ref_start - 1 AS BIGINT) AS pos, CASE WHEN op = 'D' THEN n ELSE 0 END AS removed,
        CASE WHEN op = 'I' THEN substr(seq, CAST(read_start AS BIGINT), n) ELSE '' END AS added,
        count(*) AS alt_count, count(*) FILTER ((flag & 64 > 0 AND flag & 16 = 0) OR (flag & 128 > 0 AND flag & 16 > 0)) AS alt_f1r2
      FROM steps WHERE op IN ('I', 'D') AND flag & 3844 = 0 AND mapq >= 20 GROUP BY ALL""",
    "indel_refs": """SELECT contig, pos, removed, string_agg(base, '' ORDER BY spot) AS ref FROM (
        SELECT e.contig, e.pos, e.removed, r.pos AS spot, r.base FROM (SELECT DISTINCT contig, pos, removed FROM indel_events) e
        JOIN ref_bases r ON r.contig = e.contig AND r.pos BETWEEN e.pos AND e.pos + e.removed)
      GROUP BY ALL HAVING count(*) = removed + 1""",
    "interval_of": f"""SELECT c.*, i.interval_id FROM counts c JOIN intervals i
      ON c.contig = i.contig AND c.pos >= i.start_pos AND c.pos <= i.end_pos""",
    "callable_of": """SELECT lab_id, interval_id, count(*) AS callable FROM (
        SELECT lab_id, interval_id, contig, pos FROM interval_of GROUP BY ALL HAVING max(ref_count + alt_count) >= 10) GROUP BY ALL""",
    "costed": """SELECT i.interval_no, i.interval_id, CAST(coalesce(sum(c.ref_count + c.alt_count), 0) AS BIGINT) AS cost
      FROM intervals i LEFT JOIN interval_of c USING (interval_id) GROUP BY ALL""",
    "chunked": """SELECT *, CAST(floor((reach - cost) * 8 / CAST(total AS DOUBLE)) AS BIGINT) AS chunk_id FROM (
        SELECT *, sum(cost) OVER (ORDER BY interval_no) AS reach, sum(cost) OVER () AS total FROM costed)""",
    # panel of normals
    "normal_calls": f"""SELECT * FROM (SELECT c.*, {frac('ref_count', 'alt_count')} AS fraction,
          {lik('ref_count', 'alt_count', frac('ref_count', 'alt_count'))} - {lik('ref_count', 'alt_count', '0e0')} AS lod
        FROM counts c WHERE alt_count >= 2 AND ref_count + alt_count >= 10 AND lab_id IN (SELECT lab_id FROM normals))
      WHERE lod >= 3.0e0""",
    "normal_known": f"SELECT c.*, coalesce(g.af, 1e-6) AS af FROM normal_calls c LEFT JOIN germline g USING ({SITE})",
    "normal_scored": inherited("normal_known", "ref_count", "alt_count", None),
    "panel": f"""SELECT {SITE}, count(DISTINCT lab_id) AS n_seen,
        count(DISTINCT lab_id) / (SELECT CAST(count(DISTINCT lab_id) AS DOUBLE) FROM normals) AS share_of_normals,
        avg(fraction) AS mean_fraction, var_pop(fraction) AS var_fraction
      FROM normal_scored WHERE p_germline <= 0.5e0 GROUP BY ALL HAVING count(DISTINCT lab_id) >= 2""",
    "shaped": """SELECT *, CASE WHEN var_fraction > 1e-15 THEN mean_fraction * (1e0 - mean_fraction) / var_fraction - 1e0 END AS size FROM panel""",
    # calls
    "lods": f"""SELECT *, {lik('ref_count', 'alt_count', frac('ref_count', 'alt_count'))} - {lik('ref_count', 'alt_count', '0e0')} AS tlod
      FROM counts WHERE alt_count >= 3 AND ref_count + alt_count >= 10""",
    "all_cands": f"""SELECT p.pair, p.tumour_id, p.normal_id, {SITE}, ref_count AS t_ref, alt_count AS t_alt, alt_f1r2 AS t_f1r2,
        alt_f2r1 AS t_f2r1, tlod FROM lods JOIN pairs p ON lods.lab_id = p.tumour_id WHERE tlod >= 3.0e0""",
    "cands": "SELECT * FROM all_cands WHERE tlod >= 6.3e0",
    "all_matched": f"""SELECT *, {lik('n_ref', 'n_alt', '0e0')} - {lik('n_ref', 'n_alt', '0.5e0')} AS nlod FROM (
        SELECT a.*, coalesce(n.ref_count, 0) AS n_ref, coalesce(n.alt_count, 0) AS n_alt FROM all_cands a
        LEFT JOIN counts n ON n.lab_id = a.normal_id AND n.contig = a.contig AND n.pos = a.pos AND n.ref = a.ref AND n.alt = a.alt)""",
    "all_known": f"""SELECT m.*, coalesce(g.af, 1e-6) AS af, p.n_seen IS NOT NULL AS in_pon FROM all_matched m
      LEFT JOIN germline g USING ({SITE}) LEFT JOIN panel p USING ({SITE})""",
    "diploid_calls": inherited("all_known", "t_ref", "t_alt", ("n_ref", "n_alt")),
    "haploid_calls": inherited("all_known", "t_ref", "t_alt", ("n_ref", "n_alt"), diploid="false"),
    "calls": """SELECT * FROM diploid_calls WHERE contig <> 'chr4' AND tlod >= 6.3e0
      UNION ALL SELECT * FROM haploid_calls WHERE contig = 'chr4'""",
    "stats": """SELECT p.pair, 'callable' AS statistic, CAST(sum(c.callable) AS DOUBLE) AS value
      FROM callable_of c JOIN pairs p ON c.lab_id = p.tumour_id GROUP BY ALL""",
    # orientation
    "folded": """SELECT c.lab_id, c.contig, c.pos, c.ref, c.alt, c.ref_count + c.alt_count AS depth, c.alt_count, c.alt_f1r2, c.alt_f2r1,
        CASE WHEN c.ref IN ('A', 'C') THEN x.context ELSE reverse(translate(x.context, 'ACGT', 'TGCA')) END AS context,
        CASE WHEN c.ref IN ('A', 'C') THEN c.alt ELSE translate(c.alt, 'ACGT', 'TGCA') END AS alt_base,
        CASE WHEN c.ref IN ('A', 'C') THEN c.alt_f1r2 ELSE c.alt_f2r1 END AS f1r2
      FROM counts c JOIN contexts x ON c.contig = x.contig AND c.pos = x.pos WHERE length(c.ref) = 1 AND length(c.alt) = 1""",
    "hist": """SELECT p.pair, f.context, f.alt_base, f.depth, f.alt_count, f.f1r2, count(*) AS n
      FROM folded f JOIN pairs p ON f.lab_id = p.tumour_id GROUP BY ALL""",
    "em_cells": "SELECT pair, context, alt_base, alt_count, f1r2, sum(n) AS n FROM hist WHERE alt_count > 0 GROUP BY ALL",
    "em_1": em_step(1),
    "em_2": em_step(2),
    "em_3": em_step(3),
    "em_4": em_step(4),
    "em_5": em_step(5),
    "oriented": "SELECT *, m_art_f1r2 + m_art_f2r1 AS p_orientation FROM ("
    + responsibilities(
        """(SELECT p.pair, f.contig, f.pos, f.ref, f.alt, f.f1r2, f.alt_count, e.balanced, e.art_f1r2, e.art_f2r1
          FROM folded f JOIN pairs p ON f.lab_id = p.tumour_id JOIN em_5 e ON e.pair = p.pair AND e.context = f.context AND e.alt_base = f.alt_base)""",
        {s: f"greatest({s}, 1e-12)" for s in STATE},
        "f1r2",
        "alt_count",
    )
    + ")",
    # contamination
    "hom_sites": "SELECT * FROM pileups WHERE ref_count + alt_count >= 10 AND alt_count >= 0.9e0 * (ref_count + alt_count)",
    "het_loci": """SELECT * FROM pileups WHERE ref_count + alt_count >= 10
      AND alt_count / CAST(ref_count + alt_count AS DOUBLE) >= 0.4e0 AND alt_count / CAST(ref_count + alt_count AS DOUBLE) <= 0.6e0""",
    "foreign_sums": f"""SELECT p.pair, count(*) AS n_sites, sum(t.ref_count) AS refs, sum((t.ref_count + t.alt_count) * (1e0 - {clamp('t.af')})) AS expected
      FROM pairs p JOIN hom_sites h ON h.lab_id = p.normal_id
      JOIN pileups t ON t.lab_id = p.tumour_id AND t.contig = h.contig AND t.pos = h.pos GROUP BY ALL""",
    "contamination": """SELECT pair, coalesce(n_sites, 0) AS n_sites, c AS contamination, sqrt(c / expected) AS error FROM (
        SELECT p.pair, f.n_sites, f.expected, CASE WHEN f.expected > 0 THEN least(f.refs / f.expected, 1e0) END AS c
        FROM pairs p LEFT JOIN foreign_sums f ON f.pair = p.pair)""",
    "het_runs": """SELECT pair, tumour_id, contig, run, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n_sites, avg(maf) AS mean_maf FROM (
        SELECT *, (row_number() OVER (PARTITION BY pair, contig ORDER BY pos) - 1) // 5 AS run FROM (
          SELECT p.pair, p.tumour_id, t.contig, t.pos, least(t.ref_count, t.alt_count) / CAST(t.ref_count + t.alt_count AS DOUBLE) AS maf
          FROM pairs p JOIN het_loci h ON h.lab_id = p.normal_id
          JOIN pileups t ON t.lab_id = p.tumour_id AND t.contig = h.contig AND t.pos = h.pos WHERE t.ref_count + t.alt_count > 0))
      GROUP BY ALL""",
    "segments": """SELECT pair, tumour_id, contig, CAST(segment AS BIGINT) AS segment, min(start_pos) AS start_pos, max(end_pos) AS end_pos,
        CAST(sum(n_sites) AS BIGINT) AS n_sites, sum(mean_maf * n_sites) / sum(n_sites) AS maf FROM (
        SELECT *, sum(opens) OVER (PARTITION BY pair, contig ORDER BY run) AS segment FROM (
          SELECT *, CASE WHEN abs(mean_maf - lag(mean_maf) OVER (PARTITION BY pair, contig ORDER BY run)) > 0.1e0 THEN 1 ELSE 0 END AS opens
          FROM het_runs)) GROUP BY ALL""",
    # filtering
    "call_totals": "SELECT pair, count(*) AS n_calls FROM calls GROUP BY pair",
    "evidence": f"""SELECT c.* EXCLUDE (p_germline), k.n_calls, s.value AS callable, x.contamination, g.maf, coalesce(o.p_orientation, 0e0) AS p_orientation
      FROM calls c JOIN call_totals k ON k.pair = c.pair LEFT JOIN stats s ON s.pair = c.pair LEFT JOIN contamination x ON x.pair = c.pair
      LEFT JOIN segments g ON g.pair = c.pair AND g.contig = c.contig AND c.pos >= g.start_pos AND c.pos <= g.end_pos
      LEFT JOIN oriented o ON o.pair = c.pair AND o.contig = c.contig AND o.pos = c.pos AND o.ref = c.ref AND o.alt = c.alt""",
    "foreign_scored": f"""SELECT *, CASE WHEN contamination > 0 THEN {part_of(['w_foreign'], ['w_own'])} ELSE 0e0 END AS p_contamination
      FROM (SELECT *, log10({clamp('af')}) + {lik('t_ref', 't_alt', 'contamination * ' + clamp('af'))} AS w_foreign,
              log10(0.001e0) + {lik('t_ref', 't_alt', frac('t_ref', 't_alt'))} AS w_own FROM evidence)""",
    "inherited_again": inherited("foreign_scored", "t_ref", "t_alt", ("n_ref", "n_alt"), maf="maf", diploid="contig <> 'chr4'"),
    "scored": """SELECT *, 1e0 - (1e0 - p_germline) * (1e0 - p_contamination) * (1e0 - p_orientation) * (1e0 - p_weak) AS p_error FROM (
        SELECT *, 1e0 / (1e0 + power(10e0, log10(prior) - log10(1e0 - prior) + tlod)) AS p_weak FROM (
          SELECT *, least(greatest(n_calls / greatest(coalesce(callable, CAST(n_calls AS DOUBLE)), CAST(n_calls AS DOUBLE)), 1e-8), 0.5e0) AS prior
          FROM inherited_again))""",
    "scores": """SELECT pair, p, round(CASE WHEN tp + (fp + fn) / 2e0 > 0 THEN tp / (tp + (fp + fn) / 2e0) ELSE 0e0 END, 9) AS f FROM (
        SELECT pair, p, sum(1e0 - p_error) OVER upto AS tp, sum(p_error) OVER upto AS fp,
          sum(1e0 - p_error) OVER (PARTITION BY pair) - sum(1e0 - p_error) OVER upto AS fn
        FROM (SELECT pair, p_error, round(p_error, 12) AS p FROM scored)
        WINDOW upto AS (PARTITION BY pair ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "thresholds": """SELECT pair, p AS threshold, f AS f_score FROM (
        SELECT *, row_number() OVER (PARTITION BY pair ORDER BY f DESC, p) AS place FROM scores) WHERE place = 1""",
    "near": """SELECT c.pair, c.contig, c.pos, c.n_alleles, count(*) AS n_near FROM (
        SELECT pair, contig, pos, count(*) AS n_alleles FROM scored GROUP BY ALL) c
      JOIN (SELECT DISTINCT pair, contig, pos FROM scored) o ON o.pair = c.pair AND o.contig = c.contig AND o.pos BETWEEN c.pos - 100 AND c.pos + 100
      GROUP BY ALL""",
    "judged": """SELECT s.*, n.n_near, n.n_alleles, round(p_germline, 12) > threshold AS bad_g, round(p_contamination, 12) > threshold AS bad_c,
        round(p_orientation, 12) > threshold AS bad_o, round(p_error, 12) > threshold AS bad_e
      FROM scored s JOIN thresholds t ON t.pair = s.pair JOIN near n ON n.pair = s.pair AND n.contig = s.contig AND n.pos = s.pos""",
    "filtered": """SELECT *, concat_ws(',', CASE WHEN in_pon THEN 'panel_of_normals' END, CASE WHEN bad_g THEN 'germline' END,
        CASE WHEN bad_c THEN 'contamination' END, CASE WHEN bad_o THEN 'orientation' END,
        CASE WHEN tlod < CASE WHEN contig = 'chr4' THEN 3.0e0 ELSE 6.3e0 END OR (nlod < 2.2e0 AND n_alt = 0) OR (bad_e AND NOT (bad_g OR bad_c OR bad_o)) THEN 'weak_evidence' END,
        CASE WHEN nlod < 2.2e0 AND n_alt > 0 THEN 'normal_artifact' END, CASE WHEN n_alleles > 1 THEN 'multiallelic' END,
        CASE WHEN n_near > 2 THEN 'clustered_events' END) AS filters FROM judged""",
    # run checks
    "log_lines": f"""SELECT {pad('event_id // 4')} AS task_id, event_id AS line_no, CASE event_type WHEN 'error' THEN 'A USER ERROR has occurred'
        WHEN 'purchase' THEN 'Tool done. Elapsed time: ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.25 minutes.'
        WHEN 'view' THEN 'Tool returned:' WHEN 'click' THEN 'SUCCESS'
        ELSE 'Runtime.totalMemory()=' || CAST(CAST(floor(value * 10000000) AS BIGINT) AS VARCHAR) END AS line FROM events""",
    "tasks": f"""SELECT {pad('o_orderkey // 5')} AS task_id, 'group' || CAST(o_orderkey // 250 AS VARCHAR) AS batch, max(o_orderkey) AS last_order
      FROM orders GROUP BY ALL""",
    "outputs": f"""SELECT {pad('o_orderkey // 5')} AS task_id,
        CASE o_orderkey % 5 WHEN 0 THEN 'vcf' WHEN 1 THEN 'tbi' WHEN 2 THEN 'stats' WHEN 3 THEN 'f1r2' ELSE 'log' END AS kind,
        CASE WHEN o_totalprice > 480000 THEN 0 ELSE o_custkey + 1 END AS length FROM orders WHERE o_totalprice >= 20000""",
    "outcomes": """SELECT *, CASE WHEN has_error THEN 'error' WHEN has_success THEN 'success' ELSE 'incomplete' END AS outcome FROM (
        SELECT task_id, bool_or(line ILIKE '%success%') AS has_success, bool_or(line ILIKE '%error%') AS has_error FROM log_lines GROUP BY task_id)""",
    "missing": """SELECT t.task_id, k.kind, CASE WHEN o.length IS NULL THEN 'missing' ELSE 'empty' END AS reason
      FROM tasks t CROSS JOIN (SELECT unnest(['vcf', 'tbi', 'stats', 'f1r2', 'log']) AS kind) k
      LEFT JOIN outputs o ON o.task_id = t.task_id AND o.kind = k.kind WHERE coalesce(o.length, 0) = 0""",
    "usage": f"""SELECT 'job' || {pad('o_orderkey')} AS job, o_orderpriority AS stage, 48 * (1 + o_custkey % 10) AS cpus,
        o_totalprice / 100e0 AS cpu_minutes, CAST(30 + o_orderkey % 60 AS DOUBLE) AS wall_minutes FROM orders""",
    "runs": "SELECT stage, cpus, count(*) AS n_jobs, avg(wall_minutes) AS wall, avg(cpu_minutes) AS cpu FROM usage GROUP BY ALL",
}

CALL = f"pair, {SITE}"
COUNTS = "lab_id, contig, pos, ref, alt, ref_count, alt_count, alt_f1r2, alt_f2r1"
PANEL = f"""SELECT {SITE}, n_seen, {r6('share_of_normals')}, {r6('mean_fraction')}, {r6('var_fraction')},
  {r6('log10(mean_fraction * size)', 'log_beta_alpha')}, {r6('log10((1e0 - mean_fraction) * size)', 'log_beta_beta')} FROM shaped"""


def _call_rows(src: str) -> str:
    return f"""SELECT {CALL}, t_ref, t_alt, t_f1r2, t_f2r1, {r6('tlod')}, n_ref, n_alt, {r6('nlod')}, {r6('af')}, in_pon,
      {r6('p_germline')} FROM {src}"""


FINALS: dict[str, str] = {
    "q_read_manifest": "SELECT sample_id, lab_id, seq_centre, library FROM fx_keyed WHERE sample_id NOT LIKE '#%'",
    "q_read_intervals": "SELECT lab_id AS interval_id, contig, min(pos) AS start_pos, max(pos) AS end_pos FROM counts GROUP BY ALL",
    "q_read_bed": "SELECT * FROM excluded",
    "q_read_contigs": "SELECT * FROM contigs",
    "q_read_variants": f"""SELECT {SITE}, upper(g.role) AS lab_id, coalesce(CAST(sum(c.ref_count) FILTER (s.role = g.role) AS BIGINT), 0) AS ref_count,
      coalesce(CAST(sum(c.alt_count) FILTER (s.role = g.role) AS BIGINT), 0) AS alt_count, length(alt) AS alt_length, true AS in_db
      FROM counts c JOIN samples s ON c.lab_id = s.lab_id, (SELECT unnest(['normal', 'tumour']) AS role) g GROUP BY ALL""",
    "q_read_variants_by_file": f"""SELECT {SITE}, contig || '_' || CAST(pos // 10000000 AS VARCHAR) AS lab_id, CAST(sum(ref_count) AS BIGINT) AS ref_count,
      CAST(sum(alt_count) AS BIGINT) AS alt_count FROM counts GROUP BY ALL""",
    "q_read_job_logs": """SELECT event_type AS job_id, 'event ' || CAST(min(event_id) FILTER (value > 150) AS VARCHAR) AS stderr, count(*) AS n_lines
      FROM events GROUP BY event_type""",
    "q_read_reads": "SELECT * FROM reads",
    "q_read_pileups": "SELECT * FROM pileups",
    "q_read_logs": """SELECT event_type AS task_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line_no,
      'event ' || CAST(event_id AS VARCHAR) AS line FROM events""",
    "q_read_reference": "SELECT contig, pos - min(pos) OVER (PARTITION BY contig) + 1 AS pos, base FROM ref_bases",
    "q_list_outputs": "SELECT kind, CAST(sum(length(task_id) + length(CAST(length AS VARCHAR)) + 2) AS BIGINT) AS bytes FROM outputs GROUP BY kind",
    "q_write_table": f"SELECT {COUNTS}, interval_id FROM interval_of",
    "q_write_variants": f"SELECT {SITE}, n_seen FROM panel",
    "q_classify_samples": "SELECT sample_id, lab_id, seq_centre, library, role FROM samples",
    "q_derive_patient": "SELECT lab_id, role, patient, suffix FROM samples",
    "q_normal_samples": "SELECT sample_id, lab_id, patient FROM normals",
    "q_pair_tumour_normal": "SELECT * FROM pairs",
    "q_unpaired_normals": "SELECT lab_id, patient FROM normals WHERE patient NOT IN (SELECT patient FROM tumours)",
    "q_unpaired_tumours": "SELECT lab_id, patient FROM tumours WHERE patient NOT IN (SELECT patient FROM normals)",
    "q_pair_counts": """SELECT patient, CAST(sum(normals) AS BIGINT) AS normals, CAST(sum(tumours) AS BIGINT) AS tumours, CAST(sum(pairs) AS BIGINT) AS pairs,
      CAST(sum(several) AS BIGINT) AS patients_split FROM (
        SELECT s.patient, count(*) FILTER (role = 'normal') AS normals, count(*) FILTER (role = 'tumour') AS tumours,
          (SELECT count(*) FROM pairs p WHERE p.patient = s.patient) AS pairs, CASE WHEN count(*) FILTER (role = 'normal') > 1 THEN 1 ELSE 0 END AS several
        FROM samples s WHERE s.patient IS NOT NULL GROUP BY s.patient) GROUP BY ROLLUP (patient)""",
    "q_concat_manifests": """SELECT sample_id, lab_id, seq_centre, library FROM fx_keyed WHERE sample_id NOT LIKE '#%'
      UNION ALL SELECT sample_id, lab_id, seq_centre, library FROM fx_second WHERE sample_id NOT LIKE '#%'""",
    "q_duplicate_samples": """SELECT lab_id, count(*) AS n_rows FROM (SELECT sample_id, lab_id FROM fx_keyed UNION ALL SELECT sample_id, lab_id FROM fx_second)
      WHERE sample_id NOT LIKE '#%' GROUP BY lab_id HAVING count(*) > 1""",
    "q_reuse_previous": "SELECT lab_id, lab_id IN (SELECT lab_id FROM counts) AS gathered FROM normals",
    "q_sample_map": "SELECT lab_id, 'store/normals/' || lab_id || '.parquet' AS location FROM normals",
    "q_expected_grid": """SELECT pair, min(interval_no) AS first_no, max(interval_no) AS last_no, count(*) AS n_missing FROM (
        SELECT pair, interval_no, interval_no - row_number() OVER (PARTITION BY pair ORDER BY interval_no) AS run
        FROM pairs p, intervals i WHERE NOT EXISTS (SELECT 1 FROM interval_of c WHERE c.lab_id = p.tumour_id AND c.interval_id = i.interval_id))
      GROUP BY pair, run""",
    "q_restrict_to_intervals": f"""SELECT {COUNTS} FROM counts c WHERE EXISTS (SELECT 1 FROM excluded b
      WHERE b.contig = c.contig AND c.pos - 1 >= b.bed_start AND c.pos - 1 < b.bed_end)""",
    "q_assign_interval": f"SELECT lab_id, {SITE}, interval_id FROM interval_of",
    "q_exclude_regions": f"""SELECT {COUNTS} FROM counts c WHERE NOT EXISTS (SELECT 1 FROM excluded b
      WHERE b.contig = c.contig AND c.pos - 1 >= b.bed_start AND c.pos - 1 < b.bed_end)""",
    "q_exclude_contig": f"SELECT {COUNTS} FROM counts WHERE contig <> 'chr4'",
    "q_only_contig": f"SELECT {COUNTS} FROM counts WHERE contig = 'chr4'",
    "q_split_intervals": """SELECT dense_rank() OVER (ORDER BY share) - 1 AS group_id, contig, idx, length FROM (
      SELECT *, CAST(floor((sum(length) OVER (ORDER BY idx) - length) * 24 / CAST(sum(length) OVER () AS DOUBLE)) AS BIGINT) AS share FROM contigs)""",
    "q_pack_chunks": """SELECT chunk_id, string_agg(interval_id, ';' ORDER BY interval_no) AS intervals, count(*) AS n_intervals,
      CAST(sum(cost) AS BIGINT) AS cost FROM chunked GROUP BY chunk_id""",
    "q_chunk_members": "SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY interval_no) - 1 AS place, interval_id, cost FROM chunked",
    "q_explode_chunks": "SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY interval_no) - 1 AS place, interval_id FROM chunked",
    "q_split_resource": f"""SELECT {', '.join('g.' + c for c in SITE.split(', '))}, g.af, i.interval_id FROM fx_alleles g
      JOIN intervals i ON g.contig = i.contig AND g.pos BETWEEN i.start_pos AND i.end_pos""",
    "q_check_gather_order": """SELECT * EXCLUDE (far), far.i AS previous_id, far.e AS previous_end FROM (SELECT *, max({'e': end_pos, 'i': interval_id}) OVER ahead AS far FROM (
        SELECT lab_id, interval_id, contig, min(pos) AS start_pos, max(pos) + max(ref_count) AS end_pos FROM interval_of GROUP BY ALL)
      WINDOW ahead AS (PARTITION BY lab_id, contig ORDER BY start_pos, interval_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      WHERE start_pos <= far.e""",
    "q_usable_reads": "SELECT * FROM reads WHERE flag & 3844 = 0 AND mapq >= 20",
    "q_cigar_blocks": "SELECT read_id, start_pos, end_pos, read_offset, bases FROM blocks",
    "q_pileup_summaries": "SELECT * FROM good_pileups",
    "q_gather_pileups": "SELECT * FROM all_pileups",
    "q_allele_counts": """SELECT s.lab_id, s.contig, s.pos, s.ref, s.alt, coalesce(d.ref_count, 0) AS ref_count, s.alt_count, s.alt_f1r2, s.alt_f2r1
      FROM snv_counts s LEFT JOIN ref_depth d ON d.lab_id = s.lab_id AND d.contig = s.contig AND d.pos = s.pos
      UNION ALL
      SELECT e.lab_id, e.contig, e.pos, r.ref, substr(r.ref, 1, 1) || e.added, CAST(greatest(coalesce(d.depth, 0)
          - sum(e.alt_count) OVER (PARTITION BY e.lab_id, e.contig, e.pos), 0) AS BIGINT), e.alt_count, e.alt_f1r2, e.alt_count - e.alt_f1r2
      FROM indel_events e JOIN indel_refs r ON r.contig = e.contig AND r.pos = e.pos AND r.removed = e.removed
      LEFT JOIN depths d ON d.lab_id = e.lab_id AND d.contig = e.contig AND d.pos = e.pos""",
    "q_callable_sites": "SELECT * FROM callable_of",
    "q_reference_depths": """SELECT b.lab_id, b.contig, b.pos, count(*) FILTER (b.base = c.base AND b.baseq >= 10) AS ref_count
      FROM bases b JOIN (SELECT DISTINCT contig, pos, substr(ref, 1, 1) AS base FROM fx_alleles) c ON b.contig = c.contig AND b.pos = c.pos GROUP BY ALL""",
    "q_normalise_indels": """SELECT * FROM (WITH RECURSIVE alleles AS (
        SELECT DISTINCT e.contig, e.pos, r.ref, substr(r.ref, 1, 1) || e.added AS alt
        FROM indel_events e JOIN indel_refs r ON r.contig = e.contig AND r.pos = e.pos AND r.removed = e.removed
      ), moves AS (
        SELECT *, pos AS at, CASE WHEN length(alt) > length(ref) THEN substr(alt, 2) ELSE substr(ref, 2) END AS unit, 0 AS step FROM alleles
        UNION ALL
        SELECT m.contig, m.pos, m.ref, m.alt, m.at - 1, right(unit, 1) || left(unit, length(unit) - 1), step + 1
        FROM moves m JOIN ref_bases b ON b.contig = m.contig AND b.pos = m.at AND b.base = right(unit, 1) JOIN ref_bases p ON p.contig = m.contig AND p.pos = m.at - 1
      ), ends AS (SELECT * FROM moves QUALIFY row_number() OVER (PARTITION BY contig, pos, ref, alt ORDER BY step DESC) = 1)
      SELECT e.contig, e.at AS pos, CASE WHEN length(alt) > length(ref) THEN b.base ELSE b.base || unit END AS ref,
        CASE WHEN length(alt) > length(ref) THEN b.base || unit ELSE b.base END AS alt, e.pos AS given_pos, ref AS given_ref, alt AS given_alt
      FROM ends e JOIN ref_bases b ON b.contig = e.contig AND b.pos = e.at)""",
    "q_callable_from_reads": """SELECT d.lab_id, i.interval_id, count(*) AS callable FROM depths d
      JOIN intervals i ON d.contig = i.contig AND d.pos BETWEEN i.start_pos AND i.end_pos GROUP BY ALL""",
    "q_select_common_biallelic": "SELECT * FROM common",
    "q_explode_alleles": f"SELECT {SITE}, {r6('af')} FROM fx_alleles",
    "q_classify_variant": """SELECT contig, CASE WHEN length(ref) = length(alt) THEN CASE length(ref) WHEN 1 THEN 'SNP' ELSE 'MNP' END
        WHEN starts_with(alt, ref) THEN 'INS' WHEN starts_with(ref, alt) THEN 'DEL' ELSE 'MIXED' END AS variant_type, count(*) AS n
      FROM (SELECT * FROM mnps UNION ALL SELECT contig, pos, ref, alt FROM counts) GROUP BY ALL""",
    "q_annotate_germline": f"SELECT lab_id, {SITE}, round(coalesce(g.af, 1e-6), 6) AS af FROM counts LEFT JOIN germline g USING ({SITE})",
    "q_resource_size": "SELECT contig, count(*) AS n_loci FROM fx_alleles GROUP BY ROLLUP (contig)",
    "q_normal_candidates": f"SELECT {COUNTS}, {r6('lod')}, {r6('fraction')} FROM normal_calls",
    "q_split_mnps": """SELECT contig, pos + i - 1 AS pos, substr(ref, i, 1) AS ref, substr(alt, i, 1) AS alt FROM (
      SELECT *, unnest([1, 2, 3]) AS i FROM mnps) WHERE substr(ref, i, 1) <> substr(alt, i, 1)""",
    "q_gather_calls": f"SELECT lab_id, {SITE}, alt_count FROM normal_calls",
    "q_consolidate_cohort": f"""SELECT lab_id, {', '.join('c.' + c for c in SITE.split(', '))}, ref_count, alt_count, interval_id FROM normal_calls c
      JOIN intervals i ON c.contig = i.contig AND c.pos BETWEEN i.start_pos AND i.end_pos""",
    "q_cohort_matrix": f"""SELECT patient, {SITE}, """
    + ", ".join(f"max(alt_count) FILTER (suffix = '{s}') AS {s}" for s in ("N", "B1", "B2", "T1", "M2", "P2"))
    + " FROM counts JOIN samples USING (lab_id) WHERE patient IS NOT NULL GROUP BY ALL",
    "q_create_pon": PANEL,
    "q_sort_sites": f"SELECT {SITE}, {r6('af')}, idx FROM fx_alleles JOIN dictionary USING (contig)",
    "q_extend_pon": PANEL,
    "q_tumour_candidates": f"SELECT pair, tumour_id, normal_id, {SITE}, t_ref, t_alt, t_f1r2, t_f2r1, {r6('tlod')} FROM cands",
    "q_join_matched_normal": f"SELECT {CALL}, n_ref, n_alt, {r6('nlod')} FROM all_matched WHERE tlod >= 6.3e0",
    "q_mark_pon": f"SELECT {CALL}, n_seen IS NOT NULL AS in_pon FROM cands LEFT JOIN panel USING ({SITE})",
    "q_germline_posterior": f"SELECT {CALL}, {r6('af')}, {r6('p_germline')} FROM diploid_calls WHERE tlod >= 6.3e0",
    "q_call_pairs": _call_rows("diploid_calls") + " WHERE tlod >= 6.3e0",
    "q_call_mitochondria": _call_rows("haploid_calls") + " WHERE contig = 'chr4'",
    "q_merge_branches": f"SELECT {CALL}, idx, {r6('tlod')}, {r6('p_germline')} FROM calls JOIN dictionary USING (contig)",
    "q_merge_stats": "SELECT * FROM stats",
    "q_f1r2_histogram": "SELECT * FROM hist",
    "q_kmer_context": "SELECT * FROM contexts",
    "q_learn_orientation": " UNION ALL ".join(
        f"SELECT pair, context, alt_base, '{s}' AS state, {r6(s, 'prior')} FROM em_5" for s in STATE
    ),
    "q_orientation_posterior": f"""SELECT {', '.join('c.' + c for c in CALL.split(', '))}, round(coalesce(o.p_orientation, 0e0), 6) AS p_orientation FROM cands c
      LEFT JOIN oriented o ON o.pair = c.pair AND o.contig = c.contig AND o.pos = c.pos AND o.ref = c.ref AND o.alt = c.alt""",
    "q_homalt_sites": "SELECT * FROM hom_sites",
    "q_het_sites": "SELECT * FROM het_loci",
    "q_contamination": f"SELECT pair, n_sites, {r6('contamination')}, {r6('error')} FROM contamination",
    "q_maf_changepoints": f"""SELECT pair, tumour_id, contig, row_number() OVER (PARTITION BY pair, tumour_id, contig ORDER BY lo) - 1 AS segment,
      ps[lo + 1] AS start_pos, ps[hi] AS end_pos, hi - lo AS n_sites, {r6('(s[hi + 1] - s[lo + 1]) / (hi - lo) / 1e6', 'maf')} FROM (
      WITH RECURSIVE het AS (
        SELECT p.pair, p.tumour_id, t.contig, t.pos, least(t.ref_count, t.alt_count) * 1000000 // (t.ref_count + t.alt_count) AS x
        FROM pairs p JOIN het_loci h ON h.lab_id = p.normal_id
        JOIN pileups t ON t.lab_id = p.tumour_id AND t.contig = h.contig AND t.pos = h.pos WHERE t.ref_count + t.alt_count > 0
      ), summed AS (
        SELECT *, CAST(sum(x) OVER w AS DOUBLE) AS sx, CAST(sum(x * x) OVER w AS DOUBLE) AS qx FROM het
        WINDOW w AS (PARTITION BY pair, tumour_id, contig ORDER BY pos)
      ), g AS (
        SELECT pair, tumour_id, contig, count(*) AS n, list(pos ORDER BY pos) AS ps, list_prepend(0e0, list(sx ORDER BY pos)) AS s, list_prepend(0e0, list(qx ORDER BY pos)) AS q
        FROM summed GROUP BY ALL
      ), dp AS (
        SELECT *, CAST(0 AS BIGINT) AS t, [-2e9] AS best, [CAST(0 AS BIGINT)] AS begins FROM g
        UNION ALL
        SELECT pair, tumour_id, contig, n, ps, s, q, t + 1, list_append(best, m.v + 2e9), list_append(begins, m.k) FROM (
          SELECT pair, tumour_id, contig, n, ps, s, q, best, begins, t,
            list_min([{{'v': best[k + 1] + ((q[t + 2] - q[k + 1]) - (s[t + 2] - s[k + 1]) * (s[t + 2] - s[k + 1]) / CAST(t + 1 - k AS DOUBLE)), 'k': k}} for k in range(0, t + 1)]) AS m
          FROM dp WHERE t < n)
      ), cuts AS (
        SELECT pair, tumour_id, contig, ps, s, begins, n AS hi, begins[n + 1] AS lo FROM dp WHERE t = n
        UNION ALL
        SELECT pair, tumour_id, contig, ps, s, begins, lo, begins[lo + 1] FROM cuts WHERE lo > 0
      ) SELECT * FROM cuts)""",
    "q_maf_segments": f"SELECT pair, tumour_id, contig, segment, start_pos, end_pos, n_sites, {r6('maf')} FROM segments",
    "q_filter_evidence": f"SELECT {CALL}, n_calls, callable, {r6('contamination')}, {r6('maf')}, {r6('p_orientation')} FROM evidence",
    "q_contamination_posterior": f"SELECT {CALL}, {r6('p_contamination')} FROM foreign_scored",
    "q_error_probability": f"""SELECT {CALL}, {r6('p_germline')}, {r6('p_contamination')}, {r6('p_orientation')}, {r6('p_weak')},
      {r6('p_error')} FROM scored""",
    "q_learn_threshold": f"SELECT pair, {r6('threshold')}, {r6('f_score')} FROM thresholds",
    "q_apply_filters": f"SELECT {CALL}, filters, n_near, n_alleles FROM filtered",
    "q_filter_summary": """SELECT pair, filter, count(*) AS n_calls FROM (
      SELECT pair, unnest(string_split(CASE WHEN filters = '' THEN 'PASS' ELSE filters END, ',')) AS filter FROM filtered) GROUP BY ROLLUP (pair, filter)""",
    "q_final_calls": f"SELECT {CALL}, idx, t_ref, t_alt, {r6('tlod')} FROM filtered JOIN dictionary USING (contig) WHERE filters = ''",
    "q_write_pair_variants": f"""SELECT {SITE}, filters, lab_id, genotype, depths FROM (
      SELECT f.*, p.tumour_id AS lab_id, '0/1' AS genotype, CAST(t_ref AS VARCHAR) || ',' || CAST(t_alt AS VARCHAR) AS depths FROM filtered f JOIN pairs p ON p.pair = f.pair
      UNION ALL BY NAME
      SELECT f.*, p.normal_id AS lab_id, '0/0' AS genotype, CAST(n_ref AS VARCHAR) || ',' || CAST(n_alt AS VARCHAR) AS depths FROM filtered f JOIN pairs p ON p.pair = f.pair)""",
    "q_export_calls": f"""SELECT {CALL}, filters, CAST(t_ref AS VARCHAR) || ',' || CAST(t_alt AS VARCHAR) AS tumour_depths,
      CAST(n_ref AS VARCHAR) || ',' || CAST(n_alt AS VARCHAR) AS normal_depths, in_pon FROM filtered""",
    "q_log_outcome": "SELECT * FROM outcomes",
    "q_log_tail": """SELECT event_type AS task_id, event_id AS line_no FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS place FROM events) WHERE place <= 50""",
    "q_log_head": """SELECT event_type AS task_id, event_id AS line_no FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events) WHERE place <= 2""",
    "q_first_match": """SELECT task_id, count(*) AS n_lines, arg_min(line, line_no) FILTER (line LIKE '%Elapsed time%') AS first_line
      FROM log_lines GROUP BY task_id""",
    "q_line_after": """SELECT * FROM (SELECT task_id, line_no, line, lead(line) OVER (PARTITION BY task_id ORDER BY line_no) AS next_line FROM log_lines)
      WHERE line LIKE '%Tool returned:%'""",
    "q_task_metrics": r"""SELECT t.task_id, CASE WHEN ok THEN minutes END AS minutes, CASE WHEN ok THEN round(bytes / 1e9, 6) END AS gb FROM tasks t LEFT JOIN (
      SELECT task_id, NOT bool_or(line LIKE '%ERROR%') AND coalesce(arg_max(TRY_CAST(regexp_extract(line, '([0-9]+)$', 1) AS DOUBLE), line_no) FILTER (line LIKE '%totalMemory%'), 0) > 0 AS ok,
        arg_max(TRY_CAST(regexp_extract(line, '([0-9.]+) minutes', 1) AS DOUBLE), line_no) FILTER (line LIKE '%Elapsed%') AS minutes,
        arg_max(TRY_CAST(regexp_extract(line, '([0-9]+)$', 1) AS DOUBLE), line_no) FILTER (line LIKE '%totalMemory%') AS bytes
      FROM log_lines GROUP BY task_id) m ON m.task_id = t.task_id""",
    "q_task_metrics_binary": r"""SELECT task_id, arg_max(TRY_CAST(regexp_extract(line, '([0-9.]+) minutes', 1) AS DOUBLE), line_no) FILTER (line LIKE '%Elapsed%') AS minutes,
      round(arg_min(TRY_CAST(regexp_extract(line, '([0-9]+)$', 1) AS DOUBLE), line_no) FILTER (line LIKE '%totalMemory%') / 1073741824e0, 2) AS gb
      FROM log_lines GROUP BY task_id""",
    "q_error_counts": r"""SELECT task_id, count(*) FILTER (line LIKE '%ERROR%') AS n_errors, CASE WHEN count(*) FILTER (line LIKE '%ERROR%') = 0 THEN
      arg_max(regexp_extract(line, '([0-9.]+) minutes', 1), line_no) FILTER (line LIKE '%Elapsed%') END AS minutes FROM log_lines GROUP BY task_id""",
    "q_exit_status": f"""SELECT job_id, status, has_stderr, coalesce(status <> 0 OR has_stderr, true) AS failed FROM (
      SELECT {pad('o_orderkey')} AS job_id, CASE WHEN e.value >= 2 THEN CAST(CASE WHEN e.event_type = 'error' THEN 271 ELSE 0 END AS INTEGER) END AS status,
        e.value > 150 AS has_stderr FROM orders LEFT JOIN events e ON e.event_id = o_orderkey)""",
    "q_missing_outputs": "SELECT * FROM missing",
    "q_rerun_set": """SELECT * FROM tasks WHERE task_id IN (SELECT task_id FROM missing)
      OR task_id NOT IN (SELECT task_id FROM outcomes WHERE outcome = 'success')""",
    "q_run_summary": """SELECT batch, count(*) AS expected, count(*) FILTER (outcome = 'success') AS successful,
      count(*) FILTER (outcome IN ('error', 'incomplete')) AS failed, count(*) FILTER (outcome IS NULL) AS no_log
      FROM tasks LEFT JOIN outcomes USING (task_id) GROUP BY ROLLUP (batch)""",
    "q_job_efficiency": "SELECT job, cpu_minutes / (wall_minutes * cpus) AS efficiency, wall_minutes * cpus / 60e0 * 2e0 AS service_units FROM usage",
    "q_stage_scaling": f"""SELECT stage, cpus, n_jobs, {r6('wall', 'wall_minutes')}, {r6('first_value(wall) OVER w / wall', 'speed_up')},
      {r6('wall * cpus / (first_value(wall) OVER w * first_value(cpus) OVER w)', 'cost_ratio')}, {r6('cpu / (wall * cpus)', 'efficiency')}
      FROM runs WINDOW w AS (PARTITION BY stage ORDER BY cpus)""",
    "q_scalar_functions": """SELECT o_orderkey AS n, o_orderpriority AS second, CAST(NULL AS VARCHAR) AS ninth, 'a;b' AS last,
      'part.' || CAST(o_orderkey AS VARCHAR) || '.vcf.gz' AS base, '../Calls/S' || CAST(o_orderkey % 100 AS VARCHAR) AS folder,
      '../Calls/S' || CAST(o_orderkey % 100 AS VARCHAR) || '/part.' || CAST(o_orderkey AS VARCHAR) AS stripped, 'part' AS stem,
      CASE WHEN o_orderkey < 10000 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS padded,
      o_orderpriority ILIKE '%urgent%' AS urgent, CASE WHEN o_orderpriority LIKE '1-%' THEN '1' WHEN o_orderpriority LIKE '2-%' THEN '2' END AS top,
      'a-b' AS swapped FROM orders""",
    "q_split_rows": "SELECT o_orderkey, unnest(['x', o_orderpriority]) AS part FROM orders",
}


def _with(final: str) -> str:
    """``final`` behind the entries of CTES it needs, directly or not."""
    needed: set[str] = set()
    for name in reversed(CTES):
        texts = [final, *(CTES[n] for n in needed)]
        if any(re.search(rf"\b{name}\b", text) for text in texts):
            needed.add(name)
    listed = ",\n".join(f"{name} AS (\n{body}\n)" for name, body in CTES.items() if name in needed)
    return f"WITH {listed}\n{final}" if listed else final


def all_sql() -> dict[str, str]:
    return {name: _with(final) for name, final in FINALS.items()}
