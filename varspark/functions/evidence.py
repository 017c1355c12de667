"""Evidence scores as Column expressions.

r, a are the counts of reference and alternate reads, d = r + a, f = a / d and
e is the base error rate. All likelihoods are log10 and additive: no product of
probabilities is ever formed, so deep sites do not underflow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 1e-3
SOMATIC_PRIOR = 1e-3
DEFAULT_AF = 1e-6


def _col(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def allele_fraction(ref: Column, alt: Column) -> Column:
    """a / d, and 0 without reads."""
    return F.when(ref + alt > 0, alt / (ref + alt)).otherwise(F.lit(0.0))


def log_likelihood(ref: Column, alt: Column, fraction: Column | float, error: float = ERROR_RATE) -> Column:
    """log10 likelihood of the counts when a share ``fraction`` of the molecules carries the allele."""
    f = _col(fraction)
    wrong = F.lit(error / 3)
    right = F.lit(1 - error)
    as_ref = (F.lit(1.0) - f) * right + f * wrong
    as_alt = f * right + (F.lit(1.0) - f) * wrong
    return ref * F.log10(as_ref) + alt * F.log10(as_alt)


def tumour_lod(ref: Column, alt: Column, error: float = ERROR_RATE) -> Column:
    """Observed fraction against no variant at all."""
    return log_likelihood(ref, alt, allele_fraction(ref, alt), error) - log_likelihood(ref, alt, 0.0, error)


def normal_lod(ref: Column, alt: Column, error: float = ERROR_RATE) -> Column:
    """No variant against a heterozygous one; 0 without reads."""
    return log_likelihood(ref, alt, 0.0, error) - log_likelihood(ref, alt, 0.5, error)


def clamped_af(af: Column, default: float = DEFAULT_AF) -> Column:
    return F.least(F.greatest(F.coalesce(af, F.lit(default)), F.lit(default)), F.lit(1 - default))


def masses(df: DataFrame, weights: Mapping[str, Column], prefix: str = "_m_") -> DataFrame:
    """Posterior mass of each named log10 weight, as columns ``prefix + name``.

    Weights become columns first and are scaled by the largest: each is computed
    once, however often the masses use it.
    """
    logs = {n: f"_w_{n}" for n in weights}
    scaled = {n: f"_s_{n}" for n in weights}
    weighted = df.withColumns({logs[n]: w for n, w in weights.items()})
    top = F.greatest(*logs.values())
    lifted = weighted.withColumns({scaled[n]: F.pow(F.lit(10.0), F.col(logs[n]) - top) for n in weights})
    whole = reduce(lambda x, y: x + y, [F.col(c) for c in scaled.values()])
    return lifted.withColumns({prefix + n: F.col(scaled[n]) / whole for n in weights}).drop(
        *logs.values(), *scaled.values()
    )


def with_share(
    df: DataFrame, out: str, weights: Mapping[str, Column], wanted: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Add ``out``: the mass of the ``wanted`` weights, and 0 outside ``where``."""
    total = reduce(lambda x, y: x + y, [F.col(f"_m_{n}") for n in wanted])
    value = total if where is None else F.when(where, total).otherwise(F.lit(0.0))
    return masses(df, weights).withColumn(out, value).drop(*[f"_m_{n}" for n in weights])


def germline_weights(
    ref: Column,
    alt: Column,
    af: Column,
    normal_ref: Column | None = None,
    normal_alt: Column | None = None,
    *,
    maf: Column | None = None,
    diploid: Column | None = None,
    somatic_prior: float = SOMATIC_PRIOR,
    error: float = ERROR_RATE,
) -> dict[str, Column]:
    """log10 weights of inherited (het, hom) and somatic origin, given both samples.

    ``maf`` is the minor-allele share of the tumour segment; het reads then
    follow it or its complement instead of one half. Where ``diploid`` is false
    the het state has no weight, as a haploid contig has none.
    """
    q = clamped_af(af)
    het = F.log10(F.lit(2.0) * q * (F.lit(1.0) - q))
    half = (ref + alt) * F.log10(F.lit(0.5))
    if maf is None:
        het = het + half
    else:
        low = log_likelihood(ref, alt, maf, error)
        high = log_likelihood(ref, alt, F.lit(1.0) - maf, error)
        top = F.greatest(low, high)
        either = top + F.log10((F.pow(F.lit(10.0), low - top) + F.pow(F.lit(10.0), high - top)) * F.lit(0.5))
        het = het + F.when(maf.isNull(), half).otherwise(either)
    hom = F.lit(2.0) * F.log10(q) + log_likelihood(ref, alt, 1.0, error)
    somatic = (
        F.log10(F.lit(somatic_prior))
        + F.lit(2.0) * F.log10(F.lit(1.0) - q)
        + log_likelihood(ref, alt, allele_fraction(ref, alt), error)
    )
    if normal_ref is not None and normal_alt is not None:
        het = het + log_likelihood(normal_ref, normal_alt, 0.5, error)
        hom = hom + log_likelihood(normal_ref, normal_alt, 1.0, error)
        somatic = somatic + log_likelihood(normal_ref, normal_alt, 0.0, error)
    if diploid is not None:
        het = F.when(diploid, het).otherwise(F.lit(float("-inf")))
    return {"het": het, "hom": hom, "somatic": somatic}


def contamination_weights(
    ref: Column,
    alt: Column,
    af: Column,
    contamination: Column,
    somatic_prior: float = SOMATIC_PRIOR,
    error: float = ERROR_RATE,
) -> dict[str, Column]:
    """log10 weights of alt reads from another person and from a somatic variant."""
    q = clamped_af(af)
    return {
        "foreign": F.log10(q) + log_likelihood(ref, alt, F.coalesce(contamination, F.lit(0.0)) * q, error),
        "somatic": F.log10(F.lit(somatic_prior)) + log_likelihood(ref, alt, allele_fraction(ref, alt), error),
    }


def orientation_weight(forward: Column, total: Column, share_forward: float) -> Column:
    """log10 weight of ``forward`` F1R2 reads out of ``total`` (the binomial coefficient cancels)."""
    return forward * F.log10(F.lit(share_forward)) + (total - forward) * F.log10(F.lit(1 - share_forward))
