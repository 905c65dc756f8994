"""Log-prob columns: gathered log-softmax, masked sums, KL, ratios and losses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZERO = 0.0


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(_ZERO), lambda a, x: a + x)


def token_logp(logits: Column, token: Column) -> Column:
    """Log-softmax of a row of logits at one id, shifted by the maximum."""
    top = F.array_max(logits)
    norm = F.aggregate(logits, F.lit(_ZERO), lambda a, x: a + F.exp(x - top))
    return F.element_at(logits, (token + 1).cast("int")) - (top + F.log(norm))


def seq_logp_sum(logps: Column, mask: Column) -> Column:
    return _sum(F.zip_with(logps, mask, lambda x, m: x * m))


def seq_logp_mean(logps: Column, mask: Column) -> Column:
    """Masked mean per token (length-normalised)."""
    size = F.aggregate(mask, F.lit(_ZERO), lambda a, m: a + m)
    return seq_logp_sum(logps, mask) / F.greatest(size, F.lit(1e-8))


def neg_log_sigmoid(x: Column) -> Column:
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def dpo_row_loss(
    policy_chosen: Column, policy_rejected: Column, ref_chosen: Column, ref_rejected: Column, beta=0.1
) -> Column:
    margin = (policy_chosen - policy_rejected) - (ref_chosen - ref_rejected)
    return neg_log_sigmoid(margin * F.lit(float(beta)))


def token_kl(ref: Column, new: Column) -> Column:
    return F.zip_with(ref, new, lambda r, n: F.exp(r - n) - (r - n) - 1)


def ratio(new: Column, old: Column) -> Column:
    return F.zip_with(new, old, lambda n, o: F.exp(n - o))


def _clamp(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(x, F.lit(hi)), F.lit(lo))


def grpo_token_loss(ratios: Column, kl: Column, advantage: Column, eps=0.2, beta=0.02) -> Column:
    return F.zip_with(
        ratios,
        kl,
        lambda r, k: -(
            F.least(r * advantage, _clamp(r, 1 - eps, 1 + eps) * advantage) - F.lit(float(beta)) * k
        ),
    )


def cispo_token_loss(
    ratios: Column, kl: Column, new: Column, advantage: Column, eps_high=5.0, beta=0.02
) -> Column:
    """Upper cap on the weight only; the cap is ``eps_high`` itself."""
    weighted = F.zip_with(
        ratios, new, lambda r, n: F.least(r, F.lit(float(eps_high))) * advantage * n
    )
    return F.zip_with(weighted, kl, lambda w, k: -(w - F.lit(float(beta)) * k))


def row_loss(token_loss: Column, mask: Column) -> Column:
    """Masked token mean of one row; at least one in the denominator."""
    size = F.aggregate(mask, F.lit(_ZERO), lambda a, m: a + m)
    return _sum(F.zip_with(token_loss, mask, lambda x, m: x * m)) / F.greatest(size, F.lit(1.0))


def last_valid(values: Column, mask: Column) -> Column:
    """Value at the last valid place of a row whose valid places come first."""
    size = F.aggregate(mask, F.lit(0), lambda a, m: a + m)
    return F.try_element_at(values, size)
