"""Identity hashing, sampling keys and format checks as Column expressions.

Arguments are the SQL text of a string expression, usually a column name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aftermerge.functions.text import quote, strip_sql

SAMPLE_SPACE = 10_000
"""Sampling keys lie in ``[0, SAMPLE_SPACE)``."""

_TWO_POW_32_MOD = 2**32 % SAMPLE_SPACE
SHA = r"^[0-9a-fA-F]{40}\z"
REPO = r"^[A-Za-z0-9][A-Za-z0-9-]*/[A-Za-z0-9._-]+\z"


def _digest(value: str) -> str:
    return f"sha2(CAST(lower({strip_sql(value)}) AS BINARY), 256)"


def hash_identity_sql(value: str) -> str:
    """16 hex digits of SHA-256 over the trimmed, lower-cased value; NULL and '' give NULL."""
    return f"CASE WHEN length({value}) > 0 THEN substring({_digest(value)}, 1, 16) END"


def hash_identity(value: str) -> Column:
    """Column form of :func:`hash_identity_sql`."""
    return F.expr(hash_identity_sql(value))


def is_bot_login(login: str) -> Column:
    """True when the login ends in ``[bot]``; NULL counts as no."""
    return F.expr(f"coalesce(endswith({login}, '[bot]'), false)")


def valid_sha(sha: str) -> Column:
    """Exactly 40 hex digits, either case."""
    return F.expr(f"coalesce({sha} RLIKE {quote(SHA)}, false)")


def valid_repo(repo: str) -> Column:
    """``owner/name`` with the characters the hosting site allows."""
    return F.expr(f"coalesce({repo} RLIKE {quote(REPO)}, false)")


def sample_key(repo: str) -> Column:
    """Stable INT in ``[0, SAMPLE_SPACE)``: the first 64 bits of SHA-256 of the lower-cased name.

    The 64-bit value is reduced half by half, so it never leaves signed BIGINT range.
    """
    high = f"CAST(conv(substring({_digest(repo)}, 1, 8), 16, 10) AS BIGINT)"
    low = f"CAST(conv(substring({_digest(repo)}, 9, 8), 16, 10) AS BIGINT)"
    whole = f"{high} % {SAMPLE_SPACE} * {_TWO_POW_32_MOD} + {low}"
    return F.expr(f"CAST(({whole}) % {SAMPLE_SPACE} AS INT)")


def sample_threshold(rate: float) -> int:
    """Number of sampling keys a rate keeps."""
    if not 0.0 <= rate <= 1.0:
        raise ValueError(f"a sampling rate lies between 0 and 1, got {rate}")
    return round(rate * SAMPLE_SPACE)


def in_sample(repo: str, rate: float) -> Column:
    """True when the repository falls in a sample of the given rate."""
    return sample_key(repo) < sample_threshold(rate)
