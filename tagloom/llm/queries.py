"""All registered queries of this package."""

from . import (  # noqa: F401
    bpe,
    hamming,
    html,
    langid,
    licenses,
    minhash,
    mixing,
    periodic,
    quality,
    secrets,
    toxicity,
    urlfilter,
    vafile,
)
from .registry import ORACLES, QUERIES  # noqa: F401
