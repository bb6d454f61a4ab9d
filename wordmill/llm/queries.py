"""All queries of this folder; importing the modules registers them."""

from . import collocations, decontam, language, licenses, lines, mixing, negatives, quality, secrets, simhash, substrings, toxicity, urls  # noqa: F401, E501
from .common import ORACLES, QUERIES  # noqa: F401
