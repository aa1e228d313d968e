"""Registered queries. Importing this package fills the registry."""

from pactmill.plans import corpus, evaluation, runs, streams, vectors  # noqa: F401
from pactmill.plans.registry import ORACLES, QUERIES  # noqa: F401
