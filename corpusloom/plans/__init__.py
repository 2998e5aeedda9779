"""Queries over the test tables. Importing the package registers all of them."""

from corpusloom.plans import blends, chat, pairs, reports, sequences, streams  # noqa: F401
from corpusloom.plans.registry import QUERIES, SQL  # noqa: F401
