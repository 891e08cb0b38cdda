"""Predicate-only row counts of the saved searches, as agreed in FIXTURES.md §3."""

import pytest

from dealspark.plans.packs import SAVED_QUERIES
from dealspark.sources.catalogue import catalogue, catalogue_latest

from conftest import SF_MID, SF_SMALL

# FIXTURES.md §3 (sf0.001, sf0.01), predicate only, no top-k.
EXPECTED = {
    "discount": (58, 571), "headphones": (9, 73), "airpods": (3, 50), "ps5 controller": (7, 64),
    "television": (1, 18), "macbook": (2, 55), "nvidia": (2, 9), "desktop": (1, 38), "purple": (40, 427),
    "airpods recent": (3, 8), "macbook cheap": (2, 27), "nvidia cheap": (0, 4),
    "television top10": (6, 116), "nvidia top10": (3, 60),
}


@pytest.mark.parametrize("sf_dir,idx", [(SF_SMALL, 0), (SF_MID, 1)])
def test_saved_search_counts(spark, sf_dir, idx):
    cat = catalogue(spark, sf_dir)
    now = catalogue_latest(spark, sf_dir)
    got = {name: cat.where(q.where(now)).count() for name, q in SAVED_QUERIES.items()}
    assert got == {name: counts[idx] for name, counts in EXPECTED.items()}
