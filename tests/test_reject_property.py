"""The page-level reject rule against a brute-force model, on random pages.

The model flattens a page the straightforward way in Python - look every
requested key up, scan ``details`` for each attribute until the first match,
read every requested offer field - and calls the page rejected when any step
fails.  Spark evaluates the same rule on ``VARIANT`` envelopes.
"""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dealspark.operators.projection import ProjectionSpec
from dealspark.sources import pages as G

SPEC = ProjectionSpec(["sku", "name"], ["Color", "Size"], ["startDate"])
MISSING = object()

text = st.sampled_from(["Color", "COLOR", "size", "Weight", "x"])
names = st.one_of(text, st.just(5))  # a number cannot be case-folded
maybe = lambda s: st.one_of(st.just(MISSING), st.none(), s)


def _detail():
    return st.fixed_dictionaries({}, optional={"name": st.one_of(st.none(), names),
                                               "value": st.one_of(st.none(), text)})


def _offer():
    return st.fixed_dictionaries({}, optional={"startDate": st.one_of(st.none(), st.just("2024-01-01")),
                                               "endDate": st.just("2024-01-08")})


@st.composite
def product(draw, sku):
    p = {"sku": sku}
    name = draw(maybe(st.just(f"n{sku}")))
    if name is not MISSING:
        p["name"] = name
    details = draw(st.one_of(st.just(MISSING), st.lists(_detail(), max_size=4)))
    if details is not MISSING:
        p["details"] = details
    offers = draw(st.one_of(st.just(MISSING), st.lists(_offer(), max_size=3)))
    if offers is not MISSING:
        p["offers"] = offers
    return p


def model_fails(products, spec) -> bool:
    s = spec.resolved()
    try:
        for p in products:
            for c in s.columns:
                p[c]
            for want in s.details:
                for d in p["details"]:
                    if d["name"].lower() == want.lower():
                        d["value"]
                        break
            for f in s.offers:
                for o in p["offers"]:
                    o[f]
    except (KeyError, AttributeError, TypeError):
        return True
    return False


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3), min_size=1, max_size=6).flatmap(
    lambda sizes: st.tuples(*[st.tuples(*[product(100 * i + j) for j in range(n)]) for i, n in enumerate(sizes)])))
def test_reject_matches_model(spark, tmp_path_factory, pages):
    d = tmp_path_factory.mktemp("pages")
    lines = [json.dumps({"totalPages": len(pages), "total": 0, "currentPage": i + 1, "products": list(ps)})
             for i, ps in enumerate(pages)]
    (d / "part-0.json").write_text("\n".join(lines) + "\n")
    env = G.read_envelopes(spark, str(d))
    kept = {r.page for r in G.accepted(env, SPEC).select(
        G.F.variant_get(G.F.col(G.ENVELOPE), "$.currentPage", "int").alias("page")).collect()}
    expected = {i + 1 for i, ps in enumerate(pages) if not model_fails(ps, SPEC)}
    assert kept == expected
