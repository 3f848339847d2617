"""Weighted whole-word scores through the inverted word counts, against a plain loop."""

from __future__ import annotations

import random

import pytest

from relevo import session
from relevo.operators import features


def _case():
    rng = random.Random(4)
    vocabulary = ["saw", "blade", "the", "oak", "nail", "été", "x"]

    def text(n):
        return " ".join(rng.choice([*vocabulary, "other", "more"]) for _ in range(rng.randrange(n)))

    pairs = [(i, i % 7 if i % 3 else 0, text(5), text(6) or None, 1.0) for i in range(300)] + [(900, None, "oak", "oak", 2.0), (901, 50, "oak", "oak", 2.0)]
    descs = [(p, text(40)) for p in range(6)]
    descs += [(0, "oak oak the"), (0, "oak oak the"), (3, None), (3, "Saw\tsaw\nSAW"), (None, "oak"), (77, "oak"), (6, "")]
    return pairs, descs


def _loop(pairs, descs, how):
    out = []
    for i, p, title, term, label in pairs:
        terms, words = (term or "").lower().split(), (title or "").lower().split()
        found = [(t or "").lower().split() for q, t in descs if q == p and p is not None]
        for d in found or ([[]] if how == "left" else []):
            n = len(terms)
            out.append((i, p, None if not n else 4 * sum(words.count(t) for t in terms) / n + sum(d.count(t) for t in terms) / n, label))
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [session.BROADCAST_LIMIT_BYTES, 0])
def test_weighted_score_equals_a_loop(spark, monkeypatch, how, limit):
    """Several and equal descriptions of a product, nulls, repeated terms; with and without broadcast."""
    monkeypatch.setattr(features, "broadcast_if_small", lambda t, *c: session.broadcast_if_small(t, *c, limit_bytes=limit))
    pairs, descs = _case()
    got = features.weighted_tf_score(spark.createDataFrame(pairs, "id long, product_uid long, product_title string, search_term string, relevance double"),
                                     spark.createDataFrame(descs, "product_uid long, product_description string"), join_how=how).collect()
    assert _close(got, _loop(pairs, descs, how))


def _close(got, want):
    a = sorted((str(r["id"]), str(r["product_uid"]), -1.0 if r["values"] is None else round(r["values"], 9), r["label"]) for r in got)
    b = sorted((str(i), str(p), -1.0 if v is None else round(v, 9), x) for i, p, v, x in want)
    return a == b


def test_descriptions_are_tokenised_once(spark):
    """The score's plan reads counts: no description text, no word array of one."""
    pairs, descs = _case()
    out = features.weighted_tf_score(spark.createDataFrame(pairs, "id long, product_uid long, product_title string, search_term string, relevance double"),
                                     spark.createDataFrame(descs, "product_uid long, product_description string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "product_description" not in plan and "split(" not in plan and "array_remove" not in plan
