"""The whole pipeline against plain Python on random landing rows."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from starmill import Config, Layers
from starmill.plans import analysis
from starmill.sources.store import LayerStore
from tests.test_reconcile import landing

GENRES = ["Action", "action", " Puzzle ", "Puzzle", "Tools", "", "  ", "11-Feb-18", "Music"]
ONE = 10**12


def random_row(rnd, i):
    pick = rnd.choice
    return dict(
        raw_id=i * 3 + 1,
        app=pick(["A", " a ", "B", "b", "C", None, "", "Shifted"]),
        category=pick(["GAME", "game ", "TOOLS", "1.9", None]),
        rating=pick(["4.1", "5", "0", "5.1", "NaN", None, "3.333"]),
        reviews=pick(["0", "7", "123456789", "x", None]),
        size=pick(["1M", "2.5k", "Varies with device", None]),
        installs=pick(["1,000+", "5+", "Free", None]),
        type=pick(["Free", "Paid", "0", None]),
        price=pick(["0", "$1.99", None]),
        content_rating=pick(["Everyone", "Teen", "0"]),
        genres=pick([None, ";".join(pick(GENRES) for _ in range(rnd.randint(0, 6)))]),
        last_updated=pick(["7-Jan-18", "1-Feb-70", "31-Feb-18", ""]),
        current_ver=pick(["1.0", "NaN", "n/a"]),
        android_ver=pick(["4", "null", " "]),
    )


def norm(text):
    return None if text is None or not text.strip(" ") else text.strip(" ").lower()


def rating(text):
    if text is None or not text.replace(".", "").isdigit() or Decimal(text) > 5:
        return None
    return Decimal(text).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def whole(text, digits_only):
    if text is None:
        return None
    if digits_only:
        return int(text) if text.isdigit() else None
    digits = "".join(c for c in text if c.isdigit())
    return int(digits) if digits else None


def expected_kpis(rows):
    apps = {norm(r["app"]) for r in rows if norm(r["app"]) and r["app"].strip(" ") != "Shifted"}
    sums = {}
    for r in rows:
        category, age = norm(r["category"]), norm(r["content_rating"])
        in_fact = (
            norm(r["app"]) in apps
            and category not in (None, "1.9")
            and age not in (None, "0")
            and r["last_updated"] in ("7-Jan-18", "1-Feb-70")
        )
        names = {norm(g) for g in (r["genres"] or "").split(";")} - {None, "11-feb-18"}
        if not in_fact or not names:
            continue
        weight = (ONE * 2 + len(names)) // (2 * len(names))
        for g in names:
            s = sums.setdefault(g, dict(w=0, reviews=0, installs=0, ratings=[], rated=0, points=0))
            s["w"] += weight
            s["reviews"] += (whole(r["reviews"], True) or 0) * weight
            s["installs"] += (whole(r["installs"], False) or 0) * weight
            stars = rating(r["rating"])
            if stars is not None:
                s["ratings"].append(stars)
                s["rated"] += weight
                s["points"] += int(stars * 100) * weight
    return sums


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("stored", [False, True])
def test_genre_kpis(spark, seed, stored):
    rnd = random.Random(seed)
    rows = [random_row(rnd, i) for i in range(400)]
    store = LayerStore(spark, f"brute_{seed}", 3) if stored else None
    ly = Layers(landing(spark, rows), Config(app_sentinels=("Shifted",)), store)
    got = {r.genre_name.lower(): r for r in analysis.genre_weighted_kpis(ly).collect()}
    expected = expected_kpis(rows)
    assert set(got) == set(expected) and expected
    for g, s in expected.items():
        r = got[g]
        assert Fraction(r.weighted_snapshot_count) == Fraction(s["w"], ONE)
        # A sum over nothing but NULLs is NULL.
        assert Fraction(r.weighted_reviews_count or 0) == Fraction(s["reviews"], ONE)
        assert Fraction(r.weighted_installs_count or 0) == Fraction(s["installs"], ONE)
        mean = Fraction(sum(s["ratings"])) / len(s["ratings"])
        assert abs(Fraction(r.avg_rating_unweighted) - mean) < Fraction(1, 10**13)
        weighted = Fraction(s["points"], 100 * s["rated"])
        assert abs(Fraction(r.avg_rating_weighted) - weighted) < Fraction(1, 10**15)


def test_genre_without_any_rating(spark):
    base = dict(app="A", category="C", type="Free", content_rating="R", last_updated="7-Jan-18")
    rows = [
        dict(base, raw_id=1, genres="X;Y", rating="NaN", reviews="3"),
        dict(base, raw_id=2, genres="Y", rating="4", reviews=None),
    ]
    got = {r.genre_name: r for r in analysis.genre_weighted_kpis(Layers(landing(spark, rows))).collect()}
    assert (got["X"].avg_rating_unweighted, got["X"].avg_rating_weighted) == (None, None)
    assert got["Y"].avg_rating_weighted == 4 and got["Y"].weighted_reviews_count == Decimal("1.5")
