"""Favourite-genre rule against a plain statement of it, on random histories."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from genrec.operators import prep

GENRES = ["A", "B", "C", "D", "E"]


def expected(histories):
    out = {}
    for user, lists in histories.items():
        counts = Counter(g for lst in lists for g in lst)
        total = sum(counts.values())
        if not total:
            continue
        ordered = sorted(counts, key=lambda g: (-counts[g], g))
        above = [g for g in ordered if counts[g] / total >= 0.2]
        out[user] = above if len(above) >= 2 else ordered[:2]
    return out


histories_st = st.dictionaries(
    st.integers(1, 50),
    st.lists(st.lists(st.sampled_from(GENRES), min_size=0, max_size=4, unique=True), min_size=1, max_size=8),
    min_size=1, max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(histories=histories_st)
def test_fav_genres_rule(spark, histories):
    data = [(u, i, 4.0, i, lst) for u, lists in histories.items() for i, lst in enumerate(lists)]
    df = spark.createDataFrame(data, "userid int, movieid int, rating double, timestamp bigint, genres array<string>")
    got = {r["userid"]: r["favgenres"] for r in prep.fav_genres(df).collect()}
    assert got == expected(histories)
