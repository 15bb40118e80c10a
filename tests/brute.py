"""Plain-Python statement of the scoring rules, for brute-force checks on small inputs."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal


def round3(x: float, digits: int = 3) -> float:
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def weights(movie_genres, exact=False):
    counts = defaultdict(int)
    for g in movie_genres:
        for i in range(len(g)):
            for j in range(i + 1, len(g)):
                counts[(g[i], g[j])] += 1
    totals = defaultdict(int)
    for (a, _), c in counts.items():
        totals[a] += c
    return {(a, b): (c / totals[a] if exact else round3(c / totals[a])) for (a, b), c in counts.items()}


def score_exact(fav, genres, avg, w):
    """Single-machine variant: nothing rounded until the score, 6 digits."""
    tot = 0.0
    for u in fav:
        norm = len(genres) - (1 if u in genres else 0)
        for m in genres:
            tot += 1.0 if u == m else (w[(u, m)] * (1.0 / norm) if (u, m) in w else 0.0)
    return round3(tot * avg / len(fav), 6)


def score(fav, genres, avg, w):
    tot = Decimal(0)
    for u in fav:
        norm = len(genres) - (1 if u in genres else 0)
        for m in genres:
            if u == m:
                c = 1.0
            elif (u, m) in w:
                c = round3(w[(u, m)] * (1.0 / norm))
            else:
                c = 0.0
            tot += Decimal(repr(c))
    return round3(float(tot) * avg / len(fav))


def unseen_top(movies, fav, seen, n):
    """movies: {id: (avg, genres)}, fav: {user: [genres]}, seen: {user: set(ids)}."""
    w = weights([g for _, g in movies.values()])
    out = {}
    for user, f in fav.items():
        cands = [(score(f, g, a, w), m) for m, (a, g) in movies.items() if g and m not in seen.get(user, set())]
        cands.sort(key=lambda t: (-t[0], t[1]))
        out[user] = [(i + 1, m, s) for i, (s, m) in enumerate(cands[:n])]
    return out
