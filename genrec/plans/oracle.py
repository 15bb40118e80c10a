"""DuckDB SQL for every registered query: the same semantics written
independently as one chain of CTEs over the driver's tables."""

from __future__ import annotations

# Fixed values of the method (thresholds, names) are those of operators/prep.py,
# functions/genres.py and sources/views.py.
#
# (name, body) in dependency order; a query's SQL includes the chain up to
# the last CTE it needs.
_CTES: list[tuple[str, str]] = [
    ("movies", """
select cast(p_partkey as int) as movieid,
  case when p_partkey % 41 = 0 then p_name
       else concat(p_name, ' (', cast(1925 + p_partkey % 95 as varchar), ')') end as title,
  case when p_partkey % 37 = 0 then '(no genres listed)' else nullif(concat_ws('|',
    case when p_partkey % 5 < 2 then 'Action' end,  case when p_partkey % 3 = 0 then 'Comedy' end,
    case when p_partkey % 2 = 0 then 'Drama' end,   case when p_partkey % 11 = 0 then 'IMAX' end,
    case when p_size % 4 = 0 then 'Romance' end,    case when p_size % 7 = 0 then 'Thriller' end), '') end as genres
from part"""),
    ("ratings", """
select cast(userid as int) as userid, cast(movieid as int) as movieid, rating, ts as timestamp from (
  select o_custkey as userid, l_partkey as movieid, cast(ceil(l_quantity / 5) as double) / 2 as rating,
    cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) * 86400 + l_linenumber as ts,
    row_number() over (partition by o_custkey, l_partkey
                       order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as rn
  from lineitem join orders on l_orderkey = o_orderkey) t where rn = 1"""),
    ("vm0", """
select movieid, title, list_filter(string_split(genres, '|'), lambda x: x <> '') as raw,
  try_cast(regexp_extract(title, '\\(([0-9]{4})\\)', 1) as integer) as year
from movies where genres is not null"""),
    ("valid", """
select movieid, title,
  list_filter(raw, lambda x, i: x <> 'IMAX' and list_position(raw, x) = i) as genres, year
from vm0 where year > 1942 and not list_contains(raw, '(no genres listed)')"""),
    ("mcount", """
select movieid, count(*) as n_pos from ratings
where rating >= 3 and movieid in (select movieid from valid) group by movieid"""),
    ("thr", "select quantile_cont(n_pos, 0.7) as threshold from mcount"),
    ("rp", """
select r.userid, r.movieid, r.rating, r.timestamp, v.genres
from ratings r join valid v on r.movieid = v.movieid
where r.movieid in (select movieid from mcount where n_pos >= (select threshold from thr))"""),
    ("ustats", """
select userid, count(*) filter (where rating >= 3) as n_pos, min(timestamp) as ts_min,
  max(timestamp) as ts_max from rp group by userid"""),
    ("band", """
select quantile_cont(n_pos, 0.5) as p_low, quantile_cont(n_pos, 0.98) as p_high
from ustats where n_pos > 0"""),
    ("busers", """
select userid, ts_min, ts_max, (ts_max - ts_min) / 5 * 4 + ts_min as cut from ustats
where n_pos > 0 and n_pos between (select p_low from band) and (select p_high from band)"""),
    ("active", "select rp.*, b.cut from rp join busers b on rp.userid = b.userid"),
    ("training", "select userid, movieid, rating, timestamp, genres from active where timestamp <= cut"),
    ("test_raw", "select userid, movieid, rating, timestamp, genres from active where timestamp > cut"),
    ("test", "select * from test_raw where movieid in (select movieid from training)"),
    ("avg", """
select movieid, avg(rating) as avgrating, any_value(genres) as genres from training group by movieid"""),
    ("hist", """
select userid, genre, count(*) as cnt from (select userid, unnest(genres) as genre from training)
group by userid, genre"""),
    ("h3", """
select userid, genre, cnt, total, cnt / total as share,
  row_number() over (partition by userid order by cnt desc, genre) as rn,
  count(*) filter (where cnt / total >= 0.2) over (partition by userid) as k
from (select *, sum(cnt) over (partition by userid) as total from hist)"""),
    ("fav", """
select userid, list(genre order by rn) as favgenres from h3
where (k >= 2 and share >= 0.2) or (k < 2 and rn <= 2) group by userid"""),
    ("mlists", "select genres, count(*) as movies from avg where len(genres) >= 2 group by genres"),
    ("pcount", """
select genres[i] as genre_a, genres[j] as genre_b, cast(sum(movies) as bigint) as n
from mlists, generate_series(1, len(genres)) s(i), generate_series(1, len(genres)) t(j)
where i < j group by all"""),
    ("weights", """
select genre_a, genre_b, n, round(n / sum(n) over (partition by genre_a), 3) as weight from pcount"""),
    ("mp", """
select movieid, avgrating, array_to_string(list_sort(genres), '|') as skey, list_sort(genres) as sgenres
from avg where len(genres) > 0"""),
    ("up", """
select userid, array_to_string(list_sort(favgenres), '|') as pkey, list_sort(favgenres) as pgenres
from fav where len(favgenres) > 0"""),
    ("cands", "select t.userid, t.movieid from test t join fav f on t.userid = f.userid"),
    ("c", """
select x.userid, x.movieid, mp.avgrating, mp.skey, mp.sgenres, up.pkey, up.pgenres
from cands x join mp on x.movieid = mp.movieid join up on x.userid = up.userid"""),
    ("cpairs", "select distinct pkey, pgenres, skey, sgenres from c"),
    ("x1", "select pkey, skey, len(pgenres) as n_fav, unnest(pgenres) as u, sgenres from cpairs"),
    ("x2", """
select pkey, skey, n_fav, u, len(sgenres) - case when list_contains(sgenres, u) then 1 else 0 end as norm,
  unnest(sgenres) as m from x1"""),
    ("x3", """
select x2.*, w.weight,
  case when u = m then cast(1 as double) when w.weight is null then cast(0 as double)
       else round(w.weight * (cast(1 as double) / norm), 3) end as coeff
from x2 left join weights w on w.genre_a = x2.u and w.genre_b = x2.m"""),
    ("aff", """
select pkey, skey, cast(n_fav as int) as n_fav, sum(cast(coeff as decimal(18,3))) as aff
from x3 group by pkey, skey, n_fav"""),
    ("weights_x", "select genre_a, genre_b, n, n / sum(n) over (partition by genre_a) as weight from pcount"),
    ("aff_x", """
select pkey, skey, cast(n_fav as int) as n_fav,
  sum(case when u = m then cast(1 as double) when w.weight is null then cast(0 as double)
           else w.weight * (cast(1 as double) / norm) end) as aff
from x2 left join weights_x w on w.genre_a = x2.u and w.genre_b = x2.m group by pkey, skey, n_fav"""),
    ("preds_x", """
select * from (select userid, movieid, score,
  cast(row_number() over (partition by userid order by score desc, movieid) as int) as rank
  from (select c.userid, c.movieid, round(a.aff * c.avgrating / a.n_fav, 6) as score
        from c join aff_x a on c.pkey = a.pkey and c.skey = a.skey)) where rank <= 10"""),
    ("scores", """
select c.userid, c.movieid, round(a.aff * c.avgrating / a.n_fav, 3) as score
from c join aff a on c.pkey = a.pkey and c.skey = a.skey"""),
    ("preds", """
select * from (select userid, movieid, score,
  cast(row_number() over (partition by userid order by score desc, movieid) as int) as rank
  from scores) where rank <= 10"""),
    ("pm", """
select p.userid, p.movieid, p.rank, coalesce(t.rating >= 3, false) as positive
from preds p left join test t on p.userid = t.userid and p.movieid = t.movieid"""),
    ("tpos", "select userid, count(*) filter (where rating >= 3) as n_pos from test group by userid"),
    ("apu", """
select pm.userid, count(*) as n_pred, any_value(tpos.n_pos) as n_pos,
  least(count(*), any_value(tpos.n_pos)) as k,
  count(*) filter (where pm.positive and pm.rank <= least(x.n_pred, tpos.n_pos)) as hits
from pm join tpos on pm.userid = tpos.userid
  join (select userid, count(*) as n_pred from pm group by userid) x on pm.userid = x.userid
group by pm.userid"""),
    ("stored", """
select userid, string_agg(cast(movieid as varchar) || ':' || cast(least(score, 5.0) as varchar), '|' order by rank)
  as recommendations from preds group by userid"""),
    ("parsed", """
select userid, cast(rank as int) as rank, try_cast(split_part(item, ':', 1) as int) as movieid,
  try_cast(split_part(item, ':', 2) as double) as score
from (select userid, unnest(string_split(recommendations, '|')) as item,
        generate_subscripts(string_split(recommendations, '|'), 1) as rank from stored)
where item <> ''"""),
    ("vec", "select userid, movieid, cast(round(rating * 100) as bigint) as w from training where round(rating * 100) <> 0"),
    ("norms", "select movieid, cast(sum(w * w) as bigint) as n2 from vec group by movieid"),
    ("cosines", """
select p.movieid, p.neighbour, p.n_common, dot / sqrt(cast(a.n2 as double) * cast(b.n2 as double)) as cosine
from (select x.movieid, y.movieid as neighbour, count(*) as n_common, cast(sum(x.w * y.w) as bigint) as dot
      from vec x join vec y on x.userid = y.userid and x.movieid <> y.movieid group by all) p
  join norms a on a.movieid = p.movieid join norms b on b.movieid = p.neighbour"""),
    ("neighbours", """
select * from (select movieid, neighbour, n_common, round(cosine, 6) as cosine,
  cast(row_number() over (partition by movieid order by round(cosine, 6) desc, neighbour) as int) as rank
  from cosines where cosine >= 0.05) where rank <= 10"""),
    ("sims", """
select n.movieid, n.neighbour, cast(cosine as decimal(18,6)) as sim, cast(round(cosine * (1 + 0.5 * coalesce(
    cast(len(list_intersect(a.genres, b.genres)) as double) / nullif(len(list_distinct(list_concat(a.genres, b.genres))), 0), 0.0)), 6) as decimal(18,6)) as sim_boosted
from neighbours n left join avg a on a.movieid = n.movieid left join avg b on b.movieid = n.neighbour"""),
    ("nscores", """
select t.userid, t.movieid, count(*) as n_rated,
  round(cast(sum(s.sim * cast(r.rating as decimal(6,3))) as double) / cast(sum(s.sim) as double), 3) as score,
  round(cast(sum(s.sim_boosted * cast(r.rating as decimal(6,3))) as double) / cast(sum(s.sim_boosted) as double), 3) as score_boosted
from test t join sims s on s.movieid = t.movieid join training r on r.userid = t.userid and r.movieid = s.neighbour
group by t.userid, t.movieid"""),
    ("ufactors", "select userid, genre, cast(round(cnt / total, 3) as decimal(9,3)) as f from h3"),
    ("ifactors", """
select movieid, unnest(genres) as genre, cast(round(avgrating / sqrt(len(genres)), 3) as decimal(9,3)) as f from avg"""),
    ("products", """
select u.userid, i.movieid, cast(sum(u.f * i.f) as double) as score
from ufactors u join ifactors i on u.genre = i.genre group by all"""),
    ("seen", "select distinct userid, movieid from training"),
    ("uc", """
select up.userid, up.pkey, up.pgenres, mp.movieid, mp.avgrating, mp.skey, mp.sgenres
from up cross join mp
where not exists (select 1 from training t where t.userid = up.userid and t.movieid = mp.movieid)"""),
    ("ucpairs", "select distinct pkey, pgenres, skey, sgenres from uc"),
    ("uy1", "select pkey, skey, len(pgenres) as n_fav, unnest(pgenres) as u, sgenres from ucpairs"),
    ("uy2", """
select pkey, skey, n_fav, u, len(sgenres) - case when list_contains(sgenres, u) then 1 else 0 end as norm,
  unnest(sgenres) as m from uy1"""),
    ("uaff", """
select pkey, skey, n_fav, sum(cast(case when u = m then cast(1 as double)
    when w.weight is null then cast(0 as double)
    else round(w.weight * (cast(1 as double) / norm), 3) end as decimal(18,3))) as aff
from uy2 left join weights w on w.genre_a = uy2.u and w.genre_b = uy2.m group by pkey, skey, n_fav"""),
    ("uscores", """
select uc.userid, uc.movieid, round(a.aff * uc.avgrating / a.n_fav, 3) as score
from uc join uaff a on uc.pkey = a.pkey and uc.skey = a.skey"""),
    ("utop", """
select * from (select userid, movieid, score,
  cast(row_number() over (partition by userid order by score desc, movieid) as int) as rank
  from uscores) where rank <= 10"""),
]

# the second view of movies and ratings; the rest of the chain is the same
_EDITIONS = {
    "movies": """
select cast(p_partkey * 10 + y - 1995 as int) as movieid, concat(p_name, ' (', y, ')') as title,
  array_to_string(list_transform(list_append(string_split(p_name, ' '), p_type),
    lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), '|') as genres
from part, generate_series(1995, 2001) s(y)""",
    "ratings": """
select cast(userid as int) as userid, cast(movieid as int) as movieid, rating, ts as timestamp from (
  select o_custkey as userid, l_partkey * 10 + year(l_shipdate) - 1995 as movieid, cast(ceil(l_quantity / 5) as double) / 2 as rating,
    cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) * 86400 + l_linenumber as ts,
    row_number() over (partition by o_custkey, l_partkey, year(l_shipdate)
                       order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as rn
  from lineitem join orders on l_orderkey = o_orderkey) t where rn = 1""",
}


def _half_up(sql: str) -> str:
    """``round(x, 3)`` on the shortest decimal form of x, as the method rounds; DuckDB rounds x * 1000 in binary, which
    differs on some ties that this view meets (2.0195)."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        end, depth = start + 6, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + 6:end - 1].removesuffix(", 3")
        out += sql[at:start] + f"cast(round(cast(cast({inner} as varchar) as decimal(38,20)), 3) as double)"
        at = end
    return out + sql[at:]


_EDITIONS |= {n: _half_up(sql) for n, sql in _CTES if n in ("weights", "x3", "scores", "uaff", "uscores")}
_EDITION_KEYS = {f"edition_{k}": k for k in (
    "movies", "ratings", "training", "test_raw", "cold_movies", "test", "fav_genres", "genre_weights", "predictions", "accuracy")}
_EDITION_KEYS["edition_unseen"] = "unseen_recommendations"

_FINAL: dict[str, tuple[str, str]] = {
    # name: (last CTE needed, final select)
    "movies": ("movies", "select * from movies"),
    "ratings": ("ratings", "select * from ratings"),
    "movie_year": ("movies", "select movieid, title, regexp_extract(title, '\\(([0-9]{4})\\)', 1) as year from movies"),
    "split_genres": ("movies", """select movieid,
        array_to_string(list_filter(string_split(genres, '|'), lambda x: x <> ''), '|') as genres from movies"""),
    "valid_movies": ("valid", "select movieid, title, array_to_string(genres, '|') as genres, year from valid"),
    "positive_ratings": ("ratings", "select * from ratings where rating >= 3"),
    "ratings_with_genres": ("valid", """select r.userid, r.movieid, r.rating, r.timestamp,
        array_to_string(v.genres, '|') as genres from ratings r join valid v on r.movieid = v.movieid"""),
    "positive_count_per_movie": ("mcount", "select * from mcount"),
    "movie_threshold": ("thr", "select * from thr"),
    "popular_movie_ratings": ("rp", """select userid, movieid, rating, timestamp,
        array_to_string(genres, '|') as genres from rp"""),
    "positive_count_per_user": ("rp", "select userid, count(*) as n_pos from rp where rating >= 3 group by userid"),
    "user_band": ("band", "select * from band"),
    "bounded_thresholds": ("band", """select 'movie' as what, cast(0.7 as double) as share, threshold from thr
        union all select 'user', 0.5, p_low from band union all select 'user', 0.98, p_high from band"""),
    "user_time_span": ("busers", "select * from busers"),
    "active_user_ratings": ("active", """select userid, movieid, rating, timestamp,
        array_to_string(genres, '|') as genres from active"""),
    "training": ("training", "select * replace (array_to_string(genres, '|') as genres) from training"),
    "test_raw": ("test_raw", "select * replace (array_to_string(genres, '|') as genres) from test_raw"),
    "cold_movies": ("test_raw", """select distinct movieid from test_raw
        where movieid not in (select movieid from training)"""),
    "test": ("test", "select * replace (array_to_string(genres, '|') as genres) from test"),
    "test_ratings": ("test", "select userid, movieid, rating from test"),
    "avg_ratings": ("avg", "select movieid, avgrating, array_to_string(genres, '|') as genres from avg"),
    "movie_profiles": ("mp", "select movieid, avgrating, skey, cast(len(sgenres) as int) as n_genres from mp"),
    "user_genre_hist": ("h3", "select userid, genre, cnt, cast(total as bigint) as total, share from h3"),
    "fav_genres": ("fav", "select userid, array_to_string(favgenres, '|') as favgenres from fav"),
    "titles": ("valid", "select movieid, title from valid"),
    "genre_pairs": ("avg", """select movieid, genres[i] as genre_a, genres[j] as genre_b
        from avg, generate_series(1, len(genres)) s(i), generate_series(1, len(genres)) t(j) where i < j"""),
    "genre_pair_counts": ("pcount", "select * from pcount"),
    "genre_weights": ("weights", "select * from weights"),
    "known_genres": ("avg", "select distinct unnest(genres) as genre from avg"),
    "test_candidates": ("cands", "select * from cands"),
    "genre_coefficient": ("x3", "select distinct u as genre_u, m as genre_m, cast(norm as int) as norm, coeff from x3"),
    "genre_affinity": ("aff", "select pkey, skey, n_fav, cast(aff as double) as aff from aff"),
    "score": ("scores", "select * from scores"),
    "top_n": ("scores", """select * from (select userid, movieid, score,
        cast(row_number() over (partition by userid order by score desc, movieid) as int) as rank
        from scores) where rank <= 3"""),
    "predictions_exact": ("preds_x", "select * from preds_x"),
    "predictions": ("preds", "select * from preds"),
    "clip_scores": ("preds", "select userid, movieid, least(score, 5.0) as score, rank from preds"),
    "accuracy_per_user": ("apu", "select * from apu"),
    "accuracy": ("apu", """select cast(sum(hits) as bigint) as hits, cast(sum(k) as bigint) as k,
        case when sum(k) = 0 then null else cast(sum(hits) as double) / cast(sum(k) as double) end as accuracy,
        round(avg(case when k = 0 then null else cast(hits as double) / cast(k as double) end), 10)
          as accuracy_macro from apu"""),
    "rmse": ("preds", """select count(*) as n, sqrt(cast(sum(e * e) as double) / count(*)) as rmse
        from (select cast(least(p.score, 5.0) as decimal(10,3)) - cast(t.rating as decimal(10,3)) as e
              from preds p join test t on p.userid = t.userid and p.movieid = t.movieid)"""),
    "item_cosine": ("neighbours", "select movieid, rank, neighbour, n_common, cosine from neighbours"),
    "item_cosine_common": ("cosines", """select * from (select movieid, neighbour, n_common, round(cosine, 6) as cosine,
        cast(row_number() over (partition by movieid order by round(cosine, 6) desc, neighbour) as int) as rank
        from cosines where cosine >= 0.02 and n_common >= 2) where rank <= 10"""),
    "neighbour_scores": ("nscores", "select userid, movieid, n_rated, score from nscores"),
    "neighbour_scores_boosted": ("nscores", "select userid, movieid, n_rated, score_boosted as score from nscores"),
    "rmse_by_method": ("nscores", """select method, count(*) as n, sqrt(cast(sum(e * e) as double) / count(*)) as rmse
        from (select method, cast(least(p.score, 5.0) as decimal(10,3)) - cast(t.rating as decimal(10,3)) as e
              from (select 'genres' as method, userid, movieid, score from preds
                    union all select 'neighbours', userid, movieid, score from nscores
                    union all select 'neighbours_boosted', userid, movieid, score_boosted from nscores) p
                join test t on p.userid = t.userid and p.movieid = t.movieid) group by method"""),
    "prediction_store_ibcf": ("nscores", """select userid, string_agg(cast(movieid as varchar) || ':' ||
          cast(least(score, 5.0) as varchar), '|' order by rank) as recommendations
        from (select *, row_number() over (partition by userid order by score desc, movieid) as rank from nscores)
        where rank <= 10 group by userid"""),
    "prediction_store_users": ("parsed", """select * from parsed
        where userid in (select userid from test where rating >= 3)"""),
    "factor_top_n": ("products", """select userid, rank, movieid, score from (
        select u.userid, i.movieid, coalesce(p.score, 0.0) as score,
          cast(row_number() over (partition by u.userid order by coalesce(p.score, 0.0) desc, i.movieid) as int) as rank
        from (select distinct userid from h3) u cross join (select movieid from avg where len(genres) > 0) i
          left join products p on p.userid = u.userid and p.movieid = i.movieid) where rank <= 10"""),
    "predictions_export": ("stored", "select * from stored"),
    "predictions_parse": ("parsed", "select * from parsed"),
    "first_predictions": ("stored", "select * from stored order by userid limit 50"),
    "user_recommendations": ("parsed", """select p.userid,
        cast(row_number() over (partition by p.userid order by p.score desc, p.movieid) as int) as rank,
        trim(v.title) as title, p.score from parsed p join valid v on p.movieid = v.movieid"""),
    "seen_movies": ("seen", "select * from seen"),
    "unseen_counts": ("up", """select up.userid, (select count(*) from mp) - coalesce(s.n, 0) as n_unseen
        from up left join (select userid, count(*) as n from training
                           where movieid in (select movieid from mp) group by userid) s
        on up.userid = s.userid"""),
    "unseen_recommendations": ("utop", """select up.userid, t.rank, t.movieid, t.score
        from up left join utop t on up.userid = t.userid"""),
    "read_csv": ("movies", "select * from movies"),
    "read_ratings_csv": ("ratings", "select * from ratings"),
    "later_duplicates": ("ratings", "select * from ratings"),
    "csv_outcome": ("ratings", """select case l_linenumber when 3 then 'movieid: no int' when 4 then 'rating: no double'
          when 5 then 'fields' when 6 then 'fields' else 'kept' end as reason, count(*) as n from lineitem group by 1"""),
    "csv_rejects": ("ratings", """select case l_linenumber when 3 then 'movieid: no int' when 4 then 'rating: no double' else 'fields' end as reason,
          concat_ws(',', o_custkey, case when l_linenumber = 3 then 'm' || l_partkey else cast(l_partkey as varchar) end,
            case when l_linenumber = 4 then 'good' else cast(cast(ceil(l_quantity / 5) as double) / 2 as varchar) end,
            case when l_linenumber <> 5 then date_diff('day', date '1970-01-01', cast(l_shipdate as date)) * 86400 + l_linenumber end,
            case when l_linenumber = 6 then 'more' end) as text
        from lineitem join orders on l_orderkey = o_orderkey where l_linenumber between 3 and 6"""),
    "read_titles_csv": ("valid", "select movieid, title from valid"),
    "dropped_candidates": ("up", """select reason, count(*) as n from (
        select case when up.userid is null then 'no_favourites' when a.movieid is null then 'no_movie'
                    when len(a.genres) = 0 then 'no_genres' end as reason
        from ratings r left join up on r.userid = up.userid left join avg a on r.movieid = a.movieid)
        where reason is not null group by reason"""),
    "export_training": ("training", """select userid, movieid, rating, timestamp,
        case when len(genres) = 0 then '' else array_to_string(genres, '|') || '|' end as genres from training"""),
    "predictions_csv": ("stored", "select * from stored"),
    "predictions_csv_als": ("stored", "select * from stored"),
    "csv_roundtrip": ("fav", """
        select 'training' as dataset, concat_ws(';', userid, movieid, rating, timestamp, array_to_string(genres, '|')) as row from training
        union all select 'test', concat_ws(';', userid, movieid, rating, timestamp, array_to_string(genres, '|')) from test
        union all select 'avg_ratings', concat_ws(';', movieid, avgrating, array_to_string(genres, '|')) from avg
        union all select 'users_fav_genres', concat_ws(';', userid, array_to_string(favgenres, '|')) from fav
        union all select 'titles', concat_ws(';', movieid, title) from valid"""),
}


def _chain(last: str, final: str, views: dict[str, str]) -> str:
    names = [n for n, _ in _CTES]
    chain = _CTES[: names.index(last) + 1]
    body = ",\n".join(f"{n} as ({views.get(n, sql).strip()})" for n, sql in chain)
    return f"with {body}\n{final}"


def oracle_sql() -> dict[str, str]:
    out = {key: _chain(*spec, {}) for key, spec in _FINAL.items()}
    return out | {key: _chain(*_FINAL[of], _EDITIONS) for key, of in _EDITION_KEYS.items()}
