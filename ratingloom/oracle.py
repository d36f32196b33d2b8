"""DuckDB statements that compute the registered queries independently, from the same tables."""

from ratingloom.sources.warehouse import GENRES, TYPE_GENRES, WORD_GENRES


def _case(expr: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"when '{old}' then '{new}'" for old, new in mapping.items())
    return f"case {expr} {arms} else {expr} end"


_W1 = _case("split_part(p_name, ' ', 1)", WORD_GENRES)
_W2 = _case("split_part(p_name, ' ', 2)", WORD_GENRES)
_TY = _case("p_type", TYPE_GENRES)

# The adapted tables.
_TABLES = f"""
ratings as (
  select o_custkey as userId, l_partkey as movieId,
         (1 + floor((l_quantity - 1) * (1 + l_partkey % 10) / 50)) / 2 as rating,
         cast(epoch(l_shipdate) as bigint) as "timestamp"
  from lineitem join orders on l_orderkey = o_orderkey),
movies as (
  select p_partkey as movieId,
         case when p_partkey % 41 = 0 then p_name
              else concat(p_name, case when p_partkey % 7 = 0 then ', the' else '' end,
                          ' (', cast(1920 + 2 * p_size as varchar), ')') end as title,
         case when p_partkey % 37 = 0 then '(no genres listed)'
              when p_partkey % 2 = 0 then concat({_W1}, '|', {_W2}, '|', {_TY})
              else concat({_W1}, '|', {_W2}) end as genres
  from part),
genome_scores as (
  select l_partkey as movieId, l_suppkey as tagId, l_discount * 10 as relevance from lineitem),
genome_tags as (select s_suppkey as tagId, s_name as tag from supplier),
tags as (
  select user_id as userId, event_id % 2000 as movieId,
         concat(event_type, '-', cast(event_id % 13 as varchar)) as tag,
         cast(floor(epoch(ts)) as bigint) as "timestamp"
  from events),
links as (
  select p_partkey as movieId, lpad(cast(p_partkey as varchar), 7, '0') as imdbId,
         cast(p_partkey * 3 + 1 as varchar) as tmdbId
  from part)"""

_TREND = """,
popular as (
  select r.*, n as "count" from ratings r
  join (select movieId, count(*) as n from ratings group by movieId having count(*) >= 20) p
  using (movieId)),
yearly as (
  select movieId, cast(year(make_timestamp("timestamp" * 1000000)) as integer) as "Year",
         sum(rating) as yearly_total_rating, count(rating) as yearly_count
  from popular group by 1, 2),
running as (
  select *, sum(yearly_total_rating) over w as cumulative_total_rating,
         cast(sum(yearly_count) over w as bigint) as cumulative_count
  from yearly window w as (partition by movieId order by "Year")),
trend as (
  select *, cumulative_total_rating / cumulative_count as cumulative_avg_rating
  from running where cumulative_count >= 5),
first_last as (
  select movieId, "Year",
         first_value(cumulative_avg_rating) over (partition by movieId order by "Year")
           as first_rating,
         cumulative_avg_rating as last_rating
  from trend),
change as (select *, (last_rating - first_rating) / first_rating as diff from first_last)"""

_EXPLODED = """,
exploded as (select movieId, unnest(string_split(genres, '|')) as genre from movies)"""

_SPREAD = """,
item_spread as (
  select movieId, max(rating) as best_rating, min(rating) as worst_rating,
         max(rating) - min(rating) as rating_diff
  from ratings group by movieId),
combo_spread as (
  select genres, max(rating) as best_rating, min(rating) as worst_rating,
         max(rating) - min(rating) as rating_diff
  from ratings join movies using (movieId) group by genres)"""

_GROUP = """case when genre in ('Crime', 'Mystery') then 'Crime/Mystery'
         when genre in ('Romance', 'Musical', 'Drama') then 'Romance/Musical/Drama'
         when genre in ('Adventure', 'Fantasy', 'Animation') then 'Adventure/Fantasy/Animation'
         when genre in ('Documentary', 'War') then 'Documentary/War'
         when genre in ('Horror', 'Thriller') then 'Horror/Thriller'
         when genre in ('Comedy', 'Children') then 'Comedy/Children'
         when genre in ('Action', 'Sci-Fi') then 'Action/Sci-Fi'
         else 'Other' end"""

_GROUPS = f"""{_EXPLODED},
groups as (
  select {_GROUP} as genre_group, cast(count(*) as bigint) as total_count
  from exploded group by 1)"""

_DECADES = """,
years as (
  select *, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as integer) as "year"
  from movies),
decades as (
  select *, concat(cast("year" - "year" % 10 as varchar), 's') as decade
  from years where "year" between 1930 and 2022),
decade_genres as (
  select decade, unnest(string_split(genres, '|')) as genre from decades),
top_genres as (
  select decade, genre, "count" from (
    select decade, genre, count(*) as "count",
           dense_rank() over (partition by decade order by count(*) desc) as r
    from decade_genres group by 1, 2)
  where r <= 5),
shares as (
  select decade, genre, "count", "count" / sum("count") over (partition by decade) as share
  from top_genres where genre not in ('(no genres listed)', 'Other'))"""

_STATS = """,
item_mode as (
  select movieId, rating as mode_movie from (
    select movieId, rating,
           row_number() over (partition by movieId order by count(*) desc, rating) as r
    from ratings group by 1, 2) where r = 1),
user_mode as (
  select userId, rating as mode_user from (
    select userId, rating,
           row_number() over (partition by userId order by count(*) desc, rating) as r
    from ratings group by 1, 2) where r = 1),
item_mean as (select movieId, avg(rating) as movie_average from ratings group by 1),
user_mean as (select userId, avg(rating) as user_average from ratings group by 1),
averages as (
  select movieId, userId, rating, movie_average, user_average from ratings
  left join item_mean using (movieId) left join user_mean using (userId)),
predictions as (
  select movieId, userId, rating, (movie_average + user_average) / 2 as prediction
  from averages),
starred as (
  select *, cast(case when prediction < 1.2 then 1 when prediction < 2.3 then 2
                      when prediction < 3.4 then 3 when prediction < 4.5 then 4
                      else 5 end as double) as roundedPrediction
  from predictions),
starred_narrow as (
  select *, cast(case when prediction < 3.4 then 3 when prediction < 4.0 then 4
                      else 5 end as double) as roundedPrediction
  from predictions)"""

_INDICATORS = [g for g in GENRES if g != "(no genres listed)"]
_LISTED = ", ".join(f"'{g}'" for g in GENRES)
_ONEHOT = f"""{_EXPLODED},
onehot as (
  select movieId, {", ".join(f"count(*) filter (genre = '{g}') as \"{g}\"" for g in _INDICATORS)},
         count(*) filter (genre not in ({_LISTED})) as "Other"
  from exploded group by movieId)"""

# A row's share is the first 48 bits of a digest of its values.
_SHARES = """,
shares as (
  select *,
    cast(cast('0x' || substr(md5(concat_ws('|', '42', userId, movieId, rating, "timestamp")), 1, 12)
      as bigint) as double) / 281474976710656 as share,
    cast(cast('0x' || substr(md5(concat_ws('|', '0', userId, movieId, "timestamp" // 86400)), 1, 12)
      as bigint) as double) / 281474976710656 as day_share
  from ratings),
split as (select * exclude (share, day_share), day_share < 0.7 as is_train from shares),
scored as (
  select * exclude (is_train) from split where not is_train
    and userId in (select userId from split where is_train)
    and movieId in (select movieId from split where is_train))"""


def _sql(select: str, *more: str) -> str:
    return f"with {_TABLES}{''.join(more)}\n{select}"


def statements() -> dict[str, str]:
    spread_label = """case when rating_diff = 0 then '0' when rating_diff <= 0.5 then '0.5'
           when rating_diff <= 1 then '1' when rating_diff <= 1.5 then '1.5'
           when rating_diff <= 2 then '2' when rating_diff <= 2.5 then '2.5'
           when rating_diff <= 3 then '3' when rating_diff <= 3.5 then '3.5'
           when rating_diff <= 4 then '4' when rating_diff <= 4.5 then '4.5' else '5' end"""
    series = """select t.movieId, title, "Year", yearly_total_rating, yearly_count,
                       cumulative_total_rating, cumulative_count, cumulative_avg_rating
                from trend t left join movies using (movieId)
                where t.movieId = (select movieId from change order by {}, movieId, "Year" limit 1)"""
    smallest = "select {} from {} where rating_diff > 0 order by rating_diff, {} limit {}"
    combo = "genres, best_rating, worst_rating, rating_diff"
    indicators = ", ".join(f'coalesce("{g}", 0) as "{g}"' for g in [*_INDICATORS, "Other"])
    wide = ", ".join(
        f"coalesce(max(share) filter (genre = '{g}'), 0) as \"{g}\"" for g in _INDICATORS
    )
    wide += f""", coalesce(sum(share) filter (genre not in ({_LISTED})), 0) as "Other\""""
    return {
        "rating_count": _sql("select count(*) as rating_count from ratings"),
        "top_rated": _sql(
            """select movieId, replace(title, '"', '') as title,
                      cast(round(cast(mean as decimal(18, 12)), 2) as double) as average_rating, raters
               from (select movieId, avg(rating) as mean, count(rating) as raters
                     from ratings group by movieId having count(rating) > 30)
               join movies using (movieId) order by mean desc, movieId limit 5"""
        ),
        "popular_items": _sql("select * from popular", _TREND),
        "yearly_ratings": _sql("select * from yearly", _TREND),
        "cumulative_trend": _sql("select * from trend", _TREND),
        "trend_change": _sql(
            """select movieId, "Year", first_rating, last_rating, diff from change""",
            _TREND,
        ),
        "top_riser": _sql(series.format("diff desc"), _TREND),
        "top_faller": _sql(series.format("diff"), _TREND),
        "genre_popularity": _sql(
            """select genre, cast(sum(n) as bigint) as total_ratings,
                      any_value(items) as "count",
                      cast(round(sum(n) / any_value(items)) as integer) as pop
               from exploded
               join (select movieId, count(*) as n from ratings group by 1) using (movieId)
               join (select genre, count(*) as items from exploded group by 1) using (genre)
               where genre <> '(no genres listed)' group by genre""",
            _EXPLODED,
        ),
        "genre_combo_rating_range": _sql(
            smallest.format(combo, "combo_spread", "genres", 50), _SPREAD
        ),
        "genre_combo_min_range": _sql(
            smallest.format(combo, "combo_spread", "genres", 1), _SPREAD
        ),
        "item_rating_range": _sql(
            f"""select movieId, title, genres, best_rating, worst_rating, rating_diff
                from ({smallest.format("*", "item_spread", "movieId", 50)})
                join movies using (movieId)""",
            _SPREAD,
        ),
        "item_min_range": _sql(smallest.format("*", "item_spread", "movieId", 1), _SPREAD),
        "rating_range_histogram": _sql(
            f"""select {spread_label} as rating_diff_bin, count(*) as "count"
                from item_spread group by 1""",
            _SPREAD,
        ),
        "tag_relevance": _sql(
            """select tag, round(avg_relevance, 6) as avg_relevance from (
                 select tagId, tag, avg(relevance) as avg_relevance
                 from genome_scores join genome_tags using (tagId) group by tagId, tag
                 order by avg_relevance desc, tag, tagId limit 20)"""
        ),
        "top_tags": _sql(
            """select tag, count(*) as "count" from tags
               group by tag order by count(*) desc, tag limit 20"""
        ),
        "items_by_decade": _sql(
            'select movieId, title, genres, "year", decade from decades', _DECADES
        ),
        "top_genres_per_decade": _sql("select * from top_genres", _DECADES),
        "decade_genre_share": _sql(
            """select decade, genre, "count", share from shares""", _DECADES
        ),
        "decade_genre_table": _sql(
            f"select decade, {wide} from shares group by decade", _DECADES
        ),
        "unique_genres": _sql(
            "select count(distinct genre) as unique_genres from exploded", _EXPLODED
        ),
        "genre_counts": _sql(
            """select genre, count(*) as "count" from exploded group by genre""", _EXPLODED
        ),
        "item_total": _sql("select count(movieId) as item_total from movies"),
        "genre_group_counts": _sql("select * from groups", _GROUPS),
        "genre_group_share": _sql(
            """select genre_group, total_count,
                      100 * total_count / sum(total_count) over () as percentage
               from groups""",
            _GROUPS,
        ),
        "rating_distribution": _sql(
            f"""select genre_group, rating_bin, "count",
                       cast(sum("count") over (partition by genre_group) as bigint) as total_count,
                       "count" / sum("count") over (partition by genre_group) * 100
                         as percentage
                from (select {_GROUP} as genre_group,
                             cast(floor((rating + 0.25) / 0.5) as double) as rating_bin,
                             count(*) as "count"
                      from ratings join exploded using (movieId)
                      where genre not in ('IMAX', '(no genres listed)') group by 1, 2)""",
            _EXPLODED,
        ),
        "mode_features": _sql(
            """select movieId, userId, rating, mode_movie, mode_user from ratings
               left join item_mode using (movieId) left join user_mode using (userId)""",
            _STATS,
        ),
        "avg_features": _sql(
            """select movieId, userId, rating, movie_average, user_average from averages""",
            _STATS,
        ),
        "genre_onehot": _sql("select * from onehot", _ONEHOT),
        "rating_features": _sql(
            f"""select movieId, userId, rating, mode_movie, mode_user, movie_average, user_average, {indicators}
                from averages left join item_mode using (movieId)
                left join user_mode using (userId) left join onehot using (movieId)""",
            _STATS,
            _ONEHOT,
        ),
        "train_test_split": _sql("select * from split", _SHARES),
        "random_split": _sql(
            """select userId, movieId, rating, "timestamp", share < 0.7 as is_train from shares""",
            _SHARES,
        ),
        "als_scored": _sql(
            "select userId, movieId, rating, true as is_finite from scored", _SHARES
        ),
        "rf_check": _sql(
            "select count(*) as scored, true as beats_mean from split where not is_train", _SHARES
        ),
        "model_coverage": _sql(
            """select model, n as scored, n / total as coverage, known as compared
               from (select (select count(*) from scored) as known,
                            (select count(*) from split where not is_train) as total),
                    lateral (values ('als', known), ('random_forest', total),
                                    ('linear_regression', total)) as v(model, n)""",
            _SHARES,
        ),
        "linreg_coefficients": _sql(
            """select term, round(coefficient, 6) as coefficient
               from (select covar_pop(rating, movie_average) as a,
                            covar_pop(rating, user_average) as b,
                            var_pop(movie_average) as aa, var_pop(user_average) as bb,
                            covar_pop(movie_average, user_average) as ab,
                            avg(rating) as y, avg(movie_average) as ma, avg(user_average) as mb
                     from averages),
                    lateral (select (a * bb - b * ab) / (aa * bb - ab * ab) as m,
                                    (b * aa - a * ab) / (aa * bb - ab * ab) as u),
                    lateral (values ('movie_average', m), ('user_average', u),
                                    ('intercept', y - m * ma - u * mb)) as v(term, coefficient)""",
            _STATS,
        ),
        "round_to_stars": _sql(
            """select movieId, userId, rating, prediction, roundedPrediction from starred""",
            _STATS,
        ),
        "round_to_stars_narrow": _sql(
            """select movieId, userId, rating, prediction, roundedPrediction from starred_narrow""",
            _STATS,
        ),
        "prediction_accuracy": _sql(
            """select count(*) as scored,
                      cast(count(*) filter (rating = roundedPrediction) as double) / count(*)
                        as accuracy
               from starred""",
            _STATS,
        ),
        "rmse": _sql(
            """select round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) as rmse
               from predictions""",
            _STATS,
        ),
        "preview_ratings": _sql(
            'select * from ratings order by userId, movieId, "timestamp", rating limit 3'
        ),
        "preview_movies": _sql("select * from movies order by movieId limit 3"),
        "preview_links": _sql("select * from links order by movieId limit 3"),
        "preview_genome_scores": _sql(
            """select movieId, tagId, round(relevance, 6) as relevance from genome_scores
               order by movieId, tagId, genome_scores.relevance limit 3"""
        ),
        "preview_genome_tags": _sql("select * from genome_tags order by tagId limit 3"),
    }
