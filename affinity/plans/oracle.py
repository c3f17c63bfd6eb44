"""DuckDB SQL that computes the same results as the registered Spark queries.

Tables are the raw test tables (``lineitem``, ``orders``, ``part`` ...); the
CTEs below repeat the star-schema mapping of ``affinity.sources.testdata``.
"""

from __future__ import annotations

import re

# Shared CTE fragments --------------------------------------------------------

RATINGS = """
r AS (
  SELECT l.l_partkey AS mov_id, o.o_custkey AS user_id,
         l.l_quantity / 10.0 AS rating,
         CAST(floor(l.l_quantity / 10.0) AS DOUBLE) AS grade,
         CASE WHEN l.l_returnflag <> 'N' THEN l.l_returnflag END AS review,
         l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RATE = RATINGS + """,
rate AS (
  SELECT mov_id, user_id, grade, review FROM (
    SELECT *, row_number() OVER (PARTITION BY mov_id, user_id
              ORDER BY l_orderkey, l_linenumber, mov_id, l_suppkey, l_quantity) AS rn
    FROM r) WHERE rn = 1)"""

MOVIE = """
movie AS (SELECT p_name AS name, p_partkey AS mov_id, p_size AS runtime, p_retailprice AS revenue FROM part)"""

GENRE = """
genre AS (SELECT p_type AS name, CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS genre_id
          FROM (SELECT DISTINCT p_type FROM part)),
belong_to AS (SELECT p.p_partkey AS mov_id, g.genre_id FROM part p JOIN genre g ON p.p_type = g.name)"""

DIRECTOR = """
director AS (SELECT p_brand AS name, CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS director_id,
                    CAST(dense_rank() OVER (ORDER BY p_brand) % 3 AS INTEGER) AS gender
             FROM (SELECT DISTINCT p_brand FROM part)),
direct AS (SELECT p.p_partkey AS mov_id, d.director_id FROM part p JOIN director d ON p.p_brand = d.name)"""

CAST = """
mov_cast AS (SELECT s_name AS name, s_suppkey AS cast_id, CAST(s_suppkey % 2 AS VARCHAR) AS gender FROM supplier),
act AS (
  SELECT l_partkey AS mov_id, l_returnflag AS role, l_suppkey AS cast_id FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1)"""

# The raw movie file: clean rows, then the dirty ones (raw.raw_movies).
RAW_MOVIES = GENRE + """,
raw_movies AS (
  SELECT p_name AS title, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS VARCHAR) || '.0' AS runtime,
         '[{''id'': ' || g.genre_id || ', ''name'': ''' || p_type || '''}]' AS genres,
         CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 10 = 5 THEN 'nm' || CAST(p_partkey AS VARCHAR)
              ELSE 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS imdb_id, p_partkey AS pos, 0 AS kind
  FROM part JOIN genre g ON g.name = p_type
  UNION ALL
  SELECT CASE p_partkey % 20 WHEN 1 THEN 'Again ' || p_name WHEN 7 THEN 'O''Neil "X\\Y"' ELSE p_name END,
         CASE p_partkey % 20 WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'x' || CAST(p_partkey AS VARCHAR)
              WHEN 7 THEN CAST(20000000 + p_partkey AS VARCHAR) WHEN 8 THEN CAST(30000000 + p_partkey AS VARCHAR)
              ELSE CAST(10000000 + p_partkey AS VARCHAR) END,
         CASE p_partkey % 20 WHEN 1 THEN '1.0' WHEN 3 THEN 'abc' WHEN 4 THEN '' WHEN 7 THEN '81.7' ELSE '70' END,
         CASE WHEN p_partkey % 20 = 8 THEN '[{''id'': 1' ELSE '[]' END, '', 1000000000 + p_partkey, p_partkey % 20
  FROM part WHERE p_partkey % 20 BETWEEN 1 AND 8)"""

# Literals in eight forms (raw.raw_literals).
RAW_LITERALS = """
lit0 AS (
  SELECT l_orderkey % 8 AS form, l_partkey AS mov_id, l_suppkey AS cast_id, s_name, l_suppkey % 2 AS gender, l_returnflag AS role,
         '{''id'': ' || l_suppkey || ', ''name'': ''' || s_name || ''', ''gender'': ' || (l_suppkey % 2) ||
         ', ''character'': ''' || l_returnflag || '''}' AS plain
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

PROFILES_BODY = """
mg AS (SELECT mov_id, min(genre_id) AS genre_id FROM belong_to GROUP BY mov_id),
best AS (SELECT user_id, genre_id AS fav FROM (
  SELECT r.user_id, r.mov_id, mg.genre_id,
         row_number() OVER (PARTITION BY r.user_id ORDER BY r.grade DESC, r.mov_id) AS rn
  FROM rate r JOIN mg ON r.mov_id = mg.mov_id) WHERE rn = 1),
profiles AS (
  SELECT u.user_id, u.name, u.username,
         coalesce(b.fav, (SELECT genre_id FROM belong_to GROUP BY genre_id ORDER BY count(*) DESC, genre_id LIMIT 1)) AS genre_id,
         CAST(u.user_id % 2 AS VARCHAR) AS gender,
         make_date(CAST(1950 + (u.user_id * 7919) % 51 AS BIGINT), CAST(1 + (u.user_id * 31) % 12 AS BIGINT),
                   CAST(1 + (u.user_id * 17) % 28 AS BIGINT)) AS birthday
  FROM users u LEFT JOIN best b ON u.user_id = b.user_id)"""

USERS = """
users AS (SELECT c_custkey AS user_id, c_name AS name, lower(c_name) AS username,
                 CAST(c_custkey % 2 AS VARCHAR) AS gender FROM customer)"""

PROFILES = None  # set below


def core(min_item: int, min_user: int) -> str:
    """Filtered ratings, train/test rows and train cells."""
    return RATINGS + f""",
core AS (
  SELECT * FROM r
  WHERE mov_id IN (SELECT mov_id FROM r GROUP BY mov_id HAVING count(*) > {min_item})
    AND user_id IN (SELECT user_id FROM r GROUP BY user_id HAVING count(*) > {min_user})),
train AS (SELECT * FROM core WHERE (user_id * 31 + mov_id * 17) % 10 < 8),
test AS (SELECT * FROM core WHERE (user_id * 31 + mov_id * 17) % 10 >= 8),
cells AS (SELECT user_id, mov_id, avg(grade) AS grade FROM train GROUP BY user_id, mov_id)"""


MIN_ITEM, MIN_USER = 30, 10

from affinity.functions.scalars import ENGLISH_STOP_WORDS, TOKEN_PATTERN  # noqa: E402

STOP = "(" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + ")"


def tfidf_cte(tf_source: str, ndocs: str = "SELECT count(DISTINCT mov_id) AS n FROM tf") -> str:
    """CTEs tf(mov_id, term, tf) -> w(mov_id, term, weight) given a tf query."""
    return f"""
tf AS ({tf_source}),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
ndocs AS ({ndocs}),
raww AS (SELECT tf.mov_id, tf.term,
         tf.tf * (ln((1 + (SELECT n FROM ndocs)) / (1.0 + df.df)) + 1) AS raw FROM tf JOIN df USING (term)),
w AS (SELECT mov_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY mov_id)) AS weight FROM raww)"""


DOC_TF = f"""
SELECT mov_id, term, CAST(count(*) AS DOUBLE) AS tf FROM (
  SELECT doc_id AS mov_id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}', 1)) AS term
  FROM documents WHERE text IS NOT NULL)
WHERE term NOT IN {STOP} GROUP BY mov_id, term"""

SIMILAR = """
pairs AS (SELECT a.mov_id, b.mov_id AS similar_id, sum(a.weight * b.weight) AS sim
          FROM w a JOIN w b ON a.term = b.term AND a.mov_id <> b.mov_id GROUP BY a.mov_id, b.mov_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY mov_id ORDER BY round(sim, 9) DESC, similar_id) AS rank
           FROM pairs WHERE round(sim, 9) > 0)"""

NEIGHBOURS = """
um AS (SELECT user_id, avg(grade) AS mu FROM cells GROUP BY user_id),
mm AS (SELECT CAST(count(DISTINCT mov_id) AS DOUBLE) AS m FROM cells),
dev AS (SELECT c.user_id, c.mov_id, c.grade - um.mu AS d FROM cells c JOIN um USING (user_id)),
nrm AS (SELECT um.user_id, um.mu, sqrt((SELECT m FROM mm) * um.mu * um.mu + coalesce(s.ss, 0)) AS nu
        FROM um LEFT JOIN (SELECT user_id, sum(d * d) AS ss FROM dev GROUP BY user_id) s USING (user_id)),
co AS (SELECT a.user_id AS u, b.user_id AS v, sum(a.d * b.d) AS s
       FROM dev a JOIN dev b ON a.mov_id = b.mov_id AND a.user_id <> b.user_id GROUP BY 1, 2),
allp AS (SELECT x.user_id AS u, y.user_id AS v,
         CASE WHEN x.nu > 0 AND y.nu > 0
              THEN ((SELECT m FROM mm) * x.mu * y.mu + coalesce(co.s, 0)) / (x.nu * y.nu) ELSE 0 END AS sim
         FROM nrm x JOIN nrm y ON x.user_id <> y.user_id
         LEFT JOIN co ON co.u = x.user_id AND co.v = y.user_id),
nbr AS (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY round(sim, 9) DESC, v) AS rank FROM allp),
nb AS (SELECT u, v, sim, rank FROM nbr WHERE rank <= 5)"""
PROFILES = RATE + "," + GENRE + "," + USERS + "," + PROFILES_BODY


def sql() -> dict[str, str]:
    c = core(MIN_ITEM, MIN_USER)
    q: dict[str, str] = {}

    q["rank_weighted"] = f"""
WITH {c},
st AS (SELECT mov_id, avg(grade) AS mean, count(*) AS n FROM cells GROUP BY mov_id),
sc AS (SELECT mov_id, n, n / (n + 10.0) * mean + 10.0 / (n + 10.0) * (SELECT avg(grade) FROM cells) AS score FROM st),
top AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, mov_id) AS rank FROM sc)
SELECT CAST(rank AS BIGINT) AS rank, t.mov_id, p.p_name AS name, round(score, 6) AS score, n
FROM top t LEFT JOIN part p ON p.p_partkey = t.mov_id WHERE rank <= 10"""

    q["rank_mean"] = f"""
WITH {c},
st AS (SELECT mov_id, avg(grade) AS score, count(*) AS n FROM cells GROUP BY mov_id),
top AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, mov_id) AS rank FROM st)
SELECT CAST(rank AS BIGINT) AS rank, t.mov_id, p.p_name AS name, round(score, 6) AS score, n,
       coalesce(p.p_name, '') || ': ' || CAST(n AS VARCHAR) || ' Ratings' AS label
FROM top t LEFT JOIN part p ON p.p_partkey = t.mov_id WHERE rank <= 10"""

    q["front_list"] = f"""
WITH {c}, {MOVIE},
st AS (SELECT mov_id, sum(grade) AS total, count(*) AS n FROM cells GROUP BY mov_id),
sc AS (SELECT mov_id, n / (n + 10.0) * (total / n) + 10.0 / (n + 10.0) * (SELECT avg(grade) FROM cells) AS score FROM st),
top AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, mov_id) AS rank FROM sc)
SELECT m.*, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score
FROM movie m JOIN top t ON m.mov_id = t.mov_id WHERE rank <= 12"""

    q["rating_scan"] = f"WITH {RATINGS} SELECT mov_id, user_id, grade FROM r"

    q["fetch_ranked_items"] = f"""
WITH {c}, {MOVIE},
st AS (SELECT mov_id, avg(grade) AS score FROM cells GROUP BY mov_id),
top AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, mov_id) AS rank FROM st)
SELECT m.*, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score
FROM movie m JOIN top t ON m.mov_id = t.mov_id WHERE rank <= 10"""

    q["dense_core_ratings"] = f"WITH {c} SELECT user_id, mov_id, grade FROM core"

    q["holdout_split"] = f"""WITH {c}
SELECT user_id, mov_id, grade,
       CASE WHEN (user_id * 31 + mov_id * 17) % 10 >= 8 THEN 'test' ELSE 'train' END AS part FROM core"""

    q["rating_cells"] = f"WITH {RATINGS} SELECT user_id, mov_id, avg(grade) AS grade FROM r GROUP BY user_id, mov_id"

    q["item_mean_rating"] = f"""WITH {RATINGS},
cells AS (SELECT user_id, mov_id, avg(grade) AS grade FROM r GROUP BY user_id, mov_id)
SELECT mov_id, round(avg(grade), 6) AS mean, count(*) AS n FROM cells GROUP BY mov_id"""

    q["user_mean_rating"] = f"""WITH {RATINGS},
cells AS (SELECT user_id, mov_id, avg(grade) AS grade FROM r GROUP BY user_id, mov_id)
SELECT user_id, round(avg(grade), 6) AS mean, count(*) AS n FROM cells GROUP BY user_id"""

    q["grade_histogram"] = f"""WITH {RATE}
SELECT mov_id, count_if(grade = 1) AS n1, count_if(grade = 2) AS n2, count_if(grade = 3) AS n3,
       count_if(grade = 4) AS n4, count_if(grade = 5) AS n5 FROM rate GROUP BY mov_id"""

    q["popular_top_mean"] = f"""WITH {RATE}, {MOVIE}
SELECT * FROM movie WHERE mov_id IN (
  SELECT mov_id FROM rate GROUP BY mov_id HAVING count(*) > 20
  ORDER BY round(avg(grade), 9) DESC, mov_id LIMIT 12)"""

    q["user_top_rated"] = f"""WITH {RATE}
SELECT * FROM (SELECT user_id, mov_id, grade,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY grade DESC, mov_id) AS BIGINT) AS rank FROM rate)
WHERE rank <= 3"""

    q["first_by_key"] = f"""WITH {RATINGS}
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mov_id, user_id
  ORDER BY l_orderkey, l_linenumber, mov_id, l_suppkey, l_quantity) AS rn FROM r) WHERE rn = 1"""

    q["stage_counts"] = f"""WITH {c}
SELECT CAST(0 AS BIGINT) AS step, 'rating_rows' AS stage, (SELECT count(*) FROM r) AS rows
UNION ALL SELECT 1, 'rate', (SELECT count(*) FROM (SELECT DISTINCT mov_id, user_id FROM r))
UNION ALL SELECT 2, 'core', (SELECT count(*) FROM core)
UNION ALL SELECT 3, 'train', (SELECT count(*) FROM train)
UNION ALL SELECT 4, 'train_cells', (SELECT count(*) FROM cells)"""

    # lookups -------------------------------------------------------------
    q["item_by_id"] = f"WITH {MOVIE} SELECT * FROM movie"

    q["item_genres"] = f"""WITH {MOVIE}, {GENRE}
SELECT b.mov_id, b.genre_id, g.name AS genre FROM belong_to b JOIN genre g ON b.genre_id = g.genre_id
WHERE b.mov_id IN (SELECT mov_id FROM movie)"""

    q["item_cast"] = f"""WITH {MOVIE}, {CAST}
SELECT a.mov_id, a.cast_id, c.name AS cast_name, a.role FROM act a JOIN mov_cast c ON a.cast_id = c.cast_id
WHERE a.mov_id IN (SELECT mov_id FROM movie)"""

    q["item_directors"] = f"""WITH {MOVIE}, {DIRECTOR}
SELECT d.mov_id, d.director_id, x.name AS director FROM direct d JOIN director x ON d.director_id = x.director_id
WHERE d.mov_id IN (SELECT mov_id FROM movie)"""

    q["item_reviews"] = f"""WITH {RATE}, {USERS}
SELECT r.mov_id, r.user_id, u.name AS reviewer, r.grade, r.review
FROM rate r JOIN users u ON r.user_id = u.user_id WHERE r.review IS NOT NULL"""

    q["user_item_rating"] = f"""WITH {RATE}, {MOVIE}, {USERS}
SELECT r.user_id, r.mov_id, m.name AS title, r.grade, r.review
FROM rate r JOIN movie m ON r.mov_id = m.mov_id WHERE r.user_id IN (SELECT user_id FROM users)"""

    q["item_ratings_named"] = f"""WITH {RATE}, {MOVIE}, {USERS}
SELECT r.mov_id, m.name AS title, r.user_id, u.name AS rater, r.grade, r.review
FROM rate r JOIN movie m ON r.mov_id = m.mov_id JOIN users u ON r.user_id = u.user_id"""

    q["person_items"] = f"""WITH {MOVIE}, {CAST}
SELECT a.cast_id, c.name AS cast_name, a.mov_id, m.name AS title, a.role
FROM act a JOIN mov_cast c ON a.cast_id = c.cast_id JOIN movie m ON a.mov_id = m.mov_id"""

    q["director_items"] = f"""WITH {MOVIE}, {DIRECTOR}
SELECT d.director_id, d.mov_id, m.name AS title FROM direct d JOIN movie m ON d.mov_id = m.mov_id"""

    q["user_genre_name"] = f"""WITH {PROFILES}
SELECT p.user_id, p.genre_id, g.name AS genre FROM profiles p JOIN genre g ON p.genre_id = g.genre_id"""

    q["user_history"] = f"""WITH {RATE}, {MOVIE}
SELECT r.user_id, r.mov_id, m.name AS title, r.grade FROM rate r JOIN movie m ON r.mov_id = m.mov_id"""

    q["items_in_genre"] = f"""WITH {MOVIE}, {GENRE}
SELECT * FROM (SELECT g.name AS genre,
  CAST(row_number() OVER (PARTITION BY g.name ORDER BY b.mov_id) AS BIGINT) AS pos, b.mov_id, m.name AS title
  FROM belong_to b JOIN genre g ON b.genre_id = g.genre_id JOIN movie m ON b.mov_id = m.mov_id)
WHERE pos <= 12"""

    q["item_wide"] = f"""WITH {MOVIE}, {GENRE}, {CAST}
SELECT m.mov_id, m.name AS title, g.name AS genre, c.name AS cast_name, a.role
FROM movie m JOIN belong_to b ON m.mov_id = b.mov_id JOIN genre g ON b.genre_id = g.genre_id
JOIN act a ON m.mov_id = a.mov_id JOIN mov_cast c ON a.cast_id = c.cast_id"""

    q["item_facets"] = f"""WITH {GENRE}, {DIRECTOR}, {CAST}
SELECT d.mov_id, x.name AS director, g.name AS genre, c.name AS cast_name
FROM direct d JOIN director x ON d.director_id = x.director_id
JOIN belong_to b ON d.mov_id = b.mov_id JOIN genre g ON b.genre_id = g.genre_id
JOIN act a ON d.mov_id = a.mov_id JOIN mov_cast c ON a.cast_id = c.cast_id"""

    q["person_by_id"] = f"""WITH {DIRECTOR}, {CAST}
SELECT 'cast' AS entity, cast_id AS person_id, name, gender FROM mov_cast
UNION ALL SELECT 'director', director_id, name, CAST(gender AS VARCHAR) FROM director"""

    q["user_by_name"] = f"WITH {USERS} SELECT * FROM users"

    q["search_names"] = f"""WITH {DIRECTOR}
(SELECT 'movie' AS entity, p_partkey AS id, p_name AS name FROM part WHERE p_name ILIKE '%R%' ORDER BY id LIMIT 10)
UNION ALL (SELECT 'cast', s_suppkey, s_name FROM supplier WHERE s_name ILIKE '%R%' ORDER BY s_suppkey LIMIT 10)
UNION ALL (SELECT 'director', director_id, name FROM director WHERE name ILIKE '%R%' ORDER BY director_id LIMIT 10)"""

    q["search_names_indexed"] = q["search_names"].replace("'%R%'", "'%ER#0%01%'")

    # etl -------------------------------------------------------------------
    q["etl_item"] = """
SELECT p_name AS name, p_partkey AS mov_id, 'en' AS language, p_size AS runtime,
       CAST(NULL AS DATE) AS release_date, CAST(round(p_retailprice * 100) AS BIGINT) AS revenue,
       CAST(NULL AS VARCHAR) AS poster_path, CAST(NULL AS VARCHAR) AS overview FROM part
UNION ALL SELECT 'O''Neil "X\\Y"', 20000000 + p_partkey, 'en', 81, DATE '1995-12-17', NULL, NULL, NULL
FROM part WHERE p_partkey % 20 = 7
UNION ALL SELECT p_name, 30000000 + p_partkey, 'en', 70, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 20 = 8"""

    q["reject_malformed"] = f"""WITH {RAW_MOVIES}
SELECT pos, title AS name, runtime AS runtime_raw,
       CASE kind WHEN 2 THEN 'bad_id' WHEN 3 THEN 'bad_runtime' WHEN 4 THEN 'bad_runtime'
                 WHEN 5 THEN 'bad_release_date' ELSE 'bad_revenue' END AS reason
FROM raw_movies WHERE kind BETWEEN 2 AND 6"""

    q["csv_scan"] = f"WITH {RAW_MOVIES} SELECT title, id, nullif(runtime, '') AS runtime, genres, nullif(imdb_id, '') AS imdb_id FROM raw_movies"
    q["load_table"] = f"WITH {RATE} SELECT mov_id, user_id, grade, review FROM rate"
    q["reject_literals"] = f"""WITH {RAW_MOVIES}, {RAW_LITERALS}
SELECT CAST(mov_id AS VARCHAR) AS id,
       CASE form WHEN 5 THEN 'None' WHEN 6 THEN '[' || plain || '] junk' ELSE plain END AS literal
FROM lit0 WHERE form >= 5
UNION ALL SELECT id, genres FROM raw_movies WHERE kind = 8"""

    q["etl_rating"] = f"""WITH {RATINGS}
SELECT mov_id, user_id, grade, CAST(NULL AS VARCHAR) AS review FROM (
  SELECT *, row_number() OVER (PARTITION BY mov_id, user_id
            ORDER BY l_orderkey, l_linenumber, mov_id, l_suppkey, l_quantity) AS rn
  FROM r WHERE mov_id IN (SELECT p_partkey FROM part)) WHERE rn = 1"""

    q["etl_genre"] = f"WITH {GENRE} SELECT name, genre_id FROM genre"
    q["etl_item_genre"] = f"WITH {GENRE} SELECT DISTINCT mov_id, genre_id FROM belong_to"
    q["etl_director"] = f"""WITH {DIRECTOR}
SELECT name, director_id, gender FROM director WHERE director_id IN (
  SELECT d.director_id FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN director d ON p.p_brand = d.name)"""
    q["etl_cast"] = """
SELECT s_name AS name, s_suppkey AS cast_id, CAST(s_suppkey % 2 AS VARCHAR) AS gender FROM supplier
WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)"""
    q["etl_item_director"] = f"""WITH {DIRECTOR}
SELECT DISTINCT l.l_partkey AS mov_id, d.director_id FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN director d ON p.p_brand = d.name"""
    q["etl_item_cast"] = f"WITH {CAST} SELECT mov_id, role, cast_id FROM act WHERE mov_id IN (SELECT p_partkey FROM part)"
    q["user_favorite_genre"] = f"WITH {PROFILES} SELECT * FROM profiles"
    q["etl_link"] = """
SELECT DISTINCT p_partkey AS mov_id, 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS web_id
FROM part WHERE p_size % 10 NOT IN (0, 5)"""
    keys = "(3, 17, 58, 131, 1000000000000)"
    q["link_by_item"] = q["etl_link"] + f" AND p_partkey IN {keys}"
    q["lookup_item"] = q["item_by_id"] + f" WHERE mov_id IN {keys}"
    q["lookup_item_genres"] = q["item_genres"] + f" AND b.mov_id IN {keys}"
    q["lookup_item_cast"] = q["item_cast"] + f" AND a.mov_id IN {keys}"
    q["lookup_item_reviews"] = q["item_reviews"] + f" AND r.mov_id IN {keys}"
    q["lookup_person"] = f"SELECT * FROM ({q['person_by_id']}) WHERE person_id IN (1, 2, 5, 1000000000000)"
    q["lookup_user"] = q["user_by_name"] + " WHERE username IN ('customer#000000003', 'customer#000000011', 'nobody')"
    q["etl_website"] = """
SELECT DISTINCT CASE WHEN p_size % 10 = 5 THEN 'nm' || CAST(p_partkey AS VARCHAR)
                     ELSE 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS web_id
FROM part WHERE p_size % 10 <> 0"""
    q["etl_load_all"] = f"""WITH {RATE}, {GENRE}, {DIRECTOR}, {CAST}, {USERS}, {PROFILES_BODY}
SELECT CAST(0 AS BIGINT) AS step, 'website' AS tbl, (SELECT count(*) FROM part WHERE p_size % 10 <> 0) AS rows
UNION ALL SELECT 1, 'movie', (SELECT count(*) + count(CASE WHEN p_partkey % 20 IN (7, 8) THEN 1 END) FROM part)
UNION ALL SELECT 2, 'link', (SELECT count(*) FROM part WHERE p_size % 10 NOT IN (0, 5))
UNION ALL SELECT 3, 'genre', (SELECT count(*) FROM genre)
UNION ALL SELECT 4, 'user_most_like', (SELECT count(*) FROM profiles)
UNION ALL SELECT 5, 'rate', (SELECT count(*) FROM rate)
UNION ALL SELECT 6, 'belong_to', (SELECT count(*) FROM belong_to)
UNION ALL SELECT 7, 'director', (SELECT count(DISTINCT d.director_id) FROM lineitem l
                                 JOIN part p ON l.l_partkey = p.p_partkey JOIN director d ON p.p_brand = d.name)
UNION ALL SELECT 8, 'mov_cast', (SELECT count(DISTINCT l_suppkey) FROM lineitem)
UNION ALL SELECT 9, 'direct', (SELECT count(*) FROM (SELECT DISTINCT l.l_partkey, d.director_id FROM lineitem l
                               JOIN part p ON l.l_partkey = p.p_partkey JOIN director d ON p.p_brand = d.name))
UNION ALL SELECT 10, 'act', (SELECT count(*) FROM act)"""

    q["parse_nested"] = f"""WITH {RAW_LITERALS}
SELECT mov_id, cast_id,
       CASE form WHEN 1 THEN 'O''' || s_name WHEN 2 THEN s_name || 'A' ELSE s_name END AS name,
       CASE WHEN form <> 3 THEN gender END AS gender, role
FROM lit0 WHERE form < 4"""

    # content ---------------------------------------------------------------
    tw = tfidf_cte(DOC_TF, "SELECT count(*) AS n FROM documents WHERE text IS NOT NULL")
    q["tfidf_weights"] = f"WITH {tw} SELECT mov_id, term, round(weight, 6) AS weight FROM w"
    q["similar_items"] = f"""WITH {tw}, {SIMILAR}
SELECT mov_id, CAST(rank AS BIGINT) AS rank, similar_id, round(sim, 6) AS sim FROM ranked WHERE rank <= 10"""
    q["recommend_content"] = f"""WITH {RATE}, {tw}, {SIMILAR},
seeds AS (SELECT user_id, mov_id AS seed FROM (
  SELECT user_id, mov_id, row_number() OVER (PARTITION BY user_id ORDER BY grade DESC, mov_id) AS rn FROM rate)
  WHERE rn <= 3),
pool AS (SELECT s.user_id, r.similar_id AS mov_id, max(r.sim) AS score
         FROM seeds s JOIN ranked r ON r.mov_id = s.seed WHERE r.rank <= 10 GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, mov_id) AS rank FROM pool)
SELECT user_id, CAST(rank AS BIGINT) AS rank, mov_id, round(score, 6) AS score FROM top WHERE rank <= 10"""
    facet_tf = f"""
SELECT mov_id, term, CAST(sum(w) AS DOUBLE) AS tf FROM (
  SELECT mov_id, w, unnest(regexp_extract_all(lower(name), '{TOKEN_PATTERN}', 1)) AS term FROM (
    SELECT DISTINCT d.mov_id, x.name, 3 AS w FROM direct d JOIN director x USING (director_id)
    UNION ALL SELECT DISTINCT a.mov_id, c.name, 1 AS w FROM act a JOIN mov_cast c USING (cast_id)
    UNION ALL SELECT DISTINCT b.mov_id, g.name, 2 AS w FROM belong_to b JOIN genre g USING (genre_id)))
WHERE term NOT IN {STOP} GROUP BY mov_id, term"""
    q["similar_items_facets"] = f"""WITH {GENRE}, {DIRECTOR}, {CAST}, {tfidf_cte(facet_tf)}, {SIMILAR}
SELECT mov_id, CAST(rank AS BIGINT) AS rank, similar_id, round(sim, 6) AS sim FROM ranked WHERE rank <= 10"""

    # collaborative -----------------------------------------------------------
    q["user_neighbors"] = f"""WITH {c}, {NEIGHBOURS}
SELECT u AS user_id, CAST(rank AS BIGINT) AS rank, v AS neighbor_id, round(sim, 6) AS sim FROM nb"""
    q["recommend_user_cf"] = f"""WITH {c}, {NEIGHBOURS},
items AS (SELECT DISTINCT mov_id FROM cells),
imp AS (SELECT nb.u AS user_id, i.mov_id, nb.sim * coalesce(x.grade, um.mu) AS v
        FROM nb JOIN um ON um.user_id = nb.v CROSS JOIN items i
        LEFT JOIN cells x ON x.user_id = nb.v AND x.mov_id = i.mov_id),
sc AS (SELECT user_id, mov_id, sum(v) / count(*) AS score FROM imp GROUP BY user_id, mov_id),
unr AS (SELECT * FROM sc WHERE NOT EXISTS (
          SELECT 1 FROM cells x WHERE x.user_id = sc.user_id AND x.mov_id = sc.mov_id)),
top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, mov_id) AS rank FROM unr)
SELECT user_id, CAST(rank AS BIGINT) AS rank, mov_id, round(score, 6) AS score FROM top WHERE rank <= 10"""
    q["predict_user_cf"] = f"""WITH {c}, {NEIGHBOURS},
pairs AS (SELECT DISTINCT user_id, mov_id FROM test WHERE mov_id IN (SELECT mov_id FROM cells)),
pj AS (SELECT p.user_id, p.mov_id, nb.sim, coalesce(x.grade, um.mu) AS imp FROM pairs p
       JOIN nb ON nb.u = p.user_id
       LEFT JOIN cells x ON x.user_id = nb.v AND x.mov_id = p.mov_id
       LEFT JOIN um ON um.user_id = nb.v),
pred AS (SELECT user_id, mov_id, CASE WHEN sum(sim) <> 0 THEN sum(imp * sim) / sum(sim) END AS prediction
         FROM pj GROUP BY user_id, mov_id)
SELECT t.user_id, t.mov_id, t.grade, round(p.prediction, 6) AS prediction
FROM test t LEFT JOIN pred p ON p.user_id = t.user_id AND p.mov_id = t.mov_id"""
    q["unrated_items"] = f"""WITH {c}, {NEIGHBOURS}
SELECT DISTINCT nb.u AS user_id, x.mov_id FROM nb JOIN cells x ON x.user_id = nb.v
WHERE NOT EXISTS (SELECT 1 FROM cells y WHERE y.user_id = nb.u AND y.mov_id = x.mov_id)"""
    q["impute_user_mean"] = f"""WITH {c},
um AS (SELECT user_id, avg(grade) AS mu FROM cells GROUP BY user_id),
pairs AS (SELECT DISTINCT user_id, mov_id FROM test)
SELECT p.user_id, p.mov_id, round(coalesce(x.grade, um.mu), 6) AS imputed
FROM pairs p LEFT JOIN cells x ON x.user_id = p.user_id AND x.mov_id = p.mov_id
LEFT JOIN um ON um.user_id = p.user_id"""
    q["impute_rated"] = f"""WITH {c},
um AS (SELECT user_id, avg(grade) AS mu FROM cells GROUP BY user_id),
pairs AS (SELECT user_id, mov_id FROM test UNION SELECT user_id, mov_id FROM cells)
SELECT p.user_id, p.mov_id, round(coalesce(x.grade, um.mu), 6) AS imputed
FROM pairs p LEFT JOIN cells x ON x.user_id = p.user_id AND x.mov_id = p.mov_id
LEFT JOIN um ON um.user_id = p.user_id"""
    q["holdout_exact"] = f"""WITH {RATINGS},
pairs AS (SELECT DISTINCT user_id, mov_id FROM r),
drawn AS (SELECT *, (((user_id % 2147483648) * 7919 + (mov_id % 2147483648) * 104729 + 17) % 2147483648 * 1103515245 + 12345)
                    % 2147483648 AS draw FROM pairs),
held AS (SELECT user_id, mov_id FROM drawn ORDER BY draw, user_id, mov_id LIMIT 10000)
SELECT r.user_id, r.mov_id, r.grade, CASE WHEN h.user_id IS NULL THEN 'train' ELSE 'test' END AS part
FROM r LEFT JOIN held h ON h.user_id = r.user_id AND h.mov_id = r.mov_id"""
    q["factor_top"] = """
WITH p AS (
  SELECT a.vec_id AS user_id, b.vec_id AS mov_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
  FROM embeddings a CROSS JOIN embeddings b),
t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, mov_id) AS rank FROM p)
SELECT user_id, CAST(rank AS BIGINT) AS rank, mov_id, round(score, 6) AS score FROM t WHERE rank <= 10"""
    content5 = q["recommend_content"].replace("r.rank <= 10", "r.rank <= 5").replace("rank <= 10", "rank <= 5")
    weighted5 = q["rank_weighted"].replace("WHERE rank <= 10", "WHERE rank <= 5")
    q["recommend_lists"] = f"""
WITH cont AS ({content5}), wei AS ({weighted5})
SELECT user_id, 'content' AS method, rank, mov_id, score FROM cont
UNION ALL SELECT CAST(NULL AS BIGINT), 'weighted', rank, mov_id, score FROM wei
UNION ALL SELECT c_custkey, 'weighted', rank, mov_id, score FROM customer CROSS JOIN wei"""
    q["dense_ids"] = f"""WITH {RATINGS}
SELECT 'user' AS kind, user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM r)
UNION ALL
SELECT 'item', mov_id, row_number() OVER (ORDER BY mov_id) - 1 FROM (SELECT DISTINCT mov_id FROM r)"""

    # evaluation --------------------------------------------------------------
    bias = """
c0 AS (SELECT avg(grade) AS c FROM cells),
bi1 AS (SELECT mov_id, avg(grade - (SELECT c FROM c0)) AS bi FROM cells GROUP BY mov_id),"""
    for k in (1, 2, 3):
        if k > 1:
            bias += f"""
bi{k} AS (SELECT x.mov_id, avg(x.grade - (SELECT c FROM c0) - coalesce(b.bu, 0)) AS bi
          FROM cells x LEFT JOIN bu{k - 1} b ON b.user_id = x.user_id GROUP BY x.mov_id),"""
        bias += f"""
bu{k} AS (SELECT x.user_id, avg(x.grade - (SELECT c FROM c0) - coalesce(b.bi, 0)) AS bu
          FROM cells x LEFT JOIN bi{k} b ON b.mov_id = x.mov_id GROUP BY x.user_id),"""
    bias += """
pred_bias AS (SELECT t.user_id, t.mov_id, t.grade,
              (SELECT c FROM c0) + coalesce(u.bu, 0) + coalesce(i.bi, 0) AS prediction
              FROM test t LEFT JOIN bu3 u ON u.user_id = t.user_id LEFT JOIN bi3 i ON i.mov_id = t.mov_id)"""
    q["predict_bias"] = f"""WITH {c}, {bias}
SELECT user_id, mov_id, grade, round(prediction, 6) AS prediction FROM pred_bias"""

    def rmse(method, pred):
        return f"""SELECT '{method}' AS method,
  round(sqrt(avg(CASE WHEN prediction IS NOT NULL THEN (grade - prediction) * (grade - prediction) END)), 6) AS rmse,
  count(prediction) AS n_scored, count_if(prediction IS NULL) AS n_missing FROM {pred}"""

    preds = f"""WITH {c}, {NEIGHBOURS}, {bias},
st AS (SELECT mov_id, avg(grade) AS mean, sum(grade) AS total, count(*) AS n FROM cells GROUP BY mov_id),
pred_mean AS (SELECT t.user_id, t.mov_id, t.grade, st.mean AS prediction FROM test t LEFT JOIN st USING (mov_id)),
pred_weighted AS (SELECT t.user_id, t.mov_id, t.grade,
  st.n / (st.n + 10.0) * (st.total / st.n) + 10.0 / (st.n + 10.0) * (SELECT avg(grade) FROM cells) AS prediction
  FROM test t LEFT JOIN st USING (mov_id)),
pairs AS (SELECT DISTINCT user_id, mov_id FROM test WHERE mov_id IN (SELECT mov_id FROM cells)),
pj AS (SELECT p.user_id, p.mov_id, nb.sim, coalesce(x.grade, um.mu) AS imp FROM pairs p
       JOIN nb ON nb.u = p.user_id
       LEFT JOIN cells x ON x.user_id = nb.v AND x.mov_id = p.mov_id
       LEFT JOIN um ON um.user_id = nb.v),
pcf AS (SELECT user_id, mov_id, CASE WHEN sum(sim) <> 0 THEN sum(imp * sim) / sum(sim) END AS prediction
        FROM pj GROUP BY user_id, mov_id),
pred_cf AS (SELECT t.user_id, t.mov_id, t.grade, p.prediction FROM test t
            LEFT JOIN pcf p ON p.user_id = t.user_id AND p.mov_id = t.mov_id)
"""
    q["rmse_mean"] = preds + rmse("mean", "pred_mean")
    q["rmse_weighted"] = preds + rmse("weighted", "pred_weighted")
    q["rmse_user_cf"] = preds + rmse("user_cf", "pred_cf")
    q["rmse_bias"] = preds + rmse("bias", "pred_bias")
    q["compare_methods"] = preds + " UNION ALL ".join(
        f"({rmse(m, p)})" for m, p in (("mean", "pred_mean"), ("weighted", "pred_weighted"),
                                       ("user_cf", "pred_cf"), ("bias", "pred_bias")))

    # changes -----------------------------------------------------------------
    q["apply_rating_changes"] = f"""WITH {RATE},
log AS (SELECT event_id % 50 AS mov_id, user_id,
          CASE WHEN event_type IN ('signup', 'purchase', 'view') THEN 'upsert'
               WHEN event_type = 'click' THEN 'update' WHEN event_type = 'error' THEN 'delete' END AS op,
          least(5.0, CAST(floor(value / 50.0) AS DOUBLE)) AS grade, event_type AS review, ts, event_id AS seq
        FROM events),
lastop AS (SELECT mov_id, user_id, grade, review FROM (
  SELECT *, row_number() OVER (PARTITION BY mov_id, user_id ORDER BY ts DESC, seq DESC) AS rn FROM log) WHERE rn = 1),
laststruct AS (SELECT mov_id, user_id, op FROM (
  SELECT *, row_number() OVER (PARTITION BY mov_id, user_id ORDER BY ts DESC, seq DESC) AS rn
  FROM log WHERE op <> 'update') WHERE rn = 1),
changed AS (SELECT l.mov_id, l.user_id, l.grade, l.review FROM lastop l
  LEFT JOIN laststruct s ON s.mov_id = l.mov_id AND s.user_id = l.user_id
  WHERE s.op = 'upsert' OR (s.op IS NULL AND EXISTS (
    SELECT 1 FROM rate r WHERE r.mov_id = l.mov_id AND r.user_id = l.user_id)))
SELECT mov_id, user_id, grade, review FROM rate r
WHERE NOT EXISTS (SELECT 1 FROM log k WHERE k.mov_id = r.mov_id AND k.user_id = r.user_id)
UNION ALL SELECT mov_id, user_id, grade, review FROM changed"""

    q["merge_rating_changes"] = q["apply_rating_changes"]

    q["append_new_items"] = f"""WITH {MOVIE}
SELECT CASE WHEN runtime <= 40 THEN name ELSE 'New ' || name END AS name, mov_id, runtime, revenue FROM movie"""
    q["onboarding_fold"] = f"""WITH {RATE},
drawn AS (SELECT p_partkey AS mov_id, (p_partkey * 1103515245 + 12345) % 2147483648 AS draw FROM part ORDER BY draw, mov_id LIMIT 8)
SELECT mov_id, user_id, grade, review FROM rate
UNION ALL SELECT mov_id, (SELECT max(c_custkey) + 1 FROM customer), CAST(1 + draw % 5 AS DOUBLE), NULL FROM drawn"""

    q["append_new_users"] = f"""WITH {USERS},
su AS (SELECT CASE WHEN event_id % 2 = 0 THEN printf('customer#%09d', user_id) ELSE 'user' || CAST(user_id AS VARCHAR) END AS username,
              'User ' || CAST(user_id AS VARCHAR) AS name,
              event_id AS seq FROM events WHERE event_type = 'signup'),
fs AS (SELECT username, name, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY username ORDER BY seq) AS rn FROM su) WHERE rn = 1),
nw AS (SELECT * FROM fs WHERE username NOT IN (SELECT username FROM users))
SELECT user_id, username, name FROM users
UNION ALL
SELECT CAST((SELECT max(user_id) FROM users) + row_number() OVER (ORDER BY seq) AS BIGINT), username, name FROM nw"""

    q["onboarding_sample"] = """
SELECT p_partkey AS mov_id, p_name AS name, (p_partkey * 1103515245 + 12345) % 2147483648 AS draw
FROM part ORDER BY draw, mov_id LIMIT 8"""

    # integrity ---------------------------------------------------------------
    def pk(name, src, keys):
        k = " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in keys)
        return (f"SELECT '{name}' AS tbl, {k} AS key, count(*) AS n FROM {src} "
                f"GROUP BY {', '.join(keys)} HAVING count(*) > 1")

    links = f"""
website AS ({q["etl_website"]}), link AS ({q["etl_link"]}),
feed AS (SELECT l_partkey + l_linenumber - 1 AS mov_id, 'tt' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS web_id FROM lineitem)"""

    q["pk_violations"] = f"""WITH {RATE}, {MOVIE}, {GENRE}, {DIRECTOR}, {CAST}, {USERS}, {links}
""" + "\nUNION ALL ".join([
        pk("rating_rows", "r", ["mov_id", "user_id"]), pk("rate", "rate", ["mov_id", "user_id"]),
        pk("movie", "movie", ["mov_id"]), pk("genre", "genre", ["genre_id"]),
        pk("director", "director", ["director_id"]), pk("mov_cast", "mov_cast", ["cast_id"]),
        pk("user_most_like", "users", ["user_id"]), pk("user_most_like.username", "users", ["username"]),
        pk("belong_to", "belong_to", ["mov_id", "genre_id"]), pk("direct", "direct", ["mov_id", "director_id"]),
        pk("act", "act", ["mov_id", "cast_id"]), pk("website", "website", ["web_id"]), pk("link", "link", ["mov_id"]),
        pk("feed_link", "feed", ["mov_id", "web_id"])])

    def fk(name, child, col, parent, pcol):
        return (f"SELECT '{name}' AS tbl, '{col}' AS col, CAST({col} AS VARCHAR) AS value, count(*) AS n "
                f"FROM {child} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {pcol} FROM {parent}) "
                f"GROUP BY {col}")

    log_cte = """
log AS (SELECT event_id % 50 AS mov_id, user_id, least(5.0, CAST(floor(value / 50.0) AS DOUBLE)) AS grade,
        event_id AS seq FROM events)"""
    q["fk_violations"] = f"""WITH {PROFILES}, {MOVIE}, {DIRECTOR}, {CAST}, {log_cte}, {links}
""" + "\nUNION ALL ".join([
        fk("rate", "rate", "mov_id", "movie", "mov_id"), fk("rate", "rate", "user_id", "users", "user_id"),
        fk("belong_to", "belong_to", "mov_id", "movie", "mov_id"),
        fk("belong_to", "belong_to", "genre_id", "genre", "genre_id"),
        fk("direct", "direct", "mov_id", "movie", "mov_id"),
        fk("direct", "direct", "director_id", "director", "director_id"),
        fk("act", "act", "mov_id", "movie", "mov_id"), fk("act", "act", "cast_id", "mov_cast", "cast_id"),
        fk("rating_changes", "log", "mov_id", "movie", "mov_id"),
        fk("rating_changes", "log", "user_id", "users", "user_id"),
        fk("link", "link", "mov_id", "movie", "mov_id"), fk("link", "link", "web_id", "website", "web_id"),
        fk("feed_link", "feed", "mov_id", "movie", "mov_id"), fk("feed_link", "feed", "web_id", "website", "web_id"),
        fk("user_most_like", "profiles", "genre_id", "genre", "genre_id"),
        fk("rate_after_removal", "rate", "mov_id", "(SELECT * FROM movie WHERE runtime > 5)", "mov_id")])

    q["check_violations"] = f"""WITH {PROFILES}, {DIRECTOR}, {log_cte}
SELECT 'rate' AS tbl, 'grade_range' AS rule, CAST(mov_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) AS key
FROM rate WHERE NOT coalesce(grade >= 0 AND grade <= 5, true)
UNION ALL SELECT 'rating_rows', 'rating_range', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)
FROM r WHERE NOT coalesce(rating >= 0 AND rating <= 5, true)
UNION ALL SELECT 'rating_feed', 'rating_range', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)
FROM r WHERE NOT (l_quantity / 9.0 >= 0 AND l_quantity / 9.0 <= 5)
UNION ALL SELECT 'rating_changes', 'grade_range', CAST(seq AS VARCHAR) FROM log
WHERE NOT coalesce(grade >= 0 AND grade <= 5, true)
UNION ALL SELECT 'director', 'gender_range', CAST(director_id AS VARCHAR) FROM director
WHERE NOT coalesce(gender IN (0, 1, 2), true)
UNION ALL SELECT 'user_most_like', 'birthday_range', CAST(user_id AS VARCHAR) FROM profiles
WHERE NOT coalesce(birthday > DATE '1900-01-01' AND birthday < current_date, true)"""

    def dom(name, src, key, col, not_null):
        nn = f"{col} IS NULL AND {str(not_null).lower()}"
        return (f"SELECT '{name}' AS tbl, '{col}' AS col, "
                f"CASE WHEN {nn} THEN 'not_null' ELSE 'too_long' END AS rule, CAST({key} AS VARCHAR) AS key "
                f"FROM {src} WHERE ({nn}) OR length({col}) > 255")

    q["domain_violations"] = f"""WITH {RATE}, {MOVIE}, {GENRE}, {DIRECTOR}, {CAST}, {USERS}, {links},
texts AS (SELECT doc_id AS mov_id, text AS name FROM documents)
""" + "\nUNION ALL ".join([
        dom("movie", "movie", "mov_id", "name", False), dom("genre", "genre", "genre_id", "name", False),
        dom("director", "director", "director_id", "name", False),
        dom("mov_cast", "mov_cast", "cast_id", "name", False),
        dom("user_most_like", "users", "user_id", "name", False),
        dom("user_most_like", "users", "user_id", "username", True),
        dom("website", "website", "web_id", "web_id", True), dom("link", "link", "mov_id", "web_id", True),
        dom("movie_from_text", "texts", "mov_id", "name", False),
        dom("rate", "rate", "mov_id || '|' || user_id", "review", True)])
    def rows_of(kind, sql):
        return f"SELECT '{kind}' AS kind, tbl, rule, key, CAST(count(*) AS BIGINT) AS n FROM ({sql}) GROUP BY tbl, rule, key"

    q["audit_violations"] = (f"""WITH pk AS ({q["pk_violations"]}), fk AS ({q["fk_violations"]}),
ck AS ({q["check_violations"]}), dm AS ({q["domain_violations"]})
SELECT 'unique' AS kind, CASE WHEN tbl LIKE 'user_most_like%' THEN 'users' ELSE tbl END AS tbl,
       CASE WHEN tbl = 'user_most_like.username' THEN 'username' ELSE 'key' END AS rule, key, n
FROM pk WHERE tbl <> 'rating_rows'
UNION ALL SELECT 'reference', CASE WHEN tbl = 'rate_after_removal' THEN 'rate' ELSE tbl END, col, value, n FROM fk
UNION ALL """ + rows_of("check", "SELECT tbl, rule, key FROM ck") + """
UNION ALL SELECT rule, CASE WHEN tbl = 'user_most_like' THEN 'users' ELSE tbl END, col, key, CAST(count(*) AS BIGINT)
FROM dm GROUP BY ALL""")
    q["etl_load_checked"] = q["etl_load_all"]

    # DuckDB's count_if is HUGEINT; Spark's is BIGINT.
    return {k: re.sub(r"count_if\(([^()]*)\)", r"CAST(count_if(\1) AS BIGINT)", v) for k, v in q.items()}
